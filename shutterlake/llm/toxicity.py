"""Toxicity grades by cumulative-link ordinal regression.

A document has grade 0 (clean), 1 (toxic) or 2 (toxic, with more words that mark toxic documents
than the median of those). One weight for each feature is shared by all grades; only the
thresholds differ:
P(grade > k) = s(weights . features - threshold k), s the logistic function, thresholds rising.
The expected severity is the sum of these probabilities.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shutterlake.llm.common import annotate, checkpointed, least_hashed

GRADES = 3
ADDED = ("severity", "toxic_score", "grade")
TOXIC = 0.5  # probability from which a document counts as toxic
STEMS = (4, 5, 6)  # bytes of the word beginnings that are features beside whole words
# A-Z to lower case, every other ASCII byte but digits and lower case to a space
FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32
    for b in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(FOLD).split()


def features_of(word: bytes) -> set[bytes]:
    """The word itself and its beginnings, marked with ``*``."""
    return {word, *(word[:n] + b"*" for n in STEMS if len(word) >= n)}


@dataclass(frozen=True)
class Model:
    """Weights by feature, and the rising thresholds."""

    weights: dict[bytes, float]
    thresholds: tuple[float, ...]

    def severities(self, texts: list[str | None]) -> tuple[list[float], list[float]]:
        """Expected severity (0 to 2) and the probability of being toxic at all."""
        whole = {f for f in self.weights if not f.endswith(b"*")}
        stems = {n: {f[:-1] for f in self.weights if f.endswith(b"*") and len(f) == n + 1} for n in STEMS}
        sums = np.zeros(len(texts))
        for i, text in enumerate(texts):
            words = words_of(text)
            distinct = set(words)
            hit = distinct & whole
            for n, known in stems.items():
                if known and not known.isdisjoint([w[:n] for w in distinct]):
                    hit |= {w for w in distinct if w[:n] in known}
            if hit:
                times = Counter(w for w in words if w in hit)
                counts: Counter = Counter()
                for word, number in times.items():
                    for feature in features_of(word):
                        if feature in self.weights:
                            counts[feature] += number
                # summed in a fixed order, so that reruns agree
                sums[i] = sum(self.weights[f] * np.log1p(counts[f]) for f in sorted(counts))
        above = 1 / (1 + np.exp(-np.clip(sums[:, None] - np.array(self.thresholds), -50, 50)))
        return above.sum(axis=1).tolist(), above[:, 0].tolist()


def learn(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    docs_per_class: int = 4000,
    features: int = 400,
    lift: float = 10.0,
    support: float = 0.02,
) -> Model:
    """Learns from ``labels(id, label)``, 1 for toxic and 0 for clean; other values are unused.

    The sample is bounded: of toxic and of clean ids the ``docs_per_class`` with the smallest
    hash (an id labelled both ways is left out). Equal texts count once. Features are the
    ``features`` words and word beginnings with the largest chi-square among those in three
    toxic documents, and a share of ``support`` of them, and at least ``lift`` times as frequent
    there as in clean ones; counting is done by tasks. With no toxic
    or no clean document nothing is learned, and every severity is near zero.
    """
    given = (
        labels.select(F.col(id_column).alias("id"), F.col(label).alias("toxic"))
        .where("id is not null and toxic in (0, 1)")
        .groupBy("id")
        .agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("_other"))
        .where("toxic = _other")
    )
    present = given.join(docs.select(F.col(id_column).alias("id")), "id", "left_semi").select(
        "id", "toxic", F.xxhash64(F.col("id").cast("string")).alias("key")
    )
    chosen = least_hashed(present, "toxic", "key", docs_per_class).select("id", "toxic")
    # at most 2 * docs_per_class ids of 12 bytes
    texts = docs.select(F.col(id_column).alias("id"), F.col(text).alias("text"))
    sample = texts.join(F.broadcast(chosen), "id").groupBy(F.xxhash64("text")).agg(
        F.max("toxic").alias("toxic"), F.first("text").alias("text")
    )
    sample = checkpointed(sample.select("toxic", "text"))
    sizes = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)
    if not n_toxic or not n_clean:
        return Model({}, (20.0, 20.0))

    def presence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[int, Counter] = {0: Counter(), 1: Counter()}
            for toxic, one in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = set(words_of(one))
                found[toxic].update({f for w in words for f in features_of(w)})
            names = sorted(set(found[0]) | set(found[1]))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(names, pa.binary()),
                    pa.array([found[1][f] for f in names], pa.int64()),
                    pa.array([found[0][f] for f in names], pa.int64()),
                ],
                names=["feature", "a", "c"],
            )

    seen = sample.mapInArrow(presence, "feature binary, a bigint, c bigint")
    seen = seen.groupBy("feature").agg(F.sum("a").alias("a"), F.sum("c").alias("c"))
    n = n_toxic + n_clean
    expected = (F.col("a") + F.col("c")) * (n_toxic / n)
    surprise = (F.col("a") - expected) ** 2 / (expected * (n_clean / n))
    rate = ((F.col("a") + 0.5) / (n_toxic + 1)) / ((F.col("c") + 0.5) / (n_clean + 1))
    best = (
        seen.where((F.col("a") >= max(3, support * n_toxic)) & (rate >= lift))
        .select("feature", surprise.alias("surprise"))
        .orderBy(F.desc("surprise"), "feature")
        .limit(features)
        .collect()  # at most `features` rows
    )
    index = {bytes(r["feature"]): i for i, r in enumerate(best)}

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic, ids, counts, hits = [], [], [], []
            for label_, one in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = words_of(one)
                own: Counter = Counter()
                marked = 0
                for word, times in Counter(words).items():
                    known = [index[f] for f in features_of(word) if f in index]
                    marked += times * bool(known)
                    for i in known:
                        own[i] += times
                keys = sorted(own)
                toxic.append(label_)
                ids.append(keys)
                counts.append([float(own[i]) for i in keys])
                hits.append(float(marked))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(toxic, pa.int32()),
                    pa.array(ids, pa.list_(pa.int32())),
                    pa.array(counts, pa.list_(pa.float64())),
                    pa.array(hits, pa.float64()),
                ],
                names=["toxic", "ids", "counts", "marked"],
            )

    schema = "toxic int, ids array<int>, counts array<double>, marked double"
    # at most 2 * docs_per_class rows of at most `features` numbers
    rows = sample.mapInArrow(vectors, schema).collect()
    rows.sort(key=lambda r: (r["toxic"], r["marked"], r["ids"], r["counts"]))
    x = np.zeros((len(rows), len(index)))
    for i, row in enumerate(rows):
        x[i, row["ids"]] = np.log1p(row["counts"])
    toxic = np.array([r["toxic"] for r in rows])
    marked = np.array([r["marked"] for r in rows])
    some = marked[(toxic == 1) & (marked > 0)]
    grade = toxic + ((toxic == 1) & (marked > (np.median(some) if len(some) else 0)))
    weights, thresholds = fit(x, grade)
    return Model(
        {f: float(weights[i]) for f, i in index.items()}, tuple(float(t) for t in thresholds)
    )


def fit(
    x: np.ndarray, grade: np.ndarray, rounds: int = 600, ridge: float = 1e-4, pace: float = 0.1
) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds of the largest penalised likelihood, by adaptive gradient steps.

    The likelihood of grade g is P(grade > g - 1) - P(grade > g). Thresholds are the first one
    plus the exponentials of free numbers, which keeps them rising.
    """
    n, d = x.shape
    value = np.zeros(d + GRADES - 1)
    mean, square = np.zeros_like(value), np.zeros_like(value)
    row, rest, top = np.arange(n), grade < GRADES - 1, grade > 0
    for turn in range(1, rounds + 1):
        w, first, gaps = value[:d], value[d], np.exp(np.clip(value[d + 1 :], -8, 5))
        theta = first + np.concatenate([[0], np.cumsum(gaps)])
        s = 1 / (1 + np.exp(-np.clip((x @ w)[:, None] - theta, -40, 40)))
        upper = np.hstack([np.ones((n, 1)), s])
        lower = np.hstack([s, np.zeros((n, 1))])
        p = np.maximum(upper[row, grade] - lower[row, grade], 1e-12)
        slope = s * (1 - s)
        # d log p / d (w.x - theta_k) for the threshold below and above the grade
        pull = np.zeros_like(s)
        pull[row[top], grade[top] - 1] += slope[row[top], grade[top] - 1] / p[top]
        pull[row[rest], grade[rest]] -= slope[row[rest], grade[rest]] / p[rest]
        up = x.T @ pull.sum(axis=1) / n - ridge * w
        down = -pull.mean(axis=0)
        step = np.concatenate([up, [down.sum()], gaps * np.cumsum(down[:0:-1])[::-1]])
        mean = 0.9 * mean + 0.1 * step
        square = 0.999 * square + 0.001 * step**2
        size = np.sqrt(square / (1 - 0.999**turn)) + 1e-8
        value += pace * (1 - turn / (rounds + 1)) * mean / (1 - 0.9**turn) / size
    gaps = np.exp(np.clip(value[d + 1 :], -8, 5))
    return value[:d], value[d] + np.concatenate([[0], np.cumsum(gaps)])


def predict(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``df`` with ``severity`` (expected grade, 0 to 2), ``toxic_score`` (probability of any
    toxicity) and ``grade`` (the severity rounded). Null and empty texts score like a text
    without features. Columns of these names are replaced.
    """

    def run(values: pa.Array) -> list:
        severity, score = model.severities(values.to_pylist())
        return [severity, score, [int(s + 0.5) for s in severity]]

    return annotate(df, text, "severity double, toxic_score double, grade int", run)
