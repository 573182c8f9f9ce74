"""N-gram language model with deleted interpolation.

p_k(w | context) = a * count(context w) / count(context) + (1 - a) * p_(k-1)(w | shorter context),
down to p_0 = 1 / (V + 1), which gives an unknown word its share. The weight ``a`` of a level
depends on how frequent the context is (one bucket for each power of two) and is learned by
expectation-maximisation on counts of training documents that are held out of the counts for that.

Counts meet texts without a row for each token in a shuffle. Texts are packed into units of some
megabytes, whose words are numbered; a unit sends each of its distinct n-grams once, as sorted
64-bit hashes in compressed blocks, one block for each bucket of hashes. A bucket adds up what all
units sent and returns the totals in the order asked for. A unit then has all counts it needs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shutterlake.llm.common import materialized, pieces

UNIT_BYTES = 4 << 20  # text of a unit
BUCKET_TOKENS = 1 << 21  # tokens of the input for each bucket of hashes
START, END = np.uint64(0x9AE16A3B2F90404F), np.uint64(0xC949D7C7509E6557)
SCORED, COUNTED, HELD = 0, 1, 2  # only scored; counted; counted, and weights learned on it
BINS_A_BIT = 16  # resolution of likelihood ratios while weights are learned
LARGEST = 40  # bits of the largest ratio told apart


def pack(values: np.ndarray) -> bytes:
    """Numbers as compressed byte planes."""
    if not len(values):
        return zstandard.compress(b"", 1)
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T)
    return zstandard.compress(planes.tobytes(), 1)


def unpack(block: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    planes = np.frombuffer(zstandard.decompress(block), np.uint8).reshape(size, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def pack_sorted(values: np.ndarray) -> bytes:
    return pack(np.diff(values, prepend=np.uint64(0)))


def unpack_sorted(block: bytes) -> np.ndarray:
    return np.cumsum(unpack(block, np.uint64), dtype=np.uint64)


def mixed(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of a context's hash and the word behind it."""
    z = context * np.uint64(0x9E3779B97F4A7C15) + word
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


@dataclass
class Model:
    """Sums over all training texts, and the weights by level and bucket of context counts."""

    order: int
    tokens: int = 0
    distinct: int = 0
    documents: int = 0
    weights: list[np.ndarray] = field(default_factory=list)


class Unit:
    """The n-grams of a unit, at every place where a token stands."""

    def __init__(self, words: np.ndarray, tokens: np.ndarray, lengths: np.ndarray, order: int):
        pad = order - 1 or 1
        sizes = lengths + pad + 1
        ends = np.cumsum(sizes) - 1
        flat = np.full(int(sizes.sum()), START, np.uint64)
        self.real = np.ones(len(flat), bool)
        starts = ends - sizes + 1
        self.real[(starts[:, None] + np.arange(pad)).ravel()] = False
        flat[ends] = END
        inside = self.real.copy()
        inside[ends] = False
        flat[inside] = words[tokens]
        self.document = np.repeat(np.arange(len(lengths)), lengths + 1)
        self.keys, self.at = [], []
        key = flat
        for k in range(1, order + 1):
            if k > 1:
                key = np.concatenate([[START], mixed(key[:-1], flat[1:])])
            found, at = np.unique(key[self.real], return_inverse=True)
            self.keys.append(found)
            self.at.append(at)
        self.first = np.flatnonzero(~self.real[:-1] & self.real[1:]) + 1
        self.first = np.cumsum(self.real)[self.first] - 1  # first token of each document

    def counts(self, totals: list[np.ndarray], k: int) -> np.ndarray:
        return totals[k - 1][self.at[k - 1]]

    def contexts(self, totals: list[np.ndarray], k: int, documents: int) -> np.ndarray:
        """Count of the context of the k-gram at every token."""
        before = np.concatenate([[0], self.counts(totals, k - 1)[:-1]])
        before[self.first] = documents
        return before


def bucket_of(count: np.ndarray) -> np.ndarray:
    """0 for a context never seen, else one bucket for each power of two."""
    return np.where(count > 0, np.log2(np.maximum(count, 1)).astype(np.int64) + 1, 0)


def probabilities(unit: Unit, totals: list[np.ndarray], model: Model, levels: int) -> np.ndarray:
    """p of every token with the levels up to ``levels``."""
    p = np.full(len(unit.document), 1 / (model.distinct + 1))
    for k in range(1, levels + 1):
        share, context = ml(unit, totals, model, k)
        weight = model.weights[k - 1][bucket_of(context)]
        p = weight * share + (1 - weight) * p
    return p


def ml(unit: Unit, totals: list[np.ndarray], model: Model, k: int):
    """Maximum-likelihood estimate of level k at every token, and its context's count."""
    count = unit.counts(totals, k)
    if k == 1:
        context = np.full(len(count), model.tokens)
    else:
        context = unit.contexts(totals, k, model.documents)
    return count / np.maximum(context, 1), context


def _units(df: DataFrame, id_column: str, text: str, part) -> DataFrame:
    name = F.col(id_column).cast("string").alias("id")
    rows = df.select(name, part.alias("part"), F.col(text).alias("text"))
    schema = (
        "unit binary, part int, lengths binary, words binary, tokens binary, n_tokens bigint, "
        "ids array<string>"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        building: dict[int, list] = {}

        def row(part: int) -> pa.RecordBatch:
            ids, lengths, known, tokens, _ = building.pop(part)
            flat = np.concatenate([np.array([], np.int32), *tokens])
            words = np.fromiter(map(xxhash.xxh64_intdigest, known), np.uint64, len(known))
            ids = pa.concat_arrays(ids)
            name = np.random.default_rng().bytes(12)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([name], pa.binary()),
                    pa.array([part], pa.int32()),
                    pa.array([pack(np.array(lengths, np.int64))], pa.binary()),
                    pa.array([words.tobytes()], pa.binary()),
                    pa.array([pack(flat)], pa.binary()),
                    pa.array([len(flat) + len(lengths)], pa.int64()),
                    pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                ],
                names=["unit", "part", "lengths", "words", "tokens", "n_tokens", "ids"],
            )

        for batch in pieces(batches):
            parts = batch.column(1).to_pylist()
            for i, one in enumerate(batch.column(2).to_pylist()):
                part = parts[i]
                unit = building.setdefault(part, [[], [], {}, [], 0])
                words = (one or "").encode("utf-8", "surrogatepass").lower().split()
                known = unit[2]
                for word in set(words).difference(known):
                    known[word] = len(known)
                unit[0].append(batch.column(0).slice(i, 1))
                unit[1].append(len(words))
                unit[3].append(np.fromiter(map(known.__getitem__, words), np.int32, len(words)))
                unit[4] += len(one or "") + 64
                if unit[4] >= UNIT_BYTES:
                    yield row(part)
        for part in sorted(building):
            yield row(part)

    return materialized(rows.mapInArrow(run, schema), "lm-units")


def _load(row, order: int) -> Unit:
    words = np.frombuffer(row["words"], np.uint64)
    tokens = unpack(row["tokens"], np.int32) if row["n_tokens"] else np.array([], np.int32)
    return Unit(words, tokens, unpack(row["lengths"], np.int64), order)


def _slices(keys: np.ndarray, bits: int) -> np.ndarray:
    """Where each bucket begins among sorted hashes, which their first bits deal out."""
    edges = np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits)
    return np.concatenate([[0], np.searchsorted(keys, edges), [len(keys)]])


def _totals(units: DataFrame, order: int, bits: int) -> DataFrame:
    """``(unit, level, bucket, counted, held)``: totals of a unit's n-grams, in its order, and one
    row for each bucket, without a unit, with its sums."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number in range(batch.num_rows):
                row = batch.slice(number, 1).to_pylist()[0]
                unit = _load(row, order)
                out = []
                for k in range(1, order + 1):
                    keys = unit.keys[k - 1]
                    times = np.bincount(unit.at[k - 1], minlength=len(keys)).astype(np.int64)
                    cuts = _slices(keys, bits) if bits else np.array([0, len(keys)])
                    for bucket, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                        if b > a:
                            out.append((
                                k, bucket, row["unit"], row["part"], pack_sorted(keys[a:b]),
                                pack(times[a:b]) if row["part"] != SCORED else b"",
                            ))
                yield pa.RecordBatch.from_pylist(
                    [dict(zip(names, r, strict=True)) for r in out], schema=asked
                )

    names = ["level", "bucket", "unit", "part", "keys", "times"]
    kinds = [pa.int32(), pa.int64(), pa.binary(), pa.int32(), pa.binary(), pa.binary()]
    asked = pa.schema(list(zip(names, kinds, strict=True)))
    requests = units.select("unit", "part", "lengths", "words", "tokens", "n_tokens").mapInArrow(
        ask, "level int, bucket bigint, unit binary, part int, keys binary, times binary"
    )

    def add(group: pd.DataFrame) -> pd.DataFrame:
        keys = [unpack_sorted(block) for block in group["keys"]]
        sizes = np.array([len(k) for k in keys])
        found, at = np.unique(np.concatenate(keys), return_inverse=True)
        del keys
        sums = {COUNTED: np.zeros(len(found)), HELD: np.zeros(len(found))}
        edges = np.concatenate([[0], np.cumsum(sizes)])
        for i, (part, times) in enumerate(zip(group["part"], group["times"], strict=True)):
            if part != SCORED:
                own = at[edges[i] : edges[i + 1]]
                sums[part][own] += unpack(times, np.int64)
        counted, held = (sums[p].astype(np.int64) for p in (COUNTED, HELD))
        level, bucket = group["level"].iloc[0], group["bucket"].iloc[0]
        whole = counted + held
        rows = [
            (g, p, level, bucket, pack(counted[at[a:b]]), pack(held[at[a:b]]), None, None, None)
            for g, p, a, b in zip(group["unit"], group["part"], edges[:-1], edges[1:], strict=True)
        ]
        ends = found == END if level == 1 else np.zeros(len(found), bool)
        rows.append((
            None, None, level, bucket, None, None, [int(counted.sum()), int(whole.sum())],
            [int((counted > 0).sum()), int((whole > 0).sum())],
            [int(counted[ends].sum()), int(whole[ends].sum())],
        ))
        columns = ["unit", "part", "level", "bucket", "counted", "held"]
        columns += ["tokens", "distinct", "documents"]
        return pd.DataFrame(rows, columns=columns)

    answers = requests.groupBy("level", "bucket").applyInPandas(
        add,
        "unit binary, part int, level int, bucket bigint, counted binary, held binary, "
        "tokens array<bigint>, distinct array<bigint>, documents array<bigint>",
    )
    return materialized(answers, "lm-totals")


def _totals_of(answers: pd.DataFrame, order: int, with_held: bool) -> list[np.ndarray]:
    found = []
    answers = answers.sort_values(["level", "bucket"])
    for k in range(1, order + 1):
        own = answers[answers["level"] == k]
        blocks = [unpack(b, np.int64) for b in own["counted"]]
        if with_held:
            held = (unpack(b, np.int64) for b in own["held"])
            blocks = [a + b for a, b in zip(blocks, held, strict=True)]
        found.append(np.concatenate([np.array([], np.int64), *blocks]))
    return found


def _ratios(known: Model, k: int):
    """Counts the held-out tokens of a unit by context bucket and likelihood ratio of level k."""

    def count(own: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        unit = _load(own.iloc[0], known.order)
        sums = _totals_of(answers, known.order, False)
        share, context = ml(unit, sums, known, k)
        ratio = share / probabilities(unit, sums, known, k - 1)
        with np.errstate(divide="ignore"):
            bits = np.clip(np.log2(ratio), -LARGEST - 1, LARGEST)
        bins = np.round(bits * BINS_A_BIT).astype(np.int64)
        # a context never seen has no say, whatever the weight
        pairs = np.stack([bucket_of(context), bins])[:, context > 0]
        found, times = np.unique(pairs, axis=1, return_counts=True)
        return pd.DataFrame({"context": found[0], "bin": found[1], "n": times})

    return count


def _learn_weights(units, totals, model: Model) -> list[np.ndarray]:
    """Weights of all levels, the lowest first, as each needs the probabilities below it.

    Tasks count held-out tokens by level, bucket of the context and (logarithm of the) ratio of
    the two likelihoods that are mixed, which is all that the EM steps need.
    """
    held = units.where(F.col("part") == HELD)
    totals = totals.where(F.col("part") == HELD)
    order = model.order
    for k in range(1, order + 1):
        count = _ratios(Model(order, model.tokens, model.distinct, model.documents, [*model.weights]), k)
        schema = "context bigint, bin bigint, n bigint"
        counted = _together(held, totals).applyInPandas(count, schema)
        rows = counted.groupBy("context", "bin").agg(F.sum("n").alias("n")).collect()
        weights = np.zeros(64)
        last = 0.5  # without any held-out token of so frequent a context
        for bucket in range(1, 64):
            own = [(r["bin"], r["n"]) for r in rows if r["context"] == bucket]
            if own:
                last = expectation_maximisation(*(np.array(c) for c in zip(*sorted(own), strict=True)))
            weights[bucket] = last
        model.weights.append(weights)
    return model.weights


def expectation_maximisation(bins: np.ndarray, times: np.ndarray, rounds: int = 200) -> float:
    """Weight of the first of two mixed estimates, from the ratios of their likelihoods."""
    ratio = np.where(bins <= -LARGEST * BINS_A_BIT, 0.0, np.exp2(bins / BINS_A_BIT))
    weight = 0.5
    for _ in range(rounds):
        mine = weight * ratio
        weight = float((times * mine / (mine + 1 - weight)).sum() / times.sum())
        weight = min(max(weight, 1e-6), 1 - 1e-6)
    return weight


def _together(units: DataFrame, totals: DataFrame):
    answers = totals.where("unit is not null").select("unit", "level", "bucket", "counted", "held")
    return units.groupBy("unit").cogroup(answers.groupBy("unit"))


def score(
    df: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    order: int = 2,
    folds: int = 5,
    held_folds: int = 10,
) -> DataFrame:
    """``(id, held_out, n_tokens, n_known, train_tokens, base_score, score)`` for every row.

    Text is lower-cased (A-Z) and cut at ASCII white space; a text ends in one end token, which
    counts. Rows whose ``crc32`` of the id as text leaves remainder 1 by ``folds`` are held out:
    the model learns nothing from them. Of the others one in ``held_folds`` (by the same
    checksum) is left out of the counts while weights are learned, and is counted in the end.
    ``base_score`` is the sum of log10((c + 0.5) / (N + 0.5 (V + 1))) over the tokens, ``score``
    the model's log10 probability of the text.

    Null and empty texts have the end token alone. Null ids count as the empty text in the
    checksum and are kept. Repeated rows are texts of their own. Without a training row all
    tokens are unknown; without a row to learn weights on, they are one half. Other columns
    are not read.
    """
    crc = F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("")))
    part = (
        F.when(crc % folds == 1, SCORED)
        .when(F.floor(crc / folds) % held_folds == 0, HELD)
        .otherwise(COUNTED)
    )
    units = _units(df, id_column, text, part)
    tokens = units.agg(F.sum("n_tokens")).first()[0] or 0
    bits = max(0, int(np.ceil(np.log2(max(1, tokens / BUCKET_TOKENS)))))
    totals = _totals(units, order, bits)
    # one row for each bucket
    sums = (
        totals.where("unit is null and level = 1")
        .agg(*[
            F.sum(F.element_at(c, i)).alias(f"{c}{i}")
            for c in ("tokens", "distinct", "documents") for i in (1, 2)
        ])
        .first()
    )
    first = Model(order, *(sums[f"{c}1"] or 0 for c in ("tokens", "distinct", "documents")))
    weights = _learn_weights(units, totals, first)
    final = Model(order, *(sums[f"{c}2"] or 0 for c in ("tokens", "distinct", "documents")), weights)
    kind = df.schema[id_column].dataType

    def run(own: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        row = own.iloc[0]
        unit = _load(row, order)
        sums = _totals_of(answers, order, True)
        n = len(row["ids"])
        count = unit.counts(sums, 1)
        base = np.log10((count + 0.5) / (final.tokens + 0.5 * (final.distinct + 1)))
        p = np.log10(probabilities(unit, sums, final, order))
        add = lambda x: np.bincount(unit.document, weights=x, minlength=n)
        return pd.DataFrame(
            {
                "id": row["ids"],
                "held_out": row["part"] == SCORED,
                "n_tokens": np.bincount(unit.document, minlength=n),
                "n_known": add(count > 0).astype(np.int64),
                "train_tokens": final.tokens,
                "base_score": add(base),
                "score": add(p),
            }
        )

    schema = (
        "id string, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
        "base_score double, score double"
    )
    scored = _together(units, totals).applyInPandas(run, schema)
    return scored.select(F.col("id").cast(kind).alias(id_column), *scored.columns[1:])
