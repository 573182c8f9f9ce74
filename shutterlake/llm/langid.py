"""Language by prediction by partial matching over bytes.

For every language a context tree counts which byte follows which contexts of up to ``order``
bytes. A byte's probability comes from the longest context seen; a byte new to it costs the
escape (as many counts as the context has distinct bytes, method C) and goes on in the next
shorter context, without the bytes already ruled out. The statistics are frozen after learning,
so the code length of each byte in each context is a table, and a text's code length under
every language is an exact sum of looked-up values.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shutterlake.llm.common import (
    annotate,
    checkpointed,
    crc_remainder,
    least_hashed,
    materialized,
)

SLICE = 1 << 19  # byte positions scored at once
UNDETERMINED = "und"
ADDED = ("lang_pred", "lang_score", "lang_bits")
LETTER = regex.compile(r"\p{L}")


@dataclass(frozen=True)
class Model:
    """Frozen context trees of all languages.

    ``symbol`` maps a byte to its column; ``longer[node * n_symbols + s]`` is the context that
    has byte ``s`` in front of the node's, or ``none``; ``bits[node * n_symbols + s]`` has the
    code length of ``s`` for every language.
    """

    languages: tuple[str, ...]
    order: int
    symbol: np.ndarray
    longer: np.ndarray
    bits: np.ndarray

    @property
    def n_symbols(self) -> int:
        return int(self.symbol.max()) + 1 if len(self.symbol) else 1

    def lengths(self, texts: list[bytes]) -> np.ndarray:
        """Code length in bits of every text (rows) under every language (columns)."""
        pad = b"\n" * self.order
        data = np.frombuffer(pad + pad.join(texts) + pad, np.uint8)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        starts = self.order + np.concatenate([[0], np.cumsum(sizes + self.order)[:-1]])
        width, none = self.n_symbols, len(self.longer) // self.n_symbols
        longer = np.append(self.longer, np.full(width, none, self.longer.dtype))
        column = self.symbol[data]
        total = np.zeros((len(texts), len(self.languages)))
        for at in range(0, len(data), SLICE):
            end = min(at + SLICE, len(data))
            first = max(at, self.order)
            node = np.zeros(end - first, np.int64)
            best = node
            for back in range(1, self.order + 1):
                node = longer[node.astype(np.int64) * width + column[first - back : end - back]]
                best = np.where(node == none, best, node)
            bits = self.bits[best * width + column[first:end]]
            # texts that have bytes in this slice
            low = np.searchsorted(starts + sizes, first, side="right")
            high = np.searchsorted(starts, end, side="left")
            for i in range(low, high):
                a, b = max(starts[i], first) - first, min(starts[i] + sizes[i], end) - first
                if b > a:
                    total[i] += bits[a:b].sum(axis=0, dtype=np.float64)
        return total


def learn(
    df: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    order: int = 4,
    docs_per_language: int = 300,
    contexts: int = 12000,
) -> Model:
    """Learns from the rows whose language and text are not null.

    The sample is bounded: of every language ``docs_per_language`` documents, those whose id
    and text have the smallest hash together, so null and repeated ids spread; rows alike in
    both count as one. The tree keeps the
    ``contexts`` most frequent contexts of all languages together. Both bounds are parameters
    of the classifier; counting is done by tasks, and only the kept counts reach the driver.
    """
    known = df.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(lang).alias("lang"),
        F.xxhash64(F.col(id_column).cast("string"), F.col(text)).alias("key"),
        F.col(text).alias("text"),
    )
    keys = checkpointed(known.select("lang", "key").distinct())
    least = least_hashed(keys, "lang", "key", docs_per_language)
    edge = materialized(least.groupBy("lang").agg(F.max("key").alias("edge")), "language-edges")
    near = known.join(edge, "lang").where("key <= edge")
    sample = near.groupBy("lang", "key").agg(F.min("text").alias("text")).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column(0).to_pylist()
            texts = [t.encode("utf-8", "surrogatepass") for t in batch.column(1).to_pylist()]
            for name in sorted(set(names)):
                own = [t for t, n in zip(texts, names, strict=True) if n == name]
                for k in range(order + 1):
                    grams = [_grams(t, k, order) for t in own]
                    found, times = np.unique(np.concatenate(grams), return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([name] * len(found), pa.string()),
                            pa.array(np.full(len(found), k, np.int32)),
                            pa.array(found),
                            pa.array(times),
                        ],
                        names=["lang", "k", "gram", "n"],
                    )

    counts = (
        sample.mapInArrow(count, "lang string, k int, gram bigint, n bigint")
        .groupBy("lang", "k", "gram")
        .agg(F.sum("n").alias("n"))
        .withColumn("context", F.expr("shiftright(gram, 8)"))
    )
    counts = checkpointed(counts)
    # a context is never more frequent than its suffix, so the most frequent form a tree
    frequent = (
        counts.groupBy("k", "context")
        .agg(F.sum("n").alias("_total"))
        .orderBy(F.desc("_total"), "k", "context")
        .limit(contexts)
    )
    kept = counts.join(frequent, ["k", "context"]).select("lang", "k", "gram", "n").toArrow()
    return _tables(kept, order)


def _grams(text: bytes, k: int, order: int) -> np.ndarray:
    """The byte at every place behind its ``k`` bytes before, as one number."""
    data = np.frombuffer(b"\n" * order + text, np.uint8).astype(np.int64)
    gram = np.zeros(len(text), np.int64)
    for back in range(k, -1, -1):
        gram = (gram << 8) | data[order - back : len(data) - back]
    return gram


def _tables(counts: pa.Table, order: int) -> Model:
    lang = np.array(counts["lang"].to_pylist(), object)
    depth = counts["k"].to_numpy().astype(np.int64)
    gram, n = counts["gram"].to_numpy(), counts["n"].to_numpy()
    languages = tuple(sorted(set(lang.tolist())))
    last = gram & 255
    seen = np.unique(np.append(last, ord("\n")))  # contexts begin with line ends
    symbol = np.full(256, len(seen), np.uint16)  # the last column: bytes never seen
    symbol[seen] = np.arange(len(seen))
    width = len(seen) + 1
    # nodes by depth, then context; the root is node 0
    context = gram >> 8
    label = np.unique(np.append(depth << 40 | context, 0))
    node_of = {int(v): i for i, v in enumerate(label)}
    node_depth, node_context = label >> 40, label & ((1 << 40) - 1)
    parent = np.zeros(len(label), np.int64)
    longer = np.full(len(label) * width, len(label), np.int32)
    for i in range(1, len(label)):
        k, c = int(node_depth[i]), int(node_context[i])
        shorter = c & ((1 << (8 * (k - 1))) - 1)
        parent[i] = node_of[(k - 1) << 40 | shorter]
        longer[parent[i] * width + symbol[c >> (8 * (k - 1))]] = i
    at = np.searchsorted(label, depth << 40 | context)
    bits = np.zeros((len(label) * width, len(languages)), np.float32)
    for number, name in enumerate(languages):
        own = lang == name
        table = np.zeros((len(label), width))
        table[at[own], symbol[last[own]]] = n[own]
        code = -np.log2(_probabilities(table, parent, node_depth, order))
        bits[:, number] = code.ravel()
    return Model(languages, order, symbol, longer, bits)


def _probabilities(table, parent, depth, order) -> np.ndarray:
    """Probability of every symbol in every context; a column stands for each of its bytes."""
    has = table > 0
    total, distinct = table.sum(axis=1), has.sum(axis=1)
    result = np.empty_like(table)
    after = np.empty_like(table)  # behind the escape of a context: what is new to it
    root_left = 256 - distinct[0]
    after[0] = 1 / root_left
    for k in range(order + 1):
        rows = np.flatnonzero(depth == k)
        if k:
            up = parent[rows]
            known = has[rows]  # ruled out in the shorter context
            left = np.where(known, 0, table[up])
            new = distinct[up] - distinct[rows]
            whole = left.sum(axis=1) + new
            share = np.where(whole > 0, whole, 1)[:, None]
            found = has[up] & ~known
            escape = np.where(new > 0, new / share[:, 0], 1)[:, None]
            after[rows] = np.where(found, left / share, escape * after[up])
        count = np.where(total[rows] > 0, total[rows] + distinct[rows], 1)[:, None]
        own = np.where(
            has[rows], table[rows] / count, distinct[rows][:, None] / count * after[rows]
        )
        if k:  # a context this language has not seen: the shorter one decides
            own = np.where(total[rows][:, None] > 0, own, result[parent[rows]])
        else:
            own = np.where(total[rows][:, None] > 0, own, 1 / 256)
        result[rows] = own
    return result


def predict(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``df`` with ``lang_pred``, ``lang_score`` and ``lang_bits`` (bits a byte, null for und).

    The language with the shortest code wins, ties by name; the score is its share of the
    probability. A text that is null or has no letter, and any text if nothing was learned,
    is ``und`` with score 0. Columns of these names are replaced.
    """

    def run(values: pa.Array) -> list:
        texts = values.to_pylist()
        clear = [bool(t) and LETTER.search(t) is not None for t in texts]
        names, scores, rates = [], [], []
        plain = [t.encode("utf-8", "surrogatepass") for t, ok in zip(texts, clear, strict=True) if ok]
        if not model.languages or not plain:
            lengths = iter(())
            clear = [False] * len(texts)
        else:
            lengths = iter(zip(model.lengths(plain), map(len, plain), strict=True))
        for ok in clear:
            if not ok:
                names.append(UNDETERMINED)
                scores.append(0.0)
                rates.append(None)
                continue
            bits, size = next(lengths)
            best = int(bits.argmin())
            names.append(model.languages[best])
            scores.append(float(1 / np.exp2(-np.minimum(bits - bits[best], 1000)).sum()))
            rates.append(float(bits[best] / size))
        return [names, scores, rates]

    return annotate(df, text, "lang_pred string, lang_score double, lang_bits double", run)


def lettered(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with ``has_letter``: whether ``predict`` would give the text a language."""

    def run(values: pa.Array) -> list:
        return [[bool(t) and LETTER.search(t) is not None for t in values.to_pylist()]]

    return annotate(df, text, "has_letter boolean", run)


def training_rows(df: DataFrame, id_column: str = "doc_id", modulus: int = 3) -> DataFrame:
    """The rows to learn from: all but the held-out fold, remainder 1."""
    return df.where(crc_remainder(id_column, modulus) != 1)
