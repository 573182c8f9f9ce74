"""SimHash near-duplicates, compared around the anchors of a covering code.

The 64 bits are cut into three segments. Two fingerprints that differ in at most four bits
differ in at most one bit of some segment. On every segment the words of the binary Golay code
are the anchors: each of the 2**23 words of its space lies within three bits of one of the
4,096 anchors. A fingerprint is replicated to all anchors within the covering radius plus the
segment's threshold, four bits, which are 5.3 on average. Two fingerprints that differ in one
bit of the segment then share the anchor nearest to either, so no link is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shutterlake.llm.common import annotate, checkpointed, materialized
from shutterlake.llm.components import connected_components

SEGMENTS = ((42, 22), (21, 21), (0, 21))  # shift and width of each
GENERATOR = 0b101011100011  # of the cyclic [23, 12] Golay code, covering radius 3
RADIUS = 3
BITS = 4  # largest distance of a link
CROWD = 1 << 15  # fingerprints that meet in one comparison
MATRIX = 2048  # up to here all are compared at once


def fingerprint(text: str | None, words: int = 4) -> int:
    """The SimHash of the word shingles of a text; 0 for none."""
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return 0
    shingles = map(b" ".join, zip(*(tokens[i:] for i in range(words)), strict=False))
    if len(tokens) <= words:
        shingles = [b" ".join(tokens)]
    digests = b"".join([xxhash.xxh64_digest(x, 42) for x in shingles])
    hashes = np.frombuffer(digests, np.uint8).reshape(-1, 8)
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 15):
        bits = np.unpackbits(hashes[at : at + (1 << 15)], axis=1)
        counts += np.add.reduce(bits, axis=0, dtype=np.uint16)
    return int(np.packbits(counts * 2 > len(hashes)).view(">u8")[0])


def fingerprints(df: DataFrame, text: str = "text", words: int = 4) -> DataFrame:
    """``df`` with ``simhash``, the fingerprint's 64 bits as a signed number."""

    def run(texts):
        found = np.array([fingerprint(t, words) for t in texts.to_pylist()], np.uint64)
        return [found.view(np.int64)]

    return annotate(df, text, "simhash bigint", run)


def golay_code() -> np.ndarray:
    """The 4,096 words of the code: all sums of shifted generators."""
    words = np.zeros(1, np.int64)
    for shift in range(12):
        words = np.concatenate([words, words ^ (GENERATOR << shift)])
    return words


class Anchors:
    """Finds the anchors within ``RADIUS + 1`` bits of 23-bit words."""

    def __init__(self) -> None:
        code = golay_code()
        # errors of up to three bits are the coset leaders: each syndrome has one
        single = 1 << np.arange(23)
        leaders = {0}
        for _ in range(RADIUS):
            leaders |= {e ^ int(b) for e in leaders for b in single}
        self.leader = np.zeros(2048, np.int64)
        errors = np.array(sorted(leaders))
        self.leader[self.syndrome(errors)] = errors
        near = np.bitwise_count(errors[:, None] ^ code[None, :]) <= RADIUS + 1
        most = int(near.sum(axis=1).max())
        self.offsets = np.full((2048, most), -1, np.int64)
        for error, row in zip(errors, near, strict=True):
            found = code[row]
            self.offsets[self.syndrome(error), : len(found)] = found

    @staticmethod
    def syndrome(words) -> np.ndarray:
        """Remainder of the words by the generator polynomial."""
        rest = np.array(words, np.int64)
        for shift in range(11, -1, -1):
            rest = np.where((rest >> (shift + 11)) & 1 == 1, rest ^ (GENERATOR << shift), rest)
        return rest

    def of(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the word and anchor, for every anchor near enough."""
        syndrome = self.syndrome(words)
        nearest = words ^ self.leader[syndrome]
        offsets = self.offsets[syndrome]
        row, column = np.nonzero(offsets >= 0)
        return row, nearest[row] ^ offsets[row, column]


def links(prints: DataFrame) -> DataFrame:
    """``(a, b)``: links between different fingerprints ``prints(simhash)``, a spanning set.

    Around every anchor links are kept only until they connect what is connected there, so a
    crowd of near copies returns fewer rows than it has fingerprints. An anchor with more than
    ``CROWD`` fingerprints is split by the exact bits of a block of the rest of the
    fingerprint: of five blocks one has no difference. What is still too large is dealt in
    chunks of which every two meet. No link is dropped.
    """

    def replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = Anchors()
        for batch in batches:
            signed = batch.column(0).to_numpy(zero_copy_only=False)
            value = signed.view(np.uint64)
            for number, (shift, width) in enumerate(SEGMENTS):
                part = (value >> np.uint64(shift)) & np.uint64((1 << width) - 1)
                row, anchor = anchors.of(part.astype(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array((number << 23) | anchor), pa.array(signed[row])],
                    names=["anchor", "simhash"],
                )

    at = prints.select("simhash").mapInArrow(replicate, "anchor bigint, simhash bigint")
    # at most three times 4,096 anchors, whatever the number of fingerprints
    load = at.groupBy("anchor").count().where(F.col("count") > CROWD).collect()
    crowded = [row["anchor"] for row in load]
    is_crowded = F.col("anchor").isin(crowded) if crowded else F.lit(False)
    calm = at.where(~is_crowded).select(
        F.struct(F.col("anchor"), F.lit(0).alias("block"), F.lit(0).cast("bigint").alias("value"))
        .alias("key"),
        "simhash", F.lit(0).cast("bigint").alias("low"), F.lit(0).cast("bigint").alias("high"),
        F.lit(0).cast("bigint").alias("chunk"),
    )
    if not crowded:
        return _compare(calm)
    blocks = F.explode(F.expr("sequence(0, 4)"))
    # the 64 bits in five blocks, of which a pair within four bits shares one wholly
    value = F.expr("shiftrightunsigned(simhash, block * 13) & 8191")
    split = (
        at.where(is_crowded).select("anchor", "simhash", blocks.alias("block"))
        .withColumn("value", value)
        .select(F.struct("anchor", "block", "value").alias("key"), "simhash")
    )
    crowds = split.groupBy("key").agg(F.ceil(F.count("*") / CROWD).alias("chunks"))
    dealt = (
        split.join(crowds, "key")
        .withColumn("chunk", F.pmod(F.xxhash64("simhash"), "chunks"))
        .withColumn("other", F.explode(F.expr("sequence(0L, chunks - 1)")))
        .select("key", "simhash", F.least("chunk", "other").alias("low"),
                F.greatest("chunk", "other").alias("high"), "chunk")
    )
    return _compare(calm.unionByName(dealt))


def _compare(dealt: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest, rest_values = None, None
        # rows arrive sorted by key; the last key of a batch may go on in the next
        for batch in batches:
            keys = batch.column(0).to_numpy(zero_copy_only=False)
            prints = batch.column(1).to_numpy(zero_copy_only=False)
            if rest is not None:
                keys, prints = np.concatenate([rest, keys]), np.concatenate([rest_values, prints])
            edges = np.flatnonzero(keys[1:] != keys[:-1]) + 1
            last = edges[-1] if len(edges) else 0
            rest, rest_values = keys[last:], prints[last:]
            yield from found(prints[:last], edges[:-1])
        if rest is not None:
            yield from found(rest_values, np.array([], np.int64))

    def found(prints: np.ndarray, edges: np.ndarray) -> Iterator[pa.RecordBatch]:
        a, b = [], []
        for group in np.split(prints, edges):
            if len(group) > 1:
                left, right = spanning(group)
                a.append(left)
                b.append(right)
        if a:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], names=["a", "b"]
            )

    spread = dealt.select(F.xxhash64("key", "low", "high").alias("group"), "simhash")
    spread = spread.repartition("group").sortWithinPartitions("group")
    pairs = spread.mapInArrow(run, "a bigint, b bigint")
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def spanning(group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect whatever links of ``BITS`` bits connect in a group."""
    group = np.unique(group)
    value = group.view(np.uint64)
    if len(value) <= MATRIX:
        close = np.bitwise_count(value[:, None] ^ value[None, :]) <= BITS
        a, b = np.nonzero(np.triu(close, 1))
        if len(a) <= len(value):
            return group[a], group[b]
    # each is compared with those not reached yet, along the links found
    a, b = [], []
    left = np.arange(len(value))
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            one = queue.pop()
            near = np.bitwise_count(value[left] ^ value[one]) <= BITS
            reached, left = left[near], left[~near]
            queue.extend(reached.tolist())
            a.extend([one] * len(reached))
            b.extend(reached.tolist())
    return group[np.array(a, np.int64)], group[np.array(b, np.int64)]


def groups(df: DataFrame, id_column: str, text: str, words: int = 4) -> DataFrame:
    """``(id, text_key, simhash, root, component_id)`` for every row of ``df``.

    Words are lower-cased (A-Z) and cut at ASCII white space; shingles of ``words`` words are
    hashed with XXH64 (seed 42), and a fingerprint bit is 1 if set in over half the hashes.
    A text of fewer words is one shingle; null and empty texts and texts of white space have
    fingerprint zero, which links like any other. Fingerprints within ``BITS`` bits link.
    ``component_id`` is the smallest id reachable, ``root`` names the component and
    ``text_key`` is a hash of the text. Equal fingerprints are one node, so copies are never
    paired. Rows without an id take part and get their group's smallest id (null if no row of
    the group has one). Repeated rows are copies. Other columns are not read.
    """
    source = df.select(
        F.col(id_column).alias("id"),
        F.xxhash64(F.col(text)).alias("text_key"),
        F.col(text).alias("text"),
    )
    rows = fingerprints(source, "text", words).select("id", "text_key", "simhash")
    rows = materialized(rows, "simhash-rows")
    prints = checkpointed(rows.groupBy("simhash").agg(F.min("id").alias("least_id")))
    roots = connected_components(checkpointed(links(prints)))
    node = prints.join(roots, prints["simhash"] == roots["node"], "left").select(
        "simhash", F.coalesce("root", "simhash").alias("root"), "least_id"
    )
    least = node.groupBy("root").agg(F.min("least_id").alias("component_id"))
    named = node.join(least, "root").select("simhash", "root", "component_id")
    return rows.join(named, "simhash").select("id", "text_key", "simhash", "root", "component_id")


def representatives(found: DataFrame) -> DataFrame:
    """``(id, text_key)`` of one row of each component of ``groups``: the smallest id, if any."""
    first = F.min(F.struct(F.col("id").isNull().alias("unnamed"), "id", "text_key"))
    return found.groupBy("root").agg(first.alias("first")).select("first.id", "first.text_key")
