"""Alignment of two tokenizers by pointer jumping, and how widely each pair of tokens is linked.

Both tokenizers cut the same bytes. Tokens that overlap, directly or through others, form a
group: the bytes between two places where tokens of both end. Every token points to the token
that overlaps it and ends farthest to the right; where two end together the second tokenizer's
is the last and points to itself. Successors are then doubled for all tokens of many texts at
once, ``next = next[next]``, until nothing changes: every token has found its group's last one.

Both tokenizers begin a token at a space behind another character, so what stands between
spaces is aligned once and remembered.

The links of a group are all its pairs of a token of the one and a token of the other tokenizer.
How many texts hold a pair is counted over the corpus without a row for each link: texts are
packed into units, a unit sends each of its distinct pairs once, and gets the totals back.
"""

from __future__ import annotations

import functools
import itertools
import operator
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from shutterlake.llm.bpe import WORDS, first_of, spans, special_ids, token_bytes
from shutterlake.llm.common import annotate, arrow_types, materialized, pieces
from shutterlake.llm.lm import pack, unpack

BLANKS = re.compile(r"\s\s")
SLICE_BYTES = 1 << 20  # text aligned at once
KEPT_PARTS = 1 << 18  # parts of texts whose alignment a worker remembers
KEPT_LETTERS = 1 << 24  # letters of those parts
UNIT_PAIRS = 1 << 19  # distinct pairs of documents, summed, of a unit
WIDE = 1 << 10  # links of a group from which repeated tokens are counted before pairing
DENSE = 1 << 23  # texts times distinct pairs up to which a table of all is counted
PAIRS = "pair_ids"
TIMES = "pair_times"
COUNTS = "n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string"
ADDED = ("n_a", "n_b", "n_groups", "n_links", "groups", PAIRS, TIMES)


@dataclass
class Vocabulary:
    """Bytes and sizes of the tokens of both tokenizers, their ids as written in groups, and the
    alignments that a worker remembers."""

    a_path: str
    b_path: str

    def __post_init__(self) -> None:
        self.a_bytes = token_bytes(self.a_path)
        special = special_ids(self.a_path)
        plain = {t: i for i, t in enumerate(self.a_bytes) if i not in special}
        self.coder = tiktoken.Encoding(
            "first", pat_str=WORDS, mergeable_ranks=plain, special_tokens={}
        )
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=self.b_path)
        pieces = range(self.pieces.get_piece_size())
        self.b_bytes = np.array([piece_bytes(self.pieces, i) for i in pieces], object)
        self.a_size = np.array([len(t) for t in self.a_bytes], np.int64)
        self.b_size = np.array([len(t) for t in self.b_bytes], np.int64)
        a, b = (list(map(str, range(len(t)))) for t in (self.a_bytes, self.b_bytes))
        # a token inside its group, the last of the first tokenizer's, the last of the group
        written = [x + end for ids, end in ((a, ","), (a, "|"), (b, ","), (b, ";")) for x in ids]
        self.written = np.array(written, object)

        names = (self.pieces.id_to_piece(i) for i in pieces)
        if any("▁" in name.lstrip("▁") for name in names):
            raise ValueError("the second tokenizer has a token with a space behind other characters")
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}  # of every known part of a text
        self.letters = 0
        self.names: list[str] = []  # their groups as written
        self.lost: set[int] = set()  # those whose bytes a tokenizer changes
        self.counts = np.zeros((4, 0), np.int64)
        self.sizes = np.zeros(0, np.int64)  # distinct pairs of each
        self.pairs, self.times = np.zeros(0, np.int64), np.zeros(0, np.int64)  # pairs by number
        self.pair_of = np.zeros(0, np.int64)
        self.order = np.zeros(0, np.int64)  # numbers of pairs, by pair

    def encode(self, texts: list[str]) -> Encoded:
        """Tokens of both for texts with a space before them; none where bytes were changed.

        All are encoded as one text with spaces between, which both begin a token at. If that
        changes any byte they are encoded one by one.
        """
        whole = [b" " + t.encode("utf-8", "surrogatepass") for t in texts]
        size = np.fromiter(map(len, whole), np.int64, len(texts))
        joined, both = " ".join(texts), []
        first = self.coder.encode_ordinary(" " + joined) if texts else []
        second = self.pieces.encode(joined, num_threads=1) if texts else []
        for ids, table, sizes in (
            (first, self.a_bytes, self.a_size), (second, self.b_bytes, self.b_size),
        ):
            ids = np.array(ids, np.int64)
            until = np.searchsorted(np.cumsum(sizes[ids]), np.cumsum(size), "right")
            if b"".join(table[ids].tolist()) != b"".join(whole):
                return self.encode_each(texts, whole)
            both.append((ids, np.diff(until, prepend=0)))
        (a, a_count), (b, b_count) = both
        return Encoded(a, b, a_count, b_count, np.ones(len(texts), bool))

    def encode_each(self, texts: list[str], whole: list[bytes]) -> Encoded:
        first = [self.coder.encode_ordinary(" " + t) for t in texts]
        second = self.pieces.encode(texts, num_threads=1)
        same = np.array([
            b"".join(self.a_bytes[one].tolist()) == b"".join(self.b_bytes[two].tolist()) == own
            for one, two, own in zip(first, second, whole, strict=True)
        ], bool)
        flat = []
        for each in (first, second):
            kept = [ids if good else [] for ids, good in zip(each, same, strict=True)]
            flat.append(np.array([i for ids in kept for i in ids], np.int64))
            flat.append(np.array(list(map(len, kept)), np.int64))
        return Encoded(flat[0], flat[2], flat[1], flat[3], same)

    def learn(self, new: list[str], encoded: Encoded) -> None:
        """Aligns what stands between spaces and remembers it."""
        groups = align_tokens(encoded, self)
        pairs, times, begin = linked_pairs(groups)
        links = np.r_[0, np.cumsum(groups.a_count * groups.b_count)]
        links = np.diff(links[np.r_[0, np.cumsum(groups.texts)]])
        counts = np.stack([encoded.a_count, encoded.b_count, groups.texts, links])
        first = len(self.names)
        self.lost.update((first + np.flatnonzero(~encoded.same)).tolist())
        self.number.update(zip(new, itertools.count(first)))
        self.letters += sum(map(len, new))
        self.names += written(groups, self)
        self.counts = np.concatenate([self.counts, counts], axis=1)
        self.pairs = np.concatenate([self.pairs, self.pair_numbers(pairs)])
        self.times = np.concatenate([self.times, times])
        self.sizes = np.concatenate([self.sizes, np.diff(begin)])

    def pair_numbers(self, pairs: np.ndarray) -> np.ndarray:
        """Numbers of pairs in the order of their arrival."""
        found, which = np.unique(pairs, return_inverse=True)
        known = self.pair_of[self.order]
        new = np.setdiff1d(found, known, assume_unique=True)
        numbers = np.arange(len(known), len(known) + len(new))
        self.order = np.insert(self.order, np.searchsorted(known, new), numbers)
        self.pair_of = np.concatenate([self.pair_of, new])
        return self.order[np.searchsorted(self.pair_of[self.order], found)][which]

    def numbered(self, keys: list[str]) -> list[int]:
        """The numbers of parts of texts; those that are new are aligned first.

        When too many are known, all are forgotten.
        """
        found = list(map(self.number.get, keys))
        if None in found:
            new = {k for k, n in zip(keys, found, strict=True) if n is None}
            if len(self.names) + len(new) > KEPT_PARTS or self.letters > KEPT_LETTERS:
                self.forget()
                new = set(keys)
            regular = [k for k in new if k and k == k.strip()]
            self.learn(regular, self.encode(regular))
            if len(regular) < len(new):
                odd = list(new.difference(regular))
                whole = [b" " + k.encode("utf-8", "surrogatepass") for k in odd]
                self.learn(odd, self.encode_each(odd, whole))
            found = list(map(self.number.__getitem__, keys))
        return found

    def keys(self, text: str) -> list[str]:
        """A text cut at spaces so that each part, with its space, has its own tokens.

        Pieces that are empty or begin or end with white space depend on their neighbours: each
        is joined with what follows, up to a piece that does not; a single space at the end of
        the text, with what is before it.
        """
        pieces = text.split(" ")
        if not (BLANKS.search(text) or text[0].isspace() or text[-1].isspace()):
            return pieces
        out, at = [], 0
        while at < len(pieces):
            end = at + 1
            while end < len(pieces) and (not (p := pieces[end - 1]) or p != p.strip()):
                end += 1
            out.append(" ".join(pieces[at:end]))
            at = end
        if out[-1] == "":  # a last space alone
            out[-2:] = [" ".join(out[-2:])]
        return out

    def align(self, texts: list[str | None]) -> Alignments:
        """The alignment of many texts, from that of their parts."""
        cut = [self.keys(t) if t else [] for t in texts]
        which = self.numbered(list(itertools.chain.from_iterable(cut)))
        ends = list(itertools.accumulate(map(len, cut), initial=0))
        each = [which[a:b] for a, b in itertools.pairwise(ends)]
        if self.lost:
            each = [[] if self.lost.intersection(own) else own for own in each]
        names = self.names
        groups = [";".join([names[i] for i in own]) for own in each]
        until = np.array(list(itertools.accumulate(map(len, each), initial=0)))
        at = np.array([i for own in each for i in own] if self.lost else which, np.int64)
        sums = [np.diff(np.r_[0, np.cumsum(c[at])][until]) for c in self.counts]
        return Alignments(*sums, groups, *self.summed(at, until))

    def summed(self, at: np.ndarray, until: np.ndarray):
        """Distinct pairs of every text with the links of all its parts, and where texts begin."""
        begin = np.cumsum(self.sizes) - self.sizes
        size, own = self.sizes[at], np.unique(at)
        place = spans(begin[at], size)
        numbers = np.unique(self.pairs[spans(begin[own], self.sizes[own])])
        distinct = np.sort(self.pair_of[numbers])
        rank = np.zeros(len(self.pair_of), np.int64)
        rank[numbers] = np.searchsorted(distinct, self.pair_of[numbers])
        wide, texts, time = max(1, len(distinct)), len(until) - 1, self.times[place]
        text = np.repeat(np.repeat(np.arange(texts), np.diff(until)), size)
        cell = text * wide + rank[self.pairs[place]]
        if texts * wide <= DENSE:
            total = np.bincount(cell, weights=time, minlength=texts * wide)
            found = np.flatnonzero(total)
            total = total[found].astype(np.int64)
        else:
            order = np.argsort(cell, kind="stable")
            first = first_of(cell[order])
            found, total = cell[order][first], np.add.reduceat(time[order], first)
        return distinct[found % wide], total, np.searchsorted(found, np.arange(texts + 1) * wide)


class Encoded(NamedTuple):
    """Tokens of texts behind each other, how many each text has, and whether it has any."""

    a: np.ndarray
    b: np.ndarray
    a_count: np.ndarray
    b_count: np.ndarray
    same: np.ndarray


class Alignments(NamedTuple):
    """Columns of aligned texts; a text's pairs are those between its and the next begin."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    groups: list[str]
    pairs: np.ndarray
    times: np.ndarray
    begin: np.ndarray


def piece_bytes(pieces: sentencepiece.SentencePieceProcessor, number: int) -> bytes:
    """The bytes a piece stands for: a byte piece's own, else its text with spaces restored."""
    name = pieces.id_to_piece(number)
    if pieces.is_byte(number):
        return bytes([int(name[1:-1], 16)])
    return name.replace("▁", " ").encode()


@functools.cache
def vocabulary(a_path: str, b_path: str) -> Vocabulary:
    return Vocabulary(a_path, b_path)


def last_tokens(a_end: np.ndarray, b_end: np.ndarray) -> np.ndarray:
    """For every token, first all of ``a``, then all of ``b``: the last token of its group.

    The arguments are the ends of the tokens in the same bytes.
    """
    n = len(a_end)
    after = np.searchsorted(a_end, b_end, "left")  # holds the last byte of the second's token
    own = np.arange(n, n + len(b_end))
    ends = a_end[after] == b_end if n else np.zeros(0, bool)
    pointer = np.concatenate([
        n + np.searchsorted(b_end, a_end, "left"),
        np.where(ends, own, after),
    ])
    while True:
        farther = pointer[pointer]
        if np.array_equal(farther, pointer):
            return pointer
        pointer = farther


@dataclass
class Aligned:
    """Groups of several texts behind each other: all tokens, and how many each group has."""

    a: np.ndarray
    b: np.ndarray
    a_count: np.ndarray  # by group
    b_count: np.ndarray
    texts: np.ndarray  # number of groups by text


def align_tokens(encoded: Encoded, vocab: Vocabulary) -> Aligned:
    a, b, n = encoded.a, encoded.b, len(encoded.a)
    last = last_tokens(np.cumsum(vocab.a_size[a]), np.cumsum(vocab.b_size[b]))
    ends = np.flatnonzero(last[n:] == np.arange(n, n + len(b)))
    group = np.searchsorted(ends, last - n)
    count = [np.bincount(g, minlength=len(ends)) for g in (group[:n], group[n:])]
    until = np.searchsorted(ends, np.cumsum(encoded.b_count))  # a text's last token ends a group
    return Aligned(a, b, *count, np.diff(until, prepend=0))


def written(groups: Aligned, vocab: Vocabulary) -> list[str]:
    """The groups of every text as ``a1,a2|b1;a3|b2,b3``."""
    a_until, b_until = np.cumsum(groups.a_count), np.cumsum(groups.b_count)
    token = np.empty(len(groups.a) + len(groups.b), np.int64)
    a_size, b_size = len(vocab.a_bytes), len(vocab.b_bytes)
    a_text, b_text = groups.a.copy(), groups.b + 2 * a_size
    a_text[a_until - 1] += a_size
    b_text[b_until - 1] += b_size
    before = np.repeat(b_until - groups.b_count, groups.a_count)
    token[np.arange(len(groups.a)) + before] = a_text
    token[np.arange(len(groups.b)) + np.repeat(a_until, groups.b_count)] = b_text
    parts = vocab.written[token].tolist()
    ends = np.r_[0, a_until + b_until][np.cumsum(groups.texts)].tolist()
    return ["".join(parts[x:y])[:-1] for x, y in zip([0, *ends], ends, strict=False)]


def linked_pairs(groups: Aligned) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs of ids of every text and how often each is linked, and where texts begin.

    A pair is a number with the first tokenizer's id in its upper half. Of a wide group each
    distinct pair is made once, with the product of how often its two tokens stand there.
    """
    links = groups.a_count * groups.b_count
    a_from = np.cumsum(groups.a_count) - groups.a_count
    b_from = np.cumsum(groups.b_count) - groups.b_count
    text = np.repeat(np.arange(len(groups.texts)), groups.texts)
    narrow = np.flatnonzero(links <= WIDE)
    n = links[narrow]
    place = spans(np.zeros(len(n), np.int64), n)
    width = np.repeat(groups.b_count[narrow], n)
    a = groups.a[np.repeat(a_from[narrow], n) + place // np.maximum(width, 1)]
    b = groups.b[np.repeat(b_from[narrow], n) + place % np.maximum(width, 1)]
    texts, pairs = [np.repeat(text[narrow], n)], [a << 32 | b]
    times = [np.ones(len(a), np.int64)]
    for g in np.flatnonzero(links > WIDE).tolist():
        one, one_n = np.unique(groups.a[a_from[g] :][: groups.a_count[g]], return_counts=True)
        two, two_n = np.unique(groups.b[b_from[g] :][: groups.b_count[g]], return_counts=True)
        pairs.append((one[:, None] << 32 | two[None, :]).ravel())
        times.append((one_n[:, None] * two_n[None, :]).ravel())
        texts.append(np.full(len(pairs[-1]), text[g]))
    text, pair, time = np.concatenate(texts), np.concatenate(pairs), np.concatenate(times)
    order = np.lexsort((pair, text))
    text, pair, time = text[order], pair[order], time[order]
    first = np.flatnonzero((np.diff(text, prepend=-1) != 0) | (np.diff(pair, prepend=-1) != 0))
    total = np.add.reduceat(time, first) if len(first) else time
    begin = np.searchsorted(text[first], np.arange(len(groups.texts) + 1))
    return pair[first], total, begin


def aligned_slices(texts: list[str | None], a_path: str, b_path: str) -> Iterator[Alignments]:
    vocab, at = vocabulary(a_path, b_path), 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (end == at or size < SLICE_BYTES):
            size += len(texts[end] or "")
            end += 1
        yield vocab.align(texts[at:end])
        at = end


def align(df: DataFrame, a_path: str, b_path: str, text: str = "text") -> DataFrame:
    """``df`` with the groups and links of two tokenizations of a text column.

    ``a_path`` is a byte-level BPE file, which encodes a space and the text; ``b_path`` a
    SentencePiece model, which adds that space itself. Special tokens in texts are plain text.
    Adds ``n_a``, ``n_b``, ``n_groups`` and ``n_links``; ``groups``, the ids group by group as
    ``a1,a2|b1;a3|b2,b3``; and ``pair_ids`` and ``pair_times``, the distinct linked pairs (the
    first tokenizer's id times 2^32 plus the second's) in order with the number of their links.

    Texts that are null, empty, or that a tokenizer changes have no tokens: zeros, an empty
    string and empty lists. Repeated rows are texts of their own. Columns of these names, in
    any case, are replaced. Memory grows with the longest text and with the distinct pairs of
    one group, which are its result.
    """

    def run(values: pa.Array) -> list:
        found: list[list] = [[] for _ in ADDED]
        for own in aligned_slices(values.to_pylist(), a_path, b_path):
            offsets = pa.array(own.begin, pa.int32())
            for column, new in zip(found, own[:5], strict=False):
                column.extend(new)
            found[5].append(pa.ListArray.from_arrays(offsets, pa.array(own.pairs)))
            found[6].append(pa.ListArray.from_arrays(offsets, pa.array(own.times)))
        return [*found[:5], pa.concat_arrays(found[5]), pa.concat_arrays(found[6])]

    return annotate(df, text, f"{COUNTS}, {PAIRS} array<bigint>, {TIMES} array<bigint>", run)


def _units(df: DataFrame, a_path: str, b_path: str, text: str, summary: Callable) -> DataFrame:
    """Rows packed into units, each with its distinct pairs and what its rows have of them."""
    replaced = {text.lower(), "groups", "n_best", "count_sum", *ADDED[:4]}
    kept = [c for c in df.columns if c.lower() not in replaced]
    source = df.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text}`").alias("_text"))
    rows = StructType([*source.schema.fields[:-1], *StructType.fromDDL(COUNTS).fields])
    kinds = pa.struct([pa.field(n, k) for n, k in arrow_types(rows)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        packed, pairs, times, sizes, held = [], [], [], [], 0

        def unit() -> pa.RecordBatch:
            own = pa.concat_arrays(packed)
            distinct, at, documents = np.unique(
                np.concatenate(pairs), return_inverse=True, return_counts=True
            )
            columns = [
                pa.array([part << 32 | number], pa.int64()),
                pa.ListArray.from_arrays(pa.array([0, len(own)], pa.int32()), own),
            ]
            counted = [np.concatenate(sizes), distinct, documents, at, np.concatenate(times)]
            columns += [pa.array([pack(c.astype(np.int64))], pa.binary()) for c in counted]
            for each in (packed, pairs, times, sizes):
                each.clear()
            return pa.RecordBatch.from_arrays(
                columns, names=["unit", "rows", "sizes", "pairs", "documents", "at", "times"]
            )

        for batch in pieces(batches):
            columns, start = batch.columns, 0
            for own in aligned_slices(columns[-1].to_pylist(), a_path, b_path):
                size = len(own.groups)
                made = [c.slice(start, size) for c in columns[:-1]]
                made += [pa.array(c, pa.int64()) for c in own[:4]]
                made.append(pa.array([summary(g) for g in own.groups], pa.string()))
                packed.append(pa.StructArray.from_arrays(made, fields=list(kinds)))
                pairs.append(own.pairs)
                times.append(own.times)
                sizes.append(np.diff(own.begin))
                start, held = start + size, held + len(own.pairs)
                if held >= UNIT_PAIRS:
                    yield unit()
                    number, held = number + 1, 0
        if packed:
            yield unit()

    schema = StructType().add("unit", "long").add("rows", ArrayType(rows))
    for name in ("sizes", "pairs", "documents", "at", "times"):
        schema = schema.add(name, "binary")
    return materialized(source.mapInArrow(run, schema), "aligned-units")


def link_counts(
    df: DataFrame,
    a_path: str,
    b_path: str,
    text: str = "text",
    summary: Callable[[str], str] = str,
) -> DataFrame:
    """``df`` with the text replaced by ``n_a``, ``n_b``, ``n_groups``, ``n_links`` and ``groups``
    as in ``align``, and with ``n_best`` and ``count_sum``.

    A pair's count is the number of rows of the table that hold it linked. ``count_sum`` adds the
    counts of all links of a row; ``n_best`` is how many of its links have the highest count of
    all pairs with their first token, ties included. Rows without links get zeros. ``summary``
    is applied to the written groups, which are larger than the texts, before they are kept.
    Other columns stay; those with the names above, in any case, are replaced.

    What crosses tasks is each distinct pair of a unit once, and its total back. A pair that
    every text holds is one row a unit, which Spark can split where it is joined.
    """
    units = _units(df, a_path, b_path, text, summary)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                pairs, documents = unpack(row["pairs"], np.int64), unpack(row["documents"], np.int64)
                units = np.full(len(pairs), row["unit"])
                columns = [units, np.arange(len(pairs)), pairs, documents]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in columns], names=["unit", "place", "pair", "n"]
                )

    asked = units.select("unit", "pairs", "documents").mapInArrow(
        ask, "unit bigint, place bigint, pair bigint, n bigint"
    )
    totals = materialized(asked.groupBy("pair").agg(F.sum("n").alias("n")), "pair-counts")
    token = F.shiftright("pair", 32)
    best = totals.groupBy(token.alias("token")).agg(F.max("n").alias("most"))
    rated = totals.withColumn("token", token).join(best, "token")
    rated = rated.select("pair", F.col("n").alias("total"), (F.col("n") == F.col("most")).alias("best"))
    answers = asked.join(rated, "pair").select("unit", "place", "total", "best")

    rows = units.schema["rows"].dataType.elementType
    names = [f.name for f in rows.fields]
    schema = StructType(rows.fields).add("n_best", "long").add("count_sum", "long")

    def add(own: pa.Table, found: pa.Table) -> pa.Table:
        row = own.slice(0, 1).combine_chunks()
        sizes, at, times = (
            unpack(row.column(c)[0].as_py(), np.int64) for c in ("sizes", "at", "times")
        )
        total = np.zeros(found.num_rows, np.int64)
        place = found.column("place").to_numpy()
        total[place] = found.column("total").to_numpy()
        most = np.zeros(found.num_rows, np.int64)
        most[place] = found.column("best").to_numpy()
        until = np.cumsum(np.r_[0, sizes])
        sums = [np.diff(np.r_[0, np.cumsum(times * x[at])][until]) for x in (most, total)]
        texts = row.column("rows").chunk(0).flatten()
        return pa.Table.from_arrays(
            [*texts.flatten(), *(pa.array(x, pa.int64()) for x in sums)],
            names=[*names, "n_best", "count_sum"],
        )

    return units.groupBy("unit").cogroup(answers.groupBy("unit")).applyInArrow(add, schema)
