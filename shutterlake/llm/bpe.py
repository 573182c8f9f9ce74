"""Byte-level BPE by speculation: greedy tokens first, checked in bulk, merged only if wrong.

A word's greedy longest-match tokens are its BPE tokens exactly if every two neighbours are
compatible: had the word been merged in order of rank, no merge across their border would have
come before the merges that made either token. Whether that holds depends on the two tokens
alone, so all borders of all new words are tested together, and the answers are kept.
"""

from __future__ import annotations

import functools
import heapq
import itertools
import json
import operator
from collections.abc import Iterable

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shutterlake.llm.common import annotate

KEPT_WORDS = 1 << 18  # pieces between spaces whose tokens a worker remembers
KEPT_LETTERS = 1 << 24  # letters of those pieces
KEPT_BORDERS = 1 << 21  # pairs of neighbouring tokens whose verdict a worker remembers
# Fixed value: how the tokenizer's byte-level step cuts a text into words.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
NEVER = 1 << 40
GROUP = 2048  # texts whose new pieces are learned together
LONG = 128  # bytes of a word from which it is merged by itself, with a heap
BETWEEN = b"\xff"  # stands between words: no byte of UTF-8, hence in no longer token
MARKS = frozenset(".,;:!?")  # a word of its own if it ends a piece of letters


def byte_alphabet() -> dict[str, int]:
    """The printable characters that stand for bytes in the vocabulary file."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


class Memory(dict):
    """Remembers at most ``KEPT_WORDS`` answers, for keys of ``KEPT_LETTERS`` letters in all.

    When half are new, older ones not used since go.
    """

    def __init__(self) -> None:
        super().__init__()
        self.older: dict = {}
        self.letters = 0

    def lacking(self, needed: set) -> set:
        """What must be learned; the rest of ``needed`` can now be looked up."""
        lost = {key for key in needed if key not in self}
        letters = sum(map(len, lost))
        crowded = 2 * (len(self) + len(lost)) > KEPT_WORDS
        if crowded or 2 * (self.letters + letters) > KEPT_LETTERS:
            self.older = dict(self)
            self.clear()
            lost, self.letters = set(needed), 0
            letters = sum(map(len, lost))
        self.letters += letters
        for key in [k for k in lost if k in self.older]:
            self[key] = self.older[key]
            lost.discard(key)
        return lost


def special_ids(path: str) -> set[int]:
    """The ids of a tokenizer file's special tokens."""
    with open(path, encoding="utf-8") as file:
        return {t["id"] for t in json.load(file).get("added_tokens", [])}


def token_bytes(path: str) -> np.ndarray:
    """The bytes of every token of a tokenizer file."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    byte_of = byte_alphabet()
    special = {t["id"]: t["content"].encode() for t in spec.get("added_tokens", [])}
    plain = {i: t for t, i in spec["model"]["vocab"].items() if i not in special}
    table = np.full(max([*plain, *special]) + 1, b"", object)
    for number, token in plain.items():
        table[number] = bytes(byte_of[c] for c in token)
    for number, content in special.items():
        table[number] = content
    return table


class Tokenizer:
    """Encodes and decodes with the vocabulary and merges of a tokenizer file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        byte_of = byte_alphabet()
        self.id_of = {bytes(byte_of[c] for c in t): i for t, i in model["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.table = token_bytes(path)
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        plain = [[bytes(byte_of[c] for c in part) for part in merge] for merge in merges]
        left = np.array([self.id_of[a] for a, _ in plain], np.int64)
        right = np.array([self.id_of[b] for _, b in plain], np.int64)
        made = np.array([self.id_of[a + b] for a, b in plain], np.int64)
        rank = np.arange(len(plain))
        self.made = made
        # how each token was made: its halves, and the rank of that merge (-1: a single byte)
        self.born = np.full(len(self.table), -1, np.int64)
        self.left_half, self.right_half = self.born.copy(), self.born.copy()
        self.born[made], self.left_half[made], self.right_half[made] = rank, left, right
        order = np.argsort(left << 32 | right)
        self.pair_keys, self.pair_ranks = (left << 32 | right)[order], rank[order]
        self.single = np.array([self.id_of[bytes([b])] for b in range(256)], np.int64)
        self.rank_of = dict(zip(self.pair_keys.tolist(), self.pair_ranks.tolist(), strict=True))
        # only tokens that encode to themselves may be proposed
        self.finder = ahocorasick.Automaton()
        every = list(self.id_of)
        merged = np.bincount(self.merge(every)[1], minlength=len(every))
        for at in np.flatnonzero(merged == 1).tolist():
            self.finder.add_word(every[at].decode("latin-1"), self.id_of[every[at]])
        self.finder.make_automaton()
        self.between = self.id_of[BETWEEN]
        self.words = regex.compile(WORDS)
        names = sorted(self.special, key=len, reverse=True)
        self.cut = regex.compile("|".join(map(regex.escape, names))) if names else None
        self.pieces = Memory()  # tokens of what follows a space; None if that depends on more
        self.border_keys = np.array([], np.int64)
        self.border_good = np.array([], bool)

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Exact merging of many words: in each the lowest rank first, the leftmost of equals.

        All words lie behind each other in one array; every step does one merge in each word
        that has one, and looks up only the two pairs that it changes. Returns the tokens and
        the word of each.
        """
        sizes = np.array([len(w) for w in words], np.int64)
        token = self.single[np.frombuffer(b"".join(words), np.uint8)]
        word = np.repeat(np.arange(len(words)), sizes)
        done_token, done_word = [token[:0]], [word[:0]]
        rank = self.ranks(token[:-1], token[1:])
        rank[word[:-1] != word[1:]] = NEVER
        rank = np.append(rank, NEVER)[: len(token)]
        while len(token):
            start = first_of(word)
            least = np.minimum.reduceat(rank, start)
            count = np.diff(start, append=len(token))
            open_ = np.repeat(least < NEVER, count)
            done_token.append(token[~open_])
            done_word.append(word[~open_])
            token, word, rank = token[open_], word[open_], rank[open_]
            if not len(token):
                break
            lowest = np.flatnonzero(rank == np.repeat(least[least < NEVER], count[least < NEVER]))
            at = lowest[first_of(word[lowest])]
            token[at] = self.made[rank[at]]
            kept = np.ones(len(token), bool)
            kept[at + 1] = False
            at = at - np.arange(len(at))  # one token before each has gone
            token, word, rank = token[kept], word[kept], np.delete(rank, np.flatnonzero(~kept))
            for left in (at - 1, at):
                left = left[(left >= 0) & (left < len(token) - 1)]
                fresh = self.ranks(token[left], token[left + 1])
                rank[left] = np.where(word[left] == word[left + 1], fresh, NEVER)
            rank[-1] = NEVER
        token, word = np.concatenate(done_token), np.concatenate(done_word)
        order = np.argsort(word, kind="stable")
        return token[order], word[order]

    def merge_long(self, word: bytes) -> np.ndarray:
        """``merge`` for one long word: a heap of pairs over linked tokens, O(n log n)."""
        size = len(word)
        token = self.single[np.frombuffer(word, np.uint8)]
        rank = np.append(self.ranks(token[:-1], token[1:]), NEVER)
        heap = (rank * size + np.arange(size))[rank < NEVER].tolist()
        heapq.heapify(heap)
        token, rank = token.tolist(), rank.tolist()
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        rank_of, made = self.rank_of.get, self.made
        while heap:
            lowest, at = divmod(heapq.heappop(heap), size)
            if rank[at] != lowest:  # one of the two has been merged with another since
                continue
            gone = after[at]
            token[at], token[gone], rank[gone] = int(made[lowest]), -1, NEVER
            right = after[at] = after[gone]
            if right < size:
                before[right] = at
            for left, other in ((before[at], at), (at, right)):
                if left < 0 or other >= size:
                    fresh = NEVER
                else:
                    fresh = rank_of(token[left] << 32 | token[other], NEVER)
                if left >= 0:
                    rank[left] = fresh
                if fresh < NEVER:
                    heapq.heappush(heap, fresh * size + left)
        return np.array([t for t in token if t >= 0], np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the merge of each pair, ``NEVER`` for none."""
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], NEVER)

    def propose(self, words: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Greedy longest matches of all words, which ``BETWEEN`` parts, and the word of each."""
        found = self.finder.iter_long(words.decode("latin-1"))
        token = np.fromiter(map(operator.itemgetter(1), found), np.int64)
        own = token != self.between
        return token[own], np.cumsum(~own)[own]

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For each pair of tokens: does no earlier merge cross their border?

        Goes back in time. ``x`` and ``y`` are the parts of ``a`` and ``b`` that touch the
        border, ``x_until`` and ``y_until`` the ranks of the merges that used them up. The two
        would have merged if their own merge comes first; of equal ranks the left one does.
        """
        x, y = a.copy(), b.copy()
        x_until, y_until = np.full(len(a), NEVER), np.full(len(a), NEVER)
        good, open_ = np.ones(len(a), bool), np.arange(len(a))
        while len(open_):
            u, v = x[open_], y[open_]
            rank = self.ranks(u, v)
            bad = (rank < x_until[open_]) & (rank <= y_until[open_]) & (rank < NEVER)
            good[open_[bad]] = False
            open_ = open_[~bad]
            u, v = x[open_], y[open_]
            back_x = self.born[u] > self.born[v]
            back_y = ~back_x & (self.born[v] >= 0)
            i, j = open_[back_x], open_[back_y]
            x_until[i], x[i] = self.born[x[i]], self.right_half[x[i]]
            y_until[j], y[j] = self.born[y[j]], self.left_half[y[j]]
            open_ = open_[back_x | back_y]
        return good

    def good_borders(self, keys: np.ndarray) -> np.ndarray:
        """``compatible`` for packed pairs of tokens; answers are kept."""
        unique, which = np.unique(keys, return_inverse=True)
        if len(self.border_keys) + len(unique) > KEPT_BORDERS:
            self.border_keys, self.border_good = self.border_keys[:0], self.border_good[:0]
        new = np.setdiff1d(unique, self.border_keys, assume_unique=True)
        if len(new):
            at = np.searchsorted(self.border_keys, new)
            good = self.compatible(new >> 32, new & 0xFFFFFFFF)
            self.border_keys = np.insert(self.border_keys, at, new)
            self.border_good = np.insert(self.border_good, at, good)
        return self.border_good[np.searchsorted(self.border_keys, unique)][which]

    def learn(self, words: bytes, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of words, behind each other, and the number of tokens of each word.

        All are proposed, all borders are checked, and the words with a wrong one are merged.
        """
        token, word = self.propose(words)
        inner = np.flatnonzero(word[1:] == word[:-1])
        good = self.good_borders(token[inner] << 32 | token[inner + 1])
        wrong = np.unique(word[inner[~good]])
        if len(wrong):
            each = words.split(BETWEEN)
            lost = [each[i] for i in wrong.tolist()]
            short = np.array([len(w) <= LONG for w in lost])
            merged, owner = self.merge([w for w in lost if len(w) <= LONG])
            right = ~np.isin(word, wrong)
            parts, owners = [token[right], merged], [word[right], wrong[short][owner]]
            for i in wrong[~short].tolist():
                parts.append(self.merge_long(each[i]))
                owners.append(np.full(len(parts[-1]), i))
            token, word = np.concatenate(parts), np.concatenate(owners)
            order = np.argsort(word, kind="stable")
            token, word = token[order], word[order]
        return token, np.bincount(word, minlength=size)

    def tokens(self, texts: list[str]) -> list[bytes]:
        """Tokens, as 32-bit numbers, of texts whose special tokens count as plain text."""
        number: dict[str, int] = {}
        cut = [self.words.findall(t) for t in texts]
        which = [number.setdefault(w, len(number)) for words in cut for w in words]
        if not which:
            return [b""] * len(texts)
        joined = BETWEEN.join([w.encode("utf-8", "surrogatepass") for w in number])
        token, count = self.learn(joined, len(number))
        words = np.array(which)
        flat = token.astype(np.int32)[spans(np.cumsum(count)[words] - count[words], count[words])]
        in_word = np.r_[0, np.cumsum(count[words])]
        return sliced(flat, in_word[np.cumsum(list(map(len, cut)))])

    def plain(self, letters: list[str], marked: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Tokens, behind each other, of pieces with a space before them, and how many each has.

        The first are one word of letters each; the others have a punctuation mark behind it,
        which is a word of its own.
        """
        pieces = letters + [f"{p[:-1]}\n{p[-1]}" for p in marked]
        if not pieces:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        joined = (" " + "\n ".join(pieces)).encode().replace(b"\n", BETWEEN)
        token, count = self.learn(joined, len(letters) + 2 * len(marked))
        pairs = count[len(letters) :].reshape(-1, 2).sum(axis=1)
        return token, np.concatenate([count[: len(letters)], pairs])

    def behind_spaces(self, pieces: Iterable[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Pieces in some order, their tokens behind each other, and how many each has.

        Each piece has a space before it and is taken as if nothing else were there. Pieces of
        letters alone are one word, and two with a punctuation mark behind them; others are cut
        by the pattern.
        """
        rest = set(pieces)
        letters = [p for p in rest if p.isalpha()]
        rest.difference_update(letters)
        marked = [p for p in rest if p and p[-1] in MARKS and p[:-1].isalpha()]
        rest.difference_update(marked)
        others = list(rest)
        found = self.tokens([" " + p for p in others])
        token, count = self.plain(letters, marked)
        token = np.concatenate([token, np.frombuffer(b"".join(found), np.int32)])
        count = np.concatenate([count, np.fromiter(map(len, found), np.int64, len(found)) // 4])
        return letters + marked + others, token, count

    def remember(self, pieces: Iterable[str]) -> None:
        """Finds the tokens of all pieces that follow a single space in the texts.

        A space between two other characters always begins a word, so such a piece has the
        same tokens wherever it stands. Pieces that are empty or begin or end with white
        space depend on their neighbours and are marked with None.
        """
        new = self.pieces.lacking(set(pieces))
        lost = [p for p in new if not p or p != p.strip()]
        self.pieces.update(dict.fromkeys(lost))
        new.difference_update(lost)
        found, token, count = self.behind_spaces(new)
        each = sliced(token.astype(np.int32), np.cumsum(count))
        self.pieces.update(zip(found, each, strict=True))

    def ordinary(self, texts: list[str]) -> list[bytes]:
        """``tokens``, by the memory of pieces."""
        cut = [t.split(" ") for t in texts]
        self.remember(itertools.chain.from_iterable([pieces[1:] for pieces in cut]))
        known = self.pieces.get
        out, lacking, numbers = [], [], []
        for pieces in cut:
            found = list(map(known, pieces))
            first = pieces[0]
            if None in found[1:] or not first or first[-1].isspace():
                found, own = self.chunks(pieces, found, lacking)
            else:
                own = [(0, len(lacking))]
                lacking.append(first)
            out.append(found)
            numbers.append(own)
        learned = self.tokens(lacking)
        for found, own in zip(out, numbers, strict=True):
            for place, number in own:
                found[place] = learned[number]
        return list(map(b"".join, out))

    def chunks(self, pieces: list[str], found: list, lacking: list[str]) -> tuple[list, list]:
        """Joins pieces that depend on their neighbours with what follows, up to a plain piece.

        Each such chunk begins the text or begins with a space behind another character, so it
        has its own tokens; it goes to ``lacking``. Returns the tokens, and for each chunk its
        place among them and its number in ``lacking``.
        """
        out, own, at = [], [], 0
        while at < len(pieces):
            end = at + 1
            if at and found[at] is not None:
                out.append(found[at])
            else:
                open_ = bool(at) or not pieces[0] or pieces[0][-1].isspace()
                while open_ and end < len(pieces):
                    open_ = found[end] is None
                    end += 1
                own.append((len(out), len(lacking)))
                out.append(b"")
                lacking.append((" " if at else "") + " ".join(pieces[at:end]))
            at = end
        return out, own

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Token ids of every text; null counts as empty."""
        plain = [list(self.parts(t or "")) for t in texts]
        ordinary = iter(
            self.ordinary([part for parts in plain for part, special in parts if special is None])
        )
        out = []
        for parts in plain:
            ids = [
                next(ordinary) if special is None else np.int32(special).tobytes()
                for _, special in parts
            ]
            out.append(np.frombuffer(b"".join(ids), np.int32))
        return out

    def parts(self, text: str):
        """The text cut at special tokens: ``(text, None)`` or ``("", id)``."""
        at = 0
        if self.cut is not None:
            for match in self.cut.finditer(text):
                if match.start() > at:
                    yield text[at : match.start()], None
                yield "", self.special[match[0]]
                at = match.end()
        if at < len(text):
            yield text[at:], None

    def decode(self, ids: np.ndarray) -> str:
        """The text of the ids; bytes that are no UTF-8 become replacement characters."""
        return to_text(self.table, ids)


def sliced(flat: np.ndarray, ends: np.ndarray) -> list[bytes]:
    """The bytes of the numbers up to each end."""
    data, ends = flat.tobytes(), (flat.itemsize * ends).tolist()
    return [data[a:b] for a, b in zip([0, *ends], ends, strict=False)]


def first_of(runs: np.ndarray) -> np.ndarray:
    """Where each run of equal numbers begins."""
    return np.flatnonzero(np.diff(runs, prepend=-1))


def spans(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The numbers from each start on, as many as its count, behind each other."""
    before = np.cumsum(count) - count
    return np.arange(count.sum()) + np.repeat(start - before, count)


@functools.cache
def tokenizer(path: str) -> Tokenizer:
    """The tokenizer of a file, loaded once in a worker."""
    return Tokenizer(path)


@functools.cache
def decoder(path: str) -> np.ndarray:
    return token_bytes(path)


def to_text(table: np.ndarray, ids: np.ndarray) -> str:
    """The text of the ids; bytes that are no UTF-8 become replacement characters."""
    return b"".join(table[ids]).decode("utf-8", "replace")


def encode(df: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``df`` with the token ids of a text column as ``ids`` array<int>.

    ``path`` is a byte-level BPE tokenizer file that every executor can read. Special tokens
    that stand in a text become their id; none are added. Null and empty texts have no ids.
    Nothing is truncated or padded. A column named like ``ids`` is replaced.
    """

    def run(texts: pa.Array) -> list:
        return [as_lists(encoded(texts, path))]

    return annotate(df, text, f"`{ids}` array<int>", run)


def decode(df: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``df`` with the text of an id column; null decodes to the empty text."""

    def run(rows: pa.Array) -> list:
        table, empty = decoder(path), np.array([], np.int32)
        found = (rows[i].values for i in range(len(rows)))
        return [[to_text(table, empty if v is None else v.to_numpy()) for v in found]]

    return annotate(df, ids, f"`{text}` string", run)


def round_trip(
    df: DataFrame, path: str, text: str = "text", ids: str = "ids", decoded: str = "decoded"
) -> DataFrame:
    """``encode`` and ``decode`` of the ids in one pass, so that a task needs one worker."""

    def run(texts: pa.Array) -> list:
        found, table = encoded(texts, path), tokenizer(path).table
        return [as_lists(found), [to_text(table, one) for one in found]]

    return annotate(df, text, f"`{ids}` array<int>, `{decoded}` string", run)


def encoded(texts: pa.Array, path: str) -> list[np.ndarray]:
    found, coder, values = [], tokenizer(path), texts.to_pylist()
    for at in range(0, len(values), GROUP):
        found += coder.encode(values[at : at + GROUP])
    return found


def as_lists(found: list[np.ndarray]) -> pa.Array | list:
    offsets = np.cumsum([0, *map(len, found)])
    if offsets[-1] >= 1 << 31:
        return found
    flat = pa.array(np.concatenate([np.array([], np.int32), *found]))
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), flat)


def digests(df: DataFrame, path: str, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, n_tokens, ids_sha256, decoded_sha256)`` of encoding and decoding every row."""
    rows = round_trip(df.select(id_column, text), path, text, "ids", "decoded")
    return rows.select(
        id_column,
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )
