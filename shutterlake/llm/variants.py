"""Spelling variants: words one edit apart, found by a frontier in a trie that is a table.

A trie's edges are rows ``(node, letter, child)``; a node is the hash of its prefix. A state is
a word, how many of its letters are used up, a node and the number of edits. Level by level the
states are joined with the edges of their nodes: a letter that fits leads on, another one is
inserted or replaces the word's. A state that has used up its word after one edit, at a node
where a word ends, has found a neighbour. Each edge also has a summary of what follows its
child, so that most states that would not come to an end are never made.

Edits at the beginning of words would spread over the whole top of the trie. Two words one edit
apart have either the first half of the shorter one in common or the rest, so a word enters the
trie at its middle, and once more reversed. Of two neighbours the shorter one, or the one with
the smaller letter, finds the other at the first letter that differs: each pair is found once.
"""

from __future__ import annotations

import os
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shutterlake.llm.common import materialized, pieces, shared_path

LETTERS = "A-Za-zÀ-ÿ"
HELD_WORDS = 1 << 17  # distinct words a task counts before it passes them on
LEAST_LETTERS = 7
DEPTH = 40  # letters of the longest word in the trie
SLIP = 31  # one run of a text in so many loses a letter
BASE = 0x9E3779B97F4A7C15  # of polynomial hashes modulo 2^64


def add_words(total: dict[bytes, int], runs: re.Pattern, name: str, text: str) -> None:
    """Adds the words of a text, in UTF-8, letters deleted where a checksum says so."""
    before = zlib.crc32(f"{name}:".encode())
    for run, n in Counter(runs.findall(text)).items():
        word = run.encode().lower()  # of bytes, only A to Z have a lower case
        h = zlib.crc32(word, before)
        if h % SLIP == 0:
            letters = word.decode()
            at = h % len(letters)
            word = (letters[:at] + letters[at + 1 :]).encode()
        total[word] = total.get(word, 0) + n


def count_words(df: DataFrame, id_column: str, text: str, least_letters: int) -> DataFrame:
    """``(word, n)`` of all words of at least ``least_letters`` code points."""
    # runs never grow, so shorter ones are not looked at
    runs = re.compile(f"[{LETTERS}]{{{least_letters},}}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[bytes, int] = {}

        def rows() -> pa.RecordBatch:
            words = [w for w in total if len(w) - w.count(b"\xc3") >= least_letters]
            counts = [total[w] for w in words]
            total.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(words, pa.binary()).cast(pa.string()), pa.array(counts, pa.int64())],
                names=["word", "n"],
            )

        for batch in pieces(batches):
            names, texts = (batch.column(i).to_pylist() for i in (0, 1))
            for name, one in zip(names, texts, strict=True):
                add_words(total, runs, name or "", one or "")
                if len(total) >= HELD_WORDS:
                    yield rows()
        yield rows()

    source = df.select(F.col(id_column).cast("string").alias("id"), F.col(text).alias("text"))
    counted = source.mapInArrow(run, "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def node_of(back: Column, prefix: Column) -> Column:
    return F.xxhash64(back, prefix)


def rest_bits(rest: Column) -> tuple[Column, Column]:
    """The rest of a word as one bit of each of two numbers."""
    h = F.xxhash64(rest)
    one = F.lit(1).cast("bigint")
    places = (h.bitwiseAND(63), F.shiftright(h, 6).bitwiseAND(63))
    return tuple(F.call_function("shiftleft", one, p.cast("int")) for p in places)


def oriented(words: DataFrame) -> DataFrame:
    """Every word forwards and reversed, with the depth at which it enters the trie."""
    size = F.length("word")
    half = F.floor(size / 2).cast("int")
    forth = words.select(F.lit(False).alias("back"), F.col("word").alias("key"), half.alias("enter"))
    back = words.select(
        F.lit(True).alias("back"), F.reverse("word").alias("key"), (size - half).alias("enter")
    )
    return forth.unionByName(back)


def edges(keys: DataFrame, least: int) -> DataFrame:
    """``(depth, node, letter, child, one, two)``: edges below the depth at which words enter.

    ``one`` and ``two`` have the bits of the rests of all words behind the child.
    """
    depths = keys.withColumn("depth", F.explode(F.sequence(F.lit(least), F.length("key") - 1)))
    one, two = rest_bits(F.expr("substring(key, depth + 2)"))
    return (
        depths.select(
            "depth",
            node_of(F.col("back"), F.expr("left(key, depth)")).alias("node"),
            F.expr("substring(key, depth + 1, 1)").alias("letter"),
            node_of(F.col("back"), F.expr("left(key, depth + 1)")).alias("child"),
            one.alias("one"),
            two.alias("two"),
        )
        .groupBy("depth", "node", "letter", "child")
        .agg(F.bit_or("one").alias("one"), F.bit_or("two").alias("two"))
    )


def step(states: DataFrame, level: DataFrame) -> DataFrame:
    """The states one level deeper; ``done`` marks those that have found a neighbour.

    States are ``(key, back, used, node, edits, done)``; those without an edit still fit.
    """
    use_one, use_two = rest_bits(F.expr("substring(key, used + 2)"))
    keep_one, keep_two = rest_bits(F.expr("substring(key, used + 1)"))
    asked = states.select(
        "key", "back", "used", "node", "edits", F.length("key").alias("size"),
        F.expr("substring(key, used + 1, 1)").alias("wanted"),  # empty behind the last letter
        use_one.alias("use_one"), use_two.alias("use_two"),
        keep_one.alias("keep_one"), keep_two.alias("keep_two"),
    )

    def follows(name: str) -> Column:
        """Whether a word behind the child may have just this rest."""
        pairs = (("one", f"{name}_one"), ("two", f"{name}_two"))
        one, two = (F.col(a).bitwiseAND(F.col(b)) != 0 for a, b in pairs)
        return one & two

    letter, wanted, size = F.col("letter"), F.col("wanted"), F.col("size")
    fits, clean = letter == wanted, F.col("edits") == 0
    goes_on = fits & (clean | follows("use"))
    replaces = clean & ~fits & (wanted != "") & (letter > wanted) & follows("use")
    inserts = clean & ~fits & follows("keep")
    joined = asked.join(level, "node").where(goes_on | replaces | inserts)

    def state(used: Column, edits: Column) -> Column:
        done = (edits == 1) & (used == size)
        return F.struct(used.alias("used"), edits.alias("edits"), done.alias("done"))

    used, one = F.col("used"), F.lit(1)
    ways = (
        F.when(goes_on, F.array(state(used + 1, F.col("edits"))))
        .when(replaces & inserts, F.array(state(used + 1, one), state(used, one)))
        .when(replaces, F.array(state(used + 1, one)))
        .otherwise(F.array(state(used, one)))
    )
    return joined.withColumn("way", F.explode(ways)).select(
        "key", "back", "way.used", F.col("child").alias("node"), "way.edits", "way.done"
    )


def short_pairs(words: DataFrame) -> DataFrame:
    """``(word, other)``, each unordered pair once, of words up to ``DEPTH`` one edit apart."""
    spark = words.sparkSession
    keys = materialized(oriented(words.where(F.length("word") <= DEPTH)), "variant-keys")
    bounds = keys.agg(F.min("enter"), F.max(F.length("key"))).first()
    if bounds[0] is None:
        return words.select("word", F.col("word").alias("other")).limit(0)
    path = shared_path(spark, "variant-edges")
    edges(keys, bounds[0]).write.partitionBy("depth").parquet(path)
    trie = spark.read.parquet(path)
    carried, found = None, None
    for depth in range(bounds[0], bounds[1] + 1):
        begin = keys.where(F.col("enter") == depth).select(
            "key", "back", F.col("enter").alias("used"),
            node_of(F.col("back"), F.expr("left(key, enter)")).alias("node"),
            F.lit(0).alias("edits"), F.lit(False).alias("done"),
        )
        states = begin if carried is None else begin.unionByName(carried)
        level = trie.where(F.col("depth") == depth).drop("depth")
        reached = materialized(step(states, level), "variant-states")
        carried = reached.where(~F.col("done"))
        ends = reached.where("done").select("key", "back", "node")
        found = ends if found is None else found.unionByName(ends)
    return _named(found, keys)


def _named(found: DataFrame, keys: DataFrame) -> DataFrame:
    """Pairs of words for states that are done: the node is the neighbour's hash."""
    ends = keys.select(node_of(F.col("back"), F.col("key")).alias("node"), F.col("key").alias("end"))
    pairs = found.join(ends, "node").select(
        F.when(F.col("back"), F.reverse("key")).otherwise(F.col("key")).alias("word"),
        F.when(F.col("back"), F.reverse("end")).otherwise(F.col("end")).alias("other"),
        "back",
    )
    half = F.expr("floor(length(word) / 2)").cast("int")
    both = F.call_function("left", F.col("word"), half) == F.call_function("left", F.col("other"), half)
    # the summaries promise too much at times, and prefixes could share a hash
    exact = F.levenshtein("word", "other", 1) == 1
    return pairs.where(exact & ~(F.col("back") & both)).select("word", "other")


def deletions(word: str) -> tuple[int, np.ndarray]:
    """Polynomial hashes of a word and of what is left without each of its letters."""
    letters = np.frombuffer(word.encode("utf-32-le"), np.uint32).astype(np.uint64)
    n = len(letters)
    with np.errstate(over="ignore"):
        power = np.cumprod(np.r_[1, np.full(n, BASE, np.uint64)].astype(np.uint64))
        inverse = np.cumprod(np.full(n, pow(BASE, -1, 1 << 64), np.uint64))
        before = power * np.r_[np.uint64(0), np.cumsum(letters * inverse)]
        without = before[n] + (before[:-1] - before[1:]) * power[n - 1 :: -1]
    return int(before[n].astype(np.int64)), without.astype(np.int64)


def long_pairs(words: DataFrame) -> DataFrame:
    """``short_pairs`` where at least one word is longer than ``DEPTH``.

    A trie would need a join for each letter of the longest word. Here a word sends the hash of
    what is left without each letter, computed in one pass over the word; neighbours have one in
    common, at the same place, or one has the other's own hash. At most as many words as there
    are letters have the same one at the same place. All pairs are compared in full.
    """
    long = words.where(F.length("word") >= DEPTH).select("word", F.xxhash64("word").alias("id"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for word, number in zip(*(batch.column(i).to_pylist() for i in (0, 1)), strict=True):
                own, without = deletions(word)
                hashes = np.r_[own, without]
                places = np.arange(-1, len(without))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(hashes), number)), pa.array(places), pa.array(hashes)],
                    names=["id", "place", "hash"],
                )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (batch.column(i).to_pylist() for i in (0, 1))
            yield batch.filter(pa.array(list(map(one_edit_apart, a, b)), pa.bool_()))

    hashes = materialized(
        long.mapInArrow(run, "id bigint, place bigint, hash bigint"), "variant-hashes"
    )
    without = hashes.where("place >= 0")
    replaced = without.join(without.withColumnRenamed("id", "id2"), ["hash", "place"])
    whole = hashes.where("place < 0").select("hash", "id")
    inserted = whole.join(without.select("hash", F.col("id").alias("id2")), "hash")
    pairs = replaced.where("id < id2").select("id", "id2").unionByName(inserted.select("id", "id2"))
    named = (
        pairs.distinct()
        .join(long, "id")
        .join(long.select(F.col("word").alias("other"), F.col("id").alias("id2")), "id2")
        .where(F.greatest(F.length("word"), F.length("other")) > DEPTH)
        .select("word", "other")
    )
    return named.mapInArrow(compare, "word string, other string")


def one_edit_apart(a: str, b: str) -> bool:
    """Whether one inserted, deleted or replaced letter makes one word the other."""
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    same = len(os.path.commonprefix([a, b]))
    return a[same + (len(a) == len(b)) :] == b[same + 1 :]


def roots(forms: DataFrame) -> DataFrame:
    """``(word, root)``: the last word that forms lead to from each word that has one.

    Every word points to its form; pointers are doubled until none leads on. Forms are ten times
    as frequent, so chains are short and have no circles.
    """
    links = materialized(forms.select("word", F.col("form").alias("root")), "variant-roots")
    while True:
        on = links.select(F.col("word").alias("root"), F.col("root").alias("farther"))
        joined = links.join(on, "root", "left")
        if joined.where(F.col("farther").isNotNull()).isEmpty():
            return links
        links = materialized(
            joined.select("word", F.coalesce("farther", "root").alias("root")), "variant-roots"
        )


def variants(words: DataFrame, factor: int = 10) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` for a table of distinct words ``(word, n)``.

    Two words are near if one inserted, deleted or replaced code point makes one the other.
    ``n_near`` counts a word's near words. ``form`` is the most frequent of them, of equals the
    smallest in code-point order, and ``form_n`` its number, if that is at least ``factor``
    times the word's; else both are null. ``root`` is where forms lead to in the end, the word
    itself if it has none. Letters are a to z and the Latin-1 letters from U+00C0 on; words are
    as long as they like, but have at least six letters.
    """
    pairs = short_pairs(words).unionByName(long_pairs(words))
    near = pairs.unionByName(pairs.select(F.col("other").alias("word"), F.col("word").alias("other")))
    numbers = words.select(F.col("word").alias("other"), F.col("n").alias("other_n"))
    best = (
        near.join(numbers, "other")
        .groupBy("word")
        .agg(F.count("*").alias("n_near"), F.min(F.struct(-F.col("other_n"), "other")).alias("best"))
        .select("word", "n_near", F.col("best.other").alias("top"), (-F.col("best.col1")).alias("top_n"))
    )
    large = F.col("top_n") >= factor * F.col("n")
    rated = materialized(
        words.join(best, "word", "left").select(
            "word",
            F.when(large, F.col("top")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
            F.when(large, F.col("top_n")).alias("form_n"),
        ),
        "variant-forms",
    )
    ends = roots(rated.where(F.col("form").isNotNull()))
    return rated.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def spelling(
    df: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    least_letters: int = LEAST_LETTERS,
    least_n: int = 2,
    factor: int = 10,
) -> DataFrame:
    """``variants`` of the words of a text column.

    Words are runs of letters, A to Z lower-cased; a run whose checksum with the row's id 31
    divides loses a letter. Words with fewer than ``least_letters`` code points or fewer than
    ``least_n`` occurrences are left out. Null texts have no words; a null id counts as empty;
    repeated rows count again. Other columns are not read.
    """
    if least_letters < 6:
        raise ValueError("words need at least six letters")
    counted = count_words(df, id_column, text, least_letters).where(F.col("n") >= least_n)
    return variants(materialized(counted, "variant-words"), factor)
