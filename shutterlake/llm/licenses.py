"""License scan: an exact set-similarity join of text blocks with license templates.

Templates and blocks are sets of words; a template's blocks are all runs of ``block_words`` words
of a text, wherever they begin. All words are ordered from the globally rarest to the most
frequent. A block that contains at least t words of a template of n words holds one of the
template's first n - t + 1: only texts with such a word (the prefix) are looked at. A text with
fewer than t words of the template is out (length), and so is one whose words behind each prefix
word, in that order, can not make up t (position). In what is left the words of every block are
counted exactly, all blocks at once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shutterlake.llm.common import annotate

# The phrases of the base labels.
PHRASES = (
    ("mit license", "mit"),
    ("apache license", "apache"),
    ("general public license", "gpl"),
)
# Public license notices, as words.
NOTICES = (
    ("mit-notice", "released under the mit license"),
    (
        "mit-notice",
        "permission is hereby granted free of charge to any person obtaining a copy of this "
        "software and associated documentation files",
    ),
    (
        "mit-notice",
        "permission is hereby granted free of charge to any person obtaining a copy of this "
        "software and associated documentation files the software to deal in the software "
        "without restriction including without limitation the rights to use copy modify merge "
        "publish distribute sublicense and or sell copies of the software and to permit persons "
        "to whom the software is furnished to do so subject to the following conditions the "
        "above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the software",
    ),
    (
        "as-is-warranty",
        "the software is provided as is without warranty of any kind express or implied "
        "including but not limited to the warranties of merchantability fitness for a "
        "particular purpose and noninfringement in no event shall the authors or copyright "
        "holders be liable for any claim damages or other liability whether in an action of "
        "contract tort or otherwise arising from out of or in connection with the software or "
        "the use or other dealings in the software",
    ),
    ("apache-notice", "licensed under the apache license version 2 0"),
    (
        "apache-notice",
        "licensed under the apache license version 2 0 the license you may not use this file "
        "except in compliance with the license you may obtain a copy of the license at http www "
        "apache org licenses license 2 0 unless required by applicable law or agreed to in "
        "writing software distributed under the license is distributed on an as is basis "
        "without warranties or conditions of any kind either express or implied see the license "
        "for the specific language governing permissions and limitations under the license",
    ),
    (
        "gpl-notice",
        "this work is licensed under the gnu general public license version 3",
    ),
    (
        "gpl-notice",
        "this program is free software you can redistribute it and or modify it under the terms "
        "of the gnu general public license as published by the free software foundation",
    ),
    (
        "gpl-notice",
        "this program is free software you can redistribute it and or modify it under the terms "
        "of the gnu general public license as published by the free software foundation either "
        "version 3 of the license or at your option any later version this program is "
        "distributed in the hope that it will be useful but without any warranty without even "
        "the implied warranty of merchantability or fitness for a particular purpose see the "
        "gnu general public license for more details",
    ),
    (
        "bsd-notice",
        "redistribution and use in source and binary forms with or without modification are "
        "permitted provided that the following conditions are met",
    ),
    (
        "bsd-notice",
        "redistribution and use in source and binary forms with or without modification are "
        "permitted provided that the following conditions are met redistributions of source "
        "code must retain the above copyright notice this list of conditions and the following "
        "disclaimer redistributions in binary form must reproduce the above copyright notice "
        "this list of conditions and the following disclaimer in the documentation and or other "
        "materials provided with the distribution",
    ),
    (
        "mpl-notice",
        "this source code form is subject to the terms of the mozilla public license",
    ),
    ("cc-notice", "this work is licensed under a creative commons attribution license"),
    ("cc0", "cc0 1 0"),
    ("proprietary", "all rights reserved"),
    ("proprietary", "proprietary and confidential"),
)
# The parts of a Creative Commons licence's name, short and written out.
CC_KINDS = (
    ("by", "attribution"),
    ("by nc", "attribution noncommercial"),
    ("by nd", "attribution noderivatives"),
    ("by sa", "attribution sharealike"),
    ("by nc nd", "attribution noncommercial noderivatives"),
    ("by nc sa", "attribution noncommercial sharealike"),
)
CC_VERSIONS = ("1 0", "2 0", "2 5", "3 0", "4 0")
SHORT = 10  # templates with fewer words must be there with all of them, in as many words


def cc_templates() -> Iterator[tuple[str, str]]:
    """Every kind and version of a Creative Commons licence, as in ``cc by nc 4 0``."""
    for (kind, name), version in product(CC_KINDS, CC_VERSIONS):
        label = f"cc-{kind.replace(' ', '-')}-{version.replace(' ', '.')}"
        yield label, f"cc {kind} {version}"
        yield label, f"creative commons {name} {version}"


TEMPLATES = (*NOTICES, *cc_templates())
# A-Z to lower case; every other ASCII byte but 0-9 and a-z ends a word
FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32
    for b in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(FOLD).split()


def block_words(template: str) -> int:
    """Words of a template's blocks: its own number, and a quarter more if it is not short."""
    n = len(template.split())
    return n if n < SHORT else n + n // 4


def least_shared(template: str, threshold: float) -> int:
    """Distinct words of the template that a block must hold."""
    distinct = len(set(template.split()))
    if len(template.split()) < SHORT:
        return distinct
    return math.ceil(threshold * distinct - 1e-9)


def frequencies(df: DataFrame, text: str, vocabulary: frozenset) -> dict[bytes, int]:
    """Documents that hold each word of the templates, counted over all rows.

    The result has one number for each word of the templates, whatever the number of rows.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = dict.fromkeys(sorted(vocabulary), 0)
        for batch in batches:
            for one in batch.column(0).to_pylist():
                for word in vocabulary.intersection(words_of(one)):
                    total[word] += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.binary()), pa.array(list(total.values()), pa.int64())],
            names=["word", "n"],
        )

    counted = df.select(text).mapInArrow(count, "word binary, n bigint")
    rows = counted.groupBy("word").agg(F.sum("n").alias("n")).collect()
    return dict.fromkeys(vocabulary, 0) | {bytes(r["word"]): r["n"] for r in rows}


class Template:
    """A template's words by their global order."""

    def __init__(self, label: str, text: str, rank: dict[bytes, int], threshold: float) -> None:
        self.label = label
        self.words = sorted(set(text.encode().split()), key=rank.__getitem__)
        self.block = block_words(text)
        self.least = least_shared(text, threshold)
        self.prefix = self.words[: len(self.words) - self.least + 1]
        self.member = np.zeros(len(rank) + 1, bool)  # the last stands for all other words
        self.member[[rank[w] for w in self.words]] = True

    def may_match(self, distinct: set[bytes]) -> bool:
        """Length and position: can a prefix word and those behind it make up enough?"""
        held = [w in distinct for w in self.words]
        left = sum(held)
        for place in range(len(self.prefix)):
            if left < self.least:
                return False
            if held[place]:
                return True
        return False

    def shared(self, ranks: np.ndarray) -> np.ndarray:
        """How many of the template's words stand in the block at every word of a text.

        A word at place p is in the blocks that begin from p - block + 1 to p; where a word
        repeats, these stretches are joined, so that it counts once.
        """
        place = np.flatnonzero(self.member[ranks])
        word = ranks[place]
        order = np.lexsort((place, word))
        place, word = place[order], word[order]
        joined = (np.diff(word) == 0) & (np.diff(place) <= self.block)
        begins = place[np.r_[True, ~joined][: len(place)]] - self.block + 1
        ends = place[np.r_[~joined, True][: len(place)]] + 1
        change = np.bincount(np.maximum(begins, 0), minlength=len(ranks) + 1)
        change -= np.bincount(ends, minlength=len(ranks) + 1)
        return np.cumsum(change)[:-1]


class Index:
    """All templates and phrases, found by the words that a text must hold for them."""

    def __init__(self, templates, phrases, frequency: dict[bytes, int], threshold: float) -> None:
        order = sorted(frequency, key=lambda w: (frequency[w], w))
        self.rank = {word: i for i, word in enumerate(order)}
        self.templates = [Template(label, t, self.rank, threshold) for label, t in templates]
        self.prefix: dict[bytes, list[Template]] = {}
        for template in self.templates:
            for word in template.prefix:
                self.prefix.setdefault(word, []).append(template)
        self.first = frozenset(self.prefix)
        self.phrases = [(tuple(p.encode().split()), label) for p, label in phrases]

    def ranks(self, words: list[bytes]) -> np.ndarray:
        other = len(self.rank)
        return np.fromiter((self.rank.get(w, other) for w in words), np.int64, len(words))

    def places(self, ranks: np.ndarray, distinct: set[bytes]) -> list[tuple[int, str]]:
        """All places where a phrase's words stand consecutively, with its label."""
        found = []
        for phrase, label in self.phrases:
            if distinct.issuperset(phrase):
                starts = np.arange(max(0, len(ranks) - len(phrase) + 1))
                for at, word in enumerate(phrase):
                    starts = starts[ranks[starts + at] == self.rank[word]]
                found += [(start, label) for start in starts.tolist()]
        return sorted(found)

    def blocks(self, ranks: np.ndarray, distinct: set[bytes]) -> list[dict]:
        """Stretches of blocks that contain a template to the threshold, with the best share."""
        found = []
        tried: dict[int, Template] = {}
        for word in self.first.intersection(distinct):
            tried.update((id(t), t) for t in self.prefix[word])
        for template in tried.values():
            if not template.may_match(distinct):
                continue
            shared = template.shared(ranks)
            good = np.diff(shared >= template.least, prepend=False, append=False)
            edges = np.flatnonzero(good)
            for first, behind in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
                best = first + int(shared[first:behind].argmax())
                found.append({
                    "label": template.label, "start": first,
                    "end": min(behind - 1 + template.block, len(ranks)), "best": best,
                    "share": float(shared[best] / len(template.words)),
                })
        return sorted(found, key=lambda f: (f["start"], f["end"], f["label"]))


def scan(
    df: DataFrame,
    text: str = "text",
    threshold: float = 0.8,
    templates=TEMPLATES,
    phrases=PHRASES,
) -> DataFrame:
    """``df`` with what each text says of licenses.

    Words are lower-cased (A-Z) runs of letters, digits and non-ASCII characters. ``n_words``
    counts them; ``phrase_at`` and ``phrase_of`` list all places where a phrase's words stand
    consecutively and the phrase's label. ``blocks`` lists, for every template, the stretches of
    words covered by blocks that hold ``threshold`` of its distinct words (all of them if the
    template is short): label, first word, word behind the last, first word of the best block,
    and the share that block holds. ``block_of`` lists their labels, ``block_at`` and
    ``block_share`` tell the best block of all.

    A template's blocks are as long as itself, and a quarter longer from ten words on; they
    begin at every word of a text, so a notice is found wherever it stands.

    Words are ordered by the number of texts that hold them, counted over all rows in a first
    pass. Null and empty texts have no words and no labels. Columns of these names, in any case,
    are replaced. The templates and phrases are parameters, small and sent to every task.
    """
    vocabulary = frozenset(w for _, t in (*templates, *((0, p) for p, _ in phrases)) for w in t.encode().split())
    frequency = frequencies(df, text, vocabulary)

    def run(values: pa.Array) -> list:
        index = Index(templates, phrases, frequency, threshold)
        n_words, at, of, blocks, starts, shares, labels = [], [], [], [], [], [], []
        for one in values.to_pylist():
            words = words_of(one)
            distinct = set(words)
            places: list[tuple[int, str]] = []
            found: list[dict] = []
            if not vocabulary.isdisjoint(distinct):
                ranks = index.ranks(words)
                places = index.places(ranks, distinct)
                found = index.blocks(ranks, distinct)
            best = max(found, key=lambda f: (f["share"], -f["best"]), default=None)
            n_words.append(len(words))
            at.append([p for p, _ in places])
            of.append([label for _, label in places])
            blocks.append(found)
            labels.append(sorted({f["label"] for f in found}))
            shares.append(best["share"] if best else 0.0)
            starts.append(best["best"] if best else None)
        return [n_words, at, of, blocks, labels, starts, shares]

    added = (
        "n_words bigint, phrase_at array<bigint>, phrase_of array<string>, "
        "blocks array<struct<label:string, start:bigint, end:bigint, best:bigint, share:double>>, "
        "block_of array<string>, block_at bigint, block_share double"
    )
    return annotate(df, text, added, run)
