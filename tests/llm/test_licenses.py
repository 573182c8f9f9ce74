import re

import pytest

from shutterlake.llm import licenses, queries
from tests.llm.support import documents, odd_rows, prose

MIT = next(t for label, t in licenses.TEMPLATES if len(t.split()) == 87 and label == "mit-notice")
NOTICES = [
    "Released under the MIT License.",
    "mit mit license, MIT-License apache\nlicense",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software.",
    "Redistribution and use in source and binary forms, with modification, are permitted provided "
    "that the following conditions are met:",
    "This program is free software; you can redistribute it under the terms of the GNU General "
    "Public License",
    "This Source Code Form is subject to the Mozilla Public License",
    "Licensed under CC BY-NC 4.0.", "CC-BY-SA 3.0, CC BY 2.5", "(c) me. All rights reserved.",
    "all these rights are reserved", "Creative Commons Attribution-NonCommercial 4.0",
    "CC BY-NC. 4.0 reserved rights All", MIT.replace("persons", "anyone").title(),
]


def rows():
    some = [(100 + i, n, "en", "s") for i, n in enumerate(NOTICES)]
    some += [(200 + i, f"{prose(i, 70 + 9 * i)}\n{n} {prose(i, 90)}", "en", "s") for i, n in enumerate(NOTICES)]
    some.append((300, " ".join(NOTICES) + " the software " * 30 + " ".join(NOTICES), "en", "s"))
    return odd_rows() + some


def words_of(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def expected(name, text):
    """Brute force: every block of every template."""
    words, places, blocks = words_of(text), [], []
    for phrase, label in licenses.PHRASES:
        parts = phrase.split()
        places += [(i, label) for i in range(len(words)) if words[i : i + len(parts)] == parts]
    places.sort()
    for label, template in licenses.TEMPLATES:
        own, size = set(template.split()), licenses.block_words(template)
        if len(own & set(words)) < licenses.least_shared(template, 0.8):
            continue  # no block can hold enough of it
        counts = [len(own & set(words[i : i + size])) for i in range(len(words))]
        good = [n >= licenses.least_shared(template, 0.8) for n in counts]
        start = None
        for i, fits in enumerate([*good, False]):
            if fits and start is None:
                start = i
            elif not fits and start is not None:
                best = max(counts[start:i])
                first = start + counts[start:i].index(best)
                end = min(i - 1 + size, len(words))
                blocks.append((start, end, label, first, best / len(own)))
                start = None
    best = max(((share, -at) for _, _, _, at, share in blocks), default=(0.0, None))
    return (
        str(name), len(words), [p for p, _ in places], [p for _, p in places], sorted(blocks),
        sorted({b[2] for b in blocks}), best[0], best[1] and -best[1],
    )


def test_scan_equals_brute_force(spark):
    found = licenses.scan(documents(spark, rows())).collect()
    got = sorted((
        str(r["doc_id"]), r["n_words"], r["phrase_at"], r["phrase_of"],
        sorted((b["start"], b["end"], b["label"], b["best"], b["share"]) for b in r["blocks"]),
        r["block_of"], r["block_share"], r["block_at"] or r["block_at"],
    ) for r in found)
    want = sorted(expected(name, text) for name, text, *_ in rows())
    assert [(*g[:-1], g[-1] or None) for g in got] == [(*w[:-1], w[-1] or None) for w in want]
    labels = {x for w in want for x in w[5]}
    assert labels >= {
        "mit-notice", "bsd-notice", "mpl-notice", "proprietary", "cc-by-nc-4.0", "cc-by-2.5", "cc-by-sa-3.0",
    }


def index():
    vocabulary = {w for _, t in licenses.TEMPLATES for w in t.encode().split()}
    vocabulary |= {w for p, _ in licenses.PHRASES for w in p.encode().split()}
    return licenses.Index(licenses.TEMPLATES, licenses.PHRASES, dict.fromkeys(vocabulary, 0), 0.8)


def test_a_long_notice_is_found_wherever_it_stands():
    own = index()
    for offset in range(64):
        words = [b"w%d" % i for i in range(offset)] + MIT.encode().split() + [b"x"] * 70
        found = own.blocks(own.ranks(words), set(words))
        best = max(found, key=lambda b: b["share"])
        assert best["label"] == "mit-notice" and best["share"] == 1
        assert any(b["start"] <= offset and b["end"] >= offset + 87 for b in found)


def test_kinds_are_told_apart():
    own = index()
    for text, label in (("cc by nc 4 0", "cc-by-nc-4.0"), ("cc by 4 0", "cc-by-4.0"), ("rights reserved", None)):
        words = text.encode().split()
        assert [b["label"] for b in own.blocks(own.ranks(words), set(words))] == [label] * bool(label)


def test_places_are_counted_in_one_pass():
    own, n = index(), 200_000
    words = [b"mit", b"license"] * n
    assert len(own.places(own.ranks(words), set(words))) == n


@pytest.mark.parametrize("text, labels", [("Licensed under CC BY-NC 4.0.", "cc-by-nc-4.0"), ("x. All rights reserved.", "proprietary"), ("Released under the MIT License.", "mit,mit-notice")])
def test_digest(spark, text, labels):
    row = queries.licensed(documents(spark, [(1, text, "en", "a")])).first()
    assert row["labels"] == labels and row["score"] == 1.0


def test_empty_table(spark):
    assert licenses.scan(documents(spark, rows()).limit(0)).count() == 0
