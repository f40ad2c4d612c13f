import functools
import re

import pyarrow as pa
import pytest

from secdata.llm import queries
from secdata.llm.license_rules import BASE, GENERAL, NAME, Rule, rules
from secdata.llm.license_scan import Scanner, scan

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TEXTS = [
    None, "", "...", "Mit und ohne Lizenz: mit mit mit.", "Licensed under the Apache License, Version 2.0.", "Released under the MIT License. Under the MIT license again, under THE mit LICENSE!", "Licensed under CC BY-NC 4.0.", "cc by nc cc by nc",
    "This work is licensed under the GNU General Public License, version 3.", "either version 2 of the GNU Lesser General Public License or GNU LGPL v3; all rights reserved.", "SPDX-License-Identifier: GPL-2.0-or-later", "// SPDX-License-Identifier: MIT OR Apache-2.0",
    "Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License", "https://creativecommons.org/licenses/by-nc-sa/4.0/", "A mitigation under the mitlicense; apache licensed version 2.", "Alle Rechte vorbehalten. Tous droits réservés. GRÖSSE under the mit license",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\")", "License: BSD-3-Clause", "Dual licensed under the MIT license or Apache-2.0", "x " * 5000 + "under the mit license " * 300 + "gnu gpl v3 " * 300,
]


def example(pattern, pick=0):
    """A text that the pattern matches: the first alternative of each group, the first character of each class."""
    pattern = pattern.replace("[^ ]+", "some")
    while "(?:" in pattern:
        pattern = re.sub(r"\(\?:([^()]*)\)(?:\?|\{1,12\})?", lambda m: m[1].split("|")[min(pick, m[1].count("|"))], pattern)
    return re.sub(r"\[(.)[^\]]*\]", r"\1", pattern).replace("?", "")


@functools.cache
def compiled(pattern):
    return re.compile(rf"(?<![^ ])(?:{pattern})(?![^ ])")


def plain(text, table):
    """All rules on all texts, containment by all pairs."""
    words = WORD.findall((text or "").translate(LOWER))
    joined = " ".join(words)
    starts, at = {}, 0
    for i, w in enumerate(words):
        starts[at] = i
        at += len(w) + 1
    ends = {s + len(words[i]): i + 1 for s, i in starts.items()}
    found = [(starts[m.start()], ends[m.end()], k) for k, r in enumerate(table) for m in compiled(r.pattern).finditer(joined)]
    base = [x for x in found if table[x[2]].level == BASE]
    kept = []
    for x in sorted((x for x in found if table[x[2]].level != BASE), key=lambda x: (table[x[2]].level, x[0] - x[1], x[0], x[2])):
        if not any(y[0] <= x[0] and x[1] <= y[1] for y in kept):
            kept.append(x)
    return len(words), sorted(base + kept)


def test_the_gate_and_the_tree_lose_nothing(spark):
    table = rules()
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()
    examples = [example(r.pattern) for r in table]
    assert all(re.fullmatch(r.pattern, e) for r, e in zip(table, examples, strict=True))
    texts = TEXTS + [r["text"] for r in docs[::10]] + examples + [example(r.pattern, 1) for r in table]
    scanned = scan(spark.createDataFrame(list(enumerate(texts)), "i long, text string").repartition(3))
    got = {r["i"]: (r["n_words"], [(d["begin"], d["end"], d["rule"]) for d in r["detections"]]) for r in scanned.collect()}
    assert got == {i: plain(t, table) for i, t in enumerate(texts)}
    seen = {d[2] for i, (_, ds) in got.items() if i >= len(TEXTS) + len(docs[::10]) for d in ds}
    assert len(seen) > 0.8 * len(table)  # others are suppressed in their own example


@pytest.mark.parametrize(
    ("text", "labels"),
    [
        (TEXTS[3], ""), (TEXTS[4], "apache-2"), (TEXTS[5], "mit"), (TEXTS[6], "cc-by-nc"), (TEXTS[8], "gpl-3"), (TEXTS[9], "lgpl-2,lgpl-3,proprietary"), (TEXTS[10], "gpl-2"), (TEXTS[11], "mit"), (TEXTS[12], "cc-by-nc-sa"), (TEXTS[13], "cc-by-nc-sa"),
        (TEXTS[14], ""), (TEXTS[15], "mit,proprietary"), (TEXTS[16], "mit"), (TEXTS[17], "bsd-3"),
    ],
)
def test_labels(text, labels):
    scanner = Scanner()
    _, found = scanner.detect(pa.array([text], pa.string()))
    assert ",".join(sorted({scanner.rules[k].label for _, _, k in scanner.settle(found.get(0, []))})) == labels


def test_query(spark, tmp_path):
    spark.createDataFrame([(i if i != 2 else None, t, "x") for i, t in enumerate([*TEXTS, TEXTS[4]])], "doc_id long, text string, labels string").write.parquet(f"{tmp_path}/documents.parquet")
    table, got = rules(), queries.op13_license_scan(spark, str(tmp_path)).collect()
    want = []
    for i, t in enumerate([*TEXTS, TEXTS[4]]):
        n, kept = plain(t, table)
        base = [x for x in kept if table[x[2]].level == BASE]
        names = lambda xs: ",".join(sorted({table[x[2]].label for x in xs}))
        want.append((str(i if i != 2 else None), n, len(base), min((x[0] for x in base), default=None), max((x[0] for x in base), default=None), names(base), names(kept)))
    assert sorted(map(str, want)) == sorted(str((str(r["doc_id"]), r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"], r["labels"])) for r in got)
    assert all(0 <= r["score"] <= 1 and (r["score"] > 0) == (r["labels"] != "") for r in got)
    assert scan(spark.createDataFrame([], "text string, detections string")).count() == 0


def test_texts_without_any_keyword(spark):
    rows = scan(spark.createDataFrame([("plain words only",), (None,)], "text string")).collect()
    assert [(r["n_words"], r["detections"], r["license_score"]) for r in rows] in ([(3, [], 0.0), (0, [], 0.0)], [(0, [], 0.0), (3, [], 0.0)])


def test_ties_and_priority():
    table = [Rule("base", BASE, "c", "b c"), Rule("low", GENERAL, "a", "a b c d"), Rule("first", NAME, "b", "b c"), Rule("second", NAME, "b", "b c"), Rule("inside", NAME, "c", "c")]
    scanner = Scanner(table)
    _, found = scanner.detect(pa.array(["A b, c d"], pa.string()))
    assert [table[k].label for _, _, k in scanner.settle(found[0])] == ["low", "base", "first"]
