import random
import re

import pytest
from llm_cases import LOWER, as_set, frame, lettered, rows
from pyspark.sql import functions as F

from flightlake.llm import license_scan as L

COLS = ("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def brute(text, templates=L.TEMPLATES, containment=L.CONTAINMENT):
    w = lettered(text)
    places = [(i, label) for p, label in L.PHRASES.items() for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
    best, more = 0.0, set()
    sentences = re.split("[.!?][\x20\x09-\x0d]+|\n[\x20\x09-\x0d]*\n", (text or "").translate(LOWER))
    for i in range(len(sentences)):
        held = set(lettered(" ".join(sentences[i : i + 3])))
        for label, words in templates:
            wanted = set(words.split())
            share = len(wanted & held) / len(wanted)
            if share >= containment - 1e-12:
                more.add(label)
                best = max(best, share)
    base = {label for _, label in places}
    at = [i for i, _ in places]
    return (len(w), len(places), min(at, default=None), max(at, default=None), ",".join(sorted(base)), ",".join(sorted(base | more)),
            1.0 if places else best)


LGPL = """This library is free software; you can redistribute it and/or
modify it under the terms of the GNU Lesser General Public
License as published by the Free Software Foundation; either
version 2.1 of the License, or (at your option) any later version."""
NOTICES = [
    (800, "Intro.\nLicensed under the Apache License, Version 2.0.\nmore", None, None, 0),
    (801, "CC BY cc by CC-BY, General  Public\nLicense. All rights reserved", None, None, 0),
    (802, "Released under MIT license", None, None, 0),
    (803, "Released under the mighty license", None, None, 0),
    (804, "Permission is hereby granted, free of charge, to any person\nobtaining a copy of this software", None, None, 0),
    (804, "Permission is hereby granted, free of charge, to any person\nobtaining a copy of this software", None, None, 0),
    (None, "all rights reserved", None, None, 0),
    (805, LGPL, None, None, 0),
    (806, "Copyright X. All rights reserved. No part of this work may be reproduced without written permission", None, None, 0),
]


def test_matches_brute_force(spark):
    data = rows() + NOTICES
    got = as_set(L.license_scan(frame(spark, data, extra=True)), *COLS)
    assert got == sorted(((r[0], *brute(r[1])) for r in data), key=repr)
    labels = {r[0]: r[6].split(",") for r in got}
    assert "lgpl" in labels[805]
    assert any(label == "reserved" for _, label in [(r.doc_id, r.label) for r in L.template_matches(
        frame(spark, [NOTICES[-1]]).select("doc_id", "text", F.xxhash64("text").alias("print"))).collect()])


@pytest.mark.parametrize("containment", [0.5, 0.8, 1.0])
def test_filters_lose_no_match(spark, containment):
    rng = random.Random(int(containment * 10))
    letters = "abcdefghijklmn"
    templates = [(f"t{i}", " ".join(rng.sample(letters, rng.randint(1, 7)))) for i in range(6)]
    data = [(i, ". ".join(" ".join(rng.choices(letters, k=rng.randint(1, 9))) for _ in range(4)), None, None, 0) for i in range(60)]
    texts = frame(spark, data).select("doc_id", "text", F.xxhash64("text").alias("print"))
    got = {(r.doc_id, r.block, r.label) for r in L.template_matches(texts, templates, containment).collect()}
    runs = lambda t: [" ".join(t.split(". ")[i : i + 3]) for i in range(len(t.split(". ")))]
    want = {(i, b, label) for i, t, *_ in data for b, x in enumerate(runs(t)) for label, words in templates
            if len(set(words.split()) & set(x.split())) >= containment * len(set(words.split())) - 1e-9}
    assert got == want


def test_empty_table_and_no_python(spark):
    assert L.license_scan(frame(spark, [])).count() == 0
    plan = L.license_scan(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
