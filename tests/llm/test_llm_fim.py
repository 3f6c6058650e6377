import hashlib
import random
import re

import numpy as np
from llm_cases import frame, invented, rows
from pyspark.sql import functions as F

from flightlake.llm.fim import Blocks, fenwick, fill_in_middle, restored, transform

UNIT = re.compile("[\x20\x09-\x0d]*[^\x20\x09-\x0d]+|[\x20\x09-\x0d]+")


def brute(doc_id, text):
    text = text or ""
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    units = UNIT.findall(text)
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < 80:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_matches_brute_force(spark):
    data = rows(4, 120) + [(900 + i, t, "en", "s", 0) for i, t in enumerate([
        "has <M> inside", "<P", "a<", "  lead", "trail \n", " ", "é 🙂\x0b字", "one", "\x1c\x85 not spaces", "x" * 30_000, "y " * 30_000, " " * 20_000])]
    df = frame(spark, data, extra=True).selectExpr("*", "1 AS form", "2 AS output", "3 AS `a.b`")
    made = fill_in_middle(df, {"doc_id": F.col("doc_id"), "kept": F.col("`a.b`")})
    got = made.withColumn("again", restored(F.col("output"), F.col("form"))).collect()
    want = sorted(((r[0], *brute(r[0], r[1]), r[1] or "") for r in data), key=repr)
    assert sorted(((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.again) for r in got), key=repr) == want
    assert {w[2] for w in want} == {"plain", "spm", "psm"} and {r.kept for r in got} == {3}


def test_every_cut_in_blocks_of_any_size():
    rng = random.Random(5)
    for text in ["", "a", " ", "ab  cd ", invented(rng, 60), "é 🙂 字\t\n x" * 9, " lead" * 7]:
        raw, units = text.encode(), UNIT.findall(text)
        for block in (1, 2, 3, 7, 64, 8192):
            b = Blocks(raw, block)
            assert b.n == len(units)
            for k in range(len(units) + 1):
                head = "".join(units[:k])
                assert b.cut(k) == (len(head.encode()), len(head)), (text, block, k)


def test_fenwick_holds_the_sums_of_its_ranges():
    counts = np.array([3, 0, 5, 2, 7, 1, 4])
    tree = fenwick(counts)
    assert all(tree[i] == counts[i - (i & -i) : i].sum() for i in range(1, 8)) and len(fenwick(counts[:0])) == 1


def test_very_long_text_and_empty_table(spark):
    text = ("word été  " * 400_000).encode()
    n, form, first, middle, out = transform(text, (123_456, 700_001, 0, 99))
    assert (n, form) == (800_001, "psm") and len(out) == len(text) + 9
    units = UNIT.findall(text.decode())
    assert first == len("".join(units[:123_456])) and middle == len("".join(units[123_456:700_001]))
    assert fill_in_middle(frame(spark, []), {"doc_id": F.col("doc_id")}).count() == 0
