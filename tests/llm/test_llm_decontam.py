import hashlib
import random

import pytest
from llm_cases import as_set, frame, invented, lettered, rows

from flightlake.llm.decontam import contamination, decontaminate

COLS = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def brute(text, items, window=10):
    w = lettered(text)
    hit, found = set(), set()
    for item, t in items:
        v = lettered(t)
        n = min(window, len(v))
        grams = {tuple(v[i : i + n]) for i in range(len(v) - n + 1)} if n else set()
        for i in range(len(w) - n + 1):
            if n and tuple(w[i : i + n]) in grams:
                hit |= set(range(i, i + n))
                found |= {str(item)} if item is not None else set()
    return len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)


def benchmark(spark, items):
    return spark.createDataFrame(items, "item_id bigint, text string").selectExpr("*", "'z' AS words", "1 AS hash")


@pytest.mark.parametrize("seed", [1, 2])
def test_matches_brute_force(spark, seed):
    rng = random.Random(seed)
    items = [(i, invented(rng, rng.choice([2, 5, 9, 10, 11, 40]))) for i in range(12)]
    items += [(3, items[0][1]), (None, "null id item " + invented(rng, 9)), (50, None), (51, ""), (52, "..."), (53, "Tail")]
    data = rows(seed)
    for k in range(25):
        words = items[k % 12][1].split()
        start = rng.randint(0, max(0, len(words) - 8))
        part = " , ".join(words[start : start + rng.randint(5, 30)]).upper()
        data.append((700 + k % 20, f"{invented(rng, 20)} {part} {invented(rng, 6)}", None, None, 0))
    got = as_set(contamination(frame(spark, data, extra=True), benchmark(spark, items)), *COLS)
    want = sorted(((r[0], *brute(r[1], items)) for r in data), key=repr)
    assert got == want and any(x[-1] for x in want) and not all(x[-1] for x in want)
    kept = decontaminate(frame(spark, data, extra=True), benchmark(spark, items))
    clean = sorted(((r[0], r[1]) for r in data if not brute(r[1], items)[-1]), key=repr)
    assert as_set(kept, "doc_id", "text") == clean and kept.columns == frame(spark, [], extra=True).columns


def test_a_window_that_many_items_share(spark):
    shared = "one two three four five six seven eight nine ten"
    items = [(i, f"{shared} item{i}") for i in range(300)]
    data = [(i, f"doc {i} {shared} end", None, None, 0) for i in range(40)]
    out = contamination(frame(spark, data), benchmark(spark, items))
    assert {(r.n_hit, r.n_items) for r in out.collect()} == {(10, 300)}
    want = hashlib.sha256(",".join(sorted(str(i) for i in range(300))).encode()).hexdigest()
    assert {r.items_sha256 for r in out.collect()} == {want}


def test_empty_tables(spark):
    df, none = frame(spark, rows()), benchmark(spark, [])
    assert contamination(df, none).filter("contaminated").count() == 0
    assert contamination(frame(spark, []), benchmark(spark, [(1, "a b")])).count() == 0
    assert decontaminate(df, none).count() == df.count()


def test_no_python(spark):
    read = lambda t: spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet")
    plan = contamination(read("documents"), read("benchmark"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
