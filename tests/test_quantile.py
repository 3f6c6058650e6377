import math

import numpy as np

from flightlake.operators.quantile import exact_quantile, exact_quantiles
from flightlake.operators.ranks import with_sum_before


def test_matches_numpy(spark):
    rng = np.random.default_rng(1)
    vals = np.concatenate([rng.exponential(10, 3000), np.full(500, 7.25), rng.normal(0, 1, 1000)])
    groups = rng.choice(["a", "b", "c"], size=len(vals))
    df = spark.createDataFrame([(str(g), float(v)) for g, v in zip(groups, vals)], "g string, v double")
    probs = [0.01, 0.25, 0.5, 0.75, 0.99]
    res = {r.g: (r.n, r.qs) for r in exact_quantiles(df, "v", probs, group_cols=["g"]).collect()}
    for g in "abc":
        n, qs = res[g]
        expect = np.percentile(vals[groups == g], [p * 100 for p in probs])
        assert n == (groups == g).sum()
        assert np.allclose(qs, expect, rtol=0, atol=1e-12)


def test_global_single_and_ties(spark):
    df = spark.createDataFrame([(None if x is None else float(x),) for x in [3, 1, 2, 2, 2, 5, None]], "v double")
    assert exact_quantile(df, "v", 0.5) == 2.0
    assert abs(exact_quantile(df, "v", 0.9) - np.percentile([3, 1, 2, 2, 2, 5], 90)) < 1e-12


def test_empty(spark):
    df = spark.createDataFrame([], "v double")
    assert exact_quantile(df, "v", 0.5) is None
    assert exact_quantiles(df.selectExpr("'a' AS g", "v"), "v", [0.5], ["g"]).count() == 0


def test_many_groups_and_a_hot_one(spark):
    rng = np.random.default_rng(3)
    groups = [f"g{i % 40}" if i % 3 else "hot" for i in range(3000)]
    vals = rng.normal(0, 10, 3000).round(2)
    df = spark.createDataFrame([(g, float(v)) for g, v in zip(groups, vals)], "g string, v double")
    probs = [0.01, 0.25, 0.5, 0.99]
    res = exact_quantiles(df, "v", probs, group_cols=["g"]).collect()
    arr = np.array(groups)
    assert len(res) == 41
    for r in res:
        sel = vals[arr == r.g]
        assert r.n == len(sel)
        assert np.allclose(r.qs, np.percentile(sel, [p * 100 for p in probs]), atol=1e-9)


def test_null_groups_infinities_and_constants(spark):
    inf = math.inf
    rows = [(None, 1.0), (None, 3.0), ("a", inf), *[("a", float(i)) for i in range(50)], ("b", -inf), ("b", inf), ("b", inf),
            ("c", 7.0), ("c", 7.0), ("c", 7.0), ("d", None), ("d", math.nan)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: (r.n, list(r.qs)) for r in exact_quantiles(df, "v", [0.5, 1.0], ["g"]).collect()}
    assert got == {None: (2, [2.0, 3.0]), "a": (51, [25.0, inf]), "b": (3, [inf, inf]), "c": (3, [7.0, 7.0])}


def test_several_group_columns(spark):
    df = spark.createDataFrame([("a", i % 2, float(i)) for i in range(11)], "g string, h int, v double")
    got = {(r.g, r.h): (r.n, list(r.qs)) for r in exact_quantiles(df, "v", [0.5, 0.95], ["g", "h"]).collect()}
    assert {k: (n, [round(q, 9) for q in qs]) for k, (n, qs) in got.items()} == {("a", 0): (6, [5.0, 9.5]), ("a", 1): (5, [5.0, 8.6])}


def test_sums_before(spark):
    df = spark.createDataFrame([(i % 3 or None, i, i) for i in range(100)], "g long, o long, w long").repartition(7)
    for r in with_sum_before(df, ["g"], ["o"], "w").collect():
        assert r.before == sum(i for i in range(r.o) if (i % 3 or None) == r.g)
