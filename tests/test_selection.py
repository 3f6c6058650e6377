import math

import numpy as np
from pyspark.sql import functions as F

from flightlake.operators import profiles as pf
from flightlake.operators import selection as sel
from flightlake.operators.quantile import exact_quantiles


def quantiles(df, probs, groups=(), gather=50):
    return {tuple(r[g] for g in groups): (r.n, list(r.qs)) for r in sel.selected_quantiles(df, "v", probs, groups, gather).collect()}


def test_matches_numpy_over_several_rounds(spark):
    rng = np.random.default_rng(5)
    v = np.concatenate([rng.exponential(10, 30_000), np.full(15_000, 7.25), rng.normal(0, 1, 5_000)])
    g = rng.choice(["a", "b", "hot"], size=len(v), p=[0.1, 0.2, 0.7])
    df = spark.createDataFrame([(str(x), float(y)) for x, y in zip(g, v)], "g string, v double")
    probs = [0.0, 0.001, 0.25, 0.5, 0.9, 1.0]
    got = quantiles(df, probs, ["g"])
    for name in ("a", "b", "hot"):
        n, qs = got[(name,)]
        assert n == (g == name).sum()
        assert np.allclose(qs, np.percentile(v[g == name], [100 * p for p in probs]), rtol=0, atol=1e-9)


def test_same_as_by_sorting(spark):
    df = spark.range(20_000).select((F.col("id") % 7).alias("g"), (F.xxhash64("id") % 1000).cast("double").alias("v"))
    probs = [0.1, 0.5, 0.77]
    expect = {(r.g,): (r.n, list(r.qs)) for r in exact_quantiles(df, "v", probs, ["g"]).collect()}
    assert quantiles(df, probs, ["g"], gather=10) == expect


def test_nulls_infinities_and_constants(spark):
    inf = math.inf
    rows = [(None, 1.0), (None, 3.0), ("a", inf), *[("a", float(i)) for i in range(50)], ("b", -inf), ("b", inf), ("b", inf),
            ("c", 7.0), ("c", 7.0), ("c", 7.0), ("d", None), ("d", math.nan)]
    df = spark.createDataFrame(rows, "g string, v double")
    want = {(None,): (2, [2.0, 3.0]), ("a",): (51, [25.0, inf]), ("b",): (3, [inf, inf]), ("c",): (3, [7.0, 7.0])}
    assert quantiles(df, [0.5, 1.0], ["g"]) == want
    assert quantiles(df, [0.5, 1.0], ["g"], gather=1) == want


def test_empty_and_global(spark):
    df = spark.createDataFrame([], "g string, v double")
    assert sel.selected_quantile(df, "v", 0.5) is None
    assert quantiles(df, [0.5], ["g"]) == {}
    assert sel.selected_quantile(spark.range(101).selectExpr("id AS v"), "v", 0.25) == 25.0


def test_ranks_outside_pick_nothing(spark):
    df = spark.range(500).selectExpr("cast(id AS double) AS v")
    row = sel.values_at(df, "v", [lambda n: n, lambda n: n - 1, lambda n: F.lit(-1)], gather=20).first()
    assert (row.n, row.picked) == (500, [None, 499.0, None])


def test_values_meet_the_state_where_they_are(spark):
    df = spark.range(100_000).select((F.xxhash64("id") % 100_000).cast("double").alias("v"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = sel.selected_quantiles(df, "v", [0.5], gather=100)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    scan = next(i for i, line in enumerate(plan.split("\n")) if "selection-values" in line)
    over = plan.split("\n")[:scan]
    assert "rangepartitioning" not in plan
    above = next(line for line in reversed(over) if "Join" in line or "Exchange" in line)
    assert "BroadcastHashJoin" in above


def test_first_rows_like_a_sort(spark):
    df = spark.range(3000).select((F.col("id") % 900).alias("key"), F.lit("x").alias("o"), F.col("id").alias("c0"))
    order = (F.col("key") % 50).cast("double")
    for n in (0, 1, 40, 777, 2999, 3000, 9000):
        got = sel.first_rows(df, n, order, "key", gather=64)
        want = df.orderBy(order, "key").limit(n)
        assert got.columns == df.columns
        count = lambda d: sorted((r.key, r["count"]) for r in d.groupBy("key").count().collect())
        assert count(got) == count(want)


def test_first_rows_of_copies_nulls_and_nothing(spark):
    copies = spark.range(5000, numPartitions=7).select(F.lit(None).cast("long").alias("key"), F.lit(None).cast("double").alias("v"))
    assert sel.first_rows(copies, 1234, F.col("v"), "key").count() == 1234
    mixed = spark.createDataFrame([(1, None), (2, math.nan), (3, 1.0), (4, 0.5)], "key long, v double")
    assert [r.key for r in sel.first_rows(mixed, 3, F.col("v"), "key").orderBy("key").collect()] == [1, 3, 4]
    assert sel.first_rows(mixed.limit(0), 3, F.col("v"), "key").count() == 0


def test_stable_head_is_the_first_by_hash(spark):
    df = spark.range(4000).select(F.col("id").alias("obs_id"))
    got = sorted(r.obs_id for r in pf.stable_head(df, 321).collect())
    want = sorted(r.obs_id for r in df.orderBy(pf.stable_fraction("obs_id"), "obs_id").limit(321).collect())
    assert got == want
