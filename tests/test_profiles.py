import numpy as np
from pyspark.sql import functions as F

from flightlake.operators import profiles as pf


def frame(spark, rows, schema="obs_id long, velocity double, geo_altitude double, Description string"):
    return spark.createDataFrame(rows, schema)


def test_histogram_last_bin_closed_and_empty_bins(spark):
    vals = [0.0, 1.0, 2.0, 10.0, 30.0]
    df = frame(spark, [(i, v, 1.0, "a") for i, v in enumerate(vals)])
    h = {r["bin"]: r["n"] for r in pf.histogram(df, "velocity", 30).collect()}
    counts, _ = np.histogram(vals, bins=30)
    assert len(h) == 30 and [h[i] for i in range(30)] == list(counts)


def test_histogram_constant_and_empty(spark):
    df = frame(spark, [(i, 5.0, 1.0, "a") for i in range(4)])
    rows = pf.histogram(df, "velocity").collect()
    assert len(rows) == 1 and rows[0]["n"] == 4
    assert pf.histogram(df.filter(F.lit(False)), "velocity").count() == 0


def test_dropna_null_and_nan(spark):
    df = frame(spark, [(0, None, 1.0, "a"), (1, float("nan"), 1.0, "a"), (2, 3.0, 1.0, "a")])
    assert [r.obs_id for r in pf.dropna_any(df, ["velocity"]).collect()] == [2]


def test_top4_ties_count_then_label(spark):
    rows = [(i, 1.0, 1.0, d) for i, d in enumerate("aabbccddee")] + [(99, 1.0, 1.0, None)] * 5
    top = [r.Description for r in pf.top_categories(frame(spark, rows), "Description", 4).collect()]
    assert top == ["a", "b", "c", "d"]


def test_band_counts_keep_empty_bands(spark):
    df = frame(spark, [(0, 1.0, 100.0, "a"), (1, 1.0, 100.0, "a"), (2, 1.0, 20000.0, "a"), (3, 1.0, -3.0, "a")])
    got = [(r.alt_band, r.n) for r in pf.altitude_band_counts(df).collect()]
    assert got == [("Low (0-3k)", 2), ("Cruise Low (10-30k)", 1), ("Climb (3-10k)", 0), ("High (30k+)", 0)]


def test_radar_constant_metric_is_half(spark):
    rows = [(i, 100.0, 5000.0, d, 0.5, f"ac{i}") for i, d in enumerate(["a", "b", "c"])]
    df = spark.createDataFrame(rows, "obs_id long, velocity double, geo_altitude double, Description string, "
                                     "climb_rate_ratio double, icao24 string")
    radar = pf.category_radar(df, 4).collect()
    assert len(radar) == 15 and all(r.value == 0.5 for r in radar)
    assert sorted({r.point for r in radar}) == [0, 1, 2, 3, 4]


def test_radar_scaling(spark):
    rows = [(0, 100.0, 1.0, "a", 1.0, "x"), (1, 200.0, 1.0, "b", 1.0, "y"), (2, 300.0, 1.0, "c", 1.0, "z")]
    df = spark.createDataFrame(rows, "obs_id long, velocity double, geo_altitude double, Description string, "
                                     "climb_rate_ratio double, icao24 string")
    v = {r.Description: r.value for r in pf.category_radar(df).filter("metric = 'avg_velocity'").collect()}
    assert v == {"a": 0.0, "b": 0.5, "c": 1.0}


def test_category_codes_sorted(spark):
    df = frame(spark, [(0, 1.0, 1.0, "b"), (1, 1.0, 1.0, "a"), (2, 1.0, 1.0, "c"), (3, None, 1.0, "z")])
    got = {r.Description: r.desc_code for r in pf.category_codes(df).collect()}
    assert got == {"a": 0, "b": 1, "c": 2}


def test_hash_sample_stable_and_fractional(spark):
    df = spark.range(20000).withColumnRenamed("id", "obs_id")
    a = {r.obs_id for r in pf.hash_sample(df, 0.3).collect()}
    b = {r.obs_id for r in pf.hash_sample(df.repartition(7), 0.3).collect()}
    assert a == b and 0.27 < len(a) / 20000 < 0.33


def test_prepare_and_optional_cap(spark):
    rows = [(i, float(i), 1.0, 2.0, "x", 1704067207 + i) for i in range(10)] + [(99, None, 1.0, 2.0, "x", 0)]
    df = spark.createDataFrame(rows, "obs_id long, velocity double, geo_altitude double, vertical_rate double, "
                                     "Description string, snapshot_ts long")
    p = pf.prepare(df)
    assert p.count() == 10 and {"snapshot_time", "altitude_km", "alt_band"} <= set(p.columns)
    capped = pf.prepare(df, max_rows=4)
    assert capped.count() == 4 and set(r.obs_id for r in capped.collect()) == set(
        r.obs_id for r in pf.prepare(df.repartition(3), max_rows=4).collect())


def test_wtc_min_support(spark):
    rows = [(i, 1.0, "Heavy") for i in range(5)] + [(10 + i, 1.0, "Light") for i in range(4)]
    df = spark.createDataFrame(rows, "obs_id long, velocity double, WTC string")
    got = pf.wtc_supported(df).select("WTC", "wtc_order").distinct().collect()
    assert [(r.WTC, r.wtc_order) for r in got] == [("Heavy", 0)]


def test_dense_codes(spark):
    df = spark.createDataFrame([(f"k{i:04d}",) for i in range(300)] * 2, "Description string")
    codes = {r.Description: r.c for r in pf.dense_codes(df.repartition(5), "Description", "c").collect()}
    assert codes == {f"k{i:04d}": i for i in range(300)}


def test_stable_head_exact_size(spark):
    df = spark.range(5000).withColumnRenamed("id", "obs_id")
    a = pf.stable_head(df, 123)
    assert a.count() == 123
    assert {r.obs_id for r in a.collect()} == {r.obs_id for r in pf.stable_head(df.repartition(9), 123).collect()}
    assert pf.stable_head(df, 10_000).count() == 5000


def test_missing_column_guard(spark):
    import pytest
    df = frame(spark, [(0, 1.0, 1.0, "a")]).drop("Description")
    with pytest.raises(ValueError, match="Description"):
        pf.envelope_top(df)


def test_snapshot_time_label(spark):
    df = spark.createDataFrame([(1704067387,), (1704067207,)], "snapshot_ts long")
    assert pf.snapshot_time_label(df) == "00:00:07"
    assert pf.snapshot_time_label(df.filter(F.lit(False))) == "N/A"
