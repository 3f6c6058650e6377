import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from flightlake.operators import anomalies as an


def test_previous_reading_equals_plain_lag_across_chunks(spark):
    rnd = random.Random(5)
    rows = [(i, rnd.choice(["a", "b", "c", "", None]), rnd.randrange(0, 5000), float(rnd.random()))
            for i in range(400)]
    df = spark.createDataFrame(rows, "obs_id long, icao24 string, snapshot_ts long, velocity double")
    got = an.previous_reading(df, "icao24", "snapshot_ts", "obs_id", ["velocity"], chunk_seconds=97)
    w = Window.partitionBy("icao24").orderBy("snapshot_ts", "obs_id")
    ref = df.select("obs_id", F.when(F.col("icao24").isNotNull() & (F.col("icao24") != ""),
                                     F.lag("velocity").over(w)).alias("pv"))
    a = {r.obs_id: r.prev_velocity for r in got.collect()}
    b = {r.obs_id: r.pv for r in ref.collect()}
    assert a == b


def test_flags(spark):
    rows = [(0, "a", 0, 100.0, 1000.0, 1.0), (1, "a", 10, 400.0, 1000.0, 1.0), (2, "a", 20, 400.0, 3000.0, 1.0),
            (3, "b", 0, 10.0, 1000.0, 60.0), (4, "b", 0, 10.0, 1000.0, 1.0)]
    df = spark.createDataFrame(rows, "obs_id long, icao24 string, snapshot_ts long, velocity double, "
                                     "baro_altitude double, vertical_rate double")
    f = {r.obs_id: (r.sudden_velocity_anomaly, r.unrealistic_climb_anomaly, r.altitude_jump_anomaly)
         for r in an.flag_anomalies(df).collect()}
    assert f[0] == (False, False, False)
    assert f[1] == (True, False, False)   # 300 m/s in 10 s
    assert f[2] == (False, False, True)   # 2000 m in 10 s
    assert f[3] == (False, True, False)   # |vertical rate| > 50
    assert f[4] == (False, False, False)  # same second as the previous reading: no rate
    assert {r.obs_id for r in an.flagged_only(an.flag_anomalies(df)).collect()} == {1, 2, 3}


def test_peer_anomalies(spark):
    rows = [(i, f"x{i}", "D1", 100.0 + (i % 3), 1000.0) for i in range(40)] + [(99, "o", "D1", 500.0, 1000.0)]
    rows += [(200 + i, "y", "D2", 1.0, 1.0) for i in range(4)]  # below the minimum peer count
    df = spark.createDataFrame(rows, "obs_id long, icao24 string, Description string, velocity double, "
                                     "baro_altitude double")
    out = an.peer_anomalies(df).collect()
    assert [r.obs_id for r in out] == [99] and out[0].z_altitude is None


def test_peer_rows_are_not_shuffled(spark):
    """The table of one row per description is broadcast, however large the planner thinks it."""
    df = spark.range(200).selectExpr("id AS obs_id", "'x' AS icao24", "concat('D', id % 3) AS Description",
                                     "CAST(IF(id = 7, 900, id % 5) AS DOUBLE) AS velocity", "CAST(id % 7 AS DOUBLE) AS baro_altitude")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = an.peer_anomalies(df)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan, plan
        assert [r.obs_id for r in out.collect()] == [7]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_hot_aircraft_third_of_rows(spark):
    rnd = random.Random(11)
    rows = [(i, "hot" if i % 3 == 0 else f"a{i % 17}", rnd.randrange(0, 20000), float(rnd.random()))
            for i in range(1500)]
    df = spark.createDataFrame(rows, "obs_id long, icao24 string, snapshot_ts long, velocity double")
    got = an.previous_reading(df, "icao24", "snapshot_ts", "obs_id", ["velocity"], chunk_seconds=600)
    w = Window.partitionBy("icao24").orderBy("snapshot_ts", "obs_id")
    ref = {r.obs_id: r.pv for r in df.select("obs_id", F.lag("velocity").over(w).alias("pv")).collect()}
    assert {r.obs_id: r.prev_velocity for r in got.collect()} == ref


def test_hot_aircraft_is_spread_over_tasks(spark):
    # one aircraft holds a third of all rows, over ten hours of readings
    rows = [(i, "hot" if i % 3 == 0 else f"a{i % 50}", (i * 7) % 36000, 1.0) for i in range(6000)]
    df = spark.createDataFrame(rows, "obs_id long, icao24 string, snapshot_ts long, velocity double")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = an.previous_reading(df, "icao24", "snapshot_ts", "obs_id", ["velocity"], chunk_seconds=3600)
        per_task = (got.filter(F.col("icao24") == "hot").groupBy(F.spark_partition_id().alias("p")).count()
                    .collect())
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(per_task) >= 4  # the hot aircraft's ten hourly chunks land in several tasks
    assert max(r["count"] for r in per_task) < 2000
