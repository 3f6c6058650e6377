"""Rule-based anomaly tables [ours: the reference reads these tables but never defines them].

* flagged anomalies: change between consecutive readings of one aircraft (velocity and altitude
  rates) and an implausible climb, each a boolean column; the report keeps rows with any flag.
* peer anomalies: z-score of velocity and barometric altitude within the aircraft's description.

Per-aircraft ordering uses windows partitioned by (aircraft, time chunk), so one aircraft that
holds a large share of all rows is spread over many tasks; the previous reading across a chunk
boundary comes from a small per-chunk summary joined back on the same keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flightlake.functions.scalar import climb_rate_ratio, is_present_key

# Rule parameters (SI units): velocity change rate m/s^2, altitude change rate m/s, vertical rate m/s.
MAX_ACCELERATION = 15.0
MAX_ALTITUDE_RATE = 100.0
MAX_VERTICAL_RATE = 50.0
MAX_CLIMB_RATIO = 1.0
CHUNK_SECONDS = 3600
PEER_MIN_ROWS = 5
PEER_Z = 3.0
ROUND = 6


def previous_reading(df: DataFrame, key: str, ts: str, tiebreak: str, cols: list[str],
                     chunk_seconds: int = CHUNK_SECONDS) -> DataFrame:
    """Adds ``prev_<c>`` for ``c`` in ``cols + [ts]``: the previous row of the same key ordered by
    ``(ts, tiebreak)``. Rows whose key is null or empty have no previous reading."""
    tracked = cols + [ts]
    present = is_present_key(key)
    # rows without a key get no answer: any spread will do, and it keeps them from one task
    d = df.withColumn("__chunk", F.when(present, F.floor(F.col(ts) / F.lit(chunk_seconds)))
                      .otherwise(F.xxhash64(tiebreak)))
    w = Window.partitionBy(key, "__chunk").orderBy(ts, tiebreak)
    for c in tracked:
        d = d.withColumn(f"__lag_{c}", F.lag(c).over(w))
    d = d.withColumn("__first", F.row_number().over(w) == 1)
    d = d.withColumn("__last", F.lead(F.lit(1)).over(w).isNull())  # same window: no extra shuffle
    last = d.filter(F.col("__last") & present).select(key, "__chunk", F.struct(*[F.col(c).alias(f"__v_{c}") for c in tracked])
                                     .alias("__last"))
    wc = Window.partitionBy(key).orderBy("__chunk")  # one row per (key, chunk)
    prev_chunk = last.select(key, "__chunk", F.lag("__last").over(wc).alias("__prev_last"))
    d = d.drop("__last").join(prev_chunk, [key, "__chunk"], "left")
    for c in tracked:
        v = F.when(F.col("__first"), F.col(f"__prev_last.__v_{c}")).otherwise(F.col(f"__lag_{c}"))
        d = d.withColumn(f"prev_{c}", F.when(present, v))
    return d.drop("__chunk", "__first", "__prev_last", *[f"__lag_{c}" for c in tracked])


def flag_anomalies(states: DataFrame, max_acceleration: float = MAX_ACCELERATION,
                   max_altitude_rate: float = MAX_ALTITUDE_RATE, max_vertical_rate: float = MAX_VERTICAL_RATE,
                   max_climb_ratio: float = MAX_CLIMB_RATIO, chunk_seconds: int = CHUNK_SECONDS,
                   keep: tuple[str, ...] = ()) -> DataFrame:
    """Every observation with the three boolean flags (never null); ``keep`` names further columns to carry."""
    base = states.select("obs_id", "icao24", "snapshot_ts", "velocity", "baro_altitude", "vertical_rate", *keep)
    d = previous_reading(base, "icao24", "snapshot_ts", "obs_id", ["velocity", "baro_altitude"], chunk_seconds)
    dt = (F.col("snapshot_ts") - F.col("prev_snapshot_ts")).cast("double")
    ok_dt = dt.isNotNull() & (dt > 0)
    sudden = ok_dt & (F.abs(F.col("velocity") - F.col("prev_velocity")) / dt > F.lit(max_acceleration))
    jump = ok_dt & (F.abs(F.col("baro_altitude") - F.col("prev_baro_altitude")) / dt > F.lit(max_altitude_rate))
    climb = ((F.abs(F.col("vertical_rate")) > F.lit(max_vertical_rate))
             | (climb_rate_ratio() > F.lit(max_climb_ratio)))
    return d.select(
        "obs_id", "icao24", "snapshot_ts", "velocity", "baro_altitude", "vertical_rate",
        dt.cast("long").alias("dt_seconds"),
        F.coalesce(sudden, F.lit(False)).alias("sudden_velocity_anomaly"),
        F.coalesce(climb, F.lit(False)).alias("unrealistic_climb_anomaly"),
        F.coalesce(jump, F.lit(False)).alias("altitude_jump_anomaly"), *keep,
    )


def flagged_only(flags: DataFrame) -> DataFrame:
    """Rows with any flag set (a null flag counts as false)."""
    return flags.filter(F.col("sudden_velocity_anomaly") | F.col("unrealistic_climb_anomaly")
                        | F.col("altitude_jump_anomaly"))


def peer_anomalies(enriched: DataFrame, min_rows: int = PEER_MIN_ROWS, z: float = PEER_Z) -> DataFrame:
    """Rows whose velocity or barometric altitude lies more than ``z`` sample standard deviations
    from the mean of their description (groups of at least ``min_rows`` rows).

    Group statistics are a partial (map-side) aggregate; the small per-description table is broadcast
    back to the rows, which are not shuffled, never a window over a whole description.
    """
    rows = enriched.filter(F.col("Description").isNotNull()).select(
        "obs_id", "icao24", "Description", "velocity", "baro_altitude")
    stats = rows.groupBy("Description").agg(
        F.count(F.lit(1)).alias("peer_rows"),
        F.avg("velocity").alias("mu_v"), F.stddev_samp("velocity").alias("sd_v"),
        F.avg("baro_altitude").alias("mu_a"), F.stddev_samp("baro_altitude").alias("sd_a"),
    ).filter(F.col("peer_rows") >= min_rows)
    # one row per description, a short code list; the planner takes an aggregate to be as large as its input
    j = rows.join(F.broadcast(stats), "Description", "inner")
    zv = F.when(F.col("sd_v") > 0, (F.col("velocity") - F.col("mu_v")) / F.col("sd_v"))
    za = F.when(F.col("sd_a") > 0, (F.col("baro_altitude") - F.col("mu_a")) / F.col("sd_a"))
    out = j.select("obs_id", "icao24", "Description", "velocity", "baro_altitude", "peer_rows",
                   zv.alias("z_velocity"), za.alias("z_altitude"))
    out = out.filter((F.abs("z_velocity") > F.lit(z)) | (F.abs("z_altitude") > F.lit(z)))
    return out.withColumn("z_velocity", F.round("z_velocity", ROUND)).withColumn("z_altitude",
                                                                                 F.round("z_altitude", ROUND))
