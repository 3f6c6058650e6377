"""Telemetry-shaped views derived from the driver tables [ours].

The driver tables carry no telemetry, so every query reads these views, built with integer
arithmetic on whole tables (no row is dropped; some keys are derived as null to model missing
dimension data):

* ``states``    from ``events``   - one observation per event, with its 3-minute window (epoch seconds)
* ``airframes`` from ``customer`` - airframe dimension keyed by ``icao24``
* ``models``    from ``supplier`` - aircraft-type dimension keyed by ``Designator`` (4 rows per designator)

The same derivations are written as SQL for the DuckDB oracle in ``flightlake.plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flightlake.functions.scalar import epoch_seconds_ntz

WINDOW_SECONDS = 180


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def states_from_events(events: DataFrame, window_seconds: int = WINDOW_SECONDS) -> DataFrame:
    eid = F.col("event_id")
    snap = epoch_seconds_ntz("ts")
    df = events.select(
        eid.alias("obs_id"),
        F.when(eid % 211 == 0, F.lit("")).otherwise(F.col("user_id").cast("string")).alias("icao24"),
        F.concat(F.upper("event_type"), F.col("user_id").cast("string")).alias("callsign"),
        F.col("event_type").alias("origin_country"),
        F.col("ts").alias("time_position"),
        F.col("ts").alias("last_contact"),
        (((eid * 193) % 36001).cast("double") / 100.0 - 180.0).alias("longitude"),
        (((eid * 97) % 18001).cast("double") / 100.0 - 90.0).alias("latitude"),
        F.when(eid % 13 == 0, F.lit(None).cast("double"))
         .otherwise(((eid * 7919) % 13000 - 500).cast("double")).alias("baro_altitude"),
        (((eid * 7919) % 13000) < 500).alias("on_ground"),
        F.when(eid % 17 == 0, F.lit(None).cast("double")).otherwise(F.col("value")).alias("velocity"),
        (((eid * 37) % 36000).cast("double") / 100.0).alias("true_track"),
        ((((eid * 31) % 4001) - 2000).cast("double") / 4.0).alias("vertical_rate"),
        (((eid * 7919) % 62000) - 500).cast("double").alias("geo_altitude"),
        F.lpad(((eid * 7) % 7777).cast("string"), 4, "0").alias("squawk"),
        (F.col("event_type") == "error").alias("spi"),
        (eid % 4).cast("int").alias("position_source"),
        snap.alias("snapshot_ts"),
        F.year("ts").alias("date"),
    )
    start = F.col("snapshot_ts") - F.pmod(F.col("snapshot_ts"), F.lit(window_seconds))
    return df.withColumn("window_start", start).withColumn("window_end", start + F.lit(window_seconds))


def airframes_from_customer(customer: DataFrame) -> DataFrame:
    key = F.col("c_custkey")
    return customer.select(
        F.when(key % 5 == 0, F.lit(None).cast("string")).otherwise(key.cast("string")).alias("icao24"),
        F.col("c_name").alias("registration"),
        F.col("c_mktsegment").alias("model"),
        F.when(key % 11 == 0, F.lit(None).cast("string"))
         .otherwise(F.col("c_nationkey").cast("string")).alias("typecode"),
        (key % 40).cast("string").alias("icaoaircrafttype"),
        F.col("c_mktsegment").alias("operator"),
        F.substring("c_mktsegment", 1, 3).alias("operatoricao"),
    )


def models_from_supplier(supplier: DataFrame) -> DataFrame:
    key = F.col("s_suppkey")
    return supplier.select(
        F.expr("s_suppkey div 4").cast("string").alias("Designator"),
        F.col("s_name").alias("ModelFullName"),
        F.when(key % 3 == 0, F.lit("LandPlane")).when(key % 3 == 1, F.lit("Helicopter"))
         .otherwise(F.lit("Amphibian")).alias("AircraftDescription"),
        F.concat(F.lit("D"), (key % 7).cast("string")).alias("Description"),
        F.when(key % 4 == 0, F.lit("Heavy")).when(key % 4 == 1, F.lit("Medium"))
         .when(key % 4 == 2, F.lit("Light")).alias("WTC"),
    )


def states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return states_from_events(read_table(spark, sf_dir, "events"))


def recent_states(spark: SparkSession, sf_dir: str, seconds: int = WINDOW_SECONDS) -> DataFrame:
    """Observations of the last ``seconds`` and more: a filter on the raw time column by a scalar subquery,
    which reaches the scan, for queries that look at the newest window or the recent past only."""
    events = read_table(spark, sf_dir, "events")
    since = events.select((F.max("ts") - F.expr(f"INTERVAL {int(seconds) + 1} SECONDS")).alias("since"))
    return states_from_events(events.filter(F.col("ts") >= since.scalar()))


def airframes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return airframes_from_customer(read_table(spark, sf_dir, "customer"))


def models(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models_from_supplier(read_table(spark, sf_dir, "supplier"))
