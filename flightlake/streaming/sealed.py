"""Windows that are appended to as rows arrive, and sealed when they close.

The aggregate of ``streaming.windows`` holds the rows of open windows in its state and rewrites them with every
micro-batch. Here each row is written once, to files, by the micro-batch that brings it; what is carried from one
micro-batch to the next is the greatest poll stamp and one count for each open window, whatever the rows. When the
watermark (greatest stamp less the grace) passes a window's end, a seal is written: readers take the rows of sealed
windows. Rows of windows that earlier micro-batches have closed are late; they are kept apart and counted nowhere.

Every output of a micro-batch stands under its epoch and is made from the state of the epoch before, so a replayed
epoch rewrites the same files. The job has no stateful operator.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flightlake.functions.scalar import epoch_to_timestamp_ntz
from flightlake.sources import snapshots
from flightlake.sources.windows import _path, path_exists
from flightlake.streaming.windows import RAW_COLUMNS, RAW_SCHEMA, SUMMARY_SCHEMA, recent_only, window_summary

WINDOW_SECONDS, GRACE_SECONDS = 180, 10
OPEN = "window_start bigint, window_end bigint, n_obs bigint"


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p = _path(spark, path)
    out = fs.create(p, True)
    out.write(text.encode())
    out.close()


def sealing_sink(out_root: str, window_seconds: int = WINDOW_SECONDS, grace_seconds: int = GRACE_SECONDS, on_sealed=None):
    """foreachBatch function: rows appended, counts carried, closed windows sealed.

    ``on_sealed(seals, epoch_id)`` runs last, on the written seals (window_start, window_end, n_obs).
    """
    root = out_root.rstrip("/")

    def write(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        before = {"newest": None}
        if path_exists(spark, f"{root}/progress/{epoch - 1}.json"):
            before = json.loads(spark.read.text(f"{root}/progress/{epoch - 1}.json", wholetext=True).first()[0])
        mark = None if before["newest"] is None else before["newest"] - grace_seconds
        start = F.col("snapshot_ts") - F.pmod(F.col("snapshot_ts"), F.lit(window_seconds))
        rows = batch.select(*[c for c in RAW_COLUMNS if c in batch.columns], start.alias("window_start"), (start + window_seconds).alias("window_end"))
        late = F.lit(False) if mark is None else F.col("window_end") <= F.lit(mark)
        rows = rows.withColumn("window_date", F.date_format(epoch_to_timestamp_ntz("window_end"), "yyyy-MM-dd")).withColumn("late", late)
        rows.sortWithinPartitions("late", "window_date", "window_end").write.mode("overwrite").partitionBy("late", "window_date").parquet(f"{root}/rows/batch_id={epoch}")

        came = spark.read.schema(RAW_SCHEMA).parquet(f"{root}/rows/batch_id={epoch}/late=false") if path_exists(
            spark, f"{root}/rows/batch_id={epoch}/late=false") else spark.createDataFrame([], RAW_SCHEMA)
        counts = came.groupBy("window_start", "window_end").agg(F.count(F.lit(1)).alias("n_obs"))
        if path_exists(spark, f"{root}/open/epoch={epoch - 1}"):
            counts = counts.unionByName(spark.read.schema(OPEN).parquet(f"{root}/open/epoch={epoch - 1}")).groupBy(
                "window_start", "window_end").agg(F.sum("n_obs").alias("n_obs"))
        newest = came.agg(F.max("snapshot_ts")).first()[0]
        newest = max((t for t in (newest, before["newest"]) if t is not None), default=None)
        closed = F.lit(False) if newest is None else F.col("window_end") <= F.lit(newest - grace_seconds)
        counts.filter(~closed).write.mode("overwrite").parquet(f"{root}/open/epoch={epoch}")
        counts.filter(closed).write.mode("overwrite").parquet(f"{root}/seals/batch_id={epoch}")
        _write_text(spark, f"{root}/progress/{epoch}.json", json.dumps({"newest": newest}))
        fs, old = _path(spark, f"{root}/open/epoch={epoch - 2}")
        fs.delete(old, True)  # a replay needs the epoch before its own and no earlier one
        if on_sealed is not None:
            on_sealed(spark.read.schema(OPEN).parquet(f"{root}/seals/batch_id={epoch}"), epoch)

    return write


def start_sealing_job(source: DataFrame, out_root: str, checkpoint: str, available_now: bool = True, max_age_minutes: float | None = None,
                      now=None, window_seconds: int = WINDOW_SECONDS, grace_seconds: int = GRACE_SECONDS, on_sealed=None):
    """Start the job on decoded records; malformed and unstamped ones are left out."""
    obs = snapshots.accepted(source) if snapshots.CORRUPT in source.columns else source
    obs = obs if max_age_minutes is None else recent_only(obs, max_age_minutes, now)
    w = obs.writeStream.foreachBatch(sealing_sink(out_root, window_seconds, grace_seconds, on_sealed)).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


def read_sealed(spark: SparkSession, out_root: str) -> DataFrame:
    """Rows of the sealed windows; an empty table before any has closed."""
    root = out_root.rstrip("/")
    if not path_exists(spark, f"{root}/seals"):
        return spark.createDataFrame([], RAW_SCHEMA)
    seals = spark.read.schema(OPEN + ", batch_id int").parquet(f"{root}/seals").select("window_end").distinct()
    rows = spark.read.schema(T.StructType([*RAW_SCHEMA.fields, T.StructField("late", T.BooleanType())])).parquet(f"{root}/rows")
    return rows.filter(~F.col("late")).drop("late", "batch_id").join(seals, "window_end", "left_semi")


def sealed_summary(spark: SparkSession, out_root: str) -> DataFrame:
    """Observations and unique aircraft of each sealed window."""
    return window_summary(read_sealed(spark, out_root)).select(*SUMMARY_SCHEMA.names)
