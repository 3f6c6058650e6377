"""Closed 3-minute windows of observations, written once per window.

source -> recency filter -> event time + watermark (grace) -> group by (window, bucket) collecting
rows -> append mode (a window is emitted once, when the watermark passes its end) -> foreachBatch:
raw rows and a per-window summary (observations, unique aircraft), each written under the
micro-batch's epoch id, so a replayed micro-batch rewrites its own output instead of duplicating it.

The reference keys every record to one constant key, so one worker holds every window. Here the
group key adds ``bucket = pmod(xxhash64(obs_id, icao24, snapshot_ts), buckets)`` (default: the
session's shuffle partitions): a window, even one holding a third of all rows, is spread over that
many state partitions. All buckets of a window
share the watermark, so they close in the same micro-batch and each window is written whole.
"""

from __future__ import annotations

import json
import logging
import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from pyspark.sql import types as T

from flightlake.functions.scalar import age_minutes, epoch_to_timestamp_ntz, is_present_key
from flightlake.schemas import OBSERVATION
from flightlake.sources import snapshots
from flightlake.sources.windows import _path as hadoop_path
from flightlake.sources.windows import path_exists, write_windows

# ---- fixed values (must equal the reference's stream settings) ----
WINDOW = "3 minutes"      # tumbling window length
GRACE = "10 seconds"      # lateness allowed after a window's end
MAX_AGE_MINUTES = 9.0     # records this old or older are dropped before windowing
# ---- end of fixed values ----
BUCKETS = None  # default: spark.sql.shuffle.partitions, so one window spreads over every state partition
log = logging.getLogger("flightlake.streaming")
# ---- fixed values: columns of a raw window ----
RAW_COLUMNS = ["obs_id", "icao24", "callsign", "origin_country", "time_position", "last_contact", "longitude",
               "latitude", "baro_altitude", "on_ground", "velocity", "true_track", "vertical_rate", "geo_altitude",
               "squawk", "spi", "position_source", "snapshot_ts"]
# ---- end of fixed values ----


def recent_only(obs: DataFrame, max_age_minutes: float = MAX_AGE_MINUTES, now=None) -> DataFrame:
    """Keep records younger than ``max_age_minutes`` (strict); a missing stamp counts as age 0.

    ``now``: epoch seconds (tests, replays); default is the time of each micro-batch.
    """
    return obs.filter(age_minutes("snapshot_ts", now) < F.lit(float(max_age_minutes)))


def windowed_rows(obs: DataFrame, window: str = WINDOW, grace: str = GRACE, buckets: int | None = BUCKETS,
                  event_time: str | None = None) -> DataFrame:
    """Streaming aggregate: one row per (window, bucket) with the list of its observations.

    ``event_time``: name of a TIMESTAMP column to use (e.g. the broker time); default is the poll
    stamp ``snapshot_ts`` as a timestamp.
    """
    cols = [c for c in RAW_COLUMNS if c in obs.columns]
    if buckets is None:
        buckets = int(obs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    et = F.col(event_time) if event_time else F.timestamp_seconds("snapshot_ts")
    s = obs.withColumn("__event_time", et).withWatermark("__event_time", grace)
    bucket = F.pmod(F.xxhash64(*[F.col(c) for c in ("obs_id", "icao24", "snapshot_ts") if c in cols]),
                    F.lit(buckets))
    return (s.groupBy(F.window("__event_time", window).alias("window"), bucket.alias("bucket"))
            .agg(F.collect_list(F.struct(*cols)).alias("rows")))


def closed_window_rows(batch: DataFrame) -> DataFrame:
    """Flatten a micro-batch of closed (window, bucket) lists into rows with window bounds
    (epoch seconds) and the window's UTC date."""
    return batch.select(
        F.unix_seconds(F.col("window.start")).alias("window_start"),
        F.unix_seconds(F.col("window.end")).alias("window_end"),
        F.inline("rows"),
    ).withColumn("window_date", F.date_format(epoch_to_timestamp_ntz("window_end"), "yyyy-MM-dd"))


def window_summary(rows: DataFrame) -> DataFrame:
    """Observations and exact unique aircraft (null and empty keys excluded) per window."""
    return rows.groupBy("window_date", "window_start", "window_end").agg(
        F.count(F.lit(1)).alias("n_obs"),
        F.countDistinct(F.when(is_present_key("icao24"), F.col("icao24"))).alias("unique_aircraft"))


def log_closed_windows(summary: DataFrame, epoch_id: int) -> None:
    """Default per-batch callback: one log line with the totals of the windows closed in the batch."""
    r = summary.agg(F.count(F.lit(1)).alias("windows"), F.sum("n_obs").alias("obs"),
                    F.min("window_start").alias("first"), F.max("window_end").alias("last")).first()
    if r["windows"]:
        log.info("batch %s closed %s window(s) [%s, %s): %s observations", epoch_id, r["windows"], r["first"],
                 r["last"], r["obs"])


def window_sink(out_root: str, on_closed: Callable[[DataFrame, int], None] | None = log_closed_windows,
                files_root: str | None = None):
    """foreachBatch function writing raw rows and summaries of the windows closed in a batch.

    Each micro-batch writes under ``batch_id=<epoch>`` with overwrite: Spark replays a failed
    batch with the same epoch and the same rows, so a replay replaces its own output exactly
    (no duplicate, no loss). Inside a batch, rows are partitioned by the window's UTC date and sorted by
    its end, so a reader of one window skips the row groups of the others. The summary is made from the written rows.
    ``on_closed(summary, epoch_id)`` runs after both writes, on the written summary (e.g. a log
    line, or a downstream refresh). With ``files_root`` all closed windows are also written there in the
    window-file layout, with one write for the batch however many windows it closes.
    """
    out_root = out_root.rstrip("/")

    def write(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        raw_path, summary_path = f"{out_root}/raw/batch_id={epoch_id}", f"{out_root}/summary/batch_id={epoch_id}"
        rows = closed_window_rows(batch).sortWithinPartitions("window_date", "window_end")
        rows.write.mode("overwrite").partitionBy("window_date").parquet(raw_path)
        rows = spark.read.schema(RAW_SCHEMA).parquet(raw_path)
        window_summary(rows).write.mode("overwrite").parquet(summary_path)
        summary = spark.read.schema(SUMMARY_SCHEMA).parquet(summary_path)
        if files_root is not None:
            write_windows(rows.drop("window_date"), files_root)
        if on_closed is not None:
            on_closed(summary, epoch_id)

    return write


def committed(action: Callable[[DataFrame, int], None], ledger: str) -> Callable[[DataFrame, int], None]:
    """``action`` as a callback that runs once for each closed window, also when a micro-batch is replayed.

    After the action its epoch is entered in the ledger, a folder of one small file for each epoch that appears in
    one step; an epoch that is entered is not acted on again. A crash between action and entry repeats the action
    with the same epoch and the same windows, so one that writes should write under its epoch and replace.
    """
    def on_closed(summary: DataFrame, epoch_id: int) -> None:
        spark = summary.sparkSession
        entry = f"{ledger.rstrip('/')}/{epoch_id:010d}"
        if path_exists(spark, entry):
            log.info("batch %s was acted on before", epoch_id)
            return
        action(summary, epoch_id)
        fs, to = hadoop_path(spark, entry)
        draft = to.suffix("-draft")
        fs.create(draft, True).close()
        fs.rename(draft, to)

    return on_closed


METRICS = "query string, batch_id bigint, n_records bigint, n_malformed bigint, n_unstamped bigint, newest bigint, watermark string"


def observed(source: DataFrame, name: str = "records") -> DataFrame:
    """``source`` with counts that Spark takes as the records pass, one set for each micro-batch."""
    malformed = F.col(snapshots.CORRUPT).isNotNull()
    return source.observe(name, F.count(F.lit(1)).alias("n_records"), F.count_if(malformed).alias("n_malformed"),
                          F.count_if(~malformed & F.col("snapshot_ts").isNull()).alias("n_unstamped"),
                          F.max("snapshot_ts").alias("newest"))


class MetricsTable(StreamingQueryListener):
    """Writes the observed counts of every micro-batch as a row of a JSON table under ``root``: a file named for
    query and micro-batch, so a replay replaces its row. ``ended`` is set when a query ends."""

    def __init__(self, spark: SparkSession, root: str, name: str = "records"):
        super().__init__()
        self.spark, self.root, self.name = spark, root.rstrip("/"), name
        self.ended = threading.Event()

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        p = event.progress
        counts = (p.observedMetrics or {}).get(self.name)
        if counts is None:
            return
        row = {"query": str(p.id), "batch_id": p.batchId, **counts.asDict(), "watermark": (p.eventTime or {}).get("watermark")}
        fs, path = hadoop_path(self.spark, f"{self.root}/{p.id}-{p.batchId:010d}.json")
        out = fs.create(path, True)
        out.write((json.dumps(row) + "\n").encode())
        out.close()

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        self.ended.set()


def read_metrics(spark: SparkSession, root: str) -> DataFrame:
    """One row for each micro-batch that brought records."""
    return spark.read.schema(METRICS).json(root).filter("n_records > 0")


class ProgressLogger(StreamingQueryListener):
    """Logs a progress line each time another ``every_rows`` input records have been processed."""

    def __init__(self, every_rows: int = 1000):
        super().__init__()
        self.every_rows = every_rows
        self.total = 0
        self.reported = 0

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        p = event.progress
        self.total += int(p.numInputRows or 0)
        if self.total // self.every_rows > self.reported:
            self.reported = self.total // self.every_rows
            log.info("query %s: %s records processed (batch %s, watermark %s)", p.name or p.id, self.total,
                     p.batchId, (p.eventTime or {}).get("watermark"))

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass


def start_window_job(spark: SparkSession, source: DataFrame, out_root: str, checkpoint: str,
                     available_now: bool = True, max_age_minutes: float | None = None, now=None,
                     buckets: int | None = BUCKETS, window: str = WINDOW, grace: str = GRACE,
                     on_closed: Callable[[DataFrame, int], None] | None = log_closed_windows,
                     files_root: str | None = None, event_time: str | None = None):
    """Start the streaming window job; returns the ``StreamingQuery``. Malformed and unstamped records are
    left out before event time is read; :func:`start_rejects_job` keeps them."""
    obs = snapshots.accepted(source) if snapshots.CORRUPT in source.columns else source
    obs = obs if max_age_minutes is None else recent_only(obs, max_age_minutes, now)
    agg = windowed_rows(obs, window, grace, buckets, event_time)
    w = (agg.writeStream.outputMode("append").foreachBatch(window_sink(out_root, on_closed, files_root))
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


def start_rejects_job(source: DataFrame, out_path: str, checkpoint: str, available_now: bool = True):
    """Append the records that the window job leaves out, with the reason, to a Parquet table."""
    w = (snapshots.rejected(source).writeStream.outputMode("append").format("parquet").option("path", out_path)
         .option("checkpointLocation", checkpoint))
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")).start()


_OBSERVED = {f.name: f.dataType for f in OBSERVATION.fields} | {n: T.TimestampNTZType() for n in ("time_position", "last_contact")}
RAW_SCHEMA = T.StructType([T.StructField("window_start", T.LongType()),
                           T.StructField("window_end", T.LongType()),
                           *[T.StructField(n, _OBSERVED[n]) for n in RAW_COLUMNS],
                           T.StructField("window_date", T.StringType())])
SUMMARY_SCHEMA = T.StructType([T.StructField("window_date", T.StringType()),
                               *[T.StructField(n, T.LongType()) for n in ("window_start", "window_end", "n_obs", "unique_aircraft")]])


def read_window_outputs(spark: SparkSession, out_root: str) -> tuple[DataFrame, DataFrame]:
    """(raw rows, summaries) written by the window job; empty tables before any window has closed."""
    out_root = out_root.rstrip("/")

    def read(name: str, schema: T.StructType) -> DataFrame:
        schema = T.StructType([*schema.fields, T.StructField("batch_id", T.IntegerType())])
        path = f"{out_root}/{name}"
        return spark.read.schema(schema).parquet(path) if path_exists(spark, path) else spark.createDataFrame([], schema)

    return read("raw", RAW_SCHEMA), read("summary", SUMMARY_SCHEMA)
