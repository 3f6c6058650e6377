"""Batch refresh: load -> enrich -> newest window -> anomalies -> chart datasets.

Each output is written as a Parquet table under ``out_root`` (a folder in the cluster-shared
storage); later steps read the written enriched table back, which also cuts the lineage, so a lost
executor never forces the joins to be recomputed. Called on a schedule (every 3 minutes in the
reference) or from ``foreachBatch`` after windows close.
"""

from __future__ import annotations

import logging
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flightlake.operators import anomalies as an
from flightlake.operators import density as dn
from flightlake.operators import enrich as en
from flightlake.operators import iforest as isf
from flightlake.operators import profiles as pf
from flightlake.sources import versions
from flightlake.sources.windows import write_table

log = logging.getLogger("flightlake.refresh")


def refresh(spark: SparkSession, states: DataFrame, airframes: DataFrame, models: DataFrame,
            out_root: str) -> DataFrame:
    """Runs the whole refresh and returns one row per written output: ``(output, rows)``."""
    out_root = out_root.rstrip("/")
    written = {}

    def put(name: str, df: DataFrame) -> DataFrame:
        path = f"{out_root}/{name}"
        t0 = time.time()
        write_table(df, path)
        log.info("refresh: wrote %s in %.2f s", name, time.time() - t0)
        written[name] = path
        return spark.read.parquet(path)

    enriched = put("enriched_aircraft_states", en.enrich(states, airframes, models, spread=True))
    put("coverage", en.coverage_distinct(states, airframes, models))
    latest = put("latest_window", en.latest_window_frame(states, airframes, models))
    labelled = put("window_anomaly_scores", isf.fit_predict(latest, keep=("callsign",)))
    put("window_anomalies", isf.anomaly_report(labelled))
    put("anomaly_map", isf.anomaly_map(labelled))
    put("envelope_rows", pf.envelope_top(pf.prepare(latest), 4))
    prepared = pf.prepare(enriched)
    put("altitude_band_counts", pf.altitude_band_counts(enriched))
    put("vertical_status", pf.vertical_status_counts(prepared))
    put("speed_histogram", pf.speed_histogram(enriched))
    put("category_profile", pf.category_profile(enriched))
    put("category_radar", pf.category_radar(enriched))
    put("flagged_anomalies", an.flagged_only(an.flag_anomalies(states)))
    put("statistical_anomalies", an.peer_anomalies(enriched))
    put("position_density", dn.kde_2d_grid(pf.position_sample(enriched), "longitude", "latitude"))
    parts = [spark.read.parquet(p).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("output"), "rows")
             for n, p in written.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def published(spark: SparkSession, root: str, job: Callable[[str], DataFrame], keep: int = 2) -> DataFrame:
    """Run a refresh ``job(folder)`` and publish all it wrote in one step; its ``(output, rows)`` is returned.

    Readers (:func:`read_published`) see the outputs of the run before or of this one, never some of each, and a run
    that fails changes nothing. The folders of the ``keep`` newest versions stay.
    """
    version = versions.begin(spark, root)
    done = job(version.folder)
    versions.commit(spark, root, version)
    versions.vacuum(spark, root, keep)
    return done


def read_published(spark: SparkSession, root: str, output: str) -> DataFrame:
    """One output of the newest published refresh."""
    version = versions.current(spark, root)
    if version is None:
        raise ValueError(f"no refresh was published at {root}")
    return spark.read.parquet(f"{version.folder}/{output}")


def refresh_window(spark: SparkSession, window: DataFrame, airframes: DataFrame, models: DataFrame,
                   out_root: str) -> DataFrame:
    """Enrichment and anomalies for one window's observations; one row per written output."""
    out_root = out_root.rstrip("/")
    names = ("enriched_aircraft_states", "window_anomaly_scores", "window_anomalies")
    write_table(en.enrich(window, airframes, models), f"{out_root}/{names[0]}")
    write_table(isf.fit_predict(window, keep=("callsign",)), f"{out_root}/{names[1]}")
    write_table(isf.anomaly_report(spark.read.parquet(f"{out_root}/{names[1]}")), f"{out_root}/{names[2]}")
    parts = [spark.read.parquet(f"{out_root}/{n}").agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(n).alias("output"), "rows") for n in names]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def newest_window_from_outputs(spark: SparkSession, window_out_root: str) -> DataFrame:
    """Rows of the newest closed window written by the window job, read with pruning.

    The newest window comes from the small per-window summary table (one row per window); the raw
    rows are then read with a partition filter on ``window_date`` and a pushed-down equality on
    ``window_end``, so only that day's files (and matching row groups) are scanned, not the history.
    """
    from flightlake.streaming.windows import read_window_outputs
    raw, summary = read_window_outputs(spark, window_out_root)
    latest = summary.agg(F.max(F.struct("window_end", "window_date")).alias("m")).first()["m"]
    if latest is None:  # no window has closed yet
        return raw.limit(0)
    return raw.filter((F.col("window_date") == F.lit(latest["window_date"]))
                      & (F.col("window_end") == F.lit(latest["window_end"])))


def refresh_from_windows(spark: SparkSession, window_out_root: str, airframes: DataFrame, models: DataFrame,
                         out_root: str) -> DataFrame:
    """Load stage fed by the stream: newest closed window written by the window job -> enrichment
    and anomalies for that window. Returns one row per written output: ``(output, rows)``."""
    window = newest_window_from_outputs(spark, window_out_root).withColumn("date", F.year(F.col("time_position")))
    return refresh_window(spark, window, airframes, models, out_root)


def refresh_from_window_files(spark: SparkSession, files_root: str, airframes: DataFrame, models: DataFrame,
                              out_root: str) -> DataFrame:
    """Load stage over window files in the ``date=YYYY/MM/DD/window_raw_*.parquet`` layout: the
    file with the greatest path is the newest window (found by a directory walk of the newest day);
    it is loaded (keeping ``date``), normalised and refreshed like a stream-written window."""
    from flightlake.sources import windows as wf
    latest = wf.latest_window_path(spark, files_root)
    if latest is None:
        raise ValueError(f"no window files under {files_root}")
    window = wf.observations_from_window_files(wf.load_window_file(spark, files_root, latest))
    return refresh_window(spark, window, airframes, models, out_root)
