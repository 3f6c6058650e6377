"""A refresh whose work follows the new windows, not the history.

What the outputs need of the past is kept as mergeable partial aggregates: counts, sums, distinct keys and, for
the rules on consecutive readings, each aircraft's last reading. Every run reads the windows that have closed
since the run before, enriches and aggregates these alone, merges the result into the state and commits state,
new rows and outputs as one version (``sources.versions``). A run that fails leaves the version before; the next
one takes the same windows again.

The state holds one row for each value, key or category that has ever occurred, not for each observation.
Enriched rows and flagged anomalies are appended under the number of the run that made them; readers take the
runs up to the committed one. Outputs of the newest window only come from its rows. Two outputs of the full
refresh are left to it: peer anomalies and the position density judge every old row anew when the mean or the
bandwidth moves.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flightlake.functions.scalar import (
    ALT_BAND_A_LABELS, altitude_band_a, is_present_key, label_ordinal, vertical_status, vertical_status_labels,
)
from flightlake.operators import anomalies as an
from flightlake.operators import enrich as en
from flightlake.operators import profiles as pf
from flightlake.sources import versions
from flightlake.sources.windows import path_exists

#: State tables, and how rows of one key become one: columns not named are the key.
STATE = {
    "aircraft": {"n": F.sum},                                     # observations of each key
    "bands": {"n": F.sum},                                        # enriched rows of each altitude band
    "status": {"n": F.sum},                                       # prepared rows of each vertical status
    "status_aircraft": {},                                        # aircraft seen in each status
    "speeds": {"n": F.sum},                                       # enriched rows of each velocity
    "profile": {"n": F.sum, "velocity": F.sum, "altitude": F.sum, "climb": F.sum},
    "profile_aircraft": {},                                       # aircraft of each description
    "last_reading": {"last": F.max},                              # of each aircraft
}
PROFILED = ["Description", "velocity", "geo_altitude", "climb_rate_ratio", "icao24"]


def _partials(states: DataFrame, enriched: DataFrame) -> dict[str, DataFrame]:
    """The state that these rows alone would leave."""
    count = F.count(F.lit(1)).alias("n")
    prepared = pf.prepare(enriched).select(vertical_status("vertical_rate").alias("status"), "icao24")
    profiled = pf.dropna_any(enriched.select(*PROFILED), PROFILED)
    speeds = enriched.select("velocity").filter(F.col("velocity").isNotNull() & ~F.isnan("velocity"))
    reading = F.struct("snapshot_ts", "obs_id", "velocity", "baro_altitude")
    return {
        "aircraft": states.groupBy("icao24").agg(count),
        "bands": enriched.select(altitude_band_a("geo_altitude").alias("alt_band")).filter("alt_band IS NOT NULL").groupBy("alt_band").agg(count),
        "status": prepared.groupBy("status").agg(count),
        "status_aircraft": prepared.filter(is_present_key("icao24")).distinct(),
        "speeds": speeds.groupBy("velocity").agg(count),
        "profile": profiled.groupBy("Description").agg(count, F.sum("velocity").alias("velocity"), F.sum("geo_altitude").alias("altitude"),
                                                       F.sum("climb_rate_ratio").alias("climb")),
        "profile_aircraft": profiled.select("Description", "icao24").distinct(),
        "last_reading": states.filter(is_present_key("icao24")).groupBy("icao24").agg(F.max(reading).alias("last")),
    }


def merge(name: str, parts: list[DataFrame]) -> DataFrame:
    """One state table from several, in any order and grouping."""
    whole = reduce(DataFrame.unionByName, parts)
    values = STATE[name]
    keys = [c for c in whole.columns if c not in values]
    if not values:
        return whole.distinct()
    return whole.groupBy(*keys).agg(*[how(c).alias(c) for c, how in values.items()])


def _outputs(state: dict[str, DataFrame], airframes: DataFrame, models: DataFrame) -> dict[str, DataFrame]:
    """The chart tables, from the state alone."""
    spark = state["bands"].sparkSession
    known = en.with_types(airframes.select("icao24", "typecode", "icaoaircrafttype").filter("icao24 IS NOT NULL"), models, [])
    bands = pf.label_dimension(spark, "alt_band", ALT_BAND_A_LABELS).join(state["bands"], "alt_band", "left")
    labels = vertical_status_labels()
    per_status = state["status_aircraft"].groupBy("status").agg(F.count(F.lit(1)).alias("n_aircraft"))
    per_category = state["profile_aircraft"].groupBy("Description").agg(F.count(F.lit(1)).alias("aircraft_count"))
    mean = lambda c, name: F.round(F.col(c) / F.col("n"), pf.ROUND).alias(name)
    profile = state["profile"].join(per_category, "Description").select(
        "Description", mean("velocity", "avg_velocity"), mean("altitude", "avg_altitude"), mean("climb", "avg_climb_rate"), "aircraft_count")
    return {
        "coverage": en.coverage_of_counts(state["aircraft"], known),
        "altitude_band_counts": bands.select("alt_band", "alt_band_order", F.coalesce("n", F.lit(0)).cast("long").alias("n")),
        "vertical_status": state["status"].join(per_status, "status", "left").select(
            "status", label_ordinal("status", labels).alias("status_order"), F.col("n").alias("n_rows"),
            F.coalesce("n_aircraft", F.lit(0)).alias("n_aircraft")),
        "speed_histogram": pf.weighted_histogram(state["speeds"], "velocity", "n"),
        "category_profile": profile,
        "category_radar": pf.radar_of_profile(profile),
    }


def _flags(states: DataFrame, last: DataFrame | None) -> DataFrame:
    """Flags of these readings; each aircraft's first one follows the last reading of the runs before."""
    columns = ["obs_id", "icao24", "snapshot_ts", "velocity", "baro_altitude", "vertical_rate"]
    rows = states.select(*columns, F.lit(True).alias("__new"))
    if last is not None:
        # Only aircraft that were seen again are asked for; the window's keys are far fewer than all.
        seen = states.filter(is_present_key("icao24")).select("icao24").distinct()
        before = last.join(seen, "icao24", "left_semi").select("last.obs_id", "icao24", "last.snapshot_ts", "last.velocity", "last.baro_altitude",
                                                               F.lit(None).cast("double").alias("vertical_rate"), F.lit(False).alias("__new"))
        rows = rows.unionByName(before)
    flags = an.flag_anomalies(rows, keep=("__new",))
    return an.flagged_only(flags).filter("__new").drop("__new")


def refresh_new_windows(spark: SparkSession, states: DataFrame, airframes: DataFrame, models: DataFrame, root: str) -> versions.Version | None:
    """Take the closed windows of ``states`` that no run has taken yet; None if there are none.

    ``states`` holds every closed window (its readers prune by ``window_end``); windows close in order, and a run
    takes those that end after the newest one taken. The dimensions are read anew by each run: rows enriched
    before a dimension changed keep what they had, as a table that is appended to does.
    """
    root = root.rstrip("/")
    last = versions.current(spark, root)
    done = last.facts["window_end"] if last else None
    new = states if done is None else states.filter(F.col("window_end") > F.lit(done))
    newest = new.agg(F.max("window_end")).first()[0]
    if newest is None:
        return None
    version = versions.begin(spark, root)
    new = new.filter(F.col("window_end") <= F.lit(newest))

    put = lambda df, name: df.write.mode("overwrite").parquet(f"{version.folder}/{name}")
    put(en.enrich(new, airframes, models), "enriched_aircraft_states")
    enriched = spark.read.parquet(f"{version.folder}/enriched_aircraft_states")
    here = lambda v, name: spark.read.parquet(f"{v.folder}/state/{name}") if v else None
    for name, partial in _partials(new, enriched).items():
        put(merge(name, [partial, here(last, name)] if last else [partial]), f"state/{name}")
    put(_flags(new, here(last, "last_reading")), "flagged_anomalies")
    put(en.latest_window_frame(new, airframes, models), "latest_window")
    for name, output in _outputs({n: here(version, n) for n in STATE}, airframes, models).items():
        put(output, name)
    return versions.commit(spark, root, version, window_end=newest, rows=new.count())


APPENDED = ("enriched_aircraft_states", "flagged_anomalies")


def read_output(spark: SparkSession, root: str, name: str) -> DataFrame:
    """An output as of the newest committed run: appended tables are the rows of all runs."""
    runs = versions.history(spark, root)
    if not runs:
        raise ValueError(f"no run has been committed at {root}")
    folders = [v.folder for v in (runs if name in APPENDED else runs[-1:])]
    return spark.read.parquet(*[f"{f}/{name}" for f in folders if path_exists(spark, f"{f}/{name}")])
