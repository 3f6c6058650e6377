"""Enrichment (observations + airframes + aircraft types), coverage report, latest-window frame.

The aircraft-type join matches ``typecode = Designator OR icaoaircrafttype = Designator``. Written
directly, that disjunction can only run as a nested-loop join. Instead the type rows of each
designator are gathered into one list (as long as the dimension has rows for it), the list is
looked up by each of the two codes with an equi-join, and the lists are put together and unfolded.
Result rows equal the OR join's: a type row reachable through both codes appears once, a null code
is skipped, an unmatched observation survives once with nulls, several type rows per designator
multiply the observation.

A type is a property of the airframe. So when the dimensions are too large to broadcast, the types are looked
up once for each airframe (:func:`type_lists`), and the observations, the far larger table, are shuffled once,
on their key. Small dimensions are broadcast each by itself and the observations are not shuffled at all, unless
they are to be spread. Either way the lists are unfolded last: what is shuffled is observations and airframes, never
the several rows that the types make of each.

No function here runs a job; sizes are the planner's own estimates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flightlake.functions.scalar import altitude_km, climb_rate_ratio, is_present_key
from flightlake.schemas import (
    ENRICHED_AIRFRAME_COLUMNS,
    ENRICHED_COLUMNS,
    ENRICHED_OBSERVATION_COLUMNS,
    ENRICHED_TYPE_COLUMNS,
)


def with_types(rows: DataFrame, models: DataFrame, type_columns) -> DataFrame:
    """``rows`` (with both codes) LEFT JOIN type rows matching either code; a null ``Designator`` tells
    that none did."""
    return unfolded(type_lists(rows, models, type_columns))


def type_lists(rows: DataFrame, models: DataFrame, type_columns) -> DataFrame:
    """``rows`` (with both codes) and the list ``__types`` of the type rows matching either code."""
    types = (models.filter(F.col("Designator").isNotNull()).groupBy("Designator")
             .agg(F.collect_list(F.struct("Designator", *type_columns)).alias("__types")))
    first = types.select(F.col("Designator").alias("__d1"), F.col("__types").alias("__t1"))
    second = types.select(F.col("Designator").alias("__d2"), F.col("__types").alias("__t2"))
    j = (rows.join(first, F.col("typecode") == F.col("__d1"), "left")
         .join(second, F.col("icaoaircrafttype") == F.col("__d2"), "left"))
    none = F.array().cast(types.schema["__types"].dataType)
    more = F.when(F.col("typecode").eqNullSafe(F.col("icaoaircrafttype")), none).otherwise(F.coalesce("__t2", none))
    return j.select(*rows.columns, F.concat(F.coalesce("__t1", none), more).alias("__types"))


def unfolded(listed: DataFrame) -> DataFrame:
    """Each row once for each type row of its list; once, with nulls, if the list is empty or null."""
    columns = [c for c in listed.columns if c != "__types"]
    return listed.select(*columns, F.explode_outer("__types").alias("__type")).select(*columns, "__type.*")


def spread_absent(key: str, row_id: str, parts: int) -> Column:
    """Part of an absent (null or empty) key's row; 0 for every present key."""
    return F.when(is_present_key(key), F.lit(0)).otherwise(F.pmod(F.xxhash64(row_id), F.lit(parts)).cast("int"))


def join_by_aircraft(observations: DataFrame, dim: DataFrame, row_id: str = "obs_id") -> DataFrame:
    """observations LEFT JOIN dim ON icao24 (duplicates on both sides kept).

    Observations without a key may be a large share of all rows. They are dealt over as many parts as
    there are shuffle partitions; a dimension row whose own key is empty stands in each part.
    """
    parts = int(observations.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    left = observations.withColumn("__part", spread_absent("icao24", row_id, parts))
    last = F.when(is_present_key("icao24"), F.lit(0)).otherwise(F.lit(parts - 1))
    right = dim.filter(F.col("icao24").isNotNull()).withColumn("__part", F.explode(F.sequence(F.lit(0), last)))
    return left.join(right, ["icao24", "__part"], "left").drop("__part")


def broadcastable(*frames: DataFrame) -> bool:
    """Whether the planner would broadcast each of these: its estimate is within the session's threshold."""
    conf = frames[0].sparkSession._jsparkSession.sessionState().conf()
    size = lambda df: int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return all(size(df) <= conf.autoBroadcastJoinThreshold() for df in frames)


def typed_airframes(airframes: DataFrame, models: DataFrame) -> DataFrame:
    """Each airframe row with a key, once for each of its type rows (once with nulls if it has none): the
    dimension that one join attaches to observations. Repeated airframe rows stay."""
    known = airframes.select("icao24", "typecode", *ENRICHED_AIRFRAME_COLUMNS).filter(F.col("icao24").isNotNull())
    return with_types(known, models, ENRICHED_TYPE_COLUMNS).drop("typecode", "Designator")


def enrich_typed(states: DataFrame, typed: DataFrame) -> DataFrame:
    """Enriched observations from :func:`typed_airframes`, lazy or read from where it was written: one join."""
    return _derived(join_by_aircraft(states.select(*ENRICHED_OBSERVATION_COLUMNS), typed))


def enrich(states: DataFrame, airframes: DataFrame, models: DataFrame, spread: bool = False) -> DataFrame:
    """Enriched observations: 17 observation columns, 5 airframe, 4 type, 2 derived.

    ``spread``: let Spark even out the partitions by size (a rebalance at run time), for a result that is written.
    Observations are dealt before types multiply them; a shuffled join has dealt them already.
    """
    observations = states.select(*ENRICHED_OBSERVATION_COLUMNS)
    dim = airframes.select("icao24", "typecode", *ENRICHED_AIRFRAME_COLUMNS)
    if not broadcastable(airframes, models):
        listed = type_lists(dim.filter(F.col("icao24").isNotNull()), models, ENRICHED_TYPE_COLUMNS)
        return _derived(unfolded(join_by_aircraft(observations, listed.drop("typecode"))))
    if spread:
        observations = observations.hint("rebalance", "obs_id")
    return _derived(with_types(join_by_aircraft(observations, dim), models, ENRICHED_TYPE_COLUMNS))


def _derived(joined: DataFrame) -> DataFrame:
    return joined.select(
        *[c for c in ENRICHED_COLUMNS if c not in ("climb_rate_ratio", "altitude_km")],
        climb_rate_ratio().alias("climb_rate_ratio"),
        altitude_km().alias("altitude_km"),
    )


def _per_key(states: DataFrame, airframes: DataFrame, models: DataFrame) -> DataFrame:
    """Per ``icao24``: observations ``n``, rows ``m`` that enrichment makes of one of them, how many of
    these have an airframe (``m_airframe``) and a type (``m_type``). Only counts are shuffled."""
    n = states.groupBy("icao24").agg(F.count(F.lit(1)).alias("n"))
    known = airframes.select("icao24", "typecode", "icaoaircrafttype").filter(F.col("icao24").isNotNull())
    return _with_multiplicity(n, with_types(known, models, []))


def _with_multiplicity(n: DataFrame, typed: DataFrame) -> DataFrame:
    dim = (typed.groupBy("icao24")
           .agg(F.count(F.lit(1)).alias("m_airframe"), F.count("Designator").alias("m_type")))
    j = n.join(dim, "icao24", "left")
    return j.select("icao24", "n", F.coalesce("m_airframe", F.lit(1)).alias("m"),
                    F.coalesce("m_airframe", F.lit(0)).alias("m_airframe"), F.coalesce("m_type", F.lit(0)).alias("m_type"))


def coverage_parity(states: DataFrame, airframes: DataFrame, models: DataFrame) -> DataFrame:
    """Coverage of the enriched rows joined to both dimensions again (so already multiplied rows
    multiply once more), then percentages. Computed from each key's multiplicity: no join of rows."""
    k = _per_key(states, airframes, models)
    agg = k.agg(
        F.coalesce(F.sum(F.col("n") * F.col("m") * F.col("m")), F.lit(0)).alias("n_rows"),
        F.count("icao24").alias("n_aircraft"),
        F.coalesce(F.sum(F.col("n") * F.col("m") * F.col("m_airframe")), F.lit(0)).alias("n_with_airframe"),
        F.coalesce(F.sum(F.col("n") * F.col("m") * F.col("m_type")), F.lit(0)).alias("n_with_type"),
    )
    return _with_percentages(agg)


def coverage_distinct(states: DataFrame, airframes: DataFrame, models: DataFrame) -> DataFrame:
    """Corrected coverage on un-multiplied observations [ours]: each observation row counted once.
    Having an airframe or a type is a property of the key, so the fact table is only counted by key."""
    return _coverage(_per_key(states, airframes, models))


def coverage_of_counts(counts: DataFrame, typed: DataFrame) -> DataFrame:
    """As :func:`coverage_distinct`, from observations counted by key (``icao24``, ``n``) and the airframes with
    their types (``icao24``, ``Designator``)."""
    return _coverage(_with_multiplicity(counts, typed))


def _coverage(k: DataFrame) -> DataFrame:
    having = lambda c: F.coalesce(F.sum(F.when(F.col(c) > 0, F.col("n"))), F.lit(0))
    agg = k.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.count(F.when(is_present_key("icao24"), F.lit(1))).alias("n_aircraft"),
        having("m_airframe").alias("n_with_airframe"),
        having("m_type").alias("n_with_type"),
    )
    return _with_percentages(agg)


def _with_percentages(agg: DataFrame) -> DataFrame:
    total = F.nullif(F.col("n_rows"), F.lit(0)).cast("double")
    return agg.select(
        "*",
        F.round(F.col("n_with_airframe").cast("double") / total * 100.0, 6).alias("pct_with_airframe"),
        F.round(F.col("n_with_type").cast("double") / total * 100.0, 6).alias("pct_with_type"),
    )


def latest_window_end(states: DataFrame) -> DataFrame:
    """One-row frame: the greatest window end (null on an empty table)."""
    return states.agg(F.max("window_end").alias("latest_window_end"))


def latest_window_frame(states: DataFrame, airframes: DataFrame, models: DataFrame) -> DataFrame:
    """All observations of the newest window, each with its aircraft-type ``Description``.

    The newest window end is a scalar subquery, so the comparison is a plain filter: on a table
    partitioned or clustered by ``window_end`` it prunes files.
    """
    current = states.filter(F.col("window_end") == latest_window_end(states).scalar())
    dim = airframes.select("icao24", "typecode", "icaoaircrafttype")
    return with_types(join_by_aircraft(current, dim), models, ["Description"]).select(*states.columns, "Description")


def first_enriched(states: DataFrame, airframes: DataFrame, models: DataFrame, n: int) -> DataFrame:
    """The first ``n`` enriched rows by (obs_id, type name). Every observation survives enrichment, so
    these come from the first ``n`` observations, and only those are joined."""
    first = states.orderBy("obs_id").limit(n)
    return enrich(first, airframes, models).orderBy(F.col("obs_id").asc(), F.col("ModelFullName").asc_nulls_first()).limit(n)
