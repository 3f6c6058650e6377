"""Exploratory analytics over the enriched observations: bands, distributions, category profiles.

Global statistics (min, max, counts) are computed by one aggregate and returned as scalars; only
those few numbers reach the driver, never the rows.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flightlake.functions.scalar import (
    ALT_BAND_A_LABELS,
    ALT_BAND_B_LABELS,
    WTC_ORDER,
    altitude_band_a,
    altitude_band_b,
    altitude_km_from_geo_feet,
    coerce_double,
    epoch_to_timestamp_ntz,
    hms_text,
    is_present_key,
    label_ordinal,
    vertical_status,
    vertical_status_labels,
)
from flightlake.operators.ranks import with_sum_before
from flightlake.operators.selection import first_rows

# ---- fixed values: columns that frame preparation reads as numbers, and those without which a row goes ----
PREPARE_NUMERIC = ["latitude", "longitude", "geo_altitude", "velocity", "vertical_rate"]
PREPARE_REQUIRED = ["geo_altitude", "velocity", "vertical_rate"]
# ---- end of fixed values ----
ROUND = 6


def dropna_any(df: DataFrame, cols) -> DataFrame:
    """Drop rows where any of ``cols`` is null or NaN (pandas ``dropna(subset=...)``)."""
    cond = None
    for c in cols:
        dtype = dict(df.dtypes)[c]
        ok = F.col(c).isNotNull()
        if dtype in ("double", "float"):
            ok = ok & ~F.isnan(F.col(c))
        cond = ok if cond is None else cond & ok
    return df.filter(cond)


def require_columns(df: DataFrame, cols, operator: str) -> None:
    """Plan-time guard: fail with a clear message when an input lacks a needed column."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"{operator}: input has no column(s) {missing}; available: {df.columns}")


def dense_codes(labels: DataFrame, col: str, code_col: str) -> DataFrame:
    """0-based dense rank of the distinct values of ``col`` in sorted order."""
    distinct = labels.select(col).distinct().withColumn("__one", F.lit(1).cast("long"))
    return with_sum_before(distinct, [], [col], "__one").select(col, F.col("before").cast("int").alias(code_col))


def label_dimension(spark: SparkSession, name: str, labels) -> DataFrame:
    """Small fixed dimension ``(name, <name>_order)`` for explicit category orders."""
    return spark.createDataFrame([(lab, i) for i, lab in enumerate(labels)], f"{name} string, {name}_order int")


# ---------------------------------------------------------------- frame preparation (A17)

def prepare(df: DataFrame, max_rows: int | None = None, seed: int = 42) -> DataFrame:
    """Coerce numerics, drop incomplete rows, stamp time, add fallback columns, optional sample.

    ``max_rows``: the reference names a row limit it never defines; ``None`` keeps every row. When
    set, rows are kept by smallest stable hash of ``obs_id`` (deterministic, partition-independent).
    """
    out = df
    for c in PREPARE_NUMERIC:
        if c in out.columns:
            out = out.withColumn(c, coerce_double(c))
    out = dropna_any(out, [c for c in PREPARE_REQUIRED if c in out.columns])
    if "snapshot_ts" in out.columns:
        ts_type = dict(out.dtypes)["snapshot_ts"]
        if ts_type in ("bigint", "int", "double"):
            out = out.withColumn("snapshot_time", epoch_to_timestamp_ntz(F.col("snapshot_ts").cast("long")))
    if "altitude_km" not in out.columns:
        out = out.withColumn("altitude_km", altitude_km_from_geo_feet("geo_altitude"))
    if "alt_band" not in out.columns:
        out = out.withColumn("alt_band", altitude_band_b("geo_altitude"))
    if max_rows is not None:
        out = stable_head(out, max_rows, "obs_id", seed)
    return out


# ---------------------------------------------------------------- bands (A9)

def band_counts(df: DataFrame, band_col_expr, labels, name: str = "alt_band") -> DataFrame:
    """Rows per band, including empty bands, ordered by count desc then band order."""
    spark = df.sparkSession
    counts = (df.select(band_col_expr.alias(name)).filter(F.col(name).isNotNull())
              .groupBy(name).agg(F.count(F.lit(1)).alias("n")))
    # counts has at most len(labels) rows (grouped on a label), so it is the broadcast side of a
    # right outer join that keeps every label of the dimension
    dim = label_dimension(spark, name, labels)
    return (F.broadcast(counts).join(dim, name, "right")
            .select(name, f"{name}_order", F.coalesce("n", F.lit(0)).cast("long").alias("n"))
            .orderBy(F.desc("n"), f"{name}_order"))


def altitude_band_counts(enriched: DataFrame) -> DataFrame:
    return band_counts(enriched, altitude_band_a("geo_altitude"), ALT_BAND_A_LABELS)


def altitude_band_b_counts(enriched: DataFrame) -> DataFrame:
    return band_counts(enriched, altitude_band_b("geo_altitude"), ALT_BAND_B_LABELS)


def altitude_bands(enriched: DataFrame) -> DataFrame:
    """Per-row bands A and B and the fallback feet-based altitude column."""
    return enriched.select(
        "obs_id", "geo_altitude",
        altitude_band_a("geo_altitude").alias("alt_band_a"),
        altitude_band_b("geo_altitude").alias("alt_band_b"),
        altitude_km_from_geo_feet("geo_altitude").alias("altitude_km_geo_ft"),
    )


# ---------------------------------------------------------------- vertical status (A15)

def vertical_status_counts(prepared: DataFrame, tolerance: float = 200) -> DataFrame:
    """Rows and distinct aircraft per vertical-movement status, in display order."""
    require_columns(prepared, ["vertical_rate", "icao24"], "vertical_status_counts")
    st = prepared.select(vertical_status("vertical_rate", tolerance).alias("status"), "icao24")
    agg = st.groupBy("status").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.countDistinct(F.when(is_present_key("icao24"), F.col("icao24"))).alias("n_aircraft"),
    )
    return (agg.withColumn("status_order", label_ordinal("status", vertical_status_labels(tolerance)))
            .select("status", "status_order", "n_rows", "n_aircraft").orderBy("status_order"))


def snapshot_time_label(prepared: DataFrame) -> str:
    """HH:MM:SS (UTC) of the earliest poll in the frame, or 'N/A' when there is none (the chart title
    of the vertical-movement distribution; the earliest poll makes it deterministic)."""
    first = prepared.agg(F.min("snapshot_ts").alias("t")).first()["t"]
    if first is None:
        return "N/A"
    return prepared.sparkSession.range(1).select(
        hms_text(epoch_to_timestamp_ntz(F.lit(int(first))))).first()[0]


# ---------------------------------------------------------------- histogram (A16)

def histogram(df: DataFrame, col: str, bins: int = 30) -> DataFrame:
    """Equal-width histogram over [min, max]; the last bin is closed; empty bins are kept.

    A constant column gives one bin holding every row.
    """
    return weighted_histogram(df.select(col, F.lit(1).cast("long").alias("__one")), col, "__one", bins)


def weighted_histogram(df: DataFrame, col: str, weight: str, bins: int = 30) -> DataFrame:
    """As :func:`histogram`, of values that each stand for ``weight`` rows."""
    spark = df.sparkSession
    vals = df.select(F.col(col).alias("v"), F.col(weight).alias("w")).filter(F.col("v").isNotNull() & ~F.isnan("v"))
    row = vals.agg(F.min("v").alias("lo"), F.max("v").alias("hi")).first()
    lo, hi = row["lo"], row["hi"]
    schema = "bin int, bin_lo double, bin_hi double, n long"
    if lo is None:
        return spark.createDataFrame([], schema)
    if lo == hi:
        return vals.agg(F.lit(0).alias("bin"), F.lit(lo).alias("bin_lo"), F.lit(hi).alias("bin_hi"),
                        F.sum("w").alias("n"))
    width = F.lit(hi) - F.lit(lo)
    b = F.least(F.floor((F.col("v") - F.lit(lo)) / width * F.lit(float(bins))).cast("int"), F.lit(bins - 1))
    counts = vals.select(b.alias("bin"), "w").groupBy("bin").agg(F.sum("w").alias("n"))
    dim = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    # at most ``bins`` count rows: broadcast them, keep every bin of the dimension
    return (F.broadcast(counts).join(dim, "bin", "right").select(
        "bin",
        F.round(F.lit(lo) + F.col("bin") * (F.lit(hi) - F.lit(lo)) / F.lit(float(bins)), ROUND).alias("bin_lo"),
        F.round(F.lit(lo) + (F.col("bin") + 1) * (F.lit(hi) - F.lit(lo)) / F.lit(float(bins)), ROUND).alias("bin_hi"),
        F.coalesce("n", F.lit(0)).cast("long").alias("n"),
    ).orderBy("bin"))


def speed_histogram(enriched: DataFrame, bins: int = 30) -> DataFrame:
    return histogram(enriched, "velocity", bins)


# ---------------------------------------------------------------- categories (A8, A12, W1, W2)

def top_categories(df: DataFrame, col: str, k: int = 4) -> DataFrame:
    """The ``k`` most frequent non-null values (count desc, then value) with their counts."""
    return (df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.desc("n"), col).limit(k))


def envelope_top(prepared: DataFrame, k: int = 4) -> DataFrame:
    """Velocity x geo altitude rows of the ``k`` most frequent aircraft descriptions."""
    require_columns(prepared, ["Description", "velocity", "geo_altitude"], "envelope_top")
    top = F.broadcast(top_categories(prepared, "Description", k).select("Description"))
    return prepared.join(top, "Description", "left_semi").select("obs_id", "velocity", "geo_altitude", "Description")


def category_codes(enriched: DataFrame) -> DataFrame:
    """0-based code of each description in sorted order, attached to complete rows."""
    rows = dropna_any(enriched.select("obs_id", "velocity", "geo_altitude", "Description"),
                      ["velocity", "geo_altitude", "Description"])
    return rows.join(dense_codes(rows, "Description", "desc_code"), "Description", "inner").select("obs_id", "velocity", "geo_altitude", "Description",
                                                            "desc_code")


# ---- fixed values: axes of the category profile, in order ----
PROFILE_METRICS = ["avg_velocity", "avg_altitude", "avg_climb_rate", "aircraft_count"]
# ---- end of fixed values ----


def category_profile(enriched: DataFrame) -> DataFrame:
    """Per description: mean velocity, mean geo altitude, mean climb ratio, distinct aircraft."""
    m = dropna_any(enriched.select("Description", "velocity", "geo_altitude", "climb_rate_ratio", "icao24"),
                   ["Description", "velocity", "geo_altitude", "climb_rate_ratio", "icao24"])
    return m.groupBy("Description").agg(
        F.round(F.avg("velocity"), ROUND).alias("avg_velocity"),
        F.round(F.avg("geo_altitude"), ROUND).alias("avg_altitude"),
        F.round(F.avg("climb_rate_ratio"), ROUND).alias("avg_climb_rate"),
        F.countDistinct("icao24").alias("aircraft_count"),
    )


def category_radar(enriched: DataFrame, k: int = 4) -> DataFrame:
    """Top-``k`` descriptions by distinct aircraft, each metric min-max scaled across them
    (constant metric -> 0.5), in long form with the angle of each axis and the closing point."""
    return radar_of_profile(category_profile(enriched), k)


def radar_of_profile(profile: DataFrame, k: int = 4) -> DataFrame:
    prof = profile.withColumn("aircraft_count", F.col("aircraft_count").cast("double"))
    top = prof.orderBy(F.desc("aircraft_count"), "Description").limit(k)
    w = Window.partitionBy(F.lit(0))  # at most k rows (k from the limit above)
    scaled = top
    for m in PROFILE_METRICS:
        mn, mx = F.min(m).over(w), F.max(m).over(w)
        scaled = scaled.withColumn(m + "_n", F.when(mx == mn, F.lit(0.5)).otherwise((F.col(m) - mn) / (mx - mn)))
    n = len(PROFILE_METRICS)
    pairs = []
    for i, m in enumerate(PROFILE_METRICS + PROFILE_METRICS[:1]):
        pairs.append(F.struct(F.lit(i).alias("point"), F.lit(m).alias("metric"),
                              F.round(F.col(m + "_n"), ROUND).alias("value"),
                              F.round(F.lit(2 * math.pi * (i % n) / n), ROUND).alias("angle")))
    return scaled.select("Description", F.inline(F.array(*pairs)))


# ---------------------------------------------------------------- sampling (L8, L9)

def stable_fraction(key_col: str, seed: int = 42):
    """Deterministic pseudo-random value in [0, 1) of a key: the leading 48 bits of the md5 of
    ``seed:key``. Any engine with md5 gives the same value, and a row keeps it under any partitioning."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key_col).cast("string")))
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") / F.lit(float(1 << 48))


def stable_head(df: DataFrame, n: int, key_col: str = "obs_id", seed: int = 42) -> DataFrame:
    """Exactly ``min(n, rows)`` rows: those that come first by their stable fraction (ties by key; of
    equal rows as many as there is room for). The edge is selected, not sorted for; jobs run when this is called."""
    return first_rows(df, n, stable_fraction(key_col, seed), key_col)


def hash_sample(df: DataFrame, fraction: float, key_col: str = "obs_id", seed: int = 42) -> DataFrame:
    """Keep rows whose stable fraction is below ``fraction`` (all copies of a key together)."""
    return df.filter(stable_fraction(key_col, seed) < F.lit(float(fraction)))


def position_sample(enriched: DataFrame, fraction: float = 0.3, seed: int = 42) -> DataFrame:
    coords = dropna_any(enriched.select("obs_id", "latitude", "longitude"), ["latitude", "longitude"])
    return hash_sample(coords, fraction, "obs_id", seed)


# ---------------------------------------------------------------- wake category (A14)

def wtc_supported(prepared: DataFrame, min_rows: int = 5) -> DataFrame:
    """Rows whose wake category has at least ``min_rows`` rows, with the display order."""
    require_columns(prepared, ["WTC"], "wtc_supported")
    ok = (prepared.filter(F.col("WTC").isNotNull()).groupBy("WTC").agg(F.count(F.lit(1)).alias("n"))
          .filter(F.col("n") >= min_rows).select("WTC"))
    return prepared.join(ok, "WTC", "left_semi").withColumn("wtc_order", label_ordinal("WTC", WTC_ORDER))
