"""Scalar column expressions.

All functions build ``Column`` objects from built-ins, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "ALT_BAND_A_EDGES", "ALT_BAND_A_LABELS", "ALT_BAND_B_EDGES", "ALT_BAND_B_LABELS",
    "LEVEL_TOLERANCE", "WTC_ORDER", "vertical_status_labels",
    "nan_to_null", "climb_rate_ratio", "altitude_km", "altitude_km_from_geo_feet",
    "altitude_band_a", "altitude_band_b", "vertical_status", "vertical_status_order",
    "coerce_double", "epoch_seconds_ntz", "epoch_to_timestamp", "text_to_timestamp",
    "text_to_timestamp_ntz", "epoch_to_timestamp_ntz", "epoch_millis_to_timestamp_ntz",
    "iso_text", "hms_text", "window_key", "anomaly_label", "age_minutes", "is_present_key",
    "label_ordinal",
]

# ---- fixed values (must equal the reference's bins, labels and constants) ----
# Altitude band A: right-closed bins over geo altitude; values outside (0, 60000] get no band.
ALT_BAND_A_EDGES = [0, 3000, 10000, 30000, 60000]
ALT_BAND_A_LABELS = ["Low (0-3k)", "Climb (3-10k)", "Cruise Low (10-30k)", "High (30k+)"]
# Altitude band B: right-closed bins, lowest edge included.
ALT_BAND_B_EDGES = [0, 10000, 25000, 45000]
ALT_BAND_B_LABELS = ["Low", "Mid", "High"]
# Vertical movement: tolerance for level flight, ft/min; display order of the three labels.
LEVEL_TOLERANCE = 200
# Wake-category display order.
WTC_ORDER = ["Heavy", "Medium", "Light"]
# Feet -> km factor used by the fallback altitude column.
FEET_TO_KM = 0.0003048
# Labels of the forest's output: 1 is normal, -1 is an anomaly.
NORMAL_LABEL = "Normal"
ANOMALY_LABEL = "Anomaly"
# Window file key, built from the window end: prefix/date=YYYY/MM/DD/window_raw_YYYYMMDDTHHMMSS.parquet
WINDOW_FILE_PREFIX = "processed"
WINDOW_FILE_DATE_FORMAT = "yyyy/MM/dd"
WINDOW_FILE_STAMP_FORMAT = "yyyyMMdd'T'HHmmss"
# ---- end of fixed values ----


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c) -> Column:
    """NaN -> null (missing values are normalised to null before serialising)."""
    c = _c(c)
    return F.when(F.isnan(c), F.lit(None).cast("double")).otherwise(c)


def climb_rate_ratio(vertical_rate="vertical_rate", velocity="velocity", baro_altitude="baro_altitude") -> Column:
    """|vertical_rate| / velocity when velocity > 0 and baro_altitude > 0, else null."""
    vr, v, a = _c(vertical_rate), _c(velocity), _c(baro_altitude)
    return F.when((v > 0) & (a > 0), F.abs(vr) / v)


def altitude_km(baro_altitude="baro_altitude") -> Column:
    """Barometric altitude in km when present and positive, else null."""
    a = _c(baro_altitude)
    return F.when(a > 0, a / F.lit(1000.0))


def altitude_km_from_geo_feet(geo_altitude="geo_altitude") -> Column:
    """Fallback altitude column: geo altitude times the feet->km factor."""
    return _c(geo_altitude) * F.lit(FEET_TO_KM)


def _right_closed_bins(x: Column, edges, labels, include_lowest: bool) -> Column:
    """pandas.cut semantics: (e0, e1], (e1, e2], ...; NaN/null/out of range -> null."""
    x = F.when(~F.isnan(x), x)
    expr = None
    for i, label in enumerate(labels):
        lo, hi = edges[i], edges[i + 1]
        lower_ok = (x >= F.lit(lo)) if (include_lowest and i == 0) else (x > F.lit(lo))
        cond = lower_ok & (x <= F.lit(hi))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr


def altitude_band_a(geo_altitude="geo_altitude") -> Column:
    return _right_closed_bins(_c(geo_altitude), ALT_BAND_A_EDGES, ALT_BAND_A_LABELS, include_lowest=False)


def altitude_band_b(geo_altitude="geo_altitude") -> Column:
    return _right_closed_bins(_c(geo_altitude), ALT_BAND_B_EDGES, ALT_BAND_B_LABELS, include_lowest=True)


def vertical_status_labels(tolerance: float = LEVEL_TOLERANCE) -> list[str]:
    """Labels in display order: climbing, level, descending."""
    t = f"{tolerance:g}"
    return [f"Climbing (>+{t} ft/min)", f"Level/Holding (±{t} ft/min)", f"Descending (<-{t} ft/min)"]


def vertical_status(vertical_rate="vertical_rate", tolerance: float = LEVEL_TOLERANCE) -> Column:
    """Strict bounds; null and NaN are level (Spark orders NaN above every number, so guard it)."""
    vr = _c(vertical_rate)
    climb, level, desc = vertical_status_labels(tolerance)
    ok = vr.isNotNull() & ~F.isnan(vr)
    return (F.when(ok & (vr > F.lit(float(tolerance))), F.lit(climb))
            .when(ok & (vr < F.lit(-float(tolerance))), F.lit(desc))
            .otherwise(F.lit(level)))


def vertical_status_order(status="status", tolerance: float = LEVEL_TOLERANCE) -> Column:
    return label_ordinal(status, vertical_status_labels(tolerance))


def label_ordinal(c, labels) -> Column:
    """Position of a label in an explicit category order (null if absent)."""
    c = _c(c)
    expr = None
    for i, label in enumerate(labels):
        expr = F.when(c == F.lit(label), F.lit(i)) if expr is None else expr.when(c == F.lit(label), F.lit(i))
    return expr


def coerce_double(c) -> Column:
    """Coerce to DOUBLE; anything that cannot be read as a number becomes null (no job failure)."""
    return _c(c).try_cast("double")


def epoch_seconds_ntz(ts) -> Column:
    """Whole epoch seconds (floor) of a TIMESTAMP_NTZ, independent of the session time zone."""
    return F.timestamp_diff("SECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"), _c(ts))


def epoch_millis_to_timestamp_ntz(c) -> Column:
    """Epoch milliseconds (window bounds of the stream engine) -> TIMESTAMP_NTZ, UTC wall-clock."""
    return F.timestamp_add("MILLISECOND", _c(c), F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"))


def epoch_to_timestamp(c) -> Column:
    """Epoch seconds -> TIMESTAMP."""
    return F.timestamp_seconds(_c(c))


def text_to_timestamp(c) -> Column:
    """ISO text -> TIMESTAMP; unparsable text becomes null."""
    return F.try_to_timestamp(_c(c))


def text_to_timestamp_ntz(c) -> Column:
    """ISO text -> TIMESTAMP_NTZ holding the UTC wall-clock; unparsable text becomes null.

    Text with an explicit offset (``+02:00``, ``Z``) is read as an instant and shifted to UTC;
    text without one is taken as UTC wall-clock. Neither path depends on the session time zone.
    """
    c = _c(c)
    has_offset = c.rlike(r"(Z|[+-][0-9]{2}:?[0-9]{2})$")
    instant_utc = F.timestamp_add("MICROSECOND", F.unix_micros(c.try_cast("timestamp")),
                                  F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"))
    return F.when(has_offset, instant_utc).otherwise(c.try_cast("timestamp_ntz"))


def epoch_to_timestamp_ntz(c) -> Column:
    """Epoch seconds -> TIMESTAMP_NTZ in UTC wall-clock, independent of the session time zone."""
    return F.timestamp_add("SECOND", _c(c), F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"))


def iso_text(c) -> Column:
    """Timestamp -> ISO-8601 text (microseconds kept)."""
    return F.date_format(_c(c), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def hms_text(c) -> Column:
    return F.date_format(_c(c), "HH:mm:ss")


def window_key(window_end, prefix: str = WINDOW_FILE_PREFIX) -> Column:
    """Object key of a window file, built from the window end: date=YYYY/MM/DD/window_raw_YYYYMMDDTHHMMSS.parquet."""
    we = _c(window_end)
    return F.format_string("%s/date=%s/window_raw_%s.parquet", F.lit(prefix),
                           F.date_format(we, WINDOW_FILE_DATE_FORMAT), F.date_format(we, WINDOW_FILE_STAMP_FORMAT))


def anomaly_label(label="anomaly") -> Column:
    """1 -> Normal, -1 -> Anomaly."""
    c = _c(label)
    return F.when(c == -1, F.lit(ANOMALY_LABEL)).when(c == 1, F.lit(NORMAL_LABEL))


def age_minutes(snapshot_ts="snapshot_ts", now: Column | int | None = None) -> Column:
    """(now - snapshot_ts) / 60 in minutes; a missing stamp counts as age 0."""
    now_c = F.unix_timestamp() if now is None else (now if isinstance(now, Column) else F.lit(int(now)))
    return (now_c - F.coalesce(_c(snapshot_ts), now_c)).cast("double") / F.lit(60.0)


def is_present_key(c) -> Column:
    """Truthiness of a text key: null and empty string are both absent."""
    c = _c(c)
    return c.isNotNull() & (c != F.lit(""))
