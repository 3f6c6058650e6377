"""Explicit schemas. Nothing is inferred at read time."""

from __future__ import annotations

from pyspark.sql import types as T

# Observation as landed by the snapshot producer (one JSON object per aircraft per poll).
OBSERVATION = T.StructType([
    T.StructField("icao24", T.StringType()),
    T.StructField("callsign", T.StringType()),
    T.StructField("origin_country", T.StringType()),
    T.StructField("time_position", T.StringType()),
    T.StructField("last_contact", T.StringType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("baro_altitude", T.DoubleType()),
    T.StructField("on_ground", T.BooleanType()),
    T.StructField("velocity", T.DoubleType()),
    T.StructField("true_track", T.DoubleType()),
    T.StructField("vertical_rate", T.DoubleType()),
    T.StructField("sensors", T.ArrayType(T.IntegerType())),
    T.StructField("geo_altitude", T.DoubleType()),
    T.StructField("squawk", T.StringType()),
    T.StructField("spi", T.BooleanType()),
    T.StructField("position_source", T.IntegerType()),
    T.StructField("snapshot_ts", T.LongType()),
    T.StructField("obs_id", T.LongType()),
])

# ---- fixed values: raw API field names and the observation names they are landed under ----
API_RENAMES = {
    "icao24": "icao24",
    "callsign": "callsign",
    "origin_country": "origin_country",
    "timestamp": "time_position",
    "last_position": "last_contact",
    "longitude": "longitude",
    "latitude": "latitude",
    "altitude": "baro_altitude",
    "onground": "on_ground",
    "groundspeed": "velocity",
    "track": "true_track",
    "vertical_rate": "vertical_rate",
    "sensors": "sensors",
    "geoaltitude": "geo_altitude",
    "squawk": "squawk",
    "spi": "spi",
    "position_source": "position_source",
}
# ---- end of fixed values ----

AIRFRAME = T.StructType([
    T.StructField(name, T.StringType())
    for name in ["icao24", "registration", "model", "typecode", "icaoaircrafttype", "operator", "operatoricao"]
])

AIRCRAFT_TYPE = T.StructType([
    T.StructField(name, T.StringType())
    for name in ["Designator", "ModelFullName", "AircraftDescription", "Description", "WTC"]
])

# ---- fixed values: columns of the enriched table, in output order, and the Isolation Forest features ----
ENRICHED_OBSERVATION_COLUMNS = [
    "obs_id", "icao24", "origin_country", "time_position", "last_contact", "longitude", "latitude",
    "baro_altitude", "geo_altitude", "on_ground", "velocity", "true_track", "vertical_rate", "squawk",
    "spi", "snapshot_ts", "date",
]
ENRICHED_AIRFRAME_COLUMNS = ["registration", "model", "icaoaircrafttype", "operator", "operatoricao"]
ENRICHED_TYPE_COLUMNS = ["ModelFullName", "AircraftDescription", "Description", "WTC"]
ENRICHED_DERIVED_COLUMNS = ["climb_rate_ratio", "altitude_km"]
ENRICHED_COLUMNS = (ENRICHED_OBSERVATION_COLUMNS + ENRICHED_AIRFRAME_COLUMNS
                    + ENRICHED_TYPE_COLUMNS + ENRICHED_DERIVED_COLUMNS)

FEATURES = ["latitude", "longitude", "baro_altitude", "velocity", "vertical_rate"]
# ---- end of fixed values ----
