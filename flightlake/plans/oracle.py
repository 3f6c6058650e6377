"""DuckDB oracle SQL for every registered query that is SQL-expressible.

Each statement starts from the same role derivations as ``flightlake.plans.roles`` (written here as
CTEs over the pre-registered driver views) and computes the query independently in plain SQL,
including the original disjunctive join for the aircraft-type lookup.
"""

from __future__ import annotations

ROLES = """
states AS (
  SELECT
    event_id AS obs_id,
    CASE WHEN event_id % 211 = 0 THEN '' ELSE CAST(user_id AS VARCHAR) END AS icao24,
    upper(event_type) || CAST(user_id AS VARCHAR) AS callsign,
    event_type AS origin_country,
    ts AS time_position,
    ts AS last_contact,
    CAST((event_id * 193) % 36001 AS DOUBLE) / 100.0 - 180.0 AS longitude,
    CAST((event_id * 97) % 18001 AS DOUBLE) / 100.0 - 90.0 AS latitude,
    CASE WHEN event_id % 13 = 0 THEN NULL ELSE CAST((event_id * 7919) % 13000 - 500 AS DOUBLE) END AS baro_altitude,
    ((event_id * 7919) % 13000) < 500 AS on_ground,
    CASE WHEN event_id % 17 = 0 THEN NULL ELSE value END AS velocity,
    CAST((event_id * 37) % 36000 AS DOUBLE) / 100.0 AS true_track,
    CAST(((event_id * 31) % 4001) - 2000 AS DOUBLE) / 4.0 AS vertical_rate,
    CAST(((event_id * 7919) % 62000) - 500 AS DOUBLE) AS geo_altitude,
    lpad(CAST((event_id * 7) % 7777 AS VARCHAR), 4, '0') AS squawk,
    event_type = 'error' AS spi,
    CAST(event_id % 4 AS INTEGER) AS position_source,
    CAST(floor(epoch(ts)) AS BIGINT) AS snapshot_ts,
    CAST(year(ts) AS INTEGER) AS date,
    CAST(floor(epoch(ts)) AS BIGINT) - (CAST(floor(epoch(ts)) AS BIGINT) % 180) AS window_start,
    CAST(floor(epoch(ts)) AS BIGINT) - (CAST(floor(epoch(ts)) AS BIGINT) % 180) + 180 AS window_end
  FROM events
),
airframes AS (
  SELECT
    CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE CAST(c_custkey AS VARCHAR) END AS icao24,
    c_name AS registration,
    c_mktsegment AS model,
    CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE CAST(c_nationkey AS VARCHAR) END AS typecode,
    CAST(c_custkey % 40 AS VARCHAR) AS icaoaircrafttype,
    c_mktsegment AS operator,
    substr(c_mktsegment, 1, 3) AS operatoricao
  FROM customer
),
models AS (
  SELECT
    CAST(s_suppkey // 4 AS VARCHAR) AS Designator,
    s_name AS ModelFullName,
    CASE s_suppkey % 3 WHEN 0 THEN 'LandPlane' WHEN 1 THEN 'Helicopter' ELSE 'Amphibian' END AS AircraftDescription,
    'D' || CAST(s_suppkey % 7 AS VARCHAR) AS Description,
    CASE s_suppkey % 4 WHEN 0 THEN 'Heavy' WHEN 1 THEN 'Medium' WHEN 2 THEN 'Light' END AS WTC
  FROM supplier
)"""

# Which type rows belong to which airframe rows: two equi-joins over numbered rows, so that a type
# row reached both ways counts once and repeated dimension rows keep their number.
TYPE_OF = """
airframe_rows AS MATERIALIZED (SELECT row_number() OVER () AS airframe_no, * FROM airframes),
type_rows AS MATERIALIZED (SELECT row_number() OVER () AS type_no, * FROM models),
type_of AS (
  SELECT airframe_no, type_no FROM airframe_rows JOIN type_rows ON Designator = typecode
  UNION
  SELECT airframe_no, type_no FROM airframe_rows JOIN type_rows ON Designator = icaoaircrafttype
)"""

ENRICHED = TYPE_OF + """,
enriched AS (
  SELECT
    obs.* EXCLUDE (callsign, position_source, window_start, window_end),
    plane.registration, plane.model, plane.icaoaircrafttype, plane.operator, plane.operatoricao,
    kind.ModelFullName, kind.AircraftDescription, kind.Description, kind.WTC,
    CASE WHEN obs.velocity > 0 AND obs.baro_altitude > 0 THEN abs(obs.vertical_rate) / obs.velocity END AS climb_rate_ratio,
    CASE WHEN obs.baro_altitude > 0 THEN obs.baro_altitude / 1000.0 END AS altitude_km
  FROM states AS obs
  LEFT JOIN airframe_rows AS plane ON plane.icao24 = obs.icao24
  LEFT JOIN type_of USING (airframe_no)
  LEFT JOIN type_rows AS kind USING (type_no)
)"""


def with_roles(body: str, enriched: bool = False) -> str:
    ctes = ROLES + ("," + ENRICHED if enriched else "")
    return "WITH " + ctes.strip() + "\n" + body.strip()


SQL: dict[str, str] = {}

SQL["enrich"] = with_roles("SELECT * FROM enriched", enriched=True)

# Per aircraft key: rows that one observation becomes, and how many of them have each kind of data.
PER_KEY = """
, fan AS (
  SELECT icao24, count(*) AS m, count(*) AS m_airframe, count(type_no) AS m_type
  FROM airframe_rows LEFT JOIN type_of USING (airframe_no) WHERE icao24 IS NOT NULL GROUP BY icao24
)"""
PERCENT = """
SELECT *, round(100.0 * CAST(n_with_airframe AS DOUBLE) / NULLIF(n_rows, 0), 6) AS pct_with_airframe,
          round(100.0 * CAST(n_with_type AS DOUBLE) / NULLIF(n_rows, 0), 6) AS pct_with_type
FROM counted"""

SQL["enrich_coverage"] = with_roles("""
, counted AS (
  SELECT count(*) AS n_rows, count(DISTINCT again.icao24) AS n_aircraft,
         count(plane.icao24) AS n_with_airframe, count(kind.Designator) AS n_with_type
  FROM enriched AS again
  LEFT JOIN airframe_rows AS plane ON plane.icao24 = again.icao24
  LEFT JOIN type_of USING (airframe_no)
  LEFT JOIN type_rows AS kind USING (type_no)
)""" + PERCENT, enriched=True)

SQL["enrich_coverage_distinct"] = with_roles("," + TYPE_OF + PER_KEY + """
, counted AS (
  SELECT count(*) AS n_rows, count(DISTINCT nullif(states.icao24, '')) AS n_aircraft,
         count(fan.m_airframe) AS n_with_airframe, count(CASE WHEN fan.m_type > 0 THEN 1 END) AS n_with_type
  FROM states LEFT JOIN fan ON fan.icao24 = states.icao24
)""" + PERCENT)

SQL["latest_window"] = with_roles("," + TYPE_OF + """
SELECT states.*, kind.Description
FROM states
LEFT JOIN airframe_rows AS plane ON plane.icao24 = states.icao24
LEFT JOIN type_of USING (airframe_no)
LEFT JOIN type_rows AS kind USING (type_no)
WHERE states.window_end = (SELECT max(window_end) FROM states)""")


# ------------------------------------------------------------------ profiles
PREPARED = """
, prepared AS (
  SELECT *, make_timestamp(snapshot_ts * 1000000) AS snapshot_time,
         CASE WHEN geo_altitude >= 0 AND geo_altitude <= 10000 THEN 'Low'
              WHEN geo_altitude > 10000 AND geo_altitude <= 25000 THEN 'Mid'
              WHEN geo_altitude > 25000 AND geo_altitude <= 45000 THEN 'High' END AS alt_band
  FROM enriched
  WHERE geo_altitude IS NOT NULL AND NOT isnan(geo_altitude)
    AND velocity IS NOT NULL AND NOT isnan(velocity)
    AND vertical_rate IS NOT NULL AND NOT isnan(vertical_rate)
)"""

BAND_A = """CASE WHEN geo_altitude > 0 AND geo_altitude <= 3000 THEN 'Low (0-3k)'
  WHEN geo_altitude > 3000 AND geo_altitude <= 10000 THEN 'Climb (3-10k)'
  WHEN geo_altitude > 10000 AND geo_altitude <= 30000 THEN 'Cruise Low (10-30k)'
  WHEN geo_altitude > 30000 AND geo_altitude <= 60000 THEN 'High (30k+)' END"""
BAND_B = """CASE WHEN geo_altitude >= 0 AND geo_altitude <= 10000 THEN 'Low'
  WHEN geo_altitude > 10000 AND geo_altitude <= 25000 THEN 'Mid'
  WHEN geo_altitude > 25000 AND geo_altitude <= 45000 THEN 'High' END"""

SQL["altitude_band_counts"] = with_roles(f"""
, dim(alt_band, alt_band_order) AS (VALUES ('Low (0-3k)', 0), ('Climb (3-10k)', 1), ('Cruise Low (10-30k)', 2), ('High (30k+)', 3)),
counts AS (SELECT {BAND_A} AS alt_band, COUNT(*) AS n FROM enriched GROUP BY 1)
SELECT d.alt_band, d.alt_band_order, COALESCE(c.n, 0) AS n FROM dim d LEFT JOIN counts c ON d.alt_band = c.alt_band""",
                                         enriched=True)

SQL["altitude_band_b_counts"] = with_roles(f"""
, dim(alt_band, alt_band_order) AS (VALUES ('Low', 0), ('Mid', 1), ('High', 2)),
counts AS (SELECT {BAND_B} AS alt_band, COUNT(*) AS n FROM enriched GROUP BY 1)
SELECT d.alt_band, d.alt_band_order, COALESCE(c.n, 0) AS n FROM dim d LEFT JOIN counts c ON d.alt_band = c.alt_band""",
                                           enriched=True)

SQL["altitude_bands"] = with_roles(f"""
SELECT obs_id, geo_altitude, {BAND_A} AS alt_band_a, {BAND_B} AS alt_band_b, geo_altitude * 0.0003048 AS altitude_km_geo_ft
FROM enriched""", enriched=True)

SQL["vertical_status"] = with_roles(PREPARED + """
, st AS (
  SELECT CASE WHEN vertical_rate > 200 THEN 'Climbing (>+200 ft/min)'
              WHEN vertical_rate < -200 THEN 'Descending (<-200 ft/min)'
              ELSE 'Level/Holding (±200 ft/min)' END AS status, icao24
  FROM prepared
)
SELECT status,
       CASE status WHEN 'Climbing (>+200 ft/min)' THEN 0 WHEN 'Level/Holding (±200 ft/min)' THEN 1 ELSE 2 END AS status_order,
       COUNT(*) AS n_rows, COUNT(DISTINCT CASE WHEN icao24 <> '' THEN icao24 END) AS n_aircraft
FROM st GROUP BY status""", enriched=True)

SQL["speed_histogram"] = with_roles("""
, v AS (SELECT velocity AS v FROM enriched WHERE velocity IS NOT NULL AND NOT isnan(velocity)),
st AS (SELECT min(v) AS lo, max(v) AS hi FROM v),
b AS (SELECT LEAST(CAST(floor((v - lo) / (hi - lo) * 30.0) AS INTEGER), 29) AS bin FROM v, st),
c AS (SELECT bin, COUNT(*) AS n FROM b GROUP BY bin),
dim AS (SELECT CAST(range AS INTEGER) AS bin FROM range(30))
SELECT dim.bin, round(lo + dim.bin * (hi - lo) / 30.0, 6) AS bin_lo,
       round(lo + (dim.bin + 1) * (hi - lo) / 30.0, 6) AS bin_hi, COALESCE(c.n, 0) AS n
FROM dim CROSS JOIN st LEFT JOIN c ON dim.bin = c.bin""", enriched=True)

SQL["envelope_top4"] = with_roles(PREPARED + """
, top AS (SELECT Description FROM prepared WHERE Description IS NOT NULL
          GROUP BY Description ORDER BY COUNT(*) DESC, Description LIMIT 4)
SELECT obs_id, velocity, geo_altitude, Description FROM prepared WHERE Description IN (SELECT Description FROM top)""",
                                  enriched=True)

SQL["category_codes"] = with_roles("""
, r AS (SELECT obs_id, velocity, geo_altitude, Description FROM enriched
        WHERE velocity IS NOT NULL AND NOT isnan(velocity) AND geo_altitude IS NOT NULL AND NOT isnan(geo_altitude)
          AND Description IS NOT NULL),
codes AS (SELECT Description, CAST(dense_rank() OVER (ORDER BY Description) - 1 AS INTEGER) AS desc_code
          FROM (SELECT DISTINCT Description FROM r) d)
SELECT r.obs_id, r.velocity, r.geo_altitude, r.Description, codes.desc_code FROM r JOIN codes USING (Description)""",
                                   enriched=True)

PROFILE = """
, m AS (SELECT Description, velocity, geo_altitude, climb_rate_ratio, icao24 FROM enriched
        WHERE Description IS NOT NULL AND velocity IS NOT NULL AND NOT isnan(velocity)
          AND geo_altitude IS NOT NULL AND NOT isnan(geo_altitude)
          AND climb_rate_ratio IS NOT NULL AND NOT isnan(climb_rate_ratio) AND icao24 IS NOT NULL),
profile AS (SELECT Description, round(avg(velocity), 6) AS avg_velocity, round(avg(geo_altitude), 6) AS avg_altitude,
                   round(avg(climb_rate_ratio), 6) AS avg_climb_rate, COUNT(DISTINCT icao24) AS aircraft_count
            FROM m GROUP BY Description)"""

SQL["category_profile"] = with_roles(PROFILE + "\nSELECT * FROM profile", enriched=True)


def _radar_sql() -> str:
    import math
    metrics = ["avg_velocity", "avg_altitude", "avg_climb_rate", "aircraft_count"]
    scaled = ",\n".join(
        f"CASE WHEN max({m}) OVER () = min({m}) OVER () THEN 0.5 "
        f"ELSE ({m} - min({m}) OVER ()) / (max({m}) OVER () - min({m}) OVER ()) END AS {m}_n" for m in metrics)
    parts = []
    for i, m in enumerate(metrics + metrics[:1]):
        angle = round(2 * math.pi * (i % 4) / 4, 6)
        parts.append(f"SELECT Description, {i} AS point, '{m}' AS metric, round({m}_n, 6) AS value, "
                     f"{angle!r}::DOUBLE AS angle FROM scaled")
    return (PROFILE + """
, top AS (SELECT Description, avg_velocity, avg_altitude, avg_climb_rate, CAST(aircraft_count AS DOUBLE) AS aircraft_count
          FROM profile ORDER BY aircraft_count DESC, Description LIMIT 4),
scaled AS (SELECT Description, """ + scaled + """ FROM top)
""" + "\nUNION ALL\n".join(parts))


SQL["category_radar"] = with_roles(_radar_sql(), enriched=True)

STABLE_FRACTION = "CAST(('0x' || md5('42:' || CAST({key} AS VARCHAR))[1:12]) AS BIGINT) / CAST(281474976710656 AS DOUBLE)"

SQL["position_sample"] = with_roles(f"""
SELECT obs_id, latitude, longitude FROM enriched
WHERE latitude IS NOT NULL AND NOT isnan(latitude) AND longitude IS NOT NULL AND NOT isnan(longitude)
  AND {STABLE_FRACTION.format(key='obs_id')} < 0.3""", enriched=True)

SQL["prepared_frame"] = with_roles(PREPARED + """
SELECT obs_id, icao24, latitude, longitude, geo_altitude, velocity, vertical_rate, Description, WTC, snapshot_time,
       altitude_km, alt_band FROM prepared""", enriched=True)


# ------------------------------------------------------------------ anomalies, windows, ingest, catalog
SQL["flagged_anomalies"] = with_roles("""
, lagged AS (
  SELECT obs_id, icao24, snapshot_ts, velocity, baro_altitude, vertical_rate,
         CASE WHEN icao24 IS NOT NULL AND icao24 <> '' THEN
           lag(snapshot_ts) OVER (PARTITION BY icao24 ORDER BY snapshot_ts, obs_id) END AS prev_ts,
         CASE WHEN icao24 IS NOT NULL AND icao24 <> '' THEN
           lag(velocity) OVER (PARTITION BY icao24 ORDER BY snapshot_ts, obs_id) END AS prev_v,
         CASE WHEN icao24 IS NOT NULL AND icao24 <> '' THEN
           lag(baro_altitude) OVER (PARTITION BY icao24 ORDER BY snapshot_ts, obs_id) END AS prev_a
  FROM states
), f AS (
  SELECT obs_id, icao24, snapshot_ts, velocity, baro_altitude, vertical_rate,
         CAST(snapshot_ts - prev_ts AS BIGINT) AS dt_seconds,
         COALESCE(snapshot_ts - prev_ts > 0
                  AND abs(velocity - prev_v) / CAST(snapshot_ts - prev_ts AS DOUBLE) > 15.0, false) AS sudden_velocity_anomaly,
         COALESCE(abs(vertical_rate) > 50.0
                  OR (CASE WHEN velocity > 0 AND baro_altitude > 0 THEN abs(vertical_rate) / NULLIF(velocity, 0) END) > 1.0,
                  false) AS unrealistic_climb_anomaly,
         COALESCE(snapshot_ts - prev_ts > 0
                  AND abs(baro_altitude - prev_a) / CAST(snapshot_ts - prev_ts AS DOUBLE) > 100.0, false) AS altitude_jump_anomaly
  FROM lagged
)
SELECT * FROM f WHERE sudden_velocity_anomaly OR unrealistic_climb_anomaly OR altitude_jump_anomaly""")

SQL["peer_anomalies"] = with_roles("""
, rows_ AS (SELECT obs_id, icao24, Description, velocity, baro_altitude FROM enriched WHERE Description IS NOT NULL),
stats AS (SELECT Description, COUNT(*) AS peer_rows, avg(velocity) AS mu_v, stddev_samp(velocity) AS sd_v,
                 avg(baro_altitude) AS mu_a, stddev_samp(baro_altitude) AS sd_a
          FROM rows_ GROUP BY Description HAVING COUNT(*) >= 5),
z AS (SELECT r.obs_id, r.icao24, r.Description, r.velocity, r.baro_altitude, s.peer_rows,
             CASE WHEN s.sd_v > 0 THEN (r.velocity - s.mu_v) / s.sd_v END AS z_velocity,
             CASE WHEN s.sd_a > 0 THEN (r.baro_altitude - s.mu_a) / s.sd_a END AS z_altitude
      FROM rows_ r JOIN stats s USING (Description))
SELECT obs_id, icao24, Description, velocity, baro_altitude, peer_rows,
       round(z_velocity, 6) AS z_velocity, round(z_altitude, 6) AS z_altitude
FROM z WHERE abs(z_velocity) > 3.0 OR abs(z_altitude) > 3.0""", enriched=True)

SQL["window_summary"] = with_roles("""
SELECT window_start, window_end, COUNT(*) AS n_obs,
       COUNT(DISTINCT CASE WHEN icao24 <> '' THEN icao24 END) AS unique_aircraft
FROM states GROUP BY window_start, window_end""")

SQL["window_raw"] = with_roles("""
SELECT *, strftime(make_timestamp(window_end * 1000000), 'processed/date=%Y/%m/%d/window_raw_%Y%m%dT%H%M%S.parquet')
          AS window_file
FROM states""")

SQL["recent_only"] = with_roles("""
, now_ AS (SELECT max(snapshot_ts) AS now_ts FROM states),
aged AS (SELECT obs_id, icao24, snapshot_ts, CAST(now_ts - COALESCE(snapshot_ts, now_ts) AS DOUBLE) / 60.0 AS age
         FROM states, now_)
SELECT obs_id, icao24, snapshot_ts, round(age, 6) AS age_minutes FROM aged WHERE age < 9.0""")

SQL["normalised_states"] = with_roles("""
SELECT icao24, callsign, origin_country, time_position, last_contact, longitude, latitude, baro_altitude, on_ground,
       velocity, true_track, vertical_rate, geo_altitude, squawk, spi, position_source, snapshot_ts, obs_id
FROM states""")


def _profile_sql() -> str:
    tables = {
        "states": ["obs_id", "icao24", "callsign", "origin_country", "time_position", "last_contact", "longitude",
                   "latitude", "baro_altitude", "on_ground", "velocity", "true_track", "vertical_rate",
                   "geo_altitude", "squawk", "spi", "position_source", "snapshot_ts", "date", "window_start",
                   "window_end"],
        "airframes": ["icao24", "registration", "model", "typecode", "icaoaircrafttype", "operator", "operatoricao"],
        "models": ["Designator", "ModelFullName", "AircraftDescription", "Description", "WTC"],
        "enriched_aircraft_states": None,
    }
    from flightlake.schemas import ENRICHED_COLUMNS
    tables["enriched_aircraft_states"] = ENRICHED_COLUMNS
    src = {"enriched_aircraft_states": "enriched"}
    kind = ("replace(replace(replace(lower(typeof(min({c}))), 'varchar', 'string'), 'integer', 'int'), "
            "'timestamp', 'timestamp_ntz')")
    typed = lambda cols: " || ',' || ".join(f"'{c}:' || {kind.format(c=c)}" for c in cols)
    parts = [f"SELECT '{t}' AS table_name, COUNT(*) AS row_count, {len(c)} AS column_count, "
             f"'{','.join(c)}' AS columns, {typed(c)} AS column_types FROM {src.get(t, t)}" for t, c in tables.items()]
    return "\nUNION ALL\n".join(parts)


SQL["table_profile"] = with_roles(_profile_sql(), enriched=True)

SQL["table_list"] = with_roles("""
SELECT 'states' AS table_name, 21 AS column_count, least(COUNT(*), 10) AS preview_rows FROM states
UNION ALL SELECT 'airframes', 7, least(COUNT(*), 10) FROM airframes
UNION ALL SELECT 'models', 5, least(COUNT(*), 10) FROM models""")

SQL["table_preview"] = with_roles("""
SELECT obs_id, icao24, origin_country, velocity, snapshot_ts FROM states ORDER BY obs_id LIMIT 10""")

SQL["vertical_status_titled"] = SQL["vertical_status"].replace(
    "AS n_aircraft", "AS n_aircraft, (SELECT strftime(make_timestamp(min(snapshot_ts) * 1000000), '%H:%M:%S') FROM prepared) AS time_label", 1)

SQL["window_bounds"] = with_roles("""
SELECT window_start * 1000 AS start_ms, make_timestamp(window_start * 1000000) AS window_start,
       make_timestamp(window_end * 1000000) AS window_end, COUNT(*) AS n
FROM states GROUP BY ALL""")


# ------------------------------------------------------------------ quantiles and density
SQL["country_quantiles"] = with_roles("\nUNION ALL\n".join(f"""
SELECT origin_country, '{m}' AS metric, COUNT({m}) AS n, round(quantile_cont({m}, 0.01), 6) AS q01,
       round(quantile_cont({m}, 0.5), 6) AS q50, round(quantile_cont({m}, 0.99), 6) AS q99
FROM states WHERE {m} IS NOT NULL GROUP BY origin_country""" for m in ("velocity", "baro_altitude")))

WTC_SUPPORTED = PREPARED + """
, wtc_ok AS (SELECT WTC FROM prepared WHERE WTC IS NOT NULL GROUP BY WTC HAVING COUNT(*) >= 5),
sup AS (SELECT * FROM prepared WHERE WTC IN (SELECT WTC FROM wtc_ok))"""

SQL["wtc_speed_quartiles"] = with_roles(WTC_SUPPORTED + """
SELECT WTC, CASE WTC WHEN 'Heavy' THEN 0 WHEN 'Medium' THEN 1 WHEN 'Light' THEN 2 END AS wtc_order, COUNT(*) AS n,
       round(quantile_cont(velocity, 0.25), 6) AS q25, round(quantile_cont(velocity, 0.5), 6) AS q50,
       round(quantile_cont(velocity, 0.75), 6) AS q75
FROM sup GROUP BY WTC""", enriched=True)

SQL["wtc_speed_density"] = with_roles(WTC_SUPPORTED + """
, st AS (SELECT WTC, COUNT(*) AS n, stddev_samp(velocity) * pow(COUNT(*), -1.0 / 5.0) AS bw,
                min(velocity) AS mn, max(velocity) AS mx
         FROM sup GROUP BY WTC HAVING COUNT(*) >= 2 AND stddev_samp(velocity) > 0),
grid AS (SELECT st.WTC, CAST(r.range AS INTEGER) AS point,
                (mn - 2.0 * bw) + r.range * ((mx + 2.0 * bw) - (mn - 2.0 * bw)) / 99.0 AS x, n, bw
         FROM st, range(100) r)
SELECT g.WTC, g.point, round(g.x, 6) AS x,
       round(SUM(exp(-0.5 * ((g.x - s.velocity) / g.bw) * ((g.x - s.velocity) / g.bw)))
             / (g.n * g.bw * sqrt(2.0 * pi())), 12) AS density
FROM grid g JOIN sup s ON s.WTC = g.WTC
GROUP BY g.WTC, g.point, g.x, g.n, g.bw""", enriched=True)

SQL["density_grid"] = with_roles(f"""
, pts AS (SELECT longitude AS x, latitude AS y FROM enriched
          WHERE latitude IS NOT NULL AND NOT isnan(latitude) AND longitude IS NOT NULL AND NOT isnan(longitude)
            AND {STABLE_FRACTION.format(key='obs_id')} < 0.3),
st AS (SELECT COUNT(*) AS n, var_samp(x) * pow(COUNT(*), -2.0 / 6.0) AS sxx, var_samp(y) * pow(COUNT(*), -2.0 / 6.0) AS syy,
              covar_samp(x, y) * pow(COUNT(*), -2.0 / 6.0) AS sxy, min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1
       FROM pts),
inv AS (SELECT *, sxx * syy - sxy * sxy AS det FROM st),
w AS (SELECT x, y, CAST(COUNT(*) AS DOUBLE) AS w FROM pts GROUP BY x, y),
grid AS (SELECT CAST(i.range AS INTEGER) AS ix, CAST(j.range AS INTEGER) AS iy,
                x0 + i.range * (x1 - x0) / 199.0 AS gx, y0 + j.range * (y1 - y0) / 199.0 AS gy
         FROM inv, range(200) i, range(200) j WHERE det > 0)
SELECT ix, iy, round(gx, 6) AS x, round(gy, 6) AS y,
       round(SUM(w.w * exp(-0.5 * ((syy / det) * (gx - w.x) * (gx - w.x) + (sxx / det) * (gy - w.y) * (gy - w.y)
                                   - 2.0 * (sxy / det) * (gx - w.x) * (gy - w.y))))
             / (n * 2.0 * pi() * sqrt(det)), 12) AS density
FROM grid, w, inv
GROUP BY ix, iy, gx, gy, n, det""", enriched=True)


# ------------------------------------------------------------------ streaming windows
# A window is emitted once the watermark (greatest event time minus the 10 s grace) reaches its end.
CLOSED = "window_end <= (SELECT max(snapshot_ts) - 10 FROM states)"

SQL["stream_window_summary"] = with_roles(f"""
SELECT window_start, window_end, COUNT(*) AS n_obs,
       COUNT(DISTINCT CASE WHEN icao24 <> '' THEN icao24 END) AS unique_aircraft
FROM states WHERE {CLOSED} GROUP BY window_start, window_end""")

SQL["stream_windows"] = with_roles(f"""
SELECT obs_id, icao24, snapshot_ts, velocity, window_start, window_end FROM states WHERE {CLOSED}""")


# ------------------------------------------------------------------ table sample
SQL["enriched_sample"] = with_roles("""
SELECT * FROM enriched ORDER BY obs_id ASC, ModelFullName ASC NULLS FIRST LIMIT 10000""", enriched=True)


# ------------------------------------------------------------------ isolation forest
def _forest_sql(source: str = "states", n_trees: int = 100, psi: int = 256, seed: int = 42) -> str:
    """The forest grown on and applied to ``source`` in SQL, one pair of CTEs for each level."""
    feats = ["latitude", "longitude", "baro_altitude", "velocity", "vertical_rate"]
    hashed = lambda what: f"CAST('0x' || md5('{seed}:' || {what} || ':' || CAST(obs_id AS VARCHAR))[1:15] AS BIGINT)"
    drawn = lambda what: (f"CAST('0x' || md5('{seed}:' || CAST(tree AS VARCHAR) || ':' || CAST(node AS VARCHAR) || ':{what}')[1:12]"  # noqa: E731
                          " AS BIGINT) / CAST(281474976710656 AS DOUBLE)")
    height = (psi - 1).bit_length()
    sql = f"""
, complete AS MATERIALIZED (
  SELECT row_number() OVER () AS k, obs_id, callsign, latitude, longitude, [{", ".join(feats)}] AS x FROM {source}
  WHERE {" AND ".join(f"{f} IS NOT NULL AND NOT isnan({f})" for f in feats)}
), size AS (
  SELECT count(*) AS n, least({psi}, count(*)) AS psi FROM complete
), rate AS (
  SELECT *, least(1.0::DOUBLE, (4.0::DOUBLE * psi + 64.0) / n) AS p FROM size
), share AS (
  SELECT *, least(1.0::DOUBLE, {n_trees} * p) AS q FROM rate
), candidate AS (
  SELECT tree, obs_id, x, {hashed("CAST(tree AS VARCHAR)")} AS h
  FROM complete, share, range({n_trees}) AS trees(tree)
  WHERE {hashed("'row'")} < floor(q * 1152921504606846976.0::DOUBLE)
    AND {hashed("CAST(tree AS VARCHAR)")} < floor(p / q * 1152921504606846976.0::DOUBLE)
), at_0 AS MATERIALIZED (
  SELECT tree, 1 AS node, x FROM candidate, size
  QUALIFY row_number() OVER (PARTITION BY tree ORDER BY h, obs_id) <= size.psi
)"""
    for d in range(height + 1):
        lows = ", ".join(f"min(x[{i}])" for i in range(1, 6))
        highs = ", ".join(f"max(x[{i}])" for i in range(1, 6))
        sql += f""", stat_{d} AS (
  SELECT tree, node, count(*) AS members, [{lows}] AS lo, [{highs}] AS hi FROM at_{d} GROUP BY tree, node
), open_{d} AS (
  SELECT *, list_filter([1, 2, 3, 4, 5], lambda i: hi[i] > lo[i]) AS spread FROM stat_{d}
), node_{d} AS MATERIALIZED (
  SELECT tree, node, members, {d} AS depth,
         {"NULL" if d == height else f"CASE WHEN members > 1 AND len(spread) > 0 THEN spread[1 + CAST(floor({drawn('feature')} * len(spread)) AS BIGINT)] END"} AS f,
         lo[f] + {drawn("point")} * (hi[f] - lo[f]) AS threshold
  FROM open_{d}
)"""
        if d < height:
            sql += f""", at_{d + 1} AS MATERIALIZED (
  SELECT tree, 2 * node + CASE WHEN x[f] < threshold THEN 0 ELSE 1 END AS node, x
  FROM at_{d} JOIN node_{d} USING (tree, node) WHERE f IS NOT NULL
)"""
    sql += f""", falls_0 AS (SELECT k, x, tree, 1 AS node FROM complete, range({n_trees}) AS trees(tree))"""
    for d in range(height):
        sql += f""", falls_{d + 1} AS (
  SELECT k, x, tree, 2 * node + CASE WHEN x[f] < threshold THEN 0 ELSE 1 END AS node
  FROM falls_{d} JOIN node_{d} USING (tree, node) WHERE f IS NOT NULL
)"""
    ends = "\n  UNION ALL\n".join(f"  SELECT k, depth, members FROM falls_{d} JOIN node_{d} USING (tree, node) WHERE f IS NULL"
                                  for d in range(height + 1))
    mean_path = "2.0 * (ln({m} - 1.0) + 0.5772156649) - 2.0 * ({m} - 1.0) / {m}"
    sql += f""", ends AS (
{ends}
), path AS (
  SELECT k, round(sum(depth + CASE WHEN members > 2 THEN {mean_path.format(m="members")} WHEN members = 2 THEN 1.0 ELSE 0.0 END)
                       / {n_trees}, 9) AS h
  FROM ends GROUP BY k
), scored AS (
  SELECT complete.*, pow(2.0, -h / CASE WHEN psi > 2 THEN {mean_path.format(m="psi")} ELSE 1.0 END) AS s
  FROM complete JOIN path USING (k), size
), labelled AS MATERIALIZED (
  SELECT *, CASE WHEN -s < (SELECT quantile_cont(-s, 0.01) FROM scored) THEN -1 ELSE 1 END AS anomaly FROM scored
)"""
    return sql


SQL["iforest_scores"] = with_roles(_forest_sql() + """
SELECT obs_id, round(s, 6) AS score, anomaly FROM labelled""")

SQL["iforest_anomalies"] = with_roles(_forest_sql() + """
SELECT obs_id, callsign, round(s, 6) AS score, anomaly,
       (SELECT count(*) FROM labelled WHERE anomaly = -1) AS n_found, (SELECT count(*) FROM labelled) AS n_total
FROM labelled WHERE anomaly = -1""")

SQL["anomaly_map"] = with_roles(_forest_sql() + """
SELECT obs_id, latitude, longitude, CASE anomaly WHEN -1 THEN 'Anomaly' ELSE 'Normal' END AS is_anomaly FROM labelled""")


# ------------------------------------------------------------------ files, messages, batched streams, refresh
SQL["prepared_sample"] = with_roles(f"""
SELECT obs_id, geo_altitude, velocity, {BAND_B} AS alt_band FROM states
WHERE geo_altitude IS NOT NULL AND velocity IS NOT NULL AND vertical_rate IS NOT NULL
ORDER BY {STABLE_FRACTION.format(key="obs_id")}, obs_id LIMIT 5000""")

SQL["csv_enrich"] = SQL["enrich"]

SQL["typed_enrichment"] = SQL["enrich"]

SQL["api_snapshots"] = with_roles("""
SELECT CASE WHEN squawk <> '0007' THEN origin_country END AS origin_country, squawk = '0007' AS malformed, count(*) AS n,
       count(CASE WHEN squawk <> '0007' THEN velocity END) AS n_velocity,
       round(sum(CASE WHEN squawk <> '0007' THEN baro_altitude END), 3) AS sum_altitude,
       max(CASE WHEN squawk <> '0007' THEN 1700000000 END)::BIGINT AS stamp, 1704067200::BIGINT AS broker_seconds
FROM states GROUP BY 1, 2""")

SQL["window_files"] = with_roles("""
, hourly AS (SELECT * REPLACE (snapshot_ts - snapshot_ts % 3600 AS window_start, snapshot_ts - snapshot_ts % 3600 + 3600 AS window_end) FROM states)
SELECT obs_id, icao24, velocity, time_position, window_start, window_end, CAST(year(make_timestamp(window_end * 1000000)) AS INTEGER) AS date,
       (SELECT count(DISTINCT window_end) FROM hourly) AS window_files, (SELECT count(*) FROM hourly) AS rows_in_all_files
FROM hourly WHERE window_end = (SELECT max(window_end) FROM hourly)""")

# Parts of the time range arrive one after another, every 50th row one part too late. A late row is dropped if
# its window ends at or before the watermark, the greatest time of the parts before its own less the grace.
def _kept(parts: int, recent: str = "true") -> str:
    return f"""
, span AS (SELECT min(snapshot_ts) AS lo, max(snapshot_ts) AS hi FROM states),
landed AS (
  SELECT states.*, least((snapshot_ts - lo) * {parts} // (hi - lo + 1) + CASE WHEN obs_id % 50 = 0 THEN 1 ELSE 0 END, {parts}) AS part
  FROM states, span WHERE {recent}
), marks AS (
  SELECT range AS part, (SELECT max(snapshot_ts) - 10 FROM landed WHERE landed.part < range) AS mark FROM range({parts + 1})
), kept AS (
  SELECT landed.* FROM landed JOIN marks USING (part)
  WHERE (mark IS NULL OR window_end > mark) AND window_end <= (SELECT hi - 10 FROM span)
)"""


SQL["stream_batches"] = with_roles(_kept(6, "CAST(hi - snapshot_ts AS DOUBLE) / 60.0 < CAST(hi - lo AS DOUBLE) * 0.8::DOUBLE / 60.0") + """
SELECT 'raw' AS output, count(*) AS n FROM kept
UNION ALL SELECT 'windows', count(DISTINCT window_end) FROM kept
UNION ALL SELECT 'observations', count(*) FROM kept
UNION ALL SELECT 'rejects', 7""")

SQL["stream_sealed_windows"] = with_roles(_kept(6) + """
SELECT obs_id, icao24, snapshot_ts, velocity, window_start, window_end FROM kept""")

SQL["stream_resume"] = with_roles(_kept(2) + """
SELECT obs_id, icao24, snapshot_ts, window_start, window_end FROM kept""")

SQL["stream_callback"] = with_roles(_kept(2) + """
SELECT kept.window_end, count(DISTINCT kept.obs_id) AS n_obs,
       count(DISTINCT CASE WHEN kept.icao24 <> '' THEN kept.icao24 END) AS unique_aircraft, count(*) AS n_enriched, 1 AS n_acted
FROM kept JOIN enriched USING (obs_id) GROUP BY kept.window_end""", enriched=True)

SQL["stream_arrival_windows"] = with_roles("""
, came AS (SELECT *, snapshot_ts + (obs_id * 37) % 240 AS arrived FROM states),
placed AS (SELECT *, arrived - arrived % 180 AS arrival_window FROM came)
SELECT arrival_window AS window_start, count(*) AS n_obs, count(DISTINCT CASE WHEN icao24 <> '' THEN icao24 END) AS unique_aircraft,
       count(CASE WHEN window_start < arrival_window THEN 1 END) AS n_polled_before
FROM placed WHERE arrival_window + 180 <= (SELECT max(arrived) - 10 FROM came) GROUP BY arrival_window""")

SQL["stream_metrics"] = with_roles(_kept(2) + """
SELECT part, count(landed.obs_id) + 1 AS n_records, 1 AS n_malformed, 0 AS n_unstamped, max(snapshot_ts) AS newest
FROM marks LEFT JOIN landed USING (part) GROUP BY part""")


def _outputs(counts: dict[str, str]) -> str:
    return "\nUNION ALL\n".join(f"SELECT '{name}' AS output, (SELECT count(*) FROM ({sql}) AS counted) AS rows" for name, sql in counts.items())


_NEWEST_CLOSED = f"""
, newest AS (
  SELECT * FROM states WHERE window_end = (SELECT max(window_end) FROM states WHERE {CLOSED})
)"""

SQL["window_refresh"] = _outputs({
    "enriched_aircraft_states": with_roles(_NEWEST_CLOSED + "SELECT enriched.* FROM enriched JOIN newest USING (obs_id)", enriched=True),
    "window_anomaly_scores": with_roles(_NEWEST_CLOSED + _forest_sql("newest") + " SELECT * FROM labelled"),
    "window_anomalies": with_roles(_NEWEST_CLOSED + _forest_sql("newest") + " SELECT * FROM labelled WHERE anomaly = -1"),
})

_LATEST = ", latest AS (" + SQL["latest_window"] + ")"

SQL["full_refresh"] = _outputs({
    "enriched_aircraft_states": SQL["enrich"],
    "coverage": SQL["enrich_coverage_distinct"],
    "latest_window": SQL["latest_window"],
    "window_anomaly_scores": with_roles(_LATEST + _forest_sql("latest") + " SELECT * FROM labelled"),
    "window_anomalies": with_roles(_LATEST + _forest_sql("latest") + " SELECT * FROM labelled WHERE anomaly = -1"),
    "anomaly_map": with_roles(_LATEST + _forest_sql("latest") + " SELECT * FROM labelled"),
    "envelope_rows": with_roles(_LATEST + """
, complete AS (SELECT * FROM latest WHERE geo_altitude IS NOT NULL AND velocity IS NOT NULL AND vertical_rate IS NOT NULL)
SELECT * FROM complete WHERE Description IN (
  SELECT Description FROM complete WHERE Description IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 4)"""),
    "altitude_band_counts": SQL["altitude_band_counts"],
    "vertical_status": SQL["vertical_status"],
    "speed_histogram": SQL["speed_histogram"],
    "category_profile": SQL["category_profile"],
    "category_radar": SQL["category_radar"],
    "flagged_anomalies": SQL["flagged_anomalies"],
    "statistical_anomalies": SQL["peer_anomalies"],
    "position_density": SQL["density_grid"],
})


def _totals(sums: dict[str, tuple[str, str]]) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{name}' AS output, rows, total FROM (SELECT count(*) AS rows, CAST(sum({what}) AS BIGINT) AS total FROM ({sql}) AS counted)"
        for name, (sql, what) in sums.items())


SQL["incremental_refresh"] = _totals({
    "enriched_aircraft_states": (SQL["enrich"], "obs_id"),
    "flagged_anomalies": (SQL["flagged_anomalies"], "obs_id"),
    "latest_window": (SQL["latest_window"], "obs_id"),
    "coverage": (SQL["enrich_coverage_distinct"], "n_with_type"),
    "altitude_band_counts": (SQL["altitude_band_counts"], "n * (alt_band_order + 1)"),
    "vertical_status": (SQL["vertical_status"], "n_rows * (status_order + 1) + n_aircraft"),
    "speed_histogram": (SQL["speed_histogram"], "n * (bin + 1)"),
    "category_profile": (SQL["category_profile"], "aircraft_count"),
    "category_radar": (SQL["category_radar"], "point"),
})

SQL["replaced_table"] = with_roles("""
, early AS (SELECT count(DISTINCT window_end) AS windows, count(*) AS observations FROM states WHERE obs_id % 2 = 0)
SELECT 'first version' AS step, windows, observations FROM early
UNION ALL SELECT 'a write that was given up', windows, observations FROM early
UNION ALL SELECT 'second version', count(DISTINCT window_end), count(*) FROM states""")
