import os

import pytest
from pyspark.sql import functions as F

from flightlake.sources import catalog, snapshots, windows
from flightlake.plans import roles
from conftest import SF001


def test_json_roundtrip_matches_states(spark):
    st = roles.states(spark, SF001)
    back = snapshots.decode_records(snapshots.encode_records(st))
    assert back.filter(F.col(snapshots.CORRUPT).isNotNull()).count() == 0
    back = snapshots.accepted(back)
    cols = [c for c in back.columns if c != "sensors"]
    assert back.select(*cols).exceptAll(st.select(*cols)).count() == 0
    assert back.count() == st.count()


def test_bad_records_do_not_fail(spark):
    vals = spark.createDataFrame([('{"icao24":"a","velocity":"abc","time_position":"nope"}',), ("not json",), ('{"icao24": cut',)],
                                 "value string")
    out = snapshots.decode_records(vals).collect()
    assert out[0].icao24 == "a" and out[0].velocity is None and out[0].time_position is None
    assert [r.icao24 for r in out[1:]] == [None, None]
    assert [r[snapshots.CORRUPT] for r in out[1:]] == ["not json", '{"icao24": cut']


def test_messages_keep_the_brokers_time_and_bad_text(spark):
    msgs = spark.sql("SELECT * FROM VALUES (CAST('{\"icao24\":\"a\",\"snapshot_ts\":5}' AS BINARY), TIMESTAMP'2024-01-01 00:00:07'), "
                     "(CAST('oops' AS BINARY), TIMESTAMP'2024-01-01 00:00:09') AS t(value, timestamp)")
    got = snapshots.decode_messages(msgs)
    rows = sorted(got.collect(), key=lambda r: r.broker_time)
    assert (rows[0].icao24, rows[0].snapshot_ts) == ("a", 5) and rows[1][snapshots.CORRUPT] == "oops"
    assert snapshots.accepted(got).count() == 1 and [r.reason for r in snapshots.rejected(got).collect()] == ["malformed"]


def test_api_frame_renames_and_nan(spark):
    api = spark.createDataFrame([("abc", float("nan"), 100.0)], "icao24 string, groundspeed double, altitude double")
    r = snapshots.from_api_frame(api, snapshot_ts=123).first()
    assert r.velocity is None and r.baro_altitude == 100.0 and r.snapshot_ts == 123 and r.callsign is None


def test_landed_files_and_missing_stamp(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "landed")
    os.makedirs(p)
    for name in ("a.json", "poll_1700000000.json"):
        with open(os.path.join(p, name), "w") as fh:
            fh.write('{"icao24":"a","snapshot_ts":10}\n{"icao24":"b"}\nbroken\n')
    got = snapshots.read_snapshots(spark, p)
    # the poll time in the file's name stands in; never the time at which a file was written
    assert sorted(r.snapshot_ts or 0 for r in got.collect()) == [0, 0, 0, 10, 10, 1_700_000_000]
    assert sorted(r.snapshot_ts for r in snapshots.accepted(got).collect()) == [10, 10, 1_700_000_000]
    assert sorted(r.reason for r in snapshots.rejected(got).collect()) == ["malformed", "malformed", "no stamp"]


def test_window_files_latest_path(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "processed")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "obs_id long, icao24 string")
    for key in ["date=2025/12/31/window_raw_20251231T235700.parquet",
                "date=2026/01/01/window_raw_20260101T000300.parquet",
                "date=2026/01/01/window_raw_20260101T000000.parquet"]:
        df.coalesce(1).write.parquet(os.path.join(tmpdir_path, "tmp", key))
        src = [f for f in os.listdir(os.path.join(tmpdir_path, "tmp", key)) if f.endswith(".parquet")][0]
        os.makedirs(os.path.dirname(os.path.join(root, key)), exist_ok=True)
        os.link(os.path.join(tmpdir_path, "tmp", key, src), os.path.join(root, key))
    latest = walked = windows.latest_window_path(spark, root)
    assert walked.endswith("date=2026/01/01/window_raw_20260101T000300.parquet")
    os.makedirs(os.path.join(root, "date=2027/01/01"))  # a newer branch without window files
    assert windows.latest_window_path(spark, root) == walked
    assert windows.latest_window_path(spark, os.path.join(tmpdir_path, "missing")) is None
    allrows = windows.scan_window_files(spark, root)
    assert allrows.count() == 6 and "date" in allrows.columns
    one = windows.load_window_file(spark, root, latest)
    assert one.count() == 2 and one.select(F.max("date")).first()[0] == 2026


def test_csv_dimensions_by_header_name(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "af.csv")
    with open(p, "w") as fh:
        fh.write("ICAO24,registration,manufacturer,model,typecode,operatoricao,operator,icaoaircrafttype\n"
                 '00abc1,N1,"Boeing, ""Co""\nInc",M,B738,OPI,,L2J\n')
    rows = windows.read_airframes_csv(spark, p, multiline=True).collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r.icao24, r.registration, r.model, r.typecode, r.icaoaircrafttype, r.operator, r.operatoricao) == (
        "00abc1", "N1", "M", "B738", "L2J", None, "OPI")
    m = os.path.join(tmpdir_path, "md.csv")
    with open(m, "w") as fh:
        fh.write("AircraftDescription,Description,Designator,EngineCount,ModelFullName,WTC\nLandPlane,L2J,B738,2,737-800,M\n")
    t = windows.read_models_csv(spark, m).first()
    assert (t.Designator, t.ModelFullName, t.AircraftDescription, t.Description, t.WTC) == ("B738", "737-800", "LandPlane", "L2J", "M")


def test_csv_with_a_missing_column_fails(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "af.csv")
    with open(p, "w") as fh:
        fh.write("icao24,model\na,M\n")
    with pytest.raises(ValueError, match="registration"):
        windows.read_airframes_csv(spark, p)


def test_written_window_files_are_found_and_loaded(spark, tmpdir_path):
    st = roles.states(spark, SF001).filter(F.col("window_end") >= roles.states(spark, SF001).agg(F.max("window_end") - 180 * 200).scalar())
    ends = [r.window_end for r in st.select("window_end").distinct().orderBy("window_end").collect()]
    for end in ends:
        windows.write_window(st.filter(F.col("window_end") == end).drop("date"), tmpdir_path, end)
    windows.write_window(st.filter(F.col("window_end") == ends[0]).drop("date"), tmpdir_path, ends[0])  # replaces itself
    assert windows.scan_window_files(spark, tmpdir_path).count() == st.count()
    newest = windows.load_window_file(spark, tmpdir_path, windows.latest_window_path(spark, tmpdir_path))
    assert {r.window_end for r in newest.collect()} == {ends[-1]}


def test_catalog(spark):
    roles.airframes(spark, SF001).createOrReplaceTempView("airframes_t")
    prof = catalog.table_profile(spark, ["airframes_t"]).first()
    assert prof.row_count == 150 and prof.column_count == 7
    assert "airframes_t" in catalog.list_tables(spark)
    assert catalog.preview(spark, "airframes_t", 3).count() == 3


def test_pandas_written_window_files(spark, tmpdir_path):
    import datetime as dt

    import pyarrow as pa
    import pyarrow.parquet as pq

    from flightlake.operators import enrich as en
    root = os.path.join(tmpdir_path, "processed")
    path = os.path.join(root, "date=2026/01/01")
    os.makedirs(path)
    start, end = dt.datetime(2026, 1, 1, 0, 0), dt.datetime(2026, 1, 1, 0, 3)
    table = pa.table({
        "icao24": ["a", "b"], "callsign": ["X1", None], "origin_country": ["c", "c"],
        "time_position": ["2026-01-01T00:01:00+00:00", None], "last_contact": ["2026-01-01T00:01:00+00:00", None],
        "longitude": [1.0, float("nan")], "latitude": [2.0, 3.0], "baro_altitude": [1000.0, 2000.0],
        "on_ground": [False, False], "velocity": [100.0, 0.0], "true_track": [1.0, 2.0],
        "vertical_rate": [5.0, -5.0], "geo_altitude": [1100.0, 2100.0], "squawk": ["0042", None],
        "spi": [False, False], "position_source": [0, 0], "snapshot_ts": [1767225660, 1767225660],
        "window_start": pa.array([start, start], pa.timestamp("us")),
        "window_end": pa.array([end, end], pa.timestamp("us")),
    })
    pq.write_table(table, os.path.join(path, "window_raw_20260101T000300.parquet"))
    obs = windows.observations_from_window_files(
        windows.load_window_file(spark, root, windows.latest_window_path(spark, root)))
    rows = {r.icao24: r for r in obs.collect()}
    assert rows["a"].time_position.isoformat() == "2026-01-01T00:01:00" and rows["b"].longitude is None
    assert rows["a"].window_end == 1767225780 and rows["a"].date == 2026 and rows["a"].obs_id != rows["b"].obs_id
    af = spark.createDataFrame([("a", "R", "M", "T1", None, "O", "OI")],
                               "icao24 string, registration string, model string, typecode string, "
                               "icaoaircrafttype string, operator string, operatoricao string")
    md = spark.createDataFrame([("T1", "Type One", "L", "D1", "Medium")],
                               "Designator string, ModelFullName string, AircraftDescription string, "
                               "Description string, WTC string")
    e = {r.icao24: r for r in en.enrich(obs, af, md).collect()}
    assert e["a"].Description == "D1" and e["b"].Description is None and e["a"].climb_rate_ratio == 0.05


def test_malformed_lines_kept_in_corrupt_column(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "landed")
    os.makedirs(p)
    with open(os.path.join(p, "a.json"), "w") as fh:
        fh.write('{"icao24":"a","snapshot_ts":10}\n{"icao24": broken\n')
    rows = snapshots.read_snapshots(spark, p).cache()
    bad = rows.filter(F.col("_corrupt_record").isNotNull()).collect()
    assert rows.count() == 2 and len(bad) == 1 and bad[0].icao24 is None


def test_all_windows_in_one_write(spark, tmpdir_path):
    """Each window stands in its own file; a window written again replaces itself and no other."""
    from pyspark.sql import functions as F
    from flightlake.plans import roles
    st = roles.states_from_events(spark.read.parquet(f"{SF001}/events.parquet"), 12 * 3600).drop("date")
    ends = sorted(r[0] for r in st.select("window_end").distinct().collect())
    jobs = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("all windows", "")
    assert windows.write_windows(st, tmpdir_path) == len(ends)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs.getJobIdsForGroup("all windows")) <= 4  # not one for each of the windows
    back = windows.scan_window_files(spark, tmpdir_path)
    assert back.drop("date").exceptAll(st).count() == 0 and back.count() == st.count()
    one = windows.load_window_file(spark, tmpdir_path, windows.latest_window_path(spark, tmpdir_path))
    assert {r[0] for r in one.select("window_end").distinct().collect()} == {ends[-1]}
    windows.write_windows(st.filter(F.col("window_end") == ends[0]).limit(1), tmpdir_path)
    again = windows.scan_window_files(spark, tmpdir_path)
    assert again.count() == st.filter(F.col("window_end") != ends[0]).count() + 1
    assert windows.write_windows(st.limit(0), tmpdir_path) == 0
    assert not [n for n in os.listdir(tmpdir_path) if n.startswith("_staging")]
