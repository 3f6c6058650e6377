from flightlake.plans import refresh, roles
from flightlake.session import shared_path
from conftest import SF001


def test_refresh_writes_every_output(spark):
    st, af, md = roles.states(spark, SF001), roles.airframes(spark, SF001), roles.models(spark, SF001)
    out = {r.output: r.rows for r in refresh.refresh(spark, st, af, md, shared_path(spark, "t-refresh")).collect()}
    assert out["enriched_aircraft_states"] > st.count()
    assert out["latest_window"] >= 1 and out["window_anomaly_scores"] >= 1
    assert out["altitude_band_counts"] == 4 and out["speed_histogram"] == 30
    assert out["position_density"] == 40000
    assert set(out) >= {"coverage", "window_anomalies", "anomaly_map", "envelope_rows", "vertical_status",
                        "category_profile", "category_radar", "flagged_anomalies", "statistical_anomalies"}


def test_refresh_from_stream_output(spark, tmpdir_path):
    from pyspark.sql import functions as F

    from flightlake.functions import scalar as fx
    from flightlake.sources import snapshots
    from flightlake.streaming import windows as sw
    st = roles.states(spark, SF001)
    st = st.withColumn("day", F.date_format(fx.epoch_to_timestamp_ntz("snapshot_ts"), "yyyy-MM-dd"))
    snapshots.write_snapshots(st.select(*sw.RAW_COLUMNS, "day"), f"{tmpdir_path}/landed", partition_col="day")
    q = sw.start_window_job(spark, snapshots.read_snapshots(spark, f"{tmpdir_path}/landed", stream=True),
                            f"{tmpdir_path}/win", f"{tmpdir_path}/ckpt", available_now=True)
    q.awaitTermination()
    raw, _ = sw.read_window_outputs(spark, f"{tmpdir_path}/win")
    newest = raw.agg(F.max("window_end")).first()[0]
    n_newest = raw.filter(F.col("window_end") == newest).count()
    newest = refresh.newest_window_from_outputs(spark, f"{tmpdir_path}/win")
    plan = newest._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(window_date" in plan and "EqualTo(window_end" in plan
    assert newest.count() == n_newest
    out = {r.output: r.rows for r in refresh.refresh_from_windows(
        spark, f"{tmpdir_path}/win", roles.airframes(spark, SF001), roles.models(spark, SF001),
        f"{tmpdir_path}/refresh").collect()}
    assert out["enriched_aircraft_states"] >= n_newest >= 1


def test_cli_inspect(tmpdir_path, capsys):
    import subprocess
    import sys
    import os
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run([sys.executable, "-m", "flightlake", "inspect", "--table",
                          f"events={SF001}/events.parquet"], cwd=repo, capture_output=True, text=True, timeout=300)
    assert out.returncode == 0, out.stderr[-2000:]
    assert "events\trows=1000" in out.stdout


def test_cli_refresh_from_window_files(tmpdir_path):
    import datetime as dt
    import os
    import subprocess
    import sys

    import pyarrow as pa
    import pyarrow.parquet as pq
    root = os.path.join(tmpdir_path, "processed")
    for day, stamp, n in (("2025/12/31", "20251231T235700", 3), ("2026/01/01", "20260101T000300", 40)):
        os.makedirs(os.path.join(root, f"date={day}"))
        end = dt.datetime.strptime(stamp, "%Y%m%dT%H%M%S")
        cols = {"icao24": [f"k{i % 7}" for i in range(n)], "callsign": [f"C{i}" for i in range(n)],
                "time_position": [end.isoformat()] * n, "last_contact": [end.isoformat()] * n,
                "latitude": [float(i) for i in range(n)], "longitude": [float(-i) for i in range(n)],
                "baro_altitude": [1000.0 + i for i in range(n)], "geo_altitude": [1000.0 + i for i in range(n)],
                "velocity": [100.0 + i for i in range(n)], "vertical_rate": [float(i % 5) for i in range(n)],
                "snapshot_ts": [int(end.timestamp())] * n,
                "window_start": pa.array([end - dt.timedelta(minutes=3)] * n, pa.timestamp("us")),
                "window_end": pa.array([end] * n, pa.timestamp("us"))}
        pq.write_table(pa.table(cols), os.path.join(root, f"date={day}", f"window_raw_{stamp}.parquet"))
    with open(os.path.join(tmpdir_path, "af.csv"), "w") as fh:
        fh.write("icao24,registration,model,typecode,icaoaircrafttype,operator,operatoricao\nk1,R,M,T1,,O,OI\n")
    with open(os.path.join(tmpdir_path, "md.csv"), "w") as fh:
        fh.write("Designator,ModelFullName,AircraftDescription,Description,WTC\nT1,Type One,L,D1,M\n")
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run([sys.executable, "-m", "flightlake", "refresh", "--window-files", root,
                          "--airframes", os.path.join(tmpdir_path, "af.csv"),
                          "--models", os.path.join(tmpdir_path, "md.csv"), "--out", os.path.join(tmpdir_path, "o")],
                         cwd=repo, capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-3000:]
    got = dict(line.split("\t") for line in out.stdout.strip().splitlines())
    assert got["enriched_aircraft_states"] == "40" and got["window_anomaly_scores"] == "40"


def test_cli_stream_once(tmpdir_path):
    import json
    import os
    import subprocess
    import sys

    import pyarrow.parquet as pq
    src = os.path.join(tmpdir_path, "landed")
    os.makedirs(src)
    base = 1_704_067_200
    with open(os.path.join(src, "a.json"), "w") as fh:
        for i, s in enumerate([1, 2, 3, 200, 400]):
            fh.write(json.dumps({"icao24": "a", "snapshot_ts": base + s, "obs_id": i}) + "\n")
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run([sys.executable, "-m", "flightlake", "stream", "--source", src,
                          "--out", os.path.join(tmpdir_path, "win"), "--checkpoint", os.path.join(tmpdir_path, "ck"),
                          "--once", "--max-age-minutes", "1e9"], cwd=repo, capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-3000:]
    summary = pq.read_table(os.path.join(tmpdir_path, "win", "summary")).to_pandas()
    assert sorted(zip(summary.window_start - base, summary.n_obs)) == [(0, 3), (180, 1)]


def test_outputs_are_published_together(spark):
    import pytest

    st, af, md = roles.states(spark, SF001), roles.airframes(spark, SF001), roles.models(spark, SF001)
    root = shared_path(spark, "t-published")
    with pytest.raises(ValueError):
        refresh.read_published(spark, root, "window_anomalies")
    early = st.filter("obs_id % 2 = 0")
    refresh.published(spark, root, lambda folder: refresh.refresh_window(spark, early, af, md, folder))
    read = lambda: refresh.read_published(spark, root, "window_anomaly_scores")
    held, n_early = read(), read().count()

    def fails(folder):
        refresh.refresh_window(spark, st, af, md, folder)
        raise RuntimeError("stopped before its end")

    with pytest.raises(RuntimeError, match="stopped before its end"):
        refresh.published(spark, root, fails)
    assert read().count() == n_early
    done = {r.output: r.rows for r in refresh.published(spark, root, lambda folder: refresh.refresh_window(spark, st, af, md, folder)).collect()}
    assert read().count() == done["window_anomaly_scores"] > n_early
    assert held.count() == n_early  # planned before the switch: its folder is still there
