import json
import os

from flightlake.sources import snapshots
from flightlake.streaming import windows as sw


def drop(path, name, stamps, key="a"):
    with open(os.path.join(path, name), "w") as fh:
        for i, s in enumerate(stamps):
            fh.write(json.dumps({"icao24": key if i % 2 == 0 else "", "snapshot_ts": s,
                                 "obs_id": s * 10 + i}) + "\n")


def run(spark, src, root, max_files=None):
    source = snapshots.read_snapshots(spark, src, stream=True, max_files_per_trigger=max_files)
    q = sw.start_window_job(spark, source, f"{root}/out", f"{root}/ckpt", available_now=True, buckets=4)
    q.awaitTermination()
    raw, summary = sw.read_window_outputs(spark, f"{root}/out")
    return raw, summary


def test_ordered_drops_lateness_and_open_window(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "src")
    os.makedirs(src)
    base = 1_704_067_200  # a window boundary
    for i, stamps in enumerate([[10, 100, 179], [185], [170, 200], [150, 300], [380], [1000]]):
        drop(src, f"f{i}.json", [base + s for s in stamps])
        os.utime(os.path.join(src, f"f{i}.json"), (1_000_000 + i, 1_000_000 + i))
    raw, summary = run(spark, src, tmpdir_path, max_files=1)
    got = {r.window_start - base: r.n_obs for r in summary.collect()}
    assert got == {0: 5, 180: 3, 360: 1}
    # window edges: [start, end)
    edges = {r.snapshot_ts - base: r.window_start - base for r in raw.collect()}
    assert edges[179] == 0 and edges[185] == 180
    # unique aircraft excludes the empty key
    assert {r.unique_aircraft for r in summary.collect()} == {1}


def test_restart_from_checkpoint_no_duplicates(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "src")
    os.makedirs(src)
    base = 1_704_067_200
    drop(src, "a.json", [base + s for s in [1, 2, 3, 200]])
    run(spark, src, tmpdir_path)
    drop(src, "b.json", [base + s for s in [201, 400]])
    raw, summary = run(spark, src, tmpdir_path)
    got = sorted((r.window_start - base, r.n_obs) for r in summary.collect())
    assert got == [(0, 3), (180, 2)]
    assert raw.count() == 5 and raw.select("obs_id").distinct().count() == 5


def test_recency_filter_in_stream(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "src")
    os.makedirs(src)
    base = 1_704_067_200
    drop(src, "a.json", [base + s for s in [0, 10, 600, 610, 1000]])
    source = snapshots.read_snapshots(spark, src, stream=True)
    q = sw.start_window_job(spark, source, f"{tmpdir_path}/out", f"{tmpdir_path}/ckpt", available_now=True,
                            max_age_minutes=9, now=base + 1000)
    q.awaitTermination()
    _, summary = sw.read_window_outputs(spark, f"{tmpdir_path}/out")
    assert sorted((r.window_start - base, r.n_obs) for r in summary.collect()) == [(540, 2)]


def test_callback_and_progress_listener(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "src")
    os.makedirs(src)
    base = 1_704_067_200
    drop(src, "a.json", [base + s for s in [1, 2, 3, 200, 400]])
    seen = []
    listener = sw.ProgressLogger(every_rows=2)
    spark.streams.addListener(listener)
    try:
        source = snapshots.read_snapshots(spark, src, stream=True)
        q = sw.start_window_job(spark, source, f"{tmpdir_path}/out", f"{tmpdir_path}/ckpt", available_now=True,
                                on_closed=lambda summary, epoch: seen.extend(
                                    (r.window_start - base, r.n_obs) for r in summary.collect()))
        q.awaitTermination()
    finally:
        spark.streams.removeListener(listener)
    assert sorted(seen) == [(0, 3), (180, 1)]


def test_bad_lines_do_not_move_the_watermark(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "src")
    os.makedirs(src)
    base = 1_704_067_200
    for i, stamps in enumerate([[10, 100], [185], [170], [700]]):
        drop(src, f"f{i}.json", [base + s for s in stamps])
        with open(os.path.join(src, f"f{i}.json"), "a") as fh:
            fh.write('{"icao24": broken\n{"icao24": "unstamped"}\n')
        os.utime(os.path.join(src, f"f{i}.json"), (1_000_000 + i, 1_000_000 + i))
    raw, summary = run(spark, src, tmpdir_path, max_files=1)
    assert {r.window_start - base: r.n_obs for r in summary.collect()} == {0: 3, 180: 1}
    q = sw.start_rejects_job(snapshots.read_snapshots(spark, src, stream=True), f"{tmpdir_path}/rejects", f"{tmpdir_path}/ck2")
    q.awaitTermination()
    kept = spark.read.parquet(f"{tmpdir_path}/rejects").groupBy("reason").count().collect()
    assert {r.reason: r["count"] for r in kept} == {"malformed": 4, "no stamp": 4}


def test_nothing_closed_yet_reads_as_empty(spark, tmpdir_path):
    from flightlake.plans import refresh, roles
    from conftest import SF001
    src = os.path.join(tmpdir_path, "src")
    os.makedirs(src)
    drop(src, "a.json", [1_704_067_200 + 5])
    raw, summary = run(spark, src, tmpdir_path)
    assert raw.count() == 0 and summary.count() == 0
    raw, summary = sw.read_window_outputs(spark, f"{tmpdir_path}/never-run")
    assert raw.count() == 0 and summary.count() == 0
    out = refresh.refresh_from_windows(spark, f"{tmpdir_path}/out", roles.airframes(spark, SF001), roles.models(spark, SF001),
                                       f"{tmpdir_path}/refresh")
    assert {r.rows for r in out.collect()} == {0}


def test_closed_windows_as_window_files(spark, tmpdir_path):
    from flightlake.sources import windows as wf
    src = os.path.join(tmpdir_path, "src")
    os.makedirs(src)
    base = 1_704_067_200
    drop(src, "a.json", [base + s for s in [1, 2, 3, 200, 400]])
    q = sw.start_window_job(spark, snapshots.read_snapshots(spark, src, stream=True), f"{tmpdir_path}/out", f"{tmpdir_path}/ck",
                            files_root=f"{tmpdir_path}/files")
    q.awaitTermination()
    assert wf.latest_window_path(spark, f"{tmpdir_path}/files").endswith("date=2024/01/01/window_raw_20240101T000600.parquet")
    assert wf.scan_window_files(spark, f"{tmpdir_path}/files").count() == 4


def test_broker_time_as_event_time(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "src")
    os.makedirs(src)
    with open(os.path.join(src, "m.json"), "w") as fh:
        for i, second in enumerate([5, 6, 200, 600]):
            value = json.dumps({"icao24": "a", "snapshot_ts": 1, "obs_id": i})
            fh.write(json.dumps({"value": value, "timestamp": f"2024-01-01T00:{second // 60:02d}:{second % 60:02d}"}) + "\n")
    messages = spark.readStream.schema("value string, timestamp timestamp").json(src)
    q = sw.start_window_job(spark, snapshots.decode_messages(messages), f"{tmpdir_path}/out", f"{tmpdir_path}/ck", event_time="broker_time")
    q.awaitTermination()
    _, summary = sw.read_window_outputs(spark, f"{tmpdir_path}/out")
    assert sorted((r.window_start - 1_704_067_200, r.n_obs) for r in summary.collect()) == [(0, 2), (180, 1)]
