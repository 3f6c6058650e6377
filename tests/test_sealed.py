import os

from pyspark.sql import functions as F

from flightlake.sources import snapshots
from flightlake.streaming import sealed as sl
from flightlake.streaming import windows as sw

BASE = 1_704_067_200  # a window boundary
COLUMNS = "obs_id bigint, icao24 string, snapshot_ts bigint"


def batch(spark, stamps, first=0):
    rows = [(first + i, "" if i % 3 == 0 else f"k{i % 5}", BASE + t) for i, t in enumerate(stamps)]
    df = spark.createDataFrame(rows, COLUMNS)
    missing = [f for f in sw.RAW_SCHEMA if f.name in sw.RAW_COLUMNS and f.name not in df.columns]
    return df.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in missing])


def size(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names)


def test_windows_are_sealed_and_replays_change_nothing(spark, tmpdir_path):
    sealed = []
    write = sl.sealing_sink(tmpdir_path, on_sealed=lambda seals, epoch: sealed.append((epoch, sorted(r.window_start - BASE for r in seals.collect()))))
    assert sl.read_sealed(spark, tmpdir_path).count() == 0
    batches = [[10, 100, 179], [185], [170, 200], [150, 300], [380], [1000]]
    got = lambda: {r.window_start - BASE: (r.n_obs, r.unique_aircraft) for r in sl.sealed_summary(spark, tmpdir_path).collect()}
    for epoch, stamps in enumerate(batches):
        write(batch(spark, stamps, 100 * epoch), epoch)
        once = got()
        write(batch(spark, stamps, 100 * epoch), epoch)
        assert got() == once
    # 185 puts the mark at 175: 170 is in time. 200 puts it at 190: 150 is late.
    assert {w: n for w, (n, _) in got().items()} == {0: 4, 180: 3, 360: 1}
    assert sealed[::2] == [(0, []), (1, []), (2, [0]), (3, []), (4, [180]), (5, [360])]
    write(batch(spark, []), 6)
    assert len(got()) == 3


def test_state_does_not_grow_with_the_rows_of_a_window(spark, tmpdir_path):
    sizes = []
    for name, n in (("few", 20), ("many", 20_000)):
        write = sl.sealing_sink(f"{tmpdir_path}/{name}")
        write(batch(spark, [i % 170 for i in range(n)]).coalesce(1), 0)
        sizes.append(size(f"{tmpdir_path}/{name}/open") + size(f"{tmpdir_path}/{name}/progress"))
    assert abs(sizes[1] - sizes[0]) < 200


def test_committed_action_runs_once_for_an_epoch(spark, tmpdir_path):
    seen = []
    act = sw.committed(lambda summary, epoch: seen.append(epoch), f"{tmpdir_path}/ledger")
    for epoch in (0, 1, 1, 0, 2):
        act(spark.range(1), epoch)
    assert seen == [0, 1, 2]

    def breaks(summary, epoch):
        seen.append(-epoch)
        if len(seen) < 5:
            raise RuntimeError("not done")
    act = sw.committed(breaks, f"{tmpdir_path}/ledger")
    try:
        act(spark.range(1), 7)
    except RuntimeError:
        pass
    act(spark.range(1), 7)  # an action that failed was not entered
    act(spark.range(1), 7)
    assert seen[3:] == [-7, -7]


def test_records_in_folders_below(spark, tmpdir_path):
    rows = batch(spark, [1, 2, 3]).withColumn("part", F.col("obs_id").cast("int") % 2)
    snapshots.encode_records(rows, keep=("part",)).write.partitionBy("part").text(f"{tmpdir_path}/landed")
    assert snapshots.read_snapshots(spark, f"{tmpdir_path}/landed", recursive=True).count() == 3
