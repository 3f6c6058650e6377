import pytest
from conftest import SF001
from pyspark.sql import functions as F

from flightlake.operators import anomalies as an
from flightlake.operators import enrich as en
from flightlake.operators import profiles as pf
from flightlake.plans import incremental as inc
from flightlake.plans import roles
from flightlake.sources import versions


def rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def test_runs_equal_one_full_refresh_and_survive_a_failure(spark, tmpdir_path, monkeypatch):
    st, a, m = roles.states(spark, SF001), roles.airframes(spark, SF001), roles.models(spark, SF001)
    lo, hi = st.agg(F.min("window_end"), F.max("window_end")).first()
    root = f"{tmpdir_path}/state"
    first = inc.refresh_new_windows(spark, st.filter(F.col("window_end") <= (lo + hi) // 2), a, m, root)
    half = rows(inc.read_output(spark, root, "vertical_status"))

    # A run that dies after writing some of its tables changes nothing that readers see.
    def stop(*args, **kwargs):
        raise RuntimeError("lost")
    with monkeypatch.context() as patch:
        patch.setattr(inc.versions, "commit", stop)
        with pytest.raises(RuntimeError, match="lost"):
            inc.refresh_new_windows(spark, st, a, m, root)
    assert versions.current(spark, root) == first and rows(inc.read_output(spark, root, "vertical_status")) == half

    second = inc.refresh_new_windows(spark, st, a, m, root)
    assert first.facts["rows"] + second.facts["rows"] == st.count() and second.facts["window_end"] == hi
    assert inc.refresh_new_windows(spark, st, a, m, root) is None  # nothing new
    enriched = en.enrich(st, a, m)
    want = {
        "enriched_aircraft_states": enriched,
        "coverage": en.coverage_distinct(st, a, m),
        "altitude_band_counts": pf.altitude_band_counts(enriched),
        "vertical_status": pf.vertical_status_counts(pf.prepare(enriched)),
        "speed_histogram": pf.speed_histogram(enriched),
        "category_profile": pf.category_profile(enriched),
        "category_radar": pf.category_radar(enriched),
        "flagged_anomalies": an.flagged_only(an.flag_anomalies(st)),
        "latest_window": en.latest_window_frame(st, a, m),
    }
    for name, df in want.items():
        assert rows(inc.read_output(spark, root, name)) == rows(df), name


def test_replaced_table_keeps_the_old_version_until_the_commit(spark, tmpdir_path):
    root = f"{tmpdir_path}/t"
    with pytest.raises(ValueError, match="no table"):
        versions.read_table(spark, root)
    versions.replace_table(spark.range(3), root, note="a")
    old = versions.read_table(spark, root)
    started = versions.begin(spark, root)
    spark.range(9).write.parquet(started.folder)
    assert versions.read_table(spark, root).count() == 3  # written, not committed
    with pytest.raises(Exception):
        versions.replace_table(spark.range(5).select(F.raise_error(F.lit("no")).alias("x")), root)
    assert versions.read_table(spark, root).count() == 3 and versions.current(spark, root).facts == {"note": "a"}
    versions.commit(spark, root, started)
    assert versions.read_table(spark, root).count() == 9 and old.count() == 3  # who began with the old goes on
    other = versions.Version(2, f"{root}/v-0000000002-late", {})
    with pytest.raises(RuntimeError, match="not committed"):
        versions.commit(spark, root, other)
    versions.replace_table(spark.range(4), root)
    assert [v.number for v in versions.history(spark, root)] == [1, 2, 3]
    assert versions.vacuum(spark, root, keep=1) >= 2 and versions.read_table(spark, root).count() == 4
    assert [v.number for v in versions.history(spark, root)] == [3]
