import random

import pytest

from pyspark.sql import functions as F

from flightlake.operators import enrich as en
from flightlake.schemas import ENRICHED_COLUMNS

OBS_SCHEMA = ("obs_id long, icao24 string, origin_country string, time_position timestamp_ntz, "
              "last_contact timestamp_ntz, longitude double, latitude double, baro_altitude double, "
              "geo_altitude double, on_ground boolean, velocity double, true_track double, vertical_rate double, "
              "squawk string, spi boolean, snapshot_ts long, date int")
AF_SCHEMA = ("icao24 string, registration string, model string, typecode string, icaoaircrafttype string, "
             "operator string, operatoricao string")
MD_SCHEMA = "Designator string, ModelFullName string, AircraftDescription string, Description string, WTC string"


def obs(spark, keys):
    rows = [(i, k, "c", None, None, 1.0, 2.0, 1000.0, 1000.0, False, 100.0, 0.0, 5.0, "0001", False, 0, 2024)
            for i, k in enumerate(keys)]
    return spark.createDataFrame(rows, OBS_SCHEMA)


def af(spark, rows):
    return spark.createDataFrame([(k, f"R{k}", "m", tc, it, "op", "OPI") for k, tc, it in rows], AF_SCHEMA)


def md(spark, rows):
    return spark.createDataFrame([(d, name, "L", f"desc-{name}", "M") for d, name in rows], MD_SCHEMA)


def direct_or_join(o, a, m):
    j = o.join(a.select("icao24", "typecode", "registration", "model", "icaoaircrafttype", "operator",
                        "operatoricao"), "icao24", "left")
    return j.join(m, (j.typecode == m.Designator) | (j.icaoaircrafttype == m.Designator), "left")


def names(df):
    return sorted(((r["obs_id"], r["ModelFullName"]) for r in df.collect()), key=lambda t: (t[0], t[1] or ""))


def test_or_join_cases(spark):
    o = obs(spark, ["a", "b", "c", "d", "e", "f", "zz"])
    a = af(spark, [("a", "X", "X"), ("b", "X", "NOPE"), ("c", "X", "Y"), ("d", None, "Y"), ("e", None, None),
                   ("f", "X", None)])
    m = md(spark, [("X", "x1"), ("X", "x2"), ("Y", "y1")])
    got = names(en.enrich(o, a, m))
    assert got == sorted([(0, "x1"), (0, "x2"), (1, "x1"), (1, "x2"), (2, "x1"), (2, "x2"), (2, "y1"),
                          (3, "y1"), (4, None), (5, "x1"), (5, "x2"), (6, None)])
    assert got == names(direct_or_join(o, a, m))


def test_single_type_row_once(spark):
    o = obs(spark, ["a", "b"])
    a = af(spark, [("a", "X", "X"), ("b", "X", "NOPE")])
    m = md(spark, [("X", "x1")])
    assert names(en.enrich(o, a, m)) == [(0, "x1"), (1, "x1")]


def test_duplicate_airframes_kept(spark):
    o = obs(spark, ["a"])
    a = af(spark, [("a", "X", None), ("a", "X", None)])
    m = md(spark, [("X", "x1")])
    assert names(en.enrich(o, a, m)) == [(0, "x1"), (0, "x1")]


def test_enriched_columns_and_derivations(spark):
    o = obs(spark, ["a"])
    e = en.enrich(o, af(spark, [("a", "X", None)]), md(spark, [("X", "x1")]))
    assert e.columns == ENRICHED_COLUMNS
    r = e.first()
    assert r["climb_rate_ratio"] == 0.05 and r["altitude_km"] == 1.0


def test_rewrite_equals_or_join_random(spark):
    rnd = random.Random(7)
    keys = [str(i) for i in range(30)]
    codes = ["A", "B", "C", "D", None]
    o = obs(spark, [rnd.choice(keys + ["", "none"]) for _ in range(300)])
    a = af(spark, [(rnd.choice(keys + [None]), rnd.choice(codes), rnd.choice(codes)) for _ in range(40)])
    m = md(spark, [(rnd.choice(["A", "B", "C", "E"]), f"n{i}") for i in range(12)])
    assert names(en.enrich(o, a, m)) == names(direct_or_join(o, a, m))


@pytest.mark.parametrize("threshold", ["-1", "10m"])
def test_absent_keys_and_join_strategies(spark, threshold):
    """Shuffled and broadcast joins give the rows of the direct join, empty and null keys included."""
    rnd = random.Random(3)
    o = obs(spark, [rnd.choice(["", None, "1", "2", "3", "9"]) for _ in range(200)])
    a = af(spark, [(k, rnd.choice(["A", "B", None]), rnd.choice(["A", "C"])) for k in ["1", "2", "2", "3", "", "", None]])
    m = md(spark, [("A", "a1"), ("A", "a2"), ("B", "b1"), ("C", "c1")])
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        assert names(en.enrich(o, a, m)) == names(direct_or_join(o, a, m))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_coverage_counts(spark):
    o = obs(spark, ["a", "b", "zz", ""])
    a = af(spark, [("a", "X", None), ("b", "NOPE", None)])
    m = md(spark, [("X", "x1"), ("X", "x2")])
    par = en.coverage_parity(o, a, m).first()
    # enriched: a twice (x1, x2), b, zz, '' -> 5 rows; joined again: a rows multiply by 2 -> 7
    assert par["n_rows"] == 7 and par["n_with_airframe"] == 5 and par["n_with_type"] == 4
    cor = en.coverage_distinct(o, a, m).first()
    assert (cor["n_rows"], cor["n_aircraft"], cor["n_with_airframe"], cor["n_with_type"]) == (4, 3, 2, 1)
    assert cor["pct_with_type"] == 25.0


def test_coverage_equals_rejoined_rows(spark):
    rnd = random.Random(11)
    o = obs(spark, [rnd.choice(["1", "2", "3", "4", "", None]) for _ in range(120)])
    a = af(spark, [(rnd.choice(["1", "2", "3", None]), rnd.choice(["A", "B", None]), rnd.choice(["A", "C"])) for _ in range(9)])
    m = md(spark, [("A", "a1"), ("A", "a2"), ("B", "b1")])
    again = direct_or_join(direct_or_join(o, a, m).select("obs_id", "icao24"), a, m)
    par = en.coverage_parity(o, a, m).first()
    assert par["n_rows"] == again.count() and par["n_with_type"] == again.filter("ModelFullName IS NOT NULL").count()


def test_first_rows_are_those_of_the_whole(spark):
    o = obs(spark, [str(i % 4) for i in range(50)])
    a = af(spark, [("1", "A", None), ("2", "A", "B")])
    m = md(spark, [("A", "a1"), ("A", "a2"), ("B", "b1")])
    whole = en.enrich(o, a, m).orderBy("obs_id", F.col("ModelFullName").asc_nulls_first()).limit(17)
    assert names(en.first_enriched(o, a, m, 17)) == names(whole)


def test_empty_input(spark):
    o = obs(spark, []).filter(F.lit(False))
    e = en.enrich(o, af(spark, [("a", "X", None)]), md(spark, [("X", "x1")]))
    assert e.count() == 0 and e.columns == ENRICHED_COLUMNS


def test_large_dimensions_shuffle_the_observations_once(spark):
    """Beyond the broadcast threshold the types are looked up per airframe, and the events move once."""
    from conftest import SF001
    from flightlake.plans import roles
    st, a, m = roles.states(spark, SF001), roles.airframes(spark, SF001), roles.models(spark, SF001)
    whole = en.enrich(st, a, m)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = en.enrich(st, a, m)
        plan = df._jdf.queryExecution().executedPlan().toString()
        lines = plan.splitlines()
        scan = next(i for i, line in enumerate(lines) if "FileScan parquet" in line and "event_id" in line)
        depth = lambda line: len(line) - len(line.lstrip(" :+-|"))
        above, at = [], depth(lines[scan])
        for line in reversed(lines[:scan]):  # the operators between the events and the result
            if depth(line) < at:
                at = depth(line)
                above.append(line)
        assert sum("Exchange" in line for line in above) == 1, plan
        assert sum("Join" in line for line in above) == 1, plan
        assert df.exceptAll(whole).count() == 0 and df.count() == whole.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_types_of_airframes_keep_repeats(spark):
    a = af(spark, [("a", "X", "X"), ("a", "X", "Y"), ("b", None, None), (None, "X", None), ("", "Y", None)])
    m = md(spark, [("X", "x1"), ("X", "x2"), ("Y", "y1"), (None, "n")])
    typed = en.typed_airframes(a, m)
    got = sorted((r.icao24, r.ModelFullName or "") for r in typed.collect())
    assert got == [("", "y1"), ("a", "x1"), ("a", "x1"), ("a", "x2"), ("a", "x2"), ("a", "y1"), ("b", "")]
    o = obs(spark, ["a", "b", "", None, "zz"])
    assert names(en.enrich_typed(o, typed)) == names(direct_or_join(o, a, m))


@pytest.mark.parametrize("threshold", ["-1", "10m"])
def test_refresh_multiplies_observations_after_they_are_shuffled(spark, tmpdir_path, monkeypatch, threshold):
    """What the refresh writes as its enriched table is shuffled before the types unfold, never after."""
    from flightlake.plans import refresh

    class Seen(Exception):
        pass

    def seen(df, path, spread=False):
        raise Seen((df.hint("rebalance") if spread else df)._jdf.queryExecution().executedPlan().toString())

    monkeypatch.setattr(refresh, "write_table", seen)
    o = obs(spark, ["1", "2", "2", "", None, "9"])
    a = af(spark, [("1", "A", "B"), ("2", "B", "B"), ("2", None, "C"), ("3", "A", None), ("", "A", "B"), (None, "A", "A")])
    m = md(spark, [("A", "a1"), ("A", "a2"), ("B", "b1"), ("B", "b2"), (None, "n")])
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        with pytest.raises(Seen) as e:
            refresh.refresh(spark, o, a, m, tmpdir_path)
        above = str(e.value).split(" Exchange ")[0]
        assert "explode(__types" in above, str(e.value)
        assert names(en.enrich(o, a, m, spread=True)) == names(direct_or_join(o, a, m))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
