import numpy as np
from pyspark.sql import functions as F

from flightlake.operators import iforest as isf

FEATS = ["latitude", "longitude", "baro_altitude", "velocity", "vertical_rate"]


def data(spark, n=1000, extreme=5, seed=0):
    rng = np.random.default_rng(seed)
    rows = [(i, f"CS{i}", *map(float, rng.normal(0, 1, 5))) for i in range(n)]
    rows += [(n + j, f"OUT{j}", *[float(50 + 10 * j)] * 5) for j in range(extreme)]
    return spark.createDataFrame(rows, "obs_id long, callsign string, " + ", ".join(f"{f} double" for f in FEATS))


def test_c_factor_hand_values():
    c = isf.c_factor([0, 1, 2, 3, 256])
    assert c[0] == 0 and c[1] == 0 and c[2] == 1
    assert abs(c[3] - (2 * (np.log(2) + 0.5772156649) - 4 / 3)) < 1e-12
    assert abs(c[4] - (2 * (np.log(255) + 0.5772156649) - 2 * 255 / 256)) < 1e-12


def test_planted_outliers_flagged_and_partition_independent(spark):
    df = data(spark)
    a = isf.fit_predict(df, FEATS, keep=("callsign",))
    flagged = {r.callsign for r in a.filter("anomaly = -1").collect()}
    assert {f"OUT{j}" for j in range(5)} <= flagged
    # the 1st percentile interpolates at rank (1005 - 1) * 0.01 = 10.04, so ranks 0..10 lie strictly below it
    assert len(flagged) == 11
    sc = a.agg(F.min("score"), F.max("score")).first()
    assert 0 < sc[0] and sc[1] < 1
    b = isf.fit_predict(df.repartition(5), FEATS, keep=("callsign",))
    sa = {r.obs_id: r.score for r in a.collect()}
    sb = {r.obs_id: r.score for r in b.collect()}
    assert sa == sb


def test_scores_match_python_traversal(spark):
    df = data(spark, n=300, extreme=2, seed=4)
    model = isf.fit(df, FEATS, n_trees=10, max_samples=64)
    got = {r.obs_id: r.score for r in isf.score(df, model).collect()}
    trees = [{n.node: n for n in t.itertuples()} for _, t in model.nodes.groupby("tree")]
    cpsi = isf.c_factor([model.psi])[0]
    for r in df.limit(20).collect():
        x = [r[f] for f in FEATS]
        hs = []
        for nodes in trees:
            k = 1
            while nodes[k].feature >= 0:
                k = 2 * k + (x[nodes[k].feature] >= nodes[k].threshold)
            hs.append(nodes[k].depth + isf.c_factor([nodes[k].size])[0])
        assert abs(got[r.obs_id] - 2 ** (-np.mean(hs) / cpsi)) < 1e-9


def test_subsample_size_and_depth(spark):
    df = data(spark, n=2000, extreme=0)
    model = isf.fit(df, FEATS, n_trees=20, max_samples=256)
    roots = model.nodes[model.nodes.node == 1]
    assert len(roots) == 20 and (roots["size"] == 256).all()
    assert model.nodes["depth"].max() <= 8


def test_children_share_out_their_parents_rows(spark):
    nodes = isf.fit(data(spark), FEATS, n_trees=5, max_samples=64).nodes
    size = {(n.tree, n.node): n.size for n in nodes.itertuples()}
    for n in nodes.itertuples():
        if n.feature >= 0:
            assert size[n.tree, 2 * n.node] + size[n.tree, 2 * n.node + 1] == n.size
        else:
            assert (n.tree, 2 * n.node) not in size


def test_sampling_is_one_path_at_every_size(spark):
    """Rows so many that not every row enters the draw: trees stay full, uniform and independent."""
    n, psi, trees = 20_000, 8, 10
    q, per_tree = isf.rates(n, psi, trees)
    assert q < 1 and abs(q * per_tree - (4 * psi + 64) / n) < 1e-12
    df = spark.range(n).selectExpr("id AS obs_id", *[f"CAST(id % 97 AS DOUBLE) AS {f}" for f in FEATS])
    rows = isf.sample(df, n, psi, trees).select("tree", "obs_id").collect()
    by_tree = {t: {r.obs_id for r in rows if r.tree == t} for t in range(trees)}
    assert all(len(ids) == psi for ids in by_tree.values())
    # drawn with replacement between trees, as independent draws are: over seeds, trees do share rows
    shared = 0
    for seed in range(8):
        rows = isf.sample(df, 1000, psi, trees, seed).select("tree", "obs_id").collect()
        shared += len(rows) - len({r.obs_id for r in rows})
    assert shared > 0
    model = isf.fit(df, FEATS, n_trees=trees, max_samples=psi)
    assert model.nodes["tree"].nunique() == trees


def test_missing_rows_of_a_tree_are_an_error(spark, monkeypatch):
    import pytest
    monkeypatch.setattr(isf, "rates", lambda n, psi, n_trees: (0.05, 1.0))
    with pytest.raises(RuntimeError, match="trees grew"):
        isf.fit(data(spark, n=400), FEATS, n_trees=5, max_samples=128)


def test_empty_input(spark):
    df = data(spark).filter(F.lit(False))
    out = isf.fit_predict(df, FEATS, keep=("callsign",))
    assert out.count() == 0
