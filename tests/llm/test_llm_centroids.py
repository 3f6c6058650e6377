import hashlib
import random

import numpy as np
import pytest

from flightlake.llm.centroids import centroid_clusters, component_sums, dots, pack, plane_weights, planes_needed

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute(rows, clusters=40, rounds=5):
    usable = [(i, [int(np.floor(256 * float(np.float32(x)))) for x in v]) for i, v, _ in rows
              if v is not None and len(v) == 64 and all(x is not None and np.isfinite(x) for x in v)]
    name = lambda i: hashlib.sha256(f"2:{'' if i is None else i}".encode()).hexdigest()
    centroids = [v for _, v in sorted(usable, key=lambda r: (name(r[0]), r[1]))[:clusters]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(centroids))
    for _ in range(rounds):
        member = {}
        for _, v in usable:
            member.setdefault(near(v)[1], []).append(v)
        for k, vs in member.items():
            centroids[k] = [sum(c) // len(vs) for c in zip(*vs)]
    found = [(i, *near(v)[::-1]) for i, v in usable]
    inertia = {k: sum(d for _, c, d in found if c == k) for k in range(len(centroids))}
    prints = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, k, d, inertia[k], sum(inertia.values()), prints[k]) for i, k, d in found), key=repr)


def vectors(seed, n):
    rng = random.Random(seed)
    centres = [[rng.uniform(-0.5, 0.5) for _ in range(64)] for _ in range(5)]
    out = [(i, [c + rng.gauss(0, 0.1) for c in rng.choice(centres)], i) for i in range(n)]
    zero, bad = [0.0] * 64, [0.5] * 63
    out += [(900, None, 1), (901, [], 1), (902, bad, 1), (903, [*bad, 0.1, 0.2], 1), (904, [*bad, None], 1), (905, [*bad, float("nan")], 1),
            (906, [*bad, float("inf")], 1), (907, [*bad, float("-inf")], None), (None, zero, 1), (908, zero, 1), (908, zero, 1), (908, [*bad, -7.25], 1)]
    return out


@pytest.mark.parametrize("n,clusters", [(150, 40), (10, 40), (90, 3)])
def test_matches_brute_force(spark, n, clusters):
    rows = vectors(n, n)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3).selectExpr("*", "1 AS cluster", "2 AS vector", "'x' AS planes", "3 AS `a.b`", "4 AS norm")
    got = centroid_clusters(df, clusters=clusters)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows, clusters)


def test_bit_planes_are_exact():
    rng = np.random.default_rng(7)
    for size in (1, 5, 300, (1 << 27) - 1):
        v = rng.integers(-size, size, (70, 64), endpoint=True)
        planes = planes_needed(v.min(), v.max())
        p = pack(v, planes)
        assert p.shape == (70, planes) and ((dots(p, p[:9]) == v @ v[:9].T).all())
        bits = ((p[:, :, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)).astype(np.int64)
        assert (np.einsum("npj,p->nj", bits, plane_weights(planes)) == v).all()
        group = rng.integers(0, 4, 70)
        assert (component_sums(p, group, 4) == [v[group == k].sum(axis=0) for k in range(4)]).all()
    assert [planes_needed(*r) for r in ((0, 0), (-1, 0), (0, 1), (-2, 1), (-3, 3), (-128, 127), (-129, 0))] == [1, 1, 2, 2, 3, 8, 9]


def test_nothing_usable_and_too_large(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert centroid_clusters(none).count() == 0
    odd = spark.createDataFrame([(1, None, 1), (2, [1.0], 2)], SCHEMA)
    assert centroid_clusters(odd).count() == 0 and centroid_clusters(odd).columns[0] == "vec_id"
    with pytest.raises(ValueError, match="less than"):
        centroid_clusters(spark.createDataFrame([(1, [1e6] * 64, 1)], SCHEMA))
