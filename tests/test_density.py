import math

import numpy as np
from pyspark.sql import functions as F

from flightlake.operators import density as dn


def numpy_kde2(x, y, gx, gy):
    n = len(x)
    cov = np.cov(np.vstack([x, y])) * n ** (-2.0 / 6.0)
    inv = np.linalg.inv(cov)
    out = np.zeros((len(gx), len(gy)))
    for i, a in enumerate(gx):
        for j, b in enumerate(gy):
            d = np.vstack([a - x, b - y])
            out[i, j] = np.exp(-0.5 * np.sum(d * (inv @ d), axis=0)).sum()
    return out / (n * 2 * math.pi * math.sqrt(np.linalg.det(cov)))


def test_kde2_matches_numpy_with_duplicates(spark):
    rng = np.random.default_rng(0)
    x = np.round(rng.normal(0, 3, 60), 1)
    y = np.round(0.5 * x + rng.normal(0, 1, 60), 1)
    x = np.concatenate([x, x[:10]]); y = np.concatenate([y, y[:10]])
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "lon double, lat double")
    res = dn.kde_2d_grid(df, "lon", "lat", nx=7, ny=5).collect()
    gx = np.linspace(x.min(), x.max(), 7); gy = np.linspace(y.min(), y.max(), 5)
    ref = numpy_kde2(x, y, gx, gy)
    assert len(res) == 35
    for r in res:
        assert abs(r.density - ref[r.ix, r.iy]) < 1e-11


def test_kde2_degenerate_and_empty(spark):
    line = spark.createDataFrame([(float(i), 2.0 * i) for i in range(10)], "lon double, lat double")
    assert dn.kde_2d_grid(line, "lon", "lat").count() == 0
    empty = line.filter(F.lit(False))
    assert dn.kde_2d_grid(empty, "lon", "lat").count() == 0


def test_kde1_matches_numpy(spark):
    rng = np.random.default_rng(2)
    v = rng.gamma(2.0, 20.0, 200)
    df = spark.createDataFrame([("Heavy" if i % 2 else "Light", float(a)) for i, a in enumerate(v)],
                               "WTC string, velocity double")
    got = dn.kde_1d_by_group(df, "WTC", "velocity", gridsize=20).collect()
    for g, sel in (("Heavy", v[1::2]), ("Light", v[0::2])):
        n = len(sel); bw = sel.std(ddof=1) * n ** (-0.2)
        grid = np.linspace(sel.min() - 2 * bw, sel.max() + 2 * bw, 20)
        ref = np.exp(-0.5 * ((grid[:, None] - sel[None, :]) / bw) ** 2).sum(axis=1) / (n * bw * math.sqrt(2 * math.pi))
        mine = sorted((r.point, r.density) for r in got if r.WTC == g)
        assert np.allclose([d for _, d in mine], ref, atol=1e-11)
    # integrates to about one
    heavy = sorted((r.x, r.density) for r in got if r.WTC == "Heavy")
    assert abs(np.trapezoid([d for _, d in heavy], [x for x, _ in heavy]) - 1) < 0.05


def test_kde2_integrates_to_one_on_wide_grid(spark):
    rng = np.random.default_rng(5)
    pts = rng.multivariate_normal([0, 0], [[4, 1.5], [1.5, 2]], 300)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in pts], "lon double, lat double")
    res = dn.kde_2d_grid(df, "lon", "lat", 80, 80, bounds=(-15.0, 15.0, -12.0, 12.0)).collect()
    cell = (30.0 / 79) * (24.0 / 79)
    assert abs(sum(r.density for r in res) * cell - 1.0) < 0.01


def test_tiles_and_cut_equal_the_full_sum():
    """Kernels by tiles, cut at the radius, against every kernel on every cell: nearly collinear points too."""
    import math
    import numpy as np
    from flightlake.operators.density import CUT, add_kernels
    rng = np.random.default_rng(4)
    gx, gy = np.linspace(-180, 180, 61), np.linspace(-90, 90, 47)
    x, y, w = rng.uniform(-180, 180, 300), rng.uniform(-90, 90, 300), rng.integers(1, 5, 300).astype(float)
    for sx, sy, r in ((60, 30, 0.0), (12, 4, 0.5), (3, 1, -0.9), (30, 15, 0.999), (0.5, 0.2, 0.3)):
        det = sx * sx * sy * sy * (1 - r * r)
        a, b, c = sy * sy / det, -r * sx * sy / det, sx * sx / det
        radius = math.sqrt(max(2 * math.log(1 / (CUT * 2 * math.pi * math.sqrt(det))), 1))
        acc = np.zeros((61, 47))
        add_kernels(acc, gx, gy, x, y, w, (a, b, c), radius)
        dx, dy = gx[:, None, None] - x, gy[None, :, None] - y
        full = (w * np.exp(-0.5 * (a * dx * dx + 2 * b * dx * dy + c * dy * dy))).sum(axis=2)
        norm = w.sum() * 2 * math.pi * math.sqrt(det)
        assert np.abs(acc - full).max() / norm < 1e-14
