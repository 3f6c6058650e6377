"""Gaussian kernel density on a fixed grid (Scott bandwidth), computed as distributed partial sums.

Equal points are combined first. Each task adds the kernels of its points to the grid cells in their reach and
emits one partial value per cell; cells are then summed. The grid has ``nx * ny`` cells, a parameter, so what each task holds
and emits does not grow with the data. The sample covariance (ddof 1) is one aggregate.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROUND_COORD = 6
ROUND_DENSITY = 12
BLOCK = 4096  # points at once
CUT = 1e-17  # density that cut kernels may leave out in a cell: far below half a unit of the last digit
TILE_REACH = 4.0  # half the side of a tile of cells, in standard deviations: keeps every exponent small


def add_kernels(acc, gx, gy, x, y, w, inverse, radius) -> None:
    """Add the kernels of weighted points to the grid ``acc``, each within ``radius`` standard deviations.

    The grid is cut into tiles. Seen from a tile's centre the exponent of point and cell is a term of the point,
    one of the point and the cell's column, one of the point and its row, and one of the cell alone. So a tile is a
    product of two matrices, columns by points and points by rows: a point costs an exponential for each row and
    column of the tiles in its reach, not for each cell.
    """
    a, b, c = inverse
    sides = []
    for g, k in ((gx, a), (gy, c)):
        step = abs(g[1] - g[0]) if len(g) > 1 else 0.0
        n = len(g) if step == 0 else max(1, int(2 * TILE_REACH / math.sqrt(k) / step))
        sides.append([(i, min(i + n, len(g))) for i in range(0, len(g), n)])
    for i0, i1 in sides[0]:
        for j0, j1 in sides[1]:
            cx, cy = (gx[i0] + gx[i1 - 1]) / 2, (gy[j0] + gy[j1 - 1]) / 2
            u, v = gx[i0:i1] - cx, gy[j0:j1] - cy
            dx, dy = x - cx, y - cy
            square = a * dx * dx + 2 * b * dx * dy + c * dy * dy
            near = square <= (radius + math.sqrt(a) * abs(u[0]) + math.sqrt(c) * abs(v[0])) ** 2
            if not near.any():
                continue
            dx, dy, q = dx[near], dy[near], square[near]
            columns = np.exp(np.multiply.outer(a * dx + b * dy, u) - 0.5 * a * u * u)
            rows = w[near, None] * np.exp(np.multiply.outer(b * dx + c * dy, v) - 0.5 * c * v * v - 0.5 * q[:, None])
            acc[i0:i1, j0:j1] += (columns.T @ rows) * np.exp(-b * np.multiply.outer(u, v))


def kde_2d_grid(df: DataFrame, x_col: str, y_col: str, nx: int = 200, ny: int = 200,
                bounds: tuple | None = None) -> DataFrame:
    """Density of (x, y) on an ``nx`` x ``ny`` grid spanning the data range (ends included).

    Returns ``(ix, iy, x, y, density)``; empty when there are fewer than two points or when the
    covariance is singular (constant or collinear coordinates). ``bounds`` = ``(x0, x1, y0, y1)`` fixes
    the grid extent (e.g. a map view) instead of the data range. One job takes the moments, one the sums.
    """
    spark = df.sparkSession
    pts = df.select(F.col(x_col).cast("double").alias("x"), F.col(y_col).cast("double").alias("y")).filter(
        F.col("x").isNotNull() & F.col("y").isNotNull() & ~F.isnan("x") & ~F.isnan("y"))
    st = pts.agg(F.count(F.lit(1)).alias("n"), F.var_samp("x").alias("vx"), F.var_samp("y").alias("vy"),
                 F.covar_samp("x", "y").alias("cxy"), F.min("x").alias("x0"), F.max("x").alias("x1"),
                 F.min("y").alias("y0"), F.max("y").alias("y1")).first()
    schema = "ix int, iy int, x double, y double, density double"
    n = st["n"]
    if n is None or n < 2 or st["vx"] is None:
        return spark.createDataFrame([], schema)
    f2 = n ** (-2.0 / 6.0)  # Scott factor squared, d = 2
    sxx, syy, sxy = st["vx"] * f2, st["vy"] * f2, st["cxy"] * f2
    det = sxx * syy - sxy * sxy
    if not (det > 0):
        return spark.createDataFrame([], schema)
    x0, x1, y0, y1 = bounds if bounds is not None else (st["x0"], st["x1"], st["y0"], st["y1"])
    gx = np.array([x0 + i * (x1 - x0) / (nx - 1) for i in range(nx)])
    gy = np.array([y0 + j * (y1 - y0) / (ny - 1) for j in range(ny)])
    inverse = syy / det, -sxy / det, sxx / det
    # Kernels end where all that lies beyond, summed over every point, stays under CUT in any cell's density.
    radius = math.sqrt(max(2.0 * math.log(1.0 / (CUT * 2.0 * math.pi * math.sqrt(det))), 1.0))
    shared = spark.sparkContext.broadcast((gx, gy))

    def partial(batches):
        grid = shared.value
        acc = np.zeros((len(grid[0]), len(grid[1])))
        for pdf in batches:
            x, y, w = (pdf[k].to_numpy(dtype=float) for k in ("x", "y", "w"))
            for s in range(0, len(x), BLOCK):
                add_kernels(acc, grid[0], grid[1], x[s:s + BLOCK], y[s:s + BLOCK], w[s:s + BLOCK], inverse, radius)
        ix, iy = np.nonzero(acc)
        yield pd.DataFrame({"ix": ix.astype("int32"), "iy": iy.astype("int32"), "s": acc[ix, iy]})

    # Equal points become one with a weight before any kernel is computed.
    weighted = pts.groupBy("x", "y").agg(F.count(F.lit(1)).cast("double").alias("w"))
    cells = spark.range(nx * ny).select((F.col("id") / ny).cast("int").alias("ix"), (F.col("id") % ny).cast("int").alias("iy"))
    found = weighted.mapInPandas(partial, "ix int, iy int, s double").groupBy("ix", "iy").agg(F.sum("s").alias("s"))
    sums = cells.join(found, ["ix", "iy"], "left").select("ix", "iy", F.coalesce("s", F.lit(0.0)).alias("s"))
    norm = n * 2.0 * math.pi * math.sqrt(det)
    return sums.select(
        "ix", "iy",
        F.round(F.lit(x0) + F.col("ix") * (F.lit(x1) - F.lit(x0)) / F.lit(float(nx - 1)), ROUND_COORD).alias("x"),
        F.round(F.lit(y0) + F.col("iy") * (F.lit(y1) - F.lit(y0)) / F.lit(float(ny - 1)), ROUND_COORD).alias("y"),
        F.round(F.col("s") / F.lit(norm), ROUND_DENSITY).alias("density"),
    )


def kde_1d_by_group(df: DataFrame, group_col: str, value_col: str, gridsize: int = 100, cut: float = 2.0) -> DataFrame:
    """Per group: Gaussian KDE of ``value_col`` (Scott factor n^(-1/5)) on ``gridsize`` points from
    ``min - cut*bw`` to ``max + cut*bw``. Groups with fewer than 2 rows or zero spread are skipped.

    Built-in expressions only: repeated values are combined into weights, each (group, value, weight)
    row is expanded to the group's grid points inside generated code, and kernel values are summed
    per (group, point) with map-side partial sums. Per-group bandwidths come from one aggregate
    joined back, so any number of groups works.
    """
    vals = df.select(F.col(group_col).alias("g"), F.col(value_col).cast("double").alias("v")).filter(
        F.col("g").isNotNull() & F.col("v").isNotNull() & ~F.isnan("v"))
    stats = (vals.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.stddev_samp("v").alias("sd"),
                                   F.min("v").alias("mn"), F.max("v").alias("mx"))
             .filter((F.col("n") >= 2) & (F.col("sd") > 0))
             .withColumn("bw", F.col("sd") * F.pow(F.col("n").cast("double"), F.lit(-1.0 / 5.0)))
             .select("g", F.col("n").cast("double").alias("n"), "bw",
                     (F.col("mn") - F.lit(cut) * F.col("bw")).alias("lo"),
                     (F.col("mx") + F.lit(cut) * F.col("bw")).alias("hi")))
    weighted = vals.groupBy("g", "v").agg(F.count(F.lit(1)).cast("double").alias("w"))
    e = weighted.join(stats, "g").select(
        "g", "v", "w", "n", "bw", "lo", "hi", F.explode(F.sequence(F.lit(0), F.lit(gridsize - 1))).alias("point"))
    x = F.col("lo") + F.col("point") * (F.col("hi") - F.col("lo")) / F.lit(float(gridsize - 1))
    z = (x - F.col("v")) / F.col("bw")
    sums = e.groupBy("g", "point", "n", "bw", x.alias("x")).agg(
        F.sum(F.col("w") * F.exp(F.lit(-0.5) * z * z)).alias("s"))
    dens = F.col("s") / (F.col("n") * F.col("bw") * F.lit(math.sqrt(2.0 * math.pi)))
    return sums.select(F.col("g").alias(group_col), F.col("point").cast("int").alias("point"),
                       F.round("x", ROUND_COORD).alias("x"), F.round(dens, ROUND_DENSITY).alias("density"))
