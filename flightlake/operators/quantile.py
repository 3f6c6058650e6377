"""Exact quantiles (linear interpolation, as NumPy's default) for any number of groups of any size.

Equal values are first combined into one row with a weight, so a value that a third of all rows share
costs one row. The weights of the values before (``ranks.with_sum_before``) tell which ranks a value
covers, and the values at the needed ranks are picked by a partial aggregate. Nothing is gathered in
one task or on the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightlake.operators.ranks import with_sum_before


def exact_quantiles(df: DataFrame, value_col: str, probs, group_cols=()) -> DataFrame:
    """``(groups..., n, qs)``: the number of values and the quantiles of each group.

    Null and NaN values are ignored; infinities are values like any other. A null group is a group.
    Without group columns there is one row, or none if there is no value.
    """
    groups = list(group_cols)
    values = df.select(*groups, F.col(value_col).cast("double").alias("__v")).filter(
        F.col("__v").isNotNull() & ~F.isnan("__v"))
    weighted = values.groupBy(*groups, "__v").agg(F.count(F.lit(1)).alias("__w"))
    keys = groups or ["__all"]
    if not groups:
        weighted = weighted.withColumn("__all", F.lit(0))
    ranked = with_sum_before(weighted, keys, ["__v"], "__w")
    totals = ranked.groupBy(*[F.col(k).alias(f"__t_{k}") for k in keys]).agg(F.sum("__w").alias("n"))
    same = None
    for k in keys:
        eq = F.col(k).eqNullSafe(F.col(f"__t_{k}"))
        same = eq if same is None else same & eq
    j = ranked.join(totals, same)
    picks = []
    for i, p in enumerate(probs):
        h = (F.col("n") - 1).cast("double") * F.lit(float(p))
        for name, rank in (("lo", F.floor(h)), ("hi", F.ceil(h))):
            covered = (F.col("before") <= rank) & (rank < F.col("before") + F.col("__w"))
            picks.append(F.max(F.when(covered, F.col("__v"))).alias(f"__{name}{i}"))
    found = j.groupBy(*keys, "n").agg(*picks)
    qs = []
    for i, p in enumerate(probs):
        h = (F.col("n") - 1).cast("double") * F.lit(float(p))
        lo, hi = F.col(f"__lo{i}"), F.col(f"__hi{i}")
        qs.append(F.when(lo == hi, lo).otherwise(lo + (hi - lo) * (h - F.floor(h))))
    return found.select(*groups, "n", F.array(*qs).alias("qs"))


def exact_quantile(df: DataFrame, value_col: str, p: float) -> float | None:
    """The quantile of all rows; None when there is no value."""
    row = exact_quantiles(df, value_col, [p]).first()
    return None if row is None else row["qs"][0]
