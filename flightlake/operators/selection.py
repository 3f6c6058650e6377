"""Values at given ranks, picked without sorting: for any number of groups of any size, exactly.

A mergeable quantile sketch brackets each wanted rank between two values, one more pass counts the rows below and at
both, and the bracket that holds the rank is narrowed again until few rows are left in it; these are put in order.
What is shuffled is sketches, counts and the rows of the last brackets, never all values. The sketch is approximate
and only proposes: ranks come from counts, so the results do not depend on it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flightlake.operators.ranks import with_sum_before
from flightlake.session import shared_path

GATHER = 250_000  # rows of one bracket that are put in order, by one task
SKETCH = 4096  # size of the sketch: its rank error is about 0.1 %
PIVOTS = 512  # evenly spaced values read from a sketch
SLACK = 2  # pivots by which a bracket is wider than the rank asks for


def _landed(df: DataFrame, name: str) -> DataFrame:
    """Written to the shared folder and read back, so that the planner knows how small a table is."""
    spark, path = df.sparkSession, shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _join(values: DataFrame, state: DataFrame, keys: list[str]) -> DataFrame:
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"s_{k}"))
    return values.join(state.withColumnsRenamed({k: f"s_{k}" for k in keys}), same)


def _by_group(joined: DataFrame, keys: list[str]):
    return joined.groupBy(*[F.col(f"s_{k}").alias(k) for k in keys])


def _open(i: int, gather: int) -> Column:
    return F.col(f"found{i}").isNull() & (F.col(f"size{i}") > gather)


def _sketch(i: int, gather: int) -> Column:
    """The sketch of an open bracket; null for others, as an empty sketch cannot be asked."""
    here = f"found{i} IS NULL AND size{i} > {gather} AND (lo{i} IS NULL OR v > lo{i}) AND (hi{i} IS NULL OR v < hi{i})"
    return F.expr(f"IF(count_if({here}) > 0, kll_sketch_agg_double(v, {SKETCH}) FILTER (WHERE {here}), NULL)")


def _cut(values: DataFrame, state: DataFrame, keys: list[str], count: int, gather: int, first: bool) -> DataFrame:
    """Adds to each open bracket the two values between which the sketch sees its rank (``a``, ``b``)."""
    spark = values.sparkSession
    joined = _join(values, state, keys)
    which = [0] if first else list(range(count))
    sketches = [F.expr(f"kll_sketch_agg_double(v, {SKETCH})")] if first else [_sketch(i, gather) for i in which]
    told = _by_group(joined, keys).agg(*[s.alias(f"k{i}") for i, s in zip(which, sketches)])
    steps = ",".join(f"{p / PIVOTS!r}D" for p in range(PIVOTS + 1))
    told = told.select(*keys, *[F.expr(f"kll_sketch_get_quantile_double(k{i}, array({steps}))").alias(f"k{i}") for i in which])
    out = _join(told, state, keys).drop(*[f"s_{k}" for k in keys])
    for i in range(count):
        pivots = F.col("k0" if first else f"k{i}")
        at = F.floor((F.col(f"rank{i}") - F.col(f"below{i}")) * F.lit(float(PIVOTS)) / F.col(f"size{i}"))
        low = F.get(pivots, F.greatest(at - SLACK, F.lit(0)).cast("int"))
        high = F.get(pivots, F.least(at + 1 + SLACK, F.lit(PIVOTS)).cast("int"))
        out = out.withColumns({f"a{i}": F.when(_open(i, gather), low), f"b{i}": F.when(_open(i, gather), high)})
    return _landed(out.drop(*[f"k{i}" for i in which]), "selection-cuts")


def _narrow(values: DataFrame, cut: DataFrame, keys: list[str], count: int) -> DataFrame:
    """Counts what lies below and at the proposed values, and keeps of each bracket the part that holds its rank."""
    counts = []
    for i in range(count):
        a, b, v = F.col(f"a{i}"), F.col(f"b{i}"), F.col("v")
        for name, where in (("p", v < a), ("q", v <= a), ("r", v < b), ("s", v <= b)):
            counts.append(F.count_if(where).alias(f"{name}{i}"))
    out = _join(_by_group(_join(values, cut, keys), keys).agg(*counts), cut, keys).drop(*[f"s_{k}" for k in keys])
    keep = [F.col(k) for k in keys] + [F.col("n")]
    for i in range(count):
        a, b, lo, hi, found, below, size, rank, p, q, r, s = (
            F.col(f"{x}{i}") for x in ("a", "b", "lo", "hi", "found", "below", "size", "rank", "p", "q", "r", "s"))
        part = F.when(rank < p, F.lit(0)).when(rank < q, F.lit(1)).when(rank < r, F.lit(2)).when(rank < s, F.lit(3)).otherwise(F.lit(4))
        cut_here = a.isNotNull()

        def new(old: Column, *by_part: Column, part=part, cut_here=cut_here) -> Column:
            chosen = by_part[-1]
            for j in range(len(by_part) - 2, -1, -1):
                chosen = F.when(part == j, by_part[j]).otherwise(chosen)
            return F.when(cut_here, chosen).otherwise(old)

        end = below + size
        keep += [rank.alias(f"rank{i}"), new(found, found, a, found, b, found).alias(f"found{i}"),
                 new(lo, lo, lo, a, lo, b).alias(f"lo{i}"), new(hi, a, hi, b, hi, hi).alias(f"hi{i}"),
                 new(below, below, below, q, below, s).alias(f"below{i}"),
                 new(size, p - below, size, r - q, size, end - s).alias(f"size{i}")]
    return _landed(out.select(*keep), "selection-state")


def _ordered(values: DataFrame, state: DataFrame, keys: list[str], count: int) -> DataFrame:
    """The values at the ranks whose brackets are small: rows of a bracket are combined by value and put in order."""
    brackets = [F.when(F.col(f"found{i}").isNull(), F.struct(F.col(f"lo{i}").alias("lo"), F.col(f"hi{i}").alias("hi"))) for i in range(count)]
    cells = state.select(*keys, F.array_distinct(F.array_compact(F.array(*brackets))).alias("cells"))
    lo, hi, v = F.col("cell.lo"), F.col("cell.hi"), F.col("v")
    rows = _join(values, cells, keys).select(*keys, "v", F.explode("cells").alias("cell"))
    rows = rows.filter((lo.isNull() | (v > lo)) & (hi.isNull() | (v < hi)))
    weighted = rows.groupBy(*keys, lo.alias("lo"), hi.alias("hi"), "v").agg(F.count(F.lit(1)).alias("w"))
    upto = Window.partitionBy(*keys, "lo", "hi").orderBy("v").rowsBetween(Window.unboundedPreceding, -1)
    placed = weighted.withColumn("before", F.coalesce(F.sum("w").over(upto), F.lit(0)))
    # Every bracket that holds an unfound rank has rows, and so has its group.
    joined = _join(placed, state, keys)
    picks = []
    for i in range(count):
        place = F.col(f"below{i}") + F.col("before")
        own = F.col("lo").eqNullSafe(F.col(f"lo{i}")) & F.col("hi").eqNullSafe(F.col(f"hi{i}"))
        here = F.col(f"found{i}").isNull() & own & (place <= F.col(f"rank{i}")) & (F.col(f"rank{i}") < place + F.col("w"))
        picks.append(F.max(F.when(here, F.col("v"))).alias(f"pick{i}"))
    got = _by_group(joined, keys).agg(*picks).withColumnsRenamed({k: f"s_{k}" for k in keys})
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"s_{k}"))
    both = state.join(got, same, "left")
    return both.select(*keys, "n", F.array(*[F.coalesce(f"found{i}", f"pick{i}") for i in range(count)]).alias("picked"))


def values_at(
    df: DataFrame, value_col: str, ranks: list[Callable[[Column], Column]], group_cols=(), gather: int = GATHER
) -> DataFrame:
    """``(groups..., n, picked)``: the number of values of each group and its values at these ranks, counted from 0.

    A rank is told from the number of values: ``lambda n: n - 1`` is the largest. Ranks outside of the group pick
    null. Null and NaN values are ignored, infinities are values, a null group is a group; without group columns
    there is one row, or none if there is no value. Values and brackets are written to the shared folder.
    """
    groups, keys, count = list(group_cols), [f"g{j}" for j in range(len(group_cols))] or ["g"], len(ranks)
    named = [F.col(g).alias(k) for g, k in zip(groups, keys)] or [F.lit(0).alias("g")]
    values = df.select(*named, F.col(value_col).cast("double").alias("v")).filter(F.col("v").isNotNull() & ~F.isnan("v"))
    values = _landed(values, "selection-values")
    state = values.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    null = F.lit(None).cast("double")
    state = state.select(*keys, "n", *[c for i, rank in enumerate(ranks) for c in (
        rank(F.col("n")).cast("bigint").alias(f"rank{i}"), null.alias(f"found{i}"), null.alias(f"lo{i}"), null.alias(f"hi{i}"),
        F.lit(0).cast("bigint").alias(f"below{i}"), F.col("n").alias(f"size{i}"))])
    state, first = _landed(state, "selection-state"), True
    undecided = F.lit(False)
    for i in range(count):
        undecided = undecided | (_open(i, gather) & F.col(f"rank{i}").between(0, F.col("n") - 1))
    while state.filter(undecided).limit(1).count():
        state, first = _narrow(values, _cut(values, state, keys, count, gather, first), keys, count), False
    out = _ordered(values, state, keys, count)
    return out.select(*[F.col(k).alias(g) for g, k in zip(groups, keys)], "n", "picked")


def selected_quantiles(df: DataFrame, value_col: str, probs, group_cols=(), gather: int = GATHER) -> DataFrame:
    """``(groups..., n, qs)``: quantiles with linear interpolation, as ``quantile.exact_quantiles`` gives them."""
    h = [lambda n, p=p: (n - 1).cast("double") * F.lit(float(p)) for p in probs]
    ranks = [lambda n, f=f, end=end: end(f(n)) for f in h for end in (F.floor, F.ceil)]
    picked = values_at(df, value_col, ranks, group_cols, gather)
    qs = []
    for i, f in enumerate(h):
        lo, hi, at = F.get("picked", 2 * i), F.get("picked", 2 * i + 1), f(F.col("n"))
        qs.append(F.when(lo == hi, lo).otherwise(lo + (hi - lo) * (at - F.floor(at))))
    return picked.select(*group_cols, "n", F.array(*qs).alias("qs"))


def selected_quantile(df: DataFrame, value_col: str, p: float) -> float | None:
    """The quantile of all rows; None when there is no value."""
    row = selected_quantiles(df, value_col, [p]).first()
    return None if row is None else row["qs"][0]


def first_rows(df: DataFrame, n: int, order: Column, key_col: str, gather: int = GATHER) -> DataFrame:
    """The ``n`` rows that come first by ``order``, ties by key: no sort of all rows, and no task that holds all ``n``.

    ``order`` is a number made from the row, ``key_col`` any column; rows with a null order come last, by key as
    well. Of rows equal in both, as many stay as there is room for. All rows stay if there are no more than ``n``.
    """
    if n <= 0:
        return df.limit(0)
    # Columns go by number inside, so no name of theirs can meet one of ours.
    key = f"c{df.columns.index(key_col)}"
    rows = df.withColumn("__order", order).toDF(*[f"c{i}" for i in range(len(df.columns))], "o")
    rows = _landed(rows.withColumn("o", F.coalesce(F.nanvl("o", F.lit(None)), F.lit(float("inf")))), "first-rows")
    edge = values_at(rows, "o", [lambda _: F.lit(n - 1)], gather=gather).first()
    if edge is None or edge["n"] <= n:
        return rows.drop("o").toDF(*df.columns)
    at = F.lit(edge["picked"][0])
    # Of the keys at the edge the first stay, and the last of these may stay in part.
    ties = rows.filter(F.col("o") == at)
    room = n - rows.filter(F.col("o") < at).count()
    per_key = ties.groupBy(F.col(key).alias("k")).agg(F.count(F.lit(1)).alias("w"))
    held = with_sum_before(per_key, [], ["k"], "w")
    whole = held.filter(F.col("before") + F.col("w") <= room).select("k")
    split = held.filter((F.col("before") < room) & (F.col("before") + F.col("w") > room)).first()
    kept = rows.filter(F.col("o") < at).unionByName(ties.join(whole, F.col(key).eqNullSafe(F.col("k")), "left_semi"))
    if split is not None:
        copies = ties.filter(F.col(key).eqNullSafe(F.lit(split["k"])))
        kept = kept.unionByName(_some(copies, room - split["before"]))
    return kept.drop("o").toDF(*df.columns)


def _some(rows: DataFrame, n: int) -> DataFrame:
    """Any ``n`` of the rows: each partition keeps its share, told from the numbers of rows of those before it."""
    numbered = _landed(rows.withColumn("mid", F.monotonically_increasing_id()), "some-rows")
    part, place = F.shiftright("mid", 33), F.col("mid").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = numbered.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("w"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select(F.col("part").alias("p"), F.coalesce(F.sum("w").over(earlier), F.lit(0)).alias("before"))
    return numbered.join(before, part == F.col("p")).filter(F.col("before") + place < n).drop("mid", "p", "before")
