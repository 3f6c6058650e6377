"""Isolation Forest (Liu, Ting, Zhou, ICDM 2008) fitted and applied with Spark.

* Subsampling, one path at every size: a row enters the draw when the hash of its id falls under
  ``q = min(1, trees * p)`` and enters a tree when its hash for that tree falls under ``p / q``, so it is
  a candidate of each tree with chance ``p``, about ``(4 * psi + 64) / n``. Each tree keeps the ``psi``
  candidates with the smallest hashes. A tree's group holds about ``4 * psi`` rows whatever the table size.
* Fit: one ``applyInPandas`` call per tree. Hashes, split features and split points come from md5, so the
  forest depends on seed and rows alone, not on partitioning, and SQL can grow the same one.
* Score: the forest (a fixed number of nodes) is broadcast and every partition is scored vectorised in
  ``mapInPandas``.
* Label: -1 when ``-score`` is strictly below the ``contamination`` quantile of ``-score`` (exact,
  linear interpolation), else 1.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from hashlib import md5

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flightlake.operators.profiles import dropna_any
from flightlake.operators.selection import selected_quantile
from flightlake.schemas import FEATURES
from flightlake.session import shared_root

# ---- fixed values (the reference's model settings and the library defaults it relies on) ----
N_TREES = 100
MAX_SAMPLES = 256
CONTAMINATION = 0.01
SEED = 42
# ---- end of fixed values ----
EULER_GAMMA = 0.5772156649
HASH_BITS = 60
#: Mean path lengths are rounded to this many digits, so that the order of summation decides no tie.
PATH_DIGITS = 9
NODE_SCHEMA = "tree int, node int, feature int, threshold double, size long, depth int"


def c_factor(m) -> np.ndarray:
    """Average path length of an unsuccessful BST search over ``m`` points: c(1)=0, c(2)=1."""
    m = np.asarray(m, dtype=float)
    out = np.zeros_like(m)
    big = m > 2
    out[big] = 2.0 * (np.log(m[big] - 1.0) + EULER_GAMMA) - 2.0 * (m[big] - 1.0) / m[big]
    out[m == 2] = 1.0
    return out


def draw(seed: int, tree: int, node: int, what: str) -> float:
    """Uniform number in [0, 1) for a node's split: the leading 48 bits of an md5."""
    return int(md5(f"{seed}:{tree}:{node}:{what}".encode()).hexdigest()[:12], 16) / float(1 << 48)


def grow(x: np.ndarray, tree: int, seed: int, height_limit: int) -> list[tuple]:
    """Nodes (node, feature, threshold, size, depth) of one tree; node 1 is the root, 2k and 2k + 1 the
    children of k, and a feature of -1 marks a leaf."""
    nodes, open_ = [], [(1, 0, np.arange(len(x)))]
    while open_:
        node, depth, rows = open_.pop()
        sub = x[rows]
        lo, hi = sub.min(axis=0), sub.max(axis=0)
        cand = np.flatnonzero(hi > lo)
        if depth >= height_limit or len(rows) <= 1 or len(cand) == 0:
            nodes.append((node, -1, 0.0, len(rows), depth))
            continue
        q = int(cand[int(math.floor(draw(seed, tree, node, "feature") * len(cand)))])
        p = float(lo[q] + draw(seed, tree, node, "point") * (hi[q] - lo[q]))
        nodes.append((node, q, p, len(rows), depth))
        left = sub[:, q] < p
        open_ += [(2 * node, depth + 1, rows[left]), (2 * node + 1, depth + 1, rows[~left])]
    return nodes


@dataclass
class IsolationForestModel:
    features: list
    psi: int
    nodes: pd.DataFrame  # NODE_SCHEMA rows for every tree

    def arrays(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Feature, threshold and path length by (tree, node)."""
        t, k = (self.nodes[c].to_numpy(dtype=int) for c in ("tree", "node"))
        shape = (int(t.max()) + 1, int(k.max()) + 1) if len(t) else (0, 2)
        feature, threshold, path = np.full(shape, -1), np.zeros(shape), np.zeros(shape)
        feature[t, k], threshold[t, k] = self.nodes["feature"], self.nodes["threshold"]
        path[t, k] = self.nodes["depth"].to_numpy(dtype=float) + c_factor(self.nodes["size"])
        return feature, threshold, path


def _hash(seed: int, tree: Column, id_col: str) -> Column:
    """60 bits from (seed, tree, row id) as hex digits: these sort and compare like the number."""
    text = F.concat_ws(":", F.lit(str(seed)), tree.cast("string"), F.col(id_col).cast("string"))
    return F.substring(F.md5(text), 1, HASH_BITS // 4)


def _below(hashed: Column, rate: float) -> Column:
    """Whether a hash falls into the lowest ``rate`` of all."""
    if rate >= 1.0:
        return F.lit(True)
    return hashed < F.lit(f"{int(math.floor(rate * float(1 << HASH_BITS))):0{HASH_BITS // 4}x}")


def rates(n: int, psi: int, n_trees: int) -> tuple[float, float]:
    """Share of rows in the draw, and of those the share that enters one tree."""
    p = min(1.0, (4.0 * psi + 64.0) / n)
    q = min(1.0, n_trees * p)
    return q, p / q


def _dealt(rows: DataFrame) -> DataFrame:
    """Rows where the scan put them, unless the input is so small that its splits would leave cores idle: hashing or
    scoring a row against every tree costs more than moving its few numbers, but a large table is not moved."""
    spark = rows.sparkSession
    conf = spark._jsparkSession.sessionState().conf()
    size = int(str(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    cores = spark.sparkContext.defaultParallelism
    if size >= cores * conf.filesMaxPartitionBytes():
        return rows
    return rows.repartition(max(cores, int(spark.conf.get("spark.sql.shuffle.partitions"))))


def sample(data: DataFrame, n: int, psi: int, n_trees: int, seed: int = SEED, id_col: str = "obs_id") -> DataFrame:
    """``psi`` rows for each ``tree`` (all rows, if there are no more)."""
    q, per_tree = rates(n, psi, n_trees)
    drawn = _dealt(data.filter(_below(_hash(seed, F.lit("row"), id_col), q)))
    cand = drawn.select("*", F.explode(F.sequence(F.lit(0), F.lit(n_trees - 1))).alias("tree"))
    cand = cand.withColumn("__h", _hash(seed, F.col("tree"), id_col)).filter(_below(F.col("__h"), per_tree))
    w = Window.partitionBy("tree").orderBy("__h", id_col)
    return cand.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= psi).drop("__rn", "__h")


def fit(df: DataFrame, features=FEATURES, n_trees: int = N_TREES, max_samples: int = MAX_SAMPLES, seed: int = SEED,
        id_col: str = "obs_id") -> IsolationForestModel:
    data = dropna_any(df.select(id_col, *features), list(features))
    n = data.count()
    if n == 0:
        return IsolationForestModel(list(features), 0, pd.DataFrame(columns=[c.split()[0] for c in NODE_SCHEMA.split(", ")]))
    psi = int(min(max_samples, n))
    height = int(math.ceil(math.log2(max(psi, 2))))
    feats = list(features)

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(pdf["tree"].iloc[0])
        node, feature, threshold, size, depth = zip(*grow(pdf[feats].to_numpy(dtype=float), tree, seed, height))
        return pd.DataFrame({"tree": tree, "node": node, "feature": feature, "threshold": threshold, "size": size,
                             "depth": depth})

    nodes = sample(data, n, psi, n_trees, seed, id_col).groupBy("tree").applyInPandas(build, NODE_SCHEMA).toPandas()
    roots = nodes[nodes["node"] == 1]
    if len(roots) != n_trees or (roots["size"] != psi).any():
        raise RuntimeError(f"{len(roots)} of {n_trees} trees grew, on {roots['size'].min()} to {roots['size'].max()} "
                           f"of {psi} rows; row ids must be unique")
    return IsolationForestModel(feats, psi, nodes)


def score(df: DataFrame, model: IsolationForestModel, id_col: str = "obs_id", keep=()) -> DataFrame:
    """Adds ``score`` = 2^(-E[h(x)] / c(psi)) (higher = more anomalous) to complete rows."""
    feats = model.features
    data = dropna_any(df.select(id_col, *keep, *[f for f in feats if f not in keep]), feats)
    forest = df.sparkSession.sparkContext.broadcast(model.arrays())
    cpsi = float(c_factor([model.psi])[0]) if model.psi > 1 else 1.0
    out_schema = T.StructType(list(data.schema.fields) + [T.StructField("score", T.DoubleType())])

    def apply(batches):
        feature, threshold, path = forest.value
        for pdf in batches:
            x = pdf[feats].to_numpy(dtype=float)
            total = np.zeros(len(x))
            for f, t, h in zip(feature, threshold, path):
                node = np.ones(len(x), dtype=np.int64)
                idx = np.flatnonzero(f[node] >= 0)
                while len(idx):
                    k = node[idx]
                    node[idx] = 2 * k + (x[idx, f[k]] >= t[k])
                    idx = idx[f[node[idx]] >= 0]
                total += h[node]
            mean = np.round(total / max(len(feature), 1), PATH_DIGITS)
            yield pdf.assign(score=np.power(2.0, -mean / cpsi))

    return _dealt(data).mapInPandas(apply, out_schema)


def label(scored: DataFrame, contamination: float = CONTAMINATION) -> DataFrame:
    """Adds ``anomaly``: -1 when -score is strictly below the contamination quantile, else 1."""
    offset = selected_quantile(scored.select((-F.col("score")).alias("neg_score")), "neg_score", contamination)
    if offset is None:
        return scored.withColumn("anomaly", F.lit(1))
    return scored.withColumn("anomaly", F.when(-F.col("score") < F.lit(offset), F.lit(-1)).otherwise(F.lit(1)))


def fit_predict(df: DataFrame, features=FEATURES, contamination: float = CONTAMINATION, seed: int = SEED,
                n_trees: int = N_TREES, max_samples: int = MAX_SAMPLES, keep=()) -> DataFrame:
    """Fit on the complete rows of ``df``, score them and label them. The scored rows are checkpointed to
    the shared folder (lineage cut) before the threshold pass."""
    shared_root(df.sparkSession)
    model = fit(df, features, n_trees, max_samples, seed)
    return label(score(df, model, keep=keep).checkpoint(eager=True), contamination)


def anomaly_report(labelled: DataFrame) -> DataFrame:
    """Anomalous rows with their callsign, plus the found / total counts of the run (two scalars
    from one aggregate)."""
    c = labelled.agg(F.sum((F.col("anomaly") == -1).cast("long")).alias("n_found"),
                     F.count(F.lit(1)).alias("n_total")).first()
    return (labelled.filter(F.col("anomaly") == -1)
            .select("obs_id", "callsign", F.round("score", 6).alias("score"), "anomaly",
                    F.lit(int(c["n_found"] or 0)).cast("long").alias("n_found"),
                    F.lit(int(c["n_total"])).cast("long").alias("n_total")))


def anomaly_map(labelled: DataFrame) -> DataFrame:
    from flightlake.functions.scalar import anomaly_label
    return labelled.select("obs_id", "latitude", "longitude", anomaly_label("anomaly").alias("is_anomaly"))
