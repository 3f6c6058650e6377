"""Clustering vectors around centroids with bit planes: 64 components of a plane are one unsigned 64-bit integer.

A vector of 64 whole numbers is kept as its two's-complement bit planes. Plane b counts 2**b, the last one
-2**b, so the dot product of two vectors is the sum over pairs of planes of the bits that both have set, weighted
with both planes' values; the squared distance follows from it and the two norms. All of it is exact.

Vectors are packed once and written out. A round reads the planes, and each task hands on one row of component
sums for each cluster, so the driver gets as many rows as there are clusters, whatever the input.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from flightlake.llm.storage import landed
from flightlake.llm.text import table

WIDTH = 64
CLUSTERS, ROUNDS, SCALE, SEED = 40, 5, 256, 2
#: Components are whole numbers of less than this size, so that squared distances fit in 64 bits.
LIMIT = 1 << 27
#: Vectors compared at once.
CHUNK = 1024


def planes_needed(least: int, most: int) -> int:
    """Bit planes, sign included, that hold every number from ``least`` to ``most``."""
    return 1 + max(int(most).bit_length(), (-int(least) - 1).bit_length() if least < 0 else 0)


def plane_weights(planes: int) -> np.ndarray:
    weights = np.int64(1) << np.arange(planes, dtype=np.int64)
    weights[-1] = -weights[-1]
    return weights


def pack(vectors: np.ndarray, planes: int) -> np.ndarray:
    """Rows of 64 whole numbers as rows of bit planes; bit j of a plane belongs to component j."""
    out = np.empty((len(vectors), planes), np.uint64)
    for b in range(planes):
        bits = ((vectors >> b) & 1).astype(np.uint8)
        out[:, b] = np.packbits(bits, axis=1, bitorder="little").view("<u8")[:, 0]
    return out


def dots(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact dot products of all rows of planes ``x`` (rows) and ``y`` (columns)."""
    a, b = x.shape[1], y.shape[1]
    weights = np.multiply.outer(plane_weights(a), plane_weights(b)).ravel()
    if a + b + 6 <= 53:  # every sum is a whole number that a double holds
        weights = weights.astype(np.float64)
    out = np.empty((len(x), len(y)), np.int64)
    for k, centroid in enumerate(y):
        common = np.bitwise_count(x[:, :, None] & centroid).reshape(len(x), a * b)
        out[:, k] = common.astype(weights.dtype) @ weights
    return out


def component_sums(x: np.ndarray, group: np.ndarray, groups: int) -> np.ndarray:
    """Component sums of the vectors of each group, plane by plane."""
    member = (np.arange(groups)[:, None] == group).astype(np.float32)  # counts stay far below 2**24
    sums = np.zeros((groups, WIDTH), np.int64)
    for b, weight in enumerate(plane_weights(x.shape[1])):
        column = np.ascontiguousarray(x[:, b]).astype("<u8").view(np.uint8).reshape(-1, 8)
        bits = np.unpackbits(column, axis=1, bitorder="little")
        sums += weight * (member @ bits.astype(np.float32)).astype(np.int64)
    return sums


def _packed(planes: int, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            *kept, vectors = batch.columns
            v = vectors.flatten().to_numpy().astype(np.int64).reshape(-1, WIDTH)
            packed = pa.array([row.tobytes() for row in pack(v, planes).astype("<u8")], pa.binary())
            cols = [*kept, packed, pa.array((v * v).sum(axis=1))]
            yield pa.record_batch([c.cast(t) for c, t in zip(cols, schema.types, strict=True)], schema)

    return run


def _nearest(batch: pa.RecordBatch, centroids: np.ndarray, norms: np.ndarray) -> Iterator[tuple]:
    """(planes, nearest centroid, squared distance) of runs of the batch, whose last columns are planes and norm."""
    *_, packed, norm = batch.columns
    norm = norm.to_numpy()
    x = np.frombuffer(b"".join(packed.to_pylist()), "<u8").reshape(len(norm), -1)
    for lo in range(0, len(norm), CHUNK):
        part = x[lo : lo + CHUNK]
        distance = norm[lo : lo + CHUNK, None] + norms - 2 * dots(part, centroids)
        near = distance.argmin(axis=1)  # the first, so the smaller number, of equal ones
        yield part, near, distance[np.arange(len(part)), near]


def _sums(shared):
    schema = pa.schema([("cluster", pa.int32()), ("n", pa.int64()), ("sums", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centroids, norms = shared.value
        k = len(centroids)
        count, sums = np.zeros(k, np.int64), np.zeros((k, WIDTH), np.int64)
        for batch in batches:
            for x, near, _ in _nearest(batch, centroids, norms):
                count += np.bincount(near, minlength=k)
                sums += component_sums(x, near, k)
        some = np.nonzero(count)[0]
        yield pa.record_batch([pa.array(some.astype(np.int32)), pa.array(count[some]), pa.array(list(sums[some]), schema.types[2])], schema)

    return run


def _assigned(shared, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centroids, norms = shared.value
        for batch in batches:
            found = [(near, distance) for _, near, distance in _nearest(batch, centroids, norms)]
            cols = [*batch.columns[:-2], *(pa.array(np.concatenate(c) if c else np.zeros(0, np.int64)) for c in (list(zip(*found)) or ((), ())))]
            yield pa.record_batch([c.cast(t) for c, t in zip(cols, schema.types, strict=True)], schema)

    return run


def _whole(vector: Column, scale: int) -> Column:
    return F.transform(vector.cast("array<double>"), lambda x: F.floor(x * scale))


def _usable(vector: Column) -> Column:
    finite = F.forall(vector.cast("array<double>"), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(vector) == WIDTH) & finite, F.lit(False))


def centroid_clusters(
    df: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, scale: int = SCALE, seed: int = SEED,
    id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """One row per usable vector: vec_id, cluster, distance (squared), cluster_inertia, inertia, centroid_sha256.

    Usable are vectors of exactly 64 components, none of them null or not finite; all others, null vectors among
    them, have no row. A component x counts as floor(scale * x). Centroids start as the vectors with the smallest
    sha256 of ``seed:vec_id`` (a null id as empty text; equal ids by their components), as many as there are if
    fewer than ``clusters`` are usable. Ties of distance go to the smaller cluster; empty clusters keep their
    centroid. Repeated rows each count. No usable vector, or an empty table, gives no row. A component of
    ``LIMIT / scale`` or more is an error, as its squared distances would not fit in 64 bits.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    spark = df.sparkSession
    kept = df.select(F.col(f"`{id_col}`").alias("vec_id"), F.col(f"`{vector_col}`").alias("vector")).filter(_usable(F.col("vector")))
    least, most = kept.agg(F.min(F.array_min("vector")), F.max(F.array_max("vector"))).first()
    if least is None:
        return spark.createDataFrame([], StructType(kept.schema.fields[:1] + StructType.fromDDL(_RESULT).fields))
    if max(-least, most) * scale >= LIMIT:
        raise ValueError(f"components must be of less than {LIMIT / scale:g}; found {least} to {most}")
    planes = planes_needed(int(np.floor(least * scale)), int(np.floor(most * scale)))

    rows = kept.select("vec_id", _whole(F.col("vector"), scale).alias("vector"))
    drawn = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    first = rows.orderBy(drawn, "vector").limit(clusters).collect()
    centroids = np.array([r.vector for r in first], np.int64)

    kind = StructType(rows.schema.fields[:1]).add("planes", "binary").add("norm", "long")
    packed = landed(rows.mapInArrow(_packed(planes, to_arrow_schema(kind)), kind), "bit-planes")
    share = lambda: spark.sparkContext.broadcast((pack(centroids, planes), (centroids * centroids).sum(axis=1)))
    for _ in range(rounds):
        found = packed.select("planes", "norm").mapInArrow(_sums(share()), "cluster int, n bigint, sums array<bigint>")
        totals = found.groupBy("cluster").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.get("sums", F.lit(j))) for j in range(WIDTH)]).alias("sums"))
        for r in totals.collect():
            centroids[r.cluster] = [s // r.n for s in r.sums]

    kind = StructType(rows.schema.fields[:1]).add("cluster", "integer").add("distance", "long")
    assigned = landed(packed.mapInArrow(_assigned(share(), to_arrow_schema(kind)), kind), "assigned")
    inertia = {r.cluster: r.n for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("n")).collect()}
    prints = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    by_cluster = lambda values: F.get(F.array(*map(F.lit, values)), F.col("cluster"))
    return assigned.select(
        "vec_id", "cluster", "distance",
        by_cluster([inertia.get(k, 0) for k in range(len(centroids))]).cast("bigint").alias("cluster_inertia"),
        F.lit(sum(inertia.values())).cast("bigint").alias("inertia"), by_cluster(prints).alias("centroid_sha256"),
    )


_RESULT = "cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string"


def op13_centroid_clustering(spark, sf_dir: str) -> DataFrame:
    """40 clusters of all ``embeddings`` after five rounds; see :func:`centroid_clusters`."""
    return centroid_clusters(table(spark, sf_dir, "embeddings"))


def _rounds_sql() -> str:
    """Assignment and new centroids, one pair of CTEs for each round."""
    sql = ""
    for r in range(ROUNDS + 1):
        sql += f""", near_{r} AS MATERIALIZED (
  SELECT k, arg_min(c, (distance, c)) AS c, min(distance) AS distance
  FROM (SELECT v.k, c.c, v.norm + list_inner_product(c.x, c.x) - 2 * list_inner_product(v.x, c.x) AS distance FROM v, centre_{r} AS c)
  GROUP BY k
)"""
        if r < ROUNDS:
            sql += f""", mean_{r} AS (
  SELECT c, list(floor(s / n) ORDER BY j) AS x
  FROM (SELECT c, j, sum(v.x[j]) AS s, count(*) AS n FROM near_{r} JOIN v USING (k), range(1, 65) AS t(j) GROUP BY c, j) GROUP BY c
), centre_{r + 1} AS MATERIALIZED (
  SELECT c, coalesce(m.x, o.x) AS x FROM centre_{r} AS o LEFT JOIN mean_{r} AS m USING (c)
)"""
    return sql


OP13_SQL = f"""
WITH v AS MATERIALIZED (
  SELECT k, vec_id, x, list_inner_product(x, x) AS norm
  FROM (SELECT row_number() OVER () AS k, vec_id, list_transform(embedding, lambda e: floor({SCALE} * e::DOUBLE)) AS x
        FROM embeddings
        WHERE len(embedding) = {WIDTH} AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = {WIDTH})
), centre_0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('{SEED}:' || vec_id), x) - 1 AS c, x FROM v
  QUALIFY row_number() OVER (ORDER BY sha256('{SEED}:' || vec_id), x) <= {CLUSTERS}
){_rounds_sql()}
SELECT v.vec_id, n.c::INTEGER AS cluster, n.distance::BIGINT AS distance,
       (sum(n.distance) OVER (PARTITION BY n.c))::BIGINT AS cluster_inertia, (sum(n.distance) OVER ())::BIGINT AS inertia,
       sha256(array_to_string(list_transform(c.x, lambda e: e::BIGINT::VARCHAR), ',')) AS centroid_sha256
FROM near_{ROUNDS} AS n JOIN v USING (k) JOIN centre_{ROUNDS} AS c ON c.c = n.c
"""
