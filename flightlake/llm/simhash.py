"""SimHash near-duplicates: 64-bit fingerprints of word shingles, compared tile by tile with numpy.

Fingerprints are first made distinct, so copies cost one row. Distinct fingerprints are dealt into tiles by the
bit counts of their four 16-bit quarters. One differing bit changes one quarter's count by one, so two tiles
whose counts differ by more than the radius in sum cannot hold a link and are never paired. Every other pair of
tiles is compared exactly, all against all, with exclusive-or and bit counts. Tiles hold a bounded number of
fingerprints; a crowded tile is several rows. Links become components by star contraction over Spark joins.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from flightlake.llm.packing import slices
from flightlake.llm.storage import landed
from flightlake.llm.text import table

SHINGLE = 4
RADIUS = 4
SEED = 42
#: Fingerprints in one tile row.
TILE = 2048
QUARTERS = 4


def fingerprint(words: list[bytes], shingle: int = SHINGLE) -> int:
    """The fingerprint of one text's words: a bit is 1 if set in over half the shingle hashes."""
    from xxhash import xxh64_intdigest

    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    width = min(shingle, len(words))
    joined = map(b" ".join, zip(*(words[i : i + n] for i in range(width)), strict=True))
    hashes = np.fromiter((xxh64_intdigest(s, SEED) for s in joined), np.uint64, n)
    votes = np.unpackbits(hashes.view(np.uint8).reshape(n, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > n, bitorder="little").view(np.uint64)[0])


def _fingerprints(shingle: int, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            *kept, texts = batch.columns
            texts = texts.cast(pa.binary()).to_pylist()
            found = np.fromiter(
                (fingerprint(t.lower().split(), shingle) for _, part in slices(texts) for t in part),
                np.uint64, len(texts),
            )
            cols = [*kept, pa.array(found.view(np.int64))]
            yield pa.record_batch([x.cast(t) for x, t in zip(cols, schema.types, strict=True)], schema)

    return run


def fingerprints(df: DataFrame, carry: dict[str, Column], shingle: int = SHINGLE, text_col: str = "text") -> DataFrame:
    """The carried columns and ``fp``, the signed 64-bit fingerprint, of every row. Null and empty texts have 0."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    source = df.select(*[c.alias(k) for k, c in carry.items()], F.col(text_col).cast("string").alias("__text"))
    out = StructType(source.schema.fields[:-1]).add("fp", "long")
    return source.mapInArrow(_fingerprints(shingle, to_arrow_schema(out)), out)


def _quarter(i: int) -> Column:
    return F.bit_count(F.shiftrightunsigned("fp", 16 * i).bitwiseAND(F.lit(0xFFFF).cast("bigint"))).cast("int")


def _tile_key(counts: list[Column]) -> Column:
    """The quarters' bit counts as digits, each moved by the radius so that neighbours stay non-negative."""
    key = F.lit(0)
    for c in counts:
        key = key * 64 + c
    return key


def _steps(radius: int) -> list[int]:
    """What to add to a tile's key to get each tile within the radius; of a step and its opposite, one."""
    steps = []
    for d in product(range(-radius, radius + 1), repeat=QUARTERS):
        if sum(map(abs, d)) <= radius and d >= (0,) * QUARTERS:
            steps.append(sum(x * 64 ** (QUARTERS - 1 - i) for i, x in enumerate(d)))
    return steps


def spanning(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A star for each component of these links: (node, smallest node of its component)."""
    nodes, ends = np.unique(np.concatenate([left, right]), return_inverse=True)
    a, b = ends[: len(left)], ends[len(left) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    off = root != np.arange(len(nodes))
    return nodes[off], nodes[root[off]]


def _compare(radius: int):
    """Links between the two tiles of each row, reduced to stars."""
    schema = pa.schema([("src", pa.int64()), ("dst", pa.int64())])

    def links(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        near = np.bitwise_count(x[:, None] ^ y[None, :]) <= radius
        i, j = np.nonzero(near)
        apart = x[i] != y[j]
        return x[i[apart]].view(np.int64), y[j[apart]].view(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        src, dst, n = [], [], 0
        for batch in batches:
            xs, ys = batch.column(0), batch.column(1)
            xo, yo = xs.offsets.to_numpy(), ys.offsets.to_numpy()
            xv, yv = (np.asarray(c.values).view(np.uint64) for c in (xs, ys))
            for k in range(len(batch)):
                x, y = xv[xo[k] : xo[k + 1]], yv[yo[k] : yo[k + 1]]
                a, b = links(x, y)
                if len(a):
                    a, b = spanning(a, b)
                    src.append(a)
                    dst.append(b)
                    n += len(a)
            if n > 100_000:
                a, b = spanning(np.concatenate(src), np.concatenate(dst))
                yield pa.record_batch([pa.array(a), pa.array(b)], schema)
                src, dst, n = [], [], 0
        if n:
            a, b = spanning(np.concatenate(src), np.concatenate(dst))
            yield pa.record_batch([pa.array(a), pa.array(b)], schema)

    return run


def near_links(distinct: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """Links (src, dst) that connect the same fingerprints as all pairs within ``radius`` bits would.

    ``distinct`` has one row per fingerprint ``fp``. Links inside one comparison are reduced to a star per
    component, so a dense group costs as many rows as it has members.
    """
    size = distinct.count()
    keyed = distinct.select("fp", _tile_key([_quarter(i) + radius for i in range(QUARTERS)]).alias("key"))
    # Salting bounds the rows that one task collects; the number of parts follows the fullest possible tile.
    salted = keyed.withColumn("part", F.pmod(F.xxhash64("fp"), F.lit(1 + size // (64 * tile))))
    tiles = salted.groupBy("key", "part").agg(F.sort_array(F.collect_list("fp")).alias("all"))
    cuts = F.transform(F.sequence(F.lit(0), F.floor((F.size("all") - 1) / tile)), lambda i: F.slice("all", i * tile + 1, tile))
    tiles = landed(tiles.select("key", "part", F.posexplode(cuts).alias("no", "fps")), "tiles")
    # Only steps to tiles that exist are taken: a tile's row is copied for these alone.
    steps = F.array(*[F.lit(s) for s in _steps(radius)])
    left = tiles.select(F.explode(F.transform(steps, lambda s: F.col("key") + s)).alias("key"),
                        F.col("key").alias("from"), F.col("part").alias("p"), F.col("no").alias("q"), F.col("fps").alias("x"))
    present = tiles.select("key").distinct()
    left = left.join(present, "key", "left_semi")
    one_way = (F.col("key") != F.col("from")) | (F.struct("p", "q") <= F.struct("part", "no"))
    pairs = left.join(tiles, "key").filter(one_way).select("x", F.col("fps").alias("y"))
    return pairs.mapInArrow(_compare(radius), "src bigint, dst bigint")


def components(links: DataFrame, rounds: int = 50) -> DataFrame:
    """(node, root) for every node of ``links``: alternating large-star and small-star contraction.

    Each round joins nodes to the smallest neighbour and is written out; the rounds needed grow with the
    logarithm of the longest chain.
    """

    def state(e: DataFrame):
        return e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()

    edges = landed(links.filter("src != dst").select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")).distinct(), "links")
    seen = state(edges)
    for _ in range(rounds):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # Large star: every larger neighbour of u links to the smallest node that u knows.
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u != v").distinct()
        # Small star: u and its smaller neighbours link to the smallest of them.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v")
        after = landed(small.union(least.select("u", F.col("m").alias("v"))).distinct(), "links")
        edges, before, seen = after, seen, state(after)
        if seen == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    raise RuntimeError(f"components did not settle in {rounds} rounds")


def fingerprint_groups(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(fp, root) for every distinct ``fp``: fingerprints that links connect share their root, one of them."""
    distinct = landed(prints.select("fp").distinct(), "distinct")
    linked = components(near_links(distinct, radius))
    return distinct.join(linked, distinct.fp == linked.node, "left").select("fp", F.coalesce("root", "fp").alias("root"))


def simhash_groups(
    df: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: doc_id, fingerprint (16 hex digits) and component_id.

    ``component_id`` is the smallest doc_id reachable over links of at most ``radius`` differing bits, the row's
    own included; rows with equal fingerprints are linked. Null ids take part but never name a component (null
    if no other member has an id). Repeated rows stay repeated. An empty table gives no rows.
    """
    prints = landed(fingerprints(df, {"doc_id": F.col(id_col)}, shingle, text_col), "fingerprints")
    groups = fingerprint_groups(prints, radius).join(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "fp")
    groups = landed(groups, "groups")
    names = groups.groupBy("root").agg(F.min("first").alias("component_id"))
    by_print = groups.join(names, "root").select("fp", "component_id")
    return prints.join(by_print, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(
    df: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row of each group of near-duplicates, with all its columns: the one with the smallest id.

    Ids that are null come last; among rows with the same id the text's hash decides, and of rows that agree in
    both any one stays. Null and empty texts have the fingerprint 0 and are near-duplicates of one another. An empty
    table gives no row. Columns keep their names, whatever these are.
    """
    # Columns go by number inside, so no name of theirs can meet one of ours.
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    id_, text = (f"c{df.columns.index(c)}" for c in (id_col, text_col))
    own = F.concat_ws(":", F.coalesce(F.col(id_).cast("string"), F.lit("")), F.col(id_).isNull().cast("string"),
                      F.hex(F.xxhash64(F.col(text)))).alias("row")
    order = F.struct(F.col(id_).isNull().alias("last"), F.col(id_).alias("id"), own)
    prints = landed(fingerprints(plain, {"rank": order}, shingle, text), "fingerprints")
    firsts = prints.groupBy("fp").agg(F.min("rank").alias("rank"))
    stay = fingerprint_groups(prints, radius).join(firsts, "fp").groupBy("root").agg(F.min("rank").alias("rank"))
    kept = plain.withColumn("row", own).join(stay.select("rank.row"), "row", "left_semi")
    return kept.dropDuplicates(["row"]).drop("row").toDF(*df.columns)


def op4_simhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    """Fingerprint and component of all ``documents``; see :func:`simhash_groups`."""
    return simhash_groups(table(spark, sf_dir, "documents"))
