"""Benchmark decontamination by winnowing, in DataFrame expressions only.

A shared span of ``WINDOW`` words contains ``WINDOW - k + 1`` k-grams. Both sides keep the smallest k-gram hash of
every run of that many, so every shared span keeps a common hash. The kept hashes of documents and benchmark are
joined; each hit is extended to all windows around it, and these are compared word for word. The span covered by
the equal windows is the contaminated text. An item shorter than a window is one window of its own length, found
the same way with a shorter k.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from flightlake.llm.text import NOT_WORD, ascii_lower, let, pieces, table

WINDOW = 10


def _k(length: int) -> int:
    return (length + 1) // 2


def _grams(words: Column, length: int) -> Column:
    """Hashes of the k-grams of windows of this length; the length is part of the hash."""
    k = _k(length)
    return F.transform(F.sequence(F.lit(1), F.size(words) - (k - 1)), lambda i: F.xxhash64(F.lit(length), F.slice(words, i, k)))


def winnowed(words: Column, length: int) -> Column:
    """The smallest k-gram hash of every window of ``length`` words, without repeats; none if there are fewer words."""
    run = length - _k(length) + 1
    least = lambda h: F.transform(F.sequence(F.lit(1), F.size(h) - (run - 1)), lambda i: F.array_min(F.slice(h, i, run)))
    return F.when(F.size(words) >= length, F.array_distinct(let(_grams(words, length), least))).otherwise(
        F.array().cast("array<bigint>")
    )


def _starts(words: Column, hits: Column, length: int) -> Column:
    """Starts of the windows that hold a k-gram whose hash is among the hits."""
    reach = length - _k(length)
    last = F.size(words) - (length - 1)
    at = let(_grams(words, length), lambda h: F.array_compact(F.transform(h, lambda x, i: F.when(F.array_contains(hits, x), i + 1))))
    around = F.transform(at, lambda i: F.sequence(F.greatest(F.lit(1), F.least(i, last) - reach), F.least(i, last)))
    return F.when(F.size(words) >= length, F.array_distinct(F.flatten(around))).otherwise(F.array().cast("array<int>"))


def _windows(words: Column, starts: Column, length: int) -> Column:
    return F.transform(
        starts,
        lambda s: F.struct(
            s.alias("at"), F.lit(length).alias("length"), F.array_join(F.slice(words, s, length), " ").alias("words")
        ),
    )


def _covered(spans: Column) -> Column:
    """Words inside any of the spans (at, length)."""
    start = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))

    def step(a: Column, x: Column) -> Column:
        end = x["at"] + x["length"]
        new = F.greatest(F.lit(0), end - F.greatest(a["end"], x["at"]))
        return F.struct(F.greatest(a["end"], end).alias("end"), (a["n"] + new).alias("n"))

    return F.aggregate(F.sort_array(spans), start, step, lambda a: a["n"])


def _words(text: str) -> Column:
    return pieces(ascii_lower(F.coalesce(F.col(text), F.lit(""))), NOT_WORD)


def _same_row(a: str, b: str) -> Column:
    return F.col(f"{a}.doc_id").eqNullSafe(F.col(f"{b}.doc_id")) & (F.col(f"{a}.print") == F.col(f"{b}.print"))


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text without nulls, and ``print``, which tells apart rows that share an id."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.withColumn("print", F.xxhash64("text"))


def hit_spans(rows: DataFrame, benchmark: DataFrame, window: int = WINDOW, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(doc_id, print, n_hit, n_items, items) of the rows that hold a window of an item; see :func:`contamination`."""
    c = F.col
    items = benchmark.select(c(item_col).cast("string").alias("item_id"), _words(text_col).alias("words"))
    items = items.filter(F.size("words") > 0)
    lengths = [r[0] for r in items.select(F.least(F.size("words"), F.lit(window)).alias("n")).distinct().collect()]

    whole = lambda n: F.size("words") >= n if n == window else F.size("words") == n
    every = lambda n: F.sequence(F.lit(1), F.size("words") - (n - 1))
    none = F.array().cast("array<bigint>")
    prints = F.concat(none, *[F.when(whole(n), winnowed(c("words"), n)).otherwise(none) for n in lengths])
    item_prints = items.select(F.explode(prints).alias("hash")).distinct()
    no_window = F.array().cast("array<struct<at:int,length:int,words:string>>")
    item_windows = items.select(
        "item_id",
        F.explode(F.concat(no_window, *[F.when(whole(n), _windows(c("words"), every(n), n)).otherwise(no_window) for n in lengths])).alias("w"),
    ).select("item_id", c("w.words").alias("words"))
    # One row for each window, however many items share it.
    item_windows = item_windows.groupBy("words").agg(F.collect_set("item_id").alias("items"))

    # Join of the kept hashes.
    words = rows.select("doc_id", "print", _words("text").alias("words"))
    kept = words.select("doc_id", "print", F.explode(F.concat(none, *[winnowed(c("words"), n) for n in lengths])).alias("hash"))
    hits = kept.join(item_prints, "hash", "left_semi").groupBy("doc_id", "print").agg(F.collect_set("hash").alias("hits"))

    # Extension: the windows around each hit, word for word.
    hit_rows = rows.alias("d").join(hits.alias("h"), _same_row("d", "h")).select("d.doc_id", "d.print", _words("d.text").alias("words"), "hits")
    around = F.concat(no_window, *[_windows(c("words"), _starts(c("words"), c("hits"), n), n) for n in lengths])
    windows = hit_rows.select("doc_id", "print", F.explode(around).alias("w")).select("doc_id", "print", "w.*")
    return (
        windows.join(item_windows, "words")
        .groupBy("doc_id", "print")
        .agg(F.collect_set(F.struct("at", "length")).alias("spans"), F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"))
        .select("doc_id", "print", _covered(c("spans")).alias("n_hit"), F.size("items").alias("n_items"),
                F.concat_ws(",", F.sort_array("items")).alias("items"))
    )


def contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
    id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """One row per document row: doc_id, n_words, n_hit (words inside an occurrence of an item's window), n_items,
    items_sha256 (of the sorted, comma-joined ids of the items found) and contaminated.

    Null texts have no words. Null item ids are found but not listed. Repeated document rows are each reported;
    repeated items count once. With an empty benchmark nothing is contaminated. A document's list of items is as
    long as the benchmark at most.
    """
    c = F.col
    rows = _rows(docs, id_col, text_col)
    spans = hit_spans(rows, benchmark, window, item_col, item_text_col)
    counted = rows.select("doc_id", "print", F.size(pieces(c("text"), r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")).alias("n_words"))
    return counted.alias("d").join(spans.alias("s"), _same_row("d", "s"), "left").select(
        "d.doc_id", c("n_words").cast("bigint").alias("n_words"),
        F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("bigint").alias("n_items"),
        F.sha2(F.coalesce("items", F.lit("")), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
    id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """The rows of ``docs``, all columns under their own names, that hold no window of an item.

    Null and empty texts hold none and stay; repeated rows go or stay together; null ids are ids like any other.
    An empty benchmark takes nothing away.
    """
    spans = hit_spans(_rows(docs, id_col, text_col), benchmark, window, item_col, item_text_col)
    hit = spans.select(F.col("doc_id").alias("id"), "print")
    # Columns go by number inside, so no name of theirs can meet one of ours.
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    own, text = (F.col(f"c{docs.columns.index(c)}") for c in (id_col, text_col))
    here = own.eqNullSafe(F.col("id")) & (F.xxhash64(F.coalesce(text, F.lit(""))) == F.col("print"))
    return plain.join(hit, here, "left_anti").toDF(*docs.columns)


def op9_benchmark_decontamination(spark, sf_dir: str) -> DataFrame:
    """Windows of ``benchmark`` items in all ``documents``; see :func:`contamination`."""
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP9_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS k, doc_id,
         list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM documents
), b AS (
  SELECT item_id::VARCHAR AS item_id,
         list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM benchmark
), bw AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS s
  FROM (SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)
), dw AS (
  SELECT k, i, n, array_to_string(w[i:i + n - 1], ' ') AS s
  FROM (SELECT k, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n)
), hit AS (
  SELECT k, i, n, item_id FROM dw JOIN bw USING (n, s)
), covered AS (
  SELECT k, count(DISTINCT p) AS n_hit FROM (SELECT k, unnest(range(i, i + n)) AS p FROM hit) GROUP BY k
), listed AS (
  SELECT k, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
  FROM (SELECT DISTINCT k, item_id FROM hit) GROUP BY k
)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(c.n_hit, 0)::BIGINT AS n_hit,
       coalesce(l.n_items, 0)::BIGINT AS n_items, sha256(coalesce(l.items, '')) AS items_sha256,
       coalesce(c.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered c USING (k) LEFT JOIN listed l USING (k)
"""
