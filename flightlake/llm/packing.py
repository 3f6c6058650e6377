"""Best-fit packing of documents into fixed-length token sequences, planned over the histogram of lengths.

1. Tasks tokenise whole texts, cut only those longer than a sequence, and keep per piece its length and the
   checksum of its ids.
2. The histogram of lengths has at most ``max_len`` rows whatever the input. Best-fit decreasing runs over its
   counts on the driver: bins with the same free space are one entry, so the plan's work follows the number of
   lengths, not of documents.
3. Each piece gets its rank among the pieces of its length and joins the plan on that rank.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from flightlake.llm.storage import landed
from flightlake.llm.text import table

MAX_LEN = 4096
END_ID = 1
#: Distinct chunks whose ids a worker remembers, twice at most.
REMEMBERED = 300_000
#: Text bytes that a worker splits into words at once.
SLICE_BYTES = 4 << 20

_SCHEMA = "uid bigint, doc_id {id}, piece int, start bigint, length int, ids_crc32 bigint"


#: A chunk of letters (of the Latin-1 range) and the ASCII marks behind them, if any.
_WORD = re.compile(r"([a-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)")


def _byte_letters() -> str:
    """What byte-level vocabularies write for each byte: printable ones as they are, the rest from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return "".join(chr(b if b in shown else next(rest)) for b in range(256))


class ChunkTokenizer:
    """Ids of whole texts as little-endian bytes.

    The vocabulary drops white space and no merge or pattern spans it, so a text's ids are those of its chunks
    between ASCII white space, one after another. Ids of chunks seen before are looked up. A new chunk of letters
    and marks is two words of the vocabulary's own splitting; its letters go straight to the merges. Any other new
    chunk goes through the whole tokenizer.
    """

    def __init__(self, definition: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_str(definition)
        self._model = self._tokenizer.model
        self._letters = _byte_letters()
        self._new: dict[bytes, bytes] = {}
        self._old: dict[bytes, bytes] = {}

    def _known(self, chunk: bytes) -> bytes | None:
        return self._new.get(chunk) or self._old.get(chunk)

    def _whole(self, chunk: bytes) -> bytes:
        ids = self._tokenizer.encode(chunk.decode(), add_special_tokens=False).ids
        return b"".join([i.to_bytes(4, "little") for i in ids])

    def _word(self, word: str) -> bytes:
        shown = word if word.isascii() else word.encode().decode("latin-1").translate(self._letters)
        return b"".join([t.id.to_bytes(4, "little") for t in self._model.tokenize(shown)])

    def _fresh(self, chunk: bytes) -> bytes:
        m = _WORD.fullmatch(chunk.decode())
        if not m:
            return self._whole(chunk)
        word, marks = m[1].lower(), m[2].encode()
        key = word.encode()
        ids = self._known(key)
        if ids is None:
            ids = self._new[key] = self._word(word)
        if marks:
            tail = self._known(marks)
            if tail is None:
                tail = self._new[marks] = self._whole(marks)
            ids += tail
        return ids

    def _learn(self, chunks: set[bytes]) -> None:
        if len(self._new) > REMEMBERED:
            self._old, self._new = self._new, {}
        old, new = self._old, self._new
        for c in chunks - new.keys():
            new[c] = old[c] if c in old else self._fresh(c)

    def encode(self, texts: list[bytes]) -> list[bytes]:
        # Case is dropped anyway, but special tokens are told by theirs.
        chunks = [(t if b"<|" in t else t.lower()).split() for t in texts]
        self._learn(set(chain.from_iterable(chunks)))
        ids = self._new
        return [b"".join([ids[c] for c in words]) for words in chunks]


_TOKENIZERS: dict[int, ChunkTokenizer] = {}


def slices(texts: list[bytes | None], limit: int = SLICE_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of consecutive texts of about ``limit`` bytes, each with the index of its first text."""
    first, run, size = 0, [], 0
    for i, t in enumerate(texts):
        run.append(t or b"")
        size += len(run[-1])
        if size >= limit:
            yield first, run
            first, run, size = i + 1, [], 0
    if run:
        yield first, run


def _tokenised(definition, max_len: int, end_id: int, schema: pa.Schema):
    end = end_id.to_bytes(4, "little")
    step = 4 * max_len

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text = definition.value
        tokenizer = _TOKENIZERS.setdefault(zlib.crc32(text.encode()), None) or ChunkTokenizer(text)
        _TOKENIZERS[zlib.crc32(text.encode())] = tokenizer
        uid = TaskContext.get().partitionId() << 40
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()
            for first, part in slices(texts):
                rows = []
                for i, tokens in enumerate(tokenizer.encode(part), first):
                    tokens += end
                    for n, at in enumerate(range(0, len(tokens), step)):
                        piece = tokens[at : at + step]
                        rows.append((uid, ids[i], n, at // 4, len(piece) // 4, zlib.crc32(piece)))
                        uid += 1
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), schema, strict=True)], schema)

    return run


def token_pieces(
    df: DataFrame, tokenizer_path: str, max_len: int = MAX_LEN, end_id: int = END_ID,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """The pieces of every row's text: ``uid`` (one number per piece), doc_id, piece, start, length, ids_crc32.

    Written to the shared folder, since ``uid`` must stay as first given. A null text counts as empty and is
    one piece with the end id. Repeated rows give their pieces again. Nothing is dropped.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    spark = df.sparkSession
    with open(tokenizer_path, encoding="utf-8") as f:
        definition = spark.sparkContext.broadcast(f.read())
    source = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    ddl = _SCHEMA.format(id=source.schema["doc_id"].dataType.simpleString())
    schema = to_arrow_schema(StructType.fromDDL(ddl))
    return landed(source.mapInArrow(_tokenised(definition, max_len, end_id, schema), ddl), "pieces")


def best_fit_plan(histogram: dict[int, int], max_len: int = MAX_LEN) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over ``{length: count}``.

    Returns runs ``(length, first_rank, end_rank, per_bin, first_bin, offset)``: pieces of that length with rank
    from first to end go, ``per_bin`` to a bin, into consecutive bins behind ``offset`` used tokens. Equal bins
    are handled together; a piece goes to the fullest bin that holds it, and into a new bin if none does.
    """
    free: list[list[tuple[int, int]]] = [[] for _ in range(max_len + 1)]  # by free space: (first bin, bins)
    runs, bins = [], 0
    for length in sorted(histogram, reverse=True):
        rank, left = 0, histogram[length]
        space = length
        while left:
            while space <= max_len and not free[space]:
                space += 1
            if space > max_len:
                space = max_len
                per = max_len // length
                free[space].append((bins, -(-left // per)))
                bins += -(-left // per)
            first, n = free[space].pop()
            per = space // length
            take = min(left, n * per)
            runs.append((length, rank, rank + take, per, first, max_len - space))
            full, rest = divmod(take, per)
            if full:
                free[space - per * length].append((first, full))
            if rest:
                free[space - rest * length].append((first + full, 1))
            if n > full + (rest > 0):
                free[space].append((first + full + (rest > 0), n - full - (rest > 0)))
            rank, left = rank + take, left - take
    return runs


def _ranked(pieces: DataFrame, shards: int) -> DataFrame:
    """``rank`` from 0 within each length. A length's pieces are spread over shards, numbered there, and moved
    on by the counts of the shards before, so that a very common length is no single task's work."""
    pieces = pieces.withColumn("shard", F.pmod(F.xxhash64("uid"), F.lit(shards)))
    before = Window.partitionBy("length").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    counts = pieces.groupBy("length", "shard").agg(F.count("*").alias("n"))
    offsets = counts.select("length", "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    here = F.row_number().over(Window.partitionBy("length", "shard").orderBy("uid"))
    return pieces.withColumn("here", here - 1).join(offsets, ["length", "shard"]).withColumn(
        "rank", F.col("before") + F.col("here")
    )


def pack(
    df: DataFrame, tokenizer_path: str, max_len: int = MAX_LEN, end_id: int = END_ID,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Pack all rows into sequences of at most ``max_len`` tokens.

    One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset. Only texts longer than a
    sequence are cut. Within a sequence the offsets run from 0 without gaps. An empty table gives no rows.
    Only the histogram, at most ``max_len`` rows, reaches the driver.
    """
    spark = df.sparkSession
    pieces = token_pieces(df, tokenizer_path, max_len, end_id, id_col, text_col)
    histogram = {r.length: r.n for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    plan = spark.createDataFrame(
        best_fit_plan(histogram, max_len),
        "length int, first_rank bigint, end_rank bigint, per_bin bigint, first_bin bigint, used bigint",
    )
    shards = 64 + sum(histogram.values()) // 500_000
    ranked = _ranked(pieces, shards).alias("p")
    c = F.col
    # The plan's runs are bounded by lengths and free spaces, so by max_len alone.
    on = (c("p.length") == c("r.length")) & (c("rank") >= c("first_rank")) & (c("rank") < c("end_rank"))
    nth = c("rank") - c("first_rank")
    return ranked.join(F.broadcast(plan.alias("r")), on).select(
        "p.doc_id", "p.piece", "p.start", c("p.length").cast("bigint").alias("length"), "p.ids_crc32",
        (c("first_bin") + F.floor(nth / c("per_bin"))).cast("bigint").alias("sequence_id"),
        (c("used") + (nth % c("per_bin")) * c("p.length")).cast("bigint").alias("offset"),
    )


def public_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op6_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    """All ``documents`` in sequences of at most 4096 tokens; see :func:`pack`."""
    return pack(table(spark, sf_dir, "documents"), public_tokenizer())
