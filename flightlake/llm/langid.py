"""Language identification by prediction by partial matching (PPM).

Each language has a context tree of byte statistics up to three bytes deep, frozen after training. A byte is
coded in the longest context that the tree knows; a byte not seen there costs an escape to the next shorter
context, down to equal probabilities. The language whose tree codes the text in the fewest bits wins.

Frozen trees are a finite automaton: the state is the longest known context, and the bits of each next byte can
be listed per state once. Scoring a text is then two table look-ups per byte, done for a batch at a time.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from flightlake.llm.packing import slices
from flightlake.llm.text import bucket, table

#: The longest context, in bytes.
ORDER = 3
#: Training text per language is a hash sample of whole documents of about this many bytes.
SAMPLE_BYTES = 1_500_000
#: Contexts of ORDER bytes that the trees keep for each language, the most frequent first.
MAX_CONTEXTS = 5_000
#: Text bytes looked up at once.
CHUNK = 1 << 19
UNKNOWN = "und"

_LETTER = re.compile(rb"[A-Za-z]")


@dataclass(frozen=True)
class Model:
    """``codes``: symbol of each byte, 0 for bytes never seen and for the start of a text. ``state``: state after
    three symbols. ``bits``: a row per state and symbol, a column per language; a last row of zeros."""

    languages: list[str]
    codes: np.ndarray
    state: np.ndarray
    bits: np.ndarray


def _grams(text: bytes) -> np.ndarray:
    """Each byte with the three before it, as one number; a text starts after three zero bytes."""
    b = np.frombuffer(b"\0\0\0" + text, np.uint8).astype(np.uint32)
    return b[:-3] << 24 | b[1:-2] << 16 | b[2:-1] << 8 | b[3:]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("lang", pa.string()), ("gram", pa.int64()), ("n", pa.int64())])
    for batch in batches:
        langs, texts = batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()
        by: dict[str, list[bytes]] = {}
        for lang, t in zip(langs, texts, strict=True):
            by.setdefault(lang, []).append(t)
        for lang, group in by.items():
            for _, part in slices(group):
                gram, n = np.unique(np.concatenate([_grams(t) for t in part]), return_counts=True)
                yield pa.record_batch([pa.array([lang] * len(gram)), pa.array(gram.astype(np.int64)), pa.array(n)], schema)


def _tables(languages: list[str], lang: np.ndarray, gram: np.ndarray, n: np.ndarray, max_contexts: int) -> Model:
    """The automaton of the counts of byte and context, by language."""
    present = np.unique(np.concatenate([(gram >> s) & 0xFF for s in (0, 8, 16, 24)]))
    codes = np.zeros(256, np.uint8 if len(present) < 255 else np.int16)
    codes[present] = np.arange(len(present)) + (present[0] != 0)
    a, many = int(codes.max()) + 1, len(languages)
    c = [codes[(gram >> s) & 0xFF].astype(np.int64) for s in (24, 16, 8, 0)]

    def deeper(contexts: np.ndarray, of_gram: np.ndarray, shorter: np.ndarray) -> np.ndarray:
        """Bits (context, symbol, language), given those of each context without its first byte."""
        here = np.searchsorted(contexts, of_gram)
        known = (here < len(contexts)) & (contexts[np.minimum(here, len(contexts) - 1)] == of_gram)
        bits = shorter  # changed in place, one language at a time: the arrays are large
        for l in range(many):
            mine = known & (lang == l)
            count = np.zeros((len(contexts), a), np.float32)
            np.add.at(count, (here[mine], c[3][mine]), n[mine])
            total, kinds = count.sum(axis=1, keepdims=True), (count > 0).sum(axis=1, keepdims=True)
            whole = np.log2(np.maximum(total + kinds, 1))
            bits[:, :, l] += np.where(total > 0, whole - np.log2(np.maximum(kinds, 1)), 0)
            seen = count > 0
            bits[:, :, l][seen] = (whole - np.log2(np.where(seen, count, 1)))[seen]
        return bits

    root = deeper(np.zeros(1, np.int64), np.zeros(len(gram), np.int64), np.full((1, a, many), np.log2(256), np.float32))
    tables, suffix = [root], np.zeros(a, np.int64)  # suffix: state of each context of the length before
    state, key = np.zeros(1, np.int64), np.zeros(len(gram), np.int64)
    for order in range(1, ORDER + 1):
        key = key + c[ORDER - order] * a ** (order - 1)
        contexts, place = np.unique(key, return_inverse=True)
        if order == ORDER and len(contexts) > max_contexts * many:
            weight = np.bincount(place, weights=n)
            contexts = np.sort(contexts[np.argsort(-weight, kind="stable")[: max_contexts * many]])
        before = np.tile(state, a)  # a context falls back to the one without its first byte
        shorter = np.concatenate(tables)[before[contexts]]
        first = sum(map(len, tables))
        tables.append(deeper(contexts, key, shorter))
        state = before
        state[contexts] = first + np.arange(len(contexts))
    bits = np.concatenate(tables).reshape(-1, many)
    return Model(languages, codes, state.astype(np.int32), np.concatenate([bits, np.zeros((1, many), np.float32)]))


def train(
    df: DataFrame, lang_col: str = "lang", text_col: str = "text", id_col: str = "doc_id",
    sample_bytes: int = SAMPLE_BYTES, max_contexts: int = MAX_CONTEXTS,
) -> Model:
    """Trees of the languages in ``df``. Rows without language or text teach nothing.

    Of each language a hash sample of whole rows is taken, of about ``sample_bytes`` and at least one row, so every
    labelled language is learned. The driver gets the sample's counts of four bytes, never a text. An empty table,
    or one without labels, gives a model without languages.
    """
    spark = df.sparkSession
    rows = df.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"), F.col(id_col).alias("id"))
    rows = rows.filter("lang IS NOT NULL AND text IS NOT NULL AND text <> ''")
    rows = rows.withColumn("hash", F.xxhash64("id", "text"))
    sizes = rows.groupBy("lang").agg(F.sum(F.octet_length("text")).alias("size"), F.min("hash").alias("first")).collect()
    languages = sorted(r.lang for r in sizes)
    if not languages:
        return Model([], np.zeros(256, np.uint8), np.zeros(1, np.int32), np.zeros((2, 0), np.float32))
    share = spark.createDataFrame([(r.lang, min(1.0, sample_bytes / r.size), r["first"]) for r in sizes], "lang string, share double, first bigint")
    drawn = (F.pmod("hash", F.lit(1 << 20)) < F.col("share") * (1 << 20)) | (F.col("hash") == F.col("first"))
    sample = rows.join(F.broadcast(share), "lang").filter(drawn).select("lang", "text")
    counts = sample.mapInArrow(_count, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    found = counts.orderBy("lang", "gram").toArrow()
    lang = pc.index_in(found["lang"], pa.array(languages)).to_numpy()
    return _tables(languages, lang, found["gram"].to_numpy(), found["n"].to_numpy(), max_contexts)


def code_lengths(model: Model, texts: list[bytes]) -> np.ndarray:
    """Bits of each text (rows) under each language (columns)."""
    a = int(model.codes.max()) + 1
    totals = np.zeros((len(texts), len(model.languages)))
    starts = np.cumsum([0] + [len(t) + 3 for t in texts])
    symbols = model.codes[np.frombuffer(b"".join(x for t in texts for x in (b"\0\0\0", t)), np.uint8)].astype(np.int32)
    nothing = len(model.bits) - 1
    for lo in range(0, len(symbols), CHUNK):
        hi = min(lo + CHUNK, len(symbols))
        s = symbols[max(0, lo - 3) : hi]
        pad = 3 - (lo - max(0, lo - 3))
        s = np.concatenate([np.zeros(pad, np.int32), s])
        row = model.state[s[:-3] * (a * a) + s[1:-2] * a + s[2:-1]] * a + s[3:]
        docs = np.arange(np.searchsorted(starts, lo, "right") - 1, np.searchsorted(starts, hi, "left"))
        head = (starts[docs][:, None] + np.arange(3)).ravel()
        row[head[(head >= lo) & (head < hi)] - lo] = nothing
        totals[docs] += np.add.reduceat(model.bits[row], np.maximum(starts[docs], lo) - lo, axis=0, dtype=np.float64)
    return totals


def has_letter(text: bytes) -> bool:
    return bool(_LETTER.search(text)) or any(map(str.isalpha, text.decode()))


def _predict(shared, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            lang, score, rate = [], [], []
            for _, part in slices(batch.column(batch.num_columns - 1).cast(pa.binary()).to_pylist()):
                bits = code_lengths(model, part) if model.languages else None
                for i, t in enumerate(part):
                    if bits is None or not has_letter(t):
                        lang.append(UNKNOWN), score.append(0.0), rate.append(None)
                    else:
                        best = int(bits[i].argmin())
                        lang.append(model.languages[best])
                        score.append(float(1 / np.exp2(np.maximum(bits[i, best] - bits[i], -1000)).sum()))
                        rate.append(float(bits[i, best] / len(t)))
            kept = [batch.column(i) for i in range(batch.num_columns - 1)]
            new = [pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(rate, pa.float64())]
            yield pa.record_batch([x.cast(t) for x, t in zip(kept + new, schema.types, strict=True)], schema)

    return run


def identify(df: DataFrame, model: Model, carry: dict[str, Column], text_col: str = "text") -> DataFrame:
    """The carried columns of each row plus lang_pred, score (0 to 1: the winner's share of probability) and
    bits_per_byte.

    The whole text is scored. ``und`` with score 0 for null texts, texts without a letter, or an empty model.
    Equal code lengths go to the first language by name. Repeated rows are scored alike; no row is dropped.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    source = df.select(*[c.alias(k) for k, c in carry.items()], F.col(text_col).cast("string").alias("__text"))
    out = StructType(source.schema.fields[:-1])
    out = out.add("lang_pred", "string").add("score", "double").add("bits_per_byte", "double")
    shared = df.sparkSession.sparkContext.broadcast(model)
    return source.mapInArrow(_predict(shared, to_arrow_schema(out)), out)


def held_out(id_col: str = "doc_id") -> Column:
    return bucket(F.col(id_col), 3) == 1


def op2_language_id(spark, sf_dir: str) -> DataFrame:
    """Language of every text of ``documents``, learned from rows not held out; see :func:`identify`."""
    docs = table(spark, sf_dir, "documents")
    model = train(docs.filter(~held_out()))
    return identify(docs, model, {"doc_id": F.col("doc_id"), "held_out": held_out()})
