"""Secret scanning with two character Markov models: random strings and ordinary identifiers.

Patterns find assignments, access keys and long hex runs. Every other long run of key characters is scored by
both models: the log-likelihood ratio per character says whether it looks drawn at random or written by people.
Both models are trained from labelled samples: random strings drawn with a fixed seed over the alphabets that
keys use, and the words and joined words that the corpus itself contains.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from flightlake.llm.packing import slices
from flightlake.llm.text import table

# The base patterns and their least lengths.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # the runs of 24 or more; shorter runs would be dropped
ASSIGN_LEAST, ACCESS_LEAST = 6, 20
KINDS = ("assign", "access", "hex", "markov")

#: Runs that the models judge: key characters, at least this many of them.
RUN = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
#: Bits per character by which a run must look more random than written.
MARGIN = 1.5
#: Bytes of corpus text, about, that the identifier model learns from, and random strings drawn.
SAMPLE_BYTES, RANDOM_STRINGS = 1_000_000, 4000

_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
_CODE = np.full(256, len(_ALPHABET), np.uint8)
_CODE[np.frombuffer(_ALPHABET.encode(), np.uint8)] = np.arange(len(_ALPHABET))
_WORD = re.compile(r"[A-Za-z0-9_]+")


@dataclass(frozen=True)
class Models:
    """Bits by which each character, given the one before, is likelier as random than as written."""

    ratio: np.ndarray

    def score(self, run: str) -> float:
        """Mean bits per character in favour of random."""
        c = _CODE[np.frombuffer(run.encode(), np.uint8)]
        return float(self.ratio[c[:-1], c[1:]].mean())


def _pairs(strings: list[str]) -> np.ndarray:
    """How often each key character follows each."""
    n = len(_ALPHABET)
    count = np.zeros((n + 1) ** 2)
    # Strings stand apart by a byte that is no key character.
    c = _CODE[np.frombuffer("\n".join(strings).encode(), np.uint8)].astype(np.int64)
    if len(c) > 1:
        count += np.bincount(c[:-1] * (n + 1) + c[1:], minlength=len(count))
    return count.reshape(n + 1, n + 1)[:n, :n]


def _transitions(count: np.ndarray) -> np.ndarray:
    n = len(_ALPHABET)
    # A pair never seen falls back on how often its second character occurs.
    single = (count.sum(axis=0) + 1) / (count.sum() + n)
    return np.log2((count + single) / (count.sum(axis=1, keepdims=True) + 1))


def random_samples(n: int = RANDOM_STRINGS, seed: int = 42) -> list[str]:
    """Random strings over the alphabets of keys: hex, letters and digits, base 64, capital letters and digits."""
    rng = np.random.default_rng(seed)
    kinds = ("0123456789abcdef", _ALPHABET[:62], _ALPHABET[:64], _ALPHABET[:62] + "-_", _ALPHABET[:26] + _ALPHABET[52:62])
    return ["".join(rng.choice(list(kinds[i % len(kinds)]), 40)) for i in range(n)]


def written_samples(texts: list[str]) -> list[str]:
    """Words of the texts, and runs of them joined as identifiers are; base findings are left out."""
    found = []
    for t in texts:
        for p in (ASSIGN, ACCESS, HEX):
            t = p.sub(" ", t)
        words = _WORD.findall(t)
        found += words
        for i in range(0, len(words) - 2, 3):
            a = words[i : i + 3]
            found += ["_".join(a), "-".join(a), "".join(w.capitalize() for w in a), "/".join(a), "_".join(a).upper()]
    return found


def _written_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros((len(_ALPHABET),) * 2)
    for batch in batches:
        for _, part in slices(batch.column(0).cast(pa.binary()).to_pylist()):
            total += _pairs(written_samples([t.decode() for t in part]))
    seen = np.nonzero(total.ravel())[0]
    yield pa.record_batch([pa.array(seen), pa.array(total.ravel()[seen].astype(np.int64))], names=["pair", "n"])


def train(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_bytes: int = SAMPLE_BYTES) -> Models:
    """Both models. The identifier model learns from a hash sample of whole texts, of about ``sample_bytes`` and at
    least one text that is not null. The driver gets counts of character pairs, never a text. With no text at all
    every pair is as likely as its second character among none."""
    rows = df.select(F.xxhash64(id_col, text_col).alias("hash"), F.col(text_col).cast("string").alias("text")).filter("text IS NOT NULL")
    size, first = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(1)), F.min("hash")).first()
    drawn = F.pmod("hash", F.lit(1 << 24)) < int(min(1.0, sample_bytes / max(size, 1)) * (1 << 24))
    sample = rows.filter(drawn | F.col("hash").eqNullSafe(F.lit(first).cast("bigint"))).select("text")
    count = np.zeros(len(_ALPHABET) ** 2)
    for r in sample.mapInArrow(_written_pairs, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n")).collect():
        count[r.pair] = r.n
    return Models(_transitions(_pairs(random_samples())) - _transitions(count.reshape((len(_ALPHABET),) * 2)))


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the pattern findings, leftmost and non-overlapping for each kind."""
    found = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return found


def spans(text: str, models: Models, margin: float = MARGIN) -> list[tuple[int, int, str]]:
    """Base findings plus the ``markov`` runs that touch none of them and look random."""
    found = base_spans(text)
    taken = sorted(found)
    starts, reach = [a for a, _, _ in taken], []
    for _, b, _ in taken:
        reach.append(max(b, reach[-1] if reach else 0))
    for m in RUN.finditer(text):
        before = bisect_left(starts, m.end())  # findings that start before the run ends
        if (not before or reach[before - 1] <= m.start()) and models.score(m[0]) >= margin:
            found.append((m.start(), m.end(), "markov"))
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def _listed(found: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in found)


def _scan(shared, margin: float, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = shared.value
        for batch in batches:
            found = [spans(t.decode(), models, margin) for _, part in slices(batch.column(1).cast(pa.binary()).to_pylist()) for t in part]
            base = [[s for s in f if s[2] != "markov"] for f in found]
            counts = [pa.array([sum(s[2] == kind for s in f) for f in found], pa.int64()) for kind in KINDS]
            digest = pa.array([hashlib.sha256(_listed(b).encode()).hexdigest() for b in base], pa.string())
            listed = pa.array([_listed(f) for f in found], pa.string())
            yield pa.record_batch([batch.column(0).cast(schema.types[0]), *counts, digest, listed], schema)

    return run


def scan(df: DataFrame, models: Models, margin: float = MARGIN, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_assign, n_access, n_hex, n_markov, base_sha256 and spans.

    Positions count code points of the whole text; null texts count as empty. Repeated rows are reported alike.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    source = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    ddl = f"doc_id {source.schema['doc_id'].dataType.simpleString()}, " + ", ".join(f"n_{k} bigint" for k in KINDS)
    ddl += ", base_sha256 string, spans string"
    shared = df.sparkSession.sparkContext.broadcast(models)
    return source.mapInArrow(_scan(shared, margin, to_arrow_schema(StructType.fromDDL(ddl))), ddl)


def op3_secret_scans(spark, sf_dir: str) -> DataFrame:
    """Secrets in all ``documents``, by models learned from them; see :func:`scan`."""
    docs = table(spark, sf_dir, "documents")
    out = scan(docs, train(docs))
    return out.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_markov")
