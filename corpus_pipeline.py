"""The corpus pipeline: language ID, near-duplicates, benchmark decontamination, personal data, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents.
``run`` writes each stage's result to the shared folder and hands the written table on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from flightlake.llm import decontam, langid, packing, pii, simhash
from flightlake.llm.storage import landed
from flightlake.llm.text import table


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document gets its predicted language; those in no language (null, empty or letterless text) go.

    The trees learn from the labelled rows among ``docs`` that are not held out. If none is labelled nothing can be
    told, and every document stays as it is.
    """
    model = langid.train(docs.filter(~langid.held_out()))
    if not model.languages:
        return docs
    carry = {f"c{i}": F.col(f"`{c}`") for i, c in enumerate(docs.columns)}
    told = langid.identify(docs, model, carry).filter(F.col("lang_pred") != langid.UNKNOWN)
    return told.select(*[F.col("lang_pred" if c == "lang" else f"c{i}").alias(c) for i, c in enumerate(docs.columns)])


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays, the one with the smallest id."""
    return simhash.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data becomes surrogates; ``n_chars`` follows the new text. Every document stays."""
    carry = {f"c{i}": F.col(f"`{c}`") for i, c in enumerate(docs.columns) if c not in ("text", "n_chars")}
    done = pii.pseudonymise(docs, carry=carry)
    new = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.length("text").cast(docs.schema["n_chars"].dataType)
    return done.select(*[(new[c] if c in new else F.col(f"c{i}")).alias(c) for i, c in enumerate(docs.columns)])


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces in sequences of at most 4096 tokens."""
    return packing.pack(docs, packing.public_tokenizer())


STAGES = [
    ("language_id", language_stage),
    ("simhash_near_dedup", near_dedup_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("pii", pii_stage),
    ("best_fit_packing", packing_stage),
]

#: PPM, SimHash with iterated components, keyed surrogates and tokenising have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = landed(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
