"""Small column helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

#: White space that separates words: space and the ASCII controls TAB to CR.
SPACE = r"[\x20\x09-\x0D]+"
#: Everything that separates words made of ASCII lower-case letters, digits and any non-ASCII character.
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and leave every other character alone."""
    return F.translate(text, UPPER, UPPER.lower())


def pieces(text: Column, separator: str) -> Column:
    """The non-empty parts of ``text`` between matches of ``separator``."""
    return F.array_remove(F.split(text, separator), "")


def bucket(key: Column, modulus: int) -> Column:
    """crc32 of the key's text, modulo; a null key counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit(""))), F.lit(modulus))


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
