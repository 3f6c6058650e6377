"""Fill-in-the-middle: texts cut at two unit boundaries and put into another order.

A unit is a word with the white space before it; white space at the end is a unit too. A text is read in blocks
of a fixed number of bytes. One Fenwick tree over the blocks stores their unit ends, another their code points.
The block of the k-th unit end is found by binary-lifting descent, which adds up units and code points on its
way; only in that block is the boundary itself looked for. So no list of units is ever made, and memory beside
the text is that of one block and two numbers for each block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from flightlake.llm.packing import slices
from flightlake.llm.text import let, table

SEED = 42
#: Per cent of the texts that are reordered, and of these the ones with the suffix first.
RATE, SUFFIX_FIRST = 50, 80
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Bytes of text in one block.
BLOCK = 8192

_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True


def fenwick(counts: np.ndarray) -> np.ndarray:
    """The tree over ``counts``: node i, from 1, holds the sum of the i & -i counts that end at it."""
    before = np.concatenate([[0], np.cumsum(counts)])
    i = np.arange(1, len(counts) + 1)
    return np.concatenate([[0], before[i] - before[i - (i & -i)]])


class Blocks:
    """A text's blocks with the trees of their unit ends and code points."""

    def __init__(self, text: bytes, block: int = BLOCK):
        self.text, self.block = np.frombuffer(text, np.uint8), block
        starts = range(0, len(text), block)
        inside = [self._inside(s) for s in starts]
        ends = np.array([np.count_nonzero(e) for e, _ in inside], np.int64)
        points = np.array([np.count_nonzero(p) for _, p in inside], np.int64)
        self.ends, self.points = fenwick(ends), fenwick(points)
        self.n_ends, self.n_points = int(ends.sum()), int(points.sum())
        #: White space at the end of the text is a unit that no word ends.
        self.n = self.n_ends + bool(len(text) and _SPACE[self.text[-1]])

    def _inside(self, start: int) -> tuple[np.ndarray, np.ndarray]:
        """Of a block's bytes: which end a word, and which begin a code point."""
        part = self.text[start : start + self.block]
        space = _SPACE[self.text[start : start + self.block + 1]]
        follows = space[1:] if len(space) > len(part) else np.append(space[1:], True)
        return ~space[: len(part)] & follows, (part & 0xC0) != 0x80

    def cut(self, k: int) -> tuple[int, int]:
        """(byte, code point) behind the first k units."""
        if k <= 0:
            return 0, 0
        if k > self.n_ends:
            return len(self.text), self.n_points
        at, units, points, step = 0, 0, 0, 1 << (len(self.ends) - 1).bit_length()
        while step:
            on = at + step
            if on < len(self.ends) and units + self.ends[on] < k:
                at, units, points = on, units + int(self.ends[on]), points + int(self.points[on])
            step >>= 1
        ends, begins = self._inside(at * self.block)
        here = int(np.flatnonzero(ends)[k - units - 1]) + 1
        return at * self.block + here, points + int(np.count_nonzero(begins[:here]))


def transform(text: bytes, h: tuple[int, int, int, int], rate: int = RATE, suffix_first: int = SUFFIX_FIRST, block: int = BLOCK):
    """(units, form, code points of prefix, of middle, output) of one text, with the numbers drawn for it."""
    blocks = Blocks(text, block)
    markers = tuple(m.encode() for m in (PREFIX, SUFFIX, MIDDLE))
    if not text or any(m in text for m in markers) or h[2] % 100 >= rate:
        return blocks.n, "plain", None, None, text
    a, b = sorted((h[0] % (blocks.n + 1), h[1] % (blocks.n + 1)))
    (i, first), (j, second) = blocks.cut(a), blocks.cut(b)
    p, s, m = markers
    if h[3] % 100 < suffix_first:
        form, parts = "spm", (s, text[j:], p, text[:i], m, text[i:j])
    else:
        form, parts = "psm", (p, text[:i], s, text[j:], m, text[i:j])
    return blocks.n, form, first, second - first, b"".join(parts)


def _transformed(rate: int, suffix_first: int, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            *kept, h1, h2, h3, h4, texts = batch.columns
            drawn = list(zip(*(c.to_pylist() for c in (h1, h2, h3, h4)), strict=True))
            for at, part in slices(texts.cast(pa.binary()).to_pylist()):
                rows = [transform(t, h, rate, suffix_first) for t, h in zip(part, drawn[at : at + len(part)], strict=True)]
                n, form, first, second, out = zip(*rows, strict=True)
                cols = [*(c.slice(at, len(part)) for c in kept), pa.array(n), pa.array(form), pa.array(first, pa.int64()),
                        pa.array(second, pa.int64()), pa.array(out, pa.binary())]
                yield pa.record_batch([c.cast(t) for c, t in zip(cols, schema.types, strict=True)], schema)

    return run


def fill_in_middle(
    df: DataFrame, carry: dict[str, Column], seed: int = SEED, rate: int = RATE, suffix_first: int = SUFFIX_FIRST,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """The carried columns of each row plus n (units), form, prefix_chars, middle_chars and output.

    ``form`` is plain for empty texts, for texts that contain a marker and for those not drawn; their output is the
    text and both lengths are null. Else it is spm or psm. Draws depend on the id alone (a null id counts as empty
    text), so rows that share an id are cut by the same numbers. Null texts count as empty. Repeated rows stay;
    an empty table gives none. The whole text is kept whatever its length.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))), 256)
    drawn = [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("bigint").alias(f"__h{i + 1}") for i in range(4)]
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("__text")
    source = df.select(*[c.alias(k) for k, c in carry.items()], *drawn, text)
    added = "n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"
    out = StructType(source.schema.fields[:-5] + StructType.fromDDL(added).fields)
    return source.mapInArrow(_transformed(rate, suffix_first, to_arrow_schema(out)), out)


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made of."""
    whole = lambda p: F.when(form == "psm", F.concat(p[1], p[3], p[2])).otherwise(F.concat(p[2], p[3], p[1]))
    return F.when(form == "plain", output).otherwise(let(F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}"), whole))


def op12_fill_in_middle(spark, sf_dir: str) -> DataFrame:
    """Every text of ``documents`` transformed, with digests of the output and of the text rebuilt from it."""
    made = fill_in_middle(table(spark, sf_dir, "documents"), {"doc_id": F.col("doc_id")})
    again = restored(F.col("output"), F.col("form"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2(again, 256).alias("restored_sha256"),
    )


OP12_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u
  FROM documents
), drawn AS (
  SELECT *, len(u) AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
         ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4 FROM d
), cut AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 50 THEN 'plain'
              WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM drawn
), parts AS (
  SELECT *, array_to_string(u[1:a], '') AS p, array_to_string(u[a + 1:b], '') AS m, array_to_string(u[b + 1:n], '') AS s FROM cut
)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(p) END::BIGINT AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END::BIGINT AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'spm' THEN '<S>' || s || '<P>' || p || '<M>' || m
                        ELSE '<P>' || p || '<S>' || s || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM parts
"""
