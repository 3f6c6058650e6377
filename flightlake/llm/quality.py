"""Quality rules: a table of thresholds compiled into one projection of built-in expressions.

Each rule bounds one metric of a text. All metrics come from one pass over the row's own text, so the
operator needs no shuffle, no user function and no second look at any row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from flightlake.llm.text import SPACE, let, pieces

# Very common words of English, French, German and Spanish.
STOP_WORDS = (
    "the of and to in is that for it was on with as by at from are be this have or an not which "
    "de la le les et des en un une que est pour dans qui sur pas au par avec "
    "der die das und den von zu mit sich ist ein eine nicht im auf für dem des auch "
    "el los las del se por con para no su al lo más"
).split()

#: Words in a repeated window count as repetition.
WINDOW = 8


@dataclass(frozen=True)
class Rule:
    """Keep a text while ``low <= metric <= high``; a missing bound does not restrict."""

    name: str
    metric: str
    low: float | None = None
    high: float | None = None


#: The base rules (the first two) and the ratio rules of the operator.
RULES = (
    Rule("enough_words", "n_words", low=20),
    Rule("repetition", "repeat_ratio", high=0.30),
    Rule("word_length", "mean_word_length", low=2.0, high=16.0),
    Rule("symbols", "symbol_ratio", high=0.10),
    Rule("stop_words", "stop_ratio", low=0.02),
    Rule("duplicate_lines", "dup_line_ratio", high=0.40),
)


def _windows(words: Column, n: Column) -> Column:
    """A 64-bit hash of each window of WINDOW words, in order."""
    starts = F.sequence(F.lit(1), n - (WINDOW - 1))
    return F.when(n >= WINDOW, F.transform(starts, lambda i: F.xxhash64(F.slice(words, i, WINDOW)))).otherwise(
        F.array().cast("array<bigint>")
    )


def _covered(starts: Column) -> Column:
    """Words that the windows at these ascending starts cover together."""
    step = F.transform(
        starts, lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get(starts, i + 1) - p, F.lit(WINDOW)))
    )
    return F.aggregate(step, F.lit(0).cast("bigint"), lambda a, b: a + b)


def _repeated_starts(hashes: Column) -> Column:
    """Ascending starts of the windows whose hash occurs more than once."""

    def neighbours(ranked: Column) -> Column:
        marked = F.transform(
            ranked,
            lambda e, i: F.when(
                (F.get(ranked, i + 1)["h"] == e["h"]) | ((i > 0) & (F.get(ranked, i - 1)["h"] == e["h"])), e["p"]
            ),
        )
        return F.sort_array(F.array_compact(marked))

    return let(
        F.sort_array(F.transform(hashes, lambda h, p: F.struct(h.alias("h"), p.alias("p")))), neighbours
    )


def repeated_words(words: Column) -> Column:
    """Words in WINDOW-word windows found twice or more in the text, first ones included.

    Windows are compared by a 64-bit hash; texts in which no hash repeats skip the rest.
    """
    return let(
        let(words, lambda w: _windows(w, F.size(w))),
        lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("bigint")).otherwise(
            let(_repeated_starts(h), _covered)
        ),
    )


def _ratio(part: str, whole: str) -> Column:
    return F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(F.lit(0.0))


METRICS = {
    "n_words": lambda: F.col("n_words"),
    "mean_word_length": lambda: _ratio("word_chars", "n_words"),
    "symbol_ratio": lambda: _ratio("n_symbols", "word_chars"),
    "stop_ratio": lambda: _ratio("n_stop", "n_words"),
    "dup_line_ratio": lambda: _ratio("n_dup_lines", "n_lines"),
    "repeat_ratio": lambda: _ratio("n_repeat_words", "n_words"),
}


def measure(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts of each text: words, characters in words, symbols, lines, repeats, stop words.

    One row out per row in, repeated rows included. A null text counts as empty: all counts 0. Only the two
    named columns are read, so other columns cannot clash.
    """
    base = df.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    parts = base.select(
        "doc_id",
        "text",
        pieces(F.col("text"), SPACE).alias("words"),
        F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
    )
    words, lines, text = F.col("words"), F.col("lines"), F.col("text")
    bare = F.length(F.translate(text, " \t\n\x0b\x0c\r", ""))
    symbols = F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))
    return parts.select(
        "doc_id",
        F.size(words).cast("bigint").alias("n_words"),
        bare.cast("bigint").alias("word_chars"),
        symbols.cast("bigint").alias("n_symbols"),
        F.size(lines).cast("bigint").alias("n_lines"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint").alias("n_dup_lines"),
        F.size(F.filter(words, lambda w: w.isin(*STOP_WORDS))).cast("bigint").alias("n_stop"),
        repeated_words(words).alias("n_repeat_words"),
    )


def verdict(rules: tuple[Rule, ...] = RULES) -> Column:
    """The rule table as one boolean expression over the columns of :func:`measure`."""
    keep = F.lit(True)
    for rule in rules:
        metric = METRICS[rule.metric]()
        if rule.low is not None:
            keep = keep & (metric >= F.lit(rule.low))
        if rule.high is not None:
            keep = keep & (metric <= F.lit(rule.high))
    return keep


def quality_rules(
    df: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The counts of :func:`measure` plus ``kept``, the verdict of all rules, for each row.

    Empty and null texts have no words and are not kept while a rule asks for words. An empty table gives an
    empty result.
    """
    return measure(df, id_col, text_col).withColumn("kept", verdict(rules))


def op7_quality_rules(spark, sf_dir: str) -> DataFrame:
    """Base counts and verdict for every text of ``documents``; see :func:`quality_rules`."""
    from flightlake.llm.text import table

    out = quality_rules(table(spark, sf_dir, "documents"))
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (F.col("kept") & ~failed).alias("kept"),
    )


_STOP_SQL = ", ".join(f"'{w}'" for w in STOP_WORDS)
OP7_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS t FROM documents
), p AS (
  SELECT *, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM d
), g AS (
  SELECT k, i, array_to_string(w[i:i + 7], ' ') AS s
  FROM (SELECT k, w, unnest(range(1, len(w) - 6)) AS i FROM p WHERE len(w) >= 8)
), r AS (
  SELECT k, i FROM (SELECT k, i, count(*) OVER (PARTITION BY k, s) AS c FROM g) WHERE c > 1
), n AS (
  SELECT k, count(DISTINCT i + o) AS n_repeat_words FROM r, unnest(range(8)) AS u(o) GROUP BY k
), m AS (
  SELECT p.doc_id, len(w)::BIGINT AS n_words,
         length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, len(l) AS n_lines,
         len(list_filter(w, lambda x: x IN ({_STOP_SQL}))) AS n_stop,
         coalesce(n.n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM p LEFT JOIN n ON n.k = p.k
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed,
       (n_words >= 20 AND 100 * n_repeat_words <= 30 * n_words
        AND n_repeat_words / greatest(n_words, 1) <= 0.30
        AND word_chars / greatest(n_words, 1) BETWEEN 2 AND 16
        AND n_symbols / greatest(word_chars, 1) <= 0.10
        AND n_stop / greatest(n_words, 1) >= 0.02
        AND n_dup_lines / greatest(n_lines, 1) <= 0.40) AS kept
FROM m
"""
