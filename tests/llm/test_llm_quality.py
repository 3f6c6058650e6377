from collections import Counter

from llm_cases import as_set, frame, rows, spaced

from flightlake.llm.quality import RULES, Rule, measure, quality_rules


def brute(text):
    w = spaced(text)
    grams = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    inside = {i + k for i in range(len(w) - 7) if grams[tuple(w[i : i + 8])] > 1 for k in range(8)}
    lines = [x for x in (text or "").split("\n") if spaced(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(inside)


COLS = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def test_counts_match_brute_force(spark):
    data = rows()
    data += [(900, "a b c d e f g h i " * 5 + "x", None, None, 1), (901, "one\ntwo\none\n\n\none \n", None, None, 1),
             (902, "w " * 40, None, None, 1), (903, "#a| <b> 100% *&$\n", None, None, 1)]
    got = as_set(measure(frame(spark, data, extra=True)), *COLS)
    assert got == sorted(((r[0], *brute(r[1])) for r in data), key=repr)


def test_repeat_positions(spark):
    rng_text = " ".join(f"u{i}" for i in range(30))
    text = f"{rng_text} gap {rng_text} end"
    assert as_set(measure(frame(spark, [(1, text, None, None, 0)])), "n_repeat_words") == [(60,)]


def test_verdicts(spark):
    good = "the cat and the dog went to a house of stone and they saw that it was good for all of them there"
    data = [(1, good, None, None, 0), (2, "short text", None, None, 0), (3, (good + " ") * 3, None, None, 0),
            (4, good.replace(" ", "### "), None, None, 0), (5, None, None, None, 0)]
    assert as_set(quality_rules(frame(spark, data)), "doc_id", "kept") == [(1, True), (2, False), (3, False), (4, False), (5, False)]
    only = (Rule("some", "n_words", low=1),)
    assert as_set(quality_rules(frame(spark, data), only), "kept").count((True,)) == 4
    assert quality_rules(frame(spark, data), ()).filter("kept").count() == 5


def test_empty_table_and_plan(spark):
    df = quality_rules(frame(spark, []))
    assert df.count() == 0
    plan = quality_rules(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan
    assert len(RULES) >= 5
