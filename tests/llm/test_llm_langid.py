from collections import Counter, defaultdict
from math import log2

import numpy as np
from llm_cases import CLASHING, as_set, frame, rows
from pyspark.sql import functions as F

from flightlake.llm import langid as G

SF = "/root/testdata/sf0.01"


def trees(texts):
    count = defaultdict(Counter)
    for t in texts:
        b = b"\0\0\0" + t
        for i in range(3, len(b)):
            for k in range(4):
                count[b[i - k : i]][b[i]] += 1
    return count


def bits(count, seen, text):
    b, total = b"\0\0\0" + bytes(x if x in seen else 0 for x in text), 0.0
    for i in range(3, len(b)):
        for k in (3, 2, 1, 0):
            known = count.get(b[i - k : i])
            if not known:
                continue
            n, kinds = sum(known.values()), len(known)
            if known[b[i]]:
                total += log2(n + kinds) - log2(known[b[i]])
                break
            total += log2(n + kinds) - log2(kinds)
        else:
            total += 8
    return total


def test_code_lengths_match_brute_force(spark):
    data = [r for r in rows() if r[1] and r[2]]
    model = G.train(frame(spark, data), sample_bytes=10**9, max_contexts=10**9)
    assert model.languages == ["en", "fr"]
    seen = set(b"\0".join(r[1].encode() for r in data)) | {0}
    texts = [r[1].encode() for r in data[:12]] + [b"", b"q", "字 Ω end".encode(), b"x" * (G.CHUNK + 5)]
    got = G.code_lengths(model, texts)
    for j, lang in enumerate(model.languages):
        tree = trees([r[1].encode() for r in data if r[2] == lang])
        want = [bits(tree, seen, t) for t in texts[:-1]]
        assert np.allclose(got[:-1, j], want, rtol=1e-5)
        assert np.isclose(got[-1, j], bits(tree, seen, b"x" * 1000) + (G.CHUNK + 5 - 1000) * (bits(tree, seen, b"x" * 9) - bits(tree, seen, b"x" * 8)), rtol=1e-4)


def test_probabilities_of_a_context_sum_to_at_most_one(spark):
    model = G.train(frame(spark, rows()), sample_bytes=10**9)
    a = int(model.codes.max()) + 1
    mass = np.exp2(-model.bits[:-1]).reshape(-1, a, len(model.languages)).sum(axis=1)
    assert mass.max() <= 1.01 and mass.min() > 0.2


def test_held_out_accuracy(spark):
    out = G.op2_language_id(spark, SF)
    assert out.columns[:4] == ["doc_id", "held_out", "lang_pred", "score"]
    truth = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    right = out.filter("held_out").join(truth, "doc_id").filter("lang IS NOT NULL").select(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.98
    assert out.filter("score < 0 OR score > 1").count() == 0


def test_pruned_model_still_tells(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = G.train(docs, sample_bytes=50_000, max_contexts=300)
    out = G.identify(docs, model, {"lang": F.col("lang")})
    assert out.filter("lang = lang_pred").count() > 0.95 * docs.count()


def test_awkward_rows(spark):
    df = frame(spark, rows(), extra=True)
    model = G.train(df)
    out = G.identify(df, model, {"doc_id": F.col("doc_id"), "text": F.col("text")})
    assert out.count() == len(rows())
    for r in out.collect():
        assert (r.lang_pred == "und") == (not any(map(str.isalpha, r.text or "")))
        assert (r.score == 0) == (r.lang_pred == "und")
    nothing = G.train(frame(spark, []))
    assert as_set(G.identify(df, nothing, {"doc_id": F.col("doc_id")}).select("lang_pred").distinct(), "lang_pred") == [("und",)]
    assert G.identify(frame(spark, []), model, {"doc_id": F.col("doc_id")}).count() == 0
    assert len(CLASHING) + 5 == len(df.columns)


def test_every_labelled_language_is_learned(spark):
    """A language of one huge text, and one whose rows no draw would take."""
    huge = "wug blick dax " * 60_000
    data = [(1, huge, "xx", None, None), *[(10 + i, "le la les des", "fr", None, None) for i in range(5)], (30, "qqq zzz", "yy", None, None)]
    from llm_cases import frame
    from flightlake.llm import langid
    for sample in (1, 100):
        assert langid.train(frame(spark, data), sample_bytes=sample).languages == ["fr", "xx", "yy"]
    model = langid.train(frame(spark, data), sample_bytes=1)
    assert langid.code_lengths(model, [b"wug dax", b"les la"]).argmin(axis=1).tolist() == [1, 0]
