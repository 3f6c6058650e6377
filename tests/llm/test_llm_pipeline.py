"""The pipeline's stages against brute force on the small table, and on awkward rows."""

import corpus_pipeline as C
from llm_cases import CLASHING, frame, rows
from test_llm_decontam import brute as decontam_brute
from test_llm_simhash import brute_groups, brute_print

from flightlake.llm import pii
from flightlake.llm.storage import landed

SF = "/root/testdata/sf0.001"


def test_every_stage_against_brute_force(spark):
    stages = dict(C.STAGES)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    source = {r.doc_id: r for r in docs.collect()}

    told = landed(stages["language_id"](spark, docs, SF), "t")
    got = {r.doc_id: r for r in told.collect()}
    assert told.columns == docs.columns
    assert set(got) == {i for i, r in source.items() if any(map(str.isalpha, r.text or ""))}
    assert sum(got[i].lang == source[i].lang for i in got) > 0.97 * len(got) and all(got[i].text == source[i].text for i in got)

    single = landed(stages["simhash_near_dedup"](spark, told, SF), "t")
    ids = sorted(got)
    label = brute_groups([brute_print(got[i].text) for i in ids])
    first = {}
    for i, g in zip(ids, label, strict=True):
        first.setdefault(g, i)
    assert sorted(r.doc_id for r in single.collect()) == sorted(first.values()) and single.columns == docs.columns

    clean = landed(stages["benchmark_decontamination"](spark, single, SF), "t")
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    want = {i for i in first.values() if not decontam_brute(got[i].text, items)[-1]}
    assert {r.doc_id for r in clean.collect()} == want and clean.columns == docs.columns

    masked = landed(stages["pii"](spark, clean, SF), "t")
    surrogates = pii.Surrogates(pii.DEMO_KEY)
    for r in masked.collect():
        assert r.text == pii.replace(got[r.doc_id].text, surrogates)[0] and r.n_chars == len(r.text)
        want.remove(r.doc_id)
    assert not want and masked.columns == docs.columns

    packed = stages["best_fit_packing"](spark, masked, SF)
    whole = sorted(map(tuple, packed.select("doc_id", "piece", "length", "ids_crc32").collect()))
    assert {r[0] for r in whole} == {r.doc_id for r in masked.collect()}
    assert sorted(map(tuple, C.run(spark, SF).select("doc_id", "piece", "length", "ids_crc32").collect())) == whole


def test_awkward_rows_and_extra_columns(spark):
    df = frame(spark, rows(), extra=True)
    for name, stage in C.STAGES[:-1]:
        out = landed(stage(spark, df, SF), "t")
        assert out.columns == df.columns and len(out.columns) == 5 + len(CLASHING), name
        df = out
    assert df.count() > 10
    assert C.STAGES[-1][1](spark, df, SF).count() >= df.count()


def test_empty_documents(spark):
    df = frame(spark, [])
    for _, stage in C.STAGES:
        df = stage(spark, df, SF)
        assert df.count() == 0
