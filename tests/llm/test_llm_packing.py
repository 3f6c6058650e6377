import zlib
from collections import Counter, defaultdict

import numpy as np
from hypothesis import given, settings, strategies as st
from llm_cases import frame, rows
from tokenizers import Tokenizer

from flightlake.llm.packing import ChunkTokenizer, best_fit_plan, pack, public_tokenizer

WHOLE = Tokenizer.from_file(public_tokenizer())
with open(public_tokenizer(), encoding="utf-8") as f:
    CHUNKS = ChunkTokenizer(f.read())


def ids(text):
    return WHOLE.encode(text or "", add_special_tokens=False).ids


def test_awkward_rows_round_trip(spark):
    data = rows()
    out = pack(frame(spark, data, extra=True), public_tokenizer(), max_len=256).collect()
    want = []
    for r in data:
        tokens = [*ids(r[1]), 1]
        for n, at in enumerate(range(0, len(tokens), 256)):
            part = tokens[at : at + 256]
            want.append((r[0], n, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    assert sorted((tuple(r)[:5] for r in out), key=repr) == sorted(want, key=repr)
    bins = defaultdict(list)
    for r in out:
        bins[r.sequence_id].append((r.offset, r.length))
    for parts in bins.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 256
    assert len(bins) <= -(-sum(r.length for r in out) // 256) * 1.1 + 1


def test_empty_table(spark):
    assert pack(frame(spark, []), public_tokenizer()).count() == 0


ALPHABET = st.characters(codec="utf-8") | st.sampled_from("aB é'É.,#<|> \n\t0İſß字🙂́")


@settings(max_examples=300, deadline=None)
@given(st.text(ALPHABET, max_size=60))
def test_chunks_give_the_tokenizer_s_ids(text):
    got = np.frombuffer(CHUNKS.encode([text.encode()])[0], "<u4").tolist()
    assert got == ids(text)


def test_chunks_of_given_texts(spark):
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    texts += ["It's we'll I'M don't 'tis", "<|endoftext|> a<|startoftext|>B <|ENDOFTEXT|>", "Straße ÉTÉ naïve, co-op... (x)"]
    for t, got in zip(texts, CHUNKS.encode([t.encode() for t in texts]), strict=True):
        assert np.frombuffer(got, "<u4").tolist() == ids(t)


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 32), st.integers(1, 60), max_size=20))
def test_plan_places_every_rank_once(histogram):
    plan = best_fit_plan(histogram, 32)
    places, used = Counter(), defaultdict(list)
    for length, first, end, per, first_bin, offset in plan:
        for rank in range(first, end):
            places[length, rank] += 1
            used[first_bin + (rank - first) // per].append((offset + (rank - first) % per * length, length))
    assert places == Counter({(n, r): 1 for n, c in histogram.items() for r in range(c)})
    for parts in used.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 32
    # The same as placing one piece after another, longest first, into the fullest bin that holds it.
    free = []
    for n in sorted(histogram, reverse=True):
        for _ in range(histogram[n]):
            fits = [b for b in range(len(free)) if free[b] >= n]
            if fits:
                free[min(fits, key=lambda b: free[b])] -= n
            else:
                free.append(32 - n)
    assert len(used) == len(free)


def test_plan_follows_lengths_not_documents():
    assert len(best_fit_plan({n: 10**9 + n for n in range(1, 4097)})) < 100_000
