import math
import zlib
from collections import Counter

import numpy as np
from llm_cases import frame, rows
from pyspark.sql import functions as F

from flightlake.llm import brown_lm as B


def tokens(text):
    return (text or "").encode().lower().split()


def training(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 7 != 2


def run(df, held_words=B.HELD_WORDS, where=None, **sizes):
    """The core model of ``df``'s training rows, and these rows as numbers."""
    where = ~B.held_out() if where is None else where
    learnt = df.filter(where).select(F.coalesce("text", F.lit("")).alias("text"))
    words = B.vocabulary(B.landed(B.word_counts(learnt), "words"), learnt.count(), held_words)
    ids = B.landed(B.numbered(learnt, words.held, {}), "numbered")
    return B.train(ids, words, **sizes), ids


def base_scores(data):
    count = Counter(w for r in data if training(r[0]) for w in tokens(r[1]))
    docs = sum(training(r[0]) for r in data)
    total, kinds = sum(count.values()) + docs, len(count) + 1

    def score(text):
        w = tokens(text)
        base = sum(math.log10((count[x] + 1) / (total + kinds + 1)) for x in w) + math.log10((docs + 1) / (total + kinds + 1))
        return len(w) + 1, sum(count[x] > 0 for x in w) + 1, total, base

    return score


def test_texts_as_numbers_read_back(spark):
    data = rows(n=90)
    count = Counter(w for r in data for w in tokens(r[1]))
    held = sorted(count, key=lambda w: (-count[w], w))[:50]
    out = B.numbered(frame(spark, data, extra=True), held, {"text": F.col("text")}).collect()
    assert len(out) == len(data) and len({r.uid for r in out}) == len(data)
    for r in out:
        words = held + [w.encode() for w in r.words]
        assert [words[i] for i in np.frombuffer(r.ids, "<i4")] == tokens(r.text) and not set(held) & set(words[50:])


def test_core_counts_match_brute_force(spark):
    data = rows(n=90)
    model, _ = run(frame(spark, data, extra=True), class_words=40, classes=6, held_words=70)
    count = Counter(w for r in data if training(r[0]) for w in tokens(r[1]))
    top = sorted(count, key=lambda w: (-count[w], w))
    assert model.words.held == top[:70] and list(model.words.counts) == [count[w] for w in top[:70]]
    cls, (other, end) = dict(zip(top[:40], model.cls, strict=False)), model.cls[-2:]
    pair = Counter()
    for r in data:
        if training(r[0]):
            path = [end, *(cls.get(w, other) for w in tokens(r[1])), end]
            pair.update(zip(path, path[1:], strict=False))
    k = int(end) + 1
    # Texts stand between ends: the end before a task's first text belongs to it.
    assert [[pair[g, h] for h in range(k)] for g in range(k)] == model.between.astype(int).tolist()
    assert list(model.weight[:6]) == [sum(count[w] for w in cls if cls[w] == g) for g in range(6)]


def likelihood(pairs, cls):
    k = int(cls.max()) + 1
    one = np.eye(k)[cls]
    between = one.T @ pairs @ one
    return B._xlogx(between).sum() - B._xlogx(between.sum(axis=0)).sum() - B._xlogx(between.sum(axis=1)).sum()


def test_exchange_finds_planted_classes_and_a_local_best():
    rng = np.random.default_rng(0)
    n, k = 24, 3
    truth = np.arange(n) * k // n
    pairs = np.where((truth[:, None] + 1) % k == truth[None, :], 40.0, 1.0) + rng.random((n, n))
    pairs = np.pad(pairs, (0, 2), constant_values=1.0)
    cls = B.exchange(pairs, k)
    assert len({(t, c) for t, c in zip(truth, cls, strict=False)}) == k
    best = likelihood(pairs, cls)
    for w in range(n):
        for c in range(k):
            moved = cls.copy()
            moved[w] = c
            assert likelihood(pairs, moved) <= best + 1e-6


def test_classes_help_on_held_out_text(spark):
    out = B.op10_brown_lm_scoring(spark, "/root/testdata/sf0.01").filter("held_out")
    r = out.agg(F.sum("base_score"), F.sum("score")).first()
    assert r[1] > r[0]


def test_best_class_of_a_word_outside_the_core():
    rng = np.random.default_rng(3)
    n, k, extra = 12, 3, 5
    pairs = rng.integers(0, 9, (n + extra + 1, n + extra + 1)).astype(float)  # core, other words one by one, end
    cls = np.array([*np.arange(n) % k, *[k] * extra, k + 1])
    one = np.eye(k + 2)[cls]
    rest = np.arange(n, n + extra)
    self_ = pairs[rest, rest]
    out, into = pairs[rest] @ one, pairs[:, rest].T @ one
    out[:, k] -= self_
    into[:, k] -= self_
    best = B.best_classes(out, into, self_, one.T @ pairs @ one)
    for w, c in zip(rest, best, strict=True):
        moved = [likelihood(pairs, np.where(np.arange(len(cls)) == w, g, cls)) for g in range(k)]
        assert np.isclose(moved[c], max(moved))


def test_every_training_word_has_a_class(spark):
    data = rows(n=90)
    df = frame(spark, data, extra=True)
    sizes = {"class_words": 40, "classes": 6, "held_words": 70}
    core, ids = run(df, **sizes)
    rest = B.word_classes(ids, core).collect()
    count = Counter(w for r in data if training(r[0]) for w in tokens(r[1]))
    cls = dict(zip(core.words.held, core.cls[:-2], strict=False)) | {r.word.encode(): r.cls for r in rest}
    assert set(cls) == set(count) and len(rest) == len(count) - 40 and all(r.n == count[r.word.encode()] for r in rest)
    other, end = core.cls[-2:]
    assert len({r.cls for r in rest}) > 1 and all(c < other for c in cls.values())

    path = lambda t, one=-1: [end, *(other if count[w] == one else cls.get(w, other) for w in tokens(t)), end]
    pair, size = Counter(), Counter()
    for r in data:
        if training(r[0]):
            true, unseen = path(r[1]), path(r[1], 1)
            pair.update(zip(true, true[1:], strict=False))
            pair.update(p for p, q in zip(zip(unseen, unseen[1:], strict=False), zip(true, true[1:], strict=False), strict=True) if p != q)
    before, after = Counter(), Counter()
    for (g, h), x in pair.items():
        before[g] += x
        after[h] += x
    for w, x in count.items():
        size[cls[w]] += x
    k, once = int(end) + 1, sum(x == 1 for x in count.values())
    prior = lambda h: (after[h] + 1) / (sum(after.values()) + k)
    brute_base = base_scores(data)
    carry = {"doc_id": F.col("doc_id"), "text": F.col("text")}
    found = B.score_all_words(df, ~B.held_out(), carry, **sizes).collect()
    assert len(found) == len(data)
    for r in found:
        n, known, total, base = brute_base(r.text)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, total) and np.isclose(r.base_score, base, rtol=1e-9)
        p = path(r.text)
        s = sum(math.log10((pair[g, h] + B.PRIOR * prior(h)) / (before[g] + B.PRIOR)) for g, h in zip(p, p[1:], strict=False))
        s += sum(math.log10(count[x] / size[cls[x]]) if x in cls else -math.log10(once + 1) for x in tokens(r.text))
        assert np.isclose(r.score, s, rtol=1e-9) and np.isclose(r.perplexity, 10 ** (-s / n), rtol=1e-6)


def test_words_of_one_kind_of_neighbours_share_a_class(spark):
    """Rare words, each in place of a frequent one, take its class, and the rare text scores higher for it."""
    data = [(i, " ".join(["red cat", "runs far", "red dog", "runs far"] * 20), None, None, 0) for i in range(40) if training(i)]
    data += [(1000 + i, f"red cat runs far red beast{i} runs far red beast{i} runs far", None, None, 0) for i in range(30) if training(1000 + i)]
    df = frame(spark, data)
    core, ids = run(df, where=F.lit(True), class_words=5, classes=3)
    cls = dict(zip(core.words.held, core.cls[:5], strict=False))
    assert {r.cls for r in B.word_classes(ids, core).collect()} == {cls[b"cat"]}


def test_nothing_to_learn_in_any_class(spark):
    none = frame(spark, [])
    assert B.score_all_words(none, ~B.held_out(), {"doc_id": F.col("doc_id")}).count() == 0
    r = B.score_all_words(frame(spark, [(1, "a b", None, None, 0)]), F.lit(False), {"doc_id": F.col("doc_id")}).first()
    assert (r.n_tokens, r.n_known, r.train_tokens, r.base_score) == (3, 0, 0, 0.0) and math.isfinite(r.score)
