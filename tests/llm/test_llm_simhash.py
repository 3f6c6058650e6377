import numpy as np
import pytest
import xxhash
from llm_cases import LOWER, as_set, frame, rows, spaced

from flightlake.llm import simhash as S


def brute_print(text, shingle=4):
    w = spaced((text or "").translate(LOWER))
    if not w:
        return 0
    grams = [" ".join(w[i : i + shingle]) for i in range(len(w) - shingle + 1)] or [" ".join(w)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(prints, radius=4):
    label = list(range(len(prints)))
    for _ in prints:
        new = [min(label[j] for j, q in enumerate(prints) if bin(p ^ q).count("1") <= radius) for p in prints]
        if new == label:
            break
        label = new
    return label


def test_matches_brute_force(spark):
    data = rows(n=80)
    # Near copies of a long text: one word changed at the end moves few bits.
    base = data[-6][1] if data[-6][1] else data[3][1]
    data += [(500 + k, base + f" w{k}", "en", "s", 0) for k in range(6)]
    prints = [brute_print(r[1]) for r in data]
    label = brute_groups(prints)
    first = {}
    for r, g in zip(data, label, strict=True):
        if r[0] is not None:
            first[g] = min(first.get(g, r[0]), r[0])
    want = sorted(((r[0], f"{p:016x}", first.get(g)) for r, p, g in zip(data, prints, label, strict=True)), key=repr)
    assert as_set(S.simhash_groups(frame(spark, data, extra=True)), "doc_id", "fingerprint", "component_id") == want

    kept = S.keep_one(frame(spark, data, extra=True))
    groups = dict(zip(zip((r[0] for r in data), (r[1] for r in data), strict=True), label, strict=True))
    got = [(r.doc_id, r.text) for r in kept.collect()]
    assert sorted(groups[g] for g in got) == sorted(set(label)) and kept.columns == frame(spark, [], extra=True).columns
    assert all(i == first.get(groups[i, t]) for i, t in got)


@pytest.mark.parametrize("tile", [4, 2048])
def test_links_connect_what_all_pairs_connect(spark, tile):
    rng = np.random.default_rng(3)
    seeds = rng.integers(0, 2**64, 12, dtype=np.uint64)
    prints = {int(s) for s in seeds}
    for s in seeds:  # chains of small steps around each seed
        p = int(s)
        for _ in range(12):
            for b in rng.choice(64, int(rng.integers(1, 6)), replace=False):
                p ^= 1 << int(b)
            prints.add(p)
    prints = sorted(prints)
    signed = [p - (p >> 63 << 64) for p in prints]
    df = spark.createDataFrame([(p,) for p in signed], "fp bigint")
    root = {r.node: r.root for r in S.components(S.near_links(df, 4, tile)).collect()}
    label = brute_groups(prints)
    pairs = {}
    for p, g in zip(signed, label, strict=True):
        assert pairs.setdefault(g, root.get(p, p)) == root.get(p, p)
    assert len(set(pairs.values())) == len(set(label))


def test_long_chain_and_spanning(spark):
    chain = spark.range(300).selectExpr("id AS src", "id + 1 AS dst")
    assert {r.root for r in S.components(chain).collect()} == {0}
    node, root = S.spanning(np.array([1, 2, 8]), np.array([2, 3, 9]))
    assert sorted(zip(node.tolist(), root.tolist(), strict=True)) == [(2, 1), (3, 1), (9, 8)]


def test_empty_table(spark):
    assert S.simhash_groups(frame(spark, [])).count() == 0
    assert S.keep_one(frame(spark, [])).count() == 0
