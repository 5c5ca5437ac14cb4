import random

import numpy as np
import xxhash

from proofmark.llm import simhash_trees as S
from proofmark.llm.components import components


def brute_fp(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hs = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs)) if hs else 0


def brute_components(rows):
    """rows: (id, fingerprint); ids with the same fingerprint or at most 3 bits apart, and equal ids, are linked."""
    parent = {i: i for i, _ in rows}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in rows:
        for j, b in rows:
            if (a ^ b).bit_count() <= 3:
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    return {i: root(i) for i in parent}


def corpus():
    rnd = random.Random(11)
    vocab = [f"w{i}é" for i in range(400)] + ["The", "OF", "and"]
    texts = [None, "", " \n", "one", "two Words", "x " * 3000]
    for _ in range(60):
        words = rnd.choices(vocab, k=rnd.choice([3, 8, 60, 300]))
        texts.append(" ".join(words))
        for _ in range(rnd.choice([0, 0, 1, 3, 8])):  # copies, near copies, chains of edits
            words = list(words)
            for _ in range(rnd.choice([0, 1, 2])):
                words[rnd.randrange(len(words))] = rnd.choice(vocab)
            texts.append("\t".join(words).upper() if rnd.random() < 0.2 else " ".join(words))
    return texts


def test_fingerprints_and_components(spark):
    texts = corpus()
    ids = list(range(len(texts)))
    random.Random(1).shuffle(ids)
    rows = list(zip(ids, texts))
    rows += [rows[10], rows[10], (ids[7], "another text of the same id " * 9)]  # repeated rows and a repeated id
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, fp string")
    out = S.label(docs).collect()
    expected = brute_components([(i, brute_fp(t)) for i, t in rows])
    assert sorted((r.doc_id, r.fingerprint, r.component_id) for r in out) == sorted(
        (i, f"{brute_fp(t):016x}", expected[i]) for i, t in rows
    )
    assert len({r.component_id for r in out}) < len(out) - 40
    kept = S.keep(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(expected.values()))


def test_null_ids_and_empty(spark):
    docs = spark.createDataFrame([(None, "a b c d"), (None, "a b c d"), (5, "a b c d"), (None, "q r s t u")], "doc_id long, text string")
    out = sorted(((r.doc_id, r.component_id) for r in S.label(docs).collect()), key=repr)
    assert out == sorted([(5, 5), (None, 5), (None, 5), (None, None)], key=repr)
    assert sorted(r.text for r in S.keep(docs).collect()) == ["a b c d", "q r s t u"]
    assert S.label(docs.limit(0)).count() == 0 and S.keep(docs.limit(0)).count() == 0


def near(rng, n):
    fp = rng.integers(0, 2**64, n, dtype=np.uint64)
    flips = [np.uint64(1) << rng.integers(0, 64, n, dtype=np.uint64) for _ in range(4)]
    return np.unique(np.concatenate([fp, fp ^ flips[0] ^ flips[1] ^ flips[2], fp ^ flips[0] ^ flips[1] ^ flips[2] ^ flips[3]]))


def test_deal_brings_every_pair_together():
    fp = near(np.random.default_rng(2), 700)
    at, shard = S.deal(fp, 6)
    members = {}
    for i, s in zip(at, shard):
        members.setdefault(s, set()).add(i)
    i, j = np.nonzero(np.bitwise_count(fp[:, None] ^ fp[None]) <= 3)
    assert all(any(a in m and b in m for m in members.values()) for a, b in zip(i, j) if a < b)


def test_shard_forest_equals_brute_force():
    rng = np.random.default_rng(4)
    ball = np.uint64(77) ^ (np.uint64(1) << rng.integers(0, 64, 900, dtype=np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 900, dtype=np.uint64))
    fp = np.unique(np.concatenate([near(rng, 900), ball]))
    whole = S.Forest(len(fp))
    S._compare(fp, np.arange(len(fp)), whole, 3)
    assert np.array_equal(S.shard_forest(fp), whole.label)


def test_many_shards_equal_one(spark):
    fp = near(np.random.default_rng(9), 3000).view(np.int64)
    nodes = spark.createDataFrame([(int(f), i) for i, f in enumerate(fp)], "fp long, node long")
    one = {tuple(r) for r in components(S.links(nodes)).collect()}
    assert {tuple(r) for r in components(S.links(nodes, shard=64)).collect()} == one and one


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(200)]
    star = [(1000, 1000 + i) for i in range(1, 300)]
    late = [(3001, 3005), (3005, 3002), (3002, 3009), (3000, 3009), (7, 7)]
    out = dict(tuple(r) for r in components(spark.createDataFrame(chain + star + late, "a long, b long")).collect())
    assert all(out[i] == 0 for i in range(201)) and all(out[1000 + i] == 1000 for i in range(300))
    assert all(out[i] == 3000 for i in (3000, 3001, 3002, 3005, 3009))
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_a_half_that_very_many_share(spark, monkeypatch):
    """Near copies of one template: trees over the shared half can't split them, those over the other half do."""
    rng = np.random.default_rng(8)
    n, top = 6000, np.uint64(0x123456789ABCDEF0) & ~np.uint64(0xFFFFFFFF)
    fp = np.unique(top | rng.integers(0, 1 << 32, n, dtype=np.uint64))
    near = fp[:400] ^ (np.uint64(1) << rng.integers(0, 32, 400, dtype=np.uint64)) ^ (np.uint64(1) << rng.integers(32, 64, 400, dtype=np.uint64))
    fp = np.unique(np.concatenate([fp, near, near[:200] ^ np.uint64(1 << 40)]))
    nodes = spark.createDataFrame(list(enumerate(fp.view(np.int64).tolist())), "node long, fp long").select("fp", "node")
    found = S.links(nodes, shard=64).collect()
    parent = list(range(len(fp)))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for r in found:
        assert int(fp[r.a] ^ fp[r.b]).bit_count() >= 1
        parent[max(root(r.a), root(r.b))] = min(root(r.a), root(r.b))
    want = list(range(len(fp)))
    for i in range(len(fp)):
        for j in np.flatnonzero(np.bitwise_count(fp[i + 1 :] ^ fp[i]) <= 3) + i + 1:
            a, b = i, int(j)
            while want[a] != a:
                a = want[a]
            while want[b] != b:
                b = want[b]
            want[max(a, b)] = min(a, b)
    for i in range(len(fp)):
        while want[i] != want[want[i]]:
            want[i] = want[want[i]]
    assert [root(i) for i in range(len(fp))] == want and len(set(want)) < len(fp) - 300


def test_dealing_again_keeps_pairs_together():
    rng = np.random.default_rng(3)
    depth, shard = 4, np.uint64
    for half in range(2):
        fp = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
        other = np.uint64(0 if half else 32)
        bits = rng.integers(0, 32, (300, 3), dtype=np.uint64)
        twin = fp.copy()
        for k in range(3):
            twin ^= np.uint64(1) << (bits[:, k] + other)
        of = np.full(300, (2 + half) << depth, shard)
        a, b = (S.deal_again(x, of, np.full(300, 6), depth) for x in (fp, twin))
        for i in range(300):
            assert set(a[1][a[0] == i].tolist()) & set(b[1][b[0] == i].tolist())
