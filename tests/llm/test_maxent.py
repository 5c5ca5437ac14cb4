import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from proofmark.llm import maxent as M

SCHEMA = "doc_id long, text string, score string, key int"


def corpus(n=400, seed=3):
    """Two languages whose words follow each other by rule, and some rare words."""
    rnd = random.Random(seed)
    tongues = [[f"{x}{i}" for i in range(60)] for x in ("Al", "bé")]
    rows = []
    for i in range(n):
        words, at = [], rnd.randrange(60)
        tongue = rnd.choice(tongues)
        for _ in range(rnd.randint(5, 80)):
            at = (at * 7 + rnd.choice([1, 1, 1, 2])) % 60
            words.append(tongue[at] if rnd.random() < 0.9 else f"rare{rnd.randrange(5000)}")
        rows.append((i, " ".join(words), "x", 1))
    return rows + [(900, None, "x", 1), (901, "", "x", 1), (902, "word " * 3000, "x", 1), (903, "again b", "x", 1), (903, "again b", "x", 1)]


def held(i):
    return zlib.crc32(str(i).encode()) % 7 == 2


def base(rows):
    texts = {(i, t): (t or "").encode().lower().split() + [None] for i, t, *_ in rows}
    counts = Counter(w for i, t, *_ in rows if not held(i) for w in texts[i, t])
    total, distinct = sum(counts.values()), len(counts)
    out = []
    for i, t, *_ in rows:
        words = texts[i, t]
        value = sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in words)
        out.append((i, held(i), len(words), sum(counts[w] > 0 for w in words), total, value))
    return sorted(out)


@pytest.mark.parametrize("frequent", [M.FREQUENT, 300])
def test_base_and_gain(spark, monkeypatch, frequent):
    monkeypatch.setattr(M, "FREQUENT", frequent)
    rows = corpus()
    out = sorted(tuple(r) for r in M.score(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect())
    want = base(rows)
    assert [r[:5] for r in out] == [r[:5] for r in want]
    assert all(math.isclose(a[5], b[5], rel_tol=1e-9) for a, b in zip(out, want))
    unseen = [r for r in out if r[1]]
    assert sum(r[6] for r in unseen) > 0.9 * sum(r[5] for r in unseen)  # both are negative: the model gains
    assert all(r[6] < 0 for r in out)


def whole_model(words, counts, head=None):
    hashes = np.array([M.word_hash(w) for w in words], np.uint64)
    tails = np.zeros((2, M.TAILS))
    for h, c in zip(hashes.tolist(), counts):
        tails[:, h % M.TAILS] += c, 1
    return M.Model(hashes, np.array(counts), sum(counts), len(counts), *tails), hashes


def tokens(model, hashes):
    first = np.arange(len(hashes)) == 0
    return M.Tokens(hashes, *model.look_up(hashes), first, np.array([len(hashes)]))


def test_probabilities_add_up(monkeypatch):
    monkeypatch.setattr(M, "HEAD", 400)
    words = [f"w{i}".encode() for i in range(200)]
    counts = sorted((1 + 3000 // (i + 1) for i in range(200)), reverse=True)
    model, hashes = whole_model(words, counts)
    rng = np.random.default_rng(0)
    model.weights = [rng.normal(0, 1, w.shape).astype(np.float32) for w in model.weights]
    assert (model.place >= 0).sum() > 10
    for context in ([], [3], [3, 150]):
        total = 0.0
        for k, h in enumerate(hashes):
            text = tokens(model, np.append(hashes[context], h))
            total += 10 ** (model.score(text)[-1] + (math.log10(counts[k] + 1) if text.slots[-1] < 0 else 0))
        unknown = 0.0
        for t in range(M.TAILS):  # one unknown word in each class
            text = np.append(hashes[context], np.uint64((1 << 40) + t))
            unknown += 10 ** model.score(tokens(model, text))[-1]
        assert math.isclose(total + unknown, 1, rel_tol=1e-4)


def test_gradient_follows_the_score(monkeypatch):
    monkeypatch.setattr(M, "HEAD", 40)
    words = [f"w{i}".encode() for i in range(60)]
    model, hashes = whole_model(words, list(range(600, 0, -10)))
    text = tokens(model, np.tile(hashes[[1, 5, 2, 50, 9]], 200))
    before = model.score(text).sum()
    squares = [np.ones_like(w) for w in model.weights]
    for _ in range(20):
        model.learn(text, squares)
    assert model.score(text).sum() > before * 0.5


def test_changes_add_up_over_a_tree(spark, monkeypatch):
    monkeypatch.setattr(M, "FAN", 3)
    monkeypatch.setattr(M, "BLOCKS", 2)
    rows = [(b, p, p + 1, np.array([b, p, 1], np.float32).tobytes()) for b in range(2) for p in range(20)]
    out = M._added(spark.createDataFrame(rows, "block int, part int, tokens long, data binary")).collect()
    assert sorted((r.block, r.tokens, np.frombuffer(r.data, np.float32).tolist()) for r in out) == [(0, 210, [0, 190, 20]), (1, 210, [20, 190, 20])]


def test_empty_and_untrained(spark):
    assert M.score(spark.createDataFrame([], SCHEMA)).count() == 0
    only = next(i for i in range(100) if held(i))
    r = M.score(spark.createDataFrame([(only, "a b", "x", 1)], SCHEMA)).first()
    assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) == (True, 3, 0, 0, 0.0)


def test_words_of_a_batch_are_hashed_together(monkeypatch):
    rnd = random.Random(5)
    spaces = " \t\n\v\f\r"
    texts = [None, b"", b" ", b"A", "É\u00a0\u2028\x1c b".encode()]
    for size in range(1, 40):
        words = [bytes(rnd.choice(b"abXYZ09\xc3\xa9.\x00") for _ in range(size)) for _ in range(5)]
        texts.append(rnd.choice(spaces).encode().join(words) + rnd.choice(["", *spaces]).encode())
    want = [(t or b"").lower().split() + [M.END] for t in texts]
    out = M.Words.of(texts)
    assert out.lengths.tolist() == [len(w) for w in want]
    assert out.hashes.tolist() == [M.word_hash(w) for words in want for w in words]
    calls = []
    monkeypatch.setattr(M, "word_hash", lambda w: calls.append(w) or 0)
    monkeypatch.setattr(M.xxhash, "xxh3_64_intdigest", lambda w: calls.append(w) or 0)
    out = M.Words.of([b" ".join(b"word%d" % i for i in range(5000)), b"a" * 17])
    assert len(set(out.hashes.tolist())) == 5002 and calls == [M.END, b"a" * 17]
    assert [len(x) for x in M.Words.of([])] == [0, 0]


def test_counts_given_back_in_parts_add_up(spark, monkeypatch):
    rows = spark.createDataFrame([(f"w{i % 70} same",) for i in range(200)], "text string").selectExpr("CAST(text AS binary) text", "false AS held_out")
    want = {M.word_hash(b"w%d" % i): 3 if i < 60 else 2 for i in range(70)} | {M.word_hash(b"same"): 200, M.word_hash(M.END): 200}
    for counted in (M.COUNTED, 16):
        monkeypatch.setattr(M, "COUNTED", counted)
        assert {r.word % (1 << 64): r.n for r in M._counts(rows.coalesce(1)).collect()} == want


def test_lines_are_summed_and_put_by_row():
    rng = np.random.default_rng(1)
    for rows in (np.array([4]), np.array([3, 3, 3]), rng.integers(0, 300, 1000)):
        values = rng.normal(0, 1, (len(rows), 5)).astype(np.float32)
        at, sums = M.sums_by_row(rows.astype(np.uint16), values)
        whole = np.zeros((300, 5))
        np.add.at(whole, rows, values)
        table = np.zeros((300, 5), np.float32)
        M.put(table, at, sums)
        assert at.tolist() == sorted(set(rows.tolist())) and np.allclose(table, whole, atol=1e-5)
