import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from proofmark.llm import anchors
from proofmark.llm import rlz_spans as R


def brute(rows, window):
    texts = [(t or "").encode().split() for _, t, *_ in rows]
    seen = Counter(tuple(w[i : i + window]) for w in texts for i in range(len(w) - window + 1))
    out = []
    for (i, *_), w in zip(rows, texts):
        gone = {j for k in range(len(w) - window + 1) if seen[tuple(w[k : k + window])] > 1 for j in range(k, k + window)}
        kept = b" ".join(x for j, x in enumerate(w) if j not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def corpus(seed, vocab, n=120):
    rnd = random.Random(seed)
    word = lambda: rnd.choice(vocab)
    passages = [[word() for _ in range(rnd.choice([20, 34, 35, 36, 50, 120]))] for _ in range(6)]
    texts = [None, "", "a " * 34, "a " * 35, "a " * 700, "é\x0b " + "b c " * 90]
    for _ in range(n):
        words = [word() for _ in range(rnd.randint(0, 150))]
        for _ in range(rnd.choice([0, 1, 2])):
            at = rnd.randint(0, len(words))
            words[at:at] = rnd.choice(passages)
        texts.append(" ".join(words))
        if rnd.random() < 0.3:
            words = list(words)
            for _ in range(rnd.choice([0, 1, 4])):
                if words:
                    words[rnd.randrange(len(words))] = word()
            texts.append("\n".join(words))
    rows = [(i, t, "x", 1) for i, t in enumerate(texts)]
    return rows + [rows[30], rows[30], (None, texts[31], "x", 1)]


@pytest.mark.parametrize("seed,vocab,window,gram", [(1, 900, 35, 5), (2, 2, 35, 5), (3, 3, 8, 2), (4, 40, 12, 12)])
def test_dedup_equals_brute_force(spark, seed, vocab, window, gram):
    rows = corpus(seed, [f"w{i}é" for i in range(vocab)], 120 if vocab > 3 else 40)
    docs = spark.createDataFrame(rows, "doc_id long, text string, n string, start int").repartition(6)
    out = sorted((tuple(r) for r in R.dedup(docs, window=window, gram=gram).collect()), key=repr)
    assert out == brute(rows, window) and any(r[2] for r in out) and any(r[1] > r[2] for r in out)


def test_chunks_change_nothing(spark, monkeypatch):
    rows = corpus(5, [f"w{i}" for i in range(50)], 30)
    docs = spark.createDataFrame(rows, "doc_id long, text string, n string, start int")
    texts = {r.doc_id: r.text for r in R.dedup(docs, with_text=True).collect()}
    assert all(hashlib.sha256(texts[i].encode()).hexdigest() == h for i, _, _, h in brute(rows, 35) if i is not None)


@pytest.mark.parametrize("chunk", [64, 1 << 20])
def test_equal_windows_own_equal_anchors(monkeypatch, chunk):
    monkeypatch.setattr(anchors, "CHUNK", chunk)
    monkeypatch.setattr(anchors, "PLACE", np.uint64(chunk * 2 - 1))
    rng = np.random.default_rng(0)
    symbols = anchors.mix(np.arange(1, 5, dtype=np.uint64) * np.uint64(77_777_777_777))
    for t in range(60):
        sizes = rng.integers(0, 60, rng.integers(1, 9))
        s, ends = rng.integers(0, [2, 4][t % 2], sizes.sum()), sizes.cumsum()
        _, start, n, anchor, place, phrase = anchors.runs(symbols[s], ends, 8, 3)
        starts = sorted(x for a, b in zip(start.tolist(), n.tolist()) for x in range(a, a + b))
        assert starts == [i for e, size in zip(ends, sizes) for i in range(e - size, e - 7)]
        own = {}
        for a, b, x, p, h in zip(start.tolist(), n.tolist(), anchor.tolist(), place.tolist(), phrase.tolist()):
            assert all(own.setdefault(tuple(s[i : i + 8]), (x, p - i)) == (x, p - i) for i in range(a, a + b))
            assert own.setdefault(("phrase", *s[a : a + b + 7]), h) == h


def test_empty(spark):
    assert R.dedup(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_a_row_that_is_repeated_very_often(spark):
    """The spans of rows that repeat whole are gathered once."""
    text = " ".join(f"v{i}" for i in range(1500))
    docs = spark.range(20_000).selectExpr("CAST(7 AS LONG) AS doc_id", f"'{text}' AS text").repartition(16)
    docs = docs.union(spark.createDataFrame([(8, "x " + text[:3000]), (9, "alone")], "doc_id long, text string"))
    out = R.dedup(docs).groupBy("doc_id", "n_words", "n_removed").count().collect()
    n = len(("x " + text[:3000]).split())
    whole = n - 2 if not text[:3000].endswith(" ") and text[3000] != " " else n - 1
    assert sorted(map(tuple, out)) == [(7, 1500, 1500, 20_000), (8, n, whole, 1), (9, 1, 0, 1)]


def test_a_very_long_text(spark):
    words = [f"w{i % 7919}x{i // 7919}" for i in range(300_000)]
    words[250_000:250_040] = words[10:50]
    docs = spark.createDataFrame([(1, " ".join(words))], "doc_id long, text string")
    assert [tuple(r)[:3] for r in R.dedup(docs).collect()] == [(1, 300_000, 80)]
