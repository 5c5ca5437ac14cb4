import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from proofmark.llm import column_bwt as C


def brute(rows, window):
    texts = [(t or "").encode() for _, t, *_ in rows]
    seen = Counter(t[i : i + window] for t in texts for i in range(len(t) - window + 1))
    out = []
    for (i, *_), t in zip(rows, texts):
        gone = np.zeros(len(t) + 1, bool)
        for k in range(len(t) - window + 1):
            if seen[t[k : k + window]] > 1:
                gone[k : k + window] = True
        pieces = int((gone[1:] & ~gone[:-1]).sum() + gone[0])
        kept = bytes(x for x, g in zip(t, gone) if not g)
        out.append((i, len(t), int(gone.sum()), pieces, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def corpus(seed, alphabet, scale, n=90):
    rnd = random.Random(seed)
    text = lambda k: "".join(rnd.choices(alphabet, k=k))
    passages = [text(rnd.choice([scale - 1, scale, scale + 1, 2 * scale, 4 * scale])) for _ in range(5)]
    texts = [None, "", "a" * (3 * scale), "ab" * scale, "é" * scale, text(9 * scale)]
    for _ in range(n):
        t = text(rnd.randint(0, 3 * scale))
        for _ in range(rnd.choice([0, 1, 2])):
            at = rnd.randint(0, len(t))
            t = t[:at] + rnd.choice(passages) + t[at:]
        texts.append(t)
        if t and rnd.random() < 0.3:
            for _ in range(rnd.choice([0, 1, 3])):
                at = rnd.randrange(len(t))
                t = t[:at] + rnd.choice(alphabet) + t[at + 1 :]
            texts.append(t)
    rows = [(i, t, "x", 1) for i, t in enumerate(texts)]
    return rows + [rows[20], rows[20], (None, texts[21], "x", 1)]


@pytest.mark.parametrize(
    "seed,alphabet,window,gram,many",
    [(1, "abcdefghé😀", 400, 64, 512), (2, "abcdefghé😀", 400, 64, 1), (3, "ab", 40, 8, 3), (4, "abé", 50, 20, 512), (5, "ab", 40, 8, 512)],
)
def test_dedup_equals_brute_force(spark, monkeypatch, seed, alphabet, window, gram, many):
    monkeypatch.setattr(C, "MANY", many)
    monkeypatch.setattr(C, "PART", 50)
    rows = corpus(seed, alphabet, window)
    docs = spark.createDataFrame(rows, "doc_id long, text string, n string, start int").repartition(6)
    out = sorted((tuple(r) for r in C.dedup(docs, window=window, gram=gram).collect()), key=repr)
    assert out == brute(rows, window) and any(r[2] for r in out) and any(r[1] > r[2] for r in out)


def test_columns_equal_comparing_all():
    rng = np.random.default_rng(3)
    for _ in range(40):
        m = int(rng.integers(1, 30))
        group, lead = rng.integers(0, 4, m), rng.integers(0, 12, m)
        base = rng.integers(97, 99, 60).astype(np.uint8)
        data = []
        for a in lead:
            s = base[12 - a : 12 - a + int(rng.integers(15, 40))].copy()
            s[rng.random(len(s)) < 0.04] = 100
            data.append(s.tobytes())
        marks = C.repeated(group, data, lead, 8)
        for i in range(m):
            for column in range(marks.shape[1]):
                at = lambda k: data[k][p : p + 8] if (p := column - int(lead.max() - lead[k])) >= 0 else b""  # noqa: E731, B023
                mine = at(i)
                want = len(mine) == 8 and any(j != i and group[j] == group[i] and at(j) == mine for j in range(m))
                assert marks[i, column] == want


def test_empty_and_kept_bytes(spark):
    assert C.dedup(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    text = "x" + "0123456789" * 50 + "y"
    docs = spark.createDataFrame([(1, "0123456789" * 45 + "z"), (2, text), (3, "é" * 10)], "doc_id long, text string")
    kept = {r.doc_id: bytes(r.kept) for r in C.dedup(docs, with_bytes=True).collect()}
    assert kept == {1: b"z", 2: b"xy", 3: "é".encode() * 10}


def test_a_row_that_is_repeated_very_often(spark):
    """The spans of rows that repeat whole are gathered once."""
    text = " ".join(f"v{i}" for i in range(900))
    docs = spark.range(20_000).selectExpr("CAST(7 AS LONG) AS doc_id", f"'{text}' AS text").repartition(16)
    docs = docs.union(spark.createDataFrame([(8, "x" + text[:3000] + "\n"), (9, "alone")], "doc_id long, text string"))
    out = C.dedup(docs).groupBy("doc_id", "n_bytes", "n_removed", "n_spans").count().collect()
    assert sorted(map(tuple, out)) == [(7, len(text), len(text), 1, 20_000), (8, 3002, 3000, 1, 1), (9, 5, 0, 0, 1)]


def test_a_very_long_text(spark):
    data = "".join(f"{i:07d}" for i in range(170_000))
    docs = spark.createDataFrame([(1, data + "#" + data[50:650] + "#")], "doc_id long, text string")
    assert [tuple(r)[:4] for r in C.dedup(docs).collect()] == [(1, 1_190_602, 1200, 2)]


def test_passages_by_their_length_in_bytes(spark):
    """What decides is 400 bytes, not how many words: a passage of 60 short words may stay."""
    rnd = random.Random(12)
    rows, want = [], {}
    for n, size in enumerate((300, 380, 399, 400, 401, 460, 900)):
        passage = "".join(rnd.choices("abcdefgh ", k=size))
        for copy in range(3):
            text = "".join(rnd.choices("ijklmnop ", k=200)) + f"<{n}{copy}" + passage + f"{copy}{n}>" + "".join(rnd.choices("ijklmnop ", k=200))
            rows.append((10 * n + copy, text, "x", 1))
            want[10 * n + copy] = size if size >= 400 else 0
    out = C.dedup(spark.createDataFrame(rows, "doc_id long, text string, n string, start int")).collect()
    assert {r.doc_id: r.n_removed for r in out} == want
