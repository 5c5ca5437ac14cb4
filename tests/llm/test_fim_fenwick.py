import hashlib
import random
import re

import numpy as np
import pytest

from proofmark.llm import fim_fenwick as M

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def brute(i, text):
    text = text or ""
    units = UNIT.findall(text)
    digest = hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[k : k + 8], 16) for k in (0, 8, 16, 24))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return i, len(units), "plain", None, None, text
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < 80:
        return i, len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return i, len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def corpus():
    rnd = random.Random(4)
    texts = [None, "", " ", "\n\t ", "x", " x", "x ", "é", "日本 語\x0b\x0c\r", "a<P>b", "<S", "<M>", "<P<S<M", "\xa0  x", "ab" * 400_000, " " * 3000, "wörd " * 60_000]
    alphabet = ["a", "é", "語", "😀", " ", "  ", "\n", "\x0b", "<", "S>", "<S", "word", "\x1c", "\x85"]
    texts += ["".join(rnd.choices(alphabet, k=rnd.choice([3, 40, 700]))) for _ in range(300)]
    rows = [(i * 13 % 1009, t, "x", 1) for i, t in enumerate(texts)]
    return rows + rows[20:25] + [(None, "no id here", "x", 1), (None, None, "x", 1)]


def test_transform_equals_brute_force(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string, output string, n int").repartition(5)
    out = M.transform(docs).withColumn("again", M.restored()).collect()
    key = lambda r: repr(r[:6])
    assert sorted((tuple(r)[:6] for r in out), key=key) == sorted((brute(i, t) for i, t, *_ in rows), key=key)
    texts = {}
    for i, t, *_ in rows:
        texts.setdefault(i, set()).add(t or "")
    assert all(r.again in texts[r.doc_id] for r in out)
    assert {r.form for r in out} == {"plain", "psm", "spm"}


@pytest.mark.parametrize("block", [1, 2, 3, 64])
def test_every_cut_of_every_block_size(block):
    for _, text, *_ in corpus()[:14] + corpus()[20:60]:
        text = (text or "")[:200]
        units, found = M.Units(text.encode(), block), UNIT.findall(text)
        assert units.count == len(found)
        for k in range(len(found) + 1):
            part = "".join(found[:k])
            assert units.cut(k) == (len(part.encode()), len(part))


@pytest.mark.parametrize("n", [1, 2, 3, 7, 8, 9, 100])
def test_descent_finds_the_block(n):
    counts = np.random.default_rng(n).integers(0, 3, (n, 2))
    tree, sums = M.Fenwick(counts), np.cumsum(counts, axis=0)
    for rank in range(1, int(sums[-1, 0]) + 1):
        block = int(np.searchsorted(sums[:, 0], rank))
        assert tree.descend(rank) == (block, list(sums[block - 1]) if block else [0, 0])


def test_other_markers_and_shares(spark):
    docs = spark.createDataFrame([(i, f"one two three <P> {i}") for i in range(200)], "doc_id string, text string")
    marks = ("[pre]", "[suf]", "[mid]")
    out = M.transform(docs, share=100, spm_share=0, markers=marks)
    assert {r.form for r in out.collect()} == {"psm"}
    assert out.select(M.restored(markers=marks).alias("t")).distinct().count() == 200


def test_empty_table(spark):
    assert M.transform(spark.createDataFrame([], "doc_id long, text string")).collect() == []
