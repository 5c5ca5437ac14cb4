import random
import re

import numpy as np
import pyarrow as pa
import pytest

from proofmark.llm import suffix_arrays as A

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, window=10):
    windows = {}
    for name, text, *_ in items:
        w = words(text)
        for k in range(max(1, len(w) - window + 1) if w else 0):
            windows.setdefault(tuple(w[k : k + window]), set()).add(name or "")
    sizes, out = {len(w) for w in windows}, []
    for i, text, *_ in docs:
        w, hit, names = words(text), set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in windows:
                    hit |= set(range(k, k + n))
                    names |= windows[tuple(w[k : k + n])]
        longest = 0
        for _, t, *_ in items if hit else ():
            v = words(t)
            need = min(window, len(v))
            for x in range(len(v) - need + 1 if v else 0):
                for y in range(len(w)):
                    n = 0
                    while x + n < len(v) and y + n < len(w) and v[x + n] == w[y + n]:
                        n += 1
                    longest = max(longest, n if n >= need else 0)
        out.append((i, len(w), len(hit), sorted(names), longest))
    return sorted(out, key=repr)


def tables(seed, vocab, n=70, short=True):
    rnd = random.Random(seed)
    some = lambda k: [rnd.choice(vocab) for _ in range(k)]
    texts = [some(rnd.randint(10, 40)) for _ in range(12)]
    items = [(f"b{k % 11}", " ".join(t)) for k, t in enumerate(texts)] + [("b1", " ".join(texts[0])), ("nul", None), ("", " ., "), (None, " ".join(texts[3]))]
    if short:
        items += [("one", "Rare"), ("three", "rare bird É9"), ("nine", " ".join(some(9)))]
    docs = [None, "", "...", "rare", "RARE, bird. É9!", "é" * 70_000 + " x " + "y" * 70_000, " ".join(texts[0][:9]), "a" + "\x7f".join(texts[0]) + "b"]
    for _ in range(n):
        w = some(rnd.randint(0, 60))
        for _ in range(rnd.choice([0, 0, 1, 2])):
            t, at = rnd.choice(texts), rnd.randint(0, len(w))
            low = rnd.randint(0, len(t) - 1)
            w[at:at] = t[low : low + rnd.choice([8, 9, 10, 11, 40])]
        if rnd.random() < 0.2:
            w.insert(rnd.randint(0, len(w)), "rare")
        docs.append(rnd.choice([" ", "\n", ", "]).join(x.upper() if rnd.random() < 0.2 else x for x in w))
    rows = [(k, t, "x", 1) for k, t in enumerate(docs)]
    return rows + rows[20:24] + [(None, docs[20], "x", 1)], items


@pytest.mark.parametrize("seed,vocab,window,short,shard,block", [
    (1, 400, 10, True, 1 << 22, 1 << 20), (2, 3, 10, False, 3000, 1 << 20), (3, 2, 4, True, 500, 60), (4, 60, 10, False, 1, 40), (5, 5, 6, True, 1 << 22, 100),
])
def test_find_equals_brute_force(spark, seed, vocab, window, short, shard, block):
    docs, items = tables(seed, [f"w{k}" for k in range(vocab)], 70 if vocab > 3 else 30, short)
    table = spark.createDataFrame(docs, "doc_id long, text string, items string, n_words int").repartition(3)
    bench = spark.createDataFrame(items, "item_id string, text string")
    out = A.find(table, bench, window=window, shard=shard, block_words=block).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_hit, list(r.items), r.longest) for r in out), key=repr) == brute(docs, items, window)
    texts = {r[0]: words(r[1]) for r in docs}
    held = {}
    for name, text in items:
        held.setdefault(name or "", []).append(words(text))
    for r in out:
        assert sum(s.end - s.start for s in r.hits) == r.n_hit
        if r.longest and r.doc_id is not None:
            match = texts[r.doc_id][r.longest_at : r.longest_at + r.longest]
            assert any(w[r.longest_item_at : r.longest_item_at + r.longest] == match for w in held[r.longest_item])
    bad = {r.doc_id for r in out if r.n_hit}
    kept = A.clean(table, bench, window=window, shard=shard, block_words=block)
    assert kept.columns == table.columns
    assert sorted(map(repr, kept.collect())) == sorted(repr(r) for r in table.collect() if r.doc_id not in bad)


@pytest.mark.parametrize("seed", range(6))
def test_suffix_array_order(seed):
    rng = np.random.default_rng(seed)
    symbols = np.append(rng.integers(0, [2, 3, 5, 1000, 4, 2][seed], 400) * (rng.random(400) > [0.01, 0.1, 0.3, 0.05, 0, 0.02][seed]), 0)
    if seed == 4:
        symbols[100:200] = symbols[300:400] = symbols[0:100]
    order = A.suffix_array(symbols, 512)
    zero = np.flatnonzero(symbols == 0)
    text = lambda p: tuple(symbols[p : zero[np.searchsorted(zero, p)]])
    assert sorted(order) == list(np.flatnonzero(symbols))
    assert all(text(a) <= text(b) for a, b in zip(order, order[1:]))


def test_words_across_chunks(monkeypatch):
    texts = ["ab cd " * 50, "x" * 300, None, "", "Ab", "cd " + "é" * 40 + "z"]
    column = pa.array(texts)
    whole, ends = A.words_of(*A.texts_of(column))
    assert list(np.diff(np.concatenate([[0], ends]))) == [len(words(t)) for t in texts]
    monkeypatch.setattr(A, "HASHED", 16)
    assert np.array_equal(A.words_of(*A.texts_of(column))[0], whole)
    assert np.array_equal(A.words_of(*A.texts_of(column.slice(4)))[0], whole[-3:])
    assert whole[-3] == whole[0] and whole[-2] == whole[1]


def test_no_items_and_no_documents(spark):
    docs = spark.createDataFrame([(1, "a b c"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id string, text string")
    assert [tuple(r)[:3] for r in A.find(docs, none).orderBy("doc_id").collect()] == [(1, 3, 0), (2, 0, 0)]
    assert A.find(docs.limit(0), none).collect() == [] and A.clean(docs, none).count() == 2


def test_one_passage_in_every_document(spark):
    passage = " ".join(f"p{k}" for k in range(40))
    docs = spark.range(3000).selectExpr("id AS doc_id", f"concat('x', id, ' {passage} y') AS text")
    items = spark.createDataFrame([(f"i{k}", passage) for k in range(30)], "item_id string, text string")
    assert {(r.n_hit, len(r.items), r.longest, r.longest_at) for r in A.find(docs, items).collect()} == {(40, 30, 40, 1)}


def test_long_items_are_cut(spark, monkeypatch):
    text = " ".join(f"v{k % 700}" for k in range(A.ITEM_WORDS + 500))
    docs = spark.createDataFrame([(1, text), (2, text[: len(text) // 2])], "doc_id long, text string")
    out = A.find(docs, spark.createDataFrame([("a", text)], "item_id string, text string")).collect()
    assert all(r.n_hit == r.n_words and list(r.items) == ["a"] for r in out)
