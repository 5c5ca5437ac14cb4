import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from proofmark.llm import packing as P
from proofmark.llm import tokens

SCHEMA = "doc_id long, text string, source string, start string"


def corpus():
    rnd = random.Random(6)
    rows = []
    for i in range(300):
        source = rnd.choice(["hot"] * 8 + ["a", "b", None])
        words = rnd.choices(["the", "Word's", "naïve", "\n", "<|endoftext|>", "x1", "  ", "日本"], k=rnd.choice([0, 3, 40, 400]))
        rows.append((i, " ".join(words), source, "clash"))
    return rows + [(900, None, "a", ""), (901, "long text " * 9000, "one", ""), (905, "again", "hot", ""), (905, "again", "hot", "")]


def test_pieces_hold_every_id_once(spark):
    rows = corpus()
    coder = Tokenizer.from_file(tokens.path("byte_bpe_50k.json"))
    docs = spark.createDataFrame(rows, SCHEMA).repartition(7)
    out = P.pack(docs, with_ids=True).collect()
    total = sum(len(coder.encode(t or "", add_special_tokens=False).ids) + 1 for _, t, _, _ in rows)
    assert sum(r.length for r in out) == total
    by_doc, by_sequence = {}, {}
    for r in out:
        assert r.length == len(r.ids) > 0 and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for i, text, _, _ in rows:
        want = coder.encode(text or "", add_special_tokens=False).ids + [0]
        got = sorted(by_doc[i], key=lambda r: r.start)
        if i == 905:
            continue  # two rows share this id
        assert [x for r in got for x in r.ids] == want and all(r.doc_tokens == len(want) for r in got)
        assert [r.start for r in got] == [sum(x.length for x in got[:k]) for k in range(len(got))]
    assert len(by_doc[905]) >= 2
    assert sorted(by_sequence) == list(range(-(-total // 1024)))
    source = {r[0]: r[2] for r in rows}
    share = {}
    for r in out:
        share[source[r.doc_id]] = share.get(source[r.doc_id], 0) + r.length / total
    for k, parts in by_sequence.items():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at == (1024 if k < len(by_sequence) - 1 else (total - 1) % 1024 + 1)
        assert {r.padded_length for r in parts} == {at if at & (at - 1) == 0 else 1024}
        if at == 1024:  # every window has the target proportions
            for s, p in share.items():
                assert abs(sum(r.length for r in parts if source[r.doc_id] == s) - 1024 * p) < 5


def test_served_is_a_prefix_of_the_merged_order():
    rng = np.random.default_rng(1)
    for totals in ([5, 900, 1, 77], [1], [3] * 9, rng.integers(1, 500, 64).tolist()):
        totals = np.array(totals)
        order = sorted(((t + 0.5) / n, q) for q, n in enumerate(totals.tolist()) for t in range(n))
        k = np.arange(-(-totals.sum() // 16) + 1)
        got = P.served(k, totals, 16)
        for i in k:
            taken = [q for _, q in order[: i * 16]]
            assert got[i].tolist() == [taken.count(q) for q in range(len(totals))]


def test_long_document_goes_on(monkeypatch):
    monkeypatch.setattr(P, "CHUNK", 10)
    totals = np.array([5000, 40, 1])
    start, n, queue = np.array([0, 3000, 0, 0]), np.array([3000, 2000, 40, 1]), np.array([0, 0, 1, 2])
    got = sorted((int(k), int(o), int(d), int(s), int(m)) for piece in P.pieces(queue, start, n, totals, 16) for d, k, s, m, o in zip(*piece))
    assert sum(x[4] for x in got) == 5041 and len({x[:2] for x in got}) == len(got)
    for k in range(316):
        parts = [x for x in got if x[0] == k]
        assert [x[1] for x in parts] == [sum(y[4] for y in parts[:i]) for i in range(len(parts))]


def test_more_sources_than_queues(spark, monkeypatch):
    monkeypatch.setattr(P, "QUEUES", 3)
    docs = spark.createDataFrame([(i, "some words here " * (i % 9), f"s{i % 11}") for i in range(200)], "doc_id long, text string, source string")
    out = P.pack(docs).collect()
    ends = {}
    for r in out:
        ends[r.doc_id] = ends.get(r.doc_id, 0) + r.length
    assert all(r.doc_tokens == ends[r.doc_id] for r in out) and len(ends) == 200
    assert len({(r.sequence_id, r.offset) for r in out}) == len(out)


def test_empty(spark):
    assert P.pack(spark.createDataFrame([], SCHEMA)).count() == 0


def test_tail_parts_are_the_merged_order():
    rng = np.random.default_rng(2)
    for tail in ([3], [1] * 40, [7] * 9 + [2] * 5, sorted(rng.integers(1, 300, 50).tolist(), reverse=True)):
        tail = np.array(tail)
        phase = np.arange(1, len(tail) + 1) * P.GOLDEN % 1
        order = sorted(((t + phase[s]) / n, s, t) for s, n in enumerate(tail.tolist()) for t in range(n))
        taken = np.unique(np.r_[0, rng.integers(0, len(order), 20), len(order)])
        for a, b in ((0, len(taken)), (len(taken) // 2, len(taken)), (0, len(taken) // 2 + 1)):
            got, at = set(), {}
            for k, s, t, length, offset in zip(*P.tail_parts(taken[a:b], tail)):
                assert offset == at.get(k, 0)
                at[k] = offset + length
                got |= {(k, s, t + i) for i in range(length)}
            cut = taken[a:b]
            assert got == {(j, s, t) for j in range(len(cut) - 1) for _, s, t in order[cut[j] : cut[j + 1]]}


def test_every_window_has_the_proportions_of_more_sources_than_queues(spark, monkeypatch):
    monkeypatch.setattr(P, "QUEUES", 4)
    rnd = random.Random(9)
    rows = []
    for i in range(500):
        source = rnd.choice(["hot"] * 8 + ["a", "b"] + [f"s{k}" for k in range(12)] + [None, f"rare{i % 40}"])
        rows.append((i, " ".join(rnd.choices(["the", "Word's", "naïve", "日本"], k=rnd.choice([0, 3, 40, 700]))), source, "clash"))
    coder = Tokenizer.from_file(tokens.path("byte_bpe_50k.json"))
    want = {i: coder.encode(t, add_special_tokens=False).ids + [0] for i, t, _, _ in rows}
    out = P.pack(spark.createDataFrame(rows, SCHEMA).repartition(7), with_ids=True).collect()
    source, total, sizes = {r[0]: r[2] for r in rows}, sum(map(len, want.values())), {}
    by_doc, by_sequence = {}, {}
    for r in out:
        assert r.length == len(r.ids) > 0 and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
        sizes[source[r.doc_id]] = sizes.get(source[r.doc_id], 0) + r.length
    for i, ids in want.items():
        got = sorted(by_doc[i], key=lambda r: r.start)
        assert [x for r in got for x in r.ids] == ids and all(r.doc_tokens == len(ids) for r in got)
        assert [r.start for r in got] == [sum(x.length for x in got[:k]) for k in range(len(got))]
    assert sorted(by_sequence) == list(range(-(-total // 1024))) and len(by_sequence) > 50
    for k, parts in by_sequence.items():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at == (1024 if k < len(by_sequence) - 1 else (total - 1) % 1024 + 1)
        for s, n in sizes.items():
            assert abs(sum(r.length for r in parts if source[r.doc_id] == s) - at * n / total) < 6


@pytest.mark.parametrize("listed,shared", [(20, 7), (5, 3)])
def test_very_many_sources(spark, monkeypatch, listed, shared):
    """Sources beyond the listed ones share queues; nothing is lost, windows stay full, large sources keep their parts."""
    monkeypatch.setattr(P, "QUEUES", 4)
    monkeypatch.setattr(P, "LISTED", listed)
    monkeypatch.setattr(P, "SHARED", shared)
    rnd = random.Random(11)
    rows = [(i, " ".join(rnd.choices(["the", "Word's", "naïve"], k=rnd.choice([0, 3, 40, 300]))), rnd.choice(["hot", "a", "b", None, f"s{i}", f"s{i % 90}"]), "x") for i in range(900)]
    coder = Tokenizer.from_file(tokens.path("byte_bpe_50k.json"))
    want = {i: coder.encode(t, add_special_tokens=False).ids + [0] for i, t, _, _ in rows}
    out = P.pack(spark.createDataFrame(rows, SCHEMA).repartition(7), with_ids=True).collect()
    source, total, sizes = {r[0]: r[2] for r in rows}, sum(map(len, want.values())), {}
    by_doc, by_sequence = {}, {}
    for r in out:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
        sizes[source[r.doc_id]] = sizes.get(source[r.doc_id], 0) + r.length
    for i, ids in want.items():
        assert [x for r in sorted(by_doc[i], key=lambda r: r.start) for x in r.ids] == ids
    assert sorted(by_sequence) == list(range(-(-total // 1024))) and len(sizes) > 200
    for k, parts in by_sequence.items():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at == (1024 if k < len(by_sequence) - 1 else (total - 1) % 1024 + 1)
        for s in ("hot", "a", "b", None):
            assert abs(sum(r.length for r in parts if source[r.doc_id] == s) - at * sizes[s] / total) < 6


def test_a_hundred_thousand_sources(spark):
    docs = spark.range(100_000).selectExpr("id AS doc_id", "'two words' AS text", "concat('host', id) AS source")
    row = P.pack(docs).selectExpr("sum(length) AS ids", "count(DISTINCT doc_id) AS docs", "max(sequence_id) AS last", "count(DISTINCT sequence_id, offset) AS places", "count(*) AS n").first()
    assert row.docs == 100_000 and row.n == row.places and row.last == (row.ids - 1) // 1024
