import math
import random

import duckdb
import numpy as np

from proofmark.llm import pq_links as P
from proofmark.llm.queries import LINK_SQL

SCHEMA = "vec_id long, embedding array<float>, label int, links string"


def valid(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)


def brute(rows):
    parent = {i: i for i, *_ in rows}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    links = [0] * len(rows)
    for p, (i, v, l, _) in enumerate(rows):
        for q, (j, w, k, _) in enumerate(rows[:p]):
            if l is not None and l == k and valid(v) and valid(w) and len(v) == len(w):
                x, y = np.array(v, np.float32).astype(float), np.array(w, np.float32).astype(float)
                if x @ y / math.sqrt(x @ x) / math.sqrt(y @ y) >= 0.93:
                    links[p] += 1
                    links[q] += 1
                    a, b = sorted((root(i), root(j)))
                    parent[b] = a
    return sorted((i, n, root(i), root(i) == i) for (i, *_), n in zip(rows, links))


def corpus(n=260):
    rnd = random.Random(4)
    rng = np.random.default_rng(4)
    rows = []
    for i in range(n):
        if rows and rnd.random() < 0.6:
            v = np.array(rnd.choice(rows)[1]) * rnd.choice([1, 1, 3])
            v = v + rng.normal(0, rnd.choice([0, 0.02, 0.1, 0.3, 0.36]) * np.abs(v).max(), len(v))
        else:
            v = rng.normal(0, 1, 24)
        rows.append((i * 13 % 1009, [float(np.float32(x)) for x in v], rnd.choice([1, 1, 1, 2, 3]), "x"))
    rows += [(2000 + k, rows[5][1], rows[5][2], "x") for k in range(40)]  # copies
    rows += [(2100, None, 1, "x"), (2101, [0.0] * 24, 1, "x"), (2102, [1.0, None] * 12, 1, "x"), (2103, [float("nan")] * 24, 1, "x")]
    rows += [(2104, rows[5][1], None, "x"), (2105, [1.0, 2.0], 1, "x"), (2106, [2.0, 4.1], 1, "x"), (2107, [], 1, "x"), (2108, [float("inf")] + [1.0] * 23, 1, "x")]
    rows += [(2109, [1e30] * 24, 4, "x"), (2110, [2e30] * 24, 4, "x")]
    return rows


def test_links_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(P, "CELL", 12)
    monkeypatch.setattr(P, "BLOCK", 10)
    rows = corpus()
    out = sorted(tuple(r) for r in P.links(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect())
    assert out == brute(rows)
    assert any(r[1] > 40 for r in out) and any(0 < r[1] < 5 for r in out)


def test_sql_says_the_same(spark):
    rows = [r for r in corpus(90) if r[0] < 2100]
    con = duckdb.connect()
    con.execute("CREATE TABLE embeddings (vec_id BIGINT, embedding FLOAT[], label INTEGER)")
    con.executemany("INSERT INTO embeddings VALUES (?, ?, ?)", [r[:3] for r in rows])
    assert sorted(con.execute(LINK_SQL).fetchall()) == brute(rows)


def test_probes_reach_every_partner():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(600, 16))
    x = np.concatenate([x, x + rng.normal(0, 0.12, x.shape)])
    x /= np.sqrt((x**2).sum(1, keepdims=True))
    index, reach = P.Index(x[:300], 40), math.sqrt(2 - 2 * 0.93)
    home, codes, error = index.encode(x)
    probes = index.probes(x, home, reach)
    i, j = np.nonzero(x @ x.T >= 0.93)
    for a, b in zip(i, j):
        if home[a] <= home[b]:
            assert probes[a, home[b]]
            assert index.distances(x[a : a + 1], home[b], codes[b : b + 1])[0, 0] - error[b] <= reach + 1e-4
    assert probes.mean() < 0.5


def test_recall_of_the_probes():
    """Of random vectors, where cells are hardest to tell apart, at the least cosine itself."""
    rng = np.random.default_rng(2)
    x = rng.normal(size=(3000, 64))
    x /= np.sqrt((x**2).sum(1, keepdims=True))
    y = rng.normal(size=x.shape)
    y -= (x * y).sum(1, keepdims=True) * x
    y /= np.sqrt((y**2).sum(1, keepdims=True))
    y = 0.93 * x + math.sqrt(1 - 0.93**2) * y
    index, far = P.Index(x[:1000], 60), math.sqrt(2 - 2 * 0.93)
    home, other = P._nearest(x, index.centres), P._nearest(y, index.centres)
    a, b = (np.where((home <= other)[:, None], *p) for p in ((x, y), (y, x)))
    first, last = np.minimum(home, other), np.maximum(home, other)
    probes = index.probes(a, first, P.SPREAD * far / 8)
    assert (first != last).mean() > 0.2 and probes[np.arange(len(x)), last].mean() > 0.995


def test_repeated_ids_and_empty(spark):
    far = [0.0] * 23
    rows = [(1, [1.0, *far], 1, ""), (1, [*far, 1.0], 1, ""), (2, [1.0, *far], 1, ""), (3, [*far, 2.0], 1, ""), (None, [1.0, *far], 1, "")]
    out = sorted((tuple(r) for r in P.links(spark.createDataFrame(rows, SCHEMA)).collect()), key=repr)
    assert out == sorted([(1, 2, 1, True), (1, 1, 1, True), (2, 2, 1, False), (3, 1, 1, False), (None, 2, 1, False)], key=repr)
    assert P.links(spark.createDataFrame([], SCHEMA)).count() == 0
    assert [tuple(r) for r in P.links(spark.createDataFrame([(7, None, 1, "")], SCHEMA)).collect()] == [(7, 0, 7, True)]


def test_no_link_of_low_rank_vectors_is_lost(spark, monkeypatch):
    monkeypatch.setattr(P, "CELL", 12)
    rng = np.random.default_rng(6)
    low = rng.normal(size=(300, 3))
    low = np.concatenate([low, low + rng.normal(0, 0.25, low.shape)])
    x = (low @ rng.normal(size=(3, 256))).astype(np.float32)
    rows = [(i, v.tolist(), 1, "") for i, v in enumerate(x)]
    docs = spark.createDataFrame(rows, SCHEMA)
    expected = brute(rows)
    assert sorted(tuple(r) for r in P.links(docs).collect()) == expected
    fewer = P.links(docs, spread=P.SPREAD).collect()  # what the bound for random vectors loses here
    assert sum(r.n_links for r in fewer) < sum(r[1] for r in expected)
