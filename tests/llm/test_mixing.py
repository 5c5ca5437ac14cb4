import random

import duckdb

from proofmark.llm import mixing as M
from proofmark.llm.common import written
from proofmark.llm.queries import MIX_SQL

SCHEMA = "doc_id long, text string, source string, size string, n_chars long"


def corpus():
    rnd = random.Random(8)
    rows = []
    for i in range(500):
        source = rnd.choice(["hot"] * 6 + ["a", "b", "é", "😀", None, "tiny"])
        n = rnd.choice([0, 1, 5, 60, 700]) if source != "tiny" else 1
        rows.append((i, " ".join(f"w{rnd.randint(0, 99)}" for _ in range(n)) + rnd.choice(["", "\n"]), source, "clash", 3))
    return rows + [(900, None, "nulls", "c", 0), (901, None, "a", "c", 0), (902, "x " * 30_000, "long", "c", 1)]


def test_plan_equals_sql_for_any_block(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, SCHEMA)
    con = duckdb.connect()
    documents = docs.toPandas()  # noqa: F841
    expected = sorted(con.execute(MIX_SQL).fetchall())
    key = lambda r: (r[0], r[1])
    expected.sort(key=key)
    for block, columns in ((1024, 6), (7, 5)):  # slots depend on the block, what is taken does not
        out = M.plan(docs, block=block)
        assert sorted((tuple(r)[:columns] for r in out.collect()), key=key) == [r[:columns] for r in expected]
    size = sum(r[1] for r in expected)
    assert abs(sum(r[4] for r in expected) - 1.5 * size) <= 10
    assert all(r[4] <= 2 * r[1] for r in expected)
    got = {}
    for (i, s, of, target, taken, _), row in zip(expected, sorted(rows)):
        got.setdefault(row[2], [target, 0])[1] += taken
    assert all(abs(t - n) <= 0.5 for t, n in got.values())
    assert sorted((tuple(r) for r in M.plan(docs.repartition(5)).collect()), key=key) == expected  # reruns agree
    assert all((r[4] == 0) == (r[5] is None) for r in expected)


def test_schedule_keeps_to_the_targets(spark):
    targets = written(
        spark.createDataFrame([(0, 600_000, 0.0, 0.6, 1_000_000), (1, 300_000, 0.6, 0.9, 1_000_000), (2, 100_000, 0.9, 1.0, 1_000_000)],
                              "s int, need long, low double, high double, total long"), "targets")
    rows = sorted(M.schedule(targets, 100).collect(), key=lambda r: r.slot)
    slots = [(r.s, r["rank"]) for r in rows]
    assert len({r.slot for r in rows}) == 10_000
    for s in range(3):  # the ranks of a source follow the slots
        assert [r["rank"] for r in rows if r.s == s] == sorted(r["rank"] for r in rows if r.s == s)
    for share, s in ((0.6, 0), (0.3, 1), (0.1, 2)):  # every stretch of the schedule is near the targets
        upto = [0]
        for x, _ in slots:
            upto.append(upto[-1] + (x == s))
        for n in (10, 100, 1000):
            assert max(abs(upto[a + n] - upto[a] - share * n) for a in range(0, 9900 - n, 7)) < 4
    assert len(slots) == len(set(slots)) == 10_000
    assert {s: sum(x == s for x, _ in slots) for s in range(3)} == {0: 6000, 1: 3000, 2: 1000}


def test_mix_rows(spark):
    rows = corpus()
    rows += [rows[3], rows[3]]
    docs = spark.createDataFrame(rows, SCHEMA)
    taken = {}
    for r in M.plan(docs).collect():
        taken[r.doc_id] = taken.get(r.doc_id, 0) + r.taken
    out = M.mix(docs)
    assert out.columns == docs.columns and out.dtypes == docs.dtypes
    texts, got, cut = {r[0]: r[1] for r in rows}, {}, 0
    for r in out.collect():
        words = r.text.split()
        got[r.doc_id] = got.get(r.doc_id, 0) + len(words)
        assert words == texts[r.doc_id].split()[: len(words)]
        cut += r.text != texts[r.doc_id]
    assert got == {k: v for k, v in taken.items() if v} and cut <= 8


def test_empty(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert M.plan(docs).count() == 0 and M.mix(docs).count() == 0
    assert M.plan(spark.createDataFrame([(1, None, None, "", 0)], SCHEMA)).first().taken == 0
