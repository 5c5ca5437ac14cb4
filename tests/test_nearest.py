"""Ordered lookups against brute force, with hot keys, ties and many slots."""

import random

import pytest
from pyspark.sql import functions as F

from proofmark.operators import nearest as lookup
from proofmark.operators.nearest import following, nearest, running_count


def facts_and_points(seed):
    rnd = random.Random(seed)
    key = lambda: "hot" if rnd.random() < 0.4 else f"k{rnd.randrange(12)}"
    facts = [(key(), rnd.randrange(-50, 200), rnd.randrange(5)) for _ in range(300)]
    points = [(key(), rnd.randrange(-60, 220)) for _ in range(150)] + [("never", 3)]
    return facts, points


@pytest.mark.parametrize("width", [None, 1, 7, 1000])
def test_nearest_is_brute_force(spark, width):
    facts, points = facts_and_points(width or 0)
    f = spark.createDataFrame(facts, "key string, at long, x int").withColumn("measure", F.struct("at", "x"))
    p = spark.createDataFrame(points, "key string, at long")
    got = {
        (r.key, r.at): (r.next and tuple(r.next), r.last and tuple(r.last))
        for r in nearest(p, f, ["key"], width).collect()
    }
    want = {
        (k, t): (
            min(((a, x) for kk, a, x in facts if kk == k and a >= t), default=None),
            max(((a, x) for kk, a, x in facts if kk == k and a <= t), default=None),
        )
        for k, t in points
    }
    assert got == want


@pytest.mark.parametrize("hot", [1, 60, 1 << 18])
def test_keys_in_slots_or_whole(spark, monkeypatch, hot):
    """All keys hot, only the one with most times, or none: the same answers."""
    monkeypatch.setattr(lookup, "HOT", hot)
    monkeypatch.setattr(lookup, "SAMPLE", 1)
    test_nearest_is_brute_force(spark, 7)
    facts, points = facts_and_points(7)
    line = spark.createDataFrame([(k, a) for k, a, *_ in facts + points], "key string, at long")
    found = {r.key for r in lookup._with_hot(line, ["key"]).filter("hot").select("key").distinct().collect()}
    assert found == {1: {r[0] for r in facts + points}, 60: {"hot"}, 1 << 18: set()}[hot]


@pytest.mark.parametrize("width", [None, 5, 64])
def test_running_extreme_of_another_measure(spark, width):
    facts, points = facts_and_points(9)
    f = spark.createDataFrame(facts, "key string, at long, x int").withColumnRenamed("x", "measure")
    p = spark.createDataFrame(points, "key string, at long")
    got = {(r.key, r.at): r.last for r in nearest(p, f, ["key"], width, forward=False).collect()}
    assert got == {
        (k, t): max((x for kk, a, x in facts if kk == k and a <= t), default=None) for k, t in points
    }


@pytest.mark.parametrize("width", [None, 10])
def test_running_count(spark, width):
    facts, _ = facts_and_points(3)
    f = spark.createDataFrame([(k, a) for k, a, _ in facts], "key string, at long")
    got = {(r.key, r.at): (r.before, r["count"]) for r in running_count(f, ["key"], width).collect()}
    assert got == {
        (k, a): (
            sum(kk == k and b < a for kk, b, _ in facts),
            sum(kk == k and b <= a for kk, b, _ in facts),
        )
        for k, a, _ in facts
    }


@pytest.mark.parametrize("hot", [1, 60, 1 << 18])
@pytest.mark.parametrize("width", [1, 7, 1000])
def test_following_is_brute_force(spark, monkeypatch, hot, width):
    """Every key in slots, the hot one only, or none: the next time of a key is the same."""
    monkeypatch.setattr(lookup, "SAMPLE", 1)
    monkeypatch.setattr(lookup, "HOT", hot)
    facts, _ = facts_and_points(hot + width)
    times = sorted({(k, t) for k, t, _ in facts})
    rows = spark.createDataFrame([(k, t, f"{k}{t}") for k, t in times], "key string, at long, name string")
    got = {(r.key, r.at): (r.name, r.next) for r in following(rows, ["key"], width).collect()}
    assert got == {(k, t): (f"{k}{t}", min((a for kk, a in times if kk == k and a > t), default=None)) for k, t in times}
