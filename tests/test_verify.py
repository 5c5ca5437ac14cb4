"""Boundary rows of verification, each against its golden verdict."""

from datetime import datetime, timedelta, timezone

import pytest

from proofmark import schemas
from proofmark import values as v
from proofmark.operators import verify as V

T0 = datetime(2024, 1, 1, 10, 0, 0, tzinfo=timezone.utc)
EVENTS, CALLS, ENTITIES = "events", "calls", "entities"


def at(seconds):
    return T0 + timedelta(seconds=seconds)


def event(key, kind, s, offset=0):
    return (EVENTS, key, kind, None, kind, at(s), offset)


def calls(key, n, s, offset=0):
    return (CALLS, key, None, n, str(n), at(s), offset)


def entity(key, s, offset=0):
    return (ENTITIES, key, None, None, f"entity of {key}", at(s), offset)


MESSAGES = [
    event("b1", "RECEIVED", 1), event("b1", "FINISHED", 10), event("b1", "FINISHED", 20),
    event("b2", "FINISHED", 500),
    event("b3", "FAILURE", 10),
    event("b4", "FINISHED", 60),
    calls("b5", 1, 1), calls("b5", 2, 2),
    calls("b6", 1, 1), calls("b6", 2, 2),
    entity("b8", 5),
    entity("b9", 31),
    event("b10", "FINISHED", 119),
    event("b11", "FINISHED", 1),
    event("b14", "FINISHED", -1),
    event("b15", "FINISHED", 120),
]


def expectation(i, key, topic=EVENTS, presence=v.PRESENCE, kind=None, count=None, timeout=-1, reg=0):
    return (i, "r", topic, key, presence, kind, count, at(reg), timeout)


EXPECTATIONS = [
    expectation(1, "b1", kind="FINISHED", timeout=120_000),
    expectation(2, "b2", kind="FINISHED", timeout=120_000),
    expectation(3, "b3", kind="FINISHED", timeout=120_000),
    expectation(4, "b4", kind="FINISHED", timeout=30_000),
    expectation(5, "b5", CALLS, count=1),
    expectation(6, "b6", CALLS, count=3),
    expectation(7, "b7", ENTITIES, v.ABSENCE, timeout=30_000),
    expectation(8, "b8", ENTITIES, v.ABSENCE, timeout=30_000),
    expectation(9, "b9", ENTITIES, v.ABSENCE),
    expectation(10, "b10", kind="FINISHED", timeout=-1),
    expectation(11, "b11", kind="FINISHED", timeout=0),
    expectation(12, None, kind="FINISHED", timeout=5_000),
    expectation(14, "b14", kind="FINISHED", timeout=120_000),
    expectation(15, "b15", kind="FINISHED", timeout=120_000),
]

GOLDEN = {
    1: (True, 10, None, "ok"),
    2: (False, 120, None, "For key b2: Verification failed - Expected to see value but saw none"),
    3: (False, 120, "FAILURE",
        "For key b3: Verification failed!\nExpected 'b3' to have a FINISHED Processing Event, but saw none"),
    4: (False, 30, None, "For key b4: Verification failed - Expected to see value but saw none"),
    5: (True, 1, None, "ok"),
    6: (False, 120, "2",
        "For key b6: Verification failed!\n"
        "For key b6: Expected 3 attempts to save to the Archive, but found 2"),
    7: (True, 30, None, "ok"),
    8: (False, 5, None, "For key b8: Verification failed - Expected not to see value"),
    9: (True, 30, None, "ok"),
    10: (True, 119, None, "ok"),
    11: (False, 0, None, "For key b11: Verification failed - Expected to see value but saw none"),
    12: (True, 1, None, "ok"),
    14: (False, 120, None, "For key b14: Verification failed - Expected to see value but saw none"),
    15: (True, 120, None, "ok"),
}


@pytest.fixture(scope="module")
def tables(spark):
    return (
        spark.createDataFrame(MESSAGES, schemas.MESSAGES),
        spark.createDataFrame(EXPECTATIONS, schemas.EXPECTATIONS),
    )


def seconds(row):
    return (row.decided_at.astimezone(timezone.utc) - T0).total_seconds()


@pytest.mark.parametrize("slot_ms", [V.SLOT_MS, 1_000, 7_000])
def test_boundary_rows(tables, slot_ms):
    got = {
        r.expectation_id: (r.satisfied, seconds(r), r.last_value, r.message)
        for r in V.verify(*tables, slot_ms=slot_ms).collect()
    }
    assert got == GOLDEN


def test_keyless_absence_is_rejected(spark, tables):
    rows = EXPECTATIONS + [expectation(13, None, ENTITIES, v.ABSENCE)]
    all_rows = spark.createDataFrame(rows, schemas.EXPECTATIONS)
    ok, bad = V.split_expectations(all_rows)
    assert [r.expectation_id for r in bad.collect()] == [13]
    assert ok.count() == len(EXPECTATIONS)
    verdicts = V.verify(tables[0], all_rows)
    assert verdicts.count() == len(rows)
    assert verdicts.filter("expectation_id = 13").first().satisfied is False


def test_messages_outside_all_windows_go_before_the_lookup(spark, monkeypatch):
    """Only messages within the span of their key's windows are ordered, in both lookups."""
    messages = [entity("a", s) for s in (-50, -1, 0, 5, 20, 70, 90, 400)] + [entity("b", s) for s in (-9, 300)] + [entity("c", 3)]
    keys = [(1, "r", "a", at(0)), (2, "r", "a", at(60)), (3, "r", "b", at(0)), (4, "r", None, at(350))]
    keys = spark.createDataFrame(keys, "expectation_id long, run_id string, key string, registered_at timestamp")
    seen = []

    def nearest(points, facts, *args, **kw):
        seen.append(sorted((r["who"], r["at"] // 1_000_000 - int(at(0).timestamp())) for r in facts.select("who", "at").collect()))
        return lookup(points, facts, *args, **kw)

    lookup = V.nearest
    monkeypatch.setattr(V, "nearest", nearest)
    got = V.has_entity(spark.createDataFrame(messages, schemas.MESSAGES), keys, ENTITIES, 30_000).collect()
    assert {r.expectation_id: r.satisfied for r in got} == {1: True, 2: True, 3: False, 4: False}
    assert seen == [[("a", s) for s in (0, 5, 20, 70, 90)], []]
