"""What streams keep, against the batch forms, over several batches with late and repeated rows."""

import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from proofmark import schemas
from proofmark import values as v
from proofmark.operators import changes as U
from proofmark.operators import checks as Q
from proofmark.operators import history as H
from proofmark.operators import messages as M
from proofmark.operators import metrics as A
from proofmark.operators import shapes
from proofmark.operators import verify as V
from proofmark.sources import sinks
from proofmark.streaming import gauges, kept, latches, verification
from proofmark.streaming.snapshots import Snapshots
from tests.test_verify import EXPECTATIONS, MESSAGES

T0 = datetime(2024, 5, 1, tzinfo=timezone.utc)


def at(s):
    return T0 + timedelta(seconds=s)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def fed(store, spark, empty, schema, data, size):
    """The store after ``data`` in parts, each of them twice."""
    store.start(empty)
    for n in range(0, len(data), size):
        batch = spark.createDataFrame(data[n : n + size], schema)
        store.step(batch, n // size)
        store.step(batch, n // size)
    return store


def test_late_changes_split_intervals(spark, tmp_path):
    rnd = random.Random(2)
    history = [(rnd.choice(["a", "a", "b", "c"]), rnd.choice(["X", "Y", "Z"]), at(rnd.randint(0, 60)), n) for n in range(80)]
    batch = spark.createDataFrame(history, "key string, archive_status string, ts timestamp, offset long")
    whole = H.intervals(batch, 7_000)
    empty = spark.createDataFrame([], H.INTERVAL)
    changes = batch.withColumnRenamed("ts", "at").schema
    store = Snapshots(f"{tmp_path}/s", "key", empty.schema, changes, H.fold_intervals, buckets=4, ordered=False)
    fed(store, spark, empty, changes, history, 25)
    assert rows(store.rows(spark)) == rows(whole)
    moments = spark.createDataFrame([(k, at(s), s) for k in "abcd" for s in range(-2, 70, 3)], "key string, at timestamp, n int")
    for r in H.status_at(moments, whole, 7_000).collect():
        before = [(t, n, s) for k, s, t, n in history if k == r.key and t <= at(r.n)]
        assert r.archive_status == (max(before)[2] if before else None)
    for key in "abc":
        own = sorted((r.valid_from, r.valid_to) for r in whole.collect() if r.key == key)
        assert all(a[1] == b[0] for a, b in zip(own, own[1:])) and own[-1][1] is None


def test_intervals_are_not_joined_with_themselves(spark):
    """A start gets its end where it lies: a shuffle by time, one by slot, and those of the few hot keys."""
    changes = spark.range(200).selectExpr("cast(id % 7 as string) AS key", "'X' AS archive_status", "timestamp_seconds(id * 13) AS ts", "id AS offset")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = H.intervals(changes)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("Exchange hashpartitioning") <= 10 and "ReusedExchange" in plan and "Union" not in plan


def test_series_of_polls(spark):
    """A series answers what its moments answer one by one, also for keys that repeat, lack changes or are null."""
    rnd = random.Random(8)
    history = [(rnd.choice(["a", "a", "b"]), rnd.choice(["X", "Y"]), at(rnd.randint(0, 60)), n) for n in range(40)]
    known = H.intervals(spark.createDataFrame(history, "key string, archive_status string, ts timestamp, offset long"), 7_000)
    asked = [("a", at(-5)), ("a", at(7)), ("a", at(7)), ("b", at(30)), ("c", at(1)), (None, at(3)), ("b", None)]
    keys = spark.createDataFrame(asked, "key string, registered_at timestamp")
    single = H.status_at(H.polls(keys, 9, 4_000), known, 7_000).select("key", "poll", "archive_status")
    series = H.polls(keys, 9, 4_000, series=True)
    assert series.count() == len(asked)
    runs = H.status_at(series, known)
    listed = runs.select("key", F.explode(F.sequence("first_poll", "last_poll")).alias("poll"), "archive_status")
    assert sorted(map(repr, listed.collect())) == sorted(map(repr, single.collect())) and listed.count() == 9 * len(asked)


def test_running_counts(spark, tmp_path):
    rnd = random.Random(4)
    messages = [(rnd.choice(["a", "a", "a", "b"]), at(rnd.randint(0, 50))) for _ in range(120)]
    df = spark.createDataFrame(messages, "kind string, ts timestamp")
    store = kept.running_counts(f"{tmp_path}/s", ["kind"], ["string"], 5_000, buckets=8)
    changes = kept.slotted(df, ["kind"], 5_000)
    data = [tuple(r) for r in changes.collect()]
    fed(store, spark, spark.createDataFrame([], store.schema), changes.schema, data, 50)
    keys = spark.createDataFrame([(n, rnd.choice("abc"), rnd.randint(0, 90), at(rnd.randint(-5, 60))) for n in range(60)],
                                 "expectation_id long, kind string, expected_count int, registered_at timestamp")
    assert rows(kept.has_count(store, keys, ["kind"], 10_000)) == rows(V.has_count(df, keys, ["kind"], 10_000))


def test_lifecycles(spark, tmp_path):
    rnd = random.Random(6)
    events = [(f"k{rnd.randrange(8)}", rnd.choice(v.LIFECYCLE), at(rnd.randint(0, 40))) for _ in range(40)]
    df = spark.createDataFrame(events, "key string, event_type string, ts timestamp")
    store = kept.lifecycles(f"{tmp_path}/s", buckets=4)
    fed(store, spark, spark.createDataFrame([], store.schema), store.changes, events, 15)
    assert rows(kept.lifecycle_violations(spark, store)) == rows(U.lifecycle_violations(df)) != []
    last = store.last(spark)
    assert set(map(repr, rows(kept.lifecycle_violations(spark, store, batch=last)))) <= set(map(repr, rows(U.lifecycle_violations(df))))


def test_conflicts_within_a_bound(spark, tmp_path):
    rnd = random.Random(7)
    data = sorted((rnd.randrange(12), at(n), n) for n in range(60))
    data.sort(key=lambda r: (r[1] + timedelta(seconds=rnd.uniform(0, 9))))
    schema = "submission_id long, at timestamp, n int"
    store = kept.first_places(f"{tmp_path}/s", [("n", "int")], delay_ms=10_000, buckets=4)
    fed(store, spark, spark.createDataFrame([], store.schema), store.schema, data, 20).finish(spark)
    whole = Q.conflicts(spark.createDataFrame(data, schema), ["at", "n"])
    assert rows(store.rejected(spark).select("submission_id", "n")) == rows(whole.select("submission_id", "n"))
    short = kept.first_places(f"{tmp_path}/short", [("n", "int")], keep_ms=1_000, buckets=1)
    short.start(spark.createDataFrame([], short.schema))
    for k, s in enumerate([0, 1, 100, 101]):
        short.step(spark.createDataFrame([(5, at(s), k), (6 + k, at(s), k)], short.schema), k)
    short.finish(spark)
    assert 5 in {r.submission_id for r in short.rejected(spark).collect()} and short.rows(spark).count() < 5


def test_days_add_up(spark, tmp_path):
    rnd = random.Random(9)
    log = [(rnd.choice(["x", "y", None]), 1_700_000_000_000 + rnd.randrange(5) * 86_400_000, rnd.choice([5, 7, 900, None])) for _ in range(200)]
    df = spark.createDataFrame(log, "who string, started_ms long, took long").selectExpr("who", "started_ms", "started_ms + took AS finished_ms")
    path = f"{tmp_path}/h"
    for day in range(5):  # a day at a time, one of them twice
        part = df.filter(f"started_ms = {1_700_000_000_000 + day * 86_400_000}")
        for _ in range(1 + (day == 2)):
            kept.add_upload_days(part, "who", path)
    days = sorted(r.day for r in kept.days(spark, path).select("day").distinct().collect())
    assert rows(A.summary_of_counts(kept.days(spark, path), "who")) == rows(A.upload_summary(df, "who")) and len(days) == 5
    one = kept.days(spark, path, str(days[1]), str(days[1]))
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan  # other days are not read
    assert one.select("day").distinct().count() == 1


def test_drift(spark):
    values = ['{"id":"1","n":5,"o":{"x":1}}', '{"id":2,"n":null,"extra":[1]}', '{"o":{"x":"a","y":true},"n":1.5}', "[1]", "no", None, '{"id":"3","n":7,"o":7}']
    raw = spark.createDataFrame([(k, x) for k, x in enumerate(values)], "k int, value string")
    expected = {"id": "string", "n": "long", "o.x": "long"}
    df = shapes.parse_variant(raw)
    good, bad = M.split_quarantine(df)
    assert sorted(r.value for r in bad.collect()) == ["[1]", "no"]
    typed = {r.k: (r.id, r.n, r.o_x) for r in shapes.typed(good, expected).collect()}
    assert typed == {0: ("1", 5, 1), 1: (None, None, None), 2: (None, None, None), 5: (None, None, None), 6: ("3", 7, None)}
    told = {(r.path, r.change, r.found): r.n for r in shapes.drift(df, expected).collect()}
    assert told == {
        ("extra", "added", "ARRAY"): 1, ("o", "added", "OBJECT"): 2, ("o", "added", "BIGINT"): 1, ("o.y", "added", "BOOLEAN"): 1,
        ("id", "retyped", "BIGINT"): 1, ("n", "retyped", "VOID"): 1, ("n", "retyped", "DOUBLE"): 1, ("o.x", "retyped", "STRING"): 1,
        ("id", "missing", None): 1, ("o.x", "missing", None): 2,
    }


def test_published_processing_events(spark, tmp_path):
    events = spark.createDataFrame([("k1", v.FINISHED), ("k2", v.FAILURE)], "key string, event_type string")
    ready = sinks.write_processing_events(events, sinks.Sink(path=f"{tmp_path}/out"))
    stored = spark.read.parquet(f"{tmp_path}/out")
    assert rows(stored.selectExpr("key", "CAST(value AS STRING)")) == [("k1", '{"type":"%s"}' % v.FINISHED), ("k2", '{"type":"%s"}' % v.FAILURE)]
    ids = [r.headers[-1] for r in stored.collect()]
    assert all(h.key == sinks.MESSAGE_ID for h in ids) and len({bytes(h.value) for h in ids}) == 2
    assert sorted(bytes(h.value) for h in ids) == sorted(bytes(r.headers[-1].value) for r in ready.collect())
    assert sinks.write_processing_events(events, sinks.Sink(path=f"{tmp_path}/dry"), dry_run=True).count() == 2
    assert not (tmp_path / "dry").exists()


def streams(spark, tmp_path, messages, expectations, parts):
    """Both tables in files of their own, one of each a batch."""
    order = sorted(range(len(messages)), key=lambda k: messages[k][5])
    for n in range(parts):
        part = [messages[k] for k in order[n * len(order) // parts : (n + 1) * len(order) // parts]]
        spark.createDataFrame(part, schemas.MESSAGES).coalesce(1).write.mode("append").parquet(f"{tmp_path}/m")
        own = [e for e in expectations if n == min(parts - 1, sum(e[7] > messages[order[(i + 1) * len(order) // parts - 1]][5] for i in range(parts)))]
        spark.createDataFrame(own, schemas.EXPECTATIONS).coalesce(1).write.mode("append").parquet(f"{tmp_path}/e")
    read = lambda p, s: spark.readStream.schema(s).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/{p}")
    return read("m", schemas.MESSAGES), read("e", schemas.EXPECTATIONS)


def verdicts(df):
    return rows(df.select("expectation_id", "satisfied", "decided_at", "last_value", "message"))


def test_expectations_as_a_stream(spark, tmp_path):
    m, e = streams(spark, tmp_path, MESSAGES, EXPECTATIONS, 4)
    store = f"{tmp_path}/store"
    verification.start(m, e, store, delay_ms=3_600_000).awaitTermination()
    batch = V.verify(spark.createDataFrame(MESSAGES, schemas.MESSAGES), spark.createDataFrame(EXPECTATIONS, schemas.EXPECTATIONS))
    assert verdicts(verification.close(spark, store)) == verdicts(batch)


def test_a_step_reads_its_batch_and_the_open_rows_only(spark, tmp_path):
    """Steps go on alike after all that earlier batches asked and decided is gone."""
    day = 86_400
    messages = [("t", "k", "A", None, str(n), at(n * day), n) for n in range(8)]
    expectations = [(n, "r", "t", "k" if n % 2 else "none", "PRESENCE", "A", None, at(n * day - 10), 60_000) for n in range(8)]
    m, e = streams(spark, tmp_path, messages, expectations, 8)
    store = f"{tmp_path}/store"
    steps = []

    def forget(batch, batch_id):
        for path in [f"asked/batch={batch_id - 1}", f"state/batch={batch_id - 2}/done=true"]:
            verification._delete(spark, f"{store}/{path}")
        steps.append(batch_id)

    other = spark.readStream.schema(schemas.MESSAGES).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/m")
    decide = verification._decide

    def after(s, batch_id, *more):
        decide(s, batch_id, *more)
        forget(None, batch_id)

    verification._decide = after
    try:
        verification.start(m, e, store).awaitTermination()
    finally:
        verification._decide = decide
    assert steps == list(range(8)) and other.isStreaming
    left = verification._state(spark, store, "*", True)
    assert {r.expectation_id for r in left.collect()} >= {5}
    failed = verification.first_failures(spark, store).collect()
    assert [(r.run_id, r.expectation_id) for r in failed] == [("r", 0)]


@pytest.mark.parametrize("runs", [1, 2])
def test_latches(spark, tmp_path, runs):
    keyed = [x for x in EXPECTATIONS if x[3] is not None]
    m, e = streams(spark, tmp_path, MESSAGES, keyed, 4)
    store = f"{tmp_path}/store"
    found = latches.latched(m, e, "1 hour")
    for _ in range(runs):  # the second run takes up the state of the first
        last = latches.start(found, store)
        last.awaitTermination()
    done = latches.verdicts(spark, store)
    batch = V.verify(spark.createDataFrame(MESSAGES, schemas.MESSAGES), spark.createDataFrame(keyed, schemas.EXPECTATIONS))
    decided = {r.expectation_id for r in done.collect()}
    assert verdicts(done) == verdicts(batch.filter(batch.expectation_id.isin(*decided))) if decided else True
    assert done.count() == len(decided)


def test_latches_lie_in_blocks(spark, tmp_path):
    """A key's messages and open expectations are few rows of state, with one timer, and survive from step to step."""
    messages = [("t", f"k{n % 2}", "A", None, str(n), at(n), n) for n in range(90)]
    expectations = [(n, "r", "t", f"k{n % 2}", "PRESENCE", "B", None, at(n), 3_600_000 + n) for n in range(90)]
    m, e = streams(spark, tmp_path, messages, expectations + expectations[-3:], 3)  # a repeated id is one latch
    ran = latches.start(latches.latched(m, e, "10 minutes"), f"{tmp_path}/store")
    ran.awaitTermination()
    assert latches.state_size(ran)[0]["rows"] <= 2 * 4
    late = [("t", "k0", "B", None, "b", at(100), 100), ("t", "k1", "A", None, "z", at(7300), 101)]
    spark.createDataFrame(late, schemas.MESSAGES).coalesce(1).write.mode("append").parquet(f"{tmp_path}/m")
    latches.start(latches.latched(m, e, "10 minutes"), f"{tmp_path}/store").awaitTermination()
    done, all_messages = latches.verdicts(spark, f"{tmp_path}/store"), spark.createDataFrame(messages + late, schemas.MESSAGES)
    batch = V.verify(all_messages, spark.createDataFrame(expectations, schemas.EXPECTATIONS))
    assert verdicts(done) == verdicts(batch)


def test_latches_over_days_and_first_failures(spark, tmp_path):
    """Everything but the last day is decided; the failures of a run come once, the first of them."""
    day, rnd = 86_400, random.Random(1)
    messages = [("t", f"k{rnd.randrange(4)}", rnd.choice("AB"), rnd.choice([None, 1, 2]), str(n), at(n * day // 6 + rnd.randint(0, 9000)), n) for n in range(60)]
    expectations = [
        (n, f"r{n % 3}", "t", f"k{rnd.randrange(5)}", rnd.choice(["PRESENCE", "PRESENCE", "ABSENCE"]), rnd.choice([None, "A", "B"]), rnd.choice([None, None, 1]),
         at(rnd.randint(0, 8 * day)), rnd.choice([1, 10, 40]) * 3_600_000)
        for n in range(60)
    ]
    m, e = streams(spark, tmp_path, messages, expectations, 5)
    store = f"{tmp_path}/store"
    ran = latches.start(latches.latched(m, e, "2 days"), store)
    ran.awaitTermination()
    done = latches.verdicts(spark, store)
    batch = V.verify(spark.createDataFrame(messages, schemas.MESSAGES), spark.createDataFrame(expectations, schemas.EXPECTATIONS))
    decided = {r.expectation_id for r in done.collect()}
    assert len(decided) > 30 and verdicts(done) == verdicts(batch.filter(batch.expectation_id.isin(*decided)))
    assert latches.state_size(ran)[0]["rows"] >= 0
    m, e = streams(spark, tmp_path / "again", messages, expectations, 5)
    store = f"{tmp_path}/first"
    latches.start(latches.first_failures(latches.latched(m, e, "2 days")), store).awaitTermination()
    first = spark.read.parquet(f"{store}/rows").collect()
    failed = [r for r in batch.collect() if not r.satisfied and r.expectation_id in decided]
    want = {run: min((r.decided_at, r.expectation_id) for r in failed if r.run_id == run) for run in {r.run_id for r in failed}}
    assert {r.run_id: (r.decided_at, r.expectation_id) for r in first} == want and len(first) == len(want)


def test_a_batch_heard_twice_counts_once(spark, tmp_path):
    listener = gauges.GaugeListener(spark, f"{tmp_path}/g")
    for _ in range(2):
        listener.write([("rows", "n", 5.0)], "2024-01-01T00:00:00Z", "stream", 0)
    listener.write([("rows", "n", 7.0)], "2024-01-01T00:00:01Z", "stream", 1)
    assert sorted(r.value for r in gauges.gauges(spark, f"{tmp_path}/g").collect()) == [5.0, 7.0]
