"""Golden tables of the operators that the driver's tables cannot pin down alone."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from proofmark import schemas
from proofmark import values as v
from proofmark.functions import columns as C
from proofmark.operators import changes as U
from proofmark.operators import checks as Q
from proofmark.operators import lookups as J
from proofmark.operators import messages as M
from proofmark.operators import metrics as A
from proofmark.operators import notifications as N
from proofmark.operators import verify as V
from proofmark.operators import workload as G
from proofmark.operators.reconcile import classify_outcome, reconcile

T0 = datetime(2024, 1, 1, 10, 0, 0)


def at(s):
    return T0 + timedelta(seconds=s)


def scenario(key, event, entity, calls, status):
    out = [("events", key, event, None, event, at(10), 0)]
    out += [("entities", key, None, None, "title", at(9), 0)] if entity else []
    out += [("calls", key, None, n, str(n), at(n), n) for n in range(1, calls + 1)]
    out += [("status", key, None, None, s, at(11 + i), i) for i, s in enumerate(["IkkeSatt", status])]
    return out


def test_outcomes_of_the_scenarios(spark):
    """The nine end states: one file, large file, archive down, conflict, found archived, found after a timeout, poison
    row first, two failures first, three wrong answers first; and two that fit none."""
    rows = (
        scenario("one", "FINISHED", True, 1, v.ARCHIVED)
        + scenario("large", "FINISHED", True, 1, v.ARCHIVED)
        + scenario("down", "FAILURE", False, 6, v.ARCHIVE_FAILED)
        + scenario("conflict", "FINISHED", True, 1, v.ARCHIVED)
        + scenario("found", "FINISHED", True, 0, v.ARCHIVE_NOT_SET)
        + scenario("timeout", "FINISHED", False, 1, v.ARCHIVE_NOT_SET)
        + scenario("poison", "FINISHED", True, 1, v.ARCHIVED)
        + scenario("404", "FINISHED", True, 3, v.ARCHIVED)
        + scenario("wrong", "FINISHED", True, 4, v.ARCHIVED)
        + scenario("odd", "FINISHED", False, 1, v.ARCHIVED)
        + [("events", "silent", "STARTED", None, "STARTED", at(1), 0)]
    )
    out = classify_outcome(reconcile(spark.createDataFrame(rows, schemas.MESSAGES)))
    got = {r.key: (r.outcome, r.calls, r.archive_status) for r in out.collect()}
    assert got == {
        "one": ("ok", 1, v.ARCHIVED),
        "large": ("ok", 1, v.ARCHIVED),
        "down": ("failed", 6, v.ARCHIVE_FAILED),
        "conflict": ("ok", 1, v.ARCHIVED),
        "found": ("already_archived", None, v.ARCHIVE_NOT_SET),
        "timeout": ("already_archived", 1, v.ARCHIVE_NOT_SET),
        "poison": ("ok", 1, v.ARCHIVED),
        "404": ("retried", 3, v.ARCHIVED),
        "wrong": ("retried", 4, v.ARCHIVED),
        "odd": ("inconsistent", 1, v.ARCHIVED),
        "silent": ("inconsistent", None, v.ARCHIVE_NOT_SET),
    }


def test_call_count_through_and_final(spark):
    calls = [("calls", "k", None, n, str(n), at(n), n) for n in (1, 2)]
    keys = spark.createDataFrame([(1, "r", "k", at(0))], "expectation_id long, run_id string, key string, registered_at timestamp")
    m = spark.createDataFrame(calls, schemas.MESSAGES)
    assert V.has_call_count(m, keys, "calls", 1).first().satisfied
    assert not V.has_call_count(m, keys, "calls", 1, final=True).first().satisfied
    assert V.has_call_count(m, keys, "calls", 2, final=True).first().satisfied


def test_both_predicates_must_hold_on_one_message(spark):
    rows = [("t", "k", "A", 1, "A", at(1), 0), ("t", "k", "B", 2, "B", at(2), 1)]
    m = spark.createDataFrame(rows, schemas.MESSAGES)
    e = [
        (1, "r", "t", "k", "PRESENCE", "A", 1, at(0), 5000),
        (2, "r", "t", "k", "PRESENCE", "A", 2, at(0), 5000),
        (3, "r", "t", "k", "PRESENCE", "B", 2, at(0), 5000),
    ]
    got = {r.expectation_id: r for r in V.verify(m, spark.createDataFrame(e, schemas.EXPECTATIONS)).collect()}
    assert [got[i].satisfied for i in (1, 2, 3)] == [True, False, True]
    assert got[2].message == (
        "For key k: Verification failed!\nExpected 'k' to have a A Processing Event, but saw none"
    )


def test_more_messages_never_undo_a_presence_or_mend_an_absence(spark):
    rows = [("t", f"k{i % 7}", "AB"[i % 2], None, "x", at(i * 13 % 97), i) for i in range(60)]
    e = [
        (i, "r", "t", f"k{i % 7}", ["PRESENCE", "ABSENCE"][i % 2], "A" if i % 2 == 0 else None, None, at(i), 20_000)
        for i in range(40)
    ]
    expected = spark.createDataFrame(e, schemas.EXPECTATIONS)

    def satisfied(n):
        m = spark.createDataFrame(rows[:n], schemas.MESSAGES)
        out = V.verify(m, expected).collect()
        assert len(out) == len(e)
        return {r.expectation_id: r.satisfied for r in out}

    few, many = satisfied(20), satisfied(60)
    for i in few:
        assert (few[i] <= many[i]) if i % 2 == 0 else (few[i] >= many[i])


def test_status_that_starts_as_expected_or_becomes_it(spark):
    history = [("a", v.ARCHIVE_NOT_SET, at(-5), 0), ("a", v.ARCHIVED, at(30), 1), ("b", v.ARCHIVED, at(90), 0)]
    h = spark.createDataFrame(history, "key string, archive_status string, ts timestamp, offset long")
    keys = spark.createDataFrame([(1, "a", at(0)), (2, "b", at(0))], "expectation_id long, key string, registered_at timestamp")
    got = {r.expectation_id: (r.satisfied, r.last_status) for r in V.has_status(h, keys, v.ARCHIVED).collect()}
    assert got == {1: (True, v.ARCHIVED), 2: (False, None)}
    first = {r.expectation_id: r.decided_at for r in V.has_status(h, keys, v.ARCHIVE_NOT_SET).collect()}
    assert first[1] == at(0)


def test_count_passes_and_leaves(spark):
    m = spark.createDataFrame([("k", at(s)) for s in (1, 2, 2, 9)], "key string, ts timestamp")
    e = [(1, "k", 1, at(0)), (2, "k", 2, at(0)), (3, "k", 3, at(5)), (4, "k", 0, at(0)), (5, "k", 0, at(1)),
         (6, "x", 0, at(0)), (7, "k", 4, at(20)), (8, "k", 5, at(0))]
    keys = spark.createDataFrame(e, "expectation_id long, key string, expected_count int, registered_at timestamp")
    for slot in (1000, V.SLOT_MS):
        got = {r.expectation_id: r.satisfied for r in V.has_count(m, keys, ["key"], slot_ms=slot).collect()}
        # Two messages at +2 s: the count goes from 1 to 3 and is never 2.
        assert got == {1: True, 2: False, 3: True, 4: True, 5: False, 6: True, 7: True, 8: False}


def test_decoding(spark):
    raw = spark.createDataFrame(
        [("k", bytes([0, 0, 0, 4]), at(0)), ("k", bytes([0, 0, 1, 0]), at(1)), ("k", b"xy", at(2))],
        "key string, value binary, timestamp timestamp",
    ).withColumn("topic", F.lit("calls")).withColumn("offset", F.lit(0))
    from proofmark.sources import decode_calls

    good, bad = M.split_quarantine(decode_calls(raw))
    assert sorted(r.calls for r in good.collect()) == [4, 256]
    assert [bytes(r.value) for r in bad.collect()] == [b"xy"]
    framed = spark.createDataFrame([(b"\x00\x00\x00\x00\x07body",)], "value binary")
    assert bytes(framed.select(C.without_schema_id(F.col("value")).alias("b")).first().b) == b"body"


def test_generated_workload_is_repeatable(spark):
    from proofmark.sources import attachment_catalogue

    forms = spark.createDataFrame([(i, f"F{i}", "T", f"title {i}") for i in range(5)], "position long, form_no string, theme string, title string")
    make = lambda seed: G.generate_workload(spark, 20, 3, 1000, seed, forms, attachment_catalogue(spark))
    one, two = (sorted(tuple(r) for r in make(1).collect()) for _ in range(2))
    assert one == two and len(one) == 60 and len({r[-2] for r in one}) == 60
    assert sorted(tuple(r) for r in make(2).collect()) != one
    assert {r.code for r in make(1).collect()} == {"L8", "L9", "W2"}
    assert [tuple(r) for r in G.load_cases(spark).collect()] == v.LOAD_CASES


def test_documents_from_short_lists(spark):
    df = spark.createDataFrame([("0", []), ("1", ["a"]), ("2", ["a", "b"]), ("3", ["a", "b", "c"])], "k string, file_ids array<string>")
    ids = lambda keep: {
        r.k: [d.variants[0].id for d in r.documents] for r in G.documents_from_ids(df, "F", keep_last=keep).collect()
    }
    assert ids(True) == {"0": [], "1": ["a"], "2": ["a", "b"], "3": ["a", "b", "c"]}
    assert ids(False) == {"0": [], "1": ["a"], "2": ["a"], "3": ["a", "b"]}


def test_best_target_group(spark):
    acts = [("x", "p", date(2024, 1, 1), date(2024, 1, 31)), ("y", "p", date(2024, 3, 1), None), ("z", "q", date(2024, 1, 1), None)]
    groups = [
        ("p", "ANNET", "last", date(2023, 1, 1), None),
        ("p", "ARBSOKERE", "early", date(2023, 1, 1), date(2023, 12, 31)),
        ("p", "ENSFORUTD", "touch", date(2024, 1, 31), date(2024, 2, 2)),
        ("p", "ARBSOKERE", "late", date(2025, 1, 1), date(2025, 2, 2)),
        ("p", "UNLISTED", "u", date(2020, 1, 1), None),
    ]
    a = spark.createDataFrame(acts, "activity_id string, person_id string, from_date date, to_date date")
    got = {
        r.activity_id: r.target_group and tuple(r.target_group)
        for r in J.best_target_group(a, spark.createDataFrame(groups, schemas.TARGET_GROUPS)).collect()
    }
    assert got == {"x": ("ENSFORUTD", "touch"), "y": ("ARBSOKERE", "late"), "z": None}


def test_prefill_rejects_unknown_names(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert J.prefill(df, ["b"]).columns == ["b"]
    with pytest.raises(ValueError, match="c"):
        J.prefill(df, ["a", "c"])


def test_main_documents_and_required_fields(spark):
    doc = lambda main: ("F", main, "t", [])
    rows = [("one", False, "1", "T", [doc(True), doc(False)]), ("two", False, None, "T", [doc(True), doc(True)])]
    df = spark.createDataFrame(rows, schemas.SUBMISSIONS)
    assert [r.submission_id for r in Q.main_document_violations(df).collect()] == ["two"]
    assert [(r.submission_id, r.missing) for r in Q.missing_required(df, ["submission_id", "person_id"]).collect()] == [("two", ["person_id"])]
    assert Q.bad_person_ids(df).count() == 2


def test_replaced_attachments(spark):
    atts = spark.createDataFrame([(1, 10, "A"), (2, 20, "A")], "id long, application_id long, code string")
    done = spark.createDataFrame([(10, 1, at(1)), (10, 2, at(2))], "application_id long, change_id long, at timestamp")
    sent = spark.createDataFrame([(7, 10, "B", 1), (8, 10, "C", 2)], "id long, application_id long, code string, change_id long")
    assert sorted(r.id for r in U.replace_attachments(atts, done, sent).collect()) == [2, 8]


def test_lifecycle(spark):
    seq = {"good": "RECEIVED STARTED ARCHIVED FINISHED", "gap": "RECEIVED ARCHIVED", "back": "RECEIVED ARCHIVED STARTED", "open": "RECEIVED STARTED"}
    rows = [(k, t, at(i)) for k, s in seq.items() for i, t in enumerate(s.split())]
    got = {
        r.key: (r.out_of_order, r.missing)
        for r in U.lifecycle_violations(spark.createDataFrame(rows, schemas.PROCESSING_EVENTS)).collect()
    }
    assert got == {"gap": ([], ["STARTED"]), "back": (["ARCHIVED before STARTED"], [])}


def test_notification_done_cancels(spark):
    new = spark.createDataFrame([("a", at(0), 10), ("b", at(0), 0), ("c", at(5), 1)], "submission_id string, changed_at timestamp, active_days int").withColumn("group_id", F.lit("g"))
    done = spark.createDataFrame([("a", at(9)), ("c", at(1))], "submission_id string, changed_at timestamp")
    log = N.notification_events(new, done)
    assert [r.submission_id for r in N.open_notifications(log, F.lit(at(60)).cast("timestamp")).collect()] == ["c"]


def test_run_metrics(spark):
    log = [("r", "TC01", at(0), at(60), True, None), ("r", "TC02", at(60), at(90), False, "late")]
    df = spark.createDataFrame(log, schemas.RUN_LOG)
    assert A.run_duration(df).first().seconds == 90.0
    assert [(r.case_id, r.seconds) for r in A.case_duration(df).collect()] == [("TC01", 60.0)]
    assert A.last_success(df).first().last_success == at(60)
    assert A.last_success(df, strict=False).first().last_success == at(90)
    assert A.exit_status(df).first().exit_status == 1
    assert {r.name for r in A.gauges(df).collect()} == {"total_duration", "case_duration", "last_success", "last_failure"}


def test_lookup_join_keeps_every_row(spark):
    from proofmark.operators.skew import join_lookup

    rows = [("hot" if i % 3 == 0 else f"k{i}", i) for i in range(300)]
    df = spark.createDataFrame(rows, "k string, i int")
    lookup = spark.createDataFrame([("hot", 1), ("k1", 2), ("unused", 3)], "k string, x int")
    found = {"hot": 1, "k1": 2}
    got = {how: sorted(tuple(r) for r in join_lookup(df, lookup, "k", how).collect()) for how in ("left", "inner", "left_semi", "left_anti")}
    assert got["left"] == sorted((k, i, found.get(k)) for k, i in rows)
    assert got["inner"] == sorted((k, i, found[k]) for k, i in rows if k in found)
    assert got["left_semi"] == sorted(r for r in rows if r[0] in found)
    assert got["left_anti"] == sorted(r for r in rows if r[0] not in found)


def test_changes_to_a_hot_application(spark):
    apps = spark.createDataFrame([(1, "u", "F", "t0", v.CREATED), (2, "u", "F", "t0", v.CREATED)],
                                 "application_id long, user_id string, form_no string, title string, status string")
    log = [(i, "update" if i % 2 else "completed", 1, f"t{i}", at(i), "u") for i in range(200)]
    log += [(500, "delete", 1, None, at(150), "u"), (501, "update", 2, "late", at(3), "u"), (502, "update", 9, "x", at(3), "u")]
    changes = spark.createDataFrame(log, "change_id long, op string, application_id long, title string, at timestamp, actor string")
    state, rejected = U.apply_changes(apps, changes)
    got = {r.application_id: (r.title, r.status) for r in state.collect()}
    assert got == {1: ("t150", v.DELETED_BY_USER), 2: ("late", v.CREATED)}
    reasons = [r.reason for r in rejected.collect()]
    assert reasons.count("deleted before") == 49 and reasons.count("unknown application") == 1


def test_predicate_column(spark):
    df = spark.createDataFrame([("A", 1)], "event_type string, calls int")
    check = lambda t, c: df.select(
        V.predicate(F.col("event_type"), F.col("calls"), F.lit(t).cast("string"), F.lit(c).cast("int")).alias("p")
    ).first().p
    assert [check("A", 1), check("A", None), check(None, None), check("B", 1), check("A", 2)] == [True, True, True, False, False]


def test_percentiles_are_exact_for_many_distinct_values(spark):
    n = 120_000
    log = spark.range(n).select(
        F.lit("g").alias("name"), F.lit(0).cast("long").alias("started_ms"), (F.col("id") * 7919 % 1_000_003).alias("finished_ms")
    ).unionByName(spark.createDataFrame([(None, 1, 4), ("h", 5, None)], "name string, started_ms long, finished_ms long"))
    got = {r["name"]: r for r in A.upload_summary(log, "name").collect()}
    values = sorted(i * 7919 % 1_000_003 for i in range(n))
    assert (got["g"].median_ms, got["g"].p95_ms, got["g"].max_ms, got["g"].uploads) == (values[n // 2 - 1], values[n * 95 // 100 - 1], values[-1], n)
    assert (got[None].median_ms, got[None].mean_ms, got["h"].median_ms, got["h"].uploads) == (3, 3.0, None, 1)


def test_gauges_read_the_log_once(spark, tmp_path):
    rows = [("r", "a", at(0), at(5), True), ("r", "b", at(1), at(9), False), ("s", None, at(2), at(3), True)]
    spark.createDataFrame(rows, "run_id string, case_id string, started_at timestamp, finished_at timestamp, ok boolean").write.parquet(f"{tmp_path}/log")
    out = A.gauges(spark.read.parquet(f"{tmp_path}/log"))
    assert out._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    got = sorted((r.run_id, r["name"], r.labels.get("testcase_id"), r.value) for r in out.collect() if r["name"].endswith("duration"))
    assert got == [("r", "case_duration", "a", 5.0), ("r", "total_duration", None, 9.0), ("s", "case_duration", None, 1.0), ("s", "total_duration", None, 1.0)]
    assert {(r.run_id, r["name"], r.at) for r in out.collect()} >= {("r", "last_failure", at(9)), ("s", "last_success", at(3)), ("r", "case_duration", at(9))}


def test_slots_bound_a_window_task_for_microseconds(spark):
    """An hour of one key, a message every 20 ms: no slot, and so no window task, holds more than ten seconds of it."""
    from proofmark.operators.nearest import nearest, slot_of

    facts = spark.range(180_000).select(F.lit("k").alias("k"), (F.col("id") * 20_000 + 7).alias("at")).withColumn("measure", F.col("at"))
    width = V.SLOT_MS * 1000
    most = facts.groupBy(slot_of(F.col("at"), width)).count().agg(F.max("count")).first()[0]
    assert most <= 500
    points = spark.createDataFrame([("k", 0), ("k", 3_599_980_007), ("k", 1_000_000_008)], "k string, at long")
    got = {r.at: (r.next, r.last) for r in nearest(points, facts, ["k"], width).collect()}
    assert got == {0: (7, None), 3_599_980_007: (3_599_980_007, 3_599_980_007), 1_000_000_008: (1_000_020_007, 1_000_000_007)}


def test_stable_uuid_hashes_once(spark):
    """Inside a lambda nothing shares a repeated expression, so the hash stands there once."""
    import hashlib

    from pyspark.sql import functions as F

    from proofmark.functions.columns import stable_uuid

    ids = spark.range(3).select(F.transform(F.array("id"), lambda i: stable_uuid(i, F.lit("x")))[0].alias("u"))
    h = [hashlib.sha256(f"1:{i}|1:x".encode()).hexdigest() for i in range(3)]
    assert [r.u for r in ids.collect()] == [f"{x[:8]}-{x[8:12]}-{x[12:16]}-{x[16:20]}-{x[20:32]}" for x in h]
    assert ids._jdf.queryExecution().analyzed().toString().count("sha2(") == 1


def test_submissions_without_documents_or_variants_have_no_rows(spark):
    variants = "array<struct<id string, media_type string, file_name string, file_type string>>"
    kind = f"submission_id string, theme string, documents array<struct<form_no string, is_main boolean, title string, variants {variants}>>"
    x = ("i", "m", "n", "t")
    rows = [
        ("a", "T", [("F", True, "one", [x, None]), None, ("G", None, None, []), ("H", False, "two", None), ("K", False, None, [x])]),
        ("b", "T", []), ("c", None, None), (None, None, [(None, None, None, [x])]),
    ]
    out = J.flatten_submissions(spark.createDataFrame(rows, kind))
    assert out.columns == [
        "submission_id", "theme", "document_no", "form_no", "is_main", "title", "variant_no", "id", "media_type", "file_name", "file_type",
    ]
    assert sorted((tuple(r) for r in out.collect()), key=repr) == sorted(
        [
            ("a", "T", 0, "F", True, "one", 0, *x), ("a", "T", 0, "F", True, "one", 1, None, None, None, None),
            ("a", "T", 4, "K", False, None, 0, *x), (None, None, 0, None, None, None, 0, *x),
        ],
        key=repr,
    )
