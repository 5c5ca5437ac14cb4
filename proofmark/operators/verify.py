"""Expectations against a message history: one verdict per expectation.

Expectations are rows, so one or ten million of them give the same plan. Time is event time: a message
counts when ``registered_at <= ts <= registered_at + timeout_ms``, so a replay gives the same verdicts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from proofmark import values as v
from proofmark.functions.columns import filled
from proofmark.operators.nearest import nearest, running_count
from proofmark.operators.skew import join_lookup

# One hour holds at most 3.6 million distinct millisecond times per key.
# Times are microseconds, so a slot holds ten million distinct ones at most, and a year of a key three million slots.
SLOT_MS = 10_000

# What a lookup asks for: none, type, count or both, plus 4 where any key will do.
NO_TEST, TYPE_TEST, COUNT_TEST, BOTH_TESTS, ANY_KEY = 0, 1, 2, 3, 4


def micros(ts: Column | str) -> Column:
    return F.unix_micros(ts)


def from_micros(us: Column | str) -> Column:
    return F.timestamp_micros(us)


def with_default_timeout(expectations: DataFrame) -> DataFrame:
    """A given timeout counts from 0 up; null or negative means the default of the presence kind."""
    default = F.when(F.col("presence") == v.ABSENCE, v.ABSENCE_TIMEOUT_MS).otherwise(v.PRESENCE_TIMEOUT_MS)
    return expectations.withColumn(
        "timeout_ms", F.when(F.col("timeout_ms") >= 0, F.col("timeout_ms")).otherwise(default.cast("long"))
    )


def of_run(expectations: DataFrame, run_id: str) -> DataFrame:
    """Only the expectations of one run; runs do not see each other."""
    return expectations.filter(F.col("run_id") == run_id)


def split_expectations(expectations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(accepted, rejected)``: absence without a key cannot be decided and is rejected at load."""
    bad = F.col("key").isNull() & (F.col("presence") == v.ABSENCE)
    return expectations.filter(~bad), expectations.filter(bad).withColumn(
        "reason", F.lit("absence needs a key")
    )


def expect(
    keys: DataFrame,
    topic: str,
    presence: str = v.PRESENCE,
    expected_type: str | Column | None = None,
    expected_count: int | Column | None = None,
    timeout_ms: int | Column = -1,
) -> DataFrame:
    """Expectation rows for a key table ``(expectation_id, run_id, key, registered_at)``."""

    def column(x, kind):
        return (x if isinstance(x, Column) else F.lit(x)).cast(kind)

    return keys.select(
        F.col("expectation_id").cast("long").alias("expectation_id"),
        F.col("run_id").cast("string").alias("run_id"),
        F.lit(topic).alias("topic"),
        F.col("key").cast("string").alias("key"),
        F.lit(presence).alias("presence"),
        column(expected_type, "string").alias("expected_type"),
        column(expected_count, "int").alias("expected_count"),
        F.col("registered_at").cast("timestamp").alias("registered_at"),
        column(timeout_ms, "long").alias("timeout_ms"),
    )


def expect_finished(keys: DataFrame, topic: str, timeout_min: int) -> DataFrame:
    """One FINISHED expectation per submitted key, all with the same limit."""
    return expect(keys, topic, expected_type=v.FINISHED, timeout_ms=timeout_min * 60 * 1000)


def asked(event_type: Column, count: Column) -> Column:
    """Which predicates are set."""
    return (
        F.when(event_type.isNotNull(), TYPE_TEST).otherwise(NO_TEST)
        + F.when(count.isNotNull(), COUNT_TEST).otherwise(NO_TEST)
    ).cast("int")


def token(event_type: Column, count: Column) -> Column:
    """The value all set predicates ask for; with ``asked`` it is an equality key.

    A count has digits and a sign only, so the first colon ends it and the pair stays unambiguous.
    """
    return F.concat(
        F.coalesce(count.cast("string"), F.lit("")), F.lit(":"), F.coalesce(event_type, F.lit(""))
    )


def predicate(event_type: Column, calls: Column, expected_type: Column, expected_count: Column) -> Column:
    """All predicates of an expectation hold on one message; an unset predicate always holds."""
    type_ok = expected_type.isNull() | event_type.eqNullSafe(expected_type)
    count_ok = expected_count.isNull() | calls.eqNullSafe(expected_count)
    return type_ok & count_ok


def _prepared(expectations: DataFrame) -> DataFrame:
    """Adds the lookup key (``topic, who, asked, token``) and the window in microseconds.

    A row without a key looks among all messages of its topic: its ``who`` is empty and ``asked`` says so,
    which keeps every lookup an equi join.
    """
    absent = F.col("presence") == v.ABSENCE
    any_key = F.col("key").isNull()
    no_type, no_count = F.when(~absent, F.col("expected_type")), F.when(~absent, F.col("expected_count"))
    start = micros("registered_at")
    return with_default_timeout(expectations).select(
        "*",
        F.coalesce("key", F.lit("")).alias("who"),
        (asked(no_type, no_count) + F.when(any_key, ANY_KEY).otherwise(0)).alias("asked"),
        token(no_type, no_count).alias("token"),
        start.alias("start_us"),
        (start + F.col("timeout_ms") * 1000).alias("end_us"),
    )


def _kinds(points: DataFrame, kind: str) -> Column:
    """The kinds of lookup that are asked at all: a scalar subquery with a handful of values."""
    return points.select(F.collect_set(kind)).scalar()


def _in_windows(facts: DataFrame, asking: DataFrame, by: Sequence[str]) -> DataFrame:
    """Facts that lie between the first start and the last end of their key's windows; no others can answer."""
    spans = asking.groupBy(*by).agg(F.min("start_us").alias("from_us"), F.max("end_us").alias("to_us"))
    return join_lookup(facts, spans, by, "inner").filter("at BETWEEN from_us AND to_us").drop("from_us", "to_us")


def _with_hit(e: DataFrame, messages: DataFrame, slot_ms: int) -> DataFrame:
    """Adds ``hit_us``, the time of the first message of the window that passes the row's predicates.

    A message takes the form of each kind of lookup that is asked, and only those some row asks for by its
    whole key and time reach the lookup. They carry times only, so the aggregates are hash aggregates on longs.
    """
    by = ["topic", "who", "asked", "token"]
    points = e.select(*by, F.col("start_us").alias("at"))
    facts = (
        messages.select(
            "topic", "key", "event_type", "calls", micros("ts").alias("at"),
            F.explode(_kinds(points, "asked")).alias("asked"),
        )
        .select("topic", _who("asked"), "asked", token_of("asked"), "at")
        .filter("who IS NOT NULL AND token IS NOT NULL")
    )
    facts = _in_windows(facts, e, by).withColumn("measure", F.col("at"))
    hit = nearest(points, facts, by, slot_ms * 1000, backward=False, sampled=False).select(
        *by, F.col("at").alias("start_us"), F.col("next").alias("first_us")
    )
    return e.join(hit, [*by, "start_us"], "left").select(
        *e.columns, F.when(F.col("first_us") <= F.col("end_us"), F.col("first_us")).alias("hit_us")
    )


def _who(kind: str) -> Column:
    """The key a message answers a lookup of this kind with."""
    return F.when(F.col(kind) >= ANY_KEY, F.lit("")).otherwise(F.col("key")).alias("who")


def token_of(kind: str) -> Column:
    """The token a message answers a lookup of this kind with; null if it cannot."""
    test = F.pmod(F.col(kind), F.lit(ANY_KEY))
    t, c = F.col("event_type"), F.col("calls")
    none_t, none_c = F.lit(None).cast("string"), F.lit(None).cast("int")
    return (
        F.when(test == NO_TEST, token(none_t, none_c))
        .when((test == TYPE_TEST) & t.isNotNull(), token(t, none_c))
        .when((test == COUNT_TEST) & c.isNotNull(), token(none_t, c))
        .when((test == BOTH_TESTS) & t.isNotNull() & c.isNotNull(), token(t, c))
        .alias("token")
    )


def _with_seen(e: DataFrame, of: DataFrame, messages: DataFrame, slot_ms: int) -> DataFrame:
    """Adds ``seen``, the last message of the window, for the rows of ``of`` and null for the others."""
    by = ["topic", "who", "place"]
    place = F.when(F.col("key").isNull(), ANY_KEY).otherwise(NO_TEST).alias("place")
    points = of.select("topic", "who", place, F.col("end_us").alias("at"))
    at = micros("ts").alias("at")
    facts = (
        messages.select(
            "topic", "key", at, F.struct(at, "offset", "event_type", "calls", "value").alias("measure"),
            F.explode(_kinds(e.select(place), "place")).alias("place"),
        )
        .select("topic", _who("place"), "place", "at", "measure")
        .filter("who IS NOT NULL")
    )
    facts = _in_windows(facts, of.withColumn("place", place), by)
    seen = nearest(points, facts, by, slot_ms * 1000, forward=False, sampled=False).select(
        *by, F.col("at").alias("end_us"), "last"
    )
    return e.select("*", place).join(seen, [*by, "end_us"], "left").select(
        *e.columns, F.when(F.col("last.at") >= F.col("start_us"), F.col("last")).alias("seen")
    )


def match(messages: DataFrame, expectations: DataFrame, slot_ms: int = SLOT_MS) -> DataFrame:
    """Expectations with the time of the message that decides them (``hit_us``) and, where a presence found
    none, the last message it saw (``seen``). The second lookup meets the messages of failed keys only."""
    decided = _with_hit(_prepared(expectations), messages, slot_ms)
    failed = decided.filter((F.col("presence") == v.PRESENCE) & F.col("hit_us").isNull())
    return _with_seen(decided, failed, messages, slot_ms)


def verdict_message() -> Column:
    """Why a verdict is what it is, from the columns of ``match`` and ``satisfied``.

    A failed presence names the predicates that its last message fails.
    """
    key, kind, count = F.col("key"), F.col("expected_type"), F.col("expected_count")
    saw_kind, saw_count = F.col("seen.event_type"), F.col("seen.calls")
    broken = F.concat_ws(
        "\n",
        F.when(kind.isNotNull() & ~saw_kind.eqNullSafe(kind), filled(v.VERDICT_NO_EVENT, key, kind)),
        F.when(count.isNotNull() & ~saw_count.eqNullSafe(count), filled(v.VERDICT_CALLS, key, count, saw_count)),
    )
    text = (
        F.when(F.col("presence") == v.ABSENCE, F.lit(v.VERDICT_SAW_VALUE))
        .when(F.col("seen").isNull(), F.lit(v.VERDICT_SAW_NONE))
        .otherwise(filled(v.VERDICT_FAILED, broken))
    )
    prefix = F.when(key.isNotNull(), filled(v.VERDICT_FOR_KEY, key)).otherwise(F.lit(""))
    return F.when(F.col("satisfied"), F.lit(v.VERDICT_OK)).otherwise(F.concat(prefix, text))


def verify(messages: DataFrame, expectations: DataFrame, slot_ms: int = SLOT_MS) -> DataFrame:
    """Exactly one verdict per expectation.

    Presence is decided by the first message that passes all predicates at once, absence by the first
    message of the key; whatever is still open is decided at its own deadline. ``last_value`` is what a
    failed presence saw last. A rejected expectation that was not split off before comes out unsatisfied.
    """
    return decided(match(messages, expectations, slot_ms))


def decided(m: DataFrame, *more: str) -> DataFrame:
    """Verdicts from the columns of ``match``, and ``more`` of its columns."""
    absent = F.col("presence") == v.ABSENCE
    rejected = absent & F.col("key").isNull()
    hit = F.col("hit_us").isNotNull()
    return (
        m.withColumn("satisfied", (absent & ~hit | ~absent & hit) & ~rejected)
        .withColumn("message", verdict_message())
        .select(
            "expectation_id",
            "run_id",
            "satisfied",
            from_micros(
                F.when(rejected, F.col("start_us")).when(hit, F.col("hit_us")).otherwise(F.col("end_us"))
            ).alias("decided_at"),
            F.when(~absent & ~hit, F.col("seen.value")).alias("last_value"),
            F.when(rejected, F.lit("Rejected: absence needs a key")).otherwise(F.col("message")).alias("message"),
            *more,
        )
    )


def verify_presence(messages: DataFrame, expectations: DataFrame, **kw) -> DataFrame:
    return verify(messages, expectations.filter(F.col("presence") == v.PRESENCE), **kw)


def verify_absence(messages: DataFrame, expectations: DataFrame, **kw) -> DataFrame:
    return verify(messages, expectations.filter(F.col("presence") == v.ABSENCE), **kw)


def has_finished_event(events: DataFrame, keys: DataFrame, topic: str, timeout_ms: int = -1) -> DataFrame:
    return verify(events, expect(keys, topic, expected_type=v.FINISHED, timeout_ms=timeout_ms))


def has_failure_event(events: DataFrame, keys: DataFrame, topic: str, timeout_ms: int = -1) -> DataFrame:
    return verify(events, expect(keys, topic, expected_type=v.FAILURE, timeout_ms=timeout_ms))


def has_entity(entities: DataFrame, keys: DataFrame, topic: str, timeout_ms: int = -1) -> DataFrame:
    return verify(entities, expect(keys, topic, timeout_ms=timeout_ms))


def has_no_entity(entities: DataFrame, keys: DataFrame, topic: str, timeout_ms: int = -1) -> DataFrame:
    return verify(entities, expect(keys, topic, v.ABSENCE, timeout_ms=timeout_ms))


def has_call_count(
    calls: DataFrame,
    keys: DataFrame,
    topic: str,
    expected: int | Column,
    timeout_ms: int = -1,
    final: bool = False,
) -> DataFrame:
    """Some count message equals ``expected``; with ``final`` the last one of the window must."""
    expectations = expect(keys, topic, expected_count=expected, timeout_ms=timeout_ms)
    if not final:
        return verify(calls, expectations)
    e = _prepared(expectations)
    m = _with_seen(e, e, calls, SLOT_MS)
    fits = F.coalesce(F.col("seen.calls") == F.col("expected_count"), F.lit(False))
    return (
        m.withColumn("satisfied", fits)
        .withColumn("message", verdict_message())
        .select(
            "expectation_id",
            "run_id",
            "satisfied",
            from_micros("end_us").alias("decided_at"),
            F.col("seen.value").alias("last_value"),
            "message",
        )
    )


def last_observed(messages: DataFrame, by: Sequence[str] = ("topic", "key")) -> DataFrame:
    """Last value per key; equal times are told apart by offset. Combined map-side."""
    order = F.struct("ts", "offset")
    return messages.groupBy(*by).agg(
        F.max("ts").alias("ts"), F.max_by("value", order).alias("value"), F.count(F.lit(1)).alias("n")
    )


def assert_all(verdicts: DataFrame) -> DataFrame:
    """One row per run: do all verdicts hold, how many fail, and the failure decided first."""
    failed = ~F.col("satisfied")
    first = F.struct("decided_at", "expectation_id")
    return verdicts.groupBy("run_id").agg(
        F.bool_and("satisfied").alias("all_satisfied"),
        F.count(F.lit(1)).alias("verdicts"),
        F.count_if(failed).alias("failed"),
        F.min_by(F.when(failed, F.col("message")), F.when(failed, first)).alias("first_failure"),
    )


def has_status(
    history: DataFrame,
    keys: DataFrame,
    expected: str | Column,
    window_ms: int = (v.STATUS_POLLS - 1) * v.STATUS_POLL_MS,
    slot_ms: int = SLOT_MS,
) -> DataFrame:
    """Did the status hold at some time in the polling window that starts at ``registered_at``?

    It did if it was the current one at the start, or if a change to it lies in the window.
    """
    e = (
        keys.withColumn("token", expected if isinstance(expected, Column) else F.lit(expected))
        .withColumn("start_us", micros("registered_at"))
        .withColumn("end_us", F.col("start_us") + window_ms * 1000)
    )
    changes = history.select(
        "key", F.col("archive_status").alias("token"), micros("ts").alias("at"), micros("ts").alias("measure")
    )
    change = nearest(
        e.select("key", "token", F.col("start_us").alias("at")), changes, ["key", "token"], slot_ms * 1000, backward=False
    ).select("key", "token", F.col("at").alias("start_us"), F.col("next").alias("change_us"))
    at = micros("ts").alias("at")
    states = history.select("key", at, F.struct(at, "offset", "archive_status").alias("measure"))
    moments = e.select("key", F.explode(F.array("start_us", "end_us")).alias("at"))
    state = nearest(moments, states, ["key"], slot_ms * 1000, forward=False)
    before = state.select(
        "key", F.col("at").alias("start_us"), F.col("last.archive_status").alias("status_at_start")
    )
    after = state.select("key", F.col("at").alias("end_us"), F.col("last.archive_status").alias("last_status"))
    held = F.coalesce(F.col("status_at_start") == F.col("token"), F.lit(False))
    changed = F.coalesce(F.col("change_us") <= F.col("end_us"), F.lit(False))
    return (
        e.join(change, ["key", "token", "start_us"], "left")
        .join(before, ["key", "start_us"], "left")
        .join(after, ["key", "end_us"], "left")
        .select(
            "expectation_id",
            (held | changed).alias("satisfied"),
            from_micros(
                F.when(held, F.col("start_us")).when(changed, F.col("change_us")).otherwise(F.col("end_us"))
            ).alias("decided_at"),
            "last_status",
        )
    )


def current_status(history: DataFrame, expected: str | Column) -> DataFrame:
    """Latest status per key and whether it is the expected one."""
    want = expected if isinstance(expected, Column) else F.lit(expected)
    return (
        history.groupBy("key")
        .agg(F.max_by("archive_status", F.struct("ts", "offset")).alias("archive_status"))
        .withColumn("satisfied", F.col("archive_status") == want)
    )


def has_count(
    messages: DataFrame,
    keys: DataFrame,
    by: Sequence[str],
    timeout_ms: int = v.COUNT_TIMEOUT_MS,
    slot_ms: int = SLOT_MS,
    weight: str | None = None,
) -> DataFrame:
    """Does the running message count equal ``expected_count`` at some time in the window?

    ``keys`` has ``expectation_id, *by, expected_count, registered_at``; ``weight`` names the column that says for how
    many messages a row stands. The count is a step function:
    it equals n from the step that reaches n to the step that leaves it. Both go into one row per n, so one
    equi join finds the interval.
    """
    by = list(by)
    facts = messages.select(*by, micros("ts").alias("at"), *([weight] if weight else []))
    steps = running_count(facts, by, slot_ms * 1000, weight)
    ends = F.array(
        F.struct(F.col("count").alias("expected"), F.col("at").alias("reached_us"), F.lit(None).cast("long").alias("left_us")),
        F.struct(F.col("before").alias("expected"), F.lit(None).cast("long").alias("reached_us"), F.col("at").alias("left_us")),
    )
    intervals = (
        steps.select(*by, F.inline(ends))
        .groupBy(*by, "expected")
        .agg(F.max("reached_us").alias("reached_us"), F.max("left_us").alias("left_us"))
    )
    e = (
        keys.withColumn("expected", F.col("expected_count").cast("long"))
        .withColumn("start_us", micros("registered_at"))
        .withColumn("end_us", F.col("start_us") + timeout_ms * 1000)
    )
    on_time = (F.col("expected") == 0) | F.coalesce(F.col("reached_us") <= F.col("end_us"), F.lit(False))
    not_over = F.col("left_us").isNull() | (F.col("left_us") > F.col("start_us"))
    ok = on_time & not_over
    return (
        e.join(intervals, [*by, "expected"], "left")
        .select(
            "expectation_id",
            ok.alias("satisfied"),
            from_micros(
                F.when(ok, F.greatest(F.coalesce("reached_us", "start_us"), "start_us")).otherwise(
                    F.col("end_us")
                )
            ).alias("decided_at"),
        )
    )


def has_size(applications: DataFrame, attachments: DataFrame, expected: int | Column) -> DataFrame:
    """Attachment count per application against the expected one; no attachment counts 0."""
    counts = attachments.groupBy("application_id").agg(F.count(F.lit(1)).alias("attachments"))
    want = (expected if isinstance(expected, Column) else F.lit(expected)).cast("long")
    return (
        applications.join(counts, "application_id", "left")
        .withColumn("attachments", F.coalesce("attachments", F.lit(0).cast("long")))
        .withColumn("satisfied", F.col("attachments") == want)
        .select(
            "application_id",
            "attachments",
            "satisfied",
            F.when(F.col("satisfied"), F.lit(v.VERDICT_OK))
            .otherwise(filled(v.VERDICT_ATTACHMENTS, want, F.col("attachments")))
            .alias("message"),
        )
    )


def attachment_refs(attachments: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(refs, quarantine)``: a reference needs an id and a code."""
    refs = attachments.select("application_id", "id", "code")
    good = F.col("id").isNotNull() & F.col("code").isNotNull()
    return refs.filter(good), refs.filter(~good)


def all_up(health: DataFrame, up: str = "UP") -> tuple[DataFrame, DataFrame]:
    """``(summary per run, failing services)`` over a health table ``(run_id, service, status)``."""
    ok = F.coalesce(F.col("status") == up, F.lit(False))
    summary = health.groupBy("run_id").agg(
        F.bool_and(ok).alias("all_up"),
        F.count_if(~ok).alias("down"),
        F.min(F.when(~ok, F.col("service"))).alias("first_down"),
    )
    return summary, health.filter(~ok)
