"""Verification over the driver's tables: signups and orders register expectations, events and lines answer."""

from __future__ import annotations

from pyspark.sql import functions as F

from proofmark import values as v
from proofmark.operators import verify as V
from proofmark.plans import standins as S
from proofmark.plans.registry import plain, query, table

HOUR_MS = 3_600_000
DAY_MS = 24 * HOUR_MS

EVENTS_SQL = """
SELECT 'events' AS topic, CAST(user_id AS VARCHAR) AS key, event_type, CAST(NULL AS INTEGER) AS calls,
       event_type AS value, ts, event_id AS off FROM events
"""
CALLS_SQL = """
SELECT 'calls' AS topic, CAST(l_orderkey AS VARCHAR) AS key, CAST(NULL AS VARCHAR) AS event_type,
       l_linenumber AS calls, CAST(l_linenumber AS VARCHAR) AS value, l_shipdate AS ts,
       CAST(l_linenumber AS BIGINT) AS off FROM lineitem
"""
ENTITIES_SQL = """
SELECT 'entities' AS topic, CAST(l_orderkey AS VARCHAR) AS key, CAST(NULL AS VARCHAR) AS event_type,
       CAST(NULL AS INTEGER) AS calls, CAST(l_partkey AS VARCHAR) AS value, l_shipdate AS ts,
       CAST(l_linenumber AS BIGINT) AS off FROM lineitem
"""


def verdict_sql(messages: str, expectations: str, tail: str = "SELECT * FROM verdict") -> str:
    """Every pair of the window, then one row per expectation: the plain definition."""
    return f"""
WITH m AS ({messages}), e0 AS ({expectations}),
e AS (
  SELECT * REPLACE (CASE WHEN timeout_ms >= 0 THEN timeout_ms
                         WHEN presence = 'ABSENCE' THEN {v.ABSENCE_TIMEOUT_MS}
                         ELSE {v.PRESENCE_TIMEOUT_MS} END AS timeout_ms)
  FROM e0),
p AS (
  SELECT e.*, m.ts AS mts, m.off, m.event_type, m.calls, m.value,
         m.ts IS NOT NULL
         AND (e.presence = 'ABSENCE'
              OR ((e.expected_type IS NULL OR m.event_type IS NOT DISTINCT FROM e.expected_type)
                  AND (e.expected_count IS NULL OR m.calls IS NOT DISTINCT FROM e.expected_count))) AS fits
  FROM e LEFT JOIN m ON m.topic = e.topic AND (e.key IS NULL OR m.key = e.key)
       AND m.ts BETWEEN e.registered_at AND e.registered_at + to_milliseconds(e.timeout_ms)),
r AS (
  SELECT *,
         row_number() OVER (PARTITION BY expectation_id ORDER BY fits DESC, mts, off, value) AS first_hit,
         row_number() OVER (PARTITION BY expectation_id ORDER BY mts DESC NULLS LAST, off DESC, value DESC)
           AS last_seen
  FROM p),
g AS (
  SELECT expectation_id, run_id, presence, key, expected_type, expected_count,
         registered_at + to_milliseconds(timeout_ms) AS deadline,
         max(CASE WHEN first_hit = 1 AND fits THEN mts END) AS hit_ts,
         max(CASE WHEN last_seen = 1 THEN value END) AS seen_value,
         max(CASE WHEN last_seen = 1 THEN calls END) AS seen_calls,
         count(mts) AS seen
  FROM r GROUP BY ALL),
verdict AS (
  SELECT expectation_id, run_id, (presence = 'ABSENCE') = (hit_ts IS NULL) AS satisfied,
         coalesce(hit_ts, deadline) AS decided_at,
         CASE WHEN presence = 'PRESENCE' AND hit_ts IS NULL THEN seen_value END AS last_value,
         CASE WHEN (presence = 'ABSENCE') = (hit_ts IS NULL) THEN 'ok' ELSE
           CASE WHEN key IS NULL THEN '' ELSE 'For key ' || key || ': ' END ||
           CASE WHEN presence = 'ABSENCE' THEN 'Verification failed - Expected not to see value'
                WHEN seen = 0 THEN 'Verification failed - Expected to see value but saw none'
                WHEN expected_type IS NOT NULL THEN
                  'Verification failed!' || chr(10) || 'Expected ''' || coalesce(key, 'null') || ''' to have a '
                  || expected_type || ' Processing Event, but saw none'
                ELSE 'Verification failed!' || chr(10) || 'For key ' || coalesce(key, 'null') || ': Expected '
                  || expected_count || ' attempts to save to the Archive, but found ' || seen_calls END
         END AS message
  FROM g)
{tail}"""


def signup_sql(
    presence: str = "PRESENCE",
    expected_type: str | None = None,
    timeout_ms: int | str = -1,
    kind: str = "signup",
    key: str = "CAST(user_id AS VARCHAR)",
) -> str:
    wanted = "CAST(NULL AS VARCHAR)" if expected_type is None else f"'{expected_type}'"
    return f"""
SELECT event_id AS expectation_id, 'replay' AS run_id, 'events' AS topic, {key} AS key,
       '{presence}' AS presence, {wanted} AS expected_type, CAST(NULL AS INTEGER) AS expected_count,
       ts AS registered_at, CAST({timeout_ms} AS BIGINT) AS timeout_ms
FROM events WHERE event_type = '{kind}'"""


def order_sql(topic: str, presence: str = "PRESENCE", count: str = "CAST(NULL AS INTEGER)", timeout_ms: int = -1) -> str:
    return f"""
SELECT o_orderkey AS expectation_id, o_orderstatus AS run_id, '{topic}' AS topic,
       CAST(o_orderkey AS VARCHAR) AS key, '{presence}' AS presence, CAST(NULL AS VARCHAR) AS expected_type,
       {count} AS expected_count, o_orderdate AS registered_at, CAST({timeout_ms} AS BIGINT) AS timeout_ms
FROM orders"""


def others_of_user(spark, sf):
    """All events but signups, so that no expectation meets its own event."""
    return S.event_messages(spark, sf).filter(F.col("event_type") != "signup")


OTHERS_SQL = EVENTS_SQL + " WHERE event_type <> 'signup'"


@query(verdict_sql(OTHERS_SQL, signup_sql(expected_type="purchase", timeout_ms=DAY_MS)))
def verify_presence(spark, sf):
    """A signup expects a purchase of its user within a day."""
    e = V.expect(S.signup_keys(spark, sf), "events", expected_type="purchase", timeout_ms=DAY_MS)
    return plain(V.verify_presence(others_of_user(spark, sf), e))


@query(verdict_sql(OTHERS_SQL, signup_sql("ABSENCE", timeout_ms=6 * HOUR_MS)))
def verify_absence(spark, sf):
    """A signup expects nothing else of its user for six hours."""
    e = V.expect(S.signup_keys(spark, sf), "events", v.ABSENCE, timeout_ms=6 * HOUR_MS)
    return plain(V.verify_absence(others_of_user(spark, sf), e))


@query(
    verdict_sql(
        OTHERS_SQL,
        signup_sql(
            expected_type="error",
            timeout_ms=10 * 60_000,
            key="CASE WHEN value >= 20 THEN CAST(user_id AS VARCHAR) END",
        ).replace(
            "'error' AS expected_type", "CASE WHEN value < 20 THEN 'error' ELSE 'click' END AS expected_type"
        ),
    )
)
def verify_any_key(spark, sf):
    """A cheap signup expects an error of any user within ten minutes, a dear one a click of its own user."""
    value = table(spark, sf, "events").select(F.col("event_id").alias("expectation_id"), "value")
    own = F.when(F.col("value") >= 20, F.col("key"))
    keys = S.signup_keys(spark, sf).join(value, "expectation_id").withColumn("key", own)
    kind = F.when(F.col("value") < 20, "error").otherwise("click")
    e = V.expect(keys, "events", expected_type=kind, timeout_ms=10 * 60_000)
    return plain(V.verify(others_of_user(spark, sf), e))


MIXED_TIMEOUT_SQL = "CASE WHEN value < 10 THEN -1 WHEN value < 20 THEN 0 WHEN value < 40 THEN NULL ELSE 36000000 END"


@query(
    verdict_sql(
        EVENTS_SQL,
        signup_sql(expected_type="click", timeout_ms=MIXED_TIMEOUT_SQL, kind="view")
        + " UNION ALL "
        + signup_sql("ABSENCE", timeout_ms=MIXED_TIMEOUT_SQL, kind="error"),
    )
)
def verify_default_timeouts(spark, sf):
    """Given, zero, negative and missing timeouts, presence and absence in one set."""
    events = table(spark, sf, "events")
    value = F.col("value")
    timeout = F.when(value < 10, -1).when(value < 20, 0).when(value < 40, None).otherwise(10 * HOUR_MS)

    def keys(kind):
        return S.signup_keys(spark, sf, kind).join(
            events.select(F.col("event_id").alias("expectation_id"), "value"), "expectation_id"
        )

    e = V.expect(keys("view"), "events", expected_type="click", timeout_ms=timeout).unionByName(
        V.expect(keys("error"), "events", v.ABSENCE, timeout_ms=timeout)
    )
    return plain(V.verify(S.event_messages(spark, sf), e))


@query(
    verdict_sql(
        OTHERS_SQL,
        signup_sql(expected_type="purchase", timeout_ms=DAY_MS),
        """SELECT run_id, bool_and(satisfied) AS all_satisfied, count(*) AS verdicts,
                  CAST(count(*) FILTER (NOT satisfied) AS BIGINT) AS failed,
                  (SELECT message FROM verdict WHERE NOT satisfied ORDER BY decided_at, expectation_id LIMIT 1)
                    AS first_failure
           FROM verdict GROUP BY run_id""",
    )
)
def assert_all(spark, sf):
    """Do all signup expectations hold, and which fails first?"""
    return V.assert_all(verify_presence(spark, sf))


def lifecycle_named(spark, sf):
    """Purchases stand for FINISHED events and errors for FAILURE events."""
    named = (
        F.when(F.col("event_type") == "purchase", v.FINISHED)
        .when(F.col("event_type") == "error", v.FAILURE)
        .otherwise(F.col("event_type"))
    )
    return S.event_messages(spark, sf).withColumn("event_type", named)


LIFECYCLE_NAMED_SQL = """
SELECT 'events' AS topic, CAST(user_id AS VARCHAR) AS key,
       CASE event_type WHEN 'purchase' THEN 'FINISHED' WHEN 'error' THEN 'FAILURE' ELSE event_type END
         AS event_type,
       CAST(NULL AS INTEGER) AS calls, event_type AS value, ts, event_id AS off FROM events
"""


@query(verdict_sql(LIFECYCLE_NAMED_SQL, signup_sql(expected_type=v.FINISHED, timeout_ms=6 * HOUR_MS)))
def has_finished_event(spark, sf):
    keys = S.signup_keys(spark, sf)
    return plain(V.has_finished_event(lifecycle_named(spark, sf), keys, "events", 6 * HOUR_MS))


@query(verdict_sql(LIFECYCLE_NAMED_SQL, signup_sql(expected_type=v.FAILURE, timeout_ms=6 * HOUR_MS)))
def has_failure_event(spark, sf):
    keys = S.signup_keys(spark, sf)
    return plain(V.has_failure_event(lifecycle_named(spark, sf), keys, "events", 6 * HOUR_MS))


@query(verdict_sql(LIFECYCLE_NAMED_SQL, signup_sql(expected_type=v.FINISHED, timeout_ms=15 * 60_000)))
def expect_finished(spark, sf):
    """Every signup is a submitted key of one load case with a limit of 15 minutes."""
    e = V.expect_finished(S.signup_keys(spark, sf), "events", timeout_min=15)
    return plain(V.verify(lifecycle_named(spark, sf), e))


@query(verdict_sql(CALLS_SQL, order_sql("calls", count="3", timeout_ms=700 * DAY_MS)))
def call_count_any(spark, sf):
    """Some line of an order within 700 days carries the number 3."""
    return plain(
        V.has_call_count(S.call_messages(spark, sf), S.order_keys(spark, sf), "calls", 3, 700 * DAY_MS)
    )


@query(
    verdict_sql(
        CALLS_SQL,
        order_sql("calls", count="3", timeout_ms=700 * DAY_MS),
        """SELECT expectation_id, run_id, coalesce(seen_calls = 3, false) AS satisfied, deadline AS decided_at,
                  seen_value AS last_value,
                  CASE WHEN seen_calls = 3 THEN 'ok'
                       WHEN seen = 0 THEN 'For key ' || key
                            || ': Verification failed - Expected to see value but saw none'
                       ELSE 'For key ' || key || ': Verification failed!' || chr(10) || 'For key ' || key
                            || ': Expected 3 attempts to save to the Archive, but found ' || seen_calls END
                    AS message
           FROM g""",
    )
)
def call_count_final(spark, sf):
    """The last line within 700 days carries the number 3."""
    return plain(
        V.has_call_count(
            S.call_messages(spark, sf), S.order_keys(spark, sf), "calls", 3, 700 * DAY_MS, final=True
        )
    )


@query(verdict_sql(ENTITIES_SQL, order_sql("entities", timeout_ms=300 * DAY_MS)))
def has_entity(spark, sf):
    return plain(
        V.has_entity(S.entity_messages(spark, sf), S.order_keys(spark, sf), "entities", 300 * DAY_MS)
    )


@query(verdict_sql(ENTITIES_SQL, order_sql("entities", "ABSENCE", timeout_ms=300 * DAY_MS)))
def has_no_entity(spark, sf):
    return plain(
        V.has_no_entity(S.entity_messages(spark, sf), S.order_keys(spark, sf), "entities", 300 * DAY_MS)
    )


@query(
    """SELECT 'events' AS topic, CAST(user_id AS VARCHAR) AS key, max(ts) AS ts,
              (max(ROW(ts, event_id, event_type)))[3] AS value, count(*) AS n
       FROM events GROUP BY user_id"""
)
def last_observed(spark, sf):
    return plain(V.last_observed(S.event_messages(spark, sf)))


@query(
    f"""WITH h AS ({S.STATUS_HISTORY_SQL}),
    e AS (SELECT o_orderkey AS expectation_id, CAST(o_orderkey AS VARCHAR) AS key, o_orderdate AS reg,
                 o_orderdate + INTERVAL 200 DAY AS fin FROM orders),
    s AS (SELECT *, lead(ts) OVER (PARTITION BY key ORDER BY ts, off, archive_status) AS till FROM h),
    hit AS (SELECT expectation_id, min(greatest(ts, reg)) AS at_ts FROM e JOIN s USING (key)
            WHERE archive_status = '{v.ARCHIVED}' AND ts <= fin
              AND (ts >= reg OR till IS NULL OR till > reg) GROUP BY ALL),
    fin AS (SELECT expectation_id, (max(ROW(ts, off, archive_status)))[3] AS last_status
            FROM e JOIN h USING (key) WHERE ts <= fin GROUP BY ALL)
    SELECT expectation_id, at_ts IS NOT NULL AS satisfied, coalesce(at_ts, e.fin) AS decided_at, last_status
    FROM e LEFT JOIN hit USING (expectation_id) LEFT JOIN fin USING (expectation_id)"""
)
def status_within(spark, sf):
    """An order has the archived status at some time in its first 200 days."""
    return plain(
        V.has_status(S.status_history(spark, sf), S.order_keys(spark, sf), v.ARCHIVED, 200 * DAY_MS)
    )


@query(
    f"""WITH h AS ({S.STATUS_HISTORY_SQL}),
    l AS (SELECT key, (max(ROW(ts, off, archive_status)))[3] AS archive_status FROM h GROUP BY key)
    SELECT key, archive_status, archive_status = '{v.ARCHIVED}' AS satisfied FROM l"""
)
def current_status(spark, sf):
    # The status itself breaks ties of repeated line numbers.
    history = S.status_history(spark, sf).withColumn("offset", F.struct("offset", "archive_status"))
    return V.current_status(history, v.ARCHIVED)


@query(
    """WITH e AS (SELECT event_id AS expectation_id, event_type, CAST(floor(value) AS INTEGER) AS want,
                         ts AS reg, ts + INTERVAL 2 DAY AS fin FROM events),
    s AS (SELECT event_type, ts, count(*) OVER (PARTITION BY event_type ORDER BY ts) AS n FROM events),
    c AS (SELECT event_type, n, min(ts) AS reached FROM s GROUP BY ALL),
    l AS (SELECT *, lead(reached) OVER (PARTITION BY event_type ORDER BY n) AS over_at FROM c),
    j AS (SELECT e.*, reached, over_at,
                 CASE WHEN want = 0 THEN coalesce((SELECT min(reached) FROM c WHERE c.event_type = e.event_type) > reg, true)
                      ELSE coalesce(reached <= fin AND (over_at IS NULL OR over_at > reg), false) END AS ok
          FROM e LEFT JOIN l ON l.event_type = e.event_type AND l.n = e.want)
    SELECT expectation_id, ok AS satisfied,
           CASE WHEN ok THEN greatest(coalesce(reached, reg), reg) ELSE fin END AS decided_at FROM j"""
)
def running_count_reached(spark, sf):
    """Each event expects the running count of its type to equal its own value within two days."""
    events = table(spark, sf, "events")
    keys = events.select(
        F.col("event_id").alias("expectation_id"),
        "event_type",
        F.floor("value").cast("int").alias("expected_count"),
        F.col("ts").alias("registered_at"),
    )
    return plain(V.has_count(events, keys, ["event_type"], 2 * DAY_MS))


@query(
    """SELECT o_orderkey AS application_id, count(l_orderkey) AS attachments, count(l_orderkey) = 4 AS satisfied,
              CASE WHEN count(l_orderkey) = 4 THEN 'ok' ELSE 'Forventer 4 vedlegg, men søknad har '
                   || count(l_orderkey) || '.' END AS message
       FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey"""
)
def attachment_counts(spark, sf):
    return V.has_size(
        S.applications(spark, sf).select("application_id"),
        S.attachments(spark, sf).select("application_id"),
        4,
    )


ATTACHMENT_REFS_SQL = """
SELECT doc_id AS application_id, label AS id, lang AS code FROM documents
LEFT JOIN (SELECT doc_id AS d, quality AS label FROM labels) ON d = doc_id
"""


def attachment_ref_rows(spark, sf):
    """Documents as references; those without a label have no id."""
    labels = table(spark, sf, "labels").select("doc_id", F.col("quality").alias("id"))
    return (
        table(spark, sf, "documents")
        .join(labels, "doc_id", "left")
        .select(F.col("doc_id").alias("application_id"), "id", F.col("lang").alias("code"))
    )


@query(f"SELECT * FROM ({ATTACHMENT_REFS_SQL}) WHERE id IS NOT NULL AND code IS NOT NULL")
def attachment_refs(spark, sf):
    return V.attachment_refs(attachment_ref_rows(spark, sf))[0]


@query(f"SELECT * FROM ({ATTACHMENT_REFS_SQL}) WHERE id IS NULL OR code IS NULL")
def attachment_refs_quarantine(spark, sf):
    return V.attachment_refs(attachment_ref_rows(spark, sf))[1]


def health_rows(spark, sf):
    """The highest-valued events are outages: user = run, event type = service."""
    return table(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("run_id"),
        F.col("event_type").alias("service"),
        F.when(F.col("value") > 200, "DOWN").otherwise("UP").alias("status"),
    )


@query(
    """SELECT CAST(user_id AS VARCHAR) AS run_id, bool_and(value <= 200) AS all_up,
              CAST(count(*) FILTER (value > 200) AS BIGINT) AS down,
              min(CASE WHEN value > 200 THEN event_type END) AS first_down
       FROM events GROUP BY user_id"""
)
def all_up(spark, sf):
    return V.all_up(health_rows(spark, sf))[0]


@query(
    """SELECT CAST(user_id AS VARCHAR) AS run_id, event_type AS service, 'DOWN' AS status
       FROM events WHERE value > 200"""
)
def all_up_failing(spark, sf):
    return V.all_up(health_rows(spark, sf))[1]
