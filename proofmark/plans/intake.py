"""Intake over the driver's tables: JSON parsing, quarantine, the common history, outcome per key."""

from __future__ import annotations

from pyspark.sql import functions as F

from proofmark import values as v
from proofmark.operators import messages as M
from proofmark.operators import reconcile as R
from proofmark.operators import verify as V
from proofmark.plans import standins as S
from proofmark.plans.registry import plain, query, table


def raw_topic(spark, sf):
    """Event properties (JSON) and document texts (not JSON) as raw values of one topic."""
    events = table(spark, sf, "events").select(
        F.lit("main").alias("topic"),
        F.concat(F.lit("e"), F.col("event_id").cast("string")).cast("binary").alias("key"),
        F.col("props").cast("binary").alias("value"),
        F.col("ts").alias("timestamp"),
    )
    documents = table(spark, sf, "documents").select(
        F.lit("main").alias("topic"),
        F.concat(F.lit("d"), F.col("doc_id").cast("string")).cast("binary").alias("key"),
        F.col("text").cast("binary").alias("value"),
        F.timestamp_seconds(F.col("doc_id") + 1_700_000_000).alias("timestamp"),
    )
    return M.with_event_time(events.unionByName(documents))


@query(
    """SELECT 'main' AS topic, 'e' || event_id AS key, ts,
              CAST(regexp_extract(props, '"k": ([0-9]+)', 1) AS INTEGER) AS k FROM events"""
)
def parse_props(spark, sf):
    good, _ = M.split_quarantine(M.parse_json(raw_topic(spark, sf), "k int"))
    return plain(good.select("topic", "key", "ts", "entity.k"))


@query(
    """SELECT 'main' AS topic, 'd' || doc_id AS key, text AS value, 'value does not parse' AS error,
              make_timestamp((doc_id + 1700000000) * 1000000) AS ts FROM documents"""
)
def quarantine_split(spark, sf):
    """Texts among JSON values go to quarantine whole; the JSON values behind them pass."""
    _, bad = M.split_quarantine(M.parse_json(raw_topic(spark, sf), "k int"))
    return plain(bad.withColumn("value", F.col("value").cast("string")))


def history(spark, sf):
    """Orders as processing events, archived lines as entities, lines as call counts and status changes."""
    kind = (
        F.when(F.col("o_orderstatus") == "F", v.FINISHED)
        .when(F.col("o_orderstatus") == "P", v.FAILURE)
        .otherwise("STARTED")
    )
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("key"), kind.alias("kind"), F.col("o_orderdate").alias("ts")
    )
    lines = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("key"),
        "l_linenumber",
        "l_returnflag",
        "l_quantity",
        F.col("l_partkey").cast("string").alias("part"),
        F.col("l_shipdate").alias("ts"),
    )
    status = S.status_history(spark, sf)
    return M.all_messages(
        M.as_messages(orders, "events", event_type=F.col("kind")),
        M.as_messages(
            lines.filter("l_returnflag = 'A' AND l_quantity > 25"), "entities", value=F.col("part")
        ),
        M.as_messages(lines.filter("l_quantity < 15"), "calls", calls=F.col("l_linenumber")),
        M.as_messages(status, "status", value=F.col("archive_status")),
    )


HISTORY_SQL = f"""
SELECT 'events' AS topic, CAST(o_orderkey AS VARCHAR) AS key,
       CASE o_orderstatus WHEN 'F' THEN 'FINISHED' WHEN 'P' THEN 'FAILURE' ELSE 'STARTED' END AS event_type,
       CAST(NULL AS INTEGER) AS calls,
       CASE o_orderstatus WHEN 'F' THEN 'FINISHED' WHEN 'P' THEN 'FAILURE' ELSE 'STARTED' END AS value,
       o_orderdate AS ts, CAST(0 AS BIGINT) AS off FROM orders
UNION ALL SELECT 'entities', CAST(l_orderkey AS VARCHAR), NULL, NULL, CAST(l_partkey AS VARCHAR), l_shipdate, 0
FROM lineitem WHERE l_returnflag = 'A' AND l_quantity > 25
UNION ALL SELECT 'calls', CAST(l_orderkey AS VARCHAR), NULL, l_linenumber, CAST(l_linenumber AS VARCHAR),
       l_shipdate, 0 FROM lineitem WHERE l_quantity < 15
UNION ALL SELECT 'status', key, NULL, NULL, archive_status, ts, off FROM ({S.STATUS_HISTORY_SQL})
"""


@query(f"SELECT topic, key, event_type, calls, value, ts, off AS \"offset\" FROM ({HISTORY_SQL})")
def all_messages(spark, sf):
    return plain(history(spark, sf))


@query(
    f"""SELECT topic, CAST(count(*) AS BIGINT) AS messages, count(DISTINCT key) AS keys, max(ts) AS latest
        FROM ({HISTORY_SQL}) GROUP BY topic"""
)
def topic_counts(spark, sf):
    """Messages, keys and latest time per topic, with the passing rows observed."""
    seen = M.observed(history(spark, sf), "history")
    # Two exact groupings: the distinct keys are formed map-side first, so a hot key is one row per task.
    per_key = seen.groupBy("topic", "key").agg(F.count(F.lit(1)).alias("n"), F.max("ts").alias("latest"))
    return plain(
        per_key.groupBy("topic").agg(
            F.sum("n").alias("messages"), F.count(F.lit(1)).alias("keys"), F.max("latest").alias("latest")
        )
    )


RECONCILED_SQL = f"""
SELECT key,
       coalesce(bool_or(topic = 'events' AND event_type = 'FINISHED'), false) AS finished,
       coalesce(bool_or(topic = 'events' AND event_type = 'FAILURE'), false) AS failed,
       max(CASE WHEN topic = 'events' THEN event_type END) AS last_event,
       CAST(count(*) FILTER (topic = 'entities') AS BIGINT) AS entities,
       max(calls) AS calls,
       coalesce((max(ROW(ts, off, value)) FILTER (topic = 'status'))[3], '{v.ARCHIVE_NOT_SET}') AS archive_status
FROM ({HISTORY_SQL}) GROUP BY key
"""


@query(RECONCILED_SQL)
def reconcile(spark, sf):
    return R.reconcile(history(spark, sf))


@query(
    f"""SELECT *, CASE
          WHEN finished AND NOT failed AND entities > 0 AND archive_status = '{v.ARCHIVED}' AND calls = 1 THEN 'ok'
          WHEN finished AND NOT failed AND entities > 0 AND archive_status = '{v.ARCHIVED}'
               AND calls BETWEEN 2 AND {v.ARCHIVE_ATTEMPTS} THEN 'retried'
          WHEN failed AND NOT finished AND entities = 0 AND archive_status = '{v.ARCHIVE_FAILED}' THEN 'failed'
          WHEN finished AND NOT failed AND coalesce(calls, 0) <= 1 AND archive_status = '{v.ARCHIVE_NOT_SET}'
               THEN 'already_archived'
          ELSE 'inconsistent' END AS outcome FROM ({RECONCILED_SQL})"""
)
def classify_outcome(spark, sf):
    return R.classify_outcome(R.reconcile(history(spark, sf)))


@query(
    """SELECT o_orderkey AS expectation_id, o_orderstatus AS run_id, 'calls' AS topic,
              CAST(o_orderkey AS VARCHAR) AS key, 'PRESENCE' AS presence, CAST(NULL AS VARCHAR) AS expected_type,
              2 AS expected_count, o_orderdate AS registered_at, CAST(-1 AS BIGINT) AS timeout_ms
       FROM orders WHERE o_orderstatus = 'F'"""
)
def expectations_of_run(spark, sf):
    """The expectations of one run only."""
    return plain(V.of_run(V.expect(S.order_keys(spark, sf), "calls", expected_count=2), "F"))


@query(
    """SELECT event_id AS expectation_id, CASE event_type WHEN 'error' THEN 'ABSENCE' ELSE 'PRESENCE' END AS presence,
              'absence needs a key' AS reason
       FROM events WHERE event_type = 'error' AND value > 50"""
)
def rejected_expectations(spark, sf):
    """Absence without a key is rejected at load."""
    events = table(spark, sf, "events")
    e = events.select(
        F.col("event_id").alias("expectation_id"),
        F.when(F.col("value") <= 50, F.col("user_id").cast("string")).alias("key"),
        F.when(F.col("event_type") == "error", v.ABSENCE).otherwise(v.PRESENCE).alias("presence"),
    )
    return V.split_expectations(e)[1].select("expectation_id", "presence", "reason")
