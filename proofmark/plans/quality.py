"""Data checks and notifications over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from proofmark import values as v
from proofmark.operators import checks as Q
from proofmark.operators import notifications as N
from proofmark.plans.registry import plain, query, table


@query(
    """SELECT l_orderkey AS submission_id, l_linenumber, l_partkey, l_suppkey, l_shipdate AS ts FROM lineitem
       QUALIFY rank() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate, l_linenumber, l_partkey, l_suppkey) > 1"""
)
def conflicts(spark, sf):
    """Every line after the first of its order repeats the order's id."""
    lines = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("submission_id"), "l_linenumber", "l_partkey", "l_suppkey", F.col("l_shipdate").alias("ts")
    )
    return plain(Q.conflicts(lines, ["ts", "l_linenumber", "l_partkey", "l_suppkey"]))


@query(
    """SELECT doc_id AS submission_id, CAST(count(*) AS INTEGER) AS main_documents
       FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)
       WHERE length(line) > 400 GROUP BY doc_id HAVING count(*) > 1"""
)
def main_document_violations(spark, sf):
    """Text lines of more than 400 characters count as main documents."""
    documents = F.transform(F.split("text", "\n"), lambda x: F.struct((F.length(x) > 400).alias("is_main")))
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("submission_id"), documents.alias("documents"))
    return Q.main_document_violations(docs).select("submission_id", "main_documents")


@query(
    """SELECT doc_id, concat_ws(',', CASE WHEN quality IS NULL THEN 'quality' END, CASE WHEN toxic IS NULL THEN 'toxic' END)
              AS missing
       FROM documents LEFT JOIN labels USING (doc_id) WHERE quality IS NULL OR toxic IS NULL"""
)
def missing_required(spark, sf):
    """Documents without labels."""
    docs = table(spark, sf, "documents").select("doc_id", "lang").join(table(spark, sf, "labels"), "doc_id", "left")
    rows = Q.missing_required(docs, ["doc_id", "lang", "quality", "toxic"])
    return rows.select("doc_id", F.array_join("missing", ",").alias("missing"))


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey,
              concat_ws(',', CASE WHEN l_returnflag NOT IN ('A', 'N') THEN 'l_returnflag' END,
                        CASE WHEN l_linestatus NOT IN ('F') THEN 'l_linestatus' END) AS bad
       FROM lineitem WHERE l_returnflag NOT IN ('A', 'N') OR l_linestatus NOT IN ('F')"""
)
def bad_enum_values(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "l_linestatus")
    rows = Q.bad_enum_values(lines, {"l_returnflag": ["A", "N"], "l_linestatus": ["F"]})
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", F.array_join("bad", ",").alias("bad"))


@query(
    """SELECT c_custkey, '10' || substr(c_name, 10) || CASE WHEN c_acctbal < 0 THEN 'x' ELSE '' END AS person_id
       FROM customer WHERE NOT regexp_matches('10' || substr(c_name, 10) || CASE WHEN c_acctbal < 0 THEN 'x' ELSE '' END,
                                              '^[0-9]{11}$')"""
)
def bad_person_ids(spark, sf):
    person = F.concat(
        F.lit("10"), F.substr("c_name", F.lit(10)), F.when(F.col("c_acctbal") < 0, "x").otherwise("")
    )
    return Q.bad_person_ids(table(spark, sf, "customer").select("c_custkey", person.alias("person_id")))


def notification_log(spark, sf):
    """Signups are new notifications of their user, purchases done ones; other events say nothing."""
    e = table(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("submission_id"),
        F.col("user_id").alias("group_id"),
        F.col("ts").alias("changed_at"),
        (F.col("value") > 30).alias("is_followup"),
        (F.col("value") > 60).alias("system_generated"),
        F.floor("value").cast("int").alias("active_days"),
        "event_type",
    )
    new = e.filter("event_type = 'signup'").drop("event_type")
    done = e.filter("event_type = 'purchase'").select("submission_id", "group_id", "changed_at")
    return N.notification_events(new, done)


NOTIFICATIONS_SQL = """
SELECT CAST(user_id AS VARCHAR) AS submission_id, user_id AS group_id, ts AS changed_at,
       CASE WHEN event_type = 'signup' THEN value > 30 END AS is_followup,
       CASE WHEN event_type = 'signup' THEN value > 60 END AS system_generated,
       CASE WHEN event_type = 'signup' THEN CAST(floor(value) AS INTEGER) END AS active_days,
       CASE event_type WHEN 'signup' THEN 'new' ELSE 'done' END AS action
FROM events WHERE event_type IN ('signup', 'purchase')
"""


@query(NOTIFICATIONS_SQL)
def notification_events(spark, sf):
    return plain(notification_log(spark, sf))


@query(
    f"""SELECT submission_id, changed_at, action, CASE WHEN system_generated THEN '{v.NOTIFICATION_TYPES[1]}'
               ELSE '{v.NOTIFICATION_TYPES[0]}' END AS kind FROM ({NOTIFICATIONS_SQL})"""
)
def notification_kind(spark, sf):
    return plain(N.with_kind(notification_log(spark, sf)).select("submission_id", "changed_at", "action", "kind"))


@query(
    f"""WITH l AS (SELECT * FROM ({NOTIFICATIONS_SQL}) WHERE changed_at <= TIMESTAMP '2024-01-25'
                   QUALIFY row_number() OVER (PARTITION BY submission_id ORDER BY changed_at DESC, action DESC) = 1)
    SELECT submission_id, action, changed_at, active_days, group_id, changed_at + to_days(active_days) AS open_until
    FROM l WHERE action = 'new' AND changed_at + to_days(active_days) > TIMESTAMP '2024-01-25'"""
)
def open_notifications(spark, sf):
    return plain(N.open_notifications(notification_log(spark, sf), F.lit("2024-01-25").cast("timestamp")))


@query(
    f"""SELECT group_id, count(*) AS notifications, count(*) FILTER (action = 'new') AS created,
               count(*) FILTER (is_followup) AS followups, max(changed_at) AS latest_change
        FROM ({NOTIFICATIONS_SQL}) GROUP BY group_id"""
)
def notifications_by_group(spark, sf):
    return plain(N.notifications_by_group(notification_log(spark, sf)))


@query(
    """WITH c AS (SELECT event_id, event_type, unnest(
            CASE WHEN value > 100 THEN ['sms', 'epost'] WHEN value > 50 THEN ['epost'] ELSE [NULL] END) AS channel FROM events)
       SELECT event_id AS submission_id, channel, CASE WHEN channel IS NOT NULL THEN event_type END AS text,
              CASE WHEN channel = 'epost' THEN 'title' END AS title FROM c"""
)
def channel_rows(spark, sf):
    """Dear events warn by both channels, middling ones by mail, the others not at all."""

    def warning(channel, title):
        return F.struct(
            F.lit(channel).alias("channel"), F.col("event_type").alias("text"), F.lit(title).cast("string").alias("title")
        )

    sms, mail = warning(v.CHANNELS[0], None), warning(v.CHANNELS[1], "title")
    listed = F.when(F.col("value") > 100, F.array(sms, mail)).when(F.col("value") > 50, F.array(mail))
    rows = table(spark, sf, "events").select(F.col("event_id").alias("submission_id"), listed.alias("channels"))
    return N.channel_rows(rows)
