"""Engine tables read off the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from proofmark import values as v
from proofmark.plans.registry import cents, table


def event_messages(spark: SparkSession, sf: str, topic: str = "events") -> DataFrame:
    """``events`` as a keyed topic: user, event type, time; the event id is the offset."""
    return table(spark, sf, "events").select(
        F.lit(topic).alias("topic"),
        F.col("user_id").cast("string").alias("key"),
        "event_type",
        F.lit(None).cast("int").alias("calls"),
        F.col("event_type").alias("value"),
        "ts",
        F.col("event_id").alias("offset"),
    )


def call_messages(spark: SparkSession, sf: str, topic: str = "calls") -> DataFrame:
    """``lineitem`` as call counts: the line number of an order at its ship date."""
    return table(spark, sf, "lineitem").select(
        F.lit(topic).alias("topic"),
        F.col("l_orderkey").cast("string").alias("key"),
        F.lit(None).cast("string").alias("event_type"),
        F.col("l_linenumber").alias("calls"),
        F.col("l_linenumber").cast("string").alias("value"),
        F.col("l_shipdate").alias("ts"),
        F.col("l_linenumber").cast("long").alias("offset"),
    )


def entity_messages(spark: SparkSession, sf: str, topic: str = "entities") -> DataFrame:
    """``lineitem`` as archive entities: the part is the entity's title."""
    return table(spark, sf, "lineitem").select(
        F.lit(topic).alias("topic"),
        F.col("l_orderkey").cast("string").alias("key"),
        F.lit(None).cast("string").alias("event_type"),
        F.lit(None).cast("int").alias("calls"),
        F.col("l_partkey").cast("string").alias("value"),
        F.col("l_shipdate").alias("ts"),
        F.col("l_linenumber").cast("long").alias("offset"),
    )


def order_keys(spark: SparkSession, sf: str) -> DataFrame:
    """``orders`` as submitted keys, registered at the order date."""
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("expectation_id"),
        F.col("o_orderstatus").alias("run_id"),
        F.col("o_orderkey").cast("string").alias("key"),
        F.col("o_orderdate").alias("registered_at"),
    )


def signup_keys(spark: SparkSession, sf: str, kind: str = "signup") -> DataFrame:
    """Each event of one type registers an expectation on its user."""
    return (
        table(spark, sf, "events")
        .filter(F.col("event_type") == kind)
        .select(
            F.col("event_id").alias("expectation_id"),
            F.lit("replay").alias("run_id"),
            F.col("user_id").cast("string").alias("key"),
            F.col("ts").alias("registered_at"),
        )
    )


def status_history(spark: SparkSession, sf: str) -> DataFrame:
    """``lineitem`` return flags as archive status changes of an order."""
    return status_of(table(spark, sf, "lineitem"))


def status_of(lines: DataFrame) -> DataFrame:
    return lines.select(
        F.col("l_orderkey").cast("string").alias("key"),
        F.when(F.col("l_returnflag") == "A", v.ARCHIVED)
        .when(F.col("l_returnflag") == "R", v.ARCHIVE_FAILED)
        .otherwise(v.ARCHIVE_NOT_SET)
        .alias("archive_status"),
        F.col("l_shipdate").alias("ts"),
        F.col("l_linenumber").cast("long").alias("offset"),
    )


STATUS_HISTORY_SQL = f"""
SELECT CAST(l_orderkey AS VARCHAR) AS key,
       CASE l_returnflag WHEN 'A' THEN '{v.ARCHIVED}' WHEN 'R' THEN '{v.ARCHIVE_FAILED}'
            ELSE '{v.ARCHIVE_NOT_SET}' END AS archive_status,
       l_shipdate AS ts, CAST(l_linenumber AS BIGINT) AS off
FROM lineitem
"""


def applications(spark: SparkSession, sf: str) -> DataFrame:
    """``orders`` as applications."""
    status = (
        F.when(F.col("o_orderstatus") == "O", v.CREATED)
        .when(F.col("o_orderstatus") == "P", v.COMPLETED)
        .otherwise(v.SUBMITTED)
    )
    followup = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("application_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderpriority").alias("form_no"),
        status.alias("status"),
        F.when(followup, v.APPLICATION_TYPES[1]).otherwise(v.APPLICATION_TYPES[0]).alias("app_type"),
        F.col("o_orderdate").alias("created_at"),
        cents("o_totalprice").alias("amount"),
    )


APPLICATIONS_SQL = f"""
SELECT o_orderkey AS application_id, o_custkey AS user_id, o_orderpriority AS form_no,
       CASE o_orderstatus WHEN 'O' THEN '{v.CREATED}' WHEN 'P' THEN '{v.COMPLETED}'
            ELSE '{v.SUBMITTED}' END AS status,
       CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN '{v.APPLICATION_TYPES[1]}'
            ELSE '{v.APPLICATION_TYPES[0]}' END AS app_type,
       o_orderdate AS created_at, CAST(round(o_totalprice * 100) AS BIGINT) AS amount
FROM orders
"""


def attachments(spark: SparkSession, sf: str) -> DataFrame:
    """``lineitem`` as attachments: the line's flags give the upload status, its price the size.

    Order and line number repeat, so the line is not a key; callers order by all columns.
    """
    flag, line = F.col("l_returnflag"), F.col("l_linestatus")
    status = (
        F.when((flag == "A") & (line == "F"), "LastetOpp")
        .when((flag == "A") & (line == "O"), "SendSenere")
        .when((flag == "N") & (line == "F"), "SendesAvAndre")
        .when((flag == "N") & (line == "O"), "LevertDokumentasjonTidligere")
        .when((flag == "R") & (line == "F"), "HarIkkeDokumentasjonen")
        .otherwise("NavKanHenteDokumentasjon")
    )
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("application_id"),
        F.col("l_linenumber").alias("line"),
        F.col("l_partkey").alias("part"),
        F.when(F.col("l_linenumber") >= 6, v.OTHER_ATTACHMENT)
        .otherwise(F.concat(F.lit("A"), F.col("l_linenumber").cast("string")))
        .alias("code"),
        status.alias("upload_status"),
        (F.col("l_linenumber") <= 4).alias("required"),
        (F.col("l_linenumber") == 1).alias("is_main"),
        cents("l_extendedprice").alias("size"),
        F.col("l_quantity").cast("int").alias("pages"),
        F.col("l_shipdate").alias("created_at"),
    )


ATTACHMENTS_SQL = f"""
SELECT l_orderkey AS application_id, l_linenumber AS line, l_partkey AS part,
       CASE WHEN l_linenumber >= 6 THEN '{v.OTHER_ATTACHMENT}'
            ELSE 'A' || CAST(l_linenumber AS VARCHAR) END AS code,
       CASE l_returnflag || l_linestatus
            WHEN 'AF' THEN 'LastetOpp' WHEN 'AO' THEN 'SendSenere' WHEN 'NF' THEN 'SendesAvAndre'
            WHEN 'NO' THEN 'LevertDokumentasjonTidligere' WHEN 'RF' THEN 'HarIkkeDokumentasjonen'
            ELSE 'NavKanHenteDokumentasjon' END AS upload_status,
       l_linenumber <= 4 AS required, l_linenumber = 1 AS is_main,
       CAST(round(l_extendedprice * 100) AS BIGINT) AS size, CAST(l_quantity AS INTEGER) AS pages,
       l_shipdate AS created_at
FROM lineitem
"""
