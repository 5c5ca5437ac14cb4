"""Requests for applications, deletions and expiries of one log over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from proofmark import values as v
from proofmark.operators import starts
from proofmark.operators.changes import create_changes
from proofmark.plans.registry import plain, query, table

FIRST_REQUEST = "1995-01-01"


def log(spark, sf):
    """``(requests, applications so far, ends)``: orders of households ask by priority, each line that came back
    deletes its order, and most orders expire after some months."""
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("request_id"),
        F.col("o_orderkey").alias("application_id"),
        (F.col("o_custkey") % 97).alias("user_id"),
        F.col("o_orderpriority").alias("form_no"),
        F.col("o_orderdate").alias("at"),
        (F.col("o_totalprice") > 400_000).alias("force"),
        F.when(F.col("o_orderkey") % 7 > 0, F.col("o_orderdate") + F.make_interval(days=(F.col("o_orderkey") % 7 * 30).cast("int"))).alias("delete_at"),
        F.when(F.col("o_orderstatus") == "F", v.SUBMITTED).otherwise(v.CREATED).alias("status"),
    )
    ends = table(spark, sf, "lineitem").filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("application_id"), F.col("l_shipdate").alias("at"))
    cut = F.lit(FIRST_REQUEST).cast("timestamp")
    return orders.filter(F.col("at") >= cut).drop("status"), orders.filter(F.col("at") < cut), ends


FOLD_SQL = f"""
WITH RECURSIVE o AS (
  SELECT o_orderkey AS id, o_custkey % 97 AS user_id, o_orderpriority AS form_no, o_orderdate AS at_ts, o_totalprice > 400000 AS force,
    CASE WHEN o_orderkey % 7 > 0 THEN o_orderdate + to_days((o_orderkey % 7 * 30)::INTEGER) END AS delete_at, o_orderstatus <> 'F' AS active
  FROM orders),
stops AS (SELECT l_orderkey AS id, l_shipdate AS stop FROM lineitem WHERE l_returnflag = 'R'),
r AS (
  SELECT o.*, greatest(at_ts, least(coalesce(delete_at, TIMESTAMP '9999-01-01'),
      coalesce((SELECT min(stop) FROM stops s WHERE s.id = o.id AND s.stop >= o.at_ts), TIMESTAMP '9999-01-01'))) AS until,
    row_number() OVER (PARTITION BY user_id, form_no ORDER BY at_ts, id) AS k
  FROM o WHERE at_ts >= TIMESTAMP '{FIRST_REQUEST}'),
before AS (
  SELECT user_id, form_no, max(least(coalesce(delete_at, TIMESTAMP '9999-01-01'),
      coalesce((SELECT min(stop) FROM stops s WHERE s.id = o.id), TIMESTAMP '9999-01-01'))) AS until
  FROM o WHERE at_ts < TIMESTAMP '{FIRST_REQUEST}' AND active GROUP BY user_id, form_no),
fold AS (
  SELECT user_id, form_no, 0::BIGINT AS k, NULL::BIGINT AS request_id, true AS new,
    coalesce(before.until, TIMESTAMP '0001-01-01') AS until
  FROM (SELECT DISTINCT user_id, form_no FROM r) LEFT JOIN before USING (user_id, form_no)
  UNION ALL
  SELECT r.user_id, r.form_no, r.k, r.id, r.force OR f.until <= r.at_ts,
    CASE WHEN r.force OR f.until <= r.at_ts THEN greatest(f.until, r.until) ELSE f.until END
  FROM fold f JOIN r ON r.user_id = f.user_id AND r.form_no = f.form_no AND r.k = f.k + 1)
"""


@query(FOLD_SQL + f"""
SELECT request_id, user_id, form_no, CASE WHEN NOT new THEN '{v.ALREADY_EXISTS}' END AS answer FROM fold WHERE k > 0""")
def starts_in_order(spark, sf):
    """Each request of the log with its answer; null where it starts an application."""
    new, existing = starts.fold_starts(*log(spark, sf))
    columns = ["request_id", "user_id", "form_no"]
    return new.select(*columns, F.lit(None).cast("string").alias("answer")).unionByName(existing.select(*columns, "answer"))


@query(FOLD_SQL + f"""
SELECT f.request_id AS application_id, f.user_id, f.form_no, r.at_ts AS created_at, '{v.CREATED}' AS status, r.delete_at
FROM fold f JOIN r ON r.id = f.request_id WHERE f.new AND f.k > 0""")
def apply_starts(spark, sf):
    """The applications that the log's create changes start."""
    requests, apps, ends = log(spark, sf)
    changes = create_changes(requests.withColumn("change_id", F.col("request_id")).withColumn("actor", F.lit("user")), "application")
    state, _ = starts.apply_starts(changes, apps, ends)
    return plain(state.select("application_id", "user_id", "form_no", "created_at", "status", "delete_at"))
