"""Run metrics over the driver's tables: events as test cases, lines as uploads, orders as journal entries."""

from __future__ import annotations

from pyspark.sql import functions as F

from proofmark.operators import checks as Q
from proofmark.operators import metrics as A
from proofmark.plans.registry import cents, plain, query, table


def run_log(spark, sf):
    """An event is a case of its user's run; its value is its length in seconds, over 100 is a failure."""
    ok = F.col("value") <= 100
    return table(spark, sf, "events").select(
        F.col("user_id").alias("run_id"),
        F.col("event_type").alias("case_id"),
        F.col("ts").alias("started_at"),
        F.timestamp_micros(F.unix_micros("ts") + cents("value") * 10_000).alias("finished_at"),
        ok.alias("ok"),
        F.when(~ok, "too slow").alias("error"),
    )


RUN_LOG_SQL = """
SELECT user_id AS run_id, event_type AS case_id, ts AS started_at,
       ts + to_microseconds(CAST(round(value * 100) AS BIGINT) * 10000) AS finished_at, value <= 100 AS ok,
       CASE WHEN value > 100 THEN 'too slow' END AS error
FROM events
"""
SECONDS = "(epoch_us(max(finished_at)) - epoch_us(min(started_at))) / 1e6 AS seconds"


@query(f"SELECT run_id, {SECONDS} FROM ({RUN_LOG_SQL}) GROUP BY run_id")
def run_duration(spark, sf):
    return A.run_duration(run_log(spark, sf))


@query(f"SELECT run_id, case_id, {SECONDS} FROM ({RUN_LOG_SQL}) WHERE ok GROUP BY run_id, case_id")
def case_duration(spark, sf):
    return A.case_duration(run_log(spark, sf))


@query(f"SELECT run_id, max(finished_at) FILTER (ok) AS last_success FROM ({RUN_LOG_SQL}) GROUP BY run_id")
def last_success(spark, sf):
    return plain(A.last_success(run_log(spark, sf)))


@query(f"SELECT run_id, max(finished_at) AS last_success FROM ({RUN_LOG_SQL}) GROUP BY run_id")
def last_success_lenient(spark, sf):
    return plain(A.last_success(run_log(spark, sf), strict=False))


@query(f"SELECT run_id, max(finished_at) FILTER (NOT ok) AS last_failure FROM ({RUN_LOG_SQL}) GROUP BY run_id")
def last_failure(spark, sf):
    return plain(A.last_failure(run_log(spark, sf)))


@query(
    f"SELECT run_id, max(CASE WHEN ok THEN 0 ELSE 1 END) AS exit_status FROM ({RUN_LOG_SQL}) GROUP BY run_id"
)
def exit_status(spark, sf):
    return A.exit_status(run_log(spark, sf))


@query(
    f"""WITH l AS ({RUN_LOG_SQL}),
    t AS (SELECT run_id, max(finished_at) AS at FROM l GROUP BY run_id),
    g AS (SELECT run_id, 'total_duration' AS name, CAST(NULL AS VARCHAR) AS case_id,
                 (epoch_us(max(finished_at)) - epoch_us(min(started_at))) / 1e6 AS value FROM l GROUP BY run_id
          UNION ALL SELECT run_id, 'case_duration', case_id,
                 (epoch_us(max(finished_at)) - epoch_us(min(started_at))) / 1e6 FROM l WHERE ok GROUP BY run_id, case_id
          UNION ALL SELECT run_id, 'last_success', NULL, epoch_us(max(finished_at)) / 1e6 FROM l WHERE ok GROUP BY run_id
          UNION ALL SELECT run_id, 'last_failure', NULL, epoch_us(max(finished_at)) / 1e6 FROM l WHERE NOT ok
                 GROUP BY run_id)
    SELECT * FROM g JOIN t USING (run_id)"""
)
def gauges(spark, sf):
    g = A.gauges(run_log(spark, sf))
    return plain(g.withColumn("case_id", F.try_element_at("labels", F.lit("testcase_id"))).drop("labels"))


def upload_log(spark, sf):
    """A line is an upload attempt of its order: quantity = attempt number, price = duration."""
    start = F.unix_millis("l_shipdate")
    ok = F.col("l_returnflag") == "A"
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("application_id"),
        F.col("l_linenumber").alias("file_no"),
        start.alias("started_ms"),
        (start + cents("l_extendedprice")).alias("finished_ms"),
        F.col("l_quantity").cast("int").alias("attempt"),
        ok.alias("ok"),
        F.when(~ok, F.concat("l_returnflag", "l_linestatus")).alias("error"),
    )


UPLOAD_LOG_SQL = """
SELECT l_orderkey AS application_id, l_linenumber AS file_no, epoch_ms(l_shipdate) AS started_ms,
       epoch_ms(l_shipdate) + CAST(round(l_extendedprice * 100) AS BIGINT) AS finished_ms,
       CAST(l_quantity AS INTEGER) AS attempt, l_returnflag = 'A' AS ok,
       CASE WHEN l_returnflag <> 'A' THEN l_returnflag || l_linestatus END AS error
FROM lineitem
"""


@query(
    f"""SELECT application_id, file_no, attempt, (finished_ms - started_ms) / CAST(1000 AS DOUBLE) AS seconds
        FROM ({UPLOAD_LOG_SQL})"""
)
def upload_durations(spark, sf):
    return A.upload_durations(upload_log(spark, sf)).select("application_id", "file_no", "attempt", "seconds")


@query(
    f"""WITH u AS (SELECT application_id, finished_ms - started_ms AS ms,
                          row_number() OVER (PARTITION BY application_id ORDER BY finished_ms - started_ms) AS r,
                          count(*) OVER (PARTITION BY application_id) AS n FROM ({UPLOAD_LOG_SQL}))
    SELECT application_id, count(*) AS uploads, CAST(sum(ms) AS DOUBLE) / count(*) AS mean_ms, max(ms) AS max_ms,
           min(ms) FILTER (r >= 0.5 * n) AS median_ms, min(ms) FILTER (r >= 0.95 * n) AS p95_ms
    FROM u GROUP BY application_id"""
)
def upload_summary(spark, sf):
    return A.upload_summary(upload_log(spark, sf), "application_id")


@query(
    f"""SELECT application_id, count(*) AS attempts, bool_or(ok) AS ok,
               CAST(count(*) FILTER (NOT ok) AS BIGINT) AS errors,
               (max(ROW(attempt, finished_ms, error)) FILTER (NOT ok))[3] AS last_error,
               CASE WHEN NOT bool_or(ok) THEN (max(ROW(attempt, finished_ms, error)) FILTER (NOT ok))[3] END AS thrown,
               NOT bool_or(ok) AND count(*) >= 3 AS exhausted
        FROM ({UPLOAD_LOG_SQL}) GROUP BY application_id"""
)
def attempt_summary(spark, sf):
    return A.attempt_summary(upload_log(spark, sf), "application_id")


@query(
    """SELECT CASE WHEN event_type = 'signup' THEN 'create' ELSE 'submit' END AS phase,
              CAST(count(*) FILTER (value <= 100) AS BIGINT) AS succeeded,
              CAST(count(*) FILTER (value > 100) AS BIGINT) AS failed,
              min(event_type) = 'signup' AND count(*) FILTER (value > 100) > 0 AS aborts
       FROM events GROUP BY 1"""
)
def submission_outcomes(spark, sf):
    phase = F.when(F.col("case_id") == "signup", "create").otherwise("submit")
    return A.submission_outcomes(run_log(spark, sf).withColumn("phase", phase))


@query(
    """WITH t AS (SELECT l_orderkey, sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS total, count(*) AS files
                  FROM lineitem GROUP BY 1)
       SELECT count(*) AS entries, CAST((max(ROW(total, files)))[1] AS BIGINT) AS max_total,
              (max(ROW(total, files)))[2] AS max_total_files,
              CAST(count(*) FILTER (total > 25000000) AS BIGINT) AS entries_over,
              CAST(sum(total) AS DOUBLE) / count(*) AS mean_total,
              CAST(sum(files) AS DOUBLE) / count(*) AS mean_files,
              CAST(sum(total) AS DOUBLE) / CAST(sum(files) AS DOUBLE) AS mean_size
       FROM t"""
)
def size_profile(spark, sf):
    """Orders as journal entries, line prices in cents as file sizes, threshold 250,000.00."""
    files = table(spark, sf, "lineitem").select("l_orderkey", cents("l_extendedprice").alias("size"))
    return A.size_profile(files, "l_orderkey", 25_000_000)


@query(
    """SELECT CAST(user_id AS VARCHAR) AS run_id,
              CASE WHEN max(value) > 200 THEN 'DOWN' WHEN max(value) > 100 THEN 'ISSUE' ELSE 'OK' END AS status
       FROM events GROUP BY 1"""
)
def worst_status(spark, sf):
    status = F.when(F.col("value") > 200, "DOWN").when(F.col("value") > 100, "ISSUE").otherwise("OK")
    health = table(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("run_id"), F.col("event_type").alias("service"), status.alias("status")
    )
    return Q.worst_status(health)
