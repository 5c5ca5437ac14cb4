"""Run metrics: durations, last success and failure, attempts, size profile."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from proofmark import values as v
from proofmark.operators.nearest import running_count
from proofmark.operators.skew import join_lookup


def seconds_between(start: Column, end: Column) -> Column:
    return (F.unix_micros(end) - F.unix_micros(start)) / F.lit(1_000_000.0)


def run_duration(run_log: DataFrame) -> DataFrame:
    """Whole duration per run, failed or not."""
    return run_log.groupBy("run_id").agg(
        seconds_between(F.min("started_at"), F.max("finished_at")).alias("seconds")
    )


def case_duration(run_log: DataFrame) -> DataFrame:
    """Duration of each successful case of a run; a failed one has none."""
    return (
        run_log.filter("ok")
        .groupBy("run_id", "case_id")
        .agg(seconds_between(F.min("started_at"), F.max("finished_at")).alias("seconds"))
    )


def last_success(run_log: DataFrame, strict: bool = True) -> DataFrame:
    """When a run last succeeded. With ``strict=False`` a finished run counts although cases failed."""
    when = F.when(F.col("ok"), F.col("finished_at")) if strict else F.col("finished_at")
    return run_log.groupBy("run_id").agg(F.max(when).alias("last_success"))


def last_failure(run_log: DataFrame) -> DataFrame:
    return run_log.groupBy("run_id").agg(
        F.max(F.when(~F.col("ok"), F.col("finished_at"))).alias("last_failure")
    )


def exit_status(run_log: DataFrame) -> DataFrame:
    """1 if any case of the run failed."""
    return run_log.groupBy("run_id").agg(F.max(F.when(F.col("ok"), 0).otherwise(1)).alias("exit_status"))


def upload_durations(upload_log: DataFrame) -> DataFrame:
    """Seconds per upload."""
    return upload_log.withColumn("seconds", (F.col("finished_ms") - F.col("started_ms")) / F.lit(1000.0))


def upload_summary(upload_log: DataFrame, by: str, width: int = 1_000) -> DataFrame:
    """Uploads, mean, median and 95th percentile of milliseconds per group, all exact.

    A percentile is the least duration with enough uploads up to it. Uploads are counted per duration map-side and
    the counts run up in slots of ``width`` milliseconds, so a group of any size is spread over tasks. A group
    without a name stays a group.
    """
    name = F.struct(F.col(by).alias("name"))
    rows = upload_log.select(name.alias("of"), (F.col("finished_ms") - F.col("started_ms")).alias("at"), F.lit(1).cast("long").alias("n"))
    return summary_of_counts(rows, by, width)


def summary_of_counts(rows: DataFrame, by: str, width: int = 1_000) -> DataFrame:
    """``upload_summary`` of rows ``(of, at, n)``: ``n`` uploads of the group ``of.name`` took ``at`` milliseconds."""
    whole = rows.groupBy("of").agg(
        F.sum("n").alias("uploads"), F.sum(F.when(F.col("at").isNotNull(), F.col("n")).otherwise(0)).alias("timed"),
        F.sum(F.col("at") * F.col("n")).alias("total_ms"), F.max("at").alias("max_ms"),
    )
    counts = running_count(rows.filter("at IS NOT NULL"), ["of"], width, "n")
    reached = lambda q: F.min(F.when(F.col("count") >= F.ceil(F.col("timed") * q), F.col("at")))
    found = (
        join_lookup(counts, whole.select("of", "timed"), "of", "inner")
        .groupBy("of")
        .agg(reached(0.5).alias("median_ms"), reached(0.95).alias("p95_ms"))
    )
    return whole.join(found, "of", "left").select(
        F.col("of.name").alias(by),
        "uploads",
        (F.col("total_ms") / F.col("timed")).alias("mean_ms"),
        "max_ms",
        "median_ms",
        "p95_ms",
    )


def attempt_summary(upload_log: DataFrame, *item: str, allowed: int = v.UPLOAD_ATTEMPTS) -> DataFrame:
    """Attempts per item, whether one succeeded, and the error that ends it when none did."""
    order = F.struct("attempt", "finished_ms", "error")
    return (
        upload_log.groupBy(*item)
        .agg(
            F.count(F.lit(1)).alias("attempts"),
            F.bool_or("ok").alias("ok"),
            F.count_if(~F.col("ok")).alias("errors"),
            F.max_by(F.when(~F.col("ok"), F.col("error")), F.when(~F.col("ok"), order)).alias("last_error"),
        )
        .withColumn("thrown", F.when(~F.col("ok"), F.col("last_error")))
        .withColumn("exhausted", ~F.col("ok") & (F.col("attempts") >= allowed))
    )


def submission_outcomes(log: DataFrame) -> DataFrame:
    """Good and bad items per phase. A creation error aborts the batch, a submission error does not."""
    bad = ~F.col("ok")
    return (
        log.groupBy("phase")
        .agg(F.count_if(F.col("ok")).alias("succeeded"), F.count_if(bad).alias("failed"))
        .withColumn("aborts", (F.col("phase") == "create") & (F.col("failed") > 0))
    )


def size_profile(files: DataFrame, by: str, threshold: int, size: str = "size") -> DataFrame:
    """Largest total per entry with its file count, entries over the threshold, and the three means.

    Two groupings with map-side combine; the second meets one row per entry and leaves one row.
    """
    return profile_of_entries(files.groupBy(by).agg(F.sum(size).alias("total"), F.count(F.lit(1)).alias("files")), threshold)


def profile_of_entries(entries: DataFrame, threshold: int) -> DataFrame:
    """``size_profile`` of one row ``(total, files)`` per entry."""
    biggest = F.struct(F.col("total"), F.col("files"))
    return (
        entries.agg(
            F.count(F.lit(1)).alias("entries"),
            F.max(biggest).alias("biggest"),
            F.count_if(F.col("total") > threshold).alias("entries_over"),
            F.sum("total").alias("all_bytes"),
            F.sum("files").alias("all_files"),
        )
        .select(
            "entries",
            F.col("biggest.total").alias("max_total"),
            F.col("biggest.files").alias("max_total_files"),
            "entries_over",
            (F.col("all_bytes") / F.col("entries")).alias("mean_total"),
            (F.col("all_files") / F.col("entries")).alias("mean_files"),
            (F.col("all_bytes") / F.col("all_files")).alias("mean_size"),
        )
    )


def gauges(run_log: DataFrame) -> DataFrame:
    """The gauge rows of a run log: ``(run_id, name, labels, value, at)``.

    One grouping by run and case, rolled up per run; a run's cases come out of the same rows, told apart from its
    totals by the grouping, so the log is read and shuffled once.
    """
    ok, bad = F.col("ok"), ~F.col("ok")
    first, last = F.min("started_at"), F.max("finished_at")
    sets = run_log.groupingSets([[F.col("run_id"), F.col("case_id")], [F.col("run_id")]], "run_id", "case_id").agg(
        F.grouping("case_id").alias("whole"),
        seconds_between(first, last).alias("seconds"),
        seconds_between(F.min(F.when(ok, F.col("started_at"))), F.max(F.when(ok, F.col("finished_at")))).alias("good_seconds"),
        F.max(F.when(ok, F.col("finished_at"))).alias("success"),
        F.max(F.when(bad, F.col("finished_at"))).alias("failure"),
        last.alias("case_end"),
        F.count_if(ok).alias("good"),
    )
    none = F.create_map().cast("map<string,string>")
    by_case = F.create_map(F.lit("testcase_id"), F.col("case_id"))
    stamp = lambda c: F.unix_micros(c) / F.lit(1_000_000.0)
    row = lambda name, value, labels=none: F.struct(F.lit(name).alias("name"), labels.alias("labels"), value.alias("value"))
    of_run = F.array(
        row("total_duration", F.col("seconds")), row("last_success", stamp(F.col("success"))), row("last_failure", stamp(F.col("failure")))
    )
    whole = F.col("whole") == 1
    listed = F.when(whole, F.filter(of_run, lambda g: (g["name"] == "total_duration") | g["value"].isNotNull())).when(
        F.col("good") > 0, F.array(row("case_duration", F.col("good_seconds"), by_case))
    )
    end = F.max("case_end").over(Window.partitionBy("run_id"))
    return sets.withColumn("at", end).select("run_id", F.explode(listed).alias("g"), "at").select("run_id", "g.*", "at")
