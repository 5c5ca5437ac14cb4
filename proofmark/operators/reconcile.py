"""All that is known about a submission in one row, and what it amounts to."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from proofmark import values as v


def reconcile(
    messages: DataFrame,
    events: str = "events",
    entities: str = "entities",
    calls: str = "calls",
    status: str = "status",
) -> DataFrame:
    """One wide row per key from the union of the topics.

    Each topic's aggregates are conditional, so the whole reconciliation is one grouping with a map-side
    combine: no joins, and a key that lacks a topic simply has its start values.
    """
    topic = F.col("topic")
    order = F.struct("ts", "offset", "value")

    def seen(name, kind):
        return F.coalesce(F.bool_or((topic == name) & (F.col("event_type") == kind)), F.lit(False))

    def last(name, what):
        return F.max_by(F.when(topic == name, F.col(what)), F.when(topic == name, order))

    return messages.groupBy("key").agg(
        seen(events, v.FINISHED).alias("finished"),
        seen(events, v.FAILURE).alias("failed"),
        last(events, "event_type").alias("last_event"),
        F.count_if(topic == entities).alias("entities"),
        F.max(F.when(topic == calls, F.col("calls"))).alias("calls"),
        F.coalesce(last(status, "value"), F.lit(v.ARCHIVE_NOT_SET)).alias("archive_status"),
    )


def classify_outcome(reconciled: DataFrame, attempts: int = v.ARCHIVE_ATTEMPTS) -> DataFrame:
    """``ok``: archived at the first call; ``retried``: at a later one; ``failed``: given up, nothing stored;
    ``already_archived``: finished since a lookup found it in the archive, so its status was never set.

    k failed calls before the good one make k + 1 calls, and at most ``attempts`` are made. Whatever fits
    none of these is ``inconsistent``.
    """
    stored = F.col("finished") & ~F.col("failed") & (F.col("entities") > 0)
    archived = F.col("archive_status") == v.ARCHIVED
    found = F.col("finished") & ~F.col("failed") & (F.coalesce("calls", F.lit(0)) <= 1)
    gave_up = F.col("failed") & ~F.col("finished") & (F.col("entities") == 0)
    return reconciled.withColumn(
        "outcome",
        F.when(stored & archived & (F.col("calls") == 1), "ok")
        .when(stored & archived & F.col("calls").between(2, attempts), "retried")
        .when(gave_up & (F.col("archive_status") == v.ARCHIVE_FAILED), "failed")
        .when(found & (F.col("archive_status") == v.ARCHIVE_NOT_SET), "already_archived")
        .otherwise("inconsistent"),
    )
