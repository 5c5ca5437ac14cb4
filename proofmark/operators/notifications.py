"""User notifications: new, done, open, grouped, per channel."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from proofmark.functions.columns import days_after, notification_kind

NEW, DONE = "new", "done"


def notification_events(new: DataFrame, done: DataFrame) -> DataFrame:
    """New and done requests as one log; a done request carries no text of its own."""
    return new.withColumn("action", F.lit(NEW)).unionByName(
        done.withColumn("action", F.lit(DONE)), allowMissingColumns=True
    )


def with_kind(df: DataFrame) -> DataFrame:
    return df.withColumn("kind", notification_kind(F.coalesce("system_generated", F.lit(False))))


def open_notifications(df: DataFrame, as_of: Column, tie: Sequence[str] = ("action",)) -> DataFrame:
    """New ones without a later done that are still inside their active days at ``as_of``.

    At the same time a new one beats a done one, unless ``tie`` orders them by something else.
    """
    order = F.struct("changed_at", *tie)
    last = (
        df.filter(F.col("changed_at") <= as_of)
        .groupBy("submission_id")
        .agg(F.max_by(F.struct("action", "changed_at", "active_days", "group_id"), order).alias("last"))
        .select("submission_id", "last.*")
    )
    until = days_after(F.col("changed_at"), F.col("active_days"))
    return last.filter(F.col("action") == NEW).withColumn("open_until", until).filter(F.col("open_until") > as_of)


def notifications_by_group(df: DataFrame) -> DataFrame:
    """Counts and latest change per group of an application and its follow-ups."""
    return df.groupBy("group_id").agg(
        F.count(F.lit(1)).alias("notifications"),
        F.count_if(F.col("action") == NEW).alias("created"),
        F.count_if(F.col("is_followup")).alias("followups"),
        F.max("changed_at").alias("latest_change"),
    )


def channel_rows(df: DataFrame) -> DataFrame:
    """One row per outside channel; a notification without one keeps its row."""
    return df.select("submission_id", F.explode_outer("channels").alias("c")).select(
        "submission_id", "c.channel", "c.text", "c.title"
    )
