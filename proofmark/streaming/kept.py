"""Counts, histories and firsts that a stream keeps, each as the fold of a ``Snapshots`` store.

The state is what a later batch can add to: counts per time, first and last times per stage, the first place of an id.
A step rewrites the buckets that its batch touches. Sums, minima and maxima take rows in any order, so late rows need no
waiting; only what depends on the order (conflicts) follows the horizon.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from proofmark import values as v
from proofmark.operators import changes as U
from proofmark.operators import verify as V
from proofmark.operators.skew import join_lookup
from proofmark.streaming.snapshots import BUCKETS, Snapshots


def _none(df: DataFrame) -> DataFrame:
    return df.filter("false").withColumn("reason", F.lit(None).cast("string"))


def running_counts(store: str, by: Sequence[str], kinds: Sequence[str], slot_ms: int = V.SLOT_MS, buckets: int = BUCKETS) -> Snapshots:
    """Counts per ``by`` and time, in buckets of their time slot, so that one hot key lies in many buckets.

    Changes are ``(*by, at)``; ``has_count`` asks the store.
    """
    names = [f"{c} {k}" for c, k in zip(by, kinds)]
    shape = T.StructType.fromDDL(", ".join(["slot string", *names, "ts timestamp", "n long"]))

    def fold(known: DataFrame, changes: DataFrame) -> tuple[DataFrame, DataFrame]:
        new = changes.select("slot", *by, F.col("at").alias("ts"), F.lit(1).cast("long").alias("n"))
        summed = known.unionByName(new).groupBy("slot", *by, "ts").agg(F.sum("n").alias("n"))
        return summed, _none(changes)

    changes = T.StructType.fromDDL(", ".join(["slot string", *names, "at timestamp"]))
    return Snapshots(store, "slot", shape, changes, fold, buckets=buckets, ordered=False)


def slotted(messages: DataFrame, by: Sequence[str], slot_ms: int = V.SLOT_MS) -> DataFrame:
    """Messages ``(*by, ts)`` as the changes of ``running_counts``."""
    slot = F.floor(V.micros("ts") / (slot_ms * 1000)).cast("string")
    return messages.select(F.concat_ws("|", *[F.col(c).cast("string") for c in by], slot).alias("slot"), *by, F.col("ts").alias("at"))


def has_count(kept: Snapshots, keys: DataFrame, by: Sequence[str], timeout_ms: int = v.COUNT_TIMEOUT_MS) -> DataFrame:
    """``verify.has_count`` from the counts kept so far; late messages are in them."""
    return V.has_count(kept.rows(keys.sparkSession), keys, by, timeout_ms, weight="n")


def lifecycles(store: str, stages: Sequence[str] = tuple(v.LIFECYCLE), buckets: int = BUCKETS) -> Snapshots:
    """First and last time of each stage per key; changes are ``(key, event_type, at)``."""
    columns = [f"{side}_{i}" for i in range(len(stages)) for side in ("first", "last")]
    shape = T.StructType.fromDDL(", ".join(["key string", *[f"{c} timestamp" for c in columns]]))

    def fold(known: DataFrame, changes: DataFrame) -> tuple[DataFrame, DataFrame]:
        stage = lambda i, c: F.when(F.col("event_type") == stages[i], F.col("at")).alias(c)
        new = changes.select("key", *[stage(int(c.partition("_")[2]), c) for c in columns])
        extreme = [(F.min if c.startswith("first") else F.max)(c).alias(c) for c in columns]
        return known.unionByName(new).groupBy("key").agg(*extreme), _none(changes)

    return Snapshots(store, "key", shape, T.StructType.fromDDL("key string, event_type string, at timestamp"), fold, buckets=buckets, ordered=False)


def lifecycle_violations(spark: SparkSession, kept: Snapshots, stages: Sequence[str] = tuple(v.LIFECYCLE), batch: int | None = None) -> DataFrame:
    """``changes.lifecycle_violations`` of what was kept, of all keys or of those that ``batch`` touched."""
    buckets = None if batch is None else [b for b, n in kept.version(spark, batch)[0].items() if n == batch]
    return U.broken_order(kept.rows(spark, batch, buckets), stages)


def first_places(store: str, order: Sequence[tuple[str, str]], key: str = "submission_id", kind: str = "long", delay_ms: int = 0,
                 keep_ms: int | None = None, buckets: int = BUCKETS) -> Snapshots:
    """The first submission of each id; every later one is refused as a conflict.

    ``order`` names and types the columns that tell the rows of an id apart after the time ``at``. With ``keep_ms`` a
    bucket forgets ids whose first submission lies that long before its newest change; a submission of such an id is
    then a first one again.
    """
    place = F.struct("at", *[c for c, _ in order])
    shape = T.StructType.fromDDL(", ".join([f"{key} {kind}", "at timestamp", *[f"{c} {k}" for c, k in order]]))

    def fold(known: DataFrame, changes: DataFrame) -> tuple[DataFrame, DataFrame]:
        first = known.unionByName(changes.select(*known.columns)).groupBy(key).agg(F.min(place).alias("_first"))
        conflicts = join_lookup(changes, first, key).filter(place > F.col("_first")).drop("_first")
        rows = first.select(key, "_first.*")
        if keep_ms is not None:
            newest = changes.agg(F.max("at")).scalar()
            rows = rows.filter(F.col("at") >= newest - F.make_dt_interval(secs=F.lit(keep_ms / 1000)))
        return rows, conflicts.withColumn("reason", F.lit("submitted before"))

    return Snapshots(store, key, shape, shape, fold, delay_ms, buckets)


def per_day(rows: DataFrame, day: Column | str, path: str) -> None:
    """Writes counted rows of one or more days; a day written again replaces its rows and no other day is touched."""
    at = F.col(day) if isinstance(day, str) else day
    out = rows.withColumn("day", at).repartition("day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    out.partitionBy("day").parquet(path)


def add_upload_days(upload_log: DataFrame, by: str, path: str) -> None:
    """Exact histograms of upload milliseconds per day of ``started_ms`` and group: a row per duration that occurs."""
    name = F.struct(F.col(by).alias("name")).alias("of")
    took = (F.col("finished_ms") - F.col("started_ms")).alias("at")
    day = F.to_date(F.timestamp_millis("started_ms")).alias("of_day")
    counts = upload_log.select(name, took, day).groupBy("of", "at", "of_day").agg(F.count(F.lit(1)).alias("n"))
    per_day(counts.withColumnRenamed("of_day", "day"), "day", path)


def add_size_days(files: DataFrame, by: str, path: str, size: str = "size", at: str = "at") -> None:
    """Total size and file count per entry and day."""
    day = F.to_date(at).alias("day")
    per_day(files.groupBy(F.col(by).alias("entry"), day).agg(F.sum(size).alias("total"), F.count(F.lit(1)).alias("files")), "day", path)


def days(spark: SparkSession, path: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """The stored rows of some days; partitions of others are not read."""
    rows = spark.read.parquet(path)
    if first:
        rows = rows.filter(F.col("day") >= F.lit(first).cast("date"))
    return rows.filter(F.col("day") <= F.lit(last).cast("date")) if last else rows
