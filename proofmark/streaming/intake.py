"""Intake of a stream: good rows to one table, undecodable ones to quarantine, no row stops another."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from proofmark.operators import messages as M


def start(raw: DataFrame, store: str, schema: str, interval: str | None = None) -> StreamingQuery:
    """Parses JSON values of raw messages into ``store/good`` and ``store/quarantine``.

    One pass writes both: the rows are parsed once and partitioned by where they go. A repeated batch
    replaces its own rows.
    """
    parsed = M.observed(M.parse_json(M.with_event_time(raw), schema), "intake")
    fate = F.when(F.col(M.CORRUPT).isNull(), "good").otherwise("quarantine")

    def step(batch: DataFrame, batch_id: int) -> None:
        # A value that does not parse stays as it came: its bytes need not be text.
        corrupt = F.when(F.col(M.CORRUPT).isNotNull(), F.col("value").cast("binary"))
        rows = batch.select(
            "topic", "key", "entity", "ts", corrupt.alias("corrupt"), fate.alias("fate"),
            F.lit(batch_id).cast("long").alias("batch"),
        )
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("fate", "batch").parquet(
            f"{store}/rows"
        )

    writer = parsed.writeStream.foreachBatch(step).option("checkpointLocation", f"{store}/checkpoint")
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.start()


def rows(spark, store: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """``(good, quarantine)`` as read back from the store."""
    shape = T.StructType.fromDDL("topic string, key string, ts timestamp, corrupt binary, fate string, batch long")
    df = spark.read.schema(shape.add("entity", T.StructType.fromDDL(schema))).parquet(f"{store}/rows")
    good = df.filter("fate = 'good'").select("topic", "key", "entity", "ts")
    bad = df.filter("fate = 'quarantine'").select(
        "topic", "key", F.col("corrupt").alias("value"), F.lit("value does not parse").alias("error"), "ts"
    )
    return good, bad

