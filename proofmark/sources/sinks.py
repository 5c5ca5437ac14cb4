"""Publishing: messages with a stable id, to Kafka or to files, and gauge tables."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from proofmark.functions.columns import stable_uuid

MESSAGE_ID = "MESSAGE_ID"


@dataclass(frozen=True)
class Sink:
    """Where messages go. For files ``path`` is the target, for Kafka ``options`` name servers and topic."""

    format: str = "parquet"
    path: str | None = None
    options: Mapping[str, str] = field(default_factory=dict)
    mode: str = "append"


def kafka_sink(servers: str, topic: str, **options: str) -> Sink:
    """A Kafka topic; a send that takes more than a second fails, and Spark retries the task."""
    given = {"kafka.bootstrap.servers": servers, "topic": topic, "kafka.max.block.ms": "1000"}
    return Sink("kafka", None, {**given, **options})


def with_message_id(df: DataFrame) -> DataFrame:
    """Adds the header ``MESSAGE_ID`` after the caller's own headers.

    The id comes from key and value, so that a retried task or a replayed batch repeats it and readers can
    drop the second copy.
    """
    id = stable_uuid(F.col("key"), F.hex(F.col("value").cast("binary")))
    stamp = F.struct(F.lit(MESSAGE_ID).alias("key"), id.cast("binary").alias("value"))
    none = F.array().cast("array<struct<key:string,value:binary>>")
    own = F.coalesce(F.col("headers"), none) if "headers" in df.columns else none
    return df.withColumn("headers", F.array_append(own, stamp))


def publish(df: DataFrame, sink: Sink, dry_run: bool = False) -> DataFrame:
    """Writes ``key, value, headers``; a dry run prepares the same rows and writes nothing."""
    ready = with_message_id(df).select("key", "value", "headers")
    if not dry_run:
        writer = ready.write.format(sink.format).options(**sink.options).mode(sink.mode)
        if sink.path:
            writer.save(sink.path)
        else:
            writer.save()
    return ready


def publish_stream(df: DataFrame, sink: Sink, checkpoint: str, interval: str = "1 second"):
    """Starts a query that publishes a stream; offsets live in the checkpoint, one commit per interval."""
    writer = (
        with_message_id(df)
        .select("key", "value", "headers")
        .writeStream.format(sink.format)
        .options(**sink.options)
        .option("checkpointLocation", checkpoint)
        .trigger(processingTime=interval)
    )
    return writer.start(sink.path) if sink.path else writer.start()


def _encoded(value: Column, avro_schema: str | None) -> Column:
    if avro_schema is None:
        return F.to_json(value).cast("binary")
    from pyspark.sql.avro.functions import to_avro  # needs the spark-avro package on the class path

    return to_avro(value, avro_schema)


def write_submissions(df: DataFrame, sink: Sink, dry_run: bool = False, avro_schema: str | None = None) -> DataFrame:
    """Submissions keyed by their id; JSON unless an Avro schema is given."""
    value = _encoded(F.struct(*df.columns), avro_schema)
    return publish(df.select(F.col("submission_id").alias("key"), value.alias("value")), sink, dry_run)


def write_processing_events(
    df: DataFrame, sink: Sink, dry_run: bool = False, avro_schema: str | None = None
) -> DataFrame:
    value = _encoded(F.struct(F.col("event_type").alias("type")), avro_schema)
    return publish(df.select("key", value.alias("value")), sink, dry_run)


def write_notifications(df: DataFrame, sink: Sink, dry_run: bool = False) -> DataFrame:
    """New and done notifications keyed by their submission."""
    value = _encoded(F.struct(*df.columns), None)
    return publish(df.select(F.col("submission_id").alias("key"), value.alias("value")), sink, dry_run)


def write_raw(df: DataFrame, sink: Sink, dry_run: bool = False) -> DataFrame:
    """Text values as they are, past any schema."""
    return publish(df.select("key", F.col("value").cast("binary").alias("value")), sink, dry_run)


def write_gauges(gauges: DataFrame, path: str) -> None:
    """Writes the gauges of one or more runs to a table partitioned by run; a run written again replaces its rows."""
    rows = gauges.repartition("run_id").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    rows.partitionBy("run_id").parquet(path)
