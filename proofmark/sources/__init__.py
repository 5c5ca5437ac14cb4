"""Sources of topics and tables, and the sinks that publish them.

A topic comes from Kafka, or from files that hold the same raw columns (a replay); both decode alike and
both work as a batch and as a stream.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from proofmark import schemas
from proofmark import values as v
from proofmark.functions.columns import int32, without_schema_id
from proofmark.operators import messages as M


@dataclass(frozen=True)
class Source:
    """Where a topic is read from. ``decoded`` files already have the columns of the typed table."""

    format: str = "parquet"
    path: str | None = None
    options: Mapping[str, str] = field(default_factory=dict)
    streaming: bool = False
    decoded: bool = False


def kafka(servers: str, topic: str, streaming: bool = True, **options: str) -> Source:
    """A Kafka topic from its first offset; security options pass through as given."""
    given = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": "earliest"}
    return Source("kafka", None, {**given, "includeHeaders": "true", **options}, streaming)


def load(spark: SparkSession, src: Source, schema: str) -> DataFrame:
    reader = (spark.readStream if src.streaming else spark.read).format(src.format).options(**src.options)
    if src.format != "kafka":
        reader = reader.schema(schema)
    return reader.load(src.path) if src.path else reader.load()


def raw_messages(spark: SparkSession, src: Source) -> DataFrame:
    return load(spark, src, schemas.RAW_MESSAGES)


def _avro(value: Column, schema: str) -> Column:
    from pyspark.sql.avro.functions import from_avro  # needs the spark-avro package on the class path

    return from_avro(without_schema_id(value), schema, {"mode": "PERMISSIVE"})


def read_processing_events(spark: SparkSession, src: Source, avro_schema: str | None = None) -> DataFrame:
    if src.decoded:
        return load(spark, src, schemas.PROCESSING_EVENTS)
    event = M.with_event_time(raw_messages(spark, src)).withColumn("event", _avro(F.col("value"), avro_schema))
    return event.select("topic", "key", F.col("event.type").cast("string").alias("event_type"), "ts", "offset")


def read_archive_entities(spark: SparkSession, src: Source) -> DataFrame:
    """Entities with their corrupt rows marked; ``split_quarantine`` parts them."""
    return load(spark, src, schemas.ARCHIVE_ENTITIES) if src.decoded else M.parse_entities(raw_messages(spark, src))


def decode_calls(raw: DataFrame) -> DataFrame:
    """Call counts from four-byte values; a value of another length is marked corrupt."""
    sized = F.length("value") == 4
    return M.with_event_time(raw).select(
        "topic",
        "key",
        F.when(sized, int32(F.col("value"))).alias("calls"),
        "ts",
        "offset",
        "value",
        F.when(~F.coalesce(sized, F.lit(False)), F.coalesce(F.hex("value"), F.lit(""))).alias(M.CORRUPT),
    )


def read_archive_calls(spark: SparkSession, src: Source) -> DataFrame:
    return load(spark, src, schemas.ARCHIVE_CALLS) if src.decoded else decode_calls(raw_messages(spark, src))


def read_archive_feedback(spark: SparkSession, src: Source) -> DataFrame:
    if src.decoded:
        return load(spark, src, schemas.ARCHIVE_FEEDBACK)
    raw = M.with_event_time(raw_messages(spark, src))
    return raw.select("topic", "key", F.col("value").cast("string").alias("message"), "ts", "offset")


def read_submission_metrics(spark: SparkSession, src: Source, avro_schema: str) -> DataFrame:
    """Metrics stay one opaque struct in the schema the user gives."""
    raw = M.with_event_time(raw_messages(spark, src))
    return raw.select("topic", "key", _avro(F.col("value"), avro_schema).alias("raw"), "ts", "offset")


def read_archive_status(spark: SparkSession, src: Source) -> DataFrame:
    """The archive status per application, as a table instead of one call per id."""
    return load(spark, src, schemas.STATUS_HISTORY)


def read_payload_catalogue(spark: SparkSession, path: str) -> DataFrame:
    """Payload files by size; their content is never read."""
    return spark.read.format("binaryFile").load(path).select("path", F.col("length").alias("size"))


def read_form_catalogue(spark: SparkSession, path: str, format: str = "parquet", **options: str) -> DataFrame:
    """The user's form catalogue: ``position`` (0, 1, …), ``form_no``, ``theme``, ``title``."""
    schema = f"position long, {schemas.FORM_CATALOGUE}"
    return spark.read.format(format).schema(schema).options(**options).load(path)


def attachment_catalogue(spark: SparkSession) -> DataFrame:
    """The five catalogue attachments in their order."""
    rows = [(i, code, title) for i, (code, title) in enumerate(v.ATTACHMENT_CATALOGUE)]
    return spark.createDataFrame(rows, "position long, code string, attachment_title string")
