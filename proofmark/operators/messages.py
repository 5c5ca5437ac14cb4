"""Transformations of keyed messages; all of them hold for batch and for streams."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from proofmark import schemas

CORRUPT = "_corrupt"


def parse_json(df: DataFrame, schema: str = schemas.ARCHIVE_ENTITY_JSON, value: str = "value") -> DataFrame:
    """``entity`` parsed from a JSON value; ``_corrupt`` holds the text of a value that does not parse.

    A value of the wrong type counts as corrupt too.
    """
    typed = f"{schema}, {CORRUPT} string"
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parsed = df.withColumn("entity", F.from_json(F.col(value).cast("string"), typed, options))
    unread = F.col(value).isNotNull() & F.col("entity").isNull()
    return parsed.withColumn(
        CORRUPT, F.when(unread, F.col(value).cast("string")).otherwise(F.col(f"entity.{CORRUPT}"))
    ).withColumn("entity", F.col("entity").dropFields(CORRUPT))


def parse_entities(raw: DataFrame) -> DataFrame:
    """Archive entities of raw messages, corrupt ones kept with their text."""
    return with_event_time(parse_json(raw)).select(
        "topic",
        "key",
        "entity.id",
        "entity.title",
        "entity.theme",
        F.col("entity.timesaved").alias("time_saved"),
        "ts",
        "offset",
        "value",
        CORRUPT,
    )


def split_quarantine(df: DataFrame, corrupt: Column | str = CORRUPT) -> tuple[DataFrame, DataFrame]:
    """``(good, quarantine)``: undecodable rows go aside with an error and never stop the others."""
    c = F.col(corrupt) if isinstance(corrupt, str) else corrupt
    bad = c.isNotNull()
    good = df.filter(~bad)
    if isinstance(corrupt, str):
        good = good.drop(corrupt)
    quarantine = df.filter(bad).select(
        *[x for x in ("topic", "key", "value") if x in df.columns],
        F.lit("value does not parse").alias("error"),
        *[x for x in ("ts",) if x in df.columns],
    )
    return good, quarantine


def with_event_time(raw: DataFrame) -> DataFrame:
    """The record's own timestamp as ``ts``; the key is text."""
    return raw.withColumn("key", F.col("key").cast("string")).withColumnRenamed("timestamp", "ts")


def observed(df: DataFrame, name: str, *metrics: Column) -> DataFrame:
    """Counts what passes, without printing rows; read it from an observation or a query listener."""
    return df.observe(name, F.count(F.lit(1)).alias("rows"), F.max("ts").alias("latest"), *metrics)


def as_messages(
    df: DataFrame,
    topic: str,
    event_type: Column | None = None,
    calls: Column | None = None,
    value: Column | None = None,
    offset: Column | None = None,
) -> DataFrame:
    """A decoded topic in the shape of the common history."""

    def or_null(c, kind):
        return (F.lit(None) if c is None else c).cast(kind)

    text = value if value is not None else event_type if event_type is not None else calls
    place = offset if offset is not None else F.col("offset") if "offset" in df.columns else F.lit(0)
    return df.select(
        F.lit(topic).alias("topic"),
        "key",
        or_null(event_type, "string").alias("event_type"),
        or_null(calls, "int").alias("calls"),
        or_null(text, "string").alias("value"),
        "ts",
        place.cast("long").alias("offset"),
    )


def all_messages(*topics: DataFrame) -> DataFrame:
    """The topics side by side, as one keyed history."""
    return reduce(DataFrame.unionByName, topics)
