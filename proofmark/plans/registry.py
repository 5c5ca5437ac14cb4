"""Named queries over the driver's tables, each with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function name."""

    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            SQL[fn.__name__] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table, with its zone-less timestamps read as instants."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    zoneless = {f.name for f in df.schema if f.dataType.typeName() == "timestamp_ntz"}
    return df.select(*[F.col(c).cast("timestamp").alias(c) if c in zoneless else F.col(c) for c in df.columns])


def plain(df: DataFrame) -> DataFrame:
    """Timestamps without zone, as the given tables have them."""
    return df.select(
        *[
            F.col(f.name).cast("timestamp_ntz").alias(f.name)
            if f.dataType.typeName() == "timestamp"
            else F.col(f.name)
            for f in df.schema
        ]
    )


def cents(amount: Column | str) -> Column:
    """A two-decimal amount as a whole number, so that sums do not depend on their order."""
    c = F.col(amount) if isinstance(amount, str) else amount
    return F.round(c * 100).cast("long")
