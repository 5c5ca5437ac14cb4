"""What the operators of this subpackage share: written tables, wrapped rows, words and running totals."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Sequence
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from proofmark.session import shared_dir

# Words are what these separate: space and the five ASCII controls from tab to carriage return.
SPACE = r"[\x20\x09-\x0D]+"

# A table of at most so many rows may be broadcast or brought to the driver; its size is counted first.
SMALL_ROWS = 50_000

BATCH_BYTES = 4 << 20

_held: list[list[str]] = []


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read back: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/proofmark-llm/{name}-{uuid.uuid4().hex}"
    if _held:
        _held[-1].append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def holding(paths: list[str]):
    """Note the tables written inside in ``paths``, for ``release``; tables written elsewhere stay."""
    _held.append(paths)
    try:
        yield
    finally:
        _held.pop()


def release(spark: SparkSession, paths: list[str]) -> None:
    """Delete tables whose readers have stored their results."""
    while paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(paths.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def small(df: DataFrame, limit: int = SMALL_ROWS) -> bool:
    """Whether a written table has at most ``limit`` rows."""
    return df.count() <= limit


def maybe_broadcast(df: DataFrame, limit: int = SMALL_ROWS) -> DataFrame:
    """A written table, marked for broadcast if it is counted to be small; else the join stays a shuffle join."""
    return F.broadcast(df) if small(df, limit) else df


def rowed(df: DataFrame) -> DataFrame:
    """All columns as one struct ``_row``, so that no input column can clash with the operator's own."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"))


def unrowed(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The input columns again."""
    return df.select(*[F.col("_row").getField(c).alias(c) for c in columns])


def row_key(doc_id: str | Column, text: str | Column) -> Column:
    """A key of a row's content: rows that repeat both id and text share it."""
    return F.xxhash64(F.lit(1), doc_id, F.lit(2), text)


def by_arrow(
    df: DataFrame, fn: Callable[[Iterable[pa.RecordBatch]], Iterable[pa.RecordBatch]], schema: str | T.StructType
) -> DataFrame:
    """``mapInArrow`` in batches of at most ``BATCH_BYTES``, whatever the rows' sizes; ``fn`` keeps no more than one.

    The bound is Spark's own setting; a caller's value stays. The JVM and the Python worker both hold a batch.
    """
    bound = "spark.sql.execution.arrow.maxBytesPerBatch"
    if df.sparkSession.conf.get(bound, None) is None:
        df.sparkSession.conf.set(bound, str(BATCH_BYTES))
    return df.mapInArrow(fn, schema)


def by_bytes(batch: pa.RecordBatch, column: int, limit: int = 4 << 20) -> Iterable[pa.RecordBatch]:
    """The rows of a batch in parts of about ``limit`` bytes of a string column, one row at least."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    low = 0
    while low < batch.num_rows:
        high = max(low + 1, int(np.searchsorted(ends, (ends[low - 1] if low else 0) + limit, "right")))
        yield batch.slice(low, high - low)
        low = high


def running_total(df: DataFrame, group: str, order: str, tie: Sequence[str], value: str, out: str) -> DataFrame:
    """``out``: the sum of ``value`` over the rows of the same ``group`` before this one, in ascending ``order``.

    ``order`` is a double in [0, 1) that spreads evenly (a hash). A group of any share is cut into cells of a few
    hundred rows by it, cells into spans, so that no window holds more than such a part of a group.
    ``df`` must be a written table or cheap, as it is read three times.
    """
    cells = max(1, df.count() // 256)
    cut = df.withColumn("_cell", F.floor(F.col(order) * cells).cast("long")).withColumn(
        "_span", F.floor(F.col("_cell") / 1024).cast("long")
    )
    total = F.sum(value)
    per_cell = cut.groupBy(group, "_span", "_cell").agg(total.alias("_sum"))
    per_span = per_cell.groupBy(group, "_span").agg(F.sum("_sum").alias("_sum"))
    before = lambda w: F.coalesce(F.sum("_sum").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    spans = per_span.select(
        F.col(group).alias("_g"), F.col("_span").alias("_s"),
        before(Window.partitionBy(group).orderBy("_span")).alias("_in_group"),
    )
    starts = (
        per_cell.withColumn("_in_span", before(Window.partitionBy(group, "_span").orderBy("_cell")))
        .join(spans, F.col(group).eqNullSafe(F.col("_g")) & (F.col("_span") == F.col("_s")))
        .select(F.col(group).alias("_cg"), F.col("_cell").alias("_cc"), (F.col("_in_group") + F.col("_in_span")).alias("_start"))
    )
    inside = Window.partitionBy(group, "_cell").orderBy(order, *tie).rowsBetween(Window.unboundedPreceding, -1)
    return (
        cut.withColumn("_inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
        .join(starts, F.col(group).eqNullSafe(F.col("_cg")) & (F.col("_cell") == F.col("_cc")))
        .withColumn(out, F.col("_start") + F.col("_inside"))
        .drop("_cell", "_span", "_inside", "_cg", "_cc", "_start")
    )


def unit(*columns: str | Column) -> Column:
    """A hash of the columns as a double in [0, 1)."""
    return F.shiftrightunsigned(F.xxhash64(*columns), 11) / F.lit(float(1 << 53))
