"""Tables between the steps of an operator that reads them more than once, or in a loop."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from proofmark.session import shared_dir


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read back: its plan ends there, and lost executors lose nothing."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/proofmark/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
