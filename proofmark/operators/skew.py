"""Lookup joins whose hot keys adaptive execution can split.

The adaptive skew join splits a hot key's partition only where both sides of the join are plain shuffles and nothing
above relies on their partitioning. A lookup side that was grouped by the join key is no plain shuffle, as it keeps
the grouping's partitioning, and a grouping by the key after the join does rely on it. Joining by the key and its
hash gives both: neither partitioning fits the other any more, so Spark shuffles the small lookup once again for the
join, and the rows once again for a grouping after it. The rows of a key are never counted and there is no limit
below which a key stays whole but Spark's own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_lookup(df: DataFrame, lookup: DataFrame, on: str | Sequence[str], how: str = "left") -> DataFrame:
    """``df`` joined with a lookup of one row per key; any number of rows of ``df`` may share a key."""
    on = [on] if isinstance(on, str) else list(on)
    spread = F.hash(*on).alias("_spread")
    return df.select("*", spread).join(lookup.select("*", spread), [*on, "_spread"], how).drop("_spread")
