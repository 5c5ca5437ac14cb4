"""Data checks; each returns the rows that break a rule."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from proofmark import values as v
from proofmark.operators.skew import join_lookup


def conflicts(df: DataFrame, order: Sequence[str], key: str = "submission_id") -> DataFrame:
    """Every submission after the first one of its id; ``order`` tells the rows of an id apart.

    The first one is a map-side combined minimum. Only ids that repeat are joined back, so nothing is
    ranked inside a hot id.
    """
    place = F.struct(*order)
    repeated = df.groupBy(key).agg(F.min(place).alias("_first"), F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    return join_lookup(df, repeated, key, "inner").filter(place > F.col("_first")).drop("_first", "_n")


def main_document_violations(df: DataFrame) -> DataFrame:
    """Submissions with more than one main document."""
    mains = F.size(F.filter("documents", lambda d: d["is_main"]))
    return df.withColumn("main_documents", mains).filter(F.col("main_documents") > 1)


def missing_required(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Rows that lack a required field, with the names of those they lack; one pass for all fields."""
    names = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in required]))
    return df.withColumn("missing", names).filter(F.size("missing") > 0)


def bad_enum_values(df: DataFrame, allowed: Mapping[str, Sequence[str]]) -> DataFrame:
    """Rows with a value outside its list, with the names of these columns; one pass, null is no value."""
    names = F.array_compact(
        F.array(*[F.when(~F.col(c).isin(*values), F.lit(c)) for c, values in allowed.items()])
    )
    return df.withColumn("bad", names).filter(F.size("bad") > 0)


def bad_person_ids(df: DataFrame, column: str = "person_id") -> DataFrame:
    """Rows whose person id is not eleven digits; a missing id is one of them."""
    return df.filter(~F.coalesce(F.col(column).rlike(v.PERSON_ID_PATTERN), F.lit(False)))


def severity(status: Column) -> Column:
    return F.array_position(F.array(*[F.lit(s) for s in v.SERVICE_STATUSES]), status)


def worst_status(health: DataFrame, by: Sequence[str] = ("run_id",)) -> DataFrame:
    """The worst status over the services: OK < ISSUE < DOWN."""
    worst = F.max(severity(F.col("status")))
    return health.groupBy(*by).agg(
        F.element_at(F.array(*[F.lit(s) for s in v.SERVICE_STATUSES]), worst.cast("int")).alias("status")
    )
