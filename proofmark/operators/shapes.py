"""Values of unknown shape: JSON as VARIANT, typed by what is asked for, and a report of how it differs.

``parse_json`` of ``messages`` knows its schema beforehand: a value with a field of another type is corrupt as a whole.
Here a value is kept as it is. ``typed`` gives the expected fields, null where one is missing or of another type;
``drift`` tells, path by path, which fields came that nobody expects, which are missing, and which changed their type.
Only values that are no JSON go to quarantine.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from proofmark.operators.messages import CORRUPT

# Kinds of JSON values that an expected type accepts.
KINDS = {"string": "STRING", "long": "BIGINT", "int": "BIGINT", "boolean": "BOOLEAN", "double": "DOUBLE", "object": "OBJECT", "array": "ARRAY"}
ADDED, MISSING, RETYPED = "added", "missing", "retyped"


def parse_variant(raw: DataFrame, value: str = "value") -> DataFrame:
    """``entity`` as VARIANT; ``_corrupt`` has the text of a value that is no JSON object, for ``split_quarantine``."""
    text = F.col(value).cast("string")
    parsed = F.try_parse_json(text)
    whole = F.schema_of_variant(parsed).startswith("OBJECT")
    return raw.withColumn("entity", F.when(whole, parsed)).withColumn(CORRUPT, F.when(F.col("entity").isNull(), text))


def typed(df: DataFrame, expected: Mapping[str, str], entity: str = "entity") -> DataFrame:
    """A column per expected path (``a.b`` becomes ``a_b``); null if it is missing or does not fit its type."""
    read = {p.replace(".", "_"): F.try_variant_get(entity, f"$.{p}", "string" if t in ("object", "array") else t) for p, t in expected.items()}
    fits = {p.replace(".", "_"): _kind(F.try_variant_get(entity, f"$.{p}", "variant")) == KINDS[t] for p, t in expected.items()}
    return df.withColumns({c: F.when(fits[c], read[c]) for c in read})


def _kind(value):
    """STRING, BIGINT, OBJECT, …; decimals count as doubles, a JSON null is VOID."""
    kind = F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)
    return F.when(kind.isin("DECIMAL", "FLOAT"), "DOUBLE").otherwise(kind)


def paths(df: DataFrame, entity: str = "entity", depth: int = 2) -> DataFrame:
    """``(path, kind)`` of every field of every value, objects opened up to ``depth`` levels; one row per field."""
    level = df.select(F.lit("").alias("prefix"), F.col(entity).alias("v")).filter("v IS NOT NULL")
    found = None
    for _ in range(depth):
        level.createOrReplaceTempView("_shape_level")
        opened = df.sparkSession.sql("SELECT prefix, f.key, f.value FROM _shape_level, LATERAL variant_explode(v) AS f WHERE f.key IS NOT NULL")
        fields = opened.select(F.concat("prefix", "key").alias("path"), _kind(F.col("value")).alias("kind"), "value")
        found = fields.select("path", "kind") if found is None else found.unionByName(fields.select("path", "kind"))
        level = fields.filter("kind = 'OBJECT'").select(F.concat("path", F.lit(".")).alias("prefix"), F.col("value").alias("v"))
    return found


def drift(df: DataFrame, expected: Mapping[str, str], entity: str = "entity", depth: int = 2) -> DataFrame:
    """``(path, change, expected, found, n)``: how many values differ from the expected fields, and how.

    The fields are counted per path and kind map-side, so the report costs one small shuffle whatever the values.
    """
    rows = [(p, KINDS[t]) for p, t in expected.items()]
    wanted = df.sparkSession.createDataFrame(rows, "path string, expected string")
    seen = paths(df, entity, depth).groupBy("path", "kind").agg(F.count(F.lit(1)).alias("n"))
    whole = df.filter(F.col(entity).isNotNull()).agg(F.count(F.lit(1)).alias("values"))
    told = seen.join(F.broadcast(wanted), "path", "left")  # one row per expected field
    change = F.when(F.col("expected").isNull(), ADDED).when(F.col("kind") != F.col("expected"), RETYPED)
    other = told.withColumn("change", change).filter("change IS NOT NULL").select("path", "change", "expected", F.col("kind").alias("found"), "n")
    there = seen.groupBy("path").agg(F.sum("n").alias("there"))
    absent = (
        wanted.join(there, "path", "left")
        .crossJoin(whole)  # one row
        .withColumn("n", F.col("values") - F.coalesce("there", F.lit(0)))
        .filter("n > 0")
        .select("path", F.lit(MISSING).alias("change"), "expected", F.lit(None).cast("string").alias("found"), "n")
    )
    return other.unionByName(absent)
