"""A training corpus from raw documents: quality rules, near duplicates, secrets, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and reread as the next
one's documents. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from proofmark.llm import entropy_secrets, host_rules, mixing, packing, simhash_trees
from proofmark.llm.common import holding, release, written


_tables: list[str] = []


def stage(fn):
    """A stage frees the tables of the one before, whose result is stored by then."""

    @wraps(fn)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        release(spark, _tables)
        with holding(_tables):
            return fn(docs)

    return run


@stage
def quality(docs):
    """Documents that the rules, base or host, reject go."""
    return host_rules.keep(docs)


@stage
def near_duplicates(docs):
    """One document of each group of linked fingerprints stays."""
    return simhash_trees.keep(docs)


@stage
def secrets(docs):
    """Secrets are masked in the texts, with all of a run that a fixed pattern knows in part."""
    return entropy_secrets.redact(docs)


@stage
def mixture(docs):
    """Documents as often as the mix takes them, the last of a source cut at its target."""
    return mixing.mix(docs)


@stage
def packed(docs):
    """Pieces of the packed sequences."""
    return packing.pack(docs)


STAGES = [
    ("quality rules", quality),
    ("SimHash near-dedup", near_duplicates),
    ("secret scans", secrets),
    ("mixing sources", mixture),
    ("packing", packed),
]

# Fingerprints and tokens are beyond SQL; tests/llm/test_pipeline.py has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, step) in enumerate(STAGES[:-1]):
        docs = written(step(spark, docs, sf_dir), f"stage-{k + 1}")
    return STAGES[-1][1](spark, docs, sf_dir)
