"""Connected components of a table of links, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from proofmark.llm.common import written


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """One row (node, component) per node that has a link; ``component`` is the smallest node reachable.

    Each round points every node at its smallest neighbour, follows the pointers to their roots by doubling, and
    keeps only links between different roots, so the roots at least halve. The rounds' tables are written, which
    cuts the lineage and leaves each join two plain shuffles that adaptive execution can split at a hot root.
    """
    links = written(
        links.filter(F.col(a) != F.col(b)).select(F.least(a, b).alias("u"), F.greatest(a, b).alias("v")).distinct(),
        "links",
    )
    rounds = []
    while not links.isEmpty():
        ends = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        roots = written(
            ends.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("v")).select("node", F.least("node", "v").alias("root")),
            "roots",
        )
        moved = True
        while moved:
            up = roots.select(F.col("node").alias("at"), F.col("root").alias("next"))
            jumped = written(
                roots.join(up, F.col("root") == F.col("at")).select("node", F.col("next").alias("root"), (F.col("next") < F.col("root")).alias("moved")),
                "roots",
            )
            moved = not jumped.filter("moved").isEmpty()
            roots = jumped.drop("moved")
        rounds.append(roots)
        left = roots.select(F.col("node").alias("u"), F.col("root").alias("ru"))
        right = roots.select(F.col("node").alias("v"), F.col("root").alias("rv"))
        links = written(
            links.join(left, "u").join(right, "v").filter("ru != rv")
            .select(F.least("ru", "rv").alias("u"), F.greatest("ru", "rv").alias("v")).distinct(),
            "links",
        )
    if not rounds:
        return links.select(F.col("u").alias("node"), F.col("v").alias("component"))
    out = rounds[0].select("node", F.col("root").alias("component"))
    for later in rounds[1:]:
        up = later.select(F.col("node").alias("at"), F.col("root").alias("next"))
        out = out.join(up, F.col("component") == F.col("at"), "left").select(
            "node", F.coalesce("next", "component").alias("component")
        )
    return written(out, "components")
