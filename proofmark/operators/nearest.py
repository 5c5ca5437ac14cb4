"""Ordered lookups that survive hot keys: nearest fact, running extreme, running count.

A plain keyed join of points with facts emits every pair of a key, and a plain window puts a whole key
into one task. Both break when one key holds a third of the rows. Here a hot key's time line is cut into
slots of fixed width:

1. facts and points are reduced to one row per (key, slot, time), combined map-side, so a slot never
   holds more rows than it has distinct times, whatever the volume;
2. a window inside (key, slot) answers from the slot itself;
3. one row per (key, slot) is carried along the key, which is bounded by the time span.

In ``nearest`` a key with few times is one slot, so it has nothing to carry. Which keys have many is told by every
``SAMPLE``-th of their times, by hash; a key taken for the other sort gets the same answers.

Every fact and point is shuffled a constant number of times; no pairs are formed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


# A key with about as many distinct times is hot; of more than HOT_KEYS such keys, those with the most are. The others
# have less than a thousandth of all times each.
HOT, HOT_KEYS, SAMPLE = 1 << 18, 1000, 1 << 8


def _with_hot(line: DataFrame, by: Sequence[str]) -> DataFrame:
    """Adds whether a row's key is hot. The few hot keys are joined by hash; as their number is limited they are broadcast."""
    sampled = line.filter(F.pmod(F.xxhash64(*by, "at"), F.lit(SAMPLE)) == 0).select(*by, "at").distinct()
    counts = sampled.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= HOT // SAMPLE)
    most = counts.orderBy(F.desc("n")).limit(HOT_KEYS).select(F.xxhash64(*by).alias("_hash"), F.lit(True).alias("_hot")).distinct()
    return line.withColumn("_hash", F.xxhash64(*by)).join(F.broadcast(most), "_hash", "left").withColumn("hot", F.col("_hot").isNotNull()).drop("_hash", "_hot")


def slot_of(at: Column, width: int | None) -> Column:
    """Start of the slot that ``at`` lies in; one single slot when no width is given."""
    return F.lit(0).cast("long") if width is None else at - F.pmod(at, F.lit(width).cast("long"))


def nearest(
    points: DataFrame,
    facts: DataFrame,
    by: Sequence[str],
    width: int | None,
    forward: bool = True,
    backward: bool = True,
    measures: Sequence[str] = ("measure",),
    sampled: bool = True,
) -> DataFrame:
    """For each distinct point ``(*by, at)`` the extreme ``measure`` among the facts around it.

    ``next`` is the least measure of facts with ``fact.at >= at``, ``last`` the greatest of facts with
    ``fact.at <= at``. With a measure that starts with ``at`` these are the nearest facts; with another
    measure they are running extremes. Several measures give ``next_<name>`` and ``last_<name>`` each, from
    the same shuffles; a null measure says nothing. ``at`` is a long (or int) on both sides, ``by`` must not
    be null. Telling hot keys reads facts and points once more; without ``sampled`` all keys lie in slots.
    """
    by = list(by)
    keys = [*by, "slot"]
    at = F.col("at").cast("long")
    place = [*by, at.alias("at")]
    suffix = {m: "" if m == "measure" else f"_{m}" for m in measures}

    def columns(forward_column, backward_column):
        return [
            *([forward_column(x) for x in suffix.items()] if forward else []),
            *([backward_column(x) for x in suffix.items()] if backward else []),
        ]

    both = facts.select(*place, *measures, F.lit(False).alias("is_point")).unionByName(
        points.select(*place, F.lit(True).alias("is_point")), allowMissingColumns=True
    )
    told = width is not None and sampled
    line = (
        (_with_hot(both, by) if told else both.withColumn("hot", F.lit(width is not None)))
        .withColumn("slot", F.when(F.col("hot"), slot_of(at, width)).otherwise(F.lit(0)))
        .groupBy(*keys, "at")
        # The flags first, as both readers below take them first: equal plans share one shuffle. As an aggregate, the
        # filter by "hot" stays above it.
        .agg(
            F.max("hot").alias("hot"),
            F.max("is_point").alias("is_point"),
            *columns(lambda x: F.min(x[0]).alias(f"lo{x[1]}"), lambda x: F.max(x[0]).alias(f"hi{x[1]}")),
        )
    )

    def running(part, time, to, next_name, last_name):
        window = Window.partitionBy(*part).rowsBetween(Window.unboundedPreceding, to)
        down, up = window.orderBy(F.desc(time)), window.orderBy(F.asc(time))
        return columns(
            lambda x: F.min(f"lo{x[1]}").over(down).alias(f"{next_name}{x[1]}"),
            lambda x: F.max(f"hi{x[1]}").over(up).alias(f"{last_name}{x[1]}"),
        )

    answers = running(keys, "at", Window.currentRow, "next", "last")
    found = line.select(*keys, "at", "hot", "is_point", *answers).filter("is_point")
    if width is None:
        return found.drop("slot", "hot", "is_point")

    # Reads the shuffled line a second time instead of the input; only slots with points need an answer.
    carried = (
        line.filter("hot")
        .groupBy(*keys)
        .agg(
            F.max("is_point").alias("has_point"),
            *columns(
                lambda x: F.min(f"lo{x[1]}").alias(f"lo{x[1]}"), lambda x: F.max(f"hi{x[1]}").alias(f"hi{x[1]}")
            ),
        )
        .select(*keys, "has_point", *running(by, "slot", -1, "later", "earlier"))
        .filter("has_point")
    )
    return found.join(carried, keys, "left").select(
        *by,
        "at",
        *columns(
            lambda x: F.when(F.col("hot"), F.least(f"next{x[1]}", f"later{x[1]}")).otherwise(F.col(f"next{x[1]}")).alias(f"next{x[1]}"),
            lambda x: F.when(F.col("hot"), F.greatest(f"last{x[1]}", f"earlier{x[1]}")).otherwise(F.col(f"last{x[1]}")).alias(f"last{x[1]}"),
        ),
    )


def following(rows: DataFrame, by: Sequence[str], width: int) -> DataFrame:
    """``rows``, one per ``(*by, at)``, with ``next``, the next greater ``at`` of their key.

    What ``nearest`` gives for points just behind the rows, but the rows answer themselves: they are shuffled once and
    nothing is joined back, save one row per slot of a hot key. ``at`` is a long and not null.
    """
    by = list(by)
    keys = [*by, "slot"]
    placed = _with_hot(rows, by).withColumn("slot", F.when(F.col("hot"), slot_of(F.col("at"), width)).otherwise(F.lit(0)))
    inside = placed.select(*rows.columns, "slot", F.lead("at").over(Window.partitionBy(*keys).orderBy("at")).alias("inside"))
    # The first row whole, not its time alone: with all columns in use, both readers of ``rows`` share its shuffle.
    firsts = placed.filter("hot").groupBy(*keys).agg(F.min(F.struct("at", *[c for c in rows.columns if c != "at"])).alias("first"))
    later = firsts.select(*keys, F.lead("first.at").over(Window.partitionBy(*by).orderBy("slot")).alias("later"))
    return inside.join(later, keys, "left").select(*rows.columns, F.coalesce("inside", "later").alias("next"))


def running_count(facts: DataFrame, by: Sequence[str], width: int | None, weight: str | None = None) -> DataFrame:
    """``(*by, at, before, count)``: how many facts lie before and up to each distinct time.

    A row is one fact, or as many as its column ``weight`` says.
    """
    by = list(by)
    keys = [*by, "slot"]
    at = F.col("at").cast("long")
    n = F.sum(weight) if weight else F.count(F.lit(1))
    line = (
        facts.select(*by, at.alias("at"), slot_of(at, width).alias("slot"), *([weight] if weight else []))
        .groupBy(*keys, "at")
        .agg(n.alias("n"))
    )

    def running(part, time, to):
        return F.sum("n").over(Window.partitionBy(*part).orderBy(time).rowsBetween(Window.unboundedPreceding, to))

    inside = line.select(*keys, "at", "n", running(keys, "at", Window.currentRow).alias("inside"))
    carried = line.groupBy(*keys).agg(F.sum("n").alias("n")).select(*keys, running(by, "slot", -1).alias("earlier"))
    # A left join, although each slot has its row: an inner one would filter its sides differently, and they
    # would no longer share their shuffle.
    count = F.col("inside") + F.coalesce("earlier", F.lit(0))
    return inside.join(carried, keys, "left").select(
        *by, "at", (count - F.col("n")).alias("before"), count.alias("count")
    )
