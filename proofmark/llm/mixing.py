"""Mixing sources to target weights with a low-discrepancy schedule.

Slot i of the schedule takes the point frac((i + 1) * golden ratio), which is mapped through the cumulative target
shares to a source; the slots of a source are ranked. Each source's documents, shuffled by a hash and repeated, form
a stream of words cut into blocks of ``BLOCK`` words; slot rank r of a source takes its block r. The points keep
every stretch of the schedule near the targets. Ranks beyond a source's target fall out, the few slots that the
points leave short of it (their discrepancy grows with the logarithm of the slots) close the schedule, and the last
block is cut, so a source's words equal its target to the nearest word.

Defined cases: null text has no words and size 0 (takes nothing); a very long text lies in as many blocks as it fills;
documents with equal places in the shuffle follow one another by id; a null source is a source of its own, last in
order; rows that repeat an id are mixed one by one; an empty table gives an empty result; extra columns never clash.
The table of sources, one row each, is ordered in one task; documents, slots and blocks never are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from proofmark.llm.common import maybe_broadcast, row_key, rowed, running_total, unrowed, written
from proofmark.llm.host_rules import words_of

WEIGHTS = (5, 2, 1)
SHARE = 1.5
EPOCHS = 2
BLOCK = 1024
GOLDEN = 0.6180339887498949
GRID = 4096
SEED = "mix"


def place(doc_id: str) -> Column:
    """The document's place in its source's shuffle, in [0, 1)."""
    digest = F.md5(F.concat_ws(":", F.lit(SEED), F.col(doc_id).cast("string")))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def source_targets(sized: DataFrame) -> DataFrame:
    """One row per source: s (its number), source, source_size, target, need (target as whole words), low, high.

    Water-filling: in the order of their limits per weight, sources are held at their limit while it is below
    their share of what is left.
    """
    every = Window.orderBy(F.col("_source").isNull(), "_source")
    weights = F.array(*[F.lit(w) for w in WEIGHTS])
    rows = sized.groupBy("_source").agg(F.sum("size").alias("source_size"))
    rows = rows.withColumn("s", F.row_number().over(every) - 1)
    rows = rows.withColumn("w", F.get(weights, F.col("s") % len(WEIGHTS))).withColumn("cap", EPOCHS * F.col("source_size"))
    order = Window.orderBy(F.col("cap") / F.col("w"), "s")
    whole, before = Window.partitionBy(), order.rowsBetween(Window.unboundedPreceding, -1)
    left = lambda c: F.sum(c).over(whole) - F.coalesce(F.sum(c).over(before), F.lit(0))
    used = F.coalesce(F.sum("cap").over(before), F.lit(0))
    rows = rows.withColumn("level", (SHARE * F.sum("source_size").over(whole) - used) / left("w"))
    rows = rows.withColumn("held", F.col("cap") <= F.col("level") * F.col("w"))
    rows = rows.withColumn("at", F.row_number().over(order))
    level = F.min(F.when(~F.col("held"), F.struct("at", "level"))).over(whole)["level"]
    rows = rows.withColumn("target", F.when(F.col("held"), F.col("cap").cast("double")).otherwise(level * F.col("w")))
    rows = rows.withColumn("need", F.least(F.floor(F.col("target") + 0.5), F.col("cap")).cast("long"))
    total = F.sum("need").over(whole)
    upto = F.sum("need").over(every.rowsBetween(Window.unboundedPreceding, 0))
    return rows.select(
        "s", F.col("_source"), "source_size", "target", "need", total.alias("total"),
        ((upto - F.col("need")) / F.greatest(total, F.lit(1))).alias("low"),
        (upto / F.greatest(total, F.lit(1))).alias("high"),
    )


def schedule(targets: DataFrame, block: int = BLOCK) -> DataFrame:
    """Slots (s, rank, slot) that the mix takes, in the order of ``slot``; ``targets`` is a written table."""
    spark = targets.sparkSession
    total = targets.agg(F.max("total")).first()[0] or 0
    slots = -(-total // block)
    point = F.col("id") + 1
    points = spark.range(slots).withColumn("x", point * GOLDEN - F.floor(point * GOLDEN))
    points = points.withColumn("cell", F.floor(F.col("x") * GRID).cast("long"))
    cells = targets.filter("high > low").select(
        "s", "low", "high", "need",
        F.explode(F.sequence(F.floor(F.col("low") * GRID).cast("long"), F.floor(F.col("high") * GRID).cast("long"))).alias("cell"),
    )
    met = points.join(maybe_broadcast(written(cells, "mix-cells")), "cell").filter("x >= low AND x < high")
    met = written(met.select("s", "need", F.col("id").alias("slot"), (F.col("id") / F.lit(float(max(slots, 1)))).alias("at"), F.lit(1).cast("long").alias("one")), "mix-slots")
    ranked = running_total(met, "s", "at", [], "one", "rank").filter(F.col("rank") * block < F.col("need"))
    counts = met.groupBy(F.col("s").alias("_s")).agg(F.count(F.lit(1)).alias("have"))
    short = targets.join(counts, F.col("s") == F.col("_s"), "left").select(
        "s", F.coalesce("have", F.lit(0)).alias("have"), F.ceil(F.col("need") / block).cast("long").alias("wanted")
    )
    tail = short.filter("have < wanted").select("s", F.explode(F.expr("sequence(have, wanted - 1)")).alias("rank"))
    last = F.row_number().over(Window.orderBy("rank", "s")) - 1 + F.lit(slots)  # a few per source
    return ranked.select("s", "rank", "slot").unionByName(tail.withColumn("slot", last.cast("long")))


def _mixed(docs: DataFrame, doc_id: str, text: str, source: str, block: int) -> DataFrame:
    """One row per document: doc_id, row_key, size, source_size, target, takes (words by epoch, without zeros), slot."""
    sized = written(
        docs.select(
            F.col(doc_id).alias("doc_id"), F.col(source).alias("_source"), row_key(doc_id, text).alias("row_key"),
            F.size(words_of(F.col(text))).cast("long").alias("size"), place(doc_id).alias("_at"),
        ).withColumn("_at", F.coalesce("_at", F.lit(0.0))),
        "mix-sizes",
    )
    targets = written(source_targets(sized), "mix-targets")
    by_source = targets.select("s", F.col("_source").alias("_of"), "source_size", "target", "need")
    numbered = written(sized.join(maybe_broadcast(by_source), F.col("_source").eqNullSafe(F.col("_of"))).drop("_source", "_of"), "mix-numbered")
    stream = written(running_total(numbered, "s", "_at", ["doc_id", "row_key"], "size", "start"), "mix-stream")
    begin = F.col("start") + F.col("epoch") * F.col("source_size")
    pieces = (
        stream.filter("size > 0")
        .withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(EPOCHS - 1))))
        .withColumn("lo", begin).withColumn("hi", F.least(F.col("lo") + F.col("size"), F.col("need")))
        .filter("hi > lo")
        .withColumn("rank", F.explode(F.sequence(F.floor(F.col("lo") / block).cast("long"), F.floor((F.col("hi") - 1) / block).cast("long"))))
        .withColumn("words", F.least("hi", (F.col("rank") + 1) * block) - F.greatest("lo", F.col("rank") * block))
    )
    key = ["s", "start", "size", "doc_id", "row_key"]
    by_epoch = pieces.join(schedule(targets, block), ["s", "rank"]).groupBy("s", "start").agg(
        *[F.sum(F.when(F.col("epoch") == e, F.col("words"))).alias(f"e{e}") for e in range(EPOCHS)], F.min("slot").alias("slot")
    )
    takes = by_epoch.select(
        F.col("s").alias("_s"), F.col("start").alias("_start"), "slot", F.array_compact(F.array(*[f"e{e}" for e in range(EPOCHS)])).alias("takes")
    )
    has = F.col("size") > 0  # a document without words shares its start with the next one
    met = stream.filter(has).join(takes, (F.col("s") == F.col("_s")) & (F.col("start") == F.col("_start")), "left")
    none = stream.filter(~has).withColumn("takes", F.lit(None).cast("array<bigint>")).withColumn("slot", F.lit(None).cast("long"))
    cols = [*key, "source_size", "target", "takes", "slot"]
    return met.select(*cols).unionByName(none.select(*cols)).withColumn("takes", F.coalesce("takes", F.array().cast("array<bigint>")))


def plan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", block: int = BLOCK) -> DataFrame:
    """One row per document: its id, size, its source's size and target, the words that the mix takes of it, and the
    slot of the schedule that takes the first of them (null if none does). A mix in the order of the slots is near the
    targets in every stretch."""
    return _mixed(docs, doc_id, text, source, block).select(
        F.col("doc_id").alias(doc_id), "size", "source_size", "target",
        F.aggregate("takes", F.lit(0).cast("long"), lambda a, x: a + x).alias("taken"), "slot",
    )


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", length: str = "n_chars", block: int = BLOCK) -> DataFrame:
    """The mixed documents with all their columns: one row for each time that one is taken.

    Where a target ends inside a document, its row has the first words only, joined by one space, and ``length``,
    if there, follows.
    """
    takes = _mixed(docs, doc_id, text, source, block).select("doc_id", "row_key", "size", F.explode("takes").alias("take"))
    # Whole takes are counted; parts are at most one per epoch, where a source's target ends.
    takes = takes.groupBy("doc_id", "row_key", "size").agg(
        F.count_if(F.col("take") == F.col("size")).cast("int").alias("whole"),
        F.collect_list(F.when(F.col("take") < F.col("size"), F.col("take"))).alias("parts"),
    )
    takes = takes.select("doc_id", "row_key", "size", F.concat(F.array_repeat("size", F.col("whole")), "parts").alias("takes"))
    rows = rowed(docs).withColumn("_id", F.col("_row").getField(doc_id))
    rows = rows.withColumn("_key", row_key(F.col("_row").getField(doc_id), F.col("_row").getField(text)))
    same = (F.col("_id") == F.col("doc_id")) | (F.col("_id").isNull() & F.col("doc_id").isNull())
    met = rows.join(takes, (F.col("_key") == F.col("row_key")) & same)
    number = F.row_number().over(Window.partitionBy("_key", "_id").orderBy("_key"))  # repeated rows have one list
    met = met.withColumn("_n", number).filter("_n = 1").withColumn("_take", F.explode("takes"))
    part = F.array_join(F.slice(words_of(F.col("_row").getField(text)), 1, F.col("_take").cast("int")), " ")
    whole = F.col("_take") == F.col("size")
    met = met.withColumn("_text", F.when(whole, F.col("_row").getField(text)).otherwise(part))
    return met.select(
        *[
            F.col("_text").alias(c) if c == text
            else F.when(whole, F.col("_row").getField(c)).otherwise(F.char_length("_text")).cast(docs.schema[c].dataType).alias(c) if c == length
            else F.col("_row").getField(c).alias(c)
            for c in docs.columns
        ]
    )
