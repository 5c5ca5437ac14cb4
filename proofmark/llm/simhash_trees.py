"""SimHash near-duplicates found in vantage-point trees.

Of two fingerprints at most ``MAX_BITS`` apart, one half is at most ``MAX_BITS // 2`` apart, so each half has a tree of
its own. Distinct fingerprints are dealt down it by the distance of their half to vantage points that are
pseudo-random (a mix of the node's number), so that distances spread alike whatever the data: those within ``RADIUS``
bits of a node's point go to the inner branch, the others to the outer one. By the triangle inequality close halves
differ by no more than their own distance in that to any point, hence the outer ones that near to the boundary are
also copied to the inner branch, and every pair meets in a leaf. Leaves are shards; a task goes on with a tree over
the shard's own points, by whole fingerprints, and compares what is left exactly. Each shard gives back a spanning
forest, not its pairs.

The trees are implicit (no index is sent about). A level multiplies the rows by about 1.14 and a shard's share by
0.57, so the depth follows from the number of distinct fingerprints. A half that very many fingerprints share (near
copies of one template) can't be split by trees over that half: shards that are counted to be ``HOT`` times too large
are dealt again by the quarters of the other half.

Defined cases: null or blank text has fingerprint zero; a very long text is hashed whole, a bounded number of shingles
at a time; of ids of one component the smallest names it; a null id never names a component, its row gets the
component of its fingerprint (null if no row with an id has a linked one); rows of the same id count as one
document when links are followed; an empty table gives an empty result; extra columns never clash.
"""

from __future__ import annotations

from itertools import accumulate

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from proofmark.llm.common import by_arrow, maybe_broadcast, row_key, rowed, unrowed, written
from proofmark.llm.components import components

SHINGLE = 3
MAX_BITS = 3
SEED = 42
# Inner branch: distances up to this. With 32 bits and one bit of overlap both branches then hold about 57 %.
RADIUS = 15
SHRINK = 0.57
SHARD = 8192
HOT = 8  # shards of more than so many times that size are dealt again
SHRINK_AGAIN = 0.6
LEAF = 512
BLOCK = 1 << 21  # comparisons held at once


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    words = (text or b"").lower().split()
    n = len(words) - shingle + 1
    joined = b" ".join(words)
    if not words:
        return 0
    digest = xxhash.xxh64_digest
    if n <= 1:
        return int.from_bytes(digest(joined, SEED), "big")
    begins = [0, *accumulate(len(w) + 1 for w in words)]
    counts = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):
        hashes = b"".join(
            [digest(joined[a : b - 1], SEED) for a, b in zip(begins[at : min(n, at + (1 << 16))], begins[at + shingle :])]
        )
        bits = np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1)
        for k in range(0, len(bits), 255):  # bytes hold sums of 255 rows
            counts += np.add.reduce(bits[k : k + 255], axis=0, dtype=np.uint8)
    return int.from_bytes(np.packbits(2 * counts > n).tobytes(), "big")


def fingerprints(docs: DataFrame, doc_id: str, text: str, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, row_key, fp) for every row."""

    def run(batches):
        for b in batches:
            fps = [fingerprint(t, shingle) for t in b.column(2).to_pylist()]
            fp = pa.array(np.array(fps, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), fp], ["doc_id", "row_key", "fp"])

    rows = docs.select(
        F.col(doc_id).alias("doc_id"), row_key(doc_id, text).alias("row_key"), F.col(text).cast("binary").alias("text")
    )
    kind = docs.schema[doc_id].dataType.simpleString()
    return by_arrow(rows, run, f"doc_id {kind}, row_key long, fp long")


def _mix(x: np.ndarray) -> np.ndarray:
    """Pseudo-random 64 bits of a node's number (the finaliser of SplitMix64, whose constants are fixed values)."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def depth_for(n: int, shard: int = SHARD) -> int:
    return max(0, int(np.ceil(np.log(max(n, 1) / shard) / -np.log(SHRINK))))


def deal(fp: np.ndarray, depth: int, max_bits: int = MAX_BITS) -> tuple[np.ndarray, np.ndarray]:
    """(index into ``fp``, shard) for every shard that a fingerprint belongs to, in the trees of both halves."""
    out, low = [], np.uint64((1 << 32) - 1)
    for half in range(2):
        bits = (fp >> np.uint64(32 * half)) & low
        at, node = np.arange(len(fp)), np.full(len(fp), 2 + half, np.uint64)
        for _ in range(depth):
            d = np.bitwise_count(bits[at] ^ (_mix(node) & low)).astype(np.int16)
            both = (d > RADIUS) & (d <= RADIUS + max_bits // 2)
            node, at = (
                np.concatenate([node * np.uint64(2) + (d > RADIUS), node[both] * np.uint64(2)]),
                np.concatenate([at, at[both]]),
            )
        out.append((at, node))
    return tuple(np.concatenate(x) for x in zip(*out))


class Forest:
    """Component labels of one shard, joined by arrays of links."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def link(self, i: np.ndarray, j: np.ndarray) -> None:
        while len(i):
            a, b = self.label[i], self.label[j]
            apart = a != b
            i, j, a, b = i[apart], j[apart], a[apart], b[apart]
            if not len(i):
                return
            np.minimum.at(self.label, np.maximum(a, b), np.minimum(a, b))
            while True:
                up = self.label[self.label]
                if np.array_equal(up, self.label):
                    break
                self.label = up


def _compare(fp: np.ndarray, at: np.ndarray, forest: Forest, max_bits: int) -> None:
    x, step = fp[at], max(1, BLOCK // max(1, len(at)))
    for k in range(0, len(at), step):
        i, j = np.nonzero(np.bitwise_count(x[k : k + step, None] ^ x[None, k:]) <= max_bits)
        keep = i < j
        forest.link(at[i[keep] + k], at[j[keep] + k])


def shard_forest(fp: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """Component label of each of a shard's fingerprints, by a tree over its own vantage points."""
    forest, todo = Forest(len(fp)), [np.arange(len(fp))]
    while todo:
        at = todo.pop()
        if len(at) > LEAF:
            d = np.bitwise_count(fp[at] ^ fp[at[len(at) // 2]])
            close = at[2 * d <= max_bits]  # any two of these are close enough through the point
            forest.link(close[1:], close[:-1])
            radius = np.median(d)
            inner, outer = at[d <= radius + max_bits], at[d > radius]
            if max(len(inner), len(outer)) <= 0.9 * len(at):
                todo += [inner, outer]
                continue
        _compare(fp, at, forest, max_bits)
    return forest.label


def deal_again(fp: np.ndarray, shard: np.ndarray, depth: np.ndarray, first: int, max_bits: int = MAX_BITS) -> tuple[np.ndarray, np.ndarray]:
    """(index, shard) for fingerprints of shards that are too large, in trees over the half that did not make the shard.

    A linked pair differs there by up to ``max_bits``, so in one of its quarters by half of that at most: each quarter
    has a tree. Nodes of one shard are told from those of others by a hash; ``first`` is the depth of the first trees.
    """
    half = (shard >> np.uint64(first)) - np.uint64(2)
    other = np.where(half == 0, fp >> np.uint64(32), fp)
    out, low = [], np.uint64((1 << 16) - 1)
    for quarter in range(2):
        bits = (other >> np.uint64(16 * quarter)) & low
        at, node, level = np.arange(len(fp)), _mix(shard * np.uint64(2) + np.uint64(quarter)), 0
        while len(at):
            done = depth[at] <= level
            out.append((at[done], node[done]))
            at, node = at[~done], node[~done]
            d = np.bitwise_count(bits[at] ^ (_mix(node) & low)).astype(np.int16)
            both = (d > RADIUS // 2) & (d <= RADIUS // 2 + max_bits // 2)
            node = np.concatenate([_mix(node * np.uint64(2) + (d > RADIUS // 2)), _mix(node[both] * np.uint64(2))])
            at, level = np.concatenate([at, at[both]]), level + 1
    return tuple(np.concatenate(x) for x in zip(*out))


def _split_hot(routed: DataFrame, depth: int, max_bits: int, shard: int) -> DataFrame:
    """``routed`` (fp, node, shard) with shards of more than ``HOT`` times the intended size dealt again."""
    routed = written(routed, "routed")
    hot = written(routed.groupBy(F.col("shard").alias("hot")).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > HOT * shard), "hot-shards")
    if hot.isEmpty():
        return routed
    met = routed.join(maybe_broadcast(hot), F.col("shard") == F.col("hot"))

    def again(batches):
        for b in batches:
            for k in range(0, b.num_rows, 1 << 12):
                part = b.slice(k, 1 << 12)
                fp, of, rows = part.column(0).to_numpy().view(np.uint64), part.column(2).to_numpy().view(np.uint64), part.column(3).to_numpy()
                levels = np.ceil(np.log(rows / shard) / -np.log(SHRINK_AGAIN)).astype(np.int64)
                at, node = deal_again(fp, of, levels, depth, max_bits)
                for j in range(0, len(at), 1 << 16):
                    taken = part.select(["fp", "node"]).take(pa.array(at[j : j + (1 << 16)]))
                    yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(node[j : j + (1 << 16)].view(np.int64))], ["fp", "node", "shard"])

    cold = routed.join(hot, F.col("shard") == F.col("hot"), "left_anti")
    return cold.unionByName(by_arrow(met.select("fp", "node", "shard", "rows"), again, "fp long, node long, shard long"))


def links(nodes: DataFrame, max_bits: int = MAX_BITS, shard: int = SHARD) -> DataFrame:
    """Links (a, b) that span the components of ``nodes`` (fp, node), one row per distinct fingerprint."""
    depth = depth_for(nodes.count(), shard)

    def route(batches):
        for b in batches:
            at, node = deal(b.column(0).to_numpy().view(np.uint64), depth, max_bits)
            for k in range(0, len(at), 1 << 16):
                rows = b.take(pa.array(at[k : k + (1 << 16)]))
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns, pa.array(node[k : k + (1 << 16)].view(np.int64))], ["fp", "node", "shard"]
                )

    def join(pdf: pd.DataFrame) -> pd.DataFrame:
        label, node = shard_forest(pdf["fp"].to_numpy().view(np.uint64), max_bits), pdf["node"].to_numpy()
        least = node.copy()
        np.minimum.at(least, label, node)
        root = least[label]
        return pd.DataFrame({"a": root[node != root], "b": node[node != root]})

    routed = _split_hot(by_arrow(nodes.select("fp", "node"), route, "fp long, node long, shard long"), depth, max_bits, shard)
    return routed.groupBy("shard").applyInPandas(join, "a long, b long")


def clustered(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS
) -> DataFrame:
    """(doc_id, row_key, fp, component_id) for every row."""
    rows = written(fingerprints(docs, doc_id, text, shingle), "fingerprints")
    nodes = written(rows.groupBy("fp").agg(F.min("doc_id").cast("long").alias("node")), "nodes")
    found = components(links(nodes.filter("node IS NOT NULL"), max_bits).unionByName(_same_id(rows, nodes)))
    found = found.withColumnRenamed("node", "at")
    by_fp = written(
        nodes.join(found, F.col("node") == F.col("at"), "left").select(
            F.col("fp").alias("of"), F.coalesce("component", "node").alias("component_id")
        ),
        "by-fingerprint",
    )
    return rows.join(by_fp, F.col("fp") == F.col("of")).drop("of")


def _same_id(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """Links between fingerprints that share a document id, which takes repeated ids with different texts."""
    ids = rows.groupBy("doc_id").agg(F.min("fp").alias("least"), F.max("fp").alias("most"))
    odd = ids.filter("doc_id IS NOT NULL AND least != most").select("doc_id")
    pairs = written(rows.join(odd, "doc_id").select("fp", "doc_id").distinct(), "same-id")
    return pairs.join(nodes, "fp").select(F.col("node").alias("a"), F.col("doc_id").cast("long").alias("b"))


def label(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its id, the fingerprint in hex, and the smallest id it is linked with."""
    return clustered(docs, doc_id, text).select(
        F.col("doc_id").alias(doc_id),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.col("component_id").cast(docs.schema[doc_id].dataType).alias("component_id"),
    )


def keep(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each component, that with the smallest id, with all its columns.

    Rows without an id and without a linked id count as one component per fingerprint.
    """
    group = [F.col("component_id"), F.when(F.col("component_id").isNull(), F.col("fp")).alias("alone")]
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_key"))
    chosen = written(
        clustered(docs, doc_id, text).groupBy(*group).agg(first.alias("first")).select("first.doc_id", "first.row_key"),
        "chosen",
    )
    rows = rowed(docs).withColumn("_key", row_key(F.col("_row").getField(doc_id), F.col("_row").getField(text)))
    rows = rows.withColumn("_id", F.col("_row").getField(doc_id))
    same = (F.col("_id") == F.col("doc_id")) | (F.col("_id").isNull() & F.col("doc_id").isNull())
    met = rows.join(chosen, (F.col("_key") == F.col("row_key")) & same)
    number = F.row_number().over(Window.partitionBy("_key", "_id").orderBy("_key"))  # rows may be repeated whole
    return unrowed(met.withColumn("_n", number).filter("_n = 1"), docs.columns)
