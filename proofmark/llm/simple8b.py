"""Token ids in Simple-8b words, with escapes and offsets for vectorised decoding.

A 64-bit word has a selector in its top 4 bits, which says how many ids of how many bits fill the rest. Ids of
``ESCAPE`` and more are written as ``ESCAPE``; the real ones follow in a list, in order. A block holds whole
documents and is one binary value (all numbers little-endian):

    4 bytes "S8B1"; unsigned 32-bit counts: ids, words, strides, escapes, documents
    words, 64-bit; ids before every ``STRIDE``-th word; escapes before it; escapes; ids per document: 32-bit

With the offsets a reader starts at any stride, so a part of a block decodes alone. The file format's container is a
Parquet table, a row per block (shard, start, n_ids, doc_ids, data), since only Spark's writers reach a cluster's
store. Shards follow each other in ascending id, and the ids of a shard's blocks in turn.

Defined cases: null text counts as empty (its one end id); a very long text is one long block; rows without an id come first; repeated ids keep all their
rows, in the order of their text's hash; an empty table gives an empty result; extra columns never clash.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from proofmark.llm import tokens
from proofmark.llm.common import by_arrow, maybe_broadcast, row_key, running_total, written

# Fixed values of the code: ids and bits by selector.
SELECTORS = [
    (240, 0), (120, 0), (60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6),
    (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60),
]
ESCAPE = (1 << 15) - 1
STRIDE = 64
BLOCK = 1 << 16  # ids after which a block ends with its document
SHARD = 1 << 23  # bytes of text of a shard, about
MAGIC = b"S8B1"
END = 2


def pack_words(ids: np.ndarray) -> np.ndarray:
    """Words that hold ``ids`` (below 2**60), each with as many as fit."""
    n, values = len(ids), ids.astype(np.uint64)
    bits = np.zeros(n, np.uint8)
    for b in range(int(values.max(initial=0)).bit_length()):
        bits += (values >> np.uint64(b)) > 0
    widest, best = {1: bits}, np.full(n, len(SELECTORS) - 1, np.uint8)
    for selector in range(len(SELECTORS) - 2, -1, -1):
        count, most = SELECTORS[selector]
        if count > n:
            continue
        power = 1 << (count.bit_length() - 1)
        for p in (1 << i for i in range(1, power.bit_length())):
            if p not in widest:
                half = widest[p // 2]
                widest[p] = np.maximum(half[: n - p + 1], half[p // 2 : n - p // 2 + 1])
        m = widest[power]
        fits = np.maximum(m[: n - count + 1], m[count - power : n - power + 1]) <= most
        if not fits.any():
            break  # more ids of fewer bits never fit then
        best[: n - count + 1][fits] = selector
    steps, at, i = np.array([c for c, _ in SELECTORS])[best].tolist(), [], 0
    while i < n:
        at.append(i)
        i += steps[i]
    at = np.array(at, np.int64)
    chosen = best[at].astype(np.uint64) if n else np.zeros(0, np.uint64)
    words = chosen << np.uint64(60)
    for selector, (count, width) in enumerate(SELECTORS):
        here = np.nonzero(chosen == selector)[0]
        for j in range(count if width and len(here) else 0):
            words[here] |= values[at[here] + j] << np.uint64(width * j)
    return words


def unpack_words(words: np.ndarray) -> np.ndarray:
    selector = (words >> np.uint64(60)).astype(np.int64)
    counts = np.array([c for c, _ in SELECTORS])[selector]
    ends = np.cumsum(counts)
    out = np.zeros(int(ends[-1]) if len(words) else 0, np.uint64)
    for s, (count, width) in enumerate(SELECTORS):
        here = np.nonzero(selector == s)[0]
        if width and len(here):
            at = (ends - counts)[here]
            mask = np.uint64((1 << width) - 1)
            for j in range(count):
                out[at + j] = (words[here] >> np.uint64(width * j)) & mask
    return out


def encode_block(ids: np.ndarray, lengths: list[int]) -> bytes:
    escapes = ids[ids >= ESCAPE].astype("<u4")
    words = pack_words(np.minimum(ids, ESCAPE))
    counts = np.array([c for c, _ in SELECTORS])[(words >> np.uint64(60)).astype(np.int64)]
    before = (np.cumsum(counts) - counts)[::STRIDE]
    escaped = np.searchsorted(np.nonzero(ids >= ESCAPE)[0], before)
    head = np.array([len(ids), len(words), len(before), len(escapes), len(lengths)], "<u4")
    parts = head, words.astype("<u8"), before.astype("<u4"), escaped.astype("<u4"), escapes, np.array(lengths, "<u4")
    return MAGIC + b"".join(x.tobytes() for x in parts)


def _parts(data: bytes):
    if data[:4] != MAGIC:
        raise ValueError("not a Simple-8b block")
    n, words, strides, escapes, docs = np.frombuffer(data, "<u4", 5, 4).tolist()
    at, out = 24, [n]
    for kind, count in (("<u8", words), ("<u4", strides), ("<u4", strides), ("<u4", escapes), ("<u4", docs)):
        out.append(np.frombuffer(data, kind, count, at))
        at += count * int(kind[2])
    return out


def decode_block(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The ids of a block, and how many each of its documents has."""
    n, words, _, _, escapes, lengths = _parts(data)
    ids = unpack_words(words)[:n].astype("<u4")
    ids[ids == ESCAPE] = escapes
    return ids, lengths


def decode_range(data: bytes, first: int, count: int) -> np.ndarray:
    """Ids ``first`` to ``first + count`` of a block, from the strides that hold them."""
    _, words, before, escaped, escapes, _ = _parts(data)
    if not count:
        return np.zeros(0, "<u4")
    a = int(np.searchsorted(before, first, "right")) - 1
    b = int(np.searchsorted(before, first + count, "left"))
    ids = unpack_words(words[a * STRIDE : b * STRIDE]).astype("<u4")
    at = np.nonzero(ids == ESCAPE)[0]
    ids[at] = escapes[escaped[a] : escaped[a] + len(at)]
    return ids[first - before[a] : first - before[a] + count]


def write(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", file: str | None = None, end: int = END,
    shard: int = SHARD, block: int = BLOCK,
) -> DataFrame:
    """The written blocks of all documents: shard, start (in its shard), n_ids, doc_ids, data."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), row_key(doc_id, text).alias("row_key"), F.col(text).alias("text"))
    shards = max(1, -(-(rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // shard))
    file = file or tokens.path("word_bpe_49k.json")

    def run(batches):
        encoder, last = tokens.WordEncoder.of(file), np.array([end], "<u2").tobytes()
        number, start, size, doc_ids, held, lengths = TaskContext.get().partitionId(), 0, 0, [], [], []

        def full(kind):
            data = encode_block(np.frombuffer(b"".join(held), "<u2"), lengths)
            values = [number], [start], [size], [doc_ids], [data]
            kinds = pa.int32(), pa.int64(), pa.int64(), pa.list_(kind), pa.binary()
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], ["shard", "start", "n_ids", "doc_ids", "data"])

        kind = pa.int64()
        for b in batches:
            kind = b.schema.field(0).type
            for at in range(0, b.num_rows, 1024):
                part = b.slice(at, 1024)
                for doc, ids in zip(part.column(0).to_pylist(), encoder.encode_all(part.column(1).to_pylist())):
                    doc_ids.append(doc)
                    held.append(ids + last)
                    lengths.append(len(held[-1]) // 2)
                    size += lengths[-1]
                    if size >= block:
                        yield full(kind)
                        start, size, doc_ids, held, lengths = start + size, 0, [], [], []
        if held:
            yield full(kind)

    order = F.col("doc_id").asc_nulls_first(), F.col("row_key")
    ranged = rows.repartitionByRange(shards, *order).sortWithinPartitions(*order)
    schema = f"shard int, start long, n_ids long, doc_ids array<{docs.schema[doc_id].dataType.simpleString()}>, data binary"
    return written(by_arrow(ranged.select("doc_id", "text"), run, schema), "simple8b")


def read(blocks: DataFrame, doc_id: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """One row per document, from its block: its id, start (ids of all documents before), n_tokens, ids_crc32."""
    sums = blocks.groupBy("shard").agg(F.sum("n_ids").alias("sum"))
    shards = (blocks.agg(F.max("shard")).first()[0] or 0) + 1
    sums = written(sums.withColumn("all", F.lit(0)).withColumn("place", F.col("shard") / F.lit(float(shards))), "shard-sums")
    base = written(running_total(sums, "all", "place", [], "sum", "base").select(F.col("shard").alias("of"), "base"), "shard-starts")
    placed = blocks.join(maybe_broadcast(base), F.col("shard") == F.col("of")).select(
        (F.col("base") + F.col("start")).alias("start"), "doc_ids", "data"
    )

    def run(batches):
        for b in batches:
            for at in range(b.num_rows):
                part = b.slice(at, 1)
                ids, lengths = decode_block(part.column(2)[0].as_py())
                ends = np.cumsum(lengths.astype(np.int64))
                begins = ends - lengths
                cut = [ids[i:j] for i, j in zip(begins.tolist(), ends.tolist())]
                columns = [
                    part.column(1).flatten(), pa.array(begins + part.column(0)[0].as_py()), pa.array(lengths.astype(np.int64)),
                    pa.array([zlib.crc32(x) for x in cut], pa.int64()),
                ]
                if with_ids:
                    columns.append(pa.array([x.tolist() for x in cut], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, names)

    names = ["doc_id", "start", "n_tokens", "ids_crc32", *["ids"] * with_ids]
    kind = blocks.schema["doc_ids"].dataType.elementType.simpleString()
    schema = f"doc_id {kind}, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids
    return by_arrow(placed, run, schema).withColumnRenamed("doc_id", doc_id)
