"""Mixture-controlled packing: every window is filled to the sources' token proportions.

Each source is a queue of tokens. In window k a queue is due its quantum (the window's size times its share of all
tokens) plus the deficit that it carries from the windows before; whole tokens are served, and spare places go round
to the queue furthest behind, that whose next token t has the smallest (t + 1/2) / (its tokens). What the queues have
been served before window k is therefore a function of k alone, ``served``, so a task takes up the deficits at any
window without those before: no window waits for another, and each document finds its windows by itself.

Tokens are written once with their place in their source's queue (partitions one after the other); only sums per
partition and source are joined to them. With more than ``QUEUES`` sources, the ``QUEUES - 1`` with the most tokens
have queues of their own, which bounds the state of a window. All others, the tail, share one queue that is merged in
turn: token t of a source stands at (t + its phase) / (its tokens), with golden-ratio phases, as sources of equal size
would else come in bursts. ``tail_parts`` gives what each window takes of each of them, from their totals alone; these
parts meet the documents by source and bucket of its tokens. Of any number of sources the ``LISTED`` with the most tokens
are told apart there; the others, none of which has as much as one token in a few windows, are dealt to ``SHARED`` groups
by their hash, and a group takes its part like a source. So no task and no driver has more totals than these.

Defined cases: null text counts as empty (its one end token is packed); a very long text goes on from window to window;
sources with equal tokens are ranked by name; a null source is a source of its own; rows that repeat an id are packed one by one; an empty table gives an empty result; extra columns never clash.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from proofmark.llm import tokens
from proofmark.llm.common import by_arrow, maybe_broadcast, running_total, written

WINDOW = 1024
QUEUES = 64
LISTED, SHARED = 4096, 256
END = 0
CHUNK = 1 << 15  # windows handled at once
GOLDEN = 0.6180339887498949


def tokenized(docs: DataFrame, doc_id: str, text: str, source: str, file: str, end: int) -> DataFrame:
    """Written rows (doc_id, source, part, at, n, ids): a document's ids, and its place among its source's in its partition."""

    def run(batches):
        encoder, part, at = tokens.SpacedEncoder.of(file), TaskContext.get().partitionId(), {}
        last = np.array([end], "<u2").tobytes()
        for b in batches:
            for k in range(0, b.num_rows, 1024):
                piece = b.slice(k, 1024)
                sources, places = piece.column(1).to_pylist(), []
                ids = [x + last for x in encoder.encode_all(piece.column(2).to_pylist())]
                for s, x in zip(sources, ids):
                    places.append(at.get(s, 0))
                    at[s] = places[-1] + len(x) // 2
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column(0), piece.column(1), pa.array([part] * len(ids), pa.int32()), pa.array(places, pa.int64()),
                        pa.array([len(x) // 2 for x in ids], pa.int64()), pa.array(ids, pa.binary()),
                    ],
                    ["doc_id", "source", "part", "at", "n", "ids"],
                )

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), F.col(text).alias("text"))
    kind, of = (docs.schema[c].dataType.simpleString() for c in (doc_id, source))
    return written(by_arrow(rows, run, f"doc_id {kind}, source {of}, part int, at long, n long, ids binary"), "tokens")


def served(k: np.ndarray, totals: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Tokens taken from each queue before each of the windows ``k``: a row per window, rows sum to k * window.

    The first k * window tokens in the order of ((t + 1/2) / total, queue).
    """
    n, size = totals.astype(float), np.minimum(k * window, totals.sum())
    c = np.clip(np.floor(size[:, None] * (n / n.sum()) + 0.5), 0, n).astype(np.int64)
    order = np.arange(len(n))
    due = lambda c: np.where(c < totals, (c + 0.5) / n, np.inf)  # noqa: E731  key of the next token
    done = lambda c: np.where(c > 0, (c - 0.5) / n, -np.inf)  # noqa: E731  key of the last one taken
    behind = lambda x: np.argmin(x, axis=1)  # noqa: E731  the first queue of equals
    ahead = lambda x: len(order) - 1 - np.argmax(x[:, ::-1], axis=1)  # noqa: E731  the last of equals
    while True:
        off = c.sum(axis=1) - size
        low, high = np.nonzero(off < 0)[0], np.nonzero(off > 0)[0]
        if len(low):
            c[low, behind(due(c[low]))] += 1
        if len(high):
            c[high, ahead(done(c[high]))] -= 1
        if not len(low) and not len(high):
            break
    rows = np.arange(len(k))
    while len(rows):  # rounding may have left a token out of order
        next_, last = due(c[rows]), done(c[rows])
        i, j = behind(next_), ahead(last)
        x, y = next_[np.arange(len(rows)), i], last[np.arange(len(rows)), j]
        wrong = (x < y) | ((x == y) & (i < j))
        rows, i, j = rows[wrong], i[wrong], j[wrong]
        c[rows, i] += 1
        c[rows, j] -= 1
    return c


def pieces(queue: np.ndarray, start: np.ndarray, n: np.ndarray, totals: np.ndarray, window: int = WINDOW):
    """Yields (document, window, start in document, length, offset in window) for documents at ``start`` of a queue."""
    whole = totals.sum()
    key = lambda t: (t + 0.5) / totals[queue] * whole / window
    last = (whole - 1) // window
    first = np.clip(np.floor(key(start)).astype(np.int64) - 1, 0, last)
    final = np.clip(np.floor(key(start + n - 1)).astype(np.int64) + 1, 0, last)
    doc, lo = np.arange(len(n)), first
    while len(doc):
        hi = np.minimum(final[doc], lo + CHUNK - 1)
        counts = hi - lo + 1
        take = max(1, int(np.searchsorted(np.cumsum(counts), CHUNK, "right")))
        d = np.repeat(doc[:take], counts[:take])
        k = np.arange(len(d)) - np.repeat(np.cumsum(counts[:take]) - counts[:take], counts[:take]) + np.repeat(lo[:take], counts[:take])
        known = np.unique(np.concatenate([k, k + 1]))
        c = served(known, totals, window)
        before, after = c[np.searchsorted(known, k)], c[np.searchsorted(known, k + 1)]
        q, row = queue[d], np.arange(len(d))
        begin = np.maximum(start[d], before[row, q])
        end = np.minimum(start[d] + n[d], after[row, q])
        left = np.cumsum(after - before, axis=1)[row, q] - (after - before)[row, q]
        ok = end > begin
        yield d[ok], k[ok], (begin - start[d])[ok], (end - begin)[ok], (left + begin - before[row, q])[ok]
        again = final[doc[:take]] > hi[:take]  # a very long document goes on in the next round
        doc, lo = np.concatenate([doc[:take][again], doc[take:]]), np.concatenate([hi[:take][again] + 1, lo[take:]])


def tail_parts(taken: np.ndarray, totals: np.ndarray):
    """(window, source, first token, tokens, place in window) where window j takes tokens taken[j] to taken[j + 1] of the merged tail."""
    n, phase = totals.astype(float), np.arange(1, len(totals) + 1) * GOLDEN % 1
    lo, hi = 0.0, 1.0
    for _ in range(60):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if np.clip(np.ceil(mid * n - phase), 0, n).sum() <= taken[0] else (lo, mid)
    first = np.clip(np.ceil(lo * n - phase) - 1, 0, n).astype(np.int64)  # one more, as keys are rounded
    lo, hi = lo, 1.0
    for _ in range(60):
        mid = (lo + hi) / 2
        lo, hi = (lo, mid) if np.clip(np.ceil(mid * n - phase), 0, n).sum() >= taken[-1] else (mid, hi)
    last = np.clip(np.ceil(hi * n - phase) + 1, 0, n).astype(np.int64)
    counts = np.maximum(last - first, 0)
    s = np.repeat(np.arange(len(n)), counts)
    t = np.arange(len(s)) - np.repeat(np.cumsum(counts) - counts, counts) + first[s]
    order = np.lexsort((s, (t + phase[s]) / n[s]))[taken[0] - first.sum() : taken[-1] - first.sum()]
    k = np.searchsorted(taken, taken[0] + np.arange(len(order)), "right") - 1
    s, t = s[order], t[order]
    order = np.lexsort((t, s, k))
    k, s, t = k[order], s[order], t[order]
    begin = np.nonzero(np.r_[True, (k[1:] != k[:-1]) | (s[1:] != s[:-1])] if len(k) else np.zeros(0, bool))[0]
    k = k[begin]
    return k, s[begin], t[begin], np.diff(np.r_[begin, len(s)]), begin - (taken[k] - taken[0])


def _of_tail(placed: DataFrame, totals: np.ndarray, tail: np.ndarray, first: int, window: int) -> DataFrame:
    """Rows (doc_id, n, begin, length, window, offset, ids) of documents whose queue is ``first`` or beyond."""
    spark, windows = placed.sparkSession, int(-(-totals.sum() // window))
    step = max(64, 4 * len(tail) // window)

    def run(batches):
        for b in batches:
            for at in b.column(0).to_pylist():
                known = np.arange(at * step, min((at + 1) * step, windows) + 1)
                k, s, t, length, offset = tail_parts(served(known, totals, window)[:, 0], tail)
                columns = [s + first, k + at * step, t, length, offset]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["of", "window", "t", "tokens", "offset"])

    chunks = -(-windows // step)
    parts = spark.range(0, chunks, 1, min(chunks, 4 * spark.sparkContext.defaultParallelism))
    parts = written(by_arrow(parts, run, "of long, window long, t long, tokens long, offset long"), "tail-parts")
    buckets = lambda start, n: F.expr(f"explode(sequence({start} div {window}, ({start} + {n} - 1) div {window}))")
    cut = lambda ids, start, stop: F.substr(ids, (2 * start + 1).cast("int"), (2 * (stop - start)).cast("int"))
    start, stop, low = F.col("start"), F.col("start") + F.col("n"), F.col("low")
    # A bucket has the ids of the parts that begin in it, which are no longer than a window.
    docs = placed.withColumn("bucket", buckets("start", "n")).withColumn("low", F.greatest(start, F.col("bucket") * window))
    docs = docs.withColumn("ids", cut(F.col("ids"), low - start, F.least(stop, (F.col("bucket") + 2) * window) - start))
    parts = parts.withColumn("_bucket", buckets("t", "tokens"))
    begin, end = F.greatest("start", "t"), F.least(stop, F.col("t") + F.col("tokens"))
    met = docs.join(parts, (F.col("queue") == F.col("of")) & (F.col("bucket") == F.col("_bucket")) & (begin < end))
    met = met.filter(F.floor(begin / window) == F.col("bucket"))
    return met.select(
        "doc_id", "n", (begin - start).alias("begin"), (end - begin).alias("length"), "window",
        (F.col("offset") + begin - F.col("t")).alias("offset"), cut(F.col("ids"), begin - low, end - low).alias("ids"),
    )


def _queues(sums: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """(written rows (of, queue) of all sources, tokens by queue): the largest sources by rank, groups of the others."""
    by_source = written(sums.groupBy(F.col("source").alias("of")).agg(F.sum("tokens").alias("all")), "sources")
    ranked = by_source.orderBy(F.desc("all"), F.col("of")).limit(LISTED).collect()
    totals = [r["all"] for r in ranked]
    own = sums.sparkSession.createDataFrame([(r["of"], i) for i, r in enumerate(ranked)], f"of {by_source.schema['of'].dataType.simpleString()}, queue int")
    if by_source.count() > len(ranked):
        listed = F.broadcast(own.withColumnRenamed("of", "known"))  # LISTED rows at most
        group = (F.pmod(F.xxhash64("of"), F.lit(SHARED)) + len(ranked)).cast("int").alias("queue")
        rest = written(by_source.join(listed, F.col("of").eqNullSafe(F.col("known")), "left_anti").select("of", "all", group), "rest")
        tokens_of = {r["queue"]: r["n"] for r in rest.groupBy("queue").agg(F.sum("all").alias("n")).collect()}  # SHARED rows at most
        totals += [tokens_of.get(len(ranked) + k, 0) for k in range(SHARED)]
        own = own.unionByName(rest.select("of", "queue"))
    return written(own, "queues"), np.array(totals, np.int64)


def pack(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", file: str | None = None,
    end: int = END, window: int = WINDOW, with_ids: bool = False,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, padded_length.

    ``padded_length`` is what the sequence is padded to: ``window``, or its own length if that is a power of two.
    ``with_ids`` adds the piece's ids.
    """
    file = file or tokens.path("byte_bpe_50k.json")
    rows = tokenized(docs, doc_id, text, source, file, end)
    sums = written(rows.groupBy("part", "source").agg(F.sum("n").alias("tokens")), "queue-sums")
    own, totals = _queues(sums)
    most = len(totals) if len(totals) <= QUEUES else QUEUES - 1
    sums = sums.join(maybe_broadcast(own), F.col("source").eqNullSafe(F.col("of")))
    parts = (sums.agg(F.max("part")).first()[0] or 0) + 1
    sums = written(sums.select("part", "source", "tokens", "queue", (F.col("part") / F.lit(float(parts))).alias("place")), "queue-sums")
    totals, tail = totals[:most], totals[most:]
    shared = int(len(tail) > 0)  # the queue of the tail comes first
    totals = np.concatenate([[tail.sum()] * shared, totals]).astype(np.int64)
    base = written(running_total(sums, "queue", "place", ["source"], "tokens", "base").select(
        F.col("part").alias("_part"), F.col("source").alias("_source"), "queue", "base"
    ), "queue-starts")
    placed = rows.join(
        maybe_broadcast(base), (F.col("part") == F.col("_part")) & F.col("source").eqNullSafe(F.col("_source"))
    ).select("doc_id", "queue", (F.col("base") + F.col("at")).alias("start"), "n", "ids")

    def piece(doc, begin, length, cut, n, k, offset):
        left = np.minimum(totals.sum() - k * window, window)
        columns = [
            doc, pa.array(begin), pa.array(length), pa.array([zlib.crc32(x) for x in cut], pa.int64()), pa.array(n), pa.array(k),
            pa.array(offset), pa.array(np.where(left & (left - 1) == 0, left, window)),
        ]
        if with_ids:
            columns.append(pa.array([x.tolist() for x in cut], pa.list_(pa.int32())))
        return pa.RecordBatch.from_arrays(columns, names)

    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, 2048):
                part = b.slice(at, 2048)
                start, n = (part.column(i).to_numpy() for i in (2, 3))
                queue = part.column(1).to_numpy() + shared
                ids = [np.frombuffer(x, "<u2").astype("<u4") for x in part.column(4).to_pylist()]
                for d, k, begin, length, offset in pieces(queue, start, n, totals, window):
                    cut = [ids[i][a : a + m] for i, a, m in zip(d.tolist(), begin.tolist(), length.tolist())]
                    yield piece(part.column(0).take(pa.array(d)), begin, length, cut, n[d], k, offset)

    def run_tail(batches):
        for b in batches:
            n, begin, length, k, offset = (b.column(i).to_numpy() for i in range(1, 6))
            cut = [np.frombuffer(x, "<u2").astype("<u4") for x in b.column(6).to_pylist()]
            yield piece(b.column(0), begin, length, cut, n, k, offset)

    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "padded_length", *["ids"] * with_ids]
    kind = docs.schema[doc_id].dataType.simpleString()
    schema = ", ".join([f"doc_id {kind}", *[f"{c} long" for c in names[1:8]], *["ids array<int>"] * with_ids])
    out = by_arrow(placed.filter(F.col("queue") < most) if shared else placed, run, schema)
    if shared:
        out = out.unionAll(by_arrow(_of_tail(placed.filter(F.col("queue") >= most), totals, tail, most, window), run_tail, schema))
    return out.withColumnRenamed("doc_id", doc_id)
