"""Substring dedup over bytes by column-wise construction of a collection's suffix order.

The collection is built in parts. Windows of ``WINDOW`` bytes choose anchors (see ``anchors``), so a window that
repeats does so among the phrases that share its anchor; a phrase that the corpus holds twice as a whole is settled
by counting, and one without a partner of the same anchor repeats nothing. What is left, distinct phrases of one
anchor, is a collection of strings lined up at that anchor. Round after round, from the last column to the first,
one symbol of every string is inserted: the symbols in the present suffix order are the round's column of the
Burrows-Wheeler transform, a stable sort by them gives the next order, and the common prefix of two neighbours is one
more than the least between them before (``repeated``). A window starts elsewhere if its suffix has ``WINDOW``
symbols in common with a neighbour. Spark's shuffle files take the place of the method's external files: a part has a
few thousand strings of at most 2 * ``WINDOW`` bytes, and each task reads its parts one after the other.

Anchors with more than ``MANY`` distinct phrases (the ends of a passage that very many documents share) would put one
key into one task. Their phrases are cut into stretches of windows: stretches that repeat whole are counted, those
whose common core repeats no more than once are done, and only the windows of the others, at the passage's ends, are
counted one by one.

Defined cases: null text is empty; a document under ``WINDOW`` bytes loses none; very long texts are read whole, in chunks
of their windows; rows that repeat an id and text are copies of each other, whose spans are gathered once; an empty table gives an empty result; extra columns never clash.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from proofmark.llm import anchors
from proofmark.llm.common import by_arrow, row_key, written
from proofmark.llm.rlz_spans import phrases_of, whole_spans

WINDOW = 400
GRAM = 64
BATCH = 1 << 20  # bytes whose runs are found at once
MANY = 512
PART = 4096  # strings of a part, about
STRETCH = 18
SYMBOLS = anchors.mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(anchors.MULTIPLIER))
END = 256


def symbols(text: bytes) -> np.ndarray:
    return SYMBOLS[np.frombuffer(text, np.uint8)]


def _runs(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """Written rows (key, anchor, phrase, start, n, lead); ``lead``: bytes of the phrase before its anchor."""

    def run(batches):
        keys, texts, size = [], [], 0

        def found():
            ends = np.cumsum([len(t) for t in texts])
            text, start, n, anchor, place, phrase = anchors.runs(symbols(b"".join(texts)), ends, window, gram)
            begins = ends - np.array([len(t) for t in texts])
            columns = (
                np.array(keys, np.int64)[text], anchor.view(np.int64), phrase.view(np.int64), start - begins[text],
                n.astype(np.int32), (place - start).astype(np.int32),
            )
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["key", "anchor", "phrase", "start", "n", "lead"])

        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                for key, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    if text and len(text) >= window:
                        keys.append(key)
                        texts.append(text)
                        size += len(text)
                    if size >= BATCH:
                        yield found()
                        keys, texts, size = [], [], 0
        if texts:
            yield found()

    return written(by_arrow(docs, run, "key long, anchor long, phrase long, start long, n int, lead int"), "byte-runs")


def _strings(docs: DataFrame, meeting: DataFrame, window: int) -> DataFrame:
    """Written rows (anchor, phrase, lead, n, weight, of, data): the phrases' bytes."""
    each = F.struct(
        F.col("place.start").alias("start"), F.col("place.n").alias("n"), "anchor", "phrase",
        F.col("place.lead").alias("lead"), F.least(F.col("count"), F.lit(2)).alias("weight"), "of",
    )
    lists = written(meeting.groupBy(F.col("place.key").alias("key")).agg(F.collect_list(each).alias("phrases")), "byte-lists")

    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, 64):
                part = b.slice(at, 64)
                for text, (start, n, anchor, phrase, lead, weight, of) in zip(part.column(0).to_pylist(), anchors.columns_of(part.column(1))):
                    data = [text[a : a + m + window - 1] for a, m in zip(start.tolist(), n.tolist())]
                    yield pa.RecordBatch.from_arrays([*map(pa.array, (anchor, phrase, lead, n, weight, of)), pa.array(data, pa.binary())], names)

    names = ["anchor", "phrase", "lead", "n", "weight", "of", "data"]
    met = docs.join(lists, "key").select("text", "phrases")
    return written(by_arrow(met, run, "anchor long, phrase long, lead int, n int, weight long, of long, data binary"), "strings")


def repeated(group: np.ndarray, data: list[bytes], lead: np.ndarray, window: int) -> np.ndarray:
    """Marks (string, column) where a stretch of ``window`` bytes is in another string of the group at the same column.

    Strings are lined up at their leads; column ``lead.max()`` is that of the anchors.
    """
    size = np.array([len(d) for d in data])
    left, width = int(lead.max()), int(lead.max() + (size - lead).max())
    table = np.full((len(data), width), END, np.int32)
    for row, d, a in zip(table, data, (left - lead).tolist()):
        row[a : a + len(d)] = np.frombuffer(d, np.uint8)
    table, marks = np.ascontiguousarray(table.T), np.zeros((width, len(data)), bool)
    group = np.unique(group, return_inverse=True)[1].astype(np.int32) * (END + 1)
    order, common = np.argsort(group, kind="stable"), np.zeros(len(data), np.int32)
    for column in range(width - 1, -1, -1):
        inserted = table[column][order]
        key = group[order] + inserted
        by = np.argsort(key, kind="stable")
        order, key = order[by], key[by]
        same = np.nonzero((key[1:] == key[:-1]) & (inserted[by[1:]] != END))[0]
        ranges = np.empty(2 * len(same), np.int64)
        ranges[::2], ranges[1::2] = by[same], by[same + 1]
        grown = np.zeros(len(data), np.int32)
        if len(same):
            grown[same] = 1 + np.minimum.reduceat(common, ranges)[::2]
        common = grown
        long = np.nonzero(common >= window)[0]
        marks[column, order[long]] = True
        marks[column, order[long + 1]] = True
    return marks.T


def _stretches(mark: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the runs of true values."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], mark.astype(np.int8), [0]])))
    return edge[::2], edge[1::2] - edge[::2]


def _by_columns(strings: DataFrame, window: int) -> DataFrame:
    """(anchor, phrase, offset, n): the repeated windows of the strings of anchors with few phrases."""
    parts = max(1, strings.count() // PART)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        pdf = pdf.sort_values("anchor", ignore_index=True)
        anchor, many = pdf["anchor"].to_numpy(), len(pdf)
        at = 0
        while at < many:  # whole anchors, about PART strings at once
            end = min(at + PART, many)
            end = int(np.searchsorted(anchor, anchor[end - 1], "right"))
            some = pdf.iloc[at:end]
            lead, n = some["lead"].to_numpy(), some["n"].to_numpy()
            marks = repeated(anchor[at:end], some["data"].tolist(), lead, window)
            for k in np.nonzero((some["weight"].to_numpy() == 1) & marks.any(axis=1))[0].tolist():
                first = int(lead.max() - lead[k])
                for start, length in zip(*_stretches(marks[k, first : first + n[k]])):
                    out.append((anchor[at + k], some["phrase"].iat[k], start, length))
            at = end
        return pd.DataFrame(out, columns=["anchor", "phrase", "offset", "n"])

    bucket = F.pmod(F.xxhash64("anchor"), F.lit(parts)).alias("bucket")
    dealt = strings.select(bucket, "anchor", "phrase", "lead", "n", "weight", "data")
    return dealt.groupBy("bucket").applyInPandas(run, "anchor long, phrase long, offset int, n int")


def _cut(strings: DataFrame, window: int) -> DataFrame:
    """Stretches of windows by the anchor's place in them: (anchor, phrase, offset, n, core, unit, weight)."""

    def run(batches):
        for b in batches:
            rows = zip(*(b.column(i).to_pylist() for i in range(5)), b.column(6).to_pylist())
            out = []
            for anchor, phrase, lead, n, weight, data in rows:
                hashes, a = anchors.Hashes(symbols(data)), 0
                while a < n:
                    cell = (lead - a) // STRETCH
                    end = min(n, lead - cell * STRETCH + 1)  # windows a to end - 1 have their anchor in this cell
                    low = lead - cell * STRETCH
                    core, unit = hashes.of(np.array([low, a]), np.array([low + window - STRETCH + 1, end + window - 1])).tolist()
                    out.append((anchor, phrase, a, end - a, core ^ cell, unit ^ (lead - a), weight))
                    a = end
            kinds = pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.uint64(), pa.uint64(), pa.int64()
            for at in range(0, len(out), 1 << 15):
                columns = [pa.array(c, k) for c, k in zip(zip(*out[at : at + (1 << 15)]), kinds)]
                columns[4:6] = [c.view(pa.int64()) for c in columns[4:6]]
                yield pa.RecordBatch.from_arrays(columns, names)

    names = ["anchor", "phrase", "offset", "n", "core", "unit", "weight"]
    return written(by_arrow(strings, run, "anchor long, phrase long, offset int, n int, core long, unit long, weight long"), "stretches")


def _by_counts(strings: DataFrame, window: int) -> DataFrame:
    """The same as ``_by_columns`` for anchors with many phrases."""
    cut = _cut(strings, window)
    units = written(cut.groupBy("anchor", "core", "unit").agg(F.sum("weight").alias("total")), "units")
    twice = written(units.filter("total > 1").select("anchor", "core", "unit"), "units-twice")
    whole = cut.join(twice, ["anchor", "core", "unit"], "left_semi").select("anchor", "phrase", "offset", "n")
    open_ = written(units.groupBy("anchor", "core").count().filter("count > 1").select("anchor", "core"), "open-cores")
    left = cut.join(open_, ["anchor", "core"], "left_semi")
    lists = written(left.groupBy("anchor", "phrase").agg(F.collect_list(F.struct("offset", "n")).alias("at")), "open-lists")
    met = strings.join(lists, ["anchor", "phrase"]).select("anchor", "phrase", "lead", "weight", "data", "at")

    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, 64):
                part = b.slice(at, 64)
                rows = zip(*(part.column(i).to_pylist() for i in range(5)), anchors.columns_of(part.column(5)))
                for anchor, phrase, lead, weight, data, (offset, n) in rows:
                    a = np.repeat(offset, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                    hashed = anchors.Hashes(symbols(data)).of(a, a + window) ^ (lead - a).astype(np.uint64)
                    same = lambda x, a=a: pa.array(np.full(len(a), x, np.int64))
                    columns = [same(anchor), same(phrase), pa.array(a.astype(np.int32)), pa.array(hashed.view(np.int64)), same(weight)]
                    yield pa.RecordBatch.from_arrays(columns, names)

    names = ["anchor", "phrase", "offset", "window", "weight"]
    windows = written(by_arrow(met, run, "anchor long, phrase long, offset int, window long, weight long"), "open-windows")
    again = written(windows.groupBy("anchor", "window").agg(F.sum("weight").alias("total")).filter("total > 1").select("anchor", "window"), "again")
    single = windows.join(again, ["anchor", "window"], "left_semi").select("anchor", "phrase", "offset", F.lit(1).alias("n"))
    return whole.unionByName(single)


def spans(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Written rows (of, spans): per document key, runs of windows that start elsewhere too, as start * 1024 + windows."""
    if window - gram + 1 >= 1024 or window - gram + 1 < STRETCH:
        raise ValueError("a run has 18 to 1023 windows at most")
    candidates, phrases, meeting = phrases_of(_runs(docs, window, gram), ("key", "start", "n", "lead"))
    strings = _strings(docs, meeting, window)
    few, many = strings.filter(F.col("of") <= MANY), strings.filter(F.col("of") > MANY)
    found = _by_columns(few, window).unionByName(_by_counts(many, window)) if not many.isEmpty() else _by_columns(few, window)
    found = written(found.withColumnsRenamed({"anchor": "a", "phrase": "p", "n": "m"}), "found")
    part = meeting.filter("count = 1").join(found, (F.col("anchor") == F.col("a")) & (F.col("phrase") == F.col("p")))
    part = part.select("place.key", (F.col("place.start") + F.col("offset")).alias("start"), F.col("m").alias("n"))
    both = whole_spans(candidates, phrases).unionByName(part)
    return written(both.groupBy(F.col("key").alias("of")).agg(F.collect_set(F.col("start") * 1024 + F.col("n")).alias("spans")), "byte-spans")


def dedup(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, gram: int = GRAM, with_bytes: bool = False
) -> DataFrame:
    """One row per document: its id, n_bytes, n_removed, n_spans, kept_sha256; ``with_bytes`` adds what is kept."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), row_key(doc_id, text).alias("key"), F.col(text).cast("binary").alias("text"))
    found = spans(rows.select("key", "text"), window, gram)

    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part, out = b.slice(at, 256), []
                for data, codes in zip(part.column(1).to_pylist(), part.column(2)):
                    data, removed, pieces = data or b"", 0, 0
                    kept = data
                    if codes.is_valid:
                        code = codes.values.to_numpy()
                        edge = np.zeros(len(data) + 1, np.int64)
                        np.add.at(edge, code >> 10, 1)
                        np.add.at(edge, (code >> 10) + (code & 1023) + window - 1, -1)
                        gone = np.cumsum(edge[:-1]) > 0
                        removed, pieces = int(gone.sum()), len(_stretches(gone)[0])
                        kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
                    out.append((len(data), removed, pieces, hashlib.sha256(kept).hexdigest(), kept if with_bytes else None))
                columns = [pa.array(c) for c in zip(*out)]
                yield pa.RecordBatch.from_arrays([part.column(0), *columns[: 4 + with_bytes]], names)

    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", *["kept"] * with_bytes]
    kind = docs.schema[doc_id].dataType.simpleString()
    schema = f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_bytes
    met = rows.join(found, F.col("key") == F.col("of"), "left").select("doc_id", "text", "spans")
    return by_arrow(met, run, schema).withColumnRenamed("doc_id", doc_id)
