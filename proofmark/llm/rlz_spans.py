"""Substring dedup over words: repeated windows by counted phrases, in place of a relative Lempel-Ziv parse.

A parse would factor each document greedily against every reference block. What is asked for is less: the words covered
by windows of ``WINDOW`` words whose sequence starts elsewhere too, and these come without factors. Every document is
a reference for every other. References are indexed by the phrases around their anchors (see ``anchors``); the index is
dealt over the cluster by hash, each part being one reference block. A phrase that the index holds twice is repeated as
a whole. A phrase that shares its anchor but not its whole with others has a repetition's boundary in it, and there alone
single windows are looked up. Neighbouring found windows join to the longest repeated spans. Nothing is sampled: a
window is found if and only if it starts elsewhere too.

Anchors, phrases and windows are compared by 64-bit hashes, windows and phrases together with their anchor's. Rows
per document are gathered (as many as it has runs), never rows per anchor: a passage in a third of all documents
gives one counted row per task and phrase. Rows that repeat whole share a key, and its spans are gathered once.

Defined cases: null text has no words; a document under ``WINDOW`` words loses none; very long texts are read whole, in
chunks of their windows; rows that repeat an id and text are copies of each other; an empty table gives an empty result;
extra columns never clash.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from proofmark.llm import anchors
from proofmark.llm.common import by_arrow, row_key, written

WINDOW = 35
GRAM = 5
BATCH = 1 << 18  # words whose runs are found at once


class WordHashes(dict):
    """Hashes of words, kept up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 600_000:
            self.clear()
        out = self[word] = xxhash.xxh3_64_intdigest(word)
        return out

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def _runs(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """Written rows (key, anchor, phrase, start, n)."""

    def run(batches):
        known, keys, texts, size = WordHashes(), [], [], 0

        def found():
            ends = np.cumsum([len(t) for t in texts])
            text, start, n, anchor, _, phrase = anchors.runs(np.concatenate(texts), ends, window, gram)
            begins = ends - np.array([len(t) for t in texts])
            columns = np.array(keys, np.int64)[text], anchor.view(np.int64), phrase.view(np.int64), (start - begins[text]), n.astype(np.int32)
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["key", "anchor", "phrase", "start", "n"])

        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                for key, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    words = (text or b"").split()
                    if len(words) >= window:
                        keys.append(key)
                        texts.append(known.of(words))
                        size += len(words)
                    if size >= BATCH:
                        yield found()
                        keys, texts, size = [], [], 0
        if texts:
            yield found()

    return written(by_arrow(docs, run, "key long, anchor long, phrase long, start long, n int"), "runs")


def _windows(docs: DataFrame, lists: DataFrame, window: int) -> DataFrame:
    """Written rows (anchor, phrase, offset, window, weight) of the phrases in ``lists``."""

    def run(batches):
        known = WordHashes()
        for b in batches:
            for at in range(0, b.num_rows, 64):
                part = b.slice(at, 64)
                for text, (start, n, anchor, phrase, weight) in zip(part.column(0).to_pylist(), anchors.columns_of(part.column(1))):
                    hashes = anchors.Hashes(known.of(text.split()))
                    row = np.repeat(np.arange(len(n)), n)
                    offset = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
                    begin = start[row] + offset
                    columns = anchor[row], phrase[row], offset.astype(np.int32), hashes.of(begin, begin + window).view(np.int64), weight[row]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

    names = ["anchor", "phrase", "offset", "window", "weight"]
    met = docs.join(lists, "key").select("text", "phrases")
    return written(by_arrow(met, run, "anchor long, phrase long, offset int, window long, weight long"), "windows")


def phrases_of(runs: DataFrame, place: tuple[str, ...] = ("key", "start", "n")) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Of the runs whose anchor repeats: the runs, their distinct phrases (with ``count`` and one ``place``), and the
    phrases that share their anchor with others. All are written tables."""
    repeated = written(runs.groupBy(F.col("anchor").alias("at")).count().filter("count > 1").select("at"), "anchors")
    candidates = written(runs.join(repeated, F.col("anchor") == F.col("at"), "left_semi"), "candidates")
    phrases = written(
        candidates.groupBy("anchor", "phrase").agg(
            F.count(F.lit(1)).alias("count"), F.min(F.struct(*place)).alias("place")
        ),
        "phrases",
    )
    several = written(phrases.groupBy(F.col("anchor").alias("at")).agg(F.count(F.lit(1)).alias("of")).filter("of > 1"), "several")
    meeting = written(phrases.join(several, F.col("anchor") == F.col("at")).drop("at"), "meeting")
    return candidates, phrases, meeting


def whole_spans(candidates: DataFrame, phrases: DataFrame) -> DataFrame:
    """(key, start, n) of every run whose whole phrase repeats."""
    twice = written(phrases.filter("count > 1").select(F.col("anchor").alias("a"), F.col("phrase").alias("p")), "twice")
    met = candidates.join(twice, (F.col("anchor") == F.col("a")) & (F.col("phrase") == F.col("p")), "left_semi")
    return met.select("key", "start", "n")


def spans(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Written rows (of, spans): per document key, runs of windows that start elsewhere too, as start * 64 + windows.

    ``docs``: (key, text as binary).
    """
    if window - gram + 1 > 63:
        raise ValueError("a run's windows are marked in 63 bits")
    candidates, phrases, meeting = phrases_of(_runs(docs, window, gram))
    weight = F.least(F.col("count"), F.lit(2)).alias("weight")
    each = F.struct(F.col("place.start").alias("start"), F.col("place.n").alias("n"), "anchor", "phrase", weight)
    lists = written(meeting.groupBy(F.col("place.key").alias("key")).agg(F.collect_list(each).alias("phrases")), "lists")
    windows = _windows(docs, lists, window)
    again = written(
        windows.groupBy(F.col("anchor").alias("a"), F.col("window").alias("w")).agg(F.sum("weight").alias("weight"))
        .filter("weight > 1").select("a", "w"),
        "again",
    )
    bit = F.bit_or(F.expr("shiftleft(1L, offset)")).alias("mask")
    hits = (
        windows.filter("weight = 1").join(again, (F.col("anchor") == F.col("a")) & (F.col("window") == F.col("w")), "left_semi")
        .groupBy(F.col("anchor").alias("a"), F.col("phrase").alias("p")).agg(bit)
    )
    part = meeting.filter("count = 1").join(written(hits, "hits"), (F.col("anchor") == F.col("a")) & (F.col("phrase") == F.col("p")))
    part = part.select("place.key", "place.start", "place.n", "mask").withColumn("offset", F.explode(F.expr("sequence(0, n - 1)")))
    part = part.filter("shiftright(mask, offset) & 1 = 1").select("key", (F.col("start") + F.col("offset")).alias("start"), F.lit(1).alias("n"))
    both = whole_spans(candidates, phrases).unionByName(part)
    code = F.col("start") * 64 + F.col("n")
    return written(both.groupBy(F.col("key").alias("of")).agg(F.collect_set(code).alias("spans")), "spans")


def covered(codes: np.ndarray, size: int, window: int) -> np.ndarray:
    """Which of ``size`` words a found window covers."""
    start, n = codes >> 6, codes & 63
    edge = np.zeros(size + 1, np.int64)
    np.add.at(edge, start, 1)
    np.add.at(edge, start + n + window - 1, -1)
    return np.cumsum(edge[:-1]) > 0


def dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, gram: int = GRAM, with_text: bool = False) -> DataFrame:
    """One row per document: its id, n_words, n_removed, kept_sha256; ``with_text`` adds the kept words."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), row_key(doc_id, text).alias("key"), F.col(text).cast("binary").alias("text"))
    found = spans(rows.select("key", "text"), window, gram)

    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part, out = b.slice(at, 256), []
                for t, codes in zip(part.column(1).to_pylist(), part.column(2)):
                    words, removed = (t or b"").split(), 0
                    kept = words
                    if codes.is_valid:
                        gone = covered(codes.values.to_numpy(), len(words), window)
                        removed = int(gone.sum())
                        kept = [w for w, g in zip(words, gone.tolist()) if not g]
                    joined = b" ".join(kept)
                    out.append((len(words), removed, hashlib.sha256(joined).hexdigest(), joined.decode() if with_text else None))
                columns = [pa.array(c) for c in zip(*out)]
                yield pa.RecordBatch.from_arrays([part.column(0), *columns[: 3 + with_text]], names)

    names = ["doc_id", "n_words", "n_removed", "kept_sha256", *["text"] * with_text]
    schema = f"doc_id {docs.schema[doc_id].dataType.simpleString()}, n_words long, n_removed long, kept_sha256 string" + ", text string" * with_text
    met = rows.join(found, F.col("key") == F.col("of"), "left").select("doc_id", "text", "spans")
    return by_arrow(met, run, schema).withColumnRenamed("doc_id", doc_id)
