"""LM scoring with a hashed maximum-entropy model and a class-factored softmax.

P(w | h) = P(class of w | h) * P(w | class, h). The context h gives three features, hashed to rows of weight tables:
the word before (bigram), the two words before (trigram), and the word before that one (skip). The words with a
share of at least 1 in ``HEAD`` have a class of up to ``SLOTS`` words by frequency, and a softmax over its words;
every other word has a class by its last two bytes, within which its probability is its smoothed share, with one
part left for all unknown words. So the model's probabilities add up to one over any vocabulary.

Training makes ``ROUNDS`` passes over disjoint parts of the training documents. In a pass each task starts from the
model, walks through its partition in batches of gradient steps (Adagrad), and gives back the change of its weights
times its tokens; the changes are added up over a tree of groups, and a row's is divided by the tokens of the partitions
that met it, so that a rare context learns as much as a frequent one, however many partitions there are. Scoring runs in numpy batches that
touch the rows of a batch's features only.

Counts of all training words stay a table. Those of words with a share of at least 1 in ``FREQUENT`` (fewer than
that many) go to the tasks, the rest are joined to the documents' rare words, one row per document and word.
Words are told apart by 64-bit hashes; the last bits are the class of a rare word. The words of a batch are found and
hashed together in numpy, so that no word of up to 16 bytes is a Python object.

Defined cases: null text counts as empty (one end token); a very long text is read whole, its gradient and score in batches
of ``STEP`` tokens; words with equal counts are ranked by their hash; a null id counts as the empty text for the fold; rows that
repeat an id are scored one by one; without training documents every word is unknown; an empty table gives an empty
result; extra columns never clash.
"""

from __future__ import annotations

import zlib
from itertools import chain, product
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from proofmark.llm.anchors import mix
from proofmark.llm.common import by_arrow, row_key, written

FOLDS, HELD_OUT = 7, 2
HEAD, SLOTS, TAILS = 1024, 32, 32
FREQUENT = 1 << 17
CLASS_ROWS = SLOT_ROWS = 1 << 14
FEATURES = 3
RATE = 0.15
STEP = 4096  # tokens of a gradient step, or of a batch to score
READ = 1 << 18  # tokens looked up at once
COUNTED = 1 << 20  # words a task counts before it gives some back
ROUNDS = 2
BLOCKS = 16
FAN = 64  # parts that one group of the tree adds up
END = b"\n"  # no word has a line break
SALTS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5], np.uint64)


def word_hash(word: bytes) -> int:
    """64 bits, the last of which are the word's class among the rare ones."""
    return xxhash.xxh3_64_intdigest(word) & ~(TAILS - 1) | zlib.crc32(word[-2:]) % TAILS


class Words(NamedTuple):
    """Hashes of the tokens of some texts, one text after the other; each ends in an end token."""

    hashes: np.ndarray
    lengths: np.ndarray

    @classmethod
    def of(cls, texts: list[bytes | None]) -> Words:
        joined = END.join(t or b"" for t in texts).lower() + END
        data = np.frombuffer(joined, np.uint8)
        sizes = np.fromiter((len(t or b"") + 1 for t in texts), np.int64, len(texts))
        apart = np.concatenate([[True], SPACES[data], [True]])
        edges = np.flatnonzero(apart[1:] != apart[:-1])
        starts, ends = edges[::2], edges[1::2]
        words = np.diff(np.searchsorted(starts, np.cumsum(sizes)), prepend=0)
        hashes = np.full(len(starts) + len(texts), word_hash(END), np.uint64)
        of_word = np.arange(len(starts)) + np.repeat(np.arange(len(texts)), words)
        for at in range(0, len(starts), READ):
            s = slice(at, at + READ)
            hashes[of_word[s]] = hashes_of(joined, data, starts[s], ends[s])
        return cls(hashes, words + 1)


SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
# The classes of a word's last two bytes; the lines after the first 256 are of single bytes.
CLASSES = np.array(
    [zlib.crc32(bytes(w)) % TAILS for w in chain(product(range(256), repeat=2), zip(range(256)))], np.uint64
)


def _shift(h: np.ndarray, by: int) -> np.ndarray:
    return h ^ (h >> np.uint64(by))


def _turn(h: np.ndarray, by: int) -> np.ndarray:
    return (h << np.uint64(by)) | (h >> np.uint64(64 - by))


def _folded(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The upper half of the 128-bit products, exclusive or the lower half."""
    half, low = np.uint64(32), np.uint64(0xFFFFFFFF)
    al, ah, bl, bh = a & low, a >> half, b & low, b >> half
    cross = ah * bl + (al * bl >> half)
    other = al * bh + (cross & low)
    return (ah * bh + (cross >> half) + (other >> half)) ^ (a * b)


def hashes_of(joined: bytes, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """``word_hash`` of the words ``joined[start:end]``: XXH3 (64 bits) by its definition for up to 16 bytes, together.

    ``data`` are the bytes of ``joined``. Only longer words go one by one.
    """
    n = ends - starts
    out = np.empty(len(n), np.uint64)
    read = lambda t, at: np.ndarray(max(0, len(joined) - np.dtype(t).itemsize + 1), t, joined, strides=1)[at].astype(np.uint64)
    k = np.flatnonzero(n <= 3)
    s, e, m = starts[k], ends[k], n[k]
    byte = lambda at: np.take(data, at).astype(np.uint64)
    x = byte(s) << np.uint64(16) | byte(s + (m >> 1)) << np.uint64(24) | byte(e - 1) | (m << 8).astype(np.uint64)
    x = _shift(x ^ np.uint64(0x87275A9B), 33) * np.uint64(0xC2B2AE3D27D4EB4F)
    out[k] = _shift(_shift(x, 29) * np.uint64(0x165667B19E3779F9), 32)
    k = np.flatnonzero((n > 3) & (n <= 8))
    s, e, m = starts[k], ends[k], n[k].astype(np.uint64)
    x = (read("<u4", e - 4) + (read("<u4", s) << np.uint64(32))) ^ np.uint64(0xC73AB174C5ECD5A2)
    x = (x ^ _turn(x, 49) ^ _turn(x, 24)) * np.uint64(0x9FB21C651E98DF25)
    out[k] = _shift((x ^ ((x >> np.uint64(35)) + m)) * np.uint64(0x9FB21C651E98DF25), 28)
    k = np.flatnonzero((n > 8) & (n <= 16))
    s, e, m = starts[k], ends[k], n[k].astype(np.uint64)
    low, high = read("<u8", s) ^ np.uint64(0x6782737BEA4239B9), read("<u8", e - 8) ^ np.uint64(0xAF56BC3B0996523A)
    x = _shift(m + low.byteswap() + high + _folded(low, high), 37) * np.uint64(0x165667919E3779F9)
    out[k] = _shift(x, 32)
    k = np.flatnonzero(n > 16)
    out[k] = [xxhash.xxh3_64_intdigest(joined[a:b]) for a, b in zip(starts[k].tolist(), ends[k].tolist())]
    last = np.where(n > 1, np.take(data, np.maximum(ends - 2, 0)).astype(np.int64) << 8, 1 << 16) + np.take(data, ends - 1)
    return out & ~np.uint64(TAILS - 1) | CLASSES[last]


class Tokens(NamedTuple):
    """Tokens of some texts, one after the other."""

    hashes: np.ndarray
    counts: np.ndarray  # -1: rare
    classes: np.ndarray
    slots: np.ndarray  # -1: none
    first: np.ndarray
    lengths: np.ndarray

    @classmethod
    def of(cls, words: Words, model: Model) -> Tokens:
        size, lengths = len(words.hashes), words.lengths
        known = np.empty(size, np.int64), np.empty(size, np.int32), np.empty(size, np.int32)
        for at in range(0, size, READ):
            s = slice(at, at + READ)
            for all_, part in zip(known, model.look_up(words.hashes[s])):
                all_[s] = part
        first = np.zeros(size, bool)
        first[np.cumsum(lengths) - lengths] = True
        return cls(words.hashes, *known, first, lengths)


class Model:
    """Classes from the counts, and the weights."""

    def __init__(self, hashes: np.ndarray, counts: np.ndarray, total: int, distinct: int, tail_counts: np.ndarray, tail_words: np.ndarray):
        """Frequent words in descending count; tail_*: tokens and words by class of all words."""
        self.total, self.distinct = total, distinct
        head = int((counts * HEAD >= max(total, 1)).sum())
        self.classes = -(-head // SLOTS)
        order = np.argsort(hashes)
        self.hashes, self.counts = hashes[order], counts[order]
        place = np.arange(len(hashes))
        self.place = np.where(place < head, place, -1)[order]  # class and slot of a head word
        left = tail_counts.copy(), tail_words.copy()
        for h, c in zip(hashes[:head].tolist(), counts[:head].tolist()):
            left[0][h % TAILS] -= c
            left[1][h % TAILS] -= 1
        self.tail_mass = np.log10(left[0] + left[1] + 1.0)
        of_class = np.zeros(self.classes * SLOTS)
        of_class[:head] = counts[:head]
        share = np.concatenate([of_class.reshape(-1, SLOTS).sum(1), left[0] + 1.0])
        self.class_bias = np.log(share / share.sum()).astype(np.float32)
        with np.errstate(divide="ignore"):
            self.slot_bias = np.log(of_class.reshape(-1, SLOTS)).astype(np.float32)
        self.weights = [
            np.zeros((CLASS_ROWS, self.classes + TAILS), np.float32), np.zeros((SLOT_ROWS, SLOTS), np.float32)
        ]

    def look_up(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Count (-1: rare), class and slot (-1: none) of each word."""
        tail = self.classes + (h % np.uint64(TAILS)).astype(np.int32)
        none = np.full(len(h), -1, np.int32)
        if not len(self.hashes):
            return none.astype(np.int64), tail.astype(np.int32), none
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        found = self.hashes[at] == h
        place = np.where(found, self.place[at], -1)
        head = place >= 0
        return (
            np.where(found, self.counts[at], -1), np.where(head, place // SLOTS, tail).astype(np.int32),
            np.where(head, place % SLOTS, -1).astype(np.int32),
        )

    @staticmethod
    def features(h: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Numbers of the rows, one line per feature; ``first`` marks the first token of a text."""
        one = np.concatenate([h[:1] * np.uint64(0), h[:-1]])
        one[first] = 0
        two = np.concatenate([one[:1] * np.uint64(0), one[:-1]])
        two[first] = 1
        keys = one * SALTS[0] + np.uint64(1), one * SALTS[1] + two * SALTS[2] + np.uint64(2), two * SALTS[3] + np.uint64(3)
        return np.stack([(mix(k) >> np.uint64(32)).astype(np.int64) for k in keys])

    def _exponents(self, k: int, bias: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Logits less a common bound, their exponentials, and the sums of these by token."""
        w = self.weights[k]
        x = np.take(w, rows[0], axis=0, mode="clip")
        more = np.empty_like(x)
        for i in range(1, FEATURES):
            x += np.take(w, rows[i], axis=0, out=more, mode="clip")
        x += bias
        x -= x.max()  # of the whole batch, which is faster than one by token
        powers = np.exp(x, out=more)
        total = powers @ np.ones(x.shape[1], np.float32)
        if total.min() < 1e-30:  # a token far below the others
            x -= x.max(axis=1, keepdims=True)
            powers = np.exp(x)
            total = powers.sum(axis=1)
        return x, powers, total

    def parts(self, f: np.ndarray, cls: np.ndarray, slot: np.ndarray):
        """The two softmaxes of a batch: (table, bias, rows by feature, wanted, tokens)."""
        yield 0, self.class_bias, (f % CLASS_ROWS).astype(np.uint16), cls, slice(None)
        head = np.nonzero(slot >= 0)[0]
        if len(head):
            mixed = (f[:, head] * 31 + cls[head].astype(np.int64) * 0x9E3779B1) % ((1 << 31) - 1)
            yield 1, np.take(self.slot_bias, cls[head], axis=0), (mixed % SLOT_ROWS).astype(np.uint16), slot[head], head

    def score(self, tokens: Tokens) -> np.ndarray:
        """log10 P of each token, but for the log10 (count + 1) of those without a slot."""
        f, cls, slot = self.features(tokens.hashes, tokens.first), tokens.classes, tokens.slots
        out = np.zeros(len(cls))
        for at in range(0, len(cls), STEP):
            s = slice(at, at + STEP)
            for k, bias, rows, wanted, where in self.parts(f[:, s], cls[s], slot[s]):
                x, _, total = self._exponents(k, bias, rows)
                out[s][where] += (x[np.arange(len(wanted)), wanted] - np.log(total)) / np.log(10)
        tail = slot < 0
        out[tail] -= self.tail_mass[cls[tail] - self.classes]
        return out

    def learn(self, tokens: Tokens, squares: list[np.ndarray]) -> None:
        """Gradient steps through the tokens; ``squares``: Adagrad's sums, from one."""
        f, cls, slot = self.features(tokens.hashes, tokens.first), tokens.classes, tokens.slots
        for at in range(0, len(cls), STEP):
            s = slice(at, at + STEP)
            for k, bias, rows, wanted, _ in self.parts(f[:, s], cls[s], slot[s]):
                free, slope, total = self._exponents(k, bias, rows)
                slope /= total[:, None]
                slope[np.arange(len(wanted)), wanted] -= 1
                w, past = self.weights[k], squares[k]
                for row in rows:
                    touched, step = sums_by_row(row, slope)
                    seen = np.take(past, touched, axis=0, out=free[: len(touched)], mode="clip")
                    seen += step * step
                    put(past, touched, seen)
                    step *= RATE
                    step /= np.sqrt(seen, out=seen)
                    np.take(w, touched, axis=0, out=seen, mode="clip")
                    seen -= step
                    put(w, touched, seen)


def sums_by_row(row: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct numbers in ``row``, and for each the sum of its lines of ``values``."""
    order = np.argsort(row, kind="stable")  # a radix sort, as the numbers have 16 bits
    sorted_ = row[order]
    new = np.ones(len(row) + 1, bool)
    np.not_equal(sorted_[1:], sorted_[:-1], out=new[1:-1])
    starts = np.flatnonzero(new[:-1])
    out = np.take(values, order[starts], axis=0)
    lines = np.flatnonzero(~(new[:-1] & new[1:]))
    if len(lines):  # most occur once in a batch and need no sum
        begins = np.flatnonzero(new[lines])
        several = np.flatnonzero(~new[starts + 1])
        out[several] = np.add.reduceat(np.take(values, order[lines], axis=0), begins, axis=0)
    return sorted_[starts].astype(np.int64), out


def put(table: np.ndarray, at: np.ndarray, lines: np.ndarray) -> None:
    """``table[at] = lines``, a whole line of each as one item, which is faster."""
    item = np.dtype((np.void, table.shape[1] * table.itemsize))
    table.view(item)[at] = lines.view(item)


def _texts(batches, model: Model, column: int):
    """(rows, their tokens) for about ``READ`` tokens at a time."""
    for b in batches:
        at, size = 0, 0
        hashes, lengths = Words.of(b.column(column).to_pylist())
        ends = np.cumsum(lengths)
        for k, end in enumerate(ends.tolist()):
            if end - size >= READ or k == b.num_rows - 1:
                yield b.slice(at, k + 1 - at), Tokens.of(Words(hashes[size:end], lengths[at : k + 1]), model)
                at, size = k + 1, end


def _counts(rows: DataFrame) -> DataFrame:
    """Written counts (word, n) of the training tokens."""

    def added(parts):
        words, n = (np.concatenate(x) for x in zip(*parts))
        distinct, at = np.unique(words, return_inverse=True)
        return distinct, np.bincount(at, n, len(distinct)).astype(np.int64)

    def full(words, n):
        for at in range(0, len(words), READ):
            part = words[at : at + READ].view(np.int64), n[at : at + READ]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in part], ["word", "n"])

    def run(batches):
        met = []
        for b in batches:
            met.append(np.unique(Words.of(b.column(0).to_pylist()).hashes, return_counts=True))
            if sum(len(words) for words, _ in met) > COUNTED:
                met = [added(met)]
                if len(met[0][0]) > COUNTED // 2:
                    yield from full(*met.pop())
        if met:
            yield from full(*added(met))

    seen = by_arrow(rows.filter("NOT held_out").select("text"), run, "word long, n long")
    return written(seen.groupBy("word").agg(F.sum("n").alias("n")), "word-counts")


def _added(changes: DataFrame) -> DataFrame:
    """Changes (block, part, tokens, data) added up: FAN parts in a group, level by level."""

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(len(pdf["data"].iat[0]) // 4)
        for data in pdf["data"]:
            total += np.frombuffer(data, np.float32)
        return pd.DataFrame({
            "block": pdf["block"].iloc[:1], "part": pdf["part"].iloc[:1] // FAN, "tokens": [pdf["tokens"].sum()],
            "data": [total.astype(np.float32).tobytes()],
        })

    schema = "block int, part int, tokens long, data binary"
    parts = changes.agg(F.max("part")).first()[0] or 0
    while parts or changes.count() > BLOCKS:
        changes = written(changes.groupBy("block", F.floor(F.col("part") / FAN)).applyInPandas(add, schema), "changes")
        parts //= FAN
        if not parts:
            break
    return changes


def fit(rows: DataFrame, counts: DataFrame) -> Model:
    """The model of the training rows (held_out, part, text); only counts by class, frequent words and weights come here."""
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    tails = {r["t"]: (r["n"], r["words"]) for r in counts.groupBy(F.pmod("word", F.lit(TAILS)).alias("t")).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("words")).collect()}
    frequent = counts.filter(F.col("n") * FREQUENT >= total).toPandas().sort_values(["n", "word"], ascending=[False, True])
    by_tail = np.array([tails.get(t, (0, 0)) for t in range(TAILS)], float)
    model = Model(frequent["word"].to_numpy(np.int64).view(np.uint64), frequent["n"].to_numpy(np.int64), total, distinct, by_tail[:, 0], by_tail[:, 1])
    context = rows.sparkSession.sparkContext
    for k in range(ROUNDS if total else 0):
        shared = context.broadcast(model)

        def run(batches, shared=shared):
            old, tokens = shared.value, 0
            mine = object.__new__(Model)
            mine.__dict__ = old.__dict__ | {"weights": [w.copy() for w in old.weights]}
            squares = [np.ones_like(w) for w in old.weights]
            for _, read in _texts(batches, old, 0):
                mine.learn(read, squares)
                tokens += len(read.hashes)
            if tokens:
                change = [(a - b).ravel() for a, b in zip(mine.weights, old.weights)]
                met = [(s > 1).any(axis=1).astype(np.float32) for s in squares]
                change = np.concatenate(change + met) * np.float32(tokens)
                for block, data in enumerate(np.array_split(change, BLOCKS)):
                    values = [block], [TaskContext.get().partitionId()], [tokens], [data.tobytes()]
                    kinds = pa.int32(), pa.int32(), pa.int64(), pa.binary()
                    yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, kinds)], ["block", "part", "tokens", "data"])

        part = rows.filter(~F.col("held_out") & (F.col("part") == k)).select("text")
        changes = _added(written(by_arrow(part, run, "block int, part int, tokens long, data binary"), "changes"))
        got = sorted(changes.collect(), key=lambda r: r["block"])
        if got:
            change = np.concatenate([np.frombuffer(r["data"], np.float32) for r in got])
            sizes = [w.size for w in model.weights] + [len(w) for w in model.weights]
            *changes, met, met_slots = np.split(change, np.cumsum(sizes)[:-1])
            model.weights = [
                w + c.reshape(w.shape) / np.maximum(m, 1)[:, None] for w, c, m in zip(model.weights, changes, (met, met_slots))
            ]
        shared.unpersist()
    return model


def score(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10)."""
    fold = F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), row_key(doc_id, text).alias("key"), (fold % FOLDS == HELD_OUT).alias("held_out"),
        (F.floor(fold / FOLDS) % ROUNDS).alias("part"), F.col(text).cast("binary").alias("text"),
    )
    counts = _counts(rows)
    model = fit(rows, counts)
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = shared.value
        for b, read in _texts(batches, model, 3):
            h, count, slot, lengths = read.hashes, read.counts, read.slots, read.lengths
            doc = np.repeat(np.arange(len(lengths)), lengths)
            known = count >= 0
            logs = np.where(known, np.log10(np.maximum(count, 0) + 1.0), 0.0)
            base = np.bincount(doc, logs, len(lengths)) - lengths * np.log10(model.total + model.distinct + 1.0)
            value = np.bincount(doc, model.score(read) + np.where(slot < 0, logs, 0.0), len(lengths))
            order = np.lexsort((h[~known], doc[~known]))
            d, w = doc[~known][order], h[~known][order]
            starts = np.flatnonzero(np.concatenate([[True], (d[1:] != d[:-1]) | (w[1:] != w[:-1])])) if len(d) else np.zeros(0, int)
            times = np.diff(np.append(starts, len(d)))
            ends = np.searchsorted(d[starts], np.arange(len(lengths) + 1))
            lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x)) for x in (w[starts].view(np.int64), times.astype(np.int32))]
            columns = [
                b.column(0), b.column(1), b.column(2), pa.array(lengths.astype(np.int64)),
                pa.array(np.bincount(doc, known, len(lengths)).astype(np.int64)), pa.array(base), pa.array(value), *lists,
            ]
            yield pa.RecordBatch.from_arrays(columns, names)

    names = ["doc_id", "key", "held_out", "n_tokens", "known", "base", "value", "words", "times"]
    kind = docs.schema[doc_id].dataType.simpleString()
    schema = f"doc_id {kind}, key long, held_out boolean, n_tokens long, known long, base double, value double, words array<long>, times array<int>"
    scored = written(by_arrow(rows.select("doc_id", "key", "held_out", "text"), run, schema), "scores")
    rare = scored.select("key", F.posexplode(F.arrays_zip("words", "times")).alias("at", "x")).select("key", "at", F.col("x.words").alias("w"), F.col("x.times").alias("times"))
    counts = counts.filter(F.col("n") * FREQUENT < model.total)
    met = rare.join(counts, F.col("w") == F.col("word"), "left")
    # Rows that repeat a document meet under one key, so sums are divided by how many there are.
    sums = met.groupBy(F.col("key").alias("of")).agg(
        F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + 1)).alias("logs"),
        F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("known_rare"),
        F.count_if(F.col("at") == 0).alias("rows"),
    )
    logs, rest = F.coalesce(F.col("logs") / F.col("rows"), F.lit(0.0)), F.coalesce(F.expr("known_rare div rows"), F.lit(0))
    return scored.join(sums, F.col("key") == F.col("of"), "left").select(
        F.col("doc_id").alias(doc_id), "held_out", "n_tokens", (F.col("known") + rest).alias("n_known"),
        F.lit(int(model.total)).cast("long").alias("train_tokens"), (F.col("base") + logs).alias("base_score"), (F.col("value") + logs).alias("score"),
    )
