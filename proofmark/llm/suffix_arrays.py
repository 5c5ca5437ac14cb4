"""Benchmark decontamination by suffix arrays of the training texts.

Whole documents form shards of some megabytes. A shard's words become numbers: the rank of a word's 64-bit hash among
the words of the test items, or zero, where every suffix ends, if no item has it. Stretches without zeros that could
hold a window go into a suffix array: sorted by the numbers that fit a 64-bit key, then by prefix doubling where keys
tie, down to the longest item. Every test suffix is searched in every shard, all at once: its interval of the array is
narrowed word by word by binary search (``search``). The interval at a window's length has all places of that window;
the last interval that is not empty has the longest verbatim matches. Hit words, items and the longest match come out
per document, and ``clean`` drops the documents with a hit.

A shard never outgrows its texts, and nothing is shuffled: a passage that a third of all documents hold is one interval
in each shard. The test items are sent to the tasks in blocks of at most ``BLOCK_WORDS`` words, which are counted
before; more items take more passes over the documents, whose hits are carried along and joined.

Defined cases: null text has no words, nor has a null item; an item under ``WINDOW`` words is one window; a very long
document is a shard of its own, a very long item is cut into parts of ``ITEM_WORDS`` words that overlap by a window;
equal windows of several items count for each; rows that repeat an item id count as one item, a null item id is
written as the empty string; rows that repeat a document are judged alike, each in its own row; without items nothing
is hit; an empty table gives an empty result; extra columns never clash.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from proofmark.llm import anchors
from proofmark.llm.common import by_arrow, by_bytes, rowed, unrowed, written

WINDOW = 10
SHARD = 4 << 20  # bytes of text
BLOCK_WORDS = 1 << 20  # 8 MB of hashes
ITEM_WORDS = 1 << 14
HASHED = 1 << 20  # bytes hashed at once
LONG = 1 << 16  # words of more bytes are hashed by themselves

_bytes = np.arange(256, dtype=np.uint8)
_bytes[0x41:0x5B] += 0x20
_bytes[[*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = 0
LOWERED = _bytes  # a word's byte in lower case, or zero between words
SYMBOLS = anchors.mix(np.arange(1, 257, dtype=np.uint64))


def words_of(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, words up to the end of each text) of texts that follow one another in ``data``."""
    low = LOWERED[data]
    inner = low > 0
    first, last = inner.copy(), inner.copy()
    first[1:] &= ~inner[:-1]
    last[:-1] &= ~inner[1:]
    begins = np.concatenate([[0], ends])[:-1]
    begins, stops = begins[begins < ends], ends[begins < ends]
    first[begins] = inner[begins]
    last[stops - 1] = inner[stops - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    hashes, at = np.empty(len(start), np.uint64), 0
    while at < len(start):
        if end[at] - start[at] > LONG:
            hashes[at] = xxhash.xxh3_64_intdigest(low[start[at] : end[at]].tobytes())
            at += 1
            continue
        to = max(at + 1, int(np.searchsorted(end, start[at] + HASHED, "right")))
        long = np.flatnonzero(end[at:to] - start[at:to] > LONG)
        to = at + int(long[0]) if len(long) else to
        base = start[at]
        hashes[at:to] = anchors.Hashes(SYMBOLS[low[base : end[to - 1]]]).of(start[at:to] - base, end[at:to] - base)
        at = to
    return hashes, np.searchsorted(end, ends, "right")


def texts_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, end of each text) of a string column; null is empty."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets[1:] - offsets[0]


@dataclass
class Items:
    """Test items as numbers: ``symbols`` has one item part after the other, zeros between them.

    ``suffix`` are the places a window starts at, ``need`` its words; ``item`` is the item's number, ``offset`` its
    first word's place, of every suffix. ``depth`` is the length of the longest part.
    """

    vocabulary: np.ndarray
    symbols: np.ndarray
    suffix: np.ndarray
    need: np.ndarray
    item: np.ndarray
    offset: np.ndarray
    names: list[str]
    depth: int

    @classmethod
    def of(cls, parts: list[tuple[str, int, np.ndarray]], window: int) -> Items:
        """From (item id, place of the first word, hashes of the words)."""
        names = sorted({name for name, _, _ in parts})
        number = {name: k for k, name in enumerate(names)}
        vocabulary = np.unique(np.concatenate([w for _, _, w in parts]))
        zero, at = np.zeros(1, np.int64), 0
        symbols, suffix, need, item, offset = [], [], [], [], []
        for name, begin, words in parts:
            symbols += [np.searchsorted(vocabulary, words) + 1, zero]
            windows = max(1, len(words) - window + 1)
            suffix.append(at + np.arange(windows))
            need.append(np.full(windows, min(window, len(words))))
            item.append(np.full(windows, number[name]))
            offset.append(begin + np.arange(windows))
            at += len(words) + 1
        return cls(vocabulary, *map(np.concatenate, (symbols, suffix, need, item, offset)), names, max(len(w) for _, _, w in parts))

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        place = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[place] == hashes, place + 1, 0)


def suffix_array(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Starts of the suffixes, each up to its next zero, in order as far as ``depth`` symbols tell them apart.

    ``symbols`` ends in a zero; suffixes of no symbol are left out.
    """
    bits = max(1, int(symbols.max(initial=0)).bit_length())
    known = max(1, min(63 // bits, 16))
    key, open_ = np.zeros(len(symbols), np.int64), np.ones(len(symbols), bool)
    for k in range(known):
        ahead = np.zeros(len(symbols), np.int64)
        ahead[: max(0, len(symbols) - k)] = symbols[k:]
        open_ &= ahead > 0
        key = (key << bits) | np.where(open_, ahead, 0)
    starts = np.flatnonzero(symbols)
    order = starts[np.argsort(key[starts])]
    first = np.concatenate([[True], key[order[1:]] != key[order[:-1]]])[: len(order)]
    rank = np.zeros(len(symbols) + 1, np.int64)
    rank[order] = np.maximum.accumulate(np.where(first, np.arange(len(order)), 0)) + 1
    tied = np.arange(len(order))
    while known < depth:
        same = rank[order[tied]]
        alone = np.concatenate([[True], same[1:] != same[:-1]])[: len(same)]
        alone &= np.concatenate([alone[1:], [True]])[: len(same)]
        tied = tied[~alone & open_[order[tied]]]
        if not len(tied):
            break
        group, second = rank[order[tied]], rank[order[tied] + known]
        by = np.argsort(group * len(rank) + second)
        order[tied] = order[tied[by]]
        group, second = group[by], second[by]
        new = np.concatenate([[True], (group[1:] != group[:-1]) | (second[1:] != second[:-1])])
        head = np.concatenate([[True], group[1:] != group[:-1]])
        place = np.arange(len(tied))
        begin = np.maximum.accumulate(np.where(head, place, 0))
        rank[order[tied]] = group + np.maximum.accumulate(np.where(new, place, 0)) - begin
        open_[order[tied]] = open_[order[tied] + known]
        known *= 2
    return order


def search(symbols: np.ndarray, order: np.ndarray, items: Items):
    """Each test suffix in the suffix array: (low, high, suffix) of all its window's places, and a list of (words,
    low, high, suffix) with longer and longer matches wherever the interval gets smaller."""
    low, high = np.zeros(len(items.suffix), np.int64), np.full(len(items.suffix), len(order))
    live, depth, found, longest = np.arange(len(items.suffix)), 0, [], []
    while len(live):
        wanted = items.symbols[items.suffix[live] + depth]
        edges = []
        for bound in (wanted, wanted + 1):  # first place of at least the wanted symbol, and of more
            a, b = low[live].copy(), high[live].copy()
            while (going := a < b).any():
                middle = (a + b) >> 1
                less = going & (symbols[order[np.where(going, middle, low[live])] + depth] < bound)
                a, b = np.where(less, middle + 1, a), np.where(going & ~less, middle, b)
            edges.append(a)
        edges[1] = np.where(wanted > 0, edges[1], edges[0])
        smaller = (edges[1] - edges[0] < high[live] - low[live]) & (depth >= items.need[live])
        longest.append((np.full(smaller.sum(), depth), low[live[smaller]], high[live[smaller]], live[smaller]))
        matched = edges[0] < edges[1]
        low[live], high[live] = edges
        live, depth = live[matched], depth + 1
        whole = live[items.need[live] == depth]
        found.append((low[whole], high[whole], whole))
    join = lambda rows, n: [np.concatenate(c) for c in zip(*rows)] if rows else [np.zeros(0, np.int64)] * n
    return join(found, 3), join(longest, 4)


def located(hashes: np.ndarray, ends: np.ndarray, items: Items):
    """(is hit, by word), (document, item) pairs without repeats, and (length, suffix) of each word's longest match."""
    numbers = items.numbers(hashes)
    breaks = np.zeros(len(numbers) + 1, bool)
    breaks[ends] = True
    known = np.append(numbers > 0, False)
    head = known.copy()
    head[1:] &= ~known[:-1] | breaks[1:]
    starts, unknown = np.flatnonzero(head), np.flatnonzero(~known)
    stops = np.minimum(unknown[np.searchsorted(unknown, starts)], ends[np.searchsorted(ends, starts, "right")])
    fits = stops - starts >= items.need.min()
    starts, sizes = starts[fits], (stops - starts)[fits]
    # stretches that could hold a window, a zero behind each; ``word`` leads back to the text
    at = np.cumsum(sizes + 1) - sizes - 1
    word = np.repeat(starts - at, sizes + 1) + np.arange(int((sizes + 1).sum()))
    symbols = numbers[np.minimum(word, max(len(numbers) - 1, 0))] if len(numbers) else word
    symbols[at + sizes] = 0
    order = suffix_array(symbols, items.depth)
    (low, high, suffix), (length, from_, to, long) = search(symbols, order, items)

    # equal windows of several items have the same interval at the same length, and are taken once
    _, one, same = np.unique(items.need[suffix] * (len(order) + 1) + low, return_index=True, return_inverse=True)
    size = (high - low)[one]
    of = np.repeat(np.arange(len(size)), size)
    places = word[order[np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(low[one], size)]]
    count = lambda x: np.bincount(x, minlength=len(numbers) + 1)
    hit = np.cumsum(count(places) - count(places + items.need[suffix][one][of]))[:-1] > 0

    held = np.unique(np.searchsorted(ends, places, "right") * max(len(size), 1) + of)
    document, window = np.divmod(held, max(len(size), 1))
    by = np.unique(same * len(items.names) + items.item[suffix])
    ranges_of, item = np.divmod(by, len(items.names))
    begin, stop = np.searchsorted(ranges_of, window), np.searchsorted(ranges_of, window, "right")
    row = np.repeat(np.arange(len(held)), stop - begin)
    pick = np.arange(len(row)) - np.repeat(np.cumsum(stop - begin) - (stop - begin), stop - begin) + begin[row]
    pairs = np.unique(document[row] * len(items.names) + item[pick])

    best, source = np.zeros(len(numbers), np.int64), np.zeros(len(numbers), np.int64)
    rows = np.lexsort((-long, from_, length))
    unlike = np.ones(len(rows), bool)  # of equal intervals, the last counts: the first suffix
    for x in (length, from_, to):
        unlike[:-1] &= x[rows[1:]] == x[rows[:-1]]
    unlike[:-1] = ~unlike[:-1]
    for k in rows[unlike]:
        there = word[order[from_[k] : to[k]]]
        best[there], source[there] = length[k], long[k]
    return hit, np.divmod(pairs, len(items.names)), best, source


HITS = """n_words long, n_hit long, hits array<struct<start:long,end:long>>, items array<string>,
longest long, longest_at long, longest_item string, longest_item_at long"""
SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _pass(rows: DataFrame, items, size: int) -> DataFrame:
    """One block of items against all documents; rows have ``_row``, ``_text`` and the columns of ``HITS`` so far."""

    types = [pa.int64(), pa.int64(), SPANS, pa.list_(pa.string()), pa.int64(), pa.int64(), pa.string(), pa.int64()]

    def shard(batch):
        hashes, ends = words_of(*texts_of(batch.column(1)))
        block = items.value
        hit, (document, item), best, source = located(hashes, ends, block)
        lists = np.searchsorted(document, np.arange(len(ends) + 1))
        before = batch.select(batch.schema.names[2:]).to_pylist()
        out = []
        for k, (a, b) in enumerate(zip(np.concatenate([[0], ends]), ends)):
            was, mine = before[k], hit[a:b]
            for span in was["hits"] or ():
                mine[span["start"] : span["end"]] = True
            edges = np.flatnonzero(np.diff(mine, prepend=False, append=False)) if mine.any() else ()
            names = {block.names[i] for i in item[lists[k] : lists[k + 1]]} | set(was["items"] or ())
            top = was["longest"] or 0, was["longest_at"], was["longest_item"], was["longest_item_at"]
            deepest = int(np.argmax(best[a:b])) if len(edges) else 0
            if len(edges) and best[a + deepest] > top[0]:
                s = source[a + deepest]
                top = int(best[a + deepest]), deepest, block.names[block.item[s]], int(block.offset[s])
            spans = [{"start": int(x), "end": int(y)} for x, y in zip(edges[::2], edges[1::2])]
            out.append((int(b - a), int(mine.sum()), spans, sorted(names), *top))
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *map(pa.array, zip(*out), types)], batch.schema.names)

    def run(batches):
        for batch in batches:
            for part in by_bytes(batch, 1, size):
                yield shard(part)

    return by_arrow(rows, run, rows.schema)


def _parts(items: DataFrame, item_id: str, text: str, window: int) -> DataFrame:
    """Written rows (item, begin, n, words): items as hashes of their words, very long ones in parts."""

    def run(batches):
        for batch in batches:
            for part in by_bytes(batch, 1):
                names, out = part.column(0).to_pylist(), []
                hashes, ends = words_of(*texts_of(part.column(1)))
                for name, a, b in zip(names, np.concatenate([[0], ends]), ends):
                    for at in range(0, max(b - a - window + 1, min(b - a, 1)), ITEM_WORDS):
                        words = hashes[a + at : min(b, a + at + ITEM_WORDS + window - 1)]
                        out.append((name or "", at, len(words), words.tobytes()))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], ["item", "begin", "n", "words"])

    rows = items.select(F.col(item_id).cast("string").alias("item"), F.col(text).alias("text"))
    parts = by_arrow(rows, run, "item string, begin long, n long, words binary")
    return written(parts.dropDuplicates(["item", "begin", "words"]), "items")


def _found(docs: DataFrame, text: str, items: DataFrame, item_id: str, item_text: str, window: int, shard: int, block_words: int):
    """``docs`` as ``_row`` and ``_text`` with the columns of ``HITS``."""
    spark = docs.sparkSession
    parts = _parts(items, item_id, item_text, window)
    total = parts.agg(F.sum("n")).first()[0] or 0
    blocks = max(1, -(-total // block_words))
    rows = rowed(docs).withColumn("_text", F.col("_row").getField(text))
    hits = T.StructType.fromDDL(HITS)
    rows = rows.select("_row", "_text", *[F.lit(None).cast(f.dataType).alias(f.name) for f in hits])
    for k in range(blocks):
        mine = parts.filter(F.pmod(F.xxhash64("item", "begin"), F.lit(blocks)) == k) if blocks > 1 else parts
        listed = [(r.item, r.begin, np.frombuffer(r.words, np.uint64)) for r in mine.orderBy("item", "begin", "words").collect()]
        if not total:  # one window that no text has
            listed = [("", 0, np.zeros(window, np.uint64))]
        if listed:
            rows = _pass(rows, spark.sparkContext.broadcast(Items.of(listed, window)), shard)
            if k < blocks - 1:
                rows = written(rows, f"hits-{k}")
    return rows


def find(
    docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text",
    window: int = WINDOW, shard: int = SHARD, block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """One row per document: ``doc_id`` and the columns of ``HITS``.

    ``hits`` are the hit stretches of words (start, end), ``items`` the ids of the items with a window in the
    document, sorted. The longest verbatim match, of a window's words at least, begins at word ``longest_at`` of the
    document and ``longest_item_at`` of the item; of equals, the first in the document, then in the items, counts.
    """
    plain = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    rows = _found(plain, "text", items, item_id, item_text, window, shard, block_words)
    return rows.select(F.col("_row.doc_id").alias("doc_id"), *T.StructType.fromDDL(HITS).names)


def clean(
    docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
    window: int = WINDOW, shard: int = SHARD, block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """The documents without a hit."""
    rows = _found(docs, text, items, item_id, item_text, window, shard, block_words)
    return unrowed(rows.filter("n_hit = 0"), docs.columns)
