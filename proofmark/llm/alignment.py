"""Cross-tokenizer alignment by galloping intersection of token ends.

Two tokenizers cut the same bytes, a space and the text, into tokens A and B. The ends of both are two ascending lists;
the shorter one drives an exponential and then a binary search into the longer (``common_ends``). The common ends cut
the tokens into groups, and differences of ranks in the other list say which tokens of one side a token of the other
overlaps (``Pieces.learn``).

Both tokenizers always cut in front of a single space between two other characters, so the alignment of a text is that
of its pieces. A batch's new pieces are encoded and aligned as one text. A worker keeps what it knows of pieces up to
``CACHE`` bytes, and beyond that of those met most often. What cannot be cut is one piece, however long.

One pass over the texts writes each document's row with its links, each id pair once with how often it occurs. The
pairs are summed over all documents, per task before the shuffle. The counts then go to the tasks in slices of at most
``PAIRS`` id pairs, counted before, and each document looks up its pairs; more pairs take more passes over the rows,
not over the texts, each of which adds its share. No text is shuffled.

Defined cases: a null or empty text, and one that a tokenizer does not give back byte by byte, has no tokens: zeros
and an empty ``groups``; special tokens' strings are plain text; very long texts are aligned whole; of several A ids
that a B id is linked with most often, all are best; repeated rows count as often as they occur, each in its own row;
an empty table gives an empty result; extra columns never clash.
"""

from __future__ import annotations

import hashlib
import os
import re
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from proofmark.llm import tokens
from proofmark.llm.common import by_arrow, by_bytes, written

CACHE = 64 << 20  # bytes of pieces and what is known of them, kept by a worker
RUN = 64
PAIRS = 1 << 21  # id pairs sent to the tasks, or held by one, at once
JOINED = 1 << 18  # bytes of new pieces encoded at once
CUT = re.compile(r"(?<=\S) (?=\S)")
MARK = "▁"


def common_ends(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranks, in either list, of the ends that both ascending lists have.

    The shorter list drives: for every ``RUN`` of its ends, steps that double from the place reached so far find a
    stretch of the longer list that reaches the last of them, and a binary search in it each of them.
    """
    if len(left) > len(right):
        return common_ends(right, left)[::-1]
    mine, theirs, at = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0
    for low in range(0, len(left), RUN):
        run, step = left[low : low + RUN], len(left[low : low + RUN])
        while at + step < len(right) and right[at + step - 1] < run[-1]:
            step *= 2
        stretch = right[at : at + step]
        place = np.searchsorted(stretch, run)
        same = np.flatnonzero(place < len(stretch))
        same = same[stretch[place[same]] == run[same]]
        mine.append(same + low)
        theirs.append(place[same] + at)
        at += int(place[-1])
    return np.concatenate(mine), np.concatenate(theirs)


class Tokenizers:
    """Both tokenizers, and the bytes of each of their ids."""

    _made: dict = {}

    def __init__(self, file_a: str, file_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(file_a)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=file_b)
        back = {c: b for b, c in tokens.byte_alphabet().items()}
        vocabulary = sorted(self.a.get_vocab().items(), key=lambda x: x[1])
        self.bytes_a = [bytes(map(back.get, t)) if set(t) <= back.keys() else t.encode() for t, _ in vocabulary]
        pieces = [self.b.id_to_piece(k) for k in range(self.b.get_piece_size())]
        if any(MARK in p.lstrip(MARK) for p in pieces):
            raise ValueError("a piece goes on behind a space, so texts can't be cut there")
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(k) else p.replace(MARK, " ").encode() for k, p in enumerate(pieces)]
        self.sizes = [np.array(list(map(len, x)), np.int64) for x in (self.bytes_a, self.bytes_b)]
        self.names = [np.array([str(k) for k in range(len(x))], object) for x in (self.bytes_a, self.bytes_b)]
        self.pairs = len(self.bytes_a) * len(self.bytes_b)
        self.kind = np.uint32 if self.pairs < 1 << 32 else np.int64  # of an id pair

    @classmethod
    def of(cls, *files: str):
        """One pair per files and worker."""
        if files not in cls._made:
            cls._made[files] = cls(*files)
        return cls._made[files]

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of A and B of a text with a space in front, or None if one of them does not give its bytes back."""
        if MARK in text:  # B gives a space back
            return None
        a = self.a.encode_batch_fast([" " + text], add_special_tokens=False)[0].ids
        b = self.b.encode(text, num_threads=1)
        whole = b" " + text.encode()
        if b"".join(map(self.bytes_a.__getitem__, a)) != whole or b"".join(map(self.bytes_b.__getitem__, b)) != whole:
            return None
        return np.array(a, np.int64), np.array(b, np.int64)


def _reduced(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Sums between neighbouring edges."""
    sums = np.concatenate([[0], np.cumsum(values)])
    return sums[edges[1:]] - sums[edges[:-1]]


class Pieces:
    """``index`` is the rank of each known piece; rank 0 is the piece that has no tokens, as its text is not given back.

    By rank: ``numbers`` (tokens of A and B, groups, links), ``groups``, from ``edges`` the id pairs of its links in
    ``pairs``, and how often it was ``met``.
    """

    _kept: dict = {}

    def __init__(self, tokenizers: Tokenizers, cache: int = CACHE):
        self.tokenizers, self.cache, self.index = tokenizers, cache, {}
        self.numbers, self.groups, self.keys_, self.costs = np.zeros((1, 4), np.int64), [""], [""], np.zeros(1, np.int64)
        self.edges, self.pairs, self.met = np.zeros(2, np.int64), np.zeros(0, np.int64), np.zeros(1, np.int64)

    @classmethod
    def of(cls, files: tuple[str, str], cache: int) -> Pieces:
        """The worker's pieces, at most ``cache`` bytes of them between batches."""
        if (files, cache) not in cls._kept:
            cls._kept.clear()
            cls._kept[files, cache] = cls(Tokenizers.of(*files), cache)
        return cls._kept[files, cache]

    def trim(self) -> None:
        """Beyond the bound, only the pieces met most often stay, as many as half of it holds."""
        if self.costs.sum() <= self.cache:
            return
        order = np.argsort(-self.met, kind="stable")
        order = order[(np.cumsum(self.costs[order]) <= self.cache // 2) & (order > 0)]
        stay = np.concatenate([[0], np.sort(order)])
        sizes = np.diff(self.edges)
        self.pairs = self.pairs[np.repeat(np.isin(np.arange(len(sizes)), stay), sizes)]
        self.edges = np.concatenate([[0], np.cumsum(sizes[stay])])
        self.numbers, self.costs, self.met = self.numbers[stay], self.costs[stay], self.met[stay] // 2
        self.groups, self.keys_ = [self.groups[r] for r in stay], [self.keys_[r] for r in stay]
        self.index = dict(zip(self.keys_[1:], range(1, len(self.keys_))))

    def of_text(self, text: str) -> list[str]:
        """Keys of a text's pieces. A key is the piece behind its space; one with white space at an end, which can't be
        cut there in other texts, is marked by a space."""
        keys = text.split(" ")
        if not all(k and k == k.strip() for k in set(keys).difference(self.index)):
            keys = [k if k and k == k.strip() else " " + k for k in CUT.split(text)]
        return keys

    def learn(self, keys: list[str]) -> None:
        """Encode and align new pieces, as many at once as ``JOINED`` bytes have; marked ones must not meet others."""
        for key in keys:
            if key.startswith(" "):
                self._learn([key])
        keys, low = [k for k in keys if not k.startswith(" ")], 0
        while low < len(keys):
            high, size = low + 1, len(keys[low])
            while high < len(keys) and size < JOINED:
                size, high = size + len(keys[high]) + 1, high + 1
            self._learn(keys[low:high])
            low = high

    def _learn(self, keys: list[str]) -> None:
        texts = [k.removeprefix(" ") for k in keys]
        ids = self.tokenizers.encode(" ".join(texts))
        if ids is None:
            if len(keys) == 1:
                self.index[keys[0]] = 0
            else:
                half = len(keys) // 2
                self._learn(keys[:half])
                self._learn(keys[half:])
            return
        a, b = ids
        ends_a, ends_b = (np.cumsum(s[x]) for s, x in zip(self.tokenizers.sizes, ids))
        rank_a, rank_b = common_ends(ends_a, ends_b)
        piece_ends = np.cumsum([len(t.encode()) + 1 for t in texts])
        # links: from the rank of a token's start in the other list to the rank of its end
        last = np.searchsorted(ends_b, ends_a)
        first = np.concatenate([[0], last[:-1]])
        first[1:] += ends_b[first[1:]] == ends_a[:-1]
        links = last - first + 1
        of = np.repeat(np.arange(len(a)), links)
        other = np.arange(len(of)) - np.repeat(np.cumsum(links) - links, links) + first[of]
        pairs = a[of] * len(self.tokenizers.bytes_b) + b[other]
        edge = lambda ends: np.concatenate([[0], np.searchsorted(ends, piece_ends, "right")])
        at_a, at_b, at_group = edge(ends_a), edge(ends_b), edge(ends_a[rank_a])
        at_link = np.concatenate([[0], np.cumsum(links)])[at_a]
        # every group as its ids, with the sign that follows each
        sign_a, sign_b = np.full(len(a), ",", object), np.full(len(b), ",", object)
        sign_a[rank_a], sign_b[rank_b] = "|", ";"
        group_a, group_b = np.searchsorted(rank_a, np.arange(len(a))), np.searchsorted(rank_b, np.arange(len(b)))
        names = np.concatenate([self.tokenizers.names[0][a] + sign_a, self.tokenizers.names[1][b] + sign_b])
        listed = names[np.argsort(np.concatenate([group_a * 2, group_b * 2 + 1]), kind="stable")].tolist()
        at_name = (at_a + at_b).tolist()
        groups = ["".join(listed[x:y])[:-1] for x, y in zip(at_name[:-1], at_name[1:])]
        numbers = np.stack([np.diff(at_a), np.diff(at_b), np.diff(at_group), np.diff(at_link)], axis=1)
        self.index.update(zip(keys, range(len(self.numbers), len(self.numbers) + len(keys))))
        self.edges = np.concatenate([self.edges, self.edges[-1] + at_link[1:]])
        self.pairs = np.concatenate([self.pairs, pairs])
        self.numbers = np.concatenate([self.numbers, numbers])
        self.met = np.concatenate([self.met, np.zeros(len(keys), np.int64)])
        self.groups += groups
        self.keys_ += keys
        text_bytes = np.fromiter(map(len, groups), np.int64, len(keys)) + np.diff(piece_ends, prepend=0)
        self.costs = np.concatenate([self.costs, text_bytes + 8 * np.diff(at_link) + 250])

    def ranks(self, texts: list[str]):
        """Ranks of all pieces of the texts, and the pieces up to the end of each; none for texts without tokens."""
        keys = [self.of_text(t) if t else [] for t in texts]
        self.learn(list(dict.fromkeys(k for x in keys for k in set(x).difference(self.index))))
        ends = np.cumsum([0, *map(len, keys)])
        ranks = np.fromiter(map(self.index.__getitem__, chain.from_iterable(keys)), np.int64, int(ends[-1]))
        self.met += np.bincount(ranks, minlength=len(self.met))
        good = _reduced(ranks == 0, ends) == 0
        sizes = np.where(good, np.diff(ends), 0)
        return ranks[np.repeat(good, np.diff(ends))], np.concatenate([[0], np.cumsum(sizes)])

    def links(self, ranks: np.ndarray, edges: np.ndarray):
        """(id pair, how often, pairs up to the end of each text): the texts' links, each pair of a text once."""
        sizes = np.diff(self.edges)[ranks]
        at = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes - self.edges[ranks], sizes)
        text = np.repeat(np.repeat(np.arange(len(edges) - 1), np.diff(edges)), sizes)
        span = self.tokenizers.pairs
        pair, times = np.unique(text * span + self.pairs[at], return_counts=True)
        text, pair = np.divmod(pair, span)
        return pair, times, np.searchsorted(text, np.arange(len(edges)))


NUMBERS = ["n_a", "n_b", "n_groups", "n_links"]


def _aligned(docs: DataFrame, doc_id: str, text: str, files: tuple[str, str], cache: int, with_groups: bool) -> DataFrame:
    """Written rows (doc_id, numbers, groups_sha256, groups if asked for, pairs, times): a document's links by id pair."""
    columns = ["doc_id", *NUMBERS, "groups_sha256", *["groups"] * with_groups, "pairs", "times"]

    def run(batches):
        pieces = Pieces.of(files, cache)
        kind = pieces.tokenizers.kind
        for batch in batches:
            for part in by_bytes(batch, 1):
                ranks, edges = pieces.ranks(part.column(1).to_pylist())
                sums = [_reduced(x, edges) for x in pieces.numbers[ranks].T]
                listed = ranks.tolist()
                groups = [";".join([pieces.groups[r] for r in listed[x:y]]) for x, y in zip(edges[:-1], edges[1:])]
                pair, times, ends = pieces.links(ranks, edges)
                lists = [[x[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:])] for x in (pair.astype(kind), times.astype(np.uint32))]
                digests = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in groups]
                out = [part.column(0), *sums, digests, *[groups] * with_groups, *lists]
                yield pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x) for x in out], columns)
                pieces.trim()

    id_type = docs.schema[doc_id].dataType.simpleString()
    schema = ", ".join([f"doc_id {id_type}", *[f"{c} long" for c in NUMBERS], *[f"{c} string" for c in columns[5:-2]], "pairs binary", "times binary"])
    return written(by_arrow(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), run, schema), "aligned")


def _joined(batch: pa.RecordBatch, kind: type) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(pairs, times, pairs up to the end of each row) of a batch whose last columns they are."""
    pairs, times = (batch.column(batch.num_columns - k).to_pylist() for k in (2, 1))
    sizes = [len(t) // 4 for t in times]
    return np.frombuffer(b"".join(pairs), kind).astype(np.int64), np.frombuffer(b"".join(times), np.uint32).astype(np.int64), np.cumsum([0, *sizes])


def _pair_counts(aligned: DataFrame, files: tuple[str, str]) -> DataFrame:
    """Written rows (pair, count, best): how many links of all texts hold the two ids, and whether B has none more often."""

    def run(batches):
        tokenizers = Tokenizers.of(*files)
        known, total = np.zeros(0, np.int64), np.zeros(0, np.int64)

        def rows():
            return pa.RecordBatch.from_arrays([pa.array(known), pa.array(known % len(tokenizers.bytes_b)), pa.array(total)], ["pair", "b", "n"])

        for batch in batches:
            for part in by_bytes(batch, 0):
                pairs, times, _ = _joined(part, tokenizers.kind)
                known, place = np.unique(np.concatenate([known, pairs]), return_inverse=True)
                # sums of whole numbers below 2**53 are exact in doubles
                total = np.bincount(place, np.concatenate([total, times]), len(known)).astype(np.int64)
                if len(known) > PAIRS:
                    yield rows()
                    known, total = known[:0], total[:0]
        yield rows()

    summed = by_arrow(aligned.select("pairs", "times"), run, "pair long, b long, n long")
    pairs = written(summed.groupBy("pair", "b").agg(F.sum("n").alias("count")), "pairs")
    most = pairs.groupBy(F.col("b").alias("of")).agg(F.max("count").alias("most"))
    return written(pairs.join(most, F.col("b") == F.col("of")).select("pair", "count", (F.col("count") == F.col("most")).cast("long").alias("best")), "pair-counts")


def align(
    docs: DataFrame, file_a: str, file_b: str, doc_id: str = "doc_id", text: str = "text", pairs_at_once: int = PAIRS, cache: int = CACHE,
    with_groups: bool = False,
) -> DataFrame:
    """One row per document: (doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256).

    ``n_best`` links are as frequent as any of their B id, ``count_sum`` sums the counts of the links. ``with_groups``
    adds the groups themselves, as ``a1,a2|b1;a3|b2,b3``.
    """
    spark, files = docs.sparkSession, (file_a, file_b)

    def scored(counts):
        def run(batches):
            kind = Tokenizers.of(*files).kind
            known, count, best = counts.value
            for batch in batches:
                for part in by_bytes(batch, batch.num_columns - 2):
                    pairs, times, edges = _joined(part, kind)
                    place = np.searchsorted(known[:-1], pairs)
                    times = np.where(known[place] == pairs, times, 0)
                    more = [part.column(k).to_numpy() + _reduced(x[place] * times, edges) for k, x in ((0, best), (1, count))]
                    yield pa.RecordBatch.from_arrays([*map(pa.array, more), *part.columns[2:]], part.schema.names)

        return run

    aligned = _aligned(docs, doc_id, text, files, cache, with_groups)
    pairs = _pair_counts(aligned, files)
    slices = max(1, -(-pairs.count() // pairs_at_once))
    zero = F.lit(0).cast("long")
    rows = aligned.select(zero.alias("n_best"), zero.alias("count_sum"), "*")
    for k in range(slices):
        part = pairs.filter(F.pmod(F.xxhash64("pair"), F.lit(slices)) == k) if slices > 1 else pairs
        counts = [c.to_numpy() for c in part.toArrow().combine_chunks().columns]
        order = np.argsort(counts[0])
        counts = [np.append(c[order], end) for c, end in zip(counts, (-1, 0, 0))]  # a last pair that no text has
        rows = by_arrow(rows, scored(spark.sparkContext.broadcast(counts)), rows.schema)
        if k < slices - 1:
            rows = written(rows, f"scored-{k}")
    return rows.select("doc_id", *NUMBERS, "n_best", "count_sum", "groups_sha256", *["groups"] * with_groups)
