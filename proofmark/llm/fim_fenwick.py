"""Fill-in-middle transformation: texts cut at two random units, their parts reordered behind markers.

A unit is a word with the white space before it; white space at the end is a unit of its own. The text's UTF-8 bytes
are taken in fixed blocks. A Fenwick tree over the blocks has how many units end, and how many code points begin, in
them. A cut behind the k-th unit finds its block by binary lifting down the tree, which also sums the code points
before the block; the place inside the block is found in its bytes alone. What is random comes from a hash of the id,
so a repeated task gives the same rows.

One pass without a shuffle; a task holds one text's tree at a time.

Defined cases: null text is empty, and an empty text is plain; a text that holds a marker is plain; a null id hashes
as the empty string; very long texts are cut anywhere in their whole length, with one tree node a block; equal cuts
give an empty middle; rows that repeat an id are cut alike if their texts are equal, each in its own row; an empty
table gives an empty result; extra columns never clash.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from proofmark.llm.common import by_arrow, by_bytes

BLOCK = 256  # bytes
MARKERS = ("<P>", "<S>", "<M>")
PLAIN, PSM, SPM = "plain", "psm", "spm"

SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True


class Fenwick:
    """Sums of rows of ``counts``; built in place, level by level."""

    def __init__(self, counts: np.ndarray):
        tree, step = counts.copy(), 1
        while step < len(tree):
            upper = tree[2 * step - 1 :: 2 * step]
            upper += tree[step - 1 :: 2 * step][: len(upper)]
            step *= 2
        self.tree = tree.tolist()

    def descend(self, rank: int) -> tuple[int, list[int]]:
        """The block where the first column's running sum reaches ``rank``, and the sums before that block."""
        at, before, step = 0, [0, 0], 1 << len(self.tree).bit_length()
        while step := step >> 1:
            if at + step <= len(self.tree) and before[0] + self.tree[at + step - 1][0] < rank:
                before = [a + b for a, b in zip(before, self.tree[at + step - 1])]
                at += step
        return at, before


class Units:
    """Places of a text's units."""

    def __init__(self, text: bytes, block: int = BLOCK):
        data = np.frombuffer(text, np.uint8)
        space, self.block = SPACES[data], block
        self.last = ~space
        self.last[:-1] &= space[1:]
        self.last[-1:] = True
        self.lead = (data & 0xC0) != 0x80
        starts = np.arange(0, len(data), block)
        counts = [np.add.reduceat(x, starts, dtype=np.int64) if len(data) else np.zeros(0, np.int64) for x in (self.last, self.lead)]
        self.count = int(counts[0].sum())
        self.tree = Fenwick(np.stack(counts, axis=1))

    def cut(self, rank: int) -> tuple[int, int]:
        """Bytes and code points of the first ``rank`` units."""
        if not rank:
            return 0, 0
        block, (units, points) = self.tree.descend(rank)
        low = block * self.block
        inside = np.flatnonzero(self.last[low : low + self.block])
        end = low + int(inside[rank - units - 1]) + 1
        return end, points + int(self.lead[low:end].sum())


def transformed(text: bytes, doc_id: str, seed: int, share: int, spm_share: int, markers: tuple[bytes, ...]):
    """(units, form, code points of prefix, of middle, output) of one text."""
    units = Units(text)
    digest = hashlib.sha256(f"{seed}:{doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in (0, 8, 16, 24))
    if not text or any(m in text for m in markers) or h3 % 100 >= share:
        return units.count, PLAIN, None, None, text
    first, second = sorted((h1 % (units.count + 1), h2 % (units.count + 1)))
    (a, before), (b, until) = units.cut(first), units.cut(second)
    p, s, m = markers
    if h4 % 100 < spm_share:
        form, out = SPM, (s, text[b:], p, text[:a], m, text[a:b])
    else:
        form, out = PSM, (p, text[:a], s, text[b:], m, text[a:b])
    return units.count, form, before, until - before, b"".join(out)


def transform(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", seed: int = 42, share: int = 50, spm_share: int = 80,
    markers: tuple[str, str, str] = MARKERS,
) -> DataFrame:
    """Rows (doc_id, n, form, prefix_chars, middle_chars, output), one per row of ``docs``.

    ``share`` percent of the texts are cut, ``spm_share`` percent of these with the suffix first. No marker may hold
    or overlap another, so that ``restored`` finds them again.
    """
    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
    coded = tuple(m.encode() for m in markers)

    def run(batches):
        for batch in batches:
            for part in by_bytes(batch, 2):
                ids, texts = part.column(1).to_pylist(), part.column(2).cast(pa.binary()).to_pylist()
                found = [transformed(t or b"", i or "", seed, share, spm_share, coded) for i, t in zip(ids, texts)]
                columns = list(zip(*found))
                columns[-1] = [x.decode() for x in columns[-1]]
                yield pa.RecordBatch.from_arrays([part.column(0), *map(pa.array, columns, types)], names)

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(doc_id).cast("string").alias("key"), F.col(text).alias("text"))
    kind = docs.schema[doc_id].dataType.simpleString()
    return by_arrow(rows, run, f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output: str | Column = "output", form: str | Column = "form", markers: tuple[str, str, str] = MARKERS) -> Column:
    """The text before the transformation, from the output and its form alone."""
    output, form = (F.col(x) if isinstance(x, str) else x for x in (output, form))
    p, s, m = markers

    def between(start: str, end: str) -> Column:
        return F.substring_index(F.substring_index(output, end, 1), start, -1)

    middle = F.substring_index(output, m, -1)
    return (
        F.when(form == PSM, F.concat(between(p, s), middle, between(s, m)))
        .when(form == SPM, F.concat(between(p, m), middle, between(s, p)))
        .otherwise(output)
    )
