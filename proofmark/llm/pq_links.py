"""Embedding near-dedup with product quantisation.

Unit vectors are dealt to coarse cells (inverted lists) by their nearest centroid and coded by the residual: one
centroid per subspace, plus the length of what the code leaves out. A partner is no farther than ``T``, the chord of
the least cosine, and lies in another cell only beyond the plane half-way between the two centroids, so a vector probes every cell whose
plane is within ``T``. In a cell, distances to all codes are sums of table look-ups; a code is dropped only if its
distance less its own error exceeds ``T``, and the rest is reranked by the exact cosine. So no link is lost, whatever
the vectors. ``spread`` trades links for fewer probes: planes within ``spread * T / sqrt(components)`` only, which
suits vectors that differ in all directions alike (``SPREAD`` for them) and loses links of vectors of low rank.

Equal vectors of a label are one class with a size, so copies are counted and not paired. A cell is compared in
blocks of about ``BLOCK`` classes by ``BLOCK`` queries, whatever its size; a block gives back counts and a spanning
forest of its links.

Defined cases: a pair at exactly the least cosine is a link; very long vectors are compared whole; vectors that are null, zero, of another length, or hold null or non-finite numbers, and rows without
a label, link with nothing and stand for themselves; rows that repeat an id are vectors of their own and count as
one node when links are followed; a null id never names a component; an empty table gives an empty result; extra
columns never clash.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from proofmark.llm.common import by_arrow, maybe_broadcast, written
from proofmark.llm.components import components
from proofmark.llm.simhash_trees import Forest

MIN_COSINE = 0.93
SAMPLE = 16_384  # classes that the centroids are fitted on, at most
CELL = 512  # classes of a cell, about, while there are fewer than MAX_CELLS
MAX_CELLS = 1024
SUBSPACES = 8
CODES = 256
ROUNDS = 8
SPREAD = 4.0
BLOCK = 1024


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    out = [
        np.argmin((centres**2).sum(1) - 2 * x[k : k + 4096] @ centres.T, axis=1) for k in range(0, len(x), 4096)
    ]
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def k_means(x: np.ndarray, k: int) -> np.ndarray:
    """Centroids of ``x``, from evenly picked rows."""
    k = max(1, min(k, len(x)))
    centres = x[np.linspace(0, len(x) - 1, k).astype(int)].copy()
    for _ in range(ROUNDS):
        near = _nearest(x, centres)
        counts = np.bincount(near, minlength=k)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        centres[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
    return centres


class Index:
    """Coarse centroids and, by subspace, centroids of residuals."""

    def __init__(self, sample: np.ndarray, cells: int):
        self.centres = k_means(sample, cells)
        rest = sample - self.centres[_nearest(sample, self.centres)]
        self.cuts = np.array_split(np.arange(sample.shape[1]), min(SUBSPACES, sample.shape[1]))
        self.books = [k_means(rest[:, c], CODES) for c in self.cuts]

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Cell, codes and the error of each code."""
        home = _nearest(x, self.centres)
        rest = x - self.centres[home]
        codes = np.stack([_nearest(rest[:, c], b) for c, b in zip(self.cuts, self.books)], axis=1).astype(np.uint8)
        left = sum(((rest[:, c] - b[codes[:, i]]) ** 2).sum(1) for i, (c, b) in enumerate(zip(self.cuts, self.books)))
        return home, codes, np.sqrt(left)

    def probes(self, x: np.ndarray, home: np.ndarray, reach: float) -> np.ndarray:
        """Whether each vector has to look into each cell from its own on."""
        apart = np.sqrt(np.maximum(((self.centres[:, None] - self.centres[None]) ** 2).sum(2), 0))
        d = ((x[:, None] - self.centres[None]) ** 2).sum(2) if len(x) * self.centres.size < 1 << 24 else (
            (x**2).sum(1)[:, None] - 2 * x @ self.centres.T + (self.centres**2).sum(1)[None]
        )
        over = d - d[np.arange(len(x)), home][:, None]
        cells = np.arange(len(self.centres))
        return (over <= 2 * reach * apart[home] + 1e-9) & (cells[None] >= home[:, None])

    def distances(self, queries: np.ndarray, cell: int, codes: np.ndarray) -> np.ndarray:
        """From each query to each code of a cell, by look-ups.

        |q - c - r|^2 = |q - c|^2 - 2 q.r + (|r|^2 + 2 c.r): the last is a number per code, q.r a sum from tables.
        """
        centre, found = self.centres[cell], np.zeros((len(queries), len(codes)), np.float32)
        own = np.zeros(len(codes))
        for i, (c, b) in enumerate(zip(self.cuts, self.books)):
            table = (queries[:, c] @ b.T).astype(np.float32)
            found += np.take(table, codes[:, i], axis=1)
            own += ((b * b).sum(1) + 2 * b @ centre[c])[codes[:, i]]
        apart = ((queries - centre) ** 2).sum(1)[:, None] + own[None] - 2 * found
        return np.sqrt(np.maximum(apart, 0))


def _unit(values: pa.Array, width: int) -> np.ndarray:
    return _normed(values.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, width))


def _normed(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow in the squares
    return x / np.sqrt((x**2).sum(1, keepdims=True))


def links(
    rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", min_cosine: float = MIN_COSINE,
    spread: float | None = None,
) -> DataFrame:
    """One row per vector: its id, n_links, component_id and kept."""
    bad = F.exists(F.col(vector), lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    good = F.col(label).isNotNull() & F.col(vector).isNotNull() & ~bad & F.exists(F.col(vector), lambda x: x != 0)
    key = F.when(F.coalesce(good, F.lit(False)), F.xxhash64(F.col(label), F.col(vector)))
    read = rows.select(F.col(vec_id).alias("vec_id"), key.alias("class"), F.col(label).alias("label"), F.col(vector).alias("vector"))
    classes = written(
        read.filter("class IS NOT NULL").groupBy("class", "label", "vector")
        .agg(F.min("vec_id").cast("long").alias("rep"), F.count(F.lit(1)).alias("size")),
        "classes",
    )
    found = [_links_of(classes.filter(F.size("vector") == r[0]), r[0], min_cosine, spread) for r in classes.select(F.size("vector")).distinct().collect()]
    ids = read.select("vec_id", "class")
    own = F.col("vec_id")
    if not found:
        return _result(ids.withColumn("n_links", F.lit(0).cast("long")).withColumn("component_id", own), rows, vec_id)
    both = found[0]
    for more in found[1:]:
        both = both.unionByName(more)
    both = written(both, "vector-links")
    counts = both.filter("class IS NOT NULL").groupBy(F.col("class").alias("of")).agg(F.sum("links").alias("links"))
    parts = components(both.filter("a IS NOT NULL").select("a", "b").unionByName(_same_id(read, classes)))
    by_class = classes.join(counts, F.col("class") == F.col("of"), "left").join(parts, F.col("rep") == F.col("node"), "left")
    by_class = written(
        by_class.select(
            F.col("class").alias("of"), (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("links"),
            F.coalesce("component", "rep").alias("root"),
        ),
        "by-class",
    )
    met = written(ids, "vector-ids").join(by_class, F.col("class") == F.col("of"), "left")
    out = met.withColumn("n_links", F.coalesce("links", F.lit(0))).withColumn(
        "component_id", F.when(F.col("of").isNull(), own).otherwise(F.col("root")).cast(rows.schema[vec_id].dataType)
    )
    return _result(out, rows, vec_id)


def _result(df: DataFrame, rows: DataFrame, vec_id: str) -> DataFrame:
    kept = F.col("vec_id").eqNullSafe(F.col("component_id"))
    return df.select(F.col("vec_id").alias(vec_id), "n_links", "component_id", kept.alias("kept"))


def _same_id(read: DataFrame, classes: DataFrame) -> DataFrame:
    """Links between classes that share an id."""
    ids = read.groupBy("vec_id").agg(F.min("class").alias("least"), F.max("class").alias("most"))
    odd = ids.filter("vec_id IS NOT NULL AND least != most").select("vec_id")
    pairs = written(read.select("vec_id", "class").join(odd, "vec_id").distinct(), "same-vector-id")
    return pairs.join(classes.select("class", "rep"), "class").select(F.col("rep").alias("a"), F.col("vec_id").cast("long").alias("b"))


def _links_of(classes: DataFrame, width: int, min_cosine: float, spread: float | None) -> DataFrame:
    """(class, links) counts and (a, b) links of a spanning forest, for classes of one vector length."""
    far = float(np.sqrt(max(0.0, 2 - 2 * min_cosine)))
    reach = far if spread is None else min(far, spread * far / float(np.sqrt(width)))
    kept = np.float32 if classes.schema["vector"].dataType.elementType.typeName() == "float" else np.float64
    total = classes.count()
    picked = classes.orderBy(F.xxhash64("class"), "class").limit(SAMPLE).select("vector").toArrow().column(0).combine_chunks()
    index = Index(_unit(picked, width), min(MAX_CELLS, max(1, total // CELL)))

    def raw(vectors):
        return pa.array([v.tobytes() for v in vectors.flatten().to_numpy(zero_copy_only=False).astype(kept).reshape(-1, width)], pa.binary())

    def code(batches):
        for b in batches:
            for at in range(0, b.num_rows, 1024):
                part = b.slice(at, 1024)
                x = _unit(part.column(4), width)
                home, codes, error = index.encode(x)
                probed = [np.nonzero(p)[0].tolist() for p in index.probes(x, home, reach)]
                columns = [
                    *(part.column(i) for i in range(4)), pa.array(home.astype(np.int32)), pa.array([c.tobytes() for c in codes], pa.binary()),
                    pa.array(error), raw(part.column(4)), pa.array(probed, pa.list_(pa.int32())),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["class", "label", "rep", "size", "home", "codes", "error", "vector", "probes"])

    kind = classes.schema["label"].dataType.simpleString()
    schema = f"class long, label {kind}, rep long, size long, home int, codes binary, error double, vector binary, probes array<int>"
    coded = written(by_arrow(classes.select("class", "label", "rep", "size", "vector"), code, schema), "codes")
    blocks = lambda n: F.greatest(F.ceil(n / BLOCK).cast("int"), F.lit(1))
    members = coded.withColumn("cell", F.col("home")).withColumn("probes", F.lit(None).cast("array<int>"))
    queries = coded.withColumn("cell", F.explode("probes"))
    asked = queries.groupBy(F.col("label").alias("l"), F.col("cell").alias("c")).agg(F.count(F.lit(1)).alias("asked"))
    held = members.groupBy(F.col("label").alias("hl"), F.col("cell").alias("hc")).agg(F.count(F.lit(1)).alias("held"))
    sizes = written(
        asked.join(held, (F.col("l") == F.col("hl")) & (F.col("c") == F.col("hc"))).select("l", "c", blocks(F.col("asked")).alias("q"), blocks(F.col("held")).alias("m")),
        "cell-sizes",
    )
    sizes = maybe_broadcast(sizes)
    in_cell = (F.col("label") == F.col("l")) & (F.col("cell") == F.col("c"))
    block = lambda n: F.pmod(F.xxhash64("class"), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    columns = ["label", "cell", "mb", "qb", "asks", "class", "rep", "size", "home", "codes", "error", "vector"]
    one = members.join(sizes, in_cell).withColumn("mb", block("m")).withColumn("qb", each("q")).withColumn("asks", F.lit(False))
    other = queries.join(sizes, in_cell).withColumn("qb", block("q")).withColumn("mb", each("m")).withColumn("asks", F.lit(True))

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        asks = pdf["asks"].to_numpy()
        q, m = pdf[asks], pdf[~asks]
        if not len(q) or not len(m):
            return pd.DataFrame({"class": [], "links": [], "a": [], "b": []}).astype("Int64")
        cell = int(pdf["cell"].iat[0])
        x, y = (_normed(np.frombuffer(b"".join(d["vector"]), kept).astype(float).reshape(-1, width)) for d in (q, m))
        codes = np.frombuffer(b"".join(m["codes"]), np.uint8).reshape(len(m), -1)
        near = index.distances(x, cell, codes) - m["error"].to_numpy()[None] <= far + 1e-4
        qc, mc = q["class"].to_numpy(), m["class"].to_numpy()
        near &= (q["home"].to_numpy()[:, None] < cell) | (qc[:, None] < mc[None])  # a pair of one cell counts once
        i, j = np.nonzero(near)
        keep = np.zeros(len(i), bool)
        for at in range(0, len(i), 1 << 16):
            s = slice(at, at + (1 << 16))
            keep[s] = np.einsum("ij,ij->i", x[i[s]], y[j[s]]) >= min_cosine
        i, j = i[keep], j[keep]
        ids, where = np.unique(np.concatenate([qc[i], mc[j]]), return_inverse=True)
        counts = np.bincount(where, np.concatenate([m["size"].to_numpy()[j], q["size"].to_numpy()[i]]), len(ids)).astype(np.int64)
        rep = np.zeros(len(ids), np.int64)
        reps = pd.concat([q["rep"].iloc[i], m["rep"].iloc[j]]).fillna(-1).to_numpy().astype(np.int64)
        rep[where] = reps
        known = np.concatenate([q["rep"].notna().to_numpy()[i], m["rep"].notna().to_numpy()[j]])
        named = np.zeros(len(ids), bool)
        named[where] = known
        forest, n = Forest(len(ids)), len(i)
        ok = named[where[:n]] & named[where[n:]]
        forest.link(where[:n][ok], where[n:][ok])
        root = rep[forest.label]
        out = pd.DataFrame({"class": ids, "links": counts, "a": pd.NA, "b": pd.NA})
        apart = rep != root
        more = pd.DataFrame({"class": pd.NA, "links": pd.NA, "a": root[apart], "b": rep[apart]})
        return pd.concat([out.astype("Int64"), more.astype("Int64")])

    dealt = one.select(*columns).unionByName(other.select(*columns))
    return dealt.groupBy("label", "cell", "mb", "qb").applyInPandas(compare, "class long, links long, a long, b long")
