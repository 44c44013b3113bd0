"""Near-duplicate vectors through a pivot-permutation index.

1. Pivots: at most ``max_pivots`` of the vectors, drawn by a hash of their id
   (2 x the root of their number, 64 at least).  They are the only thing that
   is broadcast.
2. A vector is described by its ``prefix`` nearest pivots, nearest first; an
   inverted list per (label, dimension, pivot) holds the vectors that have the
   pivot in their description.
3. In a list every two vectors get their number of shared pivots from the
   descriptions; from ``shared`` on they are a candidate pair.  A pair that
   meets in several lists counts in the one of its lowest shared pivot only.
4. Candidates are verified by their cosine in double precision.

Equal vectors are one node that counts for all of them, so copies meet nobody
twice.  A list longer than ``tile`` is cut into tiles, and every pair of tiles
is a task's work of its own: no task holds a list without bound.  Of its pairs
a task gives only sums: how many links a node has found and one link of a
forest, never the pairs themselves.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipstat.llm.common import local_labels, materialise, run_starts, whole_groups
from clipstat.llm.components import components


def _nodes(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """(id, label, v, usable) of every row."""
    v = F.col(vector_col).cast("array<double>")
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(1e150)))
    return (vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"), v.alias("v"))
            .withColumn("usable", F.coalesce(fine & F.col("id").isNotNull() & F.col("label").isNotNull() & (norm > 0), F.lit(False))))


def draw_pivots(nodes: DataFrame, max_pivots: int, seed: int) -> np.ndarray:
    """Unit vectors in rows; shorter ones are filled up with zeros."""
    n = nodes.count()
    most = min(max_pivots, max(64, 2 * math.isqrt(n)))
    rows = [r["v"] for r in nodes.orderBy(F.xxhash64(F.lit(seed), "node"), "node").limit(most).select("v").collect()]
    if not rows:
        return np.zeros((0, 1))
    out = np.zeros((len(rows), max(map(len, rows))))
    for i, r in enumerate(rows):
        out[i, :len(r)] = r
    return out / np.linalg.norm(out, axis=1, keepdims=True)


def _describe(nodes: DataFrame, pivots: np.ndarray, prefix: int) -> DataFrame:
    """``nodes`` with ``near``, the numbers of the nearest pivots in order."""
    shared = nodes.sparkSession.sparkContext.broadcast(pivots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = shared.value
        for b in batches:
            if not b.num_rows:
                continue
            v = b.column("v")
            size = np.diff(v.offsets.to_numpy())
            flat, at = v.values.to_numpy(), v.offsets.to_numpy()[:-1]
            near = np.zeros((b.num_rows, min(prefix, len(p))), dtype=np.int32)
            for d in np.unique(size):
                own = np.flatnonzero(size == d)
                x = flat[at[own][:, None] + np.arange(d)]
                m = min(d, p.shape[1])
                dot = (x / np.linalg.norm(x, axis=1, keepdims=True))[:, :m] @ p[:, :m].T
                near[own] = np.argsort(-dot, axis=1, kind="stable")[:, :near.shape[1]]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(list(near), pa.list_(pa.int32()))], [*b.schema.names, "near"])

    return nodes.mapInArrow(run, "node long, label string, v array<double>, copies long, near array<int>")


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    c = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(c.flatten()).reshape(-1, width)


def _link_list(near: np.ndarray, pivot: int, own: np.ndarray, x: np.ndarray, copies: np.ndarray,
               shared: int, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """For a list (or pair of tiles): links found by each vector, copies counted, and its label."""
    names, at = np.unique(near, return_inverse=True)
    has = np.zeros((len(near), len(names)), dtype=np.float32)
    has[np.arange(len(near))[:, None], at.reshape(near.shape)] = 1
    below = has[:, names < pivot]
    ok = (has @ has.T >= shared) & (below @ below.T == 0)  # this is the lowest pivot they share
    if own[0] != own[-1]:
        ok &= own[:, None] != own[None, :]
    np.fill_diagonal(ok, False)
    i, j = np.nonzero(ok)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    hit = np.empty(len(i), dtype=bool)
    for lo in range(0, len(i), 1 << 16):
        part = slice(lo, lo + (1 << 16))
        hit[part] = np.einsum("ij,ij->i", unit[i[part]], unit[j[part]]) >= cosine
    i, j = i[hit], j[hit]
    return np.bincount(i, weights=copies[j], minlength=len(near)).astype(np.int64), local_labels(len(near), i, j)


def link_vectors(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                 cosine: float = 0.93, max_pivots: int = 4096, prefix: int = 10, shared: int = 2,
                 tile: int = 1024, seed: int = 1) -> DataFrame:
    """(id, n_links, component_id, kept) for every row of ``vectors``.

    Two vectors link when their labels are equal and not null, their dimensions
    are equal, and their cosine is at least ``cosine``.  A vector that is null,
    empty or zero, or holds a null or non-finite component, and a row with a
    null label or id, links with nothing: n_links 0, its own component, kept.
    Equal vectors link with each other.  Ids are taken to be unique; rows that
    repeat an id all get what the id has.  An empty table gives an empty
    result.  Other columns are not looked at.
    """
    rows = materialise(_nodes(vectors, id_col, vector_col, label_col), "vectors")
    usable = rows.where("usable")
    nodes = materialise(usable.groupBy("label", "v").agg(F.min("id").alias("node"), F.count("*").alias("copies")).select(
        "node", "label", "v", "copies"), "vector-nodes")
    pivots = draw_pivots(nodes, max_pivots, seed)
    listed = _describe(nodes, pivots, prefix).withColumn("pivot", F.explode("near")).withColumn("dim", F.size("v"))
    keys = ["label", "dim", "pivot"]
    long = listed.groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") > tile).select(
        *keys, F.ceil(F.col("n") / tile).cast("int").alias("tiles"))
    tiled = (listed.join(long, keys, "left").withColumn("tiles", F.coalesce("tiles", F.lit(1)))
             .withColumn("own", F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
             .withColumn("part", F.least("own", "other") * F.col("tiles") + F.greatest("own", "other")))
    keys = [*keys, "part"]
    dealt = tiled.select(*keys, "own", "node", "copies", "near", "v").repartition(*keys).sortWithinPartitions(*keys, "own", "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, keys, 10_000):
            cuts = [*run_starts(*[t.column(k).to_numpy() for k in keys]).tolist(), t.num_rows]
            node, copies, own = (t.column(c).to_numpy() for c in ("node", "copies", "own"))
            pivot, dim = t.column("pivot").to_numpy(), t.column("dim").to_numpy()
            for lo, hi in zip(cuts, cuts[1:]):
                if hi < lo + 2:
                    continue
                part = t.slice(lo, hi - lo)
                near = _matrix(part.column("near"), min(prefix, len(pivots)))
                n, lab = _link_list(near, pivot[lo], own[lo:hi], _matrix(part.column("v"), dim[lo]), copies[lo:hi], shared, cosine)
                found = np.flatnonzero(n)
                if len(found):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(node[lo:hi][found]), pa.array(n[found]), pa.array(node[lo:hi][lab[found]])], ["a", "n", "b"])

    found = materialise(dealt.mapInArrow(run, "a long, n long, b long"), "vector-links")
    comp = components(found.select("a", "b"))
    counts = found.groupBy("a").agg(F.sum("n").alias("n"))
    per_node = (nodes.join(counts, F.col("node") == F.col("a"), "left").join(comp.withColumnRenamed("node", "c_node"), F.col("node") == F.col("c_node"), "left")
                .select("label", "v", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("root", "node").alias("component_id")))
    linked = usable.select("id", "label", "v").join(per_node, ["label", "v"]).select("id", "n_links", "component_id")
    alone = rows.where("not usable").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("id").eqNullSafe(F.col("component_id")))
