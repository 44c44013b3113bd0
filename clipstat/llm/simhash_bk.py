"""SimHash near-duplicates found with BK-trees.

1. A document's fingerprint has 64 bits: each is 1 if it is set in over half of
   the XXH64 hashes (seed 42) of its 4-word shingles, repeats included.
   Words are lower-cased (A-Z only) and joined by one space.
2. Equal fingerprints are one node: copies are counted before anything else.
3. The nodes are dealt into shards.  Two fingerprints that differ in at most
   ``max_bits`` bits agree on ``blocks - max_bits`` whole blocks at least, so
   each goes to one shard for every choice of so many blocks, by the value of
   the chosen ones.  With 6 blocks and 4 bits that makes 15 shards a node,
   keyed by 20 to 22 bits.
4. Every shard's fingerprints form a BK-tree: the children of a node are keyed
   by their integer Hamming distance to it.  Each fingerprint of the shard
   searches the tree and follows only edges within ``max_bits`` of its distance
   to the node.  The trees travel to the task that holds their queries; to
   broadcast them all would have no bound, as they grow with the corpus.
5. A shard of more than ``tile`` nodes is cut into tiles, and a tree is made
   for every pair of tiles, so no task holds a shard without bound.
6. A task joins the pairs it finds into a forest (at most one link a node and
   shard), and the components of all links are found with joins.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clipstat.llm.common import column, local_labels, materialise, run_starts, spare, sub_batches, whole_groups
from clipstat.llm.components import components


# --- fingerprints -----------------------------------------------------------

def fingerprint(text: str | None, shingle: int = 4) -> int:
    """The fingerprint as a signed 64-bit integer; 0 without words."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    n = len(words)
    if not n:
        return 0
    joined = b" ".join(words)
    if n <= shingle:
        digests = xxhash.xxh64_digest(joined, 42)
        count = 1
    else:
        ends = list(accumulate((len(w) + 1 for w in words)))
        starts = [0, *ends]
        one = xxhash.xxh64_digest
        digests = b"".join([one(joined[a:b - 1], 42) for a, b in zip(starts, ends[shingle - 1:])])
        count = n - shingle + 1
    bits = np.unpackbits(np.frombuffer(digests, dtype=np.uint8).reshape(count, 8), axis=1)
    most = 2 * bits.sum(axis=0, dtype=np.int64) > count
    return int.from_bytes(np.packbits(most).tobytes(), "big", signed=True)


def text_key_of(text_col: str) -> Column:
    return F.xxhash64(column(text_col).cast("string"))


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int, text_key: bool = False) -> DataFrame:
    """(id, fp) for every row, with a hash of its text if asked for."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), *([text_key_of(text_col).alias("text_key")] if text_key else []))
    more = ["text_key"] if text_key else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sub_batches(batches, "text"):
            fp = [fingerprint(t, shingle) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(fp, type=pa.int64()), *[b.column(c) for c in more]], ["id", "fp", *more])

    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, fp long" + "".join(f", {c} long" for c in more))


# --- BK-trees ---------------------------------------------------------------

class BKForest:
    """One BK-tree for each group of fingerprints, all of them built level by level.

    ``fps`` are distinct within a group; ``starts`` are the places at which a
    group starts.  Node i is fingerprint i.
    """

    def __init__(self, fps: np.ndarray, starts: np.ndarray):
        n = len(fps)
        self.fps = fps
        size = np.diff(np.append(starts, n))
        group = np.repeat(np.arange(len(starts)), size)
        self.root = np.repeat(starts, size)  # of each fingerprint's own tree
        parent = np.full(n, -1)
        edge = np.zeros(n, dtype=np.int64)
        todo, subtree = np.arange(n), group
        up, key = np.full(len(starts), -1), np.zeros(len(starts), dtype=np.int64)
        while len(todo):
            at = run_starts(subtree)  # the first of a subtree becomes its top node
            top = todo[at]
            parent[top], edge[top] = up, key
            rest = np.ones(len(todo), dtype=bool)
            rest[at] = False
            above = np.repeat(top, np.diff(np.append(at, len(todo))))[rest]
            todo = todo[rest]
            d = np.bitwise_count(fps[todo] ^ fps[above]).astype(np.int64)
            order = np.lexsort((todo, d, above))
            todo, above, d = todo[order], above[order], d[order]
            first = run_starts(above, d)
            subtree = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(todo))))
            up, key = above[first], d[first]
        child = np.flatnonzero(parent >= 0)
        code = parent[child] * 65 + edge[child]
        order = np.argsort(code, kind="stable")
        self.child, self.code = child[order], code[order]

    def search(self, query: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query node, node) within ``radius``, found in the query's own tree."""
        found_q, found_n = [], []
        q, node = query, self.root[query]
        while len(q):
            d = np.bitwise_count(self.fps[q] ^ self.fps[node]).astype(np.int64)
            hit = (d <= radius) & (q != node)
            found_q.append(q[hit])
            found_n.append(node[hit])
            lo = np.searchsorted(self.code, node * 65 + np.maximum(d - radius, 1))
            hi = np.searchsorted(self.code, node * 65 + np.minimum(d + radius, 64), side="right")
            n = hi - lo
            skip = np.repeat(np.cumsum(n) - n, n)
            node = self.child[np.repeat(lo, n) + np.arange(len(skip)) - skip]
            q = np.repeat(q, n)
        return np.concatenate(found_q or [query[:0]]), np.concatenate(found_n or [query[:0]])


def block_bounds(blocks: int) -> list[tuple[int, int]]:
    """(shift, width) of each block of the 64 bits."""
    cut = [round(64 * i / blocks) for i in range(blocks + 1)]
    return [(a, b - a) for a, b in zip(cut, cut[1:])]


def near_links(nodes: DataFrame, max_bits: int = 4, blocks: int = 6, tile: int = 1024) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``nodes.fp`` that join all within ``max_bits`` bits.

    The links are a forest within each shard: two fingerprints within the
    distance are joined by a path, not always by a link of their own.
    """
    spans = block_bounds(blocks)
    keys = []
    for chosen in combinations(range(blocks), blocks - max_bits):
        mask = sum(((1 << spans[i][1]) - 1) << spans[i][0] for i in chosen)
        mask -= (1 << 64) if mask >= 1 << 63 else 0
        keys.append(F.xxhash64(F.lit(len(keys)), F.col("fp").bitwiseAND(F.lit(mask))))
    sharded = nodes.select("fp", F.explode(F.array(*keys)).alias("shard"))
    # shards of more than a tile are few: they get a number of tiles, the others keep one
    large = sharded.groupBy("shard").agg(F.count("*").alias("n")).where(F.col("n") > tile).withColumn(
        "tiles", F.ceil(F.col("n") / tile).cast("int")).select("shard", "tiles")
    tiled = sharded.join(large, "shard", "left").withColumn("tiles", F.coalesce("tiles", F.lit(1))).withColumn(
        "own", F.pmod(F.xxhash64("fp"), F.col("tiles")).cast("int"))
    pairs = tiled.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))).withColumn(
        "part", F.least("own", "other") * F.col("tiles") + F.greatest("own", "other"))
    dealt = pairs.select("shard", "part", "fp").repartition("shard", "part").sortWithinPartitions("shard", "part", "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, ["shard", "part"]):
            shard, part = t.column("shard").to_numpy(), t.column("part").to_numpy()
            fp = t.column("fp").to_numpy()
            starts = run_starts(shard, part)
            size = np.diff(np.append(starts, len(fp)))
            several = np.repeat(size > 1, size)  # a shard with one node has no links
            fp, size = fp[several], size[size > 1]
            if not len(fp):
                continue
            starts = np.cumsum(size) - size
            forest = BKForest(fp.view(np.uint64), starts)
            lab = np.arange(len(fp))
            for lo in range(0, len(fp), 2048):
                a, b = forest.search(np.arange(lo, min(lo + 2048, len(fp))), max_bits)
                every = np.arange(len(fp))
                lab = local_labels(len(fp), np.concatenate([a, every]), np.concatenate([b, lab])) if len(a) else lab
            linked = np.flatnonzero(lab != np.arange(len(fp)))
            if len(linked):
                yield pa.RecordBatch.from_arrays([pa.array(fp[linked]), pa.array(fp[lab[linked]])], ["a", "b"])

    return dealt.mapInArrow(run, "a long, b long")


def simhash_groups(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
                   max_bits: int = 4, blocks: int = 6, tile: int = 1024, text_key: bool = False) -> DataFrame:
    """(id, fp, component_id) for every row of ``docs``; component_id is the smallest id reachable.

    Texts without words (null, empty, blank) have fingerprint zero and link
    like any other.  Null ids are passed over for component_id, which is null
    only where no row of the group has an id.  Rows with the same id are rows
    of their own.  An empty table gives an empty result.  Other columns are not
    looked at.  ``text_key`` adds the group's ``root`` (its smallest fingerprint) and a
    hash of the row's text, which ``one_of_each`` needs.
    """
    fps = materialise(fingerprints(docs, id_col, text_col, shingle, text_key), "fingerprints")
    nodes = materialise(fps.groupBy("fp").agg(F.min("id").alias("low")), "nodes")
    links = near_links(nodes.select("fp"), max_bits, blocks, tile)
    comp = components(links)
    rooted = materialise(nodes.join(comp.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "low", F.coalesce("root", "fp").alias("root")), "rooted")
    lowest = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    named = rooted.join(lowest, "root").select("fp", "component_id", *(["root"] if text_key else []))
    return fps.join(named, "fp").select("id", "fp", "component_id", *(["root", "text_key"] if text_key else []))


def one_of_each(docs: DataFrame, groups: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group: that of the smallest id, and of its texts in the group the one with the least hash.

    ``groups`` come from ``simhash_groups`` with ``text_key``.  Rows of one id may
    belong to several groups, and each keeps its own; of rows that repeat id and
    text one stays.  A row without an id stays, as no group can name it.  All columns
    come back as they are.
    """
    keep, key, row = spare(docs, "kept_id"), spare(docs, "kept_text"), spare(docs, "row_of_id")
    low = (groups.where("id = component_id").groupBy("root").agg(F.min(F.struct("id", "text_key")).alias("first"))
           .select(F.col("first.id").alias(keep), F.col("first.text_key").alias(key)))
    first = Window.partitionBy(keep, key).orderBy(keep)
    one = (docs.join(low, (column(id_col) == F.col(keep)) & (text_key_of(text_col) == F.col(key)))
           .withColumn(row, F.row_number().over(first)).where(F.col(row) == 1).select(*[column(c) for c in docs.columns]))
    return one.unionByName(docs.where(column(id_col).isNull()))
