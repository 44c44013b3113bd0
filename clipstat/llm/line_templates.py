"""Line de-duplication with a log-template tree.

Lines are parsed as a log parser does: the tree's first level is the number of
tokens, the next ``depth`` levels are the leading tokens, and tokens with a
digit stand for a variable field, ``<*>``.  A line with fewer than three
constant tokens, or with more fields than those, has no fields and is a leaf of
its own, so it goes only where it recurs literally.  Two lines of a leaf are similar if
they agree on ``similarity`` of their tokens, fields of both left out, and a
template is a component of similar lines, so it doesn't depend on the order or
on how the lines are dealt.  A template that recurs in ``min_docs``
documents or more is dropped from every document but the first (smallest id),
so that what documents share is said once.

Most leaves belong to one document.  They are told by hashes alone: each line is
a (leaf, line) pair of 64-bit hashes, counted map-side, and only lines of leaves
with enough documents are fetched as text, each distinct one once.  Two similar
lines agree on one whole block of their tokens at least, if there is a block
more than places in which they may differ.  So a leaf is dealt by blocks, long
ones in tiles of ``part_lines`` lines, and no task takes in a whole leaf.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField

from clipstat.llm.common import column, map_texts, materialise, run_starts, spare, sub_batches, whole_groups
from clipstat.llm.components import components

FIELD = b"<*>"
#: Constant tokens that a line with fields has at least.
LEAST_CONSTANT = 3
_DIGIT = re.compile(rb"[0-9]")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def parse(line: bytes, depth: int) -> tuple[int, int, list[bytes]] | None:
    """(leaf, line hash, tokens with fields) of a line; None for a blank one."""
    tokens = line.split()
    if not tokens:
        return None
    if _DIGIT.search(line):
        masked = [FIELD if _DIGIT.search(t) else t for t in tokens]
        constant = len(tokens) - masked.count(FIELD)
        # mostly fields: the numbers are what the line says, so it only equals itself
        if constant < LEAST_CONSTANT or 2 * constant < len(tokens):
            depth = len(tokens)
        else:
            tokens = masked
    leaf = xxhash.xxh64_intdigest(b"%d %s" % (len(tokens), b" ".join(tokens[:depth])), 1)
    return _signed(leaf), _signed(xxhash.xxh64_intdigest(b" ".join(tokens), 2)), tokens


def _lines(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").split(b"\n") if text else []


def _parsed(docs: DataFrame, depth: int) -> DataFrame:
    """The distinct (id, leaf, line) of every document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sub_batches(batches, "text"):
            at, leaf, line = [], [], []
            for i, t in enumerate(b.column("text").to_pylist()):
                for x, h in {p[:2] for p in (parse(s, depth) for s in _lines(t)) if p}:
                    at.append(i)
                    leaf.append(x)
                    line.append(h)
            yield pa.RecordBatch.from_arrays(
                [b.column("id").take(pa.array(at, pa.int64())), pa.array(leaf, pa.int64()), pa.array(line, pa.int64())],
                ["id", "leaf", "line"])

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(run, f"id {kind}, leaf long, line long")


def _fetched(docs: DataFrame, wanted: DataFrame, depth: int) -> DataFrame:
    """(leaf, line, tokens) for the lines that ``wanted`` (id, lines) asks of a document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sub_batches(batches, "text"):
            rows = []
            for t, want in zip(b.column("text").to_pylist(), b.column("lines").to_pylist()):
                left = set(want)
                for p in (parse(s, depth) for s in _lines(t)):
                    if p and p[1] in left:
                        left.discard(p[1])
                        rows.append((p[0], p[1], b" ".join(p[2]).decode("utf-8", "surrogatepass")))
            leaf, line, tokens = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(leaf, pa.int64()), pa.array(line, pa.int64()), pa.array(tokens, pa.string())], ["leaf", "line", "tokens"])

    # the same plan at every size: texts are shuffled by id, never a growing table broadcast
    return docs.join(wanted.hint("merge"), "id").select("id", "text", "lines").mapInArrow(run, "leaf long, line long, tokens string")


def _blocks(texts: DataFrame, similarity: float) -> DataFrame:
    """(block, line) for lines (leaf, line, tokens): two lines of a leaf that are similar share a block.

    They differ in at most ``most`` places, so they agree on one whole block of
    ``most + 1`` at least.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sub_batches(batches, "tokens"):
            block, line = [], []
            for leaf, h, t in zip(b.column("leaf").to_pylist(), b.column("line").to_pylist(), b.column("tokens").to_pylist()):
                tokens = t.encode("utf-8", "surrogatepass").split(b" ")
                n = len(tokens)
                parts = n - math.ceil(similarity * n - 1e-9) + 1
                for k in range(parts):
                    text = b" ".join(tokens[k * n // parts:(k + 1) * n // parts])
                    block.append(_signed(xxhash.xxh64_intdigest(b"%d %d %d %s" % (leaf, n, k, text), 3)))
                    line.append(h)
            yield pa.RecordBatch.from_arrays([pa.array(block, pa.int64()), pa.array(line, pa.int64())], ["block", "line"])

    return texts.mapInArrow(run, "block long, line long")


def similar_labels(lines: list[list[bytes]], similarity: float) -> np.ndarray:
    """A number for each line of the same length, equal for lines that a chain of similar ones joins.

    Two lines are similar if they agree on that part of their places; places
    that are a field in both don't count on either side.
    """
    words: dict[bytes, int] = {FIELD: 0}
    coded = np.array([[words.setdefault(w, len(words)) for w in x] for x in lines], dtype=np.int32)
    lab = np.arange(len(lines))
    for i in range(len(lines) - 1):
        far = i + 1 + np.flatnonzero(lab[i + 1:] != lab[i])
        step = max(1, (1 << 22) // max(1, coded.shape[1]))
        for lo in range(0, len(far), step):
            at = far[lo:lo + step]
            both = (coded[at] == 0) & (coded[i] == 0)
            same = (coded[at] == coded[i]) & ~both
            near = same.sum(axis=1) >= similarity * (coded.shape[1] - both.sum(axis=1)) - 1e-9
            if near.any():
                lab[np.isin(lab, lab[at[near]])] = lab[i]
    return lab


def similar_links(texts: DataFrame, similarity: float, tile: int) -> DataFrame:
    """Links (a, b) between ``texts.line`` (leaf, line, tokens) that join all similar lines of a leaf.

    Lines meet in the blocks that they share.  Of blocks with the same lines one
    is enough, and one of more than ``tile`` lines is cut: a task has the lines
    of two of its tiles.  The links are a forest within each task.
    """
    blocks = materialise(_blocks(texts, similarity), "line-blocks")
    sets = blocks.groupBy("block").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64(F.lit(1), "line")).alias("x"),
                                       F.bit_xor(F.xxhash64(F.lit(2), "line")).alias("y")).where("n > 1")
    chosen = sets.groupBy("n", "x", "y").agg(F.min("block").alias("block")).select(
        "block", F.ceil(F.col("n") / tile).cast("int").alias("tiles"))
    tiled = blocks.join(chosen, "block").withColumn("own", F.pmod(F.xxhash64("line"), F.col("tiles")).cast("int"))
    pairs = tiled.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))).select(
        "block", "line", (F.least("own", "other") * F.col("tiles").cast("long") + F.greatest("own", "other")).alias("part"))
    dealt = pairs.join(texts.select("line", "tokens"), "line").select("block", "part", "line", "tokens").repartition(
        "block", "part").sortWithinPartitions("block", "part", "line")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, ["block", "part"], 5_000):
            cuts = [*run_starts(t.column("block").to_numpy(), t.column("part").to_numpy()).tolist(), t.num_rows]
            line, tokens = t.column("line").to_numpy(), t.column("tokens")
            a, b = [], []
            for lo, hi in zip(cuts, cuts[1:]):
                if hi - lo > 1:
                    lab = similar_labels([x.encode("utf-8", "surrogatepass").split(b" ") for x in tokens.slice(lo, hi - lo).to_pylist()], similarity)
                    own = np.flatnonzero(lab != np.arange(hi - lo))
                    a.append(line[lo + own])
                    b.append(line[lo + lab[own]])
            none = np.zeros(0, dtype=np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([none, *a])), pa.array(np.concatenate([none, *b]))], ["a", "b"])

    return dealt.mapInArrow(run, "a long, b long")


def _shown(texts: DataFrame, named: DataFrame) -> DataFrame:
    """(leaf, template, text): the tokens that all lines of a template share, and fields."""
    at = named.join(texts.select("line", "tokens"), "line").select("leaf", "template", F.posexplode(F.split("tokens", " ")).alias("at", "token"))
    one = at.groupBy("leaf", "template", "at").agg(F.min("token").alias("low"), F.max("token").alias("high"))
    token = F.when(F.col("low") == F.col("high"), F.col("low")).otherwise(FIELD.decode())
    return one.groupBy("leaf", "template").agg(F.sort_array(F.collect_list(F.struct("at", token.alias("token")))).alias("all")).select(
        "leaf", "template", F.array_join(F.col("all.token"), " ").alias("text"))


def recurring_lines(docs: DataFrame, *, depth: int = 3, similarity: float = 0.8, min_docs: int = 3,
                    part_lines: int = 1000) -> tuple[DataFrame, DataFrame]:
    """Of ``docs`` (id, text): the lines to drop (id, leaf, line), and the templates (leaf, template, text, n_docs, first_id).

    ``part_lines`` is how many lines of a block a tile has; the result doesn't depend on it.
    """
    rows = materialise(_parsed(docs, depth), "lines")
    lines = rows.groupBy("leaf", "line").agg(F.count("*").alias("n"), F.min("id").alias("low"))
    leaves = lines.groupBy("leaf").agg(F.sum("n").alias("docs")).where(F.col("docs") >= min_docs).select("leaf")
    lines = materialise(lines.join(leaves, "leaf").select("leaf", "line", "low"), "leaf-lines")
    wanted = lines.groupBy(F.col("low").alias("id")).agg(F.collect_set("line").alias("lines"))
    texts = materialise(_fetched(docs, wanted, depth).dropDuplicates(["line"]), "line-texts")
    several = texts.groupBy("leaf").agg(F.count("*").alias("distinct")).where("distinct > 1").select("leaf")
    comp = components(similar_links(texts.join(several, "leaf").select("leaf", "line", "tokens"), similarity, part_lines))
    named = materialise(lines.join(comp.withColumnRenamed("node", "line"), "line", "left").select(
        "leaf", "line", F.coalesce("root", "line").alias("template")), "named-lines")
    where = rows.join(named, ["leaf", "line"])
    found = (where.groupBy("leaf", "template", "id").agg(F.lit(1).alias("one")).groupBy("leaf", "template")
             .agg(F.count("*").alias("n_docs"), F.min("id").alias("first_id")).where(F.col("n_docs") >= min_docs))
    found = materialise(found, "recurring")
    drop = where.join(found, ["leaf", "template"]).where("id <> first_id").select("id", "leaf", "line")
    shown = found.join(_shown(texts, named), ["leaf", "template"])
    return drop, shown


def dedup_lines(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", depth: int = 3,
                similarity: float = 0.8, min_docs: int = 3, part_lines: int = 1000) -> DataFrame:
    """``docs`` with the text less its dropped lines, and n_lines and n_dropped.

    Lines end at LF; blank lines are never judged and stay.  What stays is as
    it was, joined by LF.  Null and empty texts stay as they are.  Rows with
    the same id are one document; rows with a null id keep all their lines and
    don't count.  All rows and other columns come back as they are; an empty
    table gives an empty result.
    """
    src = docs.select(column(id_col).alias("id"), column(text_col).cast("string").alias("text")).where("id is not null")
    drop, _ = recurring_lines(src, depth=depth, similarity=similarity, min_docs=min_docs, part_lines=part_lines)
    gone, of = spare(docs, "dropped_lines"), spare(docs, "dropped_of")
    per_doc = drop.groupBy(F.col("id").alias(of)).agg(F.collect_list(F.array("leaf", "line")).alias(gone))
    joined = docs.join(per_doc.hint("merge"), column(id_col) == F.col(of), "left")

    def run(texts: pa.Array, rows: pa.StructArray) -> list[pa.Array]:
        out, total, dropped = [], [], []
        for t, cut in zip(texts.to_pylist(), rows.field(gone).to_pylist()):
            lines = _lines(t)
            total.append(sum(1 for x in lines if x.split()))
            if cut:
                lost = set(map(tuple, cut))
                stay = [x for x in lines if not ((p := parse(x, depth)) and p[:2] in lost)]
                dropped.append(len(lines) - len(stay))
                t = b"\n".join(stay).decode("utf-8", "surrogatepass")
            else:
                dropped.append(0)
            out.append(t)
        return [pa.array(out, pa.string()), pa.array(total, pa.int64()), pa.array(dropped, pa.int64())]

    text, count, lost = (spare(docs, x) for x in ("new_text", "n_lines", "n_dropped"))
    made = map_texts(joined, text_col, [StructField(text, StringType()), StructField(count, LongType()), StructField(lost, LongType())], run)
    return made.select(*[column(text).alias(c) if c == text_col else column(c) for c in docs.columns], count, lost)
