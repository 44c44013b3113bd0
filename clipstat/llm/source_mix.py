"""Mixing sources to target weights with a low-discrepancy schedule (native DataFrame code only).

1. Targets.  Sources in code-point order (null last) weigh ``weights``,
   repeating; they share ``share`` x all words.  No target exceeds
   ``max_repeat`` x its source's words; the excess goes to the others by
   weight.  The fixed point is found in one pass: with the sources ordered by
   cap / weight, a source is capped when its cap is at most the level that the
   rest of the words give to the rest of the weights.
2. Blocks.  The documents of a source stand in a keyed shuffled order (MD5 of
   seed and id); their words, ``max_repeat`` times over, form a stream that is
   cut into blocks of equally many words.
3. Schedule.  Slot i has the point frac((i + 1) x golden ratio); the cumulative
   target shares map it to a source; the r-th slot of a source stands for block
   r of its stream.  A source that the sequence leaves a few slots short gets
   them at the end, and the last block ends at the target.
4. Documents join the blocks that they overlap.

A source can hold a third of all rows: running sums are taken in 4,096 hash
buckets per source with bucket offsets on top, ranks in chunks of 1,024 slots
with chunk offsets on top, and blocks join on (source, block).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clipstat.llm.common import column, materialise, n_words

GOLDEN = 0.6180339887498949


def shuffle_key(id_: Column, seed: str) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(id_.cast("string"), F.lit(""))))


def plan_targets(sizes: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5,
                 max_repeat: int = 2, max_slots: int = 1 << 20, min_block: int = 64) -> DataFrame:
    """One row per source from ``sizes`` (source, source_size): its target, quota and stretch of [0, 1).

    The windows here run over one row per source.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    every = Window.partitionBy()
    w = F.array(*[F.lit(float(x)) for x in weights])
    t = (sizes.withColumn("src", F.row_number().over(order) - 1)
         .withColumn("weight", F.element_at(w, (F.col("src") % len(weights) + 1).cast("int")))
         .withColumn("cap", F.col("source_size").cast("double") * max_repeat)
         .withColumn("total", F.sum("source_size").over(every))
         .withColumn("budget", F.col("total") * F.lit(float(share))))
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), "src")
    upto = by_ratio.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    t = (t.withColumn("w_left", F.sum("weight").over(every) - F.sum("weight").over(upto) + F.col("weight"))
         .withColumn("b_left", F.col("budget") - F.sum("cap").over(upto) + F.col("cap"))
         .withColumn("full", F.col("cap") * F.col("w_left") <= F.col("b_left") * F.col("weight")))
    # the level that holds for all that are not full: the one at the first of them
    first = F.min(F.when(~F.col("full"), F.struct((F.col("cap") / F.col("weight")).alias("r"), F.col("src"),
                                                 (F.col("b_left") / F.col("w_left")).alias("x")))).over(every)
    t = t.withColumn("target", F.when(F.col("full"), F.col("cap")).otherwise(first["x"] * F.col("weight")))
    block = F.greatest(F.lit(min_block), F.ceil(F.sum("target").over(every) / max_slots)).cast("long")
    cum = F.sum("target").over(Window.orderBy("src").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    all_targets = F.sum("target").over(every)
    return (t.withColumn("quota", F.least(F.floor(F.col("target") + 0.5), F.col("source_size") * max_repeat).cast("long"))
            .withColumn("block", block)
            .withColumn("hi", F.when(all_targets > 0, cum / all_targets).otherwise(0.0))
            .withColumn("lo", F.lag("hi", 1, 0.0).over(Window.orderBy("src")))
            .withColumn("n_slots", F.ceil(all_targets / F.col("block")).cast("long"))
            .withColumn("blocks", F.ceil(F.col("quota") / F.col("block")).cast("long"))
            .select("source", "src", "source_size", "weight", "target", "quota", "block", "blocks", "lo", "hi", "n_slots"))


def schedule(plan: DataFrame, cells: int = 1024) -> DataFrame:
    """(slot, src, rank, lo, hi): slot takes the words [lo, hi) of the source's stream."""
    spark = plan.sparkSession
    n = plan.agg(F.max("n_slots")).first()[0] or 0
    point = F.col("slot") * F.lit(GOLDEN) + F.lit(GOLDEN)
    slots = (spark.range(n).select(F.col("id").alias("slot"))
             .withColumn("u", point - F.floor(point)).withColumn("cell", F.floor(F.col("u") * cells)))
    # cumulative shares as cells of [0, 1): an equi-join stands for the search of the interval
    spans = plan.where("hi > lo").select(
        "src", "lo", "hi", F.explode(F.sequence(F.floor(F.col("lo") * cells), F.floor(F.col("hi") * cells))).alias("cell"))
    hit = slots.join(spans, "cell").where("u >= lo and u < hi").select("slot", "src", F.floor(F.col("slot") / 1024).alias("chunk"))
    per = hit.groupBy("src", "chunk").agg(F.count("*").alias("n"))
    before = per.withColumn("before", F.sum("n").over(Window.partitionBy("src").orderBy("chunk")) - F.col("n"))
    ranked = (hit.withColumn("r", F.row_number().over(Window.partitionBy("src", "chunk").orderBy("slot")) - 1)
              .join(before.select("src", "chunk", "before"), ["src", "chunk"])
              .select("slot", "src", (F.col("before") + F.col("r")).alias("rank")))
    got = per.groupBy("src").agg(F.sum("n").alias("got"))
    late = (plan.join(got, "src", "left").withColumn("got", F.coalesce("got", F.lit(0)))
            .where("got < blocks").select("src", F.explode(F.sequence("got", F.col("blocks") - 1)).alias("rank")))
    late = late.select((F.row_number().over(Window.orderBy("rank", "src")) - 1 + F.lit(n)).alias("slot"), "src", "rank")
    return (ranked.unionByName(late).join(plan.select("src", "block", "blocks", "quota"), "src").where("rank < blocks")
            .select("slot", "src", "rank", (F.col("rank") * F.col("block")).alias("lo"),
                    F.least((F.col("rank") + 1) * F.col("block"), "quota").alias("hi")))


@dataclass
class Mix:
    """``plan``: a row per source; ``schedule``: a row per slot; ``taken``: a row per document."""

    plan: DataFrame
    schedule: DataFrame
    taken: DataFrame


def _placed(docs: DataFrame, plan: DataFrame, offsets: DataFrame) -> DataFrame:
    """Rows of ``docs`` (with _source, _size, _key, _tie, _bucket) with their place in the source's stream."""
    inside = Window.partitionBy("_source", "_bucket").orderBy("_key", "_tie")
    return (docs.withColumn("_n", F.row_number().over(inside))
            .withColumn("_run", F.sum("_size").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
            .join(offsets, F.col("_source").eqNullSafe(F.col("o_source")) & (F.col("_bucket") == F.col("o_bucket")))
            .withColumn("_at", F.col("o_before") + F.col("_run") - F.col("_size")))


def _keyed(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: str) -> DataFrame:
    return (docs.withColumn("_source", F.col(source_col).cast("string")).withColumn("_size", n_words(F.col(text_col)))
            .withColumn("_key", shuffle_key(F.col(id_col), seed))
            .withColumn("_tie", F.struct("_size", F.xxhash64(F.col(text_col))))
            .withColumn("_bucket", F.substring("_key", 1, 3)))


def mix(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: Sequence[float] = (5, 2, 1), share: float = 1.5, max_repeat: int = 2,
        max_slots: int = 1 << 20, min_block: int = 64, seed: str = "mix") -> Mix:
    """The mix of ``docs``; ``taken`` has id, _source, size, source_size, target, taken, and the row's key.

    Every row of ``docs`` comes back once.  Null or empty text has size 0 and
    gives nothing.  A null source is a source of its own, the last.  Rows with
    the same id stand next to each other, ordered by size and text hash;
    identical rows are interchangeable.  An empty table gives empty results.
    Other columns of ``docs`` are not looked at.
    """
    narrow = materialise(
        _keyed(docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), F.col(source_col).alias("_src0")),
               "_id", "_text", "_src0", seed).select("_id", "_source", "_size", "_key", "_tie", "_bucket"), "mix-sizes")
    buckets = materialise(narrow.groupBy("_source", "_bucket").agg(F.sum("_size").alias("size")), "mix-buckets")
    sizes = buckets.groupBy(F.col("_source").alias("source")).agg(F.sum("size").alias("source_size"))
    plan = materialise(plan_targets(sizes, weights, share, max_repeat, max_slots, min_block), "mix-plan")
    along = Window.partitionBy("_source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offsets = (buckets.withColumn("o_before", F.sum("size").over(along) - F.col("size"))
               .join(plan, F.col("_source").eqNullSafe(F.col("source")))
               .select(F.col("_source").alias("o_source"), F.col("_bucket").alias("o_bucket"), "o_before",
                       "src", "source_size", "target", "block"))
    slots = materialise(schedule(plan), "mix-schedule")
    at = _placed(narrow, plan, offsets)
    # every pass over the source's words is one more stretch of its stream
    passes = at.withColumn("_pass", F.explode(F.sequence(F.lit(0), F.lit(max_repeat - 1)))).withColumn(
        "_from", F.col("_at") + F.col("_pass") * F.col("source_size"))
    cut = passes.withColumn("_block", F.explode_outer(F.when(F.col("_size") > 0, F.sequence(
        F.floor(F.col("_from") / F.col("block")), F.floor((F.col("_from") + F.col("_size") - 1) / F.col("block"))))))
    part = F.when(F.col("rank").isNotNull(), F.greatest(
        F.lit(0), F.least(F.col("hi"), F.col("_from") + F.col("_size")) - F.greatest(F.col("lo"), F.col("_from"))))
    joined = cut.join(slots.select(F.col("src").alias("s_src"), "rank", "lo", "hi"),
                      (F.col("src") == F.col("s_src")) & (F.col("_block") == F.col("rank")), "left")
    taken = joined.groupBy("_id", "_source", "_bucket", "_n", F.col("_size").alias("size"), "source_size", "target").agg(
        F.sum(F.coalesce(part, F.lit(0))).cast("long").alias("taken"))
    return Mix(plan, slots, taken)


def mixed_documents(docs: DataFrame, result: Mix, *, id_col: str = "doc_id", text_col: str = "text",
                    source_col: str = "source", max_repeat: int = 2, seed: str = "mix") -> DataFrame:
    """The rows of ``docs`` that the mix takes, each as often as taken; the columns of ``docs``.

    A document of which only some words are taken in a pass keeps its first
    words, joined by one space; it happens at the end of a source's quota.
    """
    cols = docs.columns
    inside = Window.partitionBy("_source", "_bucket").orderBy("_key", "_tie")
    keyed = _keyed(docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), F.col(source_col).alias("_src0"),
                               F.struct(*[column(c) for c in cols]).alias("_row")), "_id", "_text", "_src0", seed)
    keyed = keyed.withColumn("_n", F.row_number().over(inside))
    got = result.taken.where("taken > 0").select(
        F.col("_source").alias("g_source"), F.col("_bucket").alias("g_bucket"), F.col("_n").alias("g_n"), "size", "taken")
    rows = (keyed.join(got, F.col("_source").eqNullSafe(F.col("g_source")) & (F.col("_bucket") == F.col("g_bucket")) & (F.col("_n") == F.col("g_n")))
            .withColumn("_pass", F.explode(F.sequence(F.lit(0), F.lit(max_repeat - 1))))
            .withColumn("_take", F.least(F.col("size"), F.col("taken") - F.col("_pass") * F.col("size"))).where("_take > 0"))
    head = F.array_join(F.slice(F.regexp_extract_all(F.col("_text"), F.lit(r"([^\x20\x09-\x0D]+)"), 1), F.lit(1), F.col("_take").cast("int")), " ")
    text = F.when(F.col("_take") == F.col("size"), F.col("_text")).otherwise(head)
    return rows.withColumn("_out", text).select(*[
        F.col("_out").alias(c) if c == text_col
        else F.length("_out").cast(docs.schema[c].dataType).alias(c) if c == "n_chars"
        else F.col("_row").getField(c).alias(c) for c in cols])
