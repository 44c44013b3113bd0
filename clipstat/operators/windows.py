"""Running totals.

W1 runs on the monthly rollup (one row per month and group), so its window is
small.  W2 is a running total over every video in publish order: a plain
``Window.orderBy`` would move every row into one task ("Exchange
SinglePartition").  Instead it is a two-level prefix sum over blocks, which are
ranges of the order read off the order columns themselves:

1. the first block key is the day of the publish time.  A histogram (one
   partial aggregation) counts the rows of each; a day with more than
   ``rows_per_block`` rows gets a second key, the minute, then the instant, then
   longer and longer prefixes of the video id, as long as a histogram finds
   blocks that are too large.  So a hot day, instant or channel is split, and the
   same rows give the same blocks on every run;
2. block totals -> exclusive prefix over blocks;
3. per-block running sum + that block's offset, joined on the block keys.

Only histograms and totals pass through few tasks, never the rows, and the plan
is the same at every size.  A block with more than ``rows_per_block`` rows is
left only if that many rows agree in the whole order (same instant, same id).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clipstat.operators.nullsafe import join_null_safe
from clipstat.operators.rollups import monthly_totals, sort_small
from clipstat.session import checkpoint_dir

RUNNING = {
    "total_videos": "videos_published",
    "total_views": "views_in_month",
    "total_likes": "likes_in_month",
    "total_comments": "comments_in_month",
}


def channel_growth(videos: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Monthly totals and their running sums, by year_month."""
    m = monthly_totals(videos, by)
    w = Window.partitionBy(*by).orderBy(F.col("year_month").asc()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    for out, src in RUNNING.items():
        m = m.withColumn(out, F.try_sum(src).over(w))
    if not by:
        return sort_small(m, F.col("year_month").asc())
    return m.orderBy(*[F.col(b) for b in by], F.col("year_month").asc())


ROWS_PER_BLOCK = 1_000_000
#: Block keys of a text: prefixes of it.
PREFIXES = (2, 4, 6, 8, 12, 16, 24, 32, 64)
LAST, FIRST = 2**63 - 1, -(2**63)


def _levels(c: Column, kind: str, nulls_last: bool) -> list[Column]:
    """Keys that order rows as ``c`` does, from coarse to exact, none of them null."""
    if kind in ("timestamp", "timestamp_ntz", "date"):
        x = F.unix_micros(c.cast("timestamp"))
        steps = [F.call_function("div", x, F.lit(n)) for n in (86_400_000_000, 60_000_000)] + [x]
    elif kind in ("tinyint", "smallint", "int", "bigint"):
        x = c.cast("bigint")
        steps = [F.call_function("div", x, F.lit(n)) for n in (2**40, 2**20)] + [x]
    elif kind == "string":
        end = F.lit("\U0010ffff" if nulls_last else "")
        return [F.coalesce(F.substring(c, 1, n), end) for n in PREFIXES] + [F.coalesce(c, end)]
    else:  # doubles and the like: nulls share a block with what they stand beside
        return [F.coalesce(c.cast("double"), F.lit(float("nan" if nulls_last else "-inf")))]
    return [F.coalesce(s, F.lit(LAST if nulls_last else FIRST)) for s in steps]


def order_blocks(df: DataFrame, by: Sequence[str], order: Sequence[str], tie: str, rows_per_block: int = ROWS_PER_BLOCK,
                 totals: Sequence[Column] = ()) -> tuple[DataFrame, list[str], DataFrame]:
    """``df`` with block keys: blocks follow each other in (``order`` nulls last, ``tie``) within ``by``.

    Returns the tagged rows, the names of the key columns, of which there are as
    many as the histograms ask for, and the last histogram: the rows (``_n``) and
    ``totals`` of each block.  It is checkpointed, so the blocks' totals take no
    further pass.  The blocks that are too large, a millionth of the rows at most,
    are broadcast.
    """
    kinds = dict(df.dtypes)
    levels = [x for o in order for x in _levels(F.col(o), kinds[o], True)] + _levels(F.col(tie), kinds[tie], False)
    tagged, keys = df.withColumn("_k0", levels[0]), ["_k0"]
    checkpoint_dir(df.sparkSession)
    for i, level in enumerate([*levels[1:], None], 1):
        blocks = tagged.groupBy(*by, *keys).agg(F.count(F.lit(1)).alias("_n"), *totals).checkpoint(eager=True)
        large = blocks.filter(F.col("_n") > rows_per_block).select(*by, *keys, F.lit(True).alias("_large"))
        if level is None or large.isEmpty():
            break
        unsplit = F.lit("0").cast(tagged.select(level.alias("x")).schema["x"].dataType)  # the same for all rows of a block that stays whole
        marked = join_null_safe(tagged, F.broadcast(large), by, keys, "left")
        tagged = marked.withColumn(f"_k{i}", F.when(F.col("_large"), level).otherwise(unsplit)).drop("_large")
        keys.append(f"_k{i}")
    return tagged, keys, blocks


def running_total(
    df: DataFrame,
    measure: str = "view_count",
    order: Sequence[str] = ("published_at",),
    tie: str = "video_id",
    by: Sequence[str] = (),
    out: str = "cumulative_views",
    rows_per_block: int = ROWS_PER_BLOCK,
) -> DataFrame:
    """Running sum of ``measure`` in (``order`` asc nulls last, ``tie``) order.

    A row with a null measure gets a null result and adds 0, as pandas
    ``cumsum`` does.  Output: ``by``, ``tie``, ``order``, ``measure``, ``out``.
    """
    sort = [F.col(o).asc_nulls_last() for o in order] + [F.col(tie).asc()]
    keep = [*by, tie, *[o for o in order if o != tie], measure]
    tagged, keys, totals = order_blocks(df.select(*keep), by, order, tie, rows_per_block, [F.try_sum(measure).alias("_s")])
    before = Window.partitionBy(*by).orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*by, *keys, F.coalesce(F.try_sum("_s").over(before), F.lit(0)).alias("_off"))

    within = Window.partitionBy(*keys, *by).orderBy(*sort).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = tagged.withColumn("_run", F.coalesce(F.try_sum(measure).over(within), F.lit(0)))
    res = join_null_safe(local, offsets, by, keys)
    return res.select(
        *keep,
        F.when(F.col(measure).isNull(), F.lit(None)).otherwise(F.try_add(F.col("_off"), F.col("_run"))).alias(out),
    )
