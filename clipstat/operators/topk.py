"""Top-k rankings (T1-T4) with a total order (metric desc, then id).

``by=()``: ``orderBy().limit()`` plans as TakeOrderedAndProject (each task
keeps its own top k, the driver merges k x tasks rows).  ``by=[...]``:
``row_number() <= k`` over a per-group window; Spark inserts a partial
WindowGroupLimit before the shuffle, so even a group with a third of all rows
ships at most k rows per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clipstat.functions import columns as C
from clipstat.operators.rollups import category_performance, commenter_totals


def top_n(df: DataFrame, order: list, limit: int, by: Sequence[str] = (), rank_col: str = "rank") -> DataFrame:
    if by:
        w = Window.partitionBy(*by).orderBy(*order)
        return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= limit)
    top = df.orderBy(*order).limit(limit)
    # the ranked frame has at most ``limit`` rows: a one-partition window is free here
    return top.withColumn(rank_col, F.row_number().over(Window.orderBy(*order)))


def top_videos(videos: DataFrame, metric: str = "view_count", limit: int = 10, by: Sequence[str] = ()) -> DataFrame:
    """The ``limit`` videos with the largest ``metric`` (nulls last)."""
    return top_n(videos, [F.col(metric).desc_nulls_last(), F.col("video_id").asc()], limit, by)


def top_videos_many(videos: DataFrame, metrics: Sequence[str], limit: int = 10,
                    cached: list | None = None) -> dict[str, DataFrame]:
    """T1 for several metrics, with one wide read instead of one per metric.

    Each ranking is found on a narrow scan (video id + its metric: Parquet
    reads two columns), then the full rows of the at most
    ``len(metrics) * limit`` winners are fetched in one pass by a broadcast
    join (its size is bounded by that product) and cached; every result is a
    filter of that tiny cache.  Same rows, columns and order as ``top_videos``
    when ``video_id`` is the table's key (every source keeps one row per video).
    """
    picks = None
    for m in metrics:
        t = top_videos(videos.select("video_id", m), m, limit).select(
            "video_id", F.lit(m).alias("_metric"), "rank")
        picks = t if picks is None else picks.unionByName(t)
    rows = videos.join(F.broadcast(picks), "video_id").persist()
    if cached is not None:  # the caller releases it when done
        cached.append(rows)
    cols = [*videos.columns, "rank"]
    return {m: rows.filter(F.col("_metric") == m).select(*cols).repartition(1).orderBy("rank") for m in metrics}


def top_videos_display(videos: DataFrame, limit: int = 10) -> DataFrame:
    """T4: the notebook's six-column top-10 by views."""
    cols = ["title", "view_count", "like_count", "comment_count", "engagement_rate", "published_at"]
    return top_videos(videos.select("video_id", *cols), "view_count", limit)


def top_commenters(comments: DataFrame, limit: int = 10, by: Sequence[str] = ()) -> DataFrame:
    """Commenter totals, most comments first."""
    order = [F.col("comment_count").desc(), F.col("author_name").asc_nulls_last(),
             F.col("author_channel_id").asc_nulls_last()]
    return top_n(commenter_totals(comments, by), order, limit, by)


def rank_categories(cats: DataFrame, limit: int = 10, by: Sequence[str] = ()) -> DataFrame:
    """T3 over a finished ``category_performance``."""
    return top_n(cats, [F.col("total_views").desc_nulls_last(), F.col("category_name").asc()], limit, by)


def top_categories(videos: DataFrame, limit: int = 10, by: Sequence[str] = ()) -> DataFrame:
    """Categories with the largest total views (of each group)."""
    return rank_categories(category_performance(videos, by), limit, by)


def ranking_chart(videos: DataFrame, metric: str = "views", limit: int = 10, by: Sequence[str] = ()) -> DataFrame:
    """B3 chart table of a ranking: short title, the drawn value and its label."""
    return chart_of_ranking(top_videos(videos, C.metric_column(metric), limit, by), metric, by)


def chart_of_ranking(top: DataFrame, metric: str = "views", by: Sequence[str] = ()) -> DataFrame:
    """The chart table of a finished ``top_videos``."""
    col = C.metric_column(metric)
    return top.select(
        *[b for b in by if b not in ("rank", "video_id")],
        "rank",
        "video_id",
        C.short_title("title").alias("short_title"),
        F.lit(col).alias("metric"),
        F.col(col).cast("double").alias("value"),
        C.human_number(F.col(col)).alias("value_label"),
    )
