"""Chart tables, saved as Parquet marts.

Each dashboard figure's input becomes a saved table; refreshing the marts
replaces the dashboard's one-hour in-process cache.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipstat.functions import columns as C
from clipstat.functions.dims import DEFAULT_KEYWORDS
from clipstat.operators import rollups as R
from clipstat.operators import stats as ST
from clipstat.operators import topk as T
from clipstat.operators import windows as W
from clipstat.operators.filters import filter_recent
from clipstat.plans.analysis import AnalysisResults, full_analysis
from clipstat.sources.sinks import commit_version, current_version, new_version, write_parquet


def commenters_display(top_commenters: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The commenter table as shown (three renamed columns), the group's keys kept."""
    return top_commenters.select(
        *by,
        "rank",
        F.col("author_name").alias("Author"),
        F.col("comment_count").alias("Comments"),
        F.col("total_likes").alias("Total Likes"),
    )


def _cards(df: DataFrame, keys: list[str], items: list[tuple[str, str, str]]) -> DataFrame:
    """Unpivot metric columns into (card, value, display) rows, one set per key."""
    cards = F.inline(F.array(*[
        F.struct(F.lit(label).alias("card"), F.col(col).cast("double").alias("value"),
                 F.concat(C.human_number(F.col(col), tidy=True), F.lit(suffix)).alias("display"))
        for label, col, suffix in items
    ]))
    return df.select(*keys, cards)


def channel_cards(channel_summary: DataFrame, as_of: str | None = None) -> DataFrame:
    """Header cards per channel: subscribers, views, videos, average views per video."""
    return _cards(R.channel_figures(channel_summary, as_of), ["channel_id"], [
        ("Subscribers", "subscriber_count", ""),
        ("Total Views", "view_count", ""),
        ("Videos", "video_count", ""),
        ("Avg. Views per Video", "avg_views_per_video", ""),
    ])


def engagement_cards(engagement_metrics: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Engagement cards: the four means, engagement with a percent sign."""
    return _cards(engagement_metrics, list(by), [
        ("Avg. Views", "avg_views", ""),
        ("Avg. Likes", "avg_likes", ""),
        ("Avg. Comments", "avg_comments", ""),
        ("Avg. Engagement Rate", "avg_engagement", "%"),
    ])


def chart_tables(channel: DataFrame, videos: DataFrame, comments: DataFrame,
                 keywords: Sequence[str] = DEFAULT_KEYWORDS, by: Sequence[str] = (),
                 recent_days: int | None = None, as_of: str | None = None) -> AnalysisResults:
    """Every chart's input table: the 13 results, the dashboard's figures and the notebook's.

    ``by`` groups all of them; ``recent_days`` applies the dashboard's date
    range to the videos and their comments.  Rankings, categories and
    commenters are drawn from the analysis results, not computed again.
    """
    if recent_days is not None:
        videos = filter_recent(videos, recent_days, as_of,
                               partition_col="year_month" if "year_month" in videos.columns else None)
        comments = comments.join(videos.select("video_id"), "video_id", "left_semi")
    by = list(by)
    res = full_analysis(channel, videos, comments, keywords, by, as_of=as_of)
    out = dict(res)
    for metric in ("views", "likes", "comments", "engagement"):
        out[f"chart_top_{metric}"] = T.chart_of_ranking(res[f"top_videos_by_{metric}"], metric, by)
    out["chart_top_categories"] = T.rank_categories(res["category_performance"], by=by)
    out["chart_top_commenters"] = commenters_display(res["top_commenters"], by)
    out["chart_channel_cards"] = channel_cards(res["channel_summary"], as_of)
    out["chart_engagement_cards"] = engagement_cards(res["engagement_metrics"], by)
    out.update(notebook_tables(videos, comments, by))
    return AnalysisResults(out, res.cached)


def notebook_plans(videos: DataFrame, comments: DataFrame, by: Sequence[str] = ()) -> dict[str, Callable[[], DataFrame]]:
    """The notebook's figures as tables (``note_*``), each built when it is called for."""
    by = list(by)
    if by and not all(b in comments.columns for b in by):
        comments = comments.join(videos.select("video_id", *[b for b in by if b not in comments.columns]), "video_id", "left")
    minutes = C.minutes("duration_seconds")

    def points() -> DataFrame:
        return ST.loglog_points(videos) if not by else ST.loglog_points(videos).join(videos.select("video_id", *by), "video_id")

    return {
        "note_describe": lambda: ST.describe(videos, by=by),
        "note_views_histogram": lambda: ST.views_histogram(videos, by=by),
        "note_views_density": lambda: ST.density_curve(videos, "view_count", by=by),
        "note_duration_histogram": lambda: ST.duration_histogram(videos, by=by),
        "note_duration_density": lambda: ST.density_curve(videos, minutes, by=by),
        "note_count_by_category": lambda: R.count_by_category(videos, by),
        "note_mean_views_by_category": lambda: R.mean_views_by_category(videos, by),
        "note_mean_engagement_by_category": lambda: R.mean_engagement_by_category(videos, by),
        "note_count_by_bucket": lambda: R.count_by_bucket(videos, by),
        "note_mean_views_by_bucket": lambda: R.mean_views_by_bucket(videos, by),
        "note_mean_engagement_by_bucket": lambda: R.mean_engagement_by_bucket(videos, by),
        "note_count_by_day": lambda: R.count_by_day(videos, by),
        "note_mean_views_by_day": lambda: R.mean_views_by_day(videos, by),
        "note_count_by_hour": lambda: R.count_by_hour(videos, by),
        "note_videos_per_month": lambda: R.videos_per_month(videos, by),
        "note_running_views": lambda: W.running_total(videos, by=by),
        "note_correlation": lambda: ST.correlation_matrix(videos, by=by),
        "note_loglog_points": points,
        "note_commenters_by_name": lambda: R.commenter_counts_by_name(comments, by=by),
        "note_comments_per_date": lambda: R.comments_per_date(comments, by),
    }


def notebook_tables(videos: DataFrame, comments: DataFrame, by: Sequence[str] = ()) -> dict[str, DataFrame]:
    """The notebook's figures as tables: distributions, buckets, calendar, growth, correlation, comments."""
    return {name: make() for name, make in notebook_plans(videos, comments, by).items()}


def write_marts(tables: dict[str, DataFrame], out_root: str) -> list[str]:
    """Write one Parquet mart per table into a new version and commit them together; returns the written paths.

    Readers (``read_mart``) see the marts of the run before until all are
    written.  Intermediates cached for the tables are released then.
    """
    spark = next(iter(tables.values())).sparkSession
    root = f"{out_root.rstrip('/')}/marts"
    version = new_version(root)
    paths = []
    for name, df in tables.items():
        write_parquet(df, f"{version}/{name}")
        paths.append(f"{version}/{name}")
    commit_version(spark, root, version)
    if isinstance(tables, AnalysisResults):
        tables.release()
    return paths


def read_mart(spark: SparkSession, out_root: str, name: str) -> DataFrame:
    """One mart of the last committed run."""
    marts = current_version(spark, f"{out_root.rstrip('/')}/marts")
    return spark.read.parquet(f"{marts}/{name}")
