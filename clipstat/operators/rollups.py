"""Grouped rollups over videos and comments.

Every rollup is one ``groupBy().agg()``: Spark plans partial (map-side)
aggregation, a shuffle of at most one row per group per task, and a final
aggregation, so a hot group (one day, one category, one author holding a third
of all rows) is combined before it is shuffled.  Each takes ``by``: extra
leading keys (e.g. ``["channel_id"]``) that turn the one-channel report of the
reference into a per-channel report; ``by=[]`` equals the reference.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clipstat.functions import columns as C
from clipstat.functions.dims import DURATION_BUCKETS, WEEKDAYS_LONG
from clipstat.operators.nullsafe import join_null_safe

By = Sequence[str]

# result column -> measure, for the "avg5" family (count + 4 rounded means)
AVG_NAMES = {
    "avg_views": "view_count",
    "avg_likes": "like_count",
    "avg_comments": "comment_count",
    "avg_engagement": "engagement_rate",
}


def avg_measures(digits: int | None = 2, count_name: str | None = "video_count") -> list[Column]:
    """count(*) and the four means; ``digits=None`` leaves means unrounded."""
    out = [F.count(F.lit(1)).alias(count_name)] if count_name else []
    for name, col in AVG_NAMES.items():
        m = F.avg(col)
        out.append((m if digits is None else F.round(m, digits)).alias(name))
    return out


def rollup(df: DataFrame, key: str, key_expr: Column | None, measures: list[Column], by: By = ()) -> DataFrame:
    """groupBy(*by, key).agg(*measures), deriving ``key`` from ``key_expr`` first."""
    src = df if key_expr is None else df.withColumn(key, key_expr)
    return src.groupBy(*by, key).agg(*measures)


def sort_small(df: DataFrame, *order) -> DataFrame:
    """Sort a result whose size is bounded by a label domain (weekdays, buckets,
    categories, calendar months, a keyword list, histogram bins).

    The exchange to one partition comes after the final aggregation, so that
    stays parallel; only its few output rows are gathered, which skips the
    sampling job of a global range-partitioned sort.  (``coalesce`` is no
    exchange: it would pull the aggregation itself into the one task.)
    """
    return df.repartition(1).orderBy(*order)


def _ordered(df: DataFrame, by: By, *order: Column) -> DataFrame:
    """Reference order; per-group results (``by``) grow with the data: global sort."""
    if not by:
        return sort_small(df, *order)
    return df.orderBy(*[F.col(b).asc() for b in by], *order)


# ---------------- the analyzer's rollups (A1-A8) ----------------

def comments_per_video(comments: DataFrame) -> DataFrame:
    """A1: (video_id, actual_comment_count)."""
    return comments.groupBy("video_id").agg(F.count(F.lit(1)).alias("actual_comment_count"))


def performance_by_day(videos: DataFrame, by: By = ()) -> DataFrame:
    """A2: by short weekday of publish_date, Mon..Sun."""
    r = rollup(videos, "day_of_week", C.day_short("publish_date"), avg_measures(), by)
    return _ordered(r, by, C.weekday_order_short("day_of_week").asc())


def performance_by_month(videos: DataFrame, by: By = ()) -> DataFrame:
    """A3: by yyyy-MM of publish_date, ascending."""
    r = rollup(videos, "year_month", C.year_month("publish_date"), avg_measures(), by)
    return _ordered(r, by, F.col("year_month").asc())


def category_performance(videos: DataFrame, by: By = ()) -> DataFrame:
    """A4: by category name, plus total_views; largest total first."""
    measures = avg_measures() + [F.try_sum("view_count").alias("total_views")]
    r = rollup(videos, "category_name", None, measures, by)
    return _ordered(r, by, F.col("total_views").desc_nulls_last(), F.col("category_name").asc())


def length_performance(videos: DataFrame, by: By = ()) -> DataFrame:
    """A5: by left-closed duration bucket, shortest first."""
    r = rollup(videos, "duration_category", C.duration_bucket("duration_seconds"), avg_measures(), by)
    return _ordered(r, by, C.bucket_order("duration_category").asc())


def monthly_totals(videos: DataFrame, by: By = ()) -> DataFrame:
    """Videos and summed views / likes / comments per yyyy-MM."""
    measures = [
        F.count(F.lit(1)).alias("videos_published"),
        F.try_sum("view_count").alias("views_in_month"),
        F.try_sum("like_count").alias("likes_in_month"),
        F.try_sum("comment_count").alias("comments_in_month"),
    ]
    return rollup(videos, "year_month", C.year_month("publish_date"), measures, by)


MEDIANS = {
    "median_views": "view_count",
    "median_likes": "like_count",
    "median_comments": "comment_count",
    "median_engagement": "engagement_rate",
}


def engagement_metrics(videos: DataFrame, by: By = (), accuracy: int | None = None) -> DataFrame:
    """Four rounded means, four rounded medians, three totals.

    Medians are the exact lower median at any size (``stats.exact_quantiles``).
    ``accuracy`` asks for the ``percentile_approx`` sketch instead, with a rank
    error of at most n / accuracy; its buffers meet in one task per group.
    """
    aggs = avg_measures(count_name=None)
    if accuracy is not None:
        aggs += [F.round(F.percentile_approx(col, 0.5, accuracy), 2).alias(name) for name, col in MEDIANS.items()]
    aggs += [
        F.try_sum("view_count").alias("total_views"),
        F.try_sum("like_count").alias("total_likes"),
        F.try_sum("comment_count").alias("total_comments"),
    ]
    out = videos.groupBy(*by).agg(*aggs)
    if accuracy is not None:
        return out
    from clipstat.operators.stats import exact_quantiles  # stats builds on windows, which builds on rollups

    types = dict(videos.dtypes)
    long = videos.select(*by, F.inline(F.array(*[
        F.struct(F.lit(name).alias("_m"), F.col(col).cast("double").alias("_v")) for name, col in MEDIANS.items()
    ])))
    med = exact_quantiles(long, "_v", (0.5,), by=[*by, "_m"], interpolation="lower", few_groups=not by)
    piv = med.groupBy(*by).agg(*[
        F.round(F.max(F.when(F.col("_m") == name, F.col("value"))).cast(types[col]), 2).alias(name)
        for name, col in MEDIANS.items()
    ])
    # put the medians next to the other figures: union the two per-group rows and
    # keep each column's one non-null value (no join, also for the global row)
    cols = [*AVG_NAMES, *MEDIANS, "total_views", "total_likes", "total_comments"]
    kinds = {**dict(out.dtypes), **dict(piv.dtypes)}

    def widen(df: DataFrame) -> DataFrame:
        return df.select(*by, *[F.col(c) if c in df.columns else F.lit(None).cast(kinds[c]).alias(c) for c in cols])

    both = widen(out).unionByName(widen(piv))
    return both.groupBy(*by).agg(*[F.max(c).alias(c) for c in cols])


def commenter_totals(comments: DataFrame, by: By = ()) -> DataFrame:
    """Comments and their summed likes per (author_name, author_channel_id)."""
    return comments.groupBy(*by, "author_name", "author_channel_id").agg(
        F.count(F.lit(1)).alias("comment_count"), F.try_sum("like_count").alias("total_likes")
    )


def channel_summary(channel: DataFrame) -> DataFrame:
    """The channel's descriptive fields, one row per channel."""
    return channel.select(
        "channel_id",
        F.col("channel_title").alias("title"),
        F.col("channel_description").alias("description"),
        "custom_url",
        "published_at",
        "country",
        "view_count",
        "subscriber_count",
        "video_count",
    )


def channel_figures(summary: DataFrame, as_of: str | None = None) -> DataFrame:
    """``channel_summary`` with the mean views per video and the channel's age in days."""
    return summary.withColumns({
        "avg_views_per_video": C.avg_views_per_video("view_count", "video_count"),
        "channel_age_days": C.age_days("published_at", as_of),
    })


def performance_rollups(videos: DataFrame, by: By = (), persist: bool = True,
                        cached: list | None = None) -> dict[str, DataFrame]:
    """A2, A3, A4 and A5 from ONE scan of the videos.

    The four rollups share their measures, so counts and sums are aggregated
    once by (weekday, month, category, length), which combines map-side and
    leaves at most a few ten thousand rows a group of ``by``; each result rolls
    that up by one of the keys.  The combined rows are persisted: that is what
    makes it one scan.  Same rows and order as the individual operators.
    """
    keys = {
        "day_of_week": C.day_short("publish_date"),
        "year_month": C.year_month("publish_date"),
        "category_name": F.col("category_name"),
        "duration_category": C.duration_bucket("duration_seconds"),
    }
    src = videos.select(*by, *[e.alias(k) for k, e in keys.items()], *set(AVG_NAMES.values()))
    aggs = [F.count(F.lit(1)).alias("_n"), F.try_sum("view_count").alias("_total")]
    for c in AVG_NAMES.values():
        aggs += [F.count(c).alias(f"_n_{c}"), F.sum(F.col(c).cast("double")).alias(f"_s_{c}")]
    combined = src.groupBy(*by, *keys).agg(*aggs)
    if persist:
        combined = combined.persist()
        if cached is not None:  # the caller releases it when done
            cached.append(combined)

    def one(k: str, *extra: Column) -> DataFrame:
        means = [F.round(F.try_divide(F.sum(f"_s_{c}"), F.sum(f"_n_{c}")), 2).alias(name) for name, c in AVG_NAMES.items()]
        return combined.groupBy(*by, k).agg(F.sum("_n").alias("video_count"), *means, *extra)

    return {
        "performance_by_day": _ordered(one("day_of_week"), by, C.weekday_order_short("day_of_week").asc()),
        "performance_by_month": _ordered(one("year_month"), by, F.col("year_month").asc()),
        "category_performance": _ordered(one("category_name", F.try_sum("_total").alias("total_views")), by,
                                         F.col("total_views").desc_nulls_last(), F.col("category_name").asc()),
        "length_performance": _ordered(one("duration_category"), by, C.bucket_order("duration_category").asc()),
    }


# ---------------- the notebook's rollups (A17-A30) ----------------

def count_by(df: DataFrame, key: str, key_expr: Column | None = None, by: By = (), name: str = "count") -> DataFrame:
    """value_counts: rows per non-null key (pandas drops null keys)."""
    src = df if key_expr is None else df.withColumn(key, key_expr)
    return src.filter(F.col(key).isNotNull()).groupBy(*by, key).agg(F.count(F.lit(1)).alias(name))


def mean_by(df: DataFrame, key: str, measure: str, name: str, key_expr: Column | None = None, by: By = ()) -> DataFrame:
    """groupby(key)[measure].mean(): null keys dropped, null measures skipped."""
    src = df if key_expr is None else df.withColumn(key, key_expr)
    return src.filter(F.col(key).isNotNull()).groupBy(*by, key).agg(F.avg(measure).alias(name))


def count_by_category(videos: DataFrame, by: By = ()) -> DataFrame:
    """A17."""
    r = count_by(videos, "category_name", by=by, name="video_count")
    return _ordered(r, by, F.col("video_count").desc(), F.col("category_name").asc())


def mean_views_by_category(videos: DataFrame, by: By = ()) -> DataFrame:
    """A18."""
    r = mean_by(videos, "category_name", "view_count", "avg_views", by=by)
    return _ordered(r, by, F.col("avg_views").desc_nulls_last(), F.col("category_name").asc())


def mean_engagement_by_category(videos: DataFrame, by: By = ()) -> DataFrame:
    """A19."""
    r = mean_by(videos, "category_name", "engagement_rate", "avg_engagement", by=by)
    return _ordered(r, by, F.col("avg_engagement").desc_nulls_last(), F.col("category_name").asc())


def _all_buckets(videos: DataFrame, aggs: list[Column], by: By) -> DataFrame:
    """Right-closed buckets; every one of the five labels listed even when empty.

    The labels are a 5-row literal exploded per group key; the (small) rollup
    is then left-joined to it, so an empty bucket shows count 0 / mean null.
    """
    name = "duration_category"
    agg = (
        videos.withColumn(name, C.duration_bucket_right("duration_seconds"))
        .filter(F.col(name).isNotNull())
        .groupBy(*by, name)
        .agg(*aggs)
    )
    labels = F.explode(F.array(*[F.lit(b) for b in DURATION_BUCKETS])).alias(name)
    if by:
        keys = videos.select(*by).distinct().select(*by, labels)
    else:
        keys = videos.sparkSession.range(1).select(labels)
    out = join_null_safe(keys, agg, by, [name], "left")
    return _ordered(out, by, C.bucket_order(name).asc())


def count_by_bucket(videos: DataFrame, by: By = ()) -> DataFrame:
    """A20."""
    out = _all_buckets(videos, [F.count(F.lit(1)).alias("video_count")], by)
    return out.withColumn("video_count", F.coalesce("video_count", F.lit(0)).cast("bigint"))


def mean_views_by_bucket(videos: DataFrame, by: By = ()) -> DataFrame:
    """A21."""
    return _all_buckets(videos, [F.avg("view_count").alias("avg_views")], by)


def mean_engagement_by_bucket(videos: DataFrame, by: By = ()) -> DataFrame:
    """A22."""
    return _all_buckets(videos, [F.avg("engagement_rate").alias("avg_engagement")], by)


def count_by_day(videos: DataFrame, by: By = ()) -> DataFrame:
    """Full weekday names of published_at, Monday first; only days that occur."""
    r = count_by(videos, "day_of_week", C.day_long("published_at"), by, "video_count")
    return _ordered(r, by, C.ordinal("day_of_week", WEEKDAYS_LONG).asc())


def mean_views_by_day(videos: DataFrame, by: By = ()) -> DataFrame:
    """A24."""
    r = mean_by(videos, "day_of_week", "view_count", "avg_views", C.day_long("published_at"), by)
    return _ordered(r, by, C.ordinal("day_of_week", WEEKDAYS_LONG).asc())


def count_by_hour(videos: DataFrame, by: By = ()) -> DataFrame:
    """Hour of day (UTC), ascending."""
    r = count_by(videos, "hour_of_day", C.hour_of_day("published_at"), by, "video_count")
    return _ordered(r, by, F.col("hour_of_day").asc())


def videos_per_month(videos: DataFrame, by: By = ()) -> DataFrame:
    """Yyyy-MM of published_at."""
    r = count_by(videos, "year_month", C.year_month("published_at"), by, "videos_published")
    return _ordered(r, by, F.col("year_month").asc())


def commenter_counts_by_name(comments: DataFrame, limit: int | None = 10, by: By = ()) -> DataFrame:
    """Comments per author name (value_counts), most first; top ``limit`` (of each group)."""
    r = count_by(comments, "author_name", by=by, name="comment_count")
    order = [F.col("comment_count").desc(), F.col("author_name").asc()]
    if by and limit is not None:
        w = Window.partitionBy(*by).orderBy(*order)
        r = r.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= limit).drop("_n")
    r = r.orderBy(*[F.col(b).asc() for b in by], *order)
    return r if by or limit is None else r.limit(limit)


def comments_per_date(comments: DataFrame, by: By = ()) -> DataFrame:
    """Comments per calendar day of published_at."""
    r = count_by(comments, "date", F.to_date("published_at"), by, "comment_count")
    return _ordered(r, by, F.col("date").asc())


def total_comments(comments: DataFrame, by: By = ()) -> DataFrame:
    """A30."""
    return comments.groupBy(*by).agg(F.count(F.lit(1)).alias("total_comments"))

