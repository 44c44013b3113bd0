"""Derived video columns shared by every video source."""

from __future__ import annotations

from pyspark.sql import DataFrame

from clipstat.functions import columns as C


def derive_video_columns(v: DataFrame, as_of: str | None = None) -> DataFrame:
    """Add duration_seconds, category_name, engagement_rate, publish_date, days_since_published.

    ``as_of`` fixes "today" for days_since_published (default: current date).
    """
    return (
        v.withColumn("duration_seconds", C.duration_seconds("duration"))
        .withColumn("category_name", C.category_name("category_id"))
        .withColumn("engagement_rate", C.engagement_rate())
        .withColumn("publish_date", C.publish_date("published_at"))
        .withColumn("days_since_published", C.days_since("publish_date", as_of))
    )
