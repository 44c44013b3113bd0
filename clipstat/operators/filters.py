"""Row predicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keyword_match(keyword, case_sensitive: bool = True, fields=("title", "description")) -> Column:
    """Title or description contains the keyword, taken literally.

    ``case_sensitive=True`` is the analyzer's filter (its comment says
    case-insensitive, the code is not); ``False`` is the notebook's.  SQL
    three-valued OR: a null title does not hide a description match.
    """
    kw = F.lit(keyword) if isinstance(keyword, str) else keyword
    cond = None
    for f in fields:
        c = F.col(f)
        one = c.contains(kw) if case_sensitive else F.lower(c).contains(F.lower(kw))
        cond = one if cond is None else (cond | one)
    return cond


def published_within(days: int, as_of=None, date_col: str = "publish_date") -> Column:
    """published in the last ``days`` days up to ``as_of`` (default today)."""
    ref = F.current_date() if as_of is None else F.to_date(F.lit(as_of) if isinstance(as_of, str) else as_of)
    d = F.col(date_col)
    return (d >= F.date_sub(ref, days)) & (d <= ref)


def filter_recent(videos: DataFrame, days: int = 365, as_of=None, partition_col: str | None = None) -> DataFrame:
    """F3 on a videos table; with a ``yyyy-MM`` partition column the month bound
    is added too, so a partitioned Parquet table prunes whole directories."""
    out = videos.filter(published_within(days, as_of))
    if partition_col and partition_col in videos.columns:
        ref = F.current_date() if as_of is None else F.to_date(F.lit(as_of))
        out = out.filter(F.col(partition_col) >= F.date_format(F.date_sub(ref, days), "yyyy-MM"))
    return out
