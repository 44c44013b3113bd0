"""Keyword fan-out (J4) and keyword performance.

The reference loops over keywords on the driver, two jobs per keyword.  Here
all keywords are matched in one pass, and no non-matching pair is produced:

* a few keywords (``FEW_KEYWORDS``): each row gets an array with the keywords
  that it contains (one plain ``contains`` per keyword and field; lower-casing, if
  asked for, happens once per field) and explodes it, so there is no join;
* a longer list would make that expression as long as the list.  It becomes a
  table with an inverted index: each keyword is filed under one of its q-grams (q = 3,
  or the keyword's length if less), the one that the fewest other keywords hold.
  A row's distinct q-grams meet the index in an equi-join, and ``contains`` decides
  between the few keywords that a gram brings.  The index is as long as the list
  that the caller gave, so it is broadcast.

One grouped aggregation then gives every keyword's figures.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipstat.operators.rollups import avg_measures, sort_small

FEW_KEYWORDS = 50
GRAM = 3


def keyword_matches(videos: DataFrame, keywords: Sequence[str], case_sensitive: bool = True,
                    fields: Sequence[str] = ("title", "description")) -> DataFrame:
    """One row per (video, matching keyword); a video may match several.

    Adds ``keyword`` and ``keyword_order`` (its position in the list, for ties).
    Keywords are taken literally; a null field never matches, but does not hide
    a match in the other field.  A keyword listed twice matches twice.
    """
    if len(keywords) > FEW_KEYWORDS:
        return keyword_matches_by_index(videos, keywords, case_sensitive, fields)
    if not keywords:
        return (videos.withColumn("keyword", F.lit(None).cast("string"))
                .withColumn("keyword_order", F.lit(None).cast("int")).filter(F.lit(False)))
    looked = [f"_in_{f}" for f in fields]
    src = videos.withColumns({n: F.col(f) if case_sensitive else F.lower(F.col(f)) for n, f in zip(looked, fields)})

    def hit(k: str):
        cond = F.lit(False)
        for n in looked:
            cond = cond | F.coalesce(F.col(n).contains(F.lit(k) if case_sensitive else F.lower(F.lit(k))), F.lit(False))
        return cond

    found = F.array_compact(F.array(*[
        F.when(hit(k), F.struct(F.lit(k).alias("keyword"), F.lit(i + 1).alias("keyword_order")))
        for i, k in enumerate(keywords)
    ]))
    return (
        src.withColumn("_kw", F.explode(found))
        .withColumn("keyword", F.col("_kw.keyword"))
        .withColumn("keyword_order", F.col("_kw.keyword_order"))
        .drop("_kw", *looked)
    )


def _grams(text: Column, q: int) -> Column:
    """The distinct substrings of ``q`` characters."""
    at = F.sequence(F.lit(1), F.length(text) - (q - 1))
    return F.when(F.length(text) >= q, F.array_distinct(F.transform(at, lambda i: F.substring(text, i, F.lit(q)))))


def keyword_matches_by_index(videos: DataFrame, keywords: Sequence[str], case_sensitive: bool = True,
                             fields: Sequence[str] = ("title", "description")) -> DataFrame:
    """``keyword_matches`` for any number of keywords: the plan doesn't grow with the list."""
    spark = videos.sparkSession
    named = [(k, i + 1) for i, k in enumerate(keywords)]
    lowered = spark.createDataFrame(named, "keyword string, keyword_order int") if named else spark.createDataFrame([], "keyword string, keyword_order int")
    lowered = lowered.withColumn("_word", F.col("keyword") if case_sensitive else F.lower("keyword"))
    size = F.least(F.length("_word"), F.lit(GRAM))
    at = F.sequence(F.lit(1), F.length("_word") - size + 1)
    # the list is the driver's own: its rarest grams are told there
    listed = lowered.select("keyword", "keyword_order", "_word", F.transform(at, lambda i: F.substring("_word", i, size)).alias("_grams")).collect()
    often = Counter(g for r in listed for g in set(r._grams))
    filed = [(r.keyword, r.keyword_order, r._word, min(r._grams, key=lambda g: (often[g], g))) for r in listed]
    index = spark.createDataFrame(filed, "keyword string, keyword_order int, _word string, _gram string")
    sizes = sorted({len(f[3]) for f in filed})  # 1 to q

    looked = [f"_in_{f}" for f in fields]
    src = videos.withColumns({n: F.col(f) if case_sensitive else F.lower(F.col(f)) for n, f in zip(looked, fields)})
    parts = [F.coalesce(_grams(F.col(n), q), F.array().cast("array<string>")) for n in looked for q in sizes if q]
    if 0 in sizes:  # an empty keyword is in every text that there is
        parts += [F.when(F.col(n).isNotNull(), F.array(F.lit(""))).otherwise(F.array().cast("array<string>")) for n in looked]
    some = src.withColumn("_gram", F.explode(F.array_distinct(F.flatten(F.array(*parts))))) if parts else src.withColumn("_gram", F.lit(None).cast("string"))
    holds = F.lit(False)
    for n in looked:
        holds = holds | F.coalesce(F.contains(F.col(n), F.col("_word")), F.lit(False))
    return some.join(F.broadcast(index), "_gram").filter(holds).drop("_gram", "_word", *looked)


def keyword_performance(videos: DataFrame, keywords: Sequence[str], case_sensitive: bool = True,
                        digits: int | None = 2, by: Sequence[str] = ()) -> DataFrame:
    """Per keyword: matching videos and their mean views / likes / comments / engagement.

    Keywords without a match are omitted; most matches first, ties in list order.
    ``case_sensitive=True, digits=2`` is the analyzer's (A9); ``False, None``
    the notebook's (A10).
    """
    m = keyword_matches(videos, keywords, case_sensitive)
    out = m.groupBy(*by, "keyword", "keyword_order").agg(*avg_measures(digits))
    order = [F.col("video_count").desc(), F.col("keyword_order").asc()]
    out = out.orderBy(*by, *order) if by else sort_small(out, *order)
    return out.drop("keyword_order")
