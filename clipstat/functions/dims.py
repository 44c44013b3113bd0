"""Small fixed dimensions: category names, weekday and duration-bucket labels.

Each dimension is a (label, ordinal) list.  Their sizes are fixed by the API
(32 categories, 7 days, 5 buckets), so they are safe to broadcast or to inline
as literal maps / arrays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# --- fixed values: video category id -> name, as published by the video API.
# Ids 23 and 34 both map to "Comedy" (names are not unique). Unknown -> "Unknown".
CATEGORY_NAMES = {
    "1": "Film & Animation",
    "2": "Autos & Vehicles",
    "10": "Music",
    "15": "Pets & Animals",
    "17": "Sports",
    "18": "Short Movies",
    "19": "Travel & Events",
    "20": "Gaming",
    "21": "Videoblogging",
    "22": "People & Blogs",
    "23": "Comedy",
    "24": "Entertainment",
    "25": "News & Politics",
    "26": "Howto & Style",
    "27": "Education",
    "28": "Science & Technology",
    "29": "Nonprofits & Activism",
    "30": "Movies",
    "31": "Anime/Animation",
    "32": "Action/Adventure",
    "33": "Classics",
    "34": "Comedy",
    "35": "Documentary",
    "36": "Drama",
    "37": "Family",
    "38": "Foreign",
    "39": "Horror",
    "40": "Sci-Fi/Fantasy",
    "41": "Thriller",
    "42": "Shorts",
    "43": "Shows",
    "44": "Trailers",
}
UNKNOWN_CATEGORY = "Unknown"

# --- fixed values: label orders used by the reports.
WEEKDAYS_SHORT = ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]
WEEKDAYS_LONG = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
DURATION_BUCKETS = ["< 1 min", "1-5 mins", "5-10 mins", "10-20 mins", "> 20 mins"]
# bucket edges in seconds between consecutive labels above
DURATION_EDGES = [60, 300, 600, 1200]

# --- fixed values: keywords of the reference's full analysis run.
DEFAULT_KEYWORDS = ["how to", "tutorial", "review", "guide", "tips", "introduction"]


def category_dim(spark: SparkSession) -> DataFrame:
    """(category_id, category_name): 32 rows."""
    schema = T.StructType(
        [T.StructField("category_id", T.StringType()), T.StructField("category_name", T.StringType())]
    )
    return spark.createDataFrame(list(CATEGORY_NAMES.items()), schema)


def label_dim(spark: SparkSession, labels: list[str], name: str) -> DataFrame:
    """(name, ordinal) rows, ordinal starting at 1."""
    schema = T.StructType(
        [T.StructField(name, T.StringType()), T.StructField(f"{name}_order", T.IntegerType())]
    )
    return spark.createDataFrame([(lab, i + 1) for i, lab in enumerate(labels)], schema)


def bucket_dim(spark: SparkSession, name: str = "duration_category") -> DataFrame:
    return label_dim(spark, DURATION_BUCKETS, name)


def keyword_dim(spark: SparkSession, keywords: list[str]) -> DataFrame:
    """(keyword, keyword_order): the user's list, its order kept for ties."""
    return label_dim(spark, list(keywords), "keyword")
