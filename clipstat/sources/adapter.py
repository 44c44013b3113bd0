"""Adapter: the driver's TPC-H-like test tables -> channel / videos / comments.

The test tables carry no video domain, so one deterministic mapping turns them
into the processed tables of this engine (orders -> videos, customers ->
channels, line items -> comments).  ``clipstat.plans.oracle`` states the same
mapping in DuckDB SQL, so both engines see identical inputs.

All of it is declarative: joins on keys, one partial aggregation of line items
per order, no Python per row.  At scale ``orders`` and ``lineitem`` are the big
sides; they join on the order key after the line items are pre-aggregated to
one row per order, so the join input is bounded by the order count.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipstat.operators.dedup import latest_per_key
from clipstat.sources.prepare import derive_video_columns
from clipstat.session import use_utc

# fixed value: reference day for days_since_published in the fixture, so that
# results do not move with the wall clock.
AS_OF = "2025-01-01"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One test table; the session is pinned to UTC (its times are zone-less)."""
    use_utc(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _str(c) -> F.Column:
    return c.cast("string")


def videos(spark: SparkSession, sf_dir: str, as_of: str = AS_OF) -> DataFrame:
    use_utc(spark)
    o = read(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority"
    )
    cust = read(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    part = read(spark, sf_dir, "part").select("p_partkey", "p_name")
    li = (
        read(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(F.sum("l_quantity").cast("bigint").alias("likes"), F.count(F.lit(1)).alias("n"))
    )
    n_parts = read(spark, sf_dir, "part").select(F.count(F.lit(1))).scalar()

    k = F.col("o_orderkey")
    d = (k * 37) % 7200
    secs = d % 60
    duration = (
        F.when(k % 97 == 0, F.lit(None).cast("string"))
        .when(k % 50 == 0, F.lit("P0D"))
        .otherwise(
            F.concat(
                F.lit("PT"),
                F.when(d >= 3600, F.concat(_str(F.floor(d / 3600)), F.lit("H"))).otherwise(F.lit("")),
                F.when(d % 3600 >= 60, F.concat(_str(F.floor((d % 3600) / 60)), F.lit("M"))).otherwise(F.lit("")),
                F.when(secs > 0, F.concat(_str(secs), F.lit("S"))).otherwise(F.lit("")),
            )
        )
    )
    published = (
        F.col("o_orderdate").cast("timestamp")
        + F.make_dt_interval(hours=(k % 24).cast("int"))
    )
    view_count = (
        F.when(k % 103 == 0, F.lit(None).cast("bigint"))
        .when(k % 101 == 0, F.lit(0).cast("bigint"))
        .otherwise(F.floor("o_totalprice").cast("bigint"))
    )

    base = (
        o.withColumn("_pk", k % n_parts)
        .join(cust, F.col("c_custkey") == F.col("o_custkey"))
        .join(part, F.col("p_partkey") == F.col("_pk"))
        .join(li, F.col("l_orderkey") == k, "left")
    )
    v = base.select(
        F.concat(F.lit("v_"), _str(k)).alias("video_id"),
        F.concat(F.lit("UC"), _str(F.col("o_custkey"))).alias("channel_id"),
        F.when(k % 2 == 0, F.upper("p_name")).otherwise(F.col("p_name")).alias("title"),
        F.when(k % 7 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.col("o_orderpriority"), F.lit(" guide")))
        .alias("description"),
        published.alias("published_at"),
        F.col("c_name").alias("channel_title"),
        _str(F.col("c_nationkey") + 1).alias("category_id"),
        F.split(F.lower("p_name"), " ").alias("tags"),
        duration.alias("duration"),
        view_count.alias("view_count"),
        F.col("likes").alias("like_count"),
        F.lit(0).cast("bigint").alias("favorite_count"),
        F.col("n").alias("comment_count"),
    )
    return derive_video_columns(v, as_of)


def channels(spark: SparkSession, sf_dir: str, vids: DataFrame | None = None) -> DataFrame:
    use_utc(spark)
    vids = videos(spark, sf_dir) if vids is None else vids
    per_channel = vids.groupBy("channel_id").agg(
        F.sum("view_count").alias("v_views"),
        F.count(F.lit(1)).alias("v_count"),
        F.min("published_at").alias("v_first"),
    )
    cust = read(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    nation = read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    ch = cust.join(nation, F.col("n_nationkey") == F.col("c_nationkey"), "left").withColumn(
        "channel_id", F.concat(F.lit("UC"), _str(F.col("c_custkey")))
    )
    return ch.join(per_channel, "channel_id", "left").select(
        "channel_id",
        F.col("c_name").alias("channel_title"),
        F.col("c_mktsegment").alias("channel_description"),
        F.concat(F.lit("@"), F.lower(F.regexp_replace("c_name", "#", ""))).alias("custom_url"),
        F.col("v_first").alias("published_at"),
        F.col("n_name").alias("country"),
        F.coalesce("v_views", F.lit(0)).cast("bigint").alias("view_count"),
        F.floor(F.abs("c_acctbal") * 10).cast("bigint").alias("subscriber_count"),
        F.coalesce("v_count", F.lit(0)).cast("int").alias("video_count"),
        F.concat(F.lit("UU"), _str(F.col("c_custkey"))).alias("uploads_playlist_id"),
    )


def comments_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every comment snapshot (comment ids repeat: re-fetched comments)."""
    use_utc(spark)
    li = read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_returnflag", "l_linestatus", "l_shipdate"
    )
    sup = read(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    ts = F.col("l_shipdate").cast("timestamp")
    return li.join(sup, F.col("s_suppkey") == F.col("l_suppkey")).select(
        F.concat(_str(F.col("l_orderkey")), F.lit("."), _str(F.col("l_linenumber"))).alias("comment_id"),
        F.concat(F.lit("v_"), _str(F.col("l_orderkey"))).alias("video_id"),
        F.col("s_name").alias("author_name"),
        F.concat(F.lit("UC"), _str(F.col("l_suppkey"))).alias("author_channel_id"),
        F.concat(F.lit("status "), F.col("l_returnflag"), F.col("l_linestatus")).alias("text"),
        ts.alias("published_at"),
        ts.alias("updated_at"),
        F.col("l_quantity").cast("int").alias("like_count"),
    )


def comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per comment id: the latest snapshot wins."""
    return latest_per_key(comments_raw(spark, sf_dir), "comment_id", "updated_at")


@dataclass
class Tables:
    channel: DataFrame
    videos: DataFrame
    comments: DataFrame


def tables(spark: SparkSession, sf_dir: str) -> Tables:
    v = videos(spark, sf_dir)
    return Tables(channel=channels(spark, sf_dir, v), videos=v, comments=comments(spark, sf_dir))
