"""Connected components of a graph given as a table of links.

Alternating large-star and small-star rounds (Kiveris et al., 2014): joins and
minimum aggregations on the node, which combine before the shuffle, so a node
with very many links does not gather them in one task.  Each round's links are
written to the shared checkpoint folder.  Only two totals a round (count and
checksum) reach the driver, to see that nothing changed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipstat.llm.common import materialise


def _hook(links: DataFrame) -> DataFrame:
    """(u, v) -> (u, v, m): m is the smallest v of u, or u itself."""
    low = links.groupBy("u").agg(F.min("v").alias("m"))
    return links.join(low, "u").withColumn("m", F.least("m", "u"))


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _hook(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    hooked = _hook(down)
    moved = hooked.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = hooked.select("u", F.col("m").alias("v"))
    return moved.union(own).distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node that has a link to another one.

    ``root`` is the smallest node of the component.  Links in which a side is
    null, and links of a node with itself, are ignored; an empty table gives an
    empty result.
    """
    now = materialise(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).distinct(), "links")

    def state(df):
        r = df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        return r[0], r[1]

    before = state(now)
    while before[0]:
        now = materialise(_small_star(_large_star(now)), "links")
        after = state(now)
        if after == before:
            break
        before = after
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
