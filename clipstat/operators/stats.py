"""Column statistics (A12-A16, A27): profile, describe, histograms, density, correlation.

Counts, moments, min/max and co-moments are single-pass mergeable aggregates:
a partial aggregation per task plus one tiny final merge.  Quantiles are exact
ranks, selected by counting ever narrower cells of the values.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clipstat.functions import columns as C
from clipstat.operators.nullsafe import join_null_safe
from clipstat.session import checkpoint_dir

METRICS = ("view_count", "like_count", "comment_count", "duration_seconds", "engagement_rate")


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def column_profile(df: DataFrame) -> DataFrame:
    """Per column its position, Spark type and non-null count (``info()``)."""
    fields = df.schema.fields
    counts = df.agg(*[F.count(F.col(f"`{f.name}`")).alias(f"c{i}") for i, f in enumerate(fields)])
    return counts.select(F.inline(F.array(*[
        F.struct(
            F.lit(i).alias("position"),
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.col(f"c{i}").alias("non_null_count"),
        )
        for i, f in enumerate(fields)
    ])))


def _moments(c: str) -> list[Column]:
    return [
        F.count(c).alias(f"{c}__count"),
        F.avg(c).alias(f"{c}__mean"),
        F.stddev_samp(c).alias(f"{c}__std"),
        F.min(c).cast("double").alias(f"{c}__min"),
        F.max(c).cast("double").alias(f"{c}__max"),
    ]


#: Cells of a value's logarithm: each is about 0.02 % wide, and a group has some 100,000 at most.
CELLS_PER_LOG = 4096


def _cell(x: Column) -> Column:
    """A coarse code that never falls as ``x`` grows: the cell of its signed logarithm, NaN last."""
    y = F.signum(x) * F.log1p(F.abs(x)) * F.lit(float(CELLS_PER_LOG))
    edge = F.lit(800.0 * CELLS_PER_LOG)
    return F.when(F.isnan(x), F.lit(2**40)).otherwise(F.floor(F.least(F.greatest(y, -edge), edge)).cast("bigint"))


def exact_quantiles(df: DataFrame, value: str, quantiles: Sequence[float] = (0.25, 0.5, 0.75),
                    by: Sequence[str] = (), interpolation: str = "linear", few_groups: bool = False) -> DataFrame:
    """Exact quantiles with linear interpolation (pandas' rule), per group, at any scale.

    ``interpolation="lower"`` returns the element at rank ceil(q * n) instead
    (``percentile_approx``'s definition; for the median, the lower median).

    Selection, not sorting: every value has a coarse code, the cell of its
    logarithm, which never falls as the value grows.  Counting the cells (partial
    aggregation) tells which of them hold a wanted rank; only their values, a few
    in ten thousand, are counted one by one and ranked inside.  So the ranks are exact;
    both order statistics around an interpolation point come from the same pass.
    No buffer holds a group, nothing is range-partitioned or checkpointed, and the
    plan is the same at every size: two scans.

    A null in ``by`` is a group like any other.  ``few_groups``: the caller knows
    the groups to be few (a list of columns), so the wanted cells, at most two for
    each quantile and group, are broadcast.  Output: ``by``, ``quantile``, ``value``.
    """
    small = F.broadcast if few_groups or not by else (lambda d: d)
    x = df.select(*by, F.col(value).cast("double").alias("_x")).filter(F.col("_x").isNotNull()).withColumn("_cell", _cell(F.col("_x")))
    n = F.col("_n")
    ranks = []
    for q in quantiles:
        if interpolation == "lower":
            lo = F.greatest(F.ceil(F.lit(float(q)) * n), F.lit(1)).cast("bigint")
            hi, t = lo, F.lit(0.0)
        else:
            h = F.lit(float(q)) * (n - 1)
            lo = (F.floor(h) + 1).cast("bigint")
            hi, t = F.least(lo + 1, n), h - F.floor(h)
        ranks.append(F.struct(F.lit(float(q)).alias("quantile"), lo.alias("lo"), hi.alias("hi"), t.alias("t")))
    held = lambda r: (F.col("_off") < r["hi"]) & (F.col("_off") + F.col("_k") >= r["lo"])

    upto = Window.partitionBy(*by).orderBy("_cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cells = x.groupBy(*by, "_cell").agg(F.count(F.lit(1)).alias("_k"))
    cells = cells.withColumn("_off", F.sum("_k").over(upto) - F.col("_k")).withColumn("_n", F.sum("_k").over(Window.partitionBy(*by)))
    cells = cells.withColumn("_ranks", F.filter(F.array(*ranks), held)).filter(F.size("_ranks") > 0)

    # the cells come to the rows, and their ranks along: the same for all rows of a cell
    inside = join_null_safe(x, small(cells.select(*by, "_cell", "_off", "_ranks")), by, ["_cell"])
    values = inside.groupBy(*by, "_cell", "_off", "_ranks", "_x").agg(F.count(F.lit(1)).alias("_times"))
    within = Window.partitionBy(*by, "_cell").orderBy("_x").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = (values.withColumn("_upto", F.col("_off") + F.sum("_times").over(within))
              .withColumn("_from", F.col("_upto") - F.col("_times") + 1)
              .select(*by, "_x", "_from", "_upto", F.inline("_ranks")))
    at = lambda r: F.max(F.when(F.col(r).between(F.col("_from"), F.col("_upto")), F.col("_x")))
    picked = ranked.groupBy(*by, "quantile", "t").agg(at("lo").alias("_vlo"), at("hi").alias("_vhi"))
    a, b, t = F.col("_vlo"), F.col("_vhi"), F.col("t")
    # NumPy / pandas interpolation steps, for bit-equal results
    lerp = F.when(t == 0, a).when(t >= 0.5, b - (b - a) * (F.lit(1.0) - t)).otherwise(a + (b - a) * t)
    return picked.select(*by, "quantile", lerp.alias("value"))


def describe(df: DataFrame, cols: Sequence[str] = METRICS, quantiles: Sequence[float] = (0.25, 0.5, 0.75),
             by: Sequence[str] = ()) -> DataFrame:
    """Count, mean, std (sample), min, quartiles (linear interpolation), max.

    One row per column (and group).  Quartiles are exact at any size: one
    ``exact_quantiles`` over all columns at once (unpivoted).
    """
    qnames = [f"p{int(round(q * 100))}" for q in quantiles]
    aggs: list[Column] = []
    for c in cols:
        aggs += _moments(c)
    wide = df.groupBy(*by).agg(*aggs)
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col(f"{c}__count").alias("count"),
            F.col(f"{c}__mean").alias("mean"),
            F.col(f"{c}__std").alias("std"),
            F.col(f"{c}__min").alias("min"),
            F.col(f"{c}__max").alias("max"),
        )
        for c in cols
    ]
    out = wide.select(*by, F.inline(F.array(*rows)))
    long = df.select(*by, F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("_v")) for c in cols
    ])))
    eq = exact_quantiles(long, "_v", quantiles, by=[*by, "column_name"], few_groups=not by)
    piv = eq.groupBy(*by, "column_name").agg(*[
        F.max(F.when(F.col("quantile") == F.lit(float(q)), F.col("value"))).alias(nm)
        for q, nm in zip(quantiles, qnames)
    ])
    joined = join_null_safe(out, piv, by, ["column_name"], "left")
    return joined.select(*by, "column_name", "count", "mean", "std", "min", *qnames, "max")


#: A group's rows meet its bounds in this many parts, so a hot group is no single task.
BOUND_PARTS = 32


def _values(df: DataFrame, value, by: Sequence[str]) -> DataFrame:
    """(by, x, _k): the distinct values that aren't null and how many rows have each.

    What is derived from it shares one shuffle, so the rows' own plan runs once.
    Nulls go by their count: a filter on a derived value would be pushed down to
    the scan and work the value out there again, with all that it is made of.
    """
    return df.select(*by, _c(value).cast("double").alias("x")).groupBy(*by, "x").agg(F.count("x").alias("_k")).filter(F.col("_k") > 0)


def _parts(x: DataFrame) -> DataFrame:
    return x.withColumn("_part", F.pmod(F.xxhash64("x"), F.lit(BOUND_PARTS)).cast("int"))


def histogram(df: DataFrame, value, bins: int = 30, by: Sequence[str] = ()) -> DataFrame:
    """``bins`` equal-width bins over [min, max] (last bin closed).

    Lists every bin, empty ones with count 0.  Null values are dropped.
    ``by=()``: min / max enter as one struct-valued scalar subquery.
    ``by=[...]``: per-group bounds come from a grouped aggregate, repeated for
    ``BOUND_PARTS`` parts, and join the rows on (group, part of the row), so a
    group with a third of all rows is spread over as many tasks; a null group
    key is a group.  Either way equal values are counted first, by a partial aggregation.
    """
    x = _values(df, value, by)
    if by:
        bounds = x.groupBy(*by).agg(F.min("x").alias("_lo"), F.max("x").alias("_hi"))
        lo, hi = F.col("_lo"), F.col("_hi")
        parts = F.explode(F.sequence(F.lit(0), F.lit(BOUND_PARTS - 1))).alias("_part")
        x = join_null_safe(_parts(x), bounds.select(*by, "_lo", "_hi", parts), by, ["_part"])
    else:
        b = x.agg(F.struct(F.min("x").alias("lo"), F.max("x").alias("hi"))).scalar()
        lo, hi = b["lo"], b["hi"]
    width = (hi - lo) / F.lit(float(bins))
    idx = F.when(hi == lo, F.lit(0)).otherwise(
        F.least(F.lit(bins - 1), F.floor((F.col("x") - lo) * F.lit(float(bins)) / (hi - lo)).cast("int"))
    )
    counts = x.withColumn("bin", idx).groupBy(*by, "bin").agg(F.sum("_k").alias("count"))
    bin_ids = F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin")
    if by:
        grid = bounds.select(*by, "_lo", "_hi", bin_ids)
    else:
        grid = df.sparkSession.range(1).select(bin_ids)
    out = join_null_safe(grid, counts, by, ["bin"], "left").select(
        *by,
        "bin",
        (lo + F.col("bin") * width).alias("bin_start"),
        (lo + (F.col("bin") + 1) * width).alias("bin_end"),
        F.coalesce(F.col("count"), F.lit(0)).cast("bigint").alias("count"),
    )
    if by:
        return out.orderBy(*by, "bin")
    return out.repartition(1).orderBy("bin")


def views_histogram(videos: DataFrame, bins: int = 30, by: Sequence[str] = ()) -> DataFrame:
    return histogram(videos, "view_count", bins, by)


def duration_histogram(videos: DataFrame, bins: int = 30, by: Sequence[str] = ()) -> DataFrame:
    return histogram(videos, C.minutes("duration_seconds"), bins, by)


def density_curve(df: DataFrame, value, grid: int = 200, bins_per_bandwidth: int = 64,
                  bw_adjust: float = 1.0, by: Sequence[str] = ()) -> DataFrame:
    """Gaussian kernel density on ``grid`` points spanning [min, max], per group.

    Bandwidth h is Scott's rule, sample std * n^(-1/5) (times ``bw_adjust``).
    Equal values are counted first, in a job of its own, so the rows are read once.
    The values are then counted in fine bins of width h / ``bins_per_bandwidth``
    (a partial aggregation; a bin keeps its count, mean and variance).  Every
    bin is evaluated at every grid point: its kernel at the mean, with the
    second-order term of its variance, which leaves a relative error of about
    1e-6 against the sum over all rows.  The sums are partially aggregated too,
    so the work is (non-empty bins) x ``grid``, whatever the row count.
    Constant data (h = 0) give no curve (null).
    """
    checkpoint_dir(df.sparkSession)
    # kept on disk: the plan of a derived value, many times in one plan, takes the driver longer than the work itself
    x, k, n = _values(df, value, by).checkpoint(), F.col("_k"), F.col("_n")
    parts = F.explode(F.sequence(F.lit(0), F.lit(BOUND_PARTS - 1))).alias("_part")
    span = x.groupBy(*by).agg(F.min("x").alias("_lo"), F.max("x").alias("_hi"), F.sum("_k").alias("_n"),
                              (F.sum(F.col("x") * k) / F.sum("_k")).alias("_mean"))
    off = F.col("x") - F.col("_mean")
    s = (join_null_safe(_parts(x), span.select(*by, "_lo", "_hi", "_n", "_mean", parts), by, ["_part"])
         .groupBy(*by, "_lo", "_hi", "_n").agg(F.sum(k * off * off).alias("_dev")))
    sd = F.sqrt(F.try_divide(F.col("_dev"), n - 1))
    s = s.withColumn("_bw", sd * F.pow(n.cast("double"), F.lit(-0.2)) * F.lit(bw_adjust))
    width = F.col("_bw") / F.lit(float(bins_per_bandwidth))
    fb = F.floor(F.try_divide(F.col("x") - F.col("_lo"), width))
    stats = ["_lo", "_hi", "_n", "_bw"]
    binned = join_null_safe(_parts(x), s.select(*by, *stats, parts), by, ["_part"]).withColumn("_fb", fb)
    # a bin's mean and variance from its left edge on, so that large values lose no digits
    edge = F.col("_lo") + F.col("_fb") * width
    binned = (binned.withColumn("_y", F.col("x") - edge).groupBy(*by, *stats, "_fb")
              .agg(F.sum("_k").alias("_times"), (F.sum(k * F.col("_y")) / F.sum("_k")).alias("_m"), (F.sum(k * F.col("_y") * F.col("_y")) / F.sum("_k")).alias("_m2"))
              .select(*by, *stats, F.col("_times").alias("_k"), (edge + F.col("_m")).alias("_c"), (F.col("_m2") - F.col("_m") * F.col("_m")).alias("_v")))
    points = F.explode(F.sequence(F.lit(0), F.lit(grid - 1))).alias("_g")
    gx = F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("_g") / F.lit(float(max(grid - 1, 1)))
    z = F.try_divide(gx - F.col("_c"), F.col("_bw"))
    near = F.col("_k") * F.exp(-0.5 * z * z) * (1 + 0.5 * F.try_divide(F.col("_v"), F.col("_bw") * F.col("_bw")) * (z * z - 1))
    sums = binned.select(*by, *stats, "_k", "_c", "_v", points).groupBy(*by, "_g").agg(F.sum(near).alias("_w"))
    norm = F.col("_n").cast("double") * F.col("_bw") * F.lit(math.sqrt(2 * math.pi))
    out = join_null_safe(s.select(*by, *stats, points), sums, by, ["_g"], "left").select(
        *by, F.col("_g").alias("grid_index"), gx.alias("x"), F.try_divide(F.col("_w"), norm).alias("density"))
    if by:
        return out.orderBy(*by, "grid_index")
    return out.repartition(1).orderBy("grid_index")


def pearson(a: str, b: str) -> Column:
    """Pearson r over the rows where both are non-null (pandas' pairwise-complete).

    Null, not an error, when either side is constant or has fewer than two
    values: Spark's ``corr`` divides by zero there, which ANSI mode raises.
    """
    x, y = F.col(a).cast("double"), F.col(b).cast("double")
    both = x.isNotNull() & y.isNotNull()
    xs, ys = F.when(both, x), F.when(both, y)
    return F.try_divide(F.covar_samp(xs, ys), F.sqrt(F.var_samp(xs) * F.var_samp(ys)))


def correlation_matrix(df: DataFrame, cols: Sequence[str] = METRICS, by: Sequence[str] = ()) -> DataFrame:
    """Pearson correlation of every pair, pairwise-complete, as (x, y, r).

    One aggregation of the upper triangle (incl. diagonal), then mirrored;
    ``by`` gives one matrix per group.
    """
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    wide = df.groupBy(*by).agg(*[pearson(a, b).alias(f"r{i}") for i, (a, b) in enumerate(pairs)])
    cells = []
    for i, (a, b) in enumerate(pairs):
        cells.append(F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), F.col(f"r{i}").alias("r")))
        if a != b:
            cells.append(F.struct(F.lit(b).alias("x"), F.lit(a).alias("y"), F.col(f"r{i}").alias("r")))
    return wide.select(*by, F.inline(F.array(*cells)))


def loglog_points(videos: DataFrame) -> DataFrame:
    """P25: views vs likes on log axes (values <= 0 cannot be drawn)."""
    return videos.filter((F.col("view_count") > 0) & (F.col("like_count") > 0)).select(
        "video_id", "title", "view_count", "like_count", "comment_count", "engagement_rate",
        F.log10("view_count").alias("log_views"), F.log10("like_count").alias("log_likes"),
    )
