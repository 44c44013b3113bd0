"""Operator properties on the sf0.001 adapter tables and small fixtures."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from clipstat.functions import columns as C
from clipstat.operators import keywords as K
from clipstat.operators import rollups as R
from clipstat.operators import stats as ST
from clipstat.operators import topk as T
from clipstat.operators import windows as W
from clipstat.operators.dedup import latest_per_key
from clipstat.sources import adapter
from tests.conftest import SF_TINY


@pytest.fixture(scope="module")
def videos(spark):
    return adapter.videos(spark, SF_TINY).cache()


@pytest.fixture(scope="module")
def pdf(videos):
    return videos.drop("tags").toPandas()


def test_group_counts_sum_to_rows(videos, pdf):
    n = len(pdf)
    for fn in (R.performance_by_day, R.performance_by_month, R.category_performance, R.length_performance):
        assert sum(r.video_count for r in fn(videos).collect()) == n


def test_ordering_of_labelled_rollups(videos):
    days = [r.day_of_week for r in R.performance_by_day(videos).collect()]
    order = ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]
    assert days == [d for d in order if d in days]
    buckets = [r.duration_category for r in R.count_by_bucket(videos).collect()]
    assert buckets == ["< 1 min", "1-5 mins", "5-10 mins", "10-20 mins", "> 20 mins"]
    months = [r.year_month for r in R.performance_by_month(videos).collect()]
    assert months == sorted(months)


def test_growth_and_running_totals(videos, pdf):
    g = W.channel_growth(videos).collect()
    assert g[-1].total_views == pdf.view_count.sum()
    assert g[-1].total_videos == len(pdf)
    run = W.running_total(videos, rows_per_block=100).toPandas()
    ref = pdf.sort_values(["published_at", "video_id"], na_position="last")
    exp = ref.view_count.cumsum().where(ref.view_count.notna())
    got = run.set_index("video_id").loc[ref.video_id, "cumulative_views"]
    assert np.allclose(got.fillna(-1).to_numpy(dtype=float), exp.fillna(-1).to_numpy(dtype=float))


def test_running_total_null_rows(spark):
    df = spark.createDataFrame([("a", 1, 5), ("b", 2, None), ("c", 3, 7)], "video_id string, published_at int, view_count bigint")
    got = [r.cumulative_views for r in W.running_total(df, rows_per_block=2).orderBy("published_at").collect()]
    assert got == [5, None, 12]


def test_running_total_per_group_with_hot_group(spark):
    rows = [("hot", f"v{i:05d}", i // 7, i % 5) for i in range(3000)] + [("cold", f"w{i}", i, 1) for i in range(20)]
    df = spark.createDataFrame(rows, "channel_id string, video_id string, published_at int, view_count bigint")
    got = W.running_total(df, by=["channel_id"], rows_per_block=100).toPandas()
    pdf = df.toPandas().sort_values(["channel_id", "published_at", "video_id"])
    pdf["exp"] = pdf.groupby("channel_id").view_count.cumsum()
    m = pdf.merge(got, on="video_id")
    assert (m.exp == m.cumulative_views).all()


def test_top_videos_prefix_of_sort(videos, pdf):
    top = T.top_videos(videos, "engagement_rate", 7).toPandas()
    ref = pdf.sort_values(["engagement_rate", "video_id"], ascending=[False, True]).head(7)
    assert list(top.video_id) == list(ref.video_id)
    assert list(top["rank"]) == list(range(1, 8))
    per = T.top_videos(videos, "view_count", 2, by=["channel_id"]).toPandas()
    assert per.groupby("channel_id").size().max() <= 2


def test_engagement_metrics_median(videos, pdf):
    r = R.engagement_metrics(videos).first()
    vals = np.sort(pdf.view_count.dropna().to_numpy())
    assert r.median_views == vals[math.ceil(len(vals) / 2) - 1]
    assert r.total_views == pdf.view_count.sum()


def test_describe_matches_pandas(videos, pdf):
    d = {r.column_name: r for r in ST.describe(videos).collect()}
    for c in ST.METRICS:
        s = pdf[c].dropna().astype(float)
        for q, name in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75")):
            assert getattr(d[c], name) == pytest.approx(s.quantile(q), rel=1e-12)
        assert d[c].std == pytest.approx(s.std(), rel=1e-9)
        assert d[c]["count"] == len(s)


def test_histogram_and_density(videos, pdf):
    h = ST.views_histogram(videos).toPandas()
    x = pdf.view_count.dropna().to_numpy(dtype=float)
    counts, edges = np.histogram(x, bins=30)
    assert h["count"].sum() == len(x) and len(h) == 30
    assert list(h["count"]) == list(counts)
    assert np.allclose(h.bin_start, edges[:-1])
    dens = ST.density_curve(videos, "view_count").toPandas()
    bw = x.std(ddof=1) * len(x) ** -0.2
    grid = np.linspace(x.min(), x.max(), 200)
    exact = np.exp(-0.5 * ((grid[:, None] - x[None, :]) / bw) ** 2).sum(1) / (len(x) * bw * math.sqrt(2 * math.pi))
    assert np.allclose(dens.x, grid)
    assert np.max(np.abs(dens.density - exact)) <= 1e-5 * exact.max()


def test_correlation_matrix(videos, pdf):
    m = {(r.x, r.y): r.r for r in ST.correlation_matrix(videos).collect()}
    ref = pdf[list(ST.METRICS)].astype(float).corr()
    for a in ST.METRICS:
        assert m[(a, a)] == pytest.approx(1.0)
        for b in ST.METRICS:
            assert m[(a, b)] == pytest.approx(m[(b, a)])
            assert m[(a, b)] == pytest.approx(ref.loc[a, b], abs=1e-9)


def test_column_profile(videos, pdf):
    prof = {r.column_name: r for r in ST.column_profile(videos).collect()}
    assert prof["view_count"].non_null_count == pdf.view_count.notna().sum()
    assert prof["tags"].data_type == "array<string>"


def test_keyword_matches_three_valued_or(spark):
    df = spark.createDataFrame([("v1", None, "a guide"), ("v2", "RED RING", None), ("v3", "x", "y")],
                               "video_id string, title string, description string")
    cs = {(r.video_id, r.keyword) for r in K.keyword_matches(df, ["guide", "ring"]).collect()}
    ci = {(r.video_id, r.keyword) for r in K.keyword_matches(df, ["guide", "ring"], case_sensitive=False).collect()}
    assert cs == {("v1", "guide")}
    assert ci == {("v1", "guide"), ("v2", "ring")}


def test_keyword_performance_order(videos, pdf):
    kws = ["ring", "RING", "hot", "guide", "how to"]
    res = K.keyword_performance(videos, kws).collect()
    counts = [r.video_count for r in res]
    assert counts == sorted(counts, reverse=True)
    assert "how to" not in {r.keyword for r in res}
    guide = [r for r in res if r.keyword == "guide"][0]
    mask = pdf.title.fillna("").str.contains("guide", regex=False) | pdf.description.fillna("").str.contains("guide", regex=False)
    assert guide.video_count == mask.sum()


def test_latest_per_key_deterministic(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), ("b", None, "q"), ("b", 0, "p")],
                               "k string, ts int, v string")
    got = {r.k: (r.ts, r.v) for r in latest_per_key(df, "k", "ts").collect()}
    assert got == {"a": (2, "z"), "b": (0, "p")}


@pytest.mark.parametrize("by", [(), ("channel_id",)])
def test_order_blocks_split_a_hot_group_and_follow_the_order(spark, by):
    """One channel with a third of all rows, half of them at one instant: no block is large, and blocks are ranges of the order."""
    rows = [("hot", f"v{i:06d}", 0 if i % 2 else i) for i in range(6000)]
    rows += [(f"c{i % 500}", f"w{i:06d}", i) for i in range(12000)]
    rows += [(None, f"n{i:04d}", None) for i in range(2500)]
    df = spark.createDataFrame(rows, "channel_id string, video_id string, s int").selectExpr(
        "channel_id", "video_id", "timestamp_seconds(s) AS published_at")
    tagged, keys, blocks = W.order_blocks(df, by, ["published_at"], "video_id", rows_per_block=1000)
    got = tagged.toPandas()
    sizes = got.groupby([*by, *keys], dropna=False).size()
    assert sizes.max() <= 1000 and sizes.sum() == len(rows) and sorted(sizes) == sorted(r._n for r in blocks.collect())
    for _, g in got.groupby(list(by), dropna=False) if by else [((), got)]:
        g = g.assign(late=g.published_at.isna(), at=g.published_at.fillna(pd.Timestamp(0)))
        g = g.sort_values(["late", "at", "video_id"])
        seen = [tuple(k) for k in g[keys].itertuples(index=False)]
        assert seen == sorted(seen)
    again, same, _ = W.order_blocks(df.repartition(3), by, ["published_at"], "video_id", rows_per_block=1000)
    assert same == keys and again.select(*keys).distinct().count() == tagged.select(*keys).distinct().count()


def test_salted_channel_join_equals_plain(spark):
    from clipstat.operators.joins import with_channel

    t = adapter.tables(spark, SF_TINY)
    plain = with_channel(t.videos, t.channel).drop("tags")
    salted = with_channel(t.videos, t.channel, salt_buckets=8).drop("tags")
    assert salted.count() == plain.count()
    assert salted.select(*plain.columns).exceptAll(plain).count() == 0


def test_empty_keyword_list(spark, videos):
    assert K.keyword_performance(videos, []).count() == 0


def test_cluster_conf_sizes_shuffle_by_input():
    from clipstat.session import cluster_conf

    conf = cluster_conf(100 * 1024 ** 4, total_cores=8000)
    assert int(conf["spark.sql.shuffle.partitions"]) == 409_600
    assert cluster_conf(1024 ** 4, total_cores=100)["spark.sql.shuffle.partitions"] == "4096"
    assert cluster_conf(10 * 1024 ** 2, total_cores=8)["spark.sql.shuffle.partitions"] == "16"


def _is_sorted(keys):
    return all(a <= b for a, b in zip(keys, keys[1:]))


@pytest.mark.parametrize("fn,key", [
    (R.performance_by_month, lambda r: (r.year_month is not None, r.year_month or "")),
    (R.category_performance, lambda r: (-(r.total_views or -1), r.category_name)),
    (R.count_by_category, lambda r: (-r.video_count, r.category_name)),
    (R.mean_views_by_category, lambda r: (-(r.avg_views or -1), r.category_name)),
    (R.mean_engagement_by_category, lambda r: (-(r.avg_engagement or -1), r.category_name)),
    (R.count_by_day, lambda r: ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday",
                                "Sunday"].index(r.day_of_week)),
    (R.count_by_hour, lambda r: r.hour_of_day),
    (R.videos_per_month, lambda r: r.year_month),
    (W.channel_growth, lambda r: (r.year_month is not None, r.year_month or "")),
    (R.length_performance, lambda r: ["< 1 min", "1-5 mins", "5-10 mins", "10-20 mins",
                                      "> 20 mins"].index(r.duration_category)),
])
def test_result_order(videos, fn, key):
    rows = fn(videos).collect()
    assert len(rows) > 1
    assert _is_sorted([key(r) for r in rows])


def test_comment_orders(spark):
    cm = adapter.comments(spark, SF_TINY)
    dates = [r.date for r in R.comments_per_date(cm).collect()]
    assert _is_sorted(dates)
    top = R.commenter_counts_by_name(cm).collect()
    assert len(top) == 10 and _is_sorted([(-r.comment_count, r.author_name) for r in top])
    t2 = T.top_commenters(cm).collect()
    assert [r["rank"] for r in t2] == list(range(1, 11))
    assert _is_sorted([(-r.comment_count, r.author_name, r.author_channel_id) for r in t2])


def test_per_channel_results_grouped_and_ordered(videos):
    rows = R.performance_by_day(videos, by=["channel_id"]).collect()
    days = ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]
    assert _is_sorted([(r.channel_id, days.index(r.day_of_week)) for r in rows])


def test_stats_on_degenerate_input(spark):
    """Constant columns and one-row groups give nulls, never an ANSI division error."""
    df = spark.createDataFrame(
        [("a", 1.0, 5.0, 2.0), ("a", 2.0, 5.0, 4.0), ("a", 3.0, 5.0, None), ("b", 7.0, 1.0, 1.0)],
        "g string, x double, c double, y double")
    m = {(r.g, r.x, r.y): r.r for r in ST.correlation_matrix(df, ["x", "c", "y"], by=["g"]).collect()}
    assert m[("a", "x", "c")] is None and m[("b", "x", "y")] is None
    assert m[("a", "x", "y")] == pytest.approx(1.0)
    const = df.filter("g = 'a'")
    dens = ST.density_curve(const, "c").collect()
    assert len(dens) == 200 and all(r.density is None for r in dens)
    assert [r["count"] for r in ST.histogram(const, "c", 4).collect()] == [3, 0, 0, 0]
    assert [r["count"] for r in ST.histogram(df, "c", 4).collect()] == [1, 0, 0, 3]


@pytest.mark.parametrize("by", [(), ("channel_id",)])
def test_one_scan_performance_rollups_equal_separate(videos, by):
    one = R.performance_rollups(videos, by=list(by))
    separate = {
        "performance_by_day": R.performance_by_day(videos, by),
        "performance_by_month": R.performance_by_month(videos, by),
        "category_performance": R.category_performance(videos, by),
        "length_performance": R.length_performance(videos, by),
    }
    for name, df in separate.items():
        got, exp = one[name].collect(), df.collect()
        assert [tuple(r) for r in got] == [tuple(r) for r in exp], name


def test_exact_quantiles_per_group_match_pandas(videos, pdf):
    got = ST.describe(videos, ["view_count", "engagement_rate"], by=["category_name"]).toPandas()
    for (cat, col), row in got.set_index(["category_name", "column_name"]).iterrows():
        s = pdf.loc[pdf.category_name == cat, col].dropna().astype(float)
        assert row["count"] == len(s)
        for q, name in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75")):
            assert row[name] == s.quantile(q), (cat, col, name)  # bit-equal to pandas


def test_exact_quantiles_hot_group_and_ties(spark):
    import pandas as pd

    rows = [("hot", float(i % 7)) for i in range(4000)] + [(f"g{i % 50}", float(i)) for i in range(1000)]
    df = spark.createDataFrame(rows, "g string, x double")
    got = {(r.g, r.quantile): r.value for r in ST.exact_quantiles(df, "x", (0.1, 0.5, 0.9), by=["g"]).collect()}
    pdf = pd.DataFrame(rows, columns=["g", "x"])
    for g, grp in pdf.groupby("g"):
        for q in (0.1, 0.5, 0.9):
            assert got[(g, q)] == grp.x.quantile(q)


def test_exact_medians_equal_exact_sketch(videos):
    for by in ((), ("category_name",)):
        a = R.engagement_metrics(videos, by, accuracy=1_000_000).orderBy(*by).collect() if by else \
            R.engagement_metrics(videos, accuracy=1_000_000).collect()
        b = R.engagement_metrics(videos, by).orderBy(*by).collect() if by else R.engagement_metrics(videos).collect()
        assert R.engagement_metrics(videos, by, accuracy=1000).dtypes == R.engagement_metrics(videos, by).dtypes
        for x, y in zip(a, b):
            for name in R.MEDIANS:
                assert x[name] == y[name], (by, name)


def test_density_heavy_tail_matches_exact_kernel_sum(spark):
    rng = np.random.default_rng(7)
    x = np.exp(rng.normal(8.0, 2.0, 20000))  # views-like: a long right tail
    df = spark.createDataFrame([(float(v),) for v in x], "v double")
    got = ST.density_curve(df, "v").toPandas()
    bw = x.std(ddof=1) * len(x) ** -0.2
    grid = np.linspace(x.min(), x.max(), 200)
    exact = np.exp(-0.5 * ((grid[:, None] - x[None, :]) / bw) ** 2).sum(1) / (len(x) * bw * math.sqrt(2 * math.pi))
    assert np.max(np.abs(got.density.to_numpy() - exact)) <= 1e-5 * exact.max()


def test_top_videos_many_equals_single(videos):
    metrics = ["view_count", "like_count", "comment_count", "engagement_rate"]
    many = T.top_videos_many(videos, metrics, 10)
    for m in metrics:
        got = many[m].drop("tags").collect()
        exp = T.top_videos(videos, m, 10).drop("tags").collect()
        assert [tuple(r) for r in got] == [tuple(r) for r in exp], m
        assert many[m].columns == T.top_videos(videos, m, 10).columns


def test_empty_inputs(spark, videos):
    empty = videos.limit(0)
    assert W.running_total(empty).count() == 0
    d = ST.describe(empty).collect()
    assert len(d) == len(ST.METRICS) and all(r["count"] == 0 and r.p50 is None for r in d)
    assert [r["count"] for r in ST.views_histogram(empty).collect()] == [0] * 30
    assert R.performance_by_month(empty).count() == 0
    assert T.top_videos(empty, "view_count").count() == 0


def test_latest_per_key_random_against_pandas(spark):
    import pandas as pd

    rng = np.random.default_rng(11)
    n = 3000
    pdf = pd.DataFrame({
        "k": rng.integers(0, 40, n).astype(str),          # heavy duplication, one hot key below
        "ts": rng.integers(0, 20, n),                     # many ties on the ordering column
        "v": rng.integers(0, 1000, n).astype(str),
    })
    pdf.loc[: n // 3, "k"] = "hot"
    got = latest_per_key(spark.createDataFrame(pdf), "k", "ts").toPandas().sort_values("k").reset_index(drop=True)
    exp = (pdf.sort_values(["ts", "v"], ascending=False).groupby("k", as_index=False).head(1)
           .sort_values("k").reset_index(drop=True))
    assert got[["k", "ts", "v"]].values.tolist() == exp[["k", "ts", "v"]].values.tolist()


@pytest.mark.parametrize("blocks", [1, 3, 7])
def test_running_total_random_against_pandas(spark, blocks):
    import pandas as pd

    rng = np.random.default_rng(blocks)
    n = 2000
    pdf = pd.DataFrame({
        "g": np.where(rng.random(n) < 0.4, "hot", rng.integers(0, 30, n).astype(str)),
        "video_id": [f"v{i:05d}" for i in rng.permutation(n)],
        "published_at": rng.integers(0, 50, n),
        "view_count": rng.integers(0, 100, n).astype("float"),
    })
    pdf.loc[rng.random(n) < 0.1, "view_count"] = np.nan
    sdf = spark.createDataFrame(pdf).withColumn("view_count", F.col("view_count").cast("bigint"))
    got = W.running_total(sdf, by=["g"], rows_per_block=2000 // blocks).toPandas().set_index("video_id")
    ref = pdf.sort_values(["g", "published_at", "video_id"])
    ref["exp"] = ref.groupby("g").view_count.cumsum().where(ref.view_count.notna())
    merged = ref.set_index("video_id").join(got["cumulative_views"])
    assert np.allclose(merged.exp.fillna(-1), merged.cumulative_views.astype(float).fillna(-1))


# ---- null keys, sizes, exchanges ----

def null_groups(spark):
    rows = [("a", f"v{i}", i, i % 4) for i in range(4)] + [(None, f"w{i}", i, 10 * i) for i in range(3)]
    return spark.createDataFrame(rows, "g string, video_id string, published_at int, view_count bigint")


def test_a_null_group_key_is_a_group(spark):
    df = null_groups(spark)
    run = {r.video_id: r.cumulative_views for r in W.running_total(df, by=["g"]).collect()}
    assert len(run) == 7 and run["w2"] == 30
    q = {(r.g, r.quantile): r.value for r in ST.exact_quantiles(df, "view_count", (0.5,), by=["g"]).collect()}
    assert q == {("a", 0.5): 1.5, (None, 0.5): 10.0}
    d = {r.g: r for r in ST.describe(df, ["view_count"], by=["g"]).collect()}
    assert d[None]["count"] == 3 and d[None].p50 == 10.0
    h = ST.histogram(df, "view_count", 5, by=["g"]).where("g is null").collect()
    assert sum(r["count"] for r in h) == 3 and len(h) == 5
    dens = ST.density_curve(df, "view_count", grid=10, by=["g"]).where("g is null").collect()
    assert len(dens) == 10 and all(r.density > 0 for r in dens)
    v = df.selectExpr("g", "cast(published_at as int) * 100 as duration_seconds")
    assert sum(r.video_count for r in R.count_by_bucket(v, by=["g"]).where("g is null").collect()) == 2  # 0 has no bucket


def test_rows_without_a_key_are_not_merged(spark):
    df = spark.createDataFrame([(None, 1), (None, 1), ("a", 1), ("a", 2)], "k string, t int")
    assert sorted(map(tuple, latest_per_key(df, "k", "t").collect()), key=str) == [("a", 2), (None, 1), (None, 1)]


def test_quantiles_and_medians_do_not_change_with_size(spark):
    """More distinct values than a sketch of the former accuracy holds, in many blocks."""
    n = 30_000
    df = spark.range(n).selectExpr("(id * 7919) % 30000 as view_count", "id as like_count", "id as comment_count", "cast(id as double) as engagement_rate")
    got = {r.quantile: r.value for r in ST.exact_quantiles(df, "view_count", (0.001, 0.25, 0.9999)).collect()}
    ref = pd.Series(range(n), dtype=float)
    assert all(got[p] == pytest.approx(ref.quantile(p), rel=1e-14) for p in (0.001, 0.25, 0.9999))
    assert R.engagement_metrics(df).first().median_views == n // 2 - 1


def test_quantiles_of_odd_values(spark):
    """Signs, ties, extremes, tiny and infinite values, nulls and null groups."""
    inf = float("inf")
    vals = [0.0, -0.0, 1e-300, -1e-300, 5e-9, 1e308, -1e308, inf, -inf, 3.0, 3.0, 3.0, 2.9999999999999996, 3.0000000000000004, 1e6, -7.5, None]
    groups = {"a": vals, "b": [4.0], "c": [None], None: [float(i % 7) for i in range(200)] + [1e12]}
    df = spark.createDataFrame([(g, v) for g, vs in groups.items() for v in vs], "g string, v double")
    got = {(r.g, r.quantile): r.value for r in ST.exact_quantiles(df, "v", (0.0, 0.1, 0.5, 0.62, 1.0), ["g"], "lower").collect()}
    for g, vs in groups.items():
        held = sorted(v for v in vs if v is not None)
        for q in (0.0, 0.1, 0.5, 0.62, 1.0):
            want = held[max(1, -(-int(q * 100) * len(held) // 100)) - 1] if held else None
            assert got.get((g, q)) == want, (g, q)


def test_quantiles_neither_sort_ranges_nor_checkpoint(spark, videos):
    p = plan_of(ST.describe(videos))
    assert "rangepartitioning" not in p and "ExistingRDD" not in p


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_small_sorts_come_after_the_aggregation(spark, videos):
    comments = adapter.comments(spark, SF_TINY)
    for df in (R.performance_by_month(videos), R.videos_per_month(videos), R.comments_per_date(comments)):
        plan = plan_of(df)
        sort, single, agg = (plan.index(x) for x in ("Sort [", "SinglePartition", "HashAggregate("))
        assert sort < single < agg and "Coalesce 1" not in plan


def test_a_hot_group_is_dealt_out_before_it_is_binned(spark, videos):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(ST.views_histogram(videos, by=["channel_id"]))
        join = plan.index("_part")
        assert "hashpartitioning(" in plan[:join] and "bin#" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_sums_of_extreme_counts_are_null_not_an_error(spark, videos):
    big = videos.withColumn("view_count", F.lit(9223372036854775807))
    assert R.engagement_metrics(big).first().total_views is None
    assert R.monthly_totals(big).count() > 0 and W.channel_growth(big).count() > 0


@pytest.mark.parametrize("case_sensitive", [True, False])
def test_thousands_of_keywords_by_index(spark, case_sensitive, monkeypatch):
    """The same rows as by one expression; the plan doesn't grow with the list."""
    rows = [(f"v{i}", f"Title {i} of Item{i % 37}", None if i % 5 == 0 else f"words {i * i} é\U0001f600 x{i % 11}y") for i in range(300)] + [("n", None, None), ("e", "", "")]
    df = spark.createDataFrame(rows, "video_id string, title string, description string")
    words = ["", "1", "é", "7y", "\U0001f600", "ITEM3", "item3", "Item3", "no such", "Item3", "title", " of ", "x1"] + [str(k) for k in range(200, 280)]
    fold = (lambda x: x) if case_sensitive else str.lower
    want = sorted((v, k, i + 1) for v, *texts in rows for i, k in enumerate(words) if any(t is not None and fold(k) in fold(t) for t in texts))

    def got(keywords):
        return sorted(map(tuple, K.keyword_matches(df, keywords, case_sensitive).select("video_id", "keyword", "keyword_order").collect()))

    assert got(words) == want
    assert sorted(map(tuple, K.keyword_matches_by_index(df, words[:9], case_sensitive).select("video_id", "keyword", "keyword_order").collect())) == got(words[:9])
    assert K.keyword_matches_by_index(df, [], case_sensitive).count() == 0
    many = [f"Item{k}" for k in range(10_000)]
    plan = plan_of(K.keyword_matches(df, many, case_sensitive))
    assert len(plan) < 20_000 and "BroadcastHashJoin" in plan
    assert K.keyword_matches(df, many, case_sensitive).filter("title = 'Title 5 of Item5'").count() == 1


def test_density_and_histogram_read_a_derived_value_once(spark):
    """Nulls go without a filter on the value, which would work it out a second time at the scan."""
    df = spark.createDataFrame([(i, None if i % 5 == 0 else f"PT{i % 50}M", "a" if i % 3 else None) for i in range(600)],
                               "id long, duration string, g string")
    x = C.minutes(C.duration_seconds("duration"))
    value = F.when(F.col("duration").isNotNull(), x)
    kept = np.array([i % 50 for i in range(600) if i % 5], dtype=float)
    plan = ST.histogram(df, value, 5)._jdf.queryExecution().optimizedPlan().toString()
    assert "Filter (isnotnull(" not in plan
    assert [r["count"] for r in ST.histogram(df, value, 5).collect()] == np.histogram(kept, 5)[0].tolist()
    scans = ST.density_curve(df, value, grid=20)._jdf.queryExecution().optimizedPlan().toString()
    assert "substring_index" not in scans  # its plan starts from the counted values
    h = kept.std(ddof=1) * len(kept) ** -0.2
    for r in ST.density_curve(df, value, grid=20).collect():
        want = np.exp(-0.5 * ((r["x"] - kept) / h) ** 2).sum() / (len(kept) * h * np.sqrt(2 * np.pi))
        assert r["density"] == pytest.approx(want, rel=1e-5)
    for g in ("a", None):
        own = np.array([i % 50 for i in range(600) if i % 5 and (("a" if i % 3 else None) == g)], dtype=float)
        h = own.std(ddof=1) * len(own) ** -0.2
        curve = [r for r in ST.density_curve(df, value, grid=20, by=["g"]).collect() if r["g"] == g]
        assert len(curve) == 20
        for r in curve:
            assert r["density"] == pytest.approx(np.exp(-0.5 * ((r["x"] - own) / h) ** 2).sum() / (len(own) * h * np.sqrt(2 * np.pi)), rel=1e-5)
