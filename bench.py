"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

1. B1 (timed once): the test tables go through the adapter and are written as
   the processed Parquet tables (channel, videos by month, comments by month,
   denormalized) into a fresh scratch folder.
2. Each headline query runs over those tables (the production layout), warm,
   median of 3; results go to Spark's no-op sink, so the timing is the job, not
   the transfer to the driver.  A control query runs before every run, and
   ``vs_control`` is the ratio to it, which does not move with the machine.
3. The whole analysis (B2, 13 results collected) is timed as one unit, and a
   few queries also run end to end from the raw test tables (adapter
   included), as the correctness gate runs them; neither is in the total.

Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from pyspark.sql import DataFrame  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from clipstat.functions import columns as C  # noqa: E402
from clipstat.functions.dims import DEFAULT_KEYWORDS  # noqa: E402
from clipstat.operators import keywords as K  # noqa: E402
from clipstat.operators import rollups as R  # noqa: E402
from clipstat.operators import stats as ST  # noqa: E402
from clipstat.operators import topk as T  # noqa: E402
from clipstat.operators import windows as W  # noqa: E402
from clipstat.operators.joins import denormalize  # noqa: E402
from clipstat.plans import registry  # noqa: E402
from clipstat.plans.analysis import full_analysis  # noqa: E402
from clipstat.plans.transform import prepare_from_tables, read_tables  # noqa: E402
from clipstat.session import local_session  # noqa: E402
from clipstat.sources import adapter  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEAT = int(os.environ.get("BENCH_REPEAT", "3"))


def headline(ch, v, cm):
    kws = ["ring", "RING", "hot", "guide", "1-URGENT", "how to"]
    return {
        "channel_summary": lambda: R.channel_summary(ch),
        "top_videos_by_views": lambda: T.top_videos(v, "view_count"),
        "top_videos_by_engagement": lambda: T.top_videos(v, "engagement_rate"),
        "top_videos_per_channel": lambda: T.top_videos(v, "view_count", 3, by=["channel_id"]),
        "performance_by_day": lambda: R.performance_by_day(v),
        "performance_by_month": lambda: R.performance_by_month(v),
        "performance_by_month_per_channel": lambda: R.performance_by_month(v, by=["channel_id"]),
        "category_performance": lambda: R.category_performance(v),
        "length_performance": lambda: R.length_performance(v),
        "channel_growth": lambda: W.channel_growth(v),
        "engagement_metrics": lambda: R.engagement_metrics(v),
        "top_commenters": lambda: T.top_commenters(cm),
        "keyword_performance": lambda: K.keyword_performance(v, kws),
        "keyword_performance_default": lambda: K.keyword_performance(v, DEFAULT_KEYWORDS),
        "running_views": lambda: W.running_total(v),
        "running_views_per_channel": lambda: W.running_total(v, by=["channel_id"]),
        "describe": lambda: ST.describe(v),
        "describe_per_category": lambda: ST.describe(v, by=["category_name"]),
        "engagement_metrics_sketch": lambda: R.engagement_metrics(v, accuracy=1_000_000),
        "views_histogram": lambda: ST.views_histogram(v),
        "duration_density": lambda: ST.density_curve(v, C.minutes("duration_seconds")),
        "correlation_matrix": lambda: ST.correlation_matrix(v),
        "count_by_bucket": lambda: R.count_by_bucket(v),
        "comments_per_date": lambda: R.comments_per_date(cm),
        "denormalize": lambda: denormalize(v, ch, cm),
    }


def run(make) -> float:
    t = time.perf_counter()
    make().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t


def main():
    spark = local_session(CPUS, shuffle_partitions=int(CPUS) * 2, app="clipstat-bench")
    scratch = tempfile.mkdtemp(prefix="clipstat-bench-")

    t = time.perf_counter()
    v0 = adapter.videos(spark, SF_DIR)
    prepare_from_tables(adapter.channels(spark, SF_DIR, v0), v0, adapter.comments(spark, SF_DIR), scratch)
    prep = time.perf_counter() - t

    ch, v, cm = read_tables(spark, scratch)

    def control() -> DataFrame:
        # a plain aggregation that no change of the library touches: it tells how fast the machine is just then
        return cm.groupBy("like_count").agg(F.count("comment_id").alias("n"), F.max("text").alias("t"))

    times, controls = {}, {}
    run(control)
    for name, make in headline(ch, v, cm).items():
        run(make)  # warm-up
        pairs = [(run(control), run(make)) for _ in range(REPEAT)]
        controls[name] = statistics.median(c for c, _ in pairs)
        times[name] = statistics.median(t for _, t in pairs)

    def b2():
        # the reference's whole analysis run: 13 named results, each collected
        t = time.perf_counter()
        res = full_analysis(ch, v, cm)
        for df in res.values():
            df.collect()
        res.release()  # the small cached intermediates
        return time.perf_counter() - t

    b2()
    e2e = {"B2_full_analysis_13_results": statistics.median(b2() for _ in range(REPEAT))}
    for name in ("A3_performance_by_month", "A9_keyword_performance", "W2_running_views", "T2_top_commenters"):
        fn = registry.QUERIES[name]
        run(lambda: fn(spark, SF_DIR))
        e2e[f"e2e_{name}"] = statistics.median(run(lambda: fn(spark, SF_DIR)) for _ in range(REPEAT))

    queries = {k: round(x, 4) for k, x in {**times, **e2e}.items()}
    queries["B1_prepare_tables"] = round(prep, 4)
    sf = os.path.basename(SF_DIR.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "headline_queries_total_median_sec",
        "value": round(sum(times.values()), 4),
        "unit": "sec",
        "queries": queries,
        "control_sec": round(statistics.median(controls.values()), 4),
        "vs_control": {k: round(t / controls[k], 2) for k, t in times.items()},
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": int(CPUS),
        "repeat": REPEAT,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
