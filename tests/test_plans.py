"""Physical plan properties of the registered queries."""

import pytest

import __spark_entry__ as E
from clipstat.operators import windows as W
from clipstat.plans import registry
from clipstat.sources import adapter
from tests.conftest import SF_TINY

PY_NODES = ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "FlatMapGroupsInPandas", "MapInPandas")
PAIR_NODES = ("CartesianProduct", "BroadcastNestedLoopJoin")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark):
    return {name: plan(fn(spark, SF_TINY)) for name, fn in registry.QUERIES.items()}


def test_no_python_and_no_pair_joins(plans):
    for name, p in plans.items():
        assert not any(n in p for n in PY_NODES), name
        assert not any(n in p for n in PAIR_NODES), name


def test_top_k_is_take_ordered(plans):
    for name in ("T1_top_videos_by_views", "T2_top_commenters", "T4_top_videos_display"):
        assert "TakeOrderedAndProject" in plans[name], name


def test_running_total_not_single_partition_on_fact(spark, tmp_path):
    # one plan: few blocks, as registered, or many with more keys
    adapter.videos(spark, SF_TINY).select("video_id", "published_at", "view_count").write.parquet(str(tmp_path / "v"))
    for rows_per_block in (W.ROWS_PER_BLOCK, 3):
        p = plan(W.running_total(spark.read.parquet(str(tmp_path / "v")), rows_per_block=rows_per_block))
        assert "hashpartitioning(_k0" in p
        # the only single-partition exchange is over the per-block totals
        assert p.count("SinglePartition") <= 1
        assert not any(n in p for n in PAIR_NODES)


def test_per_group_top_k_limits_before_shuffle(plans):
    assert "WindowGroupLimit" in plans["T1_top_videos_by_views_per_channel"]


def test_scan_pruning(spark):
    df = E.queries()["A3_performance_by_month"](spark, SF_TINY)
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in p


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["year_month", "video_count", "avg_views", "avg_likes", "avg_comments", "avg_engagement"]
