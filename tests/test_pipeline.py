"""B1 transform, B2 analysis, B3 marts and streaming ingest on a landing folder."""

import shutil
import os
import tempfile
import time

import pytest

from clipstat.plans.analysis import full_analysis
from clipstat.plans.marts import chart_tables, read_mart, write_marts
from clipstat.plans.transform import read_denormalized, read_tables, transform_and_save
from clipstat.sources.sinks import commit_version, current_version, new_version
from clipstat.streaming.landing import start_comment_ingest
from tests.conftest import write_api_file
from tests.test_sources import landing  # noqa: F401  (fixture)


def test_transform_analysis_marts(spark, landing):  # noqa: F811
    out = tempfile.mkdtemp(prefix="clipstat-out-")
    report = {r.table_name: r.row_count for r in transform_and_save(spark, landing, out, as_of="2024-01-11").collect()}
    assert report == {"channel": 2, "videos": 3, "comments": 2}
    ch, v, cm = read_tables(spark, out)
    den = read_denormalized(spark, out)
    counts = {r.video_id: r.actual_comment_count for r in den.collect()}
    assert counts == {"v_1": 2, "v_2": 0, "v_3": 0}
    csv = spark.read.option("header", True).csv(f"{current_version(spark, out)}/denormalized_csv")
    assert csv.count() == 3

    res = full_analysis(ch, v, cm)
    assert len(res) == 13
    assert [r.video_id for r in res["top_videos_by_views"].collect()] == ["v_2", "v_1", "v_3"]
    assert res["keyword_performance"].first().keyword == "guide"
    growth = res["channel_growth"].collect()
    assert growth[-1].total_views == sum(r.view_count for r in v.collect())
    paths = write_marts(chart_tables(ch, v, cm), out)
    assert len(paths) >= 18
    assert spark.read.parquet(paths[0]).count() >= 1


def test_streaming_comment_ingest(spark, landing):  # noqa: F811
    src = tempfile.mkdtemp(prefix="clipstat-stream-src-")
    for name in ("comments_v_1_20240101_000000.json", "comments_v_1_20240105_000000.json", "comments_bad.json"):
        shutil.copy(f"{landing}/{name}", src)
    table = tempfile.mkdtemp(prefix="clipstat-stream-out-") + "/snapshots"
    q = start_comment_ingest(spark, src, table, name="t_ingest")
    q.awaitTermination(120)
    assert spark.read.parquet(table).count() == 3
    # a newly landed file is picked up by the next run, nothing is read twice
    write_api_file(src, "comments_v_9_20240201_000000.json", {"items": [
        {"id": "c9", "snippet": {"topLevelComment": {"snippet": {"authorDisplayName": "z", "likeCount": 1}}}}]})
    q = start_comment_ingest(spark, src, table, name="t_ingest")
    q.awaitTermination(120)
    assert spark.read.parquet(table).count() == 4


def test_full_analysis_per_channel(spark):
    from clipstat.sources import adapter
    from tests.conftest import SF_TINY

    t = adapter.tables(spark, SF_TINY)
    res = full_analysis(t.channel, t.videos, t.comments, by=["channel_id"], persist=False)
    top = res["top_commenters"].toPandas()
    assert top.groupby("channel_id")["rank"].max().max() <= 10
    per = res["performance_by_month"].toPandas()
    assert per.video_count.sum() == t.videos.count()
    kw = res["keyword_performance"].toPandas()
    assert set(kw.columns) >= {"channel_id", "keyword", "video_count"}


def test_date_filter_prunes_month_partitions(spark):
    from clipstat.operators.filters import filter_recent
    from clipstat.plans.transform import prepare_from_tables
    from clipstat.sources import adapter
    from tests.conftest import SF_TINY

    out = tempfile.mkdtemp(prefix="clipstat-prune-")
    t = adapter.tables(spark, SF_TINY)
    prepare_from_tables(t.channel, t.videos, t.comments, out)
    _, v, _ = read_tables(spark, out)
    recent = filter_recent(v, 365, as_of="1998-08-02", partition_col="year_month")
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year_month" in plan and "year_month#" in plan
    exp = t.videos.filter("publish_date >= date'1997-08-02' and publish_date <= date'1998-08-02'").count()
    assert recent.count() == exp > 0


def test_job_entry_points(spark, landing, capsys):  # noqa: F811
    from clipstat.__main__ import main

    out = tempfile.mkdtemp(prefix="clipstat-job-")
    assert main(["transform", landing, out, "--as-of", "2024-01-11"]) == 0
    assert '"table_name": "videos", "row_count": 3' in capsys.readouterr().out
    assert main(["analyze", out, "--by", "channel_id"]) == 0
    printed = capsys.readouterr().out
    assert "chart_engagement_cards" in printed
    cards = read_mart(spark, out, "chart_engagement_cards")
    assert cards.select("channel_id").distinct().count() == 2


def test_streaming_ingest_archives_processed_files(spark, landing):  # noqa: F811
    import os

    src = tempfile.mkdtemp(prefix="clipstat-stream-arch-src-")
    archive = tempfile.mkdtemp(prefix="clipstat-stream-arch-")
    shutil.copy(f"{landing}/comments_v_1_20240101_000000.json", src)
    table = tempfile.mkdtemp(prefix="clipstat-stream-arch-out-") + "/snapshots"
    q = start_comment_ingest(spark, src, table, name="t_ingest_archive", archive_dir=archive)
    q.awaitTermination(120)
    assert spark.read.parquet(table).count() == 2
    # a later run moves the files of the completed batch away
    write_api_file(src, "comments_v_8_20240301_000000.json", {"items": []})
    q = start_comment_ingest(spark, src, table, name="t_ingest_archive", archive_dir=archive)
    q.awaitTermination(120)
    archived = [f for _, _, fs in os.walk(archive) for f in fs if f.endswith(".json")]
    assert "comments_v_1_20240101_000000.json" in archived


def test_analysis_date_range(spark):
    from clipstat.plans.transform import prepare_from_tables
    from clipstat.sources import adapter
    from tests.conftest import SF_TINY

    out = tempfile.mkdtemp(prefix="clipstat-range-")
    t = adapter.tables(spark, SF_TINY)
    prepare_from_tables(t.channel, t.videos, t.comments, out)
    ch, v, cm = read_tables(spark, out)
    res = full_analysis(ch, v, cm, recent_days=365, as_of="1998-08-02", persist=False)
    months = [r.year_month for r in res["performance_by_month"].collect()]
    assert months and min(months) >= "1997-08" and max(months) <= "1998-08"
    exp = t.videos.filter("publish_date between date'1997-08-02' and date'1998-08-02'").count()
    assert sum(r.video_count for r in res["performance_by_month"].collect()) == exp


def test_marts_release_cached_intermediates(spark):
    from clipstat.plans.transform import prepare_from_tables
    from clipstat.sources import adapter
    from tests.conftest import SF_TINY

    out = tempfile.mkdtemp(prefix="clipstat-release-")
    t = adapter.tables(spark, SF_TINY)
    prepare_from_tables(t.channel, t.videos, t.comments, out)
    ch, v, cm = read_tables(spark, out)
    tables = chart_tables(ch, v, cm)
    held = list(tables.cached)
    assert len(held) == 2 and all(df.storageLevel.useMemory or df.storageLevel.useDisk for df in held)
    write_marts(tables, out)
    assert tables.cached == []
    assert all(not (df.storageLevel.useMemory or df.storageLevel.useDisk) for df in held)


def test_stream_keeps_a_checkpoint_for_each_landing_and_table(spark, landing):
    from clipstat.streaming.landing import stream_checkpoint

    out = [tempfile.mkdtemp(prefix="clipstat-stream-") + "/t" for _ in range(2)]
    for table in (*out, out[0]):  # the first one again: nothing new
        start_comment_ingest(spark, landing, table).awaitTermination()
    first, second = (sorted(map(tuple, spark.read.parquet(t).select("comment_id", "video_id", "like_count").collect()), key=str) for t in out)
    assert first and first == second
    assert stream_checkpoint(spark, landing, out[0]) != stream_checkpoint(spark, landing, out[1])


def test_date_range_acts_alike_with_and_without_groups(spark):
    from clipstat.sources import adapter
    from tests.conftest import SF_TINY

    t = adapter.tables(spark, SF_TINY)
    counts = {}
    for by in ((), ("channel_id",)):
        res = full_analysis(t.channel, t.videos, t.comments, by=by, recent_days=30, as_of=adapter.AS_OF, top_n=100_000)
        counts[by] = sum(r.comment_count for r in res["top_commenters"].collect())
        res.release()
    assert counts[()] == counts[("channel_id",)] < t.comments.count()
    charts = chart_tables(t.channel, t.videos, t.comments, by=["channel_id"], as_of=adapter.AS_OF)
    for name, df in charts.items():
        if name.startswith(("chart_", "note_")):
            assert "channel_id" in df.columns, name
    charts.release()


def landed_run(tmp, likes):
    from tests.test_sources import channel_item, comment_item, video_item

    write_api_file(tmp, "channel_UCa_20240101_000000.json", {"items": [channel_item("UCa", "a", likes, "UUa")]})
    write_api_file(tmp, "videos_details_20240101_000000.json", {"items": [video_item("v1", "UCa", 10, likes)]})
    write_api_file(tmp, "comments_v1_20240101_000000.json", {"items": [comment_item("c1", "ann", likes)]})
    return str(tmp)


def state(spark, out):
    channel, videos, comments = read_tables(spark, out)
    return (channel.first().subscriber_count, videos.first().like_count, comments.first().like_count, read_denormalized(spark, out).first().like_count)


@pytest.mark.parametrize("step", ["channel", "videos", "comments", "denormalized", "denormalized_csv", "commit"])
def test_a_run_that_fails_leaves_the_old_tables(spark, tmp_path, monkeypatch, step):
    from clipstat.plans import transform as TR

    out = str(tmp_path / "out")
    transform_and_save(spark, landed_run(tmp_path / "one", 1), out)
    assert state(spark, out) == (1, 1, 1, 1)

    def failing(write):
        def run(df, path, *rest):
            write(df, path, *rest)
            if path.endswith(f"/{step}"):
                raise RuntimeError("the cluster is gone")
        return run

    with monkeypatch.context() as m:
        m.setattr(TR, "write_parquet", failing(TR.write_parquet))
        m.setattr(TR, "write_csv", failing(TR.write_csv))
        if step == "commit":
            m.setattr(TR, "commit_version", lambda *a: 1 / 0)
        with pytest.raises((RuntimeError, ZeroDivisionError)):
            transform_and_save(spark, landed_run(tmp_path / "two", 2), out)
    assert state(spark, out) == (1, 1, 1, 1)
    transform_and_save(spark, str(tmp_path / "two"), out)
    assert state(spark, out) == (2, 2, 2, 2)


def test_versions_before_the_last_two_are_deleted(spark, tmp_path):
    root = str(tmp_path)
    assert current_version(spark, root) == root
    made = []
    for i in range(4):
        v = new_version(root)
        spark.range(i + 1).write.parquet(f"{v}/t")
        commit_version(spark, root, v)
        made.append(v)
        assert current_version(spark, root) == v and spark.read.parquet(f"{current_version(spark, root)}/t").count() == i + 1
    assert [os.path.exists(v) for v in made] == [False, False, True, True]


def test_transform_counts_files_in_the_pass_that_reads_them(spark, tmp_path):
    root = landed_run(tmp_path / "in", 3)
    write_api_file(root, "comments_v2_20240101_000000.json", {"items": []})
    write_api_file(root, "comments_20240101.json", {"items": [{"id": "x"}]})
    with open(f"{root}/comments_v3_20240101_000000.json", "w") as f:
        f.write('{"items": [')
    skipped = {}
    transform_and_save(spark, root, str(tmp_path / "out"), skip_damaged=True, skipped=skipped)
    none = {"damaged": 0, "no items": 0, "empty": 0, "name": 0}
    assert skipped == {"channel": none | {"files": 1}, "videos": none | {"files": 1},
                       "comments": {"files": 4, "damaged": 1, "no items": 0, "empty": 1, "name": 1}}


def shuffles_on_disk(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = [files.apply(i).getName() for i in range(files.size())]
    return {int(x.split("_")[1]) for x in names if x.startswith("shuffle_")}


def shuffles_left(spark, run):
    """(shuffles whose files ``run`` left on disk, shuffles it made); Spark takes a moment to delete them."""
    sc = spark.sparkContext._jsc.sc()
    first = sc.newShuffleId()
    run()
    made = set(range(first + 1, sc.newShuffleId()))
    until = time.time() + 10
    while made & shuffles_on_disk(spark) and time.time() < until:
        time.sleep(0.2)
    return len(made & shuffles_on_disk(spark)), len(made)


def many(root):
    """Videos and comments of two snapshots each, some without an id, a channel or a time; comments of no video."""
    from tests.test_sources import channel_item, comment_item, video_item

    for k, day in enumerate(("20240101", "20240102")):
        write_api_file(root, f"channel_UC_{day}_000000.json", {"items": [channel_item(f"UC{c}", f"t{c}", k, f"UU{c}") for c in range(3)]})
        videos = [video_item(f"v{i}", f"UC{i % 4}", 10 * i + k, i, published=f"2024-0{1 + i % 5}-01T10:00:00Z") for i in range(30)]
        videos[5]["snippet"]["publishedAt"] = None
        write_api_file(root, f"videos_details_{day}_000000.json", {"items": [*videos, {**videos[1], "id": None}, {**videos[2], "id": None}]})
        for v in range(0, 36, 3):
            items = [comment_item(f"c{v}_{i}", "ann", i + k, f"2024-0{1 + i}-02T00:00:00Z") for i in range(v % 5 + 1)]
            write_api_file(root, f"comments_v{v}_{day}_000000.json", {"items": [*items, {**items[0], "id": None}]})
    return str(root)


def test_tables_written_in_rounds_hold_the_same_rows(spark, tmp_path, monkeypatch):
    """Shuffle files of a round go with it, parsed snapshots with the last one, and all files are compressed."""
    from clipstat.sources import rounds

    root, got = many(tmp_path / "in"), []
    for most in (rounds.ROUND_ROWS, 30):
        monkeypatch.setattr(rounds, "ROUND_ROWS", most)
        out, report = str(tmp_path / f"out{most}"), []
        left, made = shuffles_left(spark, lambda: report.append(transform_and_save(spark, root, out, as_of="2024-06-01")))  # noqa: B023
        assert 4 * left <= made and made > 4  # a stage may outlive a query that no longer needs it
        base = current_version(spark, out)
        assert sorted(os.listdir(base)) == ["channel", "comments", "denormalized", "denormalized_csv", "videos"]
        written = [f for _, _, names in os.walk(base) for f in names if f.startswith("part-")]
        assert {".".join(f.split(".")[-2:]) for f in written} == {"zstd.parquet", "csv.gz"}
        tables = (*read_tables(spark, out), read_denormalized(spark, out), spark.read.option("header", True).csv(f"{base}/denormalized_csv"))
        got.append([*report, *tables])
    assert rounds.n_rounds(34) == 2 and rounds.n_rounds(1 << 40) == rounds.MAX_ROUNDS
    one, more = ([sorted(str(sorted(r.asDict().items(), key=str)) for r in t.collect()) for t in x] for x in got)
    assert one == more
    assert [len(x) for x in one] == [3, 3, 34, 59, 34, 34]
    assert {r.table_name: r.row_count for r in got[1][0].collect()} == {"channel": 3, "videos": 34, "comments": 59}
