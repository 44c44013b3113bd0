"""Raw JSON sources on pretty-printed fixtures (FIXTURES.md §1 cases)."""

import json
import shutil
import os
import tempfile

import pytest

from clipstat.sources import raw_json as RJ
from tests.conftest import write_api_file


def channel_item(cid, title, subs, uploads):
    return {
        "id": cid,
        "snippet": {"title": title, "description": "d", "customUrl": "@" + title, "publishedAt": "2020-01-02T03:04:05Z",
                    "country": "US"},
        "statistics": {"viewCount": "1000", "subscriberCount": str(subs), "videoCount": "2"},
        "contentDetails": {"relatedPlaylists": {"uploads": uploads}},
    }


def video_item(vid, cid, views, likes=None, duration="PT1M5S", published="2024-01-01T10:00:00Z"):
    stats = {"viewCount": str(views), "favoriteCount": "0", "commentCount": "1"}
    if likes is not None:
        stats["likeCount"] = str(likes)
    return {"id": vid, "snippet": {"channelId": cid, "title": "t " + vid, "description": "a guide",
                                   "publishedAt": published, "channelTitle": "ch", "categoryId": "10"},
            "contentDetails": {"duration": duration}, "statistics": stats}


def comment_item(cid, author, likes, updated="2024-01-02T00:00:00Z"):
    return {"id": cid, "snippet": {"topLevelComment": {"snippet": {
        "authorDisplayName": author, "authorChannelId": {"value": "UC" + author}, "textDisplay": "hi",
        "publishedAt": "2024-01-02T00:00:00Z", "updatedAt": updated, "likeCount": likes}}}}


@pytest.fixture(scope="module")
def landing():
    d = tempfile.mkdtemp(prefix="clipstat-landing-")
    write_api_file(d, "channel_UC_a-1_20240101_000000.json", {"items": [channel_item("UC_a-1", "old", 5, "UU_a-1")]})
    write_api_file(d, "channel_UC_a-1_20240102_000000.json", {"items": [channel_item("UC_a-1", "new", 7, "UU_a-1")]})
    write_api_file(d, "channel_UCb_20240101_000000.json", {"items": [channel_item("UCb", "bee", 1, "UUb")]})
    # videos: two snapshots; no tags anywhere; like count missing; fractional time
    write_api_file(d, "videos_details_20240101_000000.json", {"items": [
        video_item("v_1", "UC_a-1", 10, 1), video_item("v_2", "UC_a-1", 20)]})
    write_api_file(d, "videos_details_20240103_000000.json", {"items": [
        video_item("v_1", "UC_a-1", 15, 2, "P0D"), video_item("v_3", "UCb", 0, 3, None, "2024-01-01T10:00:00.5Z")]})
    # comments: id with "_" in the video id, re-fetched comment, empty items, no items, bad name
    write_api_file(d, "comments_v_1_20240101_000000.json", {"items": [comment_item("c1", "ann", 1),
                                                                      comment_item("c2", "bob", 0)]})
    write_api_file(d, "comments_v_1_20240105_000000.json", {"items": [comment_item("c1", "ann", 9)]})
    write_api_file(d, "comments_v_2_20240101_000000.json", {"items": []})
    write_api_file(d, "comments_v_3_20240101_000000.json", {"kind": "none"})
    write_api_file(d, "comments_bad.json", {"items": [comment_item("zz", "eve", 1)]})
    write_api_file(d, "playlist_UU_a-1_20240101_000000.json", {"items": [
        {"contentDetails": {"videoId": "v_1"}}, {"contentDetails": {"videoId": "v_2"}}]})
    return d


def test_channels_latest_snapshot_per_channel(spark, landing):
    rows = {r.channel_id: r for r in RJ.load_channels(spark, landing).collect()}
    assert set(rows) == {"UC_a-1", "UCb"}
    assert rows["UC_a-1"].channel_title == "new" and rows["UC_a-1"].subscriber_count == 7
    assert rows["UC_a-1"].video_count == 2 and rows["UC_a-1"].published_at is not None


def test_videos_latest_and_derived(spark, landing):
    v = {r.video_id: r for r in RJ.load_videos(spark, landing, as_of="2024-01-11").collect()}
    assert set(v) == {"v_1", "v_2", "v_3"}
    assert v["v_1"].view_count == 15 and v["v_1"].duration_seconds == 0
    assert v["v_2"].like_count is None and v["v_2"].duration_seconds == 65
    assert v["v_2"].engagement_rate == pytest.approx(5.0)
    assert v["v_3"].published_at is None and v["v_3"].engagement_rate == 400.0
    assert v["v_1"].tags is None and v["v_1"].category_name == "Music"
    assert v["v_2"].days_since_published == 10


def test_comments_all_files_latest_wins(spark, landing):
    snaps = RJ.load_comment_snapshots(spark, landing)
    assert snaps.count() == 3  # bad name, empty and item-less files contribute nothing
    c = {r.comment_id: r for r in RJ.load_comments(spark, landing).collect()}
    assert set(c) == {"c1", "c2"}
    assert c["c1"].like_count == 9 and c["c1"].video_id == "v_1"


def test_playlists(spark, landing):
    got = sorted(tuple(r) for r in RJ.load_playlist_items(spark, landing).collect())
    assert got == [("UU_a-1", "v_1"), ("UU_a-1", "v_2")]


def test_missing_files(spark):
    empty = tempfile.mkdtemp(prefix="clipstat-empty-")
    with pytest.raises(FileNotFoundError):
        RJ.load_channels(spark, empty)
    with pytest.raises(FileNotFoundError):
        RJ.load_videos(spark, empty)
    with pytest.warns(UserWarning):
        c = RJ.load_comments(spark, empty)
    assert c.count() == 0 and [f.name for f in c.schema.fields][:2] == ["comment_id", "video_id"]


def test_landing_writer_round_trip_comments_and_playlists(spark):
    from pyspark.sql import functions as F

    from clipstat.operators.dedup import latest_per_key
    from clipstat.sources import adapter
    from clipstat.sources import api_files as AF
    from tests.conftest import SF_TINY

    root = tempfile.mkdtemp(prefix="clipstat-land-")
    raw = adapter.comments_raw(spark, SF_TINY).filter(F.col("video_id").isin([f"v_{i}" for i in range(1, 40)]))
    AF.land_comments(raw, root, "2025-01-01 00:00:00", page_size=2)
    got = RJ.load_comments(spark, root)
    exp = latest_per_key(raw, "comment_id", "updated_at")
    assert got.count() == exp.count() > 0
    assert got.exceptAll(exp.select(*got.columns)).count() == 0
    items = raw.select(F.concat(F.lit("UU"), F.col("author_channel_id")).alias("playlist_id"), "video_id").distinct()
    AF.land_playlists(items, root, "2025-01-01 00:00:00", page_size=3)
    back = RJ.load_playlist_items(spark, root)
    assert back.count() == items.count() and back.exceptAll(items).count() == 0


@pytest.fixture
def damaged(landing):
    """Two good comments, a file cut short, one without items, one whose name has no id."""
    d = tempfile.mkdtemp(prefix="clipstat-damaged-")
    shutil.copy(f"{landing}/comments_v_1_20240101_000000.json", d)
    for name, text in (("comments_v_7_20240101_000000.json", '{"items": [{"id": "c7"'), ("comments_v_8_20240101_000000.json", "{}"),
                       ("comments_20240101.json", '{"items": [{"id": "c9"}]}')):
        with open(f"{d}/{name}", "w") as f:
            f.write(text)
    return d


def test_a_damaged_file_fails_the_read_unless_skipped(spark, damaged):
    with pytest.raises(Exception, match="damaged file"):
        RJ.load_comments(spark, damaged).collect()
    got = RJ.load_comments(spark, damaged, skip_damaged=True).collect()
    assert sorted(r.comment_id for r in got) == ["c1", "c2"]


def test_skipped_files_are_counted_by_reason(spark, damaged):
    got = {(r.kind, r.reason): r.files for r in RJ.skipped_files(spark, damaged).collect()}
    assert got == {("comments", "damaged"): 1, ("comments", "no items"): 1, ("comments", "name"): 1}


def test_comments_without_id_and_counts_as_text(spark):
    d = tempfile.mkdtemp(prefix="clipstat-null-")
    item = {"snippet": {"topLevelComment": {"snippet": {"textDisplay": "x", "likeCount": "7"}}}}
    write_api_file(d, "comments_v_1_20240101_000000.json", {"items": [item, item, {**item, "id": "c1"}]})
    got = RJ.load_comments(spark, d).collect()
    assert len(got) == 3 and all(r.like_count == 7 for r in got)


def test_processed_tables_that_cannot_be_read_are_an_error(spark):
    from pyspark.errors import AnalysisException

    d = tempfile.mkdtemp(prefix="clipstat-proc-")
    for t in ("channel", "videos"):
        spark.range(1).write.parquet(f"{d}/{t}")
    assert RJ.load_processed(spark, d)[2].count() == 0
    os.makedirs(f"{d}/comments")
    with open(f"{d}/comments/part-0.parquet", "w") as f:
        f.write("not parquet")
    with pytest.raises(Exception) as e:
        RJ.load_processed(spark, d)[2].collect()
    assert not isinstance(e.value, AnalysisException) or "PATH_NOT_FOUND" not in str(e.value)


@pytest.fixture
def mixed(tmp_path):
    """Flat files, folders of the file's name, folders as Spark writes them and subfolders, all in one landing."""
    one = lambda c: {"items": [comment_item(c, "ann", 1)]}
    write_api_file(tmp_path, "comments_a_20240101_000000.json", one("c1"))
    write_api_file(tmp_path / "comments_b_20240101_000000.json", "part-0.json", one("c2"))
    write_api_file(tmp_path / "file=comments_c_c_20240101_000000.json", "part-00000-x.c000.json", one("c3"))
    write_api_file(tmp_path / "2024" / "02", "comments_d_20240201_000000.json", one("c4"))
    write_api_file(tmp_path, "channel_UCa_20240101_000000.json", {"items": [channel_item("UCa", "a", 1, "UUa")]})
    write_api_file(tmp_path / "file=videos_details_b0_20240101_000000.json", "part-0.json", {"items": [video_item("a", "UCa", 1)]})
    write_api_file(tmp_path, "videos_details_20240102_000000.json", {"items": [video_item("b", "UCa", 2)]})
    write_api_file(tmp_path / "playlist_UUa_20240101_000000.json", "part-0.json", {"items": [{"contentDetails": {"videoId": "a"}}]})
    write_api_file(tmp_path, "playlist_UUb_20240101_000000.json", {"items": [{"contentDetails": {"videoId": "b"}}]})
    write_api_file(tmp_path, "comments_e_20240101_000000.json", {"items": []})
    write_api_file(tmp_path, "comments_late.json", one("c9"))
    write_api_file(tmp_path, "notes.json", {"items": []})
    with open(tmp_path / "comments_f_20240101_000000.json", "w") as f:
        f.write("\n")
    return str(tmp_path)


def test_both_landed_forms_are_read_together(spark, mixed):
    files = RJ.open_landing(spark, mixed)  # listed once for all
    got = RJ.load_comments(spark, files, skip_damaged=True).collect()
    assert {(r.comment_id, r.video_id) for r in got} == {("c1", "a"), ("c2", "b"), ("c3", "c_c"), ("c4", "d")}
    assert {r.channel_id for r in RJ.load_channels(spark, files).collect()} == {"UCa"}
    assert {r.video_id for r in RJ.load_videos(spark, files).collect()} == {"a", "b"}
    assert {tuple(r) for r in RJ.load_playlist_items(spark, mixed).collect()} == {("UUa", "a"), ("UUb", "b")}
    with pytest.raises(Exception, match="damaged file"):
        RJ.load_comments(spark, files).collect()


def test_both_landed_forms_stream(spark, mixed):
    from clipstat.streaming.landing import comment_snapshot_stream

    q = (comment_snapshot_stream(spark, mixed, skip_damaged=True).writeStream.format("memory").queryName("mixed_landing")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    assert {r.comment_id for r in spark.table("mixed_landing").collect()} == {"c1", "c2", "c3", "c4"}


def test_outcomes_add_up_to_the_files_listed(spark, mixed):
    listed = sum(len([f for f in names if not f.startswith(".")]) for _, _, names in os.walk(mixed))
    got = {(r.kind, r.reason): r.files for r in RJ.file_outcomes(spark, mixed).collect()}
    assert sum(got.values()) == listed == RJ.landed_files(spark, mixed).count()
    assert {k: n for k, n in got.items() if k[1]} == {
        ("comments", "empty"): 1, ("comments", "name"): 1, ("comments", "damaged"): 1, (None, "other"): 1}
    assert got["comments", None] == 4
    assert {(r.kind, r.reason) for r in RJ.skipped_files(spark, mixed).collect()} == {k for k in got if k[1]}


def test_files_of_other_kinds_are_not_opened(spark, mixed):
    """They leave the listing by their path: the plan reads the wanted ones only."""
    df = RJ.load_channels(spark, mixed)
    scan = df._jdf.queryExecution().executedPlan().toString()
    assert scan.count("FileScan") == 1 and "RLIKE(file_path" in scan
    df.collect()
    read = [n for n in _nodes(df._jdf.queryExecution().executedPlan()) if n.nodeName().startswith("Scan")]
    assert [n.metrics().apply("numFiles").value() for n in read] == [1]


def _nodes(plan):
    name = plan.nodeName()
    if name == "AdaptiveSparkPlan":
        return _nodes(plan.executedPlan())
    if name.endswith("QueryStage"):
        return _nodes(plan.plan())
    kids = plan.children()
    return [plan] + [x for i in range(kids.size()) for x in _nodes(kids.apply(i))]


def test_the_latest_snapshot_takes_one_scan_and_no_struct(spark, landing):
    for df in (RJ.load_comments(spark, landing), RJ.load_videos(spark, landing), RJ.load_channels(spark, landing)):
        p = df._jdf.queryExecution().executedPlan().toString()
        assert p.count("FileScan") == 1 and "SortAggregate" not in p
        assert p.count("WindowGroupLimit") == 2  # a task sends one row a key to the shuffle


def test_packed_landing_is_the_same_files_in_few(spark):
    """A snapshot a video: packed, the files on disk don't grow with the videos, and every loader reads the same."""
    from pyspark.sql import functions as F

    from clipstat.sources import api_files as AF

    at = F.timestamp_seconds(F.lit(1_700_000_000))
    rows = spark.range(3000).select(
        F.concat(F.lit("c"), "id").alias("comment_id"), F.concat(F.lit("v_"), (F.col("id") % 500)).alias("video_id"), F.lit("ann").alias("author_name"),
        F.lit("UCann").alias("author_channel_id"), F.lit("hi é\n\"x\"").alias("text"), at.alias("published_at"), at.alias("updated_at"),
        (F.col("id") % 7).cast("int").alias("like_count"))
    items = rows.select(F.concat(F.lit("UU"), "video_id").alias("playlist_id"), "video_id").distinct()
    roots = {}
    for packed in (False, True):
        roots[packed] = root = tempfile.mkdtemp(prefix="clipstat-packs-")
        AF.land_comments(rows, root, "2025-01-01 00:00:00", page_size=4, packed=packed)
        AF.land_playlists(items, root, "2025-01-01 00:00:00", packed=packed)
    on_disk = {p: sum(f.endswith((".json", ".parquet")) for _, _, names in os.walk(r) for f in names) for p, r in roots.items()}
    assert on_disk[False] > 1000 and on_disk[True] <= 16  # a shuffle partition each, at most
    same = {p: [sorted(map(str, RJ.load_comment_snapshots(spark, r).collect())), sorted(map(str, RJ.load_comments(spark, r).collect())),
                sorted(map(str, RJ.load_playlist_items(spark, r).collect())), sorted(map(str, RJ.load_comments(spark, r, "comments_v_1?_*.json").collect())),
                sorted(map(str, RJ.file_outcomes(spark, r).collect()))] for p, r in roots.items()}
    assert same[True] == same[False]
    assert len(same[True][0]) == 3000 and len(same[True][2]) == 500 and len(same[True][3]) == 60
    # loose files may lie beside packs, and a damaged packed file fails the job that reads it
    write_api_file(roots[True], "comments_v_1_20250109_000000.json", {"items": [comment_item("c1", "bob", 99)]})
    of = {r.comment_id: r for r in RJ.load_comments(spark, roots[True]).collect()}
    assert len(of) == 3000 and of["c1"].like_count == 99
    spark.createDataFrame([("comments_v_9_20250109_000000.json", bytearray(b'{"items": ['))], RJ.PACK_SCHEMA).write.mode("append").parquet(
        f"{roots[True]}/{RJ.PACKS}/comments")
    with pytest.raises(Exception, match="damaged file: .*comments_v_9_"):
        RJ.load_comments(spark, roots[True]).collect()
    assert RJ.load_comments(spark, roots[True], skip_damaged=True).count() == 3000
    with pytest.raises(FileNotFoundError):
        RJ.load_videos(spark, roots[True])


def test_registered_json_queries_land_few_files(spark):
    from clipstat.plans import registry
    from tests.conftest import SF_TINY

    for name in ("S3_comment_json_source", "J3_resolve_uploads"):
        assert registry.QUERIES[name](spark, SF_TINY).count() > 0
    for (_, sf_dir, kind), root in registry._roots.items():
        if sf_dir == SF_TINY and kind in ("landing-comments", "playlists"):
            assert sum(len(names) for _, _, names in os.walk(root.removeprefix("file:"))) <= 64


def test_names_are_read_once_a_file(spark, landing):
    """The time and the id in a file's name are worked out before its items are exploded."""
    plan = RJ.load_comments(spark, landing)._jdf.queryExecution().optimizedPlan().toString()
    above, below = plan.split("Generate explode", 1)
    assert "regexp_extract" not in above and "regexp_extract" in below
    assert below.count("from_json(") == 1


def test_landing_shuffles_plain_rows_once_and_leaves_no_shuffle(spark):
    """Owners of several pages only are looked up; the rows go once, without the API's structs, to the file they are written in."""
    from pyspark.sql import functions as F

    from clipstat.sources import api_files as AF
    from tests.test_pipeline import shuffles_left

    at = F.timestamp_seconds(F.lit(1_700_000_000))
    rows = spark.range(60).select(
        F.col("id").cast("string").alias("comment_id"), F.when(F.col("id") < 50, F.concat(F.lit("v"), F.floor(F.sqrt("id")))).alias("video_id"),
        F.lit("ann").alias("author_name"), F.lit("UCann").alias("author_channel_id"), F.lit("hi").alias("text"), at.alias("published_at"),
        at.alias("updated_at"), F.lit(1).alias("like_count"))
    root = tempfile.mkdtemp(prefix="clipstat-plain-")
    left, made = shuffles_left(spark, lambda: AF.land_comments(rows, root, "2025-01-01 00:00:00", page_size=4, packed=True))
    assert left < made == 2  # one counts, one deals
    assert os.listdir(root) == [RJ.PACKS]
    files = spark.read.parquet(f"{root}/{RJ.PACKS}/comments").collect()
    page = {f.name: {i["id"] for i in json.loads(f.content)["items"]} for f in files}
    sizes = {n: 2 * n + 1 if n < 7 else 1 for n in range(8)}  # videos of 1, 3, 5, ... comments
    pages = {n: [name for name in page if name.startswith(f"comments_v{n}_")] for n in sizes}
    assert len(page) == len(files) == sum(map(len, pages.values()))
    for n, names in pages.items():
        assert 1 <= len(names) <= -(-sizes[n] // 4) and {c for x in names for c in page[x]} == {str(i) for i in range(n * n, n * n + sizes[n])}
    with AF._pages(rows, "comment_id", "video_id", 4, root) as paged:
        assert paged._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 0
