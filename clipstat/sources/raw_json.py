"""Raw API snapshots -> processed tables.

Landed files are one pretty-printed ``{"items": [...]}`` object each, named
``<kind>_<id>_<yyyymmdd>_<hhmmss>.json``.  A folder of that name (or ``file=`` and
that name, as Spark writes it) may hold the file instead, and both forms may lie
in one landing, also in subfolders.

``landed_files`` is the landing's index: one recursive listing, each path
classified by its name.  Every kind is read from it in ONE pass: Spark drops the
other kinds' files from the listing by their path before it opens any, a row is
a file, and its text is parsed with an explicit schema.  So a landing folder
with a million snapshot files is one scan split across the cluster, not a driver
loop of per-file jobs.  The snapshot time and, for comments and playlists, the
entity id come from the file name, which object stores keep (creation times are
not portable).  A landing may also hold packs (``PACKS``): Parquet files whose rows are
landed files, name and raw content.  Millions of small files are no load for a
file system there, the loaders parse their text as they parse a file's.  When an entity appears in several snapshots the latest one wins,
per entity (``latest_per_key``).
"""

from __future__ import annotations

import re
import warnings

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clipstat import schemas
from clipstat.functions import columns as C
from clipstat.operators.dedup import latest_per_key
from clipstat.sources.prepare import derive_video_columns
from clipstat.sources.sinks import current_version

# fixed values: landed file names and the time stamp inside them; a folder of
# that name may hold the file
SNAPSHOT_RE = r"_(\d{8}_\d{6})\.json(?:/[^/]*)?$"
SNAPSHOT_FMT = "yyyyMMdd_HHmmss"
COMMENT_FILE_RE = r"comments_([^/]+)_\d{8}_\d{6}\.json(?:/[^/]*)?$"
PLAYLIST_FILE_RE = r"playlist_([^/]+)_\d{8}_\d{6}\.json(?:/[^/]*)?$"


def snapshot_ts_from_path(path) -> F.Column:
    """The fetch time in a landed file name (``..._yyyymmdd_hhmmss.json``)."""
    p = F.col(path) if isinstance(path, str) else path
    return F.try_to_timestamp(F.regexp_extract(p, SNAPSHOT_RE, 1), F.lit(SNAPSHOT_FMT))


def video_id_from_path(path) -> F.Column:
    """The video id in ``comments_<video id>_<ts>.json`` (ids may contain ``_``); "" if absent."""
    p = F.col(path) if isinstance(path, str) else path
    return F.regexp_extract(p, COMMENT_FILE_RE, 1)


def _path(root: str | DataFrame, pattern: str) -> str:
    return pattern if isinstance(root, DataFrame) else f"{root.rstrip('/')}/{pattern}"


def _no_path(e: AnalysisException) -> bool:
    return "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e)


#: Folder of a landing with packs, one subfolder a kind; Spark leaves it out when it lists loose files.
PACKS = "_packs"
PACK_SCHEMA = "name string, content binary"

DAMAGED = "_damaged"
#: Why a landed file gives no rows.
REASONS = ("damaged", "no items", "empty", "name")

# fixed values: kinds of landed files, their names and what the name must hold
KINDS = {
    "channel": ("channel_*.json", schemas.CHANNEL_RAW, None),
    "videos": ("videos_details_*.json", schemas.VIDEO_RAW, None),
    "comments": ("comments_*.json", schemas.COMMENT_RAW, COMMENT_FILE_RE),
    "playlist": ("playlist_*.json", schemas.PLAYLIST_RAW, PLAYLIST_FILE_RE),
}

#: What the names of some kinds tell, a column each; "" where a name doesn't.
NAMED = {"_video": COMMENT_FILE_RE, "_playlist": PLAYLIST_FILE_RE}


def path_regex(pattern: str) -> str:
    """Paths whose file, or the folder that holds it, has a name like ``pattern`` (``*``, ``?``; ``file=`` may stand before it)."""
    name = "".join({"*": "[^/]*", "?": "[^/]"}.get(c, re.escape(c)) for c in pattern.removeprefix("file="))
    return f"/(?:file=)?{name}(?:/[^/]+)?$"


def file_reader(reader):
    """A batch or stream reader of landed files, one row each: path, length and content; both forms and subfolders."""
    return reader.format("binaryFile").option("recursiveFileLookup", True)


def of_pattern(files: DataFrame, pattern: str) -> DataFrame:
    """The files of that name.  The path in the metadata takes the others out of the listing before they are opened."""
    regex = path_regex(pattern)
    plain = re.fullmatch(r"[\w.*?=-]*", pattern) is not None  # no character that a metadata path would escape
    if "listed" in files.columns:  # with packs: a pack is opened if its kind's names can fit
        start = re.match(r"[^*?]*", pattern.removeprefix("file=")).group()
        kinds = [k for k, (p, _, _) in KINDS.items() if p.split("*")[0].startswith(start) or start.startswith(p.split("*")[0])]
        loose = regex if plain else rf"^(?!.*/{PACKS}/[^/]+/[^/]+$)"
        files = files.filter(F.col("listed").rlike("|".join([loose, *[f"/{PACKS}/{k}/[^/]+$" for k in kinds]])))
        return files.filter(F.col("path").rlike(regex))
    return files.filter(F.col("_metadata.file_path").rlike(regex) if plain else F.col("path").rlike(regex))


def open_landing(spark: SparkSession, root: str | DataFrame) -> DataFrame | None:
    """All files of a landing, loose or packed, listed once; None without the folder.

    Loaders take it in place of the folder's name, so that several kinds share
    one listing.  With packs, ``listed`` is the file on disk that holds the landed one.
    """
    if isinstance(root, DataFrame):
        return root
    try:
        loose = file_reader(spark.read).load(root)
    except AnalysisException as e:
        if _no_path(e):
            return None
        raise
    try:
        packs = spark.read.schema(PACK_SCHEMA).option("recursiveFileLookup", True).parquet(f"{root.rstrip('/')}/{PACKS}")
    except AnalysisException as e:
        if _no_path(e):
            return loose
        raise
    listed = F.col("_metadata.file_path").alias("listed")
    path = F.concat(F.lit(f"{root.rstrip('/')}/"), "name").alias("path")
    packed = packs.select(path, F.octet_length("content").cast("bigint").alias("length"), "content", listed)
    return loose.select("path", "length", "content", listed).unionByName(packed)


def landed_files(spark: SparkSession, root: str | DataFrame) -> DataFrame | None:
    """The index of a landing: (path, length, kind) of every file; kind is null for other names, None without the folder.

    Spark leaves files of no bytes and names that start with ``_`` or ``.`` out of its listings.
    """
    files = open_landing(spark, root)
    if files is None:
        return None
    kind = F.coalesce(*[F.when(F.col("path").rlike(path_regex(pattern)), F.lit(k)) for k, (pattern, _, _) in KINDS.items()])
    return files.select("path", "length", kind.alias("kind"))


def parsed_files(files: DataFrame, schema, name_re: str | None = None) -> DataFrame:
    """(path, items, reason) of each file; ``reason`` tells why it gives no rows, null if it gives some."""
    with_damage = T.StructType([*schema.fields, T.StructField(DAMAGED, T.StringType())])
    text = F.expr("trim(LEADING '\ufeff' FROM cast(content AS string))")
    got = F.from_json(text, with_damage, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": DAMAGED})
    f = files.select("path", got.alias("got"), (~text.rlike(r"\S")).alias("_blank")).select("path", "got.items", F.col(f"got.{DAMAGED}").alias(DAMAGED), "_blank")
    bad_name = F.lit(False) if name_re is None else F.regexp_extract("path", name_re, 1) == ""
    reason = (F.when(F.col(DAMAGED).isNotNull() | F.col("_blank"), "damaged").when(F.col("items").isNull(), "no items")
              .when(F.size("items") == 0, "empty").when(bad_name, "name"))
    return f.select("path", "items", reason.alias("reason"))


def counted(parsed: DataFrame, kind: str, watch: dict[str, Observation] | None) -> DataFrame:
    """``parsed`` that counts its files and those that give no rows, by reason, in the pass that reads it.

    ``watch`` gets the observation under ``kind``; it is filled when an action has read the files.
    """
    if watch is None:
        return parsed
    watch[kind] = Observation(f"files_{kind}")
    per = [F.count(F.when(F.col("reason") == r, 1)).alias(r) for r in REASONS]
    return parsed.observe(watch[kind], F.count(F.lit(1)).alias("files"), *per)


def _open(spark: SparkSession, root: str | DataFrame, pattern: str) -> DataFrame | None:
    """The files of that name, None without any (told from the listing: nothing is opened)."""
    files = open_landing(spark, root)
    if files is None:
        return None
    files = of_pattern(files, pattern)
    return None if files.select("path").isEmpty() else files


def read_snapshots(spark: SparkSession, root: str | DataFrame, kind: str, pattern: str | None = None, missing_ok: bool = False,
                   skip_damaged: bool = False, watch: dict[str, Observation] | None = None) -> DataFrame | None:
    """All files of ``kind`` under ``root``, or those matching ``pattern``, exploded to one row per item.

    Columns: ``item`` (struct), ``_file`` (full path), ``snapshot_ts``.
    Files without ``items`` (or with ``items: []``), or whose name lacks the id
    that the kind needs, contribute no rows.  A file that doesn't parse fails the
    job that reads it; ``skip_damaged`` leaves it out.  ``watch`` gets the counts of
    what was left out and why, from the same pass; ``skipped_files`` counts it
    apart.
    """
    default, schema, name_re = KINDS[kind]
    pattern = pattern or default
    files = _open(spark, root, pattern)
    if files is None:
        if missing_ok:
            return None
        raise FileNotFoundError(f"No files found matching {_path(root, pattern)}")
    return snapshot_items(counted(parsed_files(files, schema, name_re), kind, watch), skip_damaged)


def snapshot_items(parsed: DataFrame, skip_damaged: bool = False) -> DataFrame:
    """Parsed files exploded to (``item``, ``_file``, ``snapshot_ts`` and ``NAMED``); batch and stream share it."""
    damaged = F.col("reason").eqNullSafe("damaged")
    items = F.when(F.col("reason").isNull(), F.col("items"))
    if not skip_damaged:
        items = F.when(damaged, F.raise_error(F.concat(F.lit("damaged file: "), "path"))).otherwise(items)
    # what the name says is worked out once a file, not once an item
    named = parsed.select("*", snapshot_ts_from_path("path").alias("snapshot_ts"), *[F.regexp_extract("path", r, 1).alias(c) for c, r in NAMED.items()])
    return named.select(F.explode(items).alias("item"), F.col("path").alias("_file"), "snapshot_ts", *NAMED)


def file_outcomes(spark: SparkSession, root: str | DataFrame) -> DataFrame:
    """(kind, reason, files) over all files of the landing's index: ``reason`` is null for files that give rows.

    The counts add up to the files listed; a file whose name is of no kind has a null kind and the reason ``other``.
    """
    files = open_landing(spark, root)
    if files is None:
        return spark.createDataFrame([], "kind string, reason string, files bigint")
    listed = landed_files(spark, files)
    out = listed.filter(F.col("kind").isNull()).select(F.lit(None).cast("string").alias("kind"), F.lit("other").alias("reason"))
    for kind, (pattern, schema, name_re) in KINDS.items():
        parsed = parsed_files(of_pattern(files, pattern), schema, name_re)
        out = out.unionByName(parsed.select(F.lit(kind).alias("kind"), "reason"))
    return out.groupBy("kind", "reason").agg(F.count(F.lit(1)).alias("files"))


def skipped_files(spark: SparkSession, root: str | DataFrame) -> DataFrame:
    """(kind, reason, files): landed files that give no rows, by reason.

    ``damaged``: the file doesn't parse; ``no items``: it has no list of items;
    ``empty``: its list is empty; ``name``: its name lacks the id that its rows
    need; ``other``: a name of no kind.
    """
    return file_outcomes(spark, root).filter(F.col("reason").isNotNull())


def load_channels(spark: SparkSession, root: str | DataFrame, pattern: str = "channel_*.json", skip_damaged: bool = False,
                  watch: dict[str, Observation] | None = None) -> DataFrame:
    """Channel table; latest snapshot per channel (S5).  Raises when no file matches."""
    it = read_snapshots(spark, root, "channel", pattern, False, skip_damaged, watch)
    flat = it.select(
        F.col("item.id").alias("channel_id"),
        F.col("item.snippet.title").alias("channel_title"),
        F.col("item.snippet.description").alias("channel_description"),
        F.col("item.snippet.customUrl").alias("custom_url"),
        C.api_timestamp("item.snippet.publishedAt").alias("published_at"),
        F.col("item.snippet.country").alias("country"),
        C.to_long("item.statistics.viewCount").alias("view_count"),
        C.to_long("item.statistics.subscriberCount").alias("subscriber_count"),
        C.to_int("item.statistics.videoCount").alias("video_count"),
        F.col("item.contentDetails.relatedPlaylists.uploads").alias("uploads_playlist_id"),
        "snapshot_ts",
    )
    return latest_per_key(flat, "channel_id", "snapshot_ts").drop("snapshot_ts")


def load_video_snapshots(spark: SparkSession, root: str | DataFrame, pattern: str = "videos_details_*.json", skip_damaged: bool = False,
                         watch: dict[str, Observation] | None = None) -> DataFrame:
    """Every video of every snapshot file (duplicates kept) + snapshot_ts, as landed: without derived columns."""
    it = read_snapshots(spark, root, "videos", pattern, False, skip_damaged, watch)
    return it.select(
        F.col("item.id").alias("video_id"),
        F.col("item.snippet.channelId").alias("channel_id"),
        F.col("item.snippet.title").alias("title"),
        F.col("item.snippet.description").alias("description"),
        C.api_timestamp("item.snippet.publishedAt").alias("published_at"),
        F.col("item.snippet.channelTitle").alias("channel_title"),
        F.col("item.snippet.categoryId").alias("category_id"),
        F.col("item.snippet.tags").alias("tags"),
        F.col("item.contentDetails.duration").alias("duration"),
        C.to_long("item.statistics.viewCount").alias("view_count"),
        C.to_long("item.statistics.likeCount").alias("like_count"),
        C.to_long("item.statistics.favoriteCount").alias("favorite_count"),
        C.to_long("item.statistics.commentCount").alias("comment_count"),
        "snapshot_ts",
    )


def latest_videos(snapshots: DataFrame, as_of: str | None = None) -> DataFrame:
    """The latest snapshot of each video, with the five derived columns."""
    latest = latest_per_key(snapshots, "video_id", "snapshot_ts").drop("snapshot_ts")
    return derive_video_columns(latest, as_of)


def load_videos(spark: SparkSession, root: str | DataFrame, pattern: str = "videos_details_*.json",
                as_of: str | None = None, skip_damaged: bool = False, watch: dict[str, Observation] | None = None) -> DataFrame:
    """Videos table with the five derived columns; latest snapshot per video."""
    return latest_videos(load_video_snapshots(spark, root, pattern, skip_damaged, watch), as_of)


def empty_comments(spark: SparkSession) -> DataFrame:
    """The typed, empty comments table."""
    return spark.createDataFrame([], schemas.COMMENT)


def load_comment_snapshots(spark: SparkSession, root: str | DataFrame, pattern: str = "comments_*.json", skip_damaged: bool = False,
                           watch: dict[str, Observation] | None = None) -> DataFrame:
    """Every comment of every snapshot file (duplicates kept) + snapshot_ts.

    The video id is taken from the file name (``comments_<video id>_<ts>.json``;
    ids may contain ``_``); files whose name does not fit are skipped
    (``watch`` and ``skipped_files`` count them).
    """
    it = read_snapshots(spark, root, "comments", pattern, True, skip_damaged, watch)
    if it is None:
        warnings.warn(f"No comment files found matching {_path(root, pattern)}")
        return empty_comments(spark).withColumn("snapshot_ts", F.lit(None).cast("timestamp"))
    return flatten_comments(it)


def flatten_comments(it: DataFrame) -> DataFrame:
    """Comment rows of exploded snapshot items (``item``, ``_file``, ``snapshot_ts``); batch and stream share it."""
    s = "item.snippet.topLevelComment.snippet"
    vid = F.col("_video")
    return it.filter(vid != "").select(
        F.col("item.id").alias("comment_id"),
        vid.alias("video_id"),
        F.col(f"{s}.authorDisplayName").alias("author_name"),
        F.col(f"{s}.authorChannelId.value").alias("author_channel_id"),
        F.col(f"{s}.textDisplay").alias("text"),
        C.api_timestamp(f"{s}.publishedAt").alias("published_at"),
        C.api_timestamp(f"{s}.updatedAt").alias("updated_at"),
        F.col(f"{s}.likeCount").try_cast("int").alias("like_count"),
        "snapshot_ts",
    )


def latest_comments(snapshots: DataFrame) -> DataFrame:
    """The latest snapshot of each comment."""
    return latest_per_key(snapshots, "comment_id", ["snapshot_ts", "updated_at"]).drop("snapshot_ts")


def load_comments(spark: SparkSession, root: str | DataFrame, pattern: str = "comments_*.json", skip_damaged: bool = False,
                  watch: dict[str, Observation] | None = None) -> DataFrame:
    """S3 + U2: comments table, one row per comment id from its latest snapshot."""
    return latest_comments(load_comment_snapshots(spark, root, pattern, skip_damaged, watch))


def load_playlist_items(spark: SparkSession, root: str | DataFrame, pattern: str = "playlist_*.json", skip_damaged: bool = False,
                        watch: dict[str, Observation] | None = None) -> DataFrame:
    """(playlist_id, video_id); the playlist id comes from the file name."""
    it = read_snapshots(spark, root, "playlist", pattern, True, skip_damaged, watch)
    if it is None:
        return spark.createDataFrame([], schemas.PLAYLIST_ITEM)
    pid = F.col("_playlist")
    return (
        it.filter(pid != "")
        .select(pid.alias("playlist_id"), F.col("item.contentDetails.videoId").alias("video_id"))
        .filter(F.col("video_id").isNotNull())
        .dropDuplicates(["playlist_id", "video_id"])
    )


def load_processed(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(channel, videos, comments) Parquet tables of the last committed version (or in ``root`` itself); missing comments give S7."""
    return tables_in(spark, current_version(spark, root))


def tables_in(spark: SparkSession, base: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The three tables in a folder."""
    channel = spark.read.parquet(f"{base}/channel")
    videos = spark.read.parquet(f"{base}/videos")
    try:
        comments = spark.read.parquet(f"{base}/comments")
    except AnalysisException as e:
        if not _no_path(e):
            raise
        comments = empty_comments(spark)
    return channel, videos, comments
