"""Incremental ingest of the landing folder with Structured Streaming.

The fetch step keeps landing new ``comments_<video>_<ts>.json`` snapshots.
Instead of re-reading the whole folder, a file stream picks up only new files
(same parsing and projection as the batch source), and each
micro-batch is appended to a Parquet table of comment snapshots, partitioned by
snapshot day.  The batch side (``latest_per_key``) keeps the latest snapshot
per comment.  Progress lives in a checkpoint under ``spark.checkpoint.dir``,
so a restarted or failed query resumes where it stopped.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clipstat import schemas
from clipstat.sources import raw_json
from clipstat.session import checkpoint_dir

# fixed value: the columns of Spark's source of whole files
FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def comment_snapshot_stream(spark: SparkSession, landing: str, pattern: str = "comments_*.json",
                            max_files_per_trigger: int = 1000, archive_dir: str | None = None, skip_damaged: bool = False) -> DataFrame:
    """Streaming DataFrame: one row per comment of each newly landed file, in either form (``raw_json``).

    A file that doesn't parse fails the batch; ``skip_damaged`` leaves it out.

    ``archive_dir``: processed files are moved there (``cleanSource=archive``),
    so listing the landing folder stays cheap however many files have landed.
    """
    reader = raw_json.file_reader(spark.readStream).schema(FILE_SCHEMA).option("maxFilesPerTrigger", max_files_per_trigger)
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    files = raw_json.of_pattern(reader.load(landing), pattern)
    parsed = raw_json.parsed_files(files, schemas.COMMENT_RAW, raw_json.COMMENT_FILE_RE)
    return raw_json.flatten_comments(raw_json.snapshot_items(parsed, skip_damaged)).withColumn("snapshot_date", F.to_date("snapshot_ts"))


def stream_checkpoint(spark: SparkSession, landing: str, table_path: str) -> str:
    """The progress folder of one (landing folder, table) pair: each pair keeps its own, the same after a restart.

    ``spark.checkpoint.dir`` itself is taken, not the application's folder in it.
    """
    pair = "\n".join(p.rstrip("/") for p in (landing, table_path))
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or checkpoint_dir(spark)
    return f"{base.rstrip('/')}/streams/{hashlib.sha256(pair.encode()).hexdigest()[:32]}"


def start_comment_ingest(spark: SparkSession, landing: str, table_path: str, name: str | None = None,
                         available_now: bool = True, archive_dir: str | None = None) -> StreamingQuery:
    """Append new comment snapshots to ``table_path`` (Parquet, by snapshot_date)."""
    ckpt = stream_checkpoint(spark, landing, table_path)
    w = (
        comment_snapshot_stream(spark, landing, archive_dir=archive_dir)
        .writeStream.format("parquet")
        .option("path", table_path)
        .option("checkpointLocation", ckpt)
        .partitionBy("snapshot_date")
        .outputMode("append")
    )
    if name:
        w = w.queryName(name)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
