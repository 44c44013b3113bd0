"""Sinks (S8, S9), versions of a set of tables, and the load report.

A run that replaces tables writes all of them into a folder of its own
(``new_version``) and, when the last one stands, commits it: an empty marker file,
named by number and version, appears in ``_versions``.  Creating a file is atomic
on every file system, so readers (``current_version``) see all the old tables or
all the new ones, also after a run that failed half-way; its folder is never
named by a marker.  The versions before the last ``KEEP_VERSIONS`` are deleted, the
one before the current one stays for jobs that still read it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

VERSIONS = "_versions"
KEEP_VERSIONS = 2
#: Of Parquet files: less disk than Spark's default, snappy.
COMPRESSION = "zstd"


def _file_system(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def delete(spark: SparkSession, path: str) -> None:
    """A file or a folder with all in it."""
    fs, p = _file_system(spark, path)
    fs.delete(p, True)


def _markers(spark: SparkSession, root: str) -> list[str]:
    """The commits of a root, oldest first: ``<number>-<version>``."""
    fs, p = _file_system(spark, f"{root.rstrip('/')}/{VERSIONS}")
    return sorted(f.getPath().getName() for f in fs.listStatus(p)) if fs.exists(p) else []


def new_version(root: str) -> str:
    """A folder for the tables of one run; nobody reads it before ``commit_version``."""
    return f"{root.rstrip('/')}/v{uuid.uuid4().hex}"


def commit_version(spark: SparkSession, root: str, version: str) -> None:
    """Make ``version`` the tables of ``root``, and delete versions long replaced."""
    root, name = root.rstrip("/"), version.rstrip("/").rsplit("/", 1)[1]
    past = _markers(spark, root)
    number = int(past[-1].split("-")[0]) + 1 if past else 1
    fs, marker = _file_system(spark, f"{root}/{VERSIONS}/{number:012d}-{name}")
    fs.create(marker, False).close()
    for old in past[: 1 - KEEP_VERSIONS] if KEEP_VERSIONS > 1 else past:
        for gone in (f"{root}/{old.split('-', 1)[1]}", f"{root}/{VERSIONS}/{old}"):
            delete(spark, gone)


def current_version(spark: SparkSession, root: str) -> str:
    """The folder that holds the tables of ``root`` now: the last version committed, or ``root`` itself without any."""
    past = _markers(spark, root)
    return f"{root.rstrip('/')}/{past[-1].split('-', 1)[1]}" if past else root.rstrip("/")


def load_report(channel: DataFrame, videos: DataFrame, comments: DataFrame) -> DataFrame:
    """(table_name, row_count) of the three tables, as one small job."""
    def n(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")

    return n(channel, "channel").unionByName(n(videos, "videos")).unionByName(n(comments, "comments"))


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None, mode: str = "overwrite") -> None:
    """Overwrite a Parquet dataset, optionally partitioned (e.g. by year_month); in a new version there is nothing to overwrite.

    ``mode="append"`` adds the rows of a further round (``rounds``).
    """
    w = df.write.mode(mode).option("compression", COMPRESSION)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_csv(df: DataFrame, path: str, array_sep: str = "|", compression: str = "none") -> None:
    """Header CSV; array columns (CSV has none) are joined with ``array_sep``.  Readers know ``compression`` by the files' names."""
    cols = [
        F.array_join(F.col(f.name), array_sep).alias(f.name) if f.dataType.typeName() == "array" else F.col(f.name)
        for f in df.schema.fields
    ]
    df.select(*cols).write.mode("overwrite").option("header", True).option("compression", compression).csv(path)
