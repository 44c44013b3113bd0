"""Exact de-duplication against immutable snapshots screened by static binary-fuse filters.

A snapshot holds, for each distinct text, its SHA-256, its number of rows and
the id that stays, dealt into shards by a 64-bit key of the digest.  Each shard
has a 3-wise binary-fuse filter of its keys (Graf and Lemire, 2022; 8-bit
fingerprints, about 1.13 bytes a key), built once and never changed.

An incoming batch is first grouped by digest on its own.  Its distinct digests
meet the filter of their shard; those that the filter lets through join the
snapshot's exact buckets by whole digest.  Groups of two rows or more are then
checked byte for byte: the texts are grouped themselves, and should a digest
stand for two texts, its rows are dealt out again by text.

Digests are counted map-side before any shuffle, so a text that a third of all
rows repeat is one row per task.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from clipstat.llm.common import materialise

SHARD_KEYS = 100_000


# --- the filter -------------------------------------------------------------

def _mix(keys: np.ndarray, seed: int) -> np.ndarray:
    """A seeded 64-bit finaliser (multiply, xor-shift) over uint64 keys."""
    with np.errstate(over="ignore"):
        x = keys.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


@dataclass
class BinaryFuse:
    """A static filter: no false negatives, about one false positive in 256."""

    seed: int
    segment: int
    table: np.ndarray

    @staticmethod
    def _slots(h: np.ndarray, segment: int, size: int) -> np.ndarray:
        """Three slots in three neighbouring segments for each hash."""
        starts = size - 2 * segment
        first = ((h >> np.uint64(32)) * np.uint64(starts)) >> np.uint64(32)
        mask = np.uint64(segment - 1)
        second = (first + np.uint64(segment)) ^ ((h >> np.uint64(18)) & mask)
        third = (first + np.uint64(2 * segment)) ^ (h & mask)
        return np.stack([first, second, third]).astype(np.int64)

    @staticmethod
    def _print(h: np.ndarray) -> np.ndarray:
        return (h ^ (h >> np.uint64(32))).astype(np.uint8)

    @classmethod
    def build(cls, keys: np.ndarray, tries: int = 100) -> BinaryFuse:
        """From distinct keys.  Peels, in rounds, the slots that only one key has left."""
        n = len(keys)
        if not n:
            return cls(0, 4, np.zeros(0, dtype=np.uint8))
        segment = max(4, 1 << int(math.floor(math.log(n) / math.log(3.33) + 2.25)))
        factor = max(1.125, 0.875 + 0.25 * math.log(1e6) / math.log(max(n, 2)))
        size = (max(1, math.ceil(n * factor / segment)) + 2) * segment
        for seed in range(1, tries + 1):
            h = _mix(keys, seed)
            slots = cls._slots(h, segment, size)
            count = np.bincount(slots.ravel(), minlength=size)
            which = np.zeros(size, dtype=np.int64)
            for s in slots:  # xor of the keys in a slot: with one left, it is that key
                np.bitwise_xor.at(which, s, np.arange(n))
            rounds, left = [], n
            ready = np.flatnonzero(count == 1)
            while len(ready):
                key, at = np.unique(which[ready], return_index=True)
                own = ready[at]
                rounds.append((key, own))
                left -= len(key)
                gone = slots[:, key]
                np.subtract.at(count, gone.ravel(), 1)
                for s in gone:
                    np.bitwise_xor.at(which, s, key)
                near = np.unique(gone)
                ready = near[count[near] == 1]
            if not left:
                table = np.zeros(size, dtype=np.uint8)
                prints = cls._print(h)
                for key, own in reversed(rounds):
                    a, b, c = slots[:, key]
                    table[own] = prints[key] ^ table[a] ^ table[b] ^ table[c]  # own is still 0
                return cls(seed, segment, table)
        raise RuntimeError(f"no binary-fuse filter for {n} keys in {tries} seeds; are they distinct?")

    def has(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.table):
            return np.zeros(len(keys), dtype=bool)
        h = _mix(keys, self.seed)
        a, b, c = self._slots(h, self.segment, len(self.table))
        return (self.table[a] ^ self.table[b] ^ self.table[c]) == self._print(h)


# --- snapshots --------------------------------------------------------------

def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


@dataclass
class Snapshot:
    """``groups``: digest, key, shard, keep_id, n; ``filters``: shard, seed, segment, fingerprints."""

    shards: int
    groups: DataFrame
    filters: DataFrame


def group_digests(rows: DataFrame) -> DataFrame:
    """(digest, keep_id, n) of rows (id, digest): the largest id stays."""
    return rows.groupBy("digest").agg(F.max("id").alias("keep_id"), F.count("*").alias("n"))


def _shard_of(shards: int) -> Column:
    return F.pmod(F.col("key"), F.lit(shards)).cast("int")


def _build_filter(pdf: pd.DataFrame) -> pd.DataFrame:
    keys = np.unique(pdf["key"].to_numpy().view(np.uint64))
    f = BinaryFuse.build(keys)
    return pd.DataFrame({"shard": [pdf["shard"].iloc[0]], "seed": [f.seed], "segment": [f.segment], "fingerprints": [f.table.tobytes()]})


def build_snapshot(rows: DataFrame, shard_keys: int = SHARD_KEYS, batch_rows: int = 0) -> Snapshot:
    """Freeze rows (id, digest): their groups and a filter for each shard of about ``shard_keys`` keys.

    ``batch_rows``: the rows to come, if they are more; a shard screens its share of them in one task.
    """
    groups = materialise(group_digests(rows).withColumn("key", F.xxhash64("digest")), "snapshot")
    shards = max(1, -(-max(groups.count(), batch_rows) // shard_keys))
    groups = groups.withColumn("shard", _shard_of(shards))
    filters = materialise(groups.select("shard", "key").groupBy("shard").applyInPandas(
        _build_filter, "shard int, seed int, segment int, fingerprints binary"), "filters")
    return Snapshot(shards, groups, filters)


def _screen(batch: pd.DataFrame, filters: pd.DataFrame) -> pd.DataFrame:
    if batch.empty or filters.empty:
        return batch.assign(maybe=False)[["digest", "maybe"]]
    f = filters.iloc[0]
    has = BinaryFuse(int(f.seed), int(f.segment), np.frombuffer(f.fingerprints, dtype=np.uint8)).has(
        batch["key"].to_numpy().view(np.uint64))
    return batch.assign(maybe=has)[["digest", "maybe"]]


def screen(batch: DataFrame, snapshot: Snapshot) -> DataFrame:
    """(digest, maybe) for distinct digests: false means surely not in the snapshot."""
    keyed = batch.select("digest", F.xxhash64("digest").alias("key")).withColumn("shard", _shard_of(snapshot.shards))
    return keyed.groupBy("shard").cogroup(snapshot.filters.groupBy("shard")).applyInPandas(_screen, "digest binary, maybe boolean")


# --- de-duplication ---------------------------------------------------------

def dedup_batch(snapshot: Snapshot, rows: DataFrame) -> DataFrame:
    """(digest, keep_id, n) over the snapshot and the incoming rows (id, digest) together."""
    own = materialise(group_digests(rows), "batch")
    positive = screen(own, snapshot).where("maybe").select("digest")
    old = snapshot.groups.select("digest", F.col("keep_id").alias("old_keep"), F.col("n").alias("old_n"))
    found = materialise(positive.join(old, "digest"), "found")  # the exact buckets
    fresh = own.join(found, "digest", "left").select(
        "digest", F.greatest("keep_id", "old_keep").alias("keep_id"),
        (F.col("n") + F.coalesce("old_n", F.lit(0))).alias("n"))
    untouched = snapshot.groups.join(found.select("digest"), "digest", "left_anti").select("digest", "keep_id", "n")
    return fresh.unionByName(untouched)


def exact_dedup(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                snapshot_share: float = 0.5, shard_keys: int = SHARD_KEYS,
                digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """One row per row of ``docs``: id, digest, keep_id, group_size, kept.

    The rows whose id lies in the lower ``snapshot_share`` of the id range (ids that
    are no numbers: a share by their hash) are frozen as the snapshot; the others arrive as the batch.  Equal texts form a
    group (null counts as empty) and the largest id stays.  A null id never
    stays beside another id; of rows with the same id and text one stays.  An
    empty table gives an empty result.  Other columns are not looked at.

    ``digest`` is a parameter for tests of the byte check only.
    """
    src = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = materialise(src.select("id", digest(F.col("text")).alias("digest")), "digests")
    if isinstance(rows.schema["id"].dataType, NumericType):
        low, high = rows.agg(F.min("id"), F.max("id")).first()
        cut = low + (high - low) * snapshot_share if low is not None else 0
        is_old = F.coalesce(F.col("id") <= F.lit(cut), F.lit(False))
    else:  # ids without distances: a share by hash
        is_old = F.col("id").isNotNull() & (F.pmod(F.xxhash64("id"), F.lit(1000)) < int(1000 * snapshot_share))
    snapshot = build_snapshot(rows.where(is_old), shard_keys, rows.where(~is_old).count())
    groups = materialise(dedup_batch(snapshot, rows.where(~is_old)), "groups")

    # byte check of all that share a digest: the same texts fall together before the shuffle
    shared = rows.join(groups.where("n > 1").select("digest"), "digest")
    members = shared.select(F.col("id").alias("m_id"), F.col("digest").alias("m_digest"))
    checked = materialise(
        src.withColumn("digest", digest(F.col("text")))
        .join(members, F.col("id").eqNullSafe(F.col("m_id")) & (F.col("digest") == F.col("m_digest")), "left_semi")
        .groupBy("digest", "text").agg(F.lit(1).alias("one"))
        .groupBy("digest").agg(F.count("*").alias("texts")), "bytes")
    split = checked.where("texts > 1").select("digest")
    # the hot digest's rows meet their group last, so that Spark may split them
    first = F.row_number().over(Window.partitionBy("id", "digest").orderBy("digest")) == 1
    out = rows.withColumn("first", first).join(groups, "digest").select(
        "id", "digest", "first", "keep_id", F.col("n").alias("group_size"))
    if not split.isEmpty():
        whole = src.withColumn("digest", digest(F.col("text"))).join(split, "digest")
        by_text = whole.groupBy("digest", "text").agg(F.max("id").alias("keep_id"), F.count("*").alias("group_size"))
        out = out.join(split, "digest", "left_anti").unionByName(
            whole.join(by_text, ["digest", "text"]).select("id", "digest", F.row_number().over(Window.partitionBy("id", "text").orderBy("digest")).alias("first"), "keep_id", "group_size")
            .withColumn("first", F.col("first") == 1))
    return out.select("id", "digest", "keep_id", "group_size", (F.col("id").eqNullSafe(F.col("keep_id")) & F.col("first")).alias("kept"))
