"""Removal of word passages that an earlier document already has, with suffix automata.

A window is ``window`` consecutive words.  Each word that is covered by a
window whose words also start in a document with a smaller id goes.

The reference of a document is every earlier document, so the automata of all
reference shards together have no bound and are not broadcast: shards are
formed so that whatever can match meets in one.

1. Anchors.  Of the ``gram``-word sequences in a window the one with the
   smallest hash is its anchor, so equal windows have the same anchor.  The
   distinct (anchor, id) pairs are shuffled by anchor; anchors of one document
   only are done with.
2. Units.  The documents that have repeated anchors give the text around each:
   all windows that have it as their anchor.  An anchor of more than
   ``hot_docs`` documents gives its windows one by one instead, keyed by
   content, so that no key gathers a hot passage's many different contexts.
   Equal units are combined before the shuffle and keep their smallest id.
3. Automata.  Each task builds generalised suffix automata over the units of
   its keys; a state knows the first document of its substrings.  The units are
   streamed through their automaton for matching statistics: at each word the
   state of the last ``window`` words tells the first document that has them.
4. Windows whose first document is an earlier one go back to their document,
   and the maximal spans that they cover are cut out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clipstat.llm.common import materialise, run_starts, sub_batches, whole_groups

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BASE = 0xD6E8FEB86659FD93  # odd, so it has an inverse modulo 2^64
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
        return x ^ (x >> np.uint64(32))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, at least ``n`` of each."""
    size = 1 << max(16, (n - 1).bit_length())
    if size not in _powers:
        _powers.clear()
        with np.errstate(over="ignore"):
            up = np.full(size, _BASE, dtype=np.uint64)
            down = np.full(size, pow(_BASE, -1, 1 << 64), dtype=np.uint64)
            up[0] = down[0] = 1
            _powers[size] = np.multiply.accumulate(up), np.multiply.accumulate(down)
    return _powers[size]


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text number) of every word of all texts, without a Python step per word."""
    raw = b" ".join(texts) + b" "
    b = np.frombuffer(raw, dtype=np.uint8)
    space = _SPACE[b]
    edge = np.flatnonzero(np.diff(space, prepend=True))
    start, end = edge[::2], edge[1::2]
    up, down = _power_tables(len(b) + 1)
    with np.errstate(over="ignore"):
        run = np.zeros(len(b) + 1, dtype=np.uint64)
        np.cumsum((b.astype(np.uint64) + np.uint64(1)) * up[:len(b)], out=run[1:])
        h = _mix((run[end] - run[start]) * down[start] + (end - start).astype(np.uint64))
    stops = np.cumsum(np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts)))
    return h, np.searchsorted(stops, start, side="right")


def anchors(h: np.ndarray, doc: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, text number, first window, windows) of every run of windows with the same anchor.

    A window is known by the place of its first word among all words.
    """
    n = len(h) - window + 1
    if n <= 0:
        z = np.zeros(0, dtype=np.int64)
        return z.astype(np.uint64), z, z, z
    with np.errstate(over="ignore"):
        g = np.zeros(len(h) - gram + 1, dtype=np.uint64)
        for k in range(gram):
            g = g * np.uint64(_BASE) + h[k:k + len(g)]
        g = _mix(g)
    low, at = g[:n].copy(), np.arange(n)
    for k in range(1, window - gram + 1):
        less = g[k:k + n] < low
        low[less] = g[k:k + n][less]
        at[less] = np.flatnonzero(less) + k
    whole = np.flatnonzero(doc[:n] == doc[window - 1:])
    if not len(whole):
        z = np.zeros(0, dtype=np.int64)
        return z.astype(np.uint64), z, z, z
    first = run_starts(doc[whole], at[whole])
    return low[whole[first]], doc[whole[first]], whole[first], np.diff(np.append(first, len(whole)))


def _texts(b: pa.RecordBatch) -> list[bytes]:
    return [t.encode("utf-8", "surrogatepass") if t else b"" for t in b.column("text").to_pylist()]


class SuffixAutomaton:
    """A generalised suffix automaton over word lists; ``first`` of a state: the smallest id of a list that has it."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link = [-1]
        self.size = [0]
        self.first = [None]

    def _new(self, size: int, links: dict, link: int) -> int:
        self.next.append(links)
        self.link.append(link)
        self.size.append(size)
        self.first.append(None)
        return len(self.size) - 1

    def _split(self, p: int, c, q: int) -> int:
        """A state for the part of q that is as long as p and c."""
        twin = self._new(self.size[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = twin
        nxt, link = self.next, self.link
        while p >= 0 and nxt[p].get(c) == q:
            nxt[p][c] = twin
            p = link[p]
        return twin

    def _extend(self, last: int, c) -> int:
        nxt, link = self.next, self.link
        q = nxt[last].get(c)
        if q is not None:
            return q if self.size[q] == self.size[last] + 1 else self._split(last, c, q)
        state = self._new(self.size[last] + 1, {}, 0)
        p = last
        while p >= 0 and c not in nxt[p]:
            nxt[p][c] = state
            p = link[p]
        if p >= 0:
            q = nxt[p][c]
            link[state] = q if self.size[q] == self.size[p] + 1 else self._split(p, c, q)
        return state

    @classmethod
    def of(cls, lists: list[tuple[int, list]]) -> SuffixAutomaton:
        a = cls()
        for _, words in lists:
            last = 0
            for c in words:
                last = a._extend(last, c)
        nxt, first = a.next, a.first
        for id_, words in lists:  # the states of each list's prefixes
            at = 0
            for c in words:
                at = nxt[at][c]
                if first[at] is None or id_ < first[at]:
                    first[at] = id_
        for s in sorted(range(1, len(a.size)), key=a.size.__getitem__, reverse=True):
            up, mine = a.link[s], first[s]  # what a state has, its suffixes have
            if up > 0 and (first[up] is None or mine < first[up]):
                first[up] = mine
        return a

    def first_ids(self, words: list, window: int) -> list[int | None]:
        """For each window of the words: the smallest id of a list that has it; None if none has.

        The state and length that follow the words are their matching
        statistics, cut at the window.
        """
        nxt, link, size = self.next, self.link, self.size
        out, at, n = [], 0, 0
        for i, c in enumerate(words):
            while at and c not in nxt[at]:
                at = link[at]
                n = size[at]
            if c in nxt[at]:
                at = nxt[at][c]
                n += 1
            while at and size[link[at]] >= window:
                at = link[at]
            n = min(n, size[at])
            if i >= window - 1:
                out.append(self.first[at] if n >= window else None)
        return out


def _units(docs: DataFrame, wanted: DataFrame, window: int, gram: int) -> DataFrame:
    """(key, id, row, start, unit) of the documents that have repeated anchors."""
    rows = docs.join(wanted, "id").select("id", "row", "text", "anchors", "hot")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sub_batches(batches, "text", 4 << 20):
            raw = _texts(b)
            h, doc = word_hashes(raw)
            anchor, of, start, n = anchors(h, doc, window, gram)
            begin = np.searchsorted(doc, np.arange(len(raw)))
            lo = np.searchsorted(of, np.arange(len(raw) + 1))
            wants, hots = b.column("anchors"), b.column("hot")
            out: tuple[list, list, list, list] = ([], [], [], [])
            for i, text in enumerate(raw):
                own = slice(lo[i], lo[i + 1])
                mine = np.asarray(wants[i].values).view(np.uint64)
                hot = set(np.asarray(hots[i].values.cast(pa.int64())).view(np.uint64).tolist())
                take = np.isin(anchor[own], mine)
                words = text.split()
                for a, s, k in zip(anchor[own][take].tolist(), (start[own][take] - begin[i]).tolist(), n[own][take].tolist()):
                    parts = [(s + j, 1) for j in range(k)] if a in hot else [(s, k)]
                    for at, m in parts:
                        unit = b" ".join(words[at:at + m + window - 1])
                        key = int.from_bytes(hashlib.blake2b(unit, digest_size=8).digest(), "big", signed=True) if a in hot \
                            else a - (1 << 64) if a >> 63 else a
                        for column, v in zip(out, (key, i, at, unit.decode("utf-8", "surrogatepass"))):
                            column.append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.int64()), *[b.column(c).take(pa.array(out[1], pa.int64())) for c in ("id", "row")],
                 pa.array(out[2], pa.int32()), pa.array(out[3], pa.string())],
                ["key", "id", "row", "start", "unit"])

    return rows.mapInArrow(run, "key long, id long, row long, start int, unit string")


def _first_documents(units: DataFrame, window: int) -> DataFrame:
    """(key, unit hash, firsts): for each window of a distinct unit the smallest id that has it."""
    distinct = units.groupBy("key", "unit").agg(F.min("id").alias("id")).withColumn("hash", F.xxhash64("unit"))
    dealt = distinct.repartition("key").sortWithinPartitions("key", "id", "hash")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, ["key"], 20_000):
            key = t.column("key").to_numpy()
            ids, unit = t.column("id").to_pylist(), [u.split(" ") for u in t.column("unit").to_pylist()]
            cuts = [*run_starts(key).tolist(), len(key)]
            firsts: list[list[int]] = []
            for lo, hi in zip(cuts, cuts[1:]):
                if hi == lo + 1:  # the automaton of one list is a chain of that list's states
                    firsts.append([ids[lo]] * (len(unit[lo]) - window + 1))
                    continue
                a = SuffixAutomaton.of([(ids[i], unit[i]) for i in range(lo, hi)])
                firsts.extend(a.first_ids(unit[i], window) for i in range(lo, hi))
            yield pa.RecordBatch.from_arrays(
                [t.column("key").combine_chunks(), t.column("hash").combine_chunks(), pa.array(firsts, pa.list_(pa.int64()))],
                ["key", "hash", "firsts"])

    return dealt.mapInArrow(run, "key long, hash long, firsts array<long>")


def dedup_passages(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", window: int = 13,
                   gram: int = 5, hot_docs: int = 1000) -> DataFrame:
    """(id, n_words, n_removed, kept) for every row of ``docs``; kept: the words that stay, joined by one space.

    ``id_col`` holds integers.  Null and blank texts have no words.  Rows with
    the same id are one document as far as "earlier" goes: nothing is removed
    from one for what another of them has.  Rows with a null id keep all their
    words and are nobody's reference.  An empty table gives an empty result.
    Other columns are not looked at.
    """
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    src = src.withColumn("row", F.xxhash64("text"))  # tells rows of the same id apart
    named = src.where("id is not null")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sub_batches(batches, "text", 4 << 20):
            h, doc = word_hashes(_texts(b))
            anchor, of, _, _ = anchors(h, doc, window, gram)
            by = np.lexsort((anchor, of))
            by = by[run_starts(of[by], anchor[by])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchor[by].view(np.int64)), b.column("id").take(pa.array(of[by]))], ["anchor", "id"])

    every = Window.partitionBy("anchor")
    seen = named.select("id", "text").mapInArrow(find, "anchor long, id long")
    repeated = (seen.withColumn("low", F.min("id").over(every)).withColumn("high", F.max("id").over(every))
                .withColumn("n", F.count("*").over(every)).where("low < high"))
    wanted = repeated.groupBy("id").agg(
        F.collect_set("anchor").alias("anchors"), F.collect_set(F.when(F.col("n") > hot_docs, F.col("anchor"))).alias("hot"))
    units = materialise(_units(named, wanted, window, gram).withColumn("hash", F.xxhash64("unit")), "units")
    firsts = materialise(_first_documents(units, window), "firsts")
    earlier = F.filter(F.transform("firsts", lambda f, i: F.when(f < F.col("id"), F.col("start") + i)), lambda s: s.isNotNull())
    cut = (units.select("key", "hash", "id", "row", "start").join(firsts, ["key", "hash"]).select("id", "row", earlier.alias("cut"))
           .where(F.size("cut") > 0).groupBy("id", "row").agg(F.flatten(F.collect_list("cut")).alias("cut")))
    rows = src.join(cut, ["id", "row"], "left")

    def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sub_batches(batches, "text"):
            cuts, total, gone, kept = b.column("cut"), [], [], []
            for i, text in enumerate(_texts(b)):
                words = text.split()
                total.append(len(words))
                if cuts[i].is_valid:
                    at = np.asarray(cuts[i].values)
                    depth = np.zeros(len(words) + 1, dtype=np.int64)
                    np.add.at(depth, at, 1)
                    np.add.at(depth, at + window, -1)
                    stay = np.cumsum(depth[:-1]) <= 0
                    gone.append(int(len(words) - stay.sum()))
                    words = [w for w, s in zip(words, stay.tolist()) if s]
                else:
                    gone.append(0)
                kept.append(b" ".join(words).decode("utf-8", "surrogatepass"))
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string())],
                ["id", "n_words", "n_removed", "kept"])

    return rows.mapInArrow(drop, "id long, n_words long, n_removed long, kept string")
