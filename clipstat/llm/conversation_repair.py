"""Conversation structure repair: the cheapest edits that make a conversation's roles alternate, by branch and bound.

A conversation's rows, by turn, are kept, given another role or deleted, and
empty messages are put in, until the initials of the roles read ``(s?(ua)+)?``: a
system message or none, then user and assistant in turns.  Of the cheapest edits
those whose initials (Keep, Rerole, Delete, Insert) are least as text are taken.

``solve`` finds them depth first with an explicit stack.  A node is a row and a
state of that grammar.  Suffix lower bounds (what the rows from here cost at
least in a looser grammar, that may end on a system message), the best complete
(cost, audit) so far and a table of the best prefix at each node cut
everything that can't win; the search ends when nothing is left, which proves
the result.

Rows are range-partitioned by (conversation, turn, role, text), so even a
conversation that holds a third of all rows is spread over many tasks.  A task
reads its rows in order; a conversation that lies inside is repaired at once.  One that a
partition's border or ``segment_rows`` cuts is put together from segments: a text
said in an earlier segment is found by a join on digests, each segment is solved
from every state to every state, a fold over the segments picks the way, and each
segment then applies its part.  Both ways give the same result.

Rows in which the conversation is null are one conversation; null turns come first; rows of the
same turn are ordered by role and text (its first 64 characters, then a hash);
repeated rows are rows; a null role or text is one space.  A role whose initial isn't s, u or
a can't be kept.  Very long texts are taken whole; a conversation's audit and messages
are bounded by what a row can hold only per segment.  Other columns are not read.  An empty
table gives empty results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from clipstat.llm.common import column, materialise

#: A conversation longer than this is repaired in segments.
SEGMENT_ROWS = 4096
SEGMENT_CHARS = 4 << 20
BLANKS = " \t\n\x0b\x0c\r"
RIGHT_PAIRS = {"su", "ua", "au"}
#: State of the grammar: nothing said yet (E), or the last initial.  What a kept initial leads to:
KEPT = {"E": {"s": "S", "u": "U"}, "S": {"u": "U"}, "U": {"a": "A"}, "A": {"u": "U"}}
#: What a message in the role that is due leads to.
DUE = {"E": "U", "S": "U", "U": "A", "A": "U"}
ROLE = {"U": "user", "A": "assistant"}
NEVER = 1 << 60


def code_of(role: str, fault: str | None) -> str:
    """A row as the search sees it: its initial, upper case if truncated; ``-`` if it has to go."""
    if fault in ("blank", "duplicate"):
        return "-"
    initial = role[:1] if role[:1] in ("s", "u", "a") else "x"
    return initial.upper() if fault == "truncated" else initial


def suffix_bounds(codes: str, goal: str | None) -> dict[str, list[int]]:
    """For each state, the least that the rows from i on cost, in the looser grammar."""
    n = len(codes)
    user, other, first = [NEVER] * (n + 1), [NEVER] * (n + 1), [NEVER] * (n + 1)  # user due, assistant due, nothing said
    user[n] = 0 if goal in (None, "S", "A") else NEVER
    other[n] = 2 if goal is None else 0 if goal == "U" else NEVER
    first[n] = 0 if goal in (None, "E") else NEVER
    for i in range(n - 1, -1, -1):
        c = codes[i]
        u, a = 3 + user[i + 1], 3 + other[i + 1]
        e = 3 + first[i + 1]
        if c != "-":
            cut, low = c.isupper(), c.lower()
            u = min(u, other[i + 1] + cut + (0 if low == "u" else 2))
            a = min(a, user[i + 1] + cut + (0 if low == "a" else 2))
            if low == "s":
                e = min(e, user[i + 1] + cut)
        user[i], other[i] = min(u, a + 2), min(a, u + 2)
        first[i] = min(e, user[i])
    return {"E": first, "S": user, "A": user, "U": other}


def search(codes: str, start: str = "E", goal: str | None = None) -> tuple[int, str] | None:
    """(cost, audit) of the best edits from ``start``; None if there are none.

    Without a goal the conversation has to end well, by inserts after the last
    row if need be.  With one, that state is to be reached by the last row.
    """
    n, bound = len(codes), suffix_bounds(codes, goal)
    best: tuple[int, str] | None = None
    table: dict[tuple[int, str], tuple[int, str]] = {}
    stack = [(0, start, 0, "")]
    while stack:
        i, state, cost, audit = stack.pop()
        least = cost + bound[state][i]
        if least >= NEVER or best is not None and (least, audit) > (best[0], best[1][:len(audit)]):
            continue
        known = table.get((i, state))
        if known is not None and known <= (cost, audit):
            continue
        table[i, state] = (cost, audit)
        if i == n and (state in "EA" if goal is None else state == goal) and (best is None or (cost, audit) < best):
            best = (cost, audit)
        ways = []
        if i < n or goal is None:
            ways.append(("I", i, DUE[state], cost + 2))
        if i < n:
            ways.append(("D", i + 1, state, cost + 3))
            if codes[i] != "-":
                cut, low = int(codes[i].isupper()), codes[i].lower()
                ways.append(("R", i + 1, DUE[state], cost + 2 + cut))
                if low in KEPT[state]:
                    ways.append(("K", i + 1, KEPT[state][low], cost + cut))
        # the one that promises most is looked at first
        ways.sort(key=lambda w: (w[3] + bound[w[2]][w[1]], w[0]), reverse=True)
        stack += [(at, to, c, audit + edit) for edit, at, to, c in ways]
    return best


_short = lru_cache(maxsize=50_000)(search)


def solve(codes: str, start: str = "E", goal: str | None = None) -> tuple[int, str] | None:
    """``search``, which a worker remembers for short conversations: they repeat."""
    return _short(codes, start, goal) if len(codes) <= 64 else search(codes, start, goal)


def apply_edits(rows: list[tuple[str, str]], audit: str, state: str = "E") -> list[tuple[str, str]]:
    """The messages that the edits leave."""
    out, i = [], 0
    for edit in audit:
        if edit == "I":
            state = DUE[state]
            out.append((ROLE[state], ""))
            continue
        role, text = rows[i]
        i += 1
        if edit == "K":
            state = KEPT[state][role[0]]
            out.append((role, text))
        elif edit == "R":
            state = DUE[state]
            out.append((ROLE[state], text))
    return out


def digest_of(role: str, text: str) -> bytes:
    return hashlib.md5(f"{len(role)}:{role}{text}".encode("utf-8", "surrogatepass"), usedforsecurity=False).digest()


def inspect(rows: list[tuple[str, str]], said: set[bytes] = frozenset()) -> tuple[str, dict[str, int]]:
    """The codes of rows in order, and how many have each fault; ``said``: digests of messages before them."""
    count = {"blank": 0, "duplicate": 0, "truncated": 0}
    codes, here = [], set()
    for role, text in rows:
        body = text.rstrip(BLANKS)
        if not body:
            fault = "blank"
        elif (role, text) in here or said and digest_of(role, text) in said:
            fault = "duplicate"
        else:
            fault = None if body[-1] in ".!?" else "truncated"
        here.add((role, text))
        if fault:
            count[fault] += 1
        codes.append(code_of(role, fault))
    return "".join(codes), count


def illegal_pairs(rows: list[tuple[str, str]]) -> int:
    return sum(a[0][:1] + b[0][:1] not in RIGHT_PAIRS for a, b in zip(rows, rows[1:]))


class _Segment:
    """Rows of one conversation that follow each other."""

    def __init__(self, conv):
        self.conv, self.rows, self.turns, self.chars = conv, [], [], 0

    def add(self, turn, role: str, text: str) -> None:
        self.rows.append((role, text))
        self.chars += len(text)
        if turn is not None and (not self.turns or self.turns[-1] != turn):
            self.turns.append(turn)


FIGURES = ["blank", "duplicate", "truncated", "illegal", "cost"]
MESSAGES = "array<struct<role:string,text:string>>"


@dataclass
class Repaired:
    """``summary``: a row for each conversation; ``messages``: the repaired ones, a row for each segment in order."""

    summary: DataFrame
    messages: DataFrame


def repair(rows: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
           gone_col: str | None = None, segment_rows: int = SEGMENT_ROWS) -> Repaired:
    """Repair every conversation of ``rows``.

    ``summary``: (conv, gaps, blank, duplicate, truncated, illegal, cost, audit).
    ``messages``: (conv, segment, whole, messages), messages an array of role and text.
    A row whose ``gone_col`` is true only says that its conversation exists.
    """
    gone = F.coalesce(column(gone_col), F.lit(False)) if gone_col else F.lit(False)
    text = F.coalesce(column(text_col).cast("string"), F.lit(" "))
    src = rows.select(column(conv_col).alias("conv"), F.when(~gone, column(turn_col).cast("long")).alias("turn"),
                      F.coalesce(column(role_col).cast("string"), F.lit(" ")).alias("role"),
                      F.when(~gone, text).alias("text"))
    order = [F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.substring("text", 1, 64),
             F.xxhash64("text"), F.col("pos")]
    ranged = src.withColumn("pos", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)

    of = src.schema["conv"]
    fields = StructType.fromDDL(f"segment long, whole boolean, n long, low long, high long, turns long, rows {MESSAGES}, "
                                "digests array<binary>, audit string")
    schema = StructType([of, *fields, *[StructField(c, LongType()) for c in FIGURES]])

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        made: list[dict] = []
        now, first, serial = None, True, 0
        conv_type = None

        def close(seg: _Segment, whole: bool) -> None:
            nonlocal serial
            got = {"conv": seg.conv, "segment": (part << 32) + serial, "whole": whole, "n": len(seg.rows),
                   "low": seg.turns[0] if seg.turns else None, "high": seg.turns[-1] if seg.turns else None, "turns": len(seg.turns)}
            serial += 1
            if whole:
                codes, count = inspect(seg.rows)
                cost, audit = solve(codes)
                got |= count | {"illegal": illegal_pairs(seg.rows), "cost": cost, "audit": audit}
                left = apply_edits(seg.rows, audit)
            else:
                left = seg.rows
                got["digests"] = list({digest_of(*r) for r in left})
            got["rows"] = [{"role": r, "text": t} for r, t in left]
            made.append(got)

        def flush() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_pylist(made, schema=arrow)
            made.clear()
            return batch

        arrow = None
        cut = False  # an earlier segment of the same conversation was closed
        for b in batches:
            if arrow is None:
                conv_type = b.schema.field("conv").type
                kinds = {"long": pa.int64(), "boolean": pa.bool_(), "string": pa.string(), "array<binary>": pa.list_(pa.binary()),
                         MESSAGES.replace(" ", ""): pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))}
                arrow = pa.schema([("conv", conv_type)] + [
                    (f.name, kinds["long" if f.dataType.simpleString() == "bigint" else f.dataType.simpleString()]) for f in schema.fields[1:]])
            size = 0
            for conv, turn, role, said in zip(*(b.column(c).to_pylist() for c in ("conv", "turn", "role", "text"))):
                if now is None or conv != now.conv:
                    if now is not None:
                        close(now, not cut and not first)
                        first = False
                    now, cut = _Segment(conv), False
                elif len(now.rows) >= segment_rows or now.chars >= SEGMENT_CHARS:
                    size += now.chars
                    close(now, False)
                    now, cut = _Segment(conv), True
                if said is not None:
                    now.add(turn, role, said)
                if len(made) >= 1000 or size > SEGMENT_CHARS:
                    yield flush()
                    size = 0
        if now is not None:
            close(now, False)  # it may go on in the next partition
            yield flush()

    found = materialise(ranged.drop("pos").mapInArrow(segments, schema), "segments")
    whole, cut = found.where("whole"), found.where("not whole")
    joined = _put_together(cut, schema)
    gaps = F.coalesce(F.expr("high - low + 1 - turns"), F.lit(0)).alias("gaps")
    picked = joined.where("summary").select("conv", gaps, *FIGURES, "audit")
    summary = whole.select("conv", gaps, *FIGURES, "audit").unionByName(picked)

    def act(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            left = []
            for held, state, audit in zip(*(b.column(c).to_pylist() for c in ("rows", "start", "part_audit"))):
                left.append([{"role": r, "text": t} for r, t in apply_edits([(x["role"], x["text"]) for x in held], audit, state)])
            kind = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
            yield pa.RecordBatch.from_arrays([b.column("conv"), b.column("segment"), pa.array([False] * b.num_rows, pa.bool_()), pa.array(left, kind)],
                                             ["conv", "segment", "whole", "messages"])

    ways = cut.select("segment", "conv", "rows").join(joined.select("segment", "start", "part_audit"), "segment")
    shape = StructType([of, *StructType.fromDDL(f"segment long, whole boolean, messages {MESSAGES}")])
    messages = whole.select("conv", "segment", "whole", F.col("rows").alias("messages")).unionByName(
        ways.select("conv", "segment", "rows", "start", "part_audit").mapInArrow(act, shape))
    return Repaired(summary.withColumnRenamed("conv", conv_col), messages.withColumnRenamed("conv", conv_col))


def _put_together(cut: DataFrame, schema: StructType) -> DataFrame:
    """A row for each segment with the way through it, the first of a conversation with its figures (``summary``)."""
    of = schema["conv"]
    said = cut.select("conv", "segment", F.explode("digests").alias("digest"))
    first = said.groupBy("conv", "digest").agg(F.min("segment").alias("first"))
    # a (conversation, digest) has a row for each of its segments at most
    again = (said.alias("s").join(first.alias("f"), F.expr("s.conv <=> f.conv AND s.digest = f.digest")).where("s.segment > f.first")
             .groupBy("s.segment").agg(F.collect_list("s.digest").alias("known")))
    plan = StructType([of, *StructType.fromDDL(
        "segment long, n long, low long, high long, turns long, blank long, duplicate long, truncated long, illegal long, "
        "first_initial string, last_initial string, ways array<struct<start:string,goal:string,cost:long,audit:string>>")])
    way = pa.list_(pa.struct([("start", pa.string()), ("goal", pa.string()), ("cost", pa.int64()), ("audit", pa.string())]))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols = {c: [] for c in ("blank", "duplicate", "truncated", "illegal", "first_initial", "last_initial", "ways")}
            for held, known in zip(b.column("rows").to_pylist(), b.column("known").to_pylist()):
                rows = [(x["role"], x["text"]) for x in held]
                codes, count = inspect(rows, set(known or ()))
                for c, v in count.items():
                    cols[c].append(v)
                cols["illegal"].append(illegal_pairs(rows))
                cols["first_initial"].append(rows[0][0][:1] if rows else None)
                cols["last_initial"].append(rows[-1][0][:1] if rows else None)
                found = [(s, g, solve(codes, s, g)) for s in "ESUA" for g in "ESUA"]
                cols["ways"].append([{"start": s, "goal": g, "cost": x[0], "audit": x[1]} for s, g, x in found if x is not None])
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [way]
            yield pa.RecordBatch.from_arrays(
                [b.column(c) for c in ("conv", "segment", "n", "low", "high", "turns")] + [pa.array(v, k) for v, k in zip(cols.values(), kinds)],
                plan.names)

    looked = cut.join(again, "segment", "left").select("conv", "segment", "n", "low", "high", "turns", "rows", "known").mapInArrow(look, plan)
    out = StructType([of, *StructType.fromDDL("segment long, start string, part_audit string, summary boolean, low long, high long, turns long, "
                                              "blank long, duplicate long, truncated long, illegal long, cost long, audit string")])

    def fold(t: pa.Table) -> pa.Table:
        segs = sorted(t.select([c for c in t.column_names if c != "conv"]).to_pylist(), key=lambda s: s["segment"])
        reach = {"E": (0, "", ())}  # state: cost, audit, the states before each segment
        for s in segs:
            to: dict[str, tuple] = {}
            for w in s["ways"]:
                if w["start"] in reach:
                    cost, audit, path = reach[w["start"]]
                    new = (cost + w["cost"], audit + w["audit"], (path, w["start"], len(audit)))
                    if w["goal"] not in to or new[:2] < to[w["goal"]][:2]:
                        to[w["goal"]] = new
            reach = to
        ends = [(c + (k := {"U": 1, "S": 2}.get(state, 0)) * 2, a + "I" * k, path) for state, (c, a, path) in reach.items()]
        cost, audit, path = min(ends, key=lambda x: x[:2])
        starts, cuts = [], [len(audit)]
        while path:
            path, state, at = path
            starts.append(state)
            cuts.append(at)
        starts, cuts = starts[::-1], cuts[::-1]
        total = {c: sum(s[c] for s in segs) for c in ("blank", "duplicate", "truncated", "illegal", "turns")}
        last_turn = last = None
        for s in segs:  # where segments meet
            if s["low"] is not None:
                total["turns"] -= s["low"] == last_turn
                last_turn = s["high"]
            if s["n"]:
                total["illegal"] += last is not None and last + s["first_initial"] not in RIGHT_PAIRS
                last = s["last_initial"]
        low = [s["low"] for s in segs if s["low"] is not None]
        rows = [{"segment": s["segment"], "start": state, "part_audit": audit[lo:hi], "summary": False}
                for s, state, lo, hi in zip(segs, starts, cuts, cuts[1:])]
        rows[0] |= total | {"summary": True, "low": min(low, default=None), "high": last_turn, "cost": cost, "audit": audit}
        kinds = {"start": pa.string(), "part_audit": pa.string(), "summary": pa.bool_(), "audit": pa.string()}
        shape = pa.schema([(c, kinds.get(c, pa.int64())) for c in out.names[1:]])
        made = pa.Table.from_pylist(rows, schema=shape)
        return made.add_column(0, "conv", t.column("conv").combine_chunks().take(pa.array([0] * len(rows), pa.int64())))

    return materialise(looked.groupBy("conv").applyInArrow(fold, out), "ways")


def message_digests(messages: DataFrame, *, conv_col: str = "conv_id", out_col: str = "repaired_sha256") -> DataFrame:
    """(conv, SHA-256 of its ``role:text`` lines joined by newlines).

    A segmented conversation's lines pass through one task in order, a segment at
    a time: the digest is a chain over all its bytes.  Nothing of it is held.
    """
    lines = F.transform("messages", lambda m: F.concat(m["role"], F.lit(":"), m["text"]))
    text = messages.select(column(conv_col).alias("conv"), "segment", "whole", F.size("messages").alias("n"), F.array_join(lines, "\n").alias("text"))
    done = text.where("whole").select("conv", F.sha2("text", 256).alias("digest"))
    shape = StructType([text.schema["conv"], *StructType.fromDDL("digest string")])

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        started, now, run, some = False, None, None, False
        for b in batches:
            got = []
            for conv, n, part in zip(*(b.column(c).to_pylist() for c in ("conv", "n", "text"))):
                if not started or conv != now:
                    if started:
                        got.append((now, run.hexdigest()))
                    started, now, run, some = True, conv, hashlib.sha256(), False
                if n:
                    run.update((("\n" if some else "") + part).encode("utf-8", "surrogatepass"))
                    some = True
            yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in got], b.schema.field("conv").type), pa.array([d for _, d in got], pa.string())], shape.names)
        if started:
            yield pa.RecordBatch.from_arrays([pa.array([now], b.schema.field("conv").type), pa.array([run.hexdigest()], pa.string())], shape.names)

    rest = text.where("not whole").repartition("conv").sortWithinPartitions("conv", "segment").mapInArrow(chain, shape)
    return done.unionByName(rest).select(F.col("conv").alias(conv_col), F.col("digest").alias(out_col))
