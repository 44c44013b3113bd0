"""Conversation repair against a plain version: uniform-cost search over one conversation at a time."""

import hashlib
import heapq
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from clipstat.llm import conversation_repair as R
from clipstat.llm import queries as Q
from tests.conftest import SF_SMALL
from tests.oracle_harness import duck

SHAPE = re.compile(r"(s?(ua)+)?")
BLANK = "\x20\x09\x0a\x0b\x0c\x0d"


def cheapest(rows, faults):
    """The least (cost, audit) and its messages: every edit is tried, cheapest first, and prefixes that can't go on are left."""
    heap, seen = [(0, "", 0, ())], set()
    while heap:
        cost, audit, i, out = heapq.heappop(heap)
        said = "".join(r[:1] or "?" for r, _ in out)
        if i == len(rows) and SHAPE.fullmatch(said):
            return cost, audit, out
        if not re.fullmatch(r"s?(ua)*u?", said):
            continue
        if (i, said[-1:]) in seen:
            continue
        seen.add((i, said[-1:]))
        for role in ("user", "assistant"):
            heapq.heappush(heap, (cost + 2, audit + "I", i, (*out, (role, ""))))
        if i == len(rows):
            continue
        role, text = rows[i]
        heapq.heappush(heap, (cost + 3, audit + "D", i + 1, out))
        if faults[i] in ("blank", "duplicate"):
            continue
        cut = faults[i] == "truncated"
        heapq.heappush(heap, (cost + cut, audit + "K", i + 1, (*out, (role, text))))
        for new in ("user", "assistant"):
            heapq.heappush(heap, (cost + 2 + cut, audit + "R", i + 1, (*out, (new, text))))


def plain(rows):
    """{conv: figures} from (conv, turn, role, text) rows."""
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        convs[conv]
        sp = lambda x: " " if x is None else str(x)
        h = zlib.crc32(f"{sp(conv)}:{sp(turn)}".encode()) % 20
        role, text = sp(role), sp(text)
        if h == 0:
            continue
        text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
        convs[conv] += [(turn, "user" if h == 4 else role, text)] * (2 if h == 3 else 1)
    out = {}
    for conv, held in convs.items():
        held.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        out[conv] = figures(held)
    return out


def figures(held):
    turns = {t for t, _, _ in held if t is not None}
    faults, said = [], set()
    for _, role, text in held:
        body = text.strip(BLANK)
        faults.append("blank" if not body else "duplicate" if (role, text) in said else "truncated" if body[-1] not in ".!?" else None)
        said.add((role, text))
    rows = [(r, t) for _, r, t in held]
    cost, audit, left = cheapest(rows, faults)
    illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    text = "\n".join(f"{r}:{t}" for r, t in left)
    return (gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, audit,
            hashlib.sha256(text.encode()).hexdigest())


COLS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def of(df):
    rows = df.select("conv_id", *COLS).collect()
    got = {r[0]: tuple(r)[1:] for r in rows}
    assert len(got) == len(rows)
    return got


def test_query_against_plain_version(spark):
    rows = duck(SF_SMALL).execute("select conv_id, turn, role, text from conversations").fetchall()
    assert of(Q.QUERIES["op12_conversations"](spark, SF_SMALL)) == plain(rows)


def test_search_is_exact():
    rng = random.Random(5)
    for _ in range(400):
        rows, faults = [], []
        for _ in range(rng.randrange(9)):
            rows.append((rng.choice(["system", "user", "user", "assistant", "assistant", "tool", ""]), "t"))
            faults.append(rng.choice([None, None, "blank", "duplicate", "truncated"]))
        codes = "".join(R.code_of(r, f) for (r, _), f in zip(rows, faults))
        cost, audit, left = cheapest(rows, faults)
        assert R.search(codes) == (cost, audit), codes
        assert R.apply_edits(rows, audit) == list(left)
        # cut in two at any place, the best way through both parts is the same
        k = rng.randrange(len(codes) + 1)
        both = []
        for mid in "ESUA":
            one = R.search(codes[:k], "E", mid)
            two = R.search(codes[k:], mid, None)
            if one and two:
                both.append((one[0] + two[0], one[1] + two[1]))
        assert min(both) == (cost, audit), codes


def test_search_of_a_long_conversation_stays_small():
    rng = random.Random(6)
    codes = "".join(rng.choice("suaUAx-") for _ in range(3000))
    cost, audit = R.search(codes)
    assert R.solve(codes) == (cost, audit) and len(audit) >= 3000 and R.search("s" * 200)[0] == 399


MESSY = [
    (1, 0, "user", "Hi."), (1, 1, "assistant", "Yes?"), (1, 1, "assistant", "Yes?"), (1, None, None, None), (1, 5, "user", "cut"),
    (2, 0, "system", "Be good."), (2, 1, "system", "Be good."), (2, 2, "tool", "x!"), (2, 2, "assistant", ""), (2, 9, "user", "Same."),
    (2, 10, "user", "Same."), (2, 11, "assistant", "é.\n\t "), (None, 0, "user", "null id."), (None, 1, "user", "again"), (3, None, "", "no role."),
    (3, None, "", "no role."), (4, 3, "assistant", " \n"), (5, 0, "user", "long " * 50_000 + "."), (6, 1, "assistant", "?" * 10),
    *[(7, i, ("user", "assistant", "system")[i * i % 3], f"turn {i % 17}" + "." * (i % 2)) for i in range(60)],
]


@pytest.mark.parametrize("segment_rows", [1, 4, 4096])
@pytest.mark.parametrize("tasks", [1, 7])
def test_edges_and_segments(spark, segment_rows, tasks):
    df = spark.createDataFrame(MESSY, "conv_id long, turn long, role string, text string").repartition(3)
    df = df.withColumns({c: F.lit(1) for c in ("segment", "rows", "n", "whole")})
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", tasks)
    try:
        got = R.repair(Q.damaged(df), gone_col="gone", segment_rows=segment_rows)
        figures_of = of(Q.join_null_safe(got.summary, R.message_digests(got.messages), ["conv_id"]))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert figures_of == plain(MESSY)


def test_other_ids_and_empty(spark):
    df = spark.createDataFrame([("b_1", 0, "user", "Hi."), ("a", 1, "user", "Hi.")], "conv_id string, turn int, role string, text string")
    got = R.repair(df)
    assert {(r.conv_id, r.cost, r.audit) for r in got.summary.collect()} == {("a", 2, "KI"), ("b_1", 2, "KI")}
    assert [[tuple(m) for m in r.messages] for r in got.messages.collect()] == [[("user", "Hi."), ("assistant", "")]] * 2
    none = R.repair(df.limit(0))
    assert none.summary.collect() == [] and none.messages.collect() == []


def test_a_hot_conversation_is_spread(spark):
    df = spark.range(20_000).selectExpr("1L AS conv_id", "id AS turn", "if(id % 2 = 0, 'user', 'assistant') AS role", "concat('t', id, '.') AS text")
    got = R.repair(df, segment_rows=500)
    segs = got.messages.collect()
    assert len(segs) >= 40 and max(len(r.messages) for r in segs) <= 500
    assert got.summary.first().cost == 0 and got.summary.first().audit == "K" * 20_000
