"""LM scores against plain Python: words counted one by one, bits mixed one by one."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from clipstat.llm import lm_mixing as L
from clipstat.llm import queries as Q
from tests.conftest import SF_SMALL
from tests.oracle_harness import duck


def streams_of(texts):
    return [b" ".join(L.words_of(t)) for t in texts]


def plain_log2(stream, follows, weights, rate):
    """One text, bit by bit; ``follows[context][byte]`` are the counts."""
    data = stream + L.END
    total, squash = 0.0, lambda z: 1 / (1 + math.exp(-z))
    for i, byte in enumerate(data):
        if i % L.LANE == 0:
            mix, bias, slope, shift = weights.mix.astype(float), weights.bias.astype(float), [1.0] * 8, [0.0] * 8
        back = (L.END * L.LEAD + data)[i:i + L.LEAD]
        seen = [follows.get(back[len(back) - k:], {}) for k in L.ORDERS]
        gate = sum(1 for s in seen if s)
        for b in range(8):
            high, bit = byte >> (8 - b), byte >> (7 - b) & 1
            x = []
            for s in seen:
                n = [L.SMOOTH, L.SMOOTH]
                for c, k in s.items():
                    if c >> (8 - b) == high:
                        n[c >> (7 - b) & 1] += k
                x.append(math.log(n[1] / n[0]))
            dot = max(-8.0, min(8.0, float(np.dot(mix[:, b], x) + bias[gate, b])))
            p = squash(dot * slope[b] + shift[b])
            total += math.log2(max(p if bit else 1 - p, float(L.LEAST)))
            shift[b] += float(L.REFINE_RATE) * (bit - p)
            slope[b] += float(L.REFINE_RATE) * float(L.SLOPE_SHARE) * (bit - p) * dot
            err = rate * (bit - squash(dot))
            mix[:, b] += err * np.array(x)
            bias[gate, b] += err
    return total


def counted(streams):
    follows = defaultdict(Counter)
    for s in streams:
        data = L.END * L.LEAD + s + L.END
        for i in range(L.LEAD, len(data)):
            for k in L.ORDERS:
                follows[data[i - k:i]][data[i]] += 1
    return follows


def known_of(streams, less=0):
    t = L.Tally()
    for s in streams:
        t.add(s.split(), True)
    return L._known(t.counts(), less)


@pytest.fixture(scope="module")
def some():
    rows = duck(SF_SMALL).execute("select text from documents where text is not null order by doc_id limit 120").fetchall()
    return streams_of([r[0] for r in rows])


def test_mixing_against_bit_by_bit(some):
    train, other = some[:100], [s[:5000] for s in some[100:106]] + [b"", b"zq \xf0\x9f\x98\x80 unseen", some[3][:700]]
    known = known_of(train)
    weights = L.fit(train, known_of(train, 1))
    assert not np.allclose(weights.mix, L.Weights.even().mix)
    follows = counted(train)
    got = L.score_streams(other, known, weights)
    want = [plain_log2(s, follows, weights, L.RATE) for s in other]
    assert got == pytest.approx(want, rel=2e-3, abs=0.05)


def test_fitting_and_adapting_help(some):
    train, other = some[:100], some[100:]
    known = known_of(train)
    n = sum(len(s) + 1 for s in other)
    even = -L.score_streams(other, known, L.Weights.even()).sum() / n
    fitted = -L.score_streams(other, known, L.fit(train, known_of(train, 1))).sum() / n
    alone = -L.score_streams(other, L._known(L.Counts.of(*[np.zeros(0, np.uint64)] * 4)), L.Weights.even()).sum() / n
    assert fitted < even < alone < 8.01


def test_first_bytes_add_up_to_one(some):
    known = known_of(some[:50])
    weights = L.fit(some[:50], known_of(some[:50], 1))
    lead = np.full(L.LEAD, 255, dtype=np.uint8)
    block = L.Block.of([(i, np.append(lead, np.uint8(i))) for i in range(256)], known)
    assert np.exp2(L.mix(block, weights, L.RATE)).sum() == pytest.approx(1, abs=0.005)


def test_pieces_are_the_whole(some, monkeypatch):
    long = b" ".join(some[:30])
    known = known_of(some[30:60])
    whole = L.score_streams([long, b"a"], known, L.Weights.even())
    monkeypatch.setattr(L, "PIECE", L.LANE)
    monkeypatch.setattr(L, "BLOCK_BYTES", 3000)
    assert L.score_streams([long, b"a"], known, L.Weights.even()) == pytest.approx(whole)
    again = known_of(some[30:60])
    assert np.array_equal(again.grams, known.grams) and np.array_equal(again.run, known.run)


def test_counts_are_packed_dealt_and_added_up(some):
    whole, parts = L.Tally(), [L.Tally() for _ in range(4)]
    for i, s in enumerate(some[:40]):
        train = i % 5 != 1
        whole.add(s.split(), train)
        parts[i % 4].add(s.split(), train)
    whole = whole.counts()
    back = [[] for _ in parts]
    dealt = [dict(p.counts().buckets(7)) for p in parts]
    fresh = 0
    for b in range(7):
        found, new = L.add_up([L.Counts.unpacked(d[b].packed()) for d in dealt])
        fresh += sum(new)
        for got, f in zip(back, found):
            got.append(f)
    assert fresh == (whole.c > 0).sum()
    total = dict(zip(whole.grams().tolist(), whole.n.tolist()))
    words = dict(zip(whole.word.tolist(), whole.c.tolist()))
    for p, got in zip(parts, map(L.Counts.joined, back)):
        own = p.counts()
        assert np.array_equal(got.ctx, own.ctx) and np.array_equal(got.word, own.word)
        assert dict(zip(got.word.tolist(), got.c.tolist())) == {w: words[w] for w in own.word.tolist()}
        here = set(own.ctx.tolist())
        assert dict(zip(got.grams().tolist(), got.n.tolist())) == {g: n for g, n in total.items() if g >> 8 in here}


def test_query_against_plain_counts(spark):
    rows = duck(SF_SMALL).execute("select doc_id, text from documents").fetchall()
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in rows}
    tokens = {i: [*L.words_of(t), None] for i, t in rows}
    count = Counter(w for i, ws in tokens.items() if not held[i] for w in ws)
    n, v = sum(count.values()), len(count)
    got = Q.QUERIES["op13_lm_score"](spark, SF_SMALL).collect()
    assert len(got) == len(rows)
    for r in got:
        ws = tokens[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[r.doc_id], len(ws), sum(count[w] > 0 for w in ws), n)
        assert r.base_score == pytest.approx(sum(math.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws), rel=1e-9)
    # on 2 MB of text the words' counts are about as good; from 30 MB on the mixed model needs 5 % fewer bits
    assert sum(r.score for r in got if r.held_out) > 1.01 * sum(r.base_score for r in got if r.held_out)
    assert all(0 < r.bits_per_byte < 9 for r in got)


MESSY = [(1, "The cat sat. " * 30, True), (2, None, True), (3, "", False), (None, "the CAT sat", False), (4, "\x00 é 漢字 \r\n\x0b x", False),
         (4, "\x00 é 漢字 \r\n\x0b x", True), (5, "w" * 300_000, False), (6, " \t\n", None), (7, "the cat sat " * 30_000, False)]


def test_edges_and_parts(spark):
    df = spark.createDataFrame(MESSY, "doc_id long, text string, learn boolean").withColumns({c: F.lit(1) for c in ("id", "train", "part", "n", "word")})
    one = L.score_texts(df.coalesce(1), F.col("learn")).collect()
    many = L.score_texts(df.repartition(5), F.col("learn"), part_bytes=50, bucket_bytes=100_000).collect()
    key = lambda r: (str(r.id), r.n_tokens, r.n_known, r.train_tokens, str(r.train))
    assert sorted(map(key, one)) == sorted(map(key, many)) and len(one) == len(MESSY)
    for a, b in zip(sorted(one, key=key), sorted(many, key=key)):
        assert (a.base_score, a.score) == pytest.approx((b.base_score, b.score), rel=1e-3, abs=1e-6)
    of = {(r.id, r.train): r for r in one}
    assert of[2, True].n_tokens == of[3, False].n_tokens == of[6, False].n_tokens == 1 and of[2, True].score == of[3, False].score < 0
    assert of[7, False].n_tokens == 90_001 and of[7, False].n_known == 60_001  # cat, the; "sat" only with a full stop
    assert L.score_texts(df.limit(0), F.col("learn")).collect() == []


def test_nothing_to_learn_from(spark):
    df = spark.createDataFrame([(1, "ab")], "doc_id long, text string")
    r = L.score_texts(df, F.lit(False)).first()
    assert (r.n_tokens, r.n_known, r.train_tokens, r.base_score) == (2, 0, 0, 0.0)
    assert r.score == pytest.approx(-3 * 8 * math.log10(2), rel=0.02)


def test_weights_are_fitted_on_all_training_texts(spark, some, monkeypatch):
    """Long texts and every part count, however the texts are dealt out; the same as fitting them in one place."""
    found = []
    fitted = L._fitted
    monkeypatch.setattr(L, "_fitted", lambda *a: found.append(fitted(*a)) or found[-1])
    monkeypatch.setattr(L, "FIT_ROUNDS", 2)
    train = [s.decode() for s in some[:20]] + [" ".join(s.decode() for s in some[20:60])]  # the last over 64 KB
    assert len(train[-1]) > 1 << 16
    rows = [(i, t, True) for i, t in enumerate(train)] + [(100 + i, s.decode(), False) for i, s in enumerate(some[60:70])]
    df = spark.createDataFrame(rows, "doc_id long, text string, learn boolean")
    for d, part in ((df.coalesce(1), 32 << 20), (df.repartition(4), 20_000)):
        L.score_texts(d, F.col("learn"), part_bytes=part).count()
    streams = streams_of(train)
    want = L.fit(streams, known_of(streams, 1))
    for got in found:
        assert np.allclose(got.mix, want.mix, atol=1e-4) and np.allclose(got.bias, want.bias, atol=1e-4)
    less = L.fit(streams[:-1], known_of(streams, 1))
    assert not np.allclose(less.mix, want.mix, atol=1e-4)


def test_fit_weighs_every_bit_of_training_texts(some):
    """One pass gives the cells: each bit of each text is in one of them, and a text that stands there twice counts twice."""
    streams = some[:30] + some[:1] + [b""]
    known = known_of(streams, 1)
    cells = L.fit_cells(streams, known)
    assert cells.sums[0].sum() == 8 * sum(len(s) + 1 for s in streams)
    bits = np.unpackbits(np.frombuffer(L.END.join(streams) + L.END, dtype=np.uint8)).sum()
    assert cells.sums[0][(cells.cell >> 8 * len(L.ORDERS)) % 2 == 1].sum() == bits
    parts = [L.fit_cells(streams[i::3], known) for i in range(3)]
    again = L.Cells.joined(parts)
    assert np.array_equal(again.cell, cells.cell) and np.allclose(again.sums, cells.sums)
    code, n = L.code_counts([p for s in streams for p in L.pieces(s)])
    seen = Counter((L.END * L.LEAD + s + L.END)[i:i + L.LEAD + 1] for s in streams for i in range(len(s) + 1))
    assert dict(zip(code.tolist(), n.tolist())) == {int.from_bytes(k, "big"): c for k, c in seen.items()}


def test_words_are_known_by_keys_worked_out_together(some, monkeypatch):
    """Equal words have equal keys and others don't, whatever their length; only long words are hashed one by one."""
    long = []
    digest = L.xxhash.xxh64_intdigest
    monkeypatch.setattr(L.xxhash, "xxh64_intdigest", lambda w: long.append(bytes(w)) or digest(w))
    odd = [b"a" * n for n in range(1, 80)] + [b"a\x00", b"\x00a", b"\x00", b"\x00\x00", "é漢字".encode(), b"z" * 63 + b"y", b"z" * 64]
    streams = [b" ".join(odd), b"", b"a", *some[:20], b" ".join(reversed(odd)), b""]
    key, n = L.token_keys(streams)
    tokens = [w for s in streams for w in [*s.split(), b""]]
    assert n.tolist() == [len(s.split()) + 1 for s in streams]
    assert len(key) == len(tokens) and len(set(zip(key.tolist(), tokens))) == len(set(key.tolist())) == len(set(tokens))
    assert sorted(long) == sorted(w for w in tokens if len(w) > L.SHORT)
    of = dict(zip(tokens, key.tolist()))
    t = L.Tally()
    for i, s in enumerate(streams):
        assert t.add(s.split(), i % 2 == 0) == s
    train = Counter(w for s in streams[::2] for w in [*s.split(), b""])
    assert len(long) == 2 * sum(len(w) > L.SHORT for w in tokens[:tokens.index(b"")]) and not t.words
    got = t.counts()
    assert dict(zip(got.word.tolist(), got.c.tolist())) == {of[w]: train[w] for w in set(tokens)}


def test_predictions_are_worked_out_once_for_each_gram(some):
    for less in (0, 1):
        known = known_of(some[:40], less)
        assert len(known.grams) > 20_000  # some stretches of whole contexts
        stretch, met = L.stretch_table(known.grams, known.grams, known.run, less)
        assert np.allclose(known.stretch, stretch, rtol=1e-6, atol=1e-6) and np.array_equal(known.met, met)
    known = known_of(some[:40])
    block = L.Block.of([(0, p) for s in some[30:60] for p in L.pieces(s)], known)
    code = L.codes(np.concatenate([p for s in some[30:60] for p in L.pieces(s)]))
    code = code[np.sort(np.unique(code, return_index=True)[1])]  # as they come first
    assert len(block.stretch[0]) < len(block.gate) / 5 and len(block.gate) >= len(code)
    for row, table, place in zip(L.grams(code), block.stretch, block.places):
        got = (table if place is None else table[place])[:len(code)]
        assert np.allclose(got, L.SIGNS[code & np.uint64(255)] * L.stretch_table(row, known.grams, known.run)[0], rtol=1e-6, atol=1e-6)
