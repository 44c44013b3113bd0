"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing column names, for each operator."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from clipstat.llm import language_kn, pii_feistel, quality_qda, sentencepiece_unigram
from clipstat.llm.exact_fuse import BinaryFuse, exact_dedup
from clipstat.llm.line_templates import dedup_lines, recurring_lines
from clipstat.llm.pivot_index import link_vectors
from clipstat.llm.simhash_bk import BKForest, near_links, one_of_each, simhash_groups
from clipstat.llm.source_mix import mix, mixed_documents, plan_targets
from clipstat.llm.substring_sam import SuffixAutomaton, dedup_passages

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"w{i * 7919 % 5003}" for i in range(60_000))
WORDS = "the quick brown fox jumps over the lazy dog near the river bank while many people watch from the old bridge"
MESSY = [
    (1, WORDS, "en", "a", 1), (2, WORDS, "en", "a", 2), (3, None, None, None, None), (4, "", "en", "b", 0),
    (5, "  \n\t ", None, "b", 5), (6, LONG, "en", None, 6), (7, "x", "fr", "c", 1), (7, "x", "fr", "c", 1),
    (None, WORDS, "en", "a", 3), (None, "y", None, None, None), (8, "été déjà vu à la plage où l'eau est bleue", "fr", "c", 9),
    (9, "12345 ... !!!", None, "c", 3), (10, "\x00\x01 é\n\nline\r\nline", "en", "d", 4),
]
CLASH = ["id", "text_of_row", "kept_id", "row_of_id", "pii_hits", "ids", "size", "dropped_lines", "n_lines", "_source", "key", "a.b", "fp", "low"]


@pytest.fixture(scope="module")
def messy(spark):
    return spark.createDataFrame(MESSY, SCHEMA)


@pytest.fixture(scope="module")
def clash(messy):
    for i, c in enumerate(CLASH):
        messy = messy.withColumn(c, F.lit(i))
    return messy


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def by(rows, *cols):
    return sorted((tuple(r[c] for c in cols) for r in rows), key=repr)


# --- 1 ----------------------------------------------------------------------

def test_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 2), (4, [1.0, 0.0], None), (5, None, 1), (6, [0.0, 0.0], 1),
            (7, [nan, 1.0], 1), (8, [inf, 1.0], 1), (9, [None, 1.0], 1), (10, [], 1), (None, [1.0, 0.0], 1), (11, [1.0, 0.0, 0.0], 1),
            (12, [1.0, 0.0], 1), (13, [0.93, (1 - 0.93**2) ** 0.5], 1), (14, [0.0, 1.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r.id: r for r in link_vectors(df).collect()}
    assert len(got) == len(rows)
    assert {i: got[i].n_links for i in (1, 2, 12, 13)} == {1: 3, 2: 3, 12: 3, 13: 3}
    assert {got[i].component_id for i in (1, 2, 12, 13)} == {1} and got[1].kept and not got[2].kept
    for i in (3, 4, 5, 6, 7, 8, 9, 10, 11, 14, None):
        assert got[i].n_links == 0 and got[i].component_id == i and got[i].kept
    twice = link_vectors(df.union(df).withColumn("pivot", F.lit(1)).withColumn("node", F.lit(1))).collect()
    assert len(twice) == 2 * len(rows)
    assert link_vectors(df.limit(0)).collect() == []


# --- 2 ----------------------------------------------------------------------

def test_quality(spark, clash, empty):
    labels = spark.createDataFrame([(1, 1), (2, 1), (6, 0), (7, 0), (8, 1), (99, 1), (4, None), (None, 1)], "doc_id long, quality int")
    got = quality_qda.quality(clash, labels).collect()
    assert len(got) == len(MESSY) and all(0 <= r.score <= 1 for r in got)
    none = quality_qda.quality(clash, labels.limit(0)).collect()
    assert len(none) == len(MESSY) and {r.score for r in none} == {0.5}
    one = quality_qda.quality(clash, labels.where("quality = 1")).collect()
    assert all(0 <= r.score <= 1 for r in one)
    assert quality_qda.quality(empty, labels).collect() == []
    assert quality_qda.statistics(None) == quality_qda.statistics("")


def test_discriminant_is_the_gaussian_log_ratio(spark):
    rng = np.random.default_rng(0)
    d = len(quality_qda.FEATURES)
    x = np.concatenate([rng.normal(0, 1, (300, d)), rng.normal(1.0, 2, (300, d))])
    y = [0] * 300 + [1] * 300
    rows = spark.createDataFrame([(v.tolist(), k) for v, k in zip(x, y)], "x array<double>, y int")
    m = quality_qda.fit(rows, to_pooled=0.0, to_identity=0.0)
    want = []
    for k in (0, 1):
        own = (x[np.array(y) == k] - m.centre) / m.scale
        cov = np.cov(own.T, bias=True)
        z = (x - m.centre) / m.scale - own.mean(0)
        want.append(-0.5 * np.einsum("ij,jk,ik->i", z, np.linalg.inv(cov), z) - 0.5 * np.linalg.slogdet(cov)[1])
    assert np.allclose(m.log_ratio(x), want[1] - want[0], atol=1e-6)


# --- 3 ----------------------------------------------------------------------

@pytest.mark.parametrize("n", [0, 1, 2, 3, 10, 1000, 50_000])
def test_binary_fuse(n):
    rng = np.random.default_rng(n)
    keys = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
    f = BinaryFuse.build(keys)
    assert f.has(keys).all()
    other = np.setdiff1d(rng.integers(0, 1 << 63, 50_000, dtype=np.uint64), keys)
    assert f.has(other).mean() < 0.01
    if n == 50_000:
        assert len(f.table) < 1.35 * n


def exact_want(rows):
    groups: dict = {}
    for i, t, *_ in rows:
        groups.setdefault(t or "", []).append(i)
    out = []
    for g in groups.values():
        keep = max((i for i in g if i is not None), default=None)
        out += [(i, keep, len(g)) for i in g]
    return sorted(out, key=repr)


def test_exact(clash, empty):
    got = exact_dedup(clash).collect()
    assert by(got, "id", "keep_id", "group_size") == exact_want(MESSY)
    assert sorted(r.id for r in got if r.kept and r.id is not None) == sorted({k for _, k, _ in exact_want(MESSY) if k is not None})
    assert sum(r.kept for r in got if r.id == 7) == 1
    assert exact_dedup(empty).collect() == []


def test_exact_survives_clashing_digests(spark):
    rows = [(i, f"text {i % 7}") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    weak = exact_dedup(df, digest=lambda t: F.encode(F.length(t).cast("string"), "utf-8"), shard_keys=1).collect()
    assert by(weak, "id", "keep_id", "group_size") == exact_want(rows)


# --- 4 ----------------------------------------------------------------------

def test_simhash(clash, empty):
    got = simhash_groups(clash).collect()
    assert len(got) == len(MESSY)
    zero = [r for r in got if r.fp == 0]
    assert {r.id for r in zero} == {3, 4, 5} and {r.component_id for r in zero} == {3}
    same = [r for r in got if r.id in (1, 2)]
    assert {r.component_id for r in same} == {1}
    kept = one_of_each(clash, simhash_groups(clash, text_key=True))
    assert kept.columns == clash.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted({r.component_id for r in got if r.id is not None})
    assert simhash_groups(empty).collect() == [] and one_of_each(empty, simhash_groups(empty, text_key=True)).collect() == []


def test_bk_forest_finds_every_pair():
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    fps = np.unique(np.concatenate([base, *(base ^ np.uint64(1 << int(b)) ^ np.uint64(1 << int(c)) for b, c in rng.integers(0, 63, (30, 2)))]))
    rng.shuffle(fps)
    starts = np.array([0, 100, 101, 400])
    f = BKForest(fps, starts)
    q, n = f.search(np.arange(len(fps)), 4)
    group = np.searchsorted(starts, np.arange(len(fps)), side="right")
    near = (np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 4) & (group[:, None] == group[None, :])
    np.fill_diagonal(near, False)
    assert set(zip(q.tolist(), n.tolist())) == set(zip(*(x.tolist() for x in np.nonzero(near))))


def test_near_links_in_tiles_join_the_same(spark):
    rng = np.random.default_rng(6)
    base = int(rng.integers(0, 1 << 62))
    fps = {base}
    while len(fps) < 300:  # a chain: neighbours differ in up to 4 bits, ends in many
        x = base
        for b in rng.integers(0, 62, int(rng.integers(1, 5))):
            x ^= 1 << int(b)
        fps.add(x)
        base = x
    df = spark.createDataFrame([(x,) for x in fps], "fp long")
    for tile in (7, 1024):
        near: dict = {x: x for x in fps}

        def find(x):
            while near[x] != x:
                x = near[x]
            return x

        for r in near_links(df, tile=tile).collect():
            near[max(find(r.a), find(r.b))] = min(find(r.a), find(r.b))
        assert len({find(x) for x in fps}) == 1


# --- 5 ----------------------------------------------------------------------

def test_lines(spark, clash, empty):
    got = dedup_lines(clash).collect()
    assert len(got) == len(MESSY) and sum(r.doc_id is None for r in got) == 2
    assert next(r for r in got if r.doc_id == 3).text is None
    rows = [(i, f"User {i} logged in from host alpha\nown line {'abcdefgh'[i % 8] * 3} of document\n\nSame for all") for i in range(6)]
    df = spark.createDataFrame([*rows, (None, "Same for all"), (2, rows[2][1])], "doc_id long, text string")
    out = {r.doc_id: r for r in dedup_lines(df).collect()}
    assert out[0].text == rows[0][1] and out[0].n_dropped == 0
    assert out[4].text == "own line eee of document\n" and (out[4].n_lines, out[4].n_dropped) == (3, 2)
    assert out[None].text == "Same for all"
    _, t = recurring_lines(df.selectExpr("doc_id as id", "text").where("id is not null"), part_lines=1)
    assert ("User <*> logged in from host alpha", 6, 0) in by(t.collect(), "text", "n_docs", "first_id")
    assert dedup_lines(empty).collect() == []
    assert dedup_lines(clash).columns[: len(clash.columns)] == clash.columns


def test_a_hot_leaf_is_clustered_alike_in_any_tiles(spark):
    """Distinct lines with a common head, against all pairs."""
    rng = np.random.default_rng(4)
    lines = sorted({" ".join(["all", "start", "alike", *("abcdefghijkl"[x] * 2 for x in rng.integers(0, 12, 2)), *("xyz"[x] for x in rng.integers(0, 3, 5))])
                    for _ in range(600)})
    words = np.array([x.split() for x in lines])
    near = (words[:, None, :] == words[None, :, :]).sum(axis=2) >= 8
    lab = np.arange(len(lines))
    for _ in lines:
        new = np.where(near, lab[None, :], len(lines)).min(axis=1)
        if (new == lab).all():
            break
        lab = new
    docs = spark.createDataFrame(list(enumerate(lines)), "id long, text string")
    want = sorted((int(n), int(i)) for i, n in zip(*np.unique(lab, return_counts=True)) if n >= 3)
    assert len(want) > 1 or want[0][0] > 100
    for part_lines in (50, 5000):
        drop, found = recurring_lines(docs, part_lines=part_lines)
        assert by(found.collect(), "n_docs", "first_id") == sorted(want, key=repr)
        assert drop.count() == sum(n - 1 for n, _ in want)


def test_rows_of_numbers_are_no_template(spark):
    """Lines with few constant tokens recur literally or stay."""
    rows = [(i, f"{i}.5 13.{i} 14.8\nid{i}\nTotal {i} of 9{i}\n1 2 3\nrun {i} of {i} took {i} ms {i} {i}") for i in range(5)]
    got = dedup_lines(spark.createDataFrame([*rows, (9, "job number 5 ended well today"), (10, "job number 6 ended well today"),
                                             (11, "job number 7 ended well today")], "doc_id long, text string")).collect()
    out = {r.doc_id: r for r in got}
    assert out[0].n_dropped == 0 and all(out[i].text == rows[i][1].replace("1 2 3\n", "") for i in range(1, 5))
    assert [out[i].n_dropped for i in (9, 10, 11)] == [0, 1, 1]


# --- 6 ----------------------------------------------------------------------

def passages_want(rows, window=13):
    first: dict = {}
    split = [(i, (t or "").encode().split()) for i, t, *_ in rows]
    for i, w in split:
        for k in range(len(w) - window + 1):
            s = tuple(w[k:k + window])
            if i is not None:
                first[s] = min(first.get(s, i), i)
    out = []
    for i, w in split:
        gone = set()
        for k in range(len(w) - window + 1):
            if i is not None and first[tuple(w[k:k + window])] < i:
                gone.update(range(k, k + window))
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone).decode()
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("hot", [1000, 2])
def test_passages(spark, clash, empty, hot):
    got = dedup_passages(clash, hot_docs=hot).withColumn("sha", F.sha2("kept", 256)).collect()
    assert by(got, "id", "n_words", "n_removed", "sha") == passages_want(MESSY)
    rng = np.random.default_rng(hot)
    rows = []
    for i in range(120):  # few words, so that passages overlap in many ways
        w = [f"t{x}" for x in rng.integers(0, 3, int(rng.integers(0, 60)))]
        if i % 3 == 0:
            w[5:5] = [f"p{k}" for k in range(20)]
        rows.append((int(rng.integers(0, 80)), "  ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = dedup_passages(df, hot_docs=hot, window=7, gram=3).withColumn("sha", F.sha2("kept", 256)).collect()
    assert by(got, "id", "n_words", "n_removed", "sha") == passages_want(rows, 7)
    assert dedup_passages(empty).collect() == []


def test_automaton_knows_first_documents():
    rng = np.random.default_rng(2)
    lists = [(int(rng.integers(0, 50)), rng.integers(0, 3, int(rng.integers(1, 40))).tolist()) for _ in range(30)]
    a = SuffixAutomaton.of(lists)
    for words in [*(x for _, x in lists), rng.integers(0, 4, 60).tolist()]:
        want = [min((i for i, x in lists if any(x[k:k + 5] == words[j:j + 5] for k in range(len(x) - 4))), default=None) for j in range(len(words) - 4)]
        assert a.first_ids(words, 5) == want


# --- 7 ----------------------------------------------------------------------

def test_coding(clash, empty):
    p = sentencepiece_unigram.load_pieces()
    coded = sentencepiece_unigram.encode(clash, p)
    assert [c for c in clash.columns if c != "ids"] + ["ids"] == coded.columns
    assert all(r.same for r in sentencepiece_unigram.encode(clash, p, check_col="same").collect())
    for r in sentencepiece_unigram.decode(coded, p).collect():
        assert r.decoded == r.text
        assert (r.ids is None) == (r.text is None) and (r.text != "" or r.ids == [])
    assert sentencepiece_unigram.encode(empty, p).collect() == []


# --- 8 ----------------------------------------------------------------------

def test_pseudonyms(spark, clash, empty):
    got = pii_feistel.pseudonymise(clash, key="clipstat")
    assert got.columns == [*clash.columns, "pii_kinds"]
    assert by(got.collect(), "doc_id", "text") == by(clash.collect(), "doc_id", "text")
    text = ["card 4111 1111 1111 1111 or 4111111111111111, not 4111111111111112", "123-45-6789 and 000-45-6789, 900-12-3456",
            "2024-02-29 or 29.02.2024, not 2023-02-30; 1.2.3.4 not 256.1.1.1 nor 4.0.", "a.b+c9@mail.example.com A@b.c", "+1 (988) 555-2485"]
    rows = pii_feistel.pseudonymise(spark.createDataFrame([(t,) for t in text], "text string"), key="clipstat").collect()
    assert [r.pii_kinds for r in rows] == [["card"] * 2, ["ssn"], ["date", "date", "ipv4"], ["email"] * 2, ["phone"]]
    a, b = rows[0].text[5:24], rows[0].text[28:44]
    assert a.replace(" ", "") == b and b != "4111111111111111" and rows[0].text.endswith("not 4111111111111112")
    y, d = rows[2].text[:10], rows[2].text[14:24]
    assert d == f"{y[8:]}.{y[5:7]}.{y[:4]}" and y != "2024-02-29"
    other = pii_feistel.pseudonymise(spark.createDataFrame([(text[0],)], "text string"), key="another").first().text
    assert other != rows[0].text
    assert pii_feistel.pseudonymise(empty, key="clipstat").collect() == []


def test_addresses_of_single_digits_alone(spark):
    """No two digits stand side by side in the text."""
    text = "dns 8.8.8.8 or 1.1.1.1 ok"
    r = pii_feistel.pseudonymise(spark.createDataFrame([(text,)], "text string"), key="clipstat").first()
    assert r.pii_kinds == ["ipv4", "ipv4"] and "8.8.8.8" not in r.text and "1.1.1.1" not in r.text


def test_cards_beside_other_numbers(spark):
    """The card goes, its neighbour stays, and the card has the same pseudonym everywhere."""
    shapes = ["{} 123", "no 7 {}", "{} 12/25", "0001 {}", "2024 {} 77", "{} 2024-02-29", "{}-9"]
    for card in ("4111111111111111", "4111 1111 1111 1111", "3782 822463 10005", "6304000000000001000", "6304 0000 0000 0001 000"):
        digits = card.replace(" ", "")
        assert luhn(digits) or digits.startswith("6304")
        if not luhn(digits):
            digits = next(digits[:-1] + c for c in "0123456789" if luhn(digits[:-1] + c))
            card = digits if " " not in card else " ".join([digits[i:i + 4] for i in range(0, 19, 4)])
        rows = pii_feistel.pseudonymise(spark.createDataFrame([(s.format(card),) for s in [*shapes, "{}"]], "text string"), key="clipstat").collect()
        new = rows[-1].text
        assert luhn(new.replace(" ", "")) and new != card and rows[-1].pii_kinds == ["card"]
        for s, r in zip(shapes, rows):
            if "2024-02-29" in s:
                assert r.text.startswith(new + " ") and r.pii_kinds == ["card", "date"]
            else:
                assert r.text == s.format(new) and r.pii_kinds == ["card"]
    two = pii_feistel.pseudonymise(spark.createDataFrame([("4111 1111 1111 1111 5500 0000 0000 0004 1",)], "text string"), key="clipstat").first()
    assert two.pii_kinds == ["card", "card"] and two.text.endswith(" 1")
    long = "1 " * 5000 + "4111111111111111" + " 12" * 5000
    r = pii_feistel.pseudonymise(spark.createDataFrame([(long,)], "text string"), key="clipstat").first()
    assert r.pii_kinds == ["card"] and r.text[:10_000] == long[:10_000] and r.text[10_016:] == long[10_016:]


def luhn(d):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def test_more_forms_of_phones_and_dates(spark):
    phones = ["555 123 4567", "1-800-555-1234", "(555)-123-4567", "1 (555) 123-4567", "555-123-4567"]
    dates = ["3/4/2024", "12-05-2023", "3-4-2024", "03/04/2024"]
    rows = pii_feistel.pseudonymise(spark.createDataFrame([(f"x {t}, y",) for t in phones + dates], "text string"), key="clipstat").collect()
    assert [r.pii_kinds for r in rows] == [["phone"]] * 5 + [["date"]] * 4
    assert all(t not in r.text for t, r in zip(phones + dates, rows))
    plain = lambda r: [int(x) for x in r.text[2:-3].replace("-", "/").split("/")]
    assert plain(rows[5]) == plain(rows[7]) == plain(rows[8])


def test_feistel_is_a_permutation(spark):
    pairs = spark.range(15 * 7).select((F.col("id") % 15).alias("x"), F.floor(F.col("id") / 15).alias("y"))
    got = pairs.select(pii_feistel.permute_pair(F.col("x"), F.col("y"), F.lit(15), F.lit(7), F.lit("t"), "k").alias("p")).collect()
    assert len({(r.p.x, r.p.y) for r in got}) == 105 and all(0 <= r.p.x < 15 and 0 <= r.p.y < 7 for r in got)
    digits = spark.range(1000).select(pii_feistel.permute_digits(F.lpad(F.col("id").cast("string"), 3, "0"), "t", "k").alias("d")).collect()
    assert len({r.d for r in digits}) == 1000


# --- 9 ----------------------------------------------------------------------

def test_language(clash, empty):
    model = language_kn.fit(clash)
    assert model.languages == ["en", "fr"]
    got = language_kn.identify(clash, model).collect()
    assert len(got) == len(MESSY)
    for r in got:
        none = not any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == none and (not none or (r.lang_score == 0 and r.lang_rejected))
    blank = language_kn.fit(empty)
    assert {r.lang_pred for r in language_kn.identify(clash, blank).collect()} == {"und"}
    assert language_kn.identify(empty, model).collect() == []


def test_every_labelled_language_is_learned(spark):
    """Languages of one document, and of two that are each longer than the sample."""
    rng = np.random.default_rng(9)
    said = lambda k, n: " ".join("".join(chr(97 + (3 * k + int(x)) % 26) for x in w) for w in rng.integers(0, 6, (n, 5)))
    rows = [(k, said(k, 40), f"one{k:02}") for k in range(16)]
    rows += [(100 + 10 * k + i, said(20 + k, 20_000), f"two{k}") for k in range(4) for i in range(2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_kn.fit(docs, train_chars=24_000)
    assert model.languages == sorted({r[2] for r in rows})
    got = language_kn.identify(docs, model).collect()
    assert not any(r.lang_rejected for r in got)


def test_kneser_ney_sums_to_one():
    """Over all characters, the probabilities after any seen context add up to one, the unseen character included."""
    texts = ["abracadabra abba", "cab bad dab"]
    g = language_kn.grams(texts, 3)
    top, first, n = np.unique(g.hashes[2][g.at], return_index=True, return_counts=True)
    at = g.at[first]
    chain = [g.hashes[2][at], g.hashes[1][at], g.hashes[1][at + 1], g.hashes[0][at + 1], g.hashes[0][at + 2], np.zeros(len(at), np.uint64)]
    m = language_kn.build_model(3, ["x"], np.zeros(len(at), np.int64), chain, n.astype(float))
    seen = sorted(set("".join(texts)))
    for context in ("ab", "ra", "zz", "da"):
        total = 0.0
        for c in seen:
            h = language_kn.grams([context + c], 3)
            k = h.at[2]  # two pads come first
            total += float(np.exp(m.log_probs(h, np.array([k]))[0, 0]))
        h = language_kn.grams([context + "q"], 3)
        unseen = float(np.exp(m.log_probs(h, np.array([h.at[2]]))[0, 0]))
        assert abs(total + unseen * (2 * len(seen) + 1 - len(seen)) - 1) < 1e-4


# --- 10 ---------------------------------------------------------------------

def test_mix(clash, empty):
    m = mix(clash)
    got = m.taken.collect()
    assert len(got) == len(MESSY)
    assert all(0 <= r.taken <= 2 * r["size"] for r in got)
    quota = {r.source: r.quota for r in m.plan.collect()}
    took: dict = {}
    for r in got:
        took[r["_source"]] = took.get(r["_source"], 0) + r.taken
    assert took == quota
    again = mix(clash.repartition(5)).taken.collect()
    assert by(got, "_id", "size", "taken") == by(again, "_id", "size", "taken")
    rows = mixed_documents(clash, m)
    assert rows.columns == clash.columns
    assert sum(len((r.text or "").split()) for r in rows.collect()) == sum(quota.values())
    assert mix(empty).taken.collect() == [] and mixed_documents(empty, mix(empty)).collect() == []


def test_targets_fill_up_by_weight(spark):
    sizes = [("a", 10), ("b", 1000), ("c", 1000), ("d", 30), (None, 5), ("e", 0)]
    got = {r.source: r for r in plan_targets(spark.createDataFrame(sizes, "source string, source_size long")).collect()}
    cap, weight = {s: 2.0 * n for s, n in sizes}, {"a": 5, "b": 2, "c": 1, "d": 5, "e": 2, None: 1}
    want, left, open_ = {}, 1.5 * sum(n for _, n in sizes), set(cap)
    while True:  # share by weight, stop at the cap, share the rest again
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] >= cap[s]}
        if not full:
            break
        want.update({s: cap[s] for s in full})
        left -= sum(cap[s] for s in full)
        open_ -= full
    want.update({s: level * weight[s] for s in open_})
    assert all(abs(got[s].target - want[s]) < 1e-9 for s in want)


# --- the pipeline -----------------------------------------------------------

def test_pipeline_stages_on_messy_and_empty(messy, empty):
    for docs in (messy, empty):
        for name, stage in corpus_pipeline.STAGES:
            docs = stage(docs.sparkSession, docs, "")
            docs.collect()


@pytest.mark.parametrize("shape", ["a@" + "b." * 500_000 + "com", "1 " * 20_000, "7" * 1_000_000, "b." * 500_000, "+1 22 " * 20_000, "a.b@c-" * 150_000,
                                   "12/12/" * 150_000, "1.1.1." * 150_000])
def test_pii_survives_long_repeats(spark, shape):
    got = pii_feistel.pseudonymise(spark.createDataFrame([(shape + " 123-45-6789",)], "text string"), key="k").first()
    assert got.pii_kinds[-1:] == ["ssn"] and len(got.text) == len(shape) + 12


def test_exact_dedup_of_text_ids_and_outliers(spark):
    rows = [(f"id{i}", f"t{i % 7}") for i in range(50)] + [(None, "t1")]
    got = {(r.id, r.keep_id, r.group_size) for r in exact_dedup(spark.createDataFrame(rows, "doc_id string, text string")).collect()}
    for i, t in rows:
        same = [j for j, u in rows if u == t and j]
        assert (i, max(same), len(same) + (t == "t1")) in got
    far = spark.range(300).selectExpr("if(id = 0, -1000000000000L, id) AS doc_id", "concat('t', id) AS text")
    assert exact_dedup(far, shard_keys=50).where("kept").count() == 300


def test_one_of_each_keeps_a_row_for_every_group(spark):
    rows = [(1, "alpha beta gamma delta " * 9), (1, "one two three four " * 9), (2, "one two three four " * 9), (2, "one two three four " * 9), (None, "x y")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = one_of_each(df, simhash_groups(df, text_key=True)).collect()
    assert sorted(map(tuple, kept), key=str) == sorted([rows[0], rows[1], rows[4]], key=str)
