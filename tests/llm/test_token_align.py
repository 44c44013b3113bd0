"""Cross-tokenizer alignment against a plain two-pointer version over the libraries' own encodings."""

import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from clipstat.llm import queries as Q
from clipstat.llm.token_align import BYTE_MODEL, PIECE_MODEL, align_tokens, load_tokenizers
from tests.conftest import SF_SMALL
from tests.oracle_harness import duck

COLS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(BYTE_MODEL)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)


def plain(libraries, texts):
    """{row: measures} by one text at a time, one token at a time."""
    a_lib, b_lib = libraries
    byte = {chr(b): b for b in [*range(33, 127), *range(161, 173), *range(174, 256)]}
    byte |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if chr(b) not in byte)}
    per_text, count = [], Counter()
    for text in texts:
        links, groups = [], []
        a = a_lib.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_lib.encode(text) if text else []
        spell_a = [bytes(byte[c] for c in a_lib.id_to_token(i)) for i in a]
        spell_b = [bytes([int(b_lib.id_to_piece(i)[3:5], 16)]) if b_lib.is_byte(i) else b_lib.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if not text or b"".join(spell_a) != (" " + text).encode() or b"".join(spell_b) != (" " + text).encode():
            a, b = [], []
        i = j = pa = pb = 0
        left, right = [], []
        while i < len(a):
            ea, eb = pa + len(spell_a[i]), pb + len(spell_b[j])
            links.append((a[i], b[j]))
            if ea <= eb:
                left.append(a[i])
                i, pa = i + 1, ea
            if eb <= ea:
                right.append(b[j])
                j, pb = j + 1, eb
            if ea == eb:
                groups.append(",".join(map(str, left)) + "|" + ",".join(map(str, right)))
                left, right = [], []
        count.update(links)
        per_text.append((len(a), len(b), len(groups), links, ";".join(groups)))
    top = {}
    for (_, b), n in count.items():
        top[b] = max(n, top.get(b, 0))
    return [(na, nb, ng, len(ln), sum(count[x] == top[x[1]] for x in ln), sum(count[x] for x in ln), g) for na, nb, ng, ln, g in per_text]


def test_query_against_plain_version(spark, libraries):
    rows = duck(SF_SMALL).execute("select doc_id, text from documents").fetchall()
    want = Counter()
    for (i, _), (*n, g) in zip(rows, plain(libraries, [t for _, t in rows])):
        want[(i, *n, hashlib.sha256(g.encode()).hexdigest() if g else "")] += 1
    got = Q.QUERIES["op11_token_align"](spark, SF_SMALL)
    assert Counter(tuple(r) for r in got.select("doc_id", *COLS[:-1], "groups_sha256").collect()) == want


def test_edges_and_parts(spark, libraries):
    texts = [None, "", " ", "a", "<|endoftext|> and </s> are plain <0x41>", "a ▁ marker", "été \U0001f600 漢字 \x00 \r\n\t", "x" * 5000,
             "word " * 3000, "same text", "same text", "same text", "ᄀ  é"]
    df = spark.createDataFrame([(k if k % 4 else None, t, k) for k, t in enumerate(texts)], "doc_id long, text string, groups long")
    df = df.withColumns({c: F.lit(1) for c in ("key", "id", "n_a", "rest_key", "copies")})
    want = Counter((k if k % 4 else None, *m) for k, m in enumerate(plain(libraries, [t or "" for t in texts])))
    for part_links in (100, 4_000_000):  # many parts or one: the same counts
        got = align_tokens(df, part_links=part_links)
        assert Counter(tuple(r) for r in got.select("id", *COLS).collect()) == want
    assert want[(5, 0, 0, 0, 0, 0, 0, "")] == 1  # U+2581 isn't spelled back
    assert align_tokens(df.limit(0)).collect() == []


def test_stretches_of_a_long_text_are_the_whole(monkeypatch):
    import clipstat.llm.token_align as T

    t = load_tokenizers().ready()
    text = "Some plain words, don't cut  them 12 times; über x y z\n" * 400
    whole = t.encode(text)
    monkeypatch.setattr(T, "LONG_TEXT", 50)
    assert t.encode(text) == whole and len(whole[0]) > 1000


def test_hot_text(spark):
    df = spark.range(3000).selectExpr("id AS doc_id", "if(id % 3 = 0, 'hot text', concat('text ', id)) AS text")
    got = align_tokens(df)
    assert got.count() == 3000 and got.where("n_a = 2 and n_links = 2").count() >= 1000
    # the hot text's rows meet its result in a broadcast join, not by a shuffle on its key
    assert "BroadcastHashJoin" in got._jdf.queryExecution().executedPlan().toString()
