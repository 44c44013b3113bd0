"""Cross-tokenizer alignment: each distinct text is encoded by two tokenizers and its tokens are aligned by bytes.

Documents are shuffled by their full text, so that every distinct text is
tokenised and aligned once, however many copies it has.  Tokenizer A is a
byte-level BPE and gets a space and the text; B is a SentencePiece model that
adds that space itself.  Both spell the same bytes, so the places where tokens
end cut them into groups, and the pieces between any two ends are the links: the
pairs of an A and a B token whose bytes overlap.

What a pair counts in the whole corpus (its links, a text's weighted by the
copies) is asked for by part: texts are dealt into parts, a part names each of
its pairs once, the totals are joined to these names and go back to the part's
texts.  So neither the totals nor a text's pairs are broadcast or joined one by
one, and a hot pair has no more rows than there are parts.

Results are joined to the rows by the text's SHA-256.  The texts that make up
more than a thousandth of all rows each are at most a thousand, and their
results are broadcast, so that no task takes in the copies of a hot text.

Null and empty texts, and texts that a tokenizer doesn't spell back exactly,
have no tokens: zeros and an empty group string.  Every row comes back, repeated
ids too; an empty table gives an empty result.  A text of any length is encoded
whole: one over ``LONG_TEXT`` characters in stretches that both tokenizers would
cut apart anyway.  Columns other than the id and the text are not read.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipstat.llm.common import column, materialise, slices

BYTE_MODEL = "/opt/tokenizers/byte_bpe_50k.json"
PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: fixed value: how byte-level BPE of this kind cuts a text before it merges
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SPACE = "▁"
LONG_TEXT = 1 << 20
#: Neither tokenizer joins a letter to a space after it.
_CUT = re.compile(r"(?<=[A-Za-z]) (?=[A-Za-z])")
#: Links of a part: bounds what a task holds.
PART_LINKS = 4_000_000
#: A text with more than 1/HOT of all rows is hot, so fewer than HOT texts are.
HOT = 1000


def byte_alphabet() -> dict[str, int]:
    """The printable characters that byte-level vocabularies write for the 256 bytes."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAC + 1), *range(0xAE, 0xFF + 1)]
    table = {chr(b): b for b in plain}
    rest = [b for b in range(256) if chr(b) not in table]
    return table | {chr(256 + i): b for i, b in enumerate(rest)}


@dataclass
class Tokenizers:
    """The two vocabularies' files, sent to the tasks as they are (bounded by the files)."""

    byte_model: bytes
    piece_model: bytes

    def __post_init__(self):
        self._ready = False

    def __getstate__(self):
        return {"byte_model": self.byte_model, "piece_model": self.piece_model, "_ready": False}

    def ready(self) -> Tokenizers:
        """Build the encoders, once a worker."""
        if self._ready:
            return self
        import sentencepiece
        import tiktoken

        m = json.loads(self.byte_model)
        special = {t["content"] for t in m["added_tokens"]}
        byte = byte_alphabet()
        ranks = {bytes(map(byte.__getitem__, k)): i for k, i in m["model"]["vocab"].items() if k not in special}
        merged = [x if isinstance(x, str) else " ".join(x) for x in m["model"]["merges"]]
        if [m["model"]["vocab"][x.replace(" ", "")] for x in merged] != list(range(256, 256 + len(merged))):
            raise ValueError("the vocabulary isn't in the order of its merges")
        self.a = tiktoken.Encoding("byte_level", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})
        self.a_bytes = [b""] * (max(ranks.values()) + 1)
        for k, i in ranks.items():
            self.a_bytes[i] = k
        self.b = sentencepiece.SentencePieceProcessor(model_proto=self.piece_model)
        self.b_bytes = [bytes([int(self.b.id_to_piece(i)[1:-1], 16)]) if self.b.is_byte(i)
                        else b"" if self.b.is_control(i) or self.b.is_unknown(i)
                        else self.b.id_to_piece(i).replace(SPACE, " ").encode() for i in range(self.b.get_piece_size())]
        self.a_len = np.fromiter(map(len, self.a_bytes), dtype=np.int64)
        self.b_len = np.fromiter(map(len, self.b_bytes), dtype=np.int64)
        # decimal ids followed by what may stand after them
        self.a_text = np.array([f"{i}{s}" for s in ",|" for i in range(len(self.a_bytes))], dtype=object)
        self.b_text = np.array([f"{i}{s}" for s in ",;" for i in range(len(self.b_bytes))], dtype=object)
        self._ready = True
        return self

    def encode(self, text: str) -> tuple[list[int], list[int]]:
        """Ids by A and by B; none if the text is empty or either doesn't spell the space and the text."""
        if not text:
            return [], []
        if len(text) <= LONG_TEXT:
            stretches = [text]
        else:
            stretches, lo = [], 0
            while lo < len(text):
                cut = _CUT.search(text, lo + LONG_TEXT // 4)
                hi = cut.start() if cut else len(text)
                stretches.append(text[lo:hi])
                lo = hi + 1  # the space goes to the next stretch, whose encoders add it
        a = [i for s in stretches for i in self.a.encode_ordinary(" " + s)]
        b = [i for s in stretches for i in self.b.encode(s)]
        want = b" " + text.encode()
        if b"".join(map(self.a_bytes.__getitem__, a)) != want or b"".join(map(self.b_bytes.__getitem__, b)) != want:
            return [], []
        return a, b


def load_tokenizers(byte_model: str = BYTE_MODEL, piece_model: str = PIECE_MODEL) -> Tokenizers:
    with open(byte_model, "rb") as f, open(piece_model, "rb") as g:
        return Tokenizers(f.read(), g.read())


def align(t: Tokenizers, texts: list[str]) -> dict[str, list | np.ndarray]:
    """Counts, group strings and pair counts of each text; the texts lie end to end for the vector operations."""
    coded = [t.encode(x) for x in texts]
    n_a = np.array([len(a) for a, _ in coded], dtype=np.int64)
    n_b = np.array([len(b) for _, b in coded], dtype=np.int64)
    a = np.array([i for x, _ in coded for i in x], dtype=np.int64)
    b = np.array([i for _, x in coded for i in x], dtype=np.int64)
    end_a, end_b = np.cumsum(t.a_len[a]), np.cumsum(t.b_len[b])
    ends = np.union1d(end_a, end_b)
    of_a, of_b = np.searchsorted(end_a, ends), np.searchsorted(end_b, ends)
    both = ends[(end_a[of_a] == ends) & (end_b[of_b] == ends)] if len(ends) else ends
    first_a = np.concatenate([[0], np.cumsum(n_a)])  # the first token of each text
    text_of_a = np.repeat(np.arange(len(texts)), n_a)
    n_links = np.bincount(text_of_a[of_a], minlength=len(texts)) if len(ends) else np.zeros(len(texts), np.int64)
    n_groups = np.bincount(text_of_a[np.searchsorted(end_a, both)], minlength=len(texts)) if len(ends) else n_links

    # a group's A ids and then its B ids: each token moves by the other side's tokens before it
    group_a, group_b = np.searchsorted(both, end_a), np.searchsorted(both, end_b)
    at = np.empty(len(a) + len(b), dtype=object)
    before_b = np.searchsorted(group_b, np.arange(len(both) + 1))
    before_a = np.searchsorted(group_a, np.arange(len(both) + 1))
    last_a, last_b = (end_a == both[group_a], end_b == both[group_b]) if len(both) else (end_a > 0, end_b > 0)
    at[np.arange(len(a)) + before_b[group_a]] = t.a_text[a + last_a * len(t.a_bytes)]
    at[np.arange(len(b)) + before_a[group_b + 1]] = t.b_text[b + last_b * len(t.b_bytes)]
    cut = first_a + np.concatenate([[0], np.cumsum(n_b)])
    groups = ["".join(at[x:y].tolist())[:-1] for x, y in zip(cut, cut[1:])]

    # the pairs of a text, and how many links hold each
    width = len(t.a_bytes) * len(t.b_bytes)
    keyed = text_of_a[of_a] * width + a[of_a] * len(t.b_bytes) + b[of_b] if len(ends) else ends
    keyed, count = np.unique(keyed, return_counts=True)
    return {"n_a": n_a, "n_b": n_b, "n_groups": n_groups, "n_links": n_links, "groups": groups, "pairs": keyed % width,
            "counts": count, "ends": np.searchsorted(keyed, np.arange(len(texts) + 1) * width)}


MEASURES = "n_a long, n_b long, n_groups long, n_links long, groups string"
NUMBERS = ["n_a", "n_b", "n_groups", "n_links"]


def align_tokens(docs: DataFrame, tokenizers: Tokenizers | None = None, *, id_col: str = "doc_id", text_col: str = "text",
                 digest: bool = False, part_links: int = PART_LINKS) -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups) for every row of ``docs``.

    ``groups`` is ``a1,a2|b1;a3|b2,b3``: the ids of each group, A's and B's; with
    ``digest`` it is the SHA-256 of that (empty without tokens), taken in the
    task that aligns, so that the long string does not travel.  ``n_best``: links
    whose pair counts as much as any pair of their B id; ``count_sum``: the sum of
    the pairs' counts over the links.
    """
    spark = docs.sparkSession
    tokenizers = tokenizers or load_tokenizers()
    shared = spark.sparkContext.broadcast(tokenizers)
    n_pieces = len(tokenizers.ready().b_bytes)
    rows = docs.select(column(id_col).alias("id"), F.nullif(column(text_col).cast("string"), F.lit("")).alias("text"))
    texts = rows.where("text is not null").groupBy("text").agg(F.count("*").alias("copies"))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = shared.value.ready()
        for whole in batches:
            for lo, n in slices(whole.column("text"), 1 << 20):
                b = whole.slice(lo, n)
                got = align(t, b.column("text").to_pylist())
                groups = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in got["groups"]] if digest else got["groups"]
                ends = pa.array(got["ends"].astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [b.column("key"), b.column("copies"), *[pa.array(got[c]) for c in NUMBERS], pa.array(groups, pa.string()),
                     pa.ListArray.from_arrays(ends, pa.array(got["pairs"])),
                     pa.ListArray.from_arrays(ends, pa.array(got["counts"].astype(np.int32)))],
                    ["key", "copies", *NUMBERS, "groups", "pairs", "counts"])

    keyed = texts.select(F.unhex(F.sha2("text", 256)).alias("key"), "copies", "text")
    aligned = materialise(keyed.mapInArrow(measure, f"key binary, copies long, {MEASURES}, pairs array<long>, counts array<int>"), "aligned")
    size = aligned.agg(F.sum("n_links").alias("links"), F.sum("copies").alias("copies")).first()
    parts = 1 + (size.links or 0) // part_links
    aligned = aligned.withColumn("part", F.pmod(F.xxhash64("key"), F.lit(parts)).cast("int"))

    asked = aligned.select("part", "copies", F.inline(F.arrays_zip("pairs", "counts")).alias("pair", "n"))
    asked = materialise(asked.groupBy("part", "pair").agg(F.sum(F.col("n") * F.col("copies")).alias("n")), "pairs")
    totals = asked.groupBy("pair").agg(F.sum("n").alias("total"))
    piece = F.expr(f"pair % {n_pieces}").alias("piece")
    top = totals.groupBy(piece).agg(F.max("total").alias("top"))  # a row for each of B's pieces, at most
    answers = (asked.join(totals, "pair").withColumn("piece", piece).join(F.broadcast(top), "piece")
               .select("part", "pair", "total", (F.col("total") == F.col("top")).alias("best")))

    def weigh(held: pa.Table, known: pa.Table) -> pa.Table:
        pair = known.column("pair").to_numpy()
        order = np.argsort(pair)
        pair, total, best = pair[order], known.column("total").to_numpy()[order], known.column("best").to_numpy()[order]
        pairs, counts = (held.column(c).combine_chunks() for c in ("pairs", "counts"))
        at = np.searchsorted(pair, pairs.flatten().to_numpy())
        n = counts.flatten().to_numpy().astype(np.int64)
        ends = np.concatenate([[0], np.cumsum(pairs.value_lengths().to_numpy())])

        def per_text(x):
            run = np.concatenate([[0], np.cumsum(x)])
            return pa.array(run[ends[1:]] - run[ends[:-1]])

        sums = [per_text(n * best[at]), per_text(n * total[at])] if len(pair) else [per_text(n), per_text(n)]
        return pa.Table.from_arrays([held.column(c) for c in ("key", "copies", *NUMBERS, "groups")] + sums,
                                    ["key", "copies", *NUMBERS, "groups", "n_best", "count_sum"])

    done = materialise(aligned.groupBy("part").cogroup(answers.groupBy("part")).applyInArrow(
        weigh, f"key binary, copies long, {MEASURES}, n_best long, count_sum long"), "measured")
    return _to_rows(rows, done, (size.copies or 0) // HOT)


def _to_rows(rows: DataFrame, done: DataFrame, limit: int) -> DataFrame:
    """The measures of each row's text; texts with more than ``limit`` copies reach their rows by a broadcast."""
    out = [*NUMBERS, "n_best", "count_sum"]
    hot = done.where(F.col("copies") > limit).select("key", *[F.col(c).alias(f"hot_{c}") for c in (*out, "groups")])
    rest = done.where(F.col("copies") <= limit).select(F.col("key").alias("rest_key"), *out, "groups")
    keyed = rows.select("id", F.unhex(F.sha2("text", 256)).alias("key"))
    # rows that need no more are dealt out by their id: eight bytes, that equal no key
    own = F.unhex(F.lpad(F.hex(F.xxhash64("id")), 16, "0"))
    marked = keyed.join(F.broadcast(hot), "key", "left").withColumn(
        "rest_key", F.when(F.col("key").isNotNull() & F.col("hot_n_a").isNull(), F.col("key")).otherwise(own))
    got = marked.join(rest, "rest_key", "left")
    return got.select("id", *[F.coalesce(f"hot_{c}", c, F.lit(0)).alias(c) for c in out],
                      F.coalesce("hot_groups", "groups", F.lit("")).alias("groups"))
