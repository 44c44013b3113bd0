"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie of pieces.

``load_pieces`` reads a SentencePiece model file on the driver.  Scores of a
unigram model are used as they are.  A BPE model's scores are merge ranks, not
log probabilities; its pieces get the log probability that Zipf's law gives to
their place in the file, rounded to 1/64 so that sums are exact in any order.

A text is encoded as the library does: spaces become U+2581 and one stands
before the text; the path of pieces with the largest sum of log scores wins; a
character that no piece covers is spelled in byte pieces.  No piece has U+2581
after another character, so a text falls into chunks (a run of U+2581 and what
follows up to the next) that are encoded on their own.  A task keeps the chunks
it has met in a bounded cache and encodes the new ones of a batch together,
position by position in vector operations.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, StringType, StructField, StructType

from clipstat.llm.common import column, map_texts

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
#: Below the lowest score: what a character without a piece costs.
UNKNOWN_COST = 10.0
CACHE_CHUNKS = 100_000
_CHUNK = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


@dataclass
class DoubleArray:
    """A trie over bytes: the child of state s by byte b is ``base[s] + b`` if its ``check`` is s."""

    base: np.ndarray
    check: np.ndarray
    value: np.ndarray  # of a state: the key's number or -1

    @classmethod
    def build(cls, keys: list[bytes]) -> DoubleArray:
        root: dict = {}
        for n, k in enumerate(keys):
            at = root
            for b in k:
                at = at.setdefault(b, {})
            at[-1] = n
        base, check, value = [0], [-1], [-1]
        used = bytearray(b"\1")

        def place(kids: list[int]) -> int:
            """The first free place of the first child such that all children are free."""
            at = 1 if len(kids) < 3 else max(1, len(used) - 4096)
            while True:
                at = used.find(0, at)
                if at < 0:
                    at = len(used)
                    break
                first = at - kids[0]
                if first > 0 and not any(used[first + b: first + b + 1] == b"\1" for b in kids):
                    break
                at += 1
            return max(at, kids[0] + 1)

        todo = [(0, root)]
        while todo:
            s, node = todo.pop()
            value[s] = node.get(-1, -1)
            kids = sorted(b for b in node if b >= 0)
            if not kids:
                continue
            first = place(kids) - kids[0]
            grow = first + kids[-1] + 1 - len(used)
            if grow > 0:
                used.extend(bytes(grow))
                for x, fill in ((base, 0), (check, -1), (value, -1)):
                    x.extend([fill] * grow)
            base[s] = first
            for b in kids:
                used[first + b] = 1
                check[first + b] = s
                todo.append((first + b, node[b]))
        # any byte from any state stays inside the arrays
        end = max(base) + 257 - len(base)
        return cls(np.array(base + [0] * end, np.int32), np.array(check + [-1] * end, np.int32), np.array(value + [-1] * end, np.int32))


@dataclass
class Pieces:
    """The vocabulary: bounded by the model file, so it can be broadcast."""

    trie: DoubleArray
    ids: np.ndarray  # of the trie's keys
    scores: np.ndarray
    byte_ids: np.ndarray
    unknown_id: int
    texts: list[bytes]  # of every id, for decoding
    add_space: bool
    cache: dict[str, bytes] = field(default_factory=dict)  # of a worker, over all its tasks

    def coded(self, chunks: set[str]) -> dict[str, bytes]:
        """A table that has the ids of all these chunks."""
        new = [c for c in chunks if c not in self.cache]
        if len(self.cache) + len(new) > CACHE_CHUNKS:
            self.cache = {}
            new = list(chunks)
        self.cache.update(zip(new, self.encode_chunks(new)))
        return self.cache

    def encode_chunks(self, chunks: list[str]) -> list[bytes]:
        """The ids of each chunk, as little-endian 32-bit integers."""
        raw = [c.encode("utf-8", "surrogatepass") for c in chunks]
        out: list[bytes] = [b""] * len(raw)
        size = np.fromiter(map(len, raw), dtype=np.int64, count=len(raw))
        order = np.argsort(size, kind="stable")
        lo = 0
        while lo < len(order):  # chunks of similar length together, about 4 MB of tables at once
            longest = max(8, int(size[order[lo]] * 1.5) + 1)
            hi = min(int(np.searchsorted(size[order], longest, side="right")), lo + max(1, (1 << 18) // longest))
            hi = max(hi, lo + 1)
            part = order[lo:hi]
            for i, ids in zip(part, self._viterbi([raw[i] for i in part])):
                out[i] = ids
            lo = hi
        return out

    def _viterbi(self, raw: list[bytes]) -> list[bytes]:
        width, n = max(map(len, raw)), len(raw)
        size = np.fromiter(map(len, raw), dtype=np.int64, count=n)
        text = np.frombuffer(b"".join(r.ljust(width, b"\0") for r in raw), dtype=np.uint8).reshape(n, width).astype(np.int32)
        best = np.full((n, width + 1), -np.inf)
        best[:, 0] = 0
        came = np.zeros((n, width + 1), dtype=np.int32)
        piece = np.full((n, width + 1), -1, dtype=np.int32)
        lead = (text >= 0xC0).astype(np.int64) + (text >= 0xE0) + (text >= 0xF0) + 1  # bytes of the character
        unknown = float(self.scores.min()) - UNKNOWN_COST
        trie = self.trie
        for i in range(width):
            row = np.flatnonzero((size > i) & (best[:, i] > -np.inf))
            if not len(row):
                continue
            one = np.zeros(n, dtype=bool)  # a piece covers just this character
            at, state = row, np.zeros(len(row), dtype=np.int32)
            for j in range(i, width):
                inside = size[at] > j
                at, state = at[inside], state[inside]
                if not len(at):
                    break
                to = trie.base[state] + text[at, j]
                ok = trie.check[to] == state
                at, state = at[ok], to[ok]
                key = trie.value[state]
                end = key >= 0
                rows, keys = at[end], key[end]
                one[rows[lead[rows, i] == j + 1 - i]] = True
                got = best[rows, i] + self.scores[keys]
                up = got > best[rows, j + 1]
                rows = rows[up]
                best[rows, j + 1], came[rows, j + 1], piece[rows, j + 1] = got[up], i, self.ids[keys[up]]
            rows = row[~one[row]]
            to = np.minimum(i + lead[rows, i], size[rows])
            got = best[rows, i] + unknown
            up = got > best[rows, to]
            rows, to = rows[up], to[up]
            best[rows, to], came[rows, to], piece[rows, to] = got[up], i, -1
        # back along the best paths, all chunks in step
        steps: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        row, end = np.arange(n), size.copy()
        while True:
            live = end > 0
            row, end = row[live], end[live]
            if not len(row):
                break
            start = came[row, end]
            known = piece[row, end]
            steps.append((row[known >= 0], end[known >= 0], known[known >= 0]))
            for r, a, b in zip(row[known < 0], start[known < 0], end[known < 0]):  # spelled in bytes
                ids = self.byte_ids[text[r, a:b]]
                steps.append((np.full(b - a, r), np.arange(a + 1, b + 1), ids))
            end = start.astype(np.int64)
        rows = np.concatenate([s[0] for s in steps]) if steps else np.zeros(0, np.int64)
        places = np.concatenate([s[1] for s in steps]) if steps else rows
        ids = np.concatenate([s[2] for s in steps]).astype("<i4") if steps else rows.astype("<i4")
        by = np.lexsort((places, rows))
        flat, cut = ids[by].tobytes(), np.searchsorted(rows[by], np.arange(n + 1)) * 4
        return [flat[a:b] for a, b in zip(cut, cut[1:])]

    def chunks(self, text: str) -> list[str]:
        if not text:
            return []
        return _CHUNK.findall((SPACE if self.add_space else "") + text.replace(" ", SPACE))

    def decode(self, ids: list[int]) -> str:
        raw = b"".join(map(self.texts.__getitem__, ids)).decode("utf-8", "replace")
        return raw[1:].replace(SPACE, " ") if self.add_space and raw.startswith(SPACE) else raw.replace(SPACE, " ")


def load_pieces(path: str = MODEL) -> Pieces:
    from sentencepiece import sentencepiece_model_pb2 as pb

    m = pb.ModelProto()
    with open(path, "rb") as f:
        m.ParseFromString(f.read())
    return pieces_of(m)


def log_scores(m) -> np.ndarray:
    """A log score for each piece of a model (0 for control and byte pieces)."""
    kind = np.array([p.type for p in m.pieces])
    plain = kind == 1
    if m.trainer_spec.model_type == 1:
        return np.where(plain, [p.score for p in m.pieces], 0.0)
    place = np.cumsum(plain)
    return np.where(plain, -np.round(64 * np.log(place + 1.0)) / 64, 0.0)


def pieces_of(m) -> Pieces:
    """The vocabulary of a parsed model; it has to have byte pieces and an identity normaliser."""
    spec = m.normalizer_spec
    if not m.trainer_spec.byte_fallback or len(spec.precompiled_charsmap) or spec.remove_extra_whitespaces:
        raise ValueError("only models with byte fallback and without normalisation round-trip")
    score = log_scores(m)
    plain = [i for i, p in enumerate(m.pieces) if p.type == 1]
    texts = [p.piece.encode() for p in m.pieces]
    if any(SPACE in m.pieces[i].piece.lstrip(SPACE) for i in plain):
        raise ValueError("a piece has a space marker after another character")
    byte_ids = np.full(256, -1, dtype=np.int32)
    for i, p in enumerate(m.pieces):
        if p.type == 6:
            byte_ids[int(p.piece[1:-1], 16)] = i
            texts[i] = bytes([int(p.piece[1:-1], 16)])
        elif p.type != 1:
            texts[i] = b""
    return Pieces(DoubleArray.build([texts[i] for i in plain]), np.array(plain, dtype=np.int32), score[plain], byte_ids,
                  next((i for i, p in enumerate(m.pieces) if p.type == 2), 0), texts, spec.add_dummy_prefix)


def encode(docs: DataFrame, pieces: Pieces, *, text_col: str = "text", ids_col: str = "ids", check_col: str | None = None) -> DataFrame:
    """``docs`` with an array of piece ids; a column of that name is replaced.

    An empty text has an empty array, a null text null.  ``check_col`` adds
    whether the ids decode to the text (true for null), told in the same task.
    All rows and other columns come back as they are.
    """
    shared = docs.sparkSession.sparkContext.broadcast(pieces)

    def run(texts: pa.Array, _: pa.StructArray) -> list[pa.Array]:
        p = shared.value
        split = [p.chunks(t) if t else [] for t in texts.to_pylist()]
        get = p.coded(set().union(*split)).__getitem__
        coded = [b"".join(map(get, d)) for d in split]
        ends = np.cumsum([0, *(len(x) // 4 for x in coded)], dtype=np.int32)
        ids = pa.array(np.frombuffer(b"".join(coded), dtype="<i4"))
        out = [pa.ListArray.from_arrays(pa.array(ends), ids, mask=texts.is_null())]
        if check_col:
            same = [t is None or p.decode(np.frombuffer(x, dtype="<i4").tolist()) == t for t, x in zip(texts.to_pylist(), coded)]
            out.append(pa.array(same, pa.bool_()))
        return out

    new = [StructField(ids_col, ArrayType(IntegerType())), *([StructField(check_col, BooleanType())] if check_col else [])]
    return map_texts(docs, text_col, new, run, max_bytes=1 << 20)


def decode(coded: DataFrame, pieces: Pieces, *, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``coded`` with the text that the ids stand for; null ids give null, an empty array an empty text."""
    own = [c for c in coded.columns if c != out_col]
    src = coded.select(F.struct(F.lit(0).alias("no_column_of_row"), *[column(c) for c in own]).alias("row"), column(ids_col).alias("ids"))
    shared = coded.sparkSession.sparkContext.broadcast(pieces)
    schema = StructType([src.schema["row"], StructField("text", StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = shared.value
        for whole in batches:
            for lo in range(0, whole.num_rows, 200):
                b = whole.slice(lo, 200)
                lists = b.column("ids")
                flat, at = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
                ok = lists.is_valid().to_numpy(zero_copy_only=False)
                texts = [p.decode(flat[x:y].tolist()) if v else None for x, y, v in zip(at, at[1:], ok)]
                yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(texts, pa.string())], ["row", "text"])

    made = src.mapInArrow(run, schema)
    return made.select(*[F.col("row").getField(c).alias(c) for c in own], F.col("text").alias(out_col))
