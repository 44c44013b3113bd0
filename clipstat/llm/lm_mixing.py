"""LM scoring by online logistic context mixing: bit predictors with hashed contexts, mixed by gated weights.

A text is scored as its lower-cased words, a space between two, and an end mark;
so its probability is that of its words.  Each bit is predicted by several
predictors: the counts, over all training texts, of the bytes that followed the
last 2, 4 and 5 bytes, read at the bits of the byte seen so far.  Contexts are
56-bit hashes, so their number grows with the corpus and hardly any two meet.
The predictions are mixed in the logistic domain with gated weights: the bit's place picks their set, and it and
the number of known contexts pick a bias; after each bit the weights move
against the error, and so do the slope and shift that refine the mixed logit into
the final one.  Every ``LANE`` bytes of a text the weights start again from the
fitted ones, so that a text's score depends on nothing but the text and the corpus,
and long texts are scored in step with others.

What is gathered from the corpus grows with it, so none of it is broadcast.  A
task counts the contexts and words of each stretch of documents (a part, of at most
about ``part_bytes``) and deals them into buckets of their hashes, as compressed rows.  A
bucket adds up what all parts say, and each part gets back the totals of the
contexts and words that it has itself.  Buckets grow in number with the corpus, and a hot
context or word stands once in each part.  Then a part's texts are scored
together: the sequential work goes on in vector operations over all lanes of a
block, and each distinct run of bytes has its predictions worked out once a block.  Words
are known by 64-bit hashes, worked out and counted for many texts at a time.

The first weights are fitted on all training texts, with each count less the
occurrence itself: they are the logistic regression of the bits on the
predictions.  A byte and those before it that predictors see decide all of its
predictions, so a part weighs each such run by how often its training texts have
it.  Bits whose predictions agree to about a half share a cell, which keeps their number and
mean; all parts' cells are added up, and each round is a Newton step over them.  So
the weights, as the counts and word statistics, cover all training texts and don't
depend on how these are dealt out.

Null text counts as empty (one token, the end).  Repeated rows and ids are rows of
their own, and train as often as they stand there.  Texts of any length are read whole, a megabyte at a
time.  An empty table gives an empty result; without training texts every bit is even.
Columns other than the id, the text and the training mark are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipstat.llm.common import column, materialise, run_starts, slices

#: Predictors: the last 2, 4 and 5 bytes.
ORDERS = (2, 4, 5)
LANE = 1024
PART_BYTES = 32 << 20
BUCKET_BYTES = 16 << 20
BLOCK_BYTES = 5 << 19
PIECE = 1 << 20  # a multiple of LANE
FIT_ROUNDS = 3
RATE = 0.01
REFINE_RATE, SLOPE_SHARE = np.float32(0.005), np.float32(0.1)
SMOOTH = 0.02
LEAST = np.float32(1 / 8192)  # the least probability of a bit
STEPS_A_PRODUCT, STEPS_A_LOG = 8, 64  # so many of the least probabilities are no less than a float, a double holds
END = b"\xff"  # never a byte of UTF-8
LEAD = max(ORDERS)
GATES = len(ORDERS) + 1  # contexts known
RIDGE = 1.0  # what holds the fitted weights to even ones where training texts say little
MOST_STEP = 0.5  # of a weight in a round of the fit
CELLS_A_UNIT = 1  # of a prediction, where it is rounded for the fit


def words_of(text: str | None) -> list[bytes]:
    """A-Z lower-cased; words are runs of bytes other than space and TAB to CR."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


#: what is left of eight bytes, the first the lowest, of which only so many are of a word
HEADS = np.array([(1 << 8 * i) - 1 for i in range(9)], dtype=np.uint64)
SHORT = 64  # the bytes of a word that are hashed in vector operations


def token_keys(streams: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The tokens of texts, and how many each text has: 64-bit hashes of its words, which stand for them over the corpus, then of the empty one for the end."""
    spaced = [s + b"  " if s else b" " for s in streams]  # a space after each token
    raw = b"".join([*spaced, bytes(SHORT)])
    data = np.frombuffer(raw, dtype=np.uint8)
    ends = np.flatnonzero(data == 32)
    starts = np.concatenate([[0], ends[:-1] + 1])[:len(ends)]
    size = ends - starts
    n = np.diff(np.searchsorted(ends, np.cumsum([0, *map(len, spaced)])))
    eight = np.ndarray(len(data) - 7, "<u8", data, strides=(1,))  # from each byte on
    key = (size + 1).astype(np.uint64) * np.uint64(0x632BE59BD9B4E019)
    for lo in range(0, SHORT, 8):
        some = np.flatnonzero(size > lo)
        h = key[some]
        h ^= eight[starts[some] + lo] & HEADS.take(np.minimum(size[some] - lo, 8))
        for shift in (32, 29):
            h *= np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(shift)
        key[some] = h
    for i in np.flatnonzero(size > SHORT).tolist():
        key[i] = xxhash.xxh64_intdigest(raw[starts[i]:ends[i]])
    return key, n


def codes(data: np.ndarray) -> np.ndarray:
    """For each byte after the lead: itself and the bytes of the lead before it, as one number."""
    whole = np.append(data, np.zeros(7 - LEAD, np.uint8))
    eight = np.ndarray(len(data) - LEAD, ">u8", whole, strides=(1,))
    code = eight.astype(np.uint64)
    code >>= np.uint64(8 * (7 - LEAD))
    return code


def grams(code: np.ndarray) -> Iterator[np.ndarray]:
    """For each code, by predictor: its context's hash (56 bits) and the byte itself."""
    h = np.full(len(code), 0x632BE59BD9B4E019, dtype=np.uint64)
    byte = code & np.uint64(255)
    for back in range(1, LEAD + 1):
        h += (code >> np.uint64(8 * back)) & np.uint64(255)
        h *= np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
        if back in ORDERS:
            yield h << np.uint64(8) | byte


def code_counts(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes of pieces, in order, and how often each comes."""
    # all pieces end to end; a lead's own places are passed over
    lead = np.zeros(sum(map(len, parts)), dtype=bool)
    begins = np.cumsum([0, *map(len, parts[:-1])])
    lead[(begins[:, None] + np.arange(LEAD)).ravel()] = True
    code = codes(np.concatenate(parts))[~lead[LEAD:]]
    return _counted(code)


def pieces(stream: bytes) -> Iterator[np.ndarray]:
    """A text's bytes with the end mark, a piece at a time, each after the bytes before it."""
    whole = np.frombuffer(END * LEAD + stream + END, dtype=np.uint8)
    for lo in range(0, len(whole) - LEAD, PIECE):
        yield whole[lo:lo + PIECE + LEAD]


#: no keys, and no counts of them
NONE = np.zeros(0, np.uint64), np.zeros(0, np.uint64)


def _counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and how often each comes; ``keys`` are sorted in place."""
    keys.sort()
    starts = run_starts(keys)
    return keys[starts], np.diff(np.append(starts, len(keys))).astype(np.uint64)


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the place of each key among them."""
    order = np.argsort(keys)
    keys = keys[order]
    new = np.ones(len(keys), dtype=bool)
    np.not_equal(keys[1:], keys[:-1], out=new[1:])
    place = np.empty(len(keys), np.int32)
    place[order] = np.cumsum(new, dtype=np.int32) - np.int32(1)
    return keys[new], place


def _merged(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and their sums."""
    order = np.argsort(keys)
    keys, n = keys[order], n[order]
    starts = run_starts(keys)
    return keys[starts], np.add.reduceat(n, starts) if len(starts) else n


class Tally:
    """Counts of grams in training texts; other texts' contexts are asked for with a count of 0."""

    def __init__(self):
        self.held, self.size = {True: [], False: []}, {True: 0, False: 0}
        self.done: list[tuple[np.ndarray, np.ndarray]] = []
        self.texts: dict[bool, list[bytes]] = {True: [], False: []}
        self.words: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, words: list[bytes], train: bool) -> bytes:
        stream = b" ".join(words)
        self.texts[train].append(stream)
        for p in pieces(stream):
            self.held[train].append(p)
            self.size[train] += len(p)
            if self.size[train] > BLOCK_BYTES:
                self.close(train)
        return stream

    def close(self, train: bool) -> None:
        if not self.held[train]:
            return
        code, times = code_counts(self.held[train])
        for row in grams(code):
            keys, n = _merged(row, times)
            if not train:
                keys = keys[run_starts(keys >> np.uint64(8))]
                n = np.zeros(len(keys), np.uint64)
            self.done.append((keys, n))
        word, times = _counted(token_keys(self.texts[train])[0])
        self.words.append((word, times if train else np.zeros(len(word), np.uint64)))
        self.held[train], self.texts[train], self.size[train] = [], [], 0
        if len(self.done) > 3 * len(ORDERS):  # some at a time, for the memory they take
            self.merge()

    def merge(self) -> None:
        self.done, self.words = ([_merged(*map(np.concatenate, zip(NONE, *some)))] for some in (self.done, self.words))

    def counts(self) -> Counts:
        """All contexts and words of the texts, with what training texts here say of them."""
        self.close(True)
        self.close(False)
        self.merge()
        return Counts.of(*self.done[0], *self.words[0])


@dataclass
class Counts:
    """Contexts in order, how many bytes follow each, these and their counts; hashed words in order and theirs."""

    ctx: np.ndarray
    size: np.ndarray
    byte: np.ndarray
    n: np.ndarray
    word: np.ndarray
    c: np.ndarray

    @classmethod
    def of(cls, keys: np.ndarray, n: np.ndarray, word: np.ndarray, c: np.ndarray) -> Counts:
        """From distinct grams in order; one with a count of 0 only names its context."""
        ctx = keys >> np.uint64(8)
        starts = run_starts(ctx)
        some = n > 0
        ends = np.concatenate([[0], np.cumsum(some)])[np.append(starts, len(keys))]
        return cls(ctx[starts], np.diff(ends).astype(np.uint16), (keys & np.uint64(255))[some].astype(np.uint8), n[some], word, c)

    def grams(self) -> np.ndarray:
        return np.repeat(self.ctx << np.uint64(8), self.size) | self.byte

    def buckets(self, n: int) -> Iterator[tuple[int, Counts]]:
        """The counts dealt into ``n`` ranges of the hashes, empty ones left out."""
        bounds = np.array([i * 2**56 // n for i in range(n + 1)], dtype=np.uint64)
        at, ends = np.searchsorted(self.ctx, bounds), np.concatenate([[0], np.cumsum(self.size, dtype=np.int64)])
        by_word = np.searchsorted(self.word >> np.uint64(8), bounds)
        for i in range(n):
            lo, hi, a, b = at[i], at[i + 1], by_word[i], by_word[i + 1]
            if lo < hi or a < b:
                yield i, Counts(self.ctx[lo:hi], self.size[lo:hi], self.byte[ends[lo]:ends[hi]], self.n[ends[lo]:ends[hi]], self.word[a:b], self.c[a:b])

    @classmethod
    def joined(cls, all_of: list[Counts]) -> Counts:
        return cls(*(np.concatenate([getattr(x, f.name) for x in all_of]) for f in fields(cls)))

    def packed(self) -> bytes:
        """Compressed: keys as differences, long numbers byte by byte."""
        raw = b"".join([_planes(np.diff(self.ctx, prepend=np.uint64(0))), self.size.astype("<u2").tobytes(), self.byte.tobytes(), _planes(self.n),
                        _planes(np.diff(self.word, prepend=np.uint64(0))), _planes(self.c)])
        head = np.array([len(self.ctx), len(self.byte), len(self.word)], dtype="<i8").tobytes()
        return head + pa.compress(raw, codec="zstd", asbytes=True)

    @classmethod
    def unpacked(cls, blob: bytes) -> Counts:
        k, e, w = np.frombuffer(blob, dtype="<i8", count=3).tolist()
        raw = np.frombuffer(pa.decompress(blob[24:], 10 * k + 9 * e + 16 * w, codec="zstd"), dtype=np.uint8)
        cut = np.cumsum([8 * k, 2 * k, e, 8 * e, 8 * w])
        ctx, size, byte, n, word, c = np.split(raw, cut)
        return cls(np.cumsum(_long(ctx), dtype=np.uint64), size.view("<u2"), byte, _long(n), np.cumsum(_long(word), dtype=np.uint64), _long(c))


def _planes(x: np.ndarray) -> bytes:
    return x.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def _long(planes: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(planes.reshape(8, -1).T).view("<u8").reshape(-1)


def add_up(held: list[Counts]) -> tuple[list[Counts], list[int]]:
    """For each of ``held``, the totals over all of them of its contexts and words, and how many words that train it is the first to have."""
    grams_all, n = _merged(np.concatenate([x.grams() for x in held]), np.concatenate([x.n for x in held]))
    ctx_of = grams_all >> np.uint64(8)
    word, first, back = np.unique(np.concatenate([x.word for x in held]), return_index=True, return_inverse=True)
    c = np.zeros(len(word), np.uint64)
    np.add.at(c, back, np.concatenate([x.c for x in held]))
    ends = np.cumsum([len(x.word) for x in held])
    fresh = np.bincount(np.searchsorted(ends, first[c > 0], side="right"), minlength=len(held))
    out = []
    for i, x in enumerate(held):
        lo, hi = np.searchsorted(ctx_of, x.ctx), np.searchsorted(ctx_of, x.ctx, side="right")
        size = hi - lo
        at = np.arange(size.sum()) + np.repeat(lo - np.concatenate([[0], np.cumsum(size)[:-1]]) if len(size) else lo, size)
        out.append(Counts(x.ctx, size.astype(np.uint16), (grams_all[at] & np.uint64(255)).astype(np.uint8), n[at], x.word,
                          c[back[ends[i] - len(x.word):ends[i]]]))
    return out, fresh.tolist()


# --- mixing -----------------------------------------------------------------


def stretch_table(seen: np.ndarray, known: np.ndarray, run: np.ndarray, less: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The eight predictions of each gram in ``seen``, as logits, and whether its context is known.

    ``known`` are the corpus's grams in order and ``run`` the running sum of their counts.
    ``less``: how much the gram's own count is lowered by (1 to fit on texts that are counted themselves).
    """
    out = np.empty((len(seen), 8), dtype=np.float32)
    base, byte = seen & ~np.uint64(255), seen & np.uint64(255)
    lo, hi = np.searchsorted(known, base), np.searchsorted(known, base + np.uint64(256))
    met = (run[hi] - run[lo]) > less
    for b in range(8):
        half = np.uint64(128 >> b)
        prefix = base | (byte & ~np.uint64((256 >> b) - 1))
        mid = np.searchsorted(known, prefix | half)
        bit = (byte & half) > 0
        zero, one = (run[mid] - run[lo]).astype(np.float32), (run[hi] - run[mid]).astype(np.float32)
        if less:
            zero, one = np.maximum(zero - less * ~bit, 0), np.maximum(one - less * bit, 0)
        one += SMOOTH
        zero += SMOOTH
        one /= zero
        np.log(one, out=out[:, b])
        lo, hi = np.where(bit, mid, lo), np.where(bit, hi, mid)
    return out, met


def stretch_all(known: np.ndarray, run: np.ndarray, less: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """As ``stretch_table`` of all of ``known`` (whole contexts), by the counts of runs that share a context and so many bits."""
    out = np.empty((len(known), 8), dtype=np.float32)
    base = run[0]
    whole = None
    for b in range(9):
        new = np.ones(len(known), dtype=bool)
        np.not_equal(known[1:] >> np.uint64(8 - b), known[:-1] >> np.uint64(8 - b), out=new[1:])
        of = np.cumsum(new) - 1
        ends = run[np.append(np.flatnonzero(new)[1:], len(known))] - base
        own = np.diff(ends, prepend=np.uint64(0))[of]
        if b:
            bit = (known & np.uint64(256 >> b)) > 0
            other = (whole - own).astype(np.float32)
            mine = own.astype(np.float32)
            if less:
                np.maximum(mine - less, 0, out=mine)
            mine += SMOOTH
            other += SMOOTH
            one, zero = np.where(bit, mine, other), np.where(bit, other, mine)
            one /= zero
            np.log(one, out=out[:, b - 1])
        else:
            met = own > less
        whole = own
    return out, met


@dataclass
class Known:
    """What the corpus says of a part's contexts: its grams in order, the running sum of their counts, and their predictions."""

    grams: np.ndarray
    run: np.ndarray
    stretch: np.ndarray
    met: np.ndarray
    less: int

    @classmethod
    def of(cls, grams: np.ndarray, run: np.ndarray, less: int = 0) -> Known:
        stretch, met = np.empty((len(grams), 8), np.float32), np.empty(len(grams), bool)
        lo = 0
        while lo < len(grams):  # some at a time, for the memory they take meanwhile
            hi = int(np.searchsorted(grams, grams[min(lo + 20_000, len(grams) - 1)] | np.uint64(255), side="right"))  # a context whole
            stretch[lo:hi], met[lo:hi] = stretch_all(grams[lo:hi], run[lo:hi + 1], less)
            lo = hi
        return cls(grams, run, stretch, met, less)

    def look_up(self, seen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The predictions of grams in order, those the corpus hasn't worked out anew."""
        at = np.minimum(np.searchsorted(self.grams, seen), max(len(self.grams) - 1, 0))
        if not len(self.grams):
            return np.zeros((len(seen), 8), np.float32), np.zeros(len(seen), bool)
        stretch, met = self.stretch.take(at, axis=0), self.met.take(at)
        new = self.grams.take(at) != seen
        stretch[new], met[new] = stretch_table(seen[new], self.grams, self.run, self.less)
        return stretch, met

    def predict(self, code: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
        """Of distinct codes, by predictor: the predictions of its distinct grams and each code's place among them; how many contexts of each code are known."""
        stretch, places, gate = [], [], np.zeros(len(code), np.uint8)
        for row in grams(code):
            distinct, place = _distinct(row)
            some, met = self.look_up(distinct)
            gate += met.take(place)
            stretch.append(some)
            places.append(place)
        return stretch, places, gate


@dataclass
class Block:
    """Pieces of texts cut into lanes, longest first; a row for each step holds the places of all lanes."""

    stretch: list[np.ndarray]  # by predictor, grams x 8; a prediction against the bit that came is negative
    places: list[np.ndarray | None]  # by predictor, the gram of each code; None: the code's own place
    gate: np.ndarray  # of each code: how many of its contexts are known, 256 times, and its byte
    code: np.ndarray  # steps x lanes
    size: np.ndarray  # of each lane
    owner: np.ndarray  # the text of each lane

    @classmethod
    def of(cls, parts: list[tuple[int, np.ndarray]], known: Known) -> Block:
        n = np.array([len(p) for _, p in parts])
        lanes = -(-(n - LEAD) // LANE)
        inside = np.arange(lanes.sum()) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        size = np.minimum(LANE, np.repeat(n - LEAD, lanes) - inside * LANE)
        by = np.argsort(-size, kind="stable")
        start = (np.repeat(np.cumsum(n) - n, lanes) + inside * LANE)[by]
        # what is past a lane's end isn't looked at
        coded = pa.array(codes(np.concatenate([p for _, p in parts] + [np.zeros(LANE, np.uint8)]))).dictionary_encode()
        code = coded.dictionary.to_numpy()
        stretch, places, gate = known.predict(code)
        byte = (code & np.uint64(255)).astype(np.uint8)
        for some, place in zip(stretch, places):
            last = np.empty(len(some), np.uint8)  # the byte of each gram
            last[place] = byte
            some *= SIGNS.take(last, axis=0)
        for i, (some, place) in enumerate(zip(stretch, places)):
            # few codes share their grams: a row for each
            stretch[i], places[i] = (_rows(some, place), None) if 2 * len(some) > len(code) else (some, place.astype(np.intp))
        place, beside = coded.indices.to_numpy(), np.empty((int(size[by[0]]), len(start)), np.int32)
        for t, row in enumerate(beside):  # a step at a time, for the memory they take
            row[:] = place.take(start + t)
        return cls(stretch, places, gate.astype(np.intp) << 8 | byte, beside, size[by], np.repeat([o for o, _ in parts], lanes)[by])


@dataclass
class Weights:
    """Where mixing starts from, as logits: predictors x 8 weights, gates x 8 biases."""

    mix: np.ndarray
    bias: np.ndarray

    @classmethod
    def even(cls) -> Weights:
        return cls(np.full((len(ORDERS), 8), 0.3, dtype=np.float32), np.zeros((GATES, 8), dtype=np.float32))


#: the eight bits of each byte
BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.float32)


#: 1 for a bit that is set, else -1
SIGNS = BITS * 2 - 1


def _squash(x: np.ndarray) -> np.ndarray:
    """The logistic function, in place."""
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


def mix(block: Block, start: Weights, rate: float) -> np.ndarray:
    """log2 of the probability of each lane, all lanes in step, byte by byte.

    Each bit's place has weights and a refinement of its own, so the eight bits of
    a byte, each predicted from those before it, are worked out together.  All
    logits are those of the bit that came (predictions, biases and shifts take its
    sign) and are halved, so that a bit's probability is (1 + tanh) / 2.
    """
    n = len(block.size)
    weights = np.repeat(start.mix[:, None] / 2, n, axis=1)  # predictors x lanes x 8
    biases = np.repeat(start.bias[None] / 2, n, axis=0).reshape(n * GATES, 8)
    rows = biases.view("V32").reshape(-1)  # the eight of a gate as one item, which numpy copies at once
    slopes = np.ones((n, 8), dtype=np.float32)  # of the refinement
    shifts = np.zeros((n, 8), dtype=np.float32)
    total, products, few = np.zeros(n), np.ones((n, 8)), np.ones((n, 8), dtype=np.float32)
    most, leasts = np.full((n, 8), 4, np.float32), np.full((n, 8), 2 * LEAST, np.float32)  # numpy is slow to compare with one number
    spare = np.empty((5, n, 8), np.float32)
    learn, refine, stretch = np.float32(-rate / 4), -REFINE_RATE / 4, 4 * SLOPE_SHARE
    live, first_row = n, np.arange(n) * GATES
    for t in range(len(block.code)):
        while block.size[live - 1] <= t:
            live -= 1
        at = block.code[t, :live].astype(np.intp)  # once, for all that is taken
        dot, p, part, high, low = spare[0, :live], spare[1, :live], spare[2, :live], most[:live], leasts[:live]
        x = [_rows(some, at if place is None else place.take(at)) for some, place in zip(block.stretch, block.places)]
        gate = block.gate.take(at)
        sign = _rows(SIGNS, gate & 255)
        gate >>= 8
        row = gate + first_row[:live]
        bias = _rows(biases, row)
        slope, shift = slopes[:live], shifts[:live]
        np.multiply(bias, sign, out=dot)
        for w, some in zip(weights, x):
            dot += np.multiply(w[:live], some, out=part)
        np.minimum(dot, high, out=dot)
        np.maximum(dot, np.negative(high, out=part), out=dot)
        # the refinement: the mixed logit, stretched and shifted as this lane has learned
        np.multiply(dot, slope, out=p)
        p += np.multiply(shift, sign, out=part)
        np.tanh(p, out=p)
        np.add(p, 1, out=part)
        few[:live] *= np.maximum(part, low, out=part)
        p -= 1  # twice what the bit was denied, negative
        p *= refine
        shift += np.multiply(p, sign, out=part)
        p *= dot
        p *= stretch
        slope += p
        # the weights learn from the mixed prediction itself
        np.tanh(dot, out=dot)
        dot -= 1
        dot *= learn
        for w, some in zip(weights, x):
            some *= dot
            w[:live] += some
        dot *= sign
        bias += dot
        rows.put(row, bias.view("V32"))
        if t % STEPS_A_PRODUCT == STEPS_A_PRODUCT - 1:
            products *= few
            few[:] = 1
        if t % STEPS_A_LOG == STEPS_A_LOG - 1:
            total += np.log2(products).sum(axis=1)
            products[:] = 1
    products *= few
    return total + np.log2(products).sum(axis=1) - 8 * block.size


def _rows(table: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Some of a table's rows of eight, each copied as one item."""
    return table.view("V32").reshape(-1).take(at).view(np.float32).reshape(-1, 8)


@dataclass
class Cells:
    """Bits of training texts: which of the eight, gate, value and rounded predictions as one number; how many, and their predictions' sums."""

    cell: np.ndarray
    sums: np.ndarray  # 1 + predictors, cells

    @classmethod
    def of(cls, code: np.ndarray, times: np.ndarray, known: Known) -> Cells:
        """Of distinct codes and how often each comes."""
        *x, gate = known.predict(code)
        x = [some.take(place, axis=0) for some, place in zip(*x)]
        bit = BITS.take((code & np.uint64(255)).astype(np.uint8), axis=0).astype(np.int64)
        cell = (np.arange(8) * GATES + gate[:, None]) * 2 + bit
        for some in x:
            cell = cell << 8 | np.clip(np.rint(some * CELLS_A_UNIT).astype(np.int64) + 128, 0, 255)
        times = times.astype(float)[:, None]
        return cls.joined([cls(cell.ravel(), np.stack([(times * some).ravel() for some in (np.ones(8), *x)]))])

    @classmethod
    def joined(cls, all_of: list[Cells]) -> Cells:
        if not all_of:
            return cls(np.zeros(0, np.int64), np.zeros((1 + len(ORDERS), 0)))
        cell, of = np.unique(np.concatenate([x.cell for x in all_of]), return_inverse=True)
        return cls(cell, np.stack([np.bincount(of, np.concatenate([x.sums[i] for x in all_of]), len(cell)) for i in range(1 + len(ORDERS))]))


@dataclass
class Sums:
    """For each of the eight bits, what cells say of its 3 weights and 4 biases: slopes and curvatures."""

    slope: np.ndarray  # 8 x 7
    curve: np.ndarray  # 8 x 7 x 7

    @classmethod
    def of(cls, cells: Cells, start: Weights) -> Sums:
        head, n = cells.cell >> 8 * len(ORDERS), cells.sums[0]
        bit, gate, value = head // (2 * GATES), head // 2 % GATES, head % 2
        x = np.concatenate([cells.sums[1:] / n, np.eye(GATES)[:, gate]])
        got = cls(np.zeros((8, len(x))), np.zeros((8, len(x), len(x))))
        for b in range(8):
            here = bit == b
            some = x[:, here]
            p = _squash(np.clip(np.concatenate([start.mix[:, b], start.bias[:, b]]).astype(float) @ some, -8, 8))
            got.slope[b] = some @ ((value[here] - p) * n[here])
            got.curve[b] = (some * (p * (1 - p) * n[here])) @ some.T
        return got

    def weights(self, start: Weights) -> Weights:
        """A Newton step from the weights at which the sums were taken."""
        even, k = Weights.even(), len(ORDERS)
        off = np.concatenate([start.mix - even.mix, start.bias - even.bias]).T
        step = np.linalg.solve(self.curve + RIDGE * np.eye(k + GATES), (self.slope - RIDGE * off)[..., None])[..., 0].T
        step = np.clip(step, -MOST_STEP, MOST_STEP).astype(np.float32)
        return Weights(start.mix + step[:k], start.bias + step[k:])


def _blocks(streams: list[bytes]) -> Iterator[list[tuple[int, np.ndarray]]]:
    """Pieces of the texts, some megabytes at a time."""
    held, size = [], 0
    for i, s in enumerate(streams):
        for p in pieces(s):
            held.append((i, p))
            size += len(p)
            if size > BLOCK_BYTES:
                yield held
                held, size = [], 0
    if held:
        yield held


def fit_cells(streams: list[bytes], known: Known) -> Cells:
    """The cells of training texts; ``known`` has each count less the occurrence itself."""
    counted: list[tuple[np.ndarray, np.ndarray]] = []
    for parts in _blocks(streams):
        counted.append(code_counts([p for _, p in parts]))
        if len(counted) > 4:  # some at a time, for the memory they take
            counted = [_merged(*map(np.concatenate, zip(*counted)))]
    if not len(known.grams) or not counted:
        return Cells.joined([])
    code, times = _merged(*map(np.concatenate, zip(*counted)))
    del counted
    return Cells.joined([Cells.of(code[lo:lo + 50_000], times[lo:lo + 50_000], known) for lo in range(0, len(code), 50_000)])


def fit(streams: list[bytes], known: Known) -> Weights:
    """Weights after some rounds over the cells of training texts."""
    got, cells = Weights.even(), fit_cells(streams, known)
    for _ in range(FIT_ROUNDS):
        got = Sums.of(cells, got).weights(got)
    return got


def score_streams(streams: list[bytes], known: Known, weights: Weights) -> np.ndarray:
    """log2 of the probability of each text and its end, some megabytes at a time."""
    total = np.zeros(len(streams))
    for parts in _blocks(streams):
        block = Block.of(parts, known)
        np.add.at(total, block.owner, mix(block, weights, RATE))
        del block
        pa.default_memory_pool().release_unused()
    return total


def word_scores(streams: list[bytes], word: np.ndarray, c: np.ndarray, unit: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Tokens of each text, those that training texts have, and the base's log10 probability, some texts at a time.

    ``word``, ``c``: the part's words and their counts; ``unit``: log10 of the base's denominator.
    """
    for lo, n in slices(pa.array(streams, pa.binary()), BLOCK_BYTES // 2):
        key, size = token_keys(streams[lo:lo + n])
        distinct, at = _distinct(key)
        count, starts = c[np.searchsorted(word, distinct)], np.cumsum(size) - size
        yield size, np.add.reduceat((count > 0).astype(np.int64)[at], starts), np.add.reduceat((np.log10(count + 0.5) - unit)[at], starts)


# --- on Spark ---------------------------------------------------------------


def score_texts(docs: DataFrame, train: Column, *, id_col: str = "doc_id", text_col: str = "text",
                part_bytes: int = PART_BYTES, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """(id, train, n_tokens, n_known, train_tokens, base_score, score, n_bytes) for every row of ``docs``.

    ``train`` marks the rows to learn from.  Scores are log10 probabilities:
    ``base_score`` by the smoothed counts of words, ``score`` by the mixed model;
    bits per byte are ``-score * log2(10) / n_bytes``.
    """
    rows = docs.select(column(id_col).alias("id"), F.coalesce(train, F.lit(False)).alias("train"), column(text_col).cast("string").alias("text"))
    n_buckets = 1 + (rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // bucket_bytes
    id_type = rows.schema["id"].dataType.simpleString()

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, serial = TaskContext.get().partitionId(), 0
        tally, held = Tally(), 0

        def texts(part: int, ids: pa.Array, learn: list[bool], streams: list[bytes]) -> pa.RecordBatch:
            raw = b"".join(streams)
            n = sum(s.count(b" ") + 1 if s else 0 for s, t in zip(streams, learn) if t) + sum(learn)
            ends = pa.array([0, len(streams)], pa.int32())
            lists = [pa.ListArray.from_arrays(ends, x) for x in (ids, pa.array(learn, pa.bool_()), pa.array(list(map(len, streams)), pa.int64()))]
            return pa.RecordBatch.from_arrays([pa.array([part]), *lists, pa.array([pa.compress(raw, codec="zstd", asbytes=True)]), pa.array([n]),
                                               pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary())], NAMES)

        def counts(part: int, got: Counts) -> Iterator[pa.RecordBatch]:
            for bucket, some in got.buckets(n_buckets):
                nulls = [pa.nulls(1, k) for k in (pa.list_(kind), pa.list_(pa.bool_()), pa.list_(pa.int64()), pa.binary(), pa.int64())]
                yield pa.RecordBatch.from_arrays([pa.array([part]), *nulls, pa.array([bucket]), pa.array([some.packed()])], NAMES)

        for b in batches:
            kind = b.schema.field("id").type
            for lo, n in slices(b.column("text"), 1 << 20):
                s = b.slice(lo, n)
                learn = s.column("train").to_pylist()
                streams = [tally.add(words_of(text), t) for text, t in zip(s.column("text").to_pylist(), learn)]
                held += sum(map(len, streams))
                yield texts(task << 20 | serial, s.column("id"), learn, streams)
                if held >= part_bytes:
                    yield from counts(task << 20 | serial, tally.counts())
                    tally, held = Tally(), 0
                    serial += 1
        if tally.words or tally.texts[True] or tally.texts[False]:
            yield from counts(task << 20 | serial, tally.counts())

    got = materialise(rows.mapInArrow(gather, GATHERED.format(id=id_type)), "lm-parts")
    texts = got.where("bucket is null").select("part", "ids", "trains", "sizes", "streams", "tokens")
    held = got.where("bucket is not null").select("part", "bucket", "counts")

    def total(t: pa.Table) -> pa.Table:
        t = t.sort_by("part")
        found, fresh = add_up([Counts.unpacked(x) for x in t.column("counts").to_pylist()])
        return pa.table({"part": t.column("part"), "bucket": t.column("bucket"), "counts": pa.array([x.packed() for x in found], pa.binary()), "fresh": fresh})

    answers = materialise(held.groupBy("bucket").applyInArrow(total, "part long, bucket long, counts binary, fresh long"), "lm-totals")
    n_train = texts.agg(F.sum("tokens")).first()[0] or 0
    distinct = answers.agg(F.sum("fresh")).first()[0] or 0
    unit = math.log10(n_train + 0.5 * (distinct + 1))
    shared = docs.sparkSession.sparkContext.broadcast(_fitted(texts, answers))

    def score(blocks: pa.Table, known: pa.Table) -> pa.Table:
        counts = _joined(known)
        word, c, corpus = counts.word, counts.c, _known(counts)
        del counts
        streams = _streams(blocks)
        log2 = score_streams(streams, corpus, shared.value)
        del corpus
        pa.default_memory_pool().release_unused()
        n_tokens, n_known, base = map(np.concatenate, zip(*word_scores(streams, word, c, unit)))
        ids, trains = (blocks.column(x).combine_chunks().flatten() for x in ("ids", "trains"))
        return pa.Table.from_arrays(
            [ids, trains, pa.array(n_tokens), pa.array(n_known), pa.array(np.full(len(streams), n_train)), pa.array(base), pa.array(log2 * np.log10(2.0)), pa.array([len(s) + 1 for s in streams], pa.int64())], names)

    shape = f"id {id_type}, train boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, n_bytes long"
    names = [x.split()[0] for x in shape.split(", ")]
    return texts.groupBy("part").cogroup(answers.groupBy("part")).applyInArrow(score, shape)


GATHERED = "part long, ids array<{id}>, trains array<boolean>, sizes array<long>, streams binary, tokens long, bucket long, counts binary"
NAMES = ["part", "ids", "trains", "sizes", "streams", "tokens", "bucket", "counts"]


def _streams(blocks: pa.Table) -> list[bytes]:
    out = []
    for sizes, blob in zip(blocks.column("sizes").to_pylist(), blocks.column("streams").to_pylist()):
        raw = pa.decompress(blob, sum(sizes), codec="zstd", asbytes=True) if sum(sizes) else b""
        cut = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
        out += [raw[a:b] for a, b in zip(cut, cut[1:])]
    return out


def _joined(known: pa.Table) -> Counts:
    """A part's totals."""
    return Counts.joined([Counts.unpacked(x) for x in known.sort_by("bucket").column("counts").to_pylist()])


def _known(counts: Counts, less: int = 0) -> Known:
    return Known.of(counts.grams(), np.concatenate([np.zeros(1, np.uint64), np.cumsum(counts.n, dtype=np.uint64)]), less)


def _fitted(texts: DataFrame, answers: DataFrame) -> Weights:
    """Weights fitted on all training texts: each part's cells, added up; a round adds up a few numbers of all cells."""
    sums = [f"s{i}" for i in range(1 + len(ORDERS))]

    def cells_of(blocks: pa.Table, known: pa.Table) -> pa.Table:
        learn = blocks.column("trains").combine_chunks().flatten().to_pylist()
        streams = [s for s, t in zip(_streams(blocks), learn) if t]
        got = fit_cells(streams, _known(_joined(known), 1)) if streams else Cells.joined([])
        return pa.table([pa.array(got.cell), *map(pa.array, got.sums)], ["cell", *sums])

    made = texts.groupBy("part").cogroup(answers.groupBy("part")).applyInArrow(cells_of, f"cell long, {', '.join(f'{s} double' for s in sums)}")
    cells = materialise(made.groupBy("cell").agg(*[F.sum(s).alias(s) for s in sums]), "lm-cells")
    start, size = Weights.even(), len(ORDERS) + GATES
    numbers = [f"got[{i}]" for i in range(8 * size * (size + 1))]

    def round_from(start: Weights):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                got = Sums.of(Cells(b.column("cell").to_numpy(), np.stack([b.column(s).to_numpy() for s in sums])), start)
                yield pa.RecordBatch.from_arrays([pa.array([np.concatenate([got.slope.ravel(), got.curve.ravel()])], pa.list_(pa.float64()))], ["got"])

        return run

    for _ in range(FIT_ROUNDS):
        made = cells.mapInArrow(round_from(start), "got array<double>")
        got = np.array([x or 0.0 for x in made.agg(*[F.sum(F.expr(c)).alias(c) for c in numbers]).first()])
        slope, curve = np.split(got, [8 * size])
        start = Sums(slope.reshape(8, size), curve.reshape(8, size, size)).weights(start)
    return start
