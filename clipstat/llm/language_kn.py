"""Language identification with interpolated Kneser-Ney character models.

Each language has a character model of ``order`` characters over lower-cased
letters (everything else is a single space).  The highest order uses counts,
the lower ones continuation counts (in how many distinct longer n-grams an
n-gram is the end), each with the absolute discount n1 / (n1 + 2 n2); the
unigram model is interpolated with a uniform one.

The models are stored as arrays sorted by 64-bit n-gram hash, one per order,
with a row of log probabilities (a column per language) for every n-gram that
any language has seen, and arrays of back-off weights by context hash.  A text
is scored on all its characters: every n-gram is looked up at the highest
order, and only those that no language has seen are looked up further down.

A text goes to the language with the lowest cross-entropy per character.  It is
rejected if that is far above what texts of that language have: the limit is
calibrated on labelled documents that the counts did not see, and allows for
the wider spread of short texts.

Fitting reads a bounded sample: about ``train_chars`` characters a language,
pieces of documents chosen by a hash.  That also bounds what is broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField

from clipstat.llm.common import map_texts, materialise, run_starts, sub_batches

TRAIN_CHARS = 3_000_000
#: Characters of the pieces that the sample is drawn in.
PIECE = 4096
#: Length from which the spread of the cross-entropy no longer shrinks.
SPREAD_CHARS = 200
#: No text is rejected below this excess (nats per character x root of the length): a passage in
#: another language amid a text stays under it, a text in a language that was not learned doesn't.
LEAST_LIMIT = 20.0
#: Bytes of text that a task scores at once: about 60 times as much memory.
SLICE = 1 << 19
_PAD = 1  # stands before the first character
_letters: list[np.ndarray] = []


def _letter_table() -> np.ndarray:
    if not _letters:
        _letters.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000))
    return _letters[0]


def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        return x ^ (x >> np.uint64(29))


@dataclass
class Grams:
    """The characters of some texts, and n-gram hashes: ``hashes[k - 1][i]`` is of the k characters from i."""

    hashes: list[np.ndarray]
    at: np.ndarray  # places at which a scored n-gram starts
    ends: np.ndarray  # for each text: how many of ``at`` end with it
    letters: np.ndarray  # for each text


def grams(texts: list[str | None], order: int) -> Grams:
    pad = chr(_PAD) * (order - 1)
    low = [(t or "").lower().replace(chr(_PAD), " ") for t in texts]
    chars = np.frombuffer("".join([f"{pad}{t} " for t in low]).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    size = np.fromiter((len(t) + order for t in low), dtype=np.int64, count=len(low))
    owner = np.repeat(np.arange(len(low)), size)
    letter = _letter_table()[chars]
    solid = letter | (chars == _PAD)
    keep = solid.copy()
    keep[1:] |= solid[:-1]  # of a run of other characters, the first
    text = np.where(solid, chars, 32)[keep].astype(np.uint64)
    owner = owner[keep]
    hashes = [_mix(text + np.uint64(1))]
    with np.errstate(over="ignore"):
        for k in range(1, order):
            hashes.append(_mix(hashes[-1][:-1] * np.uint64(0x9E3779B97F4A7C15) + text[k:]))
    at = np.flatnonzero(owner[: len(owner) - order + 1] == owner[order - 1:])
    ends = np.searchsorted(owner[at], np.arange(len(low)), side="right")
    return Grams(hashes, at, ends, np.bincount(owner, weights=letter[keep], minlength=len(low)).astype(np.int64))


# --- models -----------------------------------------------------------------

@dataclass
class Table:
    keys: np.ndarray
    values: np.ndarray  # a row for each key

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(self.keys):
            return np.zeros(len(h), dtype=np.int64), np.zeros(len(h), dtype=bool)
        i = np.minimum(np.searchsorted(self.keys, h), len(self.keys) - 1)
        return i, self.keys[i] == h


@dataclass
class LanguageModel:
    """``probs[k - 1]`` and ``backoffs[k - 1]`` are of order k; ``mean`` and ``limit`` calibrate the rejection."""

    order: int
    languages: list[str]
    probs: list[Table] = field(default_factory=list)
    backoffs: list[Table] = field(default_factory=list)
    unseen: np.ndarray | None = None  # of a character that no language has
    mean: np.ndarray | None = None
    limit: np.ndarray | None = None

    def log_probs(self, g: Grams, at: np.ndarray, k: int | None = None) -> np.ndarray:
        """A row for each n-gram of order k at ``at``, a column per language."""
        k = k or self.order
        if k == 0:
            return np.broadcast_to(self.unseen, (len(at), len(self.languages)))
        i, hit = self.probs[k - 1].find(g.hashes[k - 1][at])
        if hit.all():
            return self.probs[k - 1].values[i]
        out = np.empty((len(at), len(self.languages)), dtype=np.float32)
        out[hit] = self.probs[k - 1].values[i[hit]]
        miss = at[~hit]
        low = self.log_probs(g, miss + 1, k - 1).astype(np.float32) if k > 1 else np.repeat(self.unseen[None], len(miss), 0)
        if k > 1:
            j, known = self.backoffs[k - 1].find(g.hashes[k - 2][miss])
            low[known] += self.backoffs[k - 1].values[j[known]]
        out[~hit] = low
        return out

    def cross_entropy(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(nats per character, a row per text; characters scored; letters)."""
        g = grams(texts, self.order)
        n = np.diff(g.ends, prepend=0)
        run = np.zeros((len(g.at) + 1, len(self.languages)))
        step = 1 << 20
        for lo in range(0, len(g.at), step):
            part = self.log_probs(g, g.at[lo:lo + step])
            run[lo + 1:lo + 1 + len(part)] = part
        np.cumsum(run, axis=0, out=run)
        total = run[g.ends] - run[g.ends - n]
        return -total / np.maximum(n, 1)[:, None], n, g.letters

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        """(language, score, cross-entropy, rejected) for each text.

        The score is the posterior over the languages at 20 characters' worth
        of evidence at most, so that it doesn't only say how long a text is.
        """
        if not self.languages:
            m = len(texts)
            return ["und"] * m, np.zeros(m), np.full(m, np.nan), np.ones(m, dtype=bool)
        x, n, letters = self.cross_entropy(texts)
        best = x.argmin(axis=1)
        low = x[np.arange(len(x)), best]
        score = 1 / np.exp(-(x - low[:, None]) * np.minimum(n, 20)[:, None]).sum(axis=1)
        far = (low - self.mean[best]) * np.sqrt(np.minimum(n, SPREAD_CHARS)) > self.limit[best]
        none = letters == 0
        lang = ["und" if z else self.languages[b] for b, z in zip(best, none)]
        return lang, np.where(none, 0.0, score), np.where(none, np.nan, low), far | none


def build_model(order: int, languages: list[str], lang: np.ndarray, chain: list[np.ndarray], count: np.ndarray) -> LanguageModel:
    """From the distinct n-grams of the highest order with their language's number and count.

    ``chain`` holds, for k from ``order`` down to 1, the hashes of an n-gram's
    last k characters and of the k - 1 before its last (0 for none).
    """
    model, n_lang = LanguageModel(order, languages), len(languages)
    levels = []
    for _ in range(order):
        by = np.lexsort((chain[0], lang))
        lang, chain, count = lang[by], [c[by] for c in chain], count[by]
        first = run_starts(lang, chain[0])
        count = np.add.reduceat(count, first) if len(first) else count
        lang, chain = lang[first], [c[first] for c in chain]
        levels.append((lang, chain, count))
        # one order down an n-gram counts the distinct ones that end with it
        chain, count = chain[2:], np.ones(len(lang))
    low: Table | None = None
    for k, (lg, ch, c) in enumerate(reversed(levels), 1):
        once, twice = (c == 1).sum(), (c == 2).sum()
        d = once / (once + 2 * twice) if once and twice else 0.5
        ctx_keys, ctx_at = np.unique(ch[1], return_inverse=True)
        total, kinds = np.zeros((2, len(ctx_keys), n_lang))
        np.add.at(total, (ctx_at, lg), c)
        np.add.at(kinds, (ctx_at, lg), 1)
        left = np.where(total > 0, d * kinds / np.maximum(total, 1), 1.0)
        keys, first, at = np.unique(ch[0], return_index=True, return_inverse=True)
        row = ctx_at[first]  # an n-gram has the same context in every language
        p = np.zeros((len(keys), n_lang))
        np.add.at(p, (at, lg), np.maximum(c - d, 0))
        p /= np.maximum(total[row], 1)
        if k == 1:
            uniform = 1 / (2.0 * len(keys) + 1)
            p += left[row] * uniform
            model.unseen = np.log(left[0] * uniform).astype(np.float32)
        else:
            p += left[row] * np.exp(low.values[low.find(ch[2][first])[0]].astype(np.float64))
        low = Table(keys, np.log(p).astype(np.float32))
        model.probs.append(low)
        model.backoffs.append(Table(ctx_keys, np.log(left).astype(np.float32)))
    return model


def _chain_names(order: int) -> list[str]:
    return [f"{x}{k}" for k in range(order, 0, -1) for x in ("own", "ctx")]


def _count_grams(rows: DataFrame, order: int) -> DataFrame:
    """(lang, hashes of the chain, n) of (lang, text): counted in each batch, then added up."""
    names = _chain_names(order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sub_batches(batches, "text", SLICE):
            lang = np.asarray(b.column("lang").to_pylist(), dtype=object)
            texts = b.column("text").to_pylist()
            for name in sorted(set(lang)):
                g = grams([t for t, x in zip(texts, lang) if x == name], order)
                top, first, n = np.unique(g.hashes[order - 1][g.at], return_index=True, return_counts=True)
                at = g.at[first]
                cols = []
                for k in range(order, 0, -1):
                    cols.append(g.hashes[k - 1][at + order - k])
                    cols.append(g.hashes[k - 2][at + order - k] if k > 1 else np.zeros(len(at), dtype=np.uint64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(at)), *[pa.array(c.view(np.int64)) for c in cols], pa.array(n)],
                    ["lang", *names, "n"])

    parts = rows.mapInArrow(run, "lang string, " + ", ".join(f"{x} long" for x in names) + ", n long")
    return parts.groupBy("lang", *names).agg(F.sum("n").alias("n"))


def fit(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        order: int = 4, train_chars: int = TRAIN_CHARS, seed: int = 9) -> LanguageModel:
    """A model of every language in ``docs`` (rows without text or language are passed over).

    About ``train_chars`` characters a language are read, in pieces drawn from
    all its documents.  In the order of a hash, its documents serve the counts
    until they have 4 in 5 of those characters, and the others calibrate the
    rejection; the first always counts, so that every language is learned.
    Without any row the model is empty and every text is ``und``.
    """
    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")).where(
        "text is not null and lang is not null")
    chars = materialise(rows.groupBy("lang").agg(F.sum(F.length("text")).alias("chars")).withColumn(
        "part", F.least(F.lit(1.0), F.lit(float(train_chars)) / F.greatest("chars", F.lit(1)))), "lang-chars")
    known = rows.withColumn("doc", F.xxhash64(F.lit(seed), "id", "text")).join(F.broadcast(chars) if _few(chars) else chars, "lang")
    last = F.floor(F.greatest(F.length("text") - 1, F.lit(0)) / PIECE).cast("int")
    drawn = F.filter(F.sequence(F.lit(0), last), lambda i: F.pmod(F.xxhash64(F.lit(seed), "doc", i), F.lit(1 << 30)) / float(1 << 30) < F.col("part"))
    pieces = F.transform(drawn, lambda i: F.substr("text", i * PIECE + 1, F.lit(PIECE)))
    sample = materialise(known.select("lang", "doc", F.explode(pieces).alias("text")), "lang-drawn")
    # the sample is bounded, so a language's documents can be put in order
    order_of = Window.partitionBy("lang").orderBy("doc")
    before = F.coalesce(F.sum("chars").over(order_of.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    folds = sample.groupBy("lang", "doc").agg(F.sum(F.length("text")).alias("chars")).select(
        "lang", "doc", ((F.row_number().over(order_of) == 1) | (before < 0.8 * F.sum("chars").over(Window.partitionBy("lang")))).alias("count"))
    sample = materialise(sample.join(folds, ["lang", "doc"]).select("lang", "text", "count"), "lang-sample")
    names = _chain_names(order)
    got = _count_grams(sample.where("count").select("lang", "text"), order).toPandas()
    languages = sorted(got["lang"].unique())
    if not languages:
        return LanguageModel(order, [], mean=np.zeros(0), limit=np.zeros(0))
    number = {x: i for i, x in enumerate(languages)}
    model = build_model(order, languages, got["lang"].map(number).to_numpy(dtype=np.int64),
                        [got[c].to_numpy().view(np.uint64) for c in names], got["n"].to_numpy(dtype=np.float64))
    return _calibrate(model, sample.where(~F.col("count")).select("lang", "text"))


def _few(chars: DataFrame, most: int = 10_000) -> bool:
    return chars.limit(most + 1).count() <= most


def _calibrate(model: LanguageModel, rows: DataFrame) -> LanguageModel:
    """Means and limits from labelled texts that the counts did not see; a language without any rejects nothing."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        number = {x: i for i, x in enumerate(m.languages)}
        for b in sub_batches(batches, "text", SLICE):
            x, n, letters = m.cross_entropy(b.column("text").to_pylist())
            own = np.array([number.get(v, -1) for v in b.column("lang").to_pylist()])
            ok = (own >= 0) & (letters > 0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(own[ok]), pa.array(x[ok, own[ok]]), pa.array(n[ok])], ["lang", "x", "n"])

    seen = materialise(rows.mapInArrow(run, "lang long, x double, n long"), "lang-calibration")
    mean = seen.groupBy("lang").agg((F.sum(F.col("x") * F.col("n")) / F.sum("n")).alias("mean"))
    dev = (F.col("x") - F.col("mean")) * F.sqrt(F.least(F.col("n"), F.lit(SPREAD_CHARS)))
    top = seen.join(mean, "lang").groupBy("lang").agg(
        F.first("mean").alias("mean"), F.max(dev).alias("most"), F.stddev_pop(dev).alias("sd")).collect()
    model.mean = np.zeros(len(model.languages))
    model.limit = np.full(len(model.languages), np.inf)
    for r in top:  # beyond everything seen, and well beyond the usual spread
        model.mean[r["lang"]] = r["mean"]
        model.limit[r["lang"]] = max(1.25 * r["most"], 8 * r["sd"], LEAST_LIMIT)
    shared.unpersist()
    return model


def identify(docs: DataFrame, model: LanguageModel, *, text_col: str = "text") -> DataFrame:
    """``docs`` with lang_pred, lang_score, lang_xent and lang_rejected.

    Null texts and texts without a letter are ``und`` with score 0, and
    rejected.  Every row comes back once with all its columns; columns of these
    four names are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(texts: pa.Array, _: pa.StructArray) -> list[pa.Array]:
        lang, score, x, rejected = shared.value.predict(texts.to_pylist())
        return [pa.array(lang, pa.string()), pa.array(score), pa.array(x), pa.array(rejected)]

    new = [StructField("lang_pred", StringType()), StructField("lang_score", DoubleType()),
           StructField("lang_xent", DoubleType()), StructField("lang_rejected", BooleanType())]
    return map_texts(docs, text_col, new, run, max_bytes=SLICE)
