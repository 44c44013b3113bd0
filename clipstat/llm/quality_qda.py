"""Document quality by a regularised quadratic discriminant.

A text becomes a vector of transformed statistics (shares by arcsine of the
root, sizes by logarithm).  Each class is a normal distribution: its mean, and
its covariance shrunk towards the pooled one and then towards a multiple of the
identity in standardised units.  The score of a text is the difference of the
two log densities, each a Mahalanobis distance solved with the class's cached
Cholesky factor plus its log determinant, turned into a probability by a
logistic curve that is fitted on the training rows.

Fitting reads sums and sums of products over all labelled rows, added up by
Spark; what reaches the driver is a few hundred numbers a class.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from clipstat.llm.common import map_texts, materialise

FEATURES = ("chars", "words", "lines", "word_length", "line_words", "upper", "digit", "symbol", "space", "other_script",
            "distinct_words", "top_word", "distinct_lines", "all_caps", "symbol_end", "symbol_words", "long_words", "same_as_last")
_classes: list[np.ndarray] = []


def _class_table() -> np.ndarray:
    """0 lower-case letter, 1 upper-case, 2 digit, 3 white space, 4 symbol, 5 letter without case."""
    if not _classes:
        t = np.full(0x110000, 4, dtype=np.uint8)
        for i in range(0x110000):
            c = chr(i)
            if c.isalpha():
                t[i] = 1 if c.isupper() else 0 if c.islower() else 5
            elif c.isdigit():
                t[i] = 2
            elif c.isspace():
                t[i] = 3
        _classes.append(t)
    return _classes[0]


def statistics(text: str | None) -> list[float]:
    """The features of one text; null counts as empty, and an empty text has zeros."""
    text = text or ""
    words = text.split()
    lines = [x for x in text.split("\n") if x.strip()]
    n, w = max(len(text), 1), max(len(words), 1)
    kind = np.bincount(_class_table()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)], minlength=6) / n
    seen = Counter(words)
    share = [
        kind[1], kind[2], kind[4], kind[3], kind[5],
        len(seen) / w if words else 0.0,
        max(seen.values(), default=0) / w,
        len(set(lines)) / len(lines) if lines else 0.0,
        sum(k for x, k in seen.items() if len(x) > 1 and x.isupper()) / w,
        sum(k for x, k in seen.items() if not x[-1].isalnum()) / w,
        sum(k for x, k in seen.items() if not any(map(str.isalnum, x))) / w,
        sum(k for x, k in seen.items() if len(x) > 15) / w,
        sum(a == b for a, b in zip(words, words[1:])) / w,
    ]
    size = [len(text), len(words), len(lines), sum(map(len, words)) / w, len(words) / max(len(lines), 1)]
    return [*np.log1p(size), *np.arcsin(np.sqrt(np.minimum(share, 1.0)))]


def features(docs: DataFrame, *, text_col: str = "text", keep: list[str]) -> DataFrame:
    """The columns ``keep`` and an array ``x`` of the features of every row's text."""
    def run(texts: pa.Array, _: pa.StructArray) -> list[pa.Array]:
        return [pa.array([statistics(t) for t in texts.to_pylist()], pa.list_(pa.float64()))]

    return map_texts(docs, text_col, [StructField("x", ArrayType(DoubleType()))], run, keep=keep)


@dataclass
class Discriminant:
    """``centre`` and ``scale`` standardise; of class k: ``mean[k]``, Cholesky factor ``factor[k]``, constant ``level[k]``."""

    centre: np.ndarray
    scale: np.ndarray
    mean: np.ndarray
    factor: np.ndarray
    level: np.ndarray
    slope: float = 1.0
    shift: float = 0.0

    def log_ratio(self, x: np.ndarray) -> np.ndarray:
        """Log density of class 1 less that of class 0 for each row, priors included."""
        z = (x - self.centre) / self.scale
        out = []
        for k in (0, 1):
            y = np.linalg.solve(self.factor[k], (z - self.mean[k]).T)
            out.append(self.level[k] - 0.5 * (y * y).sum(axis=0))
        return out[1] - out[0]

    def score(self, x: np.ndarray) -> np.ndarray:
        t = self.slope * self.log_ratio(x) + self.shift
        return 1 / (1 + np.exp(-np.clip(t, -700, 700)))


def _sums(rows: DataFrame, label: str) -> dict[int, tuple[float, np.ndarray, np.ndarray]]:
    """Count, sums and sums of products of each class, added up in each batch and then by Spark."""
    d = len(FEATURES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            y = b.column("y").to_numpy(zero_copy_only=False)
            x = np.array(b.column("x").to_pylist(), dtype=float).reshape(-1, d)
            for k in (0, 1):
                own = x[y == k]
                s = np.concatenate([[len(own)], own.sum(axis=0), (own.T @ own).ravel()])
                yield pa.RecordBatch.from_arrays([pa.array([k] * len(s)), pa.array(np.arange(len(s))), pa.array(s)], ["y", "i", "s"])

    got = rows.select(F.col(label).alias("y"), "x").mapInArrow(run, "y long, i long, s double").groupBy("y", "i").agg(F.sum("s").alias("s")).collect()
    out = {}
    for k in (0, 1):
        s = np.zeros(1 + d + d * d)
        for r in got:
            if r["y"] == k:
                s[r["i"]] = r["s"]
        out[k] = (s[0], s[1:1 + d], s[1 + d:].reshape(d, d))
    return out


def fit(rows: DataFrame, *, label: str = "y", to_pooled: float = 0.1, to_identity: float = 0.02) -> Discriminant:
    """From rows (x, label 0 or 1).  A class without rows takes the pooled mean; both without, every score is 0.5."""
    sums = _sums(rows, label)
    d = len(FEATURES)
    n = sum(s[0] for s in sums.values())
    if not n:
        return Discriminant(np.zeros(d), np.ones(d), np.zeros((2, d)), np.stack([np.eye(d)] * 2), np.zeros(2))
    centre = (sums[0][1] + sums[1][1]) / n
    spread = np.sqrt(np.maximum(np.diag(sums[0][2] + sums[1][2]) / n - centre**2, 0))
    scale = np.where(spread > 1e-9, spread, 1.0)
    means, covs, counts = np.zeros((2, d)), np.zeros((2, d, d)), np.zeros(2)
    for k, (c, s, ss) in sums.items():
        counts[k] = c
        if c:
            m = s / c
            covs[k] = (ss / c - np.outer(m, m)) / np.outer(scale, scale)
            means[k] = (m - centre) / scale
    pooled = (counts[0] * covs[0] + counts[1] * covs[1]) / n
    factor, level = np.zeros((2, d, d)), np.zeros(2)
    for k in (0, 1):
        own = covs[k] if counts[k] else pooled
        shrunk = (1 - to_pooled) * own + to_pooled * pooled
        shrunk = (1 - to_identity) * shrunk + to_identity * max(np.trace(pooled) / d, 1e-6) * np.eye(d)
        factor[k] = np.linalg.cholesky(shrunk)
        level[k] = np.log((counts[k] + 1) / (n + 2)) - np.log(np.diag(factor[k])).sum()
    return _calibrate(Discriminant(centre, scale, means, factor, level), rows, label)


def _calibrate(model: Discriminant, rows: DataFrame, label: str) -> Discriminant:
    """Slope and shift of the logistic curve, from counts of the log ratio in 0.25-wide steps (steps beyond +-100 fall together)."""
    bins = predict(rows, model, out="t", raw=True).groupBy(
        F.col(label).alias("y"), F.floor(F.least(F.greatest(F.col("t"), F.lit(-100.0)), F.lit(100.0)) * 4).alias("b")).agg(F.count("*").alias("n")).collect()
    t = np.array([(r["b"] + 0.5) / 4 for r in bins])
    y = np.array([float(r["y"]) for r in bins])
    n = np.array([float(r["n"]) for r in bins])
    if len(set(y)) < 2:
        return model
    w = np.array([0.1, 0.0])
    prior = np.array([1e-3, 1e-3]) * n.sum()  # keeps the curve finite when the classes separate
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(w[0] * t + w[1], -50, 50)))
        g = np.array([(n * (p - y) * t).sum(), (n * (p - y)).sum()]) + prior * (w - [0.1, 0])
        v = n * p * (1 - p)
        h = np.array([[(v * t * t).sum(), (v * t).sum()], [(v * t).sum(), v.sum()]]) + np.diag(prior)
        step = np.linalg.solve(h, g)
        w = w - np.clip(step, -0.5, 0.5)
        if np.abs(step).max() < 1e-9:
            break
    if w[0] <= 0:
        return model
    model.slope, model.shift = float(w[0]), float(w[1])
    return model


def predict(rows: DataFrame, model: Discriminant, *, out: str = "score", raw: bool = False) -> DataFrame:
    """``rows`` (with x) and the probability of class 1, or the log ratio."""
    own = [c for c in rows.columns if c not in ("x", out)]
    shared = rows.sparkSession.sparkContext.broadcast(model)
    schema = StructType([*[f for f in rows.schema if f.name in own], StructField(out, DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            if b.num_rows:
                x = np.array(b.column("x").to_pylist(), dtype=float).reshape(-1, len(FEATURES))
                s = m.log_ratio(x) if raw else m.score(x)
                yield pa.RecordBatch.from_arrays([*[b.column(c) for c in own], pa.array(s)], [*own, out])

    return rows.select(*own, "x").mapInArrow(run, schema)


def quality(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """(id, score) for every row of ``docs``; learned from ``labels`` (id, label), one or more rows an id.

    Null texts count as empty and have a score like any other.  Labels that are
    null, neither 0 nor 1, or of unknown ids are passed over; an id that is
    labelled twice counts twice.  An empty table gives an empty result, and
    without usable labels every score is 0.5.
    """
    x = materialise(features(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), keep=["id"]), "quality-features")
    y = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).where("y in (0, 1)")
    model = fit(x.join(y, "id").select("x", "y"))
    return predict(x, model)
