"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from clipstat.session import checkpoint_dir

#: A word: a run of characters other than space, tab, LF, VT, FF, CR.
WORD = r"[^\x20\x09-\x0D]+"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet in the cluster's shared checkpoint folder and read it back.

    It cuts the lineage, survives the loss of executors, and the table can be
    read several times without running its plan again.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm-{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def n_words(text: Column) -> Column:
    """Number of words; null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def slices(texts: pa.Array, max_bytes: int) -> Iterator[tuple[int, int]]:
    """(start, rows) of stretches with at most about ``max_bytes`` of text each, one row at least."""
    end = np.cumsum(np.asarray(pc.binary_length(texts).fill_null(0), dtype=np.int64))
    lo = 0
    while lo < len(end):
        base = end[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(end, base + max_bytes, side="right")))
        yield lo, hi - lo
        lo = hi


def sub_batches(batches: Iterator[pa.RecordBatch], text_col: str, max_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of at most about ``max_bytes`` of text, one row at least.

    It bounds the memory a Python task needs, however long the texts are.
    """
    for b in batches:
        for lo, n in slices(b.column(text_col), max_bytes):
            yield b.slice(lo, n)


def whole_groups(batches: Iterator[pa.RecordBatch], key_cols: list[str], min_rows: int = 100_000) -> Iterator[pa.Table]:
    """Tables of whole key groups from a partition that is sorted by the keys.

    Each table holds at least ``min_rows`` rows (but the last), and never part
    of a group: rows after the last change of key wait for the next table.
    """
    held: list[pa.RecordBatch] = []
    rows = 0
    for b in batches:
        if not b.num_rows:
            continue
        held.append(b)
        rows += b.num_rows
        if rows < min_rows:
            continue
        t = pa.Table.from_batches(held).combine_chunks()
        change = np.zeros(t.num_rows, dtype=bool)
        for k in key_cols:
            v = t.column(k).to_numpy()
            change[1:] |= v[1:] != v[:-1]
        cuts = np.flatnonzero(change)
        if not len(cuts):
            held = t.to_batches()
            continue
        cut = int(cuts[-1])
        yield t.slice(0, cut)
        held = t.slice(cut).to_batches()
        rows = t.num_rows - cut
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def run_starts(*keys: np.ndarray) -> np.ndarray:
    """Positions at which a run of equal keys starts."""
    n = len(keys[0])
    new = np.zeros(n, dtype=bool)
    if n:
        new[0] = True
        for k in keys:
            new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


def local_labels(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index of each of ``n`` nodes' component under the links (a, b)."""
    lab = np.arange(n)
    if not len(a):
        return lab
    while True:
        m = np.minimum(lab[a], lab[b])
        new = lab.copy()
        np.minimum.at(new, lab[a], m)
        np.minimum.at(new, lab[b], m)
        np.minimum.at(new, a, m)
        np.minimum.at(new, b, m)
        while True:
            jump = new[new]
            if np.array_equal(jump, new):
                break
            new = jump
        if np.array_equal(new, lab):
            return lab
        lab = new


def spare(df: DataFrame, name: str) -> str:
    """``name``, or it with underscores in front if ``df`` has such a column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def column(name: str) -> Column:
    """The column of exactly that name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def map_texts(df: DataFrame, text_col: str, new: list[StructField], run: Callable[[pa.Array, pa.StructArray], list[pa.Array]],
              *, keep: list[str] | None = None, max_bytes: int = 1 << 20) -> DataFrame:
    """``df`` with new columns that ``run`` makes of the texts, slice by slice.

    ``run`` gets the texts as strings (null stays null) and the rows they are
    from, as a struct array.  Columns of the new names are replaced; all rows and other columns
    come back as they are.
    """
    names = [f.name for f in new]
    own = [c for c in (df.columns if keep is None else keep) if c.lower() not in {n.lower() for n in names}]
    row = F.struct(F.lit(0).alias("no_column_of_row"), *[column(c) for c in own])
    inside = text_col in own and isinstance(df.schema[text_col].dataType, StringType)  # then it need not travel twice
    src = df.select(row.alias("row"), *([] if inside else [column(text_col).cast("string").alias("text")]))
    schema = StructType([src.schema["row"], *new])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = b.column("row")
            texts = rows.field(text_col) if inside else b.column("text")
            for lo, n in slices(texts, max_bytes):
                yield pa.RecordBatch.from_arrays([rows.slice(lo, n), *run(texts.slice(lo, n), rows.slice(lo, n))], schema.names)

    made = src.mapInArrow(each, schema)
    return made.select(*[F.col("row").getField(c).alias(c) for c in own], *names)
