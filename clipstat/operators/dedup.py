"""Latest-snapshot selection.

``latest_per_key`` keeps one row per key: the one with the greatest ordering
columns, ties broken by the remaining columns so the pick is deterministic.

It ranks the rows of a key and keeps the first.  Spark trims each task to one row
per key before the shuffle (``WindowGroupLimit``), so a key repeated in a third of
all rows (a hot comment re-fetched in every snapshot) reaches the shuffle as one
row per task.  Rows are compared on the key and the ordering columns; the others
decide only between rows that are equal in those.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _as_list(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def latest_per_key(df: DataFrame, keys: str | Sequence[str], order_by: str | Sequence[str]) -> DataFrame:
    """One row per ``keys``: greatest ``order_by`` (nulls lose), then remaining columns.

    A row in which a key is null names nothing it could repeat: all such rows
    stay.  Each is a key of its own, in the same pass: the input is read once.
    """
    keys, order_by = _as_list(keys), _as_list(order_by)
    unnamed = F.lit(False)
    for k in keys:
        unnamed = unnamed | F.col(k).isNull()
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    latest = Window.partitionBy(*keys, "_own").orderBy(*[F.col(c).desc_nulls_last() for c in (*order_by, *rest)])
    ranked = df.withColumn("_own", F.when(unnamed, F.monotonically_increasing_id())).withColumn("_rank", F.row_number().over(latest))
    return ranked.filter("_rank = 1").select(*df.columns)
