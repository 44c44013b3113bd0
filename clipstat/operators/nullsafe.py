"""Joins in which a null key is a key like any other.

``groupBy`` and ``partitionBy`` make a group of the rows whose key is null; a
join by ``=`` would lose that group again.  ``<=>`` keeps it, and still plans as
a hash or sort-merge equi-join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_null_safe(left: DataFrame, right: DataFrame, by: Sequence[str], never_null: Sequence[str] = (),
                   how: str = "inner") -> DataFrame:
    """``left`` joined with ``right`` on equal or equally null ``by`` and on equal ``never_null``; the keys appear once.

    Keys that can't be null join by ``=``, which keeps the partitioning and the
    order that a window on them has left behind.
    """
    keys = [*by, *never_null]
    if not by:
        return left.join(right, keys, how)
    named = right.withColumnsRenamed({k: f"_ns_{k}" for k in keys})
    on = F.lit(True)
    for k in keys:
        on = on & (F.col(k).eqNullSafe(F.col(f"_ns_{k}")) if k in by else F.col(k) == F.col(f"_ns_{k}"))
    return left.join(named, on, how).drop(*[f"_ns_{k}" for k in keys])
