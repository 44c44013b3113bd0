"""The reference's three SQL-callable functions, as SQL functions.

``format_duration``, ``get_category_name`` and ``calculate_engagement`` are
registered as temporary SQL functions whose bodies are plain SQL expressions,
so Catalyst inlines them (no Python worker, codegen kept).  Same semantics as
the Column functions in ``columns``.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from clipstat.functions.dims import CATEGORY_NAMES, UNKNOWN_CATEGORY


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _category_map_sql() -> str:
    kv = ", ".join(f"{_q(k)}, {_q(v)}" for k, v in CATEGORY_NAMES.items())
    return f"map({kv})"


def _unit_sql(text: str, letter: str) -> str:
    return (f"coalesce(CASE WHEN instr({text}, '{letter}') > 0 "
            f"THEN try_cast(substring_index({text}, '{letter}', 1) AS BIGINT) END, 0)")


_DATE = "substring_index(substring_index(duration, 'T', 1), 'P', -1)"
_TIME = "CASE WHEN instr(duration, 'T') > 0 THEN substring_index(duration, 'T', -1) ELSE '' END"
_AFTER_H = f"substring_index({_TIME}, 'H', -1)"
_AFTER_M = f"substring_index({_AFTER_H}, 'M', -1)"

FORMAT_DURATION = f"""
CREATE OR REPLACE TEMPORARY FUNCTION format_duration(duration STRING) RETURNS INT RETURN
  coalesce(try_cast(try_add(try_add(try_add(
      try_multiply({_unit_sql(_DATE, 'D')}, 86400),
      try_multiply({_unit_sql(_TIME, 'H')}, 3600)),
      try_multiply({_unit_sql(_AFTER_H, 'M')}, 60)),
      {_unit_sql(_AFTER_M, 'S')}) AS INT), 0)
"""

CALCULATE_ENGAGEMENT = """
CREATE OR REPLACE TEMPORARY FUNCTION calculate_engagement(likes BIGINT, comments BIGINT, views BIGINT)
RETURNS DOUBLE RETURN
  (coalesce(CAST(likes AS DOUBLE), 0.0D) + coalesce(CAST(comments AS DOUBLE), 0.0D))
  / CAST(coalesce(nullif(views, 0), 1) AS DOUBLE) * 100.0
"""


def get_category_name_sql() -> str:
    return f"""
CREATE OR REPLACE TEMPORARY FUNCTION get_category_name(category_id STRING) RETURNS STRING RETURN
  coalesce(try_element_at({_category_map_sql()}, category_id), {_q(UNKNOWN_CATEGORY)})
"""


def register_sql_functions(spark: SparkSession) -> list[str]:
    """Register the three functions in the session; returns their names."""
    for stmt in (FORMAT_DURATION, get_category_name_sql(), CALCULATE_ENGAGEMENT):
        spark.sql(stmt)
    return ["format_duration", "get_category_name", "calculate_engagement"]
