"""Every registered query against its DuckDB oracle.

sf0.001 by default; ``CLIPSTAT_ORACLE_SF=/root/testdata/sf0.01`` runs it at the
driver's scale.
"""

import os

import pytest

import __spark_entry__ as E
from clipstat.plans import registry
from tests.conftest import SF_TINY
from tests.oracle_harness import compare, duck

NAMES = sorted(registry.QUERIES)
SF = os.environ.get("CLIPSTAT_ORACLE_SF", SF_TINY)


def test_every_query_has_oracle_or_is_declared_rows_only():
    assert set(registry.QUERIES) == set(registry.ORACLE)
    assert set(registry.QUERIES) <= set(E.queries())
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, name):
    r = compare(spark, duck(SF), name, E.queries()[name], E.oracle_sql().get(name), SF)
    assert r["ok"] is not False, r


def test_query_names_follow_survey_ids():
    import re

    pattern = re.compile(r"^[A-Z]\d+(_[A-Z]\d+)*_[a-z0-9_]+$")
    bad = [n for n in NAMES if not pattern.match(n)]
    assert not bad, bad
