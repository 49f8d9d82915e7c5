"""Every registered query with an oracle equals its DuckDB SQL at sf0.01 (rows, columns, values)."""

import hashlib

import pytest

import __spark_entry__ as E
from samples import SF001
from fairsketch.plans.oracle import ORACLE_SQL
from fairsketch.plans.queries import QUERIES

ORACLE = {k: v for k, v in E.oracle_sql().items() if k in QUERIES}
# the stream queries share one stream run; keep them together at the end
NAMES = sorted(ORACLE, key=lambda n: (n.startswith("stream_"), n))


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return repr(v + 0.0)
    return str(v)


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


def test_every_query_has_oracle_or_is_rows_only():
    rows_only = set(QUERIES) - set(ORACLE_SQL)
    assert not rows_only


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF001)
    rows = [tuple(r) for r in df.collect()]
    rel = duck.sql(ORACLE[name])
    orows = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert len(rows) == len(orows)
    assert _digest(df.columns, rows) == _digest(rel.columns, orows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["method", "phi_a", "phi_b", "phi"]
    rows = {r["method"]: r for r in df.collect()}
    assert set(rows) == {"standard", "fair"}
    for r in rows.values():
        assert r["phi"] == max(r["phi_a"], r["phi_b"])
