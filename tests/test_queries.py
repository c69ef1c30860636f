"""Every named query against its SQL counterpart in DuckDB, value by value."""

import math
import os

import pytest

import __spark_entry__ as entry
from shopwright.plans.oracle import ORACLE
from shopwright.plans.queries import QUERIES

duckdb = pytest.importorskip("duckdb")

FOLDER = os.environ.get("QUERY_SF_DIR", "/root/testdata/sf0.01")
TABLES = [n[: -len(".parquet")] for n in os.listdir(FOLDER)] if os.path.isdir(FOLDER) else []

pytestmark = pytest.mark.skipif(not TABLES, reason="no test tables")

# Spark type -> accepted DuckDB types. The values are compared as Python objects.
KINDS = {
    "bigint": {"BIGINT"},
    "int": {"INTEGER"},
    "double": {"DOUBLE"},
    "string": {"VARCHAR"},
    "timestamp_ntz": {"TIMESTAMP"},
}


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


def canonical(rows):
    def cell(v):
        if v is None:
            return (0, "")
        if isinstance(v, float) and math.isnan(v):
            return (1, "nan")
        return (2, repr(v))

    return sorted(tuple(cell(v) for v in row) for row in rows)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


def test_entry(spark):
    assert entry.entry(spark).count() == 25


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, db, name):
    got = entry.queries()[name](spark, FOLDER)
    columns = sorted(got.columns)
    sql = entry.oracle_sql()[name]
    kinds = {c[0]: c[1] for c in db.execute(f"DESCRIBE {sql}").fetchall()}
    assert sorted(kinds) == columns
    for column, kind in got.dtypes:
        expected = KINDS.get(kind) or {kind.upper()}
        assert kinds[column] in expected, (column, kind, kinds[column])
    quoted = ", ".join(f'"{c}"' for c in columns)
    want = db.execute(f"SELECT {quoted} FROM ({sql})").fetchall()
    rows = [tuple(r) for r in got.select(*[f"`{c}`" for c in columns]).collect()]
    assert len(rows) == len(want)
    assert canonical(rows) == canonical(want)
