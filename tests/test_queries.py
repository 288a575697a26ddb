"""Every query with SQL against DuckDB on the smallest tables."""

import datetime
import math
import os

import duckdb
import pytest

from normalake.plans import registry

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return v.isoformat() + "T00:00:00" if isinstance(v, datetime.date) else v


def ordered(rows, columns):
    at = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr([plain(r[i]) for i in at]) for r in rows)


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, con, name):
    df = registry.queries()[name](spark, SF)
    rows, r = df.collect(), con.execute(registry.oracle_sql()[name])
    columns = [x[0] for x in r.description]
    assert sorted(columns) == sorted(df.columns)
    assert ordered(rows, df.columns) == ordered(r.fetchall(), columns)
    assert rows


def test_library_does_not_import_the_llm_package():
    root = os.path.dirname(os.path.dirname(os.path.abspath(registry.__file__)))
    for folder, _, names in os.walk(root):
        if "llm" in os.path.relpath(folder, root).split(os.sep):
            continue
        for n in names:
            if n.endswith(".py"):
                with open(os.path.join(folder, n)) as f:
                    assert ".llm" not in f.read(), n
