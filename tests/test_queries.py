"""Every core query runs on the smallest tables; where there is SQL, DuckDB agrees."""

from pathlib import Path

import duckdb
import pytest

from loomline.plans import catalog

FOLDERS = [Path("/root/testdata/sf0.001"), Path("/root/testdata/sf0.01")]
pytestmark = pytest.mark.skipif(not FOLDERS[0].exists(), reason="no test tables")


def plain(value):
    return round(value, 6) + 0.0 if isinstance(value, float) else value


@pytest.fixture(scope="module")
def duck():
    connections = {}
    for folder in FOLDERS:
        connections[folder] = duckdb.connect()
        for path in folder.glob("*.parquet"):
            connections[folder].execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connections


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, duck, name):
    for folder in FOLDERS:  # the larger tables only where the smallest ones give nothing
        df = catalog.QUERIES[name](spark, str(folder))
        columns = sorted(df.columns)
        rows = [tuple(plain(r[c]) for c in columns) for r in df.collect()]
        if rows:
            break
    assert rows, "a query that gives nothing shows nothing"
    if name not in catalog.SQL:
        return
    result = duck[folder].execute(catalog.SQL[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    places = [names.index(c) for c in columns]
    expected = [tuple(plain(r[i]) for i in places) for r in result.fetchall()]
    key = lambda row: tuple(map(str, row))
    assert sorted(rows, key=key) == sorted(expected, key=key)


def test_every_sql_has_its_query():
    assert set(catalog.SQL) <= set(catalog.QUERIES)


def test_queries_of_single_terms_act(spark):
    """Scored rows hold candidates that keep terms, and such that do not."""
    rows = catalog.QUERIES["a6_preservation_rows"](spark, str(FOLDERS[0])).groupBy("status_exact").count().collect()
    assert {"all_matched", "not_matched", "no_terms"} <= {r["status_exact"] for r in rows}
    assert {r["priority"] for r in catalog.QUERIES["o1_review_sample"](spark, str(FOLDERS[0])).collect()} >= {0, 1}
