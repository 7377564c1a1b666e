"""The queries of this subpackage run on the smallest tables, with the columns asked for."""

from pathlib import Path

import duckdb
import pytest

from loomline.llm.queries import QUERIES, SQL

FOLDER = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="no test tables")

COLUMNS = {
    "p1_found": "table_name:string,record_id:string,field:string",
    "p2_found": "table_name:string,record_id:bigint",
    "p4_found": "segment_id:string,defect:string",
    "p5_found": "eval_id:string,train_id:string",
    "p6_found": "kept_id:string,copy_id:string",
    "p7_ids": "doc_id:bigint,ids:array<int>",
    "p8_found": "doc_id:bigint,item_id:bigint",
    "p9_found": "doc_id:bigint",
}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    df = QUERIES[name](spark, str(FOLDER))
    if name in COLUMNS:
        assert df.schema.simpleString() == f"struct<{COLUMNS[name]}>"
    rows = df.collect()
    assert rows
    if name in SQL:
        connection = duckdb.connect()
        for path in FOLDER.glob("*.parquet"):
            connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
        result = connection.execute(SQL[name])
        names = [d[0] for d in result.description]
        assert sorted(tuple(r[c] for c in names) for r in rows) == sorted(result.fetchall())


def test_found_cases_hold_each_case_once(spark):
    for name in ("p1_found", "p2_found", "p4_found", "p5_found", "p6_found", "p8_found", "p9_found"):
        df = QUERIES[name](spark, str(FOLDER))
        assert df.count() == df.distinct().count(), name
