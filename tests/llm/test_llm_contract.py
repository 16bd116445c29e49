from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from corpusmill.llm import queries

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test data here")
COLUMNS = {
    "p1_found": ["tbl", "rec_id", "msg_idx", "line_no"], "p2_found": ["keep_id", "copy_id"], "p3_found": ["file_id"], "p4_found": ["tbl", "rec_id"], "p5_found": ["file_id", "nl_lang"], "p6_found": ["record_id", "defect"],
    "p7_found": ["file_id", "def_line"], "p8_ids": ["doc_id", "ids"], "p9_found": ["doc_id", "item_id"], "p10_found": ["doc_id", "kind"],
}


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_query(spark, name):
    df = contract.queries()[name](spark, str(DATA))
    n = df.count()
    assert n > 0 or name == "p10_collisions"
    if name in COLUMNS:
        assert df.columns == COLUMNS[name]
    sql = queries.oracle_sql().get(name)
    if sql:
        c = duckdb.connect()
        for p in DATA.glob("*.parquet"):
            c.sql(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
        other = c.sql(sql)
        at = [other.columns.index(x) for x in df.columns]
        assert sorted(map(tuple, df.collect()), key=repr) == sorted((tuple(r[i] for i in at) for r in other.fetchall()), key=repr)
