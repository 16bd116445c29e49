import contextlib
import io
from pathlib import Path

import pytest

import __spark_entry__ as contract

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test data here")


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.mark.parametrize("name", ["p1_found", "p1_redacted_files", "p3_found", "p4_found", "p4_pieces", "p6_found", "p7_found", "p7_pairs", "p8_ids", "p10_found", "p10_replaced"])
def test_map_only(spark, name):
    text = plan(contract.queries()[name](spark, str(DATA)))
    assert "Exchange" not in text and "MapInArrow" in text


@pytest.mark.parametrize(
    ("name", "scan"),
    [
        ("p1_found", "struct<file_id:bigint,content:string>"), ("p3_found", "struct<file_id:bigint,file_path:string,content:string>"), ("p4_found", "struct<triple_id:bigint,target_code:string>"),
        ("p7_found", "struct<file_id:bigint,file_path:string,content:string>"), ("p8_ids", "struct<doc_id:bigint,text:string>"), ("p10_found", "struct<doc_id:bigint,text:string>"),
    ],
)
def test_scans_read_what_the_operator_names(spark, name, scan):
    assert f"ReadSchema: {scan}" in plan(contract.queries()[name](spark, str(DATA)))


@pytest.mark.parametrize("name", sorted(n for n in contract.queries() if n[0] == "p" and n[1].isdigit()))
def test_no_cross_joins(spark, name):
    text = plan(contract.queries()[name](spark, str(DATA)))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
