"""The plans are those that a large cluster needs: pruned columns, filters before Python, no shuffle where none is due."""

import contextlib
import io
from pathlib import Path

import pytest

import __spark_entry__ as contract
from corpusmill.operators import instruct, quality, synth
from corpusmill.operators.joins import anti_join_in_place, hot_keys, skew_safe_join
from corpusmill.runtime import shared_dir, table

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test data here")


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.mark.parametrize(
    ("name", "columns"),
    [
        ("text_metrics", "struct<file_id:bigint,content:string>"),
        ("license_filter", "struct<file_id:bigint,content:string>"),
        ("file_structure", "struct<file_id:bigint,file_path:string,content:string>"),
        ("short_fim_files", "struct<file_id:bigint,file_path:string,content:string>"),
        ("long_fim_files", "struct<file_id:bigint,file_path:string,content:string>"),
        ("import_move", "struct<triple_id:bigint,prefix_code:string,target_code:string,suffix_code:string>"),
        ("fim_chat_render", "struct<triple_id:bigint,prefix_code:string,target_code:string,suffix_code:string>"),
        ("spacing_normalize", "struct<record_id:bigint,messages:array<struct<role:string,content:string>>>"),
        ("instructions_document", "struct<file_id:bigint,file_path:string,content:string>"),
    ],
)
def test_work_per_text_needs_no_shuffle_and_reads_its_columns_only(spark, name, columns):
    text = plan(contract.queries()[name](spark, str(DATA)))
    assert "Exchange" not in text and "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert f"ReadSchema: {columns}" in text


def test_extension_and_null_filters_reach_the_scan(spark):
    text = plan(contract.queries()["long_fim_files"](spark, str(DATA)))
    assert "IsNotNull(content)" in text and "StringEndsWith(file_path,.py)" in text


def test_the_length_filter_runs_before_any_parse(spark):
    text = plan(contract.queries()["quality_labels"](spark, str(DATA)))
    tree = text[: text.index("\n\n")]
    assert tree.index("ArrowEvalPython") < tree.rindex("Filter")  # the tree is printed from the result down to the scans


def test_the_newest_rows_are_a_top_k(spark):
    assert "TakeOrderedAndProject" in plan(contract.queries()["newest_unprocessed"](spark, str(DATA)))


def exchanged(text):
    """Columns that go through a shuffle or broadcast."""
    blocks = text.split("\n\n")
    return " ".join(b.split("Input [", 1)[1].split("\n")[0] for b in blocks if "Exchange\n" in b + "\n" and "Input [" in b)


def test_texts_of_rows_that_stay_are_never_exchanged(spark):
    docs = table(spark, str(DATA), "source_docs").select("file_id", "repo", "content")
    assert "content" not in exchanged(plan(quality.first_of_each(quality.drop_empty(docs), ["content"], "file_id")))
    done = table(spark, str(DATA), "chat_records").select("doc_id")
    assert "content" not in exchanged(plan(instruct.unprocessed(docs, done, "file_id")))
    assert "part" in exchanged(plan(instruct.unprocessed(docs, done, "file_id")))


def test_few_draws_leave_the_texts_where_they_are(spark):
    docs = table(spark, str(DATA), "source_docs").select("file_id", "content")
    people = spark.createDataFrame([({"role_context": "r"},)], "persona map<string,string>")
    text = plan(synth.persona_pairs(docs, people, 10, "file_id"))
    assert "BroadcastHashJoin" in text and "content" not in exchanged(text) and "lines" not in exchanged(text)


def test_anti_join_in_place_equals_the_plain_one(frame):
    rows = frame([(i, f"text {i}") for i in range(500)] + [(None, "none")], "k int, t string")
    for gone in ([], [3], list(range(0, 500, 3)), list(range(500)), [None, 7, 7]):
        removed = frame([(g,) for g in gone], "k int")
        got = anti_join_in_place(rows, removed, "k")
        assert got.columns == rows.columns and sorted(r.k or -1 for r in got.collect()) == sorted(k or -1 for k in [*range(500), None] if k is None or k not in gone)


def test_skewed_join_equals_the_plain_one(frame):
    many = frame([(1 if i % 3 else i, i) for i in range(3000)] + [(None, -1)], "k int, n int")
    few = frame([(k, k * 10) for k in range(0, 3000, 2)] + [(1, 10)], "k int, v int")
    assert hot_keys(many, "k") == [1]
    assert sorted(map(tuple, skew_safe_join(many, few, "k").collect())) == sorted(map(tuple, many.join(few, "k").collect()))


def test_a_cluster_needs_a_shared_folder():
    class Context:
        master = "spark://host:7077"
        getConf = lambda self: {}
        getCheckpointDir = lambda self: None

    class Session:
        sparkContext = Context()

    with pytest.raises(ValueError, match="checkpoint"):
        shared_dir(Session())
