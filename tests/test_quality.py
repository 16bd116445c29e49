import pytest

from corpusmill.operators import quality
from corpusmill.operators.quality import PipelineConfig

GOOD = "def f{0}(a):\n    return a + {0}\n"


def test_missing_column_is_an_error(frame):
    with pytest.raises(KeyError):
        quality.drop_empty(frame([(1,)], "i int"))


def test_white_space_only_rows_stay(frame):
    got = quality.drop_empty(frame([(1, None), (2, ""), (3, "  "), (4, "é")], "i int, content string"))
    assert sorted((r.i, r.original_content_length) for r in got.collect()) == [(3, 2), (4, 1)]


def test_first_of_equal_rows_stays_and_hot_texts_dont_hurt(frame):
    rows = [(i, "same" if i % 3 else f"own {i}", None if i % 2 else "x") for i in range(1, 301)]
    df = frame(rows, "i int, content string, content_2 string").repartition(7)
    assert sorted(r.i for r in quality.first_of_each(df, ["content"], "i").collect()) == sorted({min(i for i, c, _ in rows if c == k) for k in {c for _, c, _ in rows}})
    assert quality.first_of_each(df, ["content", "content_2"], "i").where("content = 'same'").count() == 2


def test_nulls_are_equal_in_deduplication(frame):
    df = frame([(1, None), (2, None), (3, "null")], "i int, content string")
    assert sorted(r.i for r in quality.first_of_each(df, ["content"], "i").collect()) == [1, 3]


def test_rules(frame):
    deep = "def f(a):\n" + "".join(f"    if a == {i}:\n        return {i}\n" for i in range(60))
    rows = [(1, GOOD.format(1)), (2, "def broken(:\n    pass\n"), (3, "x=1"), (4, deep), (5, GOOD.format(1))]
    got = {r.i: r.label for r in quality.labelled(frame(rows, "i int, content string"), "i").collect()}
    assert got == {1: 1, 2: 0, 4: 0}
    legacy = {r.i: r.label for r in quality.labelled(frame(rows, "i int, content string"), "i", PipelineConfig(legacy_cc=True, min_maintainability=0)).collect()}
    assert legacy[4] == 1


def test_pipeline_parts_are_disjoint_and_complete(frame):
    rows = [(i, GOOD.format(i) * (1 + i % 3) + (f"# {'x' * (50 * i)}\n" if i % 20 == 0 else "")) for i in range(120)] + [(200, "def broken(:\n    pass\n"), (201, None)]
    out = quality.pipeline(frame(rows, "i int, content string"), "i").cache()
    assert out.count() == 121
    assert out.where("label = 1 AND removed_by IS NOT NULL").count() == 0 and out.where("label = 0 AND removed_by IS NULL").count() == 0
    assert quality.good(out).count() + quality.bad(out).count() == 121
    assert {r.stage for r in quality.stage_counts(out).collect()} <= {"kept", "rules", "isolation", "lof"}


def test_empty_table(frame):
    assert quality.pipeline(frame([], "i int, content string"), "i").count() == 0


def test_configuration():
    cfg = PipelineConfig.from_mapping({"SOURCE": "s", "MIN_CONTENT_LENGTH": "3"})
    assert (cfg.source, cfg.min_content_length, cfg.good_path, cfg.load_limit) == ("s", 3, "train.jsonl", 0)
    with pytest.raises(ValueError):
        PipelineConfig.from_mapping({})
    with pytest.raises(ValueError):
        PipelineConfig(contamination=0.7)


def test_run_writes_both_files_and_counts(spark, frame, tmp_path):
    rows = [(i, f"import os\n\ndef f{i}(a):\n    return a + {i % 7}\n" + "x = 1\n" * (i % 5)) for i in range(40)] + [(50, "def broken("), (51, "def broken("), (52, None), (53, "x = 1")]
    frame(rows, "file_id long, content string").write.parquet(str(tmp_path / "in"))
    cfg = quality.PipelineConfig.from_mapping({"SOURCE": str(tmp_path / "in"), "OUTPUT_GOOD_JSONL_FILE": str(tmp_path / "good"), "OUTPUT_BAD_JSONL_FILE": str(tmp_path / "bad")})
    counts = {r.stage: r.n_rows for r in quality.run(spark, cfg, "file_id").collect()}
    good, bad = (spark.read.json(str(tmp_path / x)) for x in ("good", "bad"))
    assert good.count() == counts["kept"] and bad.count() == sum(counts.values()) - counts["kept"] and sum(counts.values()) == 41
    assert {r.file_id for r in bad.where("removed_by = 'rules'").collect()} == {50} and not {r.file_id for r in good.collect()} & {r.file_id for r in bad.collect()}
    report = {r.stage: r.n_rows for r in quality.stage_report(frame(rows, "file_id long, content string"), "file_id").collect()}
    assert report == {"loaded": 44, "with_content": 43, "distinct": 42, "long_enough": 41, "good": 40, "bad": 1}
    assert {r.n_rows for r in quality.stage_report(frame([], "file_id long, content string"), "file_id").collect()} == {0}
