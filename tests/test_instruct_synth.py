import shutil

from pyspark.sql import functions as F

from corpusmill.operators import instruct, synth
from corpusmill.streaming.incremental import build_instructions
from corpusmill.sources import sinks

CODE = "def f{0}(a):\n    return a + {0}\n"


class Flaky:
    """Asks once to wait, then answers; fails for good on some prompts."""

    def __init__(self):
        self.waited = False

    def complete(self, prompt, request):
        assert request.system == "be brief" and request.max_tokens == 9
        if "never" in prompt:
            raise instruct.RateLimited
        if "boom" in prompt:
            raise RuntimeError
        if not self.waited:
            self.waited = True
            raise instruct.RateLimited
        return ['"Please', ' do it."']


def test_completion_waits_and_names_failures(frame):
    df = frame([(1, "a"), (2, "boom"), (3, None), (4, "never")], "i int, p string")
    asked = instruct.completed(df, "p", Flaky, instruct.Request("be brief", 9), base_wait=0.0, jitter=0.0)
    got = {r.i: (r.answer, r.answer_error) for r in asked.collect()}
    assert got == {1: ('"Please do it."', None), 2: ("", "RuntimeError"), 3: (None, None), 4: ("", "RateLimited")}
    assert {tuple(r) for r in instruct.failures(asked).collect()} == {("RuntimeError", 1), ("RateLimited", 1)}
    assert instruct.completed(df.limit(0), "p", Flaky).collect() == []


def test_records_and_filters(frame):
    rows = [(1, CODE.format(1)), (2, None), (3, ""), (4, "x" * 7000), (5, "# Copyright\n" + "#" * 600 + "\nx = 1\ny = 2\n"), (6, "def f(")]
    df = frame(rows, "doc_id int, content string")
    got = instruct.function_instructions(df, "doc_id").collect()
    assert [(r.doc_id, [m.role for m in r.messages], r.messages[0].content) for r in got] == [(1, ["user", "assistant"], "Please write f1 in Python.")]
    assert {r.doc_id for r in instruct.document_instructions(df, "doc_id").collect()} == {1, 4, 5, 6}
    assert {r.doc_id for r in instruct.processed_ids(df, frame([(1,)], "doc_id int"), "doc_id").collect()} == {1, 2, 3}
    assert instruct.processed_ids(df, frame([(1,)], "doc_id int"), "doc_id", mark_failed=True).count() == 6


def test_scan_skips_processed(frame):
    df = frame([(i, "x") for i in range(5)], "doc_id int, content string")
    left = instruct.unprocessed(df, frame([(" 1 ",), ("",), (None,), ("x",), ("3",)], "id string"), "doc_id")
    assert [r.doc_id for r in instruct.newest(left, "doc_id", 2).collect()] == [4, 2]


def test_stream_neither_loses_nor_repeats(spark, frame, tmp_path):
    source, target, check = (str(tmp_path / x) for x in ("in", "out", "check"))
    schema = "doc_id long, content string"

    def run():
        build_instructions(spark, source, schema, target, check).awaitTermination()
        return sorted(r.doc_id for r in sinks.batch_records(spark, target, "doc_id long, idx int").collect())

    frame([(1, CODE.format(1)), (2, None)], schema).write.mode("append").parquet(source)
    assert run() == [1]
    frame([(1, CODE.format(1)), (3, CODE.format(3)), (4, "def f(")], schema).write.mode("append").parquet(source)
    assert run() == [1, 3] and run() == [1, 3]
    assert {r.id for r in sinks.batch_ids(spark, target).collect()} == {"1", "2", "3"}


def test_replayed_batch_is_neither_lost_nor_doubled(spark, frame, tmp_path):
    """A crash after the sink's commit but before the stream's, and one between a batch's records and its commit mark."""
    source, target, check = (str(tmp_path / x) for x in ("in", "out", "check"))
    schema = "doc_id long, content string"

    def run():
        build_instructions(spark, source, schema, target, check).awaitTermination()
        return sorted(r.doc_id for r in sinks.batch_records(spark, target, "doc_id long, idx int").collect())

    frame([(i, CODE.format(i)) for i in range(5)], schema).write.parquet(source)
    assert run() == list(range(5))
    for last in (tmp_path / "check" / "commits").iterdir():
        last.unlink()
    assert run() == list(range(5)) and run() == list(range(5))
    for last in (tmp_path / "check" / "commits").iterdir():
        last.unlink()
    shutil.rmtree(tmp_path / "out" / "commits")
    assert sinks.batch_records(spark, target, "doc_id long").count() == 0 and sinks.batch_ids(spark, target).count() == 0
    assert run() == list(range(5)) and {r.id for r in sinks.batch_ids(spark, target).collect()} == {str(i) for i in range(5)}


def test_examples_depend_on_the_seed_only(spark):
    one = synth.error_examples(spark, 400, 1)
    rows = {r.id: (r.kind, r.error_context.title, r.error_context.buggy_code_snippet, r.fixed_code_snippet) for r in one.collect()}
    assert rows == {r.id: (r.kind, r.error_context.title, r.error_context.buggy_code_snippet, r.fixed_code_snippet) for r in one.repartition(13).collect()}
    assert len({k for k, *_ in rows.values()}) == len(synth.TEMPLATES)
    assert synth.error_examples(spark, 0).count() == 0 and synth.error_examples(spark, 300, 1, numpy=False).where("kind = 'ValueError'").count() == 0


def test_fixed_snippets_run_and_buggy_ones_fail(spark):
    import contextlib
    import io

    for r in synth.error_examples(spark, 300, 5, numpy=False).collect():
        with contextlib.redirect_stdout(io.StringIO()), contextlib.suppress(PermissionError):
            exec(compile(r.fixed_code_snippet, "<fixed>", "exec"), {})
        if r.kind in ("PermissionError", "RecursionError", "NameError"):
            continue
        try:
            with contextlib.redirect_stdout(io.StringIO()):
                exec(compile(r.error_context.buggy_code_snippet, "<buggy>", "exec"), {})
            raised = None
        except Exception as e:
            raised = e
        assert raised is not None and r.error_context.title.split(":")[0] in {c.__name__ for c in type(raised).__mro__}, r


def test_persona_pairs(frame):
    personas = frame([({"role_context": "R", "output_requirement": "use --- Notes ---"},), ({"role_context": "한"},), ({"tone_context": None},)], "persona map<string,string>")
    snippets = frame([(i, "\n".join(f"line{i}{j}" for j in range(2 + i))) for i in range(4)] + [(9, None)], "i int, content string")
    out = synth.persona_pairs(snippets, personas, 200, "i", seed=3)
    rows = out.collect()
    assert len(rows) == 200 and rows == sorted(rows, key=lambda r: r.id) or len({r.id for r in rows}) == 200
    for r in rows:
        system, user, answer = (m.content for m in r.messages)
        head, tail = user.split("<｜fim begin｜>")[1].split("<｜fim hole｜>")
        middle = answer.split("\n\n--- Notes ---")[0]
        n = head[4]
        assert [head.split("\n")[0], *(head + "\n" + middle + "\n" + tail.replace("<｜fim end｜>", "")).split("\n")[1:]] == [f"line{n}{j}" for j in range(2 + int(n))]
        assert ("--- Notes ---" in answer) == system.startswith("R ")
        assert not system.startswith("한")
    assert synth.persona_pairs(snippets.limit(0), personas, 10, "i").count() == 0


def test_system_turn(frame):
    df = frame([({},), ({"role_context": " a", "task_instruction": "b"},)], "persona map<string,string>")
    assert [r.s for r in df.select(synth.system_turn(F.col("persona")).alias("s")).collect()] == [synth.DEFAULT_ROLE, "a  b"]
