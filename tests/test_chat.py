from corpusmill.operators import chat

SCHEMA = "i int, messages array<struct<role:string,content:string>>"


def test_dialogue(frame):
    df = frame([(5, [("user", "q"), ("assistant", "a")]), (7, None), (6, [("tOOL", None)])], SCHEMA)
    got = [r.value for r in chat.pretty_dialogues(df, "i").orderBy("i").collect()]
    rule = "-" * 30 + "\n\n"
    assert got == ["--- Dialogue 1 ---\nUser:\nq\n\nAssistant:\na\n\n" + rule, "--- Dialogue 2 ---\nTool:\n\n\n" + rule, "--- Dialogue 3 ---\n" + rule]


def test_numbers_are_dense_over_many_partitions(frame):
    df = frame([(i,) for i in range(500)], "i int").repartition(11)
    assert [(r.i, r.n) for r in chat.numbered(df, "i").orderBy("i").collect()] == [(i, i + 1) for i in range(500)]
    assert chat.numbered(df.limit(0), "i").count() == 0


def test_only_the_first_answer_is_normalised(frame):
    df = frame([(1, [("assistant", None), ("assistant", "a\n\n\nb "), ("assistant", " c ")]), (2, [("user", " u ")]), (3, None)], SCHEMA)
    got = {r.i: r.messages for r in chat.normalized_spacing(df).collect()}
    assert [m.content for m in got[1]] == [None, "a\n\nb", " c "] and got[2][0].content == " u " and got[3] is None


def test_code_of_assistant_turns(frame):
    df = frame([(1, [("user", "```\nno```"), ("assistant", "```python\nA\n``` and ```\nB```"), ("assistant", " x ")]), (2, None)], SCHEMA)
    assert [(r.turn, r.block, r.code) for r in chat.assistant_code(df, "i").orderBy("turn", "block").collect()] == [(1, 0, "A\n"), (1, 1, "B"), (2, 0, "x")]


def test_turns_and_back(frame):
    df = frame([(1, [("user", "a"), ("assistant", None)]), (2, [])], SCHEMA)
    assert [(r.i, [tuple(m) for m in r.messages]) for r in chat.regrouped(chat.turns(df, "i"), "i").collect()] == [(1, [("user", "a"), ("assistant", None)])]


def test_merging_keeps_the_first_and_tells_null_from_empty(frame):
    df = frame([(2, "a", "", ""), (1, "a", "", ""), (3, "a", None, ""), (4, "a", None, "")], "i int, prefix_code string, target_code string, suffix_code string")
    assert sorted((r.i, r.target_code) for r in chat.merge_unique(df, "i").collect()) == [(1, ""), (3, None)]
    assert chat.canonical_triple(frame([("p", 1)], "prefix_code string, other int")).collect()[0].asDict() == {"prefix_code": "p", "target_code": "", "suffix_code": ""}
    assert chat.merge_all(df, df).count() == 8
