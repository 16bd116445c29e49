import random

import pytest

from corpusmill.llm import pairs as P

EN = "The result is sorted by the row buffer and then by the token table. Keep the order because the index depends on it."
DE = "Falls das Protokoll fehlt, wird stattdessen die Tabelle verwendet. Achtung, der Index darf nicht mehr als zwölf Zeilen enthalten."
CODE = "```python\ndef f(a):\n    return sorted(a)\n```"
ASK = "Write a Python function `f` that takes a row buffer and returns the token table."


@pytest.mark.parametrize(
    ("question", "answer", "want"),
    [
        (ASK, None, "empty"), (ASK, " \n", "empty"), (ASK, "```python\n```", "empty"), (ASK, "N/A", "empty"), (ASK, "...", "empty"), (ASK, "None", "empty"),
        (ASK, ASK.upper(), "copies_question"), (ASK, f'"{ASK}"', "copies_question"), (ASK, f"{ASK}\n{ASK}", "copies_question"), (ASK + "\n\n" + CODE, ASK[:-1], "copies_question"), (ASK, "Question: " + ASK, "copies_question"),
        (ASK, "I'm sorry, but I can't help with that request.", "refusal"), (ASK, "Good question. I must decline to answer this question.", "refusal"), (ASK, "Diese Anfrage muss ich leider ablehnen.", "refusal"), (ASK, "죄송하지만 그 요청은 도와드릴 수 없습니다.", "refusal"),
        (ASK, DE, "other_language"), (ASK, CODE + "\n\n" + DE, "other_language"), ("Wie kann ich `f` beschleunigen, falls der Index sehr groß ist?", EN, "other_language"),
        (ASK, EN[:-12], "truncated"), (ASK, CODE[:-8], "truncated"), (ASK, f"1. {EN}\n2. Keep the", "truncated"), (ASK, EN + " The default works for mo (", "truncated"),
        (ASK, EN, None), (ASK, CODE, None), (ASK, "42", None), (ASK, "O(n log n)", None), (ASK, "`f(37)`", None), (ASK, f"> {ASK}\n\n{EN}", None), (ASK + " Please reply in German.", DE, None),
        (ASK, "I can't reproduce the failure here, but this version is safer:\n\n" + CODE, None), (ASK, "You can't change a tuple in place, so build a new one:\n\n" + CODE, None),
    ],
)
def test_kinds(model, question, answer, want):
    assert model.defects([P.features(question, answer, True)]) == [want]


def corpus(n=240):
    rng = random.Random(2)
    rows = []
    for i in range(n):
        parts = EN.split(". ") if i % 2 else DE.split(". ")
        ask = f"{ASK[:-1]} {i}." if i % 2 else f"Wie kann ich `f_{i}` beschleunigen, falls der Index sehr groß ist?"
        said = [p.rstrip(".") for p in rng.sample(parts, 2)] + [f"{'Row' if i % 2 else 'Zeile'} {i} {'is the last one' if i % 2 else 'ist die letzte Zeile'}"]
        rng.shuffle(said)
        answer = rng.choice(["", CODE + "\n\n"]) + ". ".join(said) + "."
        rows.append((i, [("user", ask), ("assistant", answer)]))
    return rows


def as_messages(rows):
    return [(i, [{"role": r, "content": c} for r, c in m]) for i, m in rows]


@pytest.fixture(scope="module")
def model():
    return P.fit(P.examples(P.fixed_records()) + P.examples(as_messages(corpus())))


def test_held_out_defects_are_found(model):
    made = P.examples(as_messages(corpus()))
    for k, defect in enumerate(P.DEFECTS):
        mine = model.defects([x for x, kind, held in made if held and kind == k])
        assert len(mine) > 10 and sum(d == defect for d in mine) / len(mine) >= 0.95, defect
    sound = model.defects([x for x, kind, held in made if held and kind < 0])
    assert len(sound) > 30 and sum(d is not None for d in sound) <= 0.02 * len(sound)


def test_the_classifier_decides(model):
    """With its weights taken away nothing is found, with its labels exchanged something else is."""
    x = P.features(ASK, "I must decline to answer this question.", True)
    assert model.defects([x]) == ["refusal"]
    assert P.Classifier(model.weights * 0, abs(model.thresholds) + 1).defects([x]) == [None]
    turn = [1, 2, 3, 4, 0]
    assert P.Classifier(model.weights[:, turn], model.thresholds[turn]).defects([x]) == [P.DEFECTS[turn.index(2)]]


@pytest.mark.parametrize("length", [47, 235, 600, 3000])
def test_long_refusals(model, length):
    said = "I'm sorry, but I can't help with that request. "
    assert model.defects([P.features(ASK, (said * (length // len(said) + 1)).strip(), True)]) == ["refusal"]


def test_features_see_whole_texts():
    filler = "The rows are sorted by the index. " * 300
    assert set(P.features(ASK, filler + "Zebra.", True)) != set(P.features(ASK, filler + "Ostrich.", True))
    assert P.features(None, None, False) == P.features("x", "y", False) and len(P.features("", "", True)) > 2


def test_frames(frame):
    rows = corpus() + [(1000, [("user", ASK)]), (1001, None), (1002, []), (1003, [("user", ASK), ("assistant", None)]), (1004, [("user", None), ("assistant", EN)]), (1005, [("user", ASK), ("assistant", DE)]), (1005, [("user", ASK), ("assistant", DE)])]
    df = frame(rows, "record_id long, messages array<struct<role:string,content:string>>")
    got = sorted((r.record_id, r.defect) for r in P.p6_found(df.repartition(5)).collect())
    assert got == [(1000, "empty"), (1001, "empty"), (1002, "empty"), (1003, "empty"), (1005, "other_language"), (1005, "other_language")]
    assert P.p6_found(df.limit(0)).count() == 0


@pytest.mark.parametrize("sound", [[], [(1, [("user", ASK), ("assistant", EN)])], [r for r in corpus() if r[0] % 2]])
def test_small_and_one_language_tables(sound):
    model = P.fit(P.examples(P.fixed_records()) + P.examples(as_messages(sound)))
    for q, a, want in BROKEN:
        assert model.defects([P.features(q, a, True)]) == [want]
    assert all(P.language(t) == k for k, texts in P.FOREIGN.items() for t in texts)


BROKEN = [(ASK, "", "empty"), (ASK, ASK.upper(), "copies_question"), (ASK, "I'm sorry, but I can't help with that request.", "refusal"), (ASK, DE, "other_language"), (ASK, EN[:-12], "truncated")]
