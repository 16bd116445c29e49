import random

import pytest

from corpusmill.llm import leaks as L

WORDS = "zither lobster kettle thimble mitten lantana umbrella cymbal sapphire gondola nutmeg papaya spindle otter heron raven walnut pepper feather pebble hammock kiosk quilt olive falcon acorn mango copper velvet onion".split()


def item(rng, n=40):
    return [rng.choice(WORDS) + str(rng.randint(0, 9)) * (rng.random() < 0.3) for _ in range(n)]


def brute(docs, items):
    out = {}
    for d, text in docs:
        w = L.words(text or "")
        for i, t in items:
            best = 0
            for shift in range(-len(t), len(w)):
                best = max(best, L.longest_run([p for p in range(len(t)) if 0 <= p + shift < len(w) and w[p + shift] == t[p]], L.MIN_WORDS, L.PER_REPLACED))
            if best:
                out[d, i] = best
    return out


def test_equals_brute_force(frame):
    rng = random.Random(4)
    items = [(i, item(rng)) for i in range(6)]
    docs = []
    for d in range(60):
        _, words = rng.choice(items)
        a = rng.randint(0, 20)
        part = words[a : a + rng.choice([8, 12, 14, 15, 16, 20, 24, 30])]
        for k in rng.sample(range(len(part)), len(part) // rng.choice([5, 6, 7, 99])):
            part[k] = "other"
        docs.append((d, " ".join(item(rng, 10)) + "\n> " + ("\n> ".join(part) if d % 2 else ", ".join(part).upper()) + " end " + " ".join(item(rng, 10))))
    docs += [(100, None), (101, ""), (102, docs[0][1])]
    want = brute(docs, items)
    table = frame([(i, " ".join(w)) for i, w in items], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.n_words for r in L.leaks(frame(docs, "doc_id long, text string").repartition(5), table).collect()}
    assert got == want and 10 < len(want) < 60


def test_longest_run_equals_trying_all():
    rng = random.Random(8)
    for _ in range(300):
        p = sorted(rng.sample(range(60), rng.randint(0, 50)))
        want = max((b - a + 1 for i, a in enumerate(p) for j, b in enumerate(p[i:]) if (b - a - j) * L.PER_REPLACED <= b - a + 1), default=0)
        assert L.longest_run(p, L.MIN_WORDS, L.PER_REPLACED) == (want if want >= L.MIN_WORDS else 0)


def test_the_index_serves_any_test_set_and_any_range(frame, monkeypatch):
    rng = random.Random(9)
    items = [(i, " ".join(item(rng))) for i in range(8)]
    docs = frame([(i, " ".join(item(rng, 30)) + " " + t + " " + " ".join(item(rng, 30))) for i, t in items] + [(50, ""), (51, items[0][1] + " " + "walnut " * 3000 + items[1][1])], "doc_id long, text string")
    index = L.build_index(docs.coalesce(1), range_words=300).cache()
    assert index.select("docs_in").distinct().count() > 2
    assert {tuple(r[:2]) for r in index.where("term = ''").selectExpr("docs_in", "size(ids)").collect()} and index.where("term = 'walnut'").selectExpr("sum(size(positions))").first()[0] >= 3000
    monkeypatch.setattr(L, "STEP", 50)
    for part in (items[:4], items[4:]):
        table = frame(part, "item_id long, text string")
        got = {(r.doc_id, r.item_id): r.n_words for r in L.leaks(docs, table, index=index).collect()}
        assert {k: v for k, v in got.items() if k[0] != 51} == {(i, i): 40 for i, _ in part}
        assert {k[1] for k in got if k[0] == 51} == {i for i, _ in part if i < 2}


def test_blocks_of_items_give_the_same(frame, monkeypatch):
    rng = random.Random(5)
    items = [(i, " ".join(item(rng))) for i in range(5)]
    docs = frame([(i, "x " + t + " y") for i, t in items], "doc_id long, text string")
    monkeypatch.setattr(L, "BLOCK_WORDS", 50)
    assert {tuple(r) for r in L.p9_found(docs, frame(items, "item_id long, text string")).collect()} == {(i, i) for i in range(5)}


def test_shared_instruction_and_stub_are_no_leak(frame):
    rng = random.Random(6)
    head = "Read the task that is printed below these lines and then answer it with nothing but the plain code please."
    stub = "def f(rows, k):\n    >>> f([34, 45, 67, 89, 12, 45, 67, 89, 32, 12], 7)\n    654"
    items = [(i, f"{head}\n\n{' '.join(item(rng))}\n\n{stub}") for i in range(3)]
    docs = frame([(1, head), (2, stub), (3, items[1][1])], "doc_id long, text string")
    assert {tuple(r) for r in L.p9_found(docs, frame(items, "item_id long, text string")).collect()} == {(3, 1)}


def test_empty_sides(frame):
    docs, items = frame([(1, "a")], "doc_id long, text string"), frame([(1, None), (2, "too short")], "item_id long, text string")
    assert L.p9_found(docs, items).count() == 0 and L.p9_found(docs.limit(0), items.limit(0)).count() == 0


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("<p>One <b>two</b>,<br/>three</p>", ["one", "two", "three"]),
        ("> a **b**\n// c\n# d\n| e |\n  * f\n3. g\n12: h", list("abcdefgh")),
        ("left RIGHT​ ｆｕｌｌ wrap-\nped", ["left", "right", "full", "wrapped"]),
        ("", []),
    ],
)
def test_words(text, want):
    assert L.words(text) == want
