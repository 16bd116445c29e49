import random
from collections import Counter, defaultdict

from corpusmill.llm import variants as V

SCHEMA = "file_id long, file_path string, content string"


def brute(rows):
    """Union of equal raw forms and equal ordered forms, by the definition."""
    parent = {i: i for i, _, t in rows if t and V.plain(t)}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for form in (lambda p, t: V.plain(t), lambda p, t: V.ordered(p.rpartition(".")[2], t)):
        seen = {}
        for i, p, t in rows:
            if i in parent and (k := form(p, t)) is not None:
                a, b = sorted((root(i), root(seen.setdefault(k, i))))
                parent[b] = a
    return {(root(i), i) for i in parent if root(i) != i}


def sample(n=400):
    rng = random.Random(1)
    base = ["def f(a): return a", '{"b": [1, 2], "a": "x"}', "A=1\nB=2\n", "Straße über 7", "", " \n.", "x" * 500, "a_b c"]
    rows = []
    for i in range(n):
        t = rng.choice(base)
        p = "f.json" if t.startswith("{") else "f.env" if t.startswith("A=") else "f.py"
        if rng.random() < 0.3:
            t = t.upper()
        if rng.random() < 0.3:
            t = t.replace(" ", "  ").replace(",", " , ")
        if rng.random() < 0.3 and p == "f.json":
            t = '{"a":"x","b":[1,2]}'
        if rng.random() < 0.3 and p == "f.env":
            t = "B=2\n\nA=1"
        if rng.random() < 0.1 and p == "f.json":
            t = t + ","  # no JSON any more, but the same letters and digits
        rows.append((i, p, t if rng.random() > 0.05 else None))
    return rows


def test_groups_are_those_of_the_definition(frame):
    rows = sample()
    got = {tuple(r) for r in V.p2_found(frame(rows, SCHEMA).repartition(6)).collect()}
    assert got == brute(rows)


def test_recursion_splits_full_buckets(frame):
    rows = sample() + [(1000 + i, "f.py", f"value {i}") for i in range(300)]
    df = frame(rows, SCHEMA)
    assert {tuple(r) for r in V.p2_found(df, bucket_rows=20).collect()} == brute(rows)
    counts = {r.keep_id: r.copies for r in V.collapse(df, bucket_rows=20).collect()}
    want = Counter(k for k, _ in brute(rows))
    assert all(counts[k] == n + 1 for k, n in want.items()) and sum(counts.values()) == sum(1 for _, _, t in rows if t and V.plain(t))


def test_full_buckets_are_split_by_as_many_digits_as_each_needs(frame):
    from collections import Counter

    opening = "licence text " * 40
    texts = [f"{opening} file {i}" for i in range(60)] + [f"other {i}" for i in range(60)] + [f"{i} lone" for i in range(30)] + ["same"] * 50
    rows = frame([(V.key(V.plain(t)), 1, i) for i, t in enumerate(texts)], V.GROUP)
    placed = V.buckets(rows, 10).collect()
    sizes = Counter(bytes(r.bucket) for r in placed)
    whole = {bytes(r.bucket) for r in placed if bytes(r.bucket) == bytes(r.k)}
    assert all(n <= 10 or b in whole for b, n in sizes.items())
    assert len({len(b) for b in sizes}) >= 4 and sizes[b"same"] == 50
    assert sorted((bytes(r.k), r.n, r.least) for r in V.radix_count(rows, 10).collect()) == sorted((k, n, min(i for i, t in enumerate(texts) if V.key(V.plain(t)) == k)) for k, n in Counter(V.key(V.plain(t)) for t in texts).items())


def test_keys_are_equal_only_where_the_bytes_are():
    rng = random.Random(3)
    forms = {"x" * n for n in range(0, 400, 7)} | {"".join(rng.choices("ab", k=rng.randint(0, 90))) for _ in range(3000)} | {"h" * 5000 + c for c in "abc"}
    assert len({V.key(f) for f in forms}) == len(forms)
    a, b = V.key("p" * 700 + "1" * 400), V.key("p" * 700 + "2" * 400)
    assert a[: V.prefix_bytes(9)] == b[: V.prefix_bytes(9)] and a != b and V.key("short") == b"short"


def test_links_over_both_relations_hold(frame):
    rows = [(1, ".env", "a=1\nb2=c3"), (2, ".env", "b2=c3\na=1"), (3, ".env", "a1=b2\nc=3"), (4, ".env", "c=3\na1=b2")]
    rows += [(5, ".env", "k=1\nm=2"), (6, "x.py", "k1m2")]
    got = {tuple(r) for r in V.p2_found(frame(rows, SCHEMA)).collect()}
    assert got == brute(rows) == {(1, 2), (1, 3), (1, 4), (5, 6)}
    assert {(r.keep_id, r.copies) for r in V.collapse(frame(rows, SCHEMA)).collect()} == {(1, 4), (5, 2)}


def test_components_of_a_long_chain(frame):
    n = 40
    order = list(range(n))
    random.Random(5).shuffle(order)
    links = frame([(order[i], order[i + 1]) for i in range(n - 1)] + [(100, 101)], "v long, root long")
    got = {r.v: r.root for r in V.components(links).collect()}
    assert got == {i: 0 for i in range(n)} | {100: 100, 101: 100}


def test_a_third_of_all_rows_can_be_one_text(frame):
    rows = [(i, "a.py", "hot  text 1" if i % 3 == 0 else f"own {i}") for i in range(900)]
    got = {tuple(r) for r in V.p2_found(frame(rows, SCHEMA).repartition(5)).collect()}
    assert got == {(0, i) for i in range(3, 900, 3)}


def test_edges(frame):
    assert V.p2_found(frame([], SCHEMA)).count() == 0 and V.collapse(frame([], SCHEMA)).count() == 0
    odd = frame([(1, None, "same"), (2, "x.py", "SAME"), (3, "noext", None), (4, "x.py", "...")], SCHEMA).selectExpr("*", "1 AS raw", "2 AS id", "3 AS ord")
    assert [tuple(r) for r in V.p2_found(odd).collect()] == [(1, 2)]


def test_canonical_forms():
    assert V.plain("A_b\n1é²") == "ab1é²" and V.plain("_-.") == ""
    assert V.ordered("json", '{"b":1,"a":{"d":2,"c":[3,{"y":1,"x":2}]}}') == V.ordered("json", '{"a":{"c":[3,{"x":2,"y":1}],"d":2},"b":1}')
    assert V.ordered("json", "[1,2]") != V.ordered("json", "[2,1]") and V.ordered("json", "{bad") is None and V.ordered("toml", "a=1") is None
    assert V.ordered("json", "[" * 100_000) is None


def test_trie_counts_like_a_counter():
    rng = random.Random(0)
    keys = [bytes(rng.choices(b"abc", k=rng.randint(0, 6))) for _ in range(3000)]
    trie, least = V.Trie(), defaultdict(lambda: 10**9)
    for i, k in enumerate(keys):
        trie.add(k, 1, i)
        least[k] = min(least[k], i)
    assert {k: (n, m) for k, n, m in trie.terminals()} == {k: (n, least[k]) for k, n in Counter(keys).items()}
