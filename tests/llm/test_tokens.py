import base64
import os

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from corpusmill.llm import tokens as T

pytestmark = pytest.mark.skipif(not os.path.exists(T.DEFAULT_VOCABULARY), reason="no vocabulary here")


@pytest.fixture(scope="module")
def reference():
    import tiktoken

    with open(T.DEFAULT_VOCABULARY, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.one_of(st.sampled_from(" \n\t'sdrevlmtABc9é한。　 \x1c<|>½²_-"), st.characters(codec="utf-8", exclude_categories=["Cs", "Cn"]))), max_size=8))
def test_ids_are_those_of_the_public_library(reference, texts):
    assert T.encode_batch(texts)[0] == [reference(t) for t in texts]


def test_special_tokens_are_plain_text_and_long_runs_work(reference):
    texts = ["<|endoftext|> a", "a" * 5000, "=" * 3000, " " * 1000 + "x", "'s't've'll'LL'", "it''s '' 's", "", "\n \n"]
    assert T.encode_batch(texts)[0] == [reference(t) for t in texts]


def test_offsets_and_decoding():
    text = "It's 12 apples,  isn't it?\n\n  한국어 <|endoftext|>"
    (ids,), (spans,) = T.encode_batch([text], offsets=True)
    assert T.decode(ids) == text and sum(s["n_ids"] for s in spans) == len(ids)
    at = 0
    for s, nxt in zip(spans, [*spans[1:], {"start": len(text)}]):
        assert T.decode(ids[at : at + s["n_ids"]]) == text[s["start"] : nxt["start"]]
        at += s["n_ids"]


def test_frames(frame):
    df = frame([(1, None, [0]), (2, "", None), (3, "a b", None), (3, "a b", None)], "doc_id long, text string, ids array<int>")
    got = sorted(((r.doc_id, r.ids) for r in T.p8_ids(df).collect()), key=repr)
    assert got == [(1, []), (2, []), (3, got[2][1]), (3, got[2][1])] and len(got[2][1]) == 2
    assert T.p8_ids(df.limit(0)).count() == 0
    with pytest.raises(FileNotFoundError):
        T.encode(df, "doc_id", "text", "/nowhere")
    assert T.encode_batch(["\ud800x"])[0][0]
