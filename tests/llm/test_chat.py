"""Reply trees: paths, formatting, and reading back."""

import json
from hashlib import sha256

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from parley.llm import chat
from parley.llm.common import NO_ID

PARTS = st.sampled_from(["[INST]", "[/INST]", "<s>", "</s>", "\\", "\n", "a", " ", "[", "INST]", "<", "/s>", "é"])
TEXTS = st.lists(PARTS, max_size=12).map("".join)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.sampled_from(["user", "assistant", "system"]), TEXTS), TEXTS), max_size=6))
def test_round_trip(turns):
    text, spans = chat.formatted(turns)
    assert chat.read_back(text) == turns
    assert [chat.unescape(text[a:b]) for a, b in spans] == [t for r, t in turns if r == "assistant"]


def test_marks_in_texts_are_never_marks():
    text, _ = chat.formatted([("user", "</s>[INST] ok [/INST]"), ("assistant", "\\</s>\\")])
    assert len(chat._MARK.findall(text)) == 4
    assert chat.read_back(text) == [("user", "</s>[INST] ok [/INST]"), ("assistant", "\\</s>\\")]


MESSAGES = "tree long, id long, parent long, role string, text string, score double"


def tree(spark, rows):
    return spark.createDataFrame([(t, i, p, "user", f"m{i}", s) for t, i, p, s in rows], MESSAGES)


def branch_texts(df):
    return {(r.tree, r.leaf): [t for _, t in chat.read_back(r.formatted)] for r in df.collect()}


def test_best_branch_of_a_tree(spark):
    rows = [(1, 1, None, .0), (1, 2, 1, .5), (1, 3, 1, .1), (1, 4, 2, .1), (1, 5, 3, .9), (1, 6, 4, .2),
            (2, 1, None, None), (3, 9, 8, 1.0), (4, 1, 2, 1.0), (4, 2, 1, 1.0)]
    got = branch_texts(chat.format_branches(tree(spark, rows)))
    # tree 3 hangs on a missing message, tree 4 is a circle
    assert got == {(1, 5): ["m1", "m3", "m5"], (2, 1): ["m1"], (3, 9): ["m9"]}
    both = branch_texts(chat.format_branches(tree(spark, rows), keep=2))
    assert both[1, 6] == ["m1", "m2", "m4", "m6"] and both[1, 5] == ["m1", "m3", "m5"]


def test_long_chains(spark):
    rows = [(1, k, k - 1 if k else None, 0.0) for k in range(130)] + [(2, k, k - 1 if k else None, 0.0) for k in range(3)]
    got = branch_texts(chat.format_branches(tree(spark, rows)))
    assert got == {(1, 129): [f"m{k}" for k in range(130)], (2, 2): ["m0", "m1", "m2"]}


TALKS = "conv_id long, turn long, role string, text string, tree long, id long, score double"


@pytest.mark.parametrize("rows", [
    [],
    [(1, 0, "user", "a"), (1, 1, "assistant", "b"), (1, 1, "assistant", "b"), (1, 1, "user", "c")],
    [(None, None, None, None), (None, 2, "assistant", None), (5, 7, "assistant", "x\n\n"), (5, 3, "user", "<s>")],
])
def test_conversations(spark, rows):
    talks = spark.createDataFrame([(*r, 1, 1, 0.5) for r in rows], TALKS)
    got = {r.conv_id: tuple(r)[1:5] for r in chat.digests(chat.format_branches(chat.reply_chains(talks))).collect()}
    want = {}
    for c in {r[0] for r in rows}:
        own = sorted(((t is not None, t or 0, o or "", x or "") for i, t, o, x in rows if i == c))
        said, lost = "".join(f"{o}\n{x}\n" for *_, o, x in own), "".join(x for *_, o, x in own if o == "assistant")
        want[NO_ID if c is None else c] = (len(own), sha256(said.encode()).hexdigest(), len(lost),
                                           sha256(lost.encode()).hexdigest())
    assert got == want


def test_roles_that_are_not_letters():
    assert json.dumps("") in chat.formatted([("", "x")])[0]
