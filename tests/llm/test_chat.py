import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from vibralake.llm import chat

PIECES = st.lists(st.sampled_from(["[INST]", "[/INST]", "</s>", "<s>", "[ANS]", "[ROLE]", "[/ROLE]", "\\", "[\\INST]", "<\\/s>", " ", "\n", "a", "é", "[", "<", "]", ">", "/"]), max_size=8).map("".join)


@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "", "we\nird [ROLE] \\n"]), PIECES), max_size=5))
@settings(max_examples=500, deadline=None)
def test_round_trip(turns):
    made = [chat.settle(r, t) for r, t in turns]
    back = list(chat.parse("".join(m[0] for m in made)))
    assert [(r, t) for r, t, _, _ in back] == turns
    assert all(chat.unescape(m[0][m[1] : m[2]]) == t for m, (_, t) in zip(made, turns, strict=True))


def test_plain_text_is_not_escaped():
    assert chat.settle("user", "plain [text]")[3] == 0 and chat.settle("user", "a [INST] b")[3] == 1


def test_broken_text_is_refused():
    for text in ("[INST] a", "x", "[INST] a </s>", "[ROLE] a [/ROLE]"):
        with pytest.raises(chat.ParseError):
            list(chat.parse(text))


def test_digest(spark):
    rows = [(1, 2, "assistant", "b"), (1, 1, "user", "a [/INST]"), (1, 3, None, None), (1, 1, "user", "a [/INST]"), (None, 1, "assistant", "x"), (2, None, "system", "s\\")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "conv_id bigint, turn bigint, role string, text string, segment string")
    found = {r["conv_id"]: r for r in chat.digest(df).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert set(found) == {1, None, 2, -7}
    assert found[1]["turns_sha256"] == sha("user\na [/INST]\n" * 2 + "assistant\nb\n" + "\n\n") and found[1]["n_turns"] == 4
    assert found[1]["loss_chars"] == 1 and found[1]["loss_sha256"] == sha("b")
    trap = "</s>[INST] ok [/INST]"
    assert found[-7]["loss_sha256"] == sha(trap) and found[-7]["turns_sha256"] == sha(f"user\n{trap}\nassistant\n{trap}\n")
    parts = chat.format_conversations(df).orderBy("conv_id", "position").collect()
    assert sum(len(p["segment"]) for p in parts if p["conv_id"] == 1) == found[1]["formatted_chars"]
    assert chat.format_conversations(df.limit(0)).count() == 0
