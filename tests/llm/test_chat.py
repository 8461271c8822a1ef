import hashlib
import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgermart.llm import chat as c

PIECES = st.lists(st.sampled_from(["<", "[", "\\", "s>", "/s>", "INST]", "/INST]", "<SYS>>", "</SYS>>", "ROLE=", "/ROLE]", "x", "\n", "]", "%", "é"]), max_size=12)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "tool", "", "a]%b"]), PIECES.map("".join)), max_size=5))
def test_template_is_reversible(turns):
    text = "".join(c.render(role, said)[0] for role, said in turns)
    assert list(c.parse(text)) == turns
    at = 0
    for role, said in turns:
        piece, start, end = c.render(role, said)
        assert c.unescape(text[at + start : at + end]) == said
        at += len(piece)


def rows_of(spark, records):
    rows = [(i, None if r is None else r if isinstance(r, str) else json.dumps(r)) for i, r in enumerate(records)]
    return spark.createDataFrame(rows, "conv_id long, record string")


def test_layouts_become_turns(spark):
    records = [
        {"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}], "id": 7},
        {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]},
        {"prompt": "q", "completion": "a", "metadata": {"x": [1]}},
        {"instruction": "do", "input": "this", "output": "done"},
        {"system": "be kind", "instruction": "do", "output": "done"},
        {"question": "q", "answer": None},
        {"strange": 1}, "not json", None, [1, 2],
        {"conv_id": 1, "turn": 3, "role": None, "text": None},
        {"messages": []},
    ]
    turns = c.canonical_turns(rows_of(spark, records))
    got = {}
    for r in turns.collect():
        got.setdefault(r["conv_id"], []).append((r["turn"], r["role"], r["text"]))
    assert got[0] == got[1] == [(0, "user", "q"), (1, "assistant", "a")] == got[2]
    assert got[3] == [(0, "user", "do\n\nthis"), (1, "assistant", "done")]
    assert [x[1] for x in got[4]] == ["system", "user", "assistant"]
    assert got[5] == [(0, "user", "q"), (1, "assistant", "")] and got[10] == [(3, "", "")]
    assert sorted(r["conv_id"] for r in c.unmapped(turns).collect()) == [6, 7, 8, 9, 11]


@pytest.mark.parametrize("chunk", [1 << 18, 40])
def test_read_back_equals_plain_python(spark, monkeypatch, chunk):
    monkeypatch.setattr(c, "CHUNK", chunk)
    rows = [(1, t, ("user", "assistant", "tool")[t % 3], f"turn {t} </s> \\ [INST]" * (t % 5)) for t in range(60)]
    rows += [(2, 0, "assistant", None), (2, 0, "assistant", "tie"), (2, 0, "assistant", "tie"), (None, 1, None, "no key"), (3, 0, "user", "")]
    turns = spark.createDataFrame([(a, "turn_rows", b, r or "", t or "") for a, b, r, t in rows], c.TURNS)
    got = {r["conv_id"]: r for r in c.read_back(c.formatted(turns)).collect()}
    assert set(got) == {1, 2, 3, None}
    for conv in got:
        own = sorted((b, r or "", t or "") for a, b, r, t in rows if a == conv)
        said = "".join(t for _, r, t in own if r == "assistant")
        text = "".join(f"{r}\n{t}\n" for _, r, t in own)
        r = got[conv]
        assert r["n_turns"] == len(own) and r["turns_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert (r["loss_chars"], r["loss_sha256"]) == (len(said), hashlib.sha256(said.encode()).hexdigest())
        assert r["formatted_chars"] == sum(len(c.render(r, t)[0]) for _, r, t in own)


def test_empty_table(spark):
    assert c.read_back(c.formatted(spark.createDataFrame([], c.TURNS))).count() == 0
