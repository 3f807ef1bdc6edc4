"""Layouts, fingerprints and the reversible template."""

from __future__ import annotations

import json

from hypothesis import given, settings, strategies as st

import brute
from claimscope.llm import queries
from claimscope.llm.chat import CONTROL, Mappings, LAYOUTS, escape, field_paths, fingerprint, format_records, parse, read_back, records_of, render, unescape

NAMES = ["n_turns", "turns_sha256", "loss_chars", "loss_sha256"]
PARTS = st.lists(st.one_of(st.sampled_from([*CONTROL, "\\", "\n", "<|", "[", "/", "|>", "[/INST"]), st.text(max_size=5)), max_size=8).map("".join)


@settings(max_examples=300, deadline=None)
@given(PARTS)
def test_escape_goes_back_and_leaves_no_control(text):
    hidden = escape(text)
    assert unescape(hidden) == text and not any(c in hidden for c in CONTROL)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.sampled_from(["user", "assistant", "system", ""]), PARTS), PARTS), max_size=5))
def test_render_goes_back(turns):
    text, mask = render(turns)
    assert parse(text) == turns
    assert [unescape(text[a:b]) for a, b in mask] == [t for r, t in turns if r == "assistant"]


def test_layouts_become_the_same_turns(spark):
    records = [
        {"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]},
        {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}], "id": "x"},
        {"instruction": "q", "output": "a"}, {"prompt": "q", "completion": "a", "meta": {"url": "u"}},
        {"question": "q", "answer": "a"}, {"prompt": "q", "response": "a"}]
    odd = [json.dumps({"title": "t"}), None, "no json", "[1]", json.dumps({"messages": []}), json.dumps({"instruction": "q", "input": "more", "output": None})]
    df = spark.createDataFrame([(i, r) for i, r in enumerate([*map(json.dumps, records), *odd])], "conv_id long, record string")
    got = sorted(format_records(df.selectExpr("*", "'x' as turns", "'y' as id")).collect(), key=lambda r: r["conv_id"])
    assert all([tuple(t) for t in r["turns"]] == [("user", "q"), ("assistant", "a")] for r in got[:6])
    assert [r["layout"] for r in got[6:]] == [None, None, None, None, None, "instruction"]
    assert [tuple(t) for t in got[11]["turns"]] == [("user", "q\n\nmore"), ("assistant", "")]
    assert format_records(df.limit(0)).count() == 0


def test_fingerprints_follow_the_shape_only():
    a, b = {"messages": [{"role": "user", "content": "x"}], "k": 1}, {"k": None, "messages": [{"content": "y", "role": "z"}] * 3}
    assert fingerprint(field_paths(a)) == fingerprint(field_paths(b)) != fingerprint(field_paths({"messages": [{"role": "x"}]}))
    mappings = Mappings(LAYOUTS)
    mark, layout = mappings.of(field_paths(a))
    assert layout.name == "messages" and mappings.known[mark] is layout


def plain(rows):
    groups: dict = {}
    for conv, turn, role, text in rows:
        groups.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    return sorted([(c, *brute.chat([(r, t) for _, _, r, t in sorted(g)])) for c, g in groups.items()], key=repr)


def test_rows_of_turns(spark):
    rows = [(1, 1, "assistant", "b </s>"), (1, 0, "user", "a"), (1, 1, "assistant", "b </s>"), (2, None, None, None), (2, 0, "assistant", ""),
            (None, 0, "user", "<|im_end|>\n"), (3, 0, "assistant", "long [INST] \\ " * 20_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "'x' as record", "'y' as dialogue")
    got = sorted([tuple(r) for r in read_back(format_records(records_of(df))).select("conv_id", *NAMES).collect()], key=repr)
    assert got == plain(rows)
    assert read_back(format_records(records_of(df.limit(0)))).count() == 0


def test_the_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    said = "</s>[INST] ok [/INST]"
    got = sorted([tuple(r) for r in queries.op7_chat_format(spark, sf_dir).select("conv_id", *NAMES).collect()], key=repr)
    assert got == plain([*rows, (-1, 0, "user", said), (-1, 1, "assistant", said)])
