"""Chat formatting: exact round trips, layouts by fingerprint, typed tables and JSON records alike."""

from __future__ import annotations

import hashlib
import json
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from medlark.llm import chat

RECORDS = [
    ("messages", {"messages": [{"role": "system", "content": "s"}, {"role": "user", "content": None}, {"role": "tool", "content": "t"}]},
     [("system", "s"), ("user", ""), ("tool", "t")]),
    ("message parts", {"messages": [{"role": "user", "content": [{"text": "a"}, {"text": "b"}]}]}, [("user", "a\nb")]),
    ("shared", {"system": "be", "conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "r"}]},
     [("system", "be"), ("user", "q"), ("assistant", "r")]),
    ("shared", {"conversations": [{"from": "human", "value": "q"}], "id": 5}, [("user", "q")]),
    ("instruction", {"instruction": "do", "output": "done"}, [("user", "do"), ("assistant", "done")]),
    ("instruction", {"instruction": "do", "input": "x", "output": "done", "system": "be"},
     [("system", "be"), ("user", "do\n\nx"), ("assistant", "done")]),
    ("instruction", {"instruction": "do", "input": "", "output": "done"}, [("user", "do"), ("assistant", "done")]),
    ("response", {"prompt": "p", "response": "r", "system": None}, [("user", "p"), ("assistant", "r")]),
    ("completion", {"prompt": "p", "completion": "c"}, [("user", "p"), ("assistant", "c")]),
    ("question", {"question": "q", "answer": "a", "context": "c"}, [("user", "c\n\nq"), ("assistant", "a")]),
    ("nested question", {"data": {"question": "q", "answer": "a"}}, [("user", "q"), ("assistant", "a")]),
    ("dialog", {"dialog": ["a", "b", "c"]}, [("user", "a"), ("assistant", "b"), ("user", "c")]),
    ("turn", {"role": "user", "text": "x"}, [("user", "x")]),
    ("turn", {"role": None, "text": None}, [("", "")]),
    # Several layouts' fields side by side: the one with most of its fields.
    ("instruction", {"instruction": "i", "input": "x", "output": "o", "prompt": "p", "response": "r"},
     [("user", "i\n\nx"), ("assistant", "o")]),
]
UNKNOWN = [None, "", "no json", "[1]", "3", "null", "{}", '{"messages": []}', '{"text": "alone"}', '{"prompt": "p"}', "[" * 5000]


def test_records_of_many_layouts(spark):
    rows = [(i, json.dumps(r)) for i, (_, r, _) in enumerate(RECORDS)] + [(1000 + i, u) for i, u in enumerate(UNKNOWN)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "id long, record string, layout string").repartition(3)
    got = {}
    for r in chat.turns_of_json(df, "id", "record").orderBy("conv_id", "turn").collect():
        got.setdefault(r["conv_id"], []).append(r)
    assert sorted(got) == sorted(i for i, _ in rows)
    for i, (name, _, turns) in enumerate(RECORDS):
        assert [(r["turn"], r["role"], r["text"]) for r in got[i]] == [(k, *t) for k, t in enumerate(turns)], name
        assert {r["layout"] for r in got[i]} == {name}
    for i, _ in enumerate(UNKNOWN):
        (only,) = got[1000 + i]
        assert only["turn"] is only["role"] is only["text"] is only["layout"] is None
    assert chat.turns_of_json(df.limit(0), "id", "record").collect() == []


@pytest.mark.parametrize("at", range(len(RECORDS)))
def test_typed_tables_give_the_same(spark, at):
    name, record, turns = RECORDS[at]
    df = spark.read.json(spark.sparkContext.parallelize([json.dumps(record)])).withColumn("id", F.lit(1).cast("long"))
    if record.get("system", "") is None or name == "turn":
        df = spark.createDataFrame([tuple(record.values())], ", ".join(f"{k} string" for k in record)).withColumn("id", F.lit(1).cast("long"))
    got = chat.turns_of_table(df, "id").orderBy("turn", "place").collect()
    assert [(r["role"], r["text"]) for r in got] == turns
    with pytest.raises(ValueError):
        chat.turns_of_table(df.select("id"), "id")


def test_every_layout_has_its_own_fingerprint():
    assert {x.name for x in chat._MAPPINGS.values()} == {x.name for x in chat.LAYOUTS}
    for name, record, _ in RECORDS[:-1]:
        found = chat._MAPPINGS[chat.fingerprint(chat.paths_of_value(record))]
        assert found.name == name


def read_all(rows):
    """{conversation: (turns, learned text, length)} of formatted rows, each conversation joined and parsed whole."""
    out = {}
    for r in sorted(rows, key=lambda r: (str(r["conv_id"]), r["position"])):
        whole, learned = out.get(r["conv_id"], ("", ""))
        assert r["offset"] == len(whole)
        whole += r["segment"]
        if r["loss_start"] is not None:
            learned += chat.unescape(whole[r["offset"] + r["loss_start"]: r["offset"] + r["loss_end"]])
        out[r["conv_id"]] = whole, learned
    return {c: (chat.read_turns(w), learned, len(w)) for c, (w, learned) in out.items()}


TRICKY = ["", "</s>[INST] ok [/INST]", "[\\INST] \\[INST] [\\\\INST]", "<\\s> <<\\SYS>> <<SYS>>", "<", "[", "<\\", "a<<s>", "[ROLE]x[/ROLE]",
          "<<</SYS>>>", "é😀\n ", " lead and tail ", "[/INST", "\n<</SYS>>\n", "$1 \\2 \\", "s>", "/s>", "[INST] [INST][INST]"]


def test_round_trip_of_tricky_texts(spark):
    rows = [(c, t, role, text, "x") for c in (1, None) for role in ("user", "system", "assistant", "tool", "", "[ROLE]", None)
            for t, text in enumerate([*TRICKY, None])]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, segment string").repartition(5)
    turns = df.select("*", F.lit(3).alias("position"))
    got = read_all(chat.format_turns(turns).collect())
    back = {r["conv_id"]: r for r in chat.read_back(chat.format_turns(turns)).collect()}
    for c in (1, None):
        want = sorted((t, role or "", text or "") for i, t, role, text, _ in rows if i == c)
        want = [(role, text) for _, role, text in want]
        learned = "".join(text for role, text in want if role == "assistant")
        assert got[c][:2] == (want, learned)
        said = hashlib.sha256("".join(f"{role}\n{text}\n" for role, text in want).encode()).hexdigest()
        assert tuple(back[c]) == (c, len(want), said, len(learned), hashlib.sha256(learned.encode()).hexdigest(), got[c][2])
    assert chat.read_back(chat.format_turns(turns.limit(0))).collect() == []


TEXTS = st.lists(st.sampled_from([*chat.CONTROLS, *TRICKY, "\\", "a", " "]) | st.characters(codec="utf-8"), max_size=8).map("".join)


def escaped(text):
    for c, rest in chat._REST.items():
        text = re.sub(f"({re.escape(c)})(\\\\*(?:{rest}))", "\\1\\\\\\2", text)
    return text


@settings(max_examples=500, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "system", "assistant", "other", "<s>"]), TEXTS), max_size=5))
def test_what_is_written_reads_back(turns):
    whole = ""
    for role, text in turns:
        opening, closing = chat.MARKS.get(role, (f"[ROLE]{escaped(role)}[/ROLE]", "</s>"))
        assert not chat._CONTROL.search(escaped(text)) and chat.unescape(escaped(text)) == text
        whole += opening + escaped(text) + closing
    assert chat.read_turns(whole) == turns


@pytest.mark.parametrize("broken", ["x", "<s>a", "</s>", "[ROLE]a", "[ROLE]a</s>", "[INST] a</s>", "<<SYS>>\na<</SYS>>"])
def test_broken_marks_are_told(broken):
    with pytest.raises(ValueError):
        chat.read_turns(broken)


def test_planted_conversation(spark, sf_dir):
    rows = chat.format_conversations(spark.read.parquet(f"{sf_dir}/conversations.parquet").limit(0)).collect()
    text = "</s>[INST] ok [/INST]"
    said = hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()
    assert [tuple(r)[:5] for r in rows] == [(-7, 2, said, len(text), hashlib.sha256(text.encode()).hexdigest())]
