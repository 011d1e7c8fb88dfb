"""Chat formatting: exact round trip, parts, masks, awkward rows."""

import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tickreport.llm import chat
from tickreport.llm.common import saved

TEXT = st.lists(st.sampled_from(["\\", "#", "##", "###", "</turn>", "</tur", "n>", "\n", ": ", "h", "t", "c", "é", "### x: "])) \
    .map("".join)


def _h(text):
    return hashlib.sha256(text.encode()).hexdigest()


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(TEXT, TEXT), max_size=4))
def test_round_trip(turns):
    written = [chat.written_turn(*t) for t in turns]
    assert chat.read_turns("".join(w[0] for w in written)) == turns
    assert all(chat.unescape(w[0][w[1]:w[1] + w[2]]) == t[1] for w, t in zip(written, turns))
    assert all(w[0].count("</turn>") == w[0].count("###") == 1 for w in written)


SCHEMA = "conv_id long, turn long, role string, text string, part string, prompt string, reply long"


def _rows():
    rows = [(1, t, "assistant" if t % 2 else "user", f"say {t}", "x", "y", 1) for t in range(400)]
    rows += [(2, 0, "system", "### \\ </turn>", "x", "y", 1), (2, 1, "assistant", None, "x", "y", 1),
             (2, 2, "assistant", "two", "x", "y", 1), (2, 3, "user", "after", "x", "y", 1)]
    rows += [(3, 0, "user", "", None, None, None), (None, None, None, None, None, None, None)]
    return rows + [(None, 5, "assistant", "lost", None, None, None), (4, 0, "user", "twice", "", "", 0),
                   (4, 0, "user", "twice", "", "", 0), (5, 0, "a:b\n### c", "é" * 70_000, "", "", 0)]


def _expected(rows):
    out = {}
    for c in {r[0] for r in rows}:
        turns = sorted((r for r in rows if r[0] == c), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or ""))
        turns = [(r[2] or "", r[3] or "") for r in turns]
        said = [t for role, t in turns if role == "assistant"]
        out[c] = (len(turns), _h("".join(f"{r}\n{t}\n" for r, t in turns)), len("".join(said)), _h("".join(said)),
                  sum(len(chat.written_turn(*t)[0]) for t in turns), len(said))
    return out


def test_read_back_equals_the_rows(spark, monkeypatch):
    df = spark.createDataFrame(_rows(), SCHEMA).repartition(5)
    for held in (chat.HELD, 40):
        monkeypatch.setattr(chat, "HELD", held)
        got = chat.read_back(chat.prefix_targets(df)).collect()
        assert {r[0]: tuple(r)[1:] for r in got} == _expected(_rows()) and len(got) == 6


def test_contexts_are_all_turns_before(spark):
    rows = _rows()
    df = spark.createDataFrame(rows, SCHEMA)
    examples = saved(chat.prefix_targets(df), "test-examples")
    assert examples.where("conv_id = 1").select("part").distinct().count() > 1  # one conversation, many tasks
    offsets = {(r["conv_id"], r["part"]): r for r in chat.part_offsets(examples).collect()}
    whole = "".join(chat.written_turn(r[2], r[3])[0] for r in rows if r[0] == 1)
    found = []
    for r in examples.where("conv_id = 1 and reply is not null").collect():
        o = offsets[1, r["part"]]
        at = o["chars_before"] + r["context_chars"]
        assert whole[:at].endswith(r["prompt"]) and whole[at:].startswith(r["reply"])
        text = r["prompt"] + r["reply"]
        found.append((o["examples_before"] + r["example"], text[r["loss_start"]:r["loss_start"] + r["loss_chars"]]))
    assert sorted(found) == [(i, f"say {2 * i + 1}") for i in range(200)]
    texts = chat.example_texts(examples.where("conv_id = 2")).orderBy("part", "example").collect()
    assert len(texts) == 2 and texts[-1]["reply"] == "### assistant: two</turn>\n"


def test_long_prompts_go_on(spark, monkeypatch):
    monkeypatch.setattr(chat, "LONG", 30)
    rows = [(9, t, "user", "some words", "", "", 0) for t in range(20)] + [(9, 20, "assistant", "ok", "", "", 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert tuple(chat.read_back(chat.prefix_targets(df)).first())[1:] == _expected(rows)[9]


def test_no_rows(spark):
    assert chat.read_back(chat.prefix_targets(spark.createDataFrame([], SCHEMA))).collect() == []


def _talk(n):
    return [(7, t, "assistant" if t % 2 else "user", f"say {t}\n### {t}", "", "", 0) for t in range(n)]


def test_every_example_holds_its_whole_context(spark):
    rows = _rows() + _talk(90)
    examples = saved(chat.prefix_targets(spark.createDataFrame(rows, SCHEMA).repartition(3)), "test-examples")
    offsets = {(r["conv_id"], r["part"]): r for r in chat.part_offsets(examples).collect()}
    assert examples.where("conv_id = 7").select("part").distinct().count() > 1  # contexts reach back over parts
    for conv in (1, 2, 7):
        turns = [chat.written_turn(r[2], r[3] or "")[0] for r in rows if r[0] == conv]
        ends = [i for i, r in enumerate(r for r in rows if r[0] == conv) if r[2] == "assistant"]
        found = {}
        for r in examples.where(f"conv_id = {conv} and reply is not null").collect():
            assert r["whole"] == (conv == 2)
            found[offsets[conv, r["part"]]["examples_before"] + r["example"]] = (r["context"] + r["prompt"], r["reply"])
        assert found == {i: ("".join(turns[:at]), turns[at]) for i, at in enumerate(ends)}


@pytest.mark.parametrize("held, n, cut", [(chat.HELD, 8, "example = 2"), (10, 8, "example = 2"),
                                          (10, 90, "part > 0 and row = 0"), (10, 90, "part > 0 and row = 1")])
def test_a_cut_context_is_not_read_back(spark, monkeypatch, held, n, cut):
    monkeypatch.setattr(chat, "HELD", held)
    rows = _talk(n) + [(i, 0, "user", "more text", "", "", 0) for i in range(20, 100)]
    examples = chat.prefix_targets(spark.createDataFrame(rows, SCHEMA).coalesce(2))
    assert {r[0]: tuple(r)[1:] for r in chat.read_back(examples).collect()} == _expected(rows)
    context = F.when(F.expr(f"conv_id = 7 and {cut}"), F.expr("substring(context, 2)")).otherwise(F.col("context"))
    with pytest.raises(Exception, match="context"):
        chat.read_back(examples.withColumn("context", context)).collect()
