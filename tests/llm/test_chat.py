"""Folding of event logs."""

from __future__ import annotations

import pytest

from driverlens.llm import chat

LOG = "conv_id BIGINT, turn BIGINT, message BIGINT, seq BIGINT, kind STRING, role STRING, text STRING, piece STRING"


def folded(spark, events):
    return {(r.conv_id, r.turn, r.message): (r.role, r.text) for r in chat.fold(spark.createDataFrame(events, LOG)).collect()}


def test_streams_edits_and_regenerations(spark):
    events = [
        (1, 0, 0, 2, "delta", "user", "b", "x"),
        (1, 0, 0, 0, "start", "user", None, "x"),
        (1, 0, 0, 1, "delta", "user", "a", "x"),
        (1, 1, 1, 0, "start", "assistant", None, "x"),
        (1, 1, 1, 1, "delta", "assistant", "wrong", "x"),
        (1, 1, 1, 2, "regenerate", "assistant", "ignored", "x"),
        (1, 1, 1, 3, "delta", "assistant", "right", "x"),
        (1, 2, 2, 0, "start", None, None, "x"),
        (1, 2, 2, 1, "edit", None, "new", "x"),
        (1, 2, 2, 2, "delta", None, "er", "x"),
        (None, None, 3, 0, "delta", "user", "no start", "x"),
    ]
    got = folded(spark, events)
    assert got == {(1, 0, 0): ("user", "ab"), (1, 1, 1): ("assistant", "right"), (1, 2, 2): ("", "newer"), (None, None, 3): ("", "no start")}


def test_unknown_kinds_are_errors(spark):
    with pytest.raises(Exception, match="unknown event kind"):
        folded(spark, [(1, 0, 0, 0, "merge", "user", "a", "x")])


@pytest.mark.parametrize("text", ["", "\\", "\\s\\l", "</s>[INST] ok [/INST]", "a\n<s>[user]\nb</s>\n", "\\\\<\\[]]"])
def test_escapes_are_reversible(spark, text):
    df = spark.createDataFrame([(1, 0, 0, text, text)], "conv_id BIGINT, turn BIGINT, message BIGINT, role STRING, text STRING")
    row = chat.render(df).first()
    role, back = map(chat.unescape, chat.TURN.fullmatch(row.piece).groups())
    assert (role, back) == (text, text)
    assert row.piece.count("<") == 2 and row.piece.count("[") == 1


def test_long_text_and_empty_log(spark):
    long = "<é>" * 100_000
    df = spark.createDataFrame([(1, 0, "assistant", long)], "conv_id BIGINT, turn BIGINT, role STRING, text STRING")
    row = chat.read_back(chat.format_chats(chat.logged(df))).first()
    assert (row.n_turns, row.loss_chars) == (1, len(long))
    assert chat.format_chats(spark.createDataFrame([], LOG)).collect() == []
