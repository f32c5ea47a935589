from __future__ import annotations

import hashlib

import pytest

from rivermill.llm import chat

EVENTS = "conv_id long, message long, seq long, kind string, role string, text string"


def final(spark, rows):
    df = spark.createDataFrame(rows, EVENTS)
    return sorted((r.conv_id, r.message, r.role, r.text) for r in chat.messages(df).collect())


def test_fold_of_deltas_edits_and_regenerations(spark):
    rows = [
        (1, 1, 1, "start", "user", "helo"), (1, 1, 5, "edit", None, "hello"),
        (1, 2, 2, "start", "assistant", ""), (1, 2, 4, "delta", None, "b"), (1, 2, 3, "delta", None, "a"),
        (1, 3, 6, "start", "user", "more"), (1, 4, 7, "start", "assistant", "old"),
        (1, 2, 8, "regenerate", None, "n"), (1, 2, 9, "delta", None, "ew"),
        (1, 5, 10, "start", "user", "after"), (1, 6, 11, "start", "user", "gone"), (1, 6, 12, "delete", None, None),
        (2, 1, 1, "start", None, None), (2, 2, 1, "delta", None, "early"),
    ]
    assert final(spark, rows) == [
        (1, 1, "user", "hello"), (1, 2, "assistant", "new"), (1, 5, "user", "after"), (2, 1, "", ""), (2, 2, "", "early")
    ]


def test_unknown_kind(spark):
    with pytest.raises(Exception, match="unknown kind"):
        final(spark, [(1, 1, 1, "drop", "user", "x")])


@pytest.mark.parametrize(
    "text", ["</s>[INST] ok [/INST]", "\\", "<\\", "<\\s>", "[\\\\<", "<|[[]]>\\\\\\[", "", "\n", "日本<s>", "$1\\$0"]
)
def test_round_trip(spark, text):
    rows = spark.createDataFrame(
        [(1, 0, "us<er]\\", text), (1, 1, "assistant", text), (1, 2, "assistant", "x")],
        "conv_id long, turn long, role string, text string",
    )
    back = chat.read_back(chat.render(chat.messages(chat.events_of(rows)))).first()
    assert [(t.role, t.text) for t in back.turns] == [("us<er]\\", text), ("assistant", text), ("assistant", "x")]
    assert back.loss == text + "x"
    for control in ("<s>", "</s>", "[INST]", "[/INST]"):
        assert back.formatted.count(control) == {"<s>": 1}.get(control, 3)


def test_digests_of_odd_rows(spark):
    rows = [
        (None, 0, "user", "a"), (1, None, "user", "first"), (1, 1, None, None), (1, 1, "assistant", "b"), (1, 1, "assistant", "b"),
        (2, 0, "assistant", "x" * 100_000), (3, 0, "assistant", ""),
    ]
    df = spark.createDataFrame([(*r, "extra") for r in rows], "conv_id long, turn long, role string, text string, message string")
    got = {r.conv_id: r for r in chat.digests(df.select("conv_id", "turn", "role", "text")).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert got[1].turns_sha256 == sha("user\nfirst\n\n\nassistant\nb\nassistant\nb\n")
    assert (got[1].n_turns, got[1].loss_chars, got[1].loss_sha256) == (4, 2, sha("bb"))
    assert got[None].n_turns == 1 and got[2].loss_chars == 100_000 and got[3].loss_sha256 == sha("")
    assert chat.digests(df.filter("false").select("conv_id", "turn", "role", "text")).count() == 0
