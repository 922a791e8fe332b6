import itertools
import random

import pytest
from pyspark.sql import functions as F

from kestrel.llm import chat

EVENT = "conv_id long, message long, seq long, kind string, role string, text string"


def fold(events):
    """Plain replay of a log: {conv: [(role, text)]}."""
    rank = {"regenerate": 0, "edit": 1}
    state = {}
    key = lambda e: (e[2] is not None, e[2] or 0, rank.get(e[3], 2), e[5] or "", e[4] or "")
    by = {}
    for e in events:
        by.setdefault((e[0], e[1]), []).append(e)
    for (conv, message), own in by.items():
        text = ""
        own.sort(key=key)
        for e in own:
            text = (e[5] or "") if e[3] in rank else text + (e[5] or "")
        seqs = [e[2] for e in own if e[3] == "regenerate" and e[2] is not None]
        state.setdefault(conv, []).append((message, own[-1][4] or "", text, own[-1][2], max(seqs, default=None)))
    out = {}
    for conv, messages in state.items():
        messages.sort(key=lambda m: (m[0] is not None, m[0] or 0))
        kept = []
        for i, m in enumerate(messages):
            cuts = [x[4] for x in messages[:i] if x[4] is not None]
            if not (cuts and m[3] is not None and max(cuts) > m[3]):
                kept.append((m[1], m[2]))
        if kept:
            out[conv] = kept
    return out


def read(events):
    out = chat.render(chat.reconstruct(events))
    rows = out.select("conv", "formatted", chat.read_turns(F.col("formatted")).alias("t"), chat.loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss"), "loss_spans").collect()
    for r in rows:
        raw = r["formatted"].encode()
        assert all(raw[: s["start"]].endswith(b"|>\n") and raw[s["start"] + s["length"] :].startswith(b"</s>\n") for s in r["loss_spans"])
    return {r["conv"]: ([tuple(t) for t in r["t"]], r["loss"]) for r in rows}


def check(spark, events):
    got = read(spark.createDataFrame(events, EVENT))
    want = fold(events)
    assert {k: v[0] for k, v in got.items()} == want
    assert {k: v[1] for k, v in got.items()} == {k: "".join(t for r, t in v if r == "assistant") for k, v in want.items()}


def test_deltas_edits_and_regenerations(spark):
    check(spark, [
        (1, 0, 1, "delta", "user", "He"), (1, 0, 2, "delta", "user", "llo"),
        (1, 1, 3, "delta", "assistant", "bad"), (1, 2, 4, "delta", "user", "gone"),
        (1, 1, 5, "regenerate", "assistant", None), (1, 1, 6, "delta", "assistant", "go"), (1, 1, 7, "delta", "assistant", "od"),
        (1, 2, 8, "delta", "user", "!"), (1, 0, 9, "edit", "user", "Hi"),
        (2, 0, 1, "edit", "user", "x"), (2, 1, 2, "regenerate", "assistant", "whole"),
    ])


@pytest.mark.parametrize("seed", range(3))
def test_random_logs_equal_replay(spark, seed):
    r = random.Random(seed)
    texts = ["a", "", None, "</s>", "[INST]", "<|user|>\n", "\\", "\\\\<", "é ", "|>\n", "</s>\n", "[/INST] <", "日\n\n"]
    events = [
        (r.choice([1, 2, 3, None, 2**40]), r.randint(0, 4), r.choice([None, *range(12)]), r.choice(["delta", "delta", "edit", "regenerate", None, "other"]), r.choice(["user", "assistant", "system", None, "<|x|>", "a|>\nb\\"]), r.choice(texts))
        for _ in range(150)
    ]
    check(spark, events + events[:5])


def test_escapes_are_reversible_and_hide_controls(spark):
    parts = ["<", "[", "\\", "|", "/s>", "INST]", "|>\n", "x"]
    texts = ["".join(p) for n in range(4) for p in itertools.product(parts, repeat=n)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for extra in ("", "|"):
        for r in df.select("t", chat.escape(F.col("t"), extra).alias("e")).withColumn("u", chat.unescape(F.col("e"), extra)).collect():
            assert r["u"] == r["t"]
            assert not any(x in r["e"] for x in ("</s>", "[INST]", "[/INST]", "<|", "<s>"))


def test_text_with_marks_round_trips(spark):
    check(spark, [(1, 0, 0, "delta", "assistant", t) for t in ("a|\\b", "|\\", "\\|")])


def test_empty_log_and_long_conversation(spark):
    assert read(spark.createDataFrame([], EVENT)) == {}
    check(spark, [(1, i, i, "delta", "assistant" if i % 2 else "user", "text <s> " * 50) for i in range(600)])


def test_native_plan(spark):
    from ..conftest import plan_text

    text = plan_text(chat.render(chat.reconstruct(spark.range(3).selectExpr("id conv_id", "id message", "id seq", "'delta' kind", "'user' role", "'x' text"))))
    assert "Python" not in text and "Arrow" not in text
