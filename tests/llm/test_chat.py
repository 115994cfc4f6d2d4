from __future__ import annotations

import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from touchline.llm import chat

SCHEMA = "conv_id bigint, seq bigint, msg bigint, kind string, role string, text string, place int, turn string"


def read_back(df):
    rendered = chat.render(df)
    spans = rendered.select("conv_id", "formatted", chat.parse(F.col("formatted")).alias("turns"),
                            chat.loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    return {r["conv_id"]: ([(t["role"], t["text"]) for t in r["turns"]], r["loss"], r["formatted"]) for r in spans.collect()}


def brute_fold(events):
    """Messages by a plain loop over the events of one conversation, in order."""
    state = {}
    order = lambda e: (e[1] is not None, e[1] or 0, e[3] is not None, e[3] or "", e[5] or "")
    for e in sorted(events, key=order):
        _, seq, msg, kind, role, text = e
        m = state.setdefault(msg, {"at": (seq, msg), "role": None, "text": "", "born": seq})
        if kind == "start":
            m["role"] = role
        elif kind == "delta":
            m["text"] += text or ""
        elif kind == "edit":
            m["text"] = text or ""
        elif kind == "regenerate":
            m["text"] = ""
            for key in [k for k, o in state.items() if o["at"] > m["at"] and o["born"] < seq]:
                state[key]["gone"] = True
    kept = [m for m in state.values() if not m.get("gone")]
    return [(m["role"] or "", m["text"]) for m in sorted(kept, key=lambda m: m["at"])]


def events_frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)


def test_deltas_edits_and_regenerations(spark):
    rows = [
        (1, 0, 10, "start", "user", None), (1, 1, 10, "delta", None, "Hel"), (1, 2, 10, "delta", None, "lo"),
        (1, 3, 11, "start", "assistant", None), (1, 4, 11, "delta", None, "bad"), (1, 5, 12, "start", "user", None),
        (1, 6, 12, "delta", None, "no!"), (1, 7, 11, "regenerate", None, None), (1, 8, 11, "delta", None, "good"),
        (1, 9, 13, "start", "user", None), (1, 10, 13, "delta", None, "typo"), (1, 11, 13, "edit", None, "fixed"),
        (1, 12, 13, "delta", None, " it"),
    ]
    random.seed(2)
    random.shuffle(rows)
    turns, loss, _ = read_back(chat.fold(events_frame(spark, rows)))[1]
    assert turns == [("user", "Hello"), ("assistant", "good"), ("user", "fixed it")] == brute_fold(rows)
    assert loss == "good"


def test_random_logs_equal_a_plain_loop(spark):
    random.seed(7)
    rows = []
    for conv in range(40):
        seq = 0
        for _ in range(random.randint(1, 25)):
            seq += 1
            msg = random.randint(1, 5) + seq // 8 * 10
            kind = random.choice(["start", "delta", "delta", "edit", "regenerate", "other"])
            rows.append((conv, seq, msg, kind, random.choice(["user", "assistant"]), random.choice(["a", "b<|c", "", None])))
    got = read_back(chat.fold(events_frame(spark, rows)))
    for conv in range(40):
        want = brute_fold([r for r in rows if r[0] == conv])
        assert got.get(conv, ([], "", ""))[0] == want, conv
        assert got[conv][1] == "".join(t for role, t in want if role == "assistant")


NASTY = st.text(alphabet="<|\\im_endstar>\n% a", max_size=25)


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(NASTY, NASTY), min_size=1, max_size=6))
def test_any_text_and_role_come_back(turns):
    from tests.conftest import SESSION

    rows = [(1, i, role, text, 0) for i, (role, text) in enumerate(turns)]
    frame = SESSION.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, msg int")
    got, loss, formatted = read_back(chat.fold(chat.turn_events(frame)))[1]
    assert got == turns
    assert loss == "".join(t for r, t in turns if r == "assistant")
    assert formatted.count("<|im_start|>") == len(turns) == formatted.count("<|im_end|>\n")


def test_nulls_ties_repeated_rows_and_clashing_names(spark):
    rows = [
        (None, 0, "user", "x", 1), (None, 1, "assistant", None, 1), (5, None, None, "late", 1), (5, 0, "user", "b", 1),
        (5, 0, "user", "a", 1), (5, 0, "user", "a", 1), (6, 0, "assistant", "y" * 200_000 + "é", 1),
    ]
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, msg int")
    got = read_back(chat.fold(chat.turn_events(frame)))
    assert got[None][0] == [("user", "x"), ("assistant", "")]
    assert got[5][0] == [("", "late"), ("user", "a"), ("user", "a"), ("user", "b")]
    assert got[6][1] == "y" * 200_000 + "é"


def test_empty_log(spark):
    assert chat.render(chat.fold(events_frame(spark, []))).collect() == []
