"""Chat reconstruction: folding, escaping, reading back."""

from __future__ import annotations

import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kpi_lake.llm import chat
from kpi_lake.llm.queries import CONTROL_ROWS


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def digests(rows):
    """What reading back must give, per conversation, from ``(conv, turn, role, text)``."""
    out = {}
    for conv, _, role, text in sorted(rows, key=lambda r: (str(r[0]), r[1] is not None, r[1] or 0)):
        out.setdefault(conv, []).append((role or "", text or ""))
    made = {}
    for conv, turns in out.items():
        learned = "".join(t for r, t in turns if r == "assistant")
        made[conv] = (len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(learned), sha(learned))
    return made


def run(frame):
    got = chat.read_back(chat.render(chat.fold_events(chat.conversation_events(frame)))).collect()
    return {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in got}, got


def test_conversations_read_back(spark):
    rows = list(CONTROL_ROWS) + [
        (1, 0, "user", "a" * 2000 + "é😀" * 400),
        (1, 1, "assistant", "### user:\nfake</turn>\n\\### \\\\</turn>"),
        (1, 2, None, None),
        (1, 3, "assistant", ""),
        (2, None, "user", "before"),
        (2, 5, "ass:ist\nant", "\n\n"),
        (None, 0, "assistant", "no id"),
        (3, 1, "user", "same"),
        (3, 1, "user", "same"),
    ]
    kinds = "conv_id bigint, turn bigint, role string, text string, message string, seq int, log string"
    frame = spark.createDataFrame([(*r, "m", 1, "l") for r in rows], kinds).repartition(3, "role")
    got, raw = run(frame)
    assert got == digests(rows)
    whole = chat.render(chat.fold_events(chat.conversation_events(frame))).groupBy("conv_id").agg(F.sum(F.length("piece")).alias("n")).collect()
    assert {r.conv_id: r.n for r in whole} == {r.conv_id: r.formatted_chars for r in raw}


def test_deltas_edits_and_regenerations_fold(spark):
    events = [
        (1, "m1", 1, "delta", "user", "Hel"),
        (1, "m2", 3, "delta", "assistant", "wrong"),
        (1, "m1", 2, "delta", None, "lo"),
        (1, "m2", 4, "regenerate", None, None),
        (1, "m2", 5, "delta", None, "right"),
        (1, "m2", 7, "delta", None, "!"),
        (1, "m3", 8, "delta", "user", "x"),
        (1, "m3", 9, "edit", None, "edited"),
        (1, None, 10, None, "user", "alone"),
        (1, None, 10, None, "user", "alone"),
    ]
    frame = spark.createDataFrame(events, "conv_id bigint, message string, seq int, kind string, role string, text string").repartition(4)
    rows = chat.fold_events(frame).orderBy("at", "message").collect()
    assert [(r.role, r.text) for r in rows] == [("user", "Hello"), ("assistant", "right!"), ("user", "edited"), ("user", "alone"), ("user", "alone")]


def test_empty_log(spark):
    frame = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    assert run(frame)[0] == {}


CONTROL = st.lists(st.sampled_from(["\\", "###", "#", "</turn>", "<", "\n", ":", "a", "😀", "### user:\n"]), max_size=12).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(CONTROL, CONTROL), max_size=4))
def test_escaping_is_reversible(turns):
    """The template's escapes, as its column expressions make them, parse back to the turns."""
    import re

    def text(t):
        return re.sub(r"(\\|###|</turn>)", r"\\\1", t)

    def role(r):
        return re.sub(r"(\\|###|:|\n)", r"\\\1", r)

    formatted = "".join(f"### {role(r)}:\n{text(t)}{chat.END}\n" for r, t in turns)
    assert chat.parse(formatted) == turns


def test_column_escapes_equal_the_plain_ones(spark):
    import re

    rows = ["\\", "\\\\###", "</turn>\n####", "a:b\n", "$1 \\$"]
    frame = spark.createDataFrame([(r,) for r in rows], "t string")
    got = frame.select(chat.escape_text(F.col("t")), chat.escape_role(F.col("t"))).collect()
    assert [r[0] for r in got] == [re.sub(r"(\\|###|</turn>)", r"\\\1", r) for r in rows]
    assert [r[1] for r in got] == [re.sub(r"(\\|###|:|\n)", r"\\\1", r) for r in rows]
