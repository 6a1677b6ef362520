"""Chat formatting by event-sourced reconstruction.

A log holds events of conversations: ``delta`` appends to a message, ``edit`` replaces its text,
``regenerate`` throws its text away and begins anew with the event's own. Events are gathered by
conversation and message, put in sequence and folded into the final text; a message stands where
its first event does. Each message is then rendered as

    ### role:
    text</turn>

with control strings (``###``, ``</turn>`` and the backslash) escaped by a backslash, reversibly,
and, in a role, also the colon and the line end. The formatted conversation is its turns' pieces,
one after another; the loss mask covers the escaped text of each assistant turn.

Scale: folding groups by message, so a conversation that holds a third of all rows is spread over
many tasks. Reading back streams over the pieces in order, sorted within hash partitions; its state
is one piece and three running digests, whatever the length of a conversation.

Defined cases: null texts and roles are empty; null conversation ids are one conversation; events
with a null message are messages of their own; a kind that is null or unknown counts as ``delta``;
ties in the sequence go by message, kind, role and text; repeated rows without a message are
repeated turns; an empty log gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

END = "</turn>"
ASSISTANT = "assistant"
#: Code points in one streamed delta of the conversations' texts.
DELTA = 512
_ESCAPED = re.compile(r"\\(\\|###|</turn>|:|\n)")
_TURN = re.compile(r"### ((?:\\(?:\\|###|:|\n)|[^\\:\n])*):\n((?:[^\\<#]++|\\(?:\\|###|</turn>)|(?!</turn>)<|(?!###)#)*+)</turn>\n")


def fold_events(events: DataFrame, conv: str = "conv_id", message: str = "message", seq: str = "seq", kind: str = "kind", role: str = "role", text: str = "text") -> DataFrame:
    """Final messages: ``conv_id, at`` (sequence of the first event), ``message, role, text``. The
    role is that of the first event that has one."""
    own = F.coalesce(F.col(message).cast("string"), F.concat(F.lit("row "), F.monotonically_increasing_id().cast("string")))
    rows = events.select(
        F.col(conv).alias("conv_id"),
        own.alias("message"),
        F.struct(
            F.col(seq).alias("seq"),
            F.coalesce(F.col(kind), F.lit("delta")).alias("kind"),
            F.col(role).cast("string").alias("role"),
            F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
        ).alias("event"),
    )
    grouped = rows.groupBy("conv_id", "message").agg(F.array_sort(F.collect_list("event")).alias("log"))
    resets = F.filter(F.sequence(F.lit(1), F.size("log")), lambda i: F.element_at("log", i)["kind"].isin("edit", "regenerate"))
    begin = F.coalesce(F.array_max(resets), F.lit(1))
    live = F.slice("log", begin, F.size("log") - begin + 1)
    roles = F.filter(F.transform("log", lambda e: e["role"]), lambda r: r.isNotNull())
    return grouped.select(
        "conv_id",
        F.element_at("log", 1)["seq"].alias("at"),
        "message",
        F.coalesce(F.get(roles, F.lit(0)), F.lit("")).alias("role"),
        F.array_join(F.transform(live, lambda e: e["text"]), "").alias("text"),
    )


def escape_text(text: Column) -> Column:
    return F.regexp_replace(text, r"(\\|###|</turn>)", r"\\$1")


def escape_role(role: Column) -> Column:
    return F.regexp_replace(role, r"(\\|###|:|\n)", r"\\$1")


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def render(messages: DataFrame, loss_role: str = ASSISTANT) -> DataFrame:
    """Adds ``piece`` (the rendered turn) and ``loss_start, loss_end``: code points of the piece
    under the loss mask, or nulls."""
    head = F.concat(F.lit("### "), escape_role(F.col("role")), F.lit(":\n"))
    body = escape_text(F.col("text"))
    learned = F.col("role") == loss_role
    return messages.select(
        "*",
        F.concat(head, body, F.lit(END + "\n")).alias("piece"),
        F.when(learned, F.length(head)).cast("bigint").alias("loss_start"),
        F.when(learned, F.length(head) + F.length(body)).cast("bigint").alias("loss_end"),
    )


def parse(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts of a formatted conversation; raises if a part of it is no turn."""
    turns, at = [], 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if m is None:
            raise ValueError(f"no turn at {at}")
        turns.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    return turns


_SCHEMA = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("n_turns", pa.int64()),
        ("turns_sha256", pa.string()),
        ("loss_chars", pa.int64()),
        ("loss_sha256", pa.string()),
        ("formatted_chars", pa.int64()),
    ]
)


def read_back(rendered: DataFrame) -> DataFrame:
    """Per conversation, parsed from its formatted text: number and digest of its turns, and length
    and digest of what is under the loss mask."""
    kinds = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"

    def run(batches):
        at, state, out = object(), None, []

        def close():
            return (at, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4])

        for batch in batches:
            for conv, piece, start, end in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if state is None or conv != at:
                    if state is not None:
                        out.append(close())
                    at, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, text in parse(piece):
                    state[0] += 1
                    state[1].update(f"{role}\n{text}\n".encode())
                if start is not None:
                    learned = unescape(piece[start:end])
                    state[2] += len(learned)
                    state[3].update(learned.encode())
                state[4] += len(piece)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _SCHEMA, strict=True)], schema=_SCHEMA)
                out = []
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([c], f.type) for c, f in zip(close(), _SCHEMA, strict=True)], schema=_SCHEMA)

    pieces = rendered.select("conv_id", "at", "message", "piece", "loss_start", "loss_end")
    ordered = pieces.repartition(F.col("conv_id")).sortWithinPartitions("conv_id", "at", "message")
    return ordered.select("conv_id", "piece", "loss_start", "loss_end").mapInArrow(run, kinds)


def conversation_events(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", delta: int = DELTA) -> DataFrame:
    """A log of streamed deltas for rows that hold a whole turn each."""
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    n = F.greatest(F.lit(1), F.ceil(F.length(whole) / delta)).cast("int")
    rows = conversations.select(
        F.col(conv).cast("bigint").alias("conv_id"),
        F.format_string("%019d", F.monotonically_increasing_id()).alias("message"),
        F.col(turn).cast("bigint").alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        F.when(n == 1, F.array(whole)).otherwise(F.regexp_extract_all(whole, F.lit(f"(?s).{{1,{delta}}}"), F.lit(0))).alias("deltas"),
    )
    return rows.select("conv_id", "message", "turn", "role", F.posexplode("deltas").alias("part", "text")).select(
        "conv_id", "message", F.struct("turn", "message", "part").alias("seq"), F.lit("delta").alias("kind"), "role", "text"
    )
