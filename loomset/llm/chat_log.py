"""Conversations rebuilt from an event log, rendered, and read back.

Events carry a conversation, a message within it, a sequence number and a kind:

- ``open`` starts a message and names its role; messages stand in the order of
  their first ``open``,
- ``delta`` appends a piece of text,
- ``edit`` replaces the text so far,
- ``regenerate`` empties it, to be streamed anew,
- ``delete`` removes the message; a later ``edit`` or ``regenerate`` restores it.

The log is partitioned by conversation and message, sorted by sequence and
folded, so that a conversation of any length is folded by many tasks and a task
holds one message. Rendering is a projection. A rendered conversation is its
parts, one a message, in order: nothing ever holds a whole conversation.

A part is ``<turn>### role: text</turn>`` and a newline. Before each backslash and each
control string inside a role or text (and each colon of a role) stands a
backslash, so the text never closes its turn and reading back is exact.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN, DELTA, EDIT, REGENERATE, DELETE = "open", "delta", "edit", "regenerate", "delete"

TURN, MARK, BETWEEN, END = "<turn>", "### ", ": ", "</turn>\n"
_CONTROL = r"(\\|</?turn>|###)"
_ROLE_CONTROL = r"(\\|</?turn>|###|:)"
_PART = re.compile(r"<turn>### ((?:[^\\:]|\\.)*): ((?:[^\\<]|\\.|<(?!/turn>))*)</turn>\n", re.S)


def fold(events: DataFrame) -> DataFrame:
    """Final messages of a log: ``conv_id``, ``position`` (sequence of the first ``open``), ``role``, ``text``.

    ``events`` has ``conv_id``, ``message``, ``seq``, ``kind``, ``role``,
    ``text``; ids and sequence may be null or of any type that sorts. Events of
    equal sequence apply in the order of kind (delete, delta, edit, open, regenerate), then text. A null text is empty. A
    repeated ``open`` changes nothing; a message without one has the role
    of its first event and stands where that does. Unknown and null kinds are ignored.
    """
    event = F.struct("seq", "kind", F.coalesce("text", F.lit("")).alias("text"), "role")
    start = F.struct(F.lit("").alias("text"), F.lit(False).alias("gone"))

    def step(state: Column, e: Column) -> Column:
        kind, text = e["kind"], e["text"]
        return (
            F.when(kind == DELTA, F.struct(F.concat(state["text"], text).alias("text"), state["gone"].alias("gone")))
            .when(kind == EDIT, F.struct(text.alias("text"), F.lit(False).alias("gone")))
            .when(kind == REGENERATE, F.struct(F.lit("").alias("text"), F.lit(False).alias("gone")))
            .when(kind == DELETE, F.struct(F.lit("").alias("text"), F.lit(True).alias("gone")))
            .otherwise(state)
        )

    log = F.col("log")
    opened = F.filter(log, lambda e: e["kind"] == OPEN)
    first = F.coalesce(F.get(opened, 0), F.get(log, 0))
    return (
        events.filter(F.col("kind").isin(OPEN, DELTA, EDIT, REGENERATE, DELETE))
        .groupBy("conv_id", "message")
        .agg(F.array_sort(F.collect_list(event)).alias("log"))
        .select("conv_id", "message", first["seq"].alias("position"), first["role"].alias("role"), F.aggregate(log, start, step).alias("end"))
        .filter("NOT end.gone")
        .select("conv_id", "position", "message", "role", F.col("end.text").alias("text"))
    )


def _escaped(text: Column, control: str) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), control, r"\\$1")


def render(messages: DataFrame, loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """Parts of rendered conversations: ``conv_id``, ``position``, ``message``, ``part``, ``loss_start``, ``loss_length``.

    The loss mask covers the escaped text of a part whose role is one of
    ``loss_roles``: so many code points from ``loss_start`` on; else its length
    is null. A null role or text is empty.
    """
    head = F.concat(F.lit(TURN + MARK), _escaped(F.col("role"), _ROLE_CONTROL), F.lit(BETWEEN))
    text = _escaped(F.col("text"), _CONTROL)
    learned = F.col("role").isin(*loss_roles)
    return messages.select(
        "conv_id",
        "position",
        "message",
        F.concat(head, text, F.lit(END)).alias("part"),
        F.length(head).alias("loss_start"),
        F.when(learned, F.length(text)).alias("loss_length"),
    )


def read_part(part: str) -> tuple[str, str]:
    """Role and text of a rendered part."""
    found = _PART.fullmatch(part)
    if not found:
        raise ValueError(f"not a rendered turn: {part[:60]!r}")
    return unescape(found[1]), unescape(found[2])


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


def digests(parts: DataFrame) -> DataFrame:
    """What each rendered conversation says, read back from its parts in order.

    Returns ``conv_id``, ``n_turns``, ``turns_sha256`` (of role, newline, text,
    newline per turn), ``loss_chars`` and ``loss_sha256`` (of the unescaped
    text under the mask) and ``formatted_chars``. Parts stream through a task
    sorted by conversation; it keeps hashes, not texts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, now, state = [], None, None
        for batch in batches:
            columns = [batch.column(c) for c in ("conv_id", "part", "loss_start", "loss_length")]
            for conv, part, start, length in zip(*columns):
                conv, part = conv.as_py(), part.as_py()
                if state is None or conv != now:
                    if state:
                        rows.append((now, *_closed(state)))
                    now, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                role, text = read_part(part)
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
                state[4] += len(part)
                if length.is_valid:
                    learned = unescape(part[start.as_py() : start.as_py() + length.as_py()])
                    state[2] += len(learned)
                    state[3].update(learned.encode())
            if len(rows) >= 1000:
                yield _digest_rows(rows, kind)
                rows = []
        if state:
            rows.append((now, *_closed(state)))
        if rows:
            yield _digest_rows(rows, kind)

    kind = pa.int64() if parts.schema["conv_id"].dataType.simpleString() == "bigint" else pa.string()
    ordered = parts.repartition("conv_id").sortWithinPartitions("conv_id", "position", "message")
    if kind == pa.string():
        ordered = ordered.withColumn("conv_id", F.col("conv_id").cast("string"))
    return ordered.select("conv_id", "part", "loss_start", "loss_length").mapInArrow(
        run,
        f"conv_id {'bigint' if kind == pa.int64() else 'string'}, n_turns long, turns_sha256 string, "
        "loss_chars long, loss_sha256 string, formatted_chars long",
    )


def _closed(state: list) -> tuple:
    return state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]


def _digest_rows(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    kinds = (kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
    names = ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=list(names))


def as_events(turns: DataFrame, piece: int = 400) -> DataFrame:
    """A turn table (``conv_id``, ``turn``, ``role``, ``text``) as the log that streaming it would leave.

    Every row opens a message and streams its text in pieces. An assistant's
    turn is streamed twice: a first try that is cut off after a piece, then a
    regeneration. A system turn comes as a draft that an edit replaces. Rows
    that repeat a turn number are messages of their own, ordered by role and text.
    """
    text = F.coalesce("text", F.lit(""))
    pieces = F.when(F.length(text) <= piece, F.array(text)).otherwise(
        F.regexp_extract_all(text, F.lit(rf"(?s).{{1,{piece}}}"), 0)
    )
    event = lambda kind, said: F.struct(F.lit(kind).alias("kind"), said.alias("text"))
    stream = F.transform(pieces, lambda p: event(DELTA, p))
    log = F.concat(
        F.array(event(OPEN, F.lit(""))),
        F.when(F.col("role") == "assistant", F.concat(F.slice(stream, 1, 1), F.array(event(REGENERATE, F.lit("")))))
        .when(F.col("role") == "system", F.slice(stream, 1, 1))
        .otherwise(F.slice(stream, 1, 0)),
        F.when(F.col("role") == "system", F.array(event(EDIT, text))).otherwise(stream),
    )
    alike = Window.partitionBy("conv_id", "turn").orderBy("role", "text")
    return (
        turns.withColumn("copy", F.row_number().over(alike))
        .select("conv_id", "role", F.struct("turn", "copy").alias("message"), F.posexplode(log).alias("step", "event"))
        .select("conv_id", "message", F.struct("message.turn", "step").alias("seq"), "event.kind", "role", "event.text")
    )
