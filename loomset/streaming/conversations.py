"""Conversations assembled from streams of turns.

Turns of a conversation may lie in many files and arrive in any order. They are
kept as state, by conversation, until the stream's time has passed its newest
turn by ``idle``; then the conversation is emitted whole and its state dropped. For
another ``remember`` a mark stays, and a turn that still arrives is emitted by
itself, marked as late. So state is bounded: open conversations, and one mark
for each that closed within ``remember``.

Turns that are older than the watermark when they arrive are dropped by Spark, which counts
them; ``delay`` says how far behind the newest turn they may be.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from loomset.functions.text import ref

#: The state's settings while a query starts.
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

CLOSED, LATE = "closed", "late"

_TURN = T.StructType(
    [T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType())]
)


@contextmanager
def keyed_state(spark: SparkSession) -> Iterator[None]:
    """State on disk for queries started inside; afterwards the session's settings hold again."""
    before = {name: spark.conf.get(name, None) for name in STATE_SETTINGS}
    for name, value in STATE_SETTINGS.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


class _Assembler(StatefulProcessor):
    """Keeps a conversation's turns until a timer closes it."""

    def __init__(self, key: str, idle_ms: int, remember_ms: int):
        self.key, self.idle, self.remember = key, idle_ms, remember_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.turns = handle.getListState("turns", _TURN)
        self.newest = handle.getValueState("newest", "ms long")
        self.closed = handle.getValueState("closed", "at long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        arrived = [(r["turn"], r["role"], r["text"], r["ms"]) for r in rows]
        if self.closed.exists():
            for turn in arrived:
                yield self._row(key, LATE, [turn[:3]])
            return
        self.turns.appendList([turn[:3] for turn in arrived])
        before = self.newest.get()[0] if self.newest.exists() else None
        newest = max([ms for *_, ms in arrived if ms is not None] + [before or 0])
        if newest != before:
            self._clear_timers()
            self.newest.update((newest,))
            self.handle.registerTimer(max(newest + self.idle, timerValues.getCurrentWatermarkInMs() + 1))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if self.closed.exists():
            self.closed.clear()
            return
        # As in a table: by number, then role and text; missing ones first.
        said = sorted((tuple(t) for t in self.turns.get()), key=lambda turn: [(v is not None, v) for v in turn])
        self.turns.clear()
        self.newest.clear()
        if self.remember > 0:
            at = expiredTimerInfo.getExpiryTimeInMs()
            self.closed.update((at,))
            self.handle.registerTimer(at + self.remember)
        yield self._row(key, CLOSED, said)

    def close(self) -> None:
        pass

    def _clear_timers(self) -> None:
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)

    def _row(self, key, status: str, turns: list[tuple]) -> Row:
        return Row(**{self.key: key[0], "status": status, "turns": [Row(turn=n, role=r, text=t) for n, r, t in turns]})


def assemble_stream(
    turns: DataFrame,
    time: str,
    key: str = "conv_id",
    order: str = "turn",
    role: str = "role",
    text: str = "text",
    delay: str = "10 minutes",
    idle: timedelta = timedelta(minutes=30),
    remember: timedelta = timedelta(days=1),
) -> DataFrame:
    """A row per conversation that has closed: ``key``, ``status`` (``closed``) and its ``turns`` in order.

    ``turns`` is an array of turn, role and text. A turn that comes after its
    conversation closed is a row of its own, of status ``late``. Turns without a
    time are kept and don't put off the closing. Start queries within ``keyed_state``.
    """
    if key in ("status", "turns", "ms"):
        raise ValueError(f"name the key other than {key!r}")
    timed = turns.withColumn(time, ref(time).cast("timestamp")).withWatermark(time, delay)
    said = timed.select(
        ref(key).alias(key),
        ref(order).cast("long").alias("turn"),
        ref(role).alias("role"),
        ref(text).alias("text"),
        F.unix_millis(ref(time)).alias("ms"),
        ref(time).alias("_time"),
    )
    out = T.StructType(
        [
            T.StructField(key, turns.schema[key].dataType),
            T.StructField("status", T.StringType()),
            T.StructField("turns", T.ArrayType(_TURN)),
        ]
    )
    processor = _Assembler(key, round(idle.total_seconds() * 1000), round(remember.total_seconds() * 1000))
    return said.groupBy(ref(key)).transformWithState(processor, out, "Append", "EventTime")


def conversations_of(closed: DataFrame, key: str = "conv_id") -> DataFrame:
    """Closed conversations as ``turns.assemble_conversations`` has them; late turns are left out."""
    messages = F.transform("turns", lambda t: F.struct(t["role"].alias("from"), t["text"].alias("value")))
    return closed.filter(F.col("status") == CLOSED).select(ref(key), messages.alias("conversations"))


def pairs_of(
    closed: DataFrame, key: str = "conv_id", asks: str = "user", answers: str = "assistant", context: str = "system"
) -> DataFrame:
    """Closed conversations as the rows of ``turns.pair_turns``, each from its own array."""
    said = F.col("turns")

    def answered(t: Column, i: Column) -> Column:
        follows = F.get(said, i + 1)
        fits = (t["role"] == asks) & (follows["role"] == answers)
        return F.when(fits, F.struct(t["turn"].alias("turn"), t["text"].alias("instruction"), follows["text"].alias("output")))

    pairs = F.filter(F.transform(said, answered), lambda p: p.isNotNull())
    told = F.get(F.filter(said, lambda t: t["role"] == context), F.lit(0))["text"]
    rows = closed.filter(F.col("status") == CLOSED).select(
        ref(key), F.coalesce(told, F.lit("")).alias("input"), F.explode(pairs).alias("pair")
    )
    return rows.select(ref(key), F.col("pair.turn").alias("turn"), "pair.instruction", "input", "pair.output")
