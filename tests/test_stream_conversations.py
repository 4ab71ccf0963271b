"""Conversations from streams of turns, against assembling the table."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from loomset.operators.turns import assemble_conversations, pair_turns
from loomset.streaming import conversations, jobs

SCHEMA = "conv_id long, turn long, role string, text string, at timestamp"
START = datetime(2024, 1, 1)


def minutes(n):
    return START + timedelta(minutes=n)


class Arrivals:
    """Files that arrive one after the other; each run takes those that are new, one to a batch."""

    def __init__(self, spark, base, **options):
        self.spark, self.base, self.options = spark, str(base), options

    def add(self, rows):
        self.spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{self.base}/in")

    def run(self):
        stream = jobs.file_stream(self.spark, f"{self.base}/in", SCHEMA, max_files_per_trigger=1)
        with conversations.keyed_state(self.spark):
            closing = conversations.assemble_stream(stream, "at", **self.options)
            jobs.append_available(closing, f"{self.base}/out", f"{self.base}/checkpoint")
        return self.out()

    def out(self):
        return self.spark.read.parquet(f"{self.base}/out")


def told(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_turns_in_any_order_and_runs_equal_the_table(spark, tmp_path):
    rng = random.Random(8)
    roles = ["system", "user", "assistant", "tool"]
    rows = [(c, n, rng.choice(roles), rng.choice(["a", "", None, "é\n"]), minutes(rng.randrange(60))) for c in range(12) for n in range(rng.randrange(1, 9))]
    rows += [(None, 1, "user", "no key", minutes(3)), (3, None, None, None, minutes(4)), (4, 0, "user", "twice", minutes(5)), (4, 0, "user", "twice", minutes(5))]
    rng.shuffle(rows)
    arrivals = Arrivals(spark, tmp_path, delay="2 hours", idle=timedelta(minutes=10))
    for part in range(4):
        arrivals.add(rows[part::4])
        if part % 2:
            assert arrivals.run().count() == 0
    arrivals.add([(99, 0, "user", "much later", minutes(10_000))])
    closed = arrivals.run()
    table = spark.createDataFrame(rows, SCHEMA)
    assert told(conversations.conversations_of(closed)) == told(assemble_conversations(table))
    unique = closed.filter("conv_id NOT IN (3, 4)")
    assert told(conversations.pairs_of(unique)) == told(pair_turns(table.filter("conv_id NOT IN (3, 4)")))
    assert closed.filter("status = 'late'").count() == 0


def test_idle_conversations_close_and_late_turns_are_told(spark, tmp_path):
    arrivals = Arrivals(spark, tmp_path, delay="0 minutes", idle=timedelta(minutes=10), remember=timedelta(minutes=100))
    arrivals.add([(1, 0, "user", "a", minutes(0)), (2, 0, "user", "b", minutes(0))])
    arrivals.add([(2, 1, "assistant", "c", minutes(8))])
    arrivals.add([(3, 0, "user", "time goes on", minutes(15))])
    closed = arrivals.run()
    assert [(r["conv_id"], len(r["turns"])) for r in closed.collect()] == [(1, 1)]
    # Conversation 1 has closed; 2 goes on.
    arrivals.add([(1, 1, "user", "too late", minutes(16)), (2, 2, "user", "d", minutes(16))])
    arrivals.add([(3, 1, "user", "on", minutes(40))])
    rows = {(r["conv_id"], r["status"]): [t["text"] for t in r["turns"]] for r in arrivals.run().collect()}
    assert rows == {(1, "closed"): ["a"], (1, "late"): ["too late"], (2, "closed"): ["b", "c", "d"]}
    # After another while the mark is gone too: what comes then is a conversation of its own.
    arrivals.add([(3, 2, "user", "on and on", minutes(300))])
    arrivals.run()
    arrivals.add([(1, 2, "user", "again", minutes(310))])
    arrivals.add([(4, 0, "user", "end", minutes(400))])
    after = [(r["status"], [t["text"] for t in r["turns"]]) for r in arrivals.run().filter("conv_id = 1").collect()]
    assert ("closed", ["again"]) in after and len(after) == 3


def test_a_run_that_breaks_off_goes_on_where_it_stopped(spark, tmp_path):
    arrivals = Arrivals(spark, tmp_path, delay="0 minutes", idle=timedelta(minutes=10))
    arrivals.add([(1, 0, "user", "a", minutes(0))])
    arrivals.run()
    arrivals.add([(1, 1, "assistant", "b", minutes(5))])
    arrivals.add([(2, 0, "user", "later", minutes(60))])
    stream = jobs.file_stream(spark, f"{tmp_path}/in", SCHEMA, max_files_per_trigger=1)
    with conversations.keyed_state(spark):
        broken = conversations.assemble_stream(stream, "at", delay="0 minutes", idle=timedelta(minutes=10)).withColumn(
            "status", F.when(F.size("turns") > 0, F.raise_error(F.lit("stop"))).otherwise(F.col("status")).cast("string")
        )
        with pytest.raises(Exception, match="stop"):
            jobs.append_available(broken, f"{tmp_path}/out", f"{tmp_path}/checkpoint")
    got = arrivals.run().collect()
    assert [(r["conv_id"], [t["text"] for t in r["turns"]]) for r in got] == [(1, ["a", "b"])]


def test_settings_of_the_session_stay(spark):
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    with conversations.keyed_state(spark):
        assert "RocksDB" in spark.conf.get(name)
    assert spark.conf.get(name, None) == before
    with pytest.raises(ValueError, match="key"):
        conversations.assemble_stream(spark.createDataFrame([], SCHEMA), "at", key="status")
