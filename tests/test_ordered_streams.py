"""Streaming folds whose triggers bring a key's rows in any order, against plain folds and their batch twins."""

import random

import pytest
from pyspark.sql import functions as F

from rillmark.operators import states
from rillmark.session import scratch
from rillmark.streaming import streams as S

HOUR = 3_600_000


def _log(rows=240, keys=6, seed=2):
    """seq, key, epoch milliseconds and amount; time grows with seq, some times are equal."""
    rng, now, out = random.Random(seed), 1_700_000_000_000, []
    for seq in range(rows):
        now += rng.choice([0, 1, 60_000, HOUR, 9 * HOUR])
        out.append((seq, rng.choice([None, 0, *range(1, keys)]), now, rng.randrange(-60, 50)))
    return out


def _pushed(spark, log, files, seed=3):
    """The rows in random order as that many files, one a trigger."""
    rows, landing = list(log), scratch(spark, "shuffled")
    random.Random(seed).shuffle(rows)
    for i in range(files):
        df = spark.createDataFrame(rows[i::files], "seq long, k long, ms long, amount long")
        S.push(df.select("seq", "k", F.timestamp_millis("ms").alias("ts"), "amount").coalesce(1), landing)
    schema = spark.read.parquet(landing).schema
    return S.landed_stream(spark, landing, schema, files=1)


def _folded(log):
    balance, out = {}, []
    for seq, key, _, amount in log:
        now = balance.get(key, 0)
        ok = now + amount >= 0
        balance[key] = now + amount if ok else now
        out.append((seq, key, amount, ok, balance[key]))
    return out


@pytest.mark.parametrize("slot_ms", [HOUR, 24 * HOUR, 10_000 * HOUR])
def test_balances_do_not_depend_on_triggers(spark, slot_ms):
    log = _log()
    marked, release = S.with_sentinel(_pushed(spark, log, 5), "ts")
    rows = S.guarded_account_stream(marked.withWatermark("ts", S.REPLAY_LATENESS), "k", "ts", "seq", "amount", slot_ms)
    got = S.drain_closed(spark, rows, release, "shuffled-account").select("seq", "k", "amount", "accepted", "balance")
    assert sorted(map(tuple, got.collect())) == _folded(log)
    df = spark.createDataFrame(log, "seq long, k long, ms long, amount long")
    twin = states.guarded_balance(df, ["k"], ["seq"], "amount").select("seq", "k", "amount", "accepted", "balance")
    assert sorted(map(tuple, twin.collect())) == _folded(log)


@pytest.mark.parametrize("slot_ms", [HOUR, 30 * HOUR])
def test_silences_do_not_depend_on_triggers(spark, slot_ms):
    log, idle = _log(), 8 * HOUR
    expected = []
    for key in {k for _, k, _, _ in log}:
        times = sorted(ms for _, k, ms, _ in log if k == key)
        expected += [(key, a + idle) for a, b in zip(times, [*times[1:], 10**15], strict=True) if b - a > idle]
    marked, fire = S.with_sentinel(_pushed(spark, log, 4).select("k", "ts"), "ts")
    rows = S.silence_stream(marked.withWatermark("ts", S.REPLAY_LATENESS), "k", "ts", idle, slot_ms)
    got = S.drain_closed(spark, rows, fire, "shuffled-silences")
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(expected, key=repr)


def test_a_live_stream_releases_rows_as_time_passes(spark):
    """Rows come out of order within the lateness; what a trigger releases stays, across a restart too."""
    landing, path, checkpoint = (scratch(spark, f"live-{part}") for part in ("in", "out", "checkpoint"))
    log = [(0, 0, 5), (2, 20, -3), (1, 10, -4), (4, 200, -3), (3, 70, 2), (5, 600, 1)]
    seen = []
    for seq, minute, amount in log:
        df = spark.createDataFrame([(seq, 1, 3_600_000 + minute * 60, amount)], "seq long, k long, s long, amount long")
        S.push(df.select("seq", "k", F.timestamp_seconds("s").alias("ts"), "amount"), landing)
        stream = S.landed_stream(spark, landing, spark.read.parquet(landing).schema, files=1)
        rows = S.guarded_account_stream(stream.withWatermark("ts", "150 minutes"), "k", "ts", "seq", "amount", HOUR)
        with S.stateful(spark):
            S.drain(rows.writeStream.format("parquet").option("path", path), checkpoint)
        seen.append(sorted((r["seq"], r["balance"]) for r in spark.read.schema(rows.schema).parquet(path).collect()))
    whole = [(0, 5), (1, 1), (2, 1), (3, 3), (4, 0)]
    assert seen[2] == [] and seen[-1] == whole and all(s == whole[: len(s)] for s in seen)


def test_rows_later_than_the_lateness_fail_the_run_whenever_they_come(spark):
    """The late row comes in the first of many triggers."""
    landing, checkpoint = scratch(spark, "late-first"), scratch(spark, "late-first-checkpoint")

    def run():
        stream = S.landed_stream(spark, landing, spark.read.parquet(landing).schema, files=1)
        counts = stream.withWatermark("ts", "1 hour").groupBy(F.window("ts", "1 hour")).count()
        with S.stateful(spark):
            S.drain(counts.writeStream.outputMode("update").foreachBatch(lambda df, _: df.write.format("noop").mode("overwrite").save()), checkpoint)

    def push(second):
        S.push(spark.range(1).select(F.timestamp_seconds(F.lit(second)).alias("ts")).coalesce(1), landing)

    push(10**6)
    run()
    push(0)
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        for i in range(6):
            push(10**6 + i)
        with pytest.raises(RuntimeError, match="1 rows came after"):
            run()
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")


def test_state_partitions_are_a_setting(spark):
    spark.conf.set(S.STATE_PARTITIONS, "3")
    try:
        with S.stateful(spark):
            assert spark.conf.get("spark.sql.shuffle.partitions") == "3"
    finally:
        spark.conf.unset(S.STATE_PARTITIONS)
