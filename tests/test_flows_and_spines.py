"""Sinks, paced sources, spines and user stages on small inputs."""

import pytest
from pyspark.sql import functions as F

from rillmark.operators import calls, flows, timespine, udtfs
from rillmark.plans import sources_sinks
from rillmark.session import scratch
from rillmark.streaming import streams as S


def test_tee_reads_its_input_once(spark):
    source = scratch(spark, "tee-source")
    spark.range(100).withColumn("v", F.col("id") % 7).write.parquet(source)
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    df = spark.read.parquet(source)
    sinks = {"all": F.lit(True), "large": F.col("v") > 4, "none": F.col("v") > 9, "unknown": F.lit(None).cast("boolean")}
    tables = flows.tee_write(df.mapInArrow(count, df.schema), sinks, scratch(spark, "tee-sinks"))
    assert seen.value == 100
    assert {name: t.count() for name, t in tables.items()} == {"all": 100, "large": 28, "none": 0, "unknown": 0}
    assert tables["large"].columns == ["id", "v"] and tables["large"].agg(F.min("v")).first()[0] == 5


def test_the_counter_comes_in_many_batches(spark):
    path = scratch(spark, "paced")
    ticks = S.counter(spark, rows_per_batch=10).where("value < 47")
    assert S.run_until(ticks, path, lambda released: released < 10) == 5
    assert sorted(r["value"] for r in spark.read.parquet(path).collect()) == list(range(47))


def test_a_longer_log_is_not_paced_in_more_batches(spark, monkeypatch):
    """The batches have an upper number, and a gap in the log does not end it."""
    folder, paced = scratch(spark, "log"), []
    seq = F.when(F.col("id") < 30, F.col("id")).otherwise(F.col("id") + 200)
    log = spark.range(100).select(
        seq.alias("event_id"), F.lit("2024-01-01").cast("timestamp_ntz").alias("ts"), (seq % 7).alias("user_id"),
        F.lit("view").alias("event_type"), F.lit(0.5).alias("value"), F.lit("{}").alias("props"),
    )
    log.union(log.where("event_id = 3")).write.parquet(f"{folder}/events.parquet")
    run = S.run_batches_until
    monkeypatch.setattr(S, "run_batches_until", lambda *args: paced.append(run(*args)))
    monkeypatch.setattr(sources_sinks, "TICKS", 10)
    monkeypatch.setattr(sources_sinks, "PACES", 4)
    got = sorted(r["tick"] for r in sources_sinks.src_counter_stream(spark, folder).collect())
    assert got == sorted([*range(30), 3, *range(230, 300)])
    assert paced == [4]


@pytest.mark.parametrize("n", [0, 1, 5, 6, 7, 36, 37, 100])
def test_numbered_rows_in_two_levels(spark, monkeypatch, n):
    monkeypatch.setattr(timespine, "SPINE", 6)
    df = spark.createDataFrame([("a", n), ("b", 2)], "k string, n int")
    got = sorted((r["k"], r["i"]) for r in timespine.numbered(df, F.col("n"), "i").collect())
    assert got == [("a", i) for i in range(n)] + [("b", 0), ("b", 1)]


def test_five_years_of_ticks(spark):
    """No array spans the life of a key; the ticks are counted, not held."""
    step, n = 10_000_000, 5 * 365 * 24 * 360
    df = spark.createDataFrame([(1, 0, 7), (1, n * step, 9)], "k long, ts long, v long")
    ticks = timespine.fill_ticks(df, ["k"], "ts", ["ts"], "v", step)
    row = ticks.agg(F.count("*").alias("n"), F.sum(F.col("is_filled").cast("int")).alias("filled"), F.max("counted").alias("most")).first()
    assert (row["n"], row["filled"], row["most"]) == (n + 1, n - 1, 7 + n - 2)
    minute = timespine.missing_beats(df, ["k"], "ts", 0, 60_000_000)
    assert minute.count() == n // 6 - 1


@pytest.mark.parametrize("n", [3, 1500])
def test_newest_by_rank_or_by_position(spark, n):
    df = spark.range(4000).select((F.col("id") % 2).alias("k"), F.col("id").alias("seq"))
    got = flows.newest(df.where("k = 0 OR seq < 1001"), ["seq"], n, ["k"])
    rows = sorted((r["k"], r["age_rank"], r["seq"]) for r in got.collect())
    evens, odds = list(range(3998, -1, -2))[:n], list(range(999, -1, -2))[:n]
    assert rows == [(0, i + 1, s) for i, s in enumerate(evens)] + [(1, i + 1, s) for i, s in enumerate(odds)]


def test_a_user_stage_holds_state_between_batches(spark):
    df = spark.range(5000)
    assert calls.stage(df, lambda: calls.KeepWhole("id", 3), df.schema).count() == 1667


def test_the_table_function_takes_whole_batches(spark):
    rows = spark.createDataFrame([(1, 2), (2, 0), (3, None), (4, -1), (None, 1)], "id long, x int")
    got = sorted(map(tuple, udtfs.RangeToTriple(rows.asTable()).collect()), key=repr)
    assert got == sorted([(1, i, 2 + i) for i in range(5)] + [(2, 0, 0)] + [(None, i, 1 + i) for i in range(3)], key=repr)
