import pytest
from pyspark.sql import functions as F

from rillmark.functions import records
from rillmark.operators import flows
from rillmark.plans import all_queries
from rillmark.session import scratch
from rillmark.sources.journal import Journal, SnapshotStore, persist_lists, replay, snapshots
from rillmark.streaming import streams as S


def _commands(spark, first, count):
    rows = [(f"e{i % 3}", i, i * 10) for i in range(first, first + count)]
    return spark.createDataFrame(rows, "persistence_id string, o long, amount long").select(
        "persistence_id",
        F.struct("amount").alias("payload"),
        F.array(F.when(F.col("o") % 2 == 0, "even").otherwise("odd")).alias("tags"),
        F.timestamp_micros(F.col("o")).alias("ts"),
        "o",
    )


@pytest.fixture
def journal(spark):
    store = Journal(spark, scratch(spark, "test-journal"), buckets=4, bucket_rows=2)
    store.append(_commands(spark, 0, 10), ["o"], batch=0)
    store.append(_commands(spark, 10, 5), ["o"], batch=1)
    return store


def _rows(df):
    return sorted((r["ordering"], r["persistence_id"], r["sequence_number"], r["payload"]["amount"]) for r in df.collect())


def test_numbers_go_on_across_batches(journal):
    rows = _rows(journal.events())
    assert [r[0] for r in rows] == list(range(1, 16))
    assert [r[2] for r in rows if r[1] == "e1"] == [1, 2, 3, 4, 5]
    assert [r[3] for r in rows] == [i * 10 for i in range(15)]


def test_writing_a_batch_again_changes_nothing(spark, journal):
    before = _rows(journal.events())
    journal.append(_commands(spark, 10, 5), ["o"], batch=1)
    assert _rows(journal.events()) == before


def test_reads_by_id_and_tag(journal):
    assert [r[2] for r in _rows(journal.by_id("e2", 2, 4))] == [2, 3, 4]
    assert {r["persistence_id"] for r in journal.ids().collect()} == {"e0", "e1", "e2"}
    assert [r[0] for r in _rows(journal.by_tag("even", 9))] == [11, 13, 15]
    assert _rows(journal.by_tag("none")) == _rows(journal.by_tag("even", 100)) == []
    plan = journal.by_id("e2")._jdf.queryExecution().executedPlan().toString()
    assert "pid_bucket" in plan.split("PartitionFilters")[1].split("]")[0]


def test_marks_of_a_tag_on_every_event_are_written_by_several_tasks(spark):
    store = Journal(spark, scratch(spark, "test-marks"), buckets=4)
    spark.conf.set("spark.rillmark.scan.taskRows", "500")
    try:
        events = spark.range(3000).select(
            F.concat(F.lit("e"), F.col("id") % 7).alias("persistence_id"), F.struct("id").alias("payload"),
            F.array(F.lit("all"), F.lit("all"), F.when(F.col("id") % 3 == 0, "third")).alias("tags"),
            F.timestamp_micros("id").alias("ts"), "id",
        )
        store.append(events, ["id"])
    finally:
        spark.conf.unset("spark.rillmark.scan.taskRows")
    marks = spark.read.parquet(store.tags)
    # the tag, the third and the null of the others
    assert {r["tag"]: r["count"] for r in marks.groupBy("tag").count().collect()} == {"all": 3000, "third": 1000, None: 2000}
    assert marks.groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0] <= 1000
    assert [r["payload"]["id"] for r in store.by_tag("third", 2500).orderBy("ordering").collect()] == list(range(2502, 3000, 3))


def test_heads_and_tags_prune_what_is_read(journal):
    assert all("-heads/" in f for df in (journal.ids(), journal.next_ids()) for f in df.inputFiles())
    assert {r["persistence_id"]: r["next_id"] for r in journal.next_ids().collect()} == {"e0": 6, "e1": 6, "e2": 6}
    # the first batch ends with ordering 10
    tagged = journal.by_tag("odd", 10)
    assert all("part=b000000000001" in f for f in tagged.inputFiles())
    plan = tagged._jdf.queryExecution().executedPlan().toString()
    assert any("tag_bucket" in part.split("]")[0] for part in plan.split("PartitionFilters: [")[1:])


def test_merged_parts_replay_the_same(spark, journal):
    for batch in range(2, 9):
        journal.append(_commands(spark, 5 + 5 * batch, 5), ["o"], batch=batch)
    journal.append(_commands(spark, 0, 0), ["o"], batch=9)
    reads = {
        "events": journal.events, "id": lambda: journal.by_id("e1", 3, 9), "tag": lambda: journal.by_tag("even", 12),
    }
    before = {name: _rows(read()) for name, read in reads.items()}
    heads = sorted(map(tuple, journal.last_numbers().collect()))
    publish = journal._publish
    # the run ends before the merge is published: nothing has changed
    journal._publish = lambda *_: (_ for _ in ()).throw(KeyboardInterrupt)
    with pytest.raises(KeyboardInterrupt):
        journal.compact(20)
    journal._publish = publish
    assert len(journal.live()) == 10 and {n: _rows(r()) for n, r in reads.items()} == before
    assert journal.compact(20) == 3 and journal.compact(20) == 3
    assert {n: _rows(r()) for n, r in reads.items()} == before
    assert sorted(map(tuple, journal.last_numbers().collect())) == heads
    journal.append(_commands(spark, 50, 5), ["o"], batch=10)
    journal.append(_commands(spark, 0, 5), ["o"], batch=3)
    assert [r[0] for r in _rows(journal.events())] == list(range(1, 56))
    assert [r[2] for r in _rows(journal.by_id("e1"))] == list(range(1, 19))


def test_live_tail_brings_each_batch_once(spark, journal):
    path, checkpoint, seen = scratch(spark, "tail"), scratch(spark, "tail-checkpoint"), []

    def follow():
        def take(published, _):
            seen.extend(r["ordering"] for r in journal.by_tag("even", parts=journal.published(published)).collect())

        S.drain(journal.stream_parts(1).writeStream.foreachBatch(take), checkpoint)

    follow()
    journal.compact(100)
    journal.append(_commands(spark, 15, 5), ["o"], batch=2)
    follow()
    assert sorted(seen) == list(range(1, 20, 2)) and path


def test_snapshot_and_tail_equal_full_replay(spark, journal):
    amount = F.col("payload.amount")
    columns = ["persistence_id", "total", "n_events", "next_id"]

    def replayed():
        return {tuple(r) for r in replay(journal.events(), amount).select(columns).collect()}

    store = SnapshotStore(journal, amount)
    assert {tuple(r) for r in store.recover().select(columns).collect()} == replayed()
    for step in (lambda: store.take_every(2), store.take, lambda: store.take_every(100), lambda: journal.compact(100), store.take):
        step()
        assert {tuple(r) for r in store.recover().select(columns).collect()} == replayed()
    for batch in range(2, 5):
        journal.append(_commands(spark, 5 + 5 * batch, 5), ["o"], batch=batch)
        assert {tuple(r) for r in store.recover().select(columns).collect()} == replayed()


def test_recovery_reads_only_the_parts_with_a_tail(spark, journal):
    store = SnapshotStore(journal, F.col("payload.amount"))
    store.take()
    journal.append(_commands(spark, 15, 3), ["o"], batch=2)
    tail = store.tail()
    assert sorted(r["ordering"] for r in tail.collect()) == [16, 17, 18]
    assert journal.events().select("part").distinct().count() == 3
    assert all("part=b000000000002" in f for f in tail.inputFiles())
    # after states of some entities the parts come from the heads
    store.take_every(4)
    tail = store.tail()
    assert sorted(r["ordering"] for r in tail.collect()) == [16, 17, 18]
    plan = tail._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.split("PartitionFilters")[1].split("]")[0]
    # nothing came after a complete snapshot
    store.take()
    assert store.tail().collect() == [] and store.recover().count() == 3


def test_a_snapshot_that_was_lost_is_not_read(spark, journal):
    store = SnapshotStore(journal, F.col("payload.amount"))
    store.take()
    # a run that ended before it committed left a folder without files
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(f"{store.path}/000000000001-all-{99:020d}")
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(hadoop)
    assert sorted(r["n_events"] for r in store.recover().collect()) == [5, 5, 5]


def test_twenty_messages_with_a_snapshot_after_ten(spark):
    journal = Journal(spark, scratch(spark, "twenty"))
    rows = spark.range(1, 21).select(
        F.lit("simple").alias("persistence_id"), F.struct(F.lit(1).alias("amount")).alias("payload"),
        F.array().cast("array<string>").alias("tags"), F.current_timestamp().alias("ts"), "id",
    )
    journal.append(rows.where("id <= 10"), ["id"], 0)
    store = SnapshotStore(journal, F.col("payload.amount"))
    assert [r["total"] for r in store.take_every(10).collect()] == [10]
    journal.append(rows.where("id > 10"), ["id"], 1)
    assert [(r["total"], r["next_id"]) for r in store.recover().collect()] == [(20, 21)]


def test_lists_reserve_consecutive_ids(spark):
    journal = Journal(spark, scratch(spark, "lists"), buckets=4)

    def lists(*rows):
        df = spark.createDataFrame(rows, "persistence_id string, o long, items array<string>")
        return df.select("*", F.array(F.lit("t")).alias("tags"), F.timestamp_micros("o").alias("ts"))

    persist_lists(journal, lists(("a", 1, ["p", "q"]), ("a", 2, []), ("b", 3, ["x"]), ("a", 4, ["r", "s", "t"])), ["o"], 0)
    persist_lists(journal, lists(("c", 5, ["z"]), ("a", 6, ["u", "v"]), (None, 7, ["n"]), (None, 8, ["m"])), ["o"], 1)
    # the run that appended it was lost, and does so again
    persist_lists(journal, lists(("a", 6, ["u", "v"])), ["o"], 1)
    rows = journal.events().select("persistence_id", "sequence_number", "payload.*").collect()
    got = sorted(((r["persistence_id"] or "", r["sequence_number"], r["base"], r["place"], r["item"]) for r in rows))
    assert got == [
        ("", 1, 1, 0, "n"), ("", 2, 2, 0, "m"),
        ("a", 1, 1, 0, "p"), ("a", 2, 1, 1, "q"), ("a", 3, 3, 0, "r"), ("a", 4, 3, 1, "s"), ("a", 5, 3, 2, "t"),
        ("a", 6, 6, 0, "u"), ("a", 7, 6, 1, "v"), ("b", 1, 1, 0, "x"), ("c", 1, 1, 0, "z"),
    ]


def test_counter_stream(spark):
    ticks = S.counter(spark, rows_per_batch=5)
    out = S.drain_to_table(ticks, "ticks")
    got = sorted(r["value"] for r in out.collect())
    assert got == list(range(len(got))) and len(got) % 5 == 0 and got


def test_push_and_buffer(spark):
    landing, df = scratch(spark, "landing"), spark.range(1, 1002).withColumnRenamed("id", "seq")
    S.push(df, landing)
    arrived = S.drain_to_table(S.landed_stream(spark, landing, df.schema), "arrived").withColumn("k", F.lit(0))
    kept = flows.newest(arrived, ["seq"], 10, ["k"])
    assert sorted(r["seq"] for r in kept.collect()) == list(range(992, 1002))


def test_text_file_lines(spark, tmp_path):
    from rillmark.functions.text import word_count

    (tmp_path / "small.txt").write_text("dogs rule\ni love dogs\n\n")
    lines = spark.read.text(str(tmp_path / "small.txt"))
    assert lines.agg(F.sum(word_count(F.col("value"))).alias("n")).first()["n"] == 6


def test_scratch_needs_a_shared_folder_off_local(spark, monkeypatch):
    class Conf:
        @staticmethod
        def get(*_):
            return None

    class Context:
        master, applicationId = "spark://host:7077", "app"

        @staticmethod
        def getConf():
            return Conf

    class Session:
        sparkContext, conf = Context, Conf

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch(Session, "x")


@pytest.mark.parametrize("lost", ["_write_part", "_publish"])
def test_a_lost_append_is_written_again(spark, lost):
    store = Journal(spark, scratch(spark, "lost-append"), buckets=4)
    for batch in range(3):
        # the run ends with or without written events, before the batch is published
        whole = getattr(store, lost)
        setattr(store, lost, lambda *_: (_ for _ in ()).throw(KeyboardInterrupt))
        with pytest.raises(KeyboardInterrupt):
            store.append(_commands(spark, 100, 7), ["o"], batch=batch)
        setattr(store, lost, whole)
        store.append(_commands(spark, 3 * batch, 3), ["o"], batch=batch)
    rows = _rows(store.events())
    assert [r[0] for r in rows] == list(range(1, 10))
    assert all([r[2] for r in rows if r[1] == f"e{k}"] == [1, 2, 3] for k in range(3))


def test_batches_come_in_turn_and_may_be_empty(spark):
    store = Journal(spark, scratch(spark, "absent-batch"), buckets=4)
    with pytest.raises(ValueError, match="batch 0"):
        store.append(_commands(spark, 0, 3), ["o"], batch=1)
    with pytest.raises(ValueError, match="nothing"):
        store.events()
    for batch, (first, count) in enumerate([(0, 0), (0, 3), (3, 0), (3, 3)]):
        store.append(_commands(spark, first, count), ["o"], batch=batch)
    assert [r[0] for r in _rows(store.events())] == [1, 2, 3, 4, 5, 6]


def test_streams_keep_rows_without_a_user(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    some = F.when(F.col("event_id") % 10 != 0, F.col("user_id"))
    events.withColumn("user_id", some).repartition(3).write.parquet(f"{tmp_path}/events.parquet")
    runs = {name: query.run(spark, str(tmp_path)) for name, query in all_queries().items() if name in ("st_session", "session_idle", "st_state_timer")}
    batch, live = (sorted(map(str, runs[n].select("user_id", "start_us", "last_us", "n_events").collect())) for n in ("session_idle", "st_session"))
    assert batch == live and any("user_id=None" in row for row in live)
    # a silence ends every session
    assert runs["st_state_timer"].where("user_id IS NULL").count() == sum("user_id=None" in row for row in batch)


def test_late_rows_fail_the_run(spark):
    landing = scratch(spark, "late")
    checkpoint = scratch(spark, "late-checkpoint")
    rows = lambda day: spark.sql(f"SELECT 1 AS k, timestamp'{day} 00:00:00' AS ts")
    for day, fails in (("2024-01-05", False), ("2024-01-06", False), ("2024-01-01", True)):
        S.push(rows(day), landing)
        counts = S.landed_stream(spark, landing, rows(day).schema).withWatermark("ts", "1 hour").groupBy(F.window("ts", "1 hour")).count()
        writer = counts.writeStream.outputMode("update").foreachBatch(S.batch_writer(scratch(spark, "late-out")))
        with S.stateful(spark):
            if fails:
                with pytest.raises(RuntimeError, match="came after the watermark"):
                    S.drain(writer, checkpoint)
            else:
                S.drain(writer, checkpoint)


def test_large_ids_decode(spark):
    raw = spark.createDataFrame([("[2147483647//a@b//Ann]",), ("[2147483648//c@d//Cy]",), ("[x//e@f//Ed]",)], "raw string")
    good, bad = records.decode_users(raw, "raw")
    assert sorted(r["id"] for r in good.collect()) == [2147483647, 2147483648] and bad.count() == 1
