"""Queries: streaming twins and user code on rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillmark.functions.values import BLOCKED_CARD
from rillmark.operators import calls, tables, udtfs
from rillmark.operators.scan import ordered_reduce
from rillmark.plans import views as V
from rillmark.plans.eventlog import ACCOUNT
from rillmark.plans.policies import SESSIONS
from rillmark.plans.sources_sinks import WRITTEN, written_journal
from rillmark.plans.views import HOUR_US, with_views
from rillmark.registry import query
from rillmark.session import load, scratch
from rillmark.streaming import streams as S


def _cents() -> Column:
    return F.round(F.col("value") * 100).cast("bigint")


def _events(spark: SparkSession, sf: str) -> DataFrame:
    """Events as a stream; event time is a timestamp in UTC because watermarks need one."""
    return S.table_stream(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))


@query("st_map_filter", with_views("ev", "SELECT seq, cents * 2 AS value FROM ev WHERE cents % 2 = 0"))
def st_map_filter(spark: SparkSession, sf: str) -> DataFrame:
    mapped = _events(spark, sf).select(F.col("event_id").alias("seq"), _cents().alias("cents"))
    flow = mapped.where(F.col("cents") % 2 == 0).select("seq", (F.col("cents") * 2).alias("value"))
    return S.drain_to_table(flow, "map-filter")


@query("st_running_count", with_views("ev", "SELECT user_id, count(*) AS n FROM ev GROUP BY user_id"))
def st_running_count(spark: SparkSession, sf: str) -> DataFrame:
    """Updated counts per batch; the newest batch of a key holds its current count."""
    counts = _events(spark, sf).groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    with S.stateful(spark):
        updates = S.drain_by_batch(counts, "running-count", "update")
    return tables.latest(updates, ["user_id"], ["batch"]).select("user_id", "n")


@query(
    "st_conflate",
    with_views(
        "ev",
        """SELECT user_id, CAST(ts_us // 3600000000 AS BIGINT) AS hour, count(*) AS n_instances, CASE WHEN count(*) = 1
        THEN arg_min(event_type, seq) ELSE 'You have ' || count(*) || ' events' END AS description FROM ev GROUP BY 1, 2""",
    ),
)
def st_conflate(spark: SparkSession, sf: str) -> DataFrame:
    """Tumbling hours in update mode; the newest batch of an hour holds its current burst."""
    hours = _events(spark, sf).groupBy(F.window("ts", "1 hour"), "user_id")
    n = F.count(F.lit(1))
    bursts = hours.agg(n.alias("n_instances"), F.min_by("event_type", "event_id").alias("only")).select(
        "user_id",
        F.floor(F.unix_micros("window.start") / HOUR_US).alias("hour"),
        "n_instances",
        F.when(F.col("n_instances") == 1, F.col("only"))
        .otherwise(F.concat(F.lit("You have "), F.col("n_instances").cast("string"), F.lit(" events")))
        .alias("description"),
    )
    with S.stateful(spark):
        updates = S.drain_by_batch(bursts, "conflate", "update")
    return tables.latest(updates, ["user_id", "hour"], ["batch"]).drop("batch")


@query("st_session", with_views("ev", SESSIONS))
def st_session(spark: SparkSession, sf: str) -> DataFrame:
    """Idle sessions in append mode; a later far-future row closes the ones still open."""
    events, close_all = S.with_sentinel(_events(spark, sf).select("user_id", "ts"), "ts")
    marked = events.withWatermark("ts", S.REPLAY_LATENESS)
    found = marked.groupBy("user_id", "closing", F.session_window("ts", "8 hours")).agg(
        F.min("ts").alias("first"), F.max("ts").alias("last"), F.count(F.lit(1)).alias("n_events")
    )
    rows = found.select(
        "user_id", F.unix_micros("first").alias("start_us"), F.unix_micros("last").alias("last_us"), "n_events", "closing"
    )
    return S.drain_closed(spark, rows, close_all, "session")


@query("st_stateful_fold", with_views("ev ledger", ACCOUNT))
def st_stateful_fold(spark: SparkSession, sf: str) -> DataFrame:
    """Guarded balances; a later far-future row releases what still waits for the watermark."""
    amount = F.when(F.col("event_type") == "purchase", -_cents()).otherwise(_cents())
    ledger = _events(spark, sf).select(F.col("event_id").alias("seq"), "user_id", amount.alias("amount"), "ts")
    marked, release_all = S.with_sentinel(ledger, "ts")
    rows = S.guarded_account_stream(marked.withWatermark("ts", S.REPLAY_LATENESS), "user_id", "ts", "seq", "amount")
    return S.drain_closed(spark, rows, release_all, "account")


@query(
    "st_state_timer",
    with_views(
        "ev",
        """, n AS (SELECT user_id, ts_us // 1000 AS ms, lead(ts_us // 1000) OVER (PARTITION BY user_id ORDER BY seq) AS nxt FROM ev)
        SELECT user_id, CAST(ms + 28800000 AS BIGINT) AS expired_ms FROM n WHERE nxt IS NULL OR nxt - ms > 28800000""",
    ),
)
def st_state_timer(spark: SparkSession, sf: str) -> DataFrame:
    """Timeouts of silent users from their rows and from state timers; a later far-future row fires those still armed."""
    events, fire_all = S.with_sentinel(_events(spark, sf).select("user_id", "ts"), "ts")
    marked = events.withWatermark("ts", S.REPLAY_LATENESS)
    return S.drain_closed(spark, S.silence_stream(marked, "user_id", "ts", 8 * HOUR_US // 1000), fire_all, "timer")


@query(
    "st_journal_live",
    with_views("ev", f"{WRITTEN} SELECT ordering, persistence_id, amount FROM stored WHERE priority = 'p1'"),
)
def st_journal_live(spark: SparkSession, sf: str) -> DataFrame:
    """Live tail of one tag: each published batch brings its tagged events, found by the tag index."""
    store = written_journal(spark, sf)
    path = scratch(spark, "live")
    keep = S.batch_writer(path)

    def take(published: DataFrame, batch_id: int) -> None:
        tagged = store.by_tag("p1", parts=store.published(published))
        keep(tagged.select("ordering", "persistence_id", "payload.amount"), batch_id)

    S.drain(store.stream_parts().writeStream.foreachBatch(take), scratch(spark, "live-checkpoint"))
    return spark.read.parquet(path).select("ordering", "persistence_id", "amount")


@query(
    "st_change_log",
    with_views("kv_log", "SELECT id, v FROM (SELECT id, arg_max(v, seq) AS v, arg_max(op, seq) AS op FROM kv_log GROUP BY id) WHERE op = 'put'"),
)
def st_change_log(spark: SparkSession, sf: str) -> DataFrame:
    """Each batch is reduced to the last change per key and kept under its id; the table is the compacted rest."""
    k = F.regexp_extract("props", "([0-9]+)", 1).cast("bigint")
    log = _events(spark, sf).select(
        F.col("event_id").alias("seq"), F.col("user_id").alias("id"), (F.col("event_type") == "error").alias("gone"), k.alias("v")
    )
    path = scratch(spark, "changes")
    keep = S.batch_writer(path)

    def reduce_batch(batch: DataFrame, batch_id: int) -> None:
        keep(tables.latest(batch, ["id"], ["seq"]), batch_id)

    S.drain(log.writeStream.foreachBatch(reduce_batch), scratch(spark, "changes-checkpoint"))
    return tables.compact(spark.read.parquet(path), ["id"], ["seq"], F.col("gone")).select("id", "v")


@query("st_dedupe", with_views("ev coupons", "SELECT DISTINCT code FROM coupons"))
def st_dedupe(spark: SparkSession, sf: str) -> DataFrame:
    """A code passes once."""
    code = F.regexp_extract("props", "([0-9]+)", 1).cast("bigint")
    used = _events(spark, sf).where(F.col("event_type") == "purchase").select(code.alias("code"))
    with S.stateful(spark):
        return S.drain_to_table(used.dropDuplicates(["code"]), "dedupe")


@query("st_checkpoint_restart", with_views("ev", "SELECT user_id, count(*) AS n, CAST(sum(cents) AS BIGINT) AS cents FROM ev GROUP BY user_id"))
def st_checkpoint_restart(spark: SparkSession, sf: str) -> DataFrame:
    """Run, stop, push more files, run again from the same checkpoint: the state goes on."""
    events = V.ev(spark, sf).select("seq", "user_id", "cents")
    landing, path, checkpoint = (scratch(spark, f"resume-{part}") for part in ("in", "out", "checkpoint"))
    for part in range(2):
        S.push(events.where(F.col("seq") % 2 == part), landing)
        totals = (
            S.landed_stream(spark, landing, events.schema)
            .groupBy("user_id")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("cents").alias("cents"))
        )
        with S.stateful(spark):
            S.drain(totals.writeStream.outputMode("update").foreachBatch(S.batch_writer(path)), checkpoint)
    return tables.latest(spark.read.parquet(path), ["user_id"], ["batch"]).drop("batch")


def _page(application: int) -> str:
    return f"page-{application % 7}@example.com"


@query("udf_async_call", with_views("oncall", "SELECT seq, application, 'page-' || application % 7 || '@example.com' AS email FROM oncall"))
def udf_async_call(spark: SparkSession, sf: str) -> DataFrame:
    calls_in = V.oncall(spark, sf).select("seq", "application")
    return calls.async_call(calls_in, _page, "application", "email", T.StringType())


def _pay(card: str) -> str:
    if card == BLOCKED_CARD:
        raise ValueError("Forbidden")
    return "OK"


@query(
    "udf_keyed_call",
    with_views(
        "tx",
        """SELECT id, card <> '1234-1234-1234-1234' AS ok, CASE WHEN card <> '1234-1234-1234-1234' THEN 'OK' END AS result,
        CASE WHEN card = '1234-1234-1234-1234' THEN 'Forbidden' END AS error FROM tx""",
    ),
)
def udf_keyed_call(spark: SparkSession, sf: str) -> DataFrame:
    return calls.keyed_call(V.tx(spark, sf), _pay, "id", "card")


@query("udf_stage", "SELECT event_type, count(*) AS n FROM events WHERE event_id % 2 = 0 GROUP BY event_type")
def udf_stage(spark: SparkSession, sf: str) -> DataFrame:
    """A user-written filter stage with state of its own between Spark's reader and an aggregation."""
    events = load(spark, sf, "events").select("event_id", "event_type")
    even = calls.stage(events, lambda: calls.KeepWhole("event_id", 2), events.schema)
    return even.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query(
    "udaf_fold",
    with_views(
        "ev",
        """SELECT user_id, CAST(list_reduce(list(CAST(k AS BIGINT) ORDER BY seq), lambda h, x: (h * 31 + x) % 1000003,
        CAST(0 AS BIGINT)) AS BIGINT) AS checksum FROM ev GROUP BY user_id""",
    ),
)
def udaf_fold(spark: SparkSession, sf: str) -> DataFrame:
    """A user fold whose order matters: h = (31 h + k) mod p over each user's events.

    One step is the map h -> a h + b; maps compose, so a log is folded in blocks.
    """
    prime = 1_000_003

    def step(a, b):
        return F.struct(a.cast("bigint").alias("a"), b.cast("bigint").alias("b"))

    def then(first, second):
        return step(first["a"] * second["a"] % prime, (second["a"] * first["b"] + second["b"]) % prime)

    sums = ordered_reduce(
        V.ev(spark, sf), ["user_id"], ["seq"], step(F.lit(31), F.col("k")), step(F.lit(1), F.lit(0)), then
    )
    return sums.select("user_id", F.col("value.b").alias("checksum"))


@query("udtf_flatmap", "SELECT id, row_number() OVER (PARTITION BY id ORDER BY value) - 1 AS place, value FROM (SELECT p_partkey AS id, CAST(unnest(generate_series(p_size, 3 * p_size)) AS BIGINT) AS value FROM part)")
def udtf_flatmap(spark: SparkSession, sf: str) -> DataFrame:
    parts = load(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.col("p_size").alias("x"))
    return udtfs.RangeToTriple(parts.asTable())
