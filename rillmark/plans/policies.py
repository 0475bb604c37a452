"""Queries: error policies, rates and clocks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillmark.operators import errors, timespine
from rillmark.operators.scan import union_all
from rillmark.plans import views as V
from rillmark.plans.views import HOUR_US, with_views
from rillmark.registry import query
from rillmark.session import load, scratch
from rillmark.streaming import streams as S

_INT_MIN = -2147483648
# the bad row of the prefix policies: the first purchase above 80.00
_BAD = "event_type = 'purchase' AND cents > 8000"
_FIRST_BAD = f", b AS (SELECT min(seq) AS first_bad FROM ev WHERE {_BAD})"


@query(
    "err_recover",
    with_views(
        "ev",
        f"""{_FIRST_BAD} SELECT seq, cents AS value FROM ev, b WHERE first_bad IS NULL OR seq < first_bad
        UNION ALL SELECT NULL, {_INT_MIN} FROM b WHERE first_bad IS NOT NULL""",
    ),
)
def err_recover(spark: SparkSession, sf: str) -> DataFrame:
    events = V.ev(spark, sf)
    substitute = spark.range(1).select(F.lit(None).cast("bigint").alias("seq"), F.lit(_INT_MIN).cast("bigint").alias("cents"))
    kept = errors.recover(events, ["seq"], F.expr(_BAD), substitute)
    return kept.select("seq", F.col("cents").alias("value"))


@query(
    "err_recover_with",
    with_views(
        "ev",
        f"""{_FIRST_BAD} SELECT 'events' AS source, seq, cents AS value FROM ev, b WHERE first_bad IS NULL OR seq < first_bad
        UNION ALL SELECT 'orders', o_orderkey, CAST(floor(o_totalprice) AS BIGINT) FROM orders, b WHERE first_bad IS NOT NULL""",
    ),
)
def err_recover_with(spark: SparkSession, sf: str) -> DataFrame:
    """After the failure the stream goes on with another table."""
    events = V.ev(spark, sf).withColumn("source", F.lit("events"))
    other = load(spark, sf, "orders").select(
        F.lit("orders").alias("source"), F.col("o_orderkey").alias("seq"), F.floor("o_totalprice").cast("bigint").alias("cents")
    )
    kept = errors.recover(events, ["seq"], F.expr(_BAD), other)
    return kept.select("source", "seq", F.col("cents").alias("value"))


@query(
    "err_resume",
    with_views(
        "requests",
        """, p AS (SELECT page_id, regexp_extract(url, '([^/?#]*)([?#].*)?$', 1) AS item FROM requests)
        SELECT page_id, 'good' AS part, TRY_CAST(item AS BIGINT) AS item_id, NULL AS raw FROM p WHERE TRY_CAST(item AS BIGINT) IS NOT NULL
        UNION ALL SELECT page_id, 'bad', NULL, item FROM p WHERE TRY_CAST(item AS BIGINT) IS NULL""",
    ),
)
def err_resume(spark: SparkSession, sf: str) -> DataFrame:
    """Page ids in URLs: elements that are no number are skipped into quarantine."""
    item = F.regexp_extract("url", r"([^/?#]*)([?#].*)?$", 1)
    pages = load(spark, sf, "pages").select("page_id", item.alias("raw"), item.try_cast("bigint").alias("item_id"))
    good, bad = errors.resume(pages, F.col("item_id").isNull())
    return union_all(
        [
            good.withColumn("part", F.lit("good")).drop("raw"),
            bad.withColumn("part", F.lit("bad")),
        ]
    ).select("page_id", "part", "item_id", "raw")


@query(
    "err_stop",
    with_views(
        "ev",
        """SELECT 'negative' AS bad, CASE WHEN bool_or(cents < 0) THEN 'failed' ELSE 'completed' END AS outcome FROM ev
        UNION ALL SELECT 'purchase', CASE WHEN bool_or(event_type = 'purchase') THEN 'failed' ELSE 'completed' END FROM ev""",
    ),
)
def err_stop(spark: SparkSession, sf: str) -> DataFrame:
    """Two runs over the whole log, one without and one with a failing check; the outcome of each."""
    events = V.ev(spark, sf)
    checks = {"negative": F.col("cents") < 0, "purchase": F.col("event_type") == "purchase"}
    outcomes = []
    for name, bad in checks.items():
        try:
            errors.stop(events, bad, f"{name} seen").write.format("noop").mode("overwrite").save()
            outcome = "completed"
        except Exception as failure:
            outcome = "failed" if f"{name} seen" in str(failure) else "unexpected failure"
        outcomes.append((name, outcome))
    return spark.createDataFrame(outcomes, "bad string, outcome string")


@query(
    "err_restart_state",
    with_views(
        "ev",
        """, c AS (SELECT *, count(*) FILTER (event_type = 'error') OVER (PARTITION BY user_id ORDER BY seq) AS cut FROM ev)
        SELECT seq, user_id, CAST(sum(cents) OVER (PARTITION BY user_id, cut ORDER BY seq) AS BIGINT) AS total FROM c
        WHERE event_type <> 'error'""",
    ),
)
def err_restart_state(spark: SparkSession, sf: str) -> DataFrame:
    bad = F.col("event_type") == "error"
    totals = errors.restart_sum(V.ev(spark, sf), ["user_id"], ["seq"], bad, F.col("cents"))
    return totals.select("seq", "user_id", "total")


_POLICIES = """, p AS (SELECT *, CASE WHEN text IS NULL THEN 'escalate' WHEN text = '' THEN 'reset' WHEN length(text) > 20 THEN 'skip'
    WHEN NOT regexp_matches(text, '^[A-Z]') THEN 'stop' ELSE 'ok' END AS policy,
    CASE WHEN text = 'Tea at noon' THEN 3 ELSE 0 END AS w FROM supervised),
    live AS (SELECT *, count(*) FILTER (policy = 'stop') OVER (PARTITION BY {scope} ORDER BY seq
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS stops FROM p)"""
_POLICY = _POLICIES + """,
    cut AS (SELECT *, count(*) FILTER (policy = 'reset') OVER (PARTITION BY {scope} ORDER BY seq) AS cut FROM live WHERE stops = 0)
    SELECT seq, user_id, policy, CAST(sum(CASE WHEN policy = 'ok' THEN w ELSE 0 END)
    OVER (PARTITION BY user_id, cut ORDER BY seq) AS BIGINT) AS words FROM cut"""
# children that die with their supervisor see no row after an escalation, surviving ones begin anew with it
_ESCALATED = _POLICIES.format(scope="user_id") + """,
    risen AS (SELECT *, count(*) FILTER (policy = 'escalate') OVER (PARTITION BY grp ORDER BY seq) AS epoch FROM live WHERE stops = 0),
    kinds AS (SELECT 'stopped' AS children, seq, user_id, policy, w, 0 AS epoch FROM risen
    WHERE epoch - CASE WHEN policy = 'escalate' THEN 1 ELSE 0 END = 0
    UNION ALL SELECT 'restarted', seq, user_id, policy, w, epoch FROM risen),
    cut AS (SELECT *, count(*) FILTER (policy = 'reset') OVER (PARTITION BY children, user_id, epoch ORDER BY seq) AS cut FROM kinds)
    SELECT children, seq, user_id, policy, CAST(sum(CASE WHEN policy = 'ok' THEN w ELSE 0 END)
    OVER (PARTITION BY children, user_id, epoch, cut ORDER BY seq) AS BIGINT) AS words FROM cut"""


@query("err_policy_wordcount", with_views("ev supervised", _ESCALATED))
def err_policy_wordcount(spark: SparkSession, sf: str) -> DataFrame:
    """Two kinds of supervisors, one for each ten users: an escalated failure stops their children, or restarts them."""
    parts = []
    for children in ("stopped", "restarted"):
        counted = errors.supervised_word_count(
            V.supervised(spark, sf), ["user_id"], ["seq"], "text", supervisor=["grp"], children_survive=children == "restarted"
        )
        parts.append(counted.select(F.lit(children).alias("children"), "seq", "user_id", "policy", "words"))
    return union_all(parts)


@query("err_all_for_one", with_views("ev supervised", _POLICY.format(scope="grp")))
def err_all_for_one(spark: SparkSession, sf: str) -> DataFrame:
    counted = errors.supervised_word_count(V.supervised(spark, sf), ["user_id"], ["seq"], "text", group=["grp"])
    return counted.select("seq", "user_id", "policy", "words")


@query("err_restart_source", with_views("ev", "SELECT seq, cents FROM ev"))
def err_restart_source(spark: SparkSession, sf: str) -> DataFrame:
    """The stream fails in its second batch, after writing it, and is restarted from its checkpoint."""
    events = V.ev(spark, sf).select("seq", "cents")
    landing, path, checkpoint = (scratch(spark, f"restart-{part}") for part in ("in", "out", "checkpoint"))
    for part in range(3):
        files = S.push(events.where(F.col("seq") % 3 == part), landing)
    stream = S.landed_stream(spark, landing, events.schema, files=-(-files // 3))
    write, failed = S.batch_writer(path), []

    def flaky(batch: DataFrame, batch_id: int) -> None:
        write(batch, batch_id)
        if batch_id == 1 and not failed:
            failed.append(batch_id)
            raise RuntimeError("source failed")

    for _ in range(2):
        try:
            S.drain(stream.writeStream.foreachBatch(flaky), checkpoint)
        except Exception as failure:
            if "source failed" not in str(failure):
                raise
    return spark.read.parquet(path).select("seq", "cents")


@query(
    "err_persist_reject",
    with_views(
        "ev",
        """, b AS (SELECT *, bool_or(k = 13 AND event_type = 'error') OVER (PARTITION BY seq // 500) AS aborted FROM ev)
        SELECT seq, CASE WHEN aborted THEN 'aborted' WHEN cents > 5000 THEN 'rejected' ELSE 'stored' END AS outcome FROM b""",
    ),
)
def err_persist_reject(spark: SparkSession, sf: str) -> DataFrame:
    """A failed write aborts its whole batch; a rejected event only leaves its batch for quarantine."""
    batch = F.floor(F.col("seq") / 500)
    events = V.ev(spark, sf).select("seq", "cents", "k", "event_type", batch.alias("batch_id"))
    failed = events.where("k = 13 AND event_type = 'error'").select("batch_id").distinct()
    marked = events.join(failed.withColumn("aborted", F.lit(True)), "batch_id", "left")
    outcome = F.when(F.col("aborted"), "aborted").when(F.col("cents") > 5000, "rejected").otherwise("stored")
    return marked.select("seq", outcome.alias("outcome"))


_TICKS = """, t AS (SELECT user_id, CAST(ts_us // 3600000000 AS BIGINT) * 3600000000 AS tick_us, arg_max(cents, seq) AS value
    FROM ev GROUP BY 1, 2),
    n AS (SELECT *, coalesce(lead(tick_us) OVER (PARTITION BY user_id ORDER BY tick_us) - 3600000000, tick_us) AS til FROM t),
    s AS (SELECT user_id, tick_us AS own, value, unnest(generate_series(tick_us, til, 3600000000)) AS tick_us FROM n)"""


@query("extrapolate_repeat", with_views("ev", f"{_TICKS} SELECT user_id, tick_us, value FROM s"))
def extrapolate_repeat(spark: SparkSession, sf: str) -> DataFrame:
    return _hourly(spark, sf).select("user_id", "tick_us", "value")


@query(
    "extrapolate_count",
    with_views("ev", f"{_TICKS} SELECT user_id, tick_us, value + CAST(greatest((tick_us - own) // 3600000000 - 1, 0) AS BIGINT) AS value FROM s"),
)
def extrapolate_count(spark: SparkSession, sf: str) -> DataFrame:
    return _hourly(spark, sf).select("user_id", "tick_us", F.col("counted").alias("value"))


@query("expand_repeat", with_views("ev", f"{_TICKS} SELECT user_id, tick_us, value, tick_us > own AS is_filled FROM s"))
def expand_repeat(spark: SparkSession, sf: str) -> DataFrame:
    return _hourly(spark, sf).select("user_id", "tick_us", "value", "is_filled")


def _hourly(spark: SparkSession, sf: str) -> DataFrame:
    return timespine.fill_ticks(V.ev(spark, sf), ["user_id"], "ts_us", ["seq"], "cents", HOUR_US)


@query(
    "heartbeat_spine",
    with_views(
        "ev",
        """, life AS (SELECT user_id, min(ts_us) + 3600000000 AS start_us, max(ts_us) AS end_us FROM ev GROUP BY user_id),
        beats AS (SELECT user_id, unnest(generate_series(start_us, end_us, 7200000000)) AS beat_us FROM life)
        SELECT b.user_id, CAST(beat_us AS BIGINT) AS beat_us FROM beats b WHERE NOT EXISTS (SELECT 1 FROM ev e
        WHERE e.user_id = b.user_id AND e.ts_us >= beat_us AND e.ts_us < beat_us + 7200000000)""",
    ),
)
def heartbeat_spine(spark: SparkSession, sf: str) -> DataFrame:
    """Beats start one hour after a user's first event and come every two hours; those without an event."""
    missing = timespine.missing_beats(V.ev(spark, sf), ["user_id"], "ts_us", HOUR_US, 2 * HOUR_US)
    return missing.select("user_id", "beat_us")


SESSIONS = """, g AS (SELECT *, coalesce(ts_us - lag(ts_us) OVER (PARTITION BY user_id ORDER BY seq) > 28800000000, false) AS gap FROM ev),
    s AS (SELECT *, count(*) FILTER (gap) OVER (PARTITION BY user_id ORDER BY seq) AS no FROM g)
    SELECT user_id, min(ts_us) AS start_us, max(ts_us) AS last_us, count(*) AS n_events FROM s GROUP BY user_id, no"""


@query("session_idle", with_views("ev", SESSIONS))
def session_idle(spark: SparkSession, sf: str) -> DataFrame:
    found = timespine.sessions(V.ev(spark, sf), ["user_id"], "ts_us", ["seq"], 8 * HOUR_US)
    return found.drop("session_no")
