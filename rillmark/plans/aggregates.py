"""Queries: totals, word counts, keyed and partitioned aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillmark.functions import text
from rillmark.operators import flows, timespine
from rillmark.operators.scan import OrderedScan, union_all
from rillmark.plans import views as V
from rillmark.plans.views import HOUR_US, with_views, words
from rillmark.registry import query
from rillmark.session import load, scratch
from rillmark.sources.journal import tag_events, upcast_guitars


@query("agg_sum", with_views("ev", "SELECT CAST(sum(cents) AS BIGINT) AS value FROM ev"))
def agg_sum(spark: SparkSession, sf: str) -> DataFrame:
    return flows.fold_sum(V.ev(spark, sf), F.col("cents"))


@query("agg_count_tap", with_views("ev", "SELECT user_id, CAST(sum(cents) AS BIGINT) AS cents, (SELECT count(*) FROM ev) AS tapped FROM ev GROUP BY user_id"))
def agg_count_tap(spark: SparkSession, sf: str) -> DataFrame:
    """The tap counts the rows on their way into a written table; the count is known when that run ends."""
    tapped, tap = flows.count_tap(V.ev(spark, sf))
    per_user = tapped.groupBy("user_id").agg(F.sum("cents").alias("cents"))
    path = scratch(spark, "tap")
    per_user.write.parquet(path)
    return spark.read.schema(per_user.schema).parquet(path).withColumn("tapped", F.lit(tap.get["n"]).cast("bigint"))


_TOTAL = f"SELECT CAST(sum({words('line')}) AS BIGINT) AS n_words FROM doc_lines"


@query("agg_word_count_total", with_views("doc_lines", _TOTAL))
def agg_word_count_total(spark: SparkSession, sf: str) -> DataFrame:
    return V.doc_lines(spark, sf).agg(F.sum(text.word_count(F.col("line"))).alias("n_words"))


@query(
    "agg_word_count_dist",
    with_views("doc_lines", f"SELECT d.source, count(*) AS n_lines, CAST(sum({words('line')}) AS BIGINT) AS n_words FROM doc_lines l JOIN documents d ON d.doc_id = l.doc_id GROUP BY d.source"),
)
def agg_word_count_dist(spark: SparkSession, sf: str) -> DataFrame:
    """Lines are counted where they are read; per source only one partial row per task is shuffled."""
    docs = load(spark, sf, "documents").select("source", F.explode(F.split("text", "\n", -1)).alias("line"))
    n = text.word_count(F.col("line"))
    return docs.groupBy("source").agg(F.count(F.lit(1)).alias("n_lines"), F.sum(n).alias("n_words"))


@query(
    "agg_char_count_sentences",
    with_views(
        "doc_lines",
        """, kept AS (SELECT line, regexp_replace(line, '(\\. )+\\z', '') AS k FROM doc_lines)
        SELECT CAST(sum(CASE WHEN k = '' AND line <> '' THEN 0 ELSE
        list_sum(list_transform(string_split(k, '. '), lambda s: greatest(length(s), 1))) END) AS BIGINT) AS n_chars FROM kept""",
    ),
)
def agg_char_count_sentences(spark: SparkSession, sf: str) -> DataFrame:
    return V.doc_lines(spark, sf).agg(F.sum(text.sentence_char_count(F.col("line"))).alias("n_chars"))


@query(
    "agg_word_count_by_task",
    f"SELECT conv_id * 100 + turn AS task_id, (conv_id * 100 + turn) % 5 AS worker, CAST({words('text')} AS BIGINT) AS n_words FROM conversations",
)
def agg_word_count_by_task(spark: SparkSession, sf: str) -> DataFrame:
    task = F.col("conv_id") * 100 + F.col("turn")
    return load(spark, sf, "conversations").select(
        task.alias("task_id"), flows.round_robin(task, 5).alias("worker"), text.word_count(F.col("text")).alias("n_words")
    )


@query("agg_group_count", with_views("votes", "SELECT candidate, count(*) AS n FROM votes WHERE candidate IS NOT NULL GROUP BY candidate"))
def agg_group_count(spark: SparkSession, sf: str) -> DataFrame:
    voted = V.votes(spark, sf).where(F.col("candidate").isNotNull())
    return voted.groupBy("candidate").agg(F.count(F.lit(1)).alias("n"))


@query("agg_substream_fold", "SELECT CASE WHEN p_name = '' THEN 'NUL' ELSE lower(substring(p_name, 1, 1)) END AS letter, count(*) AS n FROM part GROUP BY 1")
def agg_substream_fold(spark: SparkSession, sf: str) -> DataFrame:
    letter = text.first_char(F.col("p_name"))
    shown = F.when(letter == "\0", "NUL").otherwise(letter)
    return load(spark, sf, "part").groupBy(shown.alias("letter")).agg(F.count(F.lit(1)).alias("n"))


@query("agg_merged_substreams", "SELECT CAST(sum(length(text)) AS BIGINT) AS n_chars, count(DISTINCT length(text) % 2) AS n_substreams FROM documents")
def agg_merged_substreams(spark: SparkSession, sf: str) -> DataFrame:
    """Lengths summed in two substreams by parity, then merged."""
    n = F.length("text").cast("bigint")
    parts = load(spark, sf, "documents").groupBy((n % 2).alias("parity")).agg(F.sum(n).alias("n"))
    return parts.agg(F.sum("n").alias("n_chars"), F.count(F.lit(1)).alias("n_substreams"))


@query("agg_distinct_tags", with_views("songs", "SELECT playlist_id, string_agg(genre, ',' ORDER BY genre) AS tags FROM (SELECT DISTINCT playlist_id, genre FROM songs) GROUP BY playlist_id"))
def agg_distinct_tags(spark: SparkSession, sf: str) -> DataFrame:
    tagged = tag_events(V.song_genres(spark, sf), "playlist_id", F.col("genre"))
    return tagged.select("playlist_id", F.array_join("tags", ",").alias("tags"))


@query(
    "agg_inventory",
    with_views(
        "guitar_events",
        """SELECT id, model, make, coalesce(guitar_type, 'acoustic') AS guitar_type, CAST(sum(quantity) AS BIGINT) AS quantity
        FROM guitar_events GROUP BY 1, 2, 3, 4""",
    ),
)
def agg_inventory(spark: SparkSession, sf: str) -> DataFrame:
    events = V.guitar_events(spark, sf)
    v1 = events.where("version = 1").drop("guitar_type")
    current = upcast_guitars(v1, events.where("version = 2"))
    return current.groupBy("id", "model", "make", "guitar_type").agg(F.sum("quantity").alias("quantity"))


@query(
    "agg_signed_counter",
    with_views(
        "ev",
        """, n AS (SELECT *, CAST(sum(CASE event_type WHEN 'signup' THEN 1 WHEN 'error' THEN -1 ELSE 0 END)
        OVER (PARTITION BY user_id ORDER BY seq) AS BIGINT) AS counter FROM ev)
        SELECT seq, user_id, counter FROM n WHERE event_type = 'view'""",
    ),
)
def agg_signed_counter(spark: SparkSession, sf: str) -> DataFrame:
    """signup increments, error decrements, view prints the counter."""
    kind = F.col("event_type")
    step = F.when(kind == "signup", 1).when(kind == "error", -1).otherwise(0)
    counted = OrderedScan(V.ev(spark, sf), ["seq"], ["user_id"]).upto(counter=("sum", step)).df
    return counted.where(kind == "view").select("seq", "user_id", "counter")


@query(
    "agg_partitioned_sum",
    """WITH b AS (SELECT CAST(o_orderkey // 1000 AS BIGINT) AS bucket, bool_or(o_orderkey % 4999 = 17) AS failed,
    CASE WHEN NOT bool_or(o_orderkey % 4999 = 17) THEN CAST(sum(o_orderkey) AS BIGINT) END AS value FROM orders GROUP BY 1)
    SELECT 'bucket' AS scope, * FROM b
    UNION ALL SELECT 'total', NULL, bool_or(failed), CASE WHEN NOT bool_or(failed) THEN CAST(sum(value) AS BIGINT) END FROM b
    UNION ALL SELECT 'total of the rest', NULL, false, CAST(coalesce(sum(value), 0) AS BIGINT) FROM b""",
)
def agg_partitioned_sum(spark: SparkSession, sf: str) -> DataFrame:
    """Range partitions summed separately and then reduced; one bad element fails its partition, and that the total.

    The total of the rest takes failed partitions as nothing.
    """
    key = F.col("o_orderkey")
    bad = F.bool_or(key % 4999 == 17)
    buckets = load(spark, sf, "orders").groupBy(F.floor(key / 1000).alias("bucket"))
    parts = buckets.agg(bad.alias("failed"), F.when(~bad, F.sum(key)).alias("value"))
    failed, total = F.bool_or("failed"), F.sum("value")
    reduced = parts.agg(failed.alias("any"), total.alias("sum")).select(
        F.inline(
            F.array(
                F.struct(F.lit("total").alias("scope"), F.col("any").alias("failed"), F.when(~F.col("any"), F.col("sum")).alias("value")),
                F.struct(F.lit("total of the rest").alias("scope"), F.lit(False).alias("failed"), F.coalesce("sum", F.lit(0)).alias("value")),
            )
        )
    )
    return union_all([parts.withColumn("scope", F.lit("bucket")), reduced]).select("scope", "bucket", "failed", "value")


_CONFLATED = """, w AS (SELECT *, CAST(ts_us // 3600000000 AS BIGINT) AS hour FROM ev)
    SELECT user_id, hour, count(*) AS n_instances, CASE WHEN count(*) = 1 THEN arg_min(event_type, seq)
    ELSE 'You have ' || count(*) || ' events' END AS description FROM w GROUP BY user_id, hour"""


@query("agg_conflate", with_views("ev", _CONFLATED))
def agg_conflate(spark: SparkSession, sf: str) -> DataFrame:
    """Bursts are the events of a user within one hour."""
    hour = F.floor(F.col("ts_us") / HOUR_US).alias("hour")
    return timespine.conflate(V.ev(spark, sf), [F.col("user_id"), hour], ["seq"], F.lit(1), F.col("event_type"))
