"""Queries: sources, scans, sinks and stream results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillmark.functions.records import read_json
from rillmark.operators import flows
from rillmark.operators.scan import union_all
from rillmark.operators.substreams import chars
from rillmark.plans import views as V
from rillmark.plans.views import with_views
from rillmark.registry import query
from rillmark.session import changed_at, load, scratch
from rillmark.sources.journal import Journal, SnapshotStore
from rillmark.streaming import streams as S


JOURNAL_BUCKETS = 16
# of the paced counter: ticks of a batch at least, and its batches up to the last event
TICKS = 5000
PACES = 10


_JOURNALS: dict[tuple[str, str, int], Journal] = {}


def written_journal(spark: SparkSession, sf: str) -> Journal:
    """Orders as a journal in two batches, tagged by priority and status; written once per application and state of the table."""
    owner = (spark.sparkContext.applicationId, sf, changed_at(spark, f"{sf.rstrip('/')}/orders.parquet"))
    if owner not in _JOURNALS:
        _JOURNALS[owner] = Journal(spark, scratch(spark, "journal"), buckets=JOURNAL_BUCKETS)
    store = _JOURNALS[owner]
    if len(store.live()) == 2:
        return store
    level = F.split("o_orderpriority", "-")
    events = load(spark, sf, "orders").select(
        F.concat(F.lit("cust-"), F.col("o_custkey").cast("string")).alias("persistence_id"),
        F.struct(F.col("o_orderkey").alias("id"), F.floor("o_totalprice").cast("bigint").alias("amount")).alias("payload"),
        F.array(F.concat(F.lit("p"), F.get(level, F.lit(0))), F.col("o_orderstatus")).alias("tags"),
        F.col("o_orderdate").alias("ts"),
        "o_orderkey",
        (F.col("o_orderstatus") == "O").alias("late"),
    )
    store.append(events.where(~F.col("late")), ["o_orderkey"], batch=0)
    SnapshotStore(store, F.col("payload.amount")).take()
    store.append(events.where("late"), ["o_orderkey"], batch=1)
    return store


# the same journal in SQL: batch 0 holds the orders that are not open, batch 1 the open ones
WRITTEN = """, stored AS (SELECT
    row_number() OVER (ORDER BY o_orderstatus = 'O', o_orderkey) AS ordering,
    'cust-' || CAST(o_custkey AS VARCHAR) AS persistence_id,
    row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderstatus = 'O', o_orderkey) AS sequence_number,
    CAST(floor(o_totalprice) AS BIGINT) AS amount, o_orderkey AS id, o_orderstatus,
    'p' || split_part(o_orderpriority, '-', 1) AS priority FROM orders)"""


def _plain(events: DataFrame) -> DataFrame:
    return events.select("ordering", "persistence_id", "sequence_number", "payload.id", "payload.amount")


_STORED_COLUMNS = "ordering, persistence_id, sequence_number, id, amount"


@query("src_counter_stream", with_views("ev", "SELECT seq AS tick, user_id, cents FROM ev"))
def src_counter_stream(spark: SparkSession, sf: str) -> DataFrame:
    """A counter paces the log: tick i releases the event with sequence number i, a fixed number of ticks in each batch.

    The number of ticks follows from the last event, so the batches are few however long the log is, and a batch takes
    only the events between its ticks.  The counter is endless; it is stopped when every event has been released.
    """
    events = V.ev(spark, sf).select("seq", "user_id", "cents").where("seq >= 0")
    waiting, last = events.agg(F.count(F.lit(1)), F.coalesce(F.max("seq"), F.lit(0))).first()
    ticks = S.counter(spark, rows_per_batch=max(TICKS, -(-(last + 1) // PACES))).withColumnRenamed("value", "tick")
    path = scratch(spark, "counter")

    def release(batch: DataFrame) -> DataFrame:
        first, end = batch.agg(F.min("tick"), F.max("tick")).first()
        due = events.where(F.col("seq").between(first, end))
        return batch.join(due, batch["tick"] == due["seq"]).select("tick", "user_id", "cents")

    def ended(released: int) -> bool:
        nonlocal waiting
        waiting -= released
        return waiting <= 0

    S.run_batches_until(ticks, path, release, ended)
    return spark.read.parquet(path).select("tick", "user_id", "cents")


@query("src_text_lines", with_views("doc_lines", "SELECT doc_id, CAST(line_no AS BIGINT) AS line_no, line FROM doc_lines"))
def src_text_lines(spark: SparkSession, sf: str) -> DataFrame:
    return V.doc_lines(spark, sf).select("doc_id", F.col("line_no").cast("bigint"), "line")


@query(
    "src_char_stream",
    """SELECT p_partkey AS id, CAST(generate_subscripts(cs, 1) - 1 AS BIGINT) AS place, unnest(cs) AS ch
    FROM (SELECT p_partkey, string_split(p_name, '') AS cs FROM part)""",
)
def src_char_stream(spark: SparkSession, sf: str) -> DataFrame:
    names = load(spark, sf, "part").select(F.col("p_partkey").alias("id"), "p_name")
    return chars(names, "p_name", "id").select("id", F.col("place").cast("bigint"), "ch")


@query(
    "src_push",
    with_views(
        "ev",
        """SELECT user_id, seq, cents FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY seq DESC) AS r
        FROM ev) WHERE r <= 10""",
    ),
)
def src_push(spark: SparkSession, sf: str) -> DataFrame:
    """Two producers push files, taken in two triggers; each user's buffer keeps the newest 10."""
    events = V.ev(spark, sf).select("seq", "user_id", "cents")
    landing = scratch(spark, "push")
    for producer in range(2):
        files = S.push(events.where(F.col("seq") % 2 == producer), landing)
    arrived = S.drain_to_table(S.landed_stream(spark, landing, events.schema, files=-(-files // 2)), "pushed")
    return flows.newest(arrived, ["seq"], 10, ["user_id"]).select("user_id", "seq", "cents")


@query(
    "src_journal_by_id",
    with_views("ev", f"{WRITTEN} SELECT {_STORED_COLUMNS} FROM stored WHERE persistence_id = 'cust-7' AND sequence_number BETWEEN 2 AND 9"),
)
def src_journal_by_id(spark: SparkSession, sf: str) -> DataFrame:
    return _plain(written_journal(spark, sf).by_id("cust-7", 2, 9))


@query("src_journal_ids", with_views("journal", "SELECT DISTINCT persistence_id FROM journal"))
def src_journal_ids(spark: SparkSession, sf: str) -> DataFrame:
    return written_journal(spark, sf).ids()


@query(
    "src_journal_by_tag",
    with_views("ev", f"{WRITTEN} SELECT {_STORED_COLUMNS} FROM stored WHERE priority = 'p2' AND ordering > 1000"),
)
def src_journal_by_tag(spark: SparkSession, sf: str) -> DataFrame:
    return _plain(written_journal(spark, sf).by_tag("p2", 1000))


@query("src_journal_jdbc", with_views("ev", f"{WRITTEN} SELECT {_STORED_COLUMNS} FROM stored"))
def src_journal_jdbc(spark: SparkSession, sf: str) -> DataFrame:
    """The store is chosen by its format name; here the same events are appended to an ORC journal and read back."""
    events = written_journal(spark, sf).events()
    copy = Journal(spark, scratch(spark, "journal-orc"), fmt="orc", buckets=JOURNAL_BUCKETS)
    copy.append(events.select("persistence_id", "payload", "tags", "ts", "ordering"), ["ordering"])
    return _plain(copy.events())


@query(
    "src_json",
    with_views(
        "ev",
        """, raw AS (SELECT event_id AS seq, CASE WHEN event_type = 'error' THEN substring(props, 2) ELSE props END AS doc
        FROM events) SELECT seq, CASE WHEN json_valid(doc) THEN CAST(json_extract_string(doc, '$.k') AS BIGINT) END AS k,
        CASE WHEN NOT json_valid(doc) THEN doc END AS bad_json FROM raw""",
    ),
)
def src_json(spark: SparkSession, sf: str) -> DataFrame:
    """Error events carry broken JSON, which lands in its own column."""
    doc = F.when(F.col("event_type") == "error", F.substr("props", F.lit(2))).otherwise(F.col("props"))
    raw = load(spark, sf, "events").select(F.col("event_id").alias("seq"), doc.alias("doc"))
    return read_json(raw, "doc", T.StructType([T.StructField("k", T.LongType())])).select("seq", "k", "bad_json")


@query("sink_write", with_views("ev", "SELECT seq, event_type, cents * 2 AS doubled FROM ev"))
def sink_write(spark: SparkSession, sf: str) -> DataFrame:
    """Every element goes to a partitioned table."""
    out = V.ev(spark, sf).select("seq", "event_type", (F.col("cents") * 2).alias("doubled"))
    path = scratch(spark, "sink-write")
    out.hint("rebalance", "event_type").write.partitionBy("event_type").parquet(path)
    return spark.read.schema(out.schema).parquet(path)


@query("sink_head", with_views("ev", "SELECT user_id, arg_min(cents, seq) AS value FROM ev GROUP BY user_id"))
def sink_head(spark: SparkSession, sf: str) -> DataFrame:
    return flows.head(V.ev(spark, sf), ["seq"], F.col("cents"), ["user_id"])


@query("sink_last", with_views("ev", "SELECT user_id, arg_max(cents, seq) AS value FROM ev GROUP BY user_id"))
def sink_last(spark: SparkSession, sf: str) -> DataFrame:
    return flows.last(V.ev(spark, sf), ["seq"], F.col("cents"), ["user_id"])


@query(
    "sink_fold",
    with_views(
        "ev",
        """SELECT 'all' AS scope, CAST(coalesce(sum(cents), 0) AS BIGINT) AS value FROM ev
        UNION ALL SELECT 'none', CAST(coalesce(sum(cents), 0) AS BIGINT) FROM ev WHERE cents < -1""",
    ),
)
def sink_fold(spark: SparkSession, sf: str) -> DataFrame:
    """Totals of all rows and of an empty selection, which gives the zero."""
    events = V.ev(spark, sf)
    scopes = {"all": events, "none": events.where("cents < -1")}
    return union_all(
        [flows.fold_sum(df, F.col("cents")).select(F.lit(s).alias("scope"), "value") for s, df in scopes.items()]
    )


@query("sink_reduce", with_views("ev", "SELECT max(cents) AS value FROM ev"))
def sink_reduce(spark: SparkSession, sf: str) -> DataFrame:
    return flows.reduce_rows(V.ev(spark, sf), F.max("cents"), strict=True)


@query(
    "sink_batches",
    with_views(
        "ev",
        """, placed AS (SELECT seq, cents, row_number() OVER (ORDER BY seq) - 1 AS pos FROM ev)
        SELECT CAST(pos // 10 AS BIGINT) AS batch_id, string_agg(CAST(cents AS VARCHAR), ',' ORDER BY pos) AS items
        FROM placed GROUP BY 1""",
    ),
)
def sink_batches(spark: SparkSession, sf: str) -> DataFrame:
    batches = flows.batches(V.ev(spark, sf), ["seq"], "cents", 10)
    items = F.array_join(F.transform("items", lambda x: x.cast("string")), ",")
    return batches.select("batch_id", items.alias("items"))


@query("sink_acked", with_views("ev", "SELECT seq, user_id FROM ev"))
def sink_acked(spark: SparkSession, sf: str) -> DataFrame:
    """Each micro-batch is written under its id: writing it again after a failure replaces it."""
    events = S.table_stream(spark, sf, "events").select(F.col("event_id").alias("seq"), "user_id")
    return S.drain_by_batch(events, "acked").drop("batch")


@query("sink_journal_append", with_views("ev", f"{WRITTEN} SELECT {_STORED_COLUMNS} FROM stored"))
def sink_journal_append(spark: SparkSession, sf: str) -> DataFrame:
    """Two appended batches: numbers of the second go on where the first ended."""
    return _plain(written_journal(spark, sf).events())


@query(
    "sink_tee",
    with_views(
        "ev",
        """SELECT 'all' AS sink, seq, cents FROM ev
        UNION ALL SELECT 'large', seq, cents FROM ev WHERE cents > 5000""",
    ),
)
def sink_tee(spark: SparkSession, sf: str) -> DataFrame:
    """One frame into two tables in one pass; the second sink has its own filter."""
    sinks = {"all": F.lit(True), "large": F.col("cents") > 5000}
    tables = flows.tee_write(V.ev(spark, sf).select("seq", "cents"), sinks, scratch(spark, "tee"))
    return union_all([df.select(F.lit(name).alias("sink"), "seq", "cents") for name, df in tables.items()])
