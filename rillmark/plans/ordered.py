"""Queries: running folds, limits, priorities, routing, substreams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillmark.functions import values
from rillmark.operators import flows, states, substreams, tables, timespine
from rillmark.operators.scan import OrderedScan, with_position
from rillmark.plans import views as V
from rillmark.plans.views import HOUR_US, MEMBERSHIP, with_views
from rillmark.registry import query
from rillmark.session import load


@query(
    "scan_running",
    with_views(
        "ev ledger",
        """SELECT user_id, seq, CAST(sum(amount) OVER (PARTITION BY user_id ORDER BY seq) AS BIGINT) AS total FROM ledger
        UNION ALL SELECT DISTINCT user_id, CAST(NULL AS BIGINT), 0 FROM ledger""",
    ),
)
def scan_running(spark: SparkSession, sf: str) -> DataFrame:
    """Running fold that emits its seed first: one row with a null sequence number per key."""
    running = OrderedScan(V.ledger(spark, sf), ["seq"], ["user_id"]).upto(total=("sum", F.col("amount"))).df
    return flows.seeded_scan(running.drop("amount"), ["user_id"], "total", 0)


@query("running_total_reply", with_views("ev", "SELECT seq, CAST(sum(k) OVER (ORDER BY seq) AS BIGINT) AS total FROM ev"))
def running_total_reply(spark: SparkSession, sf: str) -> DataFrame:
    """The total replied after each message, over the whole log."""
    return OrderedScan(V.ev(spark, sf).select("seq", "k"), ["seq"]).upto(total=("sum", F.col("k"))).df.select("seq", "total")


@query("running_count", with_views("ev", "SELECT seq, user_id, row_number() OVER (PARTITION BY user_id ORDER BY seq) AS n FROM ev"))
def running_count(spark: SparkSession, sf: str) -> DataFrame:
    events = V.ev(spark, sf).select("seq", "user_id")
    return OrderedScan(events, ["seq"], ["user_id"]).upto(n=("count", F.lit(1))).df


@query("seq_id_assign", "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS order_id FROM orders")
def seq_id_assign(spark: SparkSession, sf: str) -> DataFrame:
    return with_position(load(spark, sf, "orders").select("o_orderkey"), ["o_orderkey"], name="order_id")


@query(
    "last_n",
    with_views(
        "ev",
        """SELECT user_id, seq, event_type, r AS age_rank FROM (SELECT *, row_number() OVER
        (PARTITION BY user_id ORDER BY seq DESC) AS r FROM ev) WHERE r <= 10""",
    ),
)
def last_n(spark: SparkSession, sf: str) -> DataFrame:
    kept = flows.newest(V.ev(spark, sf).select("user_id", "seq", "event_type"), ["seq"], 10, ["user_id"])
    return kept.withColumn("age_rank", F.col("age_rank").cast("bigint"))


@query("latest_state", with_views("kv_log", "SELECT id, max(seq) AS seq, arg_max(v, seq) AS v, arg_max(op, seq) AS op FROM kv_log GROUP BY id"))
def latest_state(spark: SparkSession, sf: str) -> DataFrame:
    return tables.latest(V.kv_log(spark, sf), ["id"], ["seq"])


_DEPTH = """, r AS (SELECT *, sum(step) OVER (PARTITION BY user_id ORDER BY seq) AS s FROM steps),
    m AS (SELECT *, min(s) OVER (PARTITION BY user_id ORDER BY seq) AS low FROM r)
    SELECT seq, user_id, CAST(s - least(0, low) AS BIGINT) AS depth, s - least(0, low) = 0 AS happy FROM m"""


@query("stack_state", with_views("steps", _DEPTH))
def stack_state(spark: SparkSession, sf: str) -> DataFrame:
    depths = states.nesting(V.steps(spark, sf), ["user_id"], ["seq"], F.col("step"))
    return depths.select("seq", "user_id", "depth", (F.col("depth") == 0).alias("happy"))


@query(
    "gap_timeout",
    with_views(
        "ev",
        """, g AS (SELECT *, ts_us - lag(ts_us) OVER (PARTITION BY user_id ORDER BY seq) > 86400000000 AS gap FROM ev)
        SELECT seq, user_id, coalesce(bool_or(gap) OVER (PARTITION BY user_id ORDER BY seq), false) AS closed FROM g""",
    ),
)
def gap_timeout(spark: SparkSession, sf: str) -> DataFrame:
    """A user's channel closes at the first silence longer than a day."""
    events = V.ev(spark, sf).select("seq", "user_id", "ts_us")
    return timespine.until_silence(events, ["user_id"], "ts_us", ["seq"], 24 * HOUR_US).select("seq", "user_id", "closed")


@query(
    "segment_by_delimiter",
    with_views("doc_lines", "SELECT doc_id, CAST(line_no AS BIGINT) AS segment, CAST(length(line) AS BIGINT) AS n_chars FROM doc_lines"),
)
def segment_by_delimiter(spark: SparkSession, sf: str) -> DataFrame:
    cut = substreams.cut_at_newlines(load(spark, sf, "documents"), "text", "doc_id")
    return cut.withColumn("segment", F.col("segment").cast("bigint"))


@query("take_n", "SELECT o_orderkey, o_orderdate IS NOT NULL AS dated FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 100")
def take_n(spark: SparkSession, sf: str) -> DataFrame:
    first = flows.take(load(spark, sf, "orders").select("o_orderkey", "o_orderdate"), ["o_orderdate", "o_orderkey"], 100)
    return first.select("o_orderkey", F.col("o_orderdate").isNotNull().alias("dated"))


@query("drop_n", "SELECT o_orderkey FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 1000000000 OFFSET 100")
def drop_n(spark: SparkSession, sf: str) -> DataFrame:
    rest = flows.drop(load(spark, sf, "orders").select("o_orderkey", "o_orderdate"), ["o_orderdate", "o_orderkey"], 100)
    return rest.select("o_orderkey")


@query(
    "priority_order",
    with_views(
        "tickets",
        """, r AS (SELECT *, CASE WHEN starts_with(msg, '[P0]') THEN 0 WHEN starts_with(msg, '[P1]') THEN 1
        WHEN starts_with(msg, '[P2]') THEN 2 WHEN starts_with(msg, '[P3]') THEN 3 ELSE 4 END AS rank FROM tickets)
        SELECT seq, msg, rank, row_number() OVER (ORDER BY rank, seq) - 1 AS process_pos FROM r""",
    ),
)
def priority_order(spark: SparkSession, sf: str) -> DataFrame:
    tickets = V.tickets(spark, sf).select("seq", "msg")
    return flows.process_order(tickets, values.ticket_class(F.col("msg")), ["seq"], 5)


@query(
    "control_first",
    with_views("tickets", "SELECT seq, event_type, row_number() OVER (ORDER BY event_type <> 'signup', seq) - 1 AS process_pos FROM tickets"),
)
def control_first(spark: SparkSession, sf: str) -> DataFrame:
    rank = F.when(F.col("event_type") == "signup", 0).otherwise(1)
    return flows.process_order(V.tickets(spark, sf).select("seq", "event_type"), rank, ["seq"], 2).drop("rank")


@query("route_round_robin", with_views("doc_lines", "SELECT doc_id, CAST(line_no AS BIGINT) AS line_no, CAST(line_no % 5 AS BIGINT) AS worker FROM doc_lines"))
def route_round_robin(spark: SparkSession, sf: str) -> DataFrame:
    """Each text hands its lines out to five workers in turn, starting over per text."""
    line_no = F.col("line_no").cast("bigint")
    return V.doc_lines(spark, sf).select("doc_id", line_no, flows.round_robin(line_no, 5).alias("worker"))


@query(
    "route_random",
    with_views(
        "ev members doc_lines",
        f"""{MEMBERSHIP}, live AS (SELECT node, row_number() OVER (ORDER BY node) - 1 AS worker_no, count(*) OVER () AS n
        FROM states WHERE live),
        picked AS (SELECT doc_id, line_no, CAST('0x' || substring(md5(doc_id || ':' || line_no), 1, 8) AS BIGINT)
        % (SELECT count(*) FROM live) AS worker_no FROM doc_lines)
        SELECT doc_id, CAST(line_no AS BIGINT) AS line_no, node FROM picked JOIN live ON live.worker_no = picked.worker_no""",
    ),
)
def route_random(spark: SparkSession, sf: str) -> DataFrame:
    """Every line goes to a random live worker; live is what the membership events leave."""
    nodes = states.membership(V.members(spark, sf), "node", ["seq"], F.col("kind"))
    workers = with_position(nodes.where("live").select("node"), ["node"], name="worker_no")
    slot = flows.random_slot(workers.agg(F.count(F.lit(1))).scalar(), F.col("doc_id"), F.col("line_no"))
    lines = V.doc_lines(spark, sf).select("doc_id", F.col("line_no").cast("bigint"), slot.alias("worker_no"))
    return lines.join(workers, "worker_no").select("doc_id", "line_no", "node")


@query(
    "buffer_drop_head",
    with_views(
        "ev",
        """SELECT event_type, day, seq FROM (SELECT event_type, CAST(ts_us // 86400000000 AS BIGINT) AS day, seq,
        row_number() OVER (PARTITION BY event_type, ts_us // 86400000000 ORDER BY seq DESC) AS r FROM ev) WHERE r <= 10""",
    ),
)
def buffer_drop_head(spark: SparkSession, sf: str) -> DataFrame:
    """A buffer of ten per event type that is drained daily keeps the newest ten of each day."""
    day = F.floor(F.col("ts_us") / (24 * HOUR_US)).alias("day")
    events = V.ev(spark, sf).select("event_type", day, "seq")
    return flows.newest(events, ["seq"], 10, ["event_type", "day"]).drop("age_rank")


@query("throttle", with_views("ev", "SELECT seq, CAST((row_number() OVER (ORDER BY seq) - 1) // 2 AS BIGINT) AS release_s FROM ev"))
def throttle(spark: SparkSession, sf: str) -> DataFrame:
    return flows.throttle(V.ev(spark, sf).select("seq"), ["seq"], 2, 1).select("seq", "release_s")


@query("group_capped", "SELECT lower(substring(p_name, 1, 1)) AS key, count(*) AS n FROM part GROUP BY 1")
def group_capped(spark: SparkSession, sf: str) -> DataFrame:
    return substreams.capped_counts(load(spark, sf, "part"), F.lower(F.substring("p_name", 1, 1)), 30)


_RANGES = "SELECT p_partkey AS id, CAST(unnest(generate_series(p_size, 3 * p_size)) AS BIGINT) AS value FROM part"


@query("flat_map_concat", f"SELECT id, row_number() OVER (PARTITION BY id ORDER BY value) - 1 AS place, value FROM ({_RANGES})")
def flat_map_concat(spark: SparkSession, sf: str) -> DataFrame:
    flat = substreams.flat_map_range(load(spark, sf, "part"), F.col("p_size").cast("bigint"), ordered=True)
    return flat.select(F.col("p_partkey").alias("id"), F.col("place").cast("bigint"), "value")


@query("flat_map_merge", _RANGES)
def flat_map_merge(spark: SparkSession, sf: str) -> DataFrame:
    flat = substreams.flat_map_range(load(spark, sf, "part"), F.col("p_size").cast("bigint"), ordered=False)
    return flat.select(F.col("p_partkey").alias("id"), "value")


@query("merge_substreams", "SELECT doc_id, length(text) AS n FROM documents")
def merge_substreams(spark: SparkSession, sf: str) -> DataFrame:
    """Substreams by parity of the length, merged back: the key is dropped, no row moves."""
    n = F.length("text").cast("bigint")
    keyed = load(spark, sf, "documents").select("doc_id", n.alias("n"), (n % 2).alias("parity"))
    return keyed.drop("parity")


_PAGE = 100


@query(
    "nested_explode",
    with_views(
        "songs",
        """, lists AS (SELECT o_orderkey AS playlist_id FROM orders)
        SELECT l.playlist_id, s.artist, s.title, s.genre FROM lists l LEFT JOIN songs s ON s.playlist_id = l.playlist_id""",
    ),
)
def nested_explode(spark: SparkSession, sf: str) -> DataFrame:
    """Nested playlists, in pages of at most a hundred songs, flattened; an empty playlist keeps one row."""
    tie_break = ["artist", "title", "genre"]

    def nested() -> DataFrame:
        hashed = V.songs(spark, sf).withColumn("_h", F.xxhash64(*tie_break))
        placed = with_position(hashed, ["_h", *tie_break], ["playlist_id"], name="_n")
        pages = placed.groupBy("playlist_id", F.floor(F.col("_n") / _PAGE).alias("page")).agg(
            F.array_sort(F.collect_list(F.struct("_n", *tie_break))).alias("songs")
        )
        lists = load(spark, sf, "orders").select(F.col("o_orderkey").alias("playlist_id"))
        return lists.join(pages, "playlist_id", "left")

    playlists = V.stored_once(spark, sf, "lineitem", "playlists", nested)
    flat = playlists.select("playlist_id", F.explode_outer("songs").alias("song"))
    return flat.select("playlist_id", "song.artist", "song.title", "song.genre")
