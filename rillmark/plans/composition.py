"""Queries: joins of streams, fan-in, fan-out, lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillmark.operators import flows, tables
from rillmark.operators.scan import OrderedScan, union_all, with_position
from rillmark.plans import views as V
from rillmark.plans.views import with_views
from rillmark.registry import query
from rillmark.session import load, scratch

_PLACED = """, o AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS pos FROM orders),
    e AS (SELECT seq, cents, row_number() OVER (ORDER BY seq) - 1 AS pos FROM ev)"""


def _orders(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "orders").select("o_orderkey")


@query("zip_positional", with_views("ev", f"{_PLACED} SELECT o.pos, o_orderkey, seq FROM o JOIN e ON o.pos = e.pos"))
def zip_positional(spark: SparkSession, sf: str) -> DataFrame:
    events = V.ev(spark, sf).select("seq")
    return flows.zip_rows(_orders(spark, sf), ["o_orderkey"], events, ["seq"])


@query(
    "zip_with_max3",
    with_views(
        "ev",
        f"""{_PLACED}, c AS (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey DESC) - 1 AS pos FROM customer)
        SELECT o.pos, greatest(o_orderkey, cents, c_custkey) AS value FROM o JOIN e ON o.pos = e.pos JOIN c ON c.pos = o.pos""",
    ),
)
def zip_with_max3(spark: SparkSession, sf: str) -> DataFrame:
    """Elementwise maximum of three streams, the third one running backwards."""
    events = V.ev(spark, sf).select("seq", "cents")
    customers = load(spark, sf, "customer").select("c_custkey", (-F.col("c_custkey")).alias("back"))
    pair = flows.zip_rows(_orders(spark, sf), ["o_orderkey"], events, ["seq"])
    three = pair.join(with_position(customers, ["back"]), "pos")
    return three.select("pos", F.greatest("o_orderkey", "cents", "c_custkey").alias("value"))


@query("fanout_zip_same", with_views("ev", "SELECT seq, cents + 1 AS incremented, cents * 10 AS multiplied FROM ev"))
def fanout_zip_same(spark: SparkSession, sf: str) -> DataFrame:
    """Both branches come from the same row, so the zip is a projection."""
    x = F.col("cents")
    return V.ev(spark, sf).select("seq", (x + 1).alias("incremented"), (x * 10).alias("multiplied"))


@query(
    "concat_sources",
    with_views(
        "ev",
        f"""{_PLACED} SELECT 0 AS src_ord, pos, (o_orderkey + 1) * 2 AS value FROM o UNION ALL
        SELECT 1, pos + (SELECT count(*) FROM orders), (seq + 1) * 2 FROM e""",
    ),
)
def concat_sources(spark: SparkSession, sf: str) -> DataFrame:
    first = _orders(spark, sf).withColumnRenamed("o_orderkey", "x")
    second = V.ev(spark, sf).select(F.col("seq").alias("x"))
    joined = flows.concat([(first, ["x"]), (second, ["x"])])
    return joined.select("src_ord", "pos", ((F.col("x") + 1) * 2).alias("value"))


@query("merge_sources", with_views("ev", "SELECT o_orderkey AS value FROM orders UNION ALL SELECT seq FROM ev"))
def merge_sources(spark: SparkSession, sf: str) -> DataFrame:
    return flows.merge(
        [_orders(spark, sf).select(F.col("o_orderkey").alias("value")), V.ev(spark, sf).select(F.col("seq").alias("value"))]
    )


@query(
    "merge_preferred",
    with_views(
        "ev",
        f"""{_PLACED}, both_ AS (SELECT pos AS slot, true AS preferred, seq AS value FROM e
        UNION ALL SELECT pos, false, o_orderkey FROM o)
        SELECT row_number() OVER (ORDER BY slot, NOT preferred) - 1 AS emit_pos, slot, preferred, value FROM both_""",
    ),
)
def merge_preferred(spark: SparkSession, sf: str) -> DataFrame:
    events = V.ev(spark, sf).select(F.col("seq").alias("value"))
    orders = _orders(spark, sf).select(F.col("o_orderkey").alias("value"))
    return flows.merge_preferred((events, ["value"]), (orders, ["value"])).select("emit_pos", "slot", "preferred", "value")


@query("merge_hub", with_views("ev", "SELECT event_type AS producer, count(*) AS n, CAST(sum(cents) AS BIGINT) AS cents FROM ev GROUP BY 1"))
def merge_hub(spark: SparkSession, sf: str) -> DataFrame:
    """Each producer owns a folder; the hub discovers whatever producers exist when it is read."""
    out = V.ev(spark, sf).select("seq", "cents", F.col("event_type").alias("producer"))
    path = scratch(spark, "hub")
    out.hint("rebalance", "producer").write.partitionBy("producer").parquet(path)
    hub = spark.read.parquet(path)
    return hub.groupBy("producer").agg(F.count(F.lit(1)).alias("n"), F.sum("cents").alias("cents"))


def _durable(df: DataFrame, purpose: str) -> DataFrame:
    path = scratch(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@query(
    "broadcast_hub",
    with_views(
        "ev",
        """SELECT 'count' AS consumer, count(*) AS value FROM ev UNION ALL SELECT 'sum', CAST(sum(cents) AS BIGINT) FROM ev
        UNION ALL SELECT 'users', count(DISTINCT user_id) FROM ev""",
    ),
)
def broadcast_hub(spark: SparkSession, sf: str) -> DataFrame:
    """Several independent consumers of one durable table."""
    hub = _durable(V.ev(spark, sf).select("user_id", "cents"), "broadcast-hub")
    consumers = {"count": F.count(F.lit(1)), "sum": F.sum("cents"), "users": F.count_distinct("user_id")}
    return union_all([hub.agg(v.alias("value")).select(F.lit(c).alias("consumer"), "value") for c, v in consumers.items()])


@query(
    "pubsub",
    """WITH m AS (SELECT p_name AS msg FROM part UNION ALL SELECT c_name FROM customer)
    SELECT 'value' AS subscriber, msg, NULL AS n FROM m UNION ALL SELECT 'length', NULL, length(msg) FROM m""",
)
def pubsub(spark: SparkSession, sf: str) -> DataFrame:
    """Two publishers, one durable table, two subscribers."""
    published = flows.merge(
        [load(spark, sf, "part").select(F.col("p_name").alias("msg")), load(spark, sf, "customer").select(F.col("c_name").alias("msg"))]
    )
    hub = _durable(published, "pubsub")
    value = hub.select(F.lit("value").alias("subscriber"), "msg", F.lit(None).cast("bigint").alias("n"))
    length = hub.select(
        F.lit("length").alias("subscriber"), F.lit(None).cast("string").alias("msg"), F.length("msg").cast("bigint").alias("n")
    )
    return value.unionByName(length)


@query(
    "balance_round_robin",
    with_views("ev", f"{_PLACED} SELECT seq, pos % 3 AS lane, CAST(pos // 3 + 1 AS BIGINT) AS lane_n FROM e"),
)
def balance_round_robin(spark: SparkSession, sf: str) -> DataFrame:
    return flows.balance(V.ev(spark, sf).select("seq"), ["seq"], 3).select("seq", "lane", "lane_n")


@query(
    "lane_counts",
    with_views("ev", f"{_PLACED} SELECT pos % 3 AS lane, count(*) AS n, CAST(sum(cents) AS BIGINT) AS cents FROM e GROUP BY 1"),
)
def lane_counts(spark: SparkSession, sf: str) -> DataFrame:
    lanes = flows.balance(V.ev(spark, sf).select("seq", "cents"), ["seq"], 3)
    return lanes.groupBy("lane").agg(F.count(F.lit(1)).alias("n"), F.sum("cents").alias("cents"))


@query(
    "fanout_suspicious",
    with_views(
        "tx",
        """SELECT 'all' AS port, id, account, amount FROM tx UNION ALL
        SELECT 'suspicious', id, NULL, NULL FROM tx WHERE amount > 400000""",
    ),
)
def fanout_suspicious(spark: SparkSession, sf: str) -> DataFrame:
    everything, suspicious = flows.tee(
        V.tx(spark, sf).select("id", "account", "amount"),
        lambda df: df,
        lambda df: df.where(F.col("amount") > 400_000).select("id"),
    )
    return union_all(
        [everything.withColumn("port", F.lit("all")), suspicious.withColumn("port", F.lit("suspicious"))]
    ).select("port", "id", "account", "amount")


@query(
    "lookup_join",
    with_views("oncall", "SELECT seq, application, c_name AS owner, n_name AS region FROM oncall JOIN customer ON c_custkey = application JOIN nation ON c_nationkey = n_nationkey"),
)
def lookup_join(spark: SparkSession, sf: str) -> DataFrame:
    """Keys must exist: inner joins whose small side Spark broadcasts when its size allows."""
    owners = load(spark, sf, "customer").select(
        F.col("c_custkey").alias("application"), F.col("c_name").alias("owner"), F.col("c_nationkey").alias("n_nationkey")
    )
    nations = load(spark, sf, "nation").select("n_nationkey", F.col("n_name").alias("region"))
    calls = V.oncall(spark, sf).join(owners, "application").join(nations, "n_nationkey")
    return calls.select("seq", "application", "owner", "region")


@query(
    "lookup_optional",
    with_views(
        "kv_log",
        """, kv AS (SELECT id, arg_max(v, seq) AS v, arg_max(op, seq) AS op FROM kv_log GROUP BY id),
        f AS (SELECT id, arg_min(v, seq) AS first_v FROM kv_log GROUP BY id)
        SELECT c_custkey AS id, kv.v AS v, f.first_v FROM customer LEFT JOIN kv ON c_custkey = kv.id AND kv.op = 'put'
        LEFT JOIN f ON c_custkey = f.id""",
    ),
)
def lookup_optional(spark: SparkSession, sf: str) -> DataFrame:
    """Current value per key, and the first inserted one where ids repeat; null when unknown."""
    log = V.kv_log(spark, sf)
    current = tables.compact(log, ["id"], ["seq"], F.col("op") == "del").select("id", "v")
    found = tables.first(log.select("id", "seq", F.col("v").alias("first_v")), ["id"], ["seq"]).select("id", "first_v")
    asked = load(spark, sf, "customer").select(F.col("c_custkey").alias("id"))
    return tables.lookup(tables.lookup(asked, current, ["id"]), found, ["id"])


@query(
    "auth_join",
    with_views(
        "auth_log",
        """, known AS (SELECT *, last_value(CASE WHEN kind = 'register' THEN pw END IGNORE NULLS) OVER
        (PARTITION BY user_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS db_pw FROM auth_log)
        SELECT seq, user_id, CASE WHEN db_pw IS NULL THEN 'user not found' WHEN db_pw = pw THEN 'success'
        ELSE 'wrong pw' END AS outcome FROM known WHERE kind = 'authenticate'""",
    ),
)
def auth_join(spark: SparkSession, sf: str) -> DataFrame:
    log = V.auth_log(spark, sf)
    return tables.authenticate(log, "user_id", ["seq"], F.col("kind"), "pw").select("seq", "user_id", "outcome")


@query(
    "route_broadcast",
    with_views("ev", "SELECT seq, event_type AS msg, r AS routee FROM (SELECT *, unnest(['r1', 'r2', 'r3', 'r4', 'r5']) AS r FROM ev)"),
)
def route_broadcast(spark: SparkSession, sf: str) -> DataFrame:
    messages = V.ev(spark, sf).select("seq", F.col("event_type").alias("msg"))
    return flows.route_to_all(messages, [f"r{i}" for i in range(1, 6)])


@query(
    "chat_recipients",
    with_views(
        "ev",
        """, room AS (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY seq) AS before_ FROM ev
        WHERE event_type IN ('signup', 'error')),
        moves AS (SELECT seq, CASE WHEN event_type = 'signup' THEN 1 ELSE -1 END AS d FROM room
        WHERE event_type IS DISTINCT FROM coalesce(before_, 'error')),
        log AS (SELECT seq, d, CAST(NULL AS BIGINT) AS msg FROM moves UNION ALL SELECT seq, 0, seq FROM ev WHERE event_type = 'view')
        SELECT seq, n AS recipients FROM (SELECT seq, msg, CAST(sum(d) OVER (ORDER BY seq) AS BIGINT) AS n FROM log)
        WHERE msg IS NOT NULL""",
    ),
)
def chat_recipients(spark: SparkSession, sf: str) -> DataFrame:
    """Members in the room when a message is sent: signup enters, error leaves, view sends."""
    events = V.ev(spark, sf)
    kind = F.col("event_type")
    moves = OrderedScan(events.where(kind.isin("signup", "error")), ["seq"], ["user_id"])
    moves = moves.before(_prev=("last", kind)).df.where(kind != F.coalesce("_prev", F.lit("error")))
    delta = F.when(kind == "signup", 1).otherwise(-1)
    log = moves.select("seq", delta.alias("d"), F.lit(False).alias("msg")).unionByName(
        events.where(kind == "view").select("seq", F.lit(0).alias("d"), F.lit(True).alias("msg"))
    )
    counted = OrderedScan(log, ["seq"]).upto(recipients=("sum", F.col("d"))).df
    return counted.where("msg").select("seq", "recipients")


@query(
    "feedback_iterate",
    """WITH RECURSIVE f AS (SELECT p_partkey AS id, 0 AS round, CAST(p_size AS HUGEINT) AS last, CAST(1 AS HUGEINT) AS prev FROM part
    UNION ALL SELECT id, round + 1, last + prev, last FROM f WHERE round < 20)
    SELECT id, CAST(round AS BIGINT) AS round, CAST(last AS VARCHAR) AS value FROM f WHERE round > 0""",
)
def feedback_iterate(spark: SparkSession, sf: str) -> DataFrame:
    """The pair step (last + prev, last) fed back 20 times for every seed, inside the row: no shuffle."""
    big = T.DecimalType(38, 0)
    seeds = load(spark, sf, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_size").cast(big).alias("last"), F.lit(1).cast(big).alias("prev")
    )

    def feed(state, _round):
        last = (state["last"] + state["prev"]).cast(big)
        return F.struct(
            last.alias("last"), state["last"].alias("prev"), F.concat(state["out"], F.array(last)).alias("out")
        )

    zero = F.struct("last", "prev", F.array().cast(T.ArrayType(big)).alias("out"))
    rounds = F.aggregate(F.sequence(F.lit(1), F.lit(20)), zero, feed, lambda s: s["out"])
    emitted = seeds.select("id", F.posexplode(rounds).alias("round", "value"))
    return emitted.select("id", (F.col("round") + 1).cast("bigint").alias("round"), F.col("value").cast("string"))
