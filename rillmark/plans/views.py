"""Operator inputs derived from the driver tables: as DataFrames here, as SQL text in ``VIEWS``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillmark.operators.scan import with_position
from rillmark.operators.substreams import lines
from rillmark.session import changed_at, load, scratch

HOUR_US = 3_600_000_000

_STORED: dict[tuple, str] = {}


def stored_once(spark: SparkSession, sf: str, table: str, purpose: str, build: Callable[[], DataFrame]) -> DataFrame:
    """A stand-in input that is a table of its own: written once per application and state of the table it comes from."""
    owner = (spark.sparkContext.applicationId, sf, purpose, changed_at(spark, f"{sf.rstrip('/')}/{table}.parquet"))
    if owner not in _STORED:
        path = scratch(spark, purpose)
        build().write.parquet(path)
        _STORED[owner] = path
    return spark.read.parquet(_STORED[owner])


def ev(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "events").select(
        F.col("event_id").alias("seq"),
        "ts",
        F.unix_micros(F.col("ts").cast("timestamp")).alias("ts_us"),
        "user_id",
        "event_type",
        F.round(F.col("value") * 100).cast("bigint").alias("cents"),
        F.regexp_extract("props", "([0-9]+)", 1).cast("bigint").alias("k"),
    )


def _is(kind: str):
    return F.col("event_type") == kind


def ledger(spark: SparkSession, sf: str) -> DataFrame:
    amount = F.when(_is("purchase"), -F.col("cents")).otherwise(F.col("cents"))
    return ev(spark, sf).select("seq", "user_id", amount.alias("amount"))


def votes(spark: SparkSession, sf: str) -> DataFrame:
    person = F.col("user_id") * 10 + F.col("seq") % 10
    return ev(spark, sf).select(
        "seq", "ts_us", person.alias("person_id"), F.col("k").alias("age"), F.col("event_type").alias("candidate")
    )


def coupons(spark: SparkSession, sf: str) -> DataFrame:
    return ev(spark, sf).where(_is("purchase")).select("seq", F.col("k").alias("code"), "user_id")


def members(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.when(_is("signup"), "up").when(_is("error"), "unreachable").otherwise("removed")
    rows = ev(spark, sf).where(F.col("event_type").isin("signup", "error", "purchase"))
    return rows.select("seq", F.col("user_id").alias("node"), kind.alias("kind"))


def gate(spark: SparkSession, sf: str) -> DataFrame:
    cmd = (
        F.when(_is("signup"), "open").when(_is("error"), "close").when(_is("click"), "write").otherwise("read")
    )
    return ev(spark, sf).select("seq", "user_id", cmd.alias("cmd"), F.col("k").alias("payload"))


def steps(spark: SparkSession, sf: str) -> DataFrame:
    step = F.when(_is("error"), 1).when(_is("click"), -1).otherwise(0)
    return ev(spark, sf).select("seq", "user_id", step.alias("step"))


def commands(spark: SparkSession, sf: str) -> DataFrame:
    cmd = (
        F.when(_is("signup"), "init").when(_is("view"), "request").when(_is("error"), "other").otherwise("money")
    )
    return ev(spark, sf).select("seq", "ts_us", F.col("user_id").alias("machine"), cmd.alias("cmd"), "cents")


def supervised(spark: SparkSession, sf: str) -> DataFrame:
    text = (
        F.when(_is("error"), "")
        .when(_is("purchase"), "A note of more than twenty characters")
        .when(_is("signup") & (F.col("k") < 5), "small letters first")
        .when(_is("view") & (F.col("k") == 7), None)
        .otherwise("Tea at noon")
    )
    return ev(spark, sf).select("seq", "user_id", (F.col("user_id") % 10).alias("grp"), text.alias("text"))


def kv_log(spark: SparkSession, sf: str) -> DataFrame:
    op = F.when(_is("error"), "del").otherwise("put")
    return ev(spark, sf).select("seq", F.col("user_id").alias("id"), op.alias("op"), F.col("k").alias("v"))


def auth_log(spark: SparkSession, sf: str) -> DataFrame:
    rows = ev(spark, sf).where(F.col("event_type").isin("signup", "purchase"))
    kind = F.when(_is("signup"), "register").otherwise("authenticate")
    return rows.select("seq", "user_id", kind.alias("kind"), (F.col("k") % 5).alias("pw"))


def tickets(spark: SparkSession, sf: str) -> DataFrame:
    level = F.col("k") % 5
    prefixed = F.concat(F.lit("[P"), level.cast("string"), F.lit("] "), F.col("event_type"))
    message = F.when(level < 4, prefixed).otherwise(F.col("event_type"))
    return ev(spark, sf).select("seq", "event_type", message.alias("msg"))


def tx(spark: SparkSession, sf: str) -> DataFrame:
    card = F.when(F.col("o_orderkey") % 50 == 0, "1234-1234-1234-1234").otherwise(F.col("o_custkey").cast("string"))
    return load(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("account"),
        F.floor("o_totalprice").cast("bigint").alias("amount"),
        F.unix_micros(F.col("o_orderdate").cast("timestamp")).alias("date_us"),
        card.alias("card"),
    )


def journal(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as a journal with one entity per customer."""
    rows = load(spark, sf, "orders").select(
        F.col("o_orderkey").alias("ordering"),
        F.concat(F.lit("cust-"), F.col("o_custkey").cast("string")).alias("persistence_id"),
        F.floor("o_totalprice").cast("bigint").alias("amount"),
        F.unix_micros(F.col("o_orderdate").cast("timestamp")).alias("ts_us"),
    )
    return with_position(rows, ["ts_us", "ordering"], ["persistence_id"], name="sequence_number", start=1)


def songs(spark: SparkSession, sf: str) -> DataFrame:
    items = load(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey")
    parts = load(spark, sf, "part").select("p_partkey", "p_name", "p_type")
    artists = load(spark, sf, "supplier").select("s_suppkey", "s_name")
    return (
        items.join(parts, items.l_partkey == parts.p_partkey)
        .join(artists, items.l_suppkey == artists.s_suppkey)
        .select(
            F.col("l_orderkey").alias("playlist_id"),
            F.col("s_name").alias("artist"),
            F.col("p_name").alias("title"),
            F.col("p_type").alias("genre"),
        )
    )


def song_genres(spark: SparkSession, sf: str) -> DataFrame:
    """Playlists and the genres of their songs; who sings does not matter here."""
    items = load(spark, sf, "lineitem").select("l_orderkey", "l_partkey")
    parts = load(spark, sf, "part").select("p_partkey", "p_type")
    return items.join(parts, items.l_partkey == parts.p_partkey).select(
        F.col("l_orderkey").alias("playlist_id"), F.col("p_type").alias("genre")
    )


def guitar_events(spark: SparkSession, sf: str) -> DataFrame:
    items = load(spark, sf, "lineitem").select("l_partkey", "l_quantity", "l_linestatus")
    parts = load(spark, sf, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    old = F.col("l_linestatus") == "O"
    return items.join(parts, items.l_partkey == parts.p_partkey).select(
        F.col("l_partkey").alias("id"),
        F.col("p_name").alias("model"),
        F.col("p_brand").alias("make"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
        F.when(old, 1).otherwise(2).alias("version"),
        F.when(~old, F.col("p_type")).alias("guitar_type"),
    )


def stock(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "part").select(
        F.col("p_partkey").alias("id"),
        F.col("p_brand").alias("make"),
        F.col("p_name").alias("model"),
        (F.col("p_size") - 10).cast("bigint").alias("quantity"),
    )


def users(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("c_custkey")
    email = F.concat(F.lower("c_mktsegment"), key.cast("string"), F.lit("@example.com"))
    return load(spark, sf, "customer").select(key.alias("id"), email.alias("email"), F.col("c_name").alias("name"))


def oncall(spark: SparkSession, sf: str) -> DataFrame:
    return ev(spark, sf).where(_is("error")).select("seq", "ts", F.col("user_id").alias("application"))


def doc_lines(spark: SparkSession, sf: str) -> DataFrame:
    return lines(load(spark, sf, "documents"), "text", "doc_id")


def requests(spark: SparkSession, sf: str) -> DataFrame:
    """A request log: the method rotates with the page id."""
    method = F.when(F.col("page_id") % 3 == 0, "POST").when(F.col("page_id") % 7 == 1, "PUT").otherwise("GET")
    return load(spark, sf, "pages").select("page_id", "url", method.alias("method"))


VIEWS = {
    "ev": """SELECT event_id AS seq, ts, epoch_us(ts) AS ts_us, user_id, event_type,
        CAST(round(value * 100) AS BIGINT) AS cents,
        CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k FROM events""",
    "ledger": """SELECT seq, user_id, CASE WHEN event_type = 'purchase' THEN -cents ELSE cents END AS amount FROM ev""",
    "votes": """SELECT seq, ts_us, user_id * 10 + seq % 10 AS person_id, k AS age, event_type AS candidate FROM ev""",
    "coupons": """SELECT seq, k AS code, user_id FROM ev WHERE event_type = 'purchase'""",
    "members": """SELECT seq, user_id AS node, CASE event_type WHEN 'signup' THEN 'up'
        WHEN 'error' THEN 'unreachable' ELSE 'removed' END AS kind
        FROM ev WHERE event_type IN ('signup', 'error', 'purchase')""",
    "gate": """SELECT seq, user_id, CASE event_type WHEN 'signup' THEN 'open' WHEN 'error' THEN 'close'
        WHEN 'click' THEN 'write' ELSE 'read' END AS cmd, k AS payload FROM ev""",
    "steps": """SELECT seq, user_id, CASE event_type WHEN 'error' THEN 1 WHEN 'click' THEN -1 ELSE 0 END AS step FROM ev""",
    "commands": """SELECT seq, ts_us, user_id AS machine, CASE event_type WHEN 'signup' THEN 'init'
        WHEN 'view' THEN 'request' WHEN 'error' THEN 'other' ELSE 'money' END AS cmd, cents FROM ev""",
    "supervised": """SELECT seq, user_id, user_id % 10 AS grp, CASE WHEN event_type = 'error' THEN ''
        WHEN event_type = 'purchase' THEN 'A note of more than twenty characters'
        WHEN event_type = 'signup' AND k < 5 THEN 'small letters first'
        WHEN event_type = 'view' AND k = 7 THEN NULL ELSE 'Tea at noon' END AS text FROM ev""",
    "kv_log": """SELECT seq, user_id AS id, CASE WHEN event_type = 'error' THEN 'del' ELSE 'put' END AS op, k AS v FROM ev""",
    "auth_log": """SELECT seq, user_id, CASE event_type WHEN 'signup' THEN 'register' ELSE 'authenticate' END AS kind,
        k % 5 AS pw FROM ev WHERE event_type IN ('signup', 'purchase')""",
    "tickets": """SELECT seq, event_type, CASE WHEN k % 5 < 4 THEN '[P' || CAST(k % 5 AS VARCHAR) || '] ' || event_type
        ELSE event_type END AS msg FROM ev""",
    "tx": """SELECT o_orderkey AS id, o_custkey AS account, CAST(floor(o_totalprice) AS BIGINT) AS amount,
        epoch_us(o_orderdate) AS date_us, CASE WHEN o_orderkey % 50 = 0 THEN '1234-1234-1234-1234'
        ELSE CAST(o_custkey AS VARCHAR) END AS card FROM orders""",
    "journal": """SELECT o_orderkey AS ordering, 'cust-' || CAST(o_custkey AS VARCHAR) AS persistence_id,
        row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS sequence_number,
        CAST(floor(o_totalprice) AS BIGINT) AS amount, epoch_us(o_orderdate) AS ts_us FROM orders""",
    "songs": """SELECT l_orderkey AS playlist_id, s_name AS artist, p_name AS title, p_type AS genre FROM lineitem
        JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey""",
    "guitar_events": """SELECT l_partkey AS id, p_name AS model, p_brand AS make, CAST(l_quantity AS BIGINT) AS quantity,
        CASE WHEN l_linestatus = 'O' THEN 1 ELSE 2 END AS version,
        CASE WHEN l_linestatus = 'O' THEN NULL ELSE p_type END AS guitar_type
        FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "stock": """SELECT p_partkey AS id, p_brand AS make, p_name AS model, CAST(p_size - 10 AS BIGINT) AS quantity FROM part""",
    "users": """SELECT c_custkey AS id, lower(c_mktsegment) || CAST(c_custkey AS VARCHAR) || '@example.com' AS email,
        c_name AS name FROM customer""",
    "oncall": """SELECT seq, ts, user_id AS application FROM ev WHERE event_type = 'error'""",
    "doc_lines": """SELECT doc_id, generate_subscripts(parts, 1) - 1 AS line_no, unnest(parts) AS line
        FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents)""",
    "requests": """SELECT page_id, url, CASE WHEN page_id % 3 = 0 THEN 'POST' WHEN page_id % 7 = 1 THEN 'PUT'
        ELSE 'GET' END AS method FROM pages""",
}

# end state of every node after its membership events
MEMBERSHIP = """, n AS (SELECT *, row_number() OVER (PARTITION BY node ORDER BY seq) AS r FROM members),
    walk AS (SELECT node, CAST(0 AS BIGINT) AS r, false AS w, false AS p FROM (SELECT DISTINCT node FROM members)
    UNION ALL SELECT n.node, n.r,
    CASE WHEN n.kind = 'up' THEN walk.w OR NOT walk.p WHEN n.kind = 'removed' THEN false ELSE walk.w END,
    CASE WHEN n.kind = 'up' THEN false WHEN n.kind = 'unreachable' THEN walk.p OR walk.w ELSE walk.p END
    FROM walk JOIN n ON n.node = walk.node AND n.r = walk.r + 1),
    states AS (SELECT node, arg_max(w, r) AS registered, arg_max(p, r) AS pending,
    arg_max(w, r) AND NOT arg_max(p, r) AS live FROM walk GROUP BY node)"""

# word count of a text t: a split on one space without the empty pieces at the end
WORDS = """(CASE WHEN {t} = '' THEN 1 WHEN rtrim({t}, ' ') = '' THEN 0
    ELSE length(rtrim({t}, ' ')) - length(replace(rtrim({t}, ' '), ' ', '')) + 1 END)"""


def words(column: str) -> str:
    return WORDS.format(t=column)


def with_views(names: str, body: str) -> str:
    """SQL with the named views in front; ``body`` starts with SELECT, or with a comma and more CTEs."""
    wanted = names.split()
    if any(" FROM ev" in VIEWS[n] for n in wanted) and "ev" not in wanted:
        wanted.insert(0, "ev")
    ctes = ",\n".join(f"{name} AS ({VIEWS[name]})" for name in wanted)
    return f"WITH RECURSIVE {ctes}\n{body.strip()}"
