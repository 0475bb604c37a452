"""Queries: projections, filters and scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillmark.functions import records, text, values, web
from rillmark.operators.scan import union_all
from rillmark.plans import views as V
from rillmark.plans.views import with_views, words
from rillmark.registry import query
from rillmark.session import load


@query("map_arith", with_views("ev", "SELECT seq, (cents + 1) * 10 AS value FROM ev"))
def map_arith(spark: SparkSession, sf: str) -> DataFrame:
    plus_one = V.ev(spark, sf).select("seq", (F.col("cents") + 1).alias("value"))
    return plus_one.select("seq", (F.col("value") * 10).alias("value"))


@query(
    "map_struct",
    with_views("tx", "SELECT id, 'bob@gmail.com' AS email, amount AS event_amount, date_us AS event_date_us FROM tx"),
)
def map_struct(spark: SparkSession, sf: str) -> DataFrame:
    event = F.struct(F.col("amount"), F.col("date_us"))
    wrapped = V.tx(spark, sf).select("id", F.struct(F.lit(values.EMAILS["Bob"]).alias("email"), event.alias("event")).alias("n"))
    return wrapped.select(
        "id", "n.email", F.col("n.event.amount").alias("event_amount"), F.col("n.event.date_us").alias("event_date_us")
    )


@query("filter_pred", "SELECT p_partkey, p_name FROM part WHERE length(p_name) > 9 AND p_retailprice > 950")
def filter_pred(spark: SparkSession, sf: str) -> DataFrame:
    parts = load(spark, sf, "part").select("p_partkey", "p_name", "p_retailprice")
    return parts.where((F.length("p_name") > 9) & (F.col("p_retailprice") > 950)).select("p_partkey", "p_name")


@query("filter_custom", with_views("ev", "SELECT seq, cents FROM ev WHERE cents % 2 = 0"))
def filter_custom(spark: SparkSession, sf: str) -> DataFrame:
    """A predicate that fails on a row fails the run (ANSI mode)."""
    return V.ev(spark, sf).where(F.col("cents") % 2 == 0).select("seq", "cents")


@query(
    "filter_lowercase",
    with_views(
        "ev",
        """, w AS (SELECT doc_id, unnest(string_split_regex(text, '\\s+')) AS word FROM documents)
        SELECT doc_id, count(*) AS n_words, count(*) FILTER (word = lower(word)) AS n_lower FROM w GROUP BY doc_id""",
    ),
)
def filter_lowercase(spark: SparkSession, sf: str) -> DataFrame:
    """Words of each document and how many of them equal their lower-case form."""
    words = load(spark, sf, "documents").where("text IS NOT NULL").select("doc_id", F.split("text", r"\s+", -1).alias("words"))
    return words.select(
        "doc_id",
        F.size("words").cast("bigint").alias("n_words"),
        F.size(F.filter("words", text.is_lower)).cast("bigint").alias("n_lower"),
    )


@query("str_length", "SELECT doc_id, length(text) AS n, length(text) % 2 AS parity FROM documents")
def str_length(spark: SparkSession, sf: str) -> DataFrame:
    n = F.length("text").cast("bigint")
    return load(spark, sf, "documents").select("doc_id", n.alias("n"), (n % 2).alias("parity"))


@query(
    "str_upper",
    """WITH w AS (SELECT p_partkey AS id, CASE p_partkey % 5 WHEN 0 THEN 'tech' WHEN 1 THEN 'hi' ELSE p_name END AS word FROM part)
    SELECT id, unnest(CASE WHEN word = 'tech' THEN ['scala', 'akka'] WHEN word = 'hi' AND id % 2 = 0 THEN ['hi']
    WHEN word = 'hi' THEN ['hello'] ELSE [upper(word)] END) AS reply FROM w""",
)
def str_upper(spark: SparkSession, sf: str) -> DataFrame:
    turn = F.col("p_partkey") % 5
    word = F.when(turn == 0, "tech").when(turn == 1, "hi").otherwise(F.col("p_name"))
    asked = load(spark, sf, "part").select(F.col("p_partkey").alias("id"), word.alias("word"))
    return asked.select("id", F.explode(text.replies(F.col("word"), F.col("id"))).alias("reply"))


@query(
    "str_first_char",
    with_views(
        "doc_lines",
        """SELECT CASE WHEN line = '' THEN chr(0) ELSE lower(substring(line, 1, 1)) END AS first, count(*) AS n
        FROM doc_lines GROUP BY 1""",
    ).replace("chr(0)", "'NUL'"),
)
def str_first_char(spark: SparkSession, sf: str) -> DataFrame:
    """Lines per first character; the NUL key of empty lines is spelled out for the comparison."""
    key = text.first_char(F.col("line"))
    shown = F.when(key == "\0", "NUL").otherwise(key)
    return V.doc_lines(spark, sf).groupBy(shown.alias("first")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "str_word_count",
    with_views("doc_lines", f"SELECT doc_id, CAST(line_no AS BIGINT) AS line_no, CAST({words('line')} AS BIGINT) AS n FROM doc_lines"),
)
def str_word_count(spark: SparkSession, sf: str) -> DataFrame:
    n = text.word_count(F.col("line"))
    return V.doc_lines(spark, sf).select("doc_id", F.col("line_no").cast("bigint"), n.alias("n"))


_MESSAGES = """, m AS (SELECT seq, CASE WHEN seq % 2 = 0 THEN 'text' ELSE 'number' END AS kind, event_type AS s, cents AS n FROM ev)"""


def _messages(spark: SparkSession, sf: str) -> DataFrame:
    """Tagged union: even rows carry text, odd rows a number."""
    kind = F.when(F.col("seq") % 2 == 0, "text").otherwise("number")
    return V.ev(spark, sf).select("seq", kind.alias("kind"), F.col("event_type").alias("s"), F.col("cents").alias("n"))


@query("str_repeat_self", with_views("ev", f"{_MESSAGES} SELECT seq, s || s AS reply FROM m WHERE kind = 'text'"))
def str_repeat_self(spark: SparkSession, sf: str) -> DataFrame:
    texts = _messages(spark, sf).where(F.col("kind") == "text")
    return texts.select("seq", text.repeat_self(F.col("s")).alias("reply"))


@query(
    "num_double",
    with_views("ev", f"{_MESSAGES} SELECT seq, kind, CASE WHEN kind = 'number' THEN CAST(n * 2 AS VARCHAR) ELSE s || s END AS reply FROM m"),
)
def num_double(spark: SparkSession, sf: str) -> DataFrame:
    doubled = (F.col("n") * 2).cast("string")
    reply = F.when(F.col("kind") == "number", doubled).otherwise(text.repeat_self(F.col("s")))
    return _messages(spark, sf).select("seq", "kind", reply.alias("reply"))


@query(
    "col_mask_shift",
    """SELECT p_partkey AS id, array_to_string(list_transform(string_split(p_name, ''), lambda c: chr(unicode(c) + 3)), '')
    AS masked, p_name AS unmasked FROM part""",
)
def col_mask_shift(spark: SparkSession, sf: str) -> DataFrame:
    masked = text.shift_ascii(F.col("p_name"), 3)
    parts = load(spark, sf, "part").select(F.col("p_partkey").alias("id"), masked.alias("masked"))
    return parts.withColumn("unmasked", text.unshift_ascii(F.col("masked"), 3))


@query(
    "col_mask_shift_unicode",
    """SELECT doc_id, md5(array_to_string(list_transform(string_split(text, ''), lambda c: chr(unicode(c) + 3)), ''))
    AS masked_md5, md5(text) AS unmasked_md5 FROM documents""",
)
def col_mask_shift_unicode(spark: SparkSession, sf: str) -> DataFrame:
    docs = load(spark, sf, "documents").select("doc_id", text.shift_text("text", F.lit(3)).alias("masked"))
    back = text.shift_text("masked", F.lit(-3))
    return docs.select("doc_id", F.md5("masked").alias("masked_md5"), F.md5(back).alias("unmasked_md5"))


@query(
    "fmt_message",
    "SELECT conv_id, turn, role || ' said ' || text AS post, 'Server says back: ' || text || '!' AS echo FROM conversations",
)
def fmt_message(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "conversations").select(
        "conv_id",
        "turn",
        F.format_string("%s said %s", "role", "text").alias("post"),
        F.concat(F.lit("Server says back: "), F.col("text"), F.lit("!")).alias("echo"),
    )


@query(
    "date_oncall_rotation",
    with_views(
        "oncall",
        """SELECT seq, application, CASE WHEN (epoch_us(ts) // 86400000000) % 2 = 0 THEN 'Bob' ELSE 'Alice' END AS engineer,
        CASE WHEN (epoch_us(ts) // 86400000000) % 2 = 0 THEN 'bob@gmail.com' ELSE 'alice@gmail.com' END AS email FROM oncall""",
    ),
)
def date_oncall_rotation(spark: SparkSession, sf: str) -> DataFrame:
    emails = F.create_map(*[F.lit(x) for pair in values.EMAILS.items() for x in pair])
    paged = V.oncall(spark, sf).select("seq", "application", values.on_call(F.col("ts"), values.ENGINEERS).alias("engineer"))
    return paged.withColumn("email", F.element_at(emails, F.col("engineer")))


@query(
    "cond_validate_payment",
    with_views(
        "tx",
        """SELECT id, card, CASE WHEN card = '1234-1234-1234-1234' THEN 'Forbidden' ELSE 'OK' END AS status,
        starts_with(card, '0') AS denied FROM tx""",
    ),
)
def cond_validate_payment(spark: SparkSession, sf: str) -> DataFrame:
    card = F.col("card")
    return V.tx(spark, sf).select(
        "id", "card", values.payment_status(card).alias("status"), values.card_denied(card).alias("denied")
    )


@query("json_encode", with_views("stock", "SELECT id, CAST(to_json({'make': make, 'model': model, 'quantity': quantity}) AS VARCHAR) AS doc FROM stock"))
def json_encode(spark: SparkSession, sf: str) -> DataFrame:
    doc = records.to_json(F.col("make"), F.col("model"), F.col("quantity"))
    return V.stock(spark, sf).select("id", doc.alias("doc"))


@query(
    "json_defaults",
    with_views("stock", "SELECT id, make, model, CASE WHEN id % 3 = 0 THEN 0 ELSE quantity END AS quantity FROM stock"),
)
def json_defaults(spark: SparkSession, sf: str) -> DataFrame:
    """Every third document leaves the quantity out; the default is 0."""
    quantity = F.when(F.col("id") % 3 != 0, F.col("quantity"))
    docs = V.stock(spark, sf).select(
        "id", records.to_json(F.col("make"), F.col("model"), quantity.alias("quantity")).alias("doc")
    )
    schema = T.StructType(
        [T.StructField("make", T.StringType()), T.StructField("model", T.StringType()), T.StructField("quantity", T.LongType())]
    )
    parsed = records.read_json(docs, "doc", schema)
    return parsed.select("id", "make", "model", F.coalesce("quantity", F.lit(0)).alias("quantity"))


_RAW_USERS = """, raw AS (SELECT CASE WHEN id % 11 = 5 THEN '[x' || id || '//' || email || '//' || name || ']'
    WHEN id % 13 = 4 THEN '[' || id || '//' || email || ']'
    ELSE '[' || id || '//' || email || '//' || name || ']' END AS raw, id, email, name FROM users)"""


@query(
    "decode_records",
    with_views(
        "users",
        f"""{_RAW_USERS} SELECT 'good' AS part, id, email, name, NULL AS raw, NULL AS reason FROM raw
        WHERE id % 11 <> 5 AND id % 13 <> 4
        UNION ALL SELECT 'bad', NULL, NULL, NULL, raw, CASE WHEN id % 11 = 5 THEN 'id is not an integer'
        ELSE 'too few fields' END FROM raw WHERE id % 11 = 5 OR id % 13 = 4""",
    ),
)
def decode_records(spark: SparkSession, sf: str) -> DataFrame:
    """Encode all users, spoil some records, decode into a good and a quarantine table."""
    key, email, name = F.col("id"), F.col("email"), F.col("name")
    raw = (
        F.when(key % 11 == 5, records.encode_record(F.concat(F.lit("x"), key.cast("string")), email, name))
        .when(key % 13 == 4, records.encode_record(key, email))
        .otherwise(records.encode_record(key, email, name))
    )
    good, bad = records.decode_users(V.users(spark, sf).select(raw.alias("raw")), "raw")
    return union_all(
        [good.withColumn("part", F.lit("good")), bad.withColumn("part", F.lit("bad"))]
    ).select("part", "id", "email", "name", "raw", "reason")


# path and query string of a URL in SQL
_URL = """, u AS (SELECT page_id, method, regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) AS path,
    regexp_extract(url, '\\?([^#]*)', 1) AS qs FROM requests),
    ids AS (SELECT page_id, method, path, qs,
    TRY_CAST(nullif(regexp_extract(path, '/([0-9]+)/?$', 1), '') AS BIGINT) AS path_id,
    TRY_CAST(nullif(regexp_extract('&' || qs, '&page=([^&]*)', 1), '') AS BIGINT) AS param_id FROM u)"""


@query(
    "url_path_int",
    with_views("requests", f"{_URL} SELECT page_id, path_id, param_id, coalesce(path_id, param_id) AS item_id FROM ids"),
)
def url_path_int(spark: SparkSession, sf: str) -> DataFrame:
    ids = load(spark, sf, "pages").select(
        "page_id", web.path_int(F.col("url")).alias("path_id"), web.query_int(F.col("url"), "page").alias("param_id")
    )
    return ids.withColumn("item_id", F.coalesce("path_id", "param_id"))


@query(
    "route_classify",
    with_views(
        "requests",
        f"""{_URL}, routed AS (SELECT CASE WHEN method = 'PUT' THEN 'Rejected Method'
        WHEN path_id IS NULL THEN 'NotFound' WHEN method = 'POST' AND param_id IS NULL THEN 'MissingQueryParamRejection'
        WHEN path_id > 900 THEN 'BadRequest' ELSE 'OK' END AS status FROM ids)
        SELECT status, count(*) AS n FROM routed GROUP BY status""",
    ),
)
def route_classify(spark: SparkSession, sf: str) -> DataFrame:
    item, page = web.path_int(F.col("url")), web.query_int(F.col("url"), "page")
    method = F.col("method")
    rules = [
        (method == "PUT", "Rejected Method"),
        (item.isNull(), "NotFound"),
        ((method == "POST") & page.isNull(), "MissingQueryParamRejection"),
        (item > 900, "BadRequest"),
    ]
    routed = V.requests(spark, sf).select(web.first_match(rules, "OK").alias("status"))
    return routed.groupBy("status").agg(F.count(F.lit(1)).alias("n"))
