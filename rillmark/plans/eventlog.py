"""Queries: event-sourced state, state machines, keyed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillmark.functions import values
from rillmark.operators import flows, states, tables, timespine
from rillmark.operators.scan import OrderedScan, union_all
from rillmark.plans import views as V
from rillmark.plans.sources_sinks import WRITTEN, written_journal
from rillmark.plans.views import HOUR_US, MEMBERSHIP, with_views
from rillmark.registry import query
from rillmark.session import load, scratch
from rillmark.sources import journal as J


@query(
    "journal_write",
    with_views("ev", f"{WRITTEN} SELECT persistence_id, count(*) AS n, max(sequence_number) AS last, CAST(sum(ordering) AS BIGINT) AS orderings FROM stored GROUP BY 1"),
)
def journal_write(spark: SparkSession, sf: str) -> DataFrame:
    """Commands became events with consecutive numbers; the journal per entity."""
    events = written_journal(spark, sf).events()
    return events.groupBy("persistence_id").agg(
        F.count(F.lit(1)).alias("n"), F.max("sequence_number").alias("last"), F.sum("ordering").alias("orderings")
    )


@query("journal_replay", with_views("ev", f"{WRITTEN} SELECT persistence_id, CAST(sum(amount) AS BIGINT) AS total, count(*) AS n_events FROM stored GROUP BY 1"))
def journal_replay(spark: SparkSession, sf: str) -> DataFrame:
    return J.replay(written_journal(spark, sf).events(), F.col("payload.amount")).drop("next_id")


@query("journal_resume_id", with_views("ev", f"{WRITTEN} SELECT persistence_id, max(sequence_number) + 1 AS next_id FROM stored GROUP BY 1"))
def journal_resume_id(spark: SparkSession, sf: str) -> DataFrame:
    """From the heads alone, without the events."""
    return written_journal(spark, sf).next_ids()


_RUNNING = f"""{WRITTEN}, r AS (SELECT *, CAST(sum(amount) OVER (PARTITION BY persistence_id ORDER BY sequence_number) AS BIGINT) AS total FROM stored)"""


@query(
    "snapshot_write",
    with_views("ev", f"{_RUNNING} SELECT persistence_id, sequence_number, ordering, total, sequence_number AS n_events FROM r WHERE sequence_number % 10 = 0"),
)
def snapshot_write(spark: SparkSession, sf: str) -> DataFrame:
    """States after every tenth event of an entity, as the snapshot store holds them."""
    source = written_journal(spark, sf)
    store = J.Journal(spark, scratch(spark, "snapshot-journal"), buckets=source.buckets)
    store.append(source.events().select("persistence_id", "payload", "tags", "ts", "ordering"), ["ordering"])
    return J.SnapshotStore(store, F.col("payload.amount")).take_every(10)


@query("snapshot_recover", with_views("ev", f"{WRITTEN} SELECT persistence_id, CAST(sum(amount) AS BIGINT) AS total, count(*) AS n_events, max(sequence_number) + 1 AS next_id FROM stored GROUP BY 1"))
def snapshot_recover(spark: SparkSession, sf: str) -> DataFrame:
    """The states stored after the first batch and the events after them; the oracle is the full replay."""
    return J.SnapshotStore(written_journal(spark, sf), F.col("payload.amount")).recover()


@query(
    "multi_event",
    with_views(
        "journal",
        """, k AS (SELECT unnest([0, 1, 2, 3]) AS sub)
        SELECT persistence_id, sequence_number, CAST(sub AS INTEGER) AS sub,
        CASE sub WHEN 0 THEN 'TaxRecord' WHEN 1 THEN 'InvoiceRecord' WHEN 2 THEN 'Certified tax' ELSE 'Certified invoice' END AS kind,
        CASE sub WHEN 0 THEN CAST(amount // 3 AS BIGINT) WHEN 1 THEN amount END AS event_amount FROM journal, k""",
    ),
)
def multi_event(spark: SparkSession, sf: str) -> DataFrame:
    return J.invoice_events(V.journal(spark, sf), ["persistence_id", "sequence_number"], F.col("amount"))


@query(
    "multi_event_async",
    with_views("ev", "SELECT user_id, event_type AS event FROM ev UNION ALL SELECT user_id, event_type || '_pr' FROM ev"),
)
def multi_event_async(spark: SparkSession, sf: str) -> DataFrame:
    return J.processed_pairs(V.ev(spark, sf), F.col("event_type"), "user_id")


@query(
    "bulk_persist",
    """WITH placed AS (SELECT l_orderkey, l_linestatus = 'O' AS later, l_partkey, row_number() OVER (PARTITION BY l_orderkey
    ORDER BY l_linestatus = 'O', l_linenumber, l_partkey, l_suppkey) AS id FROM lineitem)
    SELECT 'invoice-' || CAST(l_orderkey AS VARCHAR) AS invoice, id, min(id) OVER (PARTITION BY l_orderkey, later) AS base, l_partkey AS part FROM placed""",
)
def bulk_persist(spark: SparkSession, sf: str) -> DataFrame:
    """The lines of an order come as one list of finished and one of open lines; the second goes on from the first's ids."""
    line = F.struct("l_linenumber", "l_partkey", "l_suppkey")
    lists = load(spark, sf, "lineitem").groupBy("l_orderkey", (F.col("l_linestatus") == "O").alias("later"))
    # an order has a few lines
    lists = lists.agg(F.array_sort(F.collect_list(line)).alias("items"), F.min("l_shipdate").alias("ts"))
    lists = lists.withColumns(
        {"persistence_id": F.concat(F.lit("invoice-"), F.col("l_orderkey").cast("string")), "tags": F.array(F.lit("invoice"))}
    )
    store = J.Journal(spark, scratch(spark, "invoices"), buckets=16)
    for batch, later in enumerate((False, True)):
        J.persist_lists(store, lists.where(F.col("later") == later), ["l_orderkey"], batch)
    return store.events().select(
        F.col("persistence_id").alias("invoice"), F.col("sequence_number").alias("id"), "payload.base", F.col("payload.item.l_partkey").alias("part")
    )


@query(
    "event_upcast",
    with_views("guitar_events", "SELECT id, quantity, version, coalesce(guitar_type, 'acoustic') AS guitar_type FROM guitar_events"),
)
def event_upcast(spark: SparkSession, sf: str) -> DataFrame:
    """Version 1 rows lack the type column altogether."""
    events = V.guitar_events(spark, sf)
    both = J.upcast_guitars(events.where("version = 1").drop("guitar_type"), events.where("version = 2"))
    return both.select("id", "quantity", "version", "guitar_type")


@query(
    "event_model_map",
    with_views(
        "ev coupons users",
        """SELECT c.seq, CAST(c.code AS VARCHAR) AS code, u.id AS user_id, u.email,
        CASE WHEN c.seq % 2 = 0 THEN '' ELSE u.name END AS name FROM coupons c JOIN users u ON c.user_id = u.id""",
    ),
)
def event_model_map(spark: SparkSession, sf: str) -> DataFrame:
    """Stored events of both versions become domain events and are stored again in the new version."""
    joined = V.coupons(spark, sf).join(V.users(spark, sf).withColumnRenamed("id", "user_id"), "user_id")
    stored = joined.withColumn("code", F.concat_ws(":", "seq", "code"))
    v1, v2 = stored.where("seq % 2 = 0").drop("name"), stored.where("seq % 2 = 1")
    again = J.to_storage(union_all([J.to_domain(v1), J.to_domain(v2)]))
    parts = F.split("code", ":")
    return again.select(
        F.get(parts, F.lit(0)).cast("bigint").alias("seq"), F.get(parts, F.lit(1)).alias("code"), "user_id", "email", "name"
    )


@query(
    "event_tag",
    with_views("songs", "SELECT playlist_id, count(DISTINCT genre) AS n_tags, bool_or(genre = 'PROMO') AS promo FROM songs GROUP BY 1"),
)
def event_tag(spark: SparkSession, sf: str) -> DataFrame:
    """Each purchased playlist is tagged with its genres when it is written."""
    tagged = J.tag_events(V.song_genres(spark, sf), "playlist_id", F.col("genre"))
    return tagged.select(
        "playlist_id", F.size("tags").cast("bigint").alias("n_tags"), F.array_contains("tags", "PROMO").alias("promo")
    )


@query("coupon_first_wins", with_views("ev coupons", "SELECT code, min(seq) AS seq, arg_min(user_id, seq) AS user_id FROM coupons GROUP BY code"))
def coupon_first_wins(spark: SparkSession, sf: str) -> DataFrame:
    return tables.first(V.coupons(spark, sf), ["code"], ["seq"])


@query(
    "vote_once",
    with_views("votes", ", f AS (SELECT person_id, arg_min(candidate, seq) AS candidate FROM votes GROUP BY 1) SELECT candidate, count(*) AS n FROM f GROUP BY 1"),
)
def vote_once(spark: SparkSession, sf: str) -> DataFrame:
    counted = tables.first(V.votes(spark, sf).select("person_id", "seq", "candidate"), ["person_id"], ["seq"])
    return counted.groupBy("candidate").agg(F.count(F.lit(1)).alias("n"))


CANDIDATES = ("click", "view", "purchase", "signup")
_VOTES = """, g AS (SELECT *, ts_us - lag(ts_us) OVER (ORDER BY seq) > 1800000000 AS gap FROM votes),
    c AS (SELECT *, coalesce(bool_or(gap) OVER (ORDER BY seq), false) AS closed FROM g),
    v AS (SELECT *, min(CASE WHEN NOT closed AND age >= 18 AND candidate <> 'error' THEN seq END)
    OVER (PARTITION BY person_id) AS accepted_at FROM c)
    SELECT seq, person_id, CASE WHEN closed THEN 'Polls closed' WHEN accepted_at < seq THEN 'Already voted'
    WHEN age < 18 THEN 'Too young' WHEN candidate = 'error' THEN 'Invalid candidate' ELSE 'Accepted' END AS outcome FROM v"""


@query("vote_validate", with_views("votes", _VOTES))
def vote_validate(spark: SparkSession, sf: str) -> DataFrame:
    polls = timespine.until_silence(V.votes(spark, sf), [], "ts_us", ["seq"], HOUR_US // 2)
    checked = states.validate_votes(
        polls, "person_id", ["seq"], F.col("age"), F.col("candidate"), CANDIDATES, F.col("closed")
    )
    return checked.select("seq", "person_id", "outcome")


ACCOUNT = """, n AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY seq) AS r FROM ledger),
    walk AS (SELECT user_id, r, seq, amount, amount >= 0 AS accepted, greatest(amount, 0) AS balance FROM n WHERE r = 1
    UNION ALL SELECT n.user_id, n.r, n.seq, n.amount, w.balance + n.amount >= 0,
    CASE WHEN w.balance + n.amount >= 0 THEN w.balance + n.amount ELSE w.balance END
    FROM walk w JOIN n ON n.user_id = w.user_id AND n.r = w.r + 1)
    SELECT seq, user_id, amount, accepted, balance FROM walk"""


@query("account_guard", with_views("ev ledger", ACCOUNT))
def account_guard(spark: SparkSession, sf: str) -> DataFrame:
    guarded = states.guarded_balance(V.ledger(spark, sf), ["user_id"], ["seq"], "amount")
    return guarded.select("seq", "user_id", "amount", "accepted", "balance")


@query("account_unguarded", with_views("ev ledger", "SELECT seq, user_id, CAST(sum(amount) OVER (PARTITION BY user_id ORDER BY seq) AS BIGINT) AS balance FROM ledger"))
def account_unguarded(spark: SparkSession, sf: str) -> DataFrame:
    return OrderedScan(V.ledger(spark, sf), ["seq"], ["user_id"]).upto(balance=("sum", F.col("amount"))).df.drop("amount")


PRICE, STOCK, WAIT_US = 5000, 3, 8 * HOUR_US
# one CASE per column; a row first expires an open wait, then acts on state (st, stock, money)
_FSM = f""", n AS (SELECT *, row_number() OVER (PARTITION BY machine ORDER BY seq) AS r,
    coalesce(ts_us - lag(ts_us) OVER (PARTITION BY machine ORDER BY seq) > {WAIT_US}, false) AS late FROM commands),
    walk AS (SELECT machine, CAST(0 AS BIGINT) AS r, CAST(NULL AS BIGINT) AS seq, 'idle' AS st, CAST({STOCK} AS BIGINT) AS stock,
    CAST(0 AS BIGINT) AS money, CAST(NULL AS BIGINT) AS expired, CAST(NULL AS VARCHAR) AS reply, CAST(NULL AS BIGINT) AS amount
    FROM (SELECT DISTINCT machine FROM commands)
    UNION ALL
    SELECT x.machine, x.r, x.seq,
      CASE WHEN x.st0 = 'idle' AND cmd = 'init' THEN 'op' WHEN x.st0 = 'op' AND cmd = 'request' AND x.stock > 0 THEN 'wait'
        WHEN x.st0 = 'wait' AND cmd = 'money' AND x.money0 + cents >= {PRICE} THEN 'op' ELSE x.st0 END,
      CASE WHEN x.st0 = 'wait' AND cmd = 'money' AND x.money0 + cents >= {PRICE} THEN x.stock - 1 ELSE x.stock END,
      CASE WHEN x.st0 = 'wait' AND cmd = 'money' AND x.money0 + cents < {PRICE} THEN x.money0 + cents
        WHEN x.st0 = 'wait' AND cmd <> 'money' THEN x.money0 ELSE 0 END,
      x.expired,
      CASE WHEN x.st0 = 'idle' AND cmd = 'init' THEN 'Initialized' WHEN x.st0 = 'idle' THEN 'Not Init'
        WHEN x.st0 = 'op' AND cmd = 'request' AND x.stock > 0 THEN 'Insert' WHEN x.st0 = 'op' AND cmd = 'request' THEN 'Product not available'
        WHEN x.st0 = 'wait' AND cmd = 'money' AND x.money0 + cents >= {PRICE} THEN 'Deliver'
        WHEN x.st0 = 'wait' AND cmd = 'money' THEN 'Insert' ELSE 'Command not found' END,
      CASE WHEN x.st0 = 'op' AND cmd = 'request' AND x.stock > 0 THEN {PRICE}
        WHEN x.st0 = 'wait' AND cmd = 'money' THEN abs(x.money0 + cents - {PRICE}) END
    FROM (SELECT n.machine, n.r, n.seq, n.cmd, n.cents, w.stock,
      CASE WHEN w.st = 'wait' AND n.late THEN 'op' ELSE w.st END AS st0,
      CASE WHEN w.st = 'wait' AND n.late THEN 0 ELSE w.money END AS money0,
      CASE WHEN w.st = 'wait' AND n.late THEN w.money END AS expired
      FROM walk w JOIN n ON n.machine = w.machine AND n.r = w.r + 1) x)
    SELECT machine, seq, 0 AS sub, 'Timed out' AS reply, expired AS amount FROM walk WHERE expired IS NOT NULL
    UNION ALL SELECT machine, seq, 1, reply, amount FROM walk WHERE seq IS NOT NULL"""


@query("fsm_replay", with_views("ev commands", _FSM))
def fsm_replay(spark: SparkSession, sf: str) -> DataFrame:
    return states.vending_replay(
        V.commands(spark, sf), "machine", "seq", "ts_us", "cmd", "cents", PRICE, STOCK, WAIT_US
    )


# the other form: only money restarts the timer, messages without a handler are dropped
_FSM_MONEY_TIMER = (
    _FSM.replace(f"coalesce(ts_us - lag(ts_us) OVER (PARTITION BY machine ORDER BY seq) > {WAIT_US}, false) AS late", "0 AS late")
    .replace("CAST(0 AS BIGINT) AS money,", "CAST(0 AS BIGINT) AS money, CAST(0 AS BIGINT) AS timer,")
    .replace(
        "      x.expired,\n",
        f"""      CASE WHEN x.st0 = 'op' AND cmd = 'request' AND x.stock > 0 THEN x.ts_us
        WHEN x.st0 = 'wait' AND cmd = 'money' AND x.money0 + cents < {PRICE} THEN x.ts_us ELSE x.timer END,
      x.expired,\n""",
    )
    .replace("n.cmd, n.cents, w.stock,", "n.cmd, n.cents, n.ts_us, w.stock, w.timer,")
    .replace("w.st = 'wait' AND n.late", f"w.st = 'wait' AND n.ts_us - w.timer > {WAIT_US}")
    .replace("ELSE 'Command not found' END", "END")
    .replace("FROM walk WHERE seq IS NOT NULL", "FROM walk WHERE seq IS NOT NULL AND reply IS NOT NULL")
)


@query("fsm_replay_money_timer", with_views("ev commands", _FSM_MONEY_TIMER))
def fsm_replay_money_timer(spark: SparkSession, sf: str) -> DataFrame:
    return states.vending_replay(
        V.commands(spark, sf), "machine", "seq", "ts_us", "cmd", "cents", PRICE, STOCK, WAIT_US, any_message_restarts=False
    )


@query(
    "hold_until_open",
    with_views(
        "gate",
        """, o AS (SELECT user_id, seq AS open_at, row_number() OVER (PARTITION BY user_id ORDER BY seq) AS n FROM gate WHERE cmd = 'open'),
        c AS (SELECT *, count(*) FILTER (cmd = 'close') OVER (PARTITION BY user_id ORDER BY seq
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS closes FROM gate),
        p AS (SELECT c.*, CASE WHEN open_at IS NOT NULL THEN greatest(seq, open_at) END AS released_at
        FROM c LEFT JOIN o ON o.user_id = c.user_id AND o.n = c.closes + 1 WHERE cmd <> 'open'),
        w AS (SELECT *, last_value(CASE WHEN cmd = 'write' THEN payload END IGNORE NULLS) OVER
        (PARTITION BY user_id, released_at IS NULL ORDER BY released_at, seq) AS seen FROM p)
        SELECT seq, user_id, cmd, released_at, CASE WHEN cmd = 'read' AND released_at IS NOT NULL THEN seen END AS read_value FROM w""",
    ),
)
def hold_until_open(spark: SparkSession, sf: str) -> DataFrame:
    passed = states.hold_until_open(V.gate(spark, sf), "user_id", "seq", "cmd", "payload")
    return passed.select("seq", "user_id", "cmd", "released_at", "read_value")


@query(
    "membership_state",
    with_views(
        "ev members",
        f"{MEMBERSHIP} SELECT * FROM states",
    ),
)
def membership_state(spark: SparkSession, sf: str) -> DataFrame:
    return states.membership(V.members(spark, sf), "node", ["seq"], F.col("kind"))


_CARDS = """, c AS (SELECT id, lpad(CAST(account % 100 AS VARCHAR), 2, '0') AS card FROM tx)"""


@query(
    "checkout_flow",
    with_views(
        "tx",
        f"""{_CARDS}, s AS (SELECT id, CASE WHEN card[1] = '0' THEN 'denied' ELSE 'confirmed' END AS stage FROM c)
        SELECT id, stage, CASE WHEN stage = 'confirmed' THEN row_number() OVER (PARTITION BY stage ORDER BY id) END AS order_no FROM s""",
    ),
)
def checkout_flow(spark: SparkSession, sf: str) -> DataFrame:
    card = F.lpad((F.col("account") % 100).cast("string"), 2, "0")
    carts = V.tx(spark, sf).select("id", card.alias("card"))
    return states.checkout(carts, ["id"], values.card_denied(F.col("card"))).select("id", "stage", "order_no")


@query("order_to_transaction", with_views("tx", "SELECT row_number() OVER (ORDER BY id) - 1 AS transaction_id, account, amount FROM tx"))
def order_to_transaction(spark: SparkSession, sf: str) -> DataFrame:
    return states.transactions(V.tx(spark, sf).select("id", "account", "amount"), ["id"], F.col("account"), F.col("amount"))


@query("tbl_find_all", with_views("stock", "SELECT * FROM stock"))
def tbl_find_all(spark: SparkSession, sf: str) -> DataFrame:
    return V.stock(spark, sf)


@query("tbl_find_id", with_views("stock", "SELECT * FROM stock WHERE id = 42"))
def tbl_find_id(spark: SparkSession, sf: str) -> DataFrame:
    return V.stock(spark, sf).where(F.col("id") == 42)


@query("tbl_filter_attr", with_views("stock", "SELECT * FROM stock WHERE make = 'Brand#17'"))
def tbl_filter_attr(spark: SparkSession, sf: str) -> DataFrame:
    return V.stock(spark, sf).where(F.col("make") == "Brand#17")


@query(
    "tbl_inventory",
    with_views("stock", "SELECT id, 'in stock' AS shelf FROM stock WHERE quantity > 0 UNION ALL SELECT id, 'out of stock' FROM stock WHERE quantity = 0"),
)
def tbl_inventory(spark: SparkSession, sf: str) -> DataFrame:
    """Negative quantities are on neither shelf."""
    shelf = F.when(F.col("quantity") > 0, "in stock").when(F.col("quantity") == 0, "out of stock")
    return V.stock(spark, sf).select("id", shelf.alias("shelf")).where("shelf IS NOT NULL")


def _player_table(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_nationkey").cast("bigint").alias("v"))


@query(
    "tbl_upsert",
    with_views(
        "kv_log",
        """, u AS (SELECT id, arg_max(v, seq) AS v FROM kv_log WHERE op = 'put' GROUP BY id)
        SELECT c_custkey AS id, CAST(c_nationkey AS BIGINT) AS v FROM customer WHERE c_custkey NOT IN (SELECT id FROM u)
        UNION ALL SELECT id, v FROM u""",
    ),
)
def tbl_upsert(spark: SparkSession, sf: str) -> DataFrame:
    return tables.upsert(_player_table(spark, sf), V.kv_log(spark, sf).where("op = 'put'"), ["id"], ["seq"])


@query(
    "tbl_delete",
    with_views("kv_log", "SELECT c_custkey AS id, CAST(c_nationkey AS BIGINT) AS v FROM customer WHERE c_custkey NOT IN (SELECT id FROM kv_log WHERE op = 'del')"),
)
def tbl_delete(spark: SparkSession, sf: str) -> DataFrame:
    return tables.delete(_player_table(spark, sf), V.kv_log(spark, sf).where("op = 'del'"), ["id"])


@query(
    "tbl_add_quantity",
    with_views(
        "ev stock",
        """, d AS (SELECT user_id * 20 AS id, CAST(sum(k) AS BIGINT) AS q FROM ev WHERE event_type = 'view' GROUP BY 1)
        SELECT coalesce(s.id, d.id) AS id, CASE WHEN s.id IS NOT NULL THEN s.quantity + coalesce(d.q, 0) END AS quantity,
        CASE WHEN d.id IS NULL THEN 'Unchanged' WHEN s.id IS NULL THEN 'AddFail' ELSE 'AddSuccess' END AS status
        FROM stock s FULL JOIN d ON s.id = d.id""",
    ),
)
def tbl_add_quantity(spark: SparkSession, sf: str) -> DataFrame:
    deltas = V.ev(spark, sf).where("event_type = 'view'").select((F.col("user_id") * 20).alias("id"), F.col("k").alias("quantity"))
    return tables.add_quantity(V.stock(spark, sf).select("id", "quantity"), deltas, "id", "quantity")


@query(
    "tbl_append",
    "SELECT p_partkey AS id, p_name AS title FROM part UNION ALL SELECT c_custkey, c_name FROM customer",
)
def tbl_append(spark: SparkSession, sf: str) -> DataFrame:
    """Appending keeps duplicate ids."""
    books = load(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("title"))
    more = load(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("title"))
    return flows.merge([books, more])


@query(
    "tbl_change_log",
    with_views("kv_log", "SELECT id, v FROM (SELECT id, arg_max(v, seq) AS v, arg_max(op, seq) AS op FROM kv_log GROUP BY id) WHERE op = 'put'"),
)
def tbl_change_log(spark: SparkSession, sf: str) -> DataFrame:
    return tables.compact(V.kv_log(spark, sf), ["id"], ["seq"], F.col("op") == "del").select("id", "v")
