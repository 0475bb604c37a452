"""Keyed, ordered state machines.

Where a machine has a closed form it is written with running folds.  Where its next step truly depends
on the previous decision, running folds first settle all rows whose outcome is certain, so that only
the rest passes through ``fold_rows``: a sequential fold over sorted rows that keeps one state in
memory and streams, however long the log of a key is.  The guarded account goes further: the claims of a
heavy key are walked in parts side by side.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass
from typing import Any

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from rillmark.functions.values import MIN_VOTING_AGE
from rillmark.operators.scan import OrderedScan, join_same, ordered_reduce, task_rows, union_all, with_position, written

Step = Callable[[dict[str, Any], tuple], tuple]


def fold_rows(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], step: Step, schema: T.StructType
) -> DataFrame:
    """Sequential fold per key in order: ``step(state, row)`` changes the state, returns an output row.

    ``df`` must start with the key columns.  Rows arrive sorted from the shuffle in Arrow batches; only
    the state of the current key is held.
    """
    width = len(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        arrow = to_arrow_schema(schema)
        current, state = None, {}
        for batch in batches:
            out = []
            for row in zip(*[column.to_pylist() for column in batch.columns], strict=True):
                if row[:width] != current:
                    current, state = row[:width], {}
                out.append(step(state, row))
            if out:
                columns = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t.type) for c, t in zip(columns, arrow, strict=True)], schema=arrow
                )

    sorted_rows = df.repartition(*keys).sortWithinPartitions(*keys, *order)
    return sorted_rows.mapInArrow(run, schema)


def _fields(df: DataFrame, *names: str) -> list[T.StructField]:
    return [T.StructField(n, df.schema[n].dataType) for n in names]


def nesting(df: DataFrame, keys: Sequence[str], order: Sequence[str], step: Column) -> DataFrame:
    """Depth of a stack that +1 / -1 steps push and pop; pops on an empty stack are ignored."""
    scan = OrderedScan(df.withColumn("_step", step), order, keys).upto(_sum=("sum", F.col("_step")))
    scan = scan.upto(_low=("min", F.col("_sum")))
    depth = F.col("_sum") - F.least(F.lit(0), F.col("_low"))
    return scan.df.withColumn("depth", depth).drop("_step", "_sum", "_low")


# doubtful claims of a key that are settled one after another in one task
CLAIMS = 1_000_000


def guarded_balance(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], amount: str
) -> DataFrame:
    """Account per key that rejects a withdrawal larger than the balance.

    Rejections only ever raise the balance, so the running sum minus its lowest point so far is a
    lower bound of it.  Withdrawals within that bound are certainly accepted.  The doubtful ones cut
    the log into segments; a segment is its doubtful claim plus the sum of certain amounts after it.
    Only this one row per claim is settled in sequence, and the decision is joined back.  Keys with more
    than ``CLAIMS`` of them (or than a task should hold) are settled part by part, see ``settled_in_parts``.
    """
    a = F.col(amount)
    scan = OrderedScan(df, order, keys)
    scan = scan.upto(_sum=("sum", a)).before(_low=("min", F.col("_sum")))
    bound = F.col("_sum") - F.least(F.lit(0), F.coalesce("_low", F.lit(0)))
    scan = scan.let(_doubt=(a < 0) & (bound < 0))
    scan = scan.upto(_segment=("count", F.when(F.col("_doubt"), 1)))
    rows = scan.table().drop("_low")
    doubt = F.col("_doubt")
    segments = rows.groupBy(*keys, "_segment").agg(
        F.coalesce(F.sum(F.when(doubt, a)), F.lit(0)).alias("_claim"),
        F.coalesce(F.sum(F.when(~doubt, a)), F.lit(0)).alias("_sure"),
        F.coalesce(F.sum(F.when(doubt, F.col("_sum"))), F.lit(0)).alias("_at"),
    )
    if scan.layout is None:
        decided = _settled(segments, keys)
    else:
        # segments are numbered from 0, so this one row tells that a key has more
        claims = min(CLAIMS, task_rows(df.sparkSession))
        segments = written(segments, "claims")
        long = segments.where(F.col("_segment") == claims).select(*keys)
        light = _settled(join_same(segments, long, keys, "left_anti"), keys)
        decided = union_all([light, settled_in_parts(join_same(segments, long, keys, "left_semi"), keys, claims)])
    joined = join_same(rows, decided, [*keys, "_segment"])
    return joined.select(
        *df.columns,
        (~doubt | F.col("_ok")).alias("accepted"),
        (F.col("_sum") + F.col("_shift")).alias("balance"),
    )


def _settled(segments: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``_segment, _ok, _shift`` (balance minus running sum) of each claim, key by key in sequence."""
    key_count = len(keys)

    def decide(state: dict, row: tuple) -> tuple:
        segment, claim, sure, at = row[key_count:]
        balance = state.get("balance", 0)
        accepted = balance + claim >= 0
        if accepted:
            balance += claim
        state["balance"] = balance + sure
        return (*row[:key_count], segment, accepted, balance - at)

    return fold_rows(segments, keys, ["_segment"], decide, _decisions(segments, keys))


def _decisions(segments: DataFrame, keys: Sequence[str]) -> T.StructType:
    ends = [T.StructField("_ok", T.BooleanType()), T.StructField("_shift", T.LongType())]
    return T.StructType(_fields(segments, *keys, "_segment") + ends)


@dataclass
class Walk:
    """A part of a log walked from one entry balance.

    Its decisions are the same from every balance between ``low`` and ``high``, so there the part is a translation:
    one piece of the piecewise translation that it is as a whole.
    """

    out: int
    low: int
    high: int
    accepted: list[bool]
    balances: list[int]

    @classmethod
    def of(cls, entry: int, claims: list[int], sures: list[int]) -> Walk:
        balance, fall, rise, accepted, balances = entry, entry, 2**62, [], []
        for claim, sure in zip(claims, sures, strict=True):
            left = balance + claim
            if left >= 0:
                fall, balance = min(fall, left), left
            else:
                rise = min(rise, -1 - left)
            accepted.append(left >= 0)
            balances.append(balance)
            balance += sure
        return cls(balance, entry - fall, entry + rise, accepted, balances)


def settled_in_parts(segments: DataFrame, keys: Sequence[str], claims: int) -> DataFrame:
    """The decisions of ``_settled`` for keys with many claims, cut into parts of ``claims`` that tasks walk side by side.

    A part maps its entry balance to its exit balance by a piecewise translation.  All parts are walked from a guess, each of
    which yields one piece with the exact bounds where it holds.  Chaining the pieces of a key gives every part the
    balance it is entered with; parts for which that falls outside their pieces are walked again from there.  Rejections
    bring different balances together, so a few rounds do; each round settles the first open part of every key for
    good, so there are never more rounds than parts.
    """
    parts = written(segments.withColumn("_part", F.floor(F.col("_segment") / claims)), "parts")
    by = [*keys, "_part"]
    key_fields = _fields(parts, *by)

    def walked(entries: DataFrame, give: Callable[[pa.Table, int, Walk], pa.Table], schema: T.StructType) -> DataFrame:
        def run(table: pa.Table) -> pa.Table:
            table = table.sort_by("_segment")
            entry = table.column("_entry")[0].as_py()
            return give(table, entry, Walk.of(entry, table.column("_claim").to_pylist(), table.column("_sure").to_pylist()))

        met = join_same(parts, entries.select(*by, "_entry"), by)
        return met.groupBy(*by).applyInArrow(run, schema)

    def piece(table: pa.Table, entry: int, walk: Walk) -> pa.Table:
        ends = {"_entry": [entry], "_out": [walk.out], "_low": [walk.low], "_high": [walk.high]}
        return pa.table({**{c: table.column(c).slice(0, 1) for c in by}, **ends})

    def decisions(table: pa.Table, entry: int, walk: Walk) -> pa.Table:
        shift = pc.subtract(pa.array(walk.balances, pa.int64()), table.column("_at"))
        return pa.table({**{c: table.column(c) for c in (*keys, "_segment")}, "_ok": walk.accepted, "_shift": shift})

    numbers = [T.StructField(c, T.LongType()) for c in ("_entry", "_out", "_low", "_high")]
    piece_schema = T.StructType(key_fields + numbers)
    pieces = walked(parts.select(*by).distinct().withColumn("_entry", F.lit(0).cast("bigint")), piece, piece_schema)
    pieces = written(pieces, "pieces")
    while True:
        entries = written(_chained(pieces, keys, key_fields), "entries")
        unknown = entries.where("NOT _known")
        if unknown.isEmpty():
            return walked(entries, decisions, _decisions(segments, keys))
        pieces = written(union_all([pieces, walked(unknown, piece, piece_schema)]), "pieces")


def _chained(pieces: DataFrame, keys: Sequence[str], key_fields: list[T.StructField]) -> DataFrame:
    """The entry balance of every part as far as the pieces tell, and whether one of its pieces holds there.

    Beyond the first part whose pieces do not, entries are guesses: the exit of the piece nearest to the entry.
    """
    known = F.collect_list(F.struct("_entry", "_out", "_low", "_high")).alias("_pieces")
    rows = pieces.groupBy(*keys, "_part").agg(known)
    width = len(keys)

    def step(state: dict, row: tuple) -> tuple:
        balance, found = state.get("balance", 0), row[width + 1]
        holds = next((p for p in found if p["_low"] <= balance <= p["_high"]), None)
        if holds:
            state["balance"] = balance + holds["_out"] - holds["_entry"]
        else:
            state["balance"] = min(found, key=lambda p: abs(p["_entry"] - balance))["_out"]
        return (*row[: width + 1], balance, holds is not None)

    ends = [T.StructField("_entry", T.LongType()), T.StructField("_known", T.BooleanType())]
    return fold_rows(rows, keys, ["_part"], step, T.StructType(key_fields + ends))


def validate_votes(
    df: DataFrame, person: str, order: Sequence[str], age: Column, candidate: Column,
    candidates: Sequence[str], closed: Column,
) -> DataFrame:
    """Outcome of every vote, first failing check first; only accepted votes block later ones."""
    valid = (age >= MIN_VOTING_AGE) & candidate.isin(*candidates) & ~closed
    scan = OrderedScan(df, order, [person]).before(_voted=("count", F.when(valid, 1)))
    outcome = (
        F.when(closed, "Polls closed")
        .when(F.col("_voted") > 0, "Already voted")
        .when(age < MIN_VOTING_AGE, "Too young")
        .when(~candidate.isin(*candidates), "Invalid candidate")
        .otherwise("Accepted")
    )
    return scan.df.withColumn("outcome", outcome).drop("_voted")


def hold_until_open(
    df: DataFrame, key: str, order: str, cmd: str, payload: str
) -> DataFrame:
    """When each read, write and close passes its gate, and what each read sees.

    After c closes a row waits for open number c + 1 of its key and passes at once if that open came
    before it; without such an open ``released_at`` is null.  Since c never falls along the log, rows
    pass in log order, so a read sees the last write before it.
    """
    is_open, is_close = F.col(cmd) == "open", F.col(cmd) == "close"
    write, read = F.col(cmd) == "write", F.col(cmd) == "read"
    scan = OrderedScan(df, [order], [key]).fold(
        upto={"_opens": ("count", F.when(is_open, 1)), "_seen": ("last", F.when(write, F.col(payload)))},
        before={"_closes": ("count", F.when(is_close, 1))},
    )
    rows = scan.table()
    opens = rows.where(is_open).select(key, (F.col("_opens") - 1).alias("_closes"), F.col(order).alias("_open_at"))
    waiting = join_same(rows.where(~is_open), opens, [key, "_closes"], "left")
    passes = F.col("_open_at").isNotNull()
    return waiting.select(
        *df.columns,
        F.when(passes, F.greatest(order, "_open_at")).alias("released_at"),
        F.when(passes & read, F.col("_seen")).alias("read_value"),
    )


def automaton(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], kind: Column, table: dict[str, list[int]]
) -> DataFrame:
    """End state (from state 0) of a finite automaton per key; ``table[kind][state]`` is the next one.

    A row is the map from each state to the next; maps compose associatively, so the log of a key is
    reduced block by block.  Kinds outside the table leave the state as it is.
    """
    states = range(len(next(iter(table.values()))))
    unchanged = F.array(*[F.lit(s) for s in states])
    moves = unchanged
    for name, row in table.items():
        moves = F.when(kind == name, F.array(*map(F.lit, row))).otherwise(moves)
    reduced = ordered_reduce(
        df, keys, order, moves, unchanged, lambda acc, row: F.transform(acc, lambda s: F.get(row, s))
    )
    return reduced.select(*keys, F.get("value", F.lit(0)).alias("state"))


# state = registered + 2 * pending
MEMBERSHIP = {"up": [1, 1, 0, 1], "unreachable": [0, 3, 2, 3], "removed": [0, 0, 2, 2]}


def membership(df: DataFrame, node: str, order: Sequence[str], kind: Column) -> DataFrame:
    """Per node: registered, pending removal, live (registered and not pending)."""
    end = automaton(df, [node], order, kind, MEMBERSHIP)
    registered, pending = F.col("state") % 2 == 1, F.col("state") >= 2
    return end.select(
        node, registered.alias("registered"), pending.alias("pending"), (registered & ~pending).alias("live")
    )


SPREAD = 4096
CLOCK = "clock"


def vending_replay(
    df: DataFrame,
    machine: str,
    order: str,
    ts_us: str,
    cmd: str,
    money: str,
    price: int,
    stock: int,
    timeout_us: int,
    any_message_restarts: bool = True,
    as_of_us: int | None = None,
) -> DataFrame:
    """Replies of a vending machine to a command log (init, request, money, anything else).

    Output: one row per reply with ``sub`` 0 for a timeout that fires before the row and 1 for the
    row itself.  ``any_message_restarts`` selects the form in which every message restarts the timer
    and an unhandled one is answered; otherwise only money restarts it and such messages are dropped.
    A wait at the end of the log stays open, unless the time ``as_of_us`` is late enough to end it.

    A request is a certain start if no wait can be open before it: there was none before, enough
    money followed the previous one, or a row after a silence longer than the timeout did.  The log of a
    machine is folded separately between certain starts, with unlimited stock; then deliveries are
    counted and everything after the last item in stock is answered as sold out.
    """
    if as_of_us is not None:
        clock = df.groupBy(machine).agg((F.max(order) + 1).alias(order))
        now = {ts_us: F.lit(as_of_us), cmd: F.lit(CLOCK), money: F.lit(0)}
        df = union_all([df.select(machine, order, *now), clock.withColumns(now).select(machine, order, *now)])
    is_request, is_money = F.col(cmd) == "request", F.col(cmd) == "money"
    restarts = F.lit(True) if any_message_restarts else (is_request | is_money)
    scan = OrderedScan(df, [order], [machine])
    scan = scan.fold(
        upto={
            "_init": ("first", F.when(F.col(cmd) == "init", F.col(order))),
            "_paid": ("sum", F.when(is_money, F.col(money))),
        },
        before={"_prev": ("last", F.when(restarts, F.col(ts_us)))},
    )
    scan = scan.let(_active=F.coalesce(F.col(order) > F.col("_init"), F.lit(False)))
    late = F.col(ts_us) - F.col("_prev") > timeout_us
    scan = scan.upto(_gaps=("count", F.when(late, 1))).let(_earlier_gaps=F.col("_gaps") - F.when(late, 1).otherwise(0))
    live_request = is_request & F.col("_active")
    scan = scan.before(
        _paid0=("last", F.when(live_request, F.col("_paid"))),
        _gaps0=("last", F.when(live_request, F.col("_gaps"))),
    )
    certain = live_request & (
        F.col("_paid0").isNull()
        | (F.col("_paid") - F.col("_paid0") >= price)
        | (F.col("_earlier_gaps") > F.col("_gaps0"))
    )
    scan = scan.let(_certain=certain).upto(_starts=("count", F.when(F.col("_certain"), 1)))
    # rows before the first start need no state: their reply is known, and they are spread by hash
    spread = -1 - F.pmod(F.xxhash64(machine, order), F.lit(SPREAD))
    segment = F.when(F.col("_starts") > 0, F.col("_starts")).otherwise(spread)
    is_init = F.coalesce(F.col(order) == F.col("_init"), F.lit(False))
    early = F.when(is_init, "Initialized").when(~F.col("_active"), "Not Init")
    rows = scan.df.select(
        machine, segment.alias("_segment"), order, ts_us, cmd, money, early.alias("_early")
    )
    unhandled = "Command not found" if any_message_restarts else None

    def step(state: dict, row: tuple) -> tuple:
        key, segment, seq, now, command, amount, early = row
        expired = None
        if segment < 0:
            return (key, seq, command, expired, None if command == CLOCK else early or unhandled, None)
        if state.get("money") is not None and now - state["timer"] > timeout_us:
            expired, state["money"] = state["money"], None
        if command == CLOCK:
            return (key, seq, command, expired, None, None)
        waiting = state.get("money") is not None
        reply, number = unhandled, None
        if command == "request" and not waiting:
            state["money"], state["timer"] = 0, now
            reply, number = "Insert", price
        elif command == "money" and waiting:
            paid = state["money"] + amount
            if paid >= price:
                state["money"] = None
                reply, number = "Deliver", paid - price
            else:
                state["money"], state["timer"] = paid, now
                reply, number = "Insert", price - paid
        elif any_message_restarts:
            state["timer"] = now
        return (key, seq, command, expired, reply, number)

    schema = T.StructType(
        _fields(df, machine, order, cmd)
        + [
            T.StructField("expired", T.LongType()),
            T.StructField("reply", T.StringType()),
            T.StructField("amount", T.LongType()),
        ]
    )
    folded = fold_rows(rows, [machine, "_segment"], [order], step, schema)
    if scan.layout is not None:
        folded = written(folded, "replies")
    counted = OrderedScan(folded, [order], [machine], scan.layout).before(
        _sold=("count", F.when(F.col("reply") == "Deliver", 1))
    )
    started = ~F.coalesce(F.col("reply").isin("Not Init", "Initialized"), F.lit(False))
    sold_out = started & (F.col("_sold") >= stock)
    settled = counted.df.select(
        machine,
        order,
        F.when(~sold_out, F.col("expired")).alias("expired"),
        F.when(~sold_out | (F.col(cmd) == CLOCK), F.col("reply"))
        .when(F.col(cmd) == "request", "Product not available")
        .otherwise(F.lit(unhandled))
        .alias("reply"),
        F.when(~sold_out, F.col("amount")).alias("amount"),
    )
    replies = F.array(
        F.struct(F.lit(0).alias("sub"), F.lit("Timed out").alias("reply"), F.col("expired").alias("amount")),
        F.struct(F.lit(1).alias("sub"), F.col("reply"), F.col("amount")),
    )
    kept = F.filter(
        replies,
        lambda r: F.when(r["sub"] == 0, r["amount"].isNotNull()).otherwise(r["reply"].isNotNull()),
    )
    return settled.select(machine, order, F.inline(kept))


def checkout(df: DataFrame, order: Sequence[str], denied: Column) -> DataFrame:
    """Stage reached by each checkout; dispatched ones get order numbers from 1 in arrival order."""
    marked = df.withColumn("stage", F.when(denied, "denied").otherwise("confirmed"))
    scan = OrderedScan(marked, order).upto(_no=("count", F.when(F.col("stage") == "confirmed", 1)))
    return scan.df.withColumn("order_no", F.when(F.col("stage") == "confirmed", F.col("_no"))).drop("_no")


def transactions(df: DataFrame, order: Sequence[str], account: Column, amount: Column) -> DataFrame:
    """Orders become transactions with dense ids from 0 in arrival order."""
    return with_position(df, order, name="transaction_id").select(
        "transaction_id", account.alias("account"), amount.alias("amount")
    )
