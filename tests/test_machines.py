"""State machines against plain Python folds on random logs, with light and with heavy keys."""

import random
from collections import deque

import pytest
from pyspark.sql import functions as F

from rillmark.operators import errors, states


@pytest.fixture(params=["light", "heavy"])
def sizes(request, spark):
    if request.param == "heavy":
        spark.conf.set("spark.rillmark.scan.smallBytes", "0")
        spark.conf.set("spark.rillmark.scan.taskRows", "40")
    yield request.param
    spark.conf.unset("spark.rillmark.scan.smallBytes")
    spark.conf.unset("spark.rillmark.scan.taskRows")


def _keys(rng, rows):
    return [0 if rng.random() < 0.4 else rng.randrange(1, 9) for _ in range(rows)]


def test_guarded_balance(spark, sizes):
    rng = random.Random(11)
    log = [(i, k, rng.randrange(-60, 40)) for i, k in enumerate(_keys(rng, 400))]
    balance, expected = {}, {}
    for seq, key, amount in log:
        now = balance.get(key, 0)
        ok = now + amount >= 0
        balance[key] = now + amount if ok else now
        expected[seq] = (ok, balance[key])
    df = spark.createDataFrame(log, "seq long, k long, amount long")
    got = states.guarded_balance(df, ["k"], ["seq"], "amount").collect()
    assert {r["seq"]: (r["accepted"], r["balance"]) for r in got} == expected
    assert any(not ok for ok, _ in expected.values())


@pytest.mark.parametrize("amounts", ["mixed", "equal claims", "falling claims", "rarely covered"])
def test_claims_of_one_key_in_parts(spark, amounts):
    """Parts of five claims each, walked side by side, for logs in which balances meet soon, late or never."""
    rng = random.Random(12)
    draw = {
        "mixed": lambda i: rng.randrange(-60, 40),
        "equal claims": lambda i: rng.choice([-10, -10, 10]) if i else 7,
        "falling claims": lambda i: [64, -64, -32, -16, -8, -4, -2, -1][i % 8] + (i == 0),
        "rarely covered": lambda i: -rng.randrange(1, 10**9) if rng.random() < 0.9 else rng.randrange(10**8),
    }[amounts]
    log = [(i, None if i % 4 == 1 else i % 4 // 2, draw(i)) for i in range(600)]
    balance, expected = {}, {}
    for seq, key, amount in log:
        now = balance.get(key, 0)
        ok = now + amount >= 0
        balance[key] = now + amount if ok else now
        expected[seq] = (ok, balance[key])
    spark.conf.set("spark.rillmark.scan.smallBytes", "0")
    spark.conf.set("spark.rillmark.scan.taskRows", "5")
    try:
        df = spark.createDataFrame(log, "seq long, k long, amount long")
        got = states.guarded_balance(df, ["k"], ["seq"], "amount").collect()
    finally:
        spark.conf.unset("spark.rillmark.scan.smallBytes")
        spark.conf.unset("spark.rillmark.scan.taskRows")
    assert {r["seq"]: (r["accepted"], r["balance"]) for r in got} == expected


def test_a_walk_holds_between_its_bounds():
    rng = random.Random(13)
    for _ in range(200):
        claims, sures = ([rng.randrange(*span) for _ in range(rng.randrange(1, 9))] for span in ((-9, 0), (0, 5)))
        sures = (sures * 9)[: len(claims)]
        walk = states.Walk.of(entry := rng.randrange(20), claims, sures)
        for other in range(40):
            same = states.Walk.of(other, claims, sures)
            holds = walk.low <= other <= walk.high
            assert (same.accepted == walk.accepted) == holds
            assert not holds or same.out - other == walk.out - entry


def _vend(log, price, stock0, timeout, any_restarts):
    """(machine, seq, sub, reply, amount) of a vending machine, row by row."""
    out, machines = [], {}
    for machine, seq, now, cmd, money in log:
        m = machines.setdefault(machine, {"state": "idle", "stock": stock0, "money": 0, "timer": None})
        if m["state"] == "wait" and now - m["timer"] > timeout:
            out.append((machine, seq, 0, "Timed out", m["money"]))
            m["state"] = "op"
        reply = ("Command not found", None) if any_restarts else None
        if m["state"] == "idle":
            reply = ("Not Init", None)
            if cmd == "init":
                m["state"], reply = "op", ("Initialized", None)
        elif m["state"] == "op" and cmd == "request":
            if m["stock"] == 0:
                reply = ("Product not available", None)
            else:
                m.update(state="wait", money=0, timer=now)
                reply = ("Insert", price)
        elif m["state"] == "wait" and cmd == "money":
            m["money"] += money
            if m["money"] >= price:
                m["state"] = "op"
                m["stock"] -= 1
                reply = ("Deliver", m["money"] - price)
            else:
                m["timer"] = now
                reply = ("Insert", price - m["money"])
        elif m["state"] == "wait" and any_restarts:
            m["timer"] = now
        if reply:
            out.append((machine, seq, 1, *reply))
    return sorted(out, key=repr)


@pytest.mark.parametrize("any_restarts", [True, False])
@pytest.mark.parametrize("stock", [0, 4, 1000])
def test_vending_replay(spark, sizes, any_restarts, stock):
    rng, now, log = random.Random(stock), 0, []
    for seq, machine in enumerate(_keys(rng, 400)):
        now += rng.choice([1, 2, 5, 40])
        cmd = rng.choices(["init", "request", "money", "other"], [1, 4, 6, 2])[0]
        log.append((machine, seq, now, cmd, rng.randrange(1, 30)))
    df = spark.createDataFrame(log, "machine long, seq long, ts_us long, cmd string, cents long")
    got = states.vending_replay(df, "machine", "seq", "ts_us", "cmd", "cents", 50, stock, 60, any_restarts)
    rows = [(r["machine"], r["seq"], r["sub"], r["reply"], r["amount"]) for r in got.collect()]
    assert sorted(rows, key=repr) == _vend(log, 50, stock, 60, any_restarts)


def _gate(log):
    """Exact stash: waiting messages go back to the front of the queue at every change of state."""
    released, reads = {}, {}
    by_key = {}
    for row in log:
        by_key.setdefault(row[1], []).append(row)
    for rows in by_key.values():
        is_open, stash, data = False, [], None
        for seq, _, cmd, payload in rows:
            queue = deque([(seq, cmd, payload)])
            while queue:
                s, c, p = queue.popleft()
                if (c == "open") if not is_open else (c == "close"):
                    is_open = not is_open
                    if c == "close":
                        released[s] = seq
                    queue.extendleft(reversed(stash))
                    stash = []
                elif is_open and c in ("read", "write"):
                    released[s] = seq
                    if c == "write":
                        data = p
                    else:
                        reads[s] = data
                else:
                    stash.append((s, c, p))
    return released, reads


def test_hold_until_open(spark, sizes):
    rng = random.Random(3)
    log = [
        (i, k, rng.choices(["open", "close", "read", "write"], [2, 2, 4, 3])[0], rng.randrange(100))
        for i, k in enumerate(_keys(rng, 400))
    ]
    df = spark.createDataFrame(log, "seq long, k long, cmd string, payload long")
    got = states.hold_until_open(df, "k", "seq", "cmd", "payload").collect()
    released, reads = _gate(log)
    assert {r["seq"]: r["released_at"] for r in got if r["released_at"] is not None} == released
    assert {r["seq"]: r["read_value"] for r in got if r["cmd"] == "read" and r["released_at"] is not None} == reads


def test_membership(spark, sizes):
    rng = random.Random(5)
    log = [(i, k, rng.choice(["up", "unreachable", "removed", "joined"])) for i, k in enumerate(_keys(rng, 300))]
    flags = {}
    for _, node, kind in log:
        workers, pending = flags.get(node, (False, False))
        if kind == "up":
            workers, pending = (workers, False) if pending else (True, False)
        elif kind == "unreachable":
            pending = pending or workers
        elif kind == "removed":
            workers = False
        flags[node] = (workers, pending)
    df = spark.createDataFrame(log, "seq long, node long, kind string")
    got = states.membership(df, "node", ["seq"], F.col("kind")).collect()
    assert {r["node"]: (r["registered"], r["pending"]) for r in got} == flags


def test_nesting(spark, sizes):
    rng = random.Random(6)
    log = [(i, k, rng.choice([1, -1, -1, 0])) for i, k in enumerate(_keys(rng, 300))]
    depth, expected = {}, {}
    for seq, key, step in log:
        depth[key] = max(0, depth.get(key, 0) + step)
        expected[seq] = depth[key]
    df = spark.createDataFrame(log, "seq long, k long, step long")
    got = states.nesting(df, ["k"], ["seq"], F.col("step")).collect()
    assert {r["seq"]: r["depth"] for r in got} == expected


@pytest.mark.parametrize("all_for_one", [False, True])
def test_supervised_word_count(spark, sizes, all_for_one):
    rng = random.Random(7)
    texts = ["", "lower", "Tea at noon", "Hi there  ", "Xyz" * 20, "Three more words here"]
    weights = [4, 1, 20, 10, 6, 10]
    log = [(i, k, k % 3, rng.choices(texts, weights)[0]) for i, k in enumerate(_keys(rng, 300))]
    words, stopped, expected = {}, set(), {}
    for seq, key, group, text in log:
        scope = [k for k in range(9) if k % 3 == group] if all_for_one else [key]
        if key in stopped:
            continue
        if text == "":
            words.update(dict.fromkeys(scope, 0))
        elif len(text) > 20:
            pass
        elif not text[0].isupper():
            stopped.update(scope)
        else:
            words[key] = words.get(key, 0) + len(text.rstrip(" ").split(" "))
        expected[seq] = words.get(key, 0)
    df = spark.createDataFrame(log, "seq long, k long, g long, text string")
    group = ["g"] if all_for_one else []
    got = errors.supervised_word_count(df, ["k"], ["seq"], "text", group).collect()
    assert {r["seq"]: r["words"] for r in got} == expected


@pytest.mark.parametrize("survive", [False, True])
def test_escalation(spark, sizes, survive):
    """Supervisors with three children each: a failure that none handles restarts the supervisor."""
    rng = random.Random(8)
    texts = ["", "lower", "Tea at noon", "Xyz" * 20, "Two words", None]
    log = [(i, k, k % 3, rng.choices(texts, [4, 1, 20, 6, 10, 2])[0]) for i, k in enumerate(_keys(rng, 300))]
    words, dead, expected = {}, set(), {}
    for seq, child, boss, text in log:
        if child in dead:
            continue
        siblings = [k for k in range(9) if k % 3 == boss]
        if text is None and survive:
            words.update(dict.fromkeys(siblings, 0))
        elif text is None:
            dead.update(siblings)
        elif text == "":
            words[child] = 0
        elif len(text) <= 20 and text[0].isupper():
            words[child] = words.get(child, 0) + len(text.split(" "))
        elif len(text) <= 20:
            dead.add(child)
        expected[seq] = words.get(child, 0)
    df = spark.createDataFrame(log, "seq long, k long, g long, text string")
    got = errors.supervised_word_count(df, ["k"], ["seq"], "text", supervisor=["g"], children_survive=survive)
    assert {r["seq"]: r["words"] for r in got.collect()} == expected
    assert "escalate" in {r["policy"] for r in got.select("policy").distinct().collect()}


def test_fold_rows_keeps_null_keys_apart(spark):
    from pyspark.sql import types as T

    df = spark.createDataFrame([(None, 1), (None, 2), (1, 3), (1, 4)], "k long, seq long")
    schema = T.StructType([T.StructField(n, T.LongType()) for n in ("k", "seq", "n")])

    def step(state, row):
        state["n"] = state.get("n", 0) + 1
        return (*row, state["n"])

    got = {tuple(r) for r in states.fold_rows(df, ["k"], ["seq"], step, schema).collect()}
    assert got == {(None, 1, 1), (None, 2, 2), (1, 3, 1), (1, 4, 2)}
