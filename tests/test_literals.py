"""Small literal inputs with known results."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillmark.functions import records, text, values, web
from rillmark.operators import calls, errors, flows, states, substreams, tables, timespine
from rillmark.operators.scan import OrderedScan
from rillmark.sources import journal as J


def _values(spark, items):
    return spark.createDataFrame(list(enumerate(items)), "o long, value long")


def _words(spark, items):
    return spark.createDataFrame(list(enumerate(items)), "o long, word string")


def _column(df, name):
    return [r[name] for r in df.collect()]


def test_sums_and_scan(spark):
    assert _column(flows.fold_sum(_values(spark, range(1, 11)), F.col("value")), "value") == [55]
    log = _values(spark, range(1, 6)).withColumn("k", F.lit(0))
    running = OrderedScan(log, ["o"], ["k"]).upto(total=("sum", F.col("value"))).df
    seeded = flows.seeded_scan(running, ["k"], "total", 0).orderBy(F.col("o").asc_nulls_first())
    assert _column(seeded, "total") == [0, 1, 3, 6, 10, 15]


def test_empty_input(spark):
    empty = _values(spark, [1]).where("value < 0")
    assert _column(flows.fold_sum(empty, F.col("value"), zero=7), "value") == [7]
    assert _column(flows.reduce_rows(empty, F.sum("value")), "value") == [None]
    assert _column(flows.head(empty, ["o"], F.col("value")), "value") == [None]
    with pytest.raises(PySparkException, match="reduce of an empty stream"):
        flows.reduce_rows(empty, F.sum("value"), strict=True).collect()
    for sink in (flows.head, flows.last):
        with pytest.raises(PySparkException, match="of an empty stream"):
            sink(empty, ["o"], F.col("value"), strict=True).collect()
    assert flows.batches(empty, ["o"], "value", 10).count() == 0
    assert flows.drop(empty, ["o"], 3).count() == 0


def test_take_drop_head_last(spark):
    df = _values(spark, [10, 20, 30, 40, 50])
    assert _column(flows.take(df, ["o"], 3).orderBy("o"), "value") == [10, 20, 30]
    assert _column(flows.drop(df, ["o"], 3).orderBy("o"), "value") == [40, 50]
    assert flows.drop(df, ["o"], 9).count() == 0
    assert _column(flows.head(df, ["o"], F.col("value")), "value") == [10]
    assert _column(flows.last(df, ["o"], F.col("value")), "value") == [50]


def test_batches_keep_order_and_rest(spark):
    got = {r["batch_id"]: r["items"] for r in flows.batches(_values(spark, range(25)), ["o"], "value", 10).collect()}
    assert got == {0: list(range(10)), 1: list(range(10, 20)), 2: list(range(20, 25))}


def test_word_counts(spark):
    cases = {
        "": 1, " ": 0, "   ": 0, "a": 1, "a b": 2, "a b  ": 2, "  a": 3, "a  b": 3, "a\tb": 1,
        "dogs rule": 2, "i love dogs": 3,
    }
    df = _words(spark, list(cases))
    assert _column(df.select(text.word_count(F.col("word")).alias("n")), "n") == list(cases.values())


def test_sentence_chars(spark):
    # an empty sentence counts one, empty ones at the end nothing
    cases = {"": 1, ". ": 0, ". . ": 0, "ab. cd": 4, "ab. ": 2, "a. . b": 3, ". a": 2, "ab.cd": 5, "a. \n": 2}
    df = _words(spark, list(cases))
    assert _column(df.select(text.sentence_char_count(F.col("word")).alias("n")), "n") == list(cases.values())


def test_first_chars_and_substreams(spark):
    words = _words(spark, ["apple", "lemon", "amber", "stone"])
    counts = substreams.capped_counts(words, text.first_char(F.col("word")), 30)
    assert {r["key"]: r["n"] for r in counts.collect()} == {"a": 2, "l": 1, "s": 1}
    with pytest.raises(PySparkException, match="more than 2 substreams"):
        substreams.capped_counts(words, text.first_char(F.col("word")), 2).collect()
    first = text.first_char(F.col("word"))
    assert _column(_words(spark, ["", "Ab"]).select(first.alias("c")), "c") == ["\0", "a"]


def test_mask_shift(spark):
    words = _words(spark, ["code", "ink", "tab"])
    masked = words.select(text.shift_ascii(F.col("word"), 3).alias("m"))
    assert _column(masked, "m") == ["frgh", "lqn", "wde"]
    wide = _words(spark, ["naïve Ωμέγα 漢字 😀~", "", None])
    there = wide.select("word", text.shift_text("word", F.lit(3)).alias("m"))
    back = there.select("word", "m", text.shift_text("m", F.lit(-3)).alias("b")).collect()
    assert [r["b"] for r in back] == [r["word"] for r in back]
    assert back[0]["m"] == "".join(chr(ord(c) + 3) for c in back[0]["word"])


def test_lower_case_filter_and_replies(spark):
    words = _words(spark, ["maple", "oakTree", "pine", "ELM"])
    assert _column(words.where(text.is_lower(F.col("word"))), "word") == ["maple", "pine"]
    asked = _words(spark, ["river", "tech", "hi", "hi"])
    answers = asked.select(F.explode(text.replies(F.col("word"), F.col("o"))).alias("r"))
    assert _column(answers, "r") == ["RIVER", "scala", "akka", "hi", "hello"]


def test_zip_and_concat(spark):
    three = [range(1, 11), [5] * 10, range(10, 0, -1)]
    a, b, c = (_values(spark, x).withColumnRenamed("value", name) for x, name in zip(three, "abc", strict=True))
    pair = flows.zip_rows(a, ["o"], b.withColumnRenamed("o", "o2"), ["o2"])
    zipped = pair.drop("o", "o2").join(flows.with_position(c, ["o"]), "pos")
    biggest = zipped.select("pos", F.greatest("a", "b", "c").alias("m")).orderBy("pos")
    assert _column(biggest, "m") == [10, 9, 8, 7, 6, 6, 7, 8, 9, 10]
    short = flows.zip_rows(a, ["o"], _values(spark, [1, 2]).withColumnRenamed("o", "p"), ["p"])
    assert short.count() == 2
    joined = flows.concat([(_values(spark, range(1, 11)), ["o"]), (_values(spark, range(42, 53)), ["o"])])
    result = _column(joined.orderBy("pos").select(((F.col("value") + 1) * 2).alias("v")), "v")
    assert result == [*range(4, 23, 2), *range(86, 107, 2)] and len(result) == 21


def test_merge_preferred_and_balance(spark):
    left, right = _values(spark, [1, 2]), _values(spark, [10, 20, 30])
    merged = flows.merge_preferred((left, ["o"]), (right, ["o"])).orderBy("emit_pos")
    assert _column(merged, "value") == [1, 10, 2, 20, 30]
    assert _column(merged, "emit_pos") == [0, 1, 2, 3, 4]
    lanes = flows.balance(_values(spark, range(7)), ["o"], 3).orderBy("o")
    assert [(r["lane"], r["lane_n"]) for r in lanes.collect()] == [(0, 1), (1, 1), (2, 1), (0, 2), (1, 2), (2, 2), (0, 3)]


def test_flat_map(spark):
    flat = substreams.flat_map_range(_values(spark, range(1, 6)), F.col("value").alias("x"), ordered=True)
    got = flat.toDF("o", "x", "place", "v").orderBy("o", "place")
    assert _column(got, "v") == [v for x in range(1, 6) for v in range(x, 3 * x + 1)] and got.count() == 35


def test_suspicious_and_payments(spark):
    amounts = _values(spark, [200, 11000, 7000])
    everything, suspicious = flows.tee(amounts, lambda d: d, lambda d: d.where("value > 10000").select("o"))
    assert everything.count() == 3 and _column(suspicious, "o") == [1]
    cards = _words(spark, ["1234", "1234-1234-1234-1234", "0000"])
    assert _column(cards.select(values.payment_status(F.col("word")).alias("s")), "s") == ["OK", "Forbidden", "OK"]
    assert _column(cards.select(values.card_denied(F.col("word")).alias("d")), "d") == [False, False, True]


def test_error_policies(spark):
    ten, bad = _values(spark, range(1, 11)), F.col("value") == 6
    minimum = spark.createDataFrame([(99, -2147483648)], "o long, value long")
    assert _column(errors.recover(ten, ["o"], bad, minimum).orderBy("o"), "value") == [1, 2, 3, 4, 5, -2147483648]
    other = spark.createDataFrame([(100 + i, 90 + i) for i in range(10)], "o long, value long")
    assert _column(errors.recover(ten, ["o"], bad, other).orderBy("o"), "value") == [*range(1, 6), *range(90, 100)]
    assert errors.recover(ten, ["o"], F.col("value") == 77, other).count() == 10
    good, rejected = errors.resume(_values(spark, range(1, 21)), F.col("value") == 13)
    assert good.count() == 19 and _column(rejected, "value") == [13]
    with pytest.raises(PySparkException, match="thirteen"):
        errors.stop(_values(spark, [1, 5, 13]), F.col("value") == 13, "thirteen").collect()
    cleared = errors.restart_sum(
        _values(spark, [1, 2, 6, 3, 4]).withColumn("k", F.lit(1)), ["k"], ["o"], bad, F.col("value")
    )
    assert _column(cleared.orderBy("o"), "total") == [1, 3, 3, 7]


def test_conflate_and_sessions(spark):
    rows = [(0, "disk full", 1), (1, "fan stopped", 1), (2, "link down", 1), (3, "door open", 2)]
    events = spark.createDataFrame(rows, "o long, d string, burst int")
    got = timespine.conflate(events, [F.col("burst")], ["o"], F.lit(1), F.col("d")).orderBy("burst").collect()
    assert [(r["n_instances"], r["description"]) for r in got] == [(3, "You have 3 events"), (1, "door open")]
    log = spark.createDataFrame([(0, 0), (1, 10), (2, 20), (3, 31)], "o long, ts_us long").withColumn("k", F.lit(0))
    found = timespine.sessions(log, ["k"], "ts_us", ["o"], 10).orderBy("start_us").collect()
    assert [(r["start_us"], r["last_us"], r["n_events"]) for r in found] == [(0, 20, 3), (31, 31, 1)]


def test_tick_fill(spark):
    log = spark.createDataFrame([(0, 0, 1, 5), (0, 1, 2, 6), (0, 2, 40, 9)], "k long, o long, ts_us long, v long")
    got = timespine.fill_ticks(log, ["k"], "ts_us", ["o"], "v", 10).orderBy("tick_us").collect()
    assert [(r["tick_us"], r["value"], r["counted"], r["is_filled"]) for r in got] == [
        (0, 6, 6, False), (10, 6, 6, True), (20, 6, 7, True), (30, 6, 8, True), (40, 9, 9, False)
    ]


def test_tickets_first_come_within_class(spark):
    tickets = _words(spark, ["[P3] sort the shelf", "[P0] mend the pump", "water the fern", "[P1] paint the gate", "[P0] stop the leak"])
    done = flows.process_order(tickets, values.ticket_class(F.col("word")), ["o"], 5).orderBy("process_pos")
    assert _column(done, "o") == [1, 4, 3, 0, 2] and _column(done, "process_pos") == [0, 1, 2, 3, 4]


def test_account_statement(spark):
    log = spark.createDataFrame([(0, 1, 1000), (1, 1, -200)], "seq long, k long, amount long")
    assert _column(states.guarded_balance(log, ["k"], ["seq"], "amount").orderBy("seq"), "balance") == [1000, 800]


@pytest.mark.parametrize("any_restarts", [True, False])
def test_vending_scripts(spark, any_restarts):
    """Time in seconds, timeout one second; the trailing message at 10 s lets an open wait expire."""

    def run(*script, stock=19, as_of=None):
        rows = [(1, i, t, cmd, money) for i, (t, cmd, money) in enumerate(script)]
        log = spark.createDataFrame(rows, "machine long, seq long, ts_us long, cmd string, cents long")
        got = states.vending_replay(log, "machine", "seq", "ts_us", "cmd", "cents", 5, stock, 1, any_restarts, as_of)
        return [(r["reply"], r["amount"]) for r in got.orderBy("seq", "sub").collect()]

    ready = ("Initialized", None)
    assert run((0, "request", 0)) == [("Not Init", None)]
    assert run((0, "init", 0), (0, "request", 0), stock=0) == [ready, ("Product not available", None)]
    assert run((0, "init", 0), (0, "request", 0), (0, "money", 1), (10, "request", 0)) == [
        ready, ("Insert", 5), ("Insert", 4), ("Timed out", 1), ("Insert", 5)
    ]
    assert run((0, "init", 0), (0, "request", 0), (0, "money", 1), as_of=1) == [ready, ("Insert", 5), ("Insert", 4)]
    assert run((0, "init", 0), (0, "request", 0), (0, "money", 1), as_of=2) == [
        ready, ("Insert", 5), ("Insert", 4), ("Timed out", 1)
    ]
    assert run((0, "request", 0), as_of=9) == [("Not Init", None)]
    assert run((0, "init", 0), (0, "request", 0), (0, "money", 6), (0, "request", 0)) == [
        ready, ("Insert", 5), ("Deliver", 1), ("Insert", 5)
    ]


def test_stash_script(spark):
    script = [("read", None), ("open", None), ("open", None), ("write", 42), ("close", None), ("read", None)]
    log = spark.createDataFrame([(i, 1, c, p) for i, (c, p) in enumerate(script)], "seq long, k long, cmd string, p long")
    got = {r["seq"]: (r["released_at"], r["read_value"]) for r in states.hold_until_open(log, "k", "seq", "cmd", "p").collect()}
    assert got == {0: (1, None), 3: (3, None), 4: (4, None), 5: (5, 42)}


def test_supervision_scripts(spark):
    def run(rows, **options):
        log = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "seq long, child string, g long, text string")
        out = errors.supervised_word_count(log, ["child"], ["seq"], "text", **options).orderBy("seq")
        return [(r["child"], r["words"]) for r in out.collect()]

    assert run([("c", 1, "We bake bread"), ("c", 1, "Loaf" * 40)]) == [("c", 3), ("c", 3)]
    assert run([("c", 1, "We bake bread"), ("c", 1, "")]) == [("c", 3), ("c", 0)]
    assert run([("c", 1, "bread"), ("c", 1, "We eat it")]) == [("c", 0)]
    rows = [("c2", 1, "Good rye"), ("c1", 1, ""), ("c2", 1, "Loaf" * 40)]
    assert run(rows, group=["g"]) == [("c2", 2), ("c1", 0), ("c2", 0)]


def test_votes(spark):
    names = ["Ada", "Bruno", "Chen", "Dora"]
    rows = [(0, 1, 17, "Ada"), (1, 1, 20, "Elsewhere"), (2, 1, 20, "Ada"), (3, 1, 17, "Elsewhere"), (4, 2, 18, "Bruno")]
    log = spark.createDataFrame(rows, "seq long, person long, age long, candidate string")
    got = states.validate_votes(
        log, "person", ["seq"], F.col("age"), F.col("candidate"), names, F.lit(False)
    ).orderBy("seq")
    assert _column(got, "outcome") == ["Too young", "Invalid candidate", "Accepted", "Already voted", "Accepted"]


def test_authentication(spark):
    rows = [(0, "asiya", "authenticate", "hi"), (1, "asiya", "register", "hi"), (2, "asiya", "authenticate", "bad"),
            (3, "asiya", "authenticate", "hi")]
    log = spark.createDataFrame(rows, "seq long, user string, kind string, pw string")
    got = tables.authenticate(log, "user", ["seq"], F.col("kind"), "pw").orderBy("seq")
    assert _column(got, "outcome") == ["user not found", "wrong pw", "success"]


def test_keyed_tables(spark):
    stock = spark.createDataFrame([(1, 0), (2, 5)], "id long, q long")
    added = tables.add_quantity(stock, spark.createDataFrame([(1, 2), (1, 3), (9, 1)], "id long, q long"), "id", "q")
    assert {r["id"]: (r["q"], r["status"]) for r in added.collect()} == {
        1: (5, "AddSuccess"), 2: (5, "Unchanged"), 9: (None, "AddFail")
    }
    changes = spark.createDataFrame([(0, 2, 7), (1, 3, 8), (2, 2, 9)], "seq long, id long, q long")
    assert {tuple(r) for r in tables.upsert(stock, changes, ["id"], ["seq"]).collect()} == {(1, 0), (2, 9), (3, 8)}
    assert _column(tables.delete(stock, changes.select("id"), ["id"]), "id") == [1]
    books = spark.createDataFrame([(0, 1, "Ann"), (1, 3, "Bob"), (2, 3, "Eve")], "n long, id long, author string")
    found = tables.first(books, ["id"], ["n"]).where("id = 3")
    assert _column(found, "author") == ["Bob"]


def test_records_and_json(spark):
    encoded = spark.createDataFrame([(0, "user_0@gmail.com", "user_0")], "id long, email string, name string").select(
        records.encode_record(F.col("id"), F.col("email"), F.col("name")).alias("raw")
    )
    assert _column(encoded, "raw") == ["[0//user_0@gmail.com//user_0]"]
    more = spark.createDataFrame([("[x//a//b]",), ("[1//a]",), ("",)], "raw string")
    good, bad = records.decode_users(encoded.union(more), "raw")
    assert [tuple(r) for r in good.collect()] == [(0, "user_0@gmail.com", "user_0")]
    assert [r["reason"] for r in bad.collect()] == ["id is not an integer", "too few fields", "too few fields"]
    docs = spark.createDataFrame([('{"make":"a"}',), ('{"make":',)], "doc string")
    schema = T.StructType([T.StructField("make", T.StringType()), T.StructField("quantity", T.LongType())])
    parsed = records.read_json(docs, "doc", schema).collect()
    assert [(r["make"], r["quantity"], r["bad_json"]) for r in parsed] == [("a", None, None), (None, None, '{"make":')]


def test_urls(spark):
    urls = ["http://h/api/item/42", "http://h/api/item?page=7", "http://h/api/x.html", "not a url", "http://h/9/?page=z"]
    got = spark.createDataFrame([(u,) for u in urls], "url string").select(
        web.path_int(F.col("url")).alias("p"), web.query_int(F.col("url"), "page").alias("q")
    )
    assert [tuple(r) for r in got.collect()] == [(42, None), (None, 7), (None, None), (None, None), (9, None)]


def test_invoices(spark):
    got = J.invoice_events(_values(spark, [2000]), ["o"], F.col("value")).orderBy("sub").collect()
    assert [(r["kind"], r["event_amount"]) for r in got] == [
        ("TaxRecord", 666), ("InvoiceRecord", 2000), ("Certified tax", None), ("Certified invoice", None)
    ]


def test_calls(spark):
    numbers = _values(spark, [4, 0, 5]).coalesce(1)
    doubled = calls.async_call(numbers, lambda x: x * 2, "value", "twice", T.LongType(), 2)
    assert _column(doubled, "twice") == [8, 0, 10]
    with pytest.raises(PySparkException, match="division"):
        calls.async_call(numbers, lambda x: 1 // x, "value", "r", T.LongType()).collect()
    answers = calls.keyed_call(numbers, lambda x: str(20 // x), "o", "value").collect()
    assert [(r["o"], r["ok"], r["result"]) for r in answers] == [(0, True, "5"), (1, False, None), (2, True, "4")]
    assert "zero" in answers[1]["error"]


def test_count_tap(spark):
    tapped, tap = flows.count_tap(_values(spark, range(10)))
    tapped.write.format("noop").mode("overwrite").save()
    assert tap.get["n"] == 10


def test_the_shift_holds_few_texts_at_once():
    """Beside the Arrow batch Python holds some texts, not all of them."""
    import tracemalloc

    import pyarrow as pa

    texts = pa.array(["w\u00f6rds " * 2000] * 1000)
    tracemalloc.start()
    shifted = text.shift_text.func(texts, pa.array([3] * len(texts), pa.int32()))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert shifted[0].as_py()[:3] == "z\u00f9u" and peak < 6_000_000
