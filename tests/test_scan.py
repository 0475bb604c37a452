import random

from pyspark.sql import functions as F

from rillmark.operators.scan import OrderedScan, with_position


def _log(spark, hot_share=0.4, rows=300, seed=5):
    rng = random.Random(seed)
    data = []
    for seq in range(rows):
        key = None if seq % 50 == 9 else (0 if rng.random() < hot_share else rng.randrange(1, 30))
        data.append((seq * 3, key, rng.randrange(-9, 9), rng.choice([None, "a", "b", "c"])))
    rng.shuffle(data)
    return data, spark.createDataFrame(data, "seq long, k long, x long, tag string")


def _expected(data, keyed):
    state, out = {}, {}
    for seq, key, x, tag in sorted(data):
        k = key if keyed else 0
        s = state.setdefault(k, dict(sum=0, n=0, low=None, last=None, prev=None))
        prev = s["prev"]
        s["sum"] += x
        s["n"] += 1
        s["low"] = x if s["low"] is None else min(s["low"], x)
        s["last"] = tag if tag is not None else s["last"]
        s["prev"] = seq
        out[seq] = (s["sum"], s["n"], s["low"], s["last"], prev)
    return out


def _run(df, keys):
    scan = OrderedScan(df, ["seq"], keys)
    scan = scan.upto(
        total=("sum", F.col("x")), n=("count", F.lit(1)), low=("min", F.col("x")), tag_now=("last", F.col("tag"))
    ).before(prev=("last", F.col("seq")))
    return {r["seq"]: (r["total"], r["n"], r["low"], r["tag_now"], r["prev"]) for r in scan.df.collect()}


def test_keyed_and_global_scan_small(spark):
    data, df = _log(spark)
    assert _run(df, ["k"]) == _expected(data, True)
    assert _run(df, []) == _expected(data, False)


def test_keyed_and_global_scan_in_chunks(spark, cut_chunks):
    data, df = _log(spark)
    assert _run(df, ["k"]) == _expected(data, True)
    assert _run(df, []) == _expected(data, False)


def test_heavy_key_is_cut(spark, cut_chunks):
    _, df = _log(spark)
    scan = OrderedScan(df, ["seq"], ["k"])
    assert (0,) in {tuple(r) for r in scan.layout.heavy.collect()}
    sizes = scan._heavy.groupBy("k", "_chunk").count().collect()
    assert max(r["count"] for r in sizes) < 30
    assert len({r["_chunk"] for r in sizes if r["k"] == 0}) > 5


def test_light_keys_stay_whole(spark):
    _, df = _log(spark)
    spark.conf.set("spark.rillmark.scan.smallBytes", "0")
    try:
        assert OrderedScan(df, ["seq"], ["k"]).layout is None
    finally:
        spark.conf.unset("spark.rillmark.scan.smallBytes")


def test_position(spark, cut_chunks):
    data, df = _log(spark)
    got = {r["seq"]: r["pos"] for r in with_position(df, ["seq"]).collect()}
    assert got == {row[0]: i for i, row in enumerate(sorted(data))}


def test_string_orders_and_several_keys_in_chunks(spark, cut_chunks):
    """Orders and keys of any type, null among the keys, and light keys that a chunk ends within."""
    data, df = _log(spark)
    named = df.select(F.concat(F.lit("n"), F.lpad(F.col("seq").cast("string"), 6, "0")).alias("name"), "seq", "k", "x", "tag")
    named = named.withColumns({"a": F.concat(F.lit("key "), F.col("k").cast("string")), "b": F.col("k") % 2 == 0})
    scan = OrderedScan(named, ["name"], ["a", "b"])
    assert scan.layout is not None
    got = scan.upto(total=("sum", F.col("x")), n=("count", F.lit(1)), low=("min", F.col("x")), tag_now=("last", F.col("tag")))
    got = got.before(prev=("last", F.col("seq")))
    assert {r["seq"]: (r["total"], r["n"], r["low"], r["tag_now"], r["prev"]) for r in got.df.collect()} == _expected(data, True)
    placed = with_position(named, ["name"])
    assert {r["seq"]: r["pos"] for r in placed.collect()} == {row[0]: i for i, row in enumerate(sorted(data))}


def test_estimates_are_not_trusted_after_an_explode(spark):
    from rillmark.operators.scan import is_small
    from rillmark.session import multiplies_rows, scratch

    path = scratch(spark, "small")
    spark.range(10).write.parquet(path)
    small = spark.read.parquet(path)
    assert is_small(small) and is_small(small.where("id > 3").withColumn("x", F.col("id") * 2))
    many = small.select("id", F.explode(F.sequence(F.lit(1), F.lit(1000))).alias("i"))
    assert multiplies_rows(many) and not is_small(many)
    assert multiplies_rows(small.join(small.withColumnRenamed("id", "j"))) and multiplies_rows(small.mapInArrow(lambda b: b, small.schema))


def test_no_task_holds_a_log_that_compresses_well(spark):
    """Two million rows are a few megabytes of file: they are cut into chunks, of which a task folds one or two."""
    from rillmark.session import scratch

    path = scratch(spark, "narrow")
    spark.range(2_000_000).repartitionByRange(1, "id").write.parquet(path)
    placed = OrderedScan(spark.read.parquet(path), ["id"]).upto(n=("count", F.lit(1)))
    assert placed.layout is not None and placed.layout.chunks >= 4
    in_task = placed._heavy.groupBy(F.spark_partition_id().alias("task")).count()
    assert in_task.agg(F.max("count")).first()[0] < 1_500_000
    assert placed.df.where("n <> id + 1").count() == 0 and placed.df.count() == 2_000_000
