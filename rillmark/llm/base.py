"""What the operators of this package share: folds, stored tables and free column names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rillmark.session import scratch


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fold(doc_id: str, folds: int) -> Column:
    """``crc32(doc_id as text) mod folds``; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), F.lit(folds))


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The rows written as Parquet to the shared scratch folder and read back: cuts the lineage."""
    spark = df.sparkSession
    path = scratch(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, wish: str) -> str:
    """A column name that the frame does not have yet, in any case."""
    taken = {name.lower() for name in df.columns}
    while wish.lower() in taken:
        wish = f"_{wish}"
    return wish


# lower-cased bytes of words; everything else becomes a blank
_WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)


def word_bytes(text: bytes) -> list[bytes]:
    """Runs of ASCII letters (lower-cased) and digits and of non-ASCII characters."""
    return text.translate(_WORD_BYTES).split()


def labelled_sample(
    docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str, rows: int, most_bytes: int
) -> tuple[dict[int, list[tuple[str, bytes]]], tuple[int, int]]:
    """A bounded sample of labelled rows of folds other than 2 of 4, and the number of all of each label.

    Per label 0 and 1 the ``rows`` ids with the smallest MD5, as (id as text, text), texts whole; ids may have any type.  Where they have more
    than ``most_bytes``, the longest texts are left out, no more than need be, and the next ids with texts
    no longer than those that stay take their places.  An id with several labels has the largest.
    """
    known = labels.where(F.col(doc_id).isNotNull() & F.col(label).isin(0, 1) & (fold(doc_id, 4) != 2))
    # ids compare as text, as the folds take them
    known = known.groupBy(F.col(doc_id).cast("string").alias("id")).agg(F.max(label).cast("int").alias("label"))
    totals = {r.label: r.n for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    order = F.md5("id")
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    bodies = docs.select(F.col(doc_id).cast("string").alias("id"), body.alias("body"))

    def first(ids: DataFrame, values: list[int]) -> DataFrame:
        chosen = ids.where("false")
        for value in values:
            chosen = chosen.unionAll(ids.where(F.col("label") == value).orderBy(order, "id").limit(rows))
        # a bounded list, 2 * rows ids, that every task may hold
        listed = [(r.id, r.label) for r in chosen.collect()]
        return docs.sparkSession.createDataFrame(listed, "id string, label int")

    def texts(ids: DataFrame, among: DataFrame) -> DataFrame:
        found = stored(among.join(F.broadcast(ids), "id"), "labelled-sample")
        # one text per id; the sum runs from the shortest text on, so that a long one costs no other its place
        place = Window.partitionBy("label").orderBy("size", "order", "id").rowsBetween(Window.unboundedPreceding, 0)
        one = found.groupBy("id", "label").agg(F.min("body").alias("body"))
        sized = one.withColumn("order", order).withColumn("size", F.octet_length("body").cast("bigint"))
        return sized.withColumn("fits", F.sum("size").over(place) <= most_bytes)

    sample = texts(first(known, [0, 1]), bodies)
    longest = F.max(F.when(F.col("fits"), F.col("size")))
    over = sample.groupBy("label").agg(F.every("fits").alias("all"), longest.alias("longest")).where("not all").collect()
    for r in over:
        shorter = bodies.where(F.octet_length("body") <= (most_bytes if r.longest is None else r.longest))
        ids = first(known.join(shorter.select("id"), "id", "left_semi"), [r.label])
        sample = sample.where(F.col("label") != r.label).unionAll(texts(ids, shorter))
    held: dict[int, list[tuple[str, bytes]]] = {0: [], 1: []}
    for r in sample.where("fits").orderBy("order", "id").toLocalIterator():
        held[r.label].append((r.id, r.body.encode()))
    return held, (totals.get(0, 0), totals.get(1, 0))
