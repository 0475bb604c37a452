import hashlib

from pyspark.sql import functions as F

from rillmark.llm import linededup
from tests.llm.helpers import awkward, rows

SCHEMA = "doc_id bigint, text string"


def plain(docs):
    """Kept texts by walking over all windows in order."""
    seen, out = {}, []
    known = sorted({(d is None, d or 0, hashlib.md5(t.encode()).hexdigest(), t) for d, t in docs if t is not None})
    kept = {}
    for null, d, _, text in known:
        lines = text.split("\n")
        full = [(i, x.strip(" \t\r")) for i, x in enumerate(lines) if x.strip(" \t\r")]
        gone = set()
        for i in range(max(len(full) - 3, 0) + 1 if full else 0):
            part = full[i : i + 3]
            if seen.setdefault(tuple(x for _, x in part), (null, d, text, i)) != (null, d, text, i):
                gone.update(range(part[0][0], part[-1][0] + 1))
        kept[null, d, text] = "\n".join(x for i, x in enumerate(lines) if i not in gone)
    for d, t in docs:
        out.append((d, None if t is None else kept[d is None, d or 0, t]))
    return sorted(out, key=repr)


CASES = [
    (1, "a\nb\nc\nd"),
    (2, "x\na\nb\nc\ny"),
    (3, "a\nb\nc\nd\ne"),
    (4, "a\nb"),
    (5, "q\nq\nq\nq\nq\nq"),
    (6, " a \n\n b\t\n\nc\r\nz"),
    (7, "one"),
    (8, "one"),
    (8, "one"),
    (9, "one\ntwo"),
    (None, "b\nc\nd"),
    (None, "b\nc\nd"),
    (10, None),
    (11, ""),
    (12, "\n\n\n"),
    (13, "p\nb\nc\nd\nq\nr\nb\nc\nd\n"),
]


def test_cases(spark):
    docs = spark.createDataFrame(CASES, SCHEMA)
    assert rows(linededup.dedup(docs)) == plain(CASES)


def test_random_lines(spark):
    import random

    draw = random.Random(5)
    docs = [(i, "\n".join(draw.choice("abc ") for _ in range(draw.randrange(12)))) for i in range(300)]
    assert rows(linededup.dedup(spark.createDataFrame(docs, SCHEMA))) == plain(docs)


def test_awkward_rows_and_columns_stay(spark):
    docs = awkward(spark, "covered_lines", "text_print", "hash", "doc", "print")
    done = linededup.dedup(docs)
    assert done.columns == docs.columns and done.count() == docs.count()
    assert rows(done.select("doc_id", "text")) == plain([(r.doc_id, r.text) for r in docs.collect()])
    assert linededup.dedup(docs.limit(0)).collect() == []


def test_many_lines(spark):
    long = "\n".join(f"line {i % 50_000}" for i in range(100_000))
    docs = spark.createDataFrame([(1, long)], SCHEMA)
    kept = linededup.dedup(docs).select(F.size(F.split("text", "\n"))).first()[0]
    assert kept == 50_000
