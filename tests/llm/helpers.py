"""Frames of awkward documents and plain reference folds for the tests of this folder."""

from __future__ import annotations

AWKWARD = [
    (1, "Plain words stand here, one after another, in a row.", "en", "a"),
    (2, None, "en", "a"),
    (3, "", None, None),
    (4, " \n\t ", "de", "b"),
    (5, "word " * 30_000, "en", "a"),
    (6, "Plain words stand here, one after another, in a row.", "en", "b"),
    (6, "Plain words stand here, one after another, in a row.", "en", "b"),
    (None, "a text without an id", None, "c"),
    (7, "é ß 😀 ñ\nzweite Zeile\n\nthird", "de", "b"),
]
SCHEMA = "doc_id bigint, text string, lang string, source string"


def awkward(spark, *clashing: str):
    """The awkward documents; ``clashing`` adds columns with names that results use."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(AWKWARD, SCHEMA)
    return df.withColumns({name: F.lit("clash") for name in clashing})


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def components(n: int, pairs) -> list[int]:
    """Smallest index reachable, for each index."""
    root = list(range(n))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]
