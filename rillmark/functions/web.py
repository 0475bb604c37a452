"""Request expressions: integer path segments, query parameters and first-match routing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def path_int(url: Column) -> Column:
    """The last path segment if it is an integer (a trailing slash is ignored), else null."""
    path = F.try_parse_url(url, F.lit("PATH"))
    return F.regexp_extract(path, r"/([0-9]+)/?$", 1).try_cast("bigint")


def query_int(url: Column, name: str) -> Column:
    return F.try_parse_url(url, F.lit("QUERY"), F.lit(name)).try_cast("bigint")


def first_match(rules: Sequence[tuple[Column, str]], otherwise: str) -> Column:
    """Ordered routing rules: the first one whose condition holds names the outcome."""
    outcome = None
    for condition, result in rules:
        outcome = F.when(condition, result) if outcome is None else outcome.when(condition, result)
    return F.lit(otherwise) if outcome is None else outcome.otherwise(otherwise)
