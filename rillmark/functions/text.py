"""Text expressions, all JVM-side except the full-Unicode shift."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def word_count(text: Column) -> Column:
    """Pieces of a split on one space, not counting empty pieces at the end; ``""`` counts one."""
    kept = F.rtrim(text)
    spaces = F.length(kept) - F.length(F.replace(kept, F.lit(" "), F.lit("")))
    return (
        F.when(text == "", F.lit(1))
        .when(kept == "", F.lit(0))
        .otherwise(spaces + 1)
        .cast("bigint")
    )


def sentence_char_count(text: Column) -> Column:
    """Characters of all sentences of a text; an empty sentence counts one, empty ones at the end none."""
    kept = F.when(text.endswith(". "), F.regexp_replace(text, r"(\. )+\z", "")).otherwise(text)
    sentences = F.split(kept, r"\. ", -1)
    chars = F.aggregate(
        sentences, F.lit(0).cast("bigint"), lambda n, s: n + F.greatest(F.length(s), F.lit(1))
    )
    return (
        F.when((kept == "") & (text != ""), F.lit(0).cast("bigint"))
        .when(~kept.contains(". "), F.greatest(F.length(kept), F.lit(1)).cast("bigint"))
        .otherwise(chars)
    )


def first_char(text: Column) -> Column:
    """Lower-cased first character, the NUL character for empty text."""
    return F.when(text == "", F.lit("\0")).otherwise(F.lower(F.substring(text, 1, 1)))


def is_lower(text: Column) -> Column:
    return text == F.lower(text)


def repeat_self(text: Column) -> Column:
    return F.concat(text, text)


# fixed values
TWO_REPLIES = {"tech": ("scala", "akka")}
ONE_OF_REPLIES = {"hi": ("hi", "hello")}


def replies(word: Column, draw: Column) -> Column:
    """All replies to a word: some words get two, some one of two, any other its upper case.

    ``draw`` is any whole number of the row; it stands for the coin and keeps reruns equal.
    """
    answer = F.array(F.upper(word))
    for known, texts in TWO_REPLIES.items():
        answer = F.when(word == known, F.array(*map(F.lit, texts))).otherwise(answer)
    for known, texts in ONE_OF_REPLIES.items():
        one = F.get(F.array(*map(F.lit, texts)), F.pmod(draw, F.lit(len(texts))))
        answer = F.when(word == known, F.array(one)).otherwise(answer)
    return answer


_PRINTABLE = "".join(map(chr, range(32, 127)))


def shift_ascii(text: Column, by: int) -> Column:
    """Shift printable ASCII by ``by`` code points (no wrap-around).  ``unshift_ascii`` undoes it."""
    return F.translate(text, _PRINTABLE, "".join(chr(ord(c) + by) for c in _PRINTABLE))


def unshift_ascii(text: Column, by: int) -> Column:
    return F.translate(text, "".join(chr(ord(c) + by) for c in _PRINTABLE), _PRINTABLE)


# texts shifted at once: what Python holds beside the Arrow batch
TEXTS = 64


@F.arrow_udf(T.StringType())
def shift_text(text: pa.Array, by: pa.Array) -> pa.Array:
    """Shift every character of any text.  ``chr`` in SQL stops at 255, so this one is an Arrow UDF."""

    def shift(t: str, n: int) -> str:
        points = np.frombuffer(t.encode("utf-32-le"), dtype="<u4")
        return (points.astype("<i8") + n).astype("<u4").tobytes().decode("utf-32-le")

    parts = [pa.array([], pa.string())]
    for at in range(0, len(text), TEXTS):
        pairs = zip(text.slice(at, TEXTS), by.slice(at, TEXTS), strict=True)
        parts.append(pa.array([shift(t.as_py(), n.as_py()) if t.is_valid else None for t, n in pairs], pa.string()))
    return pa.concat_arrays(parts)
