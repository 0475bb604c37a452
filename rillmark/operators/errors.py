"""Error policies over ordered logs: what happens to rows at and after a bad one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillmark.functions.text import word_count
from rillmark.operators.scan import OrderedScan, union_all


def _first_bad(df: DataFrame, order: Sequence[str], bad: Column) -> Column:
    return df.where(bad).agg(F.min(F.struct(*order))).scalar()


def recover(df: DataFrame, order: Sequence[str], bad: Column, substitute: DataFrame) -> DataFrame:
    """Rows before the first bad one, then the substitute rows if there was a bad one."""
    cut = _first_bad(df, order, bad)
    return union_all(
        [df.where(cut.isNull() | (F.struct(*order) < cut)), substitute.where(cut.isNotNull())]
    )


def resume(df: DataFrame, bad: Column) -> tuple[DataFrame, DataFrame]:
    """(good rows, quarantined rows); an undecided (null) check counts as bad."""
    is_bad = F.coalesce(bad, F.lit(True))
    return df.where(~is_bad), df.where(is_bad)


def stop(df: DataFrame, bad: Column, message: str) -> DataFrame:
    """The same rows, but the whole run fails when one is bad."""
    return df.where(F.when(bad, F.raise_error(F.lit(message))).otherwise(F.lit(True)))


def restart_sum(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], bad: Column, value: Column
) -> DataFrame:
    """Running sum that a bad row clears; bad rows themselves are dropped.

    The sum since the last reset is the running sum minus its value at that reset.
    """
    scan = OrderedScan(df.withColumn("_bad", bad), order, keys)
    scan = scan.upto(_total=("sum", F.when(~F.col("_bad"), value)))
    scan = scan.upto(_base=("last", F.when(F.col("_bad"), F.col("_total"))))
    total = F.col("_total") - F.coalesce("_base", F.lit(0))
    return scan.df.where(~F.col("_bad")).withColumn("total", total).drop("_bad", "_total", "_base")


MAX_TEXT = 20


def text_policy(text: Column) -> Column:
    """The five outcomes of a fussy word counter, checked in this order; null stands for what is no text."""
    first = F.substring(text, 1, 1)
    upper = (first == F.upper(first)) & (first != F.lower(first))
    return (
        F.when(text.isNull(), "escalate")
        .when(text == "", "reset")
        .when(F.length(text) > MAX_TEXT, "skip")
        .when(~upper, "stop")
        .otherwise("ok")
    )


def supervised_word_count(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    text: str,
    group: Sequence[str] = (),
    supervisor: Sequence[str] = (),
    children_survive: bool = False,
) -> DataFrame:
    """Running word count per key under the policy above, as ``words`` on every row that is handled.

    With ``group`` a reset or a stop of any member hits all members of the group.  Rows after a stop
    are not handled.  Closed form: words so far minus words at the latest reset.

    With ``supervisor`` a row that escalates restarts the supervisor of its key: that stops all children, or resets
    them if ``children_survive``; children that had stopped stay so, and cannot escalate.  Without it such rows are
    skipped.  The two levels compose: rows of stopped children go first, then escalations are counted per
    supervisor, and each count is an epoch in which a child starts from zero.
    """
    rows = df.withColumn("policy", text_policy(F.col(text))).withColumn(
        "_words", F.when(F.col("policy") == "ok", word_count(F.col(text))).otherwise(F.lit(0))
    )
    is_stop, is_reset, rises = (F.col("policy") == kind for kind in ("stop", "reset", "escalate"))
    # nothing counts once a stop was seen, so resets and words can be folded along with the stops
    stops = {"_stopped": ("count", F.when(is_stop, 1))}
    if group:
        cuts = OrderedScan(rows, order, group)
        cuts = cuts.fold(upto={"_reset_no": ("count", F.when(is_reset, 1))}, before=stops)
        live = cuts.where(F.col("_stopped") == 0).table()
        scan = OrderedScan(live, order, [*keys, "_reset_no"]).upto(words=("sum", F.col("_words")))
        return scan.df.drop("_words", "_reset_no", "_stopped")
    epoch = []
    if supervisor:
        alive = OrderedScan(rows, order, keys).fold(before=stops).where(F.col("_stopped") == 0).table().drop("_stopped")
        risen = {"_epoch": ("count", F.when(rises, 1))}
        above = OrderedScan(alive, order, supervisor)
        if children_survive:
            rows, epoch = above.upto(**risen).table(), ["_epoch"]
        else:
            rows = above.before(**risen).where(F.col("_epoch") == 0).table().drop("_epoch")
    scan = OrderedScan(rows, order, [*keys, *epoch]).fold(upto={"_all": ("sum", F.col("_words"))}, before=stops)
    scan = scan.upto(_base=("last", F.when(is_reset, F.col("_all")))).where(F.col("_stopped") == 0)
    words = F.col("_all") - F.coalesce("_base", F.lit(0))
    return scan.df.withColumn("words", words).drop("_words", "_all", "_base", "_stopped", *epoch)
