"""Record codecs: bracketed text records and JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def encode_record(*fields: Column) -> Column:
    """``[a//b//c]``"""
    return F.concat(F.lit("["), F.concat_ws("//", *[f.cast("string") for f in fields]), F.lit("]"))


def decode_users(df: DataFrame, raw: str) -> tuple[DataFrame, DataFrame]:
    """Decode ``[id//email//name]``; returns (good rows, quarantined rows with a reason).

    The first and the last character are dropped unseen, surplus fields are ignored; a short record
    or an id that is not an integer goes to quarantine instead of failing the job.
    """
    inner = F.substring(F.col(raw), F.lit(2), F.length(raw) - 2)
    parts = df.withColumn("_parts", F.split(inner, "//", -1)).withColumn(
        "_id", F.get("_parts", F.lit(0)).try_cast("bigint")
    )
    short = F.size("_parts") < 3
    reason = F.when(short, "too few fields").when(F.col("_id").isNull(), "id is not an integer")
    good = parts.where(~short & F.col("_id").isNotNull()).select(
        F.col("_id").alias("id"),
        F.get("_parts", F.lit(1)).alias("email"),
        F.get("_parts", F.lit(2)).alias("name"),
    )
    bad = parts.withColumn("reason", reason).where("reason IS NOT NULL").select(raw, "reason")
    return good, bad


def read_json(df: DataFrame, text: str, schema: T.StructType) -> DataFrame:
    """Typed fields of a JSON column next to the unparsable text (null when it parsed)."""
    bad = "_bad_json"
    wide = T.StructType([*schema.fields, T.StructField(bad, T.StringType())])
    parsed = F.from_json(
        F.col(text), wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": bad}
    )
    return df.withColumn("_json", parsed).select(
        *df.columns,
        *[F.col(f"_json.{f.name}").alias(f.name) for f in schema.fields],
        F.col(f"_json.{bad}").alias("bad_json"),
    )


def to_json(*fields: Column) -> Column:
    return F.to_json(F.struct(*fields))
