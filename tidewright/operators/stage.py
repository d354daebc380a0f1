"""Staging: column case, technical audit columns, newest row per key."""

from __future__ import annotations

import re
from datetime import datetime

from pyspark.sql import DataFrame, Window, functions as F

#: Fixed names and order of the technical columns.
AUDIT = ("_ingested_at", "_ingested_date", "_run_id", "_batch_id", "_source_op", "_first_ingested_at")
INSERT_ONLY = ("_first_ingested_at",)
_ID = re.compile(r"[A-Za-z0-9_.:+-]*")


def column_case(df: DataFrame, policy: str = "preserve") -> DataFrame:
    if policy == "preserve":
        return df
    names = [c.lower() for c in df.columns]
    if len(set(names)) < len(names):
        raise ValueError("columns differ only in case")
    return df.toDF(*names)


def plain_id(text: str) -> str:
    """An identifier of the framework's own making, of plain characters only."""
    if not _ID.fullmatch(text):
        raise ValueError(f"not an identifier: {text!r}")
    return text


def stamp(df: DataFrame, run_id: str, batch_id: str, at: datetime) -> DataFrame:
    """The technical columns, as typed literals."""
    when = F.lit(at.isoformat(sep=" ")).cast("timestamp_ntz")
    values = (when, when.cast("date"), F.lit(plain_id(run_id)), F.lit(plain_id(batch_id)), F.lit("I"), when)
    return df.withColumns(dict(zip(AUDIT, values)))


def newest(
    df: DataFrame, keys: list[str], watermark: str | None = None, version: str | None = None, n: int = 1, rank: str | None = None
) -> DataFrame:
    """The n newest rows per key under a total order, so reruns agree.

    Watermark, then version, descending with nulls last; ties by a hash and
    then the values of all columns. Spark prunes each partition to n rows a
    key before the shuffle (window group limit), so hot keys stay small.
    """
    marks = [F.col(c).desc_nulls_last() for c in (watermark, version) if c]
    ties = [F.xxhash64(*df.columns).desc(), *[F.col(f.name) for f in df.schema.fields if f.dataType.typeName() not in ("map", "variant")]]
    name = rank or "__rank"
    out = df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*marks, *ties))).where(F.col(name) <= n)
    return out if rank else out.drop(name)


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows beyond the first of each key; a null is a value of a key like any other."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_rows"))
