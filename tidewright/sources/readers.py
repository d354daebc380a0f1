"""Sources: Parquet, JDBC and in-memory frames, with projection, filter, window and probes."""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

_UNSAFE = re.compile(r";|--|/\*|\*/")
_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_$#]*")


def safe_filter(text: str) -> str:
    if _UNSAFE.search(text):
        raise ValueError(f"a filter is one expression, without terminators or comments: {text!r}")
    return text


@dataclass(frozen=True)
class Scan:
    """What to read of a relation; every part is optional."""

    columns: tuple[str, ...] | None = None
    exclude: tuple[str, ...] = ()
    filter: str | None = None
    window: Column | None = None
    limit: int | None = None

    def apply(self, df: DataFrame) -> DataFrame:
        """Plain select and where: Catalyst prunes columns and pushes predicates into the scan."""
        if self.window is not None:
            df = df.where(self.window)
        if self.filter:
            df = df.where(F.expr(safe_filter(self.filter)))
        names = list(self.columns or df.columns)
        gone = {c.lower() for c in self.exclude}
        names = [c for c in names if c.lower() not in gone]
        if not names:
            raise ValueError("the projection is empty")
        df = df.select(*names)
        return df.limit(self.limit) if self.limit else df


class ParquetSource:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def read(self, scan: Scan = Scan()) -> DataFrame:
        return scan.apply(self.spark.read.parquet(self.path))


class MemorySource:
    def __init__(self, df: DataFrame):
        self.df = df

    def read(self, scan: Scan = Scan()) -> DataFrame:
        return scan.apply(self.df)


def env_secrets(scope: str, key: str) -> str:
    """Default secret provider: environment variable SCOPE_KEY."""
    return os.environ[re.sub(r"\W", "_", f"{scope}_{key}").upper()]


@dataclass(frozen=True)
class JdbcSource:
    """A bounded, optionally range-partitioned JDBC read.

    With a partition column the relation goes in as a subquery, since Spark
    refuses `query` together with partitionColumn; the bounds come from the
    filtered extract, and an empty one is read in one partition.
    """

    spark: SparkSession
    url: str
    relation: str
    driver: str | None = None
    fetch_size: int = 10_000
    partition_column: str | None = None
    partitions: int = 1
    bounds: tuple[str, str] | None = None
    session_init: str | None = None
    custom_schema: str | None = None
    secret_scope: str | None = None
    secrets: Callable[[str, str], str] = env_secrets
    extra: dict = field(default_factory=dict)
    user_key: str = "user"
    password_key: str = "password"

    def options(self, sql: str, parallel: bool = True) -> dict[str, str]:
        out = {"url": self.url, "fetchsize": str(self.fetch_size)}
        optional = {"driver": self.driver, "sessionInitStatement": self.session_init, "customSchema": self.custom_schema}
        out |= {k: v for k, v in optional.items() if v}
        if self.secret_scope:
            out |= {"user": self.secrets(self.secret_scope, self.user_key), "password": self.secrets(self.secret_scope, self.password_key)}
        low, high = self.bounds or (None, None)
        if parallel and self.partition_column and self.partitions > 1 and low is not None and high is not None:
            out |= {
                "dbtable": f"({sql}) src", "partitionColumn": self.partition_column, "lowerBound": str(low), "upperBound": str(high),
                "numPartitions": str(self.partitions)
            }
        else:
            out["query"] = sql
        return out | self.extra

    def redacted(self, sql: str) -> dict[str, str]:
        return {k: "***" if k in ("user", "password") else v for k, v in self.options(sql).items()}

    def sql(self, columns: tuple[str, ...] | None = None, where: tuple[str, ...] = ()) -> str:
        for c in columns or ():
            if not _NAME.fullmatch(c):
                raise ValueError(f"not a column name: {c!r}")
        tests = " AND ".join(f"({safe_filter(w)})" for w in where)
        return f"SELECT {', '.join(columns) if columns else '*'} FROM {self.relation}" + (f" WHERE {tests}" if tests else "")

    def scalar(self, expression: str, sql: str):
        o = self.options(f"SELECT {expression} AS v FROM ({sql}) probe", parallel=False)
        return self.spark.read.format("jdbc").options(**o).load().first()[0]

    def with_bounds(self, sql: str) -> JdbcSource:
        if self.bounds or not self.partition_column or self.partitions < 2:
            return self
        c = self.partition_column
        low, high = self.scalar(f"MIN({c})", sql), self.scalar(f"MAX({c})", sql)
        return self if low is None else JdbcSource(**{**self.__dict__, "bounds": (str(low), str(high))})

    def read(self, columns: tuple[str, ...] | None = None, where: tuple[str, ...] = ()) -> DataFrame:
        sql = self.sql(columns, where)
        return self.spark.read.format("jdbc").options(**self.with_bounds(sql).options(sql)).load()


def template(spark: SparkSession, text: str, args: dict, views: dict[str, DataFrame]) -> DataFrame:
    """A query file: one statement, parameters bound by name, never spliced.

    Its relations are common table expressions over views of names that no
    other query has; those are gone once the query is analysed, so parallel
    runs never see each other's.
    """
    mine = {name: f"tw_{uuid.uuid4().hex}" for name in views}
    for name, df in views.items():
        df.createOrReplaceTempView(mine[name])
    try:
        with_ = ", ".join(f"{name} AS (SELECT * FROM {view})" for name, view in mine.items())
        body = text.strip().removesuffix(";")
        return spark.sql(f"WITH {with_} SELECT * FROM (\n{body}\n)" if views else body, args=args)
    finally:
        for view in mine.values():
            spark.catalog.dropTempView(view)


def probe(df: DataFrame, watermark: str | None = None, partition: str | None = None) -> DataFrame:
    """source_count, max_watermark, lower_bound and upper_bound in one aggregate."""
    out = [F.count(F.lit(1)).alias("source_count")]
    if watermark:
        out.append(F.max(watermark).alias("max_watermark"))
    if partition:
        out += [F.min(partition).alias("lower_bound"), F.max(partition).alias("upper_bound")]
    return df.agg(*out)
