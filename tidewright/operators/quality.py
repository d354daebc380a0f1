"""Expectations and reconciliation: all rules in one aggregate."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from .stage import AUDIT


@dataclass(frozen=True)
class Rule:
    """kind: not_null, unique, in_set, min, max or regex; nulls violate only not_null."""

    name: str
    kind: str
    column: str
    argument: Any = None
    severity: str = "fail"

    def violations(self) -> Column:
        c, a = F.col(self.column), self.argument
        if self.kind == "not_null":
            return F.count_if(c.isNull())
        if self.kind == "unique":
            return F.count(c) - F.count_distinct(c)
        if a is None:
            raise ValueError(f"{self.kind} needs an argument")
        if self.kind == "in_set":
            return F.count_if(c.isNotNull() & ~c.isin(list(a)))
        if self.kind == "min":
            return F.count_if(c < F.lit(a))
        if self.kind == "max":
            return F.count_if(c > F.lit(a))
        if self.kind == "regex":
            return F.count_if(~c.rlike(a))
        raise ValueError(f"no such rule: {self.kind}")


def evaluate(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """(check_name, violations, status) per rule, from one pass over df."""
    one = df.agg(*[r.violations().alias(f"r{i}") for i, r in enumerate(rules)])
    rows = [
        F.struct(
            F.lit(r.name).alias("check_name"), F.col(f"r{i}").cast("long").alias("violations"),
            F.when(F.col(f"r{i}") == 0, "PASSED").otherwise("WARNED" if r.severity == "warn" else "FAILED").alias("status")
        ) for i,
        r in enumerate(rules)
    ]
    return one.select(F.explode(F.array(*rows)).alias("x")).select("x.*")


def null_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    anyone = F.col(keys[0]).isNull()
    for k in keys[1:]:
        anyone = anyone | F.col(k).isNull()
    return df.agg(F.count_if(anyone).alias("null_key_rows"))


def row_count_status(source: int | None, duplicates: int | None, inserted: int | None, updated: int = 0, rejected: int = 0) -> str:
    """source - duplicates must equal inserted + updated + rejected."""
    if source is None or duplicates is None or inserted is None:
        return "SKIPPED"
    return "PASSED" if source - duplicates == inserted + updated + rejected else "FAILED"


def duplicate_status(duplicates: int, incremental: bool) -> str:
    return "PASSED" if incremental or not duplicates else "WARNED"


def drift(store, batch: DataFrame) -> list[str]:
    """Columns that a batch has and the table lacks, lacks and the table has, or has as another type; audit columns aside."""
    entry = store.entry()
    if entry is None:
        return []
    kinds = lambda schema: {f.name.lower(): f.dataType for f in schema if f.name not in AUDIT}
    old, new = kinds(store.schema(entry)), kinds(batch.schema)
    return sorted(c for c in {*old, *new} if old.get(c) != new.get(c))
