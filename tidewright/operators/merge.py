"""Guarded merge as one full outer join, and its metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .stage import AUDIT, INSERT_ONLY


def align(df: DataFrame, other: DataFrame) -> DataFrame:
    """df with the columns of other that it lacks, as nulls of their type."""
    have = {c.lower() for c in df.columns}
    return df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in other.schema.fields if f.name.lower() not in have})


def classify(target: DataFrame, batch: DataFrame, keys: list[str], guard: str | None) -> DataFrame:
    """Structs t and s of every pair, with __insert, __update and __reject.

    Keys compare with plain equality: null keys match nothing and stay on
    both sides. With a guard a row is replaced only when its mark is null or
    the batch's is not older; a null mark in the batch replaces no other.
    """
    t = target.select(F.struct(*target.columns).alias("t"), *[F.col(k).alias(f"__t{i}") for i, k in enumerate(keys)])
    s = batch.select(F.struct(*batch.columns).alias("s"), *[F.col(k).alias(f"__s{i}") for i, k in enumerate(keys)])
    on = [F.col(f"__t{i}") == F.col(f"__s{i}") for i in range(len(keys))]
    j = t.join(s, on, "full_outer").select("t", "s")
    newer = F.lit(True) if guard is None else F.coalesce(
        F.col(f"t.`{guard}`").isNull() | (F.col(f"s.`{guard}`") >= F.col(f"t.`{guard}`")), F.lit(False)
    )
    both = F.col("t").isNotNull() & F.col("s").isNotNull()
    return j.withColumns({"__insert": F.col("t").isNull(), "__update": both & newer, "__reject": both & ~newer})


def resolved(j: DataFrame, columns: list[str], missing: set[str]) -> list:
    """The merged value of each column of classify's result; missing: columns (lower case) that the batch lacks."""
    out = []
    for c in columns:
        t, s = F.col(f"t.`{c}`"), F.col(f"s.`{c}`")
        if c == AUDIT[4]:
            value = F.when(F.col("__insert"), "I").when(F.col("__update"), "U").otherwise(t)
        elif c in INSERT_ONLY or c.lower() in missing:
            value = F.when(F.col("__insert"), s).otherwise(t)
        else:
            value = F.when(F.col("__insert") | F.col("__update"), s).otherwise(t)
        out.append(value.alias(c))
    return out


def merge(target: DataFrame, batch: DataFrame, keys: list[str], guard: str | None = None) -> DataFrame:
    """The target after the merge; columns of either side, missing ones null.

    A column that the batch lacks keeps its value on update. The batch must
    hold a key once: call assert_unique before.
    """
    missing = {c.lower() for c in target.columns} - {c.lower() for c in batch.columns}
    target, batch = align(target, batch), align(batch, target)
    j = classify(target, batch, keys, guard)
    return j.select(*resolved(j, target.columns, missing))


def metrics(target: DataFrame, batch: DataFrame, keys: list[str], guard: str | None = None) -> DataFrame:
    n = lambda c: F.coalesce(F.sum(F.col(c).cast("long")), F.lit(0).cast("long"))
    return classify(target, batch, keys, guard).agg(
        n("__insert").alias("rows_inserted"), n("__update").alias("rows_updated"), n("__reject").alias("rows_rejected")
    )


def append(target: DataFrame, batch: DataFrame) -> DataFrame:
    return target.unionByName(batch, allowMissingColumns=True)


def assert_unique(batch: DataFrame, keys: list[str]) -> None:
    whole = batch.na.drop(subset=keys)
    if not whole.groupBy(*keys).count().where("count > 1").isEmpty():
        raise ValueError(f"the batch holds a key more than once: {keys}")
