"""Versioned Parquet tables: new data beside the old, then one exclusive log entry."""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructField, StructType

from . import merge as m
from .files import Files

#: Folders of data that appends may add to a table before one of them rewrites it.
FOLDERS = 64
#: Buckets of a new merge table; rows of a bucket beyond which their number doubles; tries of a write against others.
BUCKETS, BUCKET_ROWS, TRIES = 8, 4_000_000, 8
BUCKET = "__bucket"
CHANGE, COMMIT = "_change_type", "_commit_version"


class LostRace(RuntimeError):
    """Another writer has made this version already exist."""


class VersionedStore:
    """A table is root/_log/<version>.json naming parts of data; readers take the highest.

    A part is a folder with its schema, and, in merge tables, the buckets of
    it that still count. A merge reads and rewrites only the buckets that its
    batch touches, an append writes only its batch. A commit creates its log
    entry exclusively; a writer that comes second starts again on what the
    first one left.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.files = Files(spark, root)

    # reading

    def version(self) -> int | None:
        return max((int(n[:-5]) for n in self.files.names("_log") if n.endswith(".json")), default=None)

    def entry(self, version: int | None = None) -> dict | None:
        version = self.version() if version is None else version
        return None if version is None else json.loads(self.files.read(f"_log/{version:020d}.json"))

    def history(self) -> list[dict]:
        """Log entries, the newest first."""
        names = [n for n in self.files.names("_log") if n.endswith(".json")]
        return [{"version": int(n[:-5]), **self.entry(int(n[:-5]))} for n in reversed(names)]

    def schema(self, entry: dict) -> StructType:
        return StructType.fromJson(entry["schema"])

    def read(self, version: int | None = None) -> DataFrame | None:
        e = self.entry(version)
        return None if e is None else self._parts(e["parts"], self.schema(e))

    def _parts(self, parts: list[dict], schema: StructType, buckets: list[int] | None = None) -> DataFrame:
        """The rows of parts, with all columns of schema; of some buckets only, if any are named."""
        frames = []
        for p in parts:
            own, live = StructType.fromJson(p["schema"]), p["buckets"]
            if live is not None:
                own.add(BUCKET, "integer")
            df = self.spark.read.schema(own).parquet(f"{self.root}/{p['path']}")
            if live is not None:
                wanted = live if buckets is None else sorted(set(live) & set(buckets))
                df = df.where(F.col(BUCKET).isin(wanted)).drop(BUCKET)  # prunes folders
            frames.append(_fitted(df, schema))
        return reduce(DataFrame.unionByName, frames) if frames else self.spark.createDataFrame([], schema)

    def changes(self, since: int = 0, until: int | None = None) -> DataFrame:
        """Rows changed by versions since..until with _change_type and _commit_version, of a table that keeps changes."""
        last = self.version()
        out = []
        for v in range(since, (last if until is None else until) + 1):
            e = self.entry(v)
            schema = self.schema(e)
            tag = lambda df, kind: df.withColumns({CHANGE: F.lit(kind), COMMIT: F.lit(v).cast("long")})  # noqa: E731, B023
            if not e["table"].get("changes"):
                raise ValueError(f"version {v} keeps no change rows")
            if e["mode"] == "merge":
                out.append(self.spark.read.schema(StructType.fromJson(e["change_schema"])).parquet(f"{self.root}/{e['change_rows']}"))
            elif e["mode"] == "append":
                out.append(tag(self._parts([p for p in e["parts"] if p["path"] == e["written"]], schema), "insert"))
            elif e["mode"] == "overwrite":
                out.append(tag(self.read(v), "insert"))
                if v and (old := self.read(v - 1)) is not None:
                    out.append(tag(old, "delete"))
        empty = self.spark.createDataFrame([], self.schema(self.entry(last))).withColumns({
            CHANGE: F.lit(""), COMMIT: F.lit(0).cast("long")
        })
        return reduce(m.append, out, empty)

    def vacuum(self, keep: int = 10) -> list[str]:
        """Delete data that only versions before the last keep ones name, and their log entries; what no entry names is left alone."""
        versions = [int(n[:-5]) for n in self.files.names("_log") if n.endswith(".json")]
        old, new = versions[: -keep or None], versions[-keep:] if keep else []
        paths = lambda v: {x for e in [self.entry(v)] for x in (*e["data"], e.get("change_rows")) if x}
        gone = set().union(*map(paths, old)) - set().union(*map(paths, new))
        for name in (*(f"_log/{v:020d}.json" for v in old), *sorted(gone)):  # the log first: no entry ever names what is gone
            self.files.delete(name)
        return sorted(gone)

    # writing

    def create(
        self, schema: StructType, comment: str | None = None, partition_by: list[str] | None = None, cluster_by: list[str] | None = None,
        properties: dict | None = None, changes: bool = False, buckets: int = BUCKETS
    ) -> bool:
        """Make the table if there is none; False if there is one. Partitioning and clustering exclude each other: the first wins."""
        if self.version() is not None:
            return False
        if not schema.fields:
            raise ValueError("a table needs a column")
        names = {f.name.lower(): f.name for f in schema.fields}
        both = [*(partition_by or []), *(cluster_by or [])]
        if lost := [c for c in both if c.lower() not in names]:
            raise ValueError(f"no such columns: {lost}")
        table = {
            "comment": comment, "partition_by": [names[c.lower()] for c in partition_by or []],
            "cluster_by": [] if partition_by else [names[c.lower()] for c in cluster_by or []],
            "properties": {k: str(v) for k, v in sorted((properties or {}).items())}, "changes": changes, "buckets": buckets,
        }
        nothing = {"rows_total": 0}
        return self._log(
            0, {"mode": "create", "parts": [], "data": [], "schema": json.loads(schema.json()), "metrics": nothing, "table": table}
        )

    def _log(self, version: int, entry: dict) -> bool:
        return self.files.put(f"_log/{version:020d}.json", json.dumps(entry))

    def _commit(
        self, df: DataFrame, base: int | None, partition_by: list[str], note: dict, before: tuple = (), buckets: int | None = None,
        table: dict | None = None, schema: StructType | None = None
    ) -> dict:
        """Write df, then the log entry after base; with buckets df has the column BUCKET and is laid out by it."""
        data = f"data/{uuid.uuid4().hex}"
        seen = Observation()
        flags = [c for c in ("__insert", "__update", "__reject") if c in df.columns]
        counts = [F.count(F.lit(1)).alias("rows_total")]
        counts += [F.count_if(F.coalesce(F.col(c), F.lit(False))).alias(c.strip("_")) for c in flags]
        out = df.observe(seen, *counts).drop(*flags)
        folders = [*([BUCKET] if buckets else []), *partition_by]
        sort = (table or {}).get("cluster_by") or []
        if buckets:
            out = out.hint("rebalance", BUCKET)
        if sort:
            out = out.sortWithinPartitions(*folders, *sort)
        (out.write.partitionBy(*folders) if folders else out.write).parquet(f"{self.root}/{data}")
        own = StructType([f for f in out.schema.fields if f.name != BUCKET])
        got = {k: int(v) for k, v in seen.get.items()}
        part = {"path": data, "schema": json.loads(own.json()), "buckets": note.pop("live", None), "of": buckets}
        parts = [*before, part]
        whole = schema or own
        entry = {
            "parts": parts, "data": [p["path"] for p in parts], "written": data, "bytes": self.files.size(data),
            "schema": json.loads(whole.json()), "metrics": got, "table": table or {}, **note
        }
        if not self._log((-1 if base is None else base) + 1, entry):
            self.files.delete(data)
            raise LostRace(f"a version after {base} exists already")
        return entry

    def write(
        self, batch: DataFrame, mode: str, keys: list[str] | None = None, guard: str | None = None, partition_by: list[str] | None = None,
        evolve: bool = True, unique: bool = False, **note
    ) -> dict:
        """merge, append or overwrite; returns the log entry with its metrics.

        unique: the caller vouches that the batch holds each key once. Names
        of keys, guard and partitions are matched to the batch's whatever
        their case; one that the batch lacks is refused.
        """
        if mode not in ("merge", "append", "overwrite"):
            raise ValueError(f"no such write mode: {mode}")
        named = {c.lower(): c for c in batch.columns}
        wanted = [*(keys or []), *([guard] if guard else []), *(partition_by or [])]
        if lost := [c for c in wanted if c.lower() not in named]:
            raise ValueError(f"the batch has no column {', '.join(lost)}")
        keys, partition_by = [named[k.lower()] for k in keys or []], [named[c.lower()] for c in partition_by or []]
        guard = named[guard.lower()] if guard else None
        if mode == "merge" and not keys:
            raise ValueError("a merge needs keys")
        if mode == "merge" and not unique:
            m.assert_unique(batch, keys)
        for left in reversed(range(TRIES)):
            try:
                return self._write_once(batch, mode, keys, guard, partition_by, evolve, note)
            except LostRace:
                if not left:
                    raise
        raise AssertionError("unreachable")

    def _write_once(self, batch, mode, keys, guard, partition_by, evolve, note) -> dict:
        base = self.version()
        last = None if base is None else self.entry(base)
        table = dict(last["table"]) if last else {}
        partition_by = partition_by or table.get("partition_by") or []
        note = {"mode": mode, "added": [], **note}
        if last is None:
            schema = batch.schema
        else:
            have = {f.name.lower(): f.name for f in self.schema(last)}
            batch = batch.select(*[F.col(f"`{c}`").alias(have.get(c.lower(), c)) for c in batch.columns])
            keys, partition_by = ([have.get(c.lower(), c) for c in x] for x in (keys, partition_by))
            guard = have.get(guard.lower(), guard) if guard else None
            schema = _evolved(self.schema(last), batch.schema)
            note["added"] = [f.name for f in schema.fields[len(self.schema(last).fields) :]]
            if not evolve and _plain(self.schema(last)) != _plain(batch.schema):
                raise ValueError("the batch's schema differs from the table's")
        if mode == "merge":
            return self._merge(batch, base, last, table, keys, guard, partition_by, schema, note)
        if mode == "overwrite":
            return self._commit(batch, base, partition_by, note, (), None, table)
        # only the batch is written; beyond FOLDERS folders the table is written anew
        before = tuple(last["parts"]) if last else ()
        if len(before) < FOLDERS:
            return self._commit(_fitted(batch, schema, missing=False), base, partition_by, note, before, None, table, schema)
        df = self._parts(before, schema).withColumn("__insert", F.lit(False)).unionByName(
            _fitted(batch, schema).withColumn("__insert", F.lit(True))
        )
        written = self._commit(df, base, partition_by, {**note, "compacted": True}, (), None, table, schema)
        return {**written, "metrics": {**written["metrics"], "rows_total": written["metrics"]["insert"]}}

    def _merge(self, batch, base, last, table, keys, guard, partition_by, schema, note) -> dict:
        buckets = table.setdefault("buckets", BUCKETS)
        missing = {f.name.lower() for f in schema} - {c.lower() for c in batch.columns}
        batch = _fitted(batch, schema).withColumn(BUCKET, bucket(keys, buckets))
        hit = sorted(r[0] for r in batch.select(BUCKET).distinct().collect())
        old = list(last["parts"]) if last else []
        if any(p["of"] != buckets for p in old):  # parts that appends wrote, or of another number of buckets: all is laid out anew
            hit = list(range(buckets))
            touched, kept = old, []
            target = self._parts(touched, schema).withColumn(BUCKET, bucket(keys, buckets))
        else:
            touched = [p for p in old if set(p["buckets"]) & set(hit)]
            kept = [{**p, "buckets": rest} for p in old if (rest := sorted(set(p["buckets"]) - set(hit)))]
            target = self._parts(touched, schema, hit).withColumn(BUCKET, bucket(keys, buckets))
        j = m.classify(target, batch, [BUCKET, *keys], guard)
        rows = m.resolved(j, [f.name for f in schema], missing)
        out = j.select(*rows, F.coalesce(F.col(f"t.{BUCKET}"), F.col(f"s.{BUCKET}")).alias(BUCKET), "__insert", "__update", "__reject")
        if table.get("changes"):
            note["change_rows"] = f"changes/{uuid.uuid4().hex}"
            found = _change_rows(j, rows, [f.name for f in schema], (-1 if base is None else base) + 1)
            found.write.parquet(f"{self.root}/{note['change_rows']}")
            note["change_schema"] = json.loads(found.schema.json())
        return self._commit(out, base, partition_by, {**note, "live": hit}, tuple(kept), buckets, _grown(table, last), schema)


def bucket(keys: list[str], buckets: int) -> Column:
    """The bucket of a row: keys as text, so that it doesn't depend on how wide a number's type is."""
    return F.pmod(F.xxhash64(*[F.col(f"`{k}`").cast("string") for k in keys]), F.lit(buckets)).cast("int")


def _grown(table: dict, last: dict | None) -> dict:
    """The table's note for the next merge: twice the buckets where those that the last merge wrote were too large."""
    if last and last["mode"] == "merge":
        if last["metrics"]["rows_total"] > BUCKET_ROWS * max(1, len(last["parts"][-1]["buckets"])):
            return {**table, "buckets": 2 * table["buckets"]}
    return table


def _plain(schema: StructType) -> dict:
    return {f.name.lower(): f.dataType for f in schema}


def _evolved(old: StructType, new: StructType) -> StructType:
    """Columns of the table, then those that only the batch has; nullable."""
    have = _plain(old)
    return StructType([
        StructField(f.name, f.dataType, True) for f in (*old.fields, *(g for g in new.fields if g.name.lower() not in have))
    ])


def _fitted(df: DataFrame, schema: StructType, missing: bool = True) -> DataFrame:
    """df with the names and types of schema; columns that it lacks are null, or left out."""
    have = {c.lower(): c for c in df.columns}
    kinds = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for f in schema.fields:
        own = have.get(f.name.lower())
        if own is not None:
            c = F.col(f"`{own}`")
            out.append((c if kinds[own] == f.dataType else c.cast(f.dataType)).alias(f.name))
        elif missing:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*out)


def _change_rows(j: DataFrame, rows: list[Column], names: list[str], version: int) -> DataFrame:
    """insert, update_preimage and update_postimage rows of a merge."""
    after = F.struct(*rows)
    before = F.struct(*[F.col(f"t.`{c}`").alias(c) for c in names])
    tagged = lambda row, kind: F.struct(row.alias("row"), F.lit(kind).alias("kind"))
    both = F.array(tagged(before, "update_preimage"), tagged(after, "update_postimage"))
    x = F.explode(F.when(F.col("__insert"), F.array(tagged(after, "insert"))).when(F.col("__update"), both))
    return j.where("__insert OR __update").select(x.alias("x")).select(
        "x.row.*", F.col("x.kind").alias(CHANGE), F.lit(version).cast("long").alias(COMMIT)
    )
