"""Exact deduplication over a log-structured merge index.

Each task fills a memtable of digests and flushes it, when full, as a run
sorted by digest; equal texts in one memtable are compared byte by byte and
collapse there. Compaction merges the runs by digest and keeps the best
identifier of each. Digests of several runs pass a filter of bounded size, and
those hits are verified byte by byte: the distinct texts of each digest are
found, those of a hot one in two steps. A digest with one text is one group;
one with several is split by the texts themselves, so two never merge.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import counted, materialize, maybe_in, read, result_of, slices

#: A memtable is flushed beyond so many rows or bytes of text.
MEMTABLE_ROWS, MEMTABLE_BYTES = 8192, 12 << 20
#: Entries of one digest whose texts are compared by one task before what differs goes on.
TOGETHER = 256


def runs(df: DataFrame, id_col: str, text_col: str, digest=lambda raw: hashlib.sha256(raw).digest()) -> DataFrame:
    """(run, digest, variant, rep_id, n, members, text): one row per distinct text of a run, sorted by digest."""

    names = ["run", "digest", "variant", "rep_id", "n", "members", "text"]
    kinds = [pa.int64(), pa.binary(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary()]

    def flush(table, run):
        rows = []
        for d in sorted(table):
            for v, (raw, members) in enumerate(table[d]):
                best = max((m for m in members if m is not None), default=None)
                rows.append((run, d, v, best, len(members), members, raw))
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    def work(batches):
        run = TaskContext.get().partitionId() << 32
        table: dict[bytes, list[tuple[bytes, list[int]]]] = {}
        rows = size = 0
        for b in slices(batches):
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                raw = (text or "").encode()
                entries = table.setdefault(digest(raw), [])
                for known, members in entries:
                    if known == raw:
                        members.append(doc)
                        break
                else:
                    entries.append((raw, [doc]))
                    size += len(raw)
                rows += 1
                if rows >= MEMTABLE_ROWS or size >= MEMTABLE_BYTES:
                    yield flush(table, run)
                    run, rows, size, table = run + 1, 0, 0, {}
        if table:
            yield flush(table, run)

    src = df.select(F.col(id_col).cast("long"), F.col(text_col))
    return src.mapInArrow(work, "run long, digest binary, variant int, rep_id long, n long, members array<long>, text binary")


def _digests_of_several_texts(opened: DataFrame) -> DataFrame:
    """(digest) of entries whose texts differ. A hot digest's are compared TOGETHER at a time first."""
    salts = F.ceil(F.col("entries") / TOGETHER)
    texts = opened.select("digest", "text", F.pmod(F.xxhash64("run", "variant"), salts).alias("salt"), (salts > 1).alias("hot"))
    hot = texts.where("hot").groupBy("digest", "salt").agg(F.min("text").alias("a"), F.max("text").alias("b"))
    hot = hot.groupBy("digest").agg(F.min("a").alias("a"), F.max("b").alias("b"))
    cold = texts.where("not hot").groupBy("digest").agg(F.min("text").alias("a"), F.max("text").alias("b"))
    return materialize(cold.unionByName(hot).where("a != b").select("digest"), "split")


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest=None) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    The row with the largest id of each group of identical texts is kept (the
    index keeps the smallest of a reversed order); of repeated rows with that
    id exactly one. Null texts count as empty; null ids sort below all others.
    An empty table gives an empty result; other columns are ignored. Within a
    run copies are one entry, so a hot text shuffles one row per run, not one
    per copy. digest may be replaced by a weaker one (tests do); results stay.
    """
    return result_of(df.sparkSession, lambda: _dedup(df, id_col, text_col, digest), "exact")


def _dedup(df: DataFrame, id_col: str, text_col: str, digest) -> DataFrame:
    index = materialize(runs(df, id_col, text_col, *([digest] if digest else [])), "runs")
    key = ["run", "digest", "variant"]
    best = F.max(F.struct("rep_id", (-F.col("run")).alias("late"))).alias("best")
    merged = [best, F.sum("n").alias("size")]
    # compaction by digest: sizes and identifiers only, combined before the shuffle
    hits = index.groupBy("digest").agg(F.count("*").alias("entries"), *merged).where("entries > 1")
    hits, many = counted(hits, "hits")
    opened = maybe_in(
        index.select(*key, "rep_id", "n", "text"), "digest", hits.select("digest"), many
    ).join(hits.select("digest", "entries"), "digest")
    several = _digests_of_several_texts(opened)

    # of those digests, which none has unless SHA-256 fails, the texts are the groups
    split = opened.drop("entries").join(several, "digest", "left_semi")
    by_text = split.groupBy("digest", "text").agg(*merged)
    split = split.select(*key, "text").join(by_text, ["digest", "text"]).select(*key, "best", "size")
    whole = index.select(*key).join(hits.drop("entries").join(several, "digest", "left_anti"), "digest")
    verified = whole.select(*key, "best", "size").unionByName(split)
    out = index.select(*key, "rep_id", "n", "members").join(verified, key, "left")
    out = out.select(
        "members", F.hex("digest").alias("digest"),
        F.coalesce(F.col("best.rep_id"), F.col("rep_id")).alias("keep_id"),
        F.coalesce("size", "n").alias("group_size"),
        (F.col("best").isNull() | (F.col("best.late") == -F.col("run"))).alias("here"),
    )
    first = F.when(F.col("keep_id").isNull(), F.lit(0)).otherwise(F.array_position("members", F.col("keep_id")) - 1)
    out = out.withColumn("first", first).select("*", F.posexplode("members").alias("at", "__id"))
    return out.select(
        F.col("__id").alias(id_col), "keep_id", "group_size", (F.col("here") & (F.col("at") == F.col("first"))).alias("kept"),
        F.lower("digest").alias("text_sha256")
    )


def query(spark, sf_dir: str) -> DataFrame:
    return exact_dedup(read(spark, sf_dir, "documents"))


SQL = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
"""
