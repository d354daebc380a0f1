"""Exact token counts by prefix dynamic programming.

Every chunk of a text gets the counts of all its prefixes from one dynamic
program (bpe.PrefixDP); put end to end they are the exact counts of all
prefixes of the text. They are stored, compressed, and whatever is asked
(tokens, truncation to a budget, the cost of a prefix) is read from the store
without encoding again.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import bpe
from .common import materialize, read, slices

LIMIT = 1024
#: Compression of stored steps: small numbers, mostly 0 and 1.
LEVEL = 1


def pack_counts(steps: bytes) -> bytes:
    """Steps between neighbouring counts (16-bit), compressed; in one byte each where all fit."""
    x = np.frombuffer(steps, np.int16)
    small = x.astype(np.int8)
    if (small == x).all():
        return b"b" + zlib.compress(small.tobytes(), LEVEL)
    return b"h" + zlib.compress(steps, LEVEL)


def _stored_steps(blob: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(blob[1:]), np.int8 if blob[:1] == b"b" else np.int16)


def unpack_counts(blob: bytes) -> np.ndarray:
    """The exact count of every prefix, from the empty one to the whole text."""
    return np.concatenate([[0], np.cumsum(_stored_steps(blob), dtype=np.int64)])


def count_at(blob: bytes, chars: int) -> int:
    """Tokens of the first chars code points."""
    return int(_stored_steps(blob)[:chars].sum(dtype=np.int64))


def total(blob: bytes) -> int:
    """Tokens of the whole text."""
    return int(_stored_steps(blob).sum(dtype=np.int64))


def longest_within(blob: bytes, budget: int) -> int:
    """The most code points such that they hold at most budget tokens."""
    return int(np.flatnonzero(unpack_counts(blob) <= budget)[-1])


def prefix_store(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_bytes, prefix_counts (pack_counts of every prefix of the text), in the shared folder.

    Null and empty texts have 0 bytes and an empty store. Repeated rows each
    get their own; a null id stays null; other columns are ignored. An empty
    table gives an empty store. Rows keep their partitions: no shuffle. A text
    of n code points takes a few n bytes of memory, and one text is held at a time.
    """

    def work(batches):
        for b in slices(batches, 64):
            texts = b.column(1).to_pylist()
            packed = pa.array([pack_counts(bpe.prefix_steps(x or "")) for x in texts], pa.binary())
            size = pa.array([len((x or "").encode()) for x in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), size, packed], names=["k", "n_bytes", "prefix_counts"])

    src = df.select(F.col(id_col).alias("k"), F.col(text_col).cast("string").alias("t"))
    kind = src.schema["k"].dataType.simpleString()
    out = src.mapInArrow(work, f"k {kind}, n_bytes long, prefix_counts binary")
    return materialize(out.withColumnRenamed("k", id_col), "prefixes")


def answers(store: DataFrame, limit: int = LIMIT, id_col: str = "doc_id") -> DataFrame:
    """Per row of a store: id, n_bytes, n_tokens, over_limit (n_tokens > limit), chars_within (the longest prefix of at most limit tokens)."""

    def work(batches):
        for b in slices(batches):
            blobs = b.column(2).to_pylist()
            n = [total(x) for x in blobs]
            within = [longest_within(x, limit) if k > limit else len(_stored_steps(x)) for x, k in zip(blobs, n)]
            cols = [
                b.column(0), b.column(1), pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_()),
                pa.array(within, pa.int64())
            ]
            yield pa.RecordBatch.from_arrays(cols, names=["k", "n_bytes", "n_tokens", "over_limit", "chars_within"])

    src = store.select(F.col(id_col).alias("k"), "n_bytes", "prefix_counts")
    kind = src.schema["k"].dataType.simpleString()
    out = src.mapInArrow(work, f"k {kind}, n_bytes long, n_tokens long, over_limit boolean, chars_within long")
    return out.withColumnRenamed("k", id_col)


def token_counts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT) -> DataFrame:
    """Per row: id, n_bytes, n_tokens, over_limit, chars_within, all read from the stored prefix counts."""
    return answers(prefix_store(df, id_col, text_col), limit, id_col)


def query(spark, sf_dir: str) -> DataFrame:
    return token_counts(read(spark, sf_dir, "documents"))
