"""Packing into windows by non-negative least squares.

Documents are encoded and cut into full windows and one rest. The rests'
lengths, in units of UNIT tokens, make a histogram over the whole table;
combinations of at most DEPTH lengths that fill a window are enumerated, their
repeat counts solved against the histogram by non-negative least squares and
rounded down, and what is left over is packed greedily (best fit, longest
first) in groups of bounded size.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from . import bpe
from .common import materialize, read, slices

WINDOW, UNIT, DEPTH, EOS = 2048, 16, 4, 1
#: Left over pieces that are packed together.
GROUP = 4096


def pieces(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """Encode every text, append EOS, and cut it into windows and a rest."""

    def work(batches):
        uid = TaskContext.get().partitionId() << 34
        for b in slices(batches):
            rows: list[list] = [[] for _ in range(6)]
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                ids = bpe.encode(text or "") + EOS.to_bytes(4, "little")
                total = len(ids) // 4
                for at in range(0, total, window):
                    part = ids[4 * at : 4 * (at + window)]
                    for col, x in zip(rows, (uid, doc, at, len(part) // 4, zlib.crc32(part), total)):
                        col.append(x)
                    uid += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, b.schema.field(0).type if i == 1 else pa.int64()) for i, c in enumerate(rows)],
                names=["uid", "k", "start", "length", "ids_crc32", "doc_tokens"]
            )

    src = df.select(F.col(id_col).alias("k"), F.col(text_col).alias("t"))
    return src.mapInArrow(
        work, f"uid long, k {src.schema['k'].dataType.simpleString()}, start long, length long, ids_crc32 long, doc_tokens long"
    ).withColumnRenamed("k", id_col)


def combinations(total: int, depth: int) -> list[tuple[int, ...]]:
    """Non-increasing tuples of at most depth positive integers that add up to total."""
    out = []

    def grow(left, most, parts):
        if not left:
            out.append(parts)
        elif len(parts) < depth:
            for x in range(min(left, most), 0, -1):
                if x * (depth - len(parts)) < left:
                    break
                grow(left - x, x, (*parts, x))

    grow(total, total, ())
    return out


def nnls(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Active-set non-negative least squares (Lawson and Hanson, 1974)."""
    x = np.zeros(a.shape[1])
    active: list[int] = []
    scale = max(1.0, np.abs(b).max())
    for _ in range(3 * a.shape[0]):
        gradient = a.T @ (b - a @ x)
        gradient[active] = -np.inf
        j = int(np.argmax(gradient))
        if gradient[j] <= 1e-9 * scale:
            break
        active.append(j)
        while active:
            z = np.linalg.lstsq(a[:, active], b, rcond=None)[0]
            if z.min() > 1e-12:
                break
            now = x[active]
            low = z <= 1e-12
            step = np.min(np.where(low, now / np.where(low, now - z + 1e-300, 1), np.inf))
            now = now + step * (z - now)
            x[:] = 0
            x[active] = np.maximum(now, 0)
            active = [k for k in active if x[k] > 1e-12]
        x[:] = 0
        if active:
            x[active] = z
    return x


def plan(histogram: dict[int, int], window: int = WINDOW, unit: int = UNIT, depth: int = DEPTH) -> list[tuple[tuple[int, ...], int]]:
    """(combination, repeats): whole repeats that the histogram of units covers."""
    have = np.zeros(window // unit + 1)
    for k, n in histogram.items():
        have[k] = n
    columns = [c for c in combinations(window // unit, depth) if all(have[k] for k in c)]
    if not columns:
        return []
    a = np.zeros((len(have), len(columns)))
    for j, c in enumerate(columns):
        for k in c:
            a[k, j] += 1
    x = nnls(a, have)
    out, left = [], have.copy()
    for j in np.argsort(-x, kind="stable"):
        n = int(min(np.floor(x[j] + 1e-6), min(left[k] // a[k, j] for k in set(columns[j]))))
        if n > 0:
            out.append((columns[j], n))
            left -= n * a[:, j]
    return out


def best_fit(lengths: list[int], window: int = WINDOW) -> list[int]:
    """A bin for each length, longest first, each into the fullest bin that holds it."""
    room: list[list[int]] = [[] for _ in range(window + 1)]
    mask, bins, out = 0, 0, [0] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        n = lengths[i]
        above = mask >> n
        if above:
            r = n + (above & -above).bit_length() - 1
            b = room[r].pop()
            if not room[r]:
                mask &= ~(1 << r)
        else:
            r, b = window, bins
            bins += 1
        room[r - n].append(b)
        if r > n:
            mask |= 1 << (r - n)
        out[i] = b
    return out


def pack(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, unit: int = UNIT, depth: int = DEPTH
) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A null or empty text is one piece holding only EOS. Repeated rows are
    packed once each; a null id stays null; other columns are ignored; an
    empty table gives an empty result. A sequence is padded to the window
    unless its length is a power of two. Pieces are written once to the shared
    folder, so retries see the same pieces; the histogram (window / unit rows)
    and the plan are all that the driver holds.
    """
    p = materialize(pieces(df, id_col, text_col, window), "pieces")
    cols = [id_col, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    whole = p.where(F.col("length") == window).withColumns({"sequence_id": F.col("uid") * 4, "offset": F.lit(0).cast("long")}).select(cols)
    rest = p.where(F.col("length") < window).withColumn("bin", F.ceil(F.col("length") / unit).cast("int"))
    histogram = {r["bin"]: r["n"] for r in rest.groupBy("bin").agg(F.count("*").alias("n")).collect()}
    plans = plan(histogram, window, unit, depth)

    # the place of every rest within its bin: within a salted bucket, and after the buckets before
    buckets = min(65536, max(1, -(-sum(histogram.values()) // 512)))
    rest = rest.withColumn("bucket", F.pmod(F.xxhash64("uid"), F.lit(buckets)))
    before = rest.groupBy("bin", "bucket").agg(F.count("*").alias("n"))
    before = before.withColumn(
        "before", F.sum("n").over(Window.partitionBy("bin").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    ).drop("n")
    ranked = rest.withColumn(
        "rank", F.row_number().over(Window.partitionBy("bin", "bucket").orderBy("uid")) - 1
    ).join(before, ["bin", "bucket"])
    ranked = ranked.withColumn("rank", (F.col("rank") + F.coalesce("before", F.lit(0))).cast("long")).drop("before", "bucket")

    ends: dict[int, list[int]] = {}
    first: dict[int, list[int]] = {}
    slots: dict[int, list[int]] = {}
    base = 0
    for combo, n in plans:
        for slot, k in enumerate(combo):
            e = ends.setdefault(k, [])
            e.append((e[-1] if e else 0) + n)
            first.setdefault(k, []).append(base)
            slots.setdefault(k, []).append(slot)
        base += n

    def place(batches):
        for b in batches:
            f = b.to_pandas()
            seq, slot = np.full(len(f), -1, np.int64), np.zeros(len(f), np.int32)
            for k, rows in f.groupby("bin").indices.items():
                if k in ends:
                    e, r = np.array(ends[k]), f["rank"].to_numpy()[rows]
                    i = np.searchsorted(e, r, side="right")
                    ok = i < len(e)
                    i, r, rows = i[ok], r[ok], rows[ok]
                    seq[rows] = np.array(first[k])[i] + r - np.concatenate([[0], e])[i]
                    slot[rows] = np.array(slots[k])[i]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(seq), pa.array(slot)], names=[*b.schema.names, "seq", "slot"])

    kind = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranked.schema.fields)
    placed = materialize(ranked.mapInArrow(place, f"{kind}, seq long, slot int"), "placed")
    inside = Window.partitionBy("seq").orderBy("slot")
    by_plan = placed.where("seq >= 0").withColumn(
        "offset", F.coalesce(F.sum("length").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    )
    by_plan = by_plan.withColumn("sequence_id", F.col("seq") * 4 + 1).select(cols)

    left = placed.where("seq < 0").select("uid", id_col, "start", "length", "ids_crc32", "doc_tokens")
    groups = max(1, -(-(sum(histogram.values()) - sum(len(c) * n for c, n in plans)) // GROUP))
    left = left.withColumn("g", F.pmod(F.xxhash64("uid", F.lit(7)), F.lit(groups)))

    def greedy(f: pd.DataFrame) -> pd.DataFrame:
        f = f.sort_values("uid", ignore_index=True)
        f["sequence_id"] = (f["g"].to_numpy() << 20 | np.array(best_fit(f["length"].tolist(), window), dtype=np.int64)) * 4 + 2
        f["offset"] = f.groupby("sequence_id")["length"].cumsum() - f["length"]
        return f[cols]

    kind = left.schema[id_col].dataType.simpleString()
    by_fit = left.groupBy("g").applyInPandas(
        greedy, f"`{id_col}` {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    )
    return whole.unionByName(by_plan).unionByName(by_fit)


def query(spark, sf_dir: str) -> DataFrame:
    return pack(read(spark, sf_dir, "documents"))
