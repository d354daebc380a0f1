"""Mixing sources to target weights by Sainte-Laguë apportionment.

Targets become equal blocks of BLOCK words, dealt to sources and then to each
source's shards by highest quotients. A shard lays its documents end to end in
a seeded order and takes its quota as whole laps plus a run of blocks that
begins at a seeded block.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import materialize, read, slices

WEIGHTS, SHARE, MOST, BLOCK, SEED = (5, 2, 1), 1.5, 2, 16, 17
#: A source has a shard for so many words; beyond FEW of them the square root of its words, if that is less.
SHARD_WORDS, FEW = 1 << 15, 1 << 13


def shard_count(words: int) -> int:
    """Shards of a source: both their number and their size grow, so neither a shard nor the table of quotas gets long."""
    return max(1, min(-(-words // SHARD_WORDS), max(FEW, math.isqrt(words))))


def sainte_lague(weights: list[float], seats: int) -> list[int]:
    """Seats by the highest quotients weight / (2 n + 1); ties go to the earlier."""
    w = np.asarray(weights, float)
    if not len(w) or w.sum() <= 0 or seats <= 0:
        return [0] * len(w)
    low, high = w.sum() / (2 * seats + 2 * len(w)), 4 * w.max() + w.sum() / seats
    for _ in range(100):  # the divisor; what it gives is a prefix of the quotients' order
        mid = (low + high) / 2
        if np.floor(w / mid + 0.5).sum() <= seats:
            high = mid
        else:
            low = mid
    n = np.floor(w / high + 0.5).astype(int)
    heap = [(-w[i] / (2 * n[i] + 1), i) for i in range(len(w)) if w[i] > 0]
    heapq.heapify(heap)
    for _ in range(seats - int(n.sum())):
        _, i = heap[0]
        n[i] += 1
        heapq.heapreplace(heap, (-w[i] / (2 * n[i] + 1), i))
    return n.tolist()


def targets(sizes: list[int], weights=WEIGHTS, share=SHARE, most=MOST) -> list[float]:
    """Words wanted of each source, in order of the sources."""
    w = [weights[i % len(weights)] for i in range(len(sizes))]
    goal, out = share * sum(sizes), [0.0] * len(sizes)
    free = [i for i, s in enumerate(sizes) if s]
    while free:
        rest = goal - sum(out[i] for i in range(len(sizes)) if i not in set(free))
        unit = rest / sum(w[i] for i in free)
        over = [i for i in free if unit * w[i] > most * sizes[i]]
        if not over:
            for i in free:
                out[i] = unit * w[i]
            break
        for i in over:
            out[i] = float(most * sizes[i])
        free = [i for i in free if i not in set(over)]
    return out


def mix(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights=WEIGHTS, share=SHARE, most=MOST,
    block=BLOCK, seed=SEED, order_by: tuple[str, ...] = ()
) -> DataFrame:
    """Per row: id, source, size, source_size, target, taken, and what is taken of it:
    laps (whole copies) and words [from_a, to_a) and [from_b, to_b) once more.

    Null or empty texts have size 0 and are taken 0 times. A null source is a
    source of its own, the last. Repeated rows are rows like others; null ids
    hash alike; an empty table gives an empty result. Sources, not documents,
    come to the driver; a shard of a hot source is bounded by salting with ids.
    The seeded order goes by the columns order_by, else by the id; rows alike
    in them by the id.
    """

    def work(batches):
        for b in slices(batches):
            n = [len(x.encode().split()) if x else 0 for x in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(n, pa.int64()), b.column(3)], names=["k", "source", "size", "h"]
            )

    h = F.xxhash64(*(order_by or (id_col,)), F.lit(seed))
    src = df.select(
        F.col(id_col).alias("k"), F.col(source_col).cast("string").alias("source"), F.col(text_col).cast("string").alias("t"), h.alias("h")
    )
    sized = materialize(src.mapInArrow(work, f"k {src.schema['k'].dataType.simpleString()}, source string, size long, h long"), "sizes")
    sized = sized.withColumn("src", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n")))
    per = {r["src"]: r["n"] for r in sized.groupBy("src").agg(F.sum("size").alias("n")).collect()}
    names = sorted(per, key=lambda s: (s == "n", s))
    goals = targets([per[s] for s in names], weights, share, most)
    blocks = sainte_lague(goals, round(sum(goals) / block))
    spark = df.sparkSession
    table = spark.createDataFrame(
        [(s, per[s], float(t), q, shard_count(per[s])) for s, t, q in zip(names, goals, blocks)],
        "src string, source_size long, target double, blocks long, shards long"
    )
    dealt = sized.join(F.broadcast(table), "src").withColumn("shard", F.pmod("h", "shards"))

    def quotas(f: pd.DataFrame) -> pd.DataFrame:
        f = f.sort_values("shard", ignore_index=True)
        n = np.array(sainte_lague(f["shard_size"].tolist(), int(f["blocks"].iloc[0])), dtype=np.int64)
        f["take"] = np.minimum(n * block, most * f["shard_size"])
        return f[["src", "shard", "shard_size", "take"]]

    quota = dealt.groupBy("src", "shard", "blocks").agg(F.sum("size").alias("shard_size")).groupBy("src").applyInPandas(
        quotas, "src string, shard long, shard_size long, take long"
    )
    order = Window.partitionBy("src", "shard").orderBy("h", "k", "size").rowsBetween(Window.unboundedPreceding, 0)
    out = dealt.withColumn("at", F.sum("size").over(order) - F.col("size")).join(quota, ["src", "shard"])
    some = F.greatest(F.col("shard_size"), F.lit(1))
    out = out.withColumns({
        "laps": F.floor(F.col("take") / some), "extra": F.col("take") % some,
        "begin": F.pmod(F.xxhash64("src", "shard", F.lit(seed)), F.ceil(some / block)) * block
    })
    end, size = F.col("begin") + F.col("extra"), F.col("size")
    clip = lambda x: F.greatest(F.lit(0), F.least(size, x - F.col("at"))).cast("long")
    out = out.withColumns({
        "from_a": clip(F.col("begin")), "to_a": clip(end), "from_b": F.lit(0).cast("long"), "to_b": clip(end - F.col("shard_size"))
    })
    taken = F.col("laps") * size + F.col("to_a") - F.col("from_a") + F.col("to_b")
    return out.select(
        F.col("k").alias(id_col), "source", "size", "source_size", "target", taken.cast("long").alias("taken"), "laps", "from_a", "to_a",
        "from_b", "to_b"
    )


def query(spark, sf_dir: str) -> DataFrame:
    return mix(read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")
