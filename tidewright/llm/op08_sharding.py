"""Sharding by a k-d tree over text metadata, cut at weighted medians.

Native: DataFrame functions only. Every node is cut along its widest dimension
at the median of bytes, until leaves reach the target bytes. The dimensions
are properties of the text (bytes, bytes a character, characters a word), each
scaled by the table's own quantiles, so that all weigh alike. Medians come
from histograms of bounded size, refined until the bin that holds the median
is small. Ties within a dimension are ordered by the text's hash, so equal
texts stay together unless a group alone is too heavy for a shard; then it is
cut by the ids' hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import materialize, read

LEVELS, MOST_LEVELS = 4, 12
#: Share of a leaf's bytes by which a cut may miss the median to keep a group whole; a group of twice that is never cut.
TOLERANCE = 0.025
DIMS = ("bytes", "bytes_per_char", "chars_per_word")
#: Scaling: quantiles that lie a quarter of the scale from its ends, their accuracy, and the scale.
LOW, HIGH, ACCURACY, SCALE = 0.05, 0.95, 1000, 4096
#: Hex digits of a sort key: dimension, text hash, id hash; and of a histogram's step.
DIM, TEXT, ROW, STEP = 3, 16, 16, 3


def _metadata(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    size = F.octet_length(text).cast("long") + 1
    chars = F.length(text)
    digits = lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")
    return df.select(
        F.col(id_col).alias("k"), size.alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.log2(size.cast("double")).alias("bytes"),
        ((size - 1) / F.greatest(chars, F.lit(1))).cast("double").alias("bytes_per_char"),
        F.log2((chars + 1) / (chars - F.length(F.replace(text, F.lit(" "), F.lit(""))) + 1)).alias("chars_per_word"),
        F.concat(digits(F.xxhash64(text)), digits(F.xxhash64(id_col, F.lit(3)))).alias("hashes"),
    )


def _scaled(rows: DataFrame) -> DataFrame:
    """The dimensions as integers below SCALE: the quantiles LOW and HIGH lie at one and three quarters of it."""
    ends = rows.agg(*[F.percentile_approx(d, [LOW, HIGH], ACCURACY).alias(d) for d in DIMS]).first()
    new = {}
    for d in DIMS:
        low, high = ends[d] or (0.0, 0.0)
        width = max(high - low, 1e-9)
        at = F.floor((F.col(d) - low) / width * (SCALE // 2) + SCALE // 4)
        new[d] = F.greatest(F.lit(0), F.least(at, F.lit(SCALE - 1))).cast("int") if high > low else F.lit(SCALE // 2)
    return rows.withColumns(new)


def _beyond(dim: str, cut: str) -> Column:
    """Whether a row's key, the dimension as DIM hex digits and then the hashes, is cut or more."""
    at = int(cut[:DIM], 16)
    return (F.col(dim) > at) | ((F.col(dim) == at) & (F.col("hashes") >= cut[DIM:]))


def shard(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", levels: int = LEVELS, target_bytes: int | None = None
) -> DataFrame:
    """Per row: id, size, text_crc32, law ('bytes'), shard, slot, grown_shard (null).

    2 ** levels shards of nearly equal bytes; with target_bytes as many levels
    as leaves need to be no larger (MOST_LEVELS at most). Null texts have size
    1 like empty ones; repeated rows and null ids are rows like others (rows
    that are alike in everything may take each other's slot); an empty table
    gives an empty result; other columns are ignored. The driver holds the
    tree and at most SCALE bins a node.
    """
    rows = materialize(_metadata(df, id_col, text_col), "kd")
    total = rows.agg(F.sum("size")).first()[0] or 0
    if target_bytes:
        levels = min(MOST_LEVELS, max(0, (-(-total // target_bytes) - 1).bit_length()))
    leaves = 1 << levels
    rows = _scaled(rows).withColumn("node", F.lit(0))
    for _ in range(levels):  # a level writes its rows' nodes, some 60 bytes a row, so that the next reads them
        extent = [(F.max(d) - F.min(d)).alias(d) for d in DIMS]
        info = {r["node"]: r for r in rows.groupBy("node").agg(F.sum("size").alias("weight"), *extent).collect()}
        widest = {n: max(DIMS, key=lambda d: (r[d], -DIMS.index(d))) for n, r in info.items()}
        value = F.lit(0)
        for n, d in widest.items():
            value = F.when(F.col("node") == n, F.col(d)).otherwise(value)
        key = F.concat(F.lpad(F.lower(F.hex(value.cast("long"))), DIM, "0"), "hashes")
        cuts = _medians(
            rows.select("node", "size", key.alias("key")), {n: r["weight"] for n, r in info.items()}, TOLERANCE * total / leaves
        )
        right = F.lit(0)
        for n, cut in cuts.items():
            right = F.when(F.col("node") == n, _beyond(widest[n], cut).cast("int")).otherwise(right)
        rows = materialize(rows.withColumn("node", F.col("node") * 2 + right), "kd")
    rows = rows.select("k", "size", "text_crc32", "hashes", F.col("node").cast("int").alias("shard"))

    buckets = min(65536, max(1, -(-rows.count() // (512 * leaves))))
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("hashes"), F.lit(buckets)))
    before = rows.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = before.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))).drop("n")
    inside = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("hashes", "k", "size"))
    out = rows.withColumn("inside", inside).join(before, ["shard", "bucket"])
    slot = (F.col("before") + F.col("inside") - 1).cast("long")
    return out.select(
        F.col("k").alias(id_col), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", slot.alias("slot"),
        F.lit(None).cast("int").alias("grown_shard")
    )


def _medians(at: DataFrame, weight: dict[int, int], tolerance: float) -> dict[int, str]:
    """For each node a key such that about half of its bytes lie below: off by tolerance at most, unless a single row is heavier."""
    cuts: dict[int, str] = {}
    open_, below, length = {n: "" for n in weight}, {n: 0 for n in weight}, 0
    while open_:
        step = STEP if length + STEP <= DIM + TEXT or length >= DIM + TEXT else DIM + TEXT - length
        length += step
        mine = F.lit(False)
        for n, prefix in open_.items():
            mine = mine | ((F.col("node") == n) & F.col("key").startswith(prefix))
        bins: dict[int, list] = {n: [] for n in open_}
        for r in at.where(mine).groupBy("node", F.substring("key", 1, length).alias("p")).agg(F.sum("size").alias("w")).collect():
            bins[r["node"]].append((r["p"], r["w"]))
        for n in list(open_):
            half, run = weight[n] / 2, below[n]
            for p, w in sorted(bins[n]):
                if run + w >= half:
                    break
                run += w
            fine = min(half - run, run + w - half) <= tolerance
            if fine or length >= DIM + TEXT + ROW:
                # every key of the bin is below p followed by a character above the hex digits
                cuts[n] = p if half - run <= run + w - half else p + "g"
                del open_[n]
            else:
                open_[n], below[n] = p, run
    return cuts


def query(spark, sf_dir: str) -> DataFrame:
    return shard(read(spark, sf_dir, "documents"))
