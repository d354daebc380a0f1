"""Near-duplicate vectors by randomised-rotation binary codes.

Vectors are normalised and turned by seeded random rotations; the signs are
their codes, and with each code goes the correction factor <sign, x>. Bands of
code bits bring pairs together. First only codes move: the share of equal bits
is an unbiased estimate of the angle, and its confidence bound drops every
vector without a possible partner in its bucket. Then the vectors of the
others move; the unbiased estimate <sign, q> / factor of the inner product and
its bound decide which pairs are computed again exactly, in double precision.
A pair counts in the first band that it shares. What leaves a bucket is a
count and an edge per vector, never the pairs themselves.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import components, counted, materialize, read, result_of, slices

COSINE, MISS, EPS, SEED = 0.98, 1e-5, 4.0, 41
#: Rows of a memtable; vectors of a tile of a bucket (a task holds two tiles); of a bucket compared along with others; pairs computed at once.
MEMTABLE_ROWS, TILE, SMALL, PAIRS = 4096, 2048, 64, 1 << 18
#: Buckets of several tiles that are broadcast at most (some 5 MB); more are joined by shuffle.
BIG_MOST = 1 << 16
ENTRY = "run long, slot int, label string, vec binary, ids array<long>"


@lru_cache(64)
def rotation(dim: int, k: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng([SEED, dim, k]).normal(size=(dim, dim)))
    return q * np.sign(np.diag(r))


def bands(n: int, cosine: float = COSINE, miss: float = MISS) -> tuple[int, int]:
    """(bits, bands): about one unrelated vector of n a bucket, and a pair at the threshold missed with probability miss."""
    bits = min(60, max(6, math.ceil(math.log2(max(2, n)))))
    p = (1 - math.acos(cosine) / math.pi) ** bits
    return bits, math.ceil(math.log(miss) / math.log(1 - p))


def differing(bits: int, cosine: float) -> int:
    """The most differing bits of two codes that may reach the cosine: their number is binomial, bounded by EPS deviations."""
    p = math.acos(cosine) / math.pi
    return math.floor(bits * p + EPS * math.sqrt(bits * p * (1 - p)) + 1)


def _blobs(column: pa.Array, width: int) -> np.ndarray:
    """A binary column whose values all have width bytes, as rows of bytes."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    first = np.frombuffer(column.buffers()[1], np.int32)[column.offset]
    return np.frombuffer(column.buffers()[2], np.uint8)[first : first + len(column) * width].reshape(-1, width)


def _binary(rows: np.ndarray) -> pa.Array:
    """Rows of bytes as a binary column."""
    rows = np.ascontiguousarray(rows)
    ends = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(rows.tobytes())])


def units(raw: np.ndarray) -> np.ndarray:
    """Rows of bytes as unit vectors in double precision."""
    x = raw.view("<f8")
    top = np.abs(x).max(axis=1, keepdims=True)
    x = x / top
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _entries(df: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """A task's vectors, equal ones together; label null where nothing links."""

    def work(batches):
        run, table, rows = TaskContext.get().partitionId() << 32, {}, 0

        def flush():
            cols = [[run] * len(table), range(len(table)), *zip(*table), list(table.values())]
            kinds = [pa.int64(), pa.int32(), pa.string(), pa.binary(), pa.list_(pa.int64())]
            return pa.RecordBatch.from_arrays(
                [pa.array(list(c), k) for c, k in zip(cols, kinds)], names=["run", "slot", "label", "vec", "ids"]
            )

        for b in slices(batches):
            for k, v, label in zip(*(c.to_pylist() for c in b.columns)):
                key = (None, None)
                if label is not None and v and None not in v:
                    x = np.array(v, "<f8") + 0.0
                    if np.isfinite(x).all() and x.any():
                        key = (label, x.tobytes())
                table.setdefault(key, []).append(k)
                rows += 1
                if rows >= MEMTABLE_ROWS:
                    yield flush()
                    run, table, rows = run + 1, {}, 0
        if table:
            yield flush()

    src = df.select(F.col(id_col).cast("long").alias("k"), F.col(vec_col).alias("v"), F.col(label_col).cast("string").alias("label"))
    return src.mapInArrow(work, ENTRY)


def _codes(classes: DataFrame, bits: int, count: int) -> DataFrame:
    """(label, cid, dim, keys, code, factor): each class's keys by band, all its code bits, and the factor of the first rotation."""

    def work(batches):
        for b in slices(batches, 4096):
            width = pc.binary_length(b.column("vec")).to_numpy()
            for size in np.unique(width):
                at = pa.array(np.flatnonzero(width == size))
                part, dim = b.take(at), int(size) // 8
                unit = units(_blobs(part.column("vec"), int(size)))
                turned = [unit @ rotation(dim, k) for k in range(-(-bits * count // dim))]
                sign = np.concatenate([t >= 0 for t in turned], axis=1)
                place = 1 << np.arange(bits, dtype=np.int64)
                keys = np.stack([sign[:, i * bits : (i + 1) * bits] @ place for i in range(count)], axis=1)
                factor = np.abs(turned[0]).sum(axis=1) / math.sqrt(dim)
                ends = pa.array(np.arange(len(keys) + 1, dtype=np.int32) * count)
                cols = [part.column("label"), part.column("cid"), pa.array(np.full(len(keys), dim, np.int32))]
                cols += [pa.ListArray.from_arrays(ends, pa.array(keys.reshape(-1))), _binary(np.packbits(sign, axis=1)), pa.array(factor)]
                yield pa.RecordBatch.from_arrays(cols, names=["label", "cid", "dim", "keys", "code", "factor"])

    kind = "label string, cid long, dim int, keys array<long>, code binary, factor double"
    return classes.select("cid", "label", "vec").mapInArrow(work, kind)


def _blocks(rows: DataFrame, keys: list[str], slim: DataFrame | None = None) -> DataFrame:
    """Rows of a bucket (keys) in blocks of two tiles (i, j), where a bucket is larger than one tile; sorted by block.

    A bucket is cut into tiles by a salt; a row goes to every block of its
    tile, as tile i (side 0) or j (side 1). Most buckets are one block, and
    where all are, nothing is joined. slim: the same rows with the keys only.
    """
    big = (rows if slim is None else slim).groupBy(*keys).agg(F.ceil(F.count("*") / TILE).cast("int").alias("tiles")).where("tiles > 1")
    big, many = counted(big, "big")
    if many:
        rows_ = rows.join(F.broadcast(big) if many <= BIG_MOST else big, keys, "left")
        joined = rows_.withColumn("tiles", F.coalesce("tiles", F.lit(1)))
    else:
        joined = rows.withColumn("tiles", F.lit(1))
    joined = joined.withColumn("t", F.pmod(F.xxhash64("cid"), F.col("tiles")).cast("int"))
    other = F.sequence(F.lit(0), F.col("tiles") - 1)
    pair = F.transform(
        other, lambda o: F.struct(F.least("t", o).alias("i"), F.greatest("t", o).alias("j"), (F.col("t") > o).cast("int").alias("side"))
    )
    dealt = joined.withColumn("to", F.explode(pair)).select(*rows.columns, "to.i", "to.j", "to.side")
    return dealt.repartition(*keys, "i", "j").sortWithinPartitions(*keys, "i", "j")


def _starts(b: pa.RecordBatch | pa.Table, keys: list[str]) -> np.ndarray:
    """Where blocks begin among sorted rows."""
    new = np.ones(b.num_rows, bool)
    if b.num_rows > 1:
        new[1:] = False
        for k in (*keys, "i", "j"):
            c = b.column(k)
            new[1:] |= pc.not_equal(c.slice(1), c.slice(0, len(c) - 1)).to_numpy(zero_copy_only=False)
    return np.flatnonzero(new)


def _whole_blocks(batches, keys: list[str]):
    """Tables of whole blocks out of sorted batches; never more than a batch and a block of two tiles."""
    held: list[pa.RecordBatch] = []
    for b in slices(batches, 8192):
        held.append(b)
        table = pa.Table.from_batches(held).combine_chunks()
        last = _starts(table, keys)[-1] if table.num_rows else 0
        if last:
            yield table.slice(0, last).combine_chunks()
        held = table.slice(last).to_batches()
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _each_block(batches, keys: list[str]):
    for table in _whole_blocks(batches, keys):
        at = [*_starts(table, keys).tolist(), table.num_rows]
        for lo, hi in zip(at, at[1:]):
            if hi - lo > 1:
                yield table.slice(lo, hi - lo).combine_chunks()


def _sides(side: np.ndarray, i: int, j: int) -> tuple[np.ndarray, np.ndarray]:
    left = np.flatnonzero(side == 0)
    return left, left if i == j else np.flatnonzero(side == 1)


def _words(code: np.ndarray) -> np.ndarray:
    pad = -code.shape[1] % 8
    return np.ascontiguousarray(np.pad(code, ((0, 0), (0, pad)))).view(np.uint64)


def _far(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Differing bits of each pair of codes."""
    out = np.zeros((len(x), len(y)), np.uint16)
    for w in range(x.shape[1]):
        out += np.bitwise_count(x[:, w, None] ^ y[None, :, w])
    return out


def _hopeful(codes: DataFrame, bits: int, count: int, cosine: float) -> DataFrame:
    """(cid, band) of classes whose code leaves a partner possible in their bucket.

    Buckets go by a hash of label, length, band and key: two that share it are
    compared for nothing, but lose nothing.
    """
    flat = codes.select("cid", "dim", "code", "label", F.posexplode("keys").alias("band", "key"))
    flat = flat.select(F.xxhash64("label", "dim", "band", "key").alias("bucket"), "cid", "band", "dim", "code")
    placed = _blocks(flat, ["bucket"])

    def small(code: np.ndarray, start: np.ndarray, size: np.ndarray, most: int) -> np.ndarray:
        """Hope of the rows of small blocks, all blocks at once: each row against the next, the one after, and so on."""
        hope = np.zeros(len(code), bool)
        end = np.repeat(start + size, size)
        row = np.repeat(start - np.cumsum(size) + size, size) + np.arange(size.sum())
        for step in range(1, SMALL):
            keep = row + step < end
            row, end = row[keep], end[keep]
            if not len(row):
                break
            near = row[np.bitwise_count(code[row] ^ code[row + step]).sum(axis=1) <= most]
            hope[near] = hope[near + step] = True
        return hope

    def large(code: np.ndarray, a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
        hope = np.zeros(len(code), bool)
        for lo in range(0, len(a), 512):
            rows = a[lo : lo + 512]
            close = _far(code[rows], code[b]) <= most
            if a is b:
                close[np.arange(len(rows)), lo + np.arange(len(rows))] = False
            hope[rows] |= close.any(axis=1)
            hope[b] |= close.any(axis=0)
        return hope

    def work(batches):
        for whole in _whole_blocks(batches, ["bucket"]):
            dims = whole.column("dim").to_numpy()
            for dim in np.unique(dims).tolist():
                table = whole.filter(pa.array(dims == dim)).combine_chunks()
                total = dim * -(-bits * count // dim)
                code, most = _words(_blobs(table.column("code"), -(-total // 8))), differing(total, cosine)
                start = _starts(table, ["bucket"])
                size = np.diff(np.append(start, table.num_rows))
                i, j, side = (table.column(k).to_numpy() for k in ("i", "j", "side"))
                few = (size <= SMALL) & (i[start] == j[start])
                hope = small(code, start[few], size[few], most)
                for lo, n in zip(start[~few].tolist(), size[~few].tolist()):
                    a, b = _sides(side[lo : lo + n], i[lo], j[lo])
                    hope[lo : lo + n] = large(code[lo : lo + n], a, b, most)
                if hope.any():
                    yield from table.select(["cid", "band"]).filter(pa.array(hope)).to_batches()

    return placed.mapInArrow(work, "cid long, band int").distinct()


def _forest(n: int, a: np.ndarray, b: np.ndarray, parent: np.ndarray | None = None) -> np.ndarray:
    """Roots of the components of edges (a, b) over n nodes, by hooking and pointer jumping."""
    root = np.arange(n) if parent is None else parent
    while len(a):
        x, y = root[a], root[b]
        low, high = np.minimum(x, y), np.maximum(x, y)
        np.minimum.at(root, high, low)
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up
        keep = root[a] != root[b]
        a, b = a[keep], b[keep]
    return root


def _links(classes: DataFrame, codes: DataFrame, hopeful: DataFrame, bits: int, count: int, cosine: float) -> tuple[DataFrame, DataFrame]:
    """(cid, far): vectors of other classes linked, counted with copies; (a, b): edges that connect what is linked."""
    each = hopeful.groupBy("cid").agg(F.collect_list("band").alias("bands"))  # at most all bands
    each = materialize(codes.join(each, "cid"), "hopeful")
    bucket = ["label", "dim", "band", "key"]
    spread = lambda df: df.withColumn("band", F.explode("bands")).withColumn("key", F.get("keys", "band")).drop("bands")
    whole = spread(each.join(classes.select("cid", "vec", "n"), "cid"))
    placed = _blocks(whole, bucket, spread(each).select(*bucket))

    def work(batches):
        for table in _each_block(batches, bucket):
            i, j, dim, band = (table.column(k)[0].as_py() for k in ("i", "j", "dim", "band"))
            a, b = _sides(table.column("side").to_numpy(), i, j)
            if not len(a) or not len(b):
                continue
            unit = units(_blobs(table.column("vec"), 8 * dim))
            code = _blobs(table.column("code"), -(-dim * -(-bits * count // dim) // 8))
            sign = np.unpackbits(code[:, : -(-dim // 8)], axis=1, count=dim).astype(np.float32) * 2 - 1
            turned = (unit @ rotation(dim, 0)).astype(np.float32)
            f = table.column("factor").to_numpy().astype(np.float32)
            slack = EPS * np.sqrt(np.maximum(1 - f * f, 0) / (f * f) / max(1, dim - 1)) + np.float32(1e-5)
            keys = table.column("keys").combine_chunks().flatten().to_numpy().reshape(-1, count)[:, :band]
            n, cid = table.column("n").to_numpy(), table.column("cid").to_numpy()
            far, root = np.zeros(len(n), np.int64), np.arange(len(n))
            for lo in range(0, len(a), 512):
                rows = a[lo : lo + 512]
                maybe = (sign[rows] @ turned[b].T) / math.sqrt(dim) / f[rows, None] + slack[rows, None] >= cosine
                if a is b:
                    maybe &= b[None, :] > rows[:, None]
                p, q = np.nonzero(maybe)
                for at in range(0, len(p), PAIRS):
                    u, v = rows[p[at : at + PAIRS]], b[q[at : at + PAIRS]]
                    ok = np.einsum("ij,ij->i", unit[u], unit[v]) >= cosine
                    u, v = u[ok], v[ok]
                    first = ~(keys[u] == keys[v]).any(axis=1)  # counted in the first band that the two share
                    u, v = u[first], v[first]
                    far += np.bincount(u, n[v], len(n)).astype(np.int64) + np.bincount(v, n[u], len(n)).astype(np.int64)
                    root = _forest(len(n), u, v, root)
            some = np.flatnonzero((far > 0) | (root != np.arange(len(n))))
            if len(some):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cid[some]), pa.array(cid[root[some]]), pa.array(far[some])], names=["a", "b", "far"]
                )

    found = materialize(placed.mapInArrow(work, "a long, b long, far long"), "links")
    return found.groupBy(F.col("a").alias("cid")).agg(F.sum("far").alias("far")), found.where("a != b").select("a", "b").distinct()


def embedding_dedup(
    df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", cosine: float = COSINE, miss: float = MISS
) -> DataFrame:
    """Per row: id, n_links, component_id, kept.

    Vectors of different length never link, nor do those that are null, empty
    or zero, or hold null or non-finite values, or have a null label: such a
    row has no link and is its own component. Identical vectors become one
    class first, whose size counts towards n_links, so a hot vector costs one
    row per task. Repeated rows count as other vectors; an empty table gives
    an empty result; other columns are ignored. A bucket larger than TILE is
    compared in blocks, each a task's work of bounded size.
    """
    return result_of(df.sparkSession, lambda: _dedup(df, id_col, vec_col, label_col, cosine, miss), "near")


def _dedup(df: DataFrame, id_col: str, vec_col: str, label_col: str, cosine: float, miss: float) -> DataFrame:
    entries = materialize(_entries(df, id_col, vec_col, label_col), "vectors")
    keyed = entries.where("label is not null").withColumns({"h": F.xxhash64("label", "vec"), "g": F.xxhash64("vec", "label", F.lit(SEED))})
    least = F.min(F.struct("run", "slot")).alias("at")
    classes = keyed.groupBy("h", "g").agg(
        least, F.first("label").alias("label"), F.first("vec").alias("vec"), F.min(F.array_min("ids")).alias("rep"),
        F.sum(F.size("ids")).alias("n")
    )
    # a class is named by its first entry, which no other class has
    classes = materialize(classes.withColumn("cid", F.col("at.run") * MEMTABLE_ROWS + F.col("at.slot")).drop("at"), "classes")
    most = classes.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    bits, count = bands(most, cosine, miss)
    codes = materialize(_codes(classes, bits, count), "codes")
    hopeful = materialize(_hopeful(codes, bits, count, cosine), "hope")
    far, edges = _links(classes, codes, hopeful, bits, count, cosine)
    comp = components(edges).withColumnRenamed("node", "cid")
    info = classes.select("cid", "h", "g", "rep", "n").join(far, "cid", "left").join(comp, "cid", "left").withColumn(
        "component", F.coalesce("component", "cid")
    )
    least = info.groupBy("component").agg(F.min("rep").alias("component_id"))
    info = info.join(least, "component").select(
        "h", "g", "component_id", (F.col("n") - 1 + F.coalesce("far", F.lit(0))).cast("long").alias("n_links")
    )
    linked = keyed.select("h", "g", "ids").join(info, ["h", "g"]).select(F.explode("ids").alias(id_col), "n_links", "component_id")
    alone = entries.where("label is null").select(F.explode("ids").alias(id_col))
    alone = alone.select(id_col, F.lit(0).cast("long").alias("n_links"), F.col(id_col).alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id")))


def query(spark, sf_dir: str) -> DataFrame:
    return embedding_dedup(read(spark, sf_dir, "embeddings"))


SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0 AND len(list_filter(embedding, lambda e: e <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
  WHERE list_cosine_similarity(a.x, b.x) >= 0.98),
r(a, b) AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a), c AS (SELECT a, min(b) AS m FROM r GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(m, vec_id)) AS component_id, vec_id = least(vec_id, coalesce(m, vec_id)) AS kept
FROM embeddings LEFT JOIN n ON n.a = vec_id LEFT JOIN c ON c.a = vec_id
"""
