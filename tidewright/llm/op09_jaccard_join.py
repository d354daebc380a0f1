"""Jaccard join of 5-word shingle sets by a token-group matrix.

Texts with one shingle set are one class. Classes are put into groups of
similar documents: those that share a band of minimum hashes are compared with
the band's leader, then with leaders of their tokens, and verified links form
the groups. Then the matrix: for
each token of a class's prefix, the groups whose union of prefix tokens holds
it. Two sets with Jaccard >= 3/4 share a token of their prefixes (the rarest
n - ceil(3 n / 4) + 1 of each), so a query whose prefix has no token in a
group's union has overlap below the bound there and leaves the group closed.
Qualifying pairs of groups are opened: first by one pair of documents, then,
if that doesn't link them, by every pair that shares a token. Pairs whose
parity bits differ in more places than linked sets can are dropped, and every
link is decided on whole sets of 64-bit hashes. A class is named by 64 bits of
its set's digest; 64 more show where two sets share a name, and those get new ones.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from .common import components, counted, materialize, maybe_in, read, result_of, slices

SHINGLE, NUM, DEN = 5, 3, 4
#: Bands of ROWS minimum hashes that propose groups; classes of a band's salt, and pairs of a leader's, at most (on average).
BANDS, ROWS, BAND_ROWS, LEAD_ROWS = 5, 2, 1 << 16, 1024
#: Leaders of many pairs that are broadcast at most (2 MB); more are joined by shuffle.
BUSY_MOST = 1 << 16
MEMTABLE_ROWS, MEMTABLE_BYTES = 2048, 8 << 20
#: Tokens a task counts at least HEAVY times are put last in prefixes; the list has at most HEAVY_MOST (it only orders).
HEAVY, HEAVY_TASK, HEAVY_MOST = 6, 4096, 65536
SHARD_TOKENS = 1 << 19
#: Bytes of a word hashed by its bytes, and of a block of a text.
SHORT, BLOCK = 32, 1 << 18
#: Fixed odd multipliers of the shingle hash.
MULT = np.array([pow(0x9E3779B97F4A7C15, 2 * i + 1, 1 << 64) for i in range(SHINGLE)], np.uint64)
BAND_MULT = np.array([pow(0xD1342543DE82EF95, 2 * i + 1, 1 << 64) for i in range(BANDS * ROWS)], np.uint64)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


#: White space; a hash of each byte, A-Z as a-z; powers for places in a word.
GAPS = b" \t\n\r\x0b\x0c"
IS_GAP = np.isin(np.arange(256, dtype=np.uint8), np.frombuffer(GAPS, np.uint8))
BYTE = _mix(np.frombuffer(bytes(range(256)).lower(), np.uint8).astype(np.uint64) + np.uint64(1))
PLACE = np.array([pow(0x9E3779B97F4A7C15, i, 1 << 64) for i in range(SHORT)], np.uint64)


def _word_hashes(text: bytes) -> np.ndarray:
    """A 64-bit hash of each word, lower-cased: of short words from their bytes' hashes, all at once."""
    b = np.frombuffer(text, np.uint8)
    edge = np.flatnonzero(np.diff(IS_GAP[b], prepend=True, append=True))
    start, length = edge[::2], edge[1::2] - edge[::2]
    if not len(start):
        return np.zeros(0, np.uint64)
    first = np.repeat(start - np.cumsum(length) + length, length)
    place = np.arange(len(first)) + first
    part = BYTE[b[place]] * PLACE[np.minimum(place - np.repeat(start, length), SHORT - 1)]
    h = _mix(np.add.reduceat(part, np.cumsum(length) - length) + length.astype(np.uint64))
    for i in np.flatnonzero(length > SHORT):
        h[i] = xxhash.xxh3_64_intdigest(text[start[i] : start[i] + length[i]].lower())
    return h


def _blocks(text: bytes):
    """The text in blocks of about BLOCK bytes, cut at white space."""
    at = 0
    while len(text) - at > BLOCK:
        end = max(text.rfind(g, at, at + BLOCK) for g in (GAPS[i : i + 1] for i in range(len(GAPS))))
        if end <= at:
            end = min((x for g in GAPS if (x := text.find(g, at + BLOCK)) >= 0), default=len(text))
        yield text[at:end]
        at = end
    yield text[at:]


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct hashes of a text's 5-word shingles."""
    w = np.concatenate([_word_hashes(b) for b in _blocks((text or "").encode())])
    if not len(w):
        return w
    if len(w) < SHINGLE:
        return np.array([xxhash.xxh3_64_intdigest(w.tobytes(), seed=len(w))], np.uint64)
    n = len(w) - SHINGLE + 1
    h = w[:n] * MULT[0]
    for i in range(1, SHINGLE):
        h += w[i : i + n] * MULT[i]
    h = _mix(h)
    h.sort()
    return h[np.concatenate([[True], h[1:] != h[:-1]])]


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    if NUM * max(len(a), len(b)) > DEN * min(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return DEN * both >= NUM * (len(a) + len(b) - both)


def _signature(s: np.ndarray) -> list[int]:
    low = [(s * m).min() for m in BAND_MULT]
    return [xxhash.xxh3_64_intdigest(b"".join(x.tobytes() for x in low[i * ROWS : (i + 1) * ROWS])) - (1 << 63) for i in range(BANDS)]


def _parity(s: np.ndarray) -> bytes:
    """Bits by the first binary digits of the tokens, as many as tokens or up to twice that; a bit is the parity of its count."""
    digits = max(6, (len(s) - 1).bit_length())
    return np.packbits(np.bincount((s >> np.uint64(64 - digits)).astype(np.int64), minlength=1 << digits).astype(np.uint8) & 1).tobytes()


def _differ(a: bytes, b: bytes) -> int:
    """At most the number of tokens that only one of two sets has, from their parities."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    if len(x) != len(y):
        x, y = sorted((x, y), key=len)
        y = np.packbits(np.bitwise_xor.reduce(np.unpackbits(y).reshape(8 * len(x), -1), axis=1))
    return int(np.bitwise_count(x ^ y).sum())


def _digest(raw: bytes) -> int:
    return xxhash.xxh3_128_intdigest(raw)


ENTRY = {
    "run": ("long", pa.int64()), "cid": ("long", pa.int64()), "more": ("long", pa.int64()), "n": ("long", pa.int64()),
    "sigs": ("array<long>", pa.list_(pa.int64())), "bits": ("binary", pa.binary()), "ids": ("array<long>", pa.list_(pa.int64())),
    "text": ("string", pa.string()),
}


def _entries(df: DataFrame, id_col: str, text_col: str, digest) -> DataFrame:
    """A task's classes (cid and more: the digest of the set) and, with cid null, tokens that it counted often (sigs) and their counts (ids)."""
    kinds = [k for _, k in ENTRY.values()]
    batch = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=list(ENTRY))
    signed = lambda x: (x & ((1 << 64) - 1)) - (1 << 63)

    def work(batches):
        run = TaskContext.get().partitionId() << 32
        table, rows, size, tokens = {}, 0, 0, []
        heavy: dict[int, int] = {}

        def flush():
            out = batch([(run, signed(d), signed(d >> 64), *e) for d, e in table.items()])
            t, c = np.unique(np.concatenate(tokens), return_counts=True) if tokens else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
            for x, k in zip(t[c >= HEAVY].tolist(), c[c >= HEAVY].tolist()):
                heavy[x] = heavy.get(x, 0) + k
            if len(heavy) > 16 * HEAVY_TASK:
                for x in sorted(heavy, key=heavy.get)[: len(heavy) - 8 * HEAVY_TASK]:
                    del heavy[x]
            return out

        for b in slices(batches):
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                s = shingles(text)
                d = digest(s.tobytes())
                if d in table:
                    table[d][3].append(doc)
                else:
                    table[d] = (len(s), _signature(s) if len(s) else [], _parity(s) if len(s) else None, [doc], text)
                    size += len(text or "")
                    tokens.append(s)
                rows += 1
                if rows >= MEMTABLE_ROWS or size >= MEMTABLE_BYTES:
                    yield flush()
                    run, table, rows, size, tokens = run + 1, {}, 0, 0, []
        if table:
            yield flush()
        top = sorted(heavy, key=lambda x: (-heavy[x], x))[:HEAVY_TASK]
        if top:
            yield batch([(run, None, None, 0, [x - (1 << 63) for x in top], None, [heavy[x] for x in top], None)])

    src = df.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    return src.mapInArrow(work, ", ".join(f"{n} {k}" for n, (k, _) in ENTRY.items()))


def _classes(entries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """entries and their classes, one row each: cid, run of an entry of it, n, sigs, bits, rep (its smallest id).

    Where sets that differ share a cid, their entries get new ones by the whole digest, until none do.
    """
    again = 0
    while True:
        one = [F.min("run").alias("run"), *[F.first(c).alias(c) for c in ("n", "sigs", "bits")], F.min(F.array_min("ids")).alias("rep")]
        found = entries.where("cid is not null").groupBy("cid").agg(*one, (F.min("more") != F.max("more")).alias("clash"))
        found = materialize(found, "classes")
        clash = found.where("clash").select("cid", "clash")
        if clash.isEmpty():
            return entries, found.drop("clash")
        again += 1
        new = F.when(F.col("clash"), F.xxhash64("cid", "more", F.lit(again))).otherwise(F.col("cid"))
        entries = materialize(entries.join(clash, "cid", "left").withColumn("cid", new).select(*ENTRY), "sets")


def _stars(classes: DataFrame, count: int) -> DataFrame:
    """(a, b): each class and the leader of its salted band, and those leaders and the band's; sizes allow a link."""
    salts = max(64, -(-count // BAND_ROWS))
    rows = classes.where("n > 0").select(
        "cid", "n", F.posexplode("sigs").alias("band", "sig")
    ).withColumn("salt", F.pmod(F.xxhash64("cid"), F.lit(salts)))
    least = F.min(F.struct("cid", "n"))
    lead = rows.groupBy("band", "sig", "salt").agg(least.alias("lead"), F.count("*").alias("size"))
    top = lead.groupBy("band", "sig").agg(F.min("lead").alias("top"), F.count("*").alias("size"))
    inner = rows.join(
        lead.where("size > 1").drop("size"), ["band", "sig", "salt"]
    ).select(F.struct("cid", "n").alias("a"), F.col("lead").alias("b"))
    outer = lead.drop("size").join(top.where("size > 1"), ["band", "sig"]).select(F.col("lead").alias("a"), F.col("top").alias("b"))
    fits = NUM * F.greatest("a.n", "b.n") <= DEN * F.least("a.n", "b.n")
    return inner.union(outer).where((F.col("a.cid") != F.col("b.cid")) & fits).select(
        F.col("a.cid").alias("a"), F.col("b.cid").alias("b")
    ).distinct()


def _close(pairs: DataFrame, count: int, classes: DataFrame) -> tuple[DataFrame, int]:
    """Pairs (a, b, salt, run, lead_run), and their number, without those whose parities alone rule out a link: two linked sets differ in at most (n + m) / 7 tokens.

    A leader b of many pairs has a salt for every LEAD_ROWS of them; run and lead_run name entries that hold the texts.
    """
    busy, leaders = None, 0
    if count > LEAD_ROWS:
        busy = pairs.groupBy("b").agg(F.ceil(F.count("*") / LEAD_ROWS).alias("salts")).where("salts > 1")
        busy, leaders = counted(busy, "busy")
    if leaders:
        pairs = pairs.join(F.broadcast(busy) if leaders <= BUSY_MOST else busy, "b", "left")
        pairs = pairs.withColumn("salt", F.pmod(F.xxhash64("a"), F.coalesce("salts", F.lit(1)))).drop("salts")
    else:
        pairs = pairs.withColumn("salt", F.lit(0).cast("long"))
    nodes = pairs.select("a").union(pairs.select("b"))
    bits = maybe_in(classes.select("cid", F.struct("n", "bits", "run").alias("x")), "cid", nodes, 2 * count)
    lead = pairs.select("b", "salt").distinct().join(bits.select(F.col("cid").alias("b"), F.col("x").alias("y")), "b")
    both = pairs.join(bits.withColumnRenamed("cid", "a"), "a").join(lead, ["b", "salt"])

    def check(batches):
        for batch in slices(batches, 4096):
            n, x, m, y = (batch.column(c).to_pylist() for c in ("n", "x", "m", "y"))
            yield batch.select(["a", "b", "salt", "run", "lead_run"]).filter(
                pa.array([(NUM + DEN) * _differ(x[i], y[i]) <= n[i] + m[i] for i in range(len(n))], pa.bool_())
            )

    runs = [F.col("x.run").alias("run"), F.col("y.run").alias("lead_run")]
    both = both.select(
        "a", "b", "salt", *runs, F.col("x.n").alias("n"), F.col("x.bits").alias("x"), F.col("y.n").alias("m"), F.col("y.bits").alias("y")
    )
    return counted(both.mapInArrow(check, "a long, b long, salt long, run long, lead_run long"), "close")


def _verify(pairs: DataFrame, entries: DataFrame, classes: DataFrame) -> DataFrame:
    """Of pairs (a, b), those that link: sets are built again from the texts, b's once for each salt."""
    pairs, count = counted(pairs, "pairs")
    if count:
        pairs, count = _close(pairs, count, classes)
    if not count:
        return pairs.select("a", "b")
    nodes = pairs.select("a").union(pairs.select("b"))
    text = maybe_in(entries.where("cid is not null").select("cid", "run", "text"), "cid", nodes, 2 * count)
    lead = pairs.select(F.col("b").alias("cid"), F.col("lead_run").alias("run"), "salt").distinct().join(text, ["cid", "run"])
    lead = lead.select(F.col("cid").alias("b"), "salt", F.lit(None).cast("long").alias("a"), "text")
    rest = pairs.select(F.col("a").alias("cid"), "run", "b", "salt").join(text, ["cid", "run"]).select(
        "b", "salt", F.col("cid").alias("a"), "text"
    )
    both = lead.union(rest).repartition("b", "salt").sortWithinPartitions("b", "salt", F.col("a").asc_nulls_first())

    def check(batches):
        now = None
        for batch in slices(batches):
            a_out, b_out = [], []
            for b, a, text in zip(*(batch.column(c).to_pylist() for c in ("b", "a", "text"))):
                if a is None:
                    now = shingles(text)
                elif linked(shingles(text), now):
                    a_out.append(a)
                    b_out.append(b)
            yield pa.RecordBatch.from_arrays([pa.array(a_out, pa.int64()), pa.array(b_out, pa.int64())], names=["a", "b"])

    return materialize(both.mapInArrow(check, "a long, b long"), "links")


def _may_link(c, least, most):
    """Bound of the overlap of two sets with c common prefix tokens.

    least: the sum of their sizes at least; most: the larger size at most. The
    set whose prefix ends first has all common tokens up to there among the c,
    and beyond it ceil(3 n / 4) - 1 tokens; a link needs 3 (n + m) / 7 in common.
    """
    beyond = F.floor((NUM * most + DEN - 1) / DEN) - 1
    return (NUM + DEN) * (c + beyond) >= NUM * least


def _postings(entries: DataFrame, heavy: list[int], shards: int) -> DataFrame:
    """(token, cid): prefix tokens that several classes have.

    Postings go by token to shards that keep what several classes share. Heavy
    tokens are shared for certain: theirs are dealt by class, so that no shard
    holds all of one.
    """
    rare_last = np.array(sorted(x + (1 << 63) for x in heavy), np.uint64)
    place = {x + (1 << 63): i for i, x in enumerate(heavy)}

    def emit(batches):
        for batch in slices(batches, 2048):
            cids, toks, at, often_ = [], [], [], []
            for cid, text in zip(*(batch.column(c).to_pylist() for c in ("cid", "text"))):
                s = shingles(text)
                if not len(s):
                    continue
                keep = len(s) - (NUM * len(s) + DEN - 1) // DEN + 1
                rare = keep
                if len(rare_last):
                    i = np.minimum(np.searchsorted(rare_last, s), len(rare_last) - 1)
                    often = rare_last[i] == s
                    rare = min(keep, int(len(s) - often.sum()))
                    last = sorted(s[often].tolist(), key=lambda x: -place[x]) if rare < keep else []
                    s = np.concatenate([s[~often], np.array(last, np.uint64)])
                at.append(np.full(keep, len(cids), np.uint32))
                often_.append(np.arange(keep) >= rare)
                cids.append(cid)
                toks.append(s[:keep])
            if not cids:
                continue
            t, i = np.concatenate(toks), np.concatenate(at)
            home = (t % np.uint64(shards)).astype(np.int64)
            ids = np.array(cids, np.int64)
            home = np.where(np.concatenate(often_), shards + (ids.view(np.uint64)[i] % np.uint64(shards)).astype(np.int64), home)
            order = np.argsort(home, kind="stable")
            edge = np.searchsorted(home[order], np.arange(2 * shards + 1))
            out = []
            for shard in range(2 * shards):
                o = order[edge[shard] : edge[shard + 1]]
                if len(o):
                    u = np.unique(i[o])
                    width = "<u2" if len(u) < 65536 else "<u4"
                    out.append((
                        shard, t[o].tobytes(), np.searchsorted(u, i[o]).astype(width).tobytes(), ids[u].tobytes(), int(len(u) < 65536)
                    ))
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=["shard", "tokens", "at", "cids", "narrow"])

    def meet(table: pa.Table) -> pa.Table:
        shared = table.column("shard")[0].as_py() >= shards
        t = np.concatenate([np.frombuffer(x, "<u8") for x in table.column("tokens").to_pylist()])
        cols = zip(*(table.column(k).to_pylist() for k in ("cids", "at", "narrow")))
        c = np.concatenate([np.frombuffer(x, "<i8")[np.frombuffer(a, "<u2" if narrow else "<u4")] for x, a, narrow in cols])
        order = np.lexsort((c, t))
        t, c = t[order], c[order]
        fresh = np.ones(len(t), bool)
        fresh[1:] = (t[1:] != t[:-1]) | (c[1:] != c[:-1])
        t, c = t[fresh], c[fresh]
        same = t[1:] == t[:-1]
        keep = np.full(len(t), shared)
        keep[1:] |= same
        keep[:-1] |= same
        return pa.table({"token": t[keep].view(np.int64), "cid": c[keep]})

    rows = entries.where("n > 0").select("cid", "text").mapInArrow(emit, "shard long, tokens binary, at binary, cids binary, narrow long")
    return rows.groupBy("shard").applyInArrow(meet, "token long, cid long")


def _grouped(classes: DataFrame, links: DataFrame) -> DataFrame:
    """(cid, n, grp): classes and their groups by the links so far."""
    groups = components(links).withColumnRenamed("node", "cid")
    return classes.select("cid", "n").join(groups, "cid", "left").withColumn("grp", F.coalesce("component", "cid")).drop("component")


def _leaders(posts: DataFrame) -> DataFrame:
    """(a, b): classes and the leader of a token of theirs, where it is in another group and may link.

    A token's leader is the class with the largest share of its prefix in
    other classes too: in a group of edited copies, the text they were made
    of. One leader a token keeps this linear; it only forms larger groups.
    """
    lead = posts.groupBy("token").agg(
        F.max(F.struct("score", "cid", "n", "grp")).alias("b"), F.min("grp").alias("low"), F.max("grp").alias("high")
    )
    lead = lead.where("low != high").select("token", "b")
    fits = NUM * F.greatest("n", "b.n") <= DEN * F.least("n", "b.n")
    met = posts.join(lead, "token").where((F.col("grp") != F.col("b.grp")) & fits)
    met = met.groupBy(F.col("cid").alias("a"), F.col("b.cid").alias("b")).agg(
        F.count("*").alias("c"), F.first(F.col("n") + F.col("b.n")).alias("least"), F.first(F.greatest("n", "b.n")).alias("most")
    )
    return met.where(_may_link(F.col("c"), F.col("least"), F.col("most"))).select("a", "b")


def jaccard_components(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest=_digest) -> DataFrame:
    """Per row: id, n_shingles, component_id (the smallest id reachable by links).

    Null texts and texts without a word have no shingle and link with nothing,
    not even with each other. Identical sets link; repeated rows too. Null ids
    are no smallest id unless alone. An empty table gives an empty result;
    other columns are ignored. Copies cost one row per task. digest may be
    replaced by a weaker one (tests do); results stay. Only what is needed for
    components is verified: links within a group are not enumerated.
    """
    return result_of(df.sparkSession, lambda: _components(df, id_col, text_col, digest), "components")


def _components(df: DataFrame, id_col: str, text_col: str, digest) -> DataFrame:
    entries, classes = _classes(materialize(_entries(df, id_col, text_col, digest), "sets"))
    heavy = entries.where("cid is null").select(
        F.explode(F.arrays_zip("sigs", "ids")).alias("x")
    ).groupBy("x.sigs").agg(F.sum("x.ids").alias("c"))
    heavy = [r[0] for r in heavy.orderBy(F.desc("c"), "sigs").limit(HEAVY_MOST).collect()]
    count, total = classes.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()

    links = _verify(_stars(classes, count), entries, classes)
    sized = materialize(_grouped(classes, links), "groups")

    # the join has dealt the rows by cid already; a window holds the prefix of one class
    prefix = F.col("n") - F.floor((NUM * F.col("n") + DEN - 1) / DEN) + 1
    posts = _postings(entries, heavy, max(1, -(-total // (DEN * SHARD_TOKENS)))).join(sized, "cid")
    posts = materialize(posts.withColumn("score", F.count("*").over(Window.partitionBy("cid")) / prefix), "posts")
    links = materialize(links.union(_verify(_leaders(posts), entries, classes)), "links")
    sized = materialize(_grouped(classes, links), "groups")
    posts = materialize(posts.select("token", "cid").join(sized, "cid"), "posts")
    matrix = posts.groupBy("token", "grp").agg(F.min("cid").alias("rep"))
    shared = matrix.groupBy("token").agg(F.count("*").alias("groups")).where("groups > 1").select("token")
    span = sized.groupBy("grp").agg(F.min("n").alias("low"), F.max("n").alias("high"), F.count("*").alias("members"))
    matrix = materialize(matrix.join(shared, "token", "left_semi").join(span, "grp"), "matrix")
    x, y = matrix.alias("x"), matrix.alias("y")
    near = (F.col("x.grp") < F.col("y.grp")) & (
        NUM * F.col("x.low") <= DEN * F.col("y.high")
    ) & (NUM * F.col("y.low") <= DEN * F.col("x.high"))
    met = x.join(y, (F.col("x.token") == F.col("y.token")) & near).groupBy(F.col("x.grp").alias("g"), F.col("y.grp").alias("h"))
    met = met.agg(
        F.count("*").alias("c"), F.first(F.col("x.low") + F.col("y.low")).alias("least"),
        F.first(F.greatest("x.high", "y.high")).alias("most"),
        F.min(F.struct(F.col("x.rep").alias("a"), F.col("y.rep").alias("b"))).alias("p"),
        F.first(F.col("x.members") + F.col("y.members")).alias("members")
    )
    open_ = materialize(met.where(_may_link(F.col("c"), F.col("least"), F.col("most"))), "open")
    first = open_.select("p.a", "p.b")
    links = materialize(links.union(_verify(first, entries, classes)), "links")
    merged = components(links)

    # groups that the first pair did not join, unless it was their only pair: every pair of theirs that shares a token
    comp = merged.withColumnRenamed("node", "g")
    left = open_.join(comp.select("g", F.col("component").alias("cg")), "g", "left").join(
        comp.select(F.col("g").alias("h"), F.col("component").alias("ch")), "h", "left"
    )
    left = left.where((F.coalesce("cg", "g") != F.coalesce("ch", "h")) & (F.col("members") > 2)).select("g", "h")
    inside = posts.join(left.select(F.col("g").alias("grp")).union(left.select(F.col("h").alias("grp"))).distinct(), "grp", "left_semi")
    p, q = inside.alias("p"), inside.alias("q")
    fits = (F.col("p.grp") < F.col("q.grp")) & (NUM * F.col("p.n") <= DEN * F.col("q.n")) & (NUM * F.col("q.n") <= DEN * F.col("p.n"))
    rest = p.join(q, (F.col("p.token") == F.col("q.token")) & fits).select(
        F.col("p.grp").alias("g"), F.col("q.grp").alias("h"), F.col("p.cid").alias("a"), F.col("q.cid").alias("b"),
        (F.col("p.n") + F.col("q.n")).alias("least"), F.greatest("p.n", "q.n").alias("most")
    )
    rest = rest.groupBy("g", "h", "a", "b").agg(
        F.count("*").alias("c"), F.first("least").alias("least"), F.first("most").alias("most")
    ).where(_may_link(F.col("c"), F.col("least"), F.col("most")))
    rest = rest.join(left, ["g", "h"], "left_semi").select("a", "b").join(first, ["a", "b"], "left_anti")
    links = links.union(_verify(rest, entries, classes))

    comp = components(links).withColumnRenamed("node", "cid")
    info = classes.select("cid", "n", "rep").join(comp, "cid", "left").withColumn("component", F.coalesce("component", "cid"))
    least = info.groupBy("component").agg(F.min("rep").alias("least"))
    info = info.join(least, "component").select("cid", "least")
    out = entries.where("cid is not null").select("cid", "n", "ids").join(info, "cid").select(
        F.explode("ids").alias(id_col), F.col("n").alias("n_shingles"), "least"
    )
    return out.select(id_col, "n_shingles", F.when(F.col("n_shingles") > 0, F.col("least")).otherwise(F.col(id_col)).alias("component_id"))


def query(spark, sf_dir: str) -> DataFrame:
    return jaccard_components(read(spark, sf_dir, "documents"))


SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
  ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS sh FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
l AS (SELECT a.doc_id AS a, b.doc_id AS b FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id
  JOIN n x ON x.doc_id = a.doc_id JOIN n y ON y.doc_id = b.doc_id GROUP BY a.doc_id, b.doc_id, x.n, y.n
  HAVING 100 * count(*) >= 75 * (x.n + y.n - count(*))),
r(a, b) AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
c AS (SELECT a, min(b) AS m FROM r GROUP BY a)
SELECT w.doc_id, coalesce(n, 0) AS n_shingles, least(w.doc_id, coalesce(m, w.doc_id)) AS component_id
FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN c ON c.a = w.doc_id
"""
