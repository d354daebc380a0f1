"""Language identification by interpolated Kneser-Ney character models.

One model per language over letters and spaces, order 4. N-grams of all
languages are hashed into one sorted array of 64-bit keys; each key points to
the languages that have it and their log-probabilities, so a model takes room
for the n-grams seen and no more. The language with the
lowest cross-entropy per character wins; the cross-entropy of held-back
training texts sets the level beyond which a text is rejected. A language with
few texts learns from all of them, and each is held against a model of the others.
"""

from __future__ import annotations

import zlib
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import StructType

from .common import materialize, read, slices

#: Training documents of a language (those with the smallest hash of id and text) and the order.
TRAIN_DOCS, ORDER = 400, 4
DISCOUNT, ALPHABET, MARGIN, FOLDS = 0.75, 1 << 12, 0.6, 5
#: Below so many training documents a language holds back one at a time.
FEW = 10
#: Code points of a text, and n-grams, handled at once.
BLOCK = 1 << 17
SEED = 29


@lru_cache(1)
def _symbols() -> np.ndarray:
    """Code point -> lower-case letter, or a space for all else (BMP)."""
    out = np.full(1 << 16, 32, np.uint16)
    for c in range(1 << 16):
        if (ch := chr(c)).isalpha():
            low = ch.lower()
            out[c] = ord(low) if len(low) == 1 and ord(low) < 1 << 16 else c
    return out


def _mapped(text: str) -> np.ndarray:
    """One symbol for each code point: its letter, or a space."""
    cp = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    sym = _symbols()[np.minimum(cp, 0xFFFF)]
    if len(cp) and cp.max() > 0xFFFF:
        for i in np.flatnonzero(cp > 0xFFFF):
            if chr(cp[i]).isalpha():
                sym[i] = 0xE000 + (int(cp[i]) & 0xFFF)
    return sym


def _windows(s: np.ndarray) -> np.ndarray:
    out = np.zeros(len(s) - ORDER + 1, np.uint64)
    for i in range(ORDER):
        out = (out << np.uint64(16)) | s[i : len(s) - ORDER + 1 + i]
    return out


def gram_blocks(text: str):
    """grams(letters(text)) in blocks of bounded size."""
    tail = np.array([0] * (ORDER - 2) + [32], np.uint64)
    for at in range(0, len(text) + 1, BLOCK):  # also once, for the last space, where the length is a multiple
        sym = _mapped(text[at : at + BLOCK])
        if at + BLOCK > len(text):
            sym = np.append(sym, np.uint16(32))
        before = np.concatenate([[tail[-1]], sym[:-1]])
        s = np.concatenate([tail, sym[(sym != 32) | (before != 32)].astype(np.uint64)])
        tail = s[1 - ORDER :]
        yield _windows(s)


def letters(text: str) -> np.ndarray:
    """Symbols of a whole text: its letters, with one space for each run of others and at both ends."""
    sym = np.concatenate([[32], _mapped(text), [32]]).astype(np.uint64)
    keep = np.ones(len(sym), bool)
    keep[1:] = (sym[1:] != 32) | (sym[:-1] != 32)
    return sym[keep]


def grams(sym: np.ndarray) -> np.ndarray:
    """The 4-gram that ends at each symbol after the first; missing ones before it are 0."""
    return _windows(np.concatenate([np.zeros(ORDER - 2, np.uint64), sym]))


def gram_counts(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(np.concatenate([grams(letters(t)) for t in texts]), return_counts=True)


def _find(keys: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return np.zeros(len(q), np.int64), np.zeros(len(q), bool)
    i = np.minimum(np.searchsorted(keys, q), len(keys) - 1)
    return i, keys[i] == q


class Sparse:
    """Sorted keys, and for each the languages that have a value there."""

    def __init__(self, parts: list[tuple[np.ndarray, np.ndarray]]):
        lang = np.concatenate([np.full(len(k), j, np.int32) for j, (k, _) in enumerate(parts)])
        key = np.concatenate([k for k, _ in parts])
        order = np.lexsort((lang, key))
        self.lang, self.value = lang[order], np.concatenate([v for _, v in parts])[order].astype(np.float32)
        self.keys, first = np.unique(key[order], return_index=True)
        self.first = np.append(first, len(key)).astype(np.int64)

    def find(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row of q, language, value) of all values that the keys q have."""
        i, ok = _find(self.keys, q)
        rows, i = np.flatnonzero(ok), i[ok]
        many = self.first[i + 1] - self.first[i] if len(i) else np.zeros(0, np.int64)
        at = np.arange(many.sum()) + np.repeat(self.first[i] - np.cumsum(many) + many, many) if len(i) else np.zeros(0, np.int64)
        return np.repeat(rows, many), self.lang[at], self.value[at]


class Model:
    """grams[n]: log-probability of the n-grams that a language has seen;
    backoff[n]: log of the weight of the lower order after a context that it has seen."""

    def __init__(self, counts: dict[str, tuple[np.ndarray, np.ndarray]]):
        self.langs = sorted(counts)
        self.grams, self.backoff = {}, {}
        self.floor = np.full(len(self.langs), -np.log(ALPHABET))
        self.limit = np.full(len(self.langs), np.inf)
        levels = {}
        for lang in self.langs:
            k, c = counts[lang]
            own = {ORDER: (k, c.astype(float))}
            for n in range(ORDER - 1, 0, -1):  # continuation counts
                k, c = np.unique(k & np.uint64((1 << (16 * n)) - 1), return_counts=True)
                own[n] = (k, c.astype(float))
            levels[lang] = own
        for n in range(1, ORDER + 1):
            grams, back = [], []
            for j, lang in enumerate(self.langs):
                k, c = levels[lang][n]
                contexts, at = np.unique(k >> np.uint64(16), return_inverse=True)
                total, kinds = np.bincount(at, c, len(contexts)), np.bincount(at, minlength=len(contexts))
                weight = DISCOUNT * kinds / np.maximum(total, 1e-9)
                lower = np.exp(self.score(k & np.uint64((1 << (16 * (n - 1))) - 1), n - 1, j))
                grams.append((k, np.log(np.maximum(c - DISCOUNT, 0) / total[at] + weight[at] * lower)))
                back.append((contexts, np.log(weight)))
            self.grams[n], self.backoff[n] = Sparse(grams), Sparse(back)

    def score(self, q: np.ndarray, n: int = ORDER, only: int | None = None) -> np.ndarray:
        """Log-probability of the last symbol of each n-gram, by language (or of one language)."""
        if n == 0:
            out = np.empty((len(q), len(self.langs)), np.float32)
            out[:] = self.floor
        else:
            out = self.score(q & np.uint64((1 << (16 * (n - 1))) - 1), n - 1)
            row, lang, value = self.backoff[n].find(q >> np.uint64(16))
            out[row, lang] += value
            row, lang, value = self.grams[n].find(q)
            out[row, lang] = value
        return out if only is None else out[:, only]

    def cross_entropy(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Nats per symbol by language, and the symbols scored (0: no letter)."""
        out, n = np.full((len(texts), len(self.langs)), np.inf), np.zeros(len(texts), np.int64)
        block, rows, size = [], [], 0

        def done():
            if rows:
                q, back = np.unique(np.concatenate(block), return_inverse=True)  # scored once each
                lens = np.array([len(b) for b in block])
                sums = np.add.reduceat(self.score(q)[back], np.concatenate([[0], np.cumsum(lens)[:-1]]), axis=0, dtype=np.float64)
                for r, s, k in zip(rows, sums, lens):
                    out[r] = -s if n[r] == 0 else out[r] - s
                    n[r] += k
            block.clear()
            rows.clear()

        for r, text in enumerate(texts):
            for g in gram_blocks(text or ""):  # long texts in parts, all of them
                if not len(g):
                    continue
                block.append(g)
                rows.append(r)
                size += len(g)
                if size >= BLOCK:
                    done()
                    size = 0
        done()
        out[n > 0] /= n[n > 0, None]
        return out, n


def held_out(id_col: str) -> F.Column:
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def _sample(df: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """(lang, i, many, text): at most TRAIN_DOCS different documents a language, numbered from 0 in order of their hash.

    Hashes beyond three times the share wanted are dropped before the shuffle,
    but never a language's smallest. Repeated rows count once, so ties can't
    carry more than TRAIN_DOCS.
    """
    rows = df.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull() & ~held_out(id_col))
    rows = rows.select(
        F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"),
        F.xxhash64(id_col, text_col, F.lit(SEED)).alias("h")
    )
    per = rows.groupBy("lang").agg(F.count("*").alias("n"), F.min("h").alias("least")).collect()
    if not per:
        return rows.select("lang", F.lit(0).alias("i"), F.lit(0).alias("many"), "text").limit(0)
    spark = df.sparkSession
    span = 1 << 64
    top = lambda n: min((1 << 63) - 1, -(1 << 63) + 3 * TRAIN_DOCS * span // n)
    bound = spark.createDataFrame([(r["lang"], max(r["least"], top(r["n"]))) for r in per], "lang string, most long")
    low = rows.select("lang", "h").join(F.broadcast(bound), "lang").where("h <= most").select("lang", "h").distinct()
    order, whole = Window.partitionBy("lang").orderBy("h"), Window.partitionBy("lang")
    pick = low.withColumn("i", F.row_number().over(order) - 1).where(F.col("i") < TRAIN_DOCS).withColumn("many", F.count("*").over(whole))
    pick = spark.createDataFrame(pick.collect(), "lang string, h long, i int, many long")  # at most TRAIN_DOCS a language
    got = rows.join(F.broadcast(pick), ["lang", "h"]).dropDuplicates(["lang", "h"])
    return materialize(got.select("lang", "i", "many", "text"), "sample")


def train(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """Fit on at most TRAIN_DOCS whole texts a language, none of them held out.

    Every fifth of them only sets the rejection level; of fewer than FEW all are
    fitted, and the level comes from each text under a model of those that
    differ from it. With no such text a language has no level and rejects
    nothing but texts without a letter. Tasks count n-grams of their documents;
    the counts of the sample, all of them, come to the driver.
    """
    picked = _sample(df, id_col, text_col, lang_col)
    pack = lambda k, c: (k.astype("<u8").tobytes(), c.astype("<i8").tobytes())

    def count(batches):
        for b in slices(batches, 64):
            fitted: dict[str, list[str]] = {}
            for lang, i, many, text in zip(*(b.column(c).to_pylist() for c in ("lang", "i", "many", "text"))):
                if i % 5 or many < FEW:
                    fitted.setdefault(lang, []).append(text)
            got = [(lang, *pack(*gram_counts(texts))) for lang, texts in fitted.items()]
            if got:
                kinds = (pa.string(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*got), kinds)], names=["lang", "k", "c"])

    def merge(f: pd.DataFrame) -> pd.DataFrame:
        k, at = np.unique(np.concatenate([np.frombuffer(x, "<u8") for x in f["k"]]), return_inverse=True)
        c = np.zeros(len(k), np.int64)
        np.add.at(c, at, np.concatenate([np.frombuffer(x, "<i8") for x in f["c"]]))
        return pd.DataFrame([(f["lang"][0], *pack(k, c))], columns=["lang", "k", "c"])

    counts = picked.mapInArrow(
        count, "lang string, k binary, c binary"
    ).groupBy("lang").applyInPandas(merge, "lang string, k binary, c binary")
    got = counts.collect()
    if not got:
        return Model({"und": (np.zeros(0, np.uint64), np.zeros(0))})
    model = Model({r["lang"]: (np.frombuffer(r["k"], "<u8"), np.frombuffer(r["c"], "<i8")) for r in got})

    def held_back(batches):
        for b in slices(batches, 64):
            lang, text = b.column("lang").to_pylist(), b.column("text").to_pylist()
            ce, n = model.cross_entropy(text)
            ce = [float(ce[r, model.langs.index(x)]) for r, x in enumerate(lang)]
            keep = n > 0
            yield pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(ce)], names=["lang", "ce"]).filter(pa.array(keep))

    def left_out(f: pd.DataFrame) -> pd.DataFrame:
        lang, texts = f["lang"][0], f["text"].tolist()
        rest = [(t, [u for u in texts if u != t]) for t in texts]
        got = [Model({lang: gram_counts(others)}).cross_entropy([t]) for t, others in rest if others]
        return pd.DataFrame({"lang": lang, "ce": [float(ce[0, 0]) for ce, n in got if n[0]]})

    many = picked.where(
        (F.col("many") >= FEW) & (F.col("i") % 5 == 0)
    ).select("lang", "text").mapInArrow(held_back, "lang string, ce double")
    few = picked.where(F.col("many") < FEW).groupBy("lang").applyInPandas(left_out, "lang string, ce double")
    levels: dict[str, list[float]] = {}
    for r in many.union(few).collect():
        levels.setdefault(r["lang"], []).append(r["ce"])
    for lang, ce in levels.items():
        model.limit[model.langs.index(lang)] = float(np.quantile(ce, 0.99)) + MARGIN
    return model


def identify(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", keep: bool = False) -> DataFrame:
    """Per row: id, lang_pred, score, cross_entropy, accepted; with keep the row's own columns instead of the id.

    Null texts and texts without a letter are `und`, score 0, not accepted.
    Ties go to the first language by name. Repeated rows each get their
    result; an empty table gives an empty result. score is the softmax of
    cross-entropies, sharpened by length up to 20 characters.
    """

    def work(batches):
        at = None
        for b in slices(batches):
            at = b.schema.get_field_index(text_col) if at is None else at
            ce, n = model.cross_entropy(b.column(at).to_pylist())
            best = np.argmin(ce, axis=1)
            low = ce[np.arange(len(best)), best]
            with np.errstate(invalid="ignore", over="ignore"):
                score = 1 / np.exp(-(ce - low[:, None]) * np.minimum(n, 20)[:, None]).sum(axis=1)
                ok = (n > 0) & (low <= model.limit[best])
            lang = [model.langs[i] if k else "und" for i, k in zip(best, n)]
            more = [pa.array(lang, pa.string()), pa.array(np.where(n > 0, score, 0.0)), pa.array(np.where(n > 0, low, 0.0)), pa.array(ok)]
            own = len(b.columns) if keep else 1
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:own], *more], names=[*b.schema.names[:own], "lang_pred", "score", "cross_entropy", "accepted"]
            )

    src = df if keep else df.select(F.col(id_col).alias("k"), F.col(text_col))
    out = StructType(
        src.schema.fields[: None if keep else 1]
    ).add("lang_pred", "string").add("score", "double").add("cross_entropy", "double").add("accepted", "boolean")
    found = src.mapInArrow(work, out)
    return found if keep else found.withColumnRenamed("k", id_col)


def is_held_out(doc_id: int) -> bool:
    return zlib.crc32(str(doc_id).encode()) % FOLDS == 0


def query(spark, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    out = identify(docs, train(docs)).withColumn("held_out", held_out("doc_id"))
    return out.select("doc_id", "held_out", "lang_pred", "score", "accepted")
