"""From raw documents to packed training sequences.

Each stage calls one operator of tidewright.llm, works on all rows its
predecessor kept, is written as Parquet and read again by the next. All but
the last return the columns of documents, whatever other columns they hold:
inside a stage these are named by place, so no name can clash. A stage that
must tell rows apart numbers them first; doc_id may be null or repeated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewright.llm import op02_packing, op04_language_id, op06_exact_dedup, op07_mixing, op09_jaccard_join
from tidewright.llm.common import materialize, read

#: A word with the white space after it, and before it where it is the first.
PIECE = r"(?:\A[\x20\x09-\x0D]+)?[^\x20\x09-\x0D]+[\x20\x09-\x0D]*"


class Plain:
    """docs with its columns named by place (c0, c1, ...), and the way back."""

    def __init__(self, docs: DataFrame):
        self.names = docs.columns
        self.df = docs.toDF(*[f"c{i}" for i in range(len(self.names))])

    def __getitem__(self, name: str) -> str:
        return f"c{self.names.index(name)}"

    def numbered(self) -> DataFrame:
        """Rows with a number each, written so that it stays the same."""
        return materialize(self.df.withColumn("row", F.monotonically_increasing_id()), "rows")

    def back(self, df: DataFrame) -> DataFrame:
        return df.select(*[F.col(f"c{i}").alias(n) for i, n in enumerate(self.names)])


def known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go: those without a letter (null and empty texts too) and those unlike every language learned.

    Every row is judged alone, so repeated rows stay or go together.
    """
    p = Plain(docs)
    model = op04_language_id.train(p.df, p["doc_id"], p["text"], p["lang"])
    return p.back(op04_language_id.identify(p.df, model, p["doc_id"], p["text"], keep=True).where("accepted"))


def distinct_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one row stays, the one with the largest doc_id; a null doc_id is below all others.

    Null texts count as empty: one of all such rows stays. Of repeated rows
    with that doc_id any one stays.
    """
    p = Plain(docs)
    # null never equals null in a join, but the pair (0, true) equals itself
    one = {
        "id": F.coalesce(p["doc_id"], F.lit(0)), "none": F.col(p["doc_id"]).isNull(), "sha": F.sha2(F.coalesce(p["text"], F.lit("")), 256)
    }
    kept = op06_exact_dedup.exact_dedup(p.df, p["doc_id"], p["text"]).where("kept")
    kept = kept.select(
        F.coalesce(p["doc_id"], F.lit(0)).alias("id"), F.col(p["doc_id"]).isNull().alias("none"), F.col("text_sha256").alias("sha")
    )
    rows = p.df.withColumns(one).join(kept, [*one], "left_semi")
    return p.back(rows.dropDuplicates([*one]))


def distinct_near_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by shingles, directly or not, the one with the smallest doc_id stays.

    A null doc_id is above all others; ties go to the smaller SHA-256 of the
    text and then to any one row. Rows without a word link with nothing and
    all stay; of repeated rows one stays.
    """
    p = Plain(docs)
    rows = p.numbered()
    linked = op09_jaccard_join.jaccard_components(rows, "row", p["text"]).select("row", "component_id")
    order = F.struct(
        F.col(p["doc_id"]).isNull().alias("none"), p["doc_id"], F.sha2(F.coalesce(p["text"], F.lit("")), 256).alias("sha"), "row"
    )
    best = linked.join(rows.select("row", order.alias("own")), "row").groupBy("component_id").agg(F.min("own").alias("own"))
    return p.back(rows.join(best.select("own.row"), "row", "left_semi"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; of one at the border of a run, the words taken, their white space kept.

    Rows with a null or empty text, or without a word, have nothing to take.
    A null source is a source of its own. Repeated rows are rows like others.
    n_chars, where there is one, is that of the text as it is now.
    """
    p = Plain(docs)
    rows = p.numbered()
    plan = op07_mixing.mix(rows, "row", p["text"], p["source"], order_by=(p["doc_id"], p["text"])).where("taken > 0")
    plan = plan.select("row", "size", "laps", "from_a", "to_a", "from_b", "to_b")
    part = F.col("to_a") - F.col("from_a") + F.col("to_b")
    whole = F.col("laps") + (part >= F.col("size")).cast("int")
    pieces = F.regexp_extract_all(p["text"], F.lit(PIECE), F.lit(0))
    cut = lambda a, b: F.array_join(F.slice(pieces, (a + 1).cast("int"), (b - a).cast("int")), "")
    ends = r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$"
    runs = F.filter(F.array(cut(F.col("from_b"), F.col("to_b")), cut(F.col("from_a"), F.col("to_a"))), lambda x: x != "")
    some = F.array_join(F.transform(runs, lambda x: F.regexp_replace(x, ends, "")), " ")
    none = F.array().cast("array<string>")
    copies = F.concat(
        F.array_repeat(p["text"], whole.cast("int")), F.when((part > 0) & (part < F.col("size")), F.array(some)).otherwise(none)
    )
    out = rows.join(plan, "row").withColumn("taken_text", F.explode(copies))
    new = {p["text"]: F.col("taken_text")}
    if "n_chars" in p.names:
        new[p["n_chars"]] = F.length("taken_text").cast(docs.schema["n_chars"].dataType)
    return p.back(out.withColumns(new))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens, one row per piece; a null or empty text is one piece holding only the end token."""
    p = Plain(docs)
    return op02_packing.pack(p.df, p["doc_id"], p["text"]).withColumnRenamed(p["doc_id"], "doc_id")


STAGES = [
    ("language_id", known_languages),
    ("exact_dedup", distinct_texts),
    ("jaccard_join", distinct_near_texts),
    ("mixing", mixed),
    ("packing", packed),
]

#: Language models, rounded apportionment and packing can't be written in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
