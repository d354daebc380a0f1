r"""Chat formatting with a grammar round trip.

Native: DataFrame functions only. A turn is rendered as

    <s>[HEAD] role [/HEAD]\ntext</s>

and read back by splitting at </s> and at the first [/HEAD]\n. A turn that
does not come back identical is escaped: control strings inside it get one
backslash more between their opening and their name, which the parser takes
away again. The escaped text holds no control string, and none can form
across a border, since they begin with < or [, hold no white space, and the
template's own neighbours are white space or </s>. So one escape is enough;
the escaped turn is parsed again all the same, and one that still differed
would stop the query rather than be written wrong.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import read

BEGIN, HEAD, BODY, END = "<s>", "[HEAD] ", " [/HEAD]\n", "</s>"
NAMES = r"(s>|HEAD\]|INST\]|SYS>>)"
OPEN = r"(<</?|</?|\[/?)"


def escape(x: Column) -> Column:
    return F.regexp_replace(x, OPEN + r"(\\*+)" + NAMES, r"$1$2\\$3")


def unescape(x: Column) -> Column:
    return F.regexp_replace(x, OPEN + r"(\\*)\\" + NAMES, r"$1$2$3")


def block(role: Column, text: Column) -> Column:
    return F.concat(F.lit(BEGIN + HEAD), role, F.lit(BODY), text, F.lit(END))


def _turn(part: Column) -> Column:
    """What stands between two </s>, read back."""
    at = F.instr(part, BODY)
    skip = len(BEGIN + HEAD)
    role = F.substring(part, F.lit(skip + 1), at - skip - 1)
    text = F.substring(part, at + len(BODY), F.length(part))
    return F.struct(unescape(role).alias("role"), unescape(text).alias("text"))


def parse(formatted: Column) -> Column:
    """The turns of a formatted conversation, in order."""
    parts = F.split(formatted, END, -1)
    return F.transform(F.slice(parts, 1, F.size(parts) - 1), _turn)


def format_chats(
    df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """One row per conversation: conv_id, formatted, loss_spans (start and chars of each
    assistant text in formatted), n_escaped, round_trip (the parse equals the source).

    Turns go by turn, then role and text, nulls first; repeated rows are turns
    of their own. Null texts and roles count as empty; null conversation ids
    are one conversation; an empty table gives an empty result; other columns
    are ignored, whatever their names. A conversation is one row, as its format
    asks: very long texts are whole, up to the 2 GB that a row can hold.
    """
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    t = df.select(F.col(conv_col).alias("c"), F.col(turn_col).alias("n"), empty(role_col).alias("role"), empty(text_col).alias("text"))
    got = parse(block(F.col("role"), F.col("text")))
    same = F.coalesce((F.size(got) == 1) & (got[0]["role"] == F.col("role")) & (got[0]["text"] == F.col("text")), F.lit(False))
    # most texts hold no control string, plain or escaped, and come back as they are
    risky = F.concat("role", F.lit("\n"), "text").rlike(OPEN + r"\\*+" + NAMES) | F.col("role").contains(BODY.strip())
    t = t.withColumn("plain", ~risky | same)
    t = t.withColumns({
        "r": F.when(F.col("plain"), F.col("role")).otherwise(escape(F.col("role"))),
        "x": F.when(F.col("plain"), F.col("text")).otherwise(escape(F.col("text")))
    })
    back = parse(block(F.col("r"), F.col("x")))
    equal = F.coalesce((F.size(back) == 1) & (back[0]["role"] == F.col("role")) & (back[0]["text"] == F.col("text")), F.lit(False))
    t = t.withColumn("x", F.when(F.col("plain") | equal, F.col("x")).otherwise(F.raise_error("a turn cannot be read back").cast("string")))
    t = t.withColumns({"b": block(F.col("r"), F.col("x"))}).withColumn("len", F.length("b").cast("long"))
    order = Window.partitionBy("c").orderBy("n", "role", "text")
    t = t.withColumns({"i": F.row_number().over(order), "end": F.sum("len").over(order.rowsBetween(Window.unboundedPreceding, 0))})
    chars = F.length("x").cast("long")
    span = F.when(F.col("role") == "assistant", F.struct((F.col("end") - len(END) - chars).alias("start"), chars.alias("chars")))
    turns = F.array_sort(F.collect_list(F.struct("i", "b", F.struct("role", "text").alias("turn"), span.alias("span"), "plain")))
    g = t.groupBy("c").agg(turns.alias("t"))
    g = g.select("c", "t", F.array_join(F.transform("t", lambda x: x["b"]), "").alias("formatted"))
    return g.select(
        F.col("c").alias(conv_col), "formatted",
        F.filter(F.transform("t", lambda x: x["span"]), lambda x: x.isNotNull()).alias("loss_spans"),
        F.size(F.filter("t", lambda x: ~x["plain"])).alias("n_escaped"),
        (parse(F.col("formatted")) == F.transform("t", lambda x: x["turn"])).alias("round_trip"),
    )


def digests(chats: DataFrame) -> DataFrame:
    """What the contract asks for, read back from the formatted text."""
    t = chats.withColumn("turns", parse(F.col("formatted")))
    lines = F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n")))
    loss = F.transform(
        "loss_spans", lambda s: unescape(F.substring(F.col("formatted"), s["start"].cast("int") + 1, s["chars"].cast("int")))
    )
    t = t.withColumn("loss", F.array_join(loss, ""))
    return t.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"), "round_trip",
    )


def query(spark, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    more = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text")
    )
    return digests(format_chats(rows.unionByName(more)))


_CONTROL = OPEN + r"(\\{more})" + NAMES
SQL = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
p AS (SELECT *, NOT (contains(role, '</s>') OR contains(text, '</s>') OR contains(role, '{BODY[:-1]}' || chr(10))
  OR regexp_matches(role, '{_CONTROL.format(more="+")}') OR regexp_matches(text, '{_CONTROL.format(more="+")}')) AS plain FROM t),
e AS (SELECT *, CASE WHEN plain THEN length(role) + length(text)
  ELSE length(regexp_replace(role, '{_CONTROL.format(more="*")}', '\\1\\2/\\3', 'g')) + length(regexp_replace(text, '{_CONTROL.format(more="*")}', '\\1\\2/\\3', 'g')) END AS n FROM p),
g AS (SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS turns,
  coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn NULLS FIRST, role, text), '') AS loss,
  CAST(sum(n + {len(BEGIN + HEAD + BODY + END)}) AS BIGINT) AS formatted_chars FROM e GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars, TRUE AS round_trip FROM g
"""
