"""Queries over the test tables, one per operator, and their independent SQL."""

from __future__ import annotations

import uuid
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import merge as m, monitoring as mon, quality as q, stage
from ..operators.store import VersionedStore
from ..sources import readers as r
from .window import predicate, window

LO, UP = "2024-01-10 00:00:00", "2024-01-20 00:00:00"
QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def keep(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = " ".join(sql.split())
        return f

    return keep


def src(spark: SparkSession, d: str, table: str, **scan) -> DataFrame:
    return r.ParquetSource(spark, f"{d}/{table}.parquet").read(r.Scan(**scan))


def ts(text: str):
    return F.lit(text).cast("timestamp_ntz")


# scans


@query("qi1_full_scan", "SELECT * FROM nation")
def _(spark, d):
    return src(spark, d, "nation")


@query("qi2_projected", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def _(spark, d):
    return src(spark, d, "orders", columns=("o_orderkey", "o_custkey", "o_orderstatus"))


@query("qi3_filtered", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus <> 'F'")
def _(spark, d):
    return src(spark, d, "orders", columns=("o_orderkey", "o_custkey", "o_totalprice"), filter="o_orderstatus <> 'F'")


@query("qi4_exclude_columns", "SELECT c_custkey, c_nationkey, c_mktsegment FROM customer")
def _(spark, d):
    return src(spark, d, "customer", exclude=("C_NAME", "c_acctbal"))


@query(
    "qi5_incremental_timestamp",
    f"SELECT event_id, user_id, ts FROM events WHERE ts >= TIMESTAMP '{LO}' AND ts < TIMESTAMP '{UP}' AND (event_type <> 'error')"
)
def _(spark, d):
    return src(
        spark, d, "events", columns=("event_id", "user_id", "ts"), filter="event_type <> 'error'",
        window=predicate("ts", "timestamp", LO, UP)
    )


@query(
    "qi6_incremental_date",
    "SELECT l_orderkey, l_linenumber, l_shipdate FROM lineitem WHERE CAST(l_shipdate AS DATE) >= DATE '1997-01-01' AND CAST(l_shipdate "
    "AS DATE) < DATE '1997-02-01'"
)
def _(spark, d):
    return src(
        spark, d, "lineitem", columns=("l_orderkey", "l_linenumber", "l_shipdate"),
        window=predicate("l_shipdate", "date", "1997-01-01", "1997-02-01")
    )


@query("qi7_incremental_number", "SELECT event_id, event_type FROM events WHERE event_id > 100 AND event_id < 900")
def _(spark, d):
    return src(
        spark, d, "events", columns=("event_id", "event_type"), window=predicate("event_id", "version", "100", "900", inclusive=False)
    )


@query(
    "qi8_partition_bounds",
    "SELECT COUNT(*) AS source_count, MIN(l_orderkey) AS lower_bound, MAX(l_orderkey) AS upper_bound FROM lineitem WHERE l_quantity > 25"
)
def _(spark, d):
    return r.probe(src(spark, d, "lineitem", filter="l_quantity > 25"), partition="l_orderkey")


@query("qi9_overlap_window", "SELECT event_id, ts FROM events WHERE ts >= (SELECT MAX(ts) FROM events) - INTERVAL '6' HOUR")
def _(spark, d):
    stored = src(spark, d, "events").agg(F.max("ts")).first()[0]
    low = window(stored, "timestamp", timedelta(hours=6)).lower
    return src(spark, d, "events", columns=("event_id", "ts"), window=predicate("ts", "timestamp", low))


@query("qi10_template", f"SELECT o.o_orderkey, c.c_name FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey WHERE o.o_orderdate >= TIMESTAMP '1996-01-01 00:00:00' AND o.o_orderdate < TIMESTAMP '1996-07-01 00:00:00'")
def _(spark, d):
    text = (
        "SELECT o.o_orderkey, c.c_name FROM tw_orders o JOIN tw_customer c ON o.o_custkey = c.c_custkey WHERE o.o_orderdate >= "
        "CAST(:lower_bound AS TIMESTAMP_NTZ) AND o.o_orderdate < CAST(:upper_bound AS TIMESTAMP_NTZ);"
    )
    args = {"lower_bound": "1996-01-01 00:00:00", "upper_bound": "1996-07-01 00:00:00"}
    return r.template(spark, text, args, {"tw_orders": src(spark, d, "orders"), "tw_customer": src(spark, d, "customer")})


@query(
    "qi11_probes",
    "SELECT COUNT(*) AS source_count, MAX(ts) AS max_watermark, MIN(event_id) AS lower_bound, MAX(event_id) AS upper_bound FROM events "
    "WHERE event_type <> 'error'"
)
def _(spark, d):
    return r.probe(src(spark, d, "events", filter="event_type <> 'error'"), "ts", "event_id")


@query("qi12_row_limit", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 100")
def _(spark, d):
    return src(spark, d, "orders", columns=("o_orderkey", "o_totalprice")).orderBy("o_orderkey").limit(100)


@query("qi13_scan_limit", "SELECT LEAST(COUNT(*), 100) AS n FROM orders")
def _(spark, d):
    return src(spark, d, "orders", columns=("o_orderkey",), limit=100).agg(F.count("*").alias("n"))


@query("qi14_version_projected", "SELECT event_id AS _version, event_type FROM events WHERE event_id >= 100 AND event_id < 900")
def _(spark, d):
    versioned = src(spark, d, "events").withColumnRenamed("event_id", "_version")
    return r.MemorySource(versioned).read(r.Scan(("_version", "event_type"), window=predicate("_version", "version", "100", "900")))


# staging


@query(
    "qw1_dedupe_composite",
    "SELECT l_orderkey, l_linenumber, l_shipdate FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY "
    "l_shipdate DESC NULLS LAST) AS rn FROM lineitem) t WHERE rn = 1"
)
def _(spark, d):
    return stage.newest(
        src(spark, d, "lineitem", columns=("l_orderkey", "l_linenumber", "l_shipdate")), ["l_orderkey", "l_linenumber"], "l_shipdate"
    )


@query("qw2_dedupe_latest", """SELECT event_id, user_id, ts, value, TIMESTAMP '2026-01-01 00:00:00' AS _ingested_at, DATE '2026-01-01' AS _ingested_date,
'run-1' AS _run_id, 'batch-1' AS _batch_id, 'I' AS _source_op, TIMESTAMP '2026-01-01 00:00:00' AS _first_ingested_at
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC NULLS LAST) AS rn FROM events
WHERE ts >= TIMESTAMP '2024-01-09 18:00:00' AND ts < TIMESTAMP '2024-01-20 00:00:00' AND event_type <> 'error') q WHERE rn = 1""")
def _(spark, d):
    w = window(LO, "timestamp", timedelta(hours=6))
    batch = src(
        spark, d, "events", columns=("event_id", "user_id", "ts", "value"), filter="event_type <> 'error'",
        window=predicate("ts", "timestamp", w.lower, UP)
    )
    return stage.stamp(stage.newest(batch, ["user_id"], "ts", "event_id"), "run-1", "batch-1", datetime(2026, 1, 1))


@query(
    "qw3_duplicate_count",
    "SELECT CAST(COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem) d) AS BIGINT) AS "
    "duplicate_rows FROM lineitem"
)
def _(spark, d):
    return stage.duplicates(src(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("qw4_lower_case", "SELECT r_regionkey, r_name FROM region")
def _(spark, d):
    upper = src(spark, d, "region")
    return stage.column_case(upper.toDF(*[c.upper() for c in upper.columns]), "lower")


@query(
    "qw5_last_n_per_key",
    "SELECT user_id, event_id, rn FROM (SELECT user_id, event_id, CAST(ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, "
    "event_id DESC) AS INT) AS rn FROM events) q WHERE rn <= 5"
)
def _(spark, d):
    return stage.newest(
        src(spark, d, "events", columns=("user_id", "event_id", "ts")), ["user_id"], "ts", "event_id", n=5, rank="rn"
    ).select("user_id", "event_id", "rn")


# writes

def _scratch(spark: SparkSession, label: str) -> str:
    """A new folder that driver and executors share."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/tw-{label}-{uuid.uuid4().hex}"


_MERGE = """t AS (SELECT user_id, value, ts FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events
WHERE {tw}) q WHERE rn = 1),
s AS (SELECT user_id, value, ts FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events
WHERE {sw}) q WHERE rn = 1),
j AS (SELECT t.user_id AS tk, s.user_id AS sk, t.value AS tv, s.value AS sv, t.ts AS tts, s.ts AS sts FROM t FULL OUTER
JOIN s ON t.user_id = s.user_id),
f AS (SELECT *, tk IS NULL AS ins, COALESCE(tk IS NOT NULL AND sk IS NOT NULL AND ({newer}), FALSE) AS upd FROM j)"""
_ROWS = (
    "SELECT COALESCE(tk, sk) AS user_id, CASE WHEN ins OR upd THEN sv ELSE tv END AS value, CASE WHEN ins OR upd THEN sts ELSE tts END "
    "AS ts, CASE WHEN upd THEN 'U' ELSE 'I' END AS _source_op FROM f"
)
_EARLY, _LATE = "ts < TIMESTAMP '2024-01-03 00:00:00'", "ts >= TIMESTAMP '2024-01-03 00:00:00'"
_OVERLAP = "ts >= TIMESTAMP '2024-01-02 18:00:00' AND user_id % 5 <> 0"
_GUARD = "tts IS NULL OR sts >= tts"


def _side(spark, d, where: str) -> DataFrame:
    where = where.replace("TIMESTAMP '", "TIMESTAMP_NTZ '")
    rows = stage.newest(
        src(spark, d, "events", columns=("user_id", "value", "ts", "event_id"), filter=where), ["user_id"], "ts", "event_id"
    )
    return rows.select("user_id", "value", "ts", F.lit("I").alias("_source_op"))


def _merge_query(name: str, tw: str, sw: str, guard: str | None, twice: bool = False):
    @query(name, "WITH " + _MERGE.format(tw=tw, sw=sw, newer=_GUARD if guard else "TRUE") + " " + _ROWS)
    def _(spark, d):
        s = _side(spark, d, sw)
        out = m.merge(_side(spark, d, tw), s, ["user_id"], guard)
        return m.merge(out, s, ["user_id"], guard).withColumn("_source_op", F.col("_source_op")) if twice else out


_merge_query("qm1_merge_insert_only", f"{_EARLY} AND user_id % 3 = 0", "user_id % 3 = 1", "ts")
_merge_query("qm2_merge_unguarded", _EARLY, _OVERLAP, None)
_merge_query("qm3_merge_guarded", _EARLY, _OVERLAP, "ts")
_merge_query("qm4_older_replay_loses", _LATE, _EARLY, "ts")


@query(
    "qm5_idempotent_rerun",
    "WITH " + _MERGE.format(tw=_EARLY, sw=_OVERLAP, newer=_GUARD) + " " + _ROWS.replace(
        ", CASE WHEN upd THEN 'U' ELSE 'I' END AS _source_op", ""
    )
)
def _(spark, d):
    s = _side(spark, d, _OVERLAP)
    once = m.merge(_side(spark, d, _EARLY), s, ["user_id"], "ts")
    return m.merge(once, s, ["user_id"], "ts").drop("_source_op")


@query(
    "qm6_append",
    f"SELECT event_id, user_id, ts, NULL::DOUBLE AS value FROM events WHERE {_EARLY} UNION ALL SELECT event_id, user_id, ts, value FROM "
    f"events WHERE {_LATE}"
)
def _(spark, d):
    old = src(spark, d, "events", columns=("event_id", "user_id", "ts"), filter=_EARLY.replace("TIMESTAMP", "TIMESTAMP_NTZ"))
    new = src(spark, d, "events", columns=("event_id", "user_id", "ts", "value"), filter=_LATE.replace("TIMESTAMP", "TIMESTAMP_NTZ"))
    store = VersionedStore(spark, _scratch(spark, "events"))
    store.write(old, "append")
    store.write(new, "append")
    return store.read()


@query("qm7_overwrite", "SELECT p_partkey, p_name FROM part WHERE p_size > 20")
def _(spark, d):
    store = VersionedStore(spark, _scratch(spark, "part"))
    store.write(src(spark, d, "part", columns=("p_partkey", "p_name")), "overwrite")
    store.write(src(spark, d, "part", columns=("p_partkey", "p_name"), filter="p_size > 20"), "overwrite")
    return store.read()


def _run(spark, d, config: dict, batches: list[DataFrame]) -> VersionedStore:
    """Runs of one table, a batch as its source for each."""
    from ..operators.control import Control
    from ..operators.runner import Runner, target_root
    from .config import Resolved

    root = _scratch(spark, "runs")
    config = {"env": "q", "table": {"domain": "q", "name": "t"}, "source": {"type": "parquet"}, **config}
    config["target"] = {"root": root, "table_name": "t", "add_audit_columns": False, **config["target"]}
    control = Control(spark, f"{root}/control", "q")
    for batch in batches:
        status = Runner(spark, control, sources={"q.t": r.MemorySource(batch)}).run([Resolved("q.t", "q", config, ())])[1]
        if status != "SUCCEEDED":
            raise RuntimeError(f"the run is {status}")
    return VersionedStore(spark, target_root(spark, config))


_KEPT = (
    "SELECT user_id, value, ts FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY late DESC, ts DESC, event_id DESC) AS "
    "rn FROM (SELECT *, ts >= TIMESTAMP '2024-01-03 00:00:00' AS late FROM events)) q WHERE rn = 1"
)


@query("qm9_guard_lower_case", _KEPT)
def _(spark, d):
    """An older replay loses, whatever the case of the mark in the configuration."""
    rows = lambda where: src(
        spark, d, "events", columns=("user_id", "value", "ts"), filter=where.replace("TIMESTAMP '", "TIMESTAMP_NTZ '")
    ).toDF("USER_ID", "VALUE", "TS")
    config = {
        "extraction": {"mode": "full", "incremental": {"watermark_column": "TS"}},
        "target": {"write_mode": "merge", "merge_keys": ["User_Id"], "merge_guard": "watermark", "column_case": "lower"}
    }
    return _run(spark, d, config, [rows(_LATE), rows(_EARLY)]).read()


@query("qm10_append_rerun", "SELECT event_id, user_id, ts FROM events WHERE ts < TIMESTAMP '2024-01-05 00:00:00'")
def _(spark, d):
    """Appends whose last mark was a batch's maximum: the same rows again add nothing."""
    rows = lambda day: src(spark, d, "events", columns=("event_id", "user_id", "ts"), filter=f"ts < TIMESTAMP_NTZ '2024-01-{day} 00:00:00'")
    config = {"extraction": {"mode": "incremental", "incremental": {"watermark_column": "ts"}}, "target": {"write_mode": "append"}}
    return _run(spark, d, config, [rows("03"), rows("05"), rows("05")]).read()


@query(
    "qm11_partitioned_merge",
    "SELECT p_partkey, LPAD(CAST(p_size AS VARCHAR), 3, '0') AS size_code, CASE WHEN p_partkey % 3 = 0 THEN 'new' ELSE 'old' END AS "
    "state FROM part WHERE p_partkey % 2 = 0 OR p_partkey % 3 = 0"
)
def _(spark, d):
    """Partition values stay strings, leading zeros and all."""
    rows = src(spark, d, "part").select("p_partkey", F.lpad(F.col("p_size").cast("string"), 3, "0").alias("size_code"))
    store = VersionedStore(spark, _scratch(spark, "sizes"))
    store.write(rows.where("p_partkey % 2 = 0").withColumn("state", F.lit("old")), "merge", ["p_partkey"], partition_by=["size_code"])
    store.write(rows.where("p_partkey % 3 = 0").withColumn("state", F.lit("new")), "merge", ["p_partkey"], partition_by=["size_code"])
    return store.read()


@query(
    "qm12_change_rows",
    "SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN k ELSE 'insert' END AS _change_type FROM part, (VALUES ('update_preimage'), "
    "('update_postimage')) c(k) WHERE p_partkey % 3 = 0 AND (p_partkey % 2 = 0 OR k = 'update_preimage')"
)
def _(spark, d):
    """Change rows of a merge into a table that keeps them."""
    rows = src(spark, d, "part", columns=("p_partkey", "p_size"))
    store = VersionedStore(spark, _scratch(spark, "changes"))
    store.create(rows.schema, "parts", cluster_by=["p_size"], changes=True)
    store.write(rows.where("p_partkey % 2 = 0"), "merge", ["p_partkey"])
    store.write(rows.where("p_partkey % 3 = 0"), "merge", ["p_partkey"])
    return store.changes(2).select("p_partkey", "_change_type")


@query(
    "qm13_bucketed_merge",
    "SELECT o_orderkey, CASE WHEN o_orderkey % 100 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS price FROM orders"
)
def _(spark, d):
    """A small batch rewrites the buckets that it touches and leaves the others."""
    rows = src(spark, d, "orders").select("o_orderkey", F.col("o_totalprice").alias("price"))
    store = VersionedStore(spark, _scratch(spark, "orders"))
    store.write(rows, "merge", ["o_orderkey"])
    store.write(rows.where("o_orderkey % 100 = 0").withColumn("price", F.col("price") + 1), "merge", ["o_orderkey"])
    return store.read()


_MET = f"{_EARLY} AND user_id % 7 <> 0", "ts < TIMESTAMP '2024-01-02 00:00:00' OR user_id % 2 = 0"


@query(
    "qm8_merge_metrics",
    "WITH " + _MERGE.format(tw=_MET[0], sw=_MET[1], newer=_GUARD) + " SELECT CAST(SUM(CASE WHEN ins THEN 1 ELSE 0 END) AS BIGINT) AS rows_inserted, CAST(SUM(CASE WHEN upd THEN 1 ELSE 0 END) AS BIGINT) AS rows_updated, CAST(SUM(CASE WHEN NOT ins AND NOT upd AND sk IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS rows_rejected FROM f"
)
def _(spark, d):
    return m.metrics(_side(spark, d, _MET[0]), _side(spark, d, _MET[1]), ["user_id"], "ts")


# quality


def _rule_query(name: str, table: str, rule: q.Rule, sql: str):
    @query(name, f"SELECT COUNT(*) AS violations FROM {table} WHERE {sql}" if "SELECT" not in sql else sql)
    def _(spark, d):
        return q.evaluate(src(spark, d, table), [rule]).select("violations")


_rule_query("qq1_not_null", "orders", q.Rule("r", "not_null", "o_custkey"), "o_custkey IS NULL")
_rule_query(
    "qq2_unique", "lineitem", q.Rule("r", "unique", "l_orderkey"),
    "SELECT CAST(COUNT(l_orderkey) - COUNT(DISTINCT l_orderkey) AS BIGINT) AS violations FROM lineitem"
)
_rule_query("qq3_in_set", "documents", q.Rule("r", "in_set", "lang", ("en", "fr")), "lang IS NOT NULL AND lang NOT IN ('en', 'fr')")
_rule_query(
    "qq4_in_set_clean", "orders", q.Rule("r", "in_set", "o_orderstatus", ("P", "F", "O")),
    "o_orderstatus IS NOT NULL AND o_orderstatus NOT IN ('P', 'F', 'O')"
)
_rule_query("qq5_min", "customer", q.Rule("r", "min", "c_acctbal", 0.0), "c_acctbal IS NOT NULL AND c_acctbal < 0")
_rule_query("qq6_max", "orders", q.Rule("r", "max", "o_totalprice", 200000.0), "o_totalprice > 200000")
_rule_query(
    "qq8_regex", "documents", q.Rule("r", "regex", "source", "^src[0-9]$"),
    "source IS NOT NULL AND NOT regexp_matches(source, '^src[0-9]$')"
)


@query(
    "qq7_null_keys",
    "SELECT COUNT(*) AS null_key_rows FROM (SELECT NULLIF(user_id, 3) AS k1, event_id AS k2 FROM events) q WHERE k1 IS NULL OR k2 IS NULL"
)
def _(spark, d):
    return q.null_keys(
        src(spark, d, "events").select(F.nullif("user_id", F.lit(3)).alias("k1"), F.col("event_id").alias("k2")), ["k1", "k2"]
    )


@query("qq9_row_count_identity", """WITH l AS (SELECT l_orderkey AS k, COUNT(*) AS n FROM lineitem GROUP BY l_orderkey)
SELECT CAST(SUM(n) AS BIGINT) AS source_count, CAST(SUM(n) - COUNT(*) AS BIGINT) AS duplicate_rows,
CAST(SUM(CASE WHEN k % 2 = 1 THEN 1 ELSE 0 END) AS BIGINT) AS inserted,
CAST(SUM(CASE WHEN k % 2 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS updated, 'PASSED' AS status FROM l""")
def _(spark, d):
    """What a merge has written, by its log, against what was read."""
    rows = src(spark, d, "lineitem", columns=("l_orderkey", "l_shipdate"))
    seen, twice = rows.count(), stage.duplicates(rows, ["l_orderkey"]).first()[0]
    batch = stage.newest(rows, ["l_orderkey"], "l_shipdate")
    store = VersionedStore(spark, _scratch(spark, "lines"))
    store.write(batch.where("l_orderkey % 2 = 0"), "merge", ["l_orderkey"], unique=True)
    got = store.write(batch, "merge", ["l_orderkey"], unique=True)["metrics"]
    status = q.row_count_status(seen, twice, got["insert"], got["update"], got["reject"])
    return spark.createDataFrame(
        [(seen, twice, got["insert"], got["update"], status)],
        "source_count long, duplicate_rows long, inserted long, updated long, status string"
    )


_REPORT = [
    q.Rule("orders_have_customer", "not_null", "o_custkey"), q.Rule("known_status", "in_set", "o_orderstatus", ("P", "F")),
    q.Rule("price_floor", "min", "o_totalprice", 1000.0, "warn"), q.Rule("priority_form", "regex", "o_orderpriority", "^[1-5]")
]


@query("qq10_one_pass_report", """SELECT check_name, violations, CASE WHEN violations = 0 THEN 'PASSED' WHEN warn THEN 'WARNED' ELSE 'FAILED' END AS status FROM (
SELECT 'orders_have_customer' AS check_name, COUNT(*) AS violations, FALSE AS warn FROM orders WHERE o_custkey IS NULL
UNION ALL SELECT 'known_status', COUNT(*), FALSE FROM orders WHERE o_orderstatus NOT IN ('P', 'F')
UNION ALL SELECT 'price_floor', COUNT(*), TRUE FROM orders WHERE o_totalprice < 1000
UNION ALL SELECT 'priority_form', COUNT(*), FALSE FROM orders WHERE NOT regexp_matches(o_orderpriority, '^[1-5]')) x""")
def _(spark, d):
    return q.evaluate(src(spark, d, "orders"), _REPORT)


@query(
    "qq11_duplicate_status",
    "SELECT CASE WHEN COUNT(*) > (SELECT COUNT(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem) a) THEN 'WARNED' ELSE "
    "'PASSED' END AS status FROM lineitem"
)
def _(spark, d):
    return stage.duplicates(src(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"]).select(
        F.when(F.col("duplicate_rows") > 0, "WARNED").otherwise("PASSED").alias("status")
    )


@query(
    "qq12_referential",
    "SELECT o_orderkey, o_custkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_nationkey < 12)"
)
def _(spark, d):
    known = src(spark, d, "customer", columns=("c_custkey",), filter="c_nationkey < 12")
    return src(spark, d, "orders", columns=("o_orderkey", "o_custkey")).join(known, F.col("o_custkey") == F.col("c_custkey"), "left_anti")


# monitoring over control tables derived from events

_TASKS = """tasks AS (SELECT event_type AS table_fqn, CASE WHEN user_id % 2 = 0 THEN 'prod' ELSE 'dev' END AS env, user_id AS run_id, event_id,
CAST(ROW_NUMBER() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS INT) AS attempt,
CASE WHEN event_id % 7 = 0 THEN 'FAILED' ELSE 'SUCCEEDED' END AS status, ts AS started_at, CAST(FLOOR(value) AS BIGINT) AS rows_written,
CAST(FLOOR(value) AS BIGINT) + 1 AS source_count, CAST(FLOOR(value * 100) AS BIGINT) AS duration_ms,
CASE WHEN event_id % 3 = 0 THEN NULL ELSE ts END AS watermark_to FROM events)"""


def tasks(spark, d) -> DataFrame:
    e = src(spark, d, "events")
    from pyspark.sql import Window

    return e.select(
        F.col("event_type").alias("table_fqn"), F.when(F.col("user_id") % 2 == 0, "prod").otherwise("dev").alias("env"), F.col("user_id").alias("run_id"), "event_id",
        F.row_number().over(Window.partitionBy("user_id", "event_type").orderBy("event_id")).alias("attempt"),
        F.when(F.col("event_id") % 7 == 0, "FAILED").otherwise("SUCCEEDED").alias("status"), F.col("ts").alias("started_at"),
        F.floor("value").cast("bigint").alias("rows_written"), (F.floor("value") + 1).cast("bigint").alias("source_count"),
        F.floor(F.col("value") * 100).cast("bigint").alias("duration_ms"), F.when(F.col("event_id") % 3 != 0, F.col("ts")).alias("watermark_to"),
    )


@query(
    "qr1_run_success_rate",
    f"WITH {_TASKS} SELECT CAST(started_at AS DATE) AS run_date, env, status, COUNT(*) AS runs, ROUND(CAST(AVG(duration_ms) AS DOUBLE) "
    "/ 1000.0, 1) AS avg_seconds FROM tasks GROUP BY CAST(started_at AS DATE), env, status"
)
def _(spark, d):
    return mon.success_rate(tasks(spark, d))


@query("qr2_table_health", f"""WITH {_TASKS}, fin AS (SELECT t.* FROM tasks t JOIN (SELECT run_id, table_fqn, MAX(attempt) AS attempt FROM tasks
GROUP BY run_id, table_fqn) l ON t.run_id = l.run_id AND t.table_fqn = l.table_fqn AND t.attempt = l.attempt)
SELECT table_fqn, env, COUNT(*) AS runs, CAST(SUM(CASE WHEN status = 'SUCCEEDED' THEN 1 ELSE 0 END) AS BIGINT) AS succeeded,
ROUND(CAST(100.0 AS DOUBLE) * CAST(SUM(CASE WHEN status = 'SUCCEEDED' THEN 1 ELSE 0 END) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE),
1) AS success_pct, MAX(attempt) AS max_attempts, ROUND(CAST(AVG(duration_ms) AS DOUBLE) / 1000.0, 1) AS avg_seconds,
CAST(SUM(CASE WHEN status = 'FAILED' THEN 1 ELSE 0 END) AS BIGINT) AS failed FROM fin GROUP BY table_fqn, env""")
def _(spark, d):
    return mon.table_health(tasks(spark, d))


@query("qr3_freshness", f"""WITH {_TASKS}, wm AS (SELECT table_fqn, env, MAX(watermark_to) AS updated_at FROM tasks
GROUP BY table_fqn, env), sla AS (SELECT 'click' AS table_fqn, 'prod' AS env, CAST(4 AS DOUBLE) AS sla_hours UNION ALL
SELECT 'view', 'dev', CAST(72 AS DOUBLE))
SELECT w.table_fqn, w.env, w.updated_at, CAST(FLOOR((DATE_DIFF('second', DATE_TRUNC('second', w.updated_at),
TIMESTAMP '2024-01-31 00:00:00') + 18) / 36) AS DOUBLE) / 100 AS hours_since_advance, s.sla_hours, CASE WHEN s.sla_hours IS NULL
OR w.updated_at IS NULL THEN NULL WHEN w.updated_at < TIMESTAMP '2024-01-31 00:00:00' - INTERVAL '1' HOUR * CAST(s.sla_hours AS INT) THEN
TRUE ELSE FALSE END AS sla_breached FROM wm w LEFT JOIN sla s ON s.table_fqn = w.table_fqn AND s.env = w.env""")
def _(spark, d):
    marks = tasks(spark, d).groupBy("table_fqn", "env").agg(F.max("watermark_to").alias("updated_at"))
    sla = spark.createDataFrame([("click", "prod", 4.0), ("view", "dev", 72.0)], "table_fqn string, env string, sla_hours double")
    return mon.freshness(marks, sla, ts("2024-01-31 00:00:00"))


@query(
    "qr4_recent_failures",
    f"WITH {_TASKS} SELECT started_at, env, table_fqn, run_id, attempt, SUBSTRING(status, 1, 4) AS st FROM tasks WHERE status = "
    "'FAILED' ORDER BY started_at DESC, event_id LIMIT 50"
)
def _(spark, d):
    return mon.recent_failures(tasks(spark, d), tie="event_id").select(
        "started_at", "env", "table_fqn", "run_id", "attempt", F.substring("status", 1, 4).alias("st")
    )


@query(
    "qr5_reconciliation_issues",
    f"WITH {_TASKS} SELECT run_id, table_fqn, event_id, st AS status FROM (SELECT *, CASE WHEN event_id % 11 = 0 THEN 'FAILED' WHEN "
    "event_id % 5 = 0 THEN 'WARNED' ELSE 'PASSED' END AS st FROM tasks) x WHERE st IN ('FAILED', 'WARNED')"
)
def _(spark, d):
    checks = tasks(spark, d).select(
        "run_id", "table_fqn", "event_id",
        F.when(F.col("event_id") % 11 == 0, "FAILED").when(F.col("event_id") % 5 == 0, "WARNED").otherwise("PASSED").alias("status")
    )
    return mon.reconciliation_issues(checks)


@query("qr6_volume_trend", f"""WITH {_TASKS}, daily AS (SELECT table_fqn, env, CAST(started_at AS DATE) AS load_date, CAST(SUM(rows_written) AS BIGINT) AS rows_written,
CAST(SUM(source_count) AS BIGINT) AS source_count FROM tasks WHERE status = 'SUCCEEDED'
GROUP BY table_fqn, env, CAST(started_at AS DATE)),
b AS (SELECT table_fqn, env, QUANTILE_CONT(rows_written, 0.5) AS med FROM daily GROUP BY table_fqn, env)
SELECT d.table_fqn, d.env, d.load_date, d.rows_written, d.source_count, ROUND(b.med, 0) AS median_rows, CASE WHEN b.med IS NULL
OR b.med = 0 THEN NULL ELSE ROUND(CAST(100.0 AS DOUBLE) * (CAST(d.rows_written AS DOUBLE) - b.med) / b.med, 1) END AS pct_vs_median
FROM daily d LEFT JOIN b ON b.table_fqn = d.table_fqn AND b.env = d.env""")
def _(spark, d):
    return mon.volume_trend(tasks(spark, d))


@query("qr7_watermark_stalls", f"""WITH {_TASKS}, r AS (SELECT run_id, table_fqn, watermark_to, started_at, ROW_NUMBER() OVER (PARTITION BY run_id, table_fqn
ORDER BY started_at DESC, event_id DESC) AS rn FROM tasks WHERE status = 'SUCCEEDED')
SELECT run_id, table_fqn, COUNT(*) AS successful_runs, CAST(2 AS BIGINT) AS runs_with_no_new_data, MAX(started_at) AS last_run_at FROM r
WHERE rn <= 2 GROUP BY run_id, table_fqn HAVING SUM(CASE WHEN watermark_to IS NULL THEN 1 ELSE 0 END) = COUNT(*) AND COUNT(*) = 2""")
def _(spark, d):
    return mon.watermark_stalls(tasks(spark, d), 2, ("run_id", "table_fqn"), "event_id")


@query(
    "qr8_stuck_runs",
    f"WITH {_TASKS} SELECT run_id, event_id, started_at, CAST(FLOOR((DATE_DIFF('second', DATE_TRUNC('second', started_at), TIMESTAMP "
    "'2024-01-29 00:00:00') + 18) / 36) AS DOUBLE) / 100 AS hours_open FROM tasks WHERE event_id % 13 = 0 AND started_at < TIMESTAMP "
    "'2024-01-28 18:00:00'"
)
def _(spark, d):
    runs = tasks(spark, d).withColumn("status", F.when(F.col("event_id") % 13 == 0, "RUNNING").otherwise("SUCCEEDED"))
    return mon.stuck_runs(runs, ts("2024-01-29 00:00:00"), 6).select("run_id", "event_id", "started_at", "hours_open")


@query(
    "qr9_config_changes",
    "SELECT event_type AS table_fqn, user_id AS config_hash, MIN(ts) AS first_seen_at FROM events GROUP BY event_type, user_id HAVING "
    "MIN(ts) >= TIMESTAMP '2024-01-03 00:00:00'"
)
def _(spark, d):
    registry = src(spark, d, "events").groupBy(
        F.col("event_type").alias("table_fqn"), F.col("user_id").alias("config_hash")
    ).agg(F.min("ts").alias("first_seen_at"))
    return mon.config_changes(registry, ts("2024-01-03 00:00:00"))


@query(
    "qr10_latest_attempt_status",
    f"WITH {_TASKS} SELECT run_id, table_fqn, status FROM (SELECT *, MAX(attempt) OVER (PARTITION BY run_id, table_fqn) AS last FROM "
    "tasks) t WHERE attempt = last"
)
def _(spark, d):
    return mon.final_attempts(tasks(spark, d)).select("run_id", "table_fqn", "status")


@query(
    "qr11_run_status_rollup",
    f"WITH {_TASKS}, c AS (SELECT run_id, CAST(SUM(CASE WHEN status = 'FAILED' THEN 1 ELSE 0 END) AS BIGINT) AS failed, COUNT(*) AS n "
    "FROM (SELECT *, MAX(attempt) OVER (PARTITION BY run_id, table_fqn) AS last FROM tasks) t WHERE attempt = last GROUP BY run_id) "
    "SELECT run_id, CASE WHEN failed = 0 THEN 'SUCCEEDED' WHEN failed = n THEN 'FAILED' ELSE 'PARTIAL' END AS status FROM c"
)
def _(spark, d):
    return mon.run_status(mon.final_attempts(tasks(spark, d)))


@query(
    "qr12_next_attempt",
    f"WITH {_TASKS} SELECT run_id, table_fqn, CAST(COALESCE(MAX(attempt), 0) + 1 AS INT) AS next_attempt FROM tasks GROUP BY run_id, "
    "table_fqn"
)
def _(spark, d):
    return mon.next_attempt(tasks(spark, d))
