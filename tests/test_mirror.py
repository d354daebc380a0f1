"""Windows, merge, store and JDBC on hand-made rows."""

from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timedelta

import pytest

from tidewright.functions.durations import format_duration, parse_duration
from tidewright.operators import merge as m, quality, stage, store as store_module
from tidewright.operators.control import Control
from tidewright.operators.runner import Runner, sql_literal
from tidewright.operators.store import VersionedStore
from tidewright.plans import window as w
from tidewright.plans.config import Resolved
from tidewright.sources.readers import JdbcSource, safe_filter

SCHEMA = "id int, amount int, mark string"


def rows(df):
    return sorted((r["id"] is None, r["id"] or 0, r["amount"], r["mark"] or "") for r in df.collect())


def test_framework_identifiers_are_plain(spark):
    df = spark.range(1)
    assert stage.stamp(df, "dev-2024:1+a.b", "b-1", datetime(2024, 1, 1)).first()["_run_id"] == "dev-2024:1+a.b"
    with pytest.raises(ValueError):
        stage.stamp(df, "x'; --", "b", datetime(2024, 1, 1))


def test_durations_and_windows():
    assert parse_duration("P1DT6H") == timedelta(days=1, hours=6)
    assert format_duration(timedelta(hours=30)) == "P1DT6H"
    with pytest.raises(ValueError):
        parse_duration("P1M")
    assert w.window(None, "timestamp").first and w.window(None, "timestamp").lower is None
    assert w.window(None, "date", None, "2024-01-02").lower == "2024-01-02"
    assert w.window("2024-01-02 03:00:00.000000", "timestamp", timedelta(hours=6)).lower == "2024-01-01 21:00:00.000000"
    assert w.window(
        "2024-01-02", "date", timedelta(hours=6)
    ).lower == "2024-01-01" and w.window("2024-01-02", "date", timedelta(days=2)).lower == "2023-12-31"
    assert w.window("12", "number", timedelta(hours=6)).lower == "12" and w.text_of("1E+3", "number") == "1000"
    assert w.ahead("1.4", "1.2", "number") and not w.ahead("9", "10", "number") and not w.ahead(None, "1", "number") and w.ahead("9", None, "number")
    for bad in ("NaN", "Infinity", "x"):
        with pytest.raises(ValueError):
            w.text_of(bad, "number")
    with pytest.raises(ValueError):
        w.text_of("2024-01-01 00:00:00+02:00", "timestamp")
    with pytest.raises(ValueError):
        safe_filter("1 = 1; drop table x")


def test_guarded_merge(spark):
    target = spark.createDataFrame([(1, 30, "11"), (2, 1, None), (3, 5, "09"), (None, 9, "01")], SCHEMA)
    batch = spark.createDataFrame([(1, 10, "09"), (2, 2, "05"), (3, 6, None), (4, 7, "02"), (None, 8, "02")], SCHEMA)
    got = m.merge(target, batch, ["id"], "mark")
    assert rows(got) == [
        (False, 1, 30, "11"), (False, 2, 2, "05"), (False, 3, 5, "09"), (False, 4, 7, "02"), (True, 0, 8, "02"), (True, 0, 9, "01")
    ]
    assert tuple(m.metrics(target, batch, ["id"], "mark").first()) == (2, 1, 2)
    whole = batch.na.drop(subset=["id"])
    once = m.merge(target, whole, ["id"], "mark")
    assert rows(m.merge(once, whole, ["id"], "mark")) == rows(once)
    with pytest.raises(ValueError):
        m.assert_unique(batch.union(batch), ["id"])


def test_newest_keeps_one_row_and_repeats(spark):
    df = spark.createDataFrame([(1, 10, "09"), (1, 20, "10"), (1, 30, "11"), (1, 31, "11"), (2, 1, None)], SCHEMA)
    first = rows(stage.newest(df, ["id"], "mark"))
    assert len(first) == 2 and first == rows(stage.newest(df.repartition(3), ["id"], "mark"))
    assert stage.duplicates(df, ["id"]).first()[0] == 3
    assert quality.row_count_status(5, 1, 2, 1, 1) == "PASSED" and quality.row_count_status(None, 0, 1) == "SKIPPED"


def test_store_merges_evolves_and_refuses_a_lost_race(spark, tmp_path):
    store = VersionedStore(spark, str(tmp_path / "t"))
    store.write(spark.createDataFrame([(1, 10, "09")], SCHEMA), "merge", ["id"], "mark")
    entry = store.write(spark.createDataFrame([(1, 20, "10", "x"), (2, 5, "01", "y")], SCHEMA + ", note string"), "merge", ["id"], "mark")
    assert entry["metrics"] == {"rows_total": 2, "insert": 1, "update": 1, "reject": 0}
    assert {tuple(r) for r in store.read().collect()} == {(1, 20, "10", "x"), (2, 5, "01", "y")}
    assert rows(store.read(0)) == [(False, 1, 10, "09")]
    with pytest.raises(Exception, match="exist"):
        store._commit(store.read(), 0, [], {})
    store.write(spark.createDataFrame([(7, 7, "07")], SCHEMA), "append")
    assert store.read().count() == 3 and store.version() == 2


def test_jdbc_on_derby(spark):
    url = "jdbc:derby:memory:tw;create=true"
    driver = "org.apache.derby.jdbc.EmbeddedDriver"
    spark.range(100).selectExpr(
        "cast(id as int) AS ID", "cast(id * 2 as int) AS V"
    ).write.format("jdbc").options(url=url, driver=driver, dbtable="T").mode("overwrite").save()
    one = JdbcSource(spark, url, "T", driver)
    assert one.read(("ID",), ("V >= 100",)).count() == 50
    many = JdbcSource(spark, url, "T", driver, partition_column="ID", partitions=4)
    df = many.read(None, ("ID >= 20",))
    assert df.rdd.getNumPartitions() == 4 and df.count() == 80
    assert many.read(None, ("ID > 1000",)).count() == 0
    assert one.scalar("MAX(ID)", one.sql()) == 99


def test_jdbc_literals_and_a_run_on_derby(spark, tmp_path):
    assert sql_literal("2024-01-02", "timestamp", True) == "TO_TIMESTAMP('2024-01-02 00:00:00.000000', 'YYYY-MM-DD HH24:MI:SS.FF6')"
    assert sql_literal("2024-01-02", "date", True) == "TO_DATE('2024-01-02', 'YYYY-MM-DD')" and sql_literal("7", "version", True) == "7"
    with pytest.raises(ValueError):
        sql_literal("1 OR 1=1", "number", False)
    url, driver = "jdbc:derby:memory:run;create=true", "org.apache.derby.jdbc.EmbeddedDriver"
    put = lambda ids, day: spark.createDataFrame([(i, datetime(2024, 1, day)) for i in ids], "ID int, SEEN timestamp").write.format("jdbc").options(
        url=url, driver=driver, dbtable="APP.T", createTableColumnTypes="SEEN TIMESTAMP"
    ).mode("append").save()
    put([1, 2], 1)
    config = {
        "env": "d", "table": {"domain": "d", "name": "t", "source_schema": "APP", "source_object": "T"}, "source": {
            "type": "jdbc", "jdbc": {"url": url, "driver": driver}, "secret_scope": "s", "secret_keys": {"username": "u", "password": "p"}
        },
        "extraction": {
            "mode": "incremental", "columns": ["ID", "SEEN"], "incremental": {"watermark_column": "SEEN", "use_upper_bound": True}
        }, "target": {"write_mode": "append", "table_name": "t", "root": str(tmp_path), "column_case": "lower"},
    }
    asked = []
    control = Control(spark, str(tmp_path / "c"), "d")
    runner = Runner(spark, control, secrets=lambda scope, key: asked.append((scope, key)) or "APP")
    table = Resolved("d.t", "d", config, ())
    _, status, done = runner.run([table])
    assert status == "SUCCEEDED" and control.mark("d.t")["pinned"], done
    assert ("s", "u") in asked and ("s", "p") in asked
    control.force("d.t", "2024-01-02", "SEEN", "timestamp", "r")  # a ceiling that left its own rows out
    put([3], 2)
    assert runner.run([table])[1] == "SUCCEEDED"
    got = VersionedStore(spark, str(tmp_path / "t")).read()
    assert sorted(r["id"] for r in got.collect()) == [1, 2, 3]
    assert Runner._jdbc(runner, config["source"], config["table"]).redacted("x")["password"] == "***"
    one = JdbcSource(
        spark, url, "APP.T", driver, session_init="VALUES 1", fetch_size=7, extra={"fetchsize": "9"}, custom_schema="ID string",
        bounds=("1", "3"), partition_column="ID", partitions=2
    )
    o = one.options(one.sql())
    assert o["fetchsize"] == "9" and o["sessionInitStatement"] == "VALUES 1" and o["lowerBound"] == "1" and o["numPartitions"] == "2"


def test_partition_values_keep_their_type(spark, tmp_path):
    s = VersionedStore(spark, str(tmp_path / "t"))
    schema = "id int, code string"
    s.write(spark.createDataFrame([(1, "01"), (2, "007"), (3, None)], schema), "merge", ["ID"], partition_by=["Code"])
    s.write(spark.createDataFrame([(2, "x9"), (4, "1e3")], schema), "merge", ["id"], partition_by=["code"])
    assert {tuple(r) for r in s.read().collect()} == {(1, "01"), (2, "x9"), (3, None), (4, "1e3")}
    s.write(spark.createDataFrame([(5, "00")], schema), "append")
    s.write(spark.createDataFrame([(5, "0x")], schema), "merge", ["id"])
    assert {tuple(r) for r in s.read().collect()} == {(1, "01"), (2, "x9"), (3, None), (4, "1e3"), (5, "0x")}


def test_merges_touch_only_their_buckets_and_grow(spark, tmp_path, monkeypatch):
    s = VersionedStore(spark, str(tmp_path / "t"))
    first = s.write(spark.range(1000).selectExpr("id", "id AS v"), "merge", ["id"])
    entry = s.write(spark.range(1).selectExpr("id", "-1L AS v"), "merge", ["id"])
    assert entry["metrics"] == {
        "rows_total": entry["metrics"]["rows_total"], "insert": 0, "update": 1, "reject": 0
    } and entry["metrics"]["rows_total"] < 300
    assert len(entry["parts"]) == 2 and entry["parts"][0]["path"] == first["written"] and len(entry["parts"][0]["buckets"]) == 7
    monkeypatch.setattr(store_module, "BUCKET_ROWS", 50)
    for i in range(3):
        entry = s.write(spark.range(2000).selectExpr("id", f"{i}L AS v"), "merge", ["id"])
    assert entry["table"]["buckets"] > 8 and s.read().count() == 2000 and s.read().where("v = 2").count() == 2000


def test_two_writers_lose_nothing(spark, tmp_path):
    root = str(tmp_path / "t")
    one = lambda i: VersionedStore(spark, root).write(spark.createDataFrame([(i, i)], "id int, v int"), "merge", ["id"])
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(one, range(6)))
    assert sorted(
        r["id"] for r in VersionedStore(spark, root).read().collect()
    ) == list(range(6)) and VersionedStore(spark, root).version() == 5


def test_create_history_and_changes(spark, tmp_path):
    s = VersionedStore(spark, str(tmp_path / "t"))
    schema = spark.createDataFrame([], "id int, v string").schema
    assert s.create(schema, "it's a table", cluster_by=["V"], properties={"a": 1}, changes=True) and not s.create(schema)
    assert s.read().count() == 0 and s.entry()["table"]["comment"] == "it's a table" and s.entry()["table"]["cluster_by"] == ["v"]
    with pytest.raises(ValueError):
        VersionedStore(spark, str(tmp_path / "u")).create(schema, partition_by=["w"])
    s.write(spark.createDataFrame([(1, "a"), (2, "b")], schema), "merge", ["id"])
    s.write(spark.createDataFrame([(2, "c"), (3, "d")], schema), "merge", ["id"])
    s.write(spark.createDataFrame([(4, "e")], schema), "append")
    s.write(spark.createDataFrame([(9, "z")], schema), "overwrite")
    got = {tuple(r) for r in s.changes(1).select("id", "v", "_change_type", "_commit_version").collect()}
    assert got == {
        (1, "a", "insert", 1), (2, "b", "insert", 1), (2, "b", "update_preimage", 2), (2, "c", "update_postimage", 2), (3, "d", "insert", 2), (4, "e", "insert", 3), (9, "z", "insert", 4),
        *((i, v, "delete", 4) for i, v in ((1, "a"), (2, "c"), (3, "d"), (4, "e"))),
    }
    assert s.entry()["bytes"] > 0 and s.entry()["added"] == []
    assert [h["mode"] for h in s.history()] == [
        "overwrite", "append", "merge", "merge", "create"
    ] and s.entry()["table"]["properties"] == {"a": "1"}


def test_missing_columns_are_refused(spark, tmp_path):
    s = VersionedStore(spark, str(tmp_path / "t"))
    with pytest.raises(ValueError, match="mark"):
        s.write(spark.createDataFrame([(1,)], "id int"), "merge", ["id"], "mark")
    with pytest.raises(ValueError, match="key"):
        s.write(spark.createDataFrame([(1,)], "id int"), "merge", ["key"])


def test_vacuum_keeps_what_late_versions_name(spark, tmp_path):
    s = VersionedStore(spark, str(tmp_path / "t"))
    for i in range(5):
        s.write(spark.range(50).selectExpr("id", f"{i} AS v"), "merge", ["id"])
    before = {tuple(r) for r in s.read().collect()}
    assert len(s.vacuum(2)) == 3 and s.vacuum(2) == [] and {tuple(r) for r in s.read().collect()} == before and s.read(3).count() == 50
    s.write(spark.range(1).selectExpr("id", "9 AS v", "'x' AS note"), "merge", ["id"])
    assert s.entry()["added"] == ["note"] and s.read().where("note IS NOT NULL").count() == 1
