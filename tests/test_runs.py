"""Configuration layers, validation, watermarks, runs and the command line, on small trees."""

import io
import json
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

import pytest

from tidewright import cli
from tidewright.operators import alerts, logs
from tidewright.operators.control import Control, roll_up
from tidewright.operators.runner import Runner, TimedOut, levels
from tidewright.operators.store import VersionedStore
from tidewright.plans import config, jobs, validate
from tidewright.sources.readers import MemorySource, template

yaml = pytest.importorskip("yaml")


@pytest.fixture
def tree(tmp_path):
    files = {
        "defaults.yaml": {
            "source": {"type": "parquet"}, "extraction": {"mode": "full", "columns": "*"},
            "target": {"write_mode": "merge", "merge_guard": "watermark"}, "runtime": {"retries": 1, "retry_backoff_seconds": 0}
        },
        "environments/dev.yaml": {
            "env": "dev", "target": {"root": f"{tmp_path}/lake"}, "control": {"root": f"{tmp_path}/control"},
            "overrides": {"fin.acc": {"table": {"owner": "${env}-${table_fqn}"}}}
        },
        "tables/fin/acc.yaml": {
            "table": {"source_object": "ACC", "business_key": ["id"]}, "source": {"path": f"{tmp_path}/in/acc"},
            "extraction": {"mode": "incremental", "incremental": {"watermark_column": "mark", "overlap": "PT1H"}},
            "quality": {"expectations": [{"column": "amount", "rule": "min", "value": 0}]}
        },
        "tables/fin/sub.yaml": {
            "table": {"business_key": ["id"], "depends_on": ["fin.acc"]}, "source": {"path": f"{tmp_path}/in/acc"},
            "target": {"write_mode": "append"}
        },
    }
    for name, body in files.items():
        p = tmp_path / "config" / name
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_text(yaml.safe_dump(body))
    return tmp_path


def put(spark, tree, rows, mode="append"):
    data = [(i, a, datetime.fromisoformat(m)) for i, a, m in rows]
    spark.createDataFrame(data, "id int, amount int, mark timestamp_ntz").write.mode(mode).parquet(f"{tree}/in/acc")


def test_layers(tree):
    root = tree / "config"
    assert config.tables(root) == ["fin.acc", "fin.sub"]
    r = config.resolve(root, "fin.acc", "dev")
    assert r.config["table"]["owner"] == "dev-fin.acc" and r.config["target"]["merge_keys"] == ["id"] == r.config["target"]["cluster_by"]
    assert r.hash == config.resolve(root, "fin.acc", "dev").hash != config.resolve(root, "fin.sub", "dev").hash
    assert not [i for i in validate.validate(r.config, root) if i.severity == "error"]
    p = tree / "x.yaml"
    p.write_text("a: !append [3]\nb: !merge_by:k [{k: 1, v: 9}, {k: 3}]")
    assert config.merge(
        {"a": [1], "b": [{"k": 1, "v": 1, "w": 2}, {"k": 2}]}, config.load(p)
    ) == {"a": [1, 3], "b": [{"k": 1, "v": 9, "w": 2}, {"k": 2}, {"k": 3}]}
    p.write_text("a: 1\na: 2")
    with pytest.raises(config.ConfigError, match="twice"):
        config.load(p)
    for bad in ({"a": "${b}", "b": "${a}"}, {"a": "${nothing}"}, {"a": "${b}", "b": []}):
        with pytest.raises(config.ConfigError):
            config.interpolate(bad, {})
    for t, env in (("fin", "dev"), ("fin.none", "dev"), ("fin.acc", "prod")):
        with pytest.raises(config.ConfigError):
            config.resolve(root, t, env)


@pytest.mark.parametrize(
    "patch, path",
    [
        ({"nope": 1}, "nope"), ({"target": {"write_mode": "upsert"}}, "target.write_mode"), ({"target": {"merge_keys": []}}, "target.merge_keys"), (
            {"extraction": {"filter": "1=1; --"}}, "extraction.filter"
        ),
        (
            {"extraction": {"incremental": {"overlap": "P1M"}}}, "extraction.incremental.overlap"
        ), ({"extraction": {"columns": ["amount", "mark"]}}, "target.merge_keys"), ({"extraction": {"mode": "query"}}, "extraction.query_file"),
        (
            {"extraction": {"incremental": {"strategy": "scn"}}}, "extraction.incremental.watermark_column"
        ), ({"quality": {"expectations": [{"column": "id", "rule": "regex"}]}}, "quality.expectations[0]"), ({"source": {"read": {"lower_bound": 1}}}, "source.read"),
        ({"extraction": {"incremental": {"lower_bound_default": "soon"}}}, "extraction.incremental.lower_bound_default"), (
            {"source": {"type": "jdbc", "jdbc": {"url": "jdbc:x://u:p@h"}}, "table": {"source_schema": "S"}}, "source.jdbc.url"
        ),
    ],
)
def test_validation(tree, patch, path):
    c = config.merge(config.resolve(tree / "config", "fin.acc", "dev").config, patch)
    assert path in {i.path for i in validate.validate(c, tree) if i.severity == "error"}


def test_levels_and_statuses():
    assert levels({"c": ["b"], "b": ["a", "elsewhere"], "a": []}) == [["a"], ["b"], ["c"]]
    with pytest.raises(ValueError):
        levels({"a": ["b"], "b": ["a"]})
    assert [
        roll_up(x) for x in ([], ["SKIPPED"], ["FAILED"], ["FAILED", "SUCCEEDED"], ["RUNNING", "FAILED"])
    ] == ["SUCCEEDED", "SUCCEEDED", "FAILED", "PARTIAL", "RUNNING"]


def test_runs_advance_gate_and_skip(spark, tree):
    root = str(tree / "config")
    control = Control(spark, f"{tree}/control", "dev")
    told = []
    both = [config.resolve(root, t, "dev") for t in config.tables(root)]
    both = [
        config.Resolved(
            r.table_fqn, r.env, config.merge(r.config, {"alerting": {"on_reconciliation_mismatch": ["mail:x"]}}), r.sources
        ) for r in both
    ]
    runner = Runner(spark, control, root, senders={"mail": lambda target, alert: told.append((target, alert))})
    put(spark, tree, [(1, 10, "2024-01-01 09:00"), (1, 20, "2024-01-01 10:00"), (2, 5, "2024-01-01 08:00")])
    _, status, done = runner.run(both)
    assert status == "SUCCEEDED" and done["fin.acc"].metrics["rows_inserted"] == 2, done
    assert control.mark("fin.acc")["watermark_value"] == "2024-01-01 10:00:00.000000" and control.mark("fin.sub") is None
    acc = VersionedStore(spark, f"{tree}/lake/acc")
    assert {(r["id"], r["amount"], r["_source_op"]) for r in acc.read().collect()} == {(1, 20, "I"), (2, 5, "I")}

    put(spark, tree, [(2, 6, "2024-01-01 11:00"), (3, 7, "2024-01-01 09:30")])
    _, status, done = runner.run(both[:1])
    assert status == "SUCCEEDED" and (done["fin.acc"].metrics["rows_inserted"], done["fin.acc"].metrics["rows_updated"]) == (1, 2)
    before = acc.version()

    put(spark, tree, [(4, -1, "2024-01-01 12:00")])
    run_id, status, done = runner.run(both, max_workers=2)
    assert status == "PARTIAL" and done["fin.acc"].status == "FAILED" and done["fin.acc"].attempts == 2 and done["fin.sub"].status == "SKIPPED"
    assert acc.version() == before and control.mark("fin.acc")["watermark_value"].startswith("2024-01-01 11") and len(told) == 1
    assert told[0][0] == "x" and told[0][1].payload()["failed_checks"] == ["min(amount)"]
    tasks = {(r["table_fqn"], r["attempt"]): r["status"] for r in control.latest("ingestion_tasks").where(f"run_id = '{run_id}'").collect()}
    assert tasks == {("fin.acc", 1): "FAILED", ("fin.acc", 2): "FAILED", ("fin.sub", 1): "SKIPPED"}
    assert {r["status"] for r in control.latest("ingestion_runs").collect()} == {"SUCCEEDED", "PARTIAL"}
    assert control.latest("config_registry").count() == 2 and json.loads(control.latest("config_registry").first()["resolved_json"])
    assert control.latest("audit_log").where("event_type = 'RUN_STARTED'").count() == 3
    assert control.latest("reconciliation").where("status = 'FAILED'").count() == 2


def test_marks_never_go_back_unless_forced(spark, tmp_path):
    c = Control(spark, str(tmp_path), "dev")
    assert c.advance("a.b", "9", "x", "number", "r1") and c.advance("a.b", "10", "x", "number", "r2")
    assert not c.advance("a.b", "9.5", "x", "number", "r3") and not c.advance("a.b", None, "x", "number", "r3")
    assert not c._put("a.b", {"version": 0, "watermark_value": "9"}, "11", "x", "number", "late")
    c.force("a.b", "2", "x", "number", "r4")
    row = c.watermarks().collect()
    assert len(row) == 1 and (row[0]["watermark_value"], row[0]["previous_value"], row[0]["version"]) == ("2", "10", 2)


def test_appends_write_only_the_batch(spark, tmp_path):
    s = VersionedStore(spark, str(tmp_path / "t"))
    for i in range(3):
        entry = s.write(spark.createDataFrame([(i, "x")], "id int, d string"), "append", partition_by=["d"])
        assert len(entry["data"]) == i + 1 and entry["metrics"]["rows_total"] == 1
    assert {r["id"] for r in s.read().collect()} == {0, 1, 2} and s.read(0).count() == 1


def test_command_line(tree, capsys):
    root = ["--config-root", str(tree / "config")]
    assert cli.main([*root, "validate", "--env", "dev"]) == 0
    assert cli.main(["list-tables", *root]) == 0 and "fin.acc" in capsys.readouterr().out
    assert cli.main(["run", "--env", "dev", "--table", "fin.acc", "--dry-run", *root]) == 0
    assert cli.main(["backfill", "--env", "dev", "--table", "fin.sub", "--from", "2024-01-01", "--yes", *root]) == 2
    assert cli.main(["backfill", "--env", "dev", "--table", "fin.acc", "--from", "2024-01-01", *root]) == 2
    assert cli.main(["jobs", "--env", "dev", *root]) == 0 and '"depends_on": ["fin.acc"]' in capsys.readouterr().out
    assert cli.main([*root, "validate", "--env", "none"]) == 1


def _table(tree, name="fin.acc", **patch):
    r = config.resolve(tree / "config", name, "dev")
    return config.Resolved(r.table_fqn, r.env, config.merge(r.config, patch), r.sources)


def test_guard_follows_the_casing_policy(spark, tree):
    put(spark, tree, [(1, 30, "2024-01-03 00:00")])
    t = _table(
        tree, target={"column_case": "lower", "merge_keys": ["ID"]},
        extraction={"mode": "full", "incremental": {"watermark_column": "MARK", "overlap": None}}, quality={"expectations": []}
    )
    runner = Runner(spark, Control(spark, f"{tree}/control", "dev"))
    assert runner.run([t])[1] == "SUCCEEDED"
    put(spark, tree, [(1, 10, "2024-01-02 00:00")], "overwrite")
    assert runner.run([t])[1] == "SUCCEEDED"
    assert [(r["id"], r["amount"]) for r in VersionedStore(spark, f"{tree}/lake/acc").read().collect()] == [(1, 30)]
    lost = _table(
        tree, target={"merge_keys": ["id"]}, extraction={"mode": "full", "exclude_columns": ["mark"]}, runtime={"retries": 0},
        quality={"expectations": []}
    )
    _, status, done = runner.run([lost])
    assert status == "FAILED" and "guard" in done["fin.acc"].error


def test_appends_hold_rows_once(spark, tree):
    put(spark, tree, [(1, 1, "2024-01-01 00:00"), (2, 2, "2024-01-02 00:00")])
    t = _table(tree, target={"write_mode": "append"}, extraction={"incremental": {"overlap": None}})
    control = Control(spark, f"{tree}/control", "dev")
    runner = Runner(spark, control)
    for _ in range(3):
        assert runner.run([t])[1] == "SUCCEEDED"
    assert VersionedStore(spark, f"{tree}/lake/acc").read().count() == 2
    assert "extraction.incremental.overlap" in {
        i.path for i in validate.validate(_table(tree, target={"write_mode": "append"}).config) if i.severity == "error"
    }
    # up to a given end the end's own rows are left for the next run
    put(spark, tree, [(3, 3, "2024-01-03 00:00"), (4, 4, "2024-01-04 00:00")])
    assert runner.run([t], until="2024-01-04")[1] == "SUCCEEDED" and control.mark("fin.acc")["pinned"]
    assert runner.run([t])[1] == "SUCCEEDED"
    assert sorted(r["id"] for r in VersionedStore(spark, f"{tree}/lake/acc").read().collect()) == [1, 2, 3, 4]


def test_an_append_that_failed_after_its_commit_is_not_repeated(spark, tree, monkeypatch):
    put(spark, tree, [(1, 1, "2024-01-01 00:00"), (2, 2, "2024-01-02 00:00")])
    t = _table(tree, target={"write_mode": "append"}, extraction={"incremental": {"overlap": None}})
    control = Control(spark, f"{tree}/control", "dev")
    real, calls = control.advance, []

    def once_broken(*args, **kwargs):
        calls.append(args)
        if len(calls) == 1:
            raise OSError("lost")
        return real(*args, **kwargs)

    monkeypatch.setattr(control, "advance", once_broken)
    _, status, done = Runner(spark, control).run([t])
    assert status == "SUCCEEDED" and done["fin.acc"].attempts == 2
    assert VersionedStore(spark, f"{tree}/lake/acc").read().count() == 2
    assert control.mark("fin.acc")["watermark_value"].startswith("2024-01-02")
    control.force("fin.acc", "2024-01-01 12:00", "mark", "timestamp", "r")  # set back on purpose: read again
    assert Runner(spark, control).run([t])[1] == "SUCCEEDED"
    assert VersionedStore(spark, f"{tree}/lake/acc").read().count() == 3


def test_concurrent_appends_lose_no_row(spark, tmp_path):
    c = Control(spark, str(tmp_path), "dev")
    c.create()
    with ThreadPoolExecutor(8) as pool:
        list(pool.map(lambda i: c.append("audit_log", [{"event_id": str(i), "run_id": "r", "sequence": i}]), range(24)))
    assert sorted(int(r["event_id"]) for r in c.latest("audit_log").collect()) == list(range(24))
    c.append("audit_log", [{"event_id": "3", "run_id": "later"}])
    assert c.compact("audit_log") == 26 and c.compact("audit_log") == 0
    assert {r["event_id"]: r["run_id"] for r in c.latest("audit_log").collect()} == {str(i): "later" if i == 3 else "r" for i in range(24)}


def test_two_workers_and_a_given_source(spark, tree):
    names = ["fin.acc", "fin.sub", "x.y"]
    df = spark.createDataFrame([(1, 5, datetime(2024, 1, 1))], "id int, amount int, mark timestamp_ntz")
    tables = [_table(tree, "fin.acc", target={"table_name": n.replace(".", "_")}, table={"depends_on": []}) for n in names]
    tables = [config.Resolved(n, "dev", t.config, ()) for n, t in zip(names, tables)]
    control = Control(spark, f"{tree}/control", "dev")
    run_id, status, done = Runner(spark, control, sources={n: MemorySource(df) for n in names}).run(tables, max_workers=3)
    assert status == "SUCCEEDED", done
    assert control.latest("ingestion_tasks").where(f"run_id = '{run_id}' AND status = 'SUCCEEDED'").count() == 3
    assert control.latest("config_registry").count() == 3


def test_schema_drift_staleness_and_timeouts(spark, tree):
    put(spark, tree, [(1, 1, "2024-01-01 00:00")])
    told = []
    control = Control(spark, f"{tree}/control", "dev")
    runner = Runner(spark, control, senders={"mail": lambda target, alert: told.append(alert.event)})
    t = _table(
        tree, quality={"fail_on_schema_drift": True}, runtime={"retries": 0, "timeout_minutes": 30},
        alerting={"freshness_sla_hours": 1, "on_freshness_breach": ["mail:y", "nobody"], "on_reconciliation_mismatch": ["mail:y"]}
    )
    assert runner.run([t])[1] == "SUCCEEDED" and not told
    entry = VersionedStore(spark, f"{tree}/lake/acc").history()[-1]
    assert entry["mode"] == "create" and entry["table"]["properties"]["ingestion.managed_by"] == "tidewright" and entry["table"]["cluster_by"] == ["id"]
    assert runner.stale([t], "r", datetime(2100, 1, 1)) == ["fin.acc"] and told == ["freshness_breach"]
    spark.createDataFrame(
        [(2, 2, datetime(2024, 1, 2), "x")], "id int, amount int, mark timestamp_ntz, note string"
    ).write.mode("overwrite").parquet(f"{tree}/in/acc")
    _, status, done = runner.run([t])
    assert status == "FAILED" and "schema_drift" in done["fin.acc"].error and told[-1] == "reconciliation_mismatch"
    def forever():
        return spark.range(10**13).selectExpr("sum(hash(id))").first()

    with pytest.raises(TimedOut):
        runner._timed(0.02, forever)


def test_alerts_and_logs():
    out = io.StringIO()
    logs.configure("INFO", out)
    d = alerts.Dispatcher(logs.Log(run_id="r"), {"bad": lambda target, alert: 1 / 0})
    told = d.tell(alerts.failure("a.b", "dev", "r1", ValueError("no"), 2), ["mail:x", "bad:y", "nothing", ":z"])
    assert told.delivered == ["mail:x"] and list(told.failed) == ["bad:y"] and told.unroutable == ["nothing", ":z"]
    lines = [json.loads(x) for x in out.getvalue().splitlines()]
    assert len(lines) == 4 and lines[0]["error_type"] == "ValueError" and lines[0]["run_id"] == "r1" and {x["level"] for x in lines} == {"WARNING", "ERROR"}
    logs.Log().bind(message="mine").info("said")
    last = json.loads(out.getvalue().splitlines()[-1])
    assert last["message"] == "said" and last["field_message"] == "mine"


def test_jobs(tree):
    a = _table(
        tree, schedule={"group": "g", "cron": "0 0 * * * ?", "job_retries": 1}, alerting={"on_failure": ["email:a@b.c", "slack:#x"]},
        runtime={"timeout_minutes": 5}
    )
    b = _table(tree, "fin.sub", schedule={"group": "g"})
    other = config.Resolved("x.z", "dev", config.merge(b.config, {"schedule": {"group": "h"}}), ())
    made = jobs.jobs([b, a, other])
    g = made[0]
    assert [t["task"] for t in g["tasks"]] == ["fin.acc", "fin.sub"] and g["tasks"][1]["depends_on"] == ["fin.acc"] and g["tasks"][0]["timeout_seconds"] == 300
    assert g["notify_on_failure"] == ["a@b.c"] and g["schedule"]["cron"] and g["max_concurrent_runs"] == 1 and made[1]["not_enforced"] == ["x.z -> fin.acc"]
    assert jobs.across([a, b, other]) == [{"table": "x.z", "group": "h", "needs": "fin.acc", "needs_group": "g"}]
    circle = [_table(tree, table={"depends_on": ["fin.sub"]}, schedule={"group": "g"}), b]
    with pytest.raises(config.ConfigError):
        jobs.jobs(circle)
    with pytest.raises(config.ConfigError):
        jobs.jobs([a, _table(tree, "fin.sub", schedule={"group": "g", "cron": "other"})])


def test_templates_do_not_meet(spark):
    df = spark.range(3)
    got = [
        template(
            spark, "WITH big AS (SELECT * FROM source WHERE id >= :least) SELECT id FROM big;", {"least": i},
            {"source": df.where(f"id <> {i}")}
        ) for i in range(2)
    ]
    assert [sorted(r["id"] for r in x.collect()) for x in got] == [[1, 2], [2]]
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("tw_")]


def test_looking_at_the_control_plane(spark, tree, capsys):
    put(spark, tree, [(1, 1, "2024-01-01 00:00")])
    root = ["--config-root", str(tree / "config")]
    assert cli.main(["run", "--env", "dev", "--table", "fin.acc", "--trigger", "schedule", *root]) == 0
    capsys.readouterr()
    assert cli.main(["status", "--env", "dev", *root]) == 0 and '"trigger":"schedule"' in capsys.readouterr().out
    assert cli.main(["monitor", "--env", "dev", *root]) == 0 and '"query": "table_health"' in capsys.readouterr().out
    assert cli.main(["monitor", "--env", "dev", "--query", "nothing", *root]) == 2
    assert cli.main(["compact", "--env", "dev", *root]) == 0
