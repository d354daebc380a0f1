"""Command line: validate, list-tables, show-plan, jobs, init-control, run, backfill, monitor, status, compact.

Exit codes: 0 done, 1 failed, 2 refused. Only init-control and what comes
after it start Spark.
"""

from __future__ import annotations

import argparse
import json
import sys

from .plans import config, jobs, validate


COMMANDS = ("validate", "list-tables", "show-plan", "jobs", "init-control", "run", "backfill", "monitor", "status", "compact")


def _parser() -> argparse.ArgumentParser:
    common = argparse.ArgumentParser(add_help=False)
    common.add_argument("--config-root", default=argparse.SUPPRESS)
    top = argparse.ArgumentParser(prog="tidewright", parents=[common])
    sub = top.add_subparsers(dest="command", required=True)
    for name in COMMANDS:
        p = sub.add_parser(name, parents=[common])
        if name != "list-tables":
            p.add_argument("--env", required=True)
        if name in ("validate", "show-plan", "run", "backfill"):
            p.add_argument("--table", action="append", required=name in ("show-plan", "backfill"))
        if name == "run":
            p.add_argument("--group")
            p.add_argument("--dry-run", action="store_true")
            p.add_argument("--trigger", default="manual", choices=("manual", "schedule"))
        if name in ("run", "backfill"):
            p.add_argument("--max-workers", type=int, default=1)
        if name == "backfill":
            p.add_argument("--from", dest="start", required=True)
            p.add_argument("--to")
            p.add_argument("--yes", action="store_true")
        if name == "monitor":
            p.add_argument("--query", action="append")
            p.add_argument("--days", type=int, default=7)
        if name == "status":
            p.add_argument("--run")
    return top


def _resolved(root: str, env: str, names: list[str] | None) -> tuple[list[config.Resolved], int]:
    out, bad = [], 0
    for t in names or config.tables(root):
        try:
            r = config.resolve(root, t, env)
            issues = validate.validate(r.config, root)
        except config.ConfigError as e:
            print(f"{t}: error: {e}")
            bad += 1
            continue
        for i in issues:
            print(f"{t}: {i.severity}: {i.path} {i.message}")
        bad += any(i.severity == "error" for i in issues)
        out.append(r)
    return out, bad


def plan(r: config.Resolved) -> dict:
    """What a run would do: read, make the target, load. Nothing is asked of the source."""
    c = r.config
    ext, target, inc = c.get("extraction") or {}, c["target"], (c.get("extraction") or {}).get("incremental") or {}
    mark = validate.mark_name(c)
    tests = [
        f"{mark} {'>' if inc.get('bound_inclusive') is False else '>='} :lower", f"{mark} < :upper"
    ] if ext.get("mode") == "incremental" else []
    read = {
        "mode": ext.get("mode", "full"), "columns": ext.get("columns", "*"), "where": tests + [ext.get("filter")] * bool(ext.get("filter")),
        "query_file": ext.get("query_file"), "limit": ext.get("row_limit")
    }
    make = {
        k: target.get(k) for k in ("table_name", "partition_by", "cluster_by", "table_properties", "enable_change_data_feed")
    } | {"comment": c["table"].get("description")}
    guard = mark if target.get("write_mode") == "merge" and target.get("merge_guard") == "watermark" else None
    load = {
        "mode": target.get("write_mode", "merge"), "keys": target.get("merge_keys"),
        "guard": guard and f"target.{guard} IS NULL OR batch.{guard} >= target.{guard}"
    }
    checks = [e.get("name") or f"{e['rule']}({e['column']})" for e in (c.get("quality") or {}).get("expectations") or []]
    return {
        "table": r.table_fqn, "env": r.env, "hash": r.hash, "source": c["source"].get("type"), "read": read, "make": make, "load": load,
        "checks": checks, "extraction": ext, "target": target
    }


def _look(spark, control, tables: list[config.Resolved], a) -> int:
    """What the control plane holds, one JSON object a row."""
    from pyspark.sql import functions as F

    from .operators import monitoring
    from .operators.control import TABLES, now

    if a.command == "compact":
        print(json.dumps({t: control.compact(t) for t in TABLES}))
        return 0
    if a.command == "status":
        runs = control.latest("ingestion_runs").where(F.col("env") == a.env)
        runs = runs.where(F.col("run_id") == a.run) if a.run else runs.orderBy(F.desc("started_at")).limit(1)
        shown = runs.toJSON().collect()
        ids = [json.loads(x)["run_id"] for x in shown]
        tasks = control.latest("ingestion_tasks").where(F.col("run_id").isin(ids)).orderBy("table_fqn", "attempt")
        print("\n".join([*shown, *tasks.toJSON().collect()]))
        return 0 if shown else 1
    rows = [
        (r.table_fqn, r.env, float(x)) for r in tables if (x := (r.config.get("alerting") or {}).get("freshness_sla_hours")) is not None
    ]
    sla = spark.createDataFrame(rows, "table_fqn string, env string, sla_hours double")
    every = monitoring.dashboard(control, sla, F.lit(now().isoformat(sep=" ")).cast("timestamp_ntz"), a.days)
    unknown = set(a.query or ()) - set(every)
    if unknown:
        print(f"no such query: {', '.join(sorted(unknown))}; there are: {', '.join(every)}")
        return 2
    for name in a.query or every:
        for row in every[name].toJSON().collect():
            print(json.dumps({"query": name, **json.loads(row)}))
    return 0


def main(argv: list[str] | None = None) -> int:
    a = _parser().parse_args(argv)
    root = getattr(a, "config_root", "config")
    if a.command == "list-tables":
        print("\n".join(config.tables(root)))
        return 0
    tables, bad = _resolved(root, a.env, getattr(a, "table", None))
    if getattr(a, "group", None):
        tables = [r for r in tables if (r.config.get("schedule") or {}).get("group") == a.group]
    if a.command == "validate" or bad:
        return 1 if bad else 0
    if a.command == "jobs":
        print(json.dumps({"jobs": jobs.jobs(tables), "across_groups": jobs.across(tables)}))
        return 0
    if a.command == "show-plan" or getattr(a, "dry_run", False):
        for r in tables:
            print(json.dumps(plan(r), default=str))
        return 0

    if a.command == "backfill":
        for r in tables:
            inc = (r.config.get("extraction") or {}).get("incremental") or {}
            if r.config["extraction"].get("mode") == "full" or not (inc.get("watermark_column") or inc.get("strategy") == "scn"):
                print(f"{r.table_fqn} keeps no watermark")
                return 2
        if not a.yes:
            print("a backfill sets watermarks back; say --yes")
            return 2

    from pyspark.sql import SparkSession

    from .operators import logs
    from .operators.control import Control, new_run_id
    from .operators.runner import Runner

    logs.configure(next((x for r in tables if (x := (r.config.get("logging") or {}).get("level"))), "INFO"))

    spark = SparkSession.builder.config("spark.sql.session.timeZone", "UTC").getOrCreate()
    place = next((r.config.get("control") or {} for r in tables), {})
    base = place.get("root") or "/".join(
        x for x in (spark.conf.get("spark.sql.warehouse.dir"), place.get("catalog"), place.get("schema")) if x
    )
    control = Control(spark, base, a.env)
    if a.command == "init-control":
        control.create()
        return 0
    if a.command in ("monitor", "status", "compact"):
        return _look(spark, control, tables, a)
    if a.command == "backfill":
        mark = new_run_id(a.env)
        for r in tables:
            inc = r.config["extraction"]["incremental"]
            control.force(r.table_fqn, a.start, inc.get("watermark_column"), validate.mark_kind(inc), mark)
            control.audit("WATERMARK_FORCED", mark, r.table_fqn, value=a.start)
        control.flush()
    run_id, status, done = Runner(spark, control, root).run(
        tables, "backfill" if a.command == "backfill" else a.trigger, a.max_workers, getattr(a, "to", None)
    )
    print(json.dumps({"run_id": run_id, "status": status, "tables": {t: o.status for t, o in done.items()}}))
    return 0 if status == "SUCCEEDED" else 1


if __name__ == "__main__":
    sys.exit(main())
