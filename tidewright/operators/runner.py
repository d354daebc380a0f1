"""Runs: window, extract, stage, gate, load, reconcile, advance; retries and dependency levels.

An extract is read once and staged in the target's folder, so the gate, the
load and a lost executor's work all see the same rows, whatever the source
does meanwhile.
"""

from __future__ import annotations

import threading
import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import datetime
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.durations import parse_duration
from ..plans import window as w
from ..plans.config import Resolved
from ..plans.validate import RULES, VERSION, mark_kind, mark_name
from ..sources.readers import JdbcSource, Scan, env_secrets, template
from . import alerts, quality as q, stage
from .control import MESSAGE, Control, new_run_id, now, roll_up
from .files import Files
from .logs import Log
from .store import VersionedStore

#: How a source of that type writes moments.
ORACLE_MOMENT, ORACLE_DAY = "YYYY-MM-DD HH24:MI:SS.FF6", "YYYY-MM-DD"


class ReconciliationFailure(RuntimeError):
    def __init__(self, text: str, checks: list[str]):
        super().__init__(text)
        self.checks = checks


class TimedOut(RuntimeError):
    pass


@dataclass
class Outcome:
    table_fqn: str
    status: str
    attempts: int = 0
    error: str | None = None
    metrics: dict = field(default_factory=dict)


def levels(depends: dict[str, list[str]]) -> list[list[str]]:
    """Tables in levels, each after all that it depends on; names outside the run are ignored."""
    left = {t: {d for d in ds if d in depends} for t, ds in depends.items()}
    out = []
    while left:
        free = sorted(t for t, ds in left.items() if not ds)
        if not free:
            raise ValueError(f"dependencies form a circle: {sorted(left)}")
        out.append(free)
        left = {t: ds - set(free) for t, ds in left.items() if t not in free}
    return out


def target_root(spark: SparkSession, c: dict) -> str:
    t = c["target"]
    base = t.get("root") or "/".join(x for x in (spark.conf.get("spark.sql.warehouse.dir"), t.get("catalog"), t.get("schema")) if x)
    return f"{base.rstrip('/')}/{t['table_name']}"


def rules(c: dict) -> list[q.Rule]:
    out = []
    for e in (c.get("quality") or {}).get("expectations") or []:
        name = e.get("name") or f"{e['rule']}({e['column']})"
        out.append(q.Rule(name, e["rule"], e["column"], e.get(RULES[e["rule"]] or ""), e.get("severity", "fail")))
    return out


def found(df: DataFrame, name: str | None) -> str | None:
    """The column of df that a configured name means, whatever its case."""
    return next((c for c in df.columns if name and c.lower() == name.lower()), None)


def all_found(df: DataFrame, names: list[str], what: str) -> list[str]:
    out = [found(df, n) for n in names]
    if None in out:
        raise ValueError(f"{what} {names[out.index(None)]!r} is not among the columns read")
    return out


class Runner:
    """One environment's tables.

    secrets, senders (alert kind -> function) and sources (table -> an object
    with read(Scan), instead of what the configuration names) are pluggable.
    """

    def __init__(
        self, spark: SparkSession, control: Control, config_root: str = ".", secrets: Callable[[str, str], str] = env_secrets,
        senders: dict | None = None, sources: dict | None = None
    ):
        self.spark, self.control, self.root, self.secrets = spark, control, config_root, secrets
        self.log, self.sources = Log(env=control.env), sources or {}
        self.alerts = alerts.Dispatcher(self.log, senders)

    def _extract(self, r: Resolved, lower: str | None, inclusive: bool, kind: str, until: str | None) -> tuple[DataFrame, str | None]:
        """The batch as a lazy frame, and the pinned exclusive ceiling if there is one."""
        c = r.config
        source, ext, table = c["source"], c.get("extraction") or {}, c["table"]
        inc, mode = ext.get("incremental") or {}, ext.get("mode", "full")
        mark, names = mark_name(c), ext.get("columns", "*")
        extra = (mark,) if inc.get("strategy") == "scn" and names != "*" and mark not in names else ()
        columns = None if names == "*" else (*names, *extra)
        scan = Scan(columns, tuple(ext.get("exclude_columns") or ()), ext.get("filter"), None, ext.get("row_limit"))
        ceiling = until
        given = self.sources.get(r.table_fqn)
        if given is not None or source["type"] == "parquet":
            if mode == "query":
                raw = given.read() if given is not None else self.spark.read.parquet(source["path"])
                args = {"lower_bound": lower, "upper_bound": ceiling, "table_fqn": r.table_fqn, "env": c["env"]}
                return template(self.spark, (Path(self.root) / ext["query_file"]).read_text(), args, {"source": raw}), ceiling
            test = w.predicate(mark, kind, lower, ceiling, inclusive) if mode == "incremental" else None
            scan = Scan(scan.columns, scan.exclude, scan.filter, test, scan.limit)
            return given.read(scan) if given is not None else scan.apply(self.spark.read.parquet(source["path"])), ceiling

        oracle = source["type"] == "oracle"
        db = self._jdbc(source, table)
        where = []
        if mode == "incremental":
            if ceiling is None and inc.get("use_upper_bound", True):
                ceiling = self._clock(db, oracle, kind)
            for value, op in ((lower, ">=" if inclusive else ">"), (ceiling, "<")):
                if value is not None:
                    where.append(f"{mark} {op} {sql_literal(value, kind, oracle)}")
        if ext.get("filter"):
            where.append(ext["filter"])
        gone = {x.lower() for x in scan.exclude}
        df = db.read(tuple(x for x in columns if x.lower() not in gone) if columns else None, tuple(where))
        if gone and not columns:
            df = df.select(*[x for x in df.columns if x.lower() not in gone])
        return (df.limit(scan.limit) if scan.limit else df), ceiling

    def _jdbc(self, source: dict, table: dict) -> JdbcSource:
        jdbc, read, keys = source["jdbc"], source.get("read") or {}, source.get("secret_keys") or {}
        ends = (read.get("lower_bound"), read.get("upper_bound"))
        types = ", ".join(f"{k} {v}" for k, v in (source.get("custom_schema") or {}).items())
        return JdbcSource(
            self.spark, jdbc["url"], f"{table['source_schema']}.{table['source_object']}", jdbc.get("driver"), source.get("fetch_size") or 10_000,
            read.get("partition_column"), read.get("num_partitions") or 1, tuple(map(str, ends)) if None not in ends else None,
            jdbc.get("session_init_statement"), types or None, source.get("secret_scope"), self.secrets, jdbc.get("options") or {},
            keys.get("username") or "user", keys.get("password") or "password",
        )

    def _clock(self, db: JdbcSource, oracle: bool, kind: str) -> str | None:
        """The source's own now, as a mark; None where it has none of the kind."""
        if kind == "number" or (kind == "version" and not oracle):
            return None
        what = {
            "version": "DBMS_FLASHBACK.GET_SYSTEM_CHANGE_NUMBER", "date": "TRUNC(SYSDATE)" if oracle else "CURRENT_DATE",
            "timestamp": "SYSTIMESTAMP" if oracle else "CURRENT_TIMESTAMP"
        }[kind]
        sql = f"SELECT {what} AS v FROM dual" if oracle else f"SELECT v FROM (VALUES {what}) x(v)"
        got = self.spark.read.format("jdbc").options(**db.options(sql, parallel=False)).load().first()[0]
        return w.text_of(got, kind)

    def _window(self, c: dict, fqn: str, tracked: bool, kind: str) -> tuple[str | None, bool]:
        """(lower bound, whether it is inclusive).

        A mark that was a pinned exclusive ceiling must be read again, since
        the run before left its rows out. One that was a batch's maximum has
        been read: again for a merge, which loses nothing by it, and not for
        an append, which would hold it twice.
        """
        if not tracked:
            return None, True
        ext = c.get("extraction") or {}
        inc = ext.get("incremental") or {}
        floor = inc.get("lower_bound_default")
        if kind == "version" and str(floor).startswith("1900-01-01"):
            floor = "0"  # the inherited floor is a timestamp
        old = self.control.mark(fqn)
        lower = w.window(old and old["watermark_value"], kind, parse_duration(inc.get("overlap") or "PT0S"), floor).lower
        if inc.get("bound_inclusive") in (True, False):
            return lower, inc["bound_inclusive"]
        return lower, c["target"].get("write_mode", "merge") != "append" or old is None or bool(old.get("pinned"))

    def _attempt(self, r: Resolved, run_id: str, attempt: int, until: str | None) -> dict:
        c, fqn = r.config, r.table_fqn
        ext, target, quality = c.get("extraction") or {}, c["target"], c.get("quality") or {}
        mode, write = ext.get("mode", "full"), target.get("write_mode", "merge")
        kind, mark = mark_kind(ext.get("incremental") or {}), mark_name(c)
        tracked = mode != "full" and bool(mark)
        root = target_root(self.spark, c)
        store = VersionedStore(self.spark, root)
        if tracked and write == "append":
            self._catch_up(store, fqn, mark, kind, run_id)
        lower, inclusive = self._window(c, fqn, tracked, kind)

        self.control.audit("EXTRACT_STARTED", run_id, fqn, lower=lower)
        raw, ceiling = self._extract(r, lower, inclusive, kind, until)
        staged = f"_staging/{run_id}-{attempt}"
        stage.column_case(raw, target.get("column_case") or "preserve").write.mode("overwrite").parquet(f"{root}/{staged}")
        try:
            raw = self.spark.read.schema(stage.column_case(raw, target.get("column_case") or "preserve").schema).parquet(f"{root}/{staged}")
            keys = all_found(raw, target.get("merge_keys") or [], "merge key") if write == "merge" else [
                k for k in (found(raw, x) for x in target.get("merge_keys") or []) if k
            ]
            at = found(raw, mark)
            checks = [q.Rule(x.name, x.kind, all_found(raw, [x.column], "expectation")[0], x.argument, x.severity) for x in rules(c)]
            aggs = [F.count(F.lit(1)).alias("n"), (F.max(at) if tracked and at else F.lit(None)).alias("top")]
            if keys:
                gone = F.col(keys[0]).isNull()
                for k in keys[1:]:
                    gone = gone | F.col(k).isNull()
                aggs.append(F.count_if(gone).alias("null_keys"))
            aggs += [x.violations().alias(f"r{i}") for i, x in enumerate(checks)]
            seen = raw.agg(*aggs).first()
            twice = (stage.duplicates(raw, keys).first()[0] or 0) if write == "merge" else 0
            self.control.audit("EXTRACT_DONE", run_id, fqn, rows=seen["n"])

            report = [("duplicates", "duplicates", q.duplicate_status(twice, mode == "incremental"), twice)]
            if keys and quality.get("null_check_keys", True):
                report.append(("null_keys", "null_keys", "FAILED" if seen["null_keys"] else "PASSED", seen["null_keys"]))
            if quality.get("fail_on_schema_drift"):
                drift = q.drift(store, raw)
                report.append(("schema_drift", "schema_drift", "FAILED" if drift else "PASSED", len(drift)))
            for i, x in enumerate(checks):
                bad = seen[f"r{i}"] or 0
                report.append(("expectation", x.name, "PASSED" if not bad else "WARNED" if x.severity == "warn" else "FAILED", bad))
            lost = [(n, b) for _, n, s, b in report if s == "FAILED"]
            if lost:  # before the commit: bad rows never reach the target
                self._record(r, run_id, report, seen["n"], None)
                raise ReconciliationFailure("; ".join(f"{n}: {b} rows" for n, b in lost), [n for n, _ in lost])

            guard = None
            if write == "merge" and target.get("merge_guard") == "watermark" and mark:
                guard = all_found(raw, [mark], "the merge guard's column")[0]
            batch = stage.newest(raw, keys, at, found(raw, VERSION)) if write == "merge" else raw
            if target.get("add_audit_columns", True):
                batch = stage.stamp(batch, run_id, f"{run_id}-{attempt}", now())
            self._create(store, c, batch)
            self.control.audit("LOAD_STARTED", run_id, fqn, mode=write)
            # an empty batch holds the mark, whatever the source's clock says
            to = None if not tracked or not seen["n"] else ceiling or w.text_of(seen["top"], kind)
            known = self.control.mark(fqn) if tracked else None
            note = {"run_id": run_id, "config_hash": r.hash, "mark": to, "pinned": bool(ceiling), "mark_version": known["version"] if known else None}
            # newest has left one row a key
            evolve = target.get("schema_evolution", True)
            entry = store.write(batch, write, keys, guard, target.get("partition_by"), evolve, unique=True, **note)
            got = entry["metrics"]
            if entry["added"]:
                self.control.audit("SCHEMA_EVOLVED", run_id, fqn, columns=entry["added"])
            inserted = got.get("insert", got["rows_total"])
            updated, rejected = got.get("update", 0), got.get("reject", 0)
            self.control.audit("LOAD_DONE", run_id, fqn, **got)
        finally:
            Files(self.spark, root).delete(staged)

        if quality.get("row_count_reconciliation", True):
            status = q.row_count_status(seen["n"], twice, inserted, updated, rejected)
            report.append(("row_count", "row_count", status, seen["n"] - twice - inserted - updated - rejected))
        self._record(r, run_id, report, seen["n"], inserted + updated)
        self.control.audit("RECONCILIATION_DONE", run_id, fqn)
        if report[-1][2] == "FAILED":
            raise ReconciliationFailure(f"row_count is off by {report[-1][3]}", ["row_count"])

        moved = bool(to) and self.control.advance(fqn, to, mark, kind, run_id, bool(ceiling))
        if tracked:
            self.control.audit("WATERMARK_ADVANCED" if moved else "WATERMARK_HELD", run_id, fqn, value=to)
        return {
            "source_count": seen["n"], "rows_read": seen["n"], "rows_written": inserted + updated, "rows_inserted": inserted,
            "rows_updated": updated, "rows_deleted": 0, "bytes_written": entry["bytes"], "watermark_from": lower,
            "watermark_to": to if moved else None
        }

    def _catch_up(self, store: VersionedStore, fqn: str, mark: str, kind: str, run_id: str) -> None:
        """Move the mark to that of the last append, where a run wrote its rows and then failed before it moved the mark.

        The entry names the mark's version that it was made under; a mark that
        has moved since, or was set back on purpose, is left alone.
        """
        entry = store.entry()
        if not entry or entry["mode"] != "append" or not entry.get("mark"):
            return
        old = self.control.mark(fqn)
        if entry["mark_version"] == (old["version"] if old else None):
            self.control.advance(fqn, entry["mark"], mark, kind, run_id, entry["pinned"])

    def _create(self, store: VersionedStore, c: dict, batch: DataFrame) -> None:
        """The target with its comment, layout, properties and provenance, where it isn't there yet."""
        t, own, s = c["target"], c["table"], c["source"]
        source = ".".join(x for x in (own.get("source_schema"), own.get("source_object")) if x) or s.get("path") or own["name"]
        properties = {"ingestion.source_table": source, "ingestion.managed_by": "tidewright"} | (t.get("table_properties") or {})
        clusters = [x for x in t.get("cluster_by") or [] if found(batch, x)]
        store.create(
            batch.schema, own.get("description"), t.get("partition_by"), clusters, properties, bool(t.get("enable_change_data_feed"))
        )

    def _record(self, r: Resolved, run_id: str, report: list, source: int, written: int | None) -> None:
        at = now()
        rows = [
            {
                "run_id": run_id, "table_fqn": r.table_fqn, "env": r.env, "check_type": k, "check_name": n, "source_count": source,
                "target_count": written, "delta": b, "status": s, "details": None, "checked_at": at
            } for k,
            n, s, b in report
        ]
        self.control.append("reconciliation", rows)

    def _tell(self, r: Resolved, alert: alerts.Alert) -> alerts.Told:
        channels = (r.config.get("alerting") or {}).get(alerts.EVENTS[alert.event]) or []
        return self.alerts.tell(alert, channels)

    def _timed(self, minutes: float | None, work: Callable[[], dict]) -> dict:
        """work, its Spark jobs cancelled when the minutes are over."""
        if not minutes:
            return work()
        sc, group, late = self.spark.sparkContext, f"tw-{threading.get_ident()}-{time.time_ns()}", threading.Event()

        def stop() -> None:
            late.set()
            sc.cancelJobGroup(group)

        timer = threading.Timer(minutes * 60, stop)
        sc.setJobGroup(group, "table", True)
        timer.start()
        try:
            out = work()
        except Exception as e:
            if late.is_set():
                raise TimedOut(f"not done after {minutes:g} minutes") from e
            raise
        finally:
            timer.cancel()
            sc.setJobGroup("", "", False)
        return out

    def stale(self, tables: list[Resolved], run_id: str, as_of: datetime | None = None) -> list[str]:
        """Tables whose mark last moved longer ago than their freshness_sla_hours; their channels are told."""
        out = []
        for r in tables:
            sla = (r.config.get("alerting") or {}).get("freshness_sla_hours")
            mark = self.control.mark(r.table_fqn) if sla is not None else None
            if mark is None:
                continue
            hours = ((as_of or now()) - datetime.fromisoformat(mark["updated_at"])).total_seconds() / 3600
            if hours > sla:
                out.append(r.table_fqn)
                self._tell(r, alerts.stale(r.table_fqn, r.env, run_id, hours, sla))
        return out

    def table(self, r: Resolved, run_id: str, until: str | None = None) -> Outcome:
        """All attempts of one table; failures are returned, not raised."""
        c, fqn, run = r.config, r.table_fqn, r.config.get("runtime") or {}
        base = {
            "run_id": run_id, "table_fqn": fqn, "env": r.env, "extraction_mode": (c.get("extraction") or {}).get("mode", "full"),
            "write_mode": c["target"].get("write_mode", "merge"), "config_hash": r.hash
        }
        self.control.register_config(r.hash, fqn, r.json, list(r.sources), run_id)
        self.control.audit("CONFIG_RESOLVED", run_id, fqn, config_hash=r.hash, sources=list(r.sources))
        most = 1 + (run.get("retries") or 0)
        for attempt in range(1, most + 1):
            began = now()
            row = {**base, "attempt": attempt, "started_at": began}
            self.control.append("ingestion_tasks", [{**row, "status": "RUNNING"}])
            self.control.audit("TASK_STARTED", run_id, fqn, attempt=attempt)
            error: Exception | None = None
            try:
                work = lambda: self._attempt(r, run_id, attempt, until)  # noqa: E731, B023
                got, status = self._timed(run.get("timeout_minutes"), work), "SUCCEEDED"
            except Exception as e:  # any failure of a table becomes its outcome
                got, status, error = {}, "FAILED", e
            end = now()
            text = str(error)[:MESSAGE] if error else None
            self.control.append(
                "ingestion_tasks",
                [{
                    **row, **got, "status": status, "ended_at": end, "duration_ms": int((end - began).total_seconds() * 1000),
                    "error_type": type(error).__name__ if error else None, "error_message": text
                }]
            )
            self.control.audit(f"TASK_{status}", run_id, fqn, error=text)
            self.control.flush()
            if error is None:
                return Outcome(fqn, status, attempt, None, got)
            if attempt < most:
                self.control.audit("TASK_RETRYING", run_id, fqn, attempt=attempt + 1)
                time.sleep(run.get("retry_backoff_seconds") or 0)
        self.log.error(f"{fqn} failed", table_fqn=fqn, run_id=run_id, error_type=type(error).__name__, reason=text)
        if isinstance(error, ReconciliationFailure):
            self._tell(r, alerts.mismatch(fqn, r.env, run_id, error.checks))
        else:
            self._tell(r, alerts.failure(fqn, r.env, run_id, error, most))
        return Outcome(fqn, "FAILED", most, text)

    def _skip(self, r: Resolved, run_id: str, why: str) -> Outcome:
        at = now()
        self.control.append(
            "ingestion_tasks",
            [{
                "run_id": run_id, "table_fqn": r.table_fqn, "env": r.env, "attempt": 1, "status": "SKIPPED", "config_hash": r.hash,
                "started_at": at, "ended_at": at, "error_message": why
            }]
        )
        self.control.audit("TASK_SKIPPED", run_id, r.table_fqn, why=why)
        return Outcome(r.table_fqn, "SKIPPED", 0, why)

    def run(
        self, tables: list[Resolved], trigger: str = "manual", max_workers: int = 1, until: str | None = None
    ) -> tuple[str, str, dict[str, Outcome]]:
        """(run id, status, outcomes): levels in order; dependents of a failed or so skipped table are skipped."""
        env, by_name = self.control.env, {r.table_fqn: r for r in tables}
        order = levels({t: (r.config["table"].get("depends_on") or []) for t, r in by_name.items()})
        self.control.create()
        run_id, began, done = new_run_id(env), now(), {}
        row = {
            "run_id": run_id, "env": env, "trigger": trigger, "triggered_by": self.spark.sparkContext.sparkUser(),
            "table_count": len(tables), "started_at": began
        }
        self.control.append("ingestion_runs", [{**row, "status": "RUNNING"}])
        self.control.audit("RUN_STARTED", run_id)
        broken: set[str] = set()

        def one(t: str) -> Outcome:
            r = by_name[t]
            lost = sorted(broken & set(r.config["table"].get("depends_on") or []))
            if lost:
                return self._skip(r, run_id, f"depends on {', '.join(lost)}")
            if not (r.config.get("runtime") or {}).get("enabled", True):
                return self._skip(r, run_id, "not enabled")
            return self.table(r, run_id, until)

        status, error = "FAILED", None
        try:
            for level in order:
                with ThreadPoolExecutor(max(1, max_workers)) as pool:
                    got = list(pool.map(one, level))
                done |= {o.table_fqn: o for o in got}
                broken |= {o.table_fqn for o in got if o.status == "FAILED" or (o.error or "").startswith("depends on")}
            status = roll_up([o.status for o in done.values()])
            try:
                self.stale(tables, run_id)
            except Exception as e:  # what is told about a run doesn't decide it
                self.log.error(f"freshness was not checked: {e}", run_id=run_id)
        except Exception as e:
            error = str(e)[:MESSAGE]
            raise
        finally:
            end = now()
            self.control.append(
                "ingestion_runs",
                [{
                    **row, "status": status, "ended_at": end, "duration_ms": int((end - began).total_seconds() * 1000),
                    "error_message": error
                }]
            )
            self.control.audit("RUN_FINISHED", run_id, status=status)
            self.control.flush()
        return run_id, status, done


def sql_literal(value: str, kind: str, oracle: bool) -> str:
    """A mark in a source's SQL: parsed and printed again before it enters a statement."""
    text = w.text_of(value, kind)
    if kind in ("number", "version"):
        return text
    if oracle:
        return f"TO_DATE('{text}', '{ORACLE_DAY}')" if kind == "date" else f"TO_TIMESTAMP('{text}', '{ORACLE_MOMENT}')"
    return f"{{d '{text}'}}" if kind == "date" else f"{{ts '{text}'}}"  # what every JDBC driver reads
