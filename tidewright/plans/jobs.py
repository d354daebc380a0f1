"""Jobs for a scheduler: one per schedule group, one task per table, as plain data."""

from __future__ import annotations

from dataclasses import asdict, dataclass, field

from .config import ConfigError, Resolved


@dataclass(frozen=True)
class Cluster:
    """What a job's tasks run on."""

    key: str = "main"
    node_type: str = "standard"
    workers: int = 2
    spark_conf: dict[str, str] = field(default_factory=lambda: {"spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true"})


def _of(r: Resolved, block: str) -> dict:
    return r.config.get(block) or {}


def schedule(group: str, members: list[Resolved]) -> dict | None:
    """The group's one schedule; tables without a cron follow those that have one."""
    plans = {(s["cron"], s.get("timezone") or "UTC") for r in members if (s := _of(r, "schedule")).get("cron")}
    if len(plans) > 1:
        raise ConfigError(f"group {group} has several schedules: {sorted(plans)}")
    return next(({"cron": c, "timezone": z, "paused": False} for c, z in plans), None)


def mails(members: list[Resolved]) -> list[str]:
    """E-mail addresses among the failure channels; other kinds are told by the run itself."""
    every = (str(ch) for r in members for ch in _of(r, "alerting").get("on_failure") or [])
    return sorted({ch.partition(":")[2].strip() for ch in every if ch.lower().startswith("email:")} - {""})


def in_order(members: list[Resolved]) -> list[Resolved]:
    """Members, each after those that it needs; a circle is refused."""
    left = {r.table_fqn: r for r in members}
    out: list[Resolved] = []
    while left:
        free = [t for t, r in left.items() if not set(r.config["table"].get("depends_on") or []) & set(left)]
        if not free:
            raise ConfigError(f"dependencies form a circle: {sorted(left)}")
        out += [left.pop(t) for t in sorted(free)]
    return out


def task(r: Resolved, names: set[str], cluster: Cluster) -> dict:
    run, needs = _of(r, "runtime"), r.config["table"].get("depends_on") or []
    minutes = run.get("timeout_minutes")
    return {
        "task": r.table_fqn, "cluster": cluster.key, "description": r.config["table"].get("description"), "depends_on": sorted(d for d in needs if d in names),
        "timeout_minutes": minutes, "timeout_seconds": minutes and int(minutes * 60), "max_retries": _of(r, "schedule").get("job_retries") or 0,
        "arguments": ["run", "--env", r.env, "--table", r.table_fqn],
    }


def across(tables: list[Resolved]) -> list[dict]:
    """Dependencies between groups, which no edge of a job can express."""
    group = {r.table_fqn: _of(r, "schedule").get("group") or "default" for r in tables}
    pairs = ((r.table_fqn, d) for r in tables for d in r.config["table"].get("depends_on") or [])
    return [{"table": t, "group": group[t], "needs": d, "needs_group": group[d]} for t, d in pairs if d in group and group[d] != group[t]]


def jobs(tables: list[Resolved], cluster: Cluster = Cluster(), tags: dict[str, str] | None = None) -> list[dict]:
    """Tables that are not enabled have no task; a group without a task has no job. Runs of one job never overlap."""
    groups: dict[str, list[Resolved]] = {}
    for r in tables:
        if _of(r, "runtime").get("enabled", True):
            groups.setdefault(_of(r, "schedule").get("group") or "default", []).append(r)
    out = []
    for group, members in sorted(groups.items()):
        members, plan = in_order(members), schedule(group, members)
        names = {r.table_fqn for r in members}
        lost = [f"{r.table_fqn} -> {d}" for r in members for d in r.config["table"].get("depends_on") or [] if d not in names]
        out.append({
            "job": group, "name": f"{members[0].env}-{group}", "cron": plan and plan["cron"], "timezone": plan["timezone"] if plan else "UTC", "schedule": plan,
            "max_concurrent_runs": 1, "clusters": [asdict(cluster)], "tags": {
                "managed_by": "tidewright", "schedule_group": group, **(tags or {})
            },
            "notify_on_failure": mails(members), "tasks": [task(r, names, cluster) for r in members], "not_enforced": lost,
        })
    return out
