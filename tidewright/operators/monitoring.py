"""Operational queries over control tables; as_of stands for now, so results repeat. Results are small and ordered for reading."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

GOOD, BAD = "SUCCEEDED", "FAILED"


def seconds_between(start: Column, end: Column) -> Column:
    """By whole seconds of either."""
    whole = lambda t: F.date_trunc("second", t.cast("timestamp_ntz"))
    return F.timestamp_diff("SECOND", whole(start), whole(end))


def rounded_hours(start: Column, end: Column) -> Column:
    """To hundredths, halves up; whole numbers until the last step, so that no other engine rounds otherwise."""
    return F.floor((seconds_between(start, end) + 18) / 36) / F.lit(100.0)


def _seconds(ms: Column) -> Column:
    return F.round(F.avg(ms).cast("double") / 1000.0, 1)


def _since(df: DataFrame, column: str, since: Column | None) -> DataFrame:
    return df if since is None else df.where(F.col(column) >= since)


def success_rate(runs: DataFrame, since: Column | None = None) -> DataFrame:
    g = _since(runs, "started_at", since).groupBy(F.to_date("started_at").alias("run_date"), "env", "status")
    return g.agg(
        F.count("*").alias("runs"), _seconds(F.col("duration_ms")).alias("avg_seconds")
    ).orderBy(F.desc("run_date"), "env", "status")


def final_attempts(tasks: DataFrame) -> DataFrame:
    """One shuffle: the newest attempt by window instead of a self-join."""
    w = Window.partitionBy("run_id", "table_fqn")
    return tasks.withColumn("__last", F.max("attempt").over(w)).where("attempt = __last").drop("__last")


def table_health(tasks: DataFrame, since: Column | None = None) -> DataFrame:
    good, bad = F.count_if(F.col("status") == GOOD), F.count_if(F.col("status") == BAD)
    g = final_attempts(_since(tasks, "started_at", since)).groupBy("table_fqn", "env").agg(
        F.count("*").alias("runs"), good.alias("succeeded"), bad.alias("failed"),
        F.round(100.0 * good.cast("double") / F.count("*"), 1).alias("success_pct"),
        F.max("attempt").alias("max_attempts"), _seconds(F.col("duration_ms")).alias("avg_seconds"),
    )
    return g.orderBy(F.desc("failed"), "success_pct", "table_fqn")


def freshness(marks: DataFrame, sla: DataFrame, as_of: Column) -> DataFrame:
    """sla: configuration, a row per table and environment. Breaches first, then the others, tables without an answer last.

    A table with an SLA whose mark never moved is there too, without an age.
    """
    j = marks.join(sla, ["table_fqn", "env"], "full_outer")
    age = seconds_between(F.col("updated_at"), as_of) / F.lit(3600.0)
    breached = F.when(F.col("sla_hours").isNotNull(), age > F.col("sla_hours"))
    value = ["watermark_value"] if "watermark_value" in marks.columns else []
    out = j.select(
        "table_fqn", "env", *value, "updated_at", rounded_hours(F.col("updated_at"), as_of).alias("hours_since_advance"), "sla_hours",
        breached.alias("sla_breached")
    )
    return out.orderBy(F.desc_nulls_last("sla_breached"), F.desc("hours_since_advance"), "table_fqn", "env")


def volume_trend(tasks: DataFrame, since: Column | None = None) -> DataFrame:
    good = _since(tasks, "started_at", since).where(F.col("status") == GOOD)
    daily = good.groupBy("table_fqn", "env", F.to_date("started_at").alias("load_date")).agg(
        F.sum("rows_written").alias("rows_written"), F.sum("source_count").alias("source_count")
    )
    base = daily.groupBy("table_fqn", "env").agg(F.percentile("rows_written", F.lit(0.5)).alias("med"))
    j = daily.join(base, ["table_fqn", "env"], "left")
    off = F.when(F.col("med") != 0, F.round(100.0 * (F.col("rows_written") - F.col("med")) / F.col("med"), 1))
    out = j.select(
        "table_fqn", "env", "load_date", "rows_written", "source_count", F.round("med", 0).alias("median_rows"), off.alias("pct_vs_median")
    )
    return out.orderBy(F.desc("load_date"), "table_fqn", "env")


def recent_failures(tasks: DataFrame, n: int = 50, tie: str = "run_id") -> DataFrame:
    return tasks.where(F.col("status") == BAD).orderBy(F.desc("started_at"), tie).limit(n)


def watermark_stalls(tasks: DataFrame, last: int = 5, keys: tuple[str, ...] = ("table_fqn", "env"), tie: str = "run_id") -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(F.desc("started_at"), F.desc(tie))
    r = tasks.where(F.col("status") == GOOD).withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= last)
    still = F.count_if(F.col("watermark_to").isNull())
    g = r.groupBy(*keys).agg(
        F.count("*").alias("successful_runs"), still.alias("runs_with_no_new_data"), F.max("started_at").alias("last_run_at")
    )
    return g.where((F.col("runs_with_no_new_data") == last) & (F.col("successful_runs") == last)).orderBy(*keys)


def stuck_runs(runs: DataFrame, as_of: Column, hours: int) -> DataFrame:
    open_ = runs.where((F.col("status") == "RUNNING") & (F.col("started_at") < as_of - F.make_dt_interval(hours=F.lit(hours))))
    return open_.withColumn("hours_open", rounded_hours(F.col("started_at"), as_of)).orderBy("started_at")


def reconciliation_issues(checks: DataFrame, since: Column | None = None) -> DataFrame:
    out = _since(checks, "checked_at", since).where(F.col("status").isin("FAILED", "WARNED"))
    return out.orderBy(F.desc("checked_at")) if "checked_at" in out.columns else out


def config_changes(registry: DataFrame, since: Column) -> DataFrame:
    return registry.where(F.col("first_seen_at") >= since).orderBy(F.desc("first_seen_at"), "table_fqn")


def run_status(tasks: DataFrame) -> DataFrame:
    """RUNNING while a task is open; a skipped one hasn't failed; FAILED only if all have."""
    bad, n = F.count_if(F.col("status") == BAD), F.count("*")
    open_ = F.count_if(F.col("status").isin("PENDING", "RUNNING"))
    status = F.when(open_ > 0, "RUNNING").when(bad == 0, "SUCCEEDED").when(bad == n, "FAILED").otherwise("PARTIAL")
    return tasks.groupBy("run_id").agg(status.alias("status"))


def next_attempt(tasks: DataFrame) -> DataFrame:
    return tasks.groupBy("run_id", "table_fqn").agg((F.coalesce(F.max("attempt"), F.lit(0)) + 1).cast("int").alias("next_attempt"))


def dashboard(control, sla: DataFrame, as_of: Column, days: int = 7) -> dict[str, DataFrame]:
    """All queries over a control plane, by name."""
    since = as_of - F.make_dt_interval(days=F.lit(days))
    runs, tasks = control.latest("ingestion_runs"), control.latest("ingestion_tasks")
    return {
        "run_success_rate": success_rate(runs, since), "table_health": table_health(tasks, since), "freshness": freshness(control.watermarks(), sla, as_of),
        "volume_trend": volume_trend(tasks, as_of - F.make_dt_interval(days=F.lit(30))), "recent_failures": recent_failures(tasks),
        "reconciliation_issues": reconciliation_issues(control.latest("reconciliation"), since), "stuck_runs": stuck_runs(runs, as_of, 6),
        "config_changes": config_changes(
            control.latest("config_registry"), as_of - F.make_dt_interval(days=F.lit(30))
        ), "watermark_stalls": watermark_stalls(tasks),
    }
