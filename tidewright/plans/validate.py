"""What a resolved configuration must fulfil: first its shape, then what its parts mean together."""

from __future__ import annotations

import re
from dataclasses import dataclass
from pathlib import Path

from ..functions.durations import parse_duration
from ..sources.readers import safe_filter
from . import window as w

_NAME = re.compile(r"[A-Za-z][A-Za-z0-9_$#]{0,127}")
_TEXT, _LIST, _MAP, _INT, _BOOL = (str, type(None)), (list,), (dict,), (int, type(None)), (bool,)
#: The keys of each block; a set lists all values allowed.
SHAPE = {
    "version": _INT, "env": _TEXT,
    "table": {
        "domain": _TEXT, "name": _TEXT, "source_schema": _TEXT, "source_object": _TEXT, "business_key": _LIST, "description": _TEXT,
        "owner": _TEXT, "depends_on": _LIST
    },
    "source": {
        "type": {"oracle", "jdbc", "parquet"}, "path": _TEXT, "fetch_size": _INT, "secret_scope": _TEXT, "secret_keys": _MAP, "custom_schema": _MAP,
        "jdbc": {"driver": _TEXT, "url": _TEXT, "session_init_statement": _TEXT, "options": _MAP},
        "read": {
            "num_partitions": _INT, "partition_column": _TEXT, "lower_bound": (str, int, float, type(None)),
            "upper_bound": (str, int, float, type(None)), "bounds_strategy": {"auto", "explicit"}
        },
    },
    "extraction": {
        "mode": {"full", "incremental", "query"}, "columns": (str, list), "exclude_columns": _LIST, "filter": _TEXT, "query_file": _TEXT, "row_limit": _INT,
        "incremental": {
            "strategy": {"watermark", "scn"}, "watermark_column": _TEXT, "watermark_type": {"timestamp", "date", "number"},
            "overlap": _TEXT, "lower_bound_default": (str, int, float, type(None)), "bound_inclusive": {"auto", True, False},
            "use_upper_bound": _BOOL
        },
    },
    "target": {
        "catalog": _TEXT, "schema": _TEXT, "root": _TEXT, "table_name": _TEXT, "layer": _TEXT, "format": {"delta", "parquet"}, "write_mode": {"merge", "append", "overwrite"}, "merge_keys": _LIST, "merge_guard": {"watermark", "none"},
        "enable_change_data_feed": _BOOL, "partition_by": _LIST, "cluster_by": _LIST, "add_audit_columns": _BOOL, "schema_evolution": _BOOL, "column_case": {"preserve", "lower"}, "table_properties": _MAP,
    },
    "control": {"catalog": _TEXT, "schema": _TEXT, "root": _TEXT},
    "quality": {"row_count_reconciliation": _BOOL, "fail_on_schema_drift": _BOOL, "null_check_keys": _BOOL, "expectations": _LIST},
    "runtime": {"enabled": _BOOL, "retries": _INT, "retry_backoff_seconds": (int, float), "timeout_minutes": _INT},
    "logging": {"level": _TEXT},
    "alerting": {
        "on_failure": _LIST, "on_reconciliation_mismatch": _LIST, "on_freshness_breach": _LIST,
        "freshness_sla_hours": (int, float, type(None))
    },
    "schedule": {"group": _TEXT, "cron": _TEXT, "timezone": _TEXT, "job_retries": _INT},
}
VERSION = "ORA_ROWSCN"
RULES = {"not_null": None, "unique": None, "in_set": "values", "min": "value", "max": "value", "regex": "pattern"}


@dataclass(frozen=True)
class Issue:
    severity: str
    path: str
    message: str


def _shape(x, want, path: str) -> list[Issue]:
    if isinstance(want, dict):
        if not isinstance(x, dict):
            return [Issue("error", path, "must be a mapping")]
        unknown = [Issue("error", f"{path}.{k}".strip("."), "no such key") for k in x if k not in want]
        return unknown + [i for k, v in x.items() if k in want for i in _shape(v, want[k], f"{path}.{k}".strip("."))]
    if isinstance(want, set):
        return [] if any(x == v and type(x) is type(v) for v in want) else [
            Issue("error", path, f"must be one of {sorted(map(str, want))}")
        ]
    fits = isinstance(x, want) and (not isinstance(x, bool) or bool in want)
    return [] if fits else [Issue("error", path, f"has the wrong type: {type(x).__name__}")]


def mark_kind(inc: dict) -> str:
    return "version" if inc.get("strategy") == "scn" else inc.get("watermark_type") or "timestamp"


def mark_name(c: dict) -> str | None:
    """The column that a table's watermark follows; of a source by version, the version's own."""
    inc = (c.get("extraction") or {}).get("incremental") or {}
    if inc.get("strategy") == "scn":
        return VERSION if c["source"]["type"] == "oracle" else "_version"
    return inc.get("watermark_column")


def validate(c: dict, root: str | Path = ".") -> list[Issue]:
    """Issues of a resolved configuration; none of severity error means that it can run."""
    out = _shape(c, SHAPE, "")
    if out:
        return out

    def say(bad, path: str, message: str, severity: str = "error") -> None:
        if bad:
            out.append(Issue(severity, path, message))

    table, source, ext, target = (c.get(k) or {} for k in ("table", "source", "extraction", "target"))
    inc, read, jdbc, quality = ext.get("incremental") or {}, source.get("read") or {}, source.get("jdbc") or {}, c.get("quality") or {}
    mode, write = ext.get("mode", "full"), target.get("write_mode", "merge")
    scn, mark = inc.get("strategy") == "scn", inc.get("watermark_column")
    keys = target.get("merge_keys") or []
    is_jdbc = source.get("type") != "parquet"

    if is_jdbc:
        for k in ("source_schema", "source_object"):
            say(not _NAME.fullmatch(str(table.get(k) or "")), f"table.{k}", "must be an identifier")
        url = jdbc.get("url") or ""
        say(not url, "source.jdbc.url", "is required")
        say(re.search(r"(?i)(password|user)\s*=|//[^/@:]+:[^/@]+@|:[^/@:]+/[^/@]+@", url), "source.jdbc.url", "must not hold credentials")
        say(source.get("type") == "oracle" and not source.get("secret_scope"), "source.secret_scope", "is required")
    else:
        say(not source.get("path"), "source.path", "is required")

    columns = ext.get("columns", "*")
    named = columns if isinstance(columns, list) else None
    say(named is None and columns != "*", "extraction.columns", "must be * or a list")
    if named is not None:
        low = [str(x).lower() for x in named]
        say([x for x in named if not _NAME.fullmatch(str(x))], "extraction.columns", "must be plain identifiers")
        say(len(set(low)) < len(low), "extraction.columns", "names a column twice")
    if ext.get("filter"):
        try:
            safe_filter(ext["filter"])
        except ValueError as e:
            say(True, "extraction.filter", str(e))

    try:
        overlap = parse_duration(inc.get("overlap") or "PT0S")
    except ValueError as e:
        overlap = None
        say(True, "extraction.incremental.overlap", str(e))
    tracked = mode == "incremental" or (mode == "query" and (scn or mark))
    say(mode == "incremental" and not scn and not mark, "extraction.incremental.watermark_column", "is required")
    say(scn and mark, "extraction.incremental.watermark_column", "is set by the strategy")
    say(overlap and write == "append", "extraction.incremental.overlap", "would append rows twice")
    say(overlap and not tracked, "extraction.incremental.overlap", "needs an incremental extraction")
    say(mode == "full" and mark, "extraction.incremental.watermark_column", "only breaks ties in a full load", "warning")
    if tracked and inc.get("lower_bound_default") is not None:
        try:
            w.Mark.of(str(inc["lower_bound_default"]), mark_kind(inc))
        except ValueError as e:
            say(
                not (scn and str(inc["lower_bound_default"]).startswith("1900-01-01")), "extraction.incremental.lower_bound_default", str(e)
            )

    file = ext.get("query_file")
    if mode == "query":
        say(not file or not (Path(root) / file).exists(), "extraction.query_file", "must be a file")
        say(named is not None or ext.get("filter"), "extraction", "columns and filter belong into the query")
        if file and (Path(root) / file).exists() and tracked and inc.get("use_upper_bound", True):
            say(
                ":upper_bound" not in (Path(root) / file).read_text(), "extraction.query_file",
                "must use :upper_bound, or rows beyond it are read twice"
            )
    else:
        say(file, "extraction.query_file", "needs mode query")

    say(write == "merge" and not keys, "target.merge_keys", "are required")
    say(
        write == "merge" and target.get("merge_guard") == "watermark" and not (mark or scn), "target.merge_guard",
        "has no watermark to compare", "warning"
    )
    say(
        inc.get("bound_inclusive") is True and write == "append", "extraction.incremental.bound_inclusive",
        "appends the last mark's rows again", "warning"
    )
    say(target.get("partition_by") and target.get("cluster_by"), "target.cluster_by", "is not used beside partition_by", "warning")
    say(
        target.get("enable_change_data_feed") and target.get("format") == "delta", "target.format",
        "is written as versioned Parquet, change rows too", "warning"
    )
    for key, channels in (c.get("alerting") or {}).items():
        for text in channels if isinstance(channels, list) else []:
            say(not re.fullmatch(r"[A-Za-z]+:.+", str(text)), f"alerting.{key}", f"{text} is no channel kind:target")
    sla = (c.get("alerting") or {}).get("freshness_sla_hours")
    say(sla is not None and not tracked, "alerting.freshness_sla_hours", "needs a watermark to age", "warning")
    level = (c.get("logging") or {}).get("level")
    say(level and level.upper() not in ("DEBUG", "INFO", "WARNING", "ERROR"), "logging.level", "must be DEBUG, INFO, WARNING or ERROR")
    odd = sorted(set(source.get("secret_keys") or {}) - {"username", "password"})
    say(odd, "source.secret_keys", f"has no use for {', '.join(odd)}")
    say(write == "merge" and target.get("partition_by"), "target.partition_by", "is of little use with merge", "warning")
    say(write == "overwrite" and keys, "target.merge_keys", "are not used by overwrite", "warning")
    say(write == "merge" and not table.get("business_key"), "table.business_key", "is not given", "warning")
    if named is not None:
        have = {x.lower() for x in named} - {
            str(x).lower() for x in ext.get("exclude_columns") or []
        } | {"_ingested_date", "_ingested_at"} | ({"ora_rowscn"} if scn else set())
        say(not have - {"_ingested_date", "_ingested_at"}, "extraction.exclude_columns", "leaves no column")
        wanted = [
            ("target.merge_keys", keys), ("target.partition_by", target.get("partition_by") or []),
            ("target.cluster_by", target.get("cluster_by") or []),
            ("quality.expectations", [e.get("column") for e in quality.get("expectations") or []])
        ]
        wanted += [
            ("extraction.incremental.watermark_column", [mark] if mark else []),
            ("source.read.partition_column", [read["partition_column"]] if read.get("partition_column") else [])
        ]
        for path, names in wanted:
            for x in names:
                say(str(x).lower() not in have, path, f"{x} is not read")

    n = read.get("num_partitions") or 1
    say(not 1 <= n <= 512, "source.read.num_partitions", "must lie between 1 and 512")
    say(n > 1 and not read.get("partition_column"), "source.read.num_partitions", "needs a partition column", "warning")
    ends = [read.get("lower_bound") is not None, read.get("upper_bound") is not None]
    say(
        any(ends) != all(ends) or (read.get("bounds_strategy") == "explicit" and not all(ends)), "source.read",
        "explicit bounds need both ends"
    )
    for i, e in enumerate(quality.get("expectations") or []):
        path, rule = f"quality.expectations[{i}]", e.get("rule")
        say(rule not in RULES or not e.get("column"), path, "needs a column and a known rule")
        say(RULES.get(rule) and e.get(RULES.get(rule)) is None, path, f"{rule} needs {RULES.get(rule)}")
        say(e.get("severity", "fail") not in ("fail", "warn"), path, "severity is fail or warn")
    return out
