"""Control plane: append-only Parquet tables with latest-row views, and fenced watermarks.

Every append has a folder of its own below the table's day, so writers never
meet; rows of a task are gathered and written together. compact() leaves one
folder with the last row of each key.
"""

from __future__ import annotations

import json
import threading
import time
import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..plans import window as w
from .files import Files

#: Columns and keys of the control tables.
TABLES = {
    "config_registry": (
        "config_hash string, table_fqn string, env string, resolved_json string, config_sources array<string>, first_seen_at "
        "timestamp_ntz, last_seen_at timestamp_ntz, last_run_id string",
        ["config_hash", "table_fqn", "env"]
    ),
    "ingestion_runs": (
        "run_id string, env string, status string, trigger string, triggered_by string, job_id string, job_run_id string, table_count "
        "int, started_at timestamp_ntz, ended_at timestamp_ntz, duration_ms long, error_message string",
        ["run_id"]
    ),
    "ingestion_tasks": (
        "run_id string, table_fqn string, env string, attempt int, status string, extraction_mode string, write_mode string, "
        "watermark_from string, watermark_to string, source_count long, rows_read long, rows_written long, rows_inserted long, "
        "rows_updated long, rows_deleted long, bytes_written long, config_hash string, started_at timestamp_ntz, ended_at "
        "timestamp_ntz, duration_ms long, error_type string, error_message string",
        ["run_id", "table_fqn", "attempt"],
    ),
    "audit_log": (
        "event_id string, run_id string, table_fqn string, env string, event_type string, event_ts timestamp_ntz, sequence int, actor "
        "string, payload string",
        ["event_id"]
    ),
    "reconciliation": (
        "run_id string, table_fqn string, env string, check_type string, check_name string, source_count long, target_count long, "
        "delta long, status string, details string, checked_at timestamp_ntz",
        ["run_id", "table_fqn", "check_name", "checked_at"]
    ),
}
MARK = (
    "table_fqn string, env string, watermark_column string, watermark_type string, watermark_value string, previous_value string, "
    "run_id string, updated_at string, version long, pinned boolean"
)
OPEN, CLOSED = ("PENDING", "RUNNING"), ("SUCCEEDED", "FAILED", "SKIPPED")
BUFFER, MESSAGE = 100, 8000


def now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def new_run_id(env: str) -> str:
    return f"{env}-{now():%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:6]}"


def roll_up(statuses: list[str]) -> str:
    """Status of a run: RUNNING while a task is open; a skipped task has not failed."""
    failed = statuses.count("FAILED")
    if any(s in OPEN for s in statuses):
        return "RUNNING"
    return "SUCCEEDED" if not failed else "FAILED" if failed == len(statuses) else "PARTIAL"


class Control:
    """Rows are only ever appended; `_seq` orders the versions of one key."""

    def __init__(self, spark: SparkSession, root: str, env: str):
        self.spark, self.root, self.env = spark, root.rstrip("/"), env
        self.lock, self.events, self.count, self.last = threading.RLock(), [], 0, 0
        self.files = Files(spark, root)

    @staticmethod
    def schema(table: str) -> StructType:
        return StructType.fromDDL(f"{TABLES[table][0]}, _seq long")

    def create(self) -> None:
        """Idempotent; an empty part gives each table its schema on disk."""
        for t in TABLES:
            if not self.files.exists(t):
                self.append(t, [])

    def _numbers(self, n: int) -> int:
        """The first of n numbers that no append of this process has had, in order of time."""
        with self.lock:
            first = max(time.time_ns(), self.last + 1)
            self.last = first + n
        return first

    def append(self, table: str, rows: list[dict]) -> None:
        schema, seq = self.schema(table), self._numbers(len(rows))
        data = [tuple({**r, "_seq": seq + i}.get(f.name) for f in schema) for i, r in enumerate(rows)]
        folder = f"{self.root}/{table}/day={now():%Y-%m-%d}/{uuid.uuid4().hex}"
        self.spark.createDataFrame(data, schema).coalesce(1).write.parquet(folder)

    def rows(self, table: str) -> DataFrame:
        """All versions of all rows."""
        return self.spark.read.schema(self.schema(table)).option("recursiveFileLookup", True).parquet(f"{self.root}/{table}")

    def latest(self, table: str) -> DataFrame:
        """One row per key, the last one appended: a partial maximum before the only shuffle, no sort."""
        own = self.schema(table).names
        best = self.rows(table).groupBy(*TABLES[table][1]).agg(F.max_by(F.struct(*own), "_seq").alias("r"))
        return best.select("r.*").drop("_seq")

    def compact(self, table: str) -> int:
        """Rewrite a table as one folder of its last rows; appends meanwhile are left alone. Returns the folders replaced."""
        old = [f"{table}/{d}/{n}" for d in self.files.names(table) for n in self.files.names(f"{table}/{d}")]
        if len(old) < 2:
            return 0
        rows = self.spark.read.schema(self.schema(table)).parquet(*[f"{self.root}/{f}" for f in old])
        own = self.schema(table).names
        best = rows.groupBy(*TABLES[table][1]).agg(F.max_by(F.struct(*own), "_seq").alias("r")).select("r.*")
        # readers may see old and new together: the same rows twice, which latest() makes one again
        best.write.parquet(f"{self.root}/{table}/day={now():%Y-%m-%d}/{uuid.uuid4().hex}")
        for f in old:
            self.files.delete(f)
        return len(old)

    def register_config(self, config_hash: str, table_fqn: str, text: str, sources: list[str], run_id: str) -> None:
        seen = self.latest("config_registry").where(
            (F.col("config_hash") == config_hash) & (F.col("table_fqn") == table_fqn) & (F.col("env") == self.env)
        ).first()
        at = now()
        first = seen["first_seen_at"] if seen else at
        self.append(
            "config_registry",
            [{
                "config_hash": config_hash, "table_fqn": table_fqn, "env": self.env, "resolved_json": text, "config_sources": sources,
                "first_seen_at": first, "last_seen_at": at, "last_run_id": run_id
            }]
        )

    def audit(self, event: str, run_id: str, table_fqn: str | None = None, **payload) -> None:
        """Buffered; flushed when full, at the end of a task and of a run."""
        with self.lock:
            self.count += 1
            row = {
                "event_id": uuid.uuid4().hex, "run_id": run_id, "table_fqn": table_fqn, "env": self.env, "event_type": event,
                "event_ts": now(), "sequence": self.count, "actor": self.spark.sparkContext.sparkUser(),
                "payload": json.dumps(payload, default=str)
            }
            self.events.append(row)
            full = len(self.events) >= BUFFER
        if full:
            self.flush()

    def flush(self) -> None:
        with self.lock:
            rows, self.events = self.events, []
        if rows:
            self.append("audit_log", rows)

    # Watermarks: one exclusively created file per version, so of two writers one loses.

    def _marks(self, table_fqn: str) -> str:
        return f"watermarks/env={self.env}/table={table_fqn}"

    def mark(self, table_fqn: str) -> dict | None:
        names = [n for n in self.files.names(self._marks(table_fqn)) if n.endswith(".json")]
        return json.loads(self.files.read(f"{self._marks(table_fqn)}/{names[-1]}")) if names else None

    def _put(
        self, table_fqn: str, old: dict | None, value: str | None, column: str | None, kind: str, run_id: str, pinned: bool = False
    ) -> bool:
        version = old["version"] + 1 if old else 0
        row = {
            "table_fqn": table_fqn, "env": self.env, "watermark_column": column, "watermark_type": kind, "watermark_value": value,
            "previous_value": old and old["watermark_value"], "run_id": run_id, "updated_at": now().isoformat(sep=" "), "version": version,
            "pinned": pinned
        }
        return self.files.put(f"{self._marks(table_fqn)}/{version:020d}.json", json.dumps(row))

    def advance(self, table_fqn: str, value: str | None, column: str | None, kind: str, run_id: str, pinned: bool = False) -> bool:
        """Move the mark forward, never back; compared as its type. False: held, or another run is further.

        pinned: the mark is a ceiling whose own rows have not been read yet.
        """
        while True:
            old = self.mark(table_fqn)
            if not w.ahead(value, old and old["watermark_value"], kind):
                return False
            if self._put(table_fqn, old, w.text_of(value, kind), column, kind, run_id, pinned):
                return True

    def force(self, table_fqn: str, value: str, column: str | None, kind: str, run_id: str) -> None:
        """Set the mark, backwards too; the previous value is kept."""
        while not self._put(table_fqn, self.mark(table_fqn), w.text_of(value, kind), column, kind, run_id, True):
            pass

    def watermarks(self) -> DataFrame:
        rows = self.spark.read.schema(MARK).option("wholetext", True).json(f"{self.root}/watermarks/*/*")
        best = rows.groupBy("table_fqn", "env").agg(F.max_by(F.struct(*rows.columns), "version").alias("r")).select("r.*")
        return best.withColumn("updated_at", F.col("updated_at").cast("timestamp_ntz"))
