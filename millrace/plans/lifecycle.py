"""Runs: where they lie, their documents, statuses and guards."""

from __future__ import annotations

import contextlib
from datetime import UTC, datetime

from pyspark.sql import SparkSession

from ..sources.readers import read_json
from ..sources.writers import write_json
from .dims import SCOPES

STATUSES = ("running", "completed", "completed_with_failures", "blocked", "failed", "interrupted")
SCHEMA_VERSION = "1.0"


def run_root(base: str, family: str, run_id: str, language: str | None = None) -> str:
    """Where a run lies: under `shared`, or under its language."""
    if family not in SCOPES:
        raise ValueError(f"unknown task family {family}")
    if SCOPES[family] == "language" and not language:
        raise ValueError(f"{family} needs a language")
    return f"{base}/{'shared' if SCOPES[family] == 'shared' else language}/runs/{family}--{run_id}"


def resolve_run_id(asked: str | None, stored: str | None, own_folder: bool = False) -> str:
    if asked and stored and asked != stored:
        raise ValueError(f"run id {asked} asked for, {stored} stored")
    if own_folder and not stored and not asked:
        raise ValueError("a folder of one's own needs a run id")
    return asked or stored or "default"


def differences(doc: dict, expected: dict) -> list[str]:
    """Supplied fields that a stored document has otherwise; a document that isn't there differs in nothing."""
    return [k for k, v in expected.items() if v is not None and doc and doc.get(k) != v]


def final_status(completed: int, failed: int) -> str:
    return "completed" if not failed else "completed_with_failures" if completed else "failed"


def now() -> str:
    return datetime.now(UTC).isoformat()


class Run:
    """Documents of one run: run, config, lineage, manifest."""

    def __init__(self, spark: SparkSession, base: str, family: str, run_id: str, language: str | None = None):
        self.spark, self.family, self.run_id, self.language = spark, family, run_id, language
        self.root = run_root(base, family, run_id, language)

    def read(self, name: str) -> dict | None:
        return read_json(self.spark, f"{self.root}/{name}.json")

    def write(self, name: str, doc: dict) -> None:
        write_json(self.spark, f"{self.root}/{name}.json", doc)

    def set_status(self, status: str, **more) -> None:
        if status not in STATUSES:
            raise ValueError(status)
        doc = self.read("run") or {"task_family": self.family, "run_id": self.run_id, "run_name": f"{self.family}--{self.run_id}", "run_scope": SCOPES[self.family], "language": self.language, "schema_version": SCHEMA_VERSION, "created_at": now()}
        self.write("run", doc | more | {"status": status, "updated_at": now()})

    @contextlib.contextmanager
    def running(self, config: dict, lineage: list[dict] = (), resume: bool = False):
        """Guards, documents and status around a job; the job may give totals with done(). An error leaves status failed and goes on."""
        stored = self.read("config")
        if stored is not None and not resume:
            raise FileExistsError(f"{self.root} has content; resume it or take another run id")
        if bad := differences(stored or {}, config):
            raise ValueError(f"resumed with another {', '.join(bad)}")
        self.write("config", config)
        self.write("lineage", {"sources": list(lineage)})
        self.set_status("running")
        totals = {}
        try:
            yield totals.update
        except KeyboardInterrupt:
            self.set_status("interrupted")
            raise
        except BaseException as e:
            self.set_status("failed", error=f"{type(e).__name__}: {e}")
            raise
        status = totals.pop("status", None) or final_status(totals.get("completed_count", 0), totals.get("failed_count", 0))
        self.write("manifest", {"task_family": self.family, "run_id": self.run_id} | totals)
        self.set_status(status)
