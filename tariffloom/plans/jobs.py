"""Conversion jobs: requests, their checks, states and results. Driver-side objects, no server."""

from __future__ import annotations

import re
import threading
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import UTC, datetime
from enum import StrEnum
from pathlib import Path


class Status(StrEnum):
    PENDING = "pending"
    PROCESSING = "processing"
    COMPLETED = "completed"
    FAILED = "failed"


@dataclass
class ConvertRequest:
    """Exactly one of plan_name and file_name; lists are comma-separated. A direct npi list overrides the postal code."""

    plan_name: str | None = None
    file_name: str | None = None
    cpt_code: str | None = None
    npi: str | None = None
    zipcode: str | None = None
    zipcode_distance_miles: float | None = None

    def __post_init__(self) -> None:
        if bool(self.plan_name) == bool(self.file_name):
            raise ValueError("exactly one of plan_name and file_name is needed")
        if self.zipcode_distance_miles is not None and self.zipcode_distance_miles < 0:
            raise ValueError("zipcode_distance_miles is negative")


@dataclass
class Job:
    id: str
    request: ConvertRequest
    status: Status = Status.PENDING
    progress: str = ""
    result: dict | None = None
    error: str | None = None
    created_at: datetime = field(default_factory=lambda: datetime.now(UTC))


class Jobs:
    """Runs conversions in the background, one thread each of a small pool."""

    def __init__(self, convert: Callable[[ConvertRequest, Callable[[str], None]], dict], workers: int = 2):
        self._convert, self._pool, self._lock = convert, ThreadPoolExecutor(workers), threading.Lock()
        self._jobs: dict[str, Job] = {}

    def submit(self, request: ConvertRequest) -> str:
        job = Job(uuid.uuid4().hex, request)
        with self._lock:
            self._jobs[job.id] = job
        self._pool.submit(self._run, job)
        return job.id

    def _run(self, job: Job) -> None:
        job.status = Status.PROCESSING
        try:
            job.result = self._convert(job.request, lambda text: setattr(job, "progress", text))
            job.status = Status.COMPLETED
        except Exception as e:  # a failed job is a result, not a crash of the pool
            job.error, job.status = str(e), Status.FAILED

    def status(self, job_id: str) -> Job:
        with self._lock:
            return self._jobs[job_id]

    def all(self) -> list[Job]:
        with self._lock:
            return list(self._jobs.values())

    def close(self) -> None:
        self._pool.shutdown(wait=True)


def list_of(text: str | None) -> list[str] | None:
    """Trimmed items of a comma-separated list; None if there are none."""
    items = [x.strip() for x in (text or "").split(",")]
    return [x for x in items if x] or None


def run_id(now: datetime | None = None) -> str:
    return (now or datetime.now(UTC)).strftime("run_%Y%m%d_%H%M%S")


def substituted(config: dict, **values: str) -> dict:
    """A configuration with ${name} replaced by its own top-level values and those given, in all texts."""
    known = {k: v for k, v in config.items() if isinstance(v, str)} | values

    def fix(v):
        if isinstance(v, dict):
            return {k: fix(x) for k, x in v.items()}
        if isinstance(v, list):
            return [fix(x) for x in v]
        return re.sub(r"\$\{(\w+)\}", lambda m: known.get(m[1], m[0]), v) if isinstance(v, str) else v

    return fix(config)


def ensure_folder(path: str | Path) -> Path:
    out = Path(path)
    out.mkdir(parents=True, exist_ok=True)
    return out
