"""The run ledger: what ran, how it ended, and the exit code that follows."""

from __future__ import annotations

import json
import secrets
import time
from contextlib import contextmanager
from dataclasses import asdict, dataclass, field
from datetime import datetime, timezone

from pyspark.sql import SparkSession

_ALPHABET = "0123456789ABCDEFGHJKMNPQRSTVWXYZ"
SAMPLES, SUMMARY_CHARS = 20, 4000


def run_id(at: float | None = None) -> str:
    """A time-sortable id: 10 characters of milliseconds, 16 random ones."""
    n = (int((time.time() if at is None else at) * 1000) << 80) | secrets.randbits(80)
    return "".join(_ALPHABET[(n >> (5 * i)) & 31] for i in range(25, -1, -1))


@dataclass
class Run:
    source: str
    mode: str
    run_id: str = field(default_factory=run_id)
    status: str = "running"
    started_at: str = field(default_factory=lambda: datetime.now(timezone.utc).isoformat())
    finished_at: str | None = None
    records_count: int | None = None
    errors_count: int = 0
    error_summary: str | None = None
    samples: list[str] = field(default_factory=list)

    def error(self, what: str) -> None:
        self.errors_count += 1
        if len(self.samples) < SAMPLES:
            self.samples.append(what)

    @property
    def exit_code(self) -> int:
        """0 for success, 1 where some records failed, 2 where the run did."""
        return {"success": 0, "partial": 1}.get(self.status, 2)


class Ledger:
    """One JSON file per run in a folder of the file system that the tables are in: written when the run
    starts, replaced when it ends."""

    def __init__(self, spark: SparkSession, folder: str):
        self.folder = folder.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._path = self._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _put(self, run: Run) -> None:
        part, to = (self._path(f"{self.folder}/{name}") for name in (f"_{run.run_id}", f"{run.run_id}.json"))
        out = self._fs.create(part, True)
        out.write(bytearray(json.dumps(asdict(run)).encode()))
        out.close()
        self._fs.delete(to, False)
        if not self._fs.rename(part, to):
            raise OSError(f"cannot write {to}")

    def all(self) -> list[dict]:
        found = sorted(str(f.getPath()) for f in self._fs.globStatus(self._path(f"{self.folder}/*.json")) or [])
        return [json.loads(self._read(f)) for f in found]

    def _read(self, path: str) -> str:
        stream = self._fs.open(self._path(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    @contextmanager
    def run(self, source: str, mode: str):
        """A running row inside the block; on leaving, success, partial (errors were counted) or, with
        the exception going on, failed."""
        r = Run(source, mode)
        self._put(r)
        try:
            yield r
            r.status = "partial" if r.errors_count else "success"
        except BaseException as e:
            r.status = "failed"
            r.error(f"{type(e).__name__}: {e}")
            raise
        finally:
            r.finished_at = datetime.now(timezone.utc).isoformat()
            r.error_summary = "; ".join(r.samples)[:SUMMARY_CHARS] or None
            self._put(r)
