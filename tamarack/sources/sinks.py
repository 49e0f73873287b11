"""Results as files that are written once, and a log of runs."""

from __future__ import annotations

import json
import os
import time
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class Refused(RuntimeError):
    """Why a file was not written; never its values."""


def write_csv(rows: DataFrame, folder: str, columns: Sequence[str], order: Sequence[str] = ()) -> None:
    """A folder of CSV parts with headers, in order if one is given; refuses to replace anything. Spark sorts by ranges, so no task holds all."""
    out = rows.orderBy(*order) if order else rows
    flat = [F.array_join(F.col(c), "; ").alias(c) if dict(rows.dtypes)[c].startswith("array<string") else F.col(c) for c in columns]
    out.select(*flat).write.mode("errorifexists").option("header", True).option("escape", '"').csv(folder)


def write_once(path: str | Path, content: dict) -> None:
    """A read-only JSON manifest; refuses if there is one."""
    try:
        handle = os.open(path, os.O_CREAT | os.O_EXCL | os.O_WRONLY, 0o600)
    except FileExistsError:
        raise Refused("the manifest exists") from None
    with os.fdopen(handle, "w", encoding="utf-8") as f:
        json.dump(content, f, sort_keys=True)
    os.chmod(path, 0o444)


def append_log(path: str | Path, entry: dict) -> None:
    """One more line of a log of JSON lines."""
    with open(path, "a", encoding="utf-8") as f:
        f.write(json.dumps(entry, sort_keys=True) + "\n")


@contextmanager
def recorded_run(path: str | Path, stage: str, params: dict) -> Iterator[dict]:
    """Logs a run with its parameters, times and the statistics that its body puts into the dict it gets; a failed run is logged as such."""
    stats: dict = {}
    entry = {"run_id": uuid.uuid4().hex, "stage": stage, "params": params, "started_at": time.time()}
    try:
        yield stats
        entry["status"] = "ok"
    except BaseException:
        entry["status"] = "failed"
        raise
    finally:
        append_log(path, entry | {"stats": stats, "finished_at": time.time()})
