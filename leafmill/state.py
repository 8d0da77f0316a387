"""A run's state file, and its lines for logs."""

from __future__ import annotations

import json
import os
import tempfile
from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

EMPTY = {"generated_at": "", "processed_count": 0, "failed_count": 0, "chunk_count": 0, "current_item": None}


def read_state(path: str) -> dict:
    """The state, zeros if the file is missing; a damaged file is an error."""
    if not os.path.exists(path):
        return dict(EMPTY)
    with open(path, encoding="utf-8") as f:
        return EMPTY | json.load(f)


def write_state(state: dict, path: str) -> None:
    """Written beside and then put in its place."""
    folder = os.path.dirname(os.path.abspath(path))
    os.makedirs(folder, exist_ok=True)
    handle, beside = tempfile.mkstemp(dir=folder)
    with os.fdopen(handle, "w", encoding="utf-8") as f:
        json.dump(state, f, sort_keys=True, indent=2, ensure_ascii=False)
    os.replace(beside, path)


def now_utc() -> str:
    return datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")


def status_line(processed: Column, failed: Column, chunks: Column, generated_at: Column, status: Column, path: Column) -> Column:
    """The state in one line; no current item is ``none`` with an empty path."""
    part = lambda name, c: F.concat(F.lit(f"{name}="), c.cast("string"))
    return F.concat_ws(
        " ", F.lit("ingest_progress"), part("processed", processed), part("failed", failed), part("chunks", chunks), part("generated_at", generated_at),
        part("current_status", F.coalesce(status, F.lit("none"))), F.concat(F.lit('current_item="'), F.coalesce(path, F.lit("")), F.lit('"')),
    )
