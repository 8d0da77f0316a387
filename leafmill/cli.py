"""Command line: one ingest run."""

from __future__ import annotations

import argparse
import sys

from .operators.embedding import DEFAULT_VERSION
from .plans.ingest import Config

OK, BAD_ARGUMENTS, RUN_FAILED = 0, 2, 3


def _positive(text: str) -> int:
    n = int(text)
    if n <= 0:
        raise ValueError(text)
    return n


def _switch(text: str) -> bool:
    if text.lower() in ("on", "true", "1"):
        return True
    if text.lower() in ("off", "false", "0"):
        return False
    raise ValueError(text)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser("leafmill", description="Ingest the PDF files of a folder.")
    p.add_argument("--inbox", required=True)
    p.add_argument("--seen-file", default="seen-files")
    p.add_argument("--state-file", default="ingest-state.json")
    p.add_argument("--db-path", default="store")
    p.add_argument("--source-manifest")
    p.add_argument("--embedding-dim", type=_positive, default=16)
    p.add_argument("--embedding-model-version", default=DEFAULT_VERSION)
    p.add_argument("--max-docs", type=_positive, default=25)
    p.add_argument("--timeout-seconds", type=_positive)
    p.add_argument("--ocr-fallback", type=_switch, default=True)
    p.add_argument("--languages", default="en")
    return p


def config_of(args: argparse.Namespace) -> Config:
    languages = tuple(x.strip() for x in args.languages.split(",") if x)
    return Config(args.inbox, args.seen_file, args.db_path, args.source_manifest, args.embedding_dim, args.embedding_model_version, args.max_docs, args.timeout_seconds, args.ocr_fallback, languages)


def status_of(state: dict) -> str:
    """The state in one line."""
    item = state["current_item"] or {}
    counts = " ".join(f"{k}={state[c]}" for k, c in (("processed", "processed_count"), ("failed", "failed_count"), ("chunks", "chunk_count"), ("generated_at", "generated_at")))
    return f'ingest_progress {counts} current_status={item.get("status") or "none"} current_item="{item.get("file_path") or ""}"'


def main(argv: list[str] | None = None) -> int:
    """0 after a run, whether documents failed or not; 2 for bad arguments; 3 if the run itself fails."""
    try:
        args = parser().parse_args(argv)
    except SystemExit as e:
        return OK if e.code == 0 else BAD_ARGUMENTS
    from pyspark.sql import SparkSession
    from pyspark.sql.functions import lit

    from .operators.queue import run_summary
    from .plans.ingest import run
    from .state import now_utc, read_state, write_state

    try:
        spark = SparkSession.builder.appName("leafmill").getOrCreate()
        before = read_state(args.state_file)

        def progress(at: dict) -> dict:
            done = at["counts"]
            state = before | {
                "generated_at": now_utc(), "processed_count": before["processed_count"] + done.get("processed_delta", 0), "failed_count": before["failed_count"] + done.get("failed_delta", 0),
                "chunk_count": before["chunk_count"] + done.get("chunks_delta", 0), "current_item": at["current_item"],
            }
            write_state(state, args.state_file)
            return state

        out = run(spark, config_of(args), progress=progress)
        row = out.first().asDict()
        last = read_state(args.state_file)
        state = progress({"counts": row, "current_item": last["current_item"] if row["current_item"] else before["current_item"]})
        counters = out.drop("current_status", "current_item", "failed_pages").withColumns({"total_processed": lit(state["processed_count"]), "total_failed": lit(state["failed_count"]), "total_chunks": lit(state["chunk_count"])})
        item = state["current_item"] or {}
        print(run_summary(counters, item.get("status"), item.get("file_path"), row["failed_pages"], args.db_path).first()["line"])
        print(status_of(state))
        return OK
    except Exception as e:  # noqa: BLE001
        print(f"ingest failed: {e}", file=sys.stderr)
        return RUN_FAILED


if __name__ == "__main__":
    sys.exit(main())
