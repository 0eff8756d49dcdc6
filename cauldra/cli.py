"""``python -m cauldra.cli ingest|load|normalize ...``: the batch runs from a shell or spark-submit."""

from __future__ import annotations

import argparse
import json
import sys
from datetime import date, datetime, timezone
from pathlib import Path

from .plans.ingest import ingest
from .plans.pipeline import load, normalize
from .plans.runs import Ledger
from .plans.store import Store
from .session import any_session
from .sources.config import read_config


def _arguments(args: list[str] | None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="cauldra")
    p.add_argument("--master", help="Spark master; by default what spark-submit was told, else this machine")
    sub = p.add_subparsers(dest="command", required=True)
    for name in ("ingest", "load", "normalize"):
        s = sub.add_parser(name)
        s.add_argument("--ledger", required=True)
        if name == "ingest":
            s.add_argument("--raw", required=True)
            s.add_argument("--config", required=True, help="YAML or JSON file of sources")
            which = s.add_mutually_exclusive_group(required=True)
            which.add_argument("--vendor", action="append")
            which.add_argument("--all", action="store_true")
            s.add_argument("--mode", choices=("full", "incremental"), default="full")
            continue
        s.add_argument("--store", required=True)
        s.add_argument("--since", type=date.fromisoformat)
        if name == "load":
            s.add_argument("--raw", required=True)
            s.add_argument("--dedup", choices=("global", "consecutive"), default="global")
        else:
            s.add_argument("--source")
            s.add_argument("--base-urls", default="{}", help="JSON object or a file that holds one")
            s.add_argument("--as-of", default=datetime.now(timezone.utc).isoformat())
    return p.parse_args(args)


def main(args: list[str] | None = None) -> int:
    """0 where all went well, 1 where some records (or vendors) failed, 2 where the run did."""
    a = _arguments(args)
    spark = any_session(a.master)
    ledger = Ledger(spark, a.ledger)
    try:
        if a.command == "ingest":
            config = read_config(a.config)
            done = ingest(spark, config, None if a.all else a.vendor, a.raw, ledger, a.mode)
            for name, status in done.items():
                print(f"{name}: {status}")
            good = sum(s == "success" for s in done.values())
            return 0 if good == len(done) else 1 if any(s != "failed" for s in done.values()) else 2
        store = Store(spark, a.store)
        with ledger.run(a.command, "since" if a.since else "full") as run:
            if a.command == "load":
                load(spark, a.raw, store, a.since, run, a.dedup).show(100, truncate=False)
            else:
                urls = json.loads(Path(a.base_urls).read_text() if Path(a.base_urls).is_file() else a.base_urls)
                normalize(spark, store, urls, a.as_of, a.since, a.source, run).show(100, truncate=False)
    except Exception as e:
        print(f"failed: {e}", file=sys.stderr)
        return 2
    return run.exit_code


if __name__ == "__main__":
    sys.exit(main())
