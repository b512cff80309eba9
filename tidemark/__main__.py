"""Command-line entry: ``spark-submit --py-files tidemark.zip -m tidemark daily ...``
(or ``python -m tidemark daily ...`` locally).

The session comes from the submitting environment (master, memory, shuffle
partitions, ``spark.checkpoint.dir``); only the time zone and AQE settings the
engine relies on are ensured.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys

from .plans.daily import Landing, run_daily
from .plans.jobs import DEFAULT_BUCKETS
from .session import get_spark


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="tidemark")
    sub = ap.add_subparsers(dest="cmd", required=True)
    d = sub.add_parser("daily", help="run every phase whose inputs have landed")
    d.add_argument("--hub", required=True, help="root of the published tables (shared storage)")
    d.add_argument("--run", required=True, help="sortable run id, e.g. 20250105000000")
    d.add_argument("--run-date", required=True, help="run date yyyy-mm-dd (audit columns)")
    d.add_argument("--product-type", default=None)
    d.add_argument("--buckets", type=int, default=DEFAULT_BUCKETS)
    d.add_argument("--no-transactions-hwm", action="store_true",
                   help="leave transaction marks to the bootstrap (source-system behaviour)")
    for field in Landing.__dataclass_fields__:
        d.add_argument(f"--{field.replace('_', '-')}", dest=field, default=None)
    a = ap.parse_args(argv)
    spark = get_spark()
    landing = Landing(**{f: getattr(a, f) for f in Landing.__dataclass_fields__})
    done = run_daily(spark, landing, a.hub, a.run, dt.date.fromisoformat(a.run_date),
                     product_type=a.product_type, advance_transactions_hwm=not a.no_transactions_hwm,
                     buckets=a.buckets)
    print(json.dumps({"run": a.run, "phases": done}))
    return 0


if __name__ == "__main__":
    sys.exit(main())
