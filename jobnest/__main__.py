"""Command line: ``python -m jobnest {queries,run,daily} ...``.

    python -m jobnest queries                         list the registered queries
    python -m jobnest run NAME SF_DIR [--explain] [--show N]
    python -m jobnest daily LANDING --run-date YYYY-MM-DD [...]   (see plans/flows.py)
"""

from __future__ import annotations

import argparse
import sys


def main(argv: list[str] | None = None) -> int:
    argv = list(sys.argv[1:] if argv is None else argv)
    if argv and argv[0] == "daily":
        from jobnest.plans.flows import main as daily
        daily(argv[1:])
        return 0
    ap = argparse.ArgumentParser(prog="python -m jobnest")
    sub = ap.add_subparsers(dest="cmd", required=True)
    sub.add_parser("queries", help="list the registered queries")
    run = sub.add_parser("run", help="run one registered query")
    run.add_argument("name")
    run.add_argument("sf_dir")
    run.add_argument("--explain", action="store_true", help="print the formatted physical plan")
    run.add_argument("--show", type=int, default=20, help="rows to print")
    sub.add_parser("daily", help="the daily chain over a landing folder (see plans/flows.py)")
    a = ap.parse_args(argv)

    from jobnest.plans.queries import QUERIES
    if a.cmd == "queries":
        for name, q in QUERIES.items():
            print(f"{name:28s} {(q.__doc__ or '').strip().splitlines()[0]}")
        return 0
    from jobnest.session import get_session
    spark = get_session()
    df = QUERIES[a.name](spark, a.sf_dir.rstrip("/"))
    if a.explain:
        df.explain("formatted")
    else:
        df.show(a.show, truncate=60)
    return 0


if __name__ == "__main__":
    sys.exit(main())
