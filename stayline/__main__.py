"""Command line: list, run or explain the registered queries.

    python -m stayline list
    python -m stayline run <key> [--sf DIR] [--rows N]
    python -m stayline explain <key> [--sf DIR]
    python -m stayline sql <key>          # the DuckDB oracle statement
"""

from __future__ import annotations

import argparse

from . import catalog


def main() -> None:
    ap = argparse.ArgumentParser(prog="python -m stayline", description=__doc__,
                                 formatter_class=argparse.RawDescriptionHelpFormatter)
    ap.add_argument("command", choices=["list", "run", "explain", "sql"])
    ap.add_argument("key", nargs="?")
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("--rows", type=int, default=20)
    ap.add_argument("--master", default="local[*]")
    a = ap.parse_args()
    qs, sqls = catalog.queries(), catalog.oracle_sql()
    if a.command == "list":
        for k in sorted(qs):
            print(k, "" if k in sqls else "(rows-only)")
        return
    if a.key not in qs:
        ap.error(f"unknown key {a.key!r}; see `python -m stayline list`")
    if a.command == "sql":
        print(sqls.get(a.key, "-- no oracle statement (rows-only key)"))
        return
    from .session import build_session
    spark = build_session(a.master)
    df = qs[a.key](spark, a.sf)
    if a.command == "explain":
        df.explain("formatted")
    else:
        df.show(a.rows, truncate=False)


if __name__ == "__main__":
    main()
