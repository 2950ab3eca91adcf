"""Command line: ``python -m starloom <command>`` (works under spark-submit).

  build  --sf-dir DIR --out DIR       write the star schema (dims + fact by year)
  query  --sf-dir DIR --out DIR KEY   run one registered query into parquet
  list                                print the registered query keys

``--roles`` reads DIR as tables already in the warehouse-role shapes
(``starloom.sources.roles``) instead of the supplied source tables.
"""

from __future__ import annotations

import argparse
import sys


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="starloom")
    sub = ap.add_subparsers(dest="cmd", required=True)
    b = sub.add_parser("build")
    b.add_argument("--sf-dir", required=True)
    b.add_argument("--out", required=True)
    b.add_argument("--roles", action="store_true")
    q = sub.add_parser("query")
    q.add_argument("--sf-dir", required=True)
    q.add_argument("--out", required=True)
    q.add_argument("--roles", action="store_true")
    q.add_argument("key")
    sub.add_parser("list")
    args = ap.parse_args(argv)

    from starloom.registry import PLANS
    if args.cmd == "list":
        print("\n".join(sorted(PLANS)))
        return 0
    if args.cmd == "query" and args.key not in PLANS:
        print(f"unknown key {args.key!r}", file=sys.stderr)
        return 2

    from starloom.operators.keys import release_stored
    from starloom.session import get_session
    from starloom.sources.io import write_table
    from starloom.sources.roles import RoleWarehouse
    from starloom.sources.tables import Warehouse
    spark = get_session()
    wh = (RoleWarehouse if args.roles else Warehouse)(spark, args.sf_dir)
    if args.cmd == "build":
        from starloom.plans.build import build_star
        for name, path in build_star(wh, args.out).items():
            print(f"{name}\t{path}")
    else:
        write_table(PLANS[args.key](wh), args.out)
    release_stored(spark)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
