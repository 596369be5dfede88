"""Run chosen layers and entities from the command line (L1).

    python -m strata --landed <folder> --warehouse <folder> [--prefix dev]
                     [--layers bronze,silver,gold] [--entities shows,cast,episodes]
                     [--reference-mode] [--no-marts] [--optimize] [--declared-only]

The warehouse is a folder that driver and executors share.
"""

from __future__ import annotations

import argparse
import json

from strata.plans.entities import LAYERS, ORDER
from strata.plans.layers import layer_row_counts, run
from strata.session import build_session
from strata.sources.sinks import TableStore


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="strata")
    ap.add_argument("--landed", required=True, help="folder with <entity>/ landed JSON")
    ap.add_argument("--warehouse", required=True, help="folder for the layer databases")
    ap.add_argument("--prefix", default="dev", help="database prefix (environment)")
    ap.add_argument("--layers", default=",".join(LAYERS))
    ap.add_argument("--entities", default=",".join(ORDER))
    ap.add_argument("--reference-mode", action="store_true")
    ap.add_argument("--no-marts", action="store_true")
    ap.add_argument("--optimize", action="store_true", help="compact the tables written")
    ap.add_argument("--declared-only", action="store_true", help="read only the declared fields of landed records")
    ap.add_argument("--master")
    args = ap.parse_args(argv)
    spark = build_session(args.master)
    store = TableStore(spark, args.warehouse, args.prefix)
    done = run(spark, store, args.landed, args.layers.split(","), args.entities.split(","),
               reference_mode=args.reference_mode, with_marts=not args.no_marts,
               optimize=args.optimize, keep_drift=not args.declared_only)
    counts = {r["table_name"]: r["record_count"] for r in layer_row_counts(store).collect()}  # None: no such table
    print(json.dumps({"loaded": {f"{k[0]}.{k[1]}": v for k, v in done.items()},
                      "row_counts": counts}, default=str))


if __name__ == "__main__":
    main()
