"""Run one registered query and write its result.

    python -m kestrel QUERY TABLES_DIR OUT_PATH [--format parquet] [--input-bytes N]
    spark-submit kestrel/__main__.py QUERY TABLES_DIR OUT_PATH ...

``TABLES_DIR`` holds the input tables (``orders.parquet``, ``documents.parquet``, ...).
The result replaces whatever is at ``OUT_PATH``. ``--input-bytes`` sizes the
session with :func:`kestrel.session.cluster_settings`; without it the cluster's
own defaults apply. ``--list`` prints the query names.
"""

from __future__ import annotations

import argparse
import os
import sys

if __package__ in (None, ""):
    # Run as a script (spark-submit kestrel/__main__.py): put the package root on the path.
    # Only the driver imports kestrel; executors run JVM expressions only.
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main(argv: list[str] | None = None) -> int:
    from pyspark.sql import SparkSession

    from kestrel.plans import QUERIES
    from kestrel.session import cluster_settings
    from kestrel.sources import write

    ap = argparse.ArgumentParser(prog="kestrel", description=__doc__.splitlines()[0])
    ap.add_argument("query", nargs="?")
    ap.add_argument("tables_dir", nargs="?")
    ap.add_argument("out_path", nargs="?")
    ap.add_argument("--format", default="parquet")
    ap.add_argument("--input-bytes", type=int, default=None)
    ap.add_argument("--list", action="store_true")
    args = ap.parse_args(argv)
    if args.list:
        print("\n".join(sorted(QUERIES)))
        return 0
    if not (args.query and args.tables_dir and args.out_path) or args.query not in QUERIES:
        ap.error("need QUERY TABLES_DIR OUT_PATH with a registered QUERY (see --list)")

    builder = SparkSession.builder.appName(f"kestrel-{args.query}")
    if args.input_bytes:
        for key, value in cluster_settings(args.input_bytes).items():
            builder = builder.config(key, value)
    spark = builder.getOrCreate()
    try:
        write(QUERIES[args.query](spark, args.tables_dir), args.out_path, fmt=args.format)
    finally:
        spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
