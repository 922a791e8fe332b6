"""Write an N-times copy of a table folder (for scaling runs of bench.py).

Usage: python tools/scale_copy.py SRC_DIR DST_DIR [N] [FILES_PER_TABLE]

Copy i shifts every entity key by i * (max key + 1), so keys stay unique and
joins keep their one-to-one / one-to-many shape; non-key columns are copied as
they are. Each table is written by Spark as FILES_PER_TABLE parquet files
(default 32), so scans run in parallel without any spreading.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from kestrel.session import local_session  # noqa: E402

# Key columns shifted per copy; a key shared by two tables uses the same shift.
KEYS = {
    "orders": {"o_orderkey": "order", "o_custkey": "cust"},
    "lineitem": {"l_orderkey": "order"},
    "customer": {"c_custkey": "cust"},
    "documents": {"doc_id": "doc"},
    "labels": {"doc_id": "doc"},
    "events": {"event_id": "event"},
    "embeddings": {"vec_id": "vec"},
    "pages": {"page_id": "page"},
}
KEY_SOURCE = {"order": ("orders", "o_orderkey"), "cust": ("customer", "c_custkey"), "doc": ("documents", "doc_id"),
              "event": ("events", "event_id"), "vec": ("embeddings", "vec_id"), "page": ("pages", "page_id")}


def main() -> None:
    src, dst = sys.argv[1].rstrip("/"), sys.argv[2].rstrip("/")
    n = int(sys.argv[3]) if len(sys.argv) > 3 else 10
    files = int(sys.argv[4]) if len(sys.argv) > 4 else 32
    spark = local_session(8, 32, app="kestrel-scale-copy")
    spans = {}
    for kind, (t, c) in KEY_SOURCE.items():
        spans[kind] = spark.read.parquet(f"{src}/{t}.parquet").agg(F.max(c)).first()[0] + 1
    tables = [f[: -len(".parquet")] for f in os.listdir(src) if f.endswith(".parquet")]
    for t in sorted(tables):
        df = spark.read.parquet(f"{src}/{t}.parquet")
        keys = KEYS.get(t, {})
        if keys:
            df = df.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))  # n copies of each row
            for col, kind in keys.items():
                df = df.withColumn(col, (F.col(col) + F.col("_copy") * F.lit(spans[kind])).cast(df.schema[col].dataType))
            df = df.drop("_copy")
        df.repartition(files if keys else 1).write.mode("overwrite").parquet(f"{dst}/{t}.parquet")
        print(t, spark.read.parquet(f"{dst}/{t}.parquet").count())
    spark.stop()


if __name__ == "__main__":
    main()
