"""Write PLANS.md: the physical plan tree of each headline query.

Two settings per query (the ``explain()`` tree, details inline): the session
defaults (small tables may be broadcast after their size check) and
``autoBroadcastJoinThreshold=-1``, which shows the plan shape used when both
sides are large (shuffle joins, AQE skew splitting).

Usage: python tools/explain_plans.py [SF_DIR]
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from kestrel.functions import JVM_TRIM_CHARS  # noqa: E402
from kestrel.plans import QUERIES  # noqa: E402
from kestrel.session import local_session  # noqa: E402

HEADLINE = [
    "enrich_with_counts", "index_counts", "index_postings", "graph_top_routes", "graph_least_in",
    "graph_triplets", "rating_stats", "nb_predict", "stream_count_per_batch",
]


NOTES = {
    "enrich_with_counts": "A plain left outer join, both sides shuffled on the key (a hot right key: skew_safe=True). "
                          "The per-year counts are a small aggregate that adaptive execution broadcasts at run time; "
                          "the range sort ends with the order key so hot (y, q) pairs split.",
    "index_counts": "One Generate (explode of the split) feeding an InSet stop-word filter and a partial aggregate: "
                    "one shuffle, keyed by (word, doc).",
    "index_postings": "The counts are range-partitioned on (word, block) before grouping: that partitioning already "
                      "clusters each group, so the aggregate adds no exchange and a local sort gives the global "
                      "order (one shuffle after the counts). A group holds at most block_size entries.",
    "graph_top_routes": "Partial aggregate of trips into edges, then TakeOrderedAndProject: no global sort.",
    "graph_least_in": "Vertex semi-join below the degree aggregate.",
    "graph_triplets": "Two semi-joins of edges with vertices; adaptive execution picks the join by the sizes it shuffled.",
    "rating_stats": "Exact distinct users and items in one pass: Expand + partial aggregate.",
    "nb_predict": "The model table (its written size known) is broadcast, so words join it map-side and the sums per "
                  "document are the only shuffle of words; without broadcasts a sort-merge join on the word. The "
                  "scores are joined back to the rows by a 128-bit hash of their content.",
    "stream_count_per_batch": "Reads the landed per-batch counts back and sums them (the stream itself ran per batch).",
}


def _shape(plan: str) -> str:
    return re.sub(r"(#\d+L?|plan_id=\d+)", "", plan)


def tree(df, width: int = 230) -> str:
    """The physical plan with each node's details inline (``explain()``), lines cut to ``width``."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="simple")
    text = buf.getvalue()
    text = text.replace(JVM_TRIM_CHARS, "<U+0000..U+0020>")
    text = re.sub(r"INSET [^)\]\n]{120,}", "INSET (…stop words…)", text)
    text = re.sub(r"file:/\S+/(\w+\.parquet)", r"\1", text)
    lines = [ln if len(ln) <= width else ln[: width - 1] + "…" for ln in text.strip().splitlines()]
    return "\n".join(lines)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(8, 16, app="kestrel-plans")
    out = ["# Physical plans", "",
           f"Generated by `python tools/explain_plans.py` on `{sf_dir}` (local[8], 16 shuffle partitions, AQE on).",
           "Each query shows the plan under default settings, then with broadcasting switched off, which is the",
           "shape used when every side is large. Plans are taken before execution (`isFinalPlan=false`), so AQE",
           "may still coalesce partitions, split skewed ones or switch a join at run time.", ""]
    for name in HEADLINE:
        default = tree(QUERIES[name](spark, sf_dir))
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            large = tree(QUERIES[name](spark, sf_dir))
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        out += [f"## `{name}`", "", NOTES.get(name, ""), "", "Default:", "", "```", default, "```", ""]
        if _shape(large) != _shape(default):
            out += ["Without broadcasts (large inputs):", "", "```", large, "```", ""]
    spark.stop()
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md")
    with open(path, "w", encoding="utf-8") as fh:
        fh.write("\n".join(out) + "\n")
    print(path)


if __name__ == "__main__":
    main()
