"""Plan properties of the registered queries: pushdown, pruning, shuffles, no Python."""

from __future__ import annotations

import re

import pytest

from kestrel.plans import QUERIES

from .conftest import SF_SMALL, plan_text


def _plan(spark, name):
    return plan_text(QUERIES[name](spark, SF_SMALL))


def test_enrich_pushes_filter_and_prunes_columns(spark):
    plan = _plan(spark, "left_outer_enrich")
    assert "IsNotNull(l_orderkey)" in plan
    assert "l_linenumber" not in plan
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert "l_orderkey:bigint,l_quantity:double,l_shipdate:timestamp_ntz" in schemas
    assert all("l_comment" not in s and "l_extendedprice" not in s for s in schemas)


def test_index_counts_one_shuffle_and_inset(spark):
    plan = _plan(spark, "index_counts")
    assert plan.count("Exchange hashpartitioning") == 1
    assert "INSET" in plan and "partial_count" in plan
    assert "BroadcastHashJoin" not in plan  # the stop-word list is a filter, not a join


def test_top_k_is_take_ordered(spark):
    for name in ("graph_top_routes", "graph_busiest", "graph_most_out"):
        plan = _plan(spark, name)
        assert "TakeOrderedAndProject" in plan, name
        assert "rangepartitioning" not in plan, name


@pytest.mark.parametrize("name", ["enrich_with_counts", "index_counts", "index_postings", "graph_triplets",
                                  "rating_stats", "nb_predict", "crawl_normalize", "parse_ratings"])
def test_no_python_in_plans(spark, name):
    plan = _plan(spark, name)
    for node in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "FlatMapGroupsInPandas", "MapInPandas"):
        assert node not in plan, (name, node)


def test_hot_right_key_is_split_only_in_the_split_form(spark):
    # One order key holds ~40% of the right side. AQE splits it in the inner join of the
    # split form, but cannot split it in a plain left outer join (right side of an outer join).
    from pyspark.sql import functions as F

    from kestrel.operators import relational as rel

    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4KB",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        d = "/root/testdata/sf0.01"
        li = spark.read.parquet(f"{d}/lineitem.parquet").repartition(8)  # several map tasks
        right = li.select(F.when(F.col("l_linenumber") <= 2, F.lit(7)).otherwise(F.col("l_orderkey")).alias("rk"),
                          F.col("l_quantity").alias("q"))
        left = spark.read.parquet(f"{d}/orders.parquet").select(F.col("o_orderkey").alias("k"))
        split = rel.enrich(left, right, [("k", "rk")], skew_safe=True)
        plain = rel.enrich(left, right, [("k", "rk")], skew_safe=False)
        n_split, n_plain = len(split.collect()), len(plain.collect())
        assert n_split == n_plain
        assert "skew=true" in plan_text(split)
        assert "skew=true" not in plan_text(plain)
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
