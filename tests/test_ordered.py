"""Joins and windows along an order against brute force: hot keys, nulls, ties, repeats, long spans."""

from __future__ import annotations

import random
import re
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from kestrel.operators import ordered

from .conftest import plan_text, rows


def keyed(seed, n, span=2000):
    rng = random.Random(seed)
    return [(i, rng.choice(["hot"] * 6 + ["a", "b", None]), None if rng.random() < 0.05 else rng.randrange(-span, span), rng.randrange(50)) for i in range(n)]


@pytest.mark.parametrize(("strict", "tolerance", "bucket"), [(False, None, 100), (True, None, 7), (False, 30, 5000), (True, 3, 1)])
def test_asof_join(spark, strict, tolerance, bucket):
    left, right = keyed(1, 500), keyed(2, 300)
    right += right[:40]  # repeated rows
    a = spark.createDataFrame(left, "id long, k string, t long, v long").repartition(4)
    b = spark.createDataFrame(right, "rid long, k string, t long, price long").repartition(3)
    got = ordered.asof_join(a, b, ["k"], "t", "t", ["price", "rid"], bucket=bucket, strict=strict, tolerance=tolerance)
    assert got.columns == ["id", "k", "t", "v", "price", "rid"]
    want = []
    for i, k, t, v in left:
        fit = [(u, p, r) for r, m, u, p in right if None not in (k, t, u) and m == k and (u < t or (u == t and not strict))]
        best = max(fit, default=None)
        if best and tolerance is not None and t - best[0] > tolerance:
            best = None
        want.append((i, k, t, v, best and best[1], best and best[2]))
    assert rows(got) == want


def test_asof_join_of_dates_repeated_left_rows_and_empty_sides(spark):
    day = datetime(2024, 1, 31).date()
    a = spark.createDataFrame([(1, day), (1, day), (2, None)], "k long, d date")
    b = spark.createDataFrame([(1, day - timedelta(days=400), 5.0)], "k long, d date, p double")
    got = ordered.asof_join(a, b, ["k"], "d", "d", ["p"], bucket=ordered.DAY)
    assert rows(got) == [(1, day, 5.0), (1, day, 5.0), (2, None, None)]
    assert rows(ordered.asof_join(a, b.where("false"), ["k"], "d", "d", ["p"], bucket=ordered.DAY), "p") == [(None,)] * 3
    assert ordered.asof_join(a.where("false"), b, ["k"], "d", "d", ["p"], bucket=ordered.DAY).count() == 0
    with pytest.raises(TypeError):
        ordered.asof_join(b, b, ["k"], "p", "p", ["p"], bucket=1)


def test_asof_hot_key_is_many_groups(spark):
    a = spark.range(0, 4000, 1, 4).selectExpr("id", "'hot' AS k", "id AS t")
    plan = plan_text(ordered.asof_join(a, a.selectExpr("k", "t", "id AS x"), ["k"], "t", "t", ["x"], bucket=100))
    # events are dealt by key and bucket; only the row per bucket is dealt by key alone
    assert re.search(r"hashpartitioning\(key#\d+, bucket#", plan)


@pytest.mark.parametrize("levels", [ordered.LEVELS, (1, 4), (1,)])
def test_overlap_join(spark, levels):
    rng = random.Random(7)

    def spans(n):
        out = []
        for i in range(n):
            lo = rng.choice([rng.randrange(-300, 300), 5, 5, 5])  # many start together
            hi = lo + rng.choice([0, 1, 1, 3, 10, 64, 500, -4])
            out.append((i, rng.choice(["hot", "hot", "a", None]), None if rng.random() < 0.05 else lo, None if rng.random() < 0.05 else hi))
        return out

    left, right = spans(150), spans(150)
    a, b = spark.createDataFrame(left, "i long, k string, lo long, hi long"), spark.createDataFrame(right, "j long, m string, f long, t long")

    def fits(x, y):
        return None not in (x[2], x[3], y[2], y[3]) and x[2] < x[3] and y[2] < y[3] and x[2] < y[3] and y[2] < x[3]

    got = ordered.overlap_join(a, b, ("lo", "hi"), ("f", "t"), smallest=2, levels=levels)
    assert Counter((r.i, r.j) for r in got.collect()) == Counter((x[0], y[0]) for x in left for y in right if fits(x, y))
    assert "NestedLoop" not in plan_text(got) and "Cartesian" not in plan_text(got)
    keyed_ = ordered.overlap_join(a, b, ("lo", "hi"), ("f", "t"), smallest=2, on=[("k", "m")], levels=levels)
    assert Counter((r.i, r.j) for r in keyed_.collect()) == Counter((x[0], y[0]) for x in left for y in right if fits(x, y) and x[1] is not None and x[1] == y[1])


def test_running_numbers_and_sums(spark):
    data = keyed(3, 700) + [(1, "hot", 5, 1)] * 60
    df = spark.createDataFrame(data, "id long, k string, t long, v long").repartition(5)
    got = ordered.running(df, [("t", "desc"), "v"], keys=["k"], sums={"total": F.col("v"), "seen": F.col("t")})
    want, at = [], {}
    for i, k, t, v in sorted(data, key=lambda r: (r[1] or "", -(r[2] if r[2] is not None else -(10**6)), r[3])):
        n, total, seen = at.get(k, (0, 0, None))
        at[k] = (n + 1, total + v, seen if t is None else (seen or 0) + t)
        want.append((k, t, v, *at[k]))
    assert rows(got.select("k", "t", "v", "row_number", "total", "seen")) == want
    assert Counter(got.groupBy("id", "k", "t", "v").count().collect()) == Counter(df.groupBy("id", "k", "t", "v").count().collect())


def test_running_over_one_order_with_one_value(spark):
    # all rows tie: still spread over range partitions, each row one number
    df = spark.range(0, 20000, 1, 8).selectExpr("1 AS x")
    got = ordered.running(df, ["x"], sums={"s": F.col("x")})
    assert got.agg(F.min("row_number"), F.max("row_number"), F.count_distinct("row_number"), F.max("s")).first() == (1, 20000, 20000, 20000)
    assert ordered.running(df.where("false"), ["x"]).count() == 0


def test_ranks(spark):
    data = keyed(4, 600, span=20) + [(0, "hot", 3, 1)] * 200
    df = spark.createDataFrame(data, "id long, k string, t long, v long").repartition(5)
    got = ordered.ranks(df, [("t", "desc")], keys=["k"])
    want = []
    for i, k, t, v in data:
        above = [r[2] for r in data if r[1] == k and r[2] is not None and (t is None or r[2] > t)]
        want.append((i, k, t, v, len(above) + 1, len(set(above)) + 1))
    assert rows(got) == want
    whole = ordered.ranks(df, ["v", "t"]).agg(F.min("rank"), F.max("dense_rank")).first()
    assert whole == (1, len({(r[3], r[2]) for r in data}))


def test_overlap_join_lists_short_spans_only_where_longer_ones_are(spark):
    """Short spans far apart: in wide bins all pairs would be compared, 16 million here."""
    a = spark.range(0, 4000, 1, 4).selectExpr("id AS i", "id * 100 AS lo", "id * 100 + 5 AS hi")
    b = spark.range(0, 4000, 1, 4).selectExpr("id AS j", "id * 100 + 3 AS f", "id * 100 + 9 AS t")
    got = ordered.overlap_join(a, b, ("lo", "hi"), ("f", "t"), smallest=8)
    assert got.where("i = j").count() == got.count() == 4000
    # one list of bins for each side: no row stands in the wider levels, which no span belongs to
    steps = {r["l_place"] for r in _listed_places(got)}
    assert steps == {0}


def _listed_places(df):
    """Places that the join's left input lists its spans at."""
    from pyspark.sql import DataFrame

    left = df._jdf.queryExecution().analyzed()
    while left.nodeName() != "Join":
        left = left.children().head()
    one = df.sparkSession._jvm.org.apache.spark.sql.classic.Dataset.ofRows(df.sparkSession._jsparkSession, left.children().head())
    return DataFrame(one, df.sparkSession).select("l_place").distinct().collect()
