"""Sketches, grouping sets and keyed ALS: hot groups, nulls, repeats; a plain numpy ALS."""

from __future__ import annotations

import math
import random
from collections import defaultdict
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from kestrel.operators import cubes, sketches
from kestrel.operators import recommend as rec

from .conftest import rows


def test_sketches_merge_to_the_sketch_of_all_rows(spark):
    df = spark.range(0, 40_000, 1, 8).selectExpr("date_add(date'2024-01-01', int(id % 9)) AS day", "if(id % 3 = 0, 'hot', string(id % 7)) AS k", "id * 7919 % 11003 AS u", "double(id % 1000) AS v")
    daily = sketches.build(df, ["day", "k"], distinct=["u"], values=["v"])
    got = sketches.estimates(sketches.merge(daily, ["k"]), {"p50": 0.5, "p95": 0.95})
    exact = {r.k: r for r in df.groupBy("k").agg(F.count("*").alias("n"), F.count_distinct("u").alias("u"), F.sort_array(F.collect_list("v")).alias("v")).collect()}
    for r in got.collect():
        e = exact[r.k]
        assert r.n == e.n and abs(r.u_distinct - e.u) <= 0.05 * e.u
        for est, q in ((r.v_p50, 0.5), (r.v_p95, 0.95)):
            below, upto = sum(x < est for x in e.v) / e.n, sum(x <= est for x in e.v) / e.n
            assert below <= q + 0.03 and upto >= q - 0.03
    assert got.count() == len(exact)


def test_sketches_of_nulls_and_stored_days_are_replaced(spark, tmp_dir):
    df = spark.createDataFrame([("2024-01-01", None, None), ("2024-01-01", None, None), ("2024-01-02", "a", 1.0), ("2024-01-02", "a", None)], "day string, u string, v double")
    df = df.withColumn("day", F.to_date("day"))
    built = sketches.build(df, ["day"], distinct=["u"], values=["v"])
    assert rows(sketches.estimates(built, {"max": 1.0}).select("n", "u_distinct", "v_max")) == [(2, 0, None), (2, 1, 1.0)]
    for part in (built, built.where("day = '2024-01-02'")):
        sketches.store(part, f"{tmp_dir}/s", "day")
    back = sketches.load(spark, f"{tmp_dir}/s")
    assert rows(sketches.estimates(sketches.merge(back, [])).select("n", "u_distinct")) == [(4, 1)]
    roll = sketches.estimates(sketches.rolling(back, "day", 2))
    assert rows(roll.select(F.col("day").cast("string"), "n")) == [("2024-01-01", 2), ("2024-01-02", 4)]


AGGS = {"n": ("count", "*"), "m": ("count", "v"), "total": ("sum", "v"), "low": ("min", "v"), "top": ("max", "v"), "mean": ("avg", "v")}


def brute_sets(data, sets):
    out = []
    for s in sets:
        groups = defaultdict(list)
        for a, b, v in data:
            groups[a if "a" in s else None, b if "b" in s else None].append(v)
        if not s and not data:
            continue
        for (a, b), vs in groups.items():
            known = [v for v in vs if v is not None]
            stats = (sum(known), min(known), max(known), sum(known) / len(known)) if known else (None,) * 4
            out.append((a, b, ("a" not in s) * 2 + ("b" not in s), len(vs), len(known), *stats))
    return out


def test_grouping_sets_rollup_and_cube(spark):
    rng = random.Random(2)
    data = [(rng.choice(["hot"] * 5 + ["x", None]), rng.choice([1, 2, None]), rng.choice([None, 1, 2, 3])) for _ in range(500)]
    df = spark.createDataFrame(data, "a string, b int, v long").repartition(4)
    sets = [("a", "b"), ("b",), (), ("b",)]
    assert rows(cubes.grouping_sets(df, ["a", "b"], sets, AGGS)) == brute_sets(data, sets)
    assert rows(cubes.rollup(df, ["a", "b"], AGGS)) == brute_sets(data, [("a", "b"), ("a",), ()])
    every = [s for n in range(3) for s in combinations(("a", "b"), n)]
    assert rows(cubes.cube(df, ["a", "b"], AGGS)) == brute_sets(data, every)
    assert cubes.cube(df.where("false"), ["a", "b"], AGGS).where("grouping_id < 3").count() == 0
    with pytest.raises(ValueError):
        cubes.grouping_sets(df, ["a"], [("b",)], AGGS)
    with pytest.raises(ValueError):
        cubes.cube(df, ["a"], {"x": ("median", "v")})


def test_grouping_sets_copy_groups_not_rows(spark):
    df = spark.range(0, 10_000, 1, 4).selectExpr("id % 3 AS a", "id % 2 AS b", "id AS v")
    plan = cubes.cube(df, ["a", "b"], {"s": ("sum", "v")})._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 2 and plan.index("Expand") < plan.rindex("Aggregate")  # printed from the top


def test_dictionary_is_dense(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("b",), ("c" * 50,)], "k string").repartition(3)
    assert sorted(r.id for r in rec.dictionary(df, "k").collect()) == [0, 1, 2]
    assert rec.dictionary(df.where("false"), "k").count() == 0


def test_keyed_als_equals_als_on_its_ids_and_handles_odd_keys(spark):
    rng = random.Random(4)
    data = [(f"u{rng.randrange(12)}", 5_000_000_000 + rng.randrange(9), float(rng.randrange(1, 6))) for _ in range(90)] + [("hot", 5_000_000_000 + i % 9, 3.0) for i in range(60)]
    df = spark.createDataFrame([*data, (None, 1, 2.0), ("u1", None, 2.0), ("u1", 1, None)], "userId string, movieId long, rating double")
    model = rec.fit_keyed(df, rank=3, max_iter=4)
    got = rec.predict_keyed(model, df.union(spark.createDataFrame([("new", 5_000_000_000, 1.0)], df.schema)))
    assert got.columns == ["userId", "movieId", "rating", "prediction"] and got.count() == len(data) + 4
    users, items = ({r.key: np.array(r.features) for r in f.collect()} for f in rec.factors(model))
    assert len(users) == len({d[0] for d in data}) and len(items) == len({d[1] for d in data})
    for r in got.collect():
        if r.userId in users and r.movieId in items:
            assert r.prediction == pytest.approx(float(users[r.userId] @ items[r.movieId]), abs=1e-5)
        else:
            assert math.isnan(r.prediction)
    assert rec.predict_keyed(model, df, cold_start="drop").count() == len(data)


def test_als_is_the_fixed_point_of_a_plain_als(spark):
    """Many iterations on a small table: each side solves its ridge problem given the other (regularised by counts)."""
    rng = np.random.default_rng(3)
    u, v = rng.normal(size=(8, 2)), rng.normal(size=(6, 2))
    data = [(i, j, float(u[i] @ v[j])) for i in range(8) for j in range(6) if (i * 7 + j * 3) % 5]
    df = spark.createDataFrame(data, "userId int, movieId int, rating double")
    reg = 0.05
    model = rec.fit(df, rank=2, max_iter=60, reg_param=reg)
    users, items = ({r.id: np.array(r.features, float) for r in f.collect()} for f in (model.userFactors, model.itemFactors))

    def solve(own, other):
        n = len(own)
        a = reg * n * np.eye(2) + sum(np.outer(other[j], other[j]) for j, _ in own)
        return np.linalg.solve(a, sum(r * other[j] for j, r in own))

    def loss(p, q):
        fit = sum((r - p[i] @ q[j]) ** 2 for i, j, r in data)
        return fit + reg * sum(p[i] @ p[i] + q[j] @ q[j] for i, j, _ in data)

    for i in users:
        assert solve([(j, r) for k, j, r in data if k == i], items) == pytest.approx(users[i], abs=2e-3)
    best = np.inf
    for seed in range(5):  # a plain ALS from other starts finds nothing better
        g = np.random.default_rng(seed)
        p, q = ({k: g.normal(size=2) for k in f} for f in (users, items))
        for _ in range(200):
            p = {i: solve([(j, r) for k, j, r in data if k == i], q) for i in users}
            q = {j: solve([(i, r) for i, k, r in data if k == j], p) for j in items}
        best = min(best, loss(p, q))
    assert loss(users, items) <= best * 1.02


def test_keyed_predictions_deal_rows_by_their_keys_only(spark):
    from .conftest import plan_text

    df = spark.createDataFrame([(f"u{i % 9}", i % 5, float(i % 4)) for i in range(60)], "userId string, movieId long, rating double")
    model = rec.fit_keyed(df, rank=2, max_iter=1)
    plan = plan_text(rec.predict_keyed(model, df), "simple")
    assert "UDF" not in plan and plan.count("Join") == 4  # two for the rows, two that give the factors their keys
    ids = rec.predict(model.model, rec._with_ids(df, model.users, model.items, "userId", "movieId"))
    assert sorted(r.prediction for r in ids.collect()) == sorted(r.prediction for r in rec.predict_keyed(model, df).collect())
