import pytest
from pyspark.sql import functions as F

from kestrel.llm import sharding


def place(df, shards=8, **options):
    return sharding.shard(df, shards, key=F.col("text"), size=F.coalesce(F.octet_length("text"), F.lit(0)) + 16, **options)


def check(rows, shards):
    by = {}
    for r in rows:
        by.setdefault(r["shard"], []).append(r["slot"])
    assert all(0 <= s < shards for s in by)
    assert all(sorted(v) == list(range(len(v))) for v in by.values())


@pytest.mark.parametrize("name", ["documents", "odd", "none"])
def test_whole_gapless_and_same_columns(request, name):
    df = request.getfixturevalue(name)
    out = place(df)
    assert out.columns == [*df.columns, *(["_shard", "_slot"] if "shard" in df.columns else ["shard", "slot"])]
    rows = out.collect()
    assert sorted(map(repr, (tuple(r)[:-2] for r in rows))) == sorted(map(repr, map(tuple, df.collect())))
    check([dict(zip(("shard", "slot"), tuple(r)[-2:])) for r in rows], 8)


def test_bytes_near_equal_groups_whole_and_reruns_agree(spark):
    df = spark.range(40_000).select(
        F.col("id").alias("doc_id"),
        # a third of all rows is one text, others come in pairs
        F.when(F.col("id") % 3 == 0, F.lit("hot " * 20)).otherwise(F.concat(F.lit("text "), F.floor(F.col("id") / 5).cast("string"), F.repeat(F.lit("x"), (F.col("id") % 7).cast("int")))).alias("text"),
    )
    rows = place(df).collect()
    check(rows, 8)
    size, home = {}, {}
    for r in rows:
        size[r["shard"]] = size.get(r["shard"], 0) + len(r["text"]) + 16
        home.setdefault(r["text"], set()).add(r["shard"])
    mean = sum(size.values()) / 8
    assert len(size) == 8 and max(abs(v - mean) for v in size.values()) < 0.06 * mean
    assert all(len(v) == 1 for t, v in home.items() if not t.startswith("hot"))
    assert len(home["hot " * 20]) > 1
    again = place(df.repartition(5)).collect()
    assert {(r["doc_id"], r["shard"], r["slot"]) for r in rows} == {(r["doc_id"], r["shard"], r["slot"]) for r in again}


def test_range_of_is_a_binary_search(spark):
    low = sharding.LOWEST
    bounds = [(-5, 0, low), (1, low, low), (1, 7, low), (1, 7, 4), (1, 9, low), (8, 3, low)]
    values = [(k, t, a) for k in (-9, -5, 0, 1, 2, 8, 9) for t in (low, -1, 0, 3, 7, 8, 9, 10) for a in (low, 3, 4, 5)]
    df = spark.createDataFrame(values, "k long, t long, a long")
    for r in df.select("k", "t", "a", sharding.range_of(F.col("k"), F.col("t"), F.col("a"), bounds).alias("n")).collect():
        assert r["n"] == sum(b <= (r["k"], r["t"], r["a"]) for b in bounds)


def table(spark, rows):
    """A written table, as the operator wants."""
    from kestrel.llm.common import staged

    return staged(spark.createDataFrame(rows, "doc_id long, text string").repartition(6), "t")


def test_equal_rows_without_ids_are_spread(spark):
    df = table(spark, [(None, "same text")] * 40_000 + [(i, f"other {i}") for i in range(4_000)])
    rows = place(df).collect()
    check(rows, 8)
    n = [0] * 8
    for r in rows:
        n[r["shard"]] += 1
    assert max(n) - min(n) < 0.06 * len(rows) / 8


def test_groups_smaller_than_a_shard_stay_whole(spark):
    # groups of 1 to 700 equal texts; a shard's equal part is about 1,000 rows
    sizes = [700, 500, 400, 400, 300, 300, 300, 150, 100, 90, 80, 70, 60, 50, 40, 30] + [3] * 1500
    rows = [(i * 10_000 + j, f"group {i:04d}") for i, n in enumerate(sizes) for j in range(n)]
    out = place(table(spark, rows)).collect()
    check(out, 8)
    home, held = {}, [0] * 8
    for r in out:
        home.setdefault(r["text"], set()).add(r["shard"])
        held[r["shard"]] += len(r["text"]) + 16
    assert all(len(s) == 1 for s in home.values())
    mean = sum(held) / 8
    assert max(abs(x - mean) for x in held) < 0.08 * mean  # one fine range or so


def test_placement_equals_a_plain_version(spark):
    rows = [(i, f"text {i % 700 if i % 4 else 'hot'}" + "x" * (i % 13)) for i in range(6_000)] + [(None, "none")] * 300
    df = table(spark, rows)
    keys = df.select("doc_id", "text", F.xxhash64("text").alias("key"), F.xxhash64("doc_id").alias("tie"), F.xxhash64(F.monotonically_increasing_id()).alias("spread"), (F.octet_length("text") + 16).cast("long").alias("size"))
    plain = sorted((r.key, r.tie, r.spread, r.size, r.doc_id, r.text) for r in keys.collect())
    bounds, hot = sharding.splitters(keys, 5 * sharding.FINENESS, 42)
    total, shards = sum(r[3] for r in plain), 5
    group = {}
    for r in plain:
        group[r[0]] = group.get(r[0], 0) + r[3]
    load, slots, want = [0] * shards, [0] * shards, []
    whole = sorted(((group[k], k) for k in hot if group[k] * shards <= total), reverse=True)
    home = {}
    for size, k in whole:
        home[k] = min(range(shards), key=lambda s: (load[s], s))
        load[home[k]] += size
    for size, k in whole:  # their rows come first, in the order in which the groups were placed
        for r in (x for x in plain if x[0] == k):
            want.append((r[4] or -1, r[5], home[k], slots[home[k]]))
            slots[home[k]] += 1
    rest = [r for r in plain if r[0] not in home]
    room = [max(0.0, total / shards - x) for x in load]
    ends = [sum(room[: i + 1]) * sum(r[3] for r in rest) / sum(room) for i in range(shards - 1)]
    units, at = {}, 0
    for r in rest:  # a group, or the part of a larger one that lies in one range
        unit = (sum(b <= r[:3] for b in bounds), r[0])
        units.setdefault(unit, [at, at])[1] = at + r[3]
        at += r[3]
    for r in rest:
        lo, hi = units[sum(b <= r[:3] for b in bounds), r[0]]
        s = sum(e <= (lo + hi) / 2 for e in ends)
        want.append((r[4] or -1, r[5], s, slots[s]))
        slots[s] += 1
    got = [(r["doc_id"] or -1, r["text"], r["shard"], r["slot"]) for r in place(df, shards).collect()]
    assert {w[:3] for w in want} == {g[:3] for g in got} and hot and whole
    exact = sum(a == b for a, b in zip(sorted(got), sorted(want)))
    assert exact == len(want)


def test_native_plan(documents):
    from ..conftest import plan_text

    text = plan_text(place(documents))
    assert "Python" not in text and "Arrow" not in text and "ExistingRDD" not in text
