import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from kestrel.llm import simhash
from kestrel.llm.components import components


def brute_print(text, k=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    parts = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or ([" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(pairs, nodes):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("name", ["documents", "odd", "none"])
def test_near_duplicates_equal_brute_force(request, name):
    df = request.getfixturevalue(name)
    rows = simhash.near_duplicates(df, keep=["text"]).collect()
    assert len(rows) == df.count()
    prints = [r["fingerprint"] & (1 << 64) - 1 for r in rows]
    assert prints == [brute_print(r["text"]) for r in rows]
    nodes = range(len(rows))
    comp = brute_components([(i, j) for i in nodes for j in nodes if i < j and (prints[i] ^ prints[j]).bit_count() <= 2], nodes)
    for i in nodes:
        ids = [rows[j]["doc_id"] for j in nodes if comp[j] == comp[i] and rows[j]["doc_id"] is not None]
        assert rows[i]["component_id"] == (min(ids) if ids else None)


@pytest.mark.parametrize("distance", [0, 1, 2, 3])
def test_links_lose_nothing(spark, distance):
    rng = np.random.default_rng(distance)
    base = rng.integers(0, 1 << 63, 300).astype(np.uint64)
    near = base.copy()
    for _ in range(distance + 1):
        near ^= np.uint64(1) << rng.integers(0, 64, len(base)).astype(np.uint64)
    crowd = base[0] ^ np.arange(300, dtype=np.uint64)  # a long list
    prints = np.unique(np.concatenate([base, near, crowd, np.array([0, 1, 3, (1 << 64) - 1], np.uint64)]))
    df = spark.createDataFrame([(int(x),) for x in prints.view(np.int64)], "fp long")
    found = simhash.links(df, "fp", distance).collect()
    values = [int(x) for x in prints]
    place = {v: i for i, v in enumerate(values)}
    pairs = [(place[r["a"] & (1 << 64) - 1], place[r["b"] & (1 << 64) - 1]) for r in found]
    got = brute_components(pairs, range(len(values)))
    close = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= distance
    assert got == brute_components(np.argwhere(close).tolist(), range(len(values)))
    assert all(got[a] == got[b] for a, b in pairs)


def test_position_masks():
    assert len(simhash.position_masks(2)) == 28 and all(m.bit_count() == 48 for m in simhash.position_masks(2))
    assert simhash.shared_bytes(np.array([0, 1, 0x0101, 1 << 63], np.uint64)).tolist() == [8, 7, 6, 7]


def test_components(spark):
    rng = np.random.default_rng(1)
    pairs = [(i, i + 1) for i in range(200, 260)] + [(5, 5), (9, 3), (3, 9), (3, 1)] + [(1000, int(x)) for x in rng.integers(1001, 1500, 300)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    want = brute_components(pairs, {x for p in pairs for x in p})
    assert got == {n: r for n, r in want.items() if n != r}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("name", ["documents", "odd", "none"])
def test_keep_one(request, name):
    df = request.getfixturevalue(name)
    out = simhash.keep_one(df)
    assert out.columns == df.columns
    kept = out.collect()
    prints = {brute_print(r["text"]) for r in df.collect()}
    comp = brute_components([(a, b) for a in prints for b in prints if a < b and (a ^ b).bit_count() <= 2], prints)
    assert sorted(comp[brute_print(r["text"])] for r in kept) == sorted(set(comp.values()))
    ids = {}
    for r in df.where(F.col("doc_id").isNotNull()).collect():
        c = comp[brute_print(r["text"])]
        ids[c] = min(ids.get(c, r["doc_id"]), r["doc_id"])
    assert all(r["doc_id"] == ids.get(comp[brute_print(r["text"])]) for r in kept)


def test_keep_one_tells_components_of_one_id_apart(spark):
    a, b = "one two three four five six", "red green blue white black grey"
    rows = [(5, a), (9, a), (5, b), (7, b)]
    kept = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, kept)) == [(5, a), (5, b)]


def test_keep_one_joins_null_ids(spark):
    prints, n = {}, 0
    base = [f"w{i}" for i in range(60)]
    while True:  # two texts 1 bit apart
        n += 1
        text = " ".join([*base, f"x{n}"])
        p = brute_print(text)
        near = next((prints[p ^ (1 << k)] for k in range(64) if p ^ (1 << k) in prints), None)
        if near:
            break
        prints[p] = text
    rows = [(None, near), (None, text)]
    assert simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).count() == 1


def test_keep_one_of_rows_that_differ_elsewhere(spark):
    """Rows equal in id and text but not in source: the same one stays, however the table is dealt."""
    rows = [(1, "one two three four", s, {"k": s}) for s in ("a", "b", None)] + [(None, "five six seven", s, {}) for s in ("x", "y")] + [(2, "eight nine ten", "z", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, m map<string,string>")
    outs = [sorted(map(repr, simhash.keep_one(df.repartition(n), shingle=3, max_distance=2).collect())) for n in (1, 5)]
    assert outs[0] == outs[1] and len(outs[0]) == 3
