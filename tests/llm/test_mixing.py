from collections import Counter

import numpy as np
import pytest

from kestrel.llm import mixing
from kestrel.llm.common import staged


def test_targets_refill():
    assert mixing.fill_targets([], [], 0, 3) == []
    assert mixing.fill_targets([0, 10], [1, 1], 10, 3) == [0.0, 10.0]
    t = mixing.fill_targets([10, 100, 1000], [3, 2, 1], 1110, 3)
    assert t[0] == 30 and t[1] == 300 and t[2] == pytest.approx(780)
    for seed in range(30):
        rng = np.random.default_rng(seed)
        s, w = rng.integers(0, 1000, 6).tolist(), rng.integers(1, 4, 6).astype(float).tolist()
        t = mixing.fill_targets(s, w, sum(s), 3)
        assert sum(t) == pytest.approx(sum(s)) and all(a <= 3 * b + 1e-6 for a, b in zip(t, s))


def test_tree_splits_exact_quotas():
    quotas = [0, 1, 7, 400, 12345]
    tree = mixing.SplitTree(quotas, 13, 5)
    source = np.repeat(np.arange(5), quotas)
    copy = np.concatenate([np.arange(q) for q in quotas])
    leaf = tree.leaves(source, copy)
    assert (leaf >= 0).all() and (leaf < 13).all()
    sizes = np.bincount(leaf, minlength=13)
    assert sizes.max() - sizes.min() <= 4  # floors along the tree
    hot = np.bincount(leaf[source == 4], minlength=13)
    assert abs(hot / sizes - quotas[4] / sum(quotas)).max() < 0.03
    # any part of the copies, in any order, gets the same leaves
    pick = np.random.default_rng(0).permutation(len(copy))[:500]
    assert (mixing.SplitTree(quotas, 13, 5).leaves(source[pick], copy[pick]) == leaf[pick]).all()


def test_split_has_the_hypergeometric_mean():
    left = [mixing.SplitTree([30, 70], 2, s).left(0, 2, np.array([30, 70])) for s in range(400)]
    assert all(x.sum() == 50 for x in left)
    a = np.array([x[0] for x in left])
    assert abs(a.mean() - 15) < 0.5 and abs(a.var() - 50 * 0.3 * 0.7 * 50 / 99) < 1.2


def test_permute_is_a_permutation():
    for n in (1, 2, 3, 17, 1000):
        x = mixing.permute(np.arange(n), np.full(n, n), np.full(n, 9))
        assert sorted(x.tolist()) == list(range(n))


def taken(rows):
    out = Counter()
    for r in rows:
        out[r["source"]] += r["size"] * len(r["copies"])
    return out


@pytest.mark.parametrize("name", ["documents", "odd", "none"])
def test_plan_near_target(request, name):
    df = request.getfixturevalue(name).select("doc_id", "source", "text")
    sized = staged(mixing.word_counts(df, "text", "size"), "t")
    rows = mixing.plan(sized, shards=5, block_size=500, slice_rows=16).collect()
    assert len(rows) == df.count()
    got = taken(rows)
    for r in rows:
        assert len(r["copies"]) <= 3 and all(0 <= s < 5 for s in r["copies"])
        assert got[r["source"]] <= r["target"] + 1e-6
    smallest = {}
    for r in rows:
        if r["size"]:
            smallest[r["source"]] = max(smallest.get(r["source"], 0), r["size"])
    for r in rows:
        assert r["target"] - got[r["source"]] <= smallest.get(r["source"], 0)
    again = mixing.plan(staged(sized.repartition(7), "t"), shards=5, block_size=500, slice_rows=16).collect()
    key = lambda r: (repr(r["doc_id"]), repr(r["source"]), r["size"], tuple(r["copies"]))
    assert sorted(map(key, rows)) == sorted(map(key, again))


@pytest.mark.parametrize("name", ["documents", "odd", "none"])
def test_mix_returns_rows(request, name):
    df = request.getfixturevalue(name)
    out = mixing.mix(df, shards=4)
    assert out.columns[: len(df.columns)] == df.columns
    rows = out.collect()
    assert {repr(tuple(r)[: len(df.columns)]) for r in rows} <= {repr(tuple(r)) for r in df.collect()}


def test_weights_cycle_by_code_point_null_last():
    assert mixing.cycle_weights(["b", None, "a", "Z", "é"]) == {"Z": 1, "a": 2, "b": 3, "é": 1, None: 2}


def test_shards_are_written_in_shuffled_order(spark, documents, tmp_path):
    mixed = mixing.mix(documents, shards=3)
    mixing.write_shards(mixed, f"{tmp_path}/mix")
    for shard in range(3):
        want = [r["doc_id"] for r in mixed.where(f"mix_shard = {shard}").orderBy("mix_order").collect()]
        files = sorted((tmp_path / "mix" / f"mix_shard={shard}").glob("*.parquet"))
        got = [r["doc_id"] for f in files for r in spark.read.parquet(str(f)).collect()]
        assert sorted(got) == sorted(want) and got == want and got != sorted(got)


def test_equal_rows_are_spread_and_drawn_alike(spark):
    rows = [(None, "hot", 3)] * 20_000 + [(i, "b", 5) for i in range(200)]
    sized = staged(spark.createDataFrame(rows, "doc_id long, source string, size long").repartition(6), "t")
    numbered = mixing._numbered(sized, "m_repeat")
    assert numbered.count() == len(rows)
    assert numbered.where("source = 'hot'").selectExpr("count(distinct m_repeat) n", "max(m_repeat) top").first() == (20_000, 19_999)
    out = mixing.plan(sized, block_size=1000, slice_rows=500, shards=4)
    got = taken(out.collect())
    target = {r["source"]: r["target"] for r in out.select("source", "target").distinct().collect()}
    assert all(0 <= target[s] - got[s] < 5 for s in target)
    # equal rows have keys, hence slices, of their own
    key = mixing.F.xxhash64(*sized.columns, mixing.F.lit(42), mixing.F.col("m_repeat"))
    assert numbered.select(key.alias("k")).distinct().count() == len(rows)


def test_too_many_block_copies_are_refused(spark):
    sized = staged(spark.createDataFrame([(1, "a", 2_000_000_000)], "doc_id long, source string, size long"), "t")
    with pytest.raises(ValueError, match="block_size"):
        mixing.plan(sized, block_size=1)
