"""The prefix trie against a plain dictionary of all beginnings."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from kestrel.llm import trie
from kestrel.llm.queries import QUERIES

from ..conftest import SF_SMALL

COLUMNS = ("depth", "conv", "parent_conv", "n_convs", "n_children", "n_leaves", "saved", "ends_sha256")


def brute(convs):
    """Rows of COLUMNS for {conv: [(role, text), ...]}."""
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    leaves, saved, out = {}, {}, []
    low = {p: min((c for c in m if c is not None), default=None) for p, m in members.items()}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[q] for q in children[p]) or 1
        saved[p] = (len(members[p]) - 1) * (len(p[-1][1]) if p else 0) + sum(saved[q] for q in children[p])
        ends = ",".join(map(str, sorted(c for c in members[p] if c is not None and len(convs[c]) == len(p))))
        out.append((len(p), low[p], low[p[:-1]] if p else None, len(members[p]), len(children[p]), leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def table(spark, convs):
    rows = [(c, t, role, text) for c, turns in convs.items() for t, (role, text) in enumerate(turns)]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def run(spark, convs, **options):
    encoded, _ = trie.encode(table(spark, convs).repartition(4))
    return sorted((tuple(r) for r in trie.build(encoded, **options).select(*COLUMNS).collect()), key=repr)


@pytest.fixture(scope="module")
def many():
    rng = random.Random(5)
    convs = {}
    for c in range(400):
        n = rng.choice([1, 2, 3, 4, 9])
        convs[c] = [("user" if d % 2 == 0 else "assistant", "word" * rng.choice([1, 1, 1, 2, 3]) + "é" * d) for d in range(n)]
    convs[900] = [("user", "x")] * 60  # long, alone
    convs[901] = convs[900][:40]
    for c in range(1000, 1150):  # a large group of copies
        convs[c] = convs[7]
    return convs


# tiny shards: most nodes near the top are shared by several of them
@pytest.mark.parametrize(("shard_turns", "block_ids"), [(1, 3), (37, 64), (1 << 16, 1 << 16)])
def test_trie_equals_a_plain_one(spark, many, shard_turns, block_ids):
    assert run(spark, many, shard_turns=shard_turns, block_ids=block_ids) == brute(many)


def test_turnless_single_and_empty(spark):
    empty = spark.createDataFrame([(1, []), (5, []), (None, [])], f"conv long, turns {trie.TURNS}")
    digest = hashlib.sha256(b"1,5").hexdigest()
    assert [tuple(r) for r in trie.build(empty).select(*COLUMNS).collect()] == [(0, 1, None, 3, 0, 1, 0, digest)]
    assert trie.build(empty.where("false")).collect() == []
    both = {1: [("u", "abc")], 2: [("u", "abc"), ("a", "d")]}
    assert run(spark, both, shard_turns=1) == brute(both)


def test_odd_rows(spark):
    rows = [(1, None, "user", "b"), (1, 0, None, None), (1, 0, None, None), (None, 0, "user", "b"), (2, 3, "user", "b"), (2, 3, "a", "b")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS conv", "2 AS sha", "3 AS id", "4 AS chars")
    convs = {1: [("user", "b"), ("", ""), ("", "")], None: [("user", "b")], 2: [("a", "b"), ("user", "b")]}
    encoded, dictionary = trie.encode(df)
    assert dictionary.count() == 3
    got = trie.build(encoded)
    assert sorted((tuple(r) for r in got.select(*COLUMNS).collect()), key=repr) == brute(convs)
    assert trie.build(trie.encode(df.where("false"))[0]).count() == 0


def test_ternary_tree_is_balanced():
    tree = trie.TernaryTree()
    for i in trie._median_first(1023):
        tree.insert([i], [1])
    deep, steps = tree.down[0], 0
    while deep >= 0:
        deep, steps = tree.low[deep], steps + 1
    assert steps == 10 and sorted(trie._median_first(77)) == list(range(77))


def test_op13(spark):
    rows = spark.read.parquet(f"{SF_SMALL}/conversations.parquet").collect()
    own = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r.conv_id, r.turn)):
        own[r.conv_id].append((r.role or "", r.text or ""))
    rebuilt = {}
    for c, turns in own.items():
        n = zlib.crc32(str(c).encode()) % 6
        rebuilt[c] = own.get(c - c % 100, [])[:n] + turns[n:]
    names = ("depth", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    got = QUERIES["op13_trie"](spark, SF_SMALL)
    assert sorted((tuple(r) for r in got.select(*names).collect()), key=repr) == brute(rebuilt)
