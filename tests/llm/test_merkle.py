"""The Merkle manifest against a plain recursive version."""

import hashlib

import pytest
from pyspark.sql import functions as F

from kestrel.llm import merkle

from ..conftest import plan_text


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def levels(nodes, fanout):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h("".join(out[-1][i : i + fanout])) for i in range(0, len(out[-1]), fanout)])
    return out


def path(tree, i, fanout):
    out = []
    for level in tree[:-1]:
        b = i // fanout * fanout
        out.append(("".join(level[b:i]), "".join(level[i + 1 : b + fanout])))
        i //= fanout
    return out


def brute(rows, fanout=2):
    """(id, lang, leaf, subroot, root, proof) of rows (id, lang)."""
    groups = {}
    for i, lang in rows:
        groups.setdefault(lang, []).append(((i is not None, i or 0), h(field(i) + field(lang)), i))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: levels([x[1] for x in sorted(groups[g], key=lambda x: x[:2])], fanout) for g in names}
    top = levels([trees[g][-1][0] for g in names], fanout)
    return [
        (x[2], g, x[1], trees[g][-1][0], top[-1][0], path(trees[g], i, fanout) + path(top, k, fanout))
        for k, g in enumerate(names)
        for i, x in enumerate(sorted(groups[g], key=lambda x: x[:2]))
    ]


def run(df, **options):
    out = merkle.manifest(df, merkle.leaf(F.col("id"), F.col("lang")), F.col("lang"), [F.col("id")], keep=["id", "lang"], **options)
    return out, sorted(((r.id, r.lang, r.leaf, r.subroot, r.root, [tuple(s) for s in r.proof]) for r in out.collect()), key=repr)


# one hot group, a null group, a group of one row, null and repeated ids
ROWS = [(None if i % 50 == 0 else i * 7 % 211, ["a", "a", "b", None, "c"][min(4, i % 13)]) for i in range(240)] + [(1, "é")]


@pytest.mark.parametrize(("fanout", "digits"), [(2, 3), (3, 2)])
def test_manifest_equals_a_plain_tree(spark, fanout, digits):
    df = spark.createDataFrame(ROWS, "id long, lang string").repartition(5)
    out, got = run(df, fanout=fanout, digits=digits)
    assert got == sorted(brute(ROWS, fanout), key=repr)
    assert out.where(merkle.fold(F.col("leaf"), F.col("proof")) != F.col("root")).count() == 0


def test_default_blocks_single_rows_and_empty_tables(spark):
    df = spark.createDataFrame(ROWS[:9], "id long, lang string")
    assert run(df)[1] == sorted(brute(ROWS[:9]), key=repr)
    one = run(df.limit(0).union(spark.createDataFrame([(5, "x")], df.schema)), digits=2)[1]
    leaf = h("1:51:x")
    assert one == [(5, "x", leaf, leaf, leaf, [])]
    assert run(df.where("false"), digits=2)[1] == []


def test_tampering_shows(spark):
    df = spark.createDataFrame(ROWS, "id long, lang string")
    out, _ = run(df, digits=3)
    bad = merkle.fold(merkle.leaf(F.col("id") + 1, F.col("lang")), F.col("proof"))
    assert out.where("id is not null").where(bad == F.col("root")).count() == 0


def test_odd_rows_and_clashing_names(spark, odd, none):
    clash = odd.selectExpr("*", "'x' AS g", "'y' AS item", "1 AS rank", "'z' AS proof_", "2 AS pos", "3 AS d0")
    leaf = merkle.leaf(*[F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")])
    out = merkle.manifest(clash, leaf, F.col("lang"), [F.col("doc_id")], keep=["doc_id", "g", "item", "rank", "pos", "d0"], digits=2)
    assert out.count() == odd.count() and out.where(merkle.fold(F.col("leaf"), F.col("proof")) == F.col("root")).count() == odd.count()
    assert merkle.manifest(none, leaf, F.col("lang"), [F.col("doc_id")], digits=2).count() == 0


def test_proofs_come_without_joins(spark):
    blocks = merkle._blocks(spark.range(99).selectExpr("'a' AS g", "id AS rank", "99L AS n", "'x' AS hash", "struct(id) AS item"), 2, 3)
    paths = spark.createDataFrame([], f"g string, rank long, proof {merkle.PROOF}, subroot string")
    found = merkle._proofs([blocks], merkle._meet(blocks, paths), 2, 3)
    assert "Join" not in plan_text(found)
