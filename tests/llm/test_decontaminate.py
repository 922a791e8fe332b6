import re

import pytest
from pyspark.sql import functions as F

from kestrel.llm import decontaminate as dc


def grams(text, k=5):
    words = [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}


def brute(docs, items, threshold=0.8):
    out = set()
    own = [(d, grams(d["text"])) for d in docs]
    for i in items:
        g = grams(i["text"])
        for d, s in own:
            if g and 10 * len(g & s) >= round(10 * threshold) * len(g):
                out.add((d["doc_id"], d["text"], i["item_id"], len(g & s), len(g)))
    return out


def found(docs, items, **options):
    rows = dc.contained_items(docs, items, **options)
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")).distinct().withColumnRenamed("doc_id", "d")
    joined = rows.join(keyed, rows.id.eqNullSafe(keyed.d) & (rows.text_hash == keyed.text_hash))
    return [(r["d"], r["text"], r["item"], r["n_matched"], r["n_shingles"]) for r in joined.collect()]


@pytest.fixture(scope="module")
def items(spark):
    from ..conftest import SF_SMALL

    return spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")


@pytest.mark.parametrize("name", ["documents", "odd", "none"])
@pytest.mark.parametrize("bound", [1 << 20, 0])
def test_equals_brute_force(request, items, name, bound, monkeypatch):
    monkeypatch.setattr(dc, "BROADCAST_ROWS", bound)
    docs = request.getfixturevalue(name)
    got = found(docs, items)
    assert len(got) == len(set(got)) and set(got) == brute(docs.collect(), items.collect())


def test_partial_and_odd_items(spark):
    words = [f"w{i}" for i in range(200)]
    item = " ".join(words[:24])  # 20 shingles
    rows = [
        (1, "x " * 5000 + item + " y" * 5000),  # short item inside a long document
        (2, " ".join(words[:20])),  # 16 of 20
        (3, " ".join(words[:19])),  # 15 of 20
        (4, item.upper().replace(" ", ",  ")),
        (5, None),
        (5, item),
        (None, item),
        (6, "w0 w1 w2"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame([(1, item), (1, item), (2, None), (3, ""), (4, "w0 w1 w2 w3"), (5, " ".join(words[:5])), (None, item)], "item_id long, text string")
    got = set(found(docs, items))
    assert got == brute([r.asDict() for r in docs.collect()], [r.asDict() for r in items.collect()])
    assert {g[0] for g in got if g[2] == 1} == {1, 2, 4, 5, None}
    assert found(docs, items.where("false")) == []


def test_sketch_is_small_and_partitioned(items):
    rows = dc.sketches(items, "item_id", "text").collect()
    by = {}
    for r in rows:
        by.setdefault(r["item"], []).append(r)
    for item in items.collect():
        n = len(grams(item["text"]))
        got = by.get(item["item_id"], [])
        assert len(got) <= n and all(1 << r["part"] <= n < 2 << r["part"] for r in got)
        assert len(got) >= min(n, n - -(-8 * n // 10) + 1) if n else not got


@pytest.mark.parametrize("name", ["documents", "odd", "none"])
def test_drop(request, items, name):
    docs = request.getfixturevalue(name)
    out = dc.drop_contaminated(docs, items)
    assert out.columns == docs.columns
    bad = {(b[0], b[1]) for b in brute(docs.collect(), items.collect())}
    assert sorted(map(repr, out.collect())) == sorted(repr(r) for r in docs.collect() if (r["doc_id"], r["text"]) not in bad)


def test_native_plan(documents, items):
    from ..conftest import plan_text

    text = plan_text(dc.drop_contaminated(documents, items))
    assert "Python" not in text and "Arrow" not in text
