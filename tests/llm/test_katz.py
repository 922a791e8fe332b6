import math
from collections import Counter, defaultdict
from functools import cache

import pytest
from pyspark.sql import functions as F

from kestrel.llm import katz


def brute(texts, train, order):
    """Scores by the textbook recursion, and a function for one probability."""
    seqs = [["<s>"] * (order - 1) + (t or "").encode().lower().split() + [None] for t in texts]
    count = [Counter() for _ in range(order + 1)]
    for seq, t in zip(seqs, train):
        for i in range(order - 1, len(seq)) if t else ():
            for k in range(1, order + 1):
                count[k][tuple(seq[i - k + 1 : i + 1])] += 1
    total = sum(count[1].values())
    cut = [None] + [katz.discounts([sum(c == r for c in count[k].values()) for r in range(1, 7)]) for k in range(1, order + 1)]
    kept = lambda k, c: c * (cut[k][c - 1] if c <= 5 else 1.0)
    unknown = 1 - sum(kept(1, c) for c in count[1].values()) / (total + 1)
    after = [defaultdict(list) for _ in range(order + 1)]
    for k in range(2, order + 1):
        for g, c in count[k].items():
            after[k][g[:-1]].append((g[-1], c))

    @cache
    def p(k, g):
        if k == 1:
            return kept(1, count[1][g]) / (total + 1) if count[1][g] else unknown
        known = after[k].get(g[:-1])
        if not known:
            return p(k - 1, g[1:])
        n = sum(c for _, c in known)
        return kept(k, count[k][g]) / (n + 1) if count[k][g] else weight(k, g[:-1]) * p(k - 1, g[1:])

    @cache
    def weight(k, h):
        n = sum(c for _, c in after[k][h])
        return (1 - sum(kept(k, c) for _, c in after[k][h]) / (n + 1)) / max(1 - sum(p(k - 1, (*h[1:], w)) for w, _ in after[k][h]), 1e-12)

    scores = [sum(math.log10(p(order, tuple(s[i - order + 1 : i + 1]))) for i in range(order - 1, len(s))) for s in seqs]
    return scores, count, p, after


def held_out(df):
    return df.withColumn("fit", F.crc32(F.encode(F.coalesce(F.col("doc_id"), F.lit(0)).cast("string"), "utf-8")) % 10 != 0)


@pytest.mark.parametrize("order", [1, 2, 3])
@pytest.mark.parametrize("name", ["documents", "odd", "none"])
def test_scores_equal_brute_force(request, name, order, monkeypatch):
    if name != "documents":
        monkeypatch.setattr(katz, "HOT", 3)
    df = held_out(request.getfixturevalue(name))
    model = katz.fit(df, F.col("fit"), order=order, bucket_tokens=4000)
    rows = sorted(katz.score(model).collect(), key=lambda r: (repr(r["id"]), r["n_tokens"], r["score"]))
    docs = df.collect()
    scores, count, p, after = brute([d["text"] for d in docs], [d["fit"] for d in docs], order)
    total, known = sum(count[1].values()), count[1]
    want = []
    for d, s in zip(docs, scores):
        tokens = [(w,) for w in [*(d["text"] or "").encode().lower().split(), None]]
        base = sum(math.log10((known[t] + 0.1) / (total + 0.1 * (len(known) + 1))) for t in tokens)
        want.append((d["doc_id"], d["fit"], len(tokens), sum(known[t] > 0 for t in tokens), base, s))
    want.sort(key=lambda r: (repr(r[0]), r[2], r[5]))
    assert len(rows) == len(want)
    for r, w in zip(rows, want):
        assert tuple(r)[:4] == w[:4]
        assert r["base_score"] == pytest.approx(w[4], rel=1e-9, abs=1e-9) and r["score"] == pytest.approx(w[5], rel=1e-9, abs=1e-9)
    assert model.levels[0].total == total and [model.table(k).count() for k in range(1, order + 1)] == [len(c) for c in count[1:]]
    vocabulary = [g[0] for g in known]
    for h in list(after[order])[:10]:
        assert sum(p(order, (*h, w)) for w in vocabulary) + p(order, (*h, b"\x00")) == pytest.approx(1)


def test_held_out_texts_are_likelier_than_under_unigrams(documents):
    df = held_out(documents)
    rows = katz.score(katz.fit(df, F.col("fit"))).where("not train").agg(F.sum("score").alias("s"), F.sum("base_score").alias("b")).first()
    assert rows["s"] > rows["b"]


def test_nothing_to_learn_from(documents):
    rows = katz.score(katz.fit(documents.limit(5), F.lit(False))).collect()
    assert len(rows) == 5 and all(r["score"] == 0 and r["n_known"] == 0 for r in rows)


def test_discounts():
    good = katz.discounts([100, 40, 20, 12, 8, 6])
    assert all(0 < d < 1 for d in good)
    # the freed mass is that of the words seen once
    assert sum(r * n * (1 - d) for r, (n, d) in enumerate(zip([100, 40, 20, 12, 8], good), 1)) == pytest.approx(100)
    for odd in ([0] * 6, [5, 0, 0, 0, 0, 0], [1, 2, 300, 4, 5, 6]):
        assert all(0 < d < 1 for d in katz.discounts(odd))


def test_packing():
    import numpy as np

    for a in (np.zeros(0, np.int64), np.arange(1000) * 7919 - 5, np.array([0.5, -1e300]), np.array([True, False])):
        assert (katz.unpack(katz.pack(a), a.dtype) == a).all()


def test_contexts_of_one_chunk_are_not_sent(spark):
    # each document lies in a chunk of its own and shares half its words with another
    own = [" ".join(f"a{i}x{j % 40}" if j % 2 else f"s{j % 50}" for j in range(200)) for i in range(6)]
    texts = [*own, own[0], "s1 s2 s3 never", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartitionByRange(len(texts), "doc_id")
    train = [i % 4 != 3 for i in range(len(texts))]
    for order in (2, 3):
        model = katz.fit(df, F.col("doc_id") % 4 != 3, order=order, bucket_tokens=100)
        scores, count, _, _ = brute(texts, train, order)
        rows = sorted(katz.score(model).collect(), key=lambda r: r["id"])
        assert [r["score"] for r in rows] == pytest.approx(scores, rel=1e-9)
        kept = model.table(order).agg(F.count("*"), F.sum("count"), F.count("bucket")).first()
        assert kept[0] == len(count[order]) and kept[1] == sum(count[order].values())
        assert 0 < kept[2] < kept[0]  # the buckets counted the shared ones only
        assert model.table(order).select("context", "word").distinct().count() == kept[0]
        assert "words" not in model.chunks.columns  # hashes are not kept beside the numbers
        model.close()


def test_shuffle_files_go_with_their_query(spark, monkeypatch):
    monkeypatch.setattr(katz, "release_shuffles", lambda spark: None)
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, seen = spark.conf.get(name, None), []
    stage = katz.staged
    monkeypatch.setattr(katz, "staged", lambda df, where: seen.append(spark.conf.get(name)) or stage(df, where))
    df = spark.createDataFrame([(1, "a b a"), (2, "b a b")], "doc_id long, text string")
    katz.fit(df, F.lit(True), order=3).close()
    assert seen == ["true"] * 3 and spark.conf.get(name, None) == before
