import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from kestrel.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    count = Counter(windows)
    inside = {i + j for i, w in enumerate(windows) if count[w] > 1 for j in range(8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_lines": len(lines),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(inside),
        "n_stutter": sum(a == b for a, b in zip(words, words[1:])),
        "n_upper": sum("A" <= c <= "Z" for c in text),
        "n_digits": sum("0" <= c <= "9" for c in text),
        "n_marks": sum(c in "!?" for c in text),
    }


@pytest.mark.parametrize("name", ["documents", "odd", "none"])
def test_measures_equal_brute_force(request, name):
    df = request.getfixturevalue(name)
    rows = quality.ledger(df.select("doc_id", "text"), "text", keep=["doc_id", "text"]).collect()
    assert len(rows) == df.count()
    for r in rows:
        want = brute(r["text"])
        assert {m: r[m] for m in quality.MEASURES} == want
        bits = 0
        for i, rule in enumerate(quality.RULES):
            bits |= int(bool(eval(rule.failed, {}, want))) << i
        assert r["failed_bits"] == bits


def test_texts_and_blocks_do_not_change_measures():
    texts = [b"a b c d e f g h i", b"", b"a b c d e f g h " * 3, b"x"] * 50
    whole = quality.measure(texts)
    for i, t in enumerate(texts):
        assert {k: int(v[i]) for k, v in whole.items()} == brute(t.decode())


def test_policies_and_ablations(documents):
    rows = quality.ledger(documents, "text").cache()
    for policy, names in quality.POLICIES.items():
        whole = quality.mask(policy)
        bits = [r["failed_bits"] for r in rows.select("failed_bits").collect()]
        assert rows.where(quality.passes(policy)).count() == sum(b & whole == 0 for b in bits)
        got = {r["rule"]: r for r in quality.ablations(rows, policy).collect()}
        assert set(got) == set(names) or not bits
        for rule in names:
            one = quality.mask((rule,))
            assert got[rule]["failed"] == sum(b & one != 0 for b in bits)
            assert got[rule]["failed_only"] == sum(b & whole == one for b in bits)
            assert got[rule]["kept_without"] == sum(b & whole & ~one == 0 for b in bits)


def test_clashing_columns_stay(documents):
    df = documents.select("doc_id", "text", F.lit("mine").alias("n_words"), F.lit(5).alias("Failed_Bits"))
    rows = quality.ledger(df, "text")
    assert rows.columns[:3] == ["doc_id", "n_words", "Failed_Bits"] and rows.columns[3] == "_n_words" and rows.columns[-1] == "_failed_bits"
    plain = {r["doc_id"]: r["n_words"] for r in quality.ledger(documents, "text").collect()}
    assert all(r["n_words"] == "mine" and r["_n_words"] == plain[r["doc_id"]] for r in rows.collect())


def test_clean_labelled_documents_stay(spark, documents):
    from ..conftest import SF_SMALL

    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    rows = quality.ledger(documents, "text").join(labels, "doc_id").where("quality = 1 and n_words >= 20")
    assert rows.where(~quality.passes("v2") & quality.passes("base")).count() == 0
