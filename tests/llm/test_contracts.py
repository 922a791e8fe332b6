"""The registered queries against plain versions of their contracts (those without SQL)."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from kestrel.llm import mixing, quality
from kestrel.llm.queries import QUERIES, URL_RULES

from ..conftest import SF_SMALL
from .test_decontaminate import brute as contaminated
from .test_katz import brute as katz_scores
from .test_lines_urls import fits, host_path
from .test_simhash import brute_components, brute_print

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def docs(documents):
    return documents.collect()


def run(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    return df, df.collect()


def test_op2(spark, docs):
    df, rows = run(spark, "op2_simhash")
    assert dict(df.dtypes)["component_id"] == "bigint"
    prints = {d["doc_id"]: brute_print(d["text"]) for d in docs}
    ids = sorted(prints)
    comp = brute_components([(a, b) for a in ids for b in ids if a < b and (prints[a] ^ prints[b]).bit_count() <= 2], ids)
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in rows} == {i: (f"{prints[i]:016x}", comp[i]) for i in ids}


def test_op3(spark, docs):
    df, rows = run(spark, "op3_sharding")
    assert [t for _, t in df.dtypes] == ["bigint", "bigint", "bigint", "string", "int", "bigint", "int"]
    want = {d["doc_id"]: (len((d["text"] or "").encode()) + 16, zlib.crc32((d["text"] or "").encode())) for d in docs}
    assert {r["doc_id"]: (r["size"], r["text_crc32"]) for r in rows} == want
    slots = defaultdict(list)
    size = Counter()
    for r in rows:
        assert 0 <= r["shard"] < 40 and r["law"] == "bytes" and r["grown_shard"] is None
        slots[r["shard"]].append(r["slot"])
        size[r["shard"]] += r["size"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    mean, largest = sum(size.values()) / 40, max(r["size"] for r in rows)
    assert all(abs(size[s] - mean) <= 1.5 * largest for s in range(40))


def test_op6(spark, docs):
    _, rows = run(spark, "op6_lm_scoring")
    train = [zlib.crc32(str(d["doc_id"]).encode()) % 10 != 0 for d in docs]
    scores, count, _, _ = katz_scores([d["text"] for d in docs], train, 3)
    want = {d["doc_id"]: (not t, s) for d, t, s in zip(docs, train, scores)}
    assert len(rows) == len(want)
    for r in rows:
        held, s = want[r["doc_id"]]
        assert r["held_out"] == held and r["train_tokens"] == sum(count[1].values()) and r["score"] == pytest.approx(s, rel=1e-9)


def test_op7(spark):
    _, rows = run(spark, "op7_url_filters")
    pages = {p["page_id"]: p["url"] for p in spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()}
    assert len(rows) == len(pages)
    for r in rows:
        host, path = host_path(pages[r["page_id"]])
        best = max((x for x in URL_RULES if fits(x, host, path)), key=lambda x: len(x.host) + len(x.path), default=None)
        assert (r["host"], r["path"], r["rule"]) == (host, path, best and best.host + best.path)
        assert r["verdict"] == best.verdict if best else r["verdict"] in ("allow", "block")


def test_op9(spark, docs):
    _, rows = run(spark, "op9_mixing")
    size = {d["doc_id"]: len(WORD.findall(d["text"] or "")) for d in docs}
    source = {d["doc_id"]: d["source"] for d in docs}
    names = sorted(set(source.values()), key=lambda s: (s is None, s or ""))
    total = {s: sum(size[i] for i in size if source[i] == s) for s in names}
    target = dict.fromkeys(names, 0.0)
    left, free = float(sum(total.values())), set(names)
    while free:
        weight = {s: names.index(s) % 3 + 1 for s in free}
        full = {s for s in free if left * weight[s] / sum(weight.values()) > 3 * total[s]}
        for s in full or free:
            target[s] = 3.0 * total[s] if full else left * weight[s] / sum(weight.values())
        left -= sum(target[s] for s in full)
        free = free - full if full else set()
    taken = Counter()
    for r in rows:
        s = source[r["doc_id"]]
        assert (r["size"], r["source_size"]) == (size[r["doc_id"]], total[s]) and r["target"] == pytest.approx(target[s])
        assert r["taken"] <= 3 * r["size"] and r["taken"] == r["n_copies"] * r["size"] and len(r["shards"]) == r["n_copies"]
        assert r["shards"] == sorted(r["shards"]) and all(0 <= x < 16 for x in r["shards"])
        taken[s] += r["taken"]
    assert all(taken[s] <= target[s] + 1e-6 for s in names)
    assert sorted(map(repr, rows)) == sorted(map(repr, run(spark, "op9_mixing")[1]))
    assert len({x for r in rows for x in r["shards"]}) > 8
    assert {r["doc_id"]: r["taken"] for r in rows} == taken_plainly(docs, size, source, target)


def taken_plainly(docs, size, source, target, block=mixing.BLOCK_WORDS):
    """Words taken of each document: whole passes, then, in the keyed order, what is before the cut or still fits after it."""
    import xxhash

    def key(d):
        """Spark's xxhash64 of (doc_id, source, size, seed, repeat 0), signed."""
        at = 42
        for v in (d["doc_id"], d["source"], size[d["doc_id"]], np.int32(42), 0):
            raw = v.encode() if isinstance(v, str) else v.tobytes() if isinstance(v, np.int32) else int(v).to_bytes(8, "little", signed=True)
            at = xxhash.xxh64_intdigest(raw, seed=at) if v is not None else at
        return at - (1 << 64) if at >> 63 else at

    most = max(Counter(source.values()).values())
    slices = max(1, -(-most // mixing.SLICE_ROWS))
    out = {}
    for s in set(source.values()):
        line = sorted((d for d in docs if d["source"] == s), key=lambda d: ((key(d) % (1 << 64) >> 16) % slices, key(d)))
        total = sum(size[d["doc_id"]] for d in line)
        passes = int(target[s] // total) if total else 0
        rest = target[s] - passes * total
        cut, at, room = rest // block * block, 0, None
        for d in line:
            n = size[d["doc_id"]]
            take = rest > 0 and at + n <= cut
            if rest > 0 and not take and n > 0 and at < cut + mixing.LOOK * block:
                room = rest - at if room is None else room
                take = n <= room
                room -= n if take else 0
            out[d["doc_id"]] = n * (passes + bool(take))
            at += n
    return out


def test_op10(spark, docs):
    _, rows = run(spark, "op10_records")
    tok, start = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), 0
    got = {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in rows}
    assert len(got) == len(rows) == len(docs)
    for d in sorted(docs, key=lambda d: d["doc_id"]):
        ids = np.array([*tok.encode(d["text"] or "", add_special_tokens=False).ids, 0], "<u4")
        assert got[d["doc_id"]] == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_pipeline_stages_against_plain_versions(spark, documents):
    from kestrel.llm.common import staged

    from .test_quality import brute as measures

    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_rules", "drop_near_duplicates", "drop_benchmark_leaks", "mix_sources", "shard_rows"]
    text = lambda df: sorted(map(repr, df.select(*documents.columns).collect()))
    now = staged(documents, "t")

    def step(name):
        out = staged(stages[name](spark, now, SF_SMALL), "t")
        assert out.columns[: len(documents.columns)] == documents.columns
        return out

    rules = [r for r in quality.RULES if r.name in quality.POLICIES["v2"]]
    out = step("quality_rules")
    assert text(out) == sorted(repr(d) for d in now.collect() if not any(eval(r.failed, {}, measures(d["text"])) for r in rules))
    now = out

    out = step("drop_near_duplicates")
    rows = now.collect()
    prints = [brute_print(d["text"]) for d in rows]
    comp = brute_components([(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 2], range(len(rows)))
    first = {}
    for i, d in enumerate(rows):
        if comp[i] not in first or d["doc_id"] < first[comp[i]]["doc_id"]:
            first[comp[i]] = d
    assert text(out) == sorted(map(repr, first.values()))
    now = out

    out = step("drop_benchmark_leaks")
    items = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()
    bad = {b[0] for b in contaminated(now.collect(), items)}
    assert text(out) == sorted(repr(d) for d in now.collect() if d["doc_id"] not in bad)
    now = out

    out = step("mix_sources")
    copies = Counter(r["doc_id"] for r in out.collect())
    assert set(text(out)) <= set(text(now)) and max(copies.values()) <= 3
    words = sum(len(WORD.findall(d["text"])) for d in now.collect())
    assert 0.8 * words < sum(len(WORD.findall(d["text"])) for d in out.collect()) <= words
    now = out

    out = step("shard_rows")
    assert text(out) == text(now)
    by = defaultdict(list)
    for r in out.collect():
        by[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    whole = corpus_pipeline.run(spark, SF_SMALL)
    assert sorted(map(repr, whole.collect())) == sorted(map(repr, out.collect()))


@pytest.mark.parametrize("name", ["odd", "none"])
def test_pipeline_stages_take_odd_and_empty_tables(spark, request, name):
    from kestrel.llm.common import staged

    now = request.getfixturevalue(name)
    for stage, f in corpus_pipeline.STAGES:
        out = staged(f(spark, now, SF_SMALL), "t")
        assert out.columns[: len(now.columns)] == now.columns and len(out.columns) == len(now.columns) + 2 * (stage == "shard_rows")
        assert out.count() <= 3 * now.count()
        now = out


def test_native_queries_run_no_python(spark):
    from ..conftest import plan_text

    for name in ("op1_chat", "op3_sharding", "op5_line_dedup", "op8_decontamination", "op11_secrets"):
        text = plan_text(QUERIES[name](spark, SF_SMALL).where(F.lit(True)))
        assert not re.search("Python|Pandas|Arrow", text), name
