import random
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from kestrel.llm import records

BPE = public_tokenizers.path("byte_bpe_50k.json")
PARTS = ["a", "Word", "é", "ß", "'s", "'", "l'", "²", "_", " ", "  ", "\n", "\n\n", "\t", ".", ",", "!?", "<|endoftext|>", "9", "x9", "Ж", "日", " ", " ", "\x1c", "'ll", "can't", "#$", "\r\n", "ɏ"]


@pytest.fixture(scope="module")
def encoder():
    return records.Encoder(BPE)


def test_pieces_equal_whole_texts(encoder, documents):
    r, whole = random.Random(3), Tokenizer.from_file(BPE)
    texts = ["".join(r.choice(PARTS) for _ in range(r.randint(0, 14))) for _ in range(8000)]
    texts += [x["text"] for x in documents.limit(60).collect()]
    assert encoder.by_piece
    for text, ids in zip(texts, encoder.encode(texts)):
        assert ids.tolist() == whole.encode(text, add_special_tokens=False).ids, repr(text)


def test_small_memory_gives_the_same(monkeypatch, documents):
    monkeypatch.setattr(records, "MEMO", 50)
    texts, small, whole = [x["text"] for x in documents.limit(20).collect()], records.Encoder(BPE), Tokenizer.from_file(BPE)
    for text in texts:
        assert small.encode([text])[0].tolist() == whole.encode(text, add_special_tokens=False).ids


def test_other_tokenizers_encode_whole():
    other = records.Encoder(public_tokenizers.path("word_bpe_49k.json"))
    assert not other.by_piece
    whole = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    assert other.encode(["Ab  c, d"])[0].tolist() == whole.encode("Ab  c, d", add_special_tokens=False).ids


def test_frames_round_trip_and_damage():
    ids = [np.array([], np.uint32), np.array([0, 65535, 7], np.uint32)]
    data = b"".join(records.frame(k, x, 2) + b"\n" for k, x in zip([None, -5], ids))
    out = list(records.parse(data))
    assert [(o[2], o[3].tolist()) for o in out] == [(None, []), (-5, [0, 65535, 7])]
    assert out[1][0] == out[0][1] and sum(o[1] for o in out) == len(data)
    n = struct.unpack("<Q", data[:8])[0]
    crc = zlib.crc32(data[:8])
    assert struct.unpack("<I", data[8:12])[0] == (((crc >> 15) | (crc << 17)) + 0xA282EAD8) & 0xFFFFFFFF and n == 10
    for at in range(len(data)):
        bad = bytearray(data)
        bad[at] ^= 4
        with pytest.raises((ValueError, struct.error)):
            list(records.parse(bytes(bad)))


@pytest.mark.parametrize("name", ["documents", "odd", "none"])
def test_files_read_back(spark, request, name):
    df = request.getfixturevalue(name)
    path, index = records.write_records(df, BPE, files=3)
    rows = sorted(index.collect(), key=lambda r: r["start"])
    docs = sorted(df.collect(), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0))
    assert [r["key"] for r in rows] == [d["doc_id"] for d in docs]
    whole, start, want = Tokenizer.from_file(BPE), 0, {}
    for d in docs:
        ids = np.array([*whole.encode(d["text"] or "", add_special_tokens=False).ids, 0], "<u4")
        want.setdefault(d["doc_id"], []).append((len(ids), zlib.crc32(ids.tobytes())))
    for r in rows:
        assert r["start"] == start
        want[r["key"]].remove((r["n_tokens"], r["ids_crc32"]))
        start += r["n_tokens"]
    # a shuffled reader fetches single records by offset and length
    files = {f["path"].rpartition("/")[2]: f["content"] for f in spark.read.format("binaryFile").load(f"{path}/data/part-*").collect()}
    for r in rows[::7]:
        (_, _, key, ids), = records.parse(bytes(files[r["file"]][r["offset"] : r["offset"] + r["length"]]))
        assert key == r["key"] and zlib.crc32(ids.tobytes()) == r["ids_crc32"]
    ids = records.read(spark, f"{path}/data", with_ids=True)
    assert ids.count() == len(rows) and all(len(r["ids"]) == r["n_tokens"] for r in ids.collect())
    some = index.where("offset % 3 <> 0")
    got = records.read_shuffled(spark, f"{path}/data", some, seed=5).collect()
    crcs = lambda found: sorted((repr(k), c) for k, c in found)
    assert crcs((r["key"], zlib.crc32(np.array(r["ids"], "<u4").tobytes())) for r in got) == crcs((r["key"], r["ids_crc32"]) for r in some.collect())
    other = records.read_shuffled(spark, f"{path}/data", some, seed=6).collect()
    assert len(got) < 20 or [r["key"] for r in got] not in ([r["key"] for r in other], sorted(r["key"] for r in got))
