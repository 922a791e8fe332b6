"""Token ids as length-delimited binary records, with a separate offset index.

A file is a run of records, in the order of the key:

======== =====================================================================
bytes    content (numbers little-endian, unsigned)
======== =====================================================================
8        length *n* of the payload
4        masked CRC-32 of those 8 bytes
n        payload: 8 bytes key (signed), 1 byte flags (bit 0: the key is null),
         1 byte width *w* (2 or 4), then the token ids, *w* bytes each
4        masked CRC-32 of the payload
1        ``0x0A``, the record end that Spark's text sink writes
======== =====================================================================

The mask rotates the checksum right by 15 bits and adds ``0xA282EAD8``, so that a
checksum stored inside checked bytes does not check itself. Two-byte ids are used
when the vocabulary has at most 65,536 entries.

``write`` range-partitions by the key and writes through Spark's own committed
sink, so a lost executor's task is simply run again. ``read`` parses the files
back, verifies both checksums of every record and gives one row per record with
its file, offset and length: ``build_index`` stores exactly that, and a shuffled
reader fetches any record with it.

Defined results: a null text counts as empty and gives one end id; null keys
sort first; repeated keys stay separate records, in the order of their text; an
empty table gives no records; other input columns are not read.
"""

from __future__ import annotations

import itertools
import json
import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kestrel.session import scratch_path

from .common import as_bytes, ref, spans, staged

_MASK = 0xA282EAD8
_HEAD = struct.Struct("<QI")
_KEY = struct.Struct("<qBB")
_CRC = struct.Struct("<I")
#: Distinct pieces of text whose ids one Python worker remembers at a time.
MEMO = 500_000


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + _MASK) & 0xFFFFFFFF


def frame(key: int | None, ids: np.ndarray, width: int) -> bytes:
    payload = _KEY.pack(0 if key is None else key, key is None, width) + ids.astype(f"<u{width}").tobytes()
    length = struct.pack("<Q", len(payload))
    return b"".join((length, _CRC.pack(masked(length)), payload, _CRC.pack(masked(payload))))


def parse(data: bytes) -> Iterator[tuple[int, int, int | None, np.ndarray]]:
    """(offset, bytes of the record, key, ids) of each record of one file; raises on any damage."""
    at, view = 0, memoryview(data)
    while at < len(data):
        n, crc = _HEAD.unpack_from(view, at)
        if masked(bytes(view[at : at + 8])) != crc:
            raise ValueError(f"length at byte {at} fails its checksum")
        payload = bytes(view[at + 12 : at + 12 + n])
        if len(payload) != n or masked(payload) != _CRC.unpack_from(view, at + 12 + n)[0]:
            raise ValueError(f"payload at byte {at} fails its checksum")
        if view[at + 16 + n] != 0x0A:
            raise ValueError(f"record at byte {at} has no end mark")
        key, null, width = _KEY.unpack_from(payload)
        yield at, n + 17, None if null else key, np.frombuffer(payload, f"<u{width}", offset=_KEY.size).astype("<u4")
        at += n + 17


def byte_letters() -> dict[int, str]:
    """Latin-1 character of each byte -> the printable character that byte-level vocabularies write for it."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class Encoder:
    """Ids of whole texts by the ``tokenizers`` library.

    A byte-level BPE never merges across the white space before a word, so such a text
    is cut at blanks and line ends, and each distinct piece of a block of texts is encoded
    once. A piece that is a Latin word with punctuation behind it is two units, which the
    library's model merges; every other piece goes through the whole library. Units are
    remembered. Texts in which white space meets other white space than line feeds, and other
    kinds of tokenizer, go to the library as a whole. All ways give the same ids.
    """

    _space = r"\t\x0b\x0c\r\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
    _odd = rf" (?:[ \n{_space}]|$)|[ {_space}]\n"
    _word = "^ ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+$"
    _marks = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre, model = spec.get("pre_tokenizer") or {}, spec["model"]
        self.by_piece = (
            spec.get("normalizer") is None
            and pre.get("type") == "ByteLevel"
            and not pre.get("add_prefix_space")
            and pre.get("use_regex", True)
            and model["type"] == "BPE"
            and not any(model.get(x) for x in ("dropout", "continuing_subword_prefix", "end_of_word_suffix"))
            # an added token must be such that no word with punctuation behind it can hold it
            and not any(re.search(r"\s", t["content"]) or t["lstrip"] or t["rstrip"] or not re.match(r"[^\w\s].*[a-z]", t["content"]) for t in spec.get("added_tokens", []))
        )
        self._letters = byte_letters()
        self._clear()

    def _clear(self) -> None:
        self.memo: dict[str, int] = {}
        self.flat = np.zeros(1 << 16, np.uint32)
        self.begin = np.zeros(1 << 14, np.int64)
        self.count = np.zeros(1 << 14, np.int64)
        self.used = 0

    def _merge(self, unit: str) -> list[int]:
        """Ids of one unit that is a single word, mark or line end to the library."""
        return [t.id for t in self.tokenizer.model.tokenize(unit.encode().decode("latin-1").translate(self._letters))]

    def _units(self, units: list[str], merged: list[bool]) -> np.ndarray:
        """Numbers of distinct units in the memory; new ones are encoded, those in ``merged`` by the model alone."""
        memo = self.memo
        if missing := [(u, m) for u, m in zip(units, merged, strict=True) if u not in memo]:
            whole = [u for u, m in missing if not m]
            ids = dict(zip(whole, (e.ids for e in self.tokenizer.encode_batch(whole, add_special_tokens=False)), strict=True))
            ids |= {u: self._merge(u) for u, m in missing if m}
            n = np.fromiter(map(len, ids.values()), np.int64, len(ids))
            flat = np.fromiter(itertools.chain.from_iterable(ids.values()), np.uint32, int(n.sum()))
            k = len(memo)
            memo.update(zip(ids, range(k, k + len(ids)), strict=True))
            if k + len(n) > len(self.begin):
                self.begin, self.count = (np.concatenate([x, np.zeros(len(x) + len(n), np.int64)]) for x in (self.begin, self.count))
            if self.used + len(flat) > len(self.flat):
                self.flat = np.concatenate([self.flat, np.zeros(len(self.flat) + len(flat), np.uint32)])
            self.begin[k : k + len(n)] = self.used + np.cumsum(n) - n
            self.count[k : k + len(n)] = n
            self.flat[self.used : self.used + len(flat)] = flat
            self.used += len(flat)
        return np.fromiter(map(memo.__getitem__, units), np.int64, len(units))

    def _gather(self, flat: np.ndarray, begin: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        ends = np.cumsum(n)
        return flat[np.repeat(begin - ends + n, n) + np.arange(ends[-1] if len(ends) else 0)], ends

    def _pieces(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Flat ids, begins and counts of distinct pieces: line ends before a word, the word, the marks behind it."""
        if len(self.memo) > MEMO:
            self._clear()
        body = pc.utf8_ltrim(pieces, "\n")
        core = pc.utf8_rtrim(body, self._marks)
        match = pc.match_substring_regex(core, self._word)
        simple = match.to_numpy(zero_copy_only=False)
        unit = pc.if_else(match, core, pieces).dictionary_encode()
        merged = pc.match_substring_regex(unit.dictionary, self._word).to_pylist()
        parts = np.full((len(pieces), 4), -1, np.int64)
        parts[:, 2] = self._units(unit.dictionary.to_pylist(), merged)[unit.indices.to_numpy()]
        length, inner = pc.utf8_length(pieces).to_numpy(), pc.utf8_length(body).to_numpy()
        # all line ends but the last are one word to the library, the last is another
        ends = np.where(simple, length - inner, 0)
        if ends.any():
            parts[ends > 0, 1] = self._units(["\n"], [True])[0]
            for k in np.unique(ends[ends > 1]):
                parts[ends == k, 0] = self._units(["\n" * int(k - 1)], [True])[0]
        marked = np.flatnonzero(simple & (pc.utf8_length(core).to_numpy() < inner))
        if len(marked):
            tail = pc.replace_substring_regex(body.take(pa.array(marked)), self._word[:-1], "", max_replacements=1).dictionary_encode()
            tails = tail.dictionary.to_pylist()
            parts[marked, 3] = self._units(tails, [True] * len(tails))[tail.indices.to_numpy()]
        at = parts.ravel()
        n = np.where(at < 0, 0, self.count[at])
        flat, _ = self._gather(self.flat, self.begin[at], n)
        count = n.reshape(-1, 4).sum(axis=1)
        return flat, np.cumsum(count) - count, count

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        odd = pc.match_substring_regex(pa.array(texts, pa.large_string()), self._odd).to_pylist() if self.by_piece else [True] * len(texts)
        whole = [i for i, x in enumerate(odd) if x]
        out: list[np.ndarray] = [np.zeros(0, np.uint32)] * len(texts)
        for i, e in zip(whole, self.tokenizer.encode_batch([texts[i] for i in whole], add_special_tokens=False), strict=True):
            out[i] = np.array(e.ids, np.uint32)
        rest = sorted({*range(len(texts))}.difference(whole))
        if not rest:
            return out
        cut = []
        for i in rest:
            text = texts[i].replace("\n", " \n")  # a cut before each run of line ends
            while "\n \n" in text:
                text = text.replace("\n \n", "\n\n")
            cut.append(text)
        split = pc.split_pattern(pa.array(cut, pa.large_string()), " ")
        bounds, found = split.offsets.to_numpy(), split.flatten().dictionary_encode()
        first = found.take(pa.array(bounds[:-1])).to_pylist()
        numbers = {x: i for i, x in enumerate(dict.fromkeys(first))}
        inner = found.dictionary
        inner = pc.if_else(pc.starts_with(inner, "\n"), inner, pc.binary_join_element_wise(pa.scalar("", pa.large_string()), inner, pa.scalar(" ", pa.large_string())))
        flat, begin, count = self._pieces(pa.concat_arrays([inner, pa.array(list(numbers), pa.large_string())]))
        at = found.indices.to_numpy().astype(np.int64)
        at[bounds[:-1]] = [len(inner) + numbers[x] for x in first]
        ids, ends = self._gather(flat, begin[at], count[at])
        edges = np.concatenate([np.zeros(1, np.int64), ends])[bounds]
        for k, i in enumerate(rest):
            out[i] = ids[edges[k] : edges[k + 1]]
        return out


_ENCODERS: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    """One encoder for each tokenizer file in this worker; its memory of pieces is bounded."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def write(df: DataFrame, path: str, tokenizer: str, key_col: str = "doc_id", text_col: str = "text", end_id: int | None = 0, files: int | None = None) -> None:
    """Encode the texts and write the record files under ``path``, in ascending key order over the files' names.

    ``tokenizer`` is the tokenizer's file, readable on every executor. ``files``
    fixes the number of files; by default Spark's shuffle settings do.
    """
    from tokenizers import Tokenizer

    width = 2 if Tokenizer.from_file(tokenizer).get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4
    end = np.array([] if end_id is None else [end_id], np.uint32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer)
        for batch in batches:
            keys = batch.column(0).to_pylist()
            for lo, hi in spans(batch.column(1), 4 << 20):
                ids = encoder.encode([t.decode("utf-8", "replace") for t in as_bytes(batch.column(1).slice(lo, hi - lo))])
                out = [frame(key, np.concatenate([x, end]), width) for key, x in zip(keys[lo:hi], ids, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])

    rows = df.select(ref(key_col).cast("long").alias("key"), ref(text_col).alias("text"))
    order = [F.col("key"), F.xxhash64("text")]
    rows = rows.repartitionByRange(files, *order) if files else rows.repartitionByRange(*order)
    records = rows.sortWithinPartitions(*order).mapInArrow(run, "record binary")
    records.select(F.col("record").cast("string").alias("value")).write.option("compression", "none").text(path)


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True))
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) if n == "key" else pa.array(c) for n, c in zip(names, columns, strict=True)], names=names)


def read(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """One row per record of the files: file, part, offset, length, key, rank in the file, ids before it in the file, n_tokens, ids_crc32."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                part, before, rows, size = int(re.search(r"part-(\d+)", name)[1]), 0, [], 0
                for rank, (offset, length, key, ids) in enumerate(parse(data.as_buffer().to_pybytes())):
                    rows.append((name.rpartition("/")[2], part, offset, length, key, rank, before, len(ids), zlib.crc32(ids.tobytes()), *([ids.astype("<i8")] if with_ids else [])))
                    before += len(ids)
                    size += len(ids)
                    if size > 1 << 20 or len(rows) > 20_000:
                        yield _batch(rows, names)
                        rows, size = [], 0
                if rows:
                    yield _batch(rows, names)

    names = ["file", "part", "offset", "length", "key", "rank", "before", "n_tokens", "ids_crc32"] + ["ids"] * with_ids
    schema = "file string, part long, offset long, length long, key long, rank long, before long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("path", "content").mapInArrow(run, schema)


def build_index(spark: SparkSession, path: str, index_path: str) -> DataFrame:
    """Write the offset index of the files under ``path``: one row per record, with ``start``, the ids of all records before it.

    Only one total per file is gathered to place the files behind each other.
    """

    rows = staged(read(spark, path), "records-index")
    files = rows.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = files.select("part", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("base"))
    rows.join(offsets, "part").select("key", (F.col("base") + F.col("before")).alias("start"), "n_tokens", "ids_crc32", "file", "offset", "length").write.parquet(index_path)
    return spark.read.parquet(index_path)


def write_records(df: DataFrame, tokenizer: str, path: str | None = None, **options) -> tuple[str, DataFrame]:
    """``write`` and ``build_index``; returns the folder and the index read back."""
    spark = df.sparkSession
    path = path or scratch_path(spark, "records")
    write(df, f"{path}/data", tokenizer, **options)
    return path, build_index(spark, f"{path}/data", f"{path}/index")


def read_shuffled(spark: SparkSession, path: str, index: DataFrame, seed: int) -> DataFrame:
    """The records that ``index`` lists (all of it or a part), in a random order fixed by ``seed``: position, key, ids.

    Each file is opened once, beside its own index rows; a record is cut out by offset and
    length and verified. ``position`` (a keyed hash) orders the result.
    """
    wanted = index.select("file", "offset", "length", F.xxhash64("file", "offset", F.lit(seed)).alias("position"))
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    files = files.select(F.substring_index("path", "/", -1).alias("file"), "content")

    def cut(rows: pa.Table, file: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return pa.table({"position": pa.array([], pa.int64()), "key": pa.array([], pa.int64()), "ids": pa.array([], pa.list_(pa.int64()))})
        data = file["content"][0].as_buffer()
        found = []
        for at, n, position in zip(rows["offset"].to_pylist(), rows["length"].to_pylist(), rows["position"].to_pylist(), strict=True):
            ((_, _, key, ids),) = parse(data.slice(at, n).to_pybytes())
            found.append((position, key, ids.astype(np.int64)))
        position, key, ids = zip(*found, strict=True)
        return pa.table({"position": pa.array(position, pa.int64()), "key": pa.array(key, pa.int64()), "ids": pa.array(ids, pa.list_(pa.int64()))})

    out = wanted.groupBy("file").cogroup(files.groupBy("file")).applyInArrow(cut, "position long, key long, ids array<long>")
    return out.orderBy("position")
