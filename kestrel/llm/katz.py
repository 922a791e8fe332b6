"""Katz backoff language model: fit on some rows of a corpus and score all of them.

The model of order *k* counts n-grams up to *k* words, discounts counts up to 5 by Good-Turing
and backs off to the shorter context with weights that make every context's probabilities sum
to 1 exactly. One extra count per context is kept for words that never followed it, so no
probability is 0; all words unseen in training share one unknown word.

How the work is spread:

1. Texts become chunks (a few MB of text each): distinct words and token numbers, bucketed by
   chunk. Once the words are counted, the chunks are written again with each word's count and
   number in place of its hash, and the first copy goes.
2. Order by order, each chunk sends its distinct n-grams, counted, to the hash bucket of their
   context; contexts with more than ``HOT`` occurrences are dealt over several buckets by word.
   So a frequent n-gram is one row per chunk, however many documents hold it. A bucket adds up
   the counts, writes its part of the n-gram table (one packed row of contexts, words, counts
   and numbers; ``Model.table`` gives them a row each) and answers
   each chunk in the chunk's own order: counts and numbers, nothing else travels back. The
   bucket also tells a chunk which n-grams no other chunk holds: all n-grams of the highest
   order that begin with one of these are in that chunk, which counts and weighs them itself.
3. The discounts follow from the counts of counts, backoff weights from sums per context (the
   probability that discounting freed, over the lower-order probability of unseen words).
4. Each chunk evaluates every token recursively: the discounted count if its n-gram was seen,
   else the context's weight times the probability of the next shorter context.

Only counts of counts and totals reach the driver. Words and contexts are held by 64-bit hash or
dense number, so the tables hold numbers; the order-1 table has each word's hash.

Defined results: a null or empty text is just its end token; null ids are kept; repeated rows
count and are scored each; with no training rows every token has the unknown word's
probability, 1; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.session import remove_scratch, scratch_path

from .common import as_bytes, mix64, ref, release_shuffles, spans, staged, starts, sums

CHUNK_BYTES = 4 << 20
#: Tokens that a bucket of n-grams gets on average; contexts beyond HOT tokens are dealt over several buckets.
BUCKET_TOKENS, HOT = 1_500_000, 500_000
CUTOFF = 5
END, START, UNSEEN = 0, 1, 2  # hash of the end token; numbers of the start context and of all that training did not see
FIRST = 3  # first free number


def pack(values: np.ndarray) -> bytes:
    """Numbers as compressed byte planes."""
    raw = np.ascontiguousarray(values)
    planes = np.ascontiguousarray(raw.view(np.uint8).reshape(len(raw), raw.itemsize).T).tobytes()
    return len(planes).to_bytes(8, "little") + pa.compress(planes, codec="zstd", asbytes=True)


def unpack(data: bytes, dtype) -> np.ndarray:
    n, kind = int.from_bytes(data[:8], "little"), np.dtype(dtype)
    if n == 0:
        return np.zeros(0, kind)
    planes = np.frombuffer(pa.decompress(data[8:], decompressed_size=n, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(kind.itemsize, -1).T).view(kind).ravel()


def by_pair(context: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order of the (context, word) pairs that puts equal ones together by context, and where each distinct one begins in it."""
    if not len(word):
        return np.zeros(0, np.int64), np.zeros(0, bool)
    small = word.min() >= 0 and max(context.max(), word.max()) < 1 << 31
    by = np.argsort((context << 32) | word) if small else np.lexsort((word, context))
    context, word = context[by], word[by]
    return by, np.concatenate([[True], (context[1:] != context[:-1]) | (word[1:] != word[:-1])])


def _dealt(bucket: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """An order that puts the entries of each bucket together, else as they are, and where each bucket begins in it."""
    bucket = bucket.astype(np.uint16) if buckets < 1 << 16 else bucket
    by = np.argsort(bucket, kind="stable")
    return by, np.concatenate([[0], np.cumsum(np.bincount(bucket, minlength=buckets))])


def _word_buckets(words: np.ndarray, buckets: int) -> np.ndarray:
    return (mix64(words) % np.uint64(buckets)).astype(np.int64)


def _merged(order: int, bucket: np.ndarray, buckets: int, reply: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]):
    """The buckets' answers in the order of the asked n-grams: count, number, whether only this chunk holds it."""
    count, number, private = np.zeros(len(bucket), np.int64), np.full(len(bucket), UNSEEN, np.int64), np.zeros(len(bucket), bool)
    by, edge = _dealt(bucket, buckets)
    for b, (counts, ranks, own) in reply.items():
        at = by[edge[b] : edge[b + 1]]
        count[at] = counts
        if len(ranks):
            ranks = np.cumsum(ranks, dtype=np.int64) if order > 1 else ranks.astype(np.int64)
            number[at] = np.where(counts > 0, FIRST + ranks * buckets + b, UNSEEN)
        if len(own):
            private[at] = own
    return count, number, private


CHUNK_SCHEMA = "chunk long, ids array<long>, train array<boolean>, lengths array<long>, words binary, tokens binary"


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Columns id, train, text -> chunks."""
    task, number = TaskContext.get().partitionId(), 0
    for batch in batches:
        for lo, hi in spans(batch.column(2), CHUNK_BYTES):
            texts = pa.array(as_bytes(batch.column(2).slice(lo, hi - lo)), pa.large_binary())
            split = pc.ascii_split_whitespace(pc.ascii_lower(texts.cast(pa.large_string())))
            found, bounds = split.flatten().dictionary_encode(), split.offsets.to_numpy()
            vocabulary = found.dictionary.cast(pa.large_binary()).to_pylist()
            # blanks at a text's ends leave empty parts
            real = np.array([bool(w) for w in vocabulary], bool)[found.indices.to_numpy()] if len(found) else np.zeros(0, bool)
            n = sums(real, bounds)
            hashes = np.fromiter((xxhash.xxh64_intdigest(w) or 1 for w in vocabulary), np.uint64, len(vocabulary))
            hashes = np.concatenate([hashes, np.array([END], np.uint64)])
            hashes[:-1][[not w for w in vocabulary]] = END
            words, place = np.unique(hashes, return_inverse=True)
            lengths = n + 1
            tokens = np.zeros(int(lengths.sum()), np.uint32)  # place 0 is the end token
            inner = np.ones(len(tokens), bool)
            inner[np.cumsum(lengths) - 1] = False
            tokens[inner] = place[found.indices.to_numpy()[real]]
            columns = [
                pa.array([(task << 32) | number], pa.int64()),
                pa.array([batch.column(0).slice(lo, hi - lo).to_pylist()], pa.list_(pa.int64())),
                pa.array([[bool(x) for x in batch.column(1).slice(lo, hi - lo).to_pylist()]], pa.list_(pa.bool_())),
                pa.array([lengths], pa.list_(pa.int64())),
                pa.array([pack(words)], pa.binary()),
                pa.array([pack(tokens)], pa.binary()),
            ]
            number += 1
            del texts, split, found, vocabulary
            pa.default_memory_pool().release_unused()
            yield pa.RecordBatch.from_arrays(columns, names=["chunk", "ids", "train", "lengths", "words", "tokens"])


def discounts(counts_of_counts: list[int], cutoff: int = CUTOFF) -> list[float]:
    """Good-Turing discounts of the counts 1..cutoff; absolute discounting where Good-Turing has no valid one."""
    n = [0, *counts_of_counts]
    out = []
    if all(n[1 : cutoff + 2]):
        common = (cutoff + 1) * n[cutoff + 1] / n[1]
        out = [((r + 1) * n[r + 1] / n[r] / r - common) / (1 - common) if common != 1 else 0.0 for r in range(1, cutoff + 1)]
    if not out or not all(0 < d < 1 for d in out):
        cut = n[1] / (n[1] + 2 * n[2]) if n[1] and n[2] else 0.5
        out = [(r - cut) / r for r in range(1, cutoff + 1)]
    return out


@dataclass
class Level:
    """What is known of one order after its counts: plain numbers, shipped to the tasks."""

    discount: list[float]
    total: int  # tokens counted
    seen: int  # distinct n-grams counted
    unknown: float = 0.0  # order 1: probability of the unknown word

    def probability(self, count: np.ndarray, context: np.ndarray) -> np.ndarray:
        factor = np.concatenate([[0.0], self.discount, [1.0]])
        return factor[np.minimum(count, len(self.discount) + 1)] * count / (context + 1.0)


@dataclass
class Chunk:
    """One chunk's tokens with what each order has answered."""

    row: dict
    buckets: int
    train_docs: int
    levels: list[Level]
    weights: list[tuple[np.ndarray, np.ndarray]]  # contexts and their weights, of the orders from 2 on
    probability: np.ndarray = field(init=False)

    def __post_init__(self):
        self.lengths = np.array(self.row["lengths"], np.int64)
        self.tokens = unpack(self.row["tokens"], np.uint32)
        first = starts(self.lengths)[:-1]
        self.first = np.zeros(len(self.tokens), bool)
        self.first[first] = True
        self.trained = np.repeat(np.array(self.row["train"], bool), self.lengths)
        if self.levels:
            self._words()
        for order in range(2, len(self.levels) + 1):
            self._answer(order, _reply_of(self.row, order))

    def _distinct(self, at: np.ndarray):
        """Distinct n-grams of these tokens: context, word, training count, a token that has it; and each token's place."""
        by, new = by_pair(self.context[at], self.word[at])
        at = at[by]
        group = np.cumsum(new, dtype=np.int32) - 1
        place = np.full(len(self.tokens), -1, np.int32)
        place[at] = group
        one = at[new]
        return self.context[one], self.word[one], np.bincount(group[self.trained[at]], minlength=len(one)), one, place

    def grams(self, order: int):
        """Distinct n-grams of this order that are asked for: context, word, training count, counts of the n-gram without its first word and of that one's context, context count, bucket; and each token's place.

        Where training saw the n-gram, the two counts give the lower probability.
        """
        if order == 1:
            words = unpack(self.row["words"], np.uint64)
            n, none = np.bincount(self.tokens[self.trained], minlength=len(words)), np.zeros(len(words), np.int64)
            return none, words.view(np.int64), n, none, none, none, _word_buckets(words, self.buckets), self.tokens
        context, word, n, one, place = self._distinct(np.flatnonzero((self.context != UNSEEN) & ~self.owned))
        heavy = self.context_count[one]
        spread = np.maximum(1, -(-heavy // HOT)).astype(np.uint64)
        bucket = (mix64(context + 1) + mix64(word + 7) % spread) % np.uint64(self.buckets)
        return context, word, n, self.lower[one], self.above[one], heavy, bucket.astype(np.int64), place

    def own_grams(self):
        """Distinct n-grams whose context no other chunk holds: as ``_distinct`` gives them."""
        return self._distinct(np.flatnonzero((self.context != UNSEEN) & self.owned))

    def _words(self) -> None:
        level, count = self.levels[0], unpack(self.row["counts"], np.int64)
        number = np.where(count > 0, np.cumsum(unpack(self.row["numbers"], np.int64)), UNSEEN)
        self.word, self.known = number[self.tokens], count[self.tokens]
        p = level.probability(self.known, np.int64(level.total))
        self.probability = np.where(self.known > 0, p, level.unknown)
        self.context_count = np.full(len(self.tokens), level.total, np.int64)
        self._next(self.known, self.word, unpack(self.row["private"], bool)[self.tokens])

    def _answer(self, order: int, reply: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]) -> None:
        bucket, place = self.grams(order)[-2:]
        count, number, private = (np.append(x, none)[place] for x, none in zip(_merged(order, bucket, self.buckets, reply), (0, UNSEEN, False), strict=True))
        level = self.levels[order - 1]
        weight = np.ones(len(place))
        keys, values = self.weights[order - 2]
        if len(keys):
            by = np.argsort(keys)
            keys, values = keys[by], values[by]
            found = np.minimum(np.searchsorted(keys, self.context), len(keys) - 1)
            weight = np.where((place >= 0) & (keys[found] == self.context), values[found], 1.0)
        if self.owned.any():
            context, _, n, one, own_place = self.own_grams()
            group = np.cumsum(np.concatenate([[False], context[1:] != context[:-1]]))
            lower = np.where(n > 0, self.levels[order - 2].probability(self.lower[one], self.above[one]), 0.0)
            kept = np.bincount(group, weights=level.probability(n, np.int64(0))) / (np.bincount(group, weights=n) + 1)
            own_weight = (1 - kept) / np.maximum(1 - np.bincount(group, weights=lower), 1e-12)
            count = np.where(own_place >= 0, n[own_place], count)
            weight = np.where(own_place >= 0, own_weight[group][own_place], weight)
        self.probability = np.where(count > 0, level.probability(count, self.context_count), weight * self.probability)
        self._next(count, number, private)

    def _next(self, count: np.ndarray, number: np.ndarray, private: np.ndarray) -> None:
        """The next order's context is this order's n-gram that ends one token earlier."""
        self.lower, self.above = count, self.context_count
        self.context = np.where(self.first, START, np.roll(np.where(count > 0, number, UNSEEN), 1))
        self.context_count = np.where(self.first, self.train_docs, np.roll(count, 1))
        self.owned = ~self.first & np.roll(private, 1)  # no other chunk holds the context
        if not self.train_docs:
            self.context[:] = UNSEEN


def _rows_of(batch: pa.RecordBatch) -> Iterator[dict]:
    """Rows as dictionaries; lists of contexts and weights as two arrays."""
    for i in range(batch.num_rows):
        row = {}
        for name, column in zip(batch.schema.names, batch.columns, strict=True):
            one = column.slice(i, 1)
            row[name] = tuple(x.to_numpy(zero_copy_only=False) for x in one.flatten().flatten()) if name.startswith("weights") else one.to_pylist()[0]
        yield row


def _reply_of(row: dict, order: int) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    return {x["bucket"]: (unpack(x["counts"], np.int64), unpack(x["numbers"], np.int32), unpack(x["private"], bool)) for x in row[f"replies{order}"] or []}


def _chunk_of(row: dict, buckets: int, train_docs: int, levels: list[Level]) -> Chunk:
    orders = range(2, len(levels) + 1)
    return Chunk(row, buckets, train_docs, levels, [row[f"weights{order}"] for order in orders])


#: A chunk whose words are counted: by place, frequent words first, each word's count, the step from the number
#: before to its own, and whether only this chunk holds it.
COUNTED_SCHEMA = "chunk long, ids array<long>, train array<boolean>, lengths array<long>, tokens binary, counts binary, numbers binary, private binary"


def _counted(buckets: int):
    kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int64()), *[pa.binary()] * 4]
    names = [x.split()[0] for x in COUNTED_SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _rows_of(batch):
                bucket = _word_buckets(unpack(row["words"], np.uint64), buckets)
                count, number, private = _merged(1, bucket, buckets, _reply_of(row, 1))
                by = np.argsort(np.where(count > 0, number, np.iinfo(np.int64).max), kind="stable")
                place = np.empty(len(by), np.uint32)
                place[by] = np.arange(len(by))
                row["tokens"] = pack(place[unpack(row["tokens"], np.uint32)])
                row |= {"counts": pack(count[by]), "numbers": pack(np.diff(number[by], prepend=0)), "private": pack(private[by])}
                yield pa.RecordBatch.from_arrays([pa.array([row[n]], t) for n, t in zip(names, kinds, strict=True)], names=names)

    return run


REQUEST_SCHEMA = "bucket int, chunk long, contexts binary, runs binary, hot binary, above binary, words binary, counts binary, lower binary, own binary"
_ANSWER = pa.schema(
    [("kind", pa.string()), ("bucket", pa.int32()), ("chunk", pa.int64())]
    + [(c, pa.binary()) for c in ("contexts", "words", "counts", "numbers", "private")]
    + [("context", pa.int64()), ("total", pa.int64()), ("distinct", pa.int64()), ("low", pa.list_(pa.int64())), ("big", pa.int64()), ("freed", pa.float64())]
)
ANSWER_SCHEMA = (
    "kind string, bucket int, chunk long, contexts binary, words binary, counts binary, numbers binary, private binary, "
    "context long, total long, distinct long, low array<long>, big long, freed double"
)
#: One row per n-gram of a model table, as ``Model.table`` gives it. Null for n-grams that a chunk
#: counted itself: their bucket, and their number, which only a higher order would use.
GRAM_SCHEMA = "bucket int, context long, word long, count long, number long"


def _tally(total: np.ndarray) -> np.ndarray:
    """Of the counts of seen n-grams: their sum, how many there are, and how many have each count up to the one beyond the cutoff."""
    return np.concatenate([[total.sum(), len(total)], np.bincount(np.minimum(total, CUTOFF + 2), minlength=CUTOFF + 3)[1 : CUTOFF + 2]]).astype(np.int64)


def _requests(order: int, buckets: int, train_docs: int, levels: list[Level]):
    names = [x.split()[0] for x in REQUEST_SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _rows_of(batch):
                chunk = _chunk_of(row, buckets, train_docs, levels)
                context, word, n, lower, above, heavy, bucket, _ = chunk.grams(order)
                own = np.zeros(0, np.int64)
                if order > 1 and chunk.owned.any():
                    own = chunk.own_grams()[2]
                    own = _tally(own[own > 0])
                del chunk
                by, edge = _dealt(bucket, buckets)
                out = []
                for b in np.flatnonzero(np.diff(edge)) if len(by) else [0]:  # somebody has to hear of own n-grams
                    at = by[edge[b] : edge[b + 1]]
                    new = at[np.concatenate([[True], context[at][1:] != context[at][:-1]])] if len(at) else at
                    runs = np.diff(np.append(np.searchsorted(context[at], context[new]), len(at)))
                    out.append((
                        int(b), row["chunk"], pack(np.diff(context[new], prepend=0)), pack(runs), pack(heavy[new] > HOT), pack(above[new]),
                        pack(word[at]), pack(n[at].astype(np.int32)), pack(lower[at]), pack(own),
                    ))
                    own = own[:0]
                del context, word, n, lower, above, heavy, bucket, by
                pa.default_memory_pool().release_unused()
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if i == 0 else pa.int64() if i == 1 else pa.binary()) for i, c in enumerate(zip(*out, strict=True))], names=names)

    return run


def _frame(**columns) -> pa.Table:
    n = len(next(iter(columns.values())))
    return pa.table([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in _ANSWER], schema=_ANSWER)


def _count(order: int, buckets: int, numbered: bool, private: bool, levels: list[Level]):
    """numbered: the chunks get the numbers; private: they also hear which n-grams no other chunk holds."""

    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        bucket = rows[0]["bucket"]
        words = [unpack(r["words"], np.int64) for r in rows]
        runs = [unpack(r["runs"], np.int64) for r in rows]
        context = np.concatenate([np.repeat(np.cumsum(unpack(r["contexts"], np.int64)), n) for r, n in zip(rows, runs, strict=True)])
        hot = np.concatenate([np.repeat(unpack(r["hot"], bool), n) for r, n in zip(rows, runs, strict=True)])
        n = np.concatenate([unpack(r["counts"], np.int32) for r in rows])
        edges = np.concatenate([[0], np.cumsum([len(w) for w in words])])
        word = np.concatenate(words)
        del words
        by, new = by_pair(context, word)
        group = np.empty(len(by), np.int32)
        group[by] = np.cumsum(new, dtype=np.int32) - 1
        total = np.bincount(group, weights=n).astype(np.int64)
        one = by[new]
        del by, new, n
        seen = total > 0
        # words are numbered by falling count, as frequent ones then get small numbers, which pack well; higher orders
        # in the order of the n-grams, so that a chunk's ranks ascend and their differences are small
        at = np.flatnonzero(seen)
        if order == 1:
            rank = np.zeros(len(total), np.int32)
            rank[at[np.argsort(-total[at], kind="stable")]] = np.arange(len(at))
        else:
            rank = np.maximum(np.cumsum(seen, dtype=np.int32) - 1, 0)
        out = []
        parts = [group[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)]
        counts = [pack(total[g]) for g in parts]
        numbers = [pack((np.diff(rank[g], prepend=np.int32(0)) if order > 1 else rank[g]) if numbered else rank[:0]) for g in parts]
        alone = seen & (np.bincount(group, minlength=len(total)) == 1) if private else seen[:0]
        privates = [pack(alone[g] if private else alone) for g in parts]
        out.append(_frame(kind=["reply"] * len(rows), bucket=[bucket] * len(rows), chunk=[r["chunk"] for r in rows], counts=counts, numbers=numbers, private=privates))
        # the ranks of higher orders are the places in this row
        ranks = rank[at] if order == 1 else rank[:0]
        out.append(_frame(kind=["gram"], bucket=[bucket], contexts=[pack(context[one[at]])], words=[pack(word[one[at]])], counts=[pack(total[at])], numbers=[pack(ranks)]))
        tally = np.sum([_tally(total[at]), *[x for r in rows if len(x := unpack(r["own"], np.int64))]], axis=0)
        out.append(_frame(kind=["total"], bucket=[bucket], total=tally[:1], distinct=tally[1:2], low=[tally[2:]]))
        if order > 1:
            missed = np.flatnonzero(total[group] == 0)
            if len(missed):
                sender = np.searchsorted(edges, missed, side="right") - 1
                pairs = np.unique(np.column_stack([sender, context[missed]]), axis=0)
                out.append(_frame(kind=["need"] * len(pairs), bucket=np.full(len(pairs), bucket, np.int32), chunk=np.array([r["chunk"] for r in rows])[pairs[:, 0]], context=pairs[:, 1]))
            # sums of the contexts that somebody needs; a hot context lies in several buckets, and some other may need it
            wanted = np.unique(np.concatenate([context[missed], context[hot]]))
            g_context = context[one]
            g_at = np.searchsorted(wanted, g_context)
            take = seen & (g_at < len(wanted)) & (wanted[np.minimum(g_at, max(len(wanted) - 1, 0))] == g_context) if len(wanted) else np.zeros(len(one), bool)
            if take.any():
                g_at, c = g_at[take], total[take]
                above = np.concatenate([np.repeat(unpack(r["above"], np.int64), n) for r, n in zip(rows, runs, strict=True)])[one[take]]
                lower = np.concatenate([unpack(r["lower"], np.int64) for r in rows])[one[take]]
                p = levels[order - 2].probability(lower, above)
                cells = np.bincount(g_at * (CUTOFF + 1) + np.minimum(c, CUTOFF + 1) - 1, minlength=len(wanted) * (CUTOFF + 1)).reshape(-1, CUTOFF + 1)[:, :CUTOFF]
                big = np.bincount(g_at, weights=np.where(c > CUTOFF, c, 0), minlength=len(wanted)).astype(np.int64)
                freed = np.bincount(g_at, weights=p, minlength=len(wanted))
                low = pa.ListArray.from_arrays(pa.array(np.arange(len(wanted) + 1) * CUTOFF, pa.int32()), pa.array(cells.ravel(), pa.int64()))
                out.append(_frame(kind=["context"] * len(wanted), bucket=np.full(len(wanted), bucket, np.int32), context=wanted, low=low, big=big, freed=freed))
        return pa.concat_tables(out)

    return run


@dataclass
class Model:
    """The fitted model: n-gram tables by order, packed one row per bucket of contexts, their levels, and the chunks.

    The chunks hold the n-grams of the highest order whose context no other chunk has.
    """

    parts: list[DataFrame]
    levels: list[Level]
    chunks: DataFrame
    buckets: int
    train_docs: int
    name: str  # of the chunks' bucketed table

    def close(self) -> None:
        """Take the chunks' table out of the catalog; call it when the scores are written."""
        self.chunks.sparkSession.sql(f"DROP TABLE IF EXISTS {self.name}")

    def table(self, order: int) -> DataFrame:
        """The n-grams of one order, a row each: bucket, context, word, count, number."""
        names, buckets, train_docs = [x.split()[0] for x in GRAM_SCHEMA.split(", ")], self.buckets, self.train_docs
        types, below = [pa.int32(), *[pa.int64()] * 4], self.levels[: order - 1]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in _rows_of(batch):
                    context, word, count = (unpack(row[c], np.int64) for c in ("contexts", "words", "counts"))
                    rank = unpack(row["numbers"], np.int32).astype(np.int64) if order == 1 else np.arange(len(word))
                    columns = np.full(len(word), row["bucket"]), context, word, count, FIRST + rank * buckets + row["bucket"]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

        def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in _rows_of(batch):
                    context, word, count, *_ = _chunk_of(row, buckets, train_docs, below).own_grams()
                    columns = [x[count > 0] for x in (context, word, count)]
                    null = [pa.nulls(len(columns[0]), t) for t in (types[0], types[-1])]
                    yield pa.RecordBatch.from_arrays([null[0], *[pa.array(c, pa.int64()) for c in columns], null[1]], names=names)

        rows = self.parts[order - 1].mapInArrow(run, GRAM_SCHEMA)
        return rows.unionByName(self.chunks.mapInArrow(own, GRAM_SCHEMA)) if 1 < order == len(self.levels) else rows


@contextmanager
def _shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Spark deletes the shuffle files of each query in this block when it ends, not when the driver's garbage is collected."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def _bucketed(chunks: DataFrame, parts: int) -> tuple[str, str]:
    """Writes chunks as a table in ``parts`` buckets: its name and folder."""
    name, path = f"lm_chunks_{uuid.uuid4().hex[:12]}", scratch_path(chunks.sparkSession, "lm-chunks")
    with _shuffles_dropped(chunks.sparkSession):
        chunks.write.bucketBy(parts, "chunk").option("path", path).saveAsTable(name)
    return name, path


def fit(df: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text", order: int = 2, bucket_tokens: int = BUCKET_TOKENS) -> Model:
    """Counts n-grams of the rows where ``train`` holds and prepares all rows of ``df`` for scoring."""
    spark = df.sparkSession
    rows = df.select(ref(id_col).cast("long").alias("id"), F.coalesce(train, F.lit(False)).alias("train"), ref(text_col).alias("text"))
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    name, path = _bucketed(rows.mapInArrow(_chunks, CHUNK_SCHEMA), parts)
    chunks = spark.table(name)
    sums = chunks.agg(
        F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x)), F.sum(F.size(F.filter("train", lambda x: x)))
    ).first()
    buckets, train_docs = max(1, -(-int(sums[0] or 0) // bucket_tokens)), int(sums[1] or 0)
    levels: list[Level] = []
    tables: list[DataFrame] = []  # packed
    for k in range(1, order + 1):
        asked = chunks.mapInArrow(_requests(k, buckets, train_docs, list(levels)), REQUEST_SCHEMA)
        counted = asked.groupBy("bucket").applyInArrow(_count(k, buckets, k < order, k == order - 1, list(levels)), ANSWER_SCHEMA)
        with _shuffles_dropped(spark):
            answers = staged(counted, f"lm-order{k}")
        release_shuffles(spark)
        totals = answers.where("kind = 'total'").agg(F.sum("total"), F.sum("distinct"), *[F.sum(F.get("low", i)) for i in range(CUTOFF + 1)]).first()
        low = [int(x or 0) for x in totals[2:]]
        level = Level(discounts(low), int(totals[0] or 0), int(totals[1] or 0))
        if k == 1:
            used = level.total - sum(r * n * (1 - d) for r, (n, d) in enumerate(zip(low, level.discount, strict=False), 1))
            level.unknown = 1 - used / (level.total + 1)
        levels.append(level)
        tables.append(answers.where("kind = 'gram'").select("bucket", "contexts", "words", "counts", "numbers"))
        # dealt like the bucketed chunks, whose tokens so never move
        replies = answers.where("kind = 'reply'").repartition(parts, "chunk").groupBy("chunk")
        replies = replies.agg(F.collect_list(F.struct("bucket", "counts", "numbers", "private")).alias(f"replies{k}"))
        chunks = chunks.join(replies.hint("merge"), "chunk", "left")
        if k == 1:
            hashed, hashes = name, path
            name, path = _bucketed(chunks.mapInArrow(_counted(buckets), COUNTED_SCHEMA), parts)
            spark.sql(f"DROP TABLE IF EXISTS {hashed}")
            remove_scratch(spark, hashes)
            release_shuffles(spark)
            chunks = spark.table(name)
        else:
            chunks = chunks.join(_weights(answers, level, k, parts).hint("merge"), "chunk", "left")
    return Model(tables, levels, chunks, buckets, train_docs, name)


def _weights(answers: DataFrame, level: Level, k: int, parts: int) -> DataFrame:
    """(chunk, weights): the backoff weights that the chunk needs."""
    sums = answers.where("kind = 'context'").groupBy("context").agg(
        *[F.sum(F.get("low", i)).alias(f"n{i + 1}") for i in range(CUTOFF)], F.sum("big").alias("big"), F.sum("freed").alias("freed")
    )
    count, kept = F.col("big"), F.col("big").cast("double")
    for r, d in enumerate(level.discount, 1):
        count, kept = count + r * F.col(f"n{r}"), kept + r * d * F.col(f"n{r}")
    weight = (1 - kept / (count + 1)) / F.greatest(1 - F.col("freed"), F.lit(1e-12))
    weights = sums.select("context", weight.alias("weight"))
    need = answers.where("kind = 'need'").select("chunk", "context").distinct()
    return need.join(weights, "context").repartition(parts, "chunk").groupBy("chunk").agg(F.collect_list(F.struct("context", "weight")).alias(f"weights{k}"))


SCORE_SCHEMA = "id long, train boolean, n_tokens long, n_known long, base_score double, score double"


def score(model: Model) -> DataFrame:
    """One row per row of the corpus: id, train, n_tokens, n_known, base_score (add-0.1 unigrams) and score (log10 probability)."""
    levels, buckets, train_docs = model.levels, model.buckets, model.train_docs
    names = [x.split()[0] for x in SCORE_SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _rows_of(batch):
                chunk = _chunk_of(row, buckets, train_docs, levels)
                first = starts(chunk.lengths)[:-1]
                total = lambda x: np.add.reduceat(x, first)  # noqa: E731  every text has its end token
                base = np.log10((chunk.known + 0.1) / (levels[0].total + 0.1 * (levels[0].seen + 1)))
                columns = [row["ids"], row["train"], chunk.lengths, total((chunk.known > 0).astype(np.int64)), total(base), total(np.log10(chunk.probability))]
                types = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
                del chunk, base  # before the next one is built
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    return model.chunks.mapInArrow(run, SCORE_SCHEMA)
