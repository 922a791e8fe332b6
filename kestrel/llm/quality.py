"""Quality rules as a bitmask ledger.

``ledger`` measures every text once and evaluates every rule once: a row keeps
its measurements and one ``long`` whose bit *i* is set if rule *i* failed.
Policies (versioned sets of rules) are then bitwise tests on that number, and
``ablations`` counts, for each rule of a policy, what only that rule rejects by
aggregating the bit patterns: no text is read again.

Defined results: a null text counts as empty; an empty text has all measures 0
and fails ``few_words``; repeated rows get equal rows; an empty table gives an
empty ledger; where an input column has the name of a ledger column, the input's
stays and the ledger's gets leading underscores.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import BLOCK, as_bytes, blocks, fresh, mix64, ref, spans, split_words, starts, sums

WINDOW = 8
MEASURES = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_lines",
    "n_dup_lines",
    "n_repeat_words",
    "n_stutter",
    "n_upper",
    "n_digits",
    "n_marks",
)

_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True


def _set(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


_BYTE_SETS = {
    # first bytes of code points outside blanks
    "word_chars": ((np.arange(256) & 0xC0) != 0x80) & ~_BLANK,
    "n_symbols": _set(b"#*$%&|<>"),
    "n_upper": _set(bytes(range(0x41, 0x5B))),
    "n_digits": _set(b"0123456789"),
    "n_marks": _set(b"!?"),
}


@dataclass(frozen=True)
class Rule:
    """``failed`` is a Spark SQL condition on the measures."""

    name: str
    failed: str


#: Bit i belongs to the i-th rule. New rules go to the end: stored bits stay valid.
RULES = (
    Rule("few_words", "n_words < 20"),
    Rule("repeated_windows", "100 * n_repeat_words > 30 * n_words"),
    Rule("mean_word_short", "word_chars < 2 * n_words"),
    Rule("mean_word_long", "word_chars > 15 * n_words"),
    Rule("symbols", "10 * n_symbols > n_words"),
    Rule("dup_lines", "2 * n_dup_lines > n_lines"),
    Rule("upper_case", "2 * n_upper > word_chars"),
    Rule("digits", "2 * n_digits > word_chars"),
    Rule("shouting", "100 * n_marks > 50 * n_words"),
    Rule("stutter", "2 * n_stutter > n_words"),
    Rule("too_many_words", "n_words > 10000000"),
)

#: Policies by version: the rules that reject a document.
POLICIES = {
    "base": ("few_words", "repeated_windows"),
    "v1": ("few_words", "repeated_windows", "mean_word_short", "mean_word_long", "symbols", "dup_lines"),
    "v2": tuple(r.name for r in RULES if r.name != "too_many_words"),
}


def _repeats(words: list[bytes], bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per text: words in a window of 8 words found twice or more in it; words equal to the word before."""
    n = len(words)
    if n < 2:
        return np.zeros(len(bounds) - 1, np.int64), np.zeros(len(bounds) - 1, np.int64)
    ids = pa.array(words, pa.binary()).dictionary_encode().indices.to_numpy().astype(np.int64)
    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    stutter = sums(np.concatenate([[False], (ids[1:] == ids[:-1]) & (doc[1:] == doc[:-1])]), bounds)
    if n < WINDOW:
        return np.zeros(len(bounds) - 1, np.int64), stutter
    at = np.flatnonzero(doc[: n - WINDOW + 1] == doc[WINDOW - 1 :])  # windows inside one text
    h = mix64(ids + 1)
    for width, factor in ((1, 0x9E3779B97F4A7C15), (2, 0xC2B2AE3D27D4EB4F), (4, 0x165667B19E3779F9)):
        h = mix64(h[: len(h) - width] * np.uint64(factor) + h[width:])
    key = mix64(h[at] + mix64(doc[at] + 1))
    order = np.argsort(key, kind="stable")
    key, at = key[order], at[order]
    same = np.concatenate([[False], key[1:] == key[:-1]])
    # equal hashes are compared word by word with the one before
    pairs = np.flatnonzero(same)
    a, b = at[pairs - 1], at[pairs]
    equal = doc[a] == doc[b]
    for i in range(WINDOW):
        equal &= ids[a + i] == ids[b + i]
    if not equal.all():  # two different windows with one hash: compare the windows themselves
        rows = np.column_stack([doc[at], *(ids[at + i] for i in range(WINDOW))])
        _, inverse, count = np.unique(rows, axis=0, return_inverse=True, return_counts=True)
        found = count[inverse.ravel()] > 1
    else:
        found = same.copy()
        found[:-1] |= same[1:]
    edge = np.zeros(n + WINDOW, np.int64)
    np.add.at(edge, at[found], 1)
    np.add.at(edge, at[found] + WINDOW, -1)
    return sums(np.cumsum(edge)[:n] > 0, bounds), stutter


def measure(texts: list[bytes]) -> dict[str, np.ndarray]:
    """The measures of each text; exact for whole texts of any length."""
    out: dict[str, list[np.ndarray]] = {name: [] for name in MEASURES}
    for lo, hi in blocks(texts):
        part = texts[lo:hi]
        raw = np.frombuffer(b"".join(part), np.uint8)
        at = starts(np.fromiter(map(len, part), np.int64, len(part)))
        for name, members in _BYTE_SETS.items():
            out[name].append(sums(members[raw], at))
        words, n_words = split_words(part)
        out["n_words"].append(n_words)
        repeated, stutter = _repeats(words, starts(n_words))
        out["n_repeat_words"].append(repeated)
        out["n_stutter"].append(stutter)
        lines = [[x for x in t.split(b"\n") if x.strip()] for t in part]
        out["n_lines"].append(np.array([len(x) for x in lines], np.int64))
        out["n_dup_lines"].append(np.array([len(x) - len(set(x)) for x in lines], np.int64))
    return {name: np.concatenate(parts) if parts else np.zeros(0, np.int64) for name, parts in out.items()}


def _measure_batches(text_col: str, keep: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text_col)
            kept = [j for j, name in enumerate(batch.schema.names) if name in keep]
            for lo, hi in spans(batch.column(at), BLOCK):
                part = batch.slice(lo, hi - lo)
                found = measure(as_bytes(part.column(at)))
                yield pa.RecordBatch.from_arrays(
                    [part.column(j) for j in kept] + [pa.array(found[m], pa.int64()) for m in MEASURES],
                    names=[batch.schema.names[j] for j in kept] + list(MEASURES),
                )

    return run


def bits(rules=RULES) -> Column:
    """One long: bit i is set if rule i failed."""
    out = F.lit(0).cast("long")
    for i, rule in enumerate(rules):
        out = out.bitwiseOR(F.when(F.expr(rule.failed), F.lit(1 << i)).otherwise(F.lit(0)).cast("long"))
    return out


def ledger(df: DataFrame, text_col: str = "text", keep: list[str] | None = None, rules=RULES) -> DataFrame:
    """Columns ``keep`` (default: all but the text), the measures, and (last) ``failed_bits``."""
    keep = [c for c in df.columns if c != text_col] if keep is None else keep
    inner = [f"kept_{i}" for i in range(len(keep))]
    rows = df.select(*[ref(c).alias(i) for c, i in zip(keep, inner, strict=True)], ref(text_col).alias("ledger_text"))
    schema = T.StructType([*rows.schema.fields[:-1], *(T.StructField(m, T.LongType()) for m in MEASURES)])
    measured = rows.mapInArrow(_measure_batches("ledger_text", inner), schema).withColumn("failed_bits", bits(rules))
    return measured.toDF(*keep, *fresh(df.select(*[ref(c) for c in keep]), *MEASURES, "failed_bits"))


def mask(policy: str | tuple[str, ...], rules=RULES) -> int:
    names = POLICIES[policy] if isinstance(policy, str) else policy
    index = {r.name: i for i, r in enumerate(rules)}
    return sum(1 << index[n] for n in names)


def passes(policy: str | tuple[str, ...], failed_bits: str = "failed_bits", rules=RULES) -> Column:
    """True if no rule of the policy failed."""
    return ref(failed_bits).bitwiseAND(F.lit(mask(policy, rules)).cast("long")) == 0


def ablations(rows: DataFrame, policy: str, rules=RULES) -> DataFrame:
    """Per rule of the policy: documents that fail it, that fail nothing else, and that the policy keeps without it.

    Rows are first counted by bit pattern (at most 2 to the number of rules), so
    the shuffle carries patterns, not documents.
    """
    whole = mask(policy, rules)
    names = POLICIES[policy]
    index = {r.name: i for i, r in enumerate(rules)}
    patterns = rows.groupBy(ref("failed_bits").bitwiseAND(F.lit(whole).cast("long")).alias("p")).agg(F.count("*").alias("n"))
    each = F.explode(F.array(*[F.struct(F.lit(x).alias("rule"), F.lit(1 << index[x]).cast("long").alias("bit")) for x in names]))
    return (
        patterns.select("p", "n", each.alias("r"))
        .groupBy("r.rule")
        .agg(
            F.sum(F.when(F.col("p").bitwiseAND(F.col("r.bit")) != 0, F.col("n")).otherwise(0)).alias("failed"),
            F.sum(F.when(F.col("p") == F.col("r.bit"), F.col("n")).otherwise(0)).alias("failed_only"),
            F.sum(F.when(F.col("p").bitwiseAND(F.lit(whole).cast("long") - F.col("r.bit")) == 0, F.col("n")).otherwise(0)).alias("kept_without"),
        )
    )
