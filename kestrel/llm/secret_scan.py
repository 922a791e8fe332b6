"""Secret scans: fixed patterns, and character Markov models of random strings and identifiers.
DataFrame functions only.

Base spans come from three patterns (``assign``, ``access``, ``hex``). The method then looks at the
rest of the text: every run of at least ``SHORTEST`` characters of ``[A-Za-z0-9+/_=-]`` is scored by
two first-order Markov models of its characters, one trained on random strings, one on ordinary
identifiers. A run is a ``random`` span if the log-likelihood ratio is at least ``MARGIN``.

The models are trained from labelled samples: counts of character pairs per label, grouped by Spark;
the driver receives at most 2 x 128 x 128 counts. ``samples`` labels strings of documents: values of
base spans and digests are random; words, decimal numbers and words joined as in identifiers are
ordinary.
It takes about ``SAMPLE_ROWS`` documents, chosen by a hash of their text; scanning covers all text.

Offsets are code points, ends exclusive. Matches and the pieces between them give the offsets, so a
text is cut by each pattern once and only if it has a match at all.

Defined results: null and empty texts have no spans; matches are leftmost and do not overlap within
a kind, kinds may overlap; runs longer than ``LONGEST`` are judged in consecutive parts, a short rest
with the part before it; the runs are taken with the base spans blanked out in the order of the
kinds; without samples of both labels no run is random; repeated rows each have their spans; an empty
table gives an empty result; all columns pass through, and ``spans`` gets leading underscores where
a column has its name.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, ref

#: The base patterns, the group that must reach a length, and that length.
BASE = {
    "assign": (r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    "access": (r"AKIA[A-Z0-9]+", 0, 16),
    "hex": (r"[0-9a-f]{32,}", 0, 32),
}
#: What every match of ``assign`` contains: a keyword's last letter and the sign after it. Far cheaper to look for.
SIGN = r"""[dtnyDTNY]["']?\x20*[:=]"""
KINDS = [*BASE, "random"]
SHORTEST, LONGEST = 16, 256
_RUN = "[A-Za-z0-9+/_=-]"
RUNS = f"{_RUN}{{{SHORTEST},{LONGEST}}}(?:{_RUN}{{1,{SHORTEST - 1}}}(?!{_RUN}))?"
#: Natural logarithm of the odds from which a run counts as random.
MARGIN = 10.0
SAMPLE_ROWS = 2_000
CODES = 128
MATCH = "array<struct<start:bigint,end:bigint,value:string>>"


@dataclass
class Model:
    """Log-likelihood ratio (random to ordinary) of each pair of character codes, row by row."""

    ratio: list[float]


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, also inside lambdas."""
    return F.transform(F.array(value), use)[0]


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda a, v: a + v)


def running(sizes: Column, block: int = 256) -> Column:
    """For each number, the sum of those before it; by blocks, so that long arrays take no square of steps."""

    def of_blocks(parts: Column) -> Column:
        def of_block(sums: Column) -> Column:
            return F.flatten(F.transform(parts, lambda part, b: _let(_total(F.slice(sums, F.lit(1), b)), lambda start: F.transform(part, lambda _, i: start + _total(F.slice(part, F.lit(1), i))))))

        return _let(F.transform(parts, _total), of_block)

    def cut(values: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(values), F.lit(block))
        return F.when(F.size(values) > 0, _let(F.transform(starts, lambda s: F.slice(values, s, F.lit(block))), of_blocks)).otherwise(F.array().cast("array<bigint>"))

    return _let(sizes, cut)


def matches(text: Column, pattern: str, group: int = 0, least: int = 0) -> Column:
    """All leftmost non-overlapping matches whose ``group`` has ``least`` characters: start, end, value (the group)."""
    found, value = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    gaps = F.transform(F.split(text, pattern), F.length)
    parts = F.zip_with(F.zip_with(F.slice(gaps, F.lit(1), F.size(found)), found, lambda g, m: F.struct(g.cast("long").alias("gap"), F.length(m).cast("long").alias("size"))), value, lambda p, v: F.struct(p["gap"].alias("gap"), p["size"].alias("size"), v.alias("value")))

    def place(p: Column) -> Column:
        before = running(F.transform(p, lambda x: x["gap"] + x["size"]))
        placed = F.zip_with(before, p, lambda b, x: F.struct((b + x["gap"]).alias("start"), (b + x["gap"] + x["size"]).alias("end"), x["value"].alias("value")))
        return F.filter(placed, lambda m: F.length(m["value"]) >= least)

    some = text.rlike(pattern)
    if pattern == BASE["assign"][0]:
        some = text.rlike(SIGN) & some
    return F.when(some, _let(parts, place)).otherwise(F.array().cast(MATCH))


def blank(text: Column, some: Column, pattern: str, group: int = 0, least: int = 0) -> Column:
    """``text`` with every match of :func:`matches` overwritten by blanks, if there is ``some``."""
    found, value = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    shown = F.zip_with(found, value, lambda m, v: F.when(F.length(v) >= least, F.repeat(F.lit(" "), F.length(m))).otherwise(m))
    # the last piece has no match after it
    joined = F.array_join(F.zip_with(F.split(text, pattern), shown, lambda piece, m: F.concat(piece, F.coalesce(m, F.lit("")))), "")
    return F.when(some, joined).otherwise(text)


def _codes(text: Column) -> Column:
    return F.transform(F.regexp_extract_all(text, F.lit("[\\x01-\\x7f]"), F.lit(0)), lambda c: F.ascii(c))


def samples(docs: DataFrame, text: str = "text", rows: int = SAMPLE_ROWS) -> DataFrame:
    """Labelled strings (text, random) of about ``rows`` documents."""
    total = docs.count()
    share = min(1.0, rows / total) if total else 1.0
    part = docs.select(F.coalesce(ref(text), F.lit("")).alias("t")).where(F.pmod(F.xxhash64("t"), F.lit(1 << 20)) < int(share * (1 << 20)))
    part = part.select("t", *[matches(F.col("t"), *kind).alias(c) for c, kind in BASE.items()], F.col("t").alias("rest"))
    for c, kind in BASE.items():
        part = part.withColumn("rest", blank(F.col("rest"), F.size(c) > 0, *kind))
    secrets = [F.transform(c, lambda m: m["value"]) for c in BASE]
    sha = F.sha2("t", 256)
    random = F.concat(*secrets, F.array(sha, F.upper(sha), F.base64(F.unhex(sha))))
    number = F.abs(F.xxhash64("t")).cast("string")  # account, card and serial numbers are identifiers
    words = F.regexp_extract_all("rest", F.lit(r"(?<![A-Za-z0-9])(?:[A-Za-z]+|[0-9]+)(?![A-Za-z0-9])"), F.lit(0))

    def ordinary(w: Column) -> Column:
        after = F.slice(w, F.lit(2), F.size(w))
        signs = F.split(F.lit("_,-,/,=,+"), ",")
        joined = F.zip_with(F.slice(w, F.lit(1), F.size(after)), after, lambda a, b: F.array(F.concat(a, F.initcap(b)), F.concat(a, F.get(signs, F.pmod(F.length(a) + F.length(b), F.lit(5))), b), F.upper(a)))
        return F.concat(w, F.flatten(joined), F.array(number))

    labelled = part.select(F.explode(F.array(F.struct(random.alias("s"), F.lit(True).alias("random")), F.struct(_let(words, ordinary).alias("s"), F.lit(False).alias("random")))).alias("x"))
    # in two steps: a row of the explode must not carry the whole array along
    return labelled.select("x.s", "x.random").select(F.explode("s").alias("text"), "random")


def train(labelled: DataFrame, text: str = "text", random: str = "random", smoothing: float = 0.5) -> Model | None:
    """The two models' log ratio; None without samples of both labels."""
    strings = labelled.groupBy(ref(text).alias("s"), ref(random).alias("random")).agg(F.count("*").alias("n"))
    codes = strings.select("random", "n", _codes(F.col("s")).alias("c"))
    pairs = F.zip_with(F.concat(F.array(F.lit(0)), F.slice("c", F.lit(1), F.size("c") - 1)), F.col("c"), lambda a, b: a * CODES + b)
    counts = codes.where(F.size("c") > 0).select("random", "n", F.explode(pairs).alias("pair")).groupBy("random", "pair").agg(F.sum("n").alias("n")).collect()
    seen: dict[bool, list[float]] = {True: [0.0] * CODES**2, False: [0.0] * CODES**2}
    for r in counts:
        seen[r["random"]][r["pair"]] += r["n"]
    used = {r["pair"] % CODES for r in counts}
    if {r["random"] for r in counts} != {True, False}:
        return None

    def logs(n: list[float]) -> list[float]:
        out = []
        for row in range(0, CODES**2, CODES):
            whole = math.log(sum(n[row : row + CODES]) + smoothing * len(used))
            out += [math.log(x + smoothing) - whole for x in n[row : row + CODES]]
        return out

    return Model([a - b for a, b in zip(logs(seen[True]), logs(seen[False]), strict=True)])


def score(text: Column, model: Model) -> Column:
    """The log-likelihood ratio of a string: above 0 it is more like a random string."""
    ratio = F.split(F.lit(",".join(f"{x:.6g}" for x in model.ratio)), ",").cast("array<double>")
    start = F.struct(F.lit(0).alias("prev"), F.lit(0.0).alias("sum"))

    def add(acc: Column, code: Column) -> Column:
        return F.struct(code.alias("prev"), (acc["sum"] + F.get(ratio, acc["prev"] * CODES + code)).alias("sum"))

    return F.aggregate(_codes(text), start, add, lambda acc: acc["sum"])


def scan(df: DataFrame, model: Model | None, text: str = "text", margin: float = MARGIN) -> DataFrame:
    """``df`` plus spans: array of start, rank (place in ``KINDS``), end, kind, by start and rank."""
    (spans,) = fresh(df, "spans")
    body, rest, *base = fresh(df, "ss_text", "ss_rest", *[f"ss_{k}" for k in BASE])
    rows = df.withColumn(body, F.coalesce(ref(text), F.lit("")))
    rows = rows.select("*", *[matches(F.col(body), *BASE[k]).alias(c) for k, c in zip(BASE, base, strict=True)], F.col(body).alias(rest))
    for c, kind in zip(base, BASE.values(), strict=True):
        # blanks make no new match, so a text without matches of a kind has none now
        rows = rows.withColumn(rest, blank(F.col(rest), F.size(c) > 0, *kind))
    runs = F.array().cast(MATCH)
    if model is not None:
        runs = F.filter(matches(F.col(rest), RUNS), lambda m: score(m["value"], model) >= margin)

    def listed(found: Column, rank: int) -> Column:
        return F.transform(found, lambda m: F.struct(m["start"].alias("start"), F.lit(rank).alias("rank"), m["end"].alias("end"), F.lit(KINDS[rank]).alias("kind")))

    every = F.concat(*[listed(F.col(c), i) for i, c in enumerate(base)], listed(runs, len(base)))
    return rows.withColumn(spans, F.sort_array(every)).drop(body, rest, *base)


def written(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
