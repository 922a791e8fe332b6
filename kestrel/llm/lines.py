"""Line dedup by site-relative frequency. DataFrame functions only.

A line's frequency on a site is the number of the site's pages that contain it, divided by
the site's number of pages. Lines above ``ratio`` that occur on more than one page of a site
are boilerplate there and are dropped from all its pages; the same line elsewhere stays.

Pages are reduced to distinct lines and pre-aggregated before the shuffle. A site has at most
(distinct lines of its mean page) / ``ratio`` boilerplate lines, so one small row per site goes
back to the pages: page texts are never shuffled line by line and put together again.

Defined results: null texts have no lines and an empty text; null hosts form one site; lines are
compared trimmed, empty lines are dropped; repeated rows count as pages of their own; an empty
table gives an empty result; all input columns but the dropped ones pass through, and the result's
columns get leading underscores where an input column has their name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, ref, staged

RATIO = 0.2

#: Elements that begin a new line; fixed values.
BLOCK_TAGS = "address|article|aside|blockquote|body|br|dd|div|dl|dt|fieldset|figcaption|figure|footer|form|h[1-6]|head|header|hr|html|li|main|meta|nav|ol|option|p|pre|section|select|table|tbody|td|tfoot|th|thead|title|tr|ul"
HIDDEN = r"(?is)<script\b.*?(</script\s*>|\z)|<style\b.*?(</style\s*>|\z)|<!--.*?(-->|\z)"
BREAKS = rf"(?i)</?({BLOCK_TAGS})\b[^<>]*>"
TAGS = r"<[^<>]*>"


def html_lines(html: Column) -> Column:
    """The trimmed, non-empty lines of a page's visible text."""
    text = F.regexp_replace(F.regexp_replace(F.regexp_replace(html, HIDDEN, ""), BREAKS, "\n"), TAGS, "")
    return text_lines(text)


def text_lines(text: Column) -> Column:
    lines = F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: F.trim(x, F.lit(" \t\r\x0b\x0c")))
    return F.filter(lines, lambda x: x != "")


def boilerplate(pages: DataFrame, host_col: str, lines_col: str, ratio: float = RATIO) -> DataFrame:
    """(site, drop): each site's boilerplate lines."""
    host = ref(host_col).alias("site")
    total = pages.groupBy(host).agg(F.count("*").alias("pages"))
    on = pages.select(host, F.explode(F.array_distinct(ref(lines_col))).alias("line")).groupBy("site", "line").agg(F.count("*").alias("n"))
    total = total.withColumnRenamed("site", "t_site")
    often = on.where("n > 1").join(total, F.col("site").eqNullSafe(F.col("t_site"))).where(F.col("n") > ratio * F.col("pages"))
    return often.groupBy("site").agg(F.collect_set("line").alias("drop"))


def drop_boilerplate(df: DataFrame, lines: Column, host: Column, drop_cols: tuple[str, ...] = (), ratio: float = RATIO) -> DataFrame:
    """``df`` less ``drop_cols`` plus clean_text, n_lines, n_dropped."""
    rest = [c for c in df.columns if c not in drop_cols]
    clean, n_lines, n_dropped = fresh(df.select(*[ref(c) for c in rest]), "clean_text", "n_lines", "n_dropped")
    site, own, key, gone = fresh(df, "ld_site", "ld_lines", "ld_key", "ld_drop")
    keyed = df.withColumn(site, host).withColumn(own, lines)
    found = staged(boilerplate(keyed.select(ref(site), ref(own)), site, own, ratio), "boilerplate").toDF(key, gone)
    rows = keyed.join(found, ref(site).eqNullSafe(ref(key)), "left")
    kept = F.filter(ref(own), lambda x: F.coalesce(~F.array_contains(ref(gone), x), F.lit(True)))
    rows = rows.withColumn(gone, kept)
    return rows.select(
        *[ref(c) for c in rest],
        F.array_join(ref(gone), "\n").alias(clean),
        F.size(ref(own)).cast("long").alias(n_lines),
        (F.size(ref(own)) - F.size(ref(gone))).cast("long").alias(n_dropped),
    )
