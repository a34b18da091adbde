"""Line dedup by site-relative frequency.

Pages are grouped by site. For each line of a site, the share of the site's
pages that contain it is its frequency; lines over a ratio are boilerplate and
go from all pages of the site. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadence.llm.common import free_name, materialise

#: A line goes if more than this share of its site's pages holds it; on one page alone nothing is repeated.
RATIO, LEAST_PAGES = 0.05, 2
#: Pages that have this share of their characters in common lines are near copies, as for documents.
COPIED = 0.8


def _bare(line: Column) -> Column:
    return F.btrim(line, F.lit(" \t\r\f\u000b"))


def line_key(line: Column) -> Column:
    """Hash of a line without the white space around it."""
    return F.xxhash64(_bare(line))


def _worded(line: Column) -> Column:
    return F.length(_bare(line)) > 0


def boilerplate(pages: DataFrame, site: str, text: str, ratio: float = RATIO) -> DataFrame:
    """``site`` and the array ``boilerplate`` of its lines' hashes.

    The total is the site's pages, near copies of one page counted once: so
    copies of a page make no boilerplate of its lines. Equal pages are one
    page. Lines are first counted on all pages; pages with ``COPIED`` of their
    characters in lines over the ratio are near copies, and when lines are
    counted for good each group of them is one page. A page's group goes by
    its longest common line, and by the length of the longest common line of
    any page that holds it, so that a page which has lost the group's longest
    line to an edit stays in it; groups with lines of one length are one.

    The pages that hold a line are summed before they are shuffled, so a line
    on a third of all pages is no hot key. A site has at most (lines per page
    / ratio) boilerplate lines: a short array.
    """
    # Each line is trimmed once, and strings, not structs, are made distinct: Spark hashes those.
    bare = F.array_distinct(F.filter(F.transform(F.split(F.col(text), "\n", -1), _bare), lambda x: F.length(x) > 0))
    sized = F.transform(bare, lambda x: F.struct(F.length(x).alias("n"), F.xxhash64(x).alias("key")))
    once = materialise(pages.groupBy(site, F.xxhash64(text).alias("_page")).agg(F.first(sized).alias("_lines")), "page-lines")
    counted = once.select(site, F.explode("_lines.key").alias("_line")).groupBy(site, "_line").agg(F.count("*").alias("_holding"))
    common = materialise(_over(counted, once.groupBy(site).agg(F.count("*").alias("_pages")), site, ratio), "common-lines")
    size = lambda x: F.aggregate(x, F.lit(0).cast("bigint"), lambda a, y: a + y.n)
    placed = F.transform("_lines", lambda x, i: F.struct(x.n.alias("n"), (-i).alias("i"), x.key.alias("key")))
    shared = F.filter(placed, lambda x: F.array_contains("boilerplate", x.key))
    marked = once.join(common, site, "left").withColumn("_shared", F.when(F.col("boilerplate").isNotNull(), shared))
    # Without common lines a page is no copy: its share is null.
    copied = F.coalesce(size(F.col("_shared")) >= COPIED * size(F.col("_lines")), F.lit(False)) & (F.size("_lines") > 0)
    marked = materialise(marked.select(site, F.col("_lines.key").alias("_keys"), copied.alias("_copied"), F.when(copied, F.col("_shared")).alias("_shared"), F.array_max("_shared").alias("_longest")), "page-lines")
    copies = marked.filter("_copied")
    lengths = copies.select(site, F.explode("_shared.key").alias("_head"), F.col("_longest.n").alias("_n")).groupBy(site, "_head").agg(F.max("_n").alias("_group"))
    grouped = copies.withColumn("_head", F.col("_longest.key")).join(materialise(lengths, "copy-groups"), [site, "_head"])
    held = grouped.select(site, "_group", F.explode("_keys").alias("_line")).distinct().groupBy(site, "_line").agg(F.count("*").alias("_holding"))
    single = marked.filter("NOT _copied")
    alone = single.select(site, F.explode("_keys").alias("_line")).groupBy(site, "_line").agg(F.count("*").alias("_holding"))
    units = single.groupBy(site).agg(F.count("*").alias("_pages")).union(grouped.groupBy(site).agg(F.countDistinct("_group").alias("_pages")))
    both = alone.union(held).groupBy(site, "_line").agg(F.sum("_holding").alias("_holding"))
    return _over(both, units.groupBy(site).agg(F.sum("_pages").alias("_pages")), site, ratio)


def _over(counted: DataFrame, totals: DataFrame, site: str, ratio: float) -> DataFrame:
    """``site`` and the array ``boilerplate`` of the lines that more than the ratio of its pages hold."""
    found = counted.filter(F.col("_holding") >= LEAST_PAGES).join(totals, site).filter(F.col("_holding") > ratio * F.col("_pages"))
    return found.groupBy(site).agg(F.collect_set("_line").alias("boilerplate"))


def drop_boilerplate(pages: DataFrame, site: Column, text: str = "text", ratio: float = RATIO, dropped: str | None = None) -> DataFrame:
    """``pages`` with the boilerplate lines taken out of ``text``.

    Lines are parted by line feeds; white space around a line does not tell
    lines apart, and lines of white space only stay. A page counts once for a
    line, however often it holds it; equal pages and near copies of a page
    count as one (see ``boilerplate``). A page that has boilerplate lines only stays as it is. Null sites are one site of
    their own; null texts stay null and count as a page. Rows, their other
    columns and the order of the lines left stay as they are. ``dropped``
    names a column for the number of lines taken out.
    """
    name, gone, lines, left = (free_name(pages, x) for x in ("_site", "_boilerplate", "_lines", "_left"))
    keyed = pages.withColumn(name, F.coalesce(site.cast("string"), F.lit("\u0000")))
    # As a written table the list has a known size: Spark broadcasts it only where it is small.
    found = materialise(boilerplate(keyed.select(name, text), name, text, ratio), "boilerplate").withColumnRenamed("boilerplate", gone)
    joined = keyed.join(found, name, "left")
    # As columns, the lines of a page are split, hashed and looked up once, whatever reads them; null where none goes.
    joined = joined.withColumn(lines, F.when(F.col(gone).isNotNull(), F.split(F.col(text), "\n", -1)))
    joined = joined.withColumn(left, F.filter(lines, lambda x: ~_worded(x) | ~F.array_contains(F.col(gone), line_key(x))))
    joined = joined.withColumn(left, F.when(F.exists(left, _worded), F.col(left)))
    clean = F.when(F.col(left).isNull(), F.col(text)).otherwise(F.array_join(left, "\n"))
    out = {c: clean.alias(c) if c == text else F.col(c) for c in pages.columns}
    if dropped:
        out[dropped] = F.when(F.col(left).isNull(), 0).otherwise(F.size(lines) - F.size(left)).alias(dropped)
    return joined.select(*out.values())


def page_lines(html: Column) -> Column:
    """The text of a page's block elements, one to a line, without markup.

    White space is matched only where it changes: a space alone and a line feed alone are most of it, and stay.
    """
    bare = F.regexp_replace(F.coalesce(html, F.lit("")), r"(?is)<(?:(?:script|style)[^>]*>.*?</(?:script|style)>|!--.*?-->)", " ")
    blocks = F.regexp_replace(bare, r"(?i)</?(?:p|div|li|ul|ol|br|h[1-6]|tr|td|table|nav|article|section|header|footer|title|body|head|html)(?:\s[^>]*)?/?>", "\n")
    plain = F.regexp_replace(blocks, r"<[^>]*>", "")
    return F.regexp_replace(F.regexp_replace(plain, r"[ \t\r\f]{2,}|[\t\r\f]", " "), r" \n[ \n]*|\n[ \n]+", "\n")


def host(url: Column) -> Column:
    """Host of a URL in lower case; empty where there is none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1))
