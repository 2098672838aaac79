"""Line deduplication by site-relative frequency (DataFrame operations only).

A line is boilerplate of a host if the share of the host's pages that contain
it reaches a limit. The lines kept are put together again in their order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import prepare, stored

#: hosts with their dropped lines are broadcast up to this size
BROADCAST_BYTES = 8 << 20
#: tags that end a line of the page's text; scripts, styles and comments hold none
_BLOCK = r"(?i)</?(?:p|div|br|li|ul|ol|h[1-6]|tr|table|article|section|header|footer|nav|title|body|head|html|blockquote|pre|hr|main|aside)(?:\s[^>]*)?/?>"
_SILENT = r"(?is)<(script|style)(?:\s[^>]*)?>.*?</\1\s*>|<!--.*?-->"


def host_of(url: Column) -> Column:
    """Lower-case host of an absolute URL, without user and port; '' if there is none."""
    host = F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.lower(host)


def page_lines(html: Column) -> Column:
    """Non-empty lines of a page's visible text, trimmed, inner white space as one space."""
    text = F.regexp_replace(F.coalesce(html.cast("string"), F.lit("")), _SILENT, "\n")
    text = F.regexp_replace(F.regexp_replace(text, _BLOCK, "\n"), r"<[^>]*>", "")
    text = F.regexp_replace(text, r"[\t\x0B\f\r ]+", " ")
    return F.filter(F.transform(F.split(text, "\n"), lambda x: F.trim(x)), lambda x: x != "")


def _joined_by_host(rows: DataFrame, hosts: DataFrame, hosts_bytes: int, salts: int) -> DataFrame:
    """``rows`` with the columns of ``hosts`` (one row a host): broadcast while small, salted beyond."""
    if hosts_bytes <= BROADCAST_BYTES:
        return rows.join(F.broadcast(hosts), "host")
    every_salt = F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("__salt")
    spread = F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int")
    return rows.withColumn("__salt", spread).join(hosts.select("*", every_salt), ["host", "__salt"]).drop("__salt")


def drop_boilerplate(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                     max_ratio: float = 0.2, min_pages: int = 3, salts: int = 32) -> DataFrame:
    """``(id_col, host, host_pages, n_lines, n_dropped, text)``, one row a page.

    A line goes if it stands on at least ``min_pages`` pages of the host and on
    more than ``max_ratio`` of them; a page counts once however often it repeats
    the line. Null or unparsable URLs share the host ''; null or empty pages
    have no lines and the empty text; repeated rows count as pages of their own
    and are all returned; an empty table gives no rows. Other columns are not
    read, so their names cannot clash.

    Lines are known by 64-bit hashes within their host and counted with partial
    sums before the shuffle, so neither a large host nor a common line is a hot
    key. What a host drops is one array of hashes: a line in it stands on more
    than ``max_ratio`` of the pages, so it has at most ``1 / max_ratio`` times
    as many entries as a page of the host has lines on average. That table, one
    row a host, meets the pages by broadcast up to ``BROADCAST_BYTES`` as
    counted, and beyond that by a join over ``salts`` copies of it.
    """
    if not max_ratio > 0:
        raise ValueError("max_ratio must be above 0")
    spark = pages.sparkSession
    prepare(spark)
    base, _ = stored(pages.select(F.col(id_col), host_of(F.col(url_col)).alias("host"), page_lines(F.col(html_col)).alias("__lines")), "page-lines")

    host_bytes = F.coalesce(F.sum(F.octet_length("host") + 64), F.lit(0))
    totals, _ = stored(base.groupBy("host").agg(F.count("*").alias("host_pages")), "host-pages")
    keys = base.select("host", F.explode(F.array_distinct(F.transform("__lines", lambda x: F.xxhash64(x)))).alias("line"))
    counts = keys.groupBy("host", "line").agg(F.count("*").alias("line_pages")).where(F.col("line_pages") >= min_pages)
    flagged = (_joined_by_host(counts, totals, totals.agg(host_bytes).head()[0], salts)
               .where(F.col("line_pages") > F.lit(max_ratio) * F.col("host_pages")).groupBy("host").agg(F.collect_list("line").alias("__bad")))
    hosts, _ = stored(totals.join(flagged, "host", "left"), "host-lines")

    array_bytes = F.coalesce(F.sum(8 * F.coalesce(F.size("__bad"), F.lit(0))), F.lit(0))
    out = _joined_by_host(base, hosts, sum(hosts.agg(host_bytes, array_bytes).head()), salts)
    kept = F.when(F.col("__bad").isNull(), F.col("__lines")).otherwise(
        F.filter("__lines", lambda x: ~F.array_contains(F.col("__bad"), F.xxhash64(x))))
    out = out.withColumn("__kept", kept)
    return out.select(id_col, "host", "host_pages", F.size("__lines").cast("long").alias("n_lines"),
                      (F.size("__lines") - F.size("__kept")).cast("long").alias("n_dropped"),
                      F.array_join("__kept", "\n").alias("text"))
