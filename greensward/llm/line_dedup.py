"""Line dedup by site-relative frequency, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from greensward.plans.scratch import Scratch


def url_host(url: Column) -> Column:
    """The lower-cased host of a URL; empty text if there is none, null for null."""
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))


def html_lines(html: Column) -> Column:
    """Each tag of a page counts as a line end."""
    return F.regexp_replace(html, "<[^>]*>", "\n")


def drop_site_lines(docs: DataFrame, text: str, host: Column, *, ratio: float, min_pages: int) -> DataFrame:
    """Drop the lines that more than ``ratio`` of a host's pages hold.

    ``docs`` comes back with ``text`` cleaned and three columns more:
    ``n_lines`` (lines with a non-space character), ``n_dropped`` and
    ``dedup_host``. Lines are split at ``\\n`` and compared without the spaces
    at their ends; a line is counted once for each page. A line goes if the
    pages of its host that hold it are at least ``min_pages`` and more than
    ``ratio`` times all pages of the host. Lines without a non-space character
    never go. Hosts compare as they are; null is a host of its own. Null texts
    stay null, with no lines.

    Pages keep only hashes of their distinct lines for the counts, which are
    combined before the shuffle, so a host with a third of all pages costs no
    more than others. What comes back to the pages is the boilerplate alone: at
    most (mean lines of a page / ratio) hashes for a host, broadcast if its
    files are small and else joined by host with skewed hosts split.
    """
    scratch = Scratch(docs.sparkSession, "lines")
    lines = F.split(docs[text], "\n")
    key = lambda x: F.struct(F.xxhash64(F.trim(x)).alias("a"), F.hash(F.trim(x)).alias("b"))
    full = lambda x: F.trim(x) != ""
    keys = docs.select(host.alias("h"), F.array_distinct(F.transform(F.filter(lines, full), key)).alias("k"))
    # the null key of every page counts the pages of its host
    each = keys.select("h", F.explode(F.concat(F.array(F.lit(None).cast("struct<a:bigint,b:int>")), F.coalesce("k", F.array()))).alias("k"))
    counts = each.groupBy("h", "k").agg(F.count(F.lit(1)).alias("n")).where((F.col("n") >= min_pages) | F.col("k").isNull())
    counts = scratch.put(counts, "counts")
    total = counts.where("k is null").select(F.col("h").alias("t"), F.col("n").alias("pages"))
    common = counts.where("k is not null").join(scratch.small(scratch.put(total, "hosts")), F.col("h").eqNullSafe(F.col("t")))
    common = common.where(F.col("n") > ratio * F.col("pages")).groupBy("h").agg(F.collect_list("k").alias("_boilerplate"))
    common = scratch.small(scratch.put(common.withColumnRenamed("h", "_boilerplate_host"), "boilerplate"))
    new = docs.withColumn("dedup_host", host).join(common, F.col("dedup_host").eqNullSafe(F.col("_boilerplate_host")), "left")
    gone = lambda x: full(x) & F.array_contains(F.coalesce("_boilerplate", F.array()), key(x))
    kept = F.filter(lines, lambda x: ~gone(x))
    new = new.withColumns({
        "n_lines": F.coalesce(F.size(F.filter(lines, full)), F.lit(0)).cast("long"),
        "n_dropped": F.coalesce(F.size(lines) - F.size(kept), F.lit(0)).cast("long"),
        text: F.array_join(kept, "\n"),
    })
    return new.drop("_boilerplate", "_boilerplate_host")


#: Share of a site's pages above which a line is boilerplate, and the least number of pages.
PAGE_RATIO, PAGE_MIN = 0.1, 5


def op6_line_dedup(spark, sf_dir: str) -> DataFrame:
    """All pages by the host of their URL; a page's lines are the texts between its tags."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    pages = pages.select("page_id", "url", html_lines(F.col("html")).alias("text"))
    out = drop_site_lines(pages, "text", url_host(F.col("url")), ratio=PAGE_RATIO, min_pages=PAGE_MIN)
    return out.select("page_id", F.col("dedup_host").alias("host"), "n_lines", "n_dropped", "text")


def site_lines_sql(table: str, doc_id: str, host: str, text: str, ratio: float, min_pages: int) -> str:
    """CTEs ``src`` (id, host, lines) and ``common`` (host, set of lines) in DuckDB SQL."""
    return f"""
src AS (SELECT {doc_id} AS id, {host} AS host, {text} AS body, string_split({text}, chr(10)) AS lines FROM {table}),
hosts AS (SELECT host, count(*) AS pages FROM src GROUP BY host),
seen AS (SELECT host, line, count(*) AS n FROM (
    SELECT host, unnest(list_distinct([trim(x, ' ') FOR x IN lines IF trim(x, ' ') <> ''])) AS line FROM src) GROUP BY host, line),
common AS (SELECT seen.host, list(line) AS bp FROM seen JOIN hosts ON seen.host IS NOT DISTINCT FROM hosts.host
    WHERE n >= {min_pages} AND n > {ratio}::DOUBLE * pages GROUP BY seen.host),
clean AS (SELECT id, src.host, body,
    len([x FOR x IN lines IF trim(x, ' ') <> '']) AS n_lines,
    [x FOR x IN lines IF NOT (trim(x, ' ') <> '' AND list_contains(coalesce(bp, []), trim(x, ' ')))] AS kept, lines
  FROM src LEFT JOIN common ON src.host IS NOT DISTINCT FROM common.host)"""


_HOST_SQL = r"lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1))"
OP6_SQL = f"""WITH {site_lines_sql('pages', 'page_id', _HOST_SQL, "regexp_replace(html, '<[^>]*>', chr(10), 'g')", PAGE_RATIO, PAGE_MIN)}
SELECT id AS page_id, host, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(len(lines) - len(kept), 0)::BIGINT AS n_dropped,
  CASE WHEN body IS NULL THEN NULL ELSE array_to_string(kept, chr(10)) END AS text FROM clean"""
