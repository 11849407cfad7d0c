"""Page and URL extraction over a table of fetched pages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import rules as R
from .text import py_strip

# per-site job-id patterns in posting URLs
JOB_ID_HTML = r"/(\d+)\.html"
JOB_ID_TAIL = r"/(\d+)(?=\?|$)"

# FIXED VALUES: HTML entities decoded by html_to_text (&amp; last)
ENTITIES = (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&"))


def url_job_id(url: Column, pattern: str = JOB_ID_HTML) -> Column:
    """H1: job id from a posting URL, NULL when the pattern is absent."""
    v = F.regexp_extract(url, pattern, 1)
    return F.when(v == "", F.lit(None).cast("string")).otherwise(v)


def max_page_text(text: Column) -> Column:
    """H2: "1 / 82 trang" -> 82, else 1."""
    v = F.regexp_extract(text, r"/\s*(\d+)\s*trang", 1)
    return F.coalesce(v.try_cast("int"), F.lit(1))


def max_page_links(text: Column) -> Column:
    """H3: largest ``page=N`` among the links, at least 1."""
    nums = F.transform(F.regexp_extract_all(text, F.lit(r"page=(\d+)"), 1), lambda x: x.try_cast("int"))
    return F.greatest(F.coalesce(F.array_max(nums), F.lit(1)), F.lit(1))


def max_page_count(heading: Column, page_size: int = R.LISTING_PAGE_SIZE) -> Column:
    """H4: ceil(leading result count / page size), else 1."""
    n = F.regexp_extract(heading, r"^(\d+)", 1).try_cast("bigint")
    return F.coalesce(F.ceil(n / F.lit(page_size)), F.lit(1)).cast("bigint")


def page_url(base: Column, page: Column) -> Column:
    """H5: URL of listing page N (page 1 is the base URL)."""
    return (F.when(page == 1, base)
            .when(base.endswith("-vi.html"),
                  F.concat(F.regexp_replace(base, r"-vi\.html$", ""), F.lit("-trang-"), page.cast("string"),
                           F.lit("-vi.html")))
            .otherwise(F.concat(base, F.lit("?page="), page.cast("string"))))


def hrefs(html: Column) -> Column:
    """H6: link targets in document order."""
    return F.regexp_extract_all(html, F.lit(r'href="([^"]+)"'), 1)


def tag_text(html: Column, tag: str) -> Column:
    """First ``<tag …>…</tag>`` inner HTML ('' when missing)."""
    return F.regexp_extract(html, rf"(?is)<{tag}\b[^>]*>(.*?)</{tag}>", 1)


def html_lang(html: Column) -> Column:
    return F.regexp_extract(html, r'(?is)<html\b[^>]*\blang="([^"]*)"', 1)


def html_to_text(html: Column) -> Column:
    """Drop script/style/comments, tags -> one space, decode entities,
    collapse white space, strip."""
    t = F.regexp_replace(html, r"(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->", " ")
    t = F.regexp_replace(t, r"(?s)<[^>]*>", " ")
    for ent, ch in ENTITIES:
        t = F.replace(t, F.lit(ent), F.lit(ch))
    return py_strip(F.regexp_replace(t, r"\s+", " "))


def kv_value(text: Column) -> Column:
    """H9: "Key: Value" -> text after the last colon."""
    s = py_strip(text)
    return F.when(s.contains(":"), py_strip(F.element_at(F.split(s, ":"), -1))).otherwise(s)


def join_sections(texts: Column) -> Column:
    """Non-empty stripped child texts joined with ". "."""
    return F.array_join(F.filter(F.transform(texts, py_strip), lambda x: x != ""), ". ")


def section_minus_heading(text: Column, heading: str) -> Column:
    return py_strip(F.replace(py_strip(text), F.lit(heading), F.lit("")))


def prefer_nonempty(card: Column, tab: Column) -> Column:
    """Card value if non-empty, else the tab value."""
    return F.coalesce(F.when(card != "", card), tab)


# FIXED VALUES: label prefix removed from scraped deadline texts
DEADLINE_PREFIX = "Hạn nộp hồ sơ: "


def strip_deadline_prefix(text: Column) -> Column:
    """Drop the "Hạn nộp hồ sơ: " label from a scraped deadline."""
    return F.replace(text, F.lit(DEADLINE_PREFIX), F.lit(""))


def with_crawl_constants(df, source: str, crawl_date: str):
    """Constant columns of a crawl run (source site, crawl date)."""
    return df.withColumn("Nguon", F.lit(source)).withColumn("NgayCaoDuLieu", F.lit(crawl_date).cast("date"))
