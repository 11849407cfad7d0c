"""Crawl-side workloads over ``pages``, ``listing``, ``seen`` and
``conversations`` (H1-H13, S12, S13, J5, L1, L5, X7)."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from .. import fixtures
from .. import oracle as O
from ..functions import html as H
from ..operators.frontier import crawl_frontier, mark_new
from ..registry import register
from ..session import scratch_path


def _pages(spark, sf_dir):
    return fixtures.table(spark, sf_dir, "pages")


# --- H1 ---------------------------------------------------------------------
register("url_job_id", r"""
SELECT page_id, url, nullif(regexp_extract(url, '/(\d+)\.html', 1), '') AS id_html,
       nullif(regexp_extract(url, '/(\d+)(?:\?|$)', 1), '') AS id_tail FROM pages""")(
    lambda spark, sf_dir: _pages(spark, sf_dir).select(
        "page_id", "url", H.url_job_id(F.col("url"), H.JOB_ID_HTML).alias("id_html"),
        H.url_job_id(F.col("url"), H.JOB_ID_TAIL).alias("id_tail")))

# --- H2-H4: max page -----------------------------------------------------------
register("max_page_text", r"""
SELECT page_id, coalesce(TRY_CAST(regexp_extract(html, '/\s*(\d+)\s*trang', 1) AS INTEGER), 1) AS max_page FROM pages""")(
    lambda spark, sf_dir: _pages(spark, sf_dir).select("page_id", H.max_page_text(F.col("html")).alias("max_page")))

_MAXPAGE_LINKS_SQL = r"""greatest(coalesce(list_max(list_transform(regexp_extract_all(url || ' ' || html, 'page=(\d+)', 1),
    lambda _x: TRY_CAST(_x AS INTEGER))), 1), 1)"""
register("max_page_links", f"SELECT page_id, {_MAXPAGE_LINKS_SQL} AS max_page FROM pages")(
    lambda spark, sf_dir: _pages(spark, sf_dir).select(
        "page_id", H.max_page_links(F.concat_ws(" ", "url", "html")).alias("max_page")))

_H1_SQL = r"regexp_extract(html, '(?is)<h1\b[^>]*>(.*?)</h1>', 1)"
register("max_page_count", rf"""
SELECT page_id, CAST(coalesce(ceil(TRY_CAST(regexp_extract(CAST(page_id * 37 AS VARCHAR) || ' ' || {_H1_SQL}, '^(\d+)', 1) AS BIGINT) / 50), 1) AS BIGINT) AS max_page
FROM pages""")(
    lambda spark, sf_dir: _pages(spark, sf_dir).select(
        "page_id", H.max_page_count(F.concat_ws(" ", (F.col("page_id") * 37).cast("string"),
                                                H.tag_text(F.col("html"), "h1"))).alias("max_page")))

# --- H5: page URLs -------------------------------------------------------------
@register("page_url_expand", rf"""
WITH p AS (SELECT page_id, CASE WHEN page_id % 2 = 0 THEN regexp_replace(url, '[?#].*$', '') || '-sortdv-vi.html'
                                ELSE url END AS base, {_MAXPAGE_LINKS_SQL} AS max_page FROM pages),
e AS (SELECT page_id, base, CAST(unnest(generate_series(1, max_page)) AS INTEGER) AS page FROM p)
SELECT page_id, page, CASE WHEN page = 1 THEN base
  WHEN suffix(base, '-vi.html') THEN regexp_replace(base, '-vi\.html$', '') || '-trang-' || CAST(page AS VARCHAR) || '-vi.html'
  ELSE base || '?page=' || CAST(page AS VARCHAR) END AS page_url FROM e""")
def _page_url_expand(spark, sf_dir):
    p = _pages(spark, sf_dir)
    base = F.when(F.col("page_id") % 2 == 0,
                  F.concat(F.regexp_replace("url", r"[?#].*$", ""), F.lit("-sortdv-vi.html"))).otherwise(F.col("url"))
    p = p.select("page_id", base.alias("base"), H.max_page_links(F.concat_ws(" ", "url", "html")).alias("max_page"))
    e = p.select("page_id", "base", F.explode(F.sequence(F.lit(1), "max_page")).alias("page"))
    return e.select("page_id", "page", H.page_url(F.col("base"), F.col("page")).alias("page_url"))


# --- H6: link harvest ------------------------------------------------------------
register("link_harvest", r"""
WITH l AS (SELECT page_id, regexp_extract_all(html, 'href="([^"]+)"', 1) AS hs FROM pages)
SELECT page_id, CAST(generate_subscripts(hs, 1) - 1 AS INTEGER) AS pos, unnest(hs) AS href FROM l""")(
    lambda spark, sf_dir: _pages(spark, sf_dir).select(
        "page_id", F.posexplode(H.hrefs(F.col("html"))).alias("pos", "href")))

# --- H8 / H11: field extraction and HTML to text -----------------------------------
_TXT = [r"(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->", r"(?s)<[^>]*>"]


def _html_to_text_sql(x: str) -> str:
    t = f"regexp_replace({x}, {O.q(_TXT[0])}, ' ', 'g')"
    t = f"regexp_replace({t}, {O.q(_TXT[1])}, ' ', 'g')"
    for ent, ch in H.ENTITIES:
        t = f"replace({t}, {O.q(ent)}, {O.q(ch)})"
    return O.strip(f"regexp_replace({t}, '\\s+', ' ', 'g')")


register("html_to_text", f"SELECT page_id, {_html_to_text_sql('html')} AS text FROM pages")(
    lambda spark, sf_dir: _pages(spark, sf_dir).select("page_id", H.html_to_text(F.col("html")).alias("text")))

register("html_field_extract", rf"""
SELECT page_id,
  {_html_to_text_sql("regexp_extract(html, '(?is)<title\\b[^>]*>(.*?)</title>', 1)")} AS title,
  {_html_to_text_sql(_H1_SQL)} AS heading,
  regexp_extract(html, '(?is)<html\b[^>]*\blang="([^"]*)"', 1) AS lang,
  {_html_to_text_sql("regexp_extract(html, '(?is)<article\\b[^>]*>(.*?)</article>', 1)")} AS body
FROM pages""")(
    lambda spark, sf_dir: _pages(spark, sf_dir).select(
        "page_id", H.html_to_text(H.tag_text(F.col("html"), "title")).alias("title"),
        H.html_to_text(H.tag_text(F.col("html"), "h1")).alias("heading"),
        H.html_lang(F.col("html")).alias("lang"),
        H.html_to_text(H.tag_text(F.col("html"), "article")).alias("body")))

# --- H9 / H10 / H12 over conversations ---------------------------------------------
register("kv_value", f"""
SELECT conv_id, turn, CASE WHEN contains({O.strip('text')}, ':')
  THEN {O.strip(f"string_split({O.strip('text')}, ':')[-1]")} ELSE {O.strip('text')} END AS value FROM conversations""")(
    lambda spark, sf_dir: fixtures.table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", H.kv_value(F.col("text")).alias("value")))


@register("section_text", f"""
SELECT conv_id, array_to_string(list_filter(list_transform(list(text ORDER BY turn), lambda _t: {O.strip('_t')}),
                                lambda _t: _t <> ''), '. ') AS section
FROM conversations GROUP BY conv_id""")
def _section_text(spark, sf_dir):
    """A section's child texts (here: a conversation's turns) joined in
    order.  One group is one output row, so its size is the output's."""
    c = fixtures.table(spark, sf_dir, "conversations")
    g = c.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "text"))).alias("_t"))
    return g.select("conv_id", H.join_sections(F.transform("_t", lambda x: x["text"])).alias("section"))


register("prefer_nonempty", """
SELECT page_id, coalesce(CASE WHEN t <> '' THEN t END, h) AS value FROM (
  SELECT page_id, regexp_extract(html, '(?is)<title\\b[^>]*>(.*?)</title>', 1) AS t,
         regexp_extract(html, '(?is)<h1\\b[^>]*>(.*?)</h1>', 1) AS h FROM pages)""")(
    lambda spark, sf_dir: _pages(spark, sf_dir).select(
        "page_id", H.prefer_nonempty(H.tag_text(F.col("html"), "title"), H.tag_text(F.col("html"), "h1")).alias("value")))

# --- S12 / S13 / J5 / L1 / L5 / H7 over listing + seen ------------------------------

_SEEN_FILE_SQL = "SELECT DISTINCT trim(link) AS link FROM seen WHERE trim(link) <> ''"


@register("seen_ids_scan", fixtures.duck_prefix("listing", "seen") + _SEEN_FILE_SQL)
def _seen_ids_scan(spark, sf_dir):
    """History file (one id per line) -> trimmed, non-blank, distinct."""
    from ..sources.files import read_history, write_history
    path = f"{scratch_path(spark, 'history-seen')}-{uuid.uuid4().hex[:10]}"
    write_history(fixtures.seen(spark, sf_dir).select("link"), path)
    return read_history(spark, path).withColumnRenamed("id", "link")


@register("seen_ids_anti", fixtures.duck_prefix("listing", "seen") + """
SELECT l.* FROM listing l ANTI JOIN seen s ON l.site = s.site AND l.link = s.link""")
def _seen_ids_anti(spark, sf_dir):
    listing = fixtures.listing(spark, sf_dir)
    seen = fixtures.seen(spark, sf_dir)
    return listing.join(seen, ["site", "link"], "left_anti").select("site", "page", "pos", "link")


def _frontier_sql(cap, max_empty, dedupe=True) -> str:
    first = ("AND (page, pos) = (SELECT (page, pos) FROM listing x WHERE x.site = c.site AND x.link = c.link "
             "ORDER BY page, pos LIMIT 1)") if dedupe else ""
    new = f"""
, c AS (SELECT l.*, s.link IS NULL AS unseen FROM listing l LEFT JOIN (SELECT DISTINCT site, link FROM seen) s
        ON l.site = s.site AND l.link = s.link)
, n AS (SELECT c.*, (unseen {first}) AS is_new FROM c)
, p AS (SELECT site, page, CAST(sum(CAST(is_new AS INTEGER)) AS BIGINT) AS n_new FROM n GROUP BY site, page)
, q AS (SELECT *, coalesce(sum(n_new) OVER (PARTITION BY site ORDER BY page ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS new_before,
        count(*) FILTER (WHERE n_new > 0) OVER (PARTITION BY site ORDER BY page ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS grp FROM p)
, r AS (SELECT *, CASE WHEN n_new = 0 THEN row_number() OVER (PARTITION BY site, grp ORDER BY page) - CASE WHEN grp > 0 THEN 1 ELSE 0 END ELSE 0 END AS run FROM q)
, st AS (SELECT site, min(page) FILTER (WHERE run >= {max_empty if max_empty else 10**9}) AS stop FROM r GROUP BY site)
, k AS (SELECT n.site, n.page, n.pos, n.link, CAST(r.new_before + row_number() OVER (PARTITION BY n.site, n.page ORDER BY n.pos, n.link) AS INTEGER) AS rank
        FROM n JOIN r ON n.site = r.site AND n.page = r.page JOIN st ON st.site = n.site
        WHERE n.is_new AND (st.stop IS NULL OR n.page <= st.stop))
"""
    where = f"WHERE rank <= {cap}" if cap is not None else ""
    return fixtures.duck_prefix("listing", "seen") + new + f"SELECT * FROM k {where}"


@register("crawl_frontier", _frontier_sql(100, 5))
def _crawl_frontier(spark, sf_dir):
    return crawl_frontier(fixtures.listing(spark, sf_dir), fixtures.seen(spark, sf_dir), cap=100, max_empty=5)


@register("crawl_frontier_no_dedupe", _frontier_sql(10, 5, dedupe=False))
def _crawl_frontier_nd(spark, sf_dir):
    """Q20 variant: no within-run de-duplication, cap 10."""
    return crawl_frontier(fixtures.listing(spark, sf_dir), fixtures.seen(spark, sf_dir), cap=10, max_empty=5,
                          dedupe_within_run=False)


@register("limit_new", _frontier_sql(20, None))
def _limit_new(spark, sf_dir):
    """L1: the first N new links per site in (page, pos) order."""
    return crawl_frontier(fixtures.listing(spark, sf_dir), fixtures.seen(spark, sf_dir), cap=20, max_empty=None)


@register("seen_ids_merge", _frontier_sql(100, 5).replace("SELECT * FROM k WHERE rank <= 100", """
SELECT DISTINCT site, link FROM (SELECT site, link FROM seen UNION ALL SELECT site, link FROM k WHERE rank <= 100)"""))
def _seen_ids_merge(spark, sf_dir):
    """History after the run = old history ∪ accepted links."""
    seen = fixtures.seen(spark, sf_dir)
    front = crawl_frontier(fixtures.listing(spark, sf_dir), seen, cap=100, max_empty=5)
    return seen.select("site", "link").unionByName(front.select("site", "link")).distinct()


# --- H8, H12, X7: job pages of three sites --------------------------------------

_JOB = ("stg", "job_pages")


def _said(c: str) -> str:
    """A value as the page shows it: white space folded, "" when missing."""
    return f"coalesce({O.strip(f"regexp_replace({c}, '\\s+', ' ', 'g')")}, '')"


def _fields_sql() -> str:
    """The fields that each site shows, from the staging rows that made its pages."""
    every = {"title": "CongViec", "salary": "MucLuong", "experience": "YeuCauKinhNghiem", "rank": "CapBac", "work_form": "HinhThucLamViec", "location": "ViTri", "industry": "LinhVuc"}
    here = "'TopCV', 'CareerLink', 'CareerViet'"
    cols = [(f, _said(c), here) for f, c in every.items()]
    cols += [("headcount", _said("SoLuongTuyen"), "'TopCV'"), ("work_time", _said("CASE row_id % 2 WHEN 0 THEN 'Thứ 2 - Thứ 6' END"), "'TopCV'"),
             ("gender", _said("CASE row_id % 4 WHEN 0 THEN 'Nam' WHEN 1 THEN 'Nữ' END"), "'CareerLink'"),
             ("deadline", f"replace({_said('HanNopHoSo')}, 'Hạn nộp hồ sơ: ', '')", here),
             ("education", f"CASE WHEN site = 'CareerViet' AND HocVan IS NOT NULL THEN 'Bằng cấp: ' ELSE '' END || {_said('HocVan')}", here),
             ("company", _said("CongTy"), "'TopCV', 'CareerLink'"), ("size", _said("QuyMoCongTy"), "'TopCV', 'CareerLink'"),
             ("company_link", "CASE WHEN CongTy IS NULL THEN '' WHEN site = 'TopCV' THEN '/cong-ty' ELSE '/cl' END", "'TopCV', 'CareerLink'"),
             ("description", f"CASE WHEN MoTaCongViec IS NULL THEN '' ELSE concat_ws('. ', nullif({_said('MoTaCongViec')}, ''), 'Liên hệ') END", "'TopCV'"),
             ("requirement", _said("YeuCauUngVien"), "'TopCV'"), ("benefits", "''", "'TopCV'")]
    from ..functions.job_pages import FIELDS, SECTIONS
    cols.sort(key=lambda c: (*FIELDS, *SECTIONS).index(c[0]))
    shown = ", ".join(f"CASE WHEN site IN ({sites}) THEN {e} ELSE '' END AS {f}" for f, e, sites in cols)
    return f"SELECT row_id AS page_id, site, {shown} FROM (SELECT s.*, p.site FROM stg s JOIN job_pages p ON p.page_id = s.row_id)"


@register("job_page_fields", fixtures.duck_prefix(*_JOB) + _fields_sql())
def _job_page_fields(spark, sf_dir):
    """H8: the fields of the job pages of three sites come back as they were put in."""
    from ..functions.job_pages import extract_fields
    return extract_fields(fixtures.job_pages(spark, sf_dir)).drop("url")


@register("company_sources_merge", fixtures.duck_prefix(*_JOB) + f"""
, f AS ({_fields_sql()})
SELECT page_id, coalesce(CASE WHEN page_id % 4 = 0 THEN NULLIF(company, '') END, 'Tab ' || company) AS company,
       coalesce(CASE WHEN page_id % 5 = 0 THEN NULLIF(company_link, '') END, '/tab' || company_link) AS company_link,
       CASE WHEN page_id % 7 <> 0 THEN size ELSE '' END AS size FROM f""")
def _company_sources(spark, sf_dir):
    """Card and tab of a company; the tab's size always wins, even when missing."""
    from ..functions.job_pages import extract_fields, merge_company
    f = extract_fields(fixtures.job_pages(spark, sf_dir))
    both = f.select("page_id", F.when(F.col("page_id") % 4 == 0, F.col("company")).otherwise("").alias("card_company"),
                    F.when(F.col("page_id") % 5 == 0, F.col("company_link")).alias("card_company_link"), F.lit("card size").alias("card_size"),
                    F.concat(F.lit("Tab "), "company").alias("tab_company"), F.concat(F.lit("/tab"), "company_link").alias("tab_company_link"),
                    F.when(F.col("page_id") % 7 != 0, F.col("size")).alias("tab_size"))
    return merge_company(both)


def _job_frontier_sql(cap: int, max_empty: int, seen: str = "job_seen") -> str:
    """CTEs up to ``k``: new job ids by site in (page, pos) order, pages without a card counted as empty."""
    return f"""
, c AS (SELECT l.*, s.job_id IS NULL AND l.job_id IS NOT NULL AS unseen FROM job_listing l LEFT JOIN (SELECT DISTINCT site, job_id FROM {seen}) s ON l.site = s.site AND l.job_id = s.job_id)
, n AS (SELECT *, unseen AND row_number() OVER (PARTITION BY site, job_id ORDER BY page, pos) = 1 AS is_new FROM c)
, p AS (SELECT g.site, g.page, count(*) FILTER (WHERE n.is_new) AS n_new FROM job_listing_pages g LEFT JOIN n ON n.site = g.site AND n.page = g.page GROUP BY 1, 2)
, q AS (SELECT *, coalesce(sum(n_new) OVER (PARTITION BY site ORDER BY page ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS new_before,
        sum(n_new) OVER (PARTITION BY site ORDER BY page ROWS BETWEEN {max_empty - 1} PRECEDING AND CURRENT ROW) AS near, row_number() OVER (PARTITION BY site ORDER BY page) AS i FROM p)
, st AS (SELECT site, min(page) FILTER (WHERE near = 0 AND i >= {max_empty}) AS stop FROM q GROUP BY site)
, k AS (SELECT n.site, n.page, n.pos, n.link, n.job_id, CAST(q.new_before + row_number() OVER (PARTITION BY n.site, n.page ORDER BY n.pos, n.link) AS INTEGER) AS rank
        FROM n JOIN q ON n.site = q.site AND n.page = q.page JOIN st ON st.site = n.site WHERE n.is_new AND (st.stop IS NULL OR n.page <= st.stop))
"""


_JOB_CRAWL = ("stg", "job_pages", "job_listing", "job_listing_pages", "job_seen")


@register("crawl_frontier_job_ids", fixtures.duck_prefix(*_JOB_CRAWL) + _job_frontier_sql(200, 5) + "SELECT * FROM k WHERE rank <= 200")
def _crawl_frontier_ids(spark, sf_dir):
    """H7 by job id: links differ, ids repeat, cards without an id are not taken,
    pages without a card count as empty."""
    _, cards, fetched, seen = fixtures.job_crawl(spark, sf_dir)
    return crawl_frontier(cards, seen, cap=200, max_empty=5, key="job_id", pages=fetched)


@register("crawl_batch", fixtures.duck_prefix(*_JOB_CRAWL) + f""", nobody AS (SELECT * FROM job_seen WHERE false)
, f AS ({_fields_sql()}) {_job_frontier_sql(100, 5, 'nobody').replace('job_seen', 'nobody')}
, k1 AS (SELECT * FROM k WHERE rank <= 100)
, two AS (SELECT 2 AS run) {_job_frontier_sql(100, 5, 'k1').replace(', c AS', ', c2 AS').replace(', n AS', ', n2 AS').replace(', p AS', ', p2 AS').replace(', q AS', ', q2 AS').replace(', st AS', ', st2 AS').replace(', k AS', ', k2 AS').replace('FROM c)', 'FROM c2)').replace('JOIN n ON', 'JOIN n2 AS n ON').replace('FROM p)', 'FROM p2)').replace('FROM q ', 'FROM q2 AS q ').replace('FROM n JOIN q ON', 'FROM n2 AS n JOIN q2 AS q ON').replace('JOIN st ON', 'JOIN st2 AS st ON')}
SELECT r.run, r.site, r.job_id, r.rank AS rank_in_run, f.title AS "CongViec", f.location AS "ViTri", f.salary AS "MucLuong", f.deadline AS "HanNopHoSo", f.company AS "CongTy", f.description AS "MoTaCongViec", r.link AS "LinkBaiTuyenDung"
FROM (SELECT 1 AS run, * FROM k1 UNION ALL SELECT 2, * FROM k2 WHERE rank <= 100) r JOIN f ON f.site = r.site AND CAST(f.page_id AS VARCHAR) = r.job_id""")
def _crawl_batch(spark, sf_dir):
    """Two runs -- frontier by job id, fields of the accepted pages, run CSVs,
    history; the second takes up where the first stopped, and a repeat of the first
    run's id replaces it."""
    from ..plans.crawl import crawl_run
    pages, cards, fetched, _ = fixtures.job_crawl(spark, sf_dir)
    root = f"{scratch_path(spark, 'crawl')}-{uuid.uuid4().hex[:10]}"
    for run in ("1", "1", "2"):
        crawl_run(spark, cards, fetched, pages, root, run, "2025-01-01")
    out = spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("nullValue", "\u0000").csv(f"{root}/runs")
    return out.select(F.col("run").cast("int").alias("run"), "site", F.col("job_id").cast("string").alias("job_id"), F.col("rank_in_run").cast("int").alias("rank_in_run"),
                      "CongViec", "ViTri", "MucLuong", "HanNopHoSo", "CongTy", "MoTaCongViec", "LinkBaiTuyenDung")


# --- J6: ordered keyword rules over whole documents ----------------------------------

def _rule_doc_sql() -> str:
    from .. import rules as R
    return f"SELECT doc_id, {O.first_match('lower(text)', R.JOB_ROLE_V2, 'Khác')} AS label FROM documents"


@register("rule_first_match_hof", _rule_doc_sql())
def _rule_hof(spark, sf_dir):
    """J6 as a projection: the role rules folded into a CASE chain."""
    from .. import rules as R
    from ..functions.text import first_match
    d = fixtures.table(spark, sf_dir, "documents")
    return d.select("doc_id", first_match(F.lower(F.col("text")), R.JOB_ROLE_V2, "Khác").alias("label"))


@register("rule_first_match_join", _rule_doc_sql())
def _rule_join(spark, sf_dir):
    """J6 as a broadcast containment join + min_by(priority)."""
    from .. import rules as R
    from ..operators.rules_join import first_match_join, rules_table
    d = fixtures.table(spark, sf_dir, "documents")
    return first_match_join(d, "doc_id", "text", rules_table(spark, R.JOB_ROLE_V2), "Khác")


def _skills_doc_sql() -> str:
    from .. import rules as R
    return f"SELECT doc_id, {O.labels_found('lower(text)', R.SKILLS_V2['hard'], True)} AS skills FROM documents"


@register("skills_documents", _skills_doc_sql())
def _skills_documents(spark, sf_dir):
    """C30 keyword table over whole documents (word-boundary matches)."""
    from .. import rules as R
    from ..functions.text import labels_found
    d = fixtures.table(spark, sf_dir, "documents")
    return d.select("doc_id", labels_found(F.lower(F.col("text")), R.SKILLS_V2["hard"]).alias("skills"))
