"""Deterministic posting views over the driver's tables.

The same SQL text is registered as a temporary view in Spark and used as a
CTE prefix by the DuckDB oracle, so both engines see identical inputs.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from . import rules

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def _keywords(*rule_sets) -> list[str]:
    """Every keyword of these rule tables once, in their order, as a plain text."""
    found = [k for rule_set in rule_sets for _, given in rule_set for k in ((given,) if isinstance(given, str) else given)]
    return list(dict.fromkeys(k.replace("\\", "") for k in found))


def _each(words: list[str], before: str, otherwise: str) -> str:
    """In two of seven rows a text with the next of these words, in turn; else the given value."""
    return f"CASE WHEN k % 7 IN (2, 5) THEN concat('{before}', split_part('{'¦'.join(words)}', '¦', CAST(k % {len(words)} AS INT) + 1), ' (x)') ELSE {otherwise} END"


_TITLE_WORDS = _keywords(rules.JOB_ROLE_V2, rules.JOB_TITLE_V1, rules.INDUSTRY_SUB_V2, rules.RANK_V2, rules.RANK_V1)
_PLACES = [k for k, _ in dict.fromkeys((*rules.PROVINCE_MERGE_V2, *rules.PROVINCE_MERGE_V1))]
_SKILL_WORDS = _keywords(*rules.SKILLS_V2.values(), *rules.SKILLS_V1.values(), rules.EDUCATION_V2, rules.EDUCATION_V1)
_FIELD_WORDS = _keywords(rules.INDUSTRY_MACRO_V2, rules.INDUSTRY_V1)
_FORM_WORDS = _keywords(rules.EMPLOYMENT_V2, rules.EMPLOYMENT_V1, rules.WORK_MODE_V2, rules.WORK_MODE_V1)

# staging postings: 18 staging columns + row_id (three rows share each link, some have none); the texts that
# keyword rules read hold every keyword of every rule table in turn
STG_SQL = f"""
WITH b AS (
  SELECT o.o_orderkey AS k, CAST(o.o_orderdate AS DATE) AS d, c.c_name, c.c_mktsegment, n.n_name, o.o_orderpriority
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey)
SELECT
  {_each(_TITLE_WORDS, 'Chuyên viên ', """CASE k % 12 WHEN 0 THEN 'Senior Java Developer' WHEN 1 THEN 'Tuyển gấp 5 Data Analyst (HCM)' WHEN 2 THEN 'Thực tập sinh Tester'
    WHEN 3 THEN 'Project Manager - lương 30 triệu' WHEN 4 THEN 'Fullstack Developer [Remote]' WHEN 5 THEN 'Trưởng phòng IT'
    WHEN 6 THEN 'Kỹ sư dữ liệu' WHEN 7 THEN 'Nhân viên IT Support, tuyển 12 người' WHEN 8 THEN 'Fresher Business Analyst'
    WHEN 9 THEN 'DevOps Engineer (AWS)' WHEN 10 THEN '  ' ELSE 'Phó giám đốc công nghệ' END""")} AS CongViec,
  {_each(_PLACES, 'Tại ', """CASE k % 9 WHEN 0 THEN 'Hà Nội' WHEN 1 THEN 'Quận 1, TP.HCM' WHEN 2 THEN 'Hà Nội; Đà Nẵng' WHEN 3 THEN 'Bình Dương | Đồng Nai'
    WHEN 4 THEN 'Tại Bắc Giang - Bắc Ninh' WHEN 5 THEN 'Singapore' WHEN 6 THEN 'Hồ Chí Minh & Cần Thơ' WHEN 7 THEN NULL ELSE 'Nghệ An, Huế' END""")} AS ViTri,
  CASE k % 8 WHEN 0 THEN 'Không yêu cầu' WHEN 1 THEN '2 năm' WHEN 2 THEN '1 - 3 năm' WHEN 3 THEN 'Trên 5 năm' WHEN 4 THEN 'Dưới 1 năm'
    WHEN 5 THEN '6 tháng' WHEN 6 THEN NULL ELSE '3 năm đến 7 năm' END AS YeuCauKinhNghiem,
  CASE k % 10 WHEN 0 THEN 'Thỏa thuận' WHEN 1 THEN concat(CAST(5 + k % 20 AS STRING), ' - ', CAST(15 + k % 40 AS STRING), ' triệu')
    WHEN 2 THEN 'Up to 2,000 USD' WHEN 3 THEN 'Từ 12 triệu' WHEN 4 THEN '800 - 1500 USD' WHEN 5 THEN '15tr - 20tr' WHEN 6 THEN '10,000,000 - 15,000,000'
    WHEN 7 THEN 'Trên 1k usd' WHEN 8 THEN NULL ELSE 'Đến 25.5 triệu' END AS MucLuong,
  CASE k % 4 WHEN 0 THEN 'Nhân viên' WHEN 1 THEN 'Quản lý' WHEN 2 THEN NULL ELSE 'Trưởng nhóm' END AS CapBac,
  {_each(_FORM_WORDS, 'Việc ', """CASE k % 5 WHEN 0 THEN 'Toàn thời gian' WHEN 1 THEN 'Bán thời gian' WHEN 2 THEN 'Freelance' WHEN 3 THEN NULL ELSE 'Full-time, hybrid' END""")} AS HinhThucLamViec,
  CASE k % 3 WHEN 0 THEN concat('công ty tnhh ', lower(c_name)) WHEN 1 THEN upper(c_name) ELSE concat(c_name, ' co.op (vn)') END AS CongTy,
  CASE k % 7 WHEN 0 THEN '100 - 499 nhân viên' WHEN 1 THEN 'Trên 1.000 nhân viên' WHEN 2 THEN 'Dưới 10 người' WHEN 3 THEN NULL
    WHEN 4 THEN '25-99' WHEN 5 THEN '10.000+ nhân viên' ELSE 'Chưa rõ' END AS QuyMoCongTy,
  CASE k % 6 WHEN 0 THEN '3 người' WHEN 1 THEN NULL WHEN 2 THEN 'Số lượng lớn' WHEN 3 THEN '1' WHEN 4 THEN '2025' ELSE '10 - 20' END AS SoLuongTuyen,
  CASE k % 5 WHEN 0 THEN 'Đại học' WHEN 1 THEN 'Cao đẳng trở lên' WHEN 2 THEN NULL WHEN 3 THEN 'Trung cấp' ELSE 'Thạc sĩ' END AS HocVan,
  {_each(_SKILL_WORDS, 'Có ', """CASE k % 6 WHEN 0 THEN 'Thành thạo Python, SQL. Tiếng Anh tốt, làm việc nhóm' WHEN 1 THEN 'Tốt nghiệp Đại học; C++ / C#, giao tiếp' WHEN 2 THEN '2 năm Java, Spring Boot, Docker'
    WHEN 3 THEN NULL WHEN 4 THEN 'Excel, Power BI; tư duy logic; N2' ELSE 'React, Node.js, tự học' END""")} AS YeuCauUngVien,
  CASE k % 4 WHEN 0 THEN 'Phát triển backend, làm việc từ xa' WHEN 1 THEN 'Hỗ trợ khách hàng tại văn phòng' WHEN 2 THEN NULL ELSE 'Phân tích dữ liệu, hybrid' END AS MoTaCongViec,
  'Bảo hiểm, thưởng' AS QuyenLoi,
  CASE k % 6 WHEN 0 THEN concat('Hạn nộp hồ sơ: ', CAST(1 + k % 28 AS STRING), '/', CAST(1 + k % 12 AS STRING), '/2025') WHEN 1 THEN 'Còn 20 ngày tới'
    WHEN 2 THEN CASE k % 5 WHEN 0 THEN '31/02/2025' WHEN 1 THEN '05.06.25 14:30' WHEN 2 THEN '2025-6-15' WHEN 3 THEN '06/13/2025' ELSE '15 June 2025' END
    WHEN 3 THEN NULL WHEN 4 THEN CASE k % 5 WHEN 0 THEN '5-6-2025' WHEN 1 THEN 'Jun 5, 25' WHEN 2 THEN '07/2025' WHEN 3 THEN '20250605' ELSE '1/2/76' END ELSE 'Thỏa thuận' END AS HanNopHoSo,
  CASE WHEN (k - k % 3) % 33 <> 0 THEN concat('https://jobs.example.com/viec-lam/', CAST(k - k % 3 AS STRING), '.html') END AS LinkBaiTuyenDung,
  o_orderpriority AS Nguon, d AS NgayCaoDuLieu,
  {_each(_FIELD_WORDS, 'Ngành ', """CASE k % 5 WHEN 0 THEN 'CNTT - Phần mềm' WHEN 1 THEN 'Ngân hàng / Kế toán' WHEN 2 THEN c_mktsegment WHEN 3 THEN NULL ELSE 'Marketing' END""")} AS LinhVuc,
  k AS row_id
FROM b
"""

# crawl result cards (site, page, pos, link), with repeats
LISTING_SQL = """
SELECT concat('site', CAST(o_orderkey % 3 AS STRING)) AS site,
       CAST(floor(o_orderkey / 60) AS INT) + 1 AS page,
       CAST(floor((o_orderkey % 60) / 3) AS INT) + 1 AS pos,
       concat('https://jobs.example.com/', CAST(o_orderkey - o_orderkey % 7 AS STRING), '.html') AS link
FROM orders
"""

# crawl history: even ids plus every link on pages 8-14 of site0
SEEN_SQL = """
SELECT DISTINCT site, link FROM listing
WHERE CAST(regexp_extract(link, '/([0-9]+)[.]html', 1) AS INT) % 2 = 0 OR (site = 'site0' AND page BETWEEN 8 AND 14)
"""



def _shown(before: str, value: str, after: str) -> str:
    """A piece of HTML with an escaped value; nothing where the value is NULL."""
    escaped = f"replace(replace(replace({value}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"
    return f"coalesce('{before}' || {escaped} || '{after}', '')"


def _job_page(title: str, parts: list[tuple[str, str, str]]) -> str:
    return " || ".join([f"'<html><body>{title}'", *[_shown(*p) for p in parts], "'<footer>x</footer></body></html>'"])


_BESIDE = '<div class="item"><div class="title">{}</div>\n<div class="item-value">'
_TOPCV_PAGE = _job_page("<nav>TopCV</nav>", [
    ('<h1 class="job-detail__info--title"><b>', "CongViec", "</b></h1>"),
    *[(_BESIDE.format(label), col, "</div></div>") for label, col in (("Mức lương", "MucLuong"), ("Kinh nghiệm", "YeuCauKinhNghiem"), ("Cấp bậc", "CapBac"),
      ("Số lượng tuyển", "SoLuongTuyen"), ("Hình thức làm việc", "HinhThucLamViec"), ("Học vấn", "HocVan"))],
    ('<div class="job-detail__info--deadline">Hạn nộp hồ sơ: ', "HanNopHoSo", "</div>"),
    ('<div class="job-detail__info--section-content-title">Địa điểm</div> <div>', "ViTri", "</div>"),
    ("<h3>Thời gian làm việc</h3><div>", "work_time", "</div>"),
    ('<div class="job-detail__box--right job-detail__company"> <a class="name" href="/cong-ty"><span>', "CongTy", "</span></a></div>"),
    ('<div class="company-scale"><div class="company-title">Quy mô:</div><div class="company-value">', "QuyMoCongTy", "</div></div>"),
    ('<div class="company-title">Lĩnh vực:</div><div class="company-value">', "LinhVuc", "</div>"),
    ('<h3>Mô tả công việc</h3><div class="job-description__item--content"><p>', "MoTaCongViec", "</p><ul><li>Liên hệ</li></ul></div>"),
    ('<h3>Yêu cầu ứng viên</h3><div class="job-description__item--content"><p> </p><p>', "YeuCauUngVien", "</p></div>")])
_CAREERLINK_PAGE = _job_page("<nav>CareerLink</nav>", [
    ('<h1 class="job-title mb-0">', "CongViec", "</h1>"),
    ('<div id="job-location"><i></i><a href="#">', "ViTri", "</a></div>"),
    ('<div id="job-salary"><i></i><span class="text-primary">', "MucLuong", "</span></div>"),
    ('<div><i class="cli-suitcase-simple"></i> <span>', "YeuCauKinhNghiem", "</span></div>"),
    ('<div id="job-date"><div class="day-expired">Hết hạn: <b>', "HanNopHoSo", "</b></div></div>"),
    ('<h5 class="company-name-title"><a title="', "CongTy", '" href="/cl">Xem</a></h5>'),
    ('<i class="cli-users"></i><span>', "QuyMoCongTy", "</span>"),
    *[(f"<div>{label}</div><div>", col, "</div>") for label, col in (("Cấp bậc", "CapBac"), ("Học vấn", "HocVan"), ("Giới tính", "gender"), ("Ngành nghề", "LinhVuc"), ("Loại công việc", "HinhThucLamViec"))]])
_CAREERVIET_PAGE = _job_page("<nav>CareerViet</nav>", [
    ('<h1 class="title">', "CongViec", "</h1>"),
    ("<strong>Địa điểm</strong><p><a>", "ViTri", "</a></p>"),
    *[(f"<strong><em></em>{label}</strong>\n<p>".replace("<em></em>", ""), col, "</p>") for label, col in (("Ngành nghề", "LinhVuc"), ("Kinh nghiệm", "YeuCauKinhNghiem"), ("Lương", "MucLuong"),
      ("Cấp bậc", "CapBac"), ("Hình thức", "HinhThucLamViec"), ("Hết hạn nộp", "HanNopHoSo"))],
    ("<ul><li>Bằng cấp: ", "HocVan", "</li></ul>")])

# job pages of three sites that show the staging rows, each in its own markup
JOB_PAGES_SQL = f"""
SELECT row_id AS page_id, site, 'https://jobs.example.com/viec-lam/' || CAST(row_id AS STRING) || '.html' AS url,
  CASE site WHEN 'TopCV' THEN {_TOPCV_PAGE} WHEN 'CareerLink' THEN {_CAREERLINK_PAGE} ELSE {_CAREERVIET_PAGE} END AS html
FROM (SELECT *, CASE row_id % 3 WHEN 0 THEN 'TopCV' WHEN 1 THEN 'CareerLink' ELSE 'CareerViet' END AS site,
        CASE row_id % 2 WHEN 0 THEN 'Thứ 2 - Thứ 6' END AS work_time, CASE row_id % 4 WHEN 0 THEN 'Nam' WHEN 1 THEN 'Nữ' END AS gender FROM stg) s
"""

# their listing pages: cards in page order with repeats, some pages without a card
JOB_LISTING_PAGES_SQL = "SELECT DISTINCT site, CAST(floor(page_id / 30) AS INT) + 1 AS page FROM job_pages"
JOB_LISTING_SQL = """
SELECT p.site, CAST(floor(l.page_id / 30) AS INT) + 1 AS page, CAST(l.page_id % 30 AS INT) + 1 AS pos, p.url || '?src=list' || CAST(l.page_id % 2 AS STRING) AS link,
       CASE WHEN p.page_id % 11 <> 3 THEN CAST(p.page_id AS STRING) END AS job_id
FROM job_pages l JOIN job_pages p ON p.page_id = l.page_id - l.page_id % 6 + l.page_id % 3
WHERE (CAST(floor(l.page_id / 30) AS INT) + 1) % 9 <> 4 AND NOT (p.site = 'CareerLink' AND floor(l.page_id / 30) BETWEEN 40 AND 43)
"""
JOB_SEEN_SQL = "SELECT site, CAST(page_id AS STRING) AS job_id FROM job_pages WHERE page_id % 5 = 0 OR (site = 'CareerViet' AND floor(page_id / 30) BETWEEN 60 AND 64)"

STAGING_COLUMNS = ("CongViec", "ViTri", "YeuCauKinhNghiem", "MucLuong", "CapBac", "HinhThucLamViec", "CongTy",
                   "QuyMoCongTy", "SoLuongTuyen", "HocVan", "YeuCauUngVien", "MoTaCongViec", "QuyenLoi",
                   "HanNopHoSo", "LinkBaiTuyenDung", "Nguon", "NgayCaoDuLieu", "LinhVuc")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def register(spark: SparkSession, sf_dir: str, names=TABLES) -> None:
    for n in names:
        table(spark, sf_dir, n).createOrReplaceTempView(n)


def _listed(sql: str) -> str:
    """``sql`` with each ``split_part`` of a literal list of words as an element of
    the literal array of them, which Spark makes once instead of splitting it a row."""
    def element(found: re.Match) -> str:
        return f"element_at(array('{"', '".join(found[1].split("¦"))}'), {found[2]})"

    return re.sub(r"split_part\('([^']*)', '¦', (CAST\(k % \d+ AS INT\) \+ 1)\)", element, sql)


def stg(spark: SparkSession, sf_dir: str) -> DataFrame:
    register(spark, sf_dir, ("orders", "customer", "nation"))
    return spark.sql(_listed(STG_SQL))


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    register(spark, sf_dir, ("orders",))
    df = spark.sql(LISTING_SQL)
    df.createOrReplaceTempView("listing")
    return df


def seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    listing(spark, sf_dir)
    return spark.sql(SEEN_SQL)


def job_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    stg(spark, sf_dir).createOrReplaceTempView("stg")
    df = spark.sql(JOB_PAGES_SQL)
    df.createOrReplaceTempView("job_pages")
    return df


def job_crawl(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(job pages, listing cards, fetched listing pages, history) of the job sites;
    the pages are stored first, as those of a crawl are."""
    from .session import materialize
    pages = materialize(job_pages(spark, sf_dir), "job-pages")
    pages.createOrReplaceTempView("job_pages")
    return pages, materialize(spark.sql(JOB_LISTING_SQL), "job-listing"), spark.sql(JOB_LISTING_PAGES_SQL), spark.sql(JOB_SEEN_SQL)


def duck_prefix(*views: str) -> str:
    """CTE prefix defining the named fixture views for the DuckDB oracle."""
    parts = []
    sql = {"stg": STG_SQL, "listing": LISTING_SQL, "seen": SEEN_SQL, "job_pages": JOB_PAGES_SQL, "job_listing": JOB_LISTING_SQL,
           "job_listing_pages": JOB_LISTING_PAGES_SQL, "job_seen": JOB_SEEN_SQL}
    for v in views:
        parts.append(f"{v} AS ({sql[v]})")
    return "WITH " + ",\n".join(parts) + "\n"
