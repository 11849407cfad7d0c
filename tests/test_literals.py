"""Literal cases (FIXTURES.md §3) for the per-row operators."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from jobsift.functions import classify as C
from jobsift.functions import html as H
from jobsift.functions import parsers as P
from jobsift.functions.dates import deadline_v1, deadline_v2
from jobsift.functions.text import title_case
from jobsift.operators.geo import geo_explode_v1, geo_explode_v2


def one(spark, value, fn, schema="x string"):
    df = spark.createDataFrame([(value,)], schema)
    return df.select(fn(F.col("x")).alias("r")).first()["r"]


def struct_of(spark, value, parse):
    df = spark.createDataFrame([(value,)], "x string")
    r = parse(df, "x", "o").select("o").first()["o"]
    return (r["min"], r["max"])


@pytest.mark.parametrize("url,html_id,tail_id", [
    ("https://x/abc/1932273.html", "1932273", None),
    ("https://x/job/3305731?src=1", None, "3305731"),
    ("https://x/job/none", None, None),
])
def test_url_job_id(spark, url, html_id, tail_id):
    assert one(spark, url, lambda c: H.url_job_id(c, H.JOB_ID_HTML)) == html_id
    assert one(spark, url, lambda c: H.url_job_id(c, H.JOB_ID_TAIL)) == tail_id


def test_max_page(spark):
    assert one(spark, "1 / 82 trang", H.max_page_text) == 82
    assert one(spark, "no pages", H.max_page_text) == 1
    assert one(spark, "1048 việc làm CNTT", H.max_page_count) == 21
    assert one(spark, "?page=2 ?page=17 page=3", H.max_page_links) == 17


def test_page_url(spark):
    df = spark.createDataFrame([("https://s/it-sortdv-vi.html", 3), ("https://s/it-sortdv-vi.html", 1),
                                ("https://s/jobs", 2)], "b string, p int")
    got = [r[0] for r in df.select(H.page_url(F.col("b"), F.col("p"))).collect()]
    assert got == ["https://s/it-sortdv-trang-3-vi.html", "https://s/it-sortdv-vi.html", "https://s/jobs?page=2"]


def test_deadlines(spark):
    df = spark.createDataFrame([("Hạn nộp hồ sơ: 30/04/2025", dt.date(2025, 4, 1)),
                                ("Còn 20 ngày tới", dt.date(2025, 4, 1)),
                                ("31/02/2025", dt.date(2025, 1, 1)),
                                (None, dt.date(2025, 1, 1)),
                                ("5-6-2025", dt.date(2025, 1, 1))], "raw string, d date")
    v1 = [r[0] for r in df.select(deadline_v1(F.col("raw"), F.col("d"))).collect()]
    v2 = [r[0] for r in df.select(deadline_v2(F.col("raw"), F.col("d"), "2025-01-01")).collect()]
    assert v1[:3] == [dt.date(2025, 4, 30), dt.date(2025, 4, 21), None]
    assert v1[4] == dt.date(2025, 6, 5)
    assert v2[2] == dt.date(2025, 1, 31) and v2[3] == dt.date(2025, 1, 31) and v2[4] == dt.date(2025, 6, 5)


def test_salary(spark):
    assert struct_of(spark, "Up to 2,000 USD", P.parse_salary_v1) == (0.0, 50_000_000.0)
    assert struct_of(spark, "10 - 15 triệu", P.parse_salary_v1) == (10_000_000.0, 15_000_000.0)
    assert struct_of(spark, "Thỏa thuận", P.parse_salary_v1) == (0.0, 0.0)
    legacy = lambda df, s, o: P.parse_salary_v2(df, s, o, fixed=False)
    assert struct_of(spark, "10 - 15 triệu", legacy) == (0.0, 0.0)
    assert struct_of(spark, "10 - 15 triệu", P.parse_salary_v2) == (10.0, 15.0)
    assert struct_of(spark, "1000 usd", legacy) == (25.0, 25.0)
    assert struct_of(spark, "1000 usd", P.parse_salary_v2) == (25.0, 25.0)


def test_salary_text_half_up(spark):
    df = spark.createDataFrame([(2.25, 0.0), (10.0, 15.0), (12.0, 12.0)], "a double, b double")
    got = [r[0] for r in df.select(P.salary_text(F.col("a"), F.col("b"))).collect()]
    assert got == ["Từ 2.3 triệu", "10.0 - 15.0 triệu", "12.0 triệu"]


def test_experience(spark):
    assert struct_of(spark, "6 tháng", P.parse_experience_v1) == (0.5, 0.5)
    assert struct_of(spark, "Trên 5 năm", P.parse_experience_v1) == (5.0, None)
    assert struct_of(spark, "Dưới 1 năm", P.parse_experience_v1) == (0.0, 1.0)
    assert struct_of(spark, "1 - 2 năm", P.parse_experience_v2) == (2.0, 2.0)
    assert struct_of(spark, "6 tháng", P.parse_experience_v2) == (None, None)
    assert struct_of(spark, None, P.parse_experience_v2) == (0.0, 0.0)


def test_size(spark):
    assert struct_of(spark, "Trên 1.000 nhân viên", P.parse_size_v1) == (1000.0, None)
    assert struct_of(spark, "Trên 1.000 nhân viên", P.parse_size_v2) == (1000.0, 1000.0)
    assert one(spark, 499.0, P.size_class_v2, "x double") == "Trung bình thấp"


def test_headcount(spark):
    df = spark.createDataFrame([("Số lượng lớn", "Dev"), ("2025", "tuyển 12 người"), (None, "Dev")], "q string, t string")
    got = [r["o"] for r in C.add_headcount(df, "q", "t", "o").collect()]
    assert got == [999, 12, 1]


def test_rank_title_case(spark):
    assert one(spark, "Phó giám đốc công nghệ", C.rank_v1) == "Giám đốc"
    assert one(spark, "công ty a-b co.op", title_case) == "Công Ty A-B Co.Op"
    assert one(spark, "Cty TNHH O'Neil", title_case) == "Cty Tnhh O'Neil"


def test_skills_word_boundary(spark):
    assert one(spark, "python, sql và tiếng anh", lambda c: C.skills_v2(c, "hard")) == "Python, SQL"
    # Python's \W is Unicode-aware: "đsqlđ" is one word, so no SQL match
    assert one(spark, "đsqlđ", lambda c: C.skills_v2(c, "hard")) == "Không yêu cầu"
    assert one(spark, "c++ / c#", lambda c: C.skills_v2(c, "hard")) == "C#, C++"


def test_geo_v2(spark):
    df = spark.createDataFrame([("l1", "Quận 1, TP.HCM"), ("l2", "Singapore"), ("l3", "Hà Nội; Đà Nẵng")],
                               "LinkBaiTuyenDung string, ViTri string")
    rows = {(r["LinkBaiTuyenDung"], r["Tinh_Thanh"], r["KhuVuc"]) for r in geo_explode_v2(df).collect()}
    assert rows == {("l1", "TP. Hồ Chí Minh", "Nam"), ("l3", "TP. Hà Nội", "Bắc"), ("l3", "TP. Đà Nẵng", "Trung")}


def test_geo_v1(spark):
    df = spark.createDataFrame([("Tại Bắc Giang - Bắc Ninh",), (None,)], "ViTri string")
    rows = sorted(((r["Tinh_Thanh"], r["ViTri_clean"], r["Latitude"]) for r in geo_explode_v1(df).collect()),
                  key=str)
    assert ("Bắc Ninh", "Bắc Giang", 21.2731) in rows and ("Bắc Ninh", "Bắc Ninh", 21.1861) in rows
    assert ("Khác", None, None) in rows


def test_html_to_text(spark):
    html = '<html lang="vi"><head><title>T &amp; U</title><script>var x="<p>";</script></head><body><p>A<br>B</p></body></html>'
    assert one(spark, html, H.html_to_text) == "T & U A B"
    assert one(spark, "Quy mô: 100 - 499", H.kv_value) == "100 - 499"


def test_day_first_dates_as_pandas_parses_them(spark):
    """Literals against the parser of the source (a date of two digits of a year near 2025)."""
    import pandas as pd
    from jobsift.functions.dates import day_first
    texts = ["5/6/2025", "05.06.25", "5-6-25 14:30", "2025-6-15", "2025-06-30 10:00", "13/14/2025", "06/13/2025", "31/02/2025", "5 jun 2025", "jun 5 2025", "20250605", "5/6/68", "5,6,2025",
             "5 6 2025", "15/6/2025 23:59", "6/2025", "2025-06", "12-2025", "5-jun-25", "2025", "30", "1.5", "thỏa thuận", "5/6/2025 10:30:15 pm", "29/02/2024", "29/02/2025", "december 31, 2025", "5/6/2025 25:00"]
    got = [r["d"] for r in spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "i int, t string").select("i", day_first(F.col("t")).alias("d")).orderBy("i").collect()]
    for text, mine in zip(texts, got, strict=True):
        want = pd.to_datetime(text, dayfirst=True, errors="coerce")
        assert (None if pd.isna(want) else want.date()) == mine, text
    # two digits: at most 49 years ahead; year-first dates are read as they stand unless asked otherwise
    one = spark.createDataFrame([("1/2/74", "1/2/75", "2025-06-05")], "a string, b string, c string")
    row = one.select(day_first(F.col("a")), day_first(F.col("b")), day_first(F.col("c")), day_first(F.col("c"), iso_swapped=True)).first()
    assert [str(x) for x in row] == ["2074-02-01", "1975-02-01", "2025-06-05", "2025-05-06"]


def test_strip_removes_every_white_space_of_the_pattern(spark):
    from jobsift.functions.text import WS, WS_CHARS, py_strip
    df = spark.range(1, 0x10000).where("id < 55296 OR id > 57343").select(F.expr("decode(unhex(lpad(hex(id), 4, '0')), 'UTF-16BE')").alias("c"))
    assert {r["c"] for r in df.where(F.col("c").rlike(WS)).collect()} == set(WS_CHARS)
    t = df.select("c", F.concat("c", F.lit("a \né"), "c", "c").alias("t"))
    assert t.where(py_strip(F.col("t")) != F.regexp_replace("t", rf"^{WS}+|{WS}+$", "")).isEmpty()


def test_rules_compute_their_text_once_a_row(spark):
    """A rule table names its text once a keyword: over 150 times for the v1 titles."""
    df = spark.range(1).select(F.col("id").cast("string").alias("title"))
    for rule in (C.title_class_v1, C.rank_v1, C.job_role_v2, C.industry_sub_v2, C.industry_macro_v2, C.industry_v1, C.education_v1):
        plan = df.select(rule(F.col("title")).alias("o"))._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("lower(") == 1, rule.__name__


def test_headcount_of_titles_with_and_without_numbers(spark):
    rows = [(None, "Tuyển 12 người"), (None, "không số"), (None, None), ("", "tuyển 2025 nhân viên"), ("1", "số lượng: 7"), (None, "5 slot, 9 bạn")]
    df = spark.createDataFrame(rows, "q string, t string")
    assert [r["o"] for r in C.add_headcount(df, "q", "t", "o").collect()] == [12, 1, 1, 1, 7, 9]
