"""Salary, experience and company-size parsers.

Each parser returns a ``struct<min: double, max: double>`` Column; callers
materialise it once with ``withColumn`` and read the fields, so the regex
work runs once per row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import rules as R
from .text import band, contains_any, fmt_1dp, fmt_num, null_skip_mean, numbers, py_strip

NUM = r"\d+(?:\.\d+)?"


def _null() -> Column:
    return F.lit(None).cast("double")


def _pair(lo: Column, hi: Column) -> Column:
    return F.struct(lo.cast("double").alias("min"), hi.cast("double").alias("max"))



# ---------------------------------------------------------------------------
# salary
# ---------------------------------------------------------------------------


def salary_v1(raw: Column) -> Column:
    """v1 salary in VND: unit from currency words, first two numbers."""
    t = F.lower(F.coalesce(raw, F.lit("None")))
    unit = (F.when(t.contains("usd") | t.contains("$"), F.lit(25000.0))
            .when(contains_any(t, ("triệu", "tr", "millions", "m")), F.lit(1e6))
            .when(contains_any(t, ("nghìn", "k")), F.lit(1e3))
            .otherwise(F.lit(1.0)))
    nums = numbers(F.regexp_replace(t, ",", ""), f"({NUM})")
    n0 = F.get(nums, 0) * unit
    n1 = F.get(nums, 1) * unit
    zero = F.lit(0.0)
    one = (F.when(contains_any(t, R.SALARY_UPTO_V1), _pair(zero, n0))
           .when(contains_any(t, R.SALARY_FROM_V1), _pair(n0, zero))
           .otherwise(_pair(n0, n0)))
    return (F.when(F.size(nums) == 1, one)
            .when(F.size(nums) >= 2, _pair(n0, n1))
            .otherwise(_pair(zero, zero)))


def _salary_v2_text(raw: Column) -> Column:
    t = py_strip(F.lower(raw))
    for a, b in (("triệu", "tr"), ("nghìn", "k"), ("million", "m"), ("millions", "m")):
        t = F.replace(t, F.lit(a), F.lit(b))
    t = F.regexp_replace(t, r"(?<=\d),(?=\d{3})", "")
    return F.replace(t, F.lit(","), F.lit("."))


def salary_v2_values(raw: Column, fixed: bool = True) -> Column:
    """All amounts of a v2 salary text in million VND, rounded to 2 places.

    ``fixed=False`` reproduces the source exactly: its unit class captures
    one character, so "tr" is never recognised.  ``fixed=True`` matches
    ``tr|k|m`` and lets a number without a unit take the unit of the last
    number that has one ("10 - 15 triệu" -> 10, 15).
    """
    t = _salary_v2_text(raw)
    pat = rf"({NUM})(\s*(?:tr|k|m)?)" if fixed else rf"({NUM})(\s*[ktrm]?)"
    nums = numbers(t, pat, 1)
    units = F.transform(F.regexp_extract_all(t, F.lit(pat), 2), lambda u: F.trim(u))
    if fixed:
        last = F.try_element_at(F.filter(units, lambda u: u != ""), F.lit(-1))
        units = F.transform(units, lambda u: F.when(u == "", F.coalesce(last, F.lit(""))).otherwise(u))
    usd = t.contains("usd") | t.contains("$")

    def conv(n, u):
        in_usd = (F.when(u == "k", n * 1000).when(u == "m", n * 1000000).otherwise(n)) * 0.025
        in_vnd = (F.when(u == "k", n / 1000).when(u.isin("tr", "m"), n).otherwise(n / 1000000))
        return F.round(F.when(usd, in_usd).otherwise(in_vnd), 2)

    return F.zip_with(nums, units, conv)


def salary_v2(raw: Column, fixed: bool = True) -> Column:
    """v2 salary (million VND) as ``struct<min,max>``; 0 for unknown ends."""
    vals = salary_v2_values(raw, fixed)
    t = _salary_v2_text(raw)
    v = F.get(vals, 0)
    zero = F.lit(0.0)
    one = (F.when(contains_any(t, R.SALARY_UPTO_V2), _pair(zero, v))
           .when(contains_any(t, R.SALARY_FROM_V2), _pair(v, zero))
           .otherwise(_pair(v, v)))
    res = (F.when(F.size(vals) == 1, one)
           .when(F.size(vals) >= 2, _pair(F.array_min(vals), F.array_max(vals)))
           .otherwise(_pair(zero, zero)))
    return F.when(raw.isNull() | (raw == ""), _pair(zero, zero)).otherwise(res)


def salary_avg_v2(lo: Column, hi: Column) -> Column:
    """Mean when both ends are positive, else the non-zero end."""
    return F.when((lo > 0) & (hi > 0), (lo + hi) / 2).when(lo != 0, lo).otherwise(hi)


def salary_band_v1(avg_vnd: Column) -> Column:
    m = avg_vnd / 1000000
    return F.when(avg_vnd.isNull() | (avg_vnd == 0), F.lit("Thỏa thuận")).otherwise(band(m, R.SALARY_BANDS_V1))


def salary_band_v2(avg_m: Column) -> Column:
    return F.when(avg_m.isNull() | (avg_m == 0), F.lit("Thỏa thuận")).otherwise(band(avg_m, R.SALARY_BANDS_V2))


def salary_text(lo: Column, hi: Column) -> Column:
    """Display text: "a - b triệu", "a triệu", "Từ a triệu", "Đến b triệu"."""
    lo = F.coalesce(lo, F.lit(0.0))
    hi = F.coalesce(hi, F.lit(0.0))
    return (F.when((lo == 0) & (hi == 0), F.lit("Thỏa thuận"))
            .when((lo > 0) & (hi > 0) & (lo == hi), F.concat(fmt_1dp(lo), F.lit(" triệu")))
            .when((lo > 0) & (hi > 0), F.concat(fmt_1dp(lo), F.lit(" - "), fmt_1dp(hi), F.lit(" triệu")))
            .when(lo > 0, F.concat(F.lit("Từ "), fmt_1dp(lo), F.lit(" triệu")))
            .when(hi > 0, F.concat(F.lit("Đến "), fmt_1dp(hi), F.lit(" triệu")))
            .otherwise(F.lit("Thỏa thuận")))


# ---------------------------------------------------------------------------
# experience
# ---------------------------------------------------------------------------


def experience_v1(raw: Column, extended: bool = False) -> Column:
    """v1 years of experience as ``struct<min,max>`` (NULL ends when unknown).

    ``extended=True`` is the superseded variant with extra no-experience
    phrases and the ``>``/``<`` markers.
    """
    t = py_lower_strip(raw)
    nums0 = numbers(t, f"({NUM})")
    months = t.contains("tháng") & ~t.contains("năm")
    nums = F.when(months, F.transform(nums0, lambda n: n / 12)).otherwise(nums0)
    n0 = F.get(nums, 0)
    no_exp = R.NO_EXPERIENCE_V1_EXTENDED if extended else R.NO_EXPERIENCE_V1
    over = ("trên", "hơn", "over", ">") if extended else ("trên", "hơn", "over")
    under = ("dưới", "less than", "<") if extended else ("dưới", "less")
    sorted_nums = F.array_sort(nums)
    res = (F.when(raw.isNull() | (raw == ""), _pair(_null(), _null()))
           .when(contains_any(t, no_exp), _pair(F.lit(0.0), F.lit(0.0)))
           .when(F.size(nums) == 0, _pair(_null(), _null()))
           .when(t.contains("dưới 1 năm"), _pair(F.lit(0.0), F.lit(1.0)))
           .when(contains_any(t, over), _pair(n0, _null()))
           .when(contains_any(t, under), _pair(F.lit(0.0), n0))
           .when(F.size(nums) >= 2, _pair(F.get(sorted_nums, 0), F.element_at(sorted_nums, -1)))
           .otherwise(_pair(n0, n0)))
    return res


def experience_v1_coalesced(primary: Column, fallback: Column, extended: bool = False) -> Column:
    """Use the fallback text only when the primary gives neither end."""
    p = experience_v1(primary, extended)
    f = experience_v1(fallback, extended)
    return F.when(p["min"].isNull() & p["max"].isNull(), f).otherwise(p)


def experience_v2(raw: Column) -> Column:
    """v2 strict parser: only numbers followed by "năm"/"year" count."""
    t = F.lower(raw)
    nums = numbers(t, rf"({NUM})\s*(?:năm|year)")
    n0 = F.get(nums, 0)
    one = (F.when(t.contains("trên") | t.contains("hơn"), _pair(n0, _null()))
           .when(t.contains("dưới"), _pair(F.lit(0.0), n0))
           .otherwise(_pair(n0, n0)))
    return (F.when(raw.isNull() | contains_any(t, R.NO_EXPERIENCE_V2), _pair(F.lit(0.0), F.lit(0.0)))
            .when(F.size(nums) == 0, _pair(_null(), _null()))
            .when(F.size(nums) == 1, one)
            .otherwise(_pair(F.array_min(nums), F.array_max(nums))))


def experience_avg(lo: Column, hi: Column) -> Column:
    return null_skip_mean(lo, hi)


def experience_band_v1(avg: Column) -> Column:
    return (F.when(avg.isNull(), F.lit("Khác"))
            .when(avg == 0, F.lit("Không yêu cầu kinh nghiệm"))
            .when(avg < 0, F.lit("Khác"))
            .otherwise(band(avg, R.EXPERIENCE_BANDS_V1)))


def experience_band_v2(avg: Column) -> Column:
    return F.when(avg.isNull() | (avg == 0), F.lit("Không yêu cầu")).otherwise(band(avg, R.EXPERIENCE_BANDS_V2))


def experience_text(lo: Column, hi: Column) -> Column:
    """"a năm", "a - b năm", "Trên a năm", "Dưới b năm" or "Không yêu cầu"."""
    return (F.when(lo.isNull() & hi.isNull(), F.lit("Không yêu cầu"))
            .when((lo == 0) & (hi == 0), F.lit("Không yêu cầu"))
            .when(lo.isNotNull() & hi.isNotNull() & (lo == hi), F.concat(fmt_num(lo), F.lit(" năm")))
            .when(lo.isNotNull() & hi.isNotNull(), F.concat(fmt_num(lo), F.lit(" - "), fmt_num(hi), F.lit(" năm")))
            .when(lo.isNotNull(), F.concat(F.lit("Trên "), fmt_num(lo), F.lit(" năm")))
            .otherwise(F.concat(F.lit("Dưới "), fmt_num(hi), F.lit(" năm"))))


# ---------------------------------------------------------------------------
# company size
# ---------------------------------------------------------------------------


def _size_nums(t: Column) -> Column:
    return numbers(F.regexp_replace(t, r"[.,]", ""), r"(\d+)")


def size_v1(raw: Column, extended: bool = False) -> Column:
    """v1: qualifiers "dưới/ít hơn" -> (0,n), "trên/hơn" -> (n,NULL)."""
    t = F.lower(raw)
    nums = _size_nums(t)
    clean = F.regexp_replace(t, r"[.,]", "")
    under = ("dưới", "ít hơn", "less than") if extended else ("dưới", "ít hơn")
    over = ("trên", "hơn", "over", "+") if extended else ("trên", "hơn")
    n0 = F.get(nums, 0)
    s = F.array_sort(nums)
    bad = raw.isNull() | (raw == "")
    if extended:
        bad = bad | (F.upper(raw) == "NULL")
    return (F.when(bad | (F.size(nums) == 0), _pair(_null(), _null()))
            .when(contains_any(clean, under), _pair(F.lit(0.0), n0))
            .when(contains_any(clean, over), _pair(n0, _null()))
            .when(F.size(nums) >= 2, _pair(F.get(s, 0), F.element_at(s, -1)))
            .otherwise(_pair(n0, n0)))


def size_avg_v1(lo: Column, hi: Column) -> Column:
    return F.when(lo.isNull(), _null()).when(hi.isNull(), lo).otherwise((lo + hi) / 2)


def size_band_v1(avg: Column) -> Column:
    return F.when(avg.isNull() | (avg < 0), F.lit("Không xác định")).otherwise(band(avg, R.SIZE_BANDS_V1))


def size_v2(raw: Column) -> Column:
    """v2: smallest and largest number, no qualifier logic."""
    nums = _size_nums(raw)
    return (F.when(raw.isNull() | (raw == "") | (F.size(nums) == 0), _pair(_null(), _null()))
            .otherwise(_pair(F.array_min(nums), F.array_max(nums))))


def size_text(lo: Column, hi: Column) -> Column:
    lo_i = lo.cast("bigint").cast("string")
    hi_i = hi.cast("bigint").cast("string")
    return (F.when(lo.isNull(), F.lit("Không xác định"))
            .when(lo == hi, F.concat(lo_i, F.lit(" nhân viên")))
            .otherwise(F.concat(lo_i, F.lit(" - "), hi_i, F.lit(" nhân viên"))))


def size_class_v2(hi: Column) -> Column:
    """Class from the largest number in the size text."""
    return F.when(hi.isNull(), F.lit("Không xác định")).otherwise(band(hi, R.SIZE_CLASS_V2))


def py_lower_strip(c: Column) -> Column:
    return py_strip(F.lower(c))


# ---------------------------------------------------------------------------
# Layered forms used by the pipelines.
#
# The Column forms above reuse sub-expressions (the lowered text, the
# number array) several times; composed into one projection they copy those
# trees.  The forms below compute each shared value once as a temporary
# column in its own projection (Catalyst does not inline a non-trivial
# expression that is referenced more than once), then build the result
# from the temporaries.  All return ``df`` plus a struct column ``out``.
# ---------------------------------------------------------------------------


def _tmp(out: str, name: str) -> str:
    return f"__{out}_{name}"


def _finish(df: DataFrame, out: str, result: Column, temps: list[str]) -> DataFrame:
    return df.withColumn(out, result).drop(*temps)


def parse_salary_v1(df: DataFrame, src: str, out: str) -> DataFrame:
    t, n = _tmp(out, "t"), _tmp(out, "n")
    df = df.withColumn(t, F.lower(F.coalesce(F.col(src), F.lit("None"))))
    df = df.withColumn(n, numbers(F.regexp_replace(F.col(t), ",", ""), f"({NUM})"))
    tc, nums = F.col(t), F.col(n)
    unit = (F.when(tc.contains("usd") | tc.contains("$"), F.lit(25000.0))
            .when(contains_any(tc, ("triệu", "tr", "millions", "m")), F.lit(1e6))
            .when(contains_any(tc, ("nghìn", "k")), F.lit(1e3))
            .otherwise(F.lit(1.0)))
    n0 = F.get(nums, 0) * unit
    n1 = F.get(nums, 1) * unit
    zero = F.lit(0.0)
    one = (F.when(contains_any(tc, R.SALARY_UPTO_V1), _pair(zero, n0))
           .when(contains_any(tc, R.SALARY_FROM_V1), _pair(n0, zero))
           .otherwise(_pair(n0, n0)))
    res = (F.when(F.size(nums) == 1, one).when(F.size(nums) >= 2, _pair(n0, n1)).otherwise(_pair(zero, zero)))
    return _finish(df, out, res, [t, n])


def parse_salary_v2(df: DataFrame, src: str, out: str, fixed: bool = True) -> DataFrame:
    t, u, n, v = _tmp(out, "t"), _tmp(out, "u"), _tmp(out, "n"), _tmp(out, "v")
    pat = rf"({NUM})(\s*(?:tr|k|m)?)" if fixed else rf"({NUM})(\s*[ktrm]?)"
    df = df.withColumn(t, _salary_v2_text(F.col(src)))
    df = (df.withColumn(n, numbers(F.col(t), pat, 1))
            .withColumn(u, F.transform(F.regexp_extract_all(F.col(t), F.lit(pat), 2), lambda x: F.trim(x))))
    units = F.col(u)
    if fixed:
        last = F.try_element_at(F.filter(units, lambda x: x != ""), F.lit(-1))
        units = F.transform(units, lambda x: F.when(x == "", F.coalesce(last, F.lit(""))).otherwise(x))
    tc = F.col(t)
    usd = tc.contains("usd") | tc.contains("$")

    def conv(num, unit):
        in_usd = (F.when(unit == "k", num * 1000).when(unit == "m", num * 1000000).otherwise(num)) * 0.025
        in_vnd = (F.when(unit == "k", num / 1000).when(unit.isin("tr", "m"), num).otherwise(num / 1000000))
        return F.round(F.when(usd, in_usd).otherwise(in_vnd), 2)

    df = df.withColumn(v, F.zip_with(F.col(n), units, conv))
    vals, raw = F.col(v), F.col(src)
    first = F.get(vals, 0)
    zero = F.lit(0.0)
    one = (F.when(contains_any(tc, R.SALARY_UPTO_V2), _pair(zero, first))
           .when(contains_any(tc, R.SALARY_FROM_V2), _pair(first, zero))
           .otherwise(_pair(first, first)))
    res = (F.when(raw.isNull() | (raw == ""), _pair(zero, zero))
           .when(F.size(vals) == 1, one)
           .when(F.size(vals) >= 2, _pair(F.array_min(vals), F.array_max(vals)))
           .otherwise(_pair(zero, zero)))
    return _finish(df, out, res, [t, u, n, v])


def _exp_v1_from(t: Column, raw: Column, nums: Column, extended: bool) -> Column:
    n0 = F.get(nums, 0)
    no_exp = R.NO_EXPERIENCE_V1_EXTENDED if extended else R.NO_EXPERIENCE_V1
    over = ("trên", "hơn", "over", ">") if extended else ("trên", "hơn", "over")
    under = ("dưới", "less than", "<") if extended else ("dưới", "less")
    return (F.when(raw.isNull() | (raw == ""), _pair(_null(), _null()))
            .when(contains_any(t, no_exp), _pair(F.lit(0.0), F.lit(0.0)))
            .when(F.size(nums) == 0, _pair(_null(), _null()))
            .when(t.contains("dưới 1 năm"), _pair(F.lit(0.0), F.lit(1.0)))
            .when(contains_any(t, over), _pair(n0, _null()))
            .when(contains_any(t, under), _pair(F.lit(0.0), n0))
            .when(F.size(nums) >= 2, _pair(F.array_min(nums), F.array_max(nums)))
            .otherwise(_pair(n0, n0)))


def parse_experience_v1(df: DataFrame, src: str, out: str, extended: bool = False) -> DataFrame:
    t, n0, n = _tmp(out, "t"), _tmp(out, "n0"), _tmp(out, "n")
    df = df.withColumn(t, py_strip(F.lower(F.col(src))))
    df = df.withColumn(n0, numbers(F.col(t), f"({NUM})"))
    months = F.col(t).contains("tháng") & ~F.col(t).contains("năm")
    df = df.withColumn(n, F.when(months, F.transform(F.col(n0), lambda x: x / 12)).otherwise(F.col(n0)))
    return _finish(df, out, _exp_v1_from(F.col(t), F.col(src), F.col(n), extended), [t, n0, n])


def parse_experience_v1_coalesced(df: DataFrame, primary: str, fallback: str, out: str,
                                  extended: bool = False) -> DataFrame:
    p, f = _tmp(out, "p"), _tmp(out, "f")
    df = parse_experience_v1(df, primary, p, extended)
    df = parse_experience_v1(df, fallback, f, extended)
    pc = F.col(p)
    res = F.when(pc["min"].isNull() & pc["max"].isNull(), F.col(f)).otherwise(pc)
    return _finish(df, out, res, [p, f])


def parse_experience_v2(df: DataFrame, src: str, out: str) -> DataFrame:
    t, n = _tmp(out, "t"), _tmp(out, "n")
    df = df.withColumn(t, F.lower(F.col(src)))
    df = df.withColumn(n, numbers(F.col(t), rf"({NUM})\s*(?:năm|year)"))
    tc, nums, raw = F.col(t), F.col(n), F.col(src)
    n0 = F.get(nums, 0)
    one = (F.when(tc.contains("trên") | tc.contains("hơn"), _pair(n0, _null()))
           .when(tc.contains("dưới"), _pair(F.lit(0.0), n0))
           .otherwise(_pair(n0, n0)))
    res = (F.when(raw.isNull() | contains_any(tc, R.NO_EXPERIENCE_V2), _pair(F.lit(0.0), F.lit(0.0)))
           .when(F.size(nums) == 0, _pair(_null(), _null()))
           .when(F.size(nums) == 1, one)
           .otherwise(_pair(F.array_min(nums), F.array_max(nums))))
    return _finish(df, out, res, [t, n])


def parse_size_v1(df: DataFrame, src: str, out: str, extended: bool = False) -> DataFrame:
    c, n = _tmp(out, "c"), _tmp(out, "n")
    df = df.withColumn(c, F.regexp_replace(F.lower(F.col(src)), r"[.,]", ""))
    df = df.withColumn(n, numbers(F.col(c), r"(\d+)"))
    clean, nums, raw = F.col(c), F.col(n), F.col(src)
    under = ("dưới", "ít hơn", "less than") if extended else ("dưới", "ít hơn")
    over = ("trên", "hơn", "over", "+") if extended else ("trên", "hơn")
    bad = raw.isNull() | (raw == "")
    if extended:
        bad = bad | (F.upper(raw) == "NULL")
    n0 = F.get(nums, 0)
    res = (F.when(bad | (F.size(nums) == 0), _pair(_null(), _null()))
           .when(contains_any(clean, under), _pair(F.lit(0.0), n0))
           .when(contains_any(clean, over), _pair(n0, _null()))
           .when(F.size(nums) >= 2, _pair(F.array_min(nums), F.array_max(nums)))
           .otherwise(_pair(n0, n0)))
    return _finish(df, out, res, [c, n])


def parse_size_v2(df: DataFrame, src: str, out: str) -> DataFrame:
    n = _tmp(out, "n")
    df = df.withColumn(n, _size_nums(F.col(src)))
    nums, raw = F.col(n), F.col(src)
    res = (F.when(raw.isNull() | (raw == "") | (F.size(nums) == 0), _pair(_null(), _null()))
           .otherwise(_pair(F.array_min(nums), F.array_max(nums))))
    return _finish(df, out, res, [n])
