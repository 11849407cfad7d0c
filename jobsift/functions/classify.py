"""Keyword-rule classifiers (C18-C32): titles, ranks, industries,
education, skills, employment type / work mode, headcount."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import rules as R
from .text import contains_any, first_match, labels_found, py_str, py_strip, title_case

# ---------------------------------------------------------------------------
# titles
# ---------------------------------------------------------------------------


def title_clean_v2(title: Column) -> Column:
    """Remove hiring noise, keep word chars and ``-+#./&``, title-case."""
    t = F.lower(title)
    for pat in R.TITLE_NOISE_V2:
        t = F.regexp_replace(t, pat, " ")
    t = F.regexp_replace(t, rf"[^\p{{L}}\p{{N}}_\s\-+#./&]", " ")
    t = py_strip(F.regexp_replace(t, r"\s+", " "))
    return F.when(t == "", F.lit(None).cast("string")).otherwise(title_case(t))


# The pipelines give the classifiers the lowered text as ``low``, a column that
# several of them share (see ``lowered``).


def lowered(df: DataFrame, texts: dict[str, str]) -> DataFrame:
    """``df`` and the lowered texts of these columns under the names given."""
    return df.select("*", *[F.lower(F.col(c)).alias(out) for c, out in texts.items()])


def _first(text: Column, low: Column | None, rules, default: str) -> Column:
    return first_match(F.lower(text) if low is None else low, rules, default)


def _first_of_str(text: Column, low: Column | None, rules, default: str) -> Column:
    """The same of ``str(x)``: a missing text is "None"."""
    return first_match(F.coalesce(F.lower(text) if low is None else low, F.lit("none")), rules, default)


def title_text_v1(title: Column) -> Column:
    """The lowered title without v1's noise words."""
    t = F.lower(title)
    for pat in R.TITLE_NOISE_V1:
        t = F.regexp_replace(t, pat, "")
    return py_strip(t)


def title_class_v1(title: Column) -> Column:
    """v1 standard job title: strip noise words then first of 32 groups."""
    return F.when(title.isNull(), F.lit("Khác")).otherwise(first_match(title_text_v1(title), R.JOB_TITLE_V1, "Khác"))


def job_role_v2(title: Column, low: Column | None = None) -> Column:
    return F.when(title.isNull() | (title == ""), F.lit("Khác")).otherwise(
        _first(title, low, R.JOB_ROLE_V2, "Khác"))


def industry_sub_v2(title: Column, low: Column | None = None) -> Column:
    return _first_of_str(title, low, R.INDUSTRY_SUB_V2, "IT - Khác")


def industry_macro_v2(industry: Column, low: Column | None = None) -> Column:
    blank = industry.isNull() | (py_strip(industry) == "")
    return F.when(blank, F.lit("Khác")).otherwise(_first(industry, low, R.INDUSTRY_MACRO_V2, "Khác"))


def industry_v1(industry: Column, low: Column | None = None) -> Column:
    return _first_of_str(industry, low, R.INDUSTRY_V1, "Khác")


# ---------------------------------------------------------------------------
# rank
# ---------------------------------------------------------------------------


def rank_v1(title: Column, low: Column | None = None) -> Column:
    return _first_of_str(title, low, R.RANK_V1, "Nhân viên")


def title_rank_v2(title: Column, low: Column | None = None) -> Column:
    """Rank from title keywords."""
    missing = title.isNull() | (title == "") | (title == "N/A")
    return F.when(missing, F.lit("Junior")).otherwise(_first(title, low, R.RANK_V2, "Junior"))


def refine_rank_v2(rank: Column, exp_avg: Column) -> Column:
    """"Junior" is refined by mean experience."""
    refined = (F.when(exp_avg >= 5, F.lit("Senior"))
               .when(exp_avg >= 3, F.lit("Mid-level"))
               .when(exp_avg >= 1, F.lit("Junior"))
               .otherwise(F.lit("Fresher")))
    return F.when((rank == "Junior") & exp_avg.isNotNull(), refined).otherwise(rank)


def rank_v2(title: Column, exp_avg: Column) -> Column:
    return refine_rank_v2(title_rank_v2(title), exp_avg)


# ---------------------------------------------------------------------------
# education
# ---------------------------------------------------------------------------


def education_v1(level: Column, low: Column | None = None) -> Column:
    return _first_of_str(level, low, R.EDUCATION_V1, "Không yêu cầu")


def _education_v2_one(text: Column, low: Column | None = None) -> Column:
    return F.when(text.isNull() | (text == ""), F.lit("Không yêu cầu")).otherwise(
        _first(text, low, R.EDUCATION_V2, "Không yêu cầu"))


def education_v2(primary: Column, fallback: Column) -> Column:
    p = _education_v2_one(primary)
    return F.when(p == "Không yêu cầu", _education_v2_one(fallback)).otherwise(p)


# ---------------------------------------------------------------------------
# skills
# ---------------------------------------------------------------------------


def skills_v2(text: Column, kind: str) -> Column:
    """Sorted skill labels of one kind (hard/soft/language) or "Không yêu cầu"."""
    found = labels_found(F.lower(text), R.SKILLS_V2[kind], escape=True)
    return F.when(text.isNull() | (found == ""), F.lit("Không yêu cầu")).otherwise(found)


def skills_v1(description: Column, requirement: Column) -> Column:
    """struct<hard, soft>: sorted labels over description + requirement.

    The source uses its keywords as raw regular expressions.
    """
    txt = F.lower(F.concat(py_str(description), F.lit(" "), py_str(requirement)))
    return F.struct(labels_found(txt, R.SKILLS_V1["hard"], escape=False).alias("hard"),
                    labels_found(txt, R.SKILLS_V1["soft"], escape=False).alias("soft"))


# ---------------------------------------------------------------------------
# employment type / work mode
# ---------------------------------------------------------------------------


def workstyle_v1(employment: Column, description: Column) -> Column:
    """struct<employment, mode> from employment text + description."""
    txt = F.lower(F.concat_ws(" ", F.coalesce(employment, F.lit("")), F.coalesce(description, F.lit(""))))
    both_null = employment.isNull() & description.isNull()
    emp = first_match(txt, R.EMPLOYMENT_V1, "Full-time")
    mode = first_match(txt, R.WORK_MODE_V1, "Onsite")
    return F.struct(F.when(both_null, F.lit("Full-time")).otherwise(emp).alias("employment"),
                    F.when(both_null, F.lit("Onsite")).otherwise(mode).alias("mode"))


def workstyle_v2(*text_columns: Column) -> Column:
    """struct<employment, mode> over the whole row's text (source: ``str(row)``)."""
    txt = F.lower(F.concat_ws(" ", *text_columns))
    return F.struct(first_match(txt, R.EMPLOYMENT_V2, "Full-time").alias("employment"),
                    first_match(txt, R.WORK_MODE_V2, "Onsite").alias("mode"))


# ---------------------------------------------------------------------------
# headcount
# ---------------------------------------------------------------------------


def _title_number(t: Column, pattern: str) -> Column:
    """The number that ``pattern`` finds; a text that it does not find is not
    cast, as each failing cast to a decimal raises and catches an error."""
    v = F.regexp_extract(t, pattern, 1)
    return F.when(v != "", v).try_cast("decimal(38,0)")


def headcount(quantity: Column, title: Column) -> Column:
    """Openings: bulk words -> 999; largest number < 1000 in the quantity
    column when > 1; else the largest 1 < n < 200 found by the title
    patterns; default 1."""
    raw = F.coalesce(quantity, F.lit(""))
    col_nums = F.filter(F.transform(F.regexp_extract_all(raw, F.lit(r"(\d+)"), 1),
                                    lambda x: x.try_cast("decimal(38,0)")),
                        lambda x: x < 1000)
    from_col = F.coalesce(F.array_max(col_nums), F.lit(1)).cast("int")
    t = F.lower(F.coalesce(title, F.lit("")))
    found = []
    for pat in R.HEADCOUNT_TITLE_PATTERNS:
        v = _title_number(t, pat)
        found.append(F.when((v > 1) & (v < 200), v))
    from_title = F.coalesce(F.greatest(*found), F.lit(1)).cast("int")
    return (F.when(contains_any(F.lower(raw), R.HEADCOUNT_BULK), F.lit(999))
            .when(from_col > 1, from_col)
            .otherwise(F.greatest(from_col, from_title))).cast("int")




# ---------------------------------------------------------------------------
# Layered forms (shared values computed once as temporary columns)
# ---------------------------------------------------------------------------


def add_headcount(df: DataFrame, quantity: str, title: str, out: str) -> DataFrame:
    raw, t, cn = f"__{out}_raw", f"__{out}_t", f"__{out}_cn"
    low = F.lower(F.col(title))
    # every pattern asks for a digit, which few titles have
    df = df.withColumn(raw, F.coalesce(F.col(quantity), F.lit(""))).withColumn(t, F.when(low.rlike(r"\d"), low))
    vals = [f"__{out}_v{i}" for i in range(len(R.HEADCOUNT_TITLE_PATTERNS))]
    df = df.select("*", F.array_max(F.filter(
        F.regexp_extract_all(F.col(raw), F.lit(r"(\d+)"), 1).try_cast("array<decimal(38,0)>"),
        lambda x: x < 1000)).alias(cn),
        *[_title_number(F.col(t), pat).alias(v)
          for pat, v in zip(R.HEADCOUNT_TITLE_PATTERNS, vals)])
    from_col = F.coalesce(F.col(cn), F.lit(1)).cast("int")
    found = [F.when((F.col(v) > 1) & (F.col(v) < 200), F.col(v)) for v in vals]
    from_title = F.coalesce(F.greatest(*found), F.lit(1)).cast("int")
    res = (F.when(contains_any(F.lower(F.col(raw)), R.HEADCOUNT_BULK), F.lit(999))
           .when(from_col > 1, from_col)
           .otherwise(F.greatest(from_col, from_title))).cast("int")
    return df.withColumn(out, res).drop(raw, t, cn, *vals)


def add_title_clean_v2(df: DataFrame, title: str, out: str) -> DataFrame:
    t = f"__{out}_t"
    s = F.lower(F.col(title))
    for pat in R.TITLE_NOISE_V2:
        s = F.regexp_replace(s, pat, " ")
    s = F.regexp_replace(s, r"[^\p{L}\p{N}_\s\-+#./&]", " ")
    df = df.withColumn(t, py_strip(F.regexp_replace(s, r"\s+", " ")))
    res = F.when(F.col(t) == "", F.lit(None).cast("string")).otherwise(title_case(F.col(t)))
    return df.withColumn(out, res).drop(t)


def add_education_v2(df: DataFrame, primary: str, fallback: str, lows: tuple[str, str], out: str) -> DataFrame:
    p = f"__{out}_p"
    df = df.withColumn(p, _education_v2_one(F.col(primary), F.col(lows[0])))
    res = F.when(F.col(p) == "Không yêu cầu", _education_v2_one(F.col(fallback), F.col(lows[1]))).otherwise(F.col(p))
    return df.withColumn(out, res).drop(p)


def add_skills_v2(df: DataFrame, text: str, low: str, outs: dict[str, str]) -> DataFrame:
    """Hard/soft/language labels from the lowered text, searched once a kind."""
    df = df.select("*", *[labels_found(F.col(low), R.SKILLS_V2[kind], escape=True).alias(f"__{out}_f") for kind, out in outs.items()])
    res = [F.when(F.col(text).isNull() | (F.col(f"__{out}_f") == ""), F.lit("Không yêu cầu")).otherwise(F.col(f"__{out}_f")).alias(out)
           for out in outs.values()]
    return df.select("*", *res).drop(*[f"__{out}_f" for out in outs.values()])


def add_workstyle_v1(df: DataFrame, employment: str, description: str, out: str) -> DataFrame:
    t = f"__{out}_t"
    e, d = F.col(employment), F.col(description)
    df = df.withColumn(t, F.lower(F.concat_ws(" ", F.coalesce(e, F.lit("")), F.coalesce(d, F.lit("")))))
    both_null = e.isNull() & d.isNull()
    res = F.struct(F.when(both_null, F.lit("Full-time")).otherwise(first_match(F.col(t), R.EMPLOYMENT_V1, "Full-time"))
                   .alias("employment"),
                   F.when(both_null, F.lit("Onsite")).otherwise(first_match(F.col(t), R.WORK_MODE_V1, "Onsite"))
                   .alias("mode"))
    return df.withColumn(out, res).drop(t)


def add_workstyle_v2(df: DataFrame, text_columns, out: str) -> DataFrame:
    t = f"__{out}_t"
    df = df.withColumn(t, F.lower(F.concat_ws(" ", *[F.col(c) for c in text_columns])))
    res = F.struct(first_match(F.col(t), R.EMPLOYMENT_V2, "Full-time").alias("employment"),
                   first_match(F.col(t), R.WORK_MODE_V2, "Onsite").alias("mode"))
    return df.withColumn(out, res).drop(t)


def add_skills_v1(df: DataFrame, description: str, requirement: str, out: str) -> DataFrame:
    t = f"__{out}_t"
    df = df.withColumn(t, F.lower(F.concat(py_str(F.col(description)), F.lit(" "), py_str(F.col(requirement)))))
    res = F.struct(labels_found(F.col(t), R.SKILLS_V1["hard"], escape=False).alias("hard"),
                   labels_found(F.col(t), R.SKILLS_V1["soft"], escape=False).alias("soft"))
    return df.withColumn(out, res).drop(t)
