"""DuckDB SQL for the differential check (the "oracle").

Each builder returns a DuckDB SQL expression over column/expression
strings.  The logic is written independently of the Spark functions (SQL
text here, Column expressions there); only the fixed rule data is shared.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from . import rules as R

WS = r"[\s\x{1c}-\x{1f}\x{85}\p{Z}]"
NON_WORD = r"[^\p{L}\p{N}_]"
NUM = r"\d+(?:\.\d+)?"
_META = set("\\^$.|?*+()[]{}/#-&~")


def q(s: str | None) -> str:
    if s is None:
        return "NULL"
    return "'" + s.replace("'", "''") + "'"


def num(v) -> str:
    return "NULL::DOUBLE" if v is None else f"{float(v)!r}::DOUBLE"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def py_str(x: str) -> str:
    return f"coalesce({x}, 'None')"


def contains_any(x: str, kws: Iterable[str]) -> str:
    return "(" + " OR ".join(f"contains({x}, {q(k)})" for k in kws) + ")"


def first_match(x: str, rules: Sequence[tuple[str, Sequence[str]]], default: str | None) -> str:
    whens = " ".join(f"WHEN {contains_any(x, kws)} THEN {q(label)}" for label, kws in rules)
    return f"(CASE {whens} ELSE {q(default)} END)"


def escape(k: str) -> str:
    return "".join("\\" + c if c in _META else c for c in k)


def word_regex(kws: Iterable[str], esc: bool = True) -> str:
    alts = "|".join(escape(k) if esc else k for k in kws)
    return f"(?:^|{NON_WORD})(?:{alts})(?:$|{NON_WORD})"


def labels_found(x: str, rules, esc: bool = True) -> str:
    parts = [f"CASE WHEN regexp_matches({x}, {q(word_regex(kws, esc))}) THEN {q(label)} END"
             for label, kws in sorted(rules, key=lambda r: r[0])]
    return f"concat_ws(', ', {', '.join(parts)})"


def numbers(x: str, pattern: str, group: int = 1) -> str:
    return f"list_transform(regexp_extract_all({x}, {q(pattern)}, {group}), lambda _n: CAST(_n AS DOUBLE))"


def title_case(x: str) -> str:
    return (f"array_to_string(list_transform(regexp_extract_all(lower({x}), '(\\p{{L}}+|\\P{{L}}+)', 1), "
            f"lambda _w: upper(_w[1]) || _w[2:]), '')")


def band(v: str, bands) -> str:
    whens = []
    last = None
    for upper, label in bands:
        if upper is None:
            last = label
        else:
            whens.append(f"WHEN {v} < {upper} THEN {q(label)}")
    return f"(CASE {' '.join(whens)} ELSE {q(last)} END)"


def null_skip_mean(a: str, b: str) -> str:
    return f"(CASE WHEN {a} IS NULL THEN {b} WHEN {b} IS NULL THEN {a} ELSE ({a} + {b}) / 2 END)"


def fmt_num(x: str) -> str:
    return f"CAST(CAST({x} AS DOUBLE) AS VARCHAR)"


def fmt_1dp(x: str) -> str:
    return f"CAST(CAST(round(CAST({x} AS DECIMAL(18,6)), 1) AS DECIMAL(18,1)) AS VARCHAR)"


def pair(lo: str, hi: str) -> str:
    return f"{{'min': CAST({lo} AS DOUBLE), 'max': CAST({hi} AS DOUBLE)}}"


NULLD = "NULL::DOUBLE"

# ---------------------------------------------------------------------------
# salary
# ---------------------------------------------------------------------------


def salary_v1(x: str) -> str:
    t = f"lower({py_str(x)})"
    unit = (f"(CASE WHEN contains({t}, 'usd') OR contains({t}, '$') THEN 25000.0 "
            f"WHEN {contains_any(t, ('triệu', 'tr', 'millions', 'm'))} THEN 1000000.0 "
            f"WHEN {contains_any(t, ('nghìn', 'k'))} THEN 1000.0 ELSE 1.0 END)")
    nums = numbers(f"replace({t}, ',', '')", f"({NUM})")
    n0 = f"({nums}[1] * {unit})"
    n1 = f"({nums}[2] * {unit})"
    return (f"(CASE WHEN len({nums}) = 1 THEN (CASE WHEN {contains_any(t, R.SALARY_UPTO_V1)} THEN {pair('0.0', n0)} "
            f"WHEN {contains_any(t, R.SALARY_FROM_V1)} THEN {pair(n0, '0.0')} ELSE {pair(n0, n0)} END) "
            f"WHEN len({nums}) >= 2 THEN {pair(n0, n1)} ELSE {pair('0.0', '0.0')} END)")


def salary_v2_text(x: str) -> str:
    t = strip(f"lower({x})")
    for a, b in (("triệu", "tr"), ("nghìn", "k"), ("million", "m"), ("millions", "m")):
        t = f"replace({t}, {q(a)}, {q(b)})"
    for _ in range(3):
        t = f"regexp_replace({t}, '(\\d),(\\d{{3}})', '\\1\\2', 'g')"
    return f"replace({t}, ',', '.')"


def salary_v2_values(t: str, fixed: bool = True) -> str:
    """``t`` is the prepared text (``salary_v2_text``)."""
    pat = f"({NUM})(\\s*(?:tr|k|m)?)" if fixed else f"({NUM})(\\s*[ktrm]?)"
    nums = numbers(t, pat, 1)
    units = f"list_transform(regexp_extract_all({t}, {q(pat)}, 2), lambda _u: trim(_u))"
    if fixed:
        last = f"list_filter({units}, lambda _u: _u <> '')[-1]"
        unit_i = f"(CASE WHEN {units}[_i] = '' THEN coalesce({last}, '') ELSE {units}[_i] END)"
    else:
        unit_i = f"{units}[_i]"
    usd = f"(contains({t}, 'usd') OR contains({t}, '$'))"
    conv = (f"round(CASE WHEN {usd} THEN (CASE WHEN {unit_i} = 'k' THEN _n * 1000 WHEN {unit_i} = 'm' THEN _n * 1000000 "
            f"ELSE _n END) * 0.025 ELSE (CASE WHEN {unit_i} = 'k' THEN _n / 1000 WHEN {unit_i} IN ('tr', 'm') THEN _n "
            f"ELSE _n / 1000000 END) END, 2)")
    return f"list_transform({nums}, lambda _n, _i: {conv})"


def salary_v2_from_values(raw: str, t: str, vals: str) -> str:
    v = f"{vals}[1]"
    one = (f"(CASE WHEN {contains_any(t, R.SALARY_UPTO_V2)} THEN {pair('0.0', v)} "
           f"WHEN {contains_any(t, R.SALARY_FROM_V2)} THEN {pair(v, '0.0')} ELSE {pair(v, v)} END)")
    return (f"(CASE WHEN {raw} IS NULL OR {raw} = '' THEN {pair('0.0', '0.0')} WHEN len({vals}) = 1 THEN {one} "
            f"WHEN len({vals}) >= 2 THEN {pair(f'list_min({vals})', f'list_max({vals})')} ELSE {pair('0.0', '0.0')} END)")


def salary_avg_v2(lo: str, hi: str) -> str:
    return f"(CASE WHEN {lo} > 0 AND {hi} > 0 THEN ({lo} + {hi}) / 2 WHEN {lo} <> 0 THEN {lo} ELSE {hi} END)"


def salary_band_v1(avg: str) -> str:
    return f"(CASE WHEN {avg} IS NULL OR {avg} = 0 THEN 'Thỏa thuận' ELSE {band(f'({avg} / 1000000)', R.SALARY_BANDS_V1)} END)"


def salary_band_v2(avg: str) -> str:
    return f"(CASE WHEN {avg} IS NULL OR {avg} = 0 THEN 'Thỏa thuận' ELSE {band(avg, R.SALARY_BANDS_V2)} END)"


def salary_text(lo: str, hi: str) -> str:
    lo = f"coalesce({lo}, 0.0)"
    hi = f"coalesce({hi}, 0.0)"
    return (f"(CASE WHEN {lo} = 0 AND {hi} = 0 THEN 'Thỏa thuận' "
            f"WHEN {lo} > 0 AND {hi} > 0 AND {lo} = {hi} THEN {fmt_1dp(lo)} || ' triệu' "
            f"WHEN {lo} > 0 AND {hi} > 0 THEN {fmt_1dp(lo)} || ' - ' || {fmt_1dp(hi)} || ' triệu' "
            f"WHEN {lo} > 0 THEN 'Từ ' || {fmt_1dp(lo)} || ' triệu' "
            f"WHEN {hi} > 0 THEN 'Đến ' || {fmt_1dp(hi)} || ' triệu' ELSE 'Thỏa thuận' END)")


# ---------------------------------------------------------------------------
# experience / size
# ---------------------------------------------------------------------------


def experience_v1(x: str, extended: bool = False) -> str:
    t = strip(f"lower({x})")
    nums0 = numbers(t, f"({NUM})")
    nums = (f"(CASE WHEN contains({t}, 'tháng') AND NOT contains({t}, 'năm') "
            f"THEN list_transform({nums0}, lambda _m: _m / 12) ELSE {nums0} END)")
    no_exp = R.NO_EXPERIENCE_V1_EXTENDED if extended else R.NO_EXPERIENCE_V1
    over = ("trên", "hơn", "over", ">") if extended else ("trên", "hơn", "over")
    under = ("dưới", "less than", "<") if extended else ("dưới", "less")
    n0 = f"{nums}[1]"
    srt = f"list_sort({nums})"
    return (f"(CASE WHEN {x} IS NULL OR {x} = '' THEN {pair(NULLD, NULLD)} "
            f"WHEN {contains_any(t, no_exp)} THEN {pair('0.0', '0.0')} "
            f"WHEN len({nums}) = 0 THEN {pair(NULLD, NULLD)} "
            f"WHEN contains({t}, 'dưới 1 năm') THEN {pair('0.0', '1.0')} "
            f"WHEN {contains_any(t, over)} THEN {pair(n0, NULLD)} "
            f"WHEN {contains_any(t, under)} THEN {pair('0.0', n0)} "
            f"WHEN len({nums}) >= 2 THEN {pair(f'{srt}[1]', f'{srt}[-1]')} ELSE {pair(n0, n0)} END)")


def experience_v1_coalesced(p: str, f: str, extended: bool = False) -> str:
    a = experience_v1(p, extended)
    b = experience_v1(f, extended)
    return f"(CASE WHEN {a}.min IS NULL AND {a}.max IS NULL THEN {b} ELSE {a} END)"


def experience_v2(x: str) -> str:
    t = f"lower({x})"
    nums = numbers(t, f"({NUM})\\s*(?:năm|year)")
    n0 = f"{nums}[1]"
    one = (f"(CASE WHEN contains({t}, 'trên') OR contains({t}, 'hơn') THEN {pair(n0, NULLD)} "
           f"WHEN contains({t}, 'dưới') THEN {pair('0.0', n0)} ELSE {pair(n0, n0)} END)")
    return (f"(CASE WHEN {x} IS NULL OR {contains_any(t, R.NO_EXPERIENCE_V2)} THEN {pair('0.0', '0.0')} "
            f"WHEN len({nums}) = 0 THEN {pair(NULLD, NULLD)} WHEN len({nums}) = 1 THEN {one} "
            f"ELSE {pair(f'list_min({nums})', f'list_max({nums})')} END)")


def experience_band_v1(avg: str) -> str:
    return (f"(CASE WHEN {avg} IS NULL THEN 'Khác' WHEN {avg} = 0 THEN 'Không yêu cầu kinh nghiệm' "
            f"WHEN {avg} < 0 THEN 'Khác' ELSE {band(avg, R.EXPERIENCE_BANDS_V1)} END)")


def experience_band_v2(avg: str) -> str:
    return f"(CASE WHEN {avg} IS NULL OR {avg} = 0 THEN 'Không yêu cầu' ELSE {band(avg, R.EXPERIENCE_BANDS_V2)} END)"


def experience_text(lo: str, hi: str) -> str:
    return (f"(CASE WHEN {lo} IS NULL AND {hi} IS NULL THEN 'Không yêu cầu' WHEN {lo} = 0 AND {hi} = 0 THEN 'Không yêu cầu' "
            f"WHEN {lo} IS NOT NULL AND {hi} IS NOT NULL AND {lo} = {hi} THEN {fmt_num(lo)} || ' năm' "
            f"WHEN {lo} IS NOT NULL AND {hi} IS NOT NULL THEN {fmt_num(lo)} || ' - ' || {fmt_num(hi)} || ' năm' "
            f"WHEN {lo} IS NOT NULL THEN 'Trên ' || {fmt_num(lo)} || ' năm' ELSE 'Dưới ' || {fmt_num(hi)} || ' năm' END)")


def _size_clean(x: str) -> str:
    return f"regexp_replace({x}, '[.,]', '', 'g')"


def size_v1(x: str, extended: bool = False) -> str:
    t = f"lower({x})"
    clean = _size_clean(t)
    nums = numbers(clean, "(\\d+)")
    under = ("dưới", "ít hơn", "less than") if extended else ("dưới", "ít hơn")
    over = ("trên", "hơn", "over", "+") if extended else ("trên", "hơn")
    bad = f"{x} IS NULL OR {x} = ''" + (f" OR upper({x}) = 'NULL'" if extended else "")
    srt = f"list_sort({nums})"
    n0 = f"{nums}[1]"
    return (f"(CASE WHEN {bad} OR len({nums}) = 0 THEN {pair(NULLD, NULLD)} "
            f"WHEN {contains_any(clean, under)} THEN {pair('0.0', n0)} "
            f"WHEN {contains_any(clean, over)} THEN {pair(n0, NULLD)} "
            f"WHEN len({nums}) >= 2 THEN {pair(f'{srt}[1]', f'{srt}[-1]')} ELSE {pair(n0, n0)} END)")


def size_avg_v1(lo: str, hi: str) -> str:
    return f"(CASE WHEN {lo} IS NULL THEN NULL WHEN {hi} IS NULL THEN {lo} ELSE ({lo} + {hi}) / 2 END)"


def size_band_v1(avg: str) -> str:
    return f"(CASE WHEN {avg} IS NULL OR {avg} < 0 THEN 'Không xác định' ELSE {band(avg, R.SIZE_BANDS_V1)} END)"


def size_v2(x: str) -> str:
    nums = numbers(_size_clean(x), "(\\d+)")
    return (f"(CASE WHEN {x} IS NULL OR {x} = '' OR len({nums}) = 0 THEN {pair(NULLD, NULLD)} "
            f"ELSE {pair(f'list_min({nums})', f'list_max({nums})')} END)")


def size_text(lo: str, hi: str) -> str:
    li = f"CAST(CAST({lo} AS BIGINT) AS VARCHAR)"
    hi_ = f"CAST(CAST({hi} AS BIGINT) AS VARCHAR)"
    return (f"(CASE WHEN {lo} IS NULL THEN 'Không xác định' WHEN {lo} = {hi} THEN {li} || ' nhân viên' "
            f"ELSE {li} || ' - ' || {hi_} || ' nhân viên' END)")


def size_class_v2(hi: str) -> str:
    return f"(CASE WHEN {hi} IS NULL THEN 'Không xác định' ELSE {band(hi, R.SIZE_CLASS_V2)} END)"


# ---------------------------------------------------------------------------
# classifiers
# ---------------------------------------------------------------------------


def title_clean_v2(x: str) -> str:
    t = f"lower({x})"
    for pat in R.TITLE_NOISE_V2:
        t = f"regexp_replace({t}, {q(pat)}, ' ', 'g')"
    t = f"regexp_replace({t}, '[^\\p{{L}}\\p{{N}}_\\s\\-+#./&]', ' ', 'g')"
    t = strip(f"regexp_replace({t}, '\\s+', ' ', 'g')")
    return f"(CASE WHEN {t} = '' THEN NULL ELSE {title_case(t)} END)"


def title_class_v1(x: str) -> str:
    t = f"lower({x})"
    for pat in R.TITLE_NOISE_V1:
        t = f"regexp_replace({t}, {q(pat)}, '', 'g')"
    t = strip(t)
    return f"(CASE WHEN {x} IS NULL THEN 'Khác' ELSE {first_match(t, R.JOB_TITLE_V1, 'Khác')} END)"


def job_role_v2(x: str) -> str:
    return f"(CASE WHEN {x} IS NULL OR {x} = '' THEN 'Khác' ELSE {first_match(f'lower({x})', R.JOB_ROLE_V2, 'Khác')} END)"


def industry_sub_v2(x: str) -> str:
    return first_match(f"lower({py_str(x)})", R.INDUSTRY_SUB_V2, "IT - Khác")


def industry_macro_v2(x: str) -> str:
    return (f"(CASE WHEN {x} IS NULL OR {strip(x)} = '' THEN 'Khác' "
            f"ELSE {first_match(f'lower({x})', R.INDUSTRY_MACRO_V2, 'Khác')} END)")


def industry_v1(x: str) -> str:
    return first_match(f"lower({py_str(x)})", R.INDUSTRY_V1, "Khác")


def rank_v1(x: str) -> str:
    return first_match(f"lower({py_str(x)})", R.RANK_V1, "Nhân viên")


def rank_v2(x: str, exp_avg: str) -> str:
    base = (f"(CASE WHEN {x} IS NULL OR {x} = '' OR {x} = 'N/A' THEN 'Junior' "
            f"ELSE {first_match(f'lower({x})', R.RANK_V2, 'Junior')} END)")
    refined = (f"(CASE WHEN {exp_avg} >= 5 THEN 'Senior' WHEN {exp_avg} >= 3 THEN 'Mid-level' "
               f"WHEN {exp_avg} >= 1 THEN 'Junior' ELSE 'Fresher' END)")
    return f"(CASE WHEN {base} = 'Junior' AND {exp_avg} IS NOT NULL THEN {refined} ELSE {base} END)"


def education_v1(x: str) -> str:
    return first_match(f"lower({py_str(x)})", R.EDUCATION_V1, "Không yêu cầu")


def _education_v2_one(x: str) -> str:
    return (f"(CASE WHEN {x} IS NULL OR {x} = '' THEN 'Không yêu cầu' "
            f"ELSE {first_match(f'lower({x})', R.EDUCATION_V2, 'Không yêu cầu')} END)")


def education_v2(p: str, f: str) -> str:
    a = _education_v2_one(p)
    return f"(CASE WHEN {a} = 'Không yêu cầu' THEN {_education_v2_one(f)} ELSE {a} END)"


def skills_v2(x: str, kind: str) -> str:
    found = labels_found(f"lower({x})", R.SKILLS_V2[kind], True)
    return f"(CASE WHEN {x} IS NULL OR {found} = '' THEN 'Không yêu cầu' ELSE {found} END)"


def skills_v1(desc: str, req: str) -> str:
    txt = f"lower({py_str(desc)} || ' ' || {py_str(req)})"
    return (f"{{'hard': {labels_found(txt, R.SKILLS_V1['hard'], False)}, "
            f"'soft': {labels_found(txt, R.SKILLS_V1['soft'], False)}}}")


def workstyle_v1(emp: str, desc: str) -> str:
    txt = f"lower(concat_ws(' ', coalesce({emp}, ''), coalesce({desc}, '')))"
    both = f"({emp} IS NULL AND {desc} IS NULL)"
    return (f"{{'employment': CASE WHEN {both} THEN 'Full-time' ELSE {first_match(txt, R.EMPLOYMENT_V1, 'Full-time')} END, "
            f"'mode': CASE WHEN {both} THEN 'Onsite' ELSE {first_match(txt, R.WORK_MODE_V1, 'Onsite')} END}}")


def workstyle_v2(cols: Sequence[str]) -> str:
    txt = f"lower(concat_ws(' ', {', '.join(cols)}))"
    return (f"{{'employment': {first_match(txt, R.EMPLOYMENT_V2, 'Full-time')}, "
            f"'mode': {first_match(txt, R.WORK_MODE_V2, 'Onsite')}}}")


def headcount(qty: str, title: str) -> str:
    raw = f"coalesce({qty}, '')"
    col_nums = (f"list_filter(list_transform(regexp_extract_all({raw}, '(\\d+)', 1), "
                f"lambda _d: TRY_CAST(_d AS DECIMAL(38,0))), lambda _d: _d < 1000)")
    from_col = f"CAST(coalesce(list_max({col_nums}), 1) AS INTEGER)"
    t = f"lower(coalesce({title}, ''))"
    found = []
    for pat in R.HEADCOUNT_TITLE_PATTERNS:
        v = f"TRY_CAST(regexp_extract({t}, {q(pat)}, 1) AS DECIMAL(38,0))"
        found.append(f"CASE WHEN {v} > 1 AND {v} < 200 THEN {v} END")
    from_title = f"CAST(coalesce(greatest({', '.join(found)}), 1) AS INTEGER)"
    return (f"CAST(CASE WHEN {contains_any(f'lower({raw})', R.HEADCOUNT_BULK)} THEN 999 "
            f"WHEN {from_col} > 1 THEN {from_col} ELSE greatest({from_col}, {from_title}) END AS INTEGER)")


# ---------------------------------------------------------------------------
# dates, hashes
# ---------------------------------------------------------------------------


def safe_date(x: str) -> str:
    return f"TRY_CAST(CAST({x} AS VARCHAR) AS DATE)"


def ymd(y: str, m: str, d: str) -> str:
    return f"CAST(try_strptime({y} || '-' || {m} || '-' || {d}, '%Y-%m-%d') AS DATE)"


def deadline_v2(raw: str, crawl: str, as_of_date: str) -> str:
    t = strip(f"lower({py_str(raw)})")
    ref = f"coalesce(CAST({crawl} AS DATE), DATE {q(as_of_date)})"
    default = f"CAST({ref} + INTERVAL {R.DEADLINE_DEFAULT_DAYS_V2} DAY AS DATE)"
    pat = q(r"(\d{1,2})[/\-.](\d{1,2})[/\-.](\d{4})")
    parsed = ymd(f"regexp_extract({t}, {pat}, 3)", f"regexp_extract({t}, {pat}, 2)", f"regexp_extract({t}, {pat}, 1)")
    return (f"(CASE WHEN {t} = '' OR {contains_any(t, R.DEADLINE_DEFAULT_WORDS_V2)} THEN {default} "
            f"WHEN regexp_extract({t}, {pat}, 0) <> '' AND {parsed} IS NOT NULL THEN {parsed} ELSE {default} END)")


def deadline_v1(raw: str, crawl: str) -> str:
    t = strip(f"lower({py_str(raw)})")
    pat = q(r"(\d{1,2})[/-](\d{1,2})[/-](\d{4})")
    dmy = ymd(f"regexp_extract({t}, {pat}, 3)", f"regexp_extract({t}, {pat}, 2)", f"regexp_extract({t}, {pat}, 1)")
    days = f"regexp_extract({t}, '(\\d+)', 1)"
    plus = f"CAST(CAST({crawl} AS DATE) + TRY_CAST({days} AS INTEGER) * INTERVAL 1 DAY AS DATE)"
    sep, time = r"[/.\-, ]+", r"([ t]+([01]?\d|2[0-3]):[0-5]\d(:[0-5]\d(\.\d+)?)?( ?[ap]m)?z?)?"
    mon = "(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*"

    def get(form: str, n: int) -> str:
        return f"regexp_extract({t}, {q(form)}, {n})" if n else "'1'"

    def year(y: str) -> str:
        return f"CASE WHEN length({y}) = 2 THEN CASE WHEN TRY_CAST({y} AS INTEGER) >= 75 THEN '19' ELSE '20' END || {y} ELSE {y} END"

    def way(y: str, m: str, d: str) -> str:
        return f"CASE WHEN TRY_CAST({m} AS INTEGER) > 12 AND TRY_CAST({d} AS INTEGER) <= 12 THEN {ymd(y, d, m)} ELSE {ymd(y, m, d)} END"

    cases = []
    for form, (y, m, d), named in ((rf"^(\d{{1,2}}){sep}(\d{{1,2}}){sep}(\d{{4}}|\d{{2}}){time}$", (3, 2, 1), False), (rf"^(\d{{4}}){sep}(\d{{1,2}}){sep}(\d{{1,2}}){time}$", (1, 2, 3), False),
                                   (rf"^(\d{{4}})(\d{{2}})(\d{{2}}){time}$", (1, 2, 3), False), (rf"^(\d{{1,2}})[/.\-, ]*{mon}[/.\-, ]*(\d{{4}}|\d{{2}}){time}$", (3, 2, 1), True),
                                   (rf"^{mon}[/.\-, ]*(\d{{1,2}}){sep}(\d{{4}}|\d{{2}}){time}$", (3, 1, 2), True), (r"^(\d{1,2})[/\-](\d{4})$", (2, 1, 0), False),
                                   (r"^(\d{4})[/\-](\d{1,2})$", (1, 2, 0), False), (r"^(\d{4})$", (1, 0, 0), False)):
        month = f"CAST((instr('janfebmaraprmayjunjulaugsepoctnovdec', {get(form, m)}) + 2) // 3 AS VARCHAR)" if named else get(form, m)
        cases.append(f"WHEN regexp_matches({t}, {q(form)}) THEN {way(year(get(form, y)), month, get(form, d))}")
    direct = f"(CASE {' '.join(cases)} END)"
    return (f"(CASE WHEN contains({t}, 'hạn nộp') AND regexp_extract({t}, {pat}, 0) <> '' THEN {dmy} "
            f"WHEN contains({t}, 'ngày tới') AND {days} <> '' THEN {plus} ELSE {direct} END)")


def date_key(x: str) -> str:
    return f"CAST(strftime({safe_date(x)}, '%Y%m%d') AS INTEGER)"


def utf16le_md5_upper(s: str) -> str:
    """MD5 over UTF-16LE bytes of a BMP string, upper-case hex."""
    hexs = (f"array_to_string(list_transform(string_split({s}, ''), lambda _c: "
            f"printf('%02X%02X', unicode(_c) % 256, unicode(_c) // 256)), '')")
    return f"upper(md5(unhex({hexs})))"


def job_hash_raw(title: str, company: str, location: str) -> str:
    parts = " || ".join(f"lower(coalesce(trim({c}), ''))" for c in (title, company, location))
    return f"(CASE WHEN ({parts}) = '' THEN upper(md5('')) ELSE {utf16le_md5_upper(f'({parts})')} END)"


def job_hash_clean(link: str, prov: str) -> str:
    return f"md5({py_str(link)} || {py_str(prov)})"
