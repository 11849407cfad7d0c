"""Dates: safe casts, deadlines (C33, C34), date keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import rules as R
from ..session import AS_OF_DATE
from .text import contains_any, py_str, py_strip, py_strip_stored


def safe_date(c: Column) -> Column:
    """``TRY_CONVERT(DATE, x)``: a date, or NULL for text that is not one."""
    return c.cast("string").try_cast("date")


def _ymd(y: Column, m: Column, d: Column) -> Column:
    """Calendar-checked date from parts; NULL for 31/02 and the like."""
    return F.try_to_timestamp(F.concat_ws("-", y, m, d), F.lit("yyyy-M-d")).cast("date")


def deadline_v2(raw: Column, crawl_date: Column, as_of_date: str) -> Column:
    """Deadline: a valid d/m/yyyy in the text, else crawl date + 30 days."""
    t = F.lower(py_str(raw))  # neither the words nor the pattern begin or end with white space
    ref = F.coalesce(crawl_date.cast("date"), F.lit(as_of_date).cast("date"))
    default = F.date_add(ref, R.DEADLINE_DEFAULT_DAYS_V2)
    pat = r"(\d{1,2})[/\-.](\d{1,2})[/\-.](\d{4})"
    parsed = _ymd(F.regexp_extract(t, pat, 3), F.regexp_extract(t, pat, 2), F.regexp_extract(t, pat, 1))
    return (F.when((py_strip_stored(raw) == "") | contains_any(t, R.DEADLINE_DEFAULT_WORDS_V2), default)
            .otherwise(F.coalesce(F.when(t.rlike(pat), parsed), default)))


# FIXED VALUES: English month names by their first three letters
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
_TIME = r"(?:[ t]+(?:[01]?\d|2[0-3]):[0-5]\d(?::[0-5]\d(?:\.\d+)?)?(?: ?[ap]m)?z?)?"
_SEP = r"[/.\-, ]+"
_MONTH = "(" + "|".join(MONTHS) + r")[a-z]*"
#: What a whole text can look like, and which group holds the year, the month and the day (0: the first).
DATE_FORMS = (
    (rf"^(\d{{1,2}}){_SEP}(\d{{1,2}}){_SEP}(\d{{4}}|\d{{2}}){_TIME}$", (3, 2, 1)),
    (rf"^(\d{{4}}){_SEP}(\d{{1,2}}){_SEP}(\d{{1,2}}){_TIME}$", (1, 2, 3)),
    (rf"^(\d{{4}})(\d{{2}})(\d{{2}}){_TIME}$", (1, 2, 3)),
    (rf"^(\d{{1,2}})[/.\-, ]*{_MONTH}[/.\-, ]*(\d{{4}}|\d{{2}}){_TIME}$", (3, 2, 1)),
    (rf"^{_MONTH}[/.\-, ]*(\d{{1,2}}){_SEP}(\d{{4}}|\d{{2}}){_TIME}$", (3, 1, 2)),
    (r"^(\d{1,2})[/\-](\d{4})$", (2, 1, 0)),
    (r"^(\d{4})[/\-](\d{1,2})$", (1, 2, 0)),
    (r"^(\d{4})$", (1, 0, 0)),
)


def day_first(text: Column, this_year: int = int(AS_OF_DATE[:4]), iso_swapped: bool = False) -> Column:
    """The date that a whole text (lower case, stripped) is, the day before the
    month; NULL for any other text and for days that do not exist.

    Two digits of a year are those nearest to ``this_year`` (50 years ahead at
    most, not included); a time of day may follow and is left out; a month over 12
    is the day, if that can be a month.  A missing month or day is the first.
    ``iso_swapped`` also takes the day of year-first dates before the month where
    both can be, as the source's parser does with ``2025-06-05``.
    """
    out = None
    for form, (y, m, d) in DATE_FORMS:
        def part(group: int, form: str = form) -> Column:
            return F.regexp_extract(text, form, group) if group else F.lit("1")

        year, month, day = part(y).try_cast("int"), part(m), part(d).try_cast("int")
        if _MONTH in form:
            month = F.floor((F.instr(F.lit("".join(MONTHS)), F.substring(month, 1, 3)) + 2) / 3).cast("int")
        else:
            month = month.try_cast("int")
        near = F.lit(this_year - this_year % 100) + year
        near = F.when(near >= this_year + 50, near - 100).when(near < this_year - 50, near + 100).otherwise(near)
        year = F.when(F.length(part(y)) == 2, near).otherwise(year)
        other_way = (month > 12) & (day <= 12)
        if iso_swapped and y == 1 and d:
            other_way = other_way | (day <= 12)
        date = F.when(other_way, _ymd(year.cast("string"), day.cast("string"), month.cast("string"))).otherwise(
            _ymd(year.cast("string"), month.cast("string"), day.cast("string")))
        fits = text.rlike(form)
        out = F.when(fits, date) if out is None else out.when(fits, date)
    return out


def deadline_v1(raw: Column, crawl_date: Column, iso_swapped: bool = False) -> Column:
    """"hạn nộp" + d/m/yyyy; "n ngày tới" -> crawl date + n; else day-first
    parse of the whole text; anything invalid -> NULL."""
    t = py_strip(F.lower(py_str(raw)))
    pat = r"(\d{1,2})[/-](\d{1,2})[/-](\d{4})"
    has_dmy = F.regexp_extract(t, pat, 0) != ""
    dmy = _ymd(F.regexp_extract(t, pat, 3), F.regexp_extract(t, pat, 2), F.regexp_extract(t, pat, 1))
    days = F.regexp_extract(t, r"(\d+)", 1)
    plus = F.date_add(crawl_date.cast("date"), days.try_cast("int"))
    return (F.when(t.contains("hạn nộp") & has_dmy, dmy)
            .when(t.contains("ngày tới") & (days != ""), plus)
            .otherwise(day_first(t, iso_swapped=iso_swapped)))


def date_key(c: Column) -> Column:
    """yyyyMMdd integer of a (text) date; NULL for a bad date."""
    return F.date_format(safe_date(c), "yyyyMMdd").cast("int")
