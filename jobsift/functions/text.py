"""Column helpers shared by the cleaning functions.

Everything here builds Catalyst expressions (no Python UDF), so the work
stays inside whole-stage code generation.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python's str.strip()/\s are Unicode-aware; Java's \s is ASCII only.
WS = r"[\s\x{1c}-\x{1f}\x{85}\p{Z}]"
# the characters of that class
WS_CHARS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
# Python's \w / \W (Unicode letters, digits, underscore)
WORD = r"[\p{L}\p{N}_]"
NON_WORD = r"[^\p{L}\p{N}_]"

_REGEX_META = set("\\^$.|?*+()[]{}/#-&~")


def py_strip(c: Column) -> Column:
    """``str.strip()``: remove leading/trailing Unicode white space.

    A trim looks at the ends only; a regular expression tries every place of the text.
    """
    return F.btrim(c, F.lit(WS_CHARS))


def py_strip_stored(c: Column) -> Column:
    """``py_strip`` of a plain column, which it names several times.

    A trim lists the places of all characters of a text; few texts begin or end
    with white space, so their first and last characters are looked at before.
    Every character of ``WS_CHARS`` is one of those tested for here (0: no character).
    """
    def outer(end: Column) -> Column:
        return (end <= 0x20) | ((end >= 0x85) & (end <= 0xA0)) | ((end >= 0x1680) & (end <= 0x3000))

    maybe = outer(F.ascii(c)) | outer(F.ascii(F.substring(c, -1, 1)))
    return F.when(maybe, py_strip(c)).otherwise(c)


def py_str(c: Column) -> Column:
    """``str(x)`` of a possibly missing text value: NULL prints as ``None``."""
    return F.coalesce(c, F.lit("None"))


def regex_escape(text: str) -> str:
    """Escape regex metacharacters (valid in Java and RE2 syntax)."""
    return "".join("\\" + ch if ch in _REGEX_META else ch for ch in text)


def to_sql(c: Column | str) -> str:
    """SQL text of a Column (or pass a SQL expression string through)."""
    return c if isinstance(c, str) else c._jc.node().sql()


def sql_str(s: str) -> str:
    """Spark SQL string literal."""
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _contains_sql(x: str, keywords: Iterable[str]) -> str:
    return "(" + " OR ".join(f"contains({x}, {sql_str(k)})" for k in keywords) + ")"


def contains_any(c: Column | str, keywords: Iterable[str]) -> Column:
    """``any(k in c for k in keywords)`` as one OR chain."""
    keywords = list(keywords)
    if not keywords:
        return F.lit(False)
    return F.expr(_contains_sql(f"({to_sql(c)})", keywords))


def first_match_sql(x: str, rules: Sequence[tuple[str, Sequence[str]]], default: str | None) -> str:
    whens = " ".join(f"WHEN {_contains_sql(x, kws)} THEN {sql_str(label)}" for label, kws in rules)
    dflt = "CAST(NULL AS STRING)" if default is None else sql_str(default)
    return f"(CASE {whens} ELSE {dflt} END)"


def first_match(c: Column | str, rules: Sequence[tuple[str, Sequence[str]]], default: str | None) -> Column:
    """Label of the first rule whose keyword occurs in ``c`` (ordered rules).

    Generated as one SQL CASE expression: it short-circuits and the fixed rule
    data constant-folds into the plan (built with one call instead of one per
    keyword).
    """
    return F.expr(_rule_sql(c, lambda x: first_match_sql(x, rules, default)))


def _rule_sql(c: Column | str, build: Callable[[str], str]) -> str:
    """``build(c)``, a long expression that names ``c`` once a keyword, as a
    lambda: ``c``, which may be an expression, is computed once a row, not once a
    keyword.  Nor does it lengthen the one method that Spark generates for a
    whole stage: beyond 8,000 bytes the JVM does not compile that method, and
    every row of the stage is interpreted.
    """
    return f"get(transform(array({to_sql(c)}), _x -> {build('_x')}), 0)"


def word_regex(keywords: Iterable[str], escape: bool = True) -> str:
    """``(?:^|\\W)(?:k1|k2…)(?:$|\\W)`` with Python's Unicode \\W."""
    alts = "|".join(regex_escape(k) if escape else k for k in keywords)
    return rf"(?:^|{NON_WORD})(?:{alts})(?:$|{NON_WORD})"


def labels_found(c: Column | str, rules: Sequence[tuple[str, Sequence[str]]], escape: bool = True) -> Column:
    """Sorted, ", "-joined labels whose keywords occur as whole words.

    Labels are emitted in code point order (Python ``sorted``); the order
    is fixed at plan time, so no per-row sort is needed.  A plain substring
    test guards each regex (a whole-word match implies the substring), so
    the regex only runs on rows that can match.  Empty string when nothing
    matches.
    """
    def found(x: str) -> str:
        parts = []
        for label, kws in sorted(rules, key=lambda r: r[0]):
            rx = f"{x} RLIKE {sql_str(word_regex(kws, escape))}"
            literal = escape or not any(ch in _REGEX_META for k in kws for ch in k)
            cond = f"{_contains_sql(x, kws)} AND {rx}" if literal else rx
            parts.append(f"CASE WHEN {cond} THEN {sql_str(label)} END")
        return f"concat_ws(', ', {', '.join(parts)})"
    return F.expr(_rule_sql(c, found))


def numbers(c: Column, pattern: str, group: int = 1) -> Column:
    """All matches of ``pattern`` as an array<double> (an array cast, which
    is code-generated, instead of a per-element lambda)."""
    return F.regexp_extract_all(c, F.lit(pattern), group).cast("array<double>")


def title_case(c: Column) -> Column:
    """Python ``str.title()``: upper-case the first letter of every letter run."""
    runs = F.regexp_extract_all(F.lower(c), F.lit(r"(\p{L}+|\P{L}+)"), 1)
    return F.array_join(
        F.transform(runs, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, 2, 1 << 30))), "")


def band(value: Column, bands: Sequence[tuple[float | None, str]]) -> Column:
    """Left-closed bands: first ``(upper, label)`` with ``value < upper``."""
    expr = None
    for upper, label in bands:
        if upper is None:
            return expr.otherwise(F.lit(label)) if expr is not None else F.lit(label)
        cond = value < F.lit(upper)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr


def null_skip_mean(a: Column, b: Column) -> Column:
    """Row-wise mean of two values that ignores NULLs (pandas ``mean(axis=1)``)."""
    return F.when(a.isNull(), b).when(b.isNull(), a).otherwise((a + b) / 2)


def fmt_num(c: Column) -> Column:
    """``str(float)`` for the small magnitudes used in display texts."""
    return c.cast("double").cast("string")


def fmt_1dp(c: Column) -> Column:
    """One decimal place, half-up (``f"{x:.1f}"`` with the rounding fixed)."""
    return c.cast("decimal(18,6)").cast("decimal(18,1)").cast("string")
