"""Labelled fields of job pages (H8) and the merge of their sources.

A rule says where a site shows a field; all rules of all sites become one
projection, in which a page runs the patterns of its own site only.  Values may
hold inline tags and entities, which ``html_to_text`` takes away; a value ends at
the first closing tag of its element, so elements that nest in themselves are
read up to there.  What a page does not show is "".
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .html import html_to_text, join_sections, prefer_nonempty

FIELDS = ("title", "salary", "experience", "rank", "headcount", "work_form", "education", "deadline", "location", "work_time",
          "company", "size", "industry", "gender", "company_link")
SECTIONS = ("description", "requirement", "benefits")


def by_class(tag: str, cls: str) -> str:
    """The text of the first element of this tag and class."""
    return rf'(?is)<{tag}\b[^>]*\bclass="[^"]*{re.escape(cls)}[^"]*"[^>]*>(.*?)</{tag}>'


def beside(label: str, value_class: str = "value") -> str:
    """The element of ``value_class`` that follows one with the label."""
    return rf'(?is)<div\b[^>]*>[^<]*{re.escape(label)}[^<]*</div>\s*<div\b[^>]*\bclass="[^"]*{value_class}[^"]*"[^>]*>(.*?)</div>'


def after(tag: str, label: str, then: str, cls: str = "") -> str:
    """The next element after a heading that holds the label."""
    own = rf'\bclass="[^"]*{re.escape(cls)}[^"]*"[^>]*' if cls else ""
    return rf"(?is)<{tag}\b[^>]*>[^<]*{re.escape(label)}[^<]*</{tag}>\s*<{then}\b[^>]*{own}>(.*?)</{then}>"


def inside(element_id: str, tag: str, cls: str = "") -> str:
    """The first such element in the block with this id."""
    own = rf'\bclass="[^"]*{re.escape(cls)}[^"]*"[^>]*' if cls else ""
    return rf'(?is)<div\b[^>]*\bid="{element_id}"[^>]*>.*?<{tag}\b[^>]*{own}>(.*?)</{tag}>'


def after_icon(icon: str) -> str:
    """The text after an icon."""
    return rf'(?is)<i\b[^>]*\bclass="[^"]*{icon}[^"]*"[^>]*>\s*</i>\s*<span\b[^>]*>(.*?)</span>'


def attribute(tag: str, before: str, name: str) -> str:
    """An attribute of the first such tag after a mark."""
    return rf'(?is){before}[^>]*>\s*<{tag}\b[^>]*?\b{name}="([^"]*)"'


# FIXED VALUES: where each site shows a field (labels, classes and ids of its pages)
TOPCV = {
    "title": by_class("h1", "job-detail__info--title"),
    "salary": beside("Mức lương"),
    "experience": beside("Kinh nghiệm"),
    "rank": beside("Cấp bậc"),
    "headcount": beside("Số lượng tuyển"),
    "work_form": beside("Hình thức làm việc"),
    "education": beside("Học vấn"),
    "deadline": by_class("div", "job-detail__info--deadline"),
    "location": after("div", "Địa điểm", "div"),
    "work_time": after("h3", "Thời gian làm việc", "div"),
    "company": by_class("a", "name"),
    "size": r'(?is)<div\b[^>]*\bclass="[^"]*company-scale[^"]*"[^>]*>.*?<div\b[^>]*\bclass="company-value"[^>]*>(.*?)</div>',
    "industry": after("div", "Lĩnh vực:", "div", "company-value"),
    "company_link": attribute("a", r'\bjob-detail__company\b', "href"),
}
CAREERLINK = {
    "title": by_class("h1", "job-title"),
    "salary": inside("job-salary", "span", "text-primary"),
    "experience": after_icon("cli-suitcase-simple"),
    "rank": after("div", "Cấp bậc", "div"),
    "work_form": after("div", "Loại công việc", "div"),
    "education": after("div", "Học vấn", "div"),
    "deadline": inside("job-date", "b"),
    "location": inside("job-location", "a"),
    "company": attribute("a", r"<h5\b[^>]*\bcompany-name-title\b", "title"),
    "size": after_icon("cli-users"),
    "industry": after("div", "Ngành nghề", "div"),
    "gender": after("div", "Giới tính", "div"),
    "company_link": attribute("a", r"<h5\b[^>]*\bcompany-name-title\b", "href"),
}
CAREERVIET = {
    "title": by_class("h1", "title"),
    "salary": after("strong", "Lương", "p"),
    "experience": after("strong", "Kinh nghiệm", "p"),
    "rank": after("strong", "Cấp bậc", "p"),
    "work_form": after("strong", "Hình thức", "p"),
    "education": r"(?is)<li\b[^>]*>([^<]*Bằng cấp:.*?)</li>",
    "deadline": after("strong", "Hết hạn nộp", "p"),
    "location": r"(?is)<strong\b[^>]*>[^<]*Địa điểm[^<]*</strong>\s*<p\b[^>]*>\s*<a\b[^>]*>(.*?)</a>",
    "industry": after("strong", "Ngành nghề", "p"),
}
SITES = {"TopCV": TOPCV, "JobsGo": TOPCV, "CareerLink": CAREERLINK, "CareerViet": CAREERVIET}
#: The element that holds a section's children, after its heading.
SECTION_HEADS = {
    "TopCV": {"description": "Mô tả công việc", "requirement": "Yêu cầu ứng viên", "benefits": "Quyền lợi"},
    "JobsGo": {"description": "Mô tả công việc", "requirement": "Yêu cầu ứng viên", "benefits": "Quyền lợi"},
}
SECTION_CLASS = "job-description__item--content"
DEADLINE_LABEL = "Hạn nộp hồ sơ: "


def field(site: Column, html: Column, name: str) -> Column:
    """One field of a page, "" when the page or the site does not show it."""
    out = None
    for pattern in dict.fromkeys(rules[name] for rules in SITES.values() if name in rules):
        sites = [s for s, rules in SITES.items() if rules.get(name) == pattern]
        value = html_to_text(F.regexp_extract(html, pattern, 1))
        out = F.when(site.isin(sites), value) if out is None else out.when(site.isin(sites), value)
    out = F.lit("") if out is None else out.otherwise("")
    return F.replace(out, F.lit(DEADLINE_LABEL), F.lit("")) if name == "deadline" else out


def section(site: Column, html: Column, name: str) -> Column:
    """The texts of a section's children, joined by ". "."""
    out = None
    for s, heads in SECTION_HEADS.items():
        block = F.regexp_extract(html, after("h3", heads[name], "div", SECTION_CLASS), 1)
        children = F.regexp_extract_all(block, F.lit(r"(?is)<(?:p|li|span)\b[^>]*>(.*?)</(?:p|li|span)>"), 1)
        value = join_sections(F.transform(children, html_to_text))
        out = F.when(site == s, value) if out is None else out.when(site == s, value)
    return out.otherwise("")


def extract_fields(pages: DataFrame, site: str = "site", html: str = "html") -> DataFrame:
    """``pages`` without its HTML, with a column a field and section."""
    s, h = F.col(site), F.coalesce(F.col(html), F.lit(""))
    return pages.select(*[c for c in pages.columns if c != html], *[field(s, h, f).alias(f) for f in FIELDS], *[section(s, h, f).alias(f) for f in SECTIONS])


def merge_company(df: DataFrame, card: str = "card_", tab: str = "tab_") -> DataFrame:
    """Name and link of the card if it has them, else of the company's tab;
    the size is the tab's, whatever the card says."""
    keep = [c for c in df.columns if not c.startswith((card, tab))]
    return df.select(*keep, *[prefer_nonempty(F.col(f"{card}{c}"), F.col(f"{tab}{c}")).alias(c) for c in ("company", "company_link")],
                     F.coalesce(F.col(f"{tab}size"), F.lit("")).alias("size"))
