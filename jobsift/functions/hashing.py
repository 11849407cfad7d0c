"""Row hashes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import py_str


def job_hash_raw(title: Column, company: Column, location: Column) -> Column:
    """Upper-case hex MD5 of lower(trim(title)) + lower(trim(company)) +
    lower(trim(location)), NULL as ''; hashed as UTF-16LE (NVARCHAR bytes)."""
    parts = [F.lower(F.coalesce(F.trim(c), F.lit(""))) for c in (title, company, location)]
    return F.upper(F.md5(F.encode(F.concat(*parts), "UTF-16LE")))


def job_hash_clean(link: Column, province: Column) -> Column:
    """Lower-case hex MD5 of link + province (UTF-8)."""
    return F.md5(F.concat(py_str(link), py_str(province)))
