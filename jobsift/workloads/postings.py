"""Posting-cleaning workloads over the ``stg`` view."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import functions as F

from .. import fixtures
from .. import oracle as O
from ..functions import classify as C
from ..functions import parsers as P
from ..functions.dates import deadline_v1, deadline_v2, date_key
from ..functions.hashing import job_hash_clean, job_hash_raw
from ..functions.text import null_skip_mean, title_case
from ..operators.geo import geo_explode_v1, geo_explode_v2
from ..plans.clean import CLEAN_V1_COLUMNS, CLEAN_V2_COLUMNS, ROW_TEXT_COLUMNS, clean_v1, clean_v2
from ..registry import register
from ..session import AS_OF, AS_OF_DATE


def _ident(name: str) -> str:
    return name


def stg_query(name: str, keep: tuple[str, ...], spark_out: dict[str, Callable], sql_out: dict[str, Callable],
              pre: tuple[Callable, Callable] | None = None) -> None:
    """Register a per-row operator over ``stg``: row_id + kept raw columns
    + computed columns.  ``pre`` is an optional struct computed once (``_s``)."""

    def build(spark, sf_dir):
        df = fixtures.stg(spark, sf_dir)
        if pre is not None:
            df = df.withColumn("_s", pre[0](F.col))
        return df.select("row_id", *keep, *[f(F.col).alias(k) for k, f in spark_out.items()])

    inner = "stg" if pre is None else f"(SELECT *, {pre[1](_ident)} AS _s FROM stg)"
    cols = ", ".join(["row_id", *keep, *[f"{f(_ident)} AS {k}" for k, f in sql_out.items()]])
    sql = fixtures.duck_prefix("stg") + f"SELECT {cols} FROM {inner} AS t"
    register(name, sql)(build)


MINMAX_SP = {"v_min": lambda c: c("_s.min"), "v_max": lambda c: c("_s.max")}
MINMAX_SQ = {"v_min": lambda c: "_s.min", "v_max": lambda c: "_s.max"}

# --- salary ---------------------------------------------------------------
stg_query("salary_v1", ("MucLuong",), MINMAX_SP, MINMAX_SQ,
          pre=(lambda c: P.salary_v1(c("MucLuong")), lambda c: O.salary_v1("MucLuong")))


def _sal_v2_sql(fixed: bool) -> str:
    t = O.salary_v2_text("MucLuong")
    return O.salary_v2_from_values("MucLuong", t, O.salary_v2_values(t, fixed))


stg_query("salary_v2_legacy", ("MucLuong",), MINMAX_SP, MINMAX_SQ,
          pre=(lambda c: P.salary_v2(c("MucLuong"), fixed=False), lambda c: _sal_v2_sql(False)))
stg_query("salary_v2_fixed", ("MucLuong",), MINMAX_SP, MINMAX_SQ,
          pre=(lambda c: P.salary_v2(c("MucLuong"), fixed=True), lambda c: _sal_v2_sql(True)))
stg_query("salary_band_v1", ("MucLuong",),
          {"v_avg": lambda c: (c("_s.min") + c("_s.max")) / 2,
           "KhoangLuong": lambda c: P.salary_band_v1((c("_s.min") + c("_s.max")) / 2)},
          {"v_avg": lambda c: "(_s.min + _s.max) / 2",
           "KhoangLuong": lambda c: O.salary_band_v1("((_s.min + _s.max) / 2)")},
          pre=(lambda c: P.salary_v1(c("MucLuong")), lambda c: O.salary_v1("MucLuong")))
stg_query("salary_band_v2", ("MucLuong",),
          {"v_avg": lambda c: P.salary_avg_v2(c("_s.min"), c("_s.max")),
           "KhoangLuong": lambda c: P.salary_band_v2(P.salary_avg_v2(c("_s.min"), c("_s.max")))},
          {"v_avg": lambda c: O.salary_avg_v2("_s.min", "_s.max"),
           "KhoangLuong": lambda c: O.salary_band_v2(O.salary_avg_v2("_s.min", "_s.max"))},
          pre=(lambda c: P.salary_v2(c("MucLuong")), lambda c: _sal_v2_sql(True)))
stg_query("salary_text", ("MucLuong",),
          {"Luong_clean": lambda c: P.salary_text(c("_s.min"), c("_s.max"))},
          {"Luong_clean": lambda c: O.salary_text("_s.min", "_s.max")},
          pre=(lambda c: P.salary_v2(c("MucLuong")), lambda c: _sal_v2_sql(True)))

# --- experience -----------------------------------------------------------
EXP_SP = {"v_min": lambda c: c("_s.min"), "v_max": lambda c: c("_s.max"),
          "v_avg": lambda c: null_skip_mean(c("_s.min"), c("_s.max"))}
EXP_SQ = {"v_min": lambda c: "_s.min", "v_max": lambda c: "_s.max",
          "v_avg": lambda c: O.null_skip_mean("_s.min", "_s.max")}
stg_query("experience_v1", ("YeuCauKinhNghiem", "YeuCauUngVien"), EXP_SP, EXP_SQ,
          pre=(lambda c: P.experience_v1_coalesced(c("YeuCauKinhNghiem"), c("YeuCauUngVien")),
               lambda c: O.experience_v1_coalesced("YeuCauKinhNghiem", "YeuCauUngVien")))
stg_query("experience_extended", ("YeuCauKinhNghiem", "YeuCauUngVien"), EXP_SP, EXP_SQ,
          pre=(lambda c: P.experience_v1_coalesced(c("YeuCauKinhNghiem"), c("YeuCauUngVien"), extended=True),
               lambda c: O.experience_v1_coalesced("YeuCauKinhNghiem", "YeuCauUngVien", extended=True)))
stg_query("experience_v2", ("YeuCauKinhNghiem",), EXP_SP, EXP_SQ,
          pre=(lambda c: P.experience_v2(c("YeuCauKinhNghiem")), lambda c: O.experience_v2("YeuCauKinhNghiem")))
stg_query("experience_band_v1", ("YeuCauKinhNghiem",),
          {"PhanLoaiKinhNghiem": lambda c: P.experience_band_v1(null_skip_mean(c("_s.min"), c("_s.max")))},
          {"PhanLoaiKinhNghiem": lambda c: O.experience_band_v1(O.null_skip_mean("_s.min", "_s.max"))},
          pre=(lambda c: P.experience_v1_coalesced(c("YeuCauKinhNghiem"), c("YeuCauUngVien")),
               lambda c: O.experience_v1_coalesced("YeuCauKinhNghiem", "YeuCauUngVien")))
stg_query("experience_band_v2", ("YeuCauKinhNghiem",),
          {"PhanLoaiKinhNghiem": lambda c: P.experience_band_v2(null_skip_mean(c("_s.min"), c("_s.max")))},
          {"PhanLoaiKinhNghiem": lambda c: O.experience_band_v2(O.null_skip_mean("_s.min", "_s.max"))},
          pre=(lambda c: P.experience_v2(c("YeuCauKinhNghiem")), lambda c: O.experience_v2("YeuCauKinhNghiem")))
stg_query("experience_text", ("YeuCauKinhNghiem",),
          {"KinhNghiem_clean": lambda c: P.experience_text(c("_s.min"), c("_s.max"))},
          {"KinhNghiem_clean": lambda c: O.experience_text("_s.min", "_s.max")},
          pre=(lambda c: P.experience_v2(c("YeuCauKinhNghiem")), lambda c: O.experience_v2("YeuCauKinhNghiem")))

# --- company size ---------------------------------------------------------
SIZE1_SP = {"v_min": lambda c: c("_s.min"), "v_max": lambda c: c("_s.max"),
            "v_avg": lambda c: P.size_avg_v1(c("_s.min"), c("_s.max"))}
SIZE1_SQ = {"v_min": lambda c: "_s.min", "v_max": lambda c: "_s.max",
            "v_avg": lambda c: O.size_avg_v1("_s.min", "_s.max")}
stg_query("size_v1", ("QuyMoCongTy",), SIZE1_SP, SIZE1_SQ,
          pre=(lambda c: P.size_v1(c("QuyMoCongTy")), lambda c: O.size_v1("QuyMoCongTy")))
stg_query("size_extended", ("QuyMoCongTy",), SIZE1_SP, SIZE1_SQ,
          pre=(lambda c: P.size_v1(c("QuyMoCongTy"), extended=True), lambda c: O.size_v1("QuyMoCongTy", True)))
stg_query("size_v2", ("QuyMoCongTy",), EXP_SP, EXP_SQ,
          pre=(lambda c: P.size_v2(c("QuyMoCongTy")), lambda c: O.size_v2("QuyMoCongTy")))
stg_query("size_band_v1", ("QuyMoCongTy",),
          {"PhanLoaiQuyMoCongTy": lambda c: P.size_band_v1(P.size_avg_v1(c("_s.min"), c("_s.max")))},
          {"PhanLoaiQuyMoCongTy": lambda c: O.size_band_v1(O.size_avg_v1("_s.min", "_s.max"))},
          pre=(lambda c: P.size_v1(c("QuyMoCongTy")), lambda c: O.size_v1("QuyMoCongTy")))
stg_query("size_text", ("QuyMoCongTy",),
          {"QuyMo_clean": lambda c: P.size_text(c("_s.min"), c("_s.max"))},
          {"QuyMo_clean": lambda c: O.size_text("_s.min", "_s.max")},
          pre=(lambda c: P.size_v2(c("QuyMoCongTy")), lambda c: O.size_v2("QuyMoCongTy")))
stg_query("size_class_v2", ("QuyMoCongTy",),
          {"LoaiQuyMo_clean": lambda c: P.size_class_v2(c("_s.max"))},
          {"LoaiQuyMo_clean": lambda c: O.size_class_v2("_s.max")},
          pre=(lambda c: P.size_v2(c("QuyMoCongTy")), lambda c: O.size_v2("QuyMoCongTy")))
stg_query("null_skip_mean", ("QuyMoCongTy",),
          {"v_avg": lambda c: null_skip_mean(c("_s.min"), c("_s.max"))},
          {"v_avg": lambda c: O.null_skip_mean("_s.min", "_s.max")},
          pre=(lambda c: P.size_v1(c("QuyMoCongTy")), lambda c: O.size_v1("QuyMoCongTy")))

# --- classifiers ----------------------------------------------------------
stg_query("headcount", ("SoLuongTuyen", "CongViec"),
          {"SoLuongTuyen_clean": lambda c: C.headcount(c("SoLuongTuyen"), c("CongViec"))},
          {"SoLuongTuyen_clean": lambda c: O.headcount("SoLuongTuyen", "CongViec")})
stg_query("title_class_v1", ("CongViec",), {"CongViec_clean": lambda c: C.title_class_v1(c("CongViec"))},
          {"CongViec_clean": lambda c: O.title_class_v1("CongViec")})
stg_query("title_clean_v2", ("CongViec",), {"CongViec_clean": lambda c: C.title_clean_v2(c("CongViec"))},
          {"CongViec_clean": lambda c: O.title_clean_v2("CongViec")})
stg_query("job_role_v2", ("CongViec",), {"ViTri_Tuyen_Clean": lambda c: C.job_role_v2(c("CongViec"))},
          {"ViTri_Tuyen_Clean": lambda c: O.job_role_v2("CongViec")})
stg_query("rank_v1", ("CongViec",), {"CapBac_clean": lambda c: C.rank_v1(c("CongViec"))},
          {"CapBac_clean": lambda c: O.rank_v1("CongViec")})
stg_query("rank_v2", ("CongViec", "YeuCauKinhNghiem"),
          {"CapBac_clean": lambda c: C.rank_v2(c("CongViec"), null_skip_mean(c("_s.min"), c("_s.max")))},
          {"CapBac_clean": lambda c: O.rank_v2("CongViec", O.null_skip_mean("_s.min", "_s.max"))},
          pre=(lambda c: P.experience_v2(c("YeuCauKinhNghiem")), lambda c: O.experience_v2("YeuCauKinhNghiem")))
stg_query("industry_v1", ("LinhVuc",), {"LinhVuc_clean": lambda c: C.industry_v1(c("LinhVuc"))},
          {"LinhVuc_clean": lambda c: O.industry_v1("LinhVuc")})
stg_query("industry_macro_v2", ("LinhVuc",), {"LinhVuc_Web": lambda c: C.industry_macro_v2(c("LinhVuc"))},
          {"LinhVuc_Web": lambda c: O.industry_macro_v2("LinhVuc")})
stg_query("industry_sub_v2", ("CongViec",), {"LinhVuc_Con": lambda c: C.industry_sub_v2(c("CongViec"))},
          {"LinhVuc_Con": lambda c: O.industry_sub_v2("CongViec")})
stg_query("education_v1", ("HocVan",), {"HocVan_clean": lambda c: C.education_v1(c("HocVan"))},
          {"HocVan_clean": lambda c: O.education_v1("HocVan")})
stg_query("education_v2", ("HocVan", "YeuCauUngVien"),
          {"HocVan_clean": lambda c: C.education_v2(c("HocVan"), c("YeuCauUngVien"))},
          {"HocVan_clean": lambda c: O.education_v2("HocVan", "YeuCauUngVien")})
stg_query("skills_v1", ("MoTaCongViec", "YeuCauUngVien"),
          {"YeuCauKiNangCung_clean": lambda c: c("_s.hard"), "YeuCauKiNangMem_clean": lambda c: c("_s.soft")},
          {"YeuCauKiNangCung_clean": lambda c: "_s.hard", "YeuCauKiNangMem_clean": lambda c: "_s.soft"},
          pre=(lambda c: C.skills_v1(c("MoTaCongViec"), c("YeuCauUngVien")),
               lambda c: O.skills_v1("MoTaCongViec", "YeuCauUngVien")))
for _kind, _col in (("hard", "Hard_Skills"), ("soft", "Soft_Skills"), ("language", "Ngoai_Ngu")):
    stg_query(f"skills_v2_{_kind}", ("YeuCauUngVien",),
              {_col: (lambda k: lambda c: C.skills_v2(c("YeuCauUngVien"), k))(_kind)},
              {_col: (lambda k: lambda c: O.skills_v2("YeuCauUngVien", k))(_kind)})
stg_query("workstyle_v1", ("HinhThucLamViec", "MoTaCongViec"),
          {"HinhThucLamViec_clean": lambda c: c("_s.employment"), "KieuLamViec_clean": lambda c: c("_s.mode")},
          {"HinhThucLamViec_clean": lambda c: "_s.employment", "KieuLamViec_clean": lambda c: "_s.mode"},
          pre=(lambda c: C.workstyle_v1(c("HinhThucLamViec"), c("MoTaCongViec")),
               lambda c: O.workstyle_v1("HinhThucLamViec", "MoTaCongViec")))
stg_query("workstyle_v2", ("HinhThucLamViec", "MoTaCongViec"),
          {"HinhThuc_clean": lambda c: c("_s.employment"), "WorkMode_clean": lambda c: c("_s.mode")},
          {"HinhThuc_clean": lambda c: "_s.employment", "WorkMode_clean": lambda c: "_s.mode"},
          pre=(lambda c: C.workstyle_v2(*[c(x) for x in ROW_TEXT_COLUMNS]),
               lambda c: O.workstyle_v2(ROW_TEXT_COLUMNS)))
stg_query("title_case", ("CongTy",), {"CongTy_clean": lambda c: title_case(c("CongTy"))},
          {"CongTy_clean": lambda c: O.title_case("CongTy")})

# --- dates and hashes -----------------------------------------------------
stg_query("deadline_v1", ("HanNopHoSo", "NgayCaoDuLieu"),
          {"HanNopHoSo_clean": lambda c: deadline_v1(c("HanNopHoSo"), c("NgayCaoDuLieu"))},
          {"HanNopHoSo_clean": lambda c: O.deadline_v1("HanNopHoSo", "NgayCaoDuLieu")})
stg_query("deadline_v2", ("HanNopHoSo", "NgayCaoDuLieu"),
          {"HanNopHoSo_clean": lambda c: deadline_v2(c("HanNopHoSo"), c("NgayCaoDuLieu"), AS_OF_DATE)},
          {"HanNopHoSo_clean": lambda c: O.deadline_v2("HanNopHoSo", "NgayCaoDuLieu", AS_OF_DATE)})
stg_query("job_hash_raw", ("CongViec", "CongTy", "ViTri"),
          {"JobHash": lambda c: job_hash_raw(c("CongViec"), c("CongTy"), c("ViTri"))},
          {"JobHash": lambda c: O.job_hash_raw("CongViec", "CongTy", "ViTri")})
stg_query("job_hash_clean", ("LinkBaiTuyenDung", "Nguon"),
          {"JobHash": lambda c: job_hash_clean(c("LinkBaiTuyenDung"), c("Nguon"))},
          {"JobHash": lambda c: O.job_hash_clean("LinkBaiTuyenDung", "Nguon")})


@register("date_key", f"""
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS FullDate, {O.date_key('CAST(o_orderdate AS DATE)')} AS DateKey
FROM orders""")
def _date_key(spark, sf_dir):
    o = fixtures.table(spark, sf_dir, "orders")
    d = F.col("o_orderdate").cast("date")
    return o.select("o_orderkey", d.alias("FullDate"), date_key(d).alias("DateKey"))


@register("safe_date_cast", fixtures.duck_prefix("stg") + f"""
SELECT row_id, HanNopHoSo, {O.safe_date('HanNopHoSo')} AS HanNopHoSo_date,
       {O.safe_date("CAST(NgayCaoDuLieu AS VARCHAR)")} AS NgayCaoDuLieu_date FROM stg""")
def _safe_date_cast(spark, sf_dir):
    from ..functions.dates import safe_date
    s = fixtures.stg(spark, sf_dir)
    return s.select("row_id", "HanNopHoSo", safe_date(F.col("HanNopHoSo")).alias("HanNopHoSo_date"),
                    safe_date(F.col("NgayCaoDuLieu").cast("string")).alias("NgayCaoDuLieu_date"))


# --- location explode -----------------------------------------------------

def _geo_v2_sql() -> str:
    from .. import rules as R
    coords = {p: (r, la, lo) for p, r, la, lo in R.PROVINCE_COORD_V2}
    prov = " ".join(f"WHEN contains(lower(part), {O.q(k)}) THEN {O.q(v)}" for k, v in R.PROVINCE_MERGE_V2)
    region = " ".join(f"WHEN {O.q(p)} THEN {O.q(r)}" for p, (r, _, _) in coords.items())
    lat = " ".join(f"WHEN {O.q(p)} THEN {O.num(la)}" for p, (_, la, _) in coords.items())
    lon = " ".join(f"WHEN {O.q(p)} THEN {O.num(lo)}" for p, (_, _, lo) in coords.items())
    parts = (f"list_filter(list_transform(string_split_regex({O.py_str('ViTri')}, '[;|,]'), "
             f"lambda _p: {O.strip('_p')}), lambda _p: _p <> '')")
    return fixtures.duck_prefix("stg") + f"""
, e AS (SELECT *, unnest({parts}) AS part, generate_subscripts({parts}, 1) AS pos FROM stg)
, g AS (SELECT *, CASE {prov} END AS Tinh_Thanh FROM e)
, r AS (SELECT *, row_number() OVER (PARTITION BY LinkBaiTuyenDung, Tinh_Thanh ORDER BY row_id, pos) AS rn
        FROM g WHERE Tinh_Thanh IS NOT NULL)
SELECT row_id, LinkBaiTuyenDung, ViTri, {O.title_case('part')} AS ViTri_clean, Tinh_Thanh,
       CASE Tinh_Thanh {region} ELSE 'Khác' END AS KhuVuc,
       CASE Tinh_Thanh {lat} END AS Latitude, CASE Tinh_Thanh {lon} END AS Longitude,
       {O.job_hash_clean('LinkBaiTuyenDung', 'Tinh_Thanh')} AS JobHash
FROM r WHERE rn = 1"""


@register("geo_explode_v2", _geo_v2_sql())
def _geo_explode_v2(spark, sf_dir):
    s = fixtures.stg(spark, sf_dir).select("row_id", "LinkBaiTuyenDung", "ViTri")
    g = geo_explode_v2(s, links_unique=False, order_col="row_id")
    return g.select("row_id", "LinkBaiTuyenDung", "ViTri", "ViTri_clean", "Tinh_Thanh", "KhuVuc", "Latitude",
                    "Longitude", job_hash_clean(F.col("LinkBaiTuyenDung"), F.col("Tinh_Thanh")).alias("JobHash"))


def _geo_v1_sql(src: str = "stg", cols: str = "row_id, ViTri") -> str:
    from .. import rules as R
    loc = O.strip("lower(part)")
    exact = " ".join(f"WHEN {O.q(k)} THEN {O.q(v)}" for k, v in R.PROVINCE_MERGE_V1)
    first = " ".join(f"WHEN contains({loc}, {O.q(k)}) THEN {O.q(v)}" for k, v in R.PROVINCE_MERGE_V1)

    def coord(i):
        ex = " ".join(f"WHEN {O.q(e[0])} THEN {O.q(e[i]) if isinstance(e[i], str) else O.num(e[i])}"
                      for e in R.PROVINCE_COORD_V1)
        fi = " ".join(f"WHEN contains({loc}, {O.q(e[0])}) THEN {O.q(e[i]) if isinstance(e[i], str) else O.num(e[i])}"
                      for e in R.PROVINCE_COORD_V1)
        return f"coalesce(CASE {loc} {ex} END, CASE {fi} END)"

    parts = (f"list_filter(list_transform(string_split_regex(ViTri, '[;,|&]|\\s+-\\s+'), "
             f"lambda _p: {O.strip('_p')}), lambda _p: _p <> '')")
    return f"""
, e AS (SELECT *, unnest(CASE WHEN {parts} IS NULL OR len({parts}) = 0 THEN [NULL::VARCHAR] ELSE {parts} END) AS part
        FROM {src})
SELECT {cols},
  CASE WHEN part IS NULL THEN NULL ELSE coalesce({coord(4)}, part) END AS ViTri_clean,
  CASE WHEN part IS NULL THEN 'Khác' ELSE coalesce(CASE {loc} {exact} END, CASE {first} END, part) END AS Tinh_Thanh,
  coalesce({coord(1)}, 'Khác') AS KhuVuc,
  {coord(2)} AS Latitude, {coord(3)} AS Longitude
FROM e"""


register("geo_explode_v1", fixtures.duck_prefix("stg") + _geo_v1_sql())(
    lambda spark, sf_dir: geo_explode_v1(fixtures.stg(spark, sf_dir).select("row_id", "ViTri")))


# --- latest row per key and the two cleaning pipelines --------------------

LATEST_SQL = """
, f AS (SELECT * EXCLUDE (_rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY LinkBaiTuyenDung ORDER BY NgayCaoDuLieu DESC NULLS LAST, row_id DESC) AS _rn
    FROM stg) WHERE _rn = 1)
"""


def raw_fact(spark, sf_dir):
    """stg -> one row per link (newest crawl wins, row_id breaks ties)."""
    from ..operators.dedupe import latest_per_key
    return latest_per_key(fixtures.stg(spark, sf_dir), ["LinkBaiTuyenDung"], ["NgayCaoDuLieu", "row_id"])


register("latest_per_key", fixtures.duck_prefix("stg") + LATEST_SQL + "SELECT * FROM f")(raw_fact)

_V2_TYPES = {"Latitude": "d", "Longitude": "d", "MucLuongMin_clean": "d", "MucLuongTB_clean": "d",
             "MucLuongMax_clean": "d", "Exp_Min_clean": "d", "Exp_Max_clean": "d", "QuyMoMin_clean": "d",
             "QuyMoMax_clean": "d", "QuyMoTB_clean": "d", "SoLuongTuyen_clean": "i", "NgayCaoDuLieu": "t",
             "HanNopHoSo_clean": "t", "NgayXuLyDL": "t"}


def _clean_v2_sql() -> str:
    from .. import rules as R
    coords = {p: (r, la, lo) for p, r, la, lo in R.PROVINCE_COORD_V2}
    prov = " ".join(f"WHEN contains(lower(part), {O.q(k)}) THEN {O.q(v)}" for k, v in R.PROVINCE_MERGE_V2)
    region = " ".join(f"WHEN {O.q(p)} THEN {O.q(r)}" for p, (r, _, _) in coords.items())
    lat = " ".join(f"WHEN {O.q(p)} THEN {O.num(la)}" for p, (_, la, _) in coords.items())
    lon = " ".join(f"WHEN {O.q(p)} THEN {O.num(lo)}" for p, (_, _, lo) in coords.items())
    parts = (f"list_filter(list_transform(string_split_regex({O.py_str('ViTri')}, '[;|,]'), "
             f"lambda _p: {O.strip('_p')}), lambda _p: _p <> '')")
    t = O.salary_v2_text("MucLuong")
    final = ", ".join(c if _V2_TYPES.get(c) else f"{O.strip(c)} AS {c}" for c in CLEAN_V2_COLUMNS)
    return fixtures.duck_prefix("stg") + LATEST_SQL + f"""
, a AS (SELECT *, {O.experience_v2('YeuCauKinhNghiem')} AS _exp, {t} AS _st, {O.size_v2('QuyMoCongTy')} AS _size FROM f)
, b AS (SELECT *, {O.salary_v2_from_values('MucLuong', '_st', O.salary_v2_values('_st', True))} AS _sal FROM a)
, c AS (SELECT *, _exp.min AS Exp_Min_clean, _exp.max AS Exp_Max_clean, {O.null_skip_mean('_exp.min', '_exp.max')} AS _exp_avg,
         _sal.min AS MucLuongMin_clean, _sal.max AS MucLuongMax_clean, _size.min AS QuyMoMin_clean, _size.max AS QuyMoMax_clean,
         {O.title_case('CongTy')} AS CongTy_clean, {O.title_clean_v2('CongViec')} AS CongViec_clean,
         {O.headcount('SoLuongTuyen', 'CongViec')} AS SoLuongTuyen_clean,
         {O.education_v2('HocVan', 'YeuCauUngVien')} AS HocVan_clean, {O.workstyle_v2(ROW_TEXT_COLUMNS)} AS _ws,
         {O.skills_v2('YeuCauUngVien', 'hard')} AS Hard_Skills, {O.skills_v2('YeuCauUngVien', 'soft')} AS Soft_Skills,
         {O.skills_v2('YeuCauUngVien', 'language')} AS Ngoai_Ngu, {O.industry_macro_v2('LinhVuc')} AS LinhVuc_Web,
         {O.industry_sub_v2('CongViec')} AS LinhVuc_Con, {O.job_role_v2('CongViec')} AS ViTri_Tuyen_Clean,
         {O.deadline_v2('HanNopHoSo', 'NgayCaoDuLieu', AS_OF_DATE)} AS HanNopHoSo_clean FROM b)
, d AS (SELECT *, {O.experience_band_v2('_exp_avg')} AS PhanLoaiKinhNghiem,
         {O.experience_text('Exp_Min_clean', 'Exp_Max_clean')} AS KinhNghiem_clean,
         {O.salary_avg_v2('MucLuongMin_clean', 'MucLuongMax_clean')} AS MucLuongTB_clean,
         {O.salary_band_v2(O.salary_avg_v2('MucLuongMin_clean', 'MucLuongMax_clean'))} AS KhoangLuong,
         {O.salary_text('MucLuongMin_clean', 'MucLuongMax_clean')} AS Luong_clean,
         {O.null_skip_mean('QuyMoMin_clean', 'QuyMoMax_clean')} AS QuyMoTB_clean,
         {O.size_text('QuyMoMin_clean', 'QuyMoMax_clean')} AS QuyMo_clean,
         {O.size_class_v2('QuyMoMax_clean')} AS LoaiQuyMo_clean,
         {O.rank_v2('CongViec', '_exp_avg')} AS CapBac_clean, _ws.employment AS HinhThuc_clean, _ws.mode AS WorkMode_clean
       FROM c)
, e AS (SELECT *, unnest({parts}) AS part, generate_subscripts({parts}, 1) AS pos FROM d)
, g AS (SELECT *, CASE {prov} END AS Tinh_Thanh FROM e)
, r AS (SELECT *, row_number() OVER (PARTITION BY LinkBaiTuyenDung, Tinh_Thanh ORDER BY row_id, pos) AS _rn2
        FROM g WHERE Tinh_Thanh IS NOT NULL)
, s AS (SELECT *, CASE Tinh_Thanh {region} ELSE 'Khác' END AS KhuVuc,
         CASE Tinh_Thanh {lat} END AS Latitude, CASE Tinh_Thanh {lon} END AS Longitude,
         {O.job_hash_clean('LinkBaiTuyenDung', 'Tinh_Thanh')} AS JobHash,
         CAST(TIMESTAMP '{AS_OF}' AS TIMESTAMP) AS NgayXuLyDL FROM r WHERE _rn2 = 1)
SELECT {final} FROM s"""


@register("clean_v2", _clean_v2_sql())
def _clean_v2(spark, sf_dir):
    return clean_v2(raw_fact(spark, sf_dir))


register("clean_v2_output", _clean_v2_sql())(_clean_v2)

_V1_TYPES = {"Latitude": "d", "Longitude": "d", "MucLuongMin_clean": "d", "MucLuongTB_clean": "d",
             "MucLuongMax_clean": "d", "YeuCauKinhNghiemMin_clean": "d", "YeuCauKinhNghiemTB_clean": "d",
             "YeuCauKinhNghiemMax_clean": "d", "QuyMoCongTyMin_clean": "d", "QuyMoCongTyTB_clean": "d",
             "QuyMoCongTyMax_clean": "d", "SoLuongTuyen_clean": "i", "NgayCaoDuLieu": "t",
             "HanNopHoSo_clean": "t", "NgayXuLyDL": "t"}


def _clean_v1_sql() -> str:
    co = O.title_case(O.strip("CongTy"))
    sal_min = "CASE WHEN _sal.min = 0 THEN NULL ELSE _sal.min END"
    sal_max = "CASE WHEN _sal.max = 0 THEN NULL ELSE _sal.max END"
    body = f"""
, a AS (SELECT * REPLACE ({co} AS CongTy), {O.salary_v1('MucLuong')} AS _sal,
         {O.experience_v1_coalesced('YeuCauKinhNghiem', 'YeuCauUngVien')} AS _exp, {O.size_v1('QuyMoCongTy')} AS _size,
         {O.workstyle_v1('HinhThucLamViec', 'MoTaCongViec')} AS _ws, {O.skills_v1('MoTaCongViec', 'YeuCauUngVien')} AS _sk
       FROM f)
, b AS (SELECT *, CongTy AS CongTy_clean, {O.title_class_v1('CongViec')} AS CongViec_clean, {O.rank_v1('CongViec')} AS CapBac_clean,
         {O.industry_v1('LinhVuc')} AS LinhVuc_clean, {O.education_v1('HocVan')} AS HocVan_clean,
         {O.headcount('SoLuongTuyen', 'CongViec')} AS SoLuongTuyen_clean,
         _ws.employment AS HinhThucLamViec_clean, _ws.mode AS KieuLamViec_clean,
         _sk.hard AS YeuCauKiNangCung_clean, _sk.soft AS YeuCauKiNangMem_clean,
         {O.deadline_v1('HanNopHoSo', 'NgayCaoDuLieu')} AS HanNopHoSo_clean,
         {sal_min} AS _smin, {sal_max} AS _smax,
         _exp.min AS YeuCauKinhNghiemMin_clean, _exp.max AS YeuCauKinhNghiemMax_clean,
         _size.min AS QuyMoCongTyMin_clean, _size.max AS QuyMoCongTyMax_clean FROM a)
, m AS (SELECT CongViec_clean, CapBac_clean, round(avg(_smin), 6) AS _mmin, round(avg(_smax), 6) AS _mmax
        FROM b GROUP BY ALL)
, c AS (SELECT b.*, coalesce(_smin, m._mmin, 0.0) AS MucLuongMin_clean, coalesce(_smax, m._mmax, 0.0) AS MucLuongMax_clean
        FROM b LEFT JOIN m USING (CongViec_clean, CapBac_clean))
, d AS (SELECT *, (MucLuongMin_clean + MucLuongMax_clean) / 2 AS MucLuongTB_clean,
         {O.salary_band_v1('((MucLuongMin_clean + MucLuongMax_clean) / 2)')} AS KhoangLuong,
         {O.null_skip_mean('YeuCauKinhNghiemMin_clean', 'YeuCauKinhNghiemMax_clean')} AS YeuCauKinhNghiemTB_clean,
         {O.experience_band_v1(O.null_skip_mean('YeuCauKinhNghiemMin_clean', 'YeuCauKinhNghiemMax_clean'))} AS PhanLoaiKinhNghiem,
         {O.size_avg_v1('QuyMoCongTyMin_clean', 'QuyMoCongTyMax_clean')} AS QuyMoCongTyTB_clean,
         {O.size_band_v1(O.size_avg_v1('QuyMoCongTyMin_clean', 'QuyMoCongTyMax_clean'))} AS PhanLoaiQuyMoCongTy,
         CAST(TIMESTAMP '{AS_OF}' AS TIMESTAMP) AS NgayXuLyDL, NULL::VARCHAR AS JobID, NULL::VARCHAR AS JobHash,
         NULL::VARCHAR AS YeuCauKiNang FROM c)"""
    geo = _geo_v1_sql("d", ", ".join(c for c in CLEAN_V1_COLUMNS if c not in
                                     ("ViTri_clean", "Tinh_Thanh", "KhuVuc", "Latitude", "Longitude")))
    cols = ", ".join(CLEAN_V1_COLUMNS)
    cte, sel = geo.split("\nSELECT ", 1)
    return fixtures.duck_prefix("stg") + LATEST_SQL + body + cte + ", x AS (SELECT " + sel + f") SELECT {cols} FROM x"


@register("clean_v1", _clean_v1_sql())
def _clean_v1(spark, sf_dir):
    return clean_v1(raw_fact(spark, sf_dir))


register("clean_v1_output", _clean_v1_sql())(_clean_v1)
