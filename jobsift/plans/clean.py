"""Cleaning pipelines: raw postings -> clean fact (X1 = v1, X2 = v2).

Both are one lazy plan of narrow projections.  v2 has no shuffle at all
when the input holds one row per link (the raw fact does); v1 adds one
small aggregate for salary imputation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import classify as C
from ..functions import parsers as P
from ..functions.dates import deadline_v1, deadline_v2
from ..functions.text import py_strip, py_strip_stored, title_case
from ..operators.dedupe import first_per_key
from ..operators.geo import geo_explode_v1, geo_explode_v2, with_clean_hash
from ..operators.impute import impute_group_mean
from ..session import AS_OF, AS_OF_DATE, compiled_stages

CLEAN_V2_COLUMNS = (
    "LinkBaiTuyenDung", "CongTy", "CongViec", "CapBac", "ViTri", "MucLuong", "MoTaCongViec", "YeuCauUngVien",
    "YeuCauKinhNghiem", "LinhVuc", "HocVan", "HinhThucLamViec", "SoLuongTuyen", "QuyMoCongTy", "HanNopHoSo",
    "Nguon", "NgayCaoDuLieu", "JobHash", "CongTy_clean", "CongViec_clean", "CapBac_clean", "HocVan_clean",
    "HinhThuc_clean", "WorkMode_clean", "Tinh_Thanh", "KhuVuc", "Latitude", "Longitude", "Luong_clean",
    "MucLuongMin_clean", "MucLuongTB_clean", "MucLuongMax_clean", "KhoangLuong", "KinhNghiem_clean",
    "Exp_Min_clean", "Exp_Max_clean", "PhanLoaiKinhNghiem", "QuyMoMin_clean", "QuyMoMax_clean", "QuyMoTB_clean",
    "QuyMo_clean", "LoaiQuyMo_clean", "Hard_Skills", "Soft_Skills", "Ngoai_Ngu", "LinhVuc_Web", "LinhVuc_Con",
    "ViTri_Tuyen_Clean", "SoLuongTuyen_clean", "HanNopHoSo_clean", "NgayXuLyDL",
)

CLEAN_V1_COLUMNS = (
    "JobID", "JobHash", "CongTy", "CongTy_clean", "LinkBaiTuyenDung", "CongViec", "CongViec_clean", "CapBac",
    "CapBac_clean", "ViTri", "ViTri_clean", "Tinh_Thanh", "KhuVuc", "Latitude", "Longitude", "MucLuong",
    "MucLuongMin_clean", "MucLuongTB_clean", "MucLuongMax_clean", "KhoangLuong", "MoTaCongViec", "YeuCauUngVien",
    "YeuCauKinhNghiem", "YeuCauKinhNghiemMin_clean", "YeuCauKinhNghiemTB_clean", "YeuCauKinhNghiemMax_clean",
    "PhanLoaiKinhNghiem", "YeuCauKiNang", "YeuCauKiNangCung_clean", "YeuCauKiNangMem_clean", "LinhVuc",
    "LinhVuc_clean", "HocVan", "HocVan_clean", "HinhThucLamViec", "HinhThucLamViec_clean", "KieuLamViec_clean",
    "SoLuongTuyen", "SoLuongTuyen_clean", "QuyMoCongTy", "QuyMoCongTyMin_clean", "QuyMoCongTyTB_clean",
    "QuyMoCongTyMax_clean", "PhanLoaiQuyMoCongTy", "HanNopHoSo", "HanNopHoSo_clean", "Nguon", "NgayCaoDuLieu",
    "NgayXuLyDL",
)

# raw text columns whose concatenation stands in for the source's str(row)
ROW_TEXT_COLUMNS = ("CongViec", "ViTri", "YeuCauKinhNghiem", "MucLuong", "CapBac", "HinhThucLamViec", "CongTy",
                    "QuyMoCongTy", "SoLuongTuyen", "HocVan", "YeuCauUngVien", "MoTaCongViec", "QuyenLoi",
                    "HanNopHoSo", "LinkBaiTuyenDung", "Nguon", "LinhVuc")


def trim_all_text(df: DataFrame) -> DataFrame:
    """Strip every string column, keeping NULL."""
    return df.select(*[py_strip_stored(F.col(f.name)).alias(f.name) if f.dataType.simpleString() == "string"
                       else F.col(f.name) for f in df.schema.fields])


def with_v2_features(df: DataFrame, as_of_date: str = AS_OF_DATE) -> DataFrame:
    """All v2 per-row columns (before the location explode)."""
    col = F.col
    given = df.columns
    df = C.lowered(df, {"CongViec": "_title_l", "LinhVuc": "_field_l", "HocVan": "_school_l", "YeuCauUngVien": "_asks_l"})
    df = P.parse_experience_v2(df, "YeuCauKinhNghiem", "_exp")
    df = P.parse_salary_v2(df, "MucLuong", "_sal", fixed=True)
    df = P.parse_size_v2(df, "QuyMoCongTy", "_size")
    df = C.add_title_clean_v2(df, "CongViec", "CongViec_clean")
    df = C.add_headcount(df, "SoLuongTuyen", "CongViec", "SoLuongTuyen_clean")
    df = C.add_workstyle_v2(df, [c for c in ROW_TEXT_COLUMNS if c in given], "_ws")
    df = C.add_education_v2(df, "HocVan", "YeuCauUngVien", ("_school_l", "_asks_l"), "HocVan_clean")
    df = C.add_skills_v2(df, "YeuCauUngVien", "_asks_l", {"hard": "Hard_Skills", "soft": "Soft_Skills", "language": "Ngoai_Ngu"})
    df = df.select(
        "*",
        col("_exp.min").alias("Exp_Min_clean"),
        col("_exp.max").alias("Exp_Max_clean"),
        P.experience_avg(col("_exp.min"), col("_exp.max")).alias("_exp_avg"),
        col("_sal.min").alias("MucLuongMin_clean"),
        col("_sal.max").alias("MucLuongMax_clean"),
        col("_size.min").alias("QuyMoMin_clean"),
        col("_size.max").alias("QuyMoMax_clean"),
        title_case(col("CongTy")).alias("CongTy_clean"),
        C.industry_macro_v2(col("LinhVuc"), col("_field_l")).alias("LinhVuc_Web"),
        C.industry_sub_v2(col("CongViec"), col("_title_l")).alias("LinhVuc_Con"),
        C.title_rank_v2(col("CongViec"), col("_title_l")).alias("_rank"),
        C.job_role_v2(col("CongViec"), col("_title_l")).alias("ViTri_Tuyen_Clean"),
        deadline_v2(col("HanNopHoSo"), col("NgayCaoDuLieu"), as_of_date).alias("HanNopHoSo_clean"),
    ).drop("_exp", "_sal", "_size", "_field_l", "_school_l", "_asks_l", "_title_l")
    df = df.select("*", C.refine_rank_v2(col("_rank"), col("_exp_avg")).alias("CapBac_clean"),
                   P.salary_avg_v2(col("MucLuongMin_clean"), col("MucLuongMax_clean")).alias("MucLuongTB_clean")).drop("_rank")
    return df.select(
        "*",
        P.experience_band_v2(col("_exp_avg")).alias("PhanLoaiKinhNghiem"),
        P.experience_text(col("Exp_Min_clean"), col("Exp_Max_clean")).alias("KinhNghiem_clean"),
        P.salary_band_v2(col("MucLuongTB_clean")).alias("KhoangLuong"),
        P.salary_text(col("MucLuongMin_clean"), col("MucLuongMax_clean")).alias("Luong_clean"),
        P.null_skip_mean(col("QuyMoMin_clean"), col("QuyMoMax_clean")).alias("QuyMoTB_clean"),
        P.size_text(col("QuyMoMin_clean"), col("QuyMoMax_clean")).alias("QuyMo_clean"),
        P.size_class_v2(col("QuyMoMax_clean")).alias("LoaiQuyMo_clean"),
        col("_ws.employment").alias("HinhThuc_clean"),
        col("_ws.mode").alias("WorkMode_clean"),
    ).drop("_ws", "_exp_avg")


def clean_v2(df: DataFrame, as_of: str = AS_OF, as_of_date: str = AS_OF_DATE, links_unique: bool = True,
             order_col: str | None = None, trim_output: bool = True) -> DataFrame:
    """Raw fact rows -> 51-column clean fact, one row per (link, province).

    A NULL link is one link here, as in the source's drop of duplicates, and a
    MERGE by link inserts NULL links anew each time.  So rows without a link are
    always reduced to one a province, the smallest by crawl date and texts, in a
    branch of their own; the others need no shuffle when links are unique.
    """
    compiled_stages(df.sparkSession)
    feats = with_v2_features(df, as_of_date)
    if links_unique and not df.schema["LinkBaiTuyenDung"].nullable:
        geo = geo_explode_v2(feats)
    elif links_unique:
        link = F.col("LinkBaiTuyenDung")
        without = geo_explode_v2(feats.filter(link.isNull()))
        rank = [c for c in ("NgayCaoDuLieu", *ROW_TEXT_COLUMNS) if c in without.columns]
        geo = geo_explode_v2(feats.filter(link.isNotNull())).unionByName(first_per_key(without, ["LinkBaiTuyenDung", "Tinh_Thanh"], rank))
    else:
        geo = geo_explode_v2(feats, links_unique=False, order_col=order_col)
    out = with_clean_hash(geo).withColumn("NgayXuLyDL", F.lit(as_of).cast("timestamp_ntz"))
    out = out.select(*CLEAN_V2_COLUMNS)
    return trim_all_text(out) if trim_output else out


def clean_v1(df: DataFrame, as_of: str = AS_OF) -> DataFrame:
    """Raw fact rows -> 49-column clean fact (v1 rules)."""
    col = F.col
    company = title_case(py_strip(col("CongTy")))
    df = df.withColumn("CongTy", company)
    df = P.parse_salary_v1(df, "MucLuong", "_sal")
    df = P.parse_experience_v1_coalesced(df, "YeuCauKinhNghiem", "YeuCauUngVien", "_exp")
    df = P.parse_size_v1(df, "QuyMoCongTy", "_size")
    df = C.add_workstyle_v1(df, "HinhThucLamViec", "MoTaCongViec", "_ws")
    df = C.add_skills_v1(df, "MoTaCongViec", "YeuCauUngVien", "_sk")
    df = C.add_headcount(df, "SoLuongTuyen", "CongViec", "SoLuongTuyen_clean")
    df = C.lowered(df, {"CongViec": "_title_l", "LinhVuc": "_field_l", "HocVan": "_school_l"})
    df = df.select(
        "*",
        col("CongTy").alias("CongTy_clean"),
        C.title_class_v1(col("CongViec")).alias("CongViec_clean"),
        C.rank_v1(col("CongViec"), col("_title_l")).alias("CapBac_clean"),
        C.industry_v1(col("LinhVuc"), col("_field_l")).alias("LinhVuc_clean"),
        C.education_v1(col("HocVan"), col("_school_l")).alias("HocVan_clean"),
        col("_ws.employment").alias("HinhThucLamViec_clean"),
        col("_ws.mode").alias("KieuLamViec_clean"),
        col("_sk.hard").alias("YeuCauKiNangCung_clean"),
        col("_sk.soft").alias("YeuCauKiNangMem_clean"),
        deadline_v1(col("HanNopHoSo"), col("NgayCaoDuLieu")).alias("HanNopHoSo_clean"),
        col("_sal.min").alias("MucLuongMin_clean"),
        col("_sal.max").alias("MucLuongMax_clean"),
        col("_exp.min").alias("YeuCauKinhNghiemMin_clean"),
        col("_exp.max").alias("YeuCauKinhNghiemMax_clean"),
        col("_size.min").alias("QuyMoCongTyMin_clean"),
        col("_size.max").alias("QuyMoCongTyMax_clean"),
    ).drop("_sal", "_exp", "_size", "_ws", "_sk", "_title_l", "_field_l", "_school_l")
    # the (title class, rank) vocabulary is fixed by the rule tables -> bounded group table
    df = impute_group_mean(df, ["MucLuongMin_clean", "MucLuongMax_clean"], ["CongViec_clean", "CapBac_clean"],
                           bounded_groups=True)
    sal_avg = (col("MucLuongMin_clean") + col("MucLuongMax_clean")) / 2
    exp_avg = P.null_skip_mean(col("YeuCauKinhNghiemMin_clean"), col("YeuCauKinhNghiemMax_clean"))
    size_avg = P.size_avg_v1(col("QuyMoCongTyMin_clean"), col("QuyMoCongTyMax_clean"))
    df = df.select(
        "*",
        sal_avg.alias("MucLuongTB_clean"),
        P.salary_band_v1(sal_avg).alias("KhoangLuong"),
        exp_avg.alias("YeuCauKinhNghiemTB_clean"),
        P.experience_band_v1(exp_avg).alias("PhanLoaiKinhNghiem"),
        size_avg.alias("QuyMoCongTyTB_clean"),
        P.size_band_v1(size_avg).alias("PhanLoaiQuyMoCongTy"),
        F.lit(as_of).cast("timestamp_ntz").alias("NgayXuLyDL"),
    )
    out = geo_explode_v1(df)
    for missing in ("JobID", "JobHash", "YeuCauKiNang"):
        if missing not in out.columns:
            out = out.withColumn(missing, F.lit(None).cast("string"))
    return out.select(*CLEAN_V1_COLUMNS)
