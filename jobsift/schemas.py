"""Table schemas (S17): explicit StructTypes for every table the pipelines
write, and create-if-missing for parquet table folders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .fixtures import STAGING_COLUMNS
from .sources.files import RAW_CSV_COLUMNS

S, D, I, L, DBL, TS = T.StringType(), T.DateType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.TimestampNTZType()


def _st(fields) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields])


RAW_CSV = _st([(c, S) for c in RAW_CSV_COLUMNS])
RAW_CSV_22 = _st([(c, S) for c in (RAW_CSV_COLUMNS[0], "ChuyenMon", *RAW_CSV_COLUMNS[1:])])
RAW_TABLE = _st([(c, D if c == "NgayCaoDuLieu" else S) for c in RAW_CSV_COLUMNS])
STAGING = _st([(c, D if c == "NgayCaoDuLieu" else S) for c in STAGING_COLUMNS])
RAW_FACT = _st([("JobHash", S), ("NgayThemVaoHeThong", TS)] + [(f.name, f.dataType) for f in STAGING.fields])

# name dimensions: (table, key, name)
DIMENSIONS = {
    "Dim_KhuVuc": _st([("KhuVucID", I), ("TenKhuVuc", S)]),
    "Dim_TinhThanh": _st([("TinhThanhID", I), ("TenTinhThanh", S), ("KhuVucID", I)]),
    "Dim_CongTy": _st([("CongTyID", I), ("TenCongTy", S)]),
    "Dim_QuyMoCongTy": _st([("QuyMoID", I), ("TenQuyMo", S)]),
    "Dim_HocVan": _st([("HocVanID", I), ("TrinhDo", S)]),
    "Dim_Nguon": _st([("NguonID", I), ("TenNguon", S)]),
    "Dim_CapBac": _st([("CapBacID", I), ("TenCapBac", S)]),
    "Dim_HinhThucLamViec": _st([("HinhThucID", I), ("TenHinhThuc", S)]),
    "Dim_KieuLamViec": _st([("KieuLamViecID", I), ("TenKieuLamViec", S)]),
    "Dim_Nganh": _st([("NganhID", I), ("TenNganh", S)]),
    "Dim_ThoiGian": _st([("DateKey", I), ("FullDate", D), ("Nam", I), ("Quy", I), ("Thang", I)]),
}


def star_fact() -> T.StructType:
    from .plans.star import FACT_SCHEMA
    return FACT_SCHEMA


def run_log() -> T.StructType:
    from .plans.staging import LOG_SCHEMA
    return LOG_SCHEMA


def create_if_missing(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Create an empty parquet table folder when absent; return the table."""
    from .session import path_exists
    if not path_exists(spark, path):
        spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)
    return spark.read.schema(schema).parquet(path)
