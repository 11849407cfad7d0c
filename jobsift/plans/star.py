"""Clean fact -> star schema (X5): dimension fill, calendar, 9-way star
lookup, idempotent fact upsert, and the consumption report."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.dims import assign_ids, assign_ids_small, calendar_fill, calendar_rows, max_key
from ..operators.upsert import ACTION, merge
from ..session import AS_OF, materialize

# (dimension, key, name column, clean-fact column, members come from the rule tables?)
NAME_DIMS = (
    ("Dim_Nguon", "NguonID", "TenNguon", "Nguon", True),
    ("Dim_CapBac", "CapBacID", "TenCapBac", "CapBac_clean", True),
    ("Dim_HocVan", "HocVanID", "TrinhDo", "HocVan_clean", True),
    ("Dim_Nganh", "NganhID", "TenNganh", "LinhVuc_clean", True),
    ("Dim_HinhThucLamViec", "HinhThucID", "TenHinhThuc", "HinhThucLamViec_clean", True),
    ("Dim_KieuLamViec", "KieuLamViecID", "TenKieuLamViec", "KieuLamViec_clean", True),
    ("Dim_CongTy", "CongTyID", "TenCongTy", "CongTy_clean", False),
    ("Dim_QuyMoCongTy", "QuyMoID", "TenQuyMo", "PhanLoaiQuyMoCongTy", True),
    ("Dim_KhuVuc", "KhuVucID", "TenKhuVuc", "KhuVuc", True),
)
PROVINCE_DIM = ("Dim_TinhThanh", "TinhThanhID", "TenTinhThanh", "Tinh_Thanh")
DIM_TABLES = (*(t for t, *_ in NAME_DIMS), "Dim_TinhThanh", "Dim_ThoiGian")
FK_COLUMNS = ("CongTyID", "QuyMoID", "TinhThanhID", "KhuVucID", "NganhID", "CapBacID", "HocVanID", "HinhThucID",
              "KieuLamViecID", "NguonID")

FACT_SCHEMA = T.StructType(
    [T.StructField("FactID", T.LongType()), T.StructField("JobHash", T.StringType()),
     T.StructField("DateKey", T.IntegerType())]
    + [T.StructField(c, T.IntegerType()) for c in FK_COLUMNS]
    + [T.StructField("SoLuongTuyen", T.IntegerType()), T.StructField("LinkBaiTuyenDung", T.StringType()),
       T.StructField("NgayTao", T.TimestampNTZType()), T.StructField("NgayCapNhat", T.TimestampNTZType())])

# v2 writes these four under other names; the star load reads the names on the right
V2_TO_STAR = {"HinhThuc_clean": "HinhThucLamViec_clean", "WorkMode_clean": "KieuLamViec_clean",
              "LinhVuc_Web": "LinhVuc_clean", "LoaiQuyMo_clean": "PhanLoaiQuyMoCongTy"}


def v2_to_star(clean: DataFrame) -> DataFrame:
    """Adapter for the schema drift between the v2 writer and the star load."""
    return clean.withColumnsRenamed(V2_TO_STAR)


#: A dimension of at most so many rows, counted in the run, is broadcast; a larger one is left to AQE.
BROADCAST_ROWS = 20_000
DIM_TABLE = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("name", T.StringType()),
                          T.StructField("parent_id", T.IntegerType()), T.StructField("dim", T.StringType())])


class Dims(dict):
    """The dimension tables by name, as one stored table ``stored`` (id, name,
    parent_id, dim) holds them, and their numbers of rows, ``rows``."""

    def __init__(self, stored: DataFrame, rows: dict[str, int]):
        self.stored, self.rows = stored, rows
        of = {t: stored.where(F.col("dim") == t) for t in DIM_TABLES}
        super().__init__({t: of[t].select(F.col("id").alias(key), F.col("name").alias(name)) for t, key, name, *_ in NAME_DIMS})
        t, key, name, _ = PROVINCE_DIM
        self[t] = of[t].select(F.col("id").alias(key), F.col("name").alias(name), F.col("parent_id").alias("KhuVucID"))
        self["Dim_ThoiGian"] = calendar_rows(of["Dim_ThoiGian"].select(F.col("name").cast("date").alias("FullDate")))


def _stored_form(dims: dict[str, DataFrame]) -> DataFrame:
    """Dimension tables under their own column names as one table."""
    columns = {t: (key, name, None) for t, key, name, *_ in NAME_DIMS}
    columns |= {PROVINCE_DIM[0]: (*PROVINCE_DIM[1:3], "KhuVucID"), "Dim_ThoiGian": ("DateKey", "FullDate", None)}
    out = None
    for t, df in dims.items():
        key, name, parent = columns[t]
        one = df.select(F.col(key).cast("int").alias("id"), F.col(name).cast("string").alias("name"),
                        (F.col(parent) if parent else F.lit(None)).cast("int").alias("parent_id"), F.lit(t).alias("dim"))
        out = one if out is None else out.unionByName(one)
    return out


def dim_members(src: DataFrame) -> DataFrame:
    """``(dim, name, parent)``: the distinct members of all dimensions in one
    pass over the source; ``parent`` is the region of a province."""
    none = F.lit(None).cast("string")
    day = F.col("NgayCaoDuLieu").cast("string").try_cast("date").cast("string")
    each = [(t, F.col(col), none) for t, _, _, col, _ in NAME_DIMS] + [(PROVINCE_DIM[0], F.col(PROVINCE_DIM[3]), F.col("KhuVuc")), ("Dim_ThoiGian", day, none)]
    members = F.inline(F.array(*[F.struct(F.lit(t).alias("dim"), c.cast("string").alias("name"), p.alias("parent")) for t, c, p in each]))
    return src.select(members).where("name IS NOT NULL").distinct()


def fill_dims(src: DataFrame, dims: dict[str, DataFrame] | None = None) -> Dims:
    """D1 + D2 + D3: every dimension after this run (existing + new members).

    The source is read once, for the distinct members of all dimensions, which
    are counted as they are written.  New members (left anti join by name) are
    numbered after the largest id of their dimension, in name order: those of all
    small dimensions in one window, a large one by the partition-offset
    numbering.  All are written as one table.
    """
    spark = src.sparkSession
    old = dims.stored if isinstance(dims, Dims) else _stored_form(dims) if dims else None
    seen = Observation(f"dims-{uuid.uuid4().hex}")
    each = [F.count_if(F.col("dim") == t).alias(t) for t in DIM_TABLES]
    fresh = dim_members(src)
    members = fresh = materialize(fresh if old is not None else fresh.observe(seen, *each), "dim-members")
    top, have = {}, {}
    if old is not None:
        for r in old.groupBy("dim").agg(F.max("id").alias("top"), F.count("*").alias("n")).collect():  # a row a dimension
            top[r["dim"]], have[r["dim"]] = r["top"], r["n"]
        fresh = materialize(members.join(old.select("dim", "name"), ["dim", "name"], "left_anti").observe(seen, *each), "dim-fresh")
    many = seen.get
    starts = F.create_map(*[F.lit(x) for t in DIM_TABLES for x in (t, top.get(t, 0))])
    columns = DIM_TABLE.fieldNames()
    named = [t for t, *_ in NAME_DIMS]
    small = [t for t in named if many[t] <= BROADCAST_ROWS]
    rank = F.row_number().over(Window.partitionBy("dim").orderBy("name"))  # BROADCAST_ROWS rows a dimension at most
    new = fresh.where(F.col("dim").isin(small)).select((starts[F.col("dim")] + rank).cast("int").alias("id"), "name", F.lit(None).cast("int").alias("parent_id"), "dim")
    for t in set(named) - set(small):
        rows = fresh.where(F.col("dim") == t).select("name", F.lit(None).cast("int").alias("parent_id"), "dim")
        new = new.unionByName(assign_ids(rows, ["name"], "id", start=top.get(t, 0)).select(columns))
    if old is not None:
        new = old.select(columns).unionByName(new)
    t = PROVINCE_DIM[0]
    if many[t]:
        regions = new.where("dim = 'Dim_KhuVuc'").select(F.col("name").alias("parent"), F.col("id").alias("parent_id"))
        pairs = fresh.where(F.col("dim") == t).select("name", "parent", "dim").join(regions, "parent", "left").select("name", "parent_id", "dim").distinct()
        number = assign_ids_small if many[t] <= BROADCAST_ROWS else assign_ids
        new = new.unionByName(number(pairs, ["name", "parent_id"], "id", start=top.get(t, 0)).select(columns))
    days = calendar_fill(None if old is None else old.where("dim = 'Dim_ThoiGian'").select(F.col("name").cast("date").alias("FullDate")),
                         members.where("dim = 'Dim_ThoiGian'").select("name"), "name")
    new = new.unionByName(days.select(F.col("DateKey").alias("id"), F.col("FullDate").cast("string").alias("name"),
                                      F.lit(None).cast("int").alias("parent_id"), F.lit("Dim_ThoiGian").alias("dim")))
    return Dims(materialize(new, "dims"), {t: many[t] + have.get(t, 0) for t in DIM_TABLES})


def star_source(src: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """The MERGE source -- hash, link, date key, 11 FKs (-1 when no
    match), measure (1 when missing).

    A dimension that ``fill_dims`` counted and found small is broadcast; any
    other join is left to AQE, which broadcasts only what is under its threshold
    at runtime and shuffles otherwise.
    """
    rows = dims.rows if isinstance(dims, Dims) else {}

    def sized(t: str, d: DataFrame) -> DataFrame:
        return F.broadcast(d) if t in rows and rows[t] <= BROADCAST_ROWS else d

    df = src.select("JobHash", "LinkBaiTuyenDung", "NgayCaoDuLieu", "SoLuongTuyen_clean", "Tinh_Thanh",
                    *[c for _, _, _, c, _ in NAME_DIMS if c != "KhuVuc"])
    for table, key, name, col, _ in NAME_DIMS:
        if table == "Dim_KhuVuc":
            continue  # the region key comes from the province dimension
        d = dims[table].select(F.col(name).alias(f"_n_{key}"), key)
        df = df.join(sized(table, d), F.col(col) == F.col(f"_n_{key}"), "left")
    prov = dims["Dim_TinhThanh"].groupBy("TenTinhThanh").agg(F.min("TinhThanhID").alias("TinhThanhID"),
                                                             F.min_by("KhuVucID", "TinhThanhID").alias("KhuVucID"))
    df = df.join(sized("Dim_TinhThanh", prov), F.col("Tinh_Thanh") == F.col("TenTinhThanh"), "left")
    date_key = F.date_format(F.col("NgayCaoDuLieu").cast("string").try_cast("date"), "yyyyMMdd").cast("int")
    return df.select(
        "JobHash", "LinkBaiTuyenDung", date_key.alias("DateKey"),
        *[F.coalesce(F.col(c), F.lit(-1)).cast("int").alias(c) for c in FK_COLUMNS],
        F.coalesce(F.col("SoLuongTuyen_clean"), F.lit(1)).cast("int").alias("SoLuongTuyen"))


def empty_fact(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], FACT_SCHEMA)


def _star_columns(as_of: str) -> tuple[dict, dict]:
    """What matched rows take (new FKs, measure and NgayCapNhat; link and NgayTao
    untouched) and what new rows take."""
    now = F.lit(as_of).cast("timestamp_ntz")
    upd = {c: c for c in ("DateKey", *FK_COLUMNS, "SoLuongTuyen")}
    ins = {c: c for c in ("JobHash", "DateKey", *FK_COLUMNS, "SoLuongTuyen", "LinkBaiTuyenDung")}
    return upd | {"NgayCapNhat": now}, ins | {"NgayTao": now, "NgayCapNhat": now}


def number_inserts(merged: DataFrame, start: int) -> DataFrame:
    """The next FactIDs for the inserted rows, in JobHash order.  The merged rows
    are written first, so the plan above them runs once for all that follows."""
    merged = materialize(merged, "star-merged")
    inserted = merged.filter(F.col(ACTION) == "INSERT").drop("FactID")
    kept = merged.filter(F.col(ACTION).isNull() | (F.col(ACTION) == "UPDATE"))
    return kept.unionByName(assign_ids(inserted, ["JobHash"], "FactID", start=start, key_type="bigint"))


def star_merge(fact: DataFrame, source: DataFrame, as_of: str = AS_OF) -> DataFrame:
    """MERGE by JobHash; the source is written first, as the check of its
    keys and the merge both read it."""
    upd, ins = _star_columns(as_of)
    merged = merge(fact, materialize(source, "star-source"), ["JobHash"], update=upd, insert=ins)
    return number_inserts(merged, max_key(fact, "FactID"))


def star_load(clean_v2_fact: DataFrame, dims: dict[str, DataFrame] | None = None, fact: DataFrame | None = None,
              as_of: str = AS_OF) -> tuple[dict[str, DataFrame], DataFrame]:
    """Returns (dimensions, merged fact with MergeAction)."""
    src = v2_to_star(clean_v2_fact)
    all_dims = fill_dims(src, dims)
    source = star_source(src, all_dims)
    if fact is None:
        fact = empty_fact(clean_v2_fact.sparkSession)
    return all_dims, star_merge(fact, source, as_of)


def postings_report(fact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Consumption query: postings and openings by region, year, month, rank."""
    region = dims["Dim_KhuVuc"].select("KhuVucID", "TenKhuVuc")
    cal = dims["Dim_ThoiGian"].select("DateKey", "Nam", "Thang")
    rank = dims["Dim_CapBac"].select("CapBacID", "TenCapBac")
    f = fact.select("KhuVucID", "DateKey", "CapBacID", "SoLuongTuyen")
    j = (f.join(F.broadcast(region), "KhuVucID", "left").join(F.broadcast(cal), "DateKey", "left")
          .join(F.broadcast(rank), "CapBacID", "left"))
    return (j.groupBy("TenKhuVuc", "Nam", "Thang", "TenCapBac")
             .agg(F.count(F.lit(1)).alias("postings"), F.sum("SoLuongTuyen").cast("bigint").alias("openings")))


def flagship_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..workloads.postings import raw_fact
    from .clean import clean_v2
    clean = materialize(clean_v2(raw_fact(spark, sf_dir)), "clean_v2")
    dims, fact = star_load(clean)
    return postings_report(fact, dims)


def read_dims(spark: SparkSession, root: str) -> Dims | None:
    """The dimensions that the last star load under ``root`` left."""
    from .staging import read_current
    stored, version = read_current(spark, f"{root.rstrip('/')}/dims", None)
    if not version:
        return None
    stored = stored.select(*DIM_TABLE.fieldNames())
    return Dims(stored, {r["dim"]: r["count"] for r in stored.groupBy("dim").count().collect()})


def star_table(spark: SparkSession, root: str, buckets: int = 1024, keep: int = 2):
    from ..operators.tables import BucketedTable
    return BucketedTable(spark, f"{root.rstrip('/')}/fact", ["JobHash"], buckets, FACT_SCHEMA, keep)


def load_star(src: DataFrame, root: str, buckets: int = 1024, as_of: str = AS_OF, batch: tuple | None = None, keep: int = 2) -> dict[str, int]:
    """X5 over stored tables: fill the dimensions under ``root/dims`` (one version
    a run, members keep their keys), then merge into the star fact under
    ``root/fact``, of which only buckets touched by ``src`` are read and replaced.
    A run that fails between the two leaves members without facts, which the next
    run finds and keeps.  New facts get FactIDs after the largest there is."""
    from .staging import next_version
    spark = src.sparkSession
    dims = fill_dims(src, read_dims(spark, root))
    next_version(dims.stored, f"{root.rstrip('/')}/dims")
    table = star_table(spark, root, buckets, keep)
    start = max_key(table.read(), "FactID")
    upd, ins = _star_columns(as_of)
    return table.merge(materialize(star_source(src, dims), "star-source"), upd, ins, lambda merged: number_inserts(merged, start), batch)


def star_load_job(spark: SparkSession, clean_path: str, root: str, buckets: int = 1024,
                  as_of: str = AS_OF) -> dict[str, int]:
    """``load_star`` of the clean fact at ``clean_path``; the fact's folder holds
    its newest version only, so it can be read as it is."""
    return load_star(v2_to_star(spark.read.parquet(clean_path)), root, buckets, as_of, keep=1)
