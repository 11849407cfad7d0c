"""Warehouse workloads: upserts (U0-U5), dimensions (D1-D4), star (J3, U3,
X5) and their oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixtures
from ..functions.hashing import job_hash_raw
from ..operators.dims import calendar_fill, date_bounds, dim_fill, dim_fill_child, union_dim
from ..operators.upsert import ACTION, action_counts, merge
from ..plans.clean import clean_v2
from ..plans.star import (FK_COLUMNS, NAME_DIMS, V2_TO_STAR, empty_fact, fill_dims, postings_report, star_load,
                          star_merge, star_source, v2_to_star)
from ..registry import register
from ..session import AS_OF
from . import postings as PW
from .. import oracle as O

CUTOFF = "1998-01-01"          # "yesterday's" batch: crawl dates before this
BATCH2_FROM = "1997-01-01"      # "today's" batch overlaps the previous one

# ---------------------------------------------------------------------------
# U0 / U4 on customer: target = every segment but BUILDING, source = every
# segment but MACHINERY with a changed balance (overlap -> updates,
# MACHINERY -> inserts, BUILDING -> kept)
# ---------------------------------------------------------------------------


def _customer_merge(spark, sf_dir):
    c = fixtures.table(spark, sf_dir, "customer")
    tgt = c.filter(F.col("c_mktsegment") != "BUILDING")
    src = c.filter(F.col("c_mktsegment") != "MACHINERY").withColumn("c_acctbal", F.round(F.col("c_acctbal") + 100, 2))
    return merge(tgt, src, ["c_custkey"])


_CUST_SQL = """
WITH t AS (SELECT * FROM customer WHERE c_mktsegment <> 'BUILDING'),
s AS (SELECT * REPLACE (round(c_acctbal + 100, 2) AS c_acctbal) FROM customer WHERE c_mktsegment <> 'MACHINERY'),
m AS (
  SELECT coalesce(s.c_custkey, t.c_custkey) AS c_custkey,
         CASE WHEN s.c_custkey IS NOT NULL THEN s.c_name ELSE t.c_name END AS c_name,
         CASE WHEN s.c_custkey IS NOT NULL THEN s.c_nationkey ELSE t.c_nationkey END AS c_nationkey,
         CASE WHEN s.c_custkey IS NOT NULL THEN s.c_acctbal ELSE t.c_acctbal END AS c_acctbal,
         CASE WHEN s.c_custkey IS NOT NULL THEN s.c_mktsegment ELSE t.c_mktsegment END AS c_mktsegment,
         CASE WHEN s.c_custkey IS NOT NULL AND t.c_custkey IS NOT NULL THEN 'UPDATE'
              WHEN s.c_custkey IS NOT NULL THEN 'INSERT' END AS MergeAction
  FROM t FULL OUTER JOIN s ON t.c_custkey = s.c_custkey)
"""

register("upsert_generic", _CUST_SQL + "SELECT * FROM m")(_customer_merge)
register("merge_action_counts", _CUST_SQL + """
SELECT CAST(count(*) FILTER (WHERE MergeAction = 'INSERT') AS BIGINT) AS inserted,
       CAST(count(*) FILTER (WHERE MergeAction = 'UPDATE') AS BIGINT) AS updated FROM m""")(
    lambda spark, sf_dir: action_counts(_customer_merge(spark, sf_dir)))

# ---------------------------------------------------------------------------
# Staging -> raw fact (newest row per link, raw hash, MERGE by link)
# ---------------------------------------------------------------------------

STAGING = fixtures.STAGING_COLUMNS
RAW_FACT_COLUMNS = ("JobHash", "NgayThemVaoHeThong", *STAGING)


def staging_source(stg):
    from ..operators.dedupe import latest_per_key
    latest = latest_per_key(stg, ["LinkBaiTuyenDung"], ["NgayCaoDuLieu", "row_id"])
    return latest.withColumn("CalculatedHash", job_hash_raw(F.col("CongViec"), F.col("CongTy"), F.col("ViTri")))


def raw_columns(as_of: str) -> tuple[dict, dict]:
    """What matched rows of the raw fact take, and what new rows take."""
    own = {"JobHash": "CalculatedHash", "NgayThemVaoHeThong": F.lit(as_of).cast("timestamp_ntz")}
    return {c: c for c in STAGING if c != "LinkBaiTuyenDung"} | own, {c: c for c in STAGING} | own


def upsert_latest_by_link(fact, stg, as_of: str = AS_OF):
    """MERGE the newest staging row per link into the raw fact."""
    upd, ins = raw_columns(as_of)
    return merge(fact, staging_source(stg), ["LinkBaiTuyenDung"], update=upd, insert=ins)


def empty_raw_fact(spark):
    from pyspark.sql import types as T
    fields = [T.StructField("JobHash", T.StringType()), T.StructField("NgayThemVaoHeThong", T.TimestampNTZType())]
    fields += [T.StructField(c, T.DateType() if c == "NgayCaoDuLieu" else T.StringType()) for c in STAGING]
    return spark.createDataFrame([], T.StructType(fields))


def _raw_fact_two_runs(spark, sf_dir):
    stg = fixtures.stg(spark, sf_dir)
    first = upsert_latest_by_link(empty_raw_fact(spark), stg.filter(F.col("NgayCaoDuLieu") < F.lit(CUTOFF)))
    first = first.drop(ACTION)
    return upsert_latest_by_link(first, stg.filter(F.col("NgayCaoDuLieu") >= F.lit(BATCH2_FROM)))


def _raw_merge_sql() -> str:
    hashed = O.job_hash_raw("CongViec", "CongTy", "ViTri")
    latest = ("SELECT * EXCLUDE (_rn), {h} AS CalculatedHash FROM (SELECT *, row_number() OVER (PARTITION BY "
              "LinkBaiTuyenDung ORDER BY NgayCaoDuLieu DESC NULLS LAST, row_id DESC) AS _rn FROM stg WHERE {w}) "
              "WHERE _rn = 1").format
    cols_s = ", ".join(f"s.{c}" for c in STAGING)
    pick = ", ".join(f"CASE WHEN s.in_s THEN s.{c} ELSE t.{c} END AS {c}" for c in STAGING)
    return fixtures.duck_prefix("stg") + f"""
, b1 AS ({latest(h=hashed, w=f"NgayCaoDuLieu < DATE '{CUTOFF}'")})
, t AS (SELECT CalculatedHash AS JobHash, TIMESTAMP '{AS_OF}' AS NgayThemVaoHeThong, {cols_s}, true AS in_t FROM b1 s)
, s AS (SELECT *, true AS in_s FROM ({latest(h=hashed, w=f"NgayCaoDuLieu >= DATE '{BATCH2_FROM}'")}))
SELECT CASE WHEN s.in_s THEN s.CalculatedHash ELSE t.JobHash END AS JobHash,
       CASE WHEN s.in_s THEN TIMESTAMP '{AS_OF}' ELSE t.NgayThemVaoHeThong END AS NgayThemVaoHeThong,
       {pick},
       CASE WHEN s.in_s AND t.in_t THEN 'UPDATE' WHEN s.in_s THEN 'INSERT' END AS MergeAction
FROM t FULL OUTER JOIN s ON t.LinkBaiTuyenDung = s.LinkBaiTuyenDung"""


register("upsert_latest_by_link", _raw_merge_sql())(_raw_fact_two_runs)

register("input_count", fixtures.duck_prefix("stg") + "SELECT CAST(count(*) AS BIGINT) AS rows_in FROM stg")(
    lambda spark, sf_dir: fixtures.stg(spark, sf_dir).agg(F.count(F.lit(1)).alias("rows_in")))


@register("run_log", fixtures.duck_prefix("stg") + """
SELECT 'sp_Update_FactJobPostings' AS ProcedureName, 'Success' AS Status, count(*) AS rows_in,
       count(DISTINCT LinkBaiTuyenDung) + CAST(count(*) > count(LinkBaiTuyenDung) AS BIGINT) AS NewJobsInserted, CAST(0 AS BIGINT) AS OldJobsUpdated, NULL AS ErrorMessage FROM stg""")
def _run_log(spark, sf_dir):
    """Run the staging merge and return its log row without its times."""
    from ..plans.staging import run_with_log
    stg = fixtures.stg(spark, sf_dir)
    _, log = run_with_log(spark, "sp_Update_FactJobPostings", lambda: upsert_latest_by_link(empty_raw_fact(spark), stg),
                          rows_in=lambda: stg.count())
    return log.drop("StartTime", "EndTime", "DurationSeconds")

# ---------------------------------------------------------------------------
# D1-D4 over the clean fact: the dimension state of "yesterday" is built from
# the rows crawled before CUTOFF, then filled from all rows
# ---------------------------------------------------------------------------


def _clean_src(spark, sf_dir):
    from ..session import materialize
    return materialize(v2_to_star(clean_v2(PW.raw_fact(spark, sf_dir))), "clean_v2_star")


def _cv2_prefix() -> str:
    ren = ", ".join(f"{a} AS {b}" for a, b in V2_TO_STAR.items())
    inner = PW._clean_v2_sql()
    return f"WITH cv2 AS ({inner}), src AS (SELECT * EXCLUDE ({', '.join(V2_TO_STAR)}), {ren} FROM cv2)\n"


def _dim_sql(col: str, key: str, name: str) -> str:
    return f"""
, old_{key} AS (SELECT CAST(row_number() OVER (ORDER BY n) AS INTEGER) AS {key}, n AS {name}
    FROM (SELECT DISTINCT {col} AS n FROM src WHERE {col} IS NOT NULL AND NgayCaoDuLieu < DATE '{CUTOFF}'))
, d_{key} AS (SELECT * FROM old_{key} UNION ALL
    SELECT CAST((SELECT coalesce(max({key}), 0) FROM old_{key}) + row_number() OVER (ORDER BY n) AS INTEGER), n
    FROM (SELECT DISTINCT {col} AS n FROM src WHERE {col} IS NOT NULL) WHERE n NOT IN (SELECT {name} FROM old_{key}))
"""


def _dim_query(table, key, name, col):
    def build(spark, sf_dir):
        src = _clean_src(spark, sf_dir)
        old = dim_fill(None, src.filter(F.col("NgayCaoDuLieu") < F.lit(CUTOFF)), col, key, name)
        return union_dim(old, dim_fill(old, src, col, key, name))
    return build


_DIM_QUERY_NAMES = {"Dim_Nguon": "dim_fill_source", "Dim_CapBac": "dim_fill_rank", "Dim_HocVan": "dim_fill_education",
                    "Dim_Nganh": "dim_fill_industry", "Dim_HinhThucLamViec": "dim_fill_emptype",
                    "Dim_KieuLamViec": "dim_fill_workmode", "Dim_CongTy": "dim_fill_company",
                    "Dim_QuyMoCongTy": "dim_fill_size", "Dim_KhuVuc": "dim_fill_region"}
for _t, _k, _n, _c, _ in NAME_DIMS:
    register(_DIM_QUERY_NAMES[_t], _cv2_prefix() + _dim_sql(_c, _k, _n) + f"SELECT * FROM d_{_k}")(
        _dim_query(_t, _k, _n, _c))


@register("dim_fill_province", """
WITH r AS (SELECT CAST(row_number() OVER (ORDER BY r_name) AS INTEGER) AS KhuVucID, r_name AS TenKhuVuc
           FROM (SELECT DISTINCT r_name FROM region WHERE r_name IS NOT NULL))
, p AS (SELECT DISTINCT n.n_name AS TenTinhThanh, r.KhuVucID FROM nation n JOIN region rr ON n.n_regionkey = rr.r_regionkey
        LEFT JOIN r ON rr.r_name = r.TenKhuVuc WHERE n.n_name IS NOT NULL)
SELECT CAST(row_number() OVER (ORDER BY TenTinhThanh, KhuVucID) AS INTEGER) AS TinhThanhID, TenTinhThanh, KhuVucID FROM p""")
def _dim_province(spark, sf_dir):
    """D2 on the driver tables: nations as provinces, regions as their parent."""
    n = fixtures.table(spark, sf_dir, "nation")
    r = fixtures.table(spark, sf_dir, "region")
    src = n.join(r, n.n_regionkey == r.r_regionkey).select(F.col("n_name"), F.col("r_name"))
    region = dim_fill(None, src, "r_name", "KhuVucID", "TenKhuVuc")
    return dim_fill_child(None, src, "n_name", "r_name", region, "TenKhuVuc", "KhuVucID", "TinhThanhID", "TenTinhThanh")


_CAL_SELECT = ("CAST(strftime(d, '%Y%m%d') AS INTEGER) AS DateKey, d AS FullDate, CAST(year(d) AS INTEGER) AS Nam, "
               "CAST(quarter(d) AS INTEGER) AS Quy, CAST(month(d) AS INTEGER) AS Thang")


@register("calendar_fill", f"""
WITH b AS (SELECT min(TRY_CAST(o_orderdate AS DATE)) AS lo, max(TRY_CAST(o_orderdate AS DATE)) AS hi FROM orders),
old AS (SELECT CAST(o_orderdate AS DATE) AS d FROM orders WHERE o_orderdate < DATE '{CUTOFF}' GROUP BY 1),
days AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d FROM b WHERE lo IS NOT NULL)
SELECT {_CAL_SELECT} FROM days WHERE d NOT IN (SELECT d FROM old)""")
def _calendar_fill(spark, sf_dir):
    """D3 over order dates; "existing" calendar = days already seen before CUTOFF."""
    from ..operators.dims import calendar_rows
    o = fixtures.table(spark, sf_dir, "orders")
    existing = calendar_rows(o.filter(F.col("o_orderdate") < F.lit(CUTOFF))
                              .select(F.col("o_orderdate").cast("date").alias("FullDate")).distinct())
    return calendar_fill(existing, o, "o_orderdate")


@register("calendar_recursive", f"""
WITH RECURSIVE b AS (SELECT min(CAST(o_orderdate AS DATE)) AS lo, max(CAST(o_orderdate AS DATE)) AS hi FROM orders),
r(d) AS (SELECT lo FROM b UNION ALL SELECT CAST(d + INTERVAL 1 DAY AS DATE) FROM r, b WHERE d < b.hi)
SELECT {_CAL_SELECT} FROM r""")
def _calendar_recursive(spark, sf_dir):
    """The recursive date range, expressed with ``sequence``."""
    return calendar_fill(None, fixtures.table(spark, sf_dir, "orders"), "o_orderdate")


register("date_bounds", """
SELECT min(TRY_CAST(CAST(o_orderdate AS VARCHAR) AS DATE)) AS MinDate, max(TRY_CAST(CAST(o_orderdate AS VARCHAR) AS DATE)) AS MaxDate
FROM orders""")(lambda spark, sf_dir: date_bounds(
    fixtures.table(spark, sf_dir, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("date")), "o_orderdate"))

# ---------------------------------------------------------------------------
# Star source, fact merge, report
# ---------------------------------------------------------------------------


def _all_dims_sql() -> str:
    """Dimensions filled from an empty state (ids in name order)."""
    parts = []
    for _t, key, name, col, _ in NAME_DIMS:
        parts.append(f", d_{key} AS (SELECT CAST(row_number() OVER (ORDER BY n) AS INTEGER) AS {key}, n AS {name} "
                     f"FROM (SELECT DISTINCT {col} AS n FROM src WHERE {col} IS NOT NULL))")
    parts.append(""", d_TinhThanhID AS (SELECT CAST(row_number() OVER (ORDER BY TenTinhThanh, KhuVucID) AS INTEGER) AS TinhThanhID,
        TenTinhThanh, KhuVucID FROM (SELECT DISTINCT s.Tinh_Thanh AS TenTinhThanh, k.KhuVucID FROM src s
        LEFT JOIN d_KhuVucID k ON s.KhuVuc = k.TenKhuVuc WHERE s.Tinh_Thanh IS NOT NULL))
, prov AS (SELECT TenTinhThanh, min(TinhThanhID) AS TinhThanhID, arg_min(KhuVucID, TinhThanhID) AS KhuVucID
        FROM d_TinhThanhID GROUP BY TenTinhThanh)""")
    joins = " ".join(f"LEFT JOIN d_{key} ON src.{col} = d_{key}.{name}" for _t, key, name, col, _ in NAME_DIMS
                     if key != "KhuVucID")
    fks = ", ".join(f"CAST(coalesce({'prov' if c in ('TinhThanhID', 'KhuVucID') else 'd_' + c}.{c}, -1) AS INTEGER) AS {c}"
                    for c in FK_COLUMNS)
    parts.append(f""", source AS (SELECT src.JobHash, src.LinkBaiTuyenDung,
        CAST(strftime(TRY_CAST(CAST(src.NgayCaoDuLieu AS VARCHAR) AS DATE), '%Y%m%d') AS INTEGER) AS DateKey, {fks},
        CAST(coalesce(src.SoLuongTuyen_clean, 1) AS INTEGER) AS SoLuongTuyen, src.NgayCaoDuLieu
        FROM src {joins} LEFT JOIN prov ON src.Tinh_Thanh = prov.TenTinhThanh)""")
    return "\n".join(parts) + "\n"


_SRC_COLS = ("JobHash", "LinkBaiTuyenDung", "DateKey", *FK_COLUMNS, "SoLuongTuyen")


def _star_source_q(spark, sf_dir):
    src = _clean_src(spark, sf_dir)
    return star_source(src, fill_dims(src))


register("star_fact_build", _cv2_prefix() + _all_dims_sql() + f"SELECT {', '.join(_SRC_COLS)} FROM source")(
    _star_source_q)


def _fact_merge_sql(two_runs: bool) -> str:
    cols = ", ".join(_SRC_COLS)
    upd = ("DateKey", *FK_COLUMNS, "SoLuongTuyen")
    if not two_runs:
        return f"""
SELECT CAST(row_number() OVER (ORDER BY JobHash) AS BIGINT) AS FactID, JobHash, DateKey, {', '.join(FK_COLUMNS)},
       SoLuongTuyen, LinkBaiTuyenDung,
       TIMESTAMP '{AS_OF}' AS NgayTao, TIMESTAMP '{AS_OF}' AS NgayCapNhat, 'INSERT' AS MergeAction FROM source"""
    pick = ", ".join(f"CASE WHEN s.JobHash IS NOT NULL THEN s.{c} ELSE t.{c} END AS {c}" for c in upd)
    return f"""
, t AS (SELECT CAST(row_number() OVER (ORDER BY JobHash) AS BIGINT) AS FactID, {cols},
        TIMESTAMP '{AS_OF}' AS NgayTao, TIMESTAMP '{AS_OF}' AS NgayCapNhat
        FROM source WHERE NgayCaoDuLieu < DATE '{CUTOFF}')
, j AS (SELECT t.FactID, coalesce(s.JobHash, t.JobHash) AS JobHash, {pick},
        CASE WHEN t.JobHash IS NOT NULL THEN t.LinkBaiTuyenDung ELSE s.LinkBaiTuyenDung END AS LinkBaiTuyenDung,
        CASE WHEN t.JobHash IS NOT NULL THEN t.NgayTao ELSE TIMESTAMP '{AS_OF}' END AS NgayTao,
        CASE WHEN s.JobHash IS NOT NULL THEN TIMESTAMP '{AS_OF}' ELSE t.NgayCapNhat END AS NgayCapNhat,
        CASE WHEN s.JobHash IS NOT NULL AND t.JobHash IS NOT NULL THEN 'UPDATE' WHEN s.JobHash IS NOT NULL THEN 'INSERT' END AS MergeAction
        FROM t FULL OUTER JOIN source s ON t.JobHash = s.JobHash)
SELECT CASE WHEN MergeAction = 'INSERT' THEN CAST((SELECT max(FactID) FROM t)
            + row_number() OVER (PARTITION BY MergeAction = 'INSERT' ORDER BY JobHash) AS BIGINT) ELSE FactID END AS FactID,
       JobHash, DateKey, {', '.join(FK_COLUMNS)}, SoLuongTuyen, LinkBaiTuyenDung, NgayTao, NgayCapNhat, MergeAction FROM j"""


def _star_load_q(spark, sf_dir):
    _, fact = star_load(_clean_src_v2(spark, sf_dir))
    return fact


def _clean_src_v2(spark, sf_dir):
    from ..session import materialize
    return materialize(clean_v2(PW.raw_fact(spark, sf_dir)), "clean_v2")


def _star_upsert_q(spark, sf_dir):
    src = _clean_src(spark, sf_dir)
    dims = fill_dims(src)
    source = star_source(src.filter(F.col("NgayCaoDuLieu") < F.lit(CUTOFF)), dims)
    first = star_merge(empty_fact(spark), source).drop(ACTION)
    return star_merge(first, star_source(src, dims))


register("star_load", _cv2_prefix() + _all_dims_sql() + _fact_merge_sql(False))(_star_load_q)
register("star_fact_upsert", _cv2_prefix() + _all_dims_sql() + _fact_merge_sql(True))(_star_upsert_q)


@register("postings_report", _cv2_prefix() + _all_dims_sql() + """
, cal AS (SELECT DISTINCT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS DateKey, CAST(year(d) AS INTEGER) AS Nam,
          CAST(month(d) AS INTEGER) AS Thang FROM (SELECT TRY_CAST(CAST(NgayCaoDuLieu AS VARCHAR) AS DATE) AS d FROM src) WHERE d IS NOT NULL)
SELECT k.TenKhuVuc, cal.Nam, cal.Thang, c.TenCapBac, CAST(count(*) AS BIGINT) AS postings,
       CAST(sum(f.SoLuongTuyen) AS BIGINT) AS openings
FROM source f LEFT JOIN d_KhuVucID k ON f.KhuVucID = k.KhuVucID LEFT JOIN cal ON f.DateKey = cal.DateKey
LEFT JOIN d_CapBacID c ON f.CapBacID = c.CapBacID GROUP BY ALL""")
def _report(spark, sf_dir):
    dims, fact = star_load(_clean_src_v2(spark, sf_dir))
    return postings_report(fact, dims)


def latest_order_of_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.dedupe import latest_by_id
    orders = fixtures.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice", "o_orderpriority")
    return latest_by_id(orders, ["o_custkey"], "o_orderdate", "o_orderkey")


register("latest_by_id", """SELECT o_orderkey, o_custkey, o_orderdate, o_totalprice, o_orderpriority FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS LAST, o_orderkey DESC) = 1""")(latest_order_of_customer)
