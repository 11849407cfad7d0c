"""Source/sink workloads: CSV, JSON, text, tables, streams (S1-S19, P1,
P7, L4, A9, U2, U2b, W2)."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import fixtures
from .. import oracle as O
from ..fixtures import STAGING_COLUMNS
from ..operators.impute import impute_group_mean
from ..operators.upsert import merge
from ..plans.clean import trim_all_text
from ..registry import register
from ..session import AS_OF, scratch_path
from ..sources import files as S
from . import postings as PW
from .warehouse import CUTOFF


def _tmp(spark, name: str) -> str:
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex[:10]}")


_STG_TEXT = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in (*STAGING_COLUMNS, "row_id"))


@register("scan_csv_postings", fixtures.duck_prefix("stg") + f"SELECT {_STG_TEXT} FROM stg")
def _scan_csv(spark, sf_dir):
    """Stg written as header CSV, read back with an all-text schema."""
    path = _tmp(spark, "csv-postings")
    S.write_csv(fixtures.stg(spark, sf_dir), path)
    return S.read_csv(spark, path, columns=(*STAGING_COLUMNS, "row_id"))


@register("append_table", "SELECT * FROM events")
def _append_table(spark, sf_dir):
    """Append the events, then an empty batch (a no-op)."""
    path = _tmp(spark, "append")
    ev = fixtures.table(spark, sf_dir, "events")
    S.append_table(ev, path)
    S.append_table(ev.limit(0), path)
    return spark.read.parquet(path)


_A_COLS = [c for c in STAGING_COLUMNS if c != "LinhVuc"]


@register("dual_sink_union_project", fixtures.duck_prefix("stg") + f"""
SELECT {', '.join(f'CAST({c} AS VARCHAR) AS {c}' for c in _A_COLS)}, NULL::VARCHAR AS LinhVuc
FROM stg WHERE NgayCaoDuLieu < DATE '{CUTOFF}'
UNION ALL
SELECT {', '.join(f'CAST({c} AS VARCHAR) AS {c}' for c in STAGING_COLUMNS)} FROM stg WHERE NgayCaoDuLieu >= DATE '{CUTOFF}'""")
def _dual_sink(spark, sf_dir):
    """Two drops with different columns -> backup (full rows) + staging
    (union by name, projected to the staging columns)."""
    stg = fixtures.stg(spark, sf_dir)
    a = stg.filter(F.col("NgayCaoDuLieu") < F.lit(CUTOFF)).select(*_A_COLS, "row_id",
                                                                  F.lit("Toàn thời gian").alias("ThoiGianLamViec"))
    b = stg.filter(F.col("NgayCaoDuLieu") >= F.lit(CUTOFF)).select(*STAGING_COLUMNS, F.lit("x").alias("LinkCongTy"))
    root = _tmp(spark, "drops")
    files = [f"{root}/a", f"{root}/b"]
    S.write_csv(a, files[0])
    S.write_csv(b, files[1])
    return S.dual_sink(spark, files, f"{root}/backup", f"{root}/staging")


register("daily_slice", fixtures.duck_prefix("stg") + "SELECT * FROM stg WHERE NgayCaoDuLieu = DATE '1998-06-01'")(
    lambda spark, sf_dir: fixtures.stg(spark, sf_dir).filter(F.col("NgayCaoDuLieu") == F.lit("1998-06-01").cast("date")))


@register("replicate_full", "SELECT * FROM supplier")
def _replicate(spark, sf_dir):
    """Full replica (overwrite) with its row count from ``observe``."""
    path = _tmp(spark, "replica")
    n = S.replicate_full(spark, fixtures.table(spark, sf_dir, "supplier"), path)
    out = spark.read.parquet(path)
    assert n == out.count()
    return out


def _run_csv_sql() -> str:
    from .crawl import _frontier_sql
    return _frontier_sql(100, 5).replace("SELECT * FROM k WHERE", "SELECT site, CAST(page AS VARCHAR) AS page, CAST(pos AS VARCHAR) AS pos, link, CAST(rank AS VARCHAR) AS rank FROM k WHERE")


@register("write_run_csv", _run_csv_sql())
def _write_run_csv(spark, sf_dir):
    """The frontier written as this run's CSV and read back as text."""
    from ..operators.frontier import crawl_frontier
    front = crawl_frontier(fixtures.listing(spark, sf_dir), fixtures.seen(spark, sf_dir), cap=100, max_empty=5)
    path = S.write_run_csv(front, _tmp(spark, "runs"), "site")
    return S.read_csv(spark, path)


register("json_import_typed", """
SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k, CAST(json_extract(props, '$.missing') AS VARCHAR) AS missing
FROM events""")(
    lambda spark, sf_dir: fixtures.table(spark, sf_dir, "events").select(
        "event_id", F.from_json("props", "k INT, missing STRING").alias("j")).select("event_id", "j.k", "j.missing"))

# ---------------------------------------------------------------------------
# Clean fact exported as JSON lines, imported with a typed schema,
# non-blank titles only, MERGE by JobHash
# ---------------------------------------------------------------------------

_DEC2, _DEC1, _DEC0 = T.DecimalType(18, 2), T.DecimalType(4, 1), T.DecimalType(18, 0)
JSON_FIELDS = (
    ("JobHash", T.StringType()), ("LinkBaiTuyenDung", T.StringType()), ("CongTy", T.StringType()),
    ("CongTy_clean", T.StringType()), ("CongViec", T.StringType()), ("CongViec_clean", T.StringType()),
    ("CapBac", T.StringType()), ("CapBac_clean", T.StringType()), ("ViTri", T.StringType()),
    ("ViTri_clean", T.StringType()), ("Tinh_Thanh", T.StringType()), ("KhuVuc", T.StringType()),
    ("Latitude", T.DoubleType()), ("Longitude", T.DoubleType()), ("MucLuong", T.StringType()),
    ("MucLuongMin_clean", _DEC2), ("MucLuongMax_clean", _DEC2), ("MucLuongTB_clean", _DEC2),
    ("KhoangLuong", T.StringType()), ("MoTaCongViec", T.StringType()), ("YeuCauUngVien", T.StringType()),
    ("YeuCauKinhNghiem", T.StringType()), ("YeuCauKinhNghiemMin_clean", _DEC1),
    ("YeuCauKinhNghiemMax_clean", _DEC1), ("YeuCauKinhNghiemTB_clean", _DEC1), ("PhanLoaiKinhNghiem", T.StringType()),
    ("HardSkills", T.StringType()), ("SoftSkills", T.StringType()), ("LinhVuc", T.StringType()),
    ("LinhVuc_clean", T.StringType()), ("HocVan", T.StringType()), ("HocVan_clean", T.StringType()),
    ("HinhThucLamViec", T.StringType()), ("HinhThucLamViec_clean", T.StringType()),
    ("KieuLamViec_clean", T.StringType()), ("SoLuongTuyen", T.StringType()), ("SoLuongTuyen_clean", T.IntegerType()),
    ("QuyMoCongTy", T.StringType()), ("QuyMoCongTyMin_clean", _DEC0), ("QuyMoCongTyMax_clean", _DEC0),
    ("QuyMoCongTyTB_clean", _DEC0), ("PhanLoaiQuyMoCongTy", T.StringType()), ("HanNopHoSo", T.StringType()),
    ("HanNopHoSo_clean", T.StringType()), ("Nguon", T.StringType()), ("NgayCaoDuLieu", T.StringType()),
    ("NgayXuLyDL", T.StringType()))
_DATES = ("HanNopHoSo", "HanNopHoSo_clean", "NgayCaoDuLieu")
# export names of the clean v2 columns (everything else keeps its name)
_V2_EXPORT = {"YeuCauKinhNghiemMin_clean": "Exp_Min_clean", "YeuCauKinhNghiemMax_clean": "Exp_Max_clean",
              "HardSkills": "Hard_Skills", "SoftSkills": "Soft_Skills", "LinhVuc_clean": "LinhVuc_Web",
              "HinhThucLamViec_clean": "HinhThuc_clean", "KieuLamViec_clean": "WorkMode_clean",
              "QuyMoCongTyMin_clean": "QuyMoMin_clean", "QuyMoCongTyMax_clean": "QuyMoMax_clean",
              "QuyMoCongTyTB_clean": "QuyMoTB_clean", "PhanLoaiQuyMoCongTy": "LoaiQuyMo_clean"}
KEYMAP_VARIANT = {"HardSkills": "YeuCauKiNangCung_clean", "SoftSkills": "YeuCauKiNangMem_clean"}


def json_schema(keymap: dict[str, str] | None = None) -> T.StructType:
    keymap = keymap or {}
    return T.StructType([T.StructField(keymap.get(n, n), t) for n, t in JSON_FIELDS])


def export_json_lines(clean, path: str, keymap: dict[str, str] | None = None) -> None:
    """The clean fact as one JSON object per line (distributed write)."""
    clean.select(*_export_columns(clean, keymap)).write.mode("overwrite").json(path)


def _export_columns(clean, keymap: dict[str, str] | None = None) -> list:
    from ..functions.text import null_skip_mean
    keymap = keymap or {}
    cols = []
    for n, _ in JSON_FIELDS:
        if n == "YeuCauKinhNghiemTB_clean":
            c = null_skip_mean(F.col("Exp_Min_clean"), F.col("Exp_Max_clean"))
        elif n == "ViTri_clean":
            continue  # v2 does not keep the cleaned location text: the key is absent
        else:
            c = F.col(_V2_EXPORT.get(n, n))
        cols.append(c.alias(keymap.get(n, n)))
    return cols


def import_json(spark, path: str, keymap: dict[str, str] | None = None):
    """Typed read, non-blank titles, text dates converted safely."""
    keymap = keymap or {}
    df = spark.read.schema(json_schema(keymap)).json(path)
    df = df.withColumnsRenamed({v: k for k, v in keymap.items()})
    df = df.filter(F.col("CongViec").isNotNull() & (F.trim(F.col("CongViec")) != ""))
    return df.select(*[F.col(c).try_cast("date").alias(c) if c in _DATES else F.col(c) for c in df.columns])


def upsert_clean_by_hash(target, source, as_of: str = AS_OF):
    """MERGE by JobHash; every column refreshed, NgayXuLyDL = now."""
    now = F.lit(as_of).cast("timestamp_ntz")
    cols = {c: c for c in source.columns if c != "NgayXuLyDL"}
    upd = {c: e for c, e in cols.items() if c != "JobHash"}
    upd["NgayXuLyDL"] = now
    ins = dict(cols)
    ins["NgayXuLyDL"] = now
    return merge(target, source, ["JobHash"], update=upd, insert=ins)


def _clean_import(spark, sf_dir, keymap=None):
    clean = PW.clean_v2(PW.raw_fact(spark, sf_dir))
    path = _tmp(spark, "json")
    export_json_lines(clean, path, keymap)
    src = import_json(spark, path, keymap)
    src = src.withColumn("NgayXuLyDL", F.lit(None).cast("timestamp_ntz"))
    target = upsert_clean_by_hash(src.limit(0), src.filter(F.col("NgayCaoDuLieu") < F.lit(CUTOFF))).drop("MergeAction")
    return upsert_clean_by_hash(target, src)


def _clean_import_sql() -> str:
    cast = {_DEC2: "DECIMAL(18,2)", _DEC1: "DECIMAL(4,1)", _DEC0: "DECIMAL(18,0)", T.DoubleType(): "DOUBLE",
            T.IntegerType(): "INTEGER"}
    sel = []
    for n, t in JSON_FIELDS:
        if n == "NgayXuLyDL":
            continue
        if n == "YeuCauKinhNghiemTB_clean":
            e = O.null_skip_mean("Exp_Min_clean", "Exp_Max_clean")
        elif n == "ViTri_clean":
            e = "NULL"
        else:
            e = _V2_EXPORT.get(n, n)
        if n in _DATES:
            sel.append(f"TRY_CAST(CAST({e} AS VARCHAR) AS DATE) AS {n}")
        elif t in cast:
            sel.append(f"CAST({e} AS {cast[t]}) AS {n}")
        else:
            sel.append(f"CAST({e} AS VARCHAR) AS {n}")
    names = [n for n, _ in JSON_FIELDS if n != "NgayXuLyDL"]
    pick = ", ".join(f"CASE WHEN s.JobHash IS NOT NULL THEN s.{c} ELSE t.{c} END AS {c}" for c in names)
    return (f"WITH cv2 AS ({PW._clean_v2_sql()}), src AS (SELECT {', '.join(sel)} FROM cv2 "
            f"WHERE CongViec IS NOT NULL AND trim(CongViec) <> '')"
            f", t AS (SELECT * FROM src WHERE NgayCaoDuLieu < DATE '{CUTOFF}')\n"
            f"SELECT {pick}, TIMESTAMP '{AS_OF}' AS NgayXuLyDL, "
            f"CASE WHEN s.JobHash IS NOT NULL AND t.JobHash IS NOT NULL THEN 'UPDATE' WHEN s.JobHash IS NOT NULL "
            f"THEN 'INSERT' END AS MergeAction FROM t FULL OUTER JOIN src s ON t.JobHash = s.JobHash")


def _documents(spark, sf_dir):
    """The clean fact as JSON array documents, one a source and crawl day, in
    which the numbers of some rows are texts that are none."""
    clean = PW.clean_v2(PW.raw_fact(spark, sf_dir))
    fields = _export_columns(clean)
    rows = clean.select("Nguon", "NgayCaoDuLieu", F.to_json(F.struct(*fields)).alias("one"))
    docs = rows.groupBy("Nguon", "NgayCaoDuLieu").agg(F.concat(F.lit("["), F.array_join(F.collect_list("one"), ",\n"), F.lit("]")).alias("content"))
    return docs.select(F.concat_ws("/", "Nguon", F.col("NgayCaoDuLieu").cast("string")).alias("doc"), "content")


@register("json_document_import", _clean_import_sql().split(", t AS (SELECT * FROM src")[0] + "\nSELECT * FROM src")
def _json_document_import(spark, sf_dir):
    """JSON array documents with all 47 fields; rows with a title, text dates converted."""
    rows, _ = S.import_documents(_documents(spark, sf_dir), "doc", "content", json_schema())
    rows = rows.filter(F.trim(F.col("CongViec")) != "").drop("doc", "pos", "NgayXuLyDL")
    return rows.select(*[F.col(c).try_cast("date").alias(c) if c in _DATES else F.col(c) for c in rows.columns])


@register("json_document_rejects", """
WITH e AS (SELECT event_id, CASE WHEN event_id % 5 = 0 THEN 'x' || event_id ELSE CAST(event_id AS VARCHAR) END AS n, CASE WHEN event_id % 7 = 0 THEN 'soon' ELSE '2025-01-01' END AS d FROM events)
SELECT 'd' || CAST(event_id // 50 AS VARCHAR) AS doc, CAST(event_id % 50 AS INTEGER) AS pos, field, value FROM (
  SELECT event_id, 'n' AS field, n AS value FROM e WHERE event_id % 5 = 0 UNION ALL SELECT event_id, 'd', d FROM e WHERE event_id % 7 = 0)
UNION ALL SELECT 'd' || CAST(event_id // 50 AS VARCHAR) || '-cut', NULL, NULL, '[{"n": ' || CAST(event_id AS VARCHAR) FROM events WHERE event_id % 50 = 0""")
def _json_document_rejects(spark, sf_dir):
    """What did not convert, by document and place, and documents that are no JSON."""
    e = fixtures.table(spark, sf_dir, "events")
    name = F.concat(F.lit("d"), F.floor(F.col("event_id") / 50).cast("string"))
    one = F.to_json(F.struct(F.when(F.col("event_id") % 5 == 0, F.concat(F.lit("x"), F.col("event_id").cast("string"))).otherwise(F.col("event_id").cast("string")).alias("n"),
                             F.when(F.col("event_id") % 7 == 0, "soon").otherwise("2025-01-01").alias("d")))
    docs = e.groupBy(name.alias("doc")).agg(F.array_sort(F.collect_list(F.struct("event_id", one.alias("one")))).alias("all"))
    docs = docs.select("doc", F.concat(F.lit("["), F.array_join(F.transform("all", lambda x: x["one"]), ","), F.lit("]")).alias("content"))
    cut = e.where("event_id % 50 = 0").select(F.concat(name, F.lit("-cut")).alias("doc"), F.concat(F.lit('[{"n": '), F.col("event_id").cast("string")).alias("content"))
    return S.import_documents(docs.unionByName(cut), "doc", "content", T.StructType([T.StructField("n", T.LongType()), T.StructField("d", T.DateType())]))[1]


register("upsert_clean_by_hash", _clean_import_sql())(lambda spark, sf_dir: _clean_import(spark, sf_dir))
register("upsert_clean_keymap", _clean_import_sql())(
    lambda spark, sf_dir: _clean_import(spark, sf_dir, KEYMAP_VARIANT))

# ---------------------------------------------------------------------------
# S16 API payload, S19 page watermark, P1, P7, L4, A9, W2
# ---------------------------------------------------------------------------


def _api_payload(spark, sf_dir):
    """Payload objects built from pages (the API's field names)."""
    from ..functions.html import tag_text
    p = fixtures.table(spark, sf_dir, "pages")
    words = F.split(F.regexp_replace(tag_text(F.col("html"), "title"), r"[^\p{L} ]", ""), " ")
    obj = F.struct(
        F.when(F.col("page_id") % 10 != 0, F.col("page_id")).alias("jobId"),
        tag_text(F.col("html"), "title").alias("jobTitle"),
        F.when(F.col("page_id") % 4 != 0, F.regexp_extract("url", r"//([^/]+)", 1)).alias("companyName"),
        F.col("url").alias("jobUrl"),
        F.transform(words, lambda w: F.struct(w.alias("skillName"))).alias("skills"),
        F.array(F.struct(F.regexp_extract("url", r"/(\w\w)/", 1).alias("locationNameVI"))).alias("locations"),
        tag_text(F.col("html"), "article").alias("jobDescription"))
    return p.select(F.to_json(obj).alias("payload"))


def _api_sql() -> str:
    from .crawl import _html_to_text_sql
    title = r"regexp_extract(html, '(?is)<title\b[^>]*>(.*?)</title>', 1)"
    article = _html_to_text_sql(r"regexp_extract(html, '(?is)<article\b[^>]*>(.*?)</article>', 1)")
    return rf"""
SELECT page_id AS jobId, {title} AS CongViec, CASE WHEN page_id % 4 <> 0 THEN regexp_extract(url, '//([^/]+)', 1) ELSE 'N/A' END AS CongTy, 'N/A' AS MucLuong, url AS LinkBaiTuyenDung,
       array_to_string(string_split(regexp_replace({title}, '[^\p{{L}} ]', '', 'g'), ' '), ', ') AS KyNang, regexp_extract(url, '/(\w\w)/', 1) AS ViTri,
       coalesce({article}, '') AS MoTaCongViec, '' AS YeuCauUngVien
FROM pages WHERE page_id % 10 <> 0"""


@register("api_payload_flatten", _api_sql())
def _api_flatten(spark, sf_dir):
    """Nested payload -> flat posting columns."""
    return S.api_flatten(_api_payload(spark, sf_dir))


register("page_watermark_advance", r"""
SELECT page_id, regexp_extract(url, 'page=([^&#]*)', 1) AS stored,
       CAST(coalesce(TRY_CAST(regexp_extract(url, 'page=([^&#]*)', 1) AS INTEGER), 1) + 5 AS INTEGER) AS next_page
FROM pages""")(
    lambda spark, sf_dir: S.page_watermark(fixtures.table(spark, sf_dir, "pages").select(
        "page_id", F.regexp_extract("url", r"page=([^&#]*)", 1).alias("stored")), "stored", 1, 5))

_WANTED = ("CongViec", "ChuyenMon", "ViTri", "MucLuong", "GioiTinh", "LinkBaiTuyenDung", "NgayCaoDuLieu", "LinhVuc")
register("project_existing", fixtures.duck_prefix("stg") +
         "SELECT CongViec, ViTri, MucLuong, LinkBaiTuyenDung, NgayCaoDuLieu, LinhVuc FROM stg")(
    lambda spark, sf_dir: S.project_existing(fixtures.stg(spark, sf_dir), _WANTED))


def _trim_sql() -> str:
    cols = [f"{O.strip(c)} AS {c}" if c not in ("NgayCaoDuLieu", "row_id") else c
            for c in (*STAGING_COLUMNS, "row_id")]
    return fixtures.duck_prefix("stg") + f"SELECT {', '.join(cols)} FROM stg"


register("trim_all_text", _trim_sql())(lambda spark, sf_dir: trim_all_text(fixtures.stg(spark, sf_dir)))

register("union_by_name", """
SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag, NULL::DOUBLE AS l_extendedprice FROM lineitem WHERE l_shipdate < DATE '1998-01-01'
UNION ALL
SELECT l_orderkey, l_linenumber, NULL::DOUBLE AS l_quantity, l_returnflag, l_extendedprice FROM lineitem WHERE l_shipdate >= DATE '1998-01-01'""")(
    lambda spark, sf_dir: S.union_by_name([
        fixtures.table(spark, sf_dir, "lineitem").filter("l_shipdate < DATE'1998-01-01'")
        .select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag"),
        fixtures.table(spark, sf_dir, "lineitem").filter("l_shipdate >= DATE'1998-01-01'")
        .select("l_orderkey", "l_linenumber", "l_returnflag", "l_extendedprice")]))


@register("rows_per_file", fixtures.duck_prefix("stg") +
          "SELECT Nguon, CAST(count(*) AS BIGINT) AS rows_in FROM stg GROUP BY Nguon")
def _rows_per_file(spark, sf_dir):
    """One CSV drop per source site; row count per input file."""
    root = _tmp(spark, "per-source")
    fixtures.stg(spark, sf_dir).write.partitionBy("Nguon").option("header", True).csv(root)
    df = S.read_csv(spark, f"{root}/*/*.csv").withColumn("_file", F.input_file_name())
    per_file = df.groupBy("_file").count()
    nguon = F.regexp_extract(F.expr("url_decode(_file)"), r"Nguon=([^/]+)/", 1)
    return per_file.groupBy(nguon.alias("Nguon")).agg(F.sum("count").cast("bigint").alias("rows_in"))


@register("salary_impute", fixtures.duck_prefix("stg") + f"""
, a AS (SELECT row_id, {O.title_class_v1('CongViec')} AS k1, {O.rank_v1('CongViec')} AS k2, {O.salary_v1('MucLuong')} AS s FROM stg)
, b AS (SELECT *, CASE WHEN s.min = 0 THEN NULL ELSE s.min END AS lo, CASE WHEN s.max = 0 THEN NULL ELSE s.max END AS hi FROM a)
, m AS (SELECT k1, k2, round(avg(lo), 6) AS mlo, round(avg(hi), 6) AS mhi FROM b GROUP BY ALL)
SELECT row_id, k1 AS CongViec_clean, k2 AS CapBac_clean, coalesce(lo, mlo, 0.0) AS MucLuongMin_clean,
       coalesce(hi, mhi, 0.0) AS MucLuongMax_clean FROM b LEFT JOIN m USING (k1, k2)""")
def _salary_impute(spark, sf_dir):
    """Zero salary ends filled with the (title class, rank) mean."""
    from ..functions import classify as C
    from ..functions import parsers as P
    s = fixtures.stg(spark, sf_dir).select("row_id", "MucLuong", C.title_class_v1(F.col("CongViec")).alias("CongViec_clean"),
                                           C.rank_v1(F.col("CongViec")).alias("CapBac_clean"))
    s = P.parse_salary_v1(s, "MucLuong", "_s")
    s = s.select("row_id", "CongViec_clean", "CapBac_clean", F.col("_s.min").alias("MucLuongMin_clean"),
                 F.col("_s.max").alias("MucLuongMax_clean"))
    return impute_group_mean(s, ["MucLuongMin_clean", "MucLuongMax_clean"], ["CongViec_clean", "CapBac_clean"],
                             bounded_groups=True)


@register("price_impute", """
WITH p AS (SELECT p_partkey, p_brand, p_type, CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE p_retailprice END AS price FROM part),
m AS (SELECT p_brand, p_type, round(avg(price), 6) AS mp FROM p GROUP BY ALL)
SELECT p_partkey, p_brand, p_type, coalesce(price, mp, 0.0) AS price FROM p LEFT JOIN m USING (p_brand, p_type)""")
def _price_impute(spark, sf_dir):
    """W2 on part: every 7th price missing, filled with the (brand, type)
    mean; the group table is not bounded, so AQE chooses the join."""
    p = fixtures.table(spark, sf_dir, "part").select(
        "p_partkey", "p_brand", "p_type",
        F.when(F.col("p_partkey") % 7 == 0, F.lit(None)).otherwise(F.col("p_retailprice")).alias("price"))
    return impute_group_mean(p, ["price"], ["p_brand", "p_type"], zero_is_missing=False)


# ---------------------------------------------------------------------------
# Streaming: S4 incremental CSV ingest, keyed-latest over an event stream
# ---------------------------------------------------------------------------


@register("incremental_csv_ingest", fixtures.duck_prefix("stg") + f"SELECT {_STG_TEXT}, CASE WHEN NgayCaoDuLieu < DATE '{CUTOFF}' THEN 0 ELSE 1 END AS _batch_id FROM stg")
def _incremental_ingest(spark, sf_dir):
    """Two runs over a drop folder; the second run only
    picks up the file dropped after the first; processed files archived."""
    from ..streaming.ingest import append_batches, csv_drop_stream, run_available
    root = _tmp(spark, "ingest")
    drop, arch, ck, out = (f"{root}/drop", f"{root}/archive", f"{root}/ckpt", f"{root}/out")
    stg = fixtures.stg(spark, sf_dir)
    cols = (*STAGING_COLUMNS, "row_id")
    S.write_csv(stg.filter(F.col("NgayCaoDuLieu") < F.lit(CUTOFF)), f"{drop}/day1")
    run_available(csv_drop_stream(spark, f"{drop}/*", cols, arch), ck, append_batches(out))
    S.write_csv(stg.filter(F.col("NgayCaoDuLieu") >= F.lit(CUTOFF)), f"{drop}/day2")
    run_available(csv_drop_stream(spark, f"{drop}/*", cols, arch), ck, append_batches(out))
    return spark.read.parquet(out).drop("_source_file")


@register("stream_upsert_events", """
SELECT user_id, event_id, ts, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""")
def _stream_upsert_events(spark, sf_dir):
    """Events as a file stream, merged batch by batch into a bucketed table
    that holds the newest event of each user; then the same batches once more,
    which change nothing."""
    from ..operators.tables import BucketedTable
    from ..streaming.ingest import merge_batches, run_available
    root = _tmp(spark, "events-stream")
    ev = fixtures.table(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type", "value")
    ev.repartition(4, "event_id").write.parquet(f"{root}/drop")
    table = BucketedTable(spark, f"{root}/table", ["user_id"], 8, ev.schema)
    for run in ("first", "replay"):
        stream = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/drop")
        run_available(stream, f"{root}/ckpt-{run}", merge_batches(table, ["ts", "event_id"], "events"))
    return table.read()


_DAYS = (None, CUTOFF, "1998-05-01")  # three drops by crawl date


def _drops(spark, sf_dir, root: str) -> list[str]:
    """stg as three daily CSV drops; the second brings one of three links of the first again."""
    stg = fixtures.stg(spark, sf_dir)
    date, again = F.col("NgayCaoDuLieu"), F.col("row_id") % 9 == 0
    parts = [date < F.lit(_DAYS[1]), ((date >= F.lit(_DAYS[1])) & (date < F.lit(_DAYS[2]))) | ((date < F.lit(_DAYS[1])) & again), date >= F.lit(_DAYS[2])]
    paths = [f"{root}/drop/day{k}" for k in range(len(parts))]
    for path, part in zip(paths, parts, strict=True):
        S.write_csv(stg.filter(part).select(*STAGING_COLUMNS), path)
    return paths


def _daily(spark, sf_dir):
    from ..plans.daily import daily_run
    root = _tmp(spark, "daily")
    for k, path in enumerate(_drops(spark, sf_dir, root)):
        w = daily_run(spark, [path], f"{root}/run", as_of=f"2025-01-0{k + 1} 00:00:00", drop_id=f"day{k}", buckets=4)
    return w


def _days_sql() -> str:
    """Raw fact and clean fact after three drops, each merged into the one before."""
    cond = [f"NgayCaoDuLieu < DATE '{_DAYS[1]}'", f"(NgayCaoDuLieu >= DATE '{_DAYS[1]}' AND NgayCaoDuLieu < DATE '{_DAYS[2]}') OR (NgayCaoDuLieu < DATE '{_DAYS[1]}' AND row_id % 9 = 0)",
            f"NgayCaoDuLieu >= DATE '{_DAYS[2]}'"]
    parts = [f"SELECT *, {k} AS day FROM stg WHERE {c}" for k, c in enumerate(cond)]
    return fixtures.duck_prefix("stg") + f", drops AS ({' UNION ALL '.join(parts)})\n"


@register("daily_run", _days_sql() + f"""
, newest AS (SELECT LinkBaiTuyenDung, day, max(NgayCaoDuLieu) AS NgayCaoDuLieu, count(*) AS n FROM drops GROUP BY 1, 2)
, raw AS (SELECT LinkBaiTuyenDung, max(day) AS day FROM newest WHERE LinkBaiTuyenDung IS NOT NULL GROUP BY 1)
SELECT d.stage, d.drop_id, d.rows_in, d.inserted, d.updated FROM (
  SELECT 'load' AS stage, 'day' || day AS drop_id, count(*) AS rows_in, NULL::BIGINT AS inserted, NULL::BIGINT AS updated FROM drops GROUP BY day
  UNION ALL
  SELECT 'raw', 'day' || day, CAST(sum(n) AS BIGINT),
    count(*) FILTER (WHERE LinkBaiTuyenDung IS NULL OR NOT EXISTS (SELECT 1 FROM newest o WHERE o.LinkBaiTuyenDung = w.LinkBaiTuyenDung AND o.day < w.day)),
    count(*) FILTER (WHERE EXISTS (SELECT 1 FROM newest o WHERE o.LinkBaiTuyenDung = w.LinkBaiTuyenDung AND o.day < w.day))
  FROM newest w GROUP BY day) d""")
def _daily_run(spark, sf_dir):
    """Three daily drops; what each loaded and merged into the raw fact."""
    return _daily(spark, sf_dir).ledger().where("stage IN ('load', 'raw') AND Status = 'Success'").select("stage", "drop_id", "rows_in", "inserted", "updated")


@register("daily_run_raw_fact", _days_sql() + f"""
, latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY LinkBaiTuyenDung, CASE WHEN LinkBaiTuyenDung IS NULL THEN day END ORDER BY day DESC, NgayCaoDuLieu DESC) AS rn FROM drops) WHERE rn = 1)
SELECT LinkBaiTuyenDung, NgayCaoDuLieu, CAST(TIMESTAMP '2025-01-01 00:00:00' + day * INTERVAL 1 DAY AS TIMESTAMP) AS NgayThemVaoHeThong FROM latest WHERE LinkBaiTuyenDung IS NOT NULL""")
def _daily_run_raw(spark, sf_dir):
    """The raw fact after three drops: each link as its last drop's newest row has it."""
    raw = _daily(spark, sf_dir).raw.read()
    return raw.where("LinkBaiTuyenDung IS NOT NULL").select("LinkBaiTuyenDung", "NgayCaoDuLieu", "NgayThemVaoHeThong")


@register("daily_run_star")
def _daily_run_star(spark, sf_dir):
    """X8 (rows-only; ties of a link's newest row are broken by a hash): the star after three drops."""
    return _daily(spark, sf_dir).star.read()
