"""One crawl run over the pages of the job sites -- listing cards -> job ids ->
frontier -> fields of the accepted pages -> run CSV a site -> history."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.html import JOB_ID_HTML, url_job_id
from ..functions.job_pages import extract_fields
from ..operators.frontier import crawl_frontier
from ..session import path_exists
from ..sources.files import RAW_CSV_COLUMNS, write_csv

# FIXED VALUES: the CSV column of each extracted field
CSV_OF = {"title": "CongViec", "location": "ViTri", "experience": "YeuCauKinhNghiem", "salary": "MucLuong", "work_time": "ThoiGianLamViec", "gender": "GioiTinh",
          "rank": "CapBac", "work_form": "HinhThucLamViec", "company": "CongTy", "company_link": "LinkCongTy", "size": "QuyMoCongTy", "headcount": "SoLuongTuyen",
          "education": "HocVan", "requirement": "YeuCauUngVien", "description": "MoTaCongViec", "benefits": "QuyenLoi", "deadline": "HanNopHoSo", "industry": "LinhVuc"}


def run_rows(front: DataFrame, job_pages: DataFrame, crawl_date: str) -> DataFrame:
    """The accepted cards with the fields of their pages, as the CSV has them; a
    card whose page is not there gives no row."""
    pages = job_pages.select("site", url_job_id(F.col("url"), JOB_ID_HTML).alias("job_id"), "html")
    rows = extract_fields(front.select("site", "job_id", "link", "rank").withColumnRenamed("rank", "_rank").join(pages, ["site", "job_id"]))
    named = rows.select("site", "job_id", F.col("_rank").alias("rank_in_run"), *[F.col(f).alias(c) for f, c in CSV_OF.items()],
                        F.col("link").alias("LinkBaiTuyenDung"), F.col("site").alias("Nguon"), F.lit(crawl_date).alias("NgayCaoDuLieu"))
    return named.select("site", "job_id", "rank_in_run", *RAW_CSV_COLUMNS)


def read_ids(spark: SparkSession, root: str, but_run: str | None = None) -> DataFrame:
    """(site, job_id) that runs accepted, without those of the run that is done again."""
    path = f"{root.rstrip('/')}/history"
    if not path_exists(spark, path):
        return spark.createDataFrame([], "site string, job_id string")
    ids = spark.read.schema("site string, job_id string, run string").parquet(path)
    return ids.where(F.col("run") != but_run).select("site", "job_id") if but_run else ids.select("site", "job_id")


def crawl_run(spark: SparkSession, listing: DataFrame, fetched: DataFrame | None, job_pages: DataFrame, root: str, run_id: str, crawl_date: str,
              cap: int | None = 100, max_empty: int | None = 5) -> DataFrame:
    """One run: its rows are written as header CSV to ``root/runs/run=<id>``, a
    folder a site, and the ids of the written rows then join the history under
    ``root/history/run=<id>``.  The same id again replaces its own CSV and
    history.  Returns the run's rows as the CSV has them."""
    root = root.rstrip("/")
    front = crawl_frontier(listing, read_ids(spark, root, run_id), cap, max_empty, key="job_id", pages=fetched)
    out, ids = f"{root}/runs/run={run_id}", f"{root}/history/run={run_id}"
    rows = run_rows(front, job_pages, crawl_date)
    (rows.write.mode("overwrite").option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False)
         .option("ignoreTrailingWhiteSpace", False).option("emptyValue", '""').option("nullValue", "\u0000").partitionBy("site").csv(out))
    schema = ", ".join(f"{c} string" for c in rows.columns if c != "site") + ", site string"
    back = spark.read.schema(schema).option("header", True).option("multiLine", True).option("escape", '"').option("nullValue", "\u0000").csv(out)
    back.select("site", "job_id").distinct().write.mode("overwrite").parquet(ids)
    return back.select(*rows.columns)
