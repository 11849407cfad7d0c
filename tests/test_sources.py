"""Sources and sinks: BOM/multi-line CSV, empty and unreadable files,
history files, staging job with versioned tables (S1-S4, S12-S14, S17, S18)."""

import os
import tempfile

from pyspark.sql import functions as F

from jobsift.sources import files as S


def test_csv_bom_multiline_and_missing_columns(spark):
    d = tempfile.mkdtemp(prefix="jobsift-csv-")
    with open(os.path.join(d, "a.csv"), "w", encoding="utf-8-sig") as f:
        f.write('CongViec,ViTri\n"Dev\nSenior","Hà Nội"\n')
    with open(os.path.join(d, "empty.csv"), "w", encoding="utf-8") as f:
        f.write("")
    df = S.read_csv(spark, d, columns=("CongViec", "ViTri", "MucLuong"))
    rows = df.collect()
    assert len(rows) == 1
    assert rows[0]["CongViec"] == "Dev\nSenior" and rows[0]["ViTri"] == "Hà Nội" and rows[0]["MucLuong"] is None


def test_history_roundtrip(spark):
    d = tempfile.mkdtemp(prefix="jobsift-hist-")
    ids = spark.createDataFrame([(" 12 ",), ("",), ("12",), ("7",)], "v string")
    S.write_history(ids, d)
    got = sorted(r["id"] for r in S.read_history(spark, d).collect())
    assert got == ["12", "7"]


def test_run_csv_skipped_when_empty(spark):
    d = tempfile.mkdtemp(prefix="jobsift-run-")
    empty = spark.createDataFrame([], "a string")
    assert S.write_run_csv(empty, d, "TopCV") is None
    path = S.write_run_csv(spark.createDataFrame([("x",)], "a string"), d, "TopCV")
    assert os.path.basename(path).startswith("TopCV_jobs_")


def test_staging_job_versions_log_and_truncate(spark, sf):
    from jobsift import fixtures
    from jobsift.plans.staging import staging_merge_job
    root = tempfile.mkdtemp(prefix="jobsift-job-")
    stg_path = os.path.join(root, "stg")
    fixtures.stg(spark, sf).write.parquet(stg_path)
    log = staging_merge_job(spark, stg_path, os.path.join(root, "fact"), os.path.join(root, "log"),
                            as_of="2025-01-01 00:00:00").first()
    assert log["Status"] == "Success" and log["NewJobsInserted"] > 0 and log["OldJobsUpdated"] == 0
    assert spark.read.parquet(stg_path).count() == 0
    assert os.path.exists(os.path.join(root, "fact", "v=1", "_SUCCESS"))


def test_schemas_create_if_missing(spark):
    from jobsift import schemas
    d = os.path.join(tempfile.mkdtemp(prefix="jobsift-sch-"), "Dim_CongTy")
    df = schemas.create_if_missing(spark, d, schemas.DIMENSIONS["Dim_CongTy"])
    assert df.count() == 0 and df.columns == ["CongTyID", "TenCongTy"]
    assert len(schemas.RAW_CSV_22.fields) == 22 and len(schemas.STAGING.fields) == 18


def test_bucketed_staging_job(spark, sf):
    from jobsift import fixtures
    from jobsift.plans.staging import bucketed_staging_merge_job
    root = tempfile.mkdtemp(prefix="jobsift-bjob-")
    stg_path = os.path.join(root, "stg")
    fixtures.stg(spark, sf).write.parquet(stg_path)
    log = bucketed_staging_merge_job(spark, stg_path, os.path.join(root, "fact"), os.path.join(root, "log"),
                                     buckets=8, as_of="2025-01-01 00:00:00").first()
    assert log["Status"] == "Success" and log["NewJobsInserted"] > 0
    assert spark.read.parquet(os.path.join(root, "fact")).count() == log["NewJobsInserted"]


def test_star_load_job_bucketed(spark, sf):
    from jobsift.plans.clean import clean_v2
    from jobsift.plans.star import read_dims, star_load_job
    from jobsift.workloads.postings import raw_fact
    root = tempfile.mkdtemp(prefix="jobsift-star-")
    clean_path = os.path.join(root, "clean")
    clean_v2(raw_fact(spark, sf)).write.parquet(clean_path)
    n = spark.read.parquet(clean_path).count()
    c1 = star_load_job(spark, clean_path, os.path.join(root, "dw"), buckets=8)
    assert c1 == {"inserted": n, "updated": 0}
    c2 = star_load_job(spark, clean_path, os.path.join(root, "dw"), buckets=8)
    assert c2 == {"inserted": 0, "updated": n}
    fact = spark.read.parquet(os.path.join(root, "dw", "fact"))
    ids = sorted(r[0] for r in fact.select("FactID").collect())
    assert ids == list(range(1, n + 1))
    dim = read_dims(spark, os.path.join(root, "dw"))["Dim_CongTy"]
    assert dim.count() == dim.select("TenCongTy").distinct().count()


def test_stream_ingest_exactly_once_and_archive(spark):
    from jobsift.streaming.ingest import append_batches, csv_drop_stream, run_available
    root = tempfile.mkdtemp(prefix="jobsift-stream-")
    drop, arch, ck, out = (os.path.join(root, x) for x in ("drop", "archive", "ckpt", "out"))
    os.makedirs(drop)
    for name, rows in (("day1.csv", 3), ("day2.csv", 2)):
        if name == "day2.csv":
            run_available(csv_drop_stream(spark, drop, ("CongViec",), arch), ck, append_batches(out))
        with open(os.path.join(drop, name), "w", encoding="utf-8-sig") as f:
            f.write("CongViec\n" + "".join(f"job {name} {i}\n" for i in range(rows)))
    run_available(csv_drop_stream(spark, drop, ("CongViec",), arch), ck, append_batches(out))
    run_available(csv_drop_stream(spark, drop, ("CongViec",), arch), ck, append_batches(out))
    got = spark.read.parquet(out)
    assert got.count() == 5 and got.select("CongViec").distinct().count() == 5
    archived = [f for _, _, fs in os.walk(arch) for f in fs if f.endswith(".csv")]
    assert len(archived) >= 1


def test_csv_files_with_other_headers_align_by_name(spark):
    d = tempfile.mkdtemp(prefix="jobsift-csv-")
    for name, text in (("a b.csv", "CongViec,ViTri\nDev,HN\n"), ("c.csv", "CongViec,ChuyenMon,ViTri\nTester,QA,HCM\n"), ("e.csv", "")):
        with open(os.path.join(d, name), "w", encoding="utf-8-sig" if name == "c.csv" else "utf-8") as f:
            f.write(text)
    got = {tuple(r) for r in S.read_csv(spark, d, columns=("CongViec", "ViTri", "MucLuong")).collect()}
    assert got == {("Dev", "HN", None), ("Tester", "HCM", None)}


def test_stream_with_another_header_fails(spark):
    import pytest
    from jobsift.streaming.ingest import append_batches, csv_drop_stream, run_available
    root = tempfile.mkdtemp(prefix="jobsift-stream-")
    os.makedirs(os.path.join(root, "drop"))
    with open(os.path.join(root, "drop", "a.csv"), "w") as f:
        f.write("CongViec,ChuyenMon,ViTri\nTester,QA,HCM\n")
    with pytest.raises(Exception):
        run_available(csv_drop_stream(spark, os.path.join(root, "drop"), ("CongViec", "ViTri")),
                      os.path.join(root, "ckpt"), append_batches(os.path.join(root, "out")))


def test_api_payload_missing_parts(spark):
    rows = [('{"jobId": 1, "skills": [], "jobTitle": "a"}',), ('{"jobId": 2, "skills": [{"skillName": "SQL"}, null, {}]}',), ('{"jobTitle": "x"}',)]
    got = {r["jobId"]: r for r in S.api_flatten(spark.createDataFrame(rows, "payload string")).collect()}
    assert set(got) == {1, 2}
    assert (got[1]["KyNang"], got[1]["ViTri"], got[1]["MoTaCongViec"], got[2]["KyNang"]) == ("N/A", "N/A", "", "SQL, ")


def test_bucket_count_is_kept(spark):
    import pytest
    from jobsift.operators.upsert import BucketCountMismatch, merge_into_bucketed
    path = os.path.join(tempfile.mkdtemp(prefix="jobsift-bkt-"), "t")
    src = spark.createDataFrame([(k, k) for k in range(50)], "k long, v long")
    assert merge_into_bucketed(spark, path, src, ["k"], 8, empty_target=src.limit(0)) == {"inserted": 50, "updated": 0}
    with pytest.raises(BucketCountMismatch):
        merge_into_bucketed(spark, path, src, ["k"], 4)
    assert merge_into_bucketed(spark, path, src, ["k"], 8) == {"inserted": 0, "updated": 50}
    assert spark.read.parquet(path).count() == 50
    assert sum(f.endswith(".parquet") for _, _, fs in os.walk(path) for f in fs) <= 8
