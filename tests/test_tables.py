"""Bucketed tables: commits in one step, batches that come again, changes; streams
merged into them; drops of several days; files that cannot be read."""

import gzip
import os

import pytest
from pyspark.sql import functions as F

from jobsift.operators.tables import BUCKET, BucketedTable


def _table(spark, tmp_path, **more):
    schema = spark.createDataFrame([], "k long, v string, n long").schema
    return BucketedTable(spark, str(tmp_path / "t"), ["k"], 4, schema, **more)


def _rows(spark, *rows):
    return spark.createDataFrame(list(rows), "k long, v string, n long")


def _folders(table):
    return [os.path.join(d, c) for d in os.listdir(table.root) if d.startswith(BUCKET) for c in os.listdir(os.path.join(table.root, d))]


def test_a_run_that_fails_before_the_rename_changes_nothing(spark, tmp_path, monkeypatch):
    t = _table(spark, tmp_path)
    assert t.read().count() == 0
    assert t.merge(_rows(spark, *[(k, "a", k) for k in range(20)])) == {"inserted": 20, "updated": 0}
    before = sorted(t.read().collect())
    publish = BucketedTable.publish

    def broken(self, manifest):
        raise OSError("lost the driver")

    monkeypatch.setattr(BucketedTable, "publish", broken)
    with pytest.raises(OSError):
        t.merge(_rows(spark, (1, "b", 1), (99, "b", 1)))
    monkeypatch.setattr(BucketedTable, "publish", publish)
    assert sorted(t.read().collect()) == before and t.versions() == [1]
    assert t.merge(_rows(spark, (1, "b", 1), (99, "b", 1))) == {"inserted": 1, "updated": 1}
    assert {r["k"]: r["v"] for r in t.read().collect()} == {k: "a" for k in range(20)} | {1: "b", 99: "b"}
    # the folders of the failed run are gone; those of the version before stay for its readers
    named = {(b, c) for v in t.versions() for b, c in t.manifest(v)["folders"].items()}
    assert len(_folders(t)) == len(named) and sorted(t.read(1).collect()) == before


def test_old_versions_go(spark, tmp_path):
    t = _table(spark, tmp_path, keep=1)
    for n in range(3):
        t.merge(_rows(spark, *[(k, f"v{n}", n) for k in range(10)]))
    assert t.versions() == [3] and len(_folders(t)) <= 4
    assert spark.read.parquet(t.root).count() == 10


def test_two_writers_of_one_version(spark, tmp_path):
    t = _table(spark, tmp_path)
    t.merge(_rows(spark, (1, "a", 1)))
    with pytest.raises(FileExistsError):
        t.publish({"version": 1, "buckets": 4, "folders": {}, "batches": {}})
    assert t.read().count() == 1


def test_changes_and_batches(spark, tmp_path):
    t = _table(spark, tmp_path)
    t.merge(_rows(spark, *[(k, "a", k) for k in range(20)]), batch=("s", 1))
    t.merge(_rows(spark, (3, "b", 1), (50, "b", 1)), batch=("s", 2))
    assert sorted(r["k"] for r in t.changes(1).collect()) == [3, 50]
    assert t.changes(0).count() == 21 and t.changes(2).count() == 0
    assert t.merged_batch("s") == 2
    assert t.merge(_rows(spark).limit(0), batch=("s", 3)) == {"inserted": 0, "updated": 0}
    assert t.merged_batch("s") == 3 and t.read().count() == 21


def test_null_keys_are_inserted(spark, tmp_path):
    t = _table(spark, tmp_path)
    for _ in range(2):
        t.merge(_rows(spark, (None, "a", 1), (1, "a", 1)))
    assert t.read().count() == 3


def test_stream_keeps_the_newest_row_of_a_key(spark, tmp_path):
    from jobsift.streaming.ingest import merge_batches
    t = _table(spark, tmp_path)
    sink = merge_batches(t, ["n"], "q")
    sink(_rows(spark, (1, "old", 1), (1, "new", 5), (2, "x", 1)), 0)
    sink(_rows(spark, (1, "late", 3), (3, "y", 1)), 1)
    sink(_rows(spark, (1, "replayed", 9)), 1)
    assert {r["k"]: r["v"] for r in t.read().collect()} == {1: "new", 2: "x", 3: "y"}
    sink(_rows(spark, (1, "next", 9)), 2)
    assert t.read().where("k = 1").first()["v"] == "next" and t.read().count() == 3


def _csv(path, rows, header="CongViec,CongTy,ViTri,LinkBaiTuyenDung,Nguon,NgayCaoDuLieu,ChuyenMon"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8-sig") as f:
        f.write("\n".join([header, *rows]) + "\n")


def test_unreadable_files_are_listed_and_stay(spark, tmp_path):
    from jobsift.sources.files import backup_drop
    drop = str(tmp_path / "drop")
    _csv(f"{drop}/good one.csv", ["Dev,A,Hà Nội,l1,s,2025-01-01,x", '"two\nlines",A,Huế,l2,s,2025-01-01,x'])
    _csv(f"{drop}/other.csv", ["QA,l3"], "CongViec,LinkBaiTuyenDung")
    _csv(f"{drop}/header.csv", [])
    open(f"{drop}/empty.csv", "w").close()
    with open(f"{drop}/latin.csv", "wb") as f:
        f.write("CongViec\nHuế é\n".encode("cp1258", "replace") + b"\xff\xfe\n")
    whole = gzip.compress("\n".join(["CongViec,LinkBaiTuyenDung", *[f"job {i},l{i}x{i * i}" for i in range(5000)]]).encode())
    with open(f"{drop}/whole.csv.gz", "wb") as f:
        f.write(whole)
    with open(f"{drop}/cut.csv.gz", "wb") as f:
        f.write(whole[:len(whole) // 2])
    rows, read, bad = backup_drop(spark, [drop], str(tmp_path / "out"))
    assert {os.path.basename(p) for p, _ in bad} == {"empty.csv", "latin.csv", "cut.csv.gz"}
    assert {os.path.basename(p) for p in read} == {"good one.csv", "other.csv", "header.csv", "whole.csv.gz"}
    out = spark.read.parquet(str(tmp_path / "out"))
    assert rows == out.count() == 5003 and out.where("CongViec = 'QA'").first()["LinkBaiTuyenDung"] == "l3"
    assert len(os.listdir(drop)) >= 7


def test_files_of_any_length_are_inspected_by_blocks(spark, tmp_path):
    """No task reads a file as a whole; faults behind the first block are found."""
    from jobsift.sources.files import inspect_files
    drop = str(tmp_path / "drop")
    long = [f'job {i},"two\nlines and Huế {i}"' for i in range(400)]
    _csv(f"{drop}/50%+ (1).csv", long, "\ufeffCongViec,MoTa \r")
    _csv(f"{drop}/blank.csv", long, " ")
    _csv(f"{drop}/late.csv", long, "CongViec,MoTa")
    with open(f"{drop}/late.csv", "ab") as f:
        f.write(b"job,Hu\xe1\nx,y\n")
    with open(f"{drop}/mark.csv", "wb") as f:
        f.write(b"\xef\xbb\xbf")
    open(f"{drop}/empty.csv", "w").close()
    with open(f"{drop}/whole.csv.gz", "wb") as f:
        f.write(gzip.compress(b"CongViec,Ma\njob,\xff\n"))
    with open(f"{drop}/cut.csv.gz", "wb") as f:
        f.write(gzip.compress("\n".join(["A,B", *[f"{i},{i * i}" for i in range(5000)]]).encode())[:2000])
    conf = {"spark.sql.sources.binaryFile.maxLength": "1000", "spark.sql.files.maxPartitionBytes": "2k", "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        looked = inspect_files(spark, [drop])
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    found = {os.path.basename(p): (header, problem) for p, header, problem in looked}
    assert len(looked) == len(found) == 7
    assert found["50%+ (1).csv"] == ("CongViec,MoTa", None) and found["whole.csv.gz"] == ("CongViec,Ma", None)
    assert found["late.csv"] == ("CongViec,MoTa", "not UTF-8 text") and found["cut.csv.gz"][1] is None
    assert {k for k, v in found.items() if v[1] == "no header line"} == {"blank.csv", "mark.csv", "empty.csv"}


@pytest.fixture(scope="module")
def days(spark, tmp_path_factory):
    """Three days: new links, links again with other values, links without value, a
    damaged file, a run that fails at its last stage and is repeated."""
    from jobsift.plans import daily
    root = str(tmp_path_factory.mktemp("daily"))
    place = ["Hà Nội", "Đà Nẵng", "Hà Nội; Đà Nẵng"]
    day = lambda d, links: [f"Dev {x},Cong ty {x % 5},{place[x % 3]},https://x/{x},site{x % 2},2025-01-0{d},m" for x in links]
    _csv(f"{root}/in/1/a.csv", day(1, range(12)))
    _csv(f"{root}/in/1/b.csv", day(1, range(12, 16)) + ["Dev n,Cong ty n,Hà Nội,,site0,2025-01-01,m"])
    _csv(f"{root}/in/2/a.csv", day(2, range(10, 20)) + ["Dev n2,Cong ty n2,Hà Nội,,site0,2025-01-02,m"])
    open(f"{root}/in/2/empty.csv", "w").close()
    _csv(f"{root}/in/3/a.csv", day(3, [0, 30]))
    runs = []
    for d in (1, 2, 3):
        run = lambda: daily.daily_run(spark, [f"{root}/in/{d}"], f"{root}/dw", as_of=f"2025-01-0{d} 06:00:00", drop_id=f"d{d}", buckets=3, archive=f"{root}/archive")  # noqa: E731, B023
        if d == 2:
            star, daily.merge_star = daily.merge_star, lambda *a: 1 / 0
            with pytest.raises(ZeroDivisionError):
                run()
            daily.merge_star = star
        w = run()
        runs.append((w.star.read().select("JobHash", "FactID", "NgayTao").collect(), {t: w.dims[t].collect() for t in ("Dim_CongTy", "Dim_TinhThanh", "Dim_Nguon")}))
    return root, w, runs


def test_days_take_what_is_new(days):
    _, w, _ = days
    ledger = {(r["drop_id"], r["stage"], r["Status"]): r for r in w.ledger().collect()}
    took = {k: (r["rows_in"], r["inserted"], r["updated"]) for k, r in ledger.items()}
    assert took["d1", "raw", "Success"] == (17, 17, 0) and took["d2", "raw", "Success"] == (11, 5, 6) and took["d3", "raw", "Success"] == (2, 1, 1)
    assert took["d2", "clean", "Success"][0] == 11 and took["d3", "clean", "Success"][0] == 2
    assert ("d2", "star", "Failed") in ledger and took["d2", "star", "Success"][0] is not None
    assert ("d2", "raw", "Skipped") in ledger and ("d2", "clean", "Skipped") in ledger
    assert {k[0] for k in ledger} == {"d1", "d2", "d3"}


def test_backup_holds_all_rows_and_files_are_archived(days, spark):
    root, w, _ = days
    back = w.backup()
    assert back.count() == 17 + 11 + 2 and "ChuyenMon" in back.columns
    assert sorted(os.listdir(f"{root}/archive/d1")) == ["a.csv", "b.csv"] and os.listdir(f"{root}/in/2") == ["empty.csv"]
    bad = spark.read.parquet(w.drop("quarantine", "d2")).collect()
    assert [(os.path.basename(r["path"]), r["error"]) for r in bad] == [("empty.csv", "no header line")]
    assert not os.path.exists(w.drop("staging", "d1"))


def test_no_surrogate_key_changes(days):
    _, w, runs = days
    for (facts, dims), (later_facts, later_dims) in zip(runs, runs[1:]):
        assert {tuple(r) for r in facts} <= {tuple(r) for r in later_facts}
        for t, rows in dims.items():
            assert {tuple(r) for r in rows} <= {tuple(r) for r in later_dims[t]}
    facts = runs[-1][0]
    assert len({r["FactID"] for r in facts}) == len({r["JobHash"] for r in facts}) == len(facts)
    # 21 links and the rows without one, each by province
    links = [x for x in [*range(20), 30]]
    assert len(facts) == sum(2 if x % 3 == 2 else 1 for x in links) + 1


def test_the_same_drop_again_changes_nothing(days, spark):
    from jobsift.plans.daily import daily_run
    root, w, _ = days
    before = [t.versions() for t in (w.raw, w.clean, w.star)], w.backup().count()
    again = daily_run(spark, [f"{root}/archive/d3"], f"{root}/dw", as_of="2025-01-09 06:00:00", drop_id="d3", buckets=3)
    assert ([t.versions() for t in (again.raw, again.clean, again.star)], again.backup().count()) == before
    assert again.ledger().where(F.col("StartTime") == again.ledger().agg(F.max("StartTime")).first()[0]).first()["Status"] == "Skipped"
