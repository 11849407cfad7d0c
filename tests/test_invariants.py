
import pytest
from pyspark.sql import functions as F

from jobsift import fixtures
from jobsift.operators.upsert import ACTION, DuplicateSourceKey, merge
from jobsift.workloads.warehouse import empty_raw_fact, upsert_latest_by_link


def test_staging_merge_idempotent(spark, sf):
    stg = fixtures.stg(spark, sf).filter("LinkBaiTuyenDung IS NOT NULL")
    first = upsert_latest_by_link(empty_raw_fact(spark), stg)
    counts = {r[ACTION]: r["count"] for r in first.groupBy(ACTION).count().collect()}
    links = stg.select("LinkBaiTuyenDung").distinct().count()
    assert counts == {"INSERT": links}
    second = upsert_latest_by_link(first.drop(ACTION), stg)
    counts2 = {r[ACTION]: r["count"] for r in second.groupBy(ACTION).count().collect()}
    assert counts2 == {"UPDATE": links}
    # the newest crawl per link wins
    latest = stg.groupBy("LinkBaiTuyenDung").agg(F.max("NgayCaoDuLieu").alias("d"))
    bad = second.join(latest, "LinkBaiTuyenDung").filter(F.col("d") != F.col("NgayCaoDuLieu")).count()
    assert bad == 0


def test_rows_without_a_link_are_inserted_each_time(spark, sf):
    stg = fixtures.stg(spark, sf).filter("LinkBaiTuyenDung IS NULL")
    assert stg.count() > 1
    first = upsert_latest_by_link(empty_raw_fact(spark), stg)
    second = upsert_latest_by_link(first.drop(ACTION), stg)
    assert sorted(str(r[ACTION]) for r in second.collect()) == ["INSERT", "None"]


def test_star_takes_rows_without_a_link_twice(spark, sf):
    from jobsift.plans.clean import clean_v2
    from jobsift.plans.star import star_load
    from jobsift.session import materialize
    from jobsift.workloads.postings import raw_fact
    raw = raw_fact(spark, sf).limit(40)
    lost = raw.filter("ViTri LIKE '%Hà Nội%'").limit(4).withColumn("LinkBaiTuyenDung", F.lit(None).cast("string"))
    clean = materialize(clean_v2(materialize(raw.unionByName(lost), "raw-lost")), "clean-lost")
    dims, fact = star_load(clean)
    again = star_load(clean, dims, fact.drop(ACTION))[1]
    actions = {r[ACTION]: r["count"] for r in again.groupBy(ACTION).count().collect()}
    assert set(actions) == {"UPDATE"}


def test_merge_rejects_duplicate_source_keys(spark):
    t = spark.createDataFrame([(1, "a")], "k int, v string")
    s = spark.createDataFrame([(1, "b"), (1, "c")], "k int, v string")
    with pytest.raises(DuplicateSourceKey):
        merge(t, s, ["k"]).collect()


def test_merge_null_keys_never_match(spark):
    t = spark.createDataFrame([(None, "a")], "k int, v string")
    s = spark.createDataFrame([(None, "b")], "k int, v string")
    got = sorted((r["v"], r[ACTION]) for r in merge(t, s, ["k"]).collect())
    assert got == [("a", None), ("b", "INSERT")]


def test_star_keys_and_calendar(spark, sf):
    from jobsift.plans.star import FK_COLUMNS, flagship_report, star_load
    from jobsift.plans.clean import clean_v2
    from jobsift.workloads.postings import raw_fact
    clean = clean_v2(raw_fact(spark, sf)).cache()
    dims, fact = star_load(clean)
    assert fact.count() == clean.count() == clean.select("JobHash").distinct().count()
    for table, key in (("Dim_CongTy", "CongTyID"), ("Dim_CapBac", "CapBacID"), ("Dim_TinhThanh", "TinhThanhID")):
        orphan = fact.filter(F.col(key) != -1).join(dims[table], key, "left_anti").count()
        assert orphan == 0
    ids = [r[0] for r in dims["Dim_CongTy"].select("CongTyID").collect()]
    assert sorted(ids) == list(range(1, len(ids) + 1))
    cal = dims["Dim_ThoiGian"].agg(F.min("FullDate"), F.max("FullDate"), F.count(F.lit(1))).first()
    assert (cal[1] - cal[0]).days + 1 == cal[2]
    assert set(FK_COLUMNS) <= set(fact.columns)
    assert flagship_report(spark, sf).count() > 0


def test_one_row_per_link_province(spark, sf):
    from jobsift.plans.clean import clean_v2
    from jobsift.workloads.postings import raw_fact
    c = clean_v2(raw_fact(spark, sf))
    assert c.count() == c.select("LinkBaiTuyenDung", "Tinh_Thanh").distinct().count()


def test_frontier_rules(spark, sf):
    from jobsift.operators.frontier import crawl_frontier
    listing = fixtures.listing(spark, sf)
    seen = fixtures.seen(spark, sf)
    f = crawl_frontier(listing, seen, cap=100, max_empty=5)
    assert f.join(seen, ["site", "link"], "left_semi").count() == 0
    assert f.groupBy("site", "link").count().filter("count > 1").count() == 0
    per_site = {r["site"]: r["n"] for r in f.groupBy("site").agg(F.max("rank").alias("n")).collect()}
    assert all(n <= 100 for n in per_site.values())


def test_bucketed_merge_rewrites_only_touched_buckets(spark, sf, tmp_path):
    import os
    from jobsift.operators.upsert import BUCKET, merge_into_bucketed
    from jobsift.workloads.warehouse import STAGING, empty_raw_fact, staging_source
    path = str(tmp_path / "fact")
    stg = fixtures.stg(spark, sf)
    now = F.lit("2025-01-01 00:00:00").cast("timestamp_ntz")
    upd = {c: c for c in STAGING if c != "LinkBaiTuyenDung"}
    upd.update({"JobHash": "CalculatedHash", "NgayThemVaoHeThong": now})
    ins = {c: c for c in STAGING}
    ins.update({"JobHash": "CalculatedHash", "NgayThemVaoHeThong": now})
    src = staging_source(stg)
    c1 = merge_into_bucketed(spark, path, src, ["LinkBaiTuyenDung"], 16, upd, ins, empty_raw_fact(spark))
    n_links = stg.select("LinkBaiTuyenDung").distinct().count()
    assert c1 == {"inserted": n_links, "updated": 0}
    # a second batch with a handful of links touches only their buckets
    small = src.filter("LinkBaiTuyenDung IS NOT NULL").orderBy("LinkBaiTuyenDung").limit(3)
    touched = {r[0] for r in small.select(F.pmod(F.xxhash64("LinkBaiTuyenDung"), F.lit(16))).collect()}
    before = {d: os.listdir(os.path.join(path, d)) for d in os.listdir(path) if d.startswith(BUCKET)}
    c2 = merge_into_bucketed(spark, path, small, ["LinkBaiTuyenDung"], 16, upd, ins)
    assert c2 == {"inserted": 0, "updated": 3}
    after = {d: os.listdir(os.path.join(path, d)) for d in os.listdir(path) if d.startswith(BUCKET)}
    changed = {int(d.split("=")[1]) for d in after if after[d] != before.get(d)}
    assert changed == touched
    assert spark.read.parquet(path).count() == n_links


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date", "long"])
def test_latest_by_id_equals_latest_per_key(spark, kind):
    from jobsift.operators.dedupe import latest_by_id, latest_per_key
    ids = "CASE id WHEN 0 THEN -9223372036854775808L WHEN 1 THEN 9223372036854775807L ELSE id - 300 END"
    when = {"long": "id * 37 % 11 - 5"}.get(kind, f"CAST(TIMESTAMP'1969-12-31 23:00:00' + make_dt_interval(0, 0, 0, id * 37 % 11 * 86400.000001) AS {kind})")
    rows = spark.range(600).selectExpr(f"{ids} AS row_id", f"CASE WHEN id % 13 <> 0 AND id % 40 <> 7 THEN {when} END AS ts", "CASE WHEN id % 3 <> 0 THEN id % 40 END AS k",
                                       "CAST(id AS STRING) AS text", "id AS _rank")
    rows = rows.unionByName(spark.sql(f"SELECT 7000L AS row_id, CAST({'9223372036' if kind == 'long' else chr(39) + '9999-12-31' + chr(39)} AS {kind}) AS ts, 77L AS k, NULL AS text, 1L AS _rank"))
    got, wanted = (sorted(map(tuple, f.collect()), key=repr) for f in (latest_by_id(rows, ["k"], "ts", "row_id"), latest_per_key(rows, ["k"], ["ts", "row_id"])))
    assert got == wanted and len(got) == rows.select("k").distinct().count()
    assert latest_by_id(rows.where("row_id IS NULL"), ["k"], "ts", "row_id").count() == 0
    with pytest.raises(TypeError):
        latest_by_id(rows, ["k"], "text", "row_id")
