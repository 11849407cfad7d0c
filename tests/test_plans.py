"""
no single-partition windows over fact-size inputs."""

from jobsift import fixtures


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _clean_plan(spark, sf, link: str) -> str:
    from jobsift.plans.clean import clean_v2
    return plan_text(clean_v2(spark.read.parquet(f"{sf}/orders.parquet").limit(0).selectExpr(
        *[f"{link if c == 'LinkBaiTuyenDung' else 'CAST(NULL AS STRING)'} AS {c}" for c in fixtures.STAGING_COLUMNS if c != "NgayCaoDuLieu"],
        "CAST(NULL AS DATE) AS NgayCaoDuLieu")))


def test_clean_v2_has_no_python_and_no_shuffle_for_unique_links(spark, sf):
    p = _clean_plan(spark, sf, "'link'")
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p and "PythonUDF" not in p
    assert "Exchange" not in p
    # rows without a link, which a MERGE inserts each time, are reduced to one a province
    assert _clean_plan(spark, sf, "CAST(NULL AS STRING)").count("Exchange") == 1


def test_latest_per_key_is_combined_before_the_shuffle(spark, sf):
    from jobsift.operators.dedupe import latest_per_key
    p = plan_text(latest_per_key(fixtures.table(spark, sf, "events"), ["user_id"], ["ts", "event_id"]))
    assert "Window" not in p and p.count("max_by") >= 2 and "partial_max_by" in p.split("Exchange", 1)[1]


def test_star_source_broadcasts_bounded_dims(spark, sf):
    from jobsift.plans.clean import clean_v2
    from jobsift.plans.star import fill_dims, star_source, v2_to_star
    from jobsift.workloads.postings import raw_fact
    src = v2_to_star(clean_v2(raw_fact(spark, sf)))
    p = plan_text(star_source(src, fill_dims(src)))
    assert p.count("BroadcastHashJoin") >= 8


def test_no_window_of_the_frontier_spans_a_site(spark, sf):
    import re
    from jobsift.operators.frontier import crawl_frontier
    df = crawl_frontier(fixtures.listing(spark, sf), fixtures.seen(spark, sf))
    p = df._jdf.queryExecution().executedPlan().toString()
    specs = re.findall(r"windowspecdefinition\(([^)]*)\)", p)
    assert specs and all(len(re.findall(r"#\d+", s.split(" ASC")[0])) >= 3 for s in specs)


def test_rules_join_has_no_nested_loop(spark, sf):
    from jobsift.operators.rules_join import first_match_join, rules_table
    p = plan_text(first_match_join(fixtures.table(spark, sf, "documents"), "doc_id", "text", rules_table(spark, [("a", ["xyz", "q"]), ("b", ["data"])]), "none"))
    assert "NestedLoop" not in p and "CartesianProduct" not in p


def test_latest_by_id_aggregates_keys_alone(spark, sf):
    from jobsift.operators.dedupe import latest_by_id
    p = plan_text(latest_by_id(fixtures.table(spark, sf, "events"), ["user_id"], "ts", "event_id"))
    assert "SortAggregate" not in p and "ObjectHashAggregate" not in p and p.count("HashAggregate") == 2 and "partial_max(_rank" in p


def test_cleaning_stages_are_compiled(spark, sf):
    key = "spark.sql.codegen.hugeMethodLimit"
    spark.conf.set(key, "65535")
    _clean_plan(spark, sf, "'link'")
    assert int(spark.conf.get(key)) <= 8000


def test_staging_lists_are_literals_with_the_same_rows(spark, sf):
    given = fixtures.stg(spark, sf)
    assert "split_part" in fixtures.STG_SQL and "split_part" not in plan_text(given)
    as_sql = spark.sql(fixtures.STG_SQL)
    assert given.exceptAll(as_sql).isEmpty() and as_sql.exceptAll(given).isEmpty()


def test_stored_texts_are_stripped_like_any(spark):
    from pyspark.sql import functions as F

    from jobsift.functions.text import WS_CHARS, py_strip_stored
    texts = [None, "", " ", "​", "Đà Nẵng", "\x84x\x84", "x、", *[f"{w}ấ {w}b{w}" for w in WS_CHARS], *[f"{w}ấ" for w in WS_CHARS], *[f"ấ{w}" for w in WS_CHARS], *WS_CHARS]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", py_strip_stored(F.col("t")).alias("s"))
    assert all(r["s"] == (None if r["t"] is None else r["t"].strip()) for r in df.collect())


def test_deadlines_are_parsed_once(spark):
    from pyspark.sql import functions as F

    from jobsift.functions.dates import deadline_v2
    df = spark.createDataFrame([(" 31/12/2025 ",), ("31/02/2025",), ("  ",), ("Hạn 1.2.2025",), ("thỏa thuận 1/2/2025",), (None,)], "t string")
    out = df.select(deadline_v2(F.col("t"), F.lit("2025-01-05").cast("date"), "2025-01-01").alias("d"))
    assert [str(r["d"]) for r in out.collect()] == ["2025-12-31", "2025-02-04", "2025-02-04", "2025-02-01", "2025-02-04", "2025-02-04"]
    assert out._jdf.queryExecution().optimizedPlan().toString().lower().count("gettimestamp") == 1
