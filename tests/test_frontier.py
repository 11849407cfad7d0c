"""The frontier against a scan page by page, over ranges of two pages; keyword rules
as a table; job pages that lack fields."""

import random

from jobsift.operators import frontier


def _scan(cards, seen, pages, cap, max_empty):
    """Page after page, as a crawler goes: stop after empty pages or at the cap."""
    out = []
    for site in {p[0] for p in pages}:
        known, empty, taken = {k for s, k in seen if s == site}, 0, []
        for page in sorted(p for s, p in pages if s == site):
            if empty >= max_empty:
                break
            new = 0
            for pos, link, key in sorted(c[2:] for c in cards if c[:2] == (site, page)):
                if key is not None and key not in known:
                    known.add(key)
                    new += 1
                    taken.append((site, page, pos, link, key))
            empty = 0 if new else empty + 1
        out += [(*t, n) for n, t in enumerate(taken, 1) if n <= cap]
    return sorted(out)


def test_frontier_equals_a_scan(spark, monkeypatch):
    monkeypatch.setattr(frontier, "RANGE", 2)
    rnd = random.Random(3)
    cards, pages = [], []
    for site in ("a", "b", "c"):
        for page in range(60):
            if rnd.random() < 0.9:
                pages.append((site, page))
                if rnd.random() < 0.6:
                    cards += [(site, page, pos, f"l{rnd.randrange(10**6)}", rnd.choice([None, *(f"j{x}" for x in range(40 + page))])) for pos in range(3)]
    seen = [(s, f"j{x}") for s in "abc" for x in range(0, 90, 2)]
    listing = spark.createDataFrame(cards, "site string, page int, pos int, link string, job_id string")
    got = frontier.crawl_frontier(listing, spark.createDataFrame(seen, "site string, job_id string"), 25, 3, key="job_id", pages=spark.createDataFrame(pages, "site string, page int"))
    assert sorted(tuple(r) for r in got.collect()) == _scan(cards, seen, pages, 25, 3)


def test_rules_of_any_length(spark):
    from jobsift.operators.rules_join import first_match_join, rules_table
    docs = spark.createDataFrame([(1, "Data engineer"), (2, "c++ dev"), (3, ""), (4, None), (5, "DATABASE")], "k int, t string")
    rules = rules_table(spark, [("c", ["c++", "c#"]), ("base", ["database"]), ("data", ["data", "bi"]), ("r", ["r"])])
    assert {r["k"]: r["label"] for r in first_match_join(docs, "k", "t", rules, "none").collect()} == {1: "data", 2: "c", 3: "none", 4: "none", 5: "base"}
    assert {r["label"] for r in first_match_join(docs, "k", "t", rules.limit(0), "none").collect()} == {"none"}


def test_pages_that_lack_fields(spark):
    from jobsift.functions.job_pages import FIELDS, SECTIONS, extract_fields
    html = '<h1 class="x job-detail__info--title y">A &amp; <b>B</b></h1><div>Mức lương</div><div class="v value">10 &lt; 20</div>'
    pages = spark.createDataFrame([(1, "TopCV", html), (2, "JobsGo", html), (3, "CareerLink", html), (4, "nowhere", html), (5, "TopCV", None), (6, None, html)], "id int, site string, html string")
    got = {r["id"]: r for r in extract_fields(pages).collect()}
    assert (got[1]["title"], got[1]["salary"], got[1]["rank"]) == ("A & B", "10 < 20", "") and got[2]["title"] == "A & B"
    assert all(got[i][f] == "" for i in (3, 4, 5, 6) for f in (*FIELDS, *SECTIONS))


def test_documents_that_do_not_convert(spark):
    from pyspark.sql import types as T
    from jobsift.sources.files import import_documents
    schema = T.StructType([T.StructField("n", T.DecimalType(6, 2)), T.StructField("s", T.StringType())])
    docs = spark.createDataFrame([("a", '[{"n": 1.5, "s": "x"}, {"n": "abc"}, {"s": null}]'), ("b", '{"n": "99999999"}'), ("c", "no json ["), ("d", None), ("e", "[]")], "doc string, content string")
    rows, rejects = import_documents(docs, "doc", "content", schema)
    assert sorted((r["doc"], r["pos"], str(r["n"]), r["s"]) for r in rows.collect()) == [("a", 0, "1.50", "x"), ("a", 1, "None", None), ("a", 2, "None", None), ("b", 0, "None", None)]
    assert sorted((r["doc"], r["field"], r["value"]) for r in rejects.collect() if r["field"]) == [("a", "n", "abc"), ("b", "n", "99999999")]
    assert [r["doc"] for r in rejects.where("field IS NULL").collect()] == ["c"]
