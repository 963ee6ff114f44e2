"""What keeps the work on parsed sites in proportion: many tasks, no large broadcast, one parse, no cut, small slices."""

import random
import re
from html.parser import HTMLParser

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rosterworks import params
from rosterworks.operators import enrich as E
from rosterworks.operators import pages as P
from rosterworks.operators import people as H
from rosterworks.plans.registry import QUERIES
from rosterworks.sources.tables import spread
from rosterworks.sources.views import view


def plan(df, capsys):
    capsys.readouterr()
    df.explain()
    return capsys.readouterr().out


@pytest.mark.parametrize("name", ["sites", "visits"])
def test_pages_of_a_narrow_table_are_many_tasks(spark, name):
    """15,000 customers are one split of their file, but four tasks' pages."""
    assert view(spark, "/root/testdata/sf0.1", name).select("page_id").rdd.getNumPartitions() >= 4


def test_spread_keeps_rows(spark):
    got = spread(spark.range(100).repartition(1), "id", rows=30)
    assert got.rdd.getNumPartitions() == 4 and sorted(r.id for r in got.collect()) == list(range(100))
    assert spread(spark.range(0), "id").count() == 0


def test_site_pages_broadcast_nothing(spark, capsys):
    sites = spark.createDataFrame([("a.example", "https://a.example/"), ("b.example", "https://b.example")], "account_key string, home string")
    rows = [("https://a.example/", 1, True, "https://a.example/"), ("https://a.example/staff", 2, True, "https://a.example/"), ("https://b.example/staff", 3, True, "https://b.example/team"), ("https://b.example/", 4, False, "https://b.example/")]
    got = P.site_pages(sites, spark.createDataFrame(rows, "url string, page_id long, usable boolean, final_url string"))
    assert "Broadcast" not in plan(got, capsys)
    assert sorted((r.account_key, r.page_ord, r.page_id) for r in got.collect()) == [("a.example", 0, 1), ("b.example", params.SITE_PATHS.index("/staff"), 3)]


def test_candidates_do_not_broadcast_accounts(spark, capsys):
    pages = spark.createDataFrame([(1, "https://a.example/staff", "<p>Jane Smith, General Manager, jane@a.example and all others</p>")], "page_id long, url string, html string")
    seen = P.page_features(pages).withColumns({"account_key": F.lit("a.example"), "page_ord": F.lit(0)})
    got = H.page_candidates(seen, spark.createDataFrame([("a.example", None)], "account_key string, website_url string"))
    assert "Broadcast" not in plan(got, capsys) and [r.full_name for r in got.collect()] == ["Jane Smith"]


def test_enrichment_parses_once(spark, capsys):
    shown = plan(QUERIES["apply_enrichment"](spark, "/root/testdata/sf0.001"), capsys)
    assert len([line for line in shown.splitlines() if "MapInArrow" in line or "MapInPandas" in line]) == 1


def test_home_pages_in_found_or_beside_it(spark):
    stored = "account_key string, account_name string, inferred_brand string, account_city string, account_state string, name_confidence double, brand_confidence double, location_confidence double, confidence_score double, website_url string, website_source_url string, website_confidence_score double, source_type string"
    accounts = spark.createDataFrame([(k, "Old", None, None, None, 0.5, 0.5, 0.5, 0.4, "w", None, s, "x") for k, s in (("a", 0.3), ("b", 0.99), ("c", 0.3), ("d", 0.3))], stored)
    values = "account_key string, account_name string, name_confidence double, inferred_brand string, brand_confidence double, account_city string, account_state string, location_confidence double, website_url string, website_confidence_score double"
    found = spark.createDataFrame([("a", "New", 0.9, "Kia", 0.4, None, None, None, "https://a", 0.95), ("b", None, None, None, None, None, None, None, "https://b", 0.95), ("c", "New", 0.9, None, None, None, None, None, None, 0.95)], values)
    beside = E.apply_enrichment(accounts, found.drop("website_url", "website_confidence_score"), found.select("account_key", "website_url", "website_confidence_score"))
    inside = E.apply_enrichment(accounts, found)
    assert sorted(inside.collect()) == sorted(beside.collect()) and inside.columns == accounts.columns
    got = {r.account_key: (r.website_url, r.website_confidence_score, r.source_type) for r in inside.collect()}
    assert got == {"a": ("https://a", 0.95, "website_enrichment"), "b": ("https://b", 0.99, "website_enrichment"), "c": ("w", 0.95, "x"), "d": ("w", 0.3, "x")}


def test_union_of_people_pages_is_whole(spark, capsys):
    """More pages than any cut stay, a found page wins over a guess of it, and nothing is ranked."""
    links = spark.range(1500).select(F.lit("https://a.example").alias("url"), F.concat(F.lit("https://a.example/staff/"), "id").alias("target"), F.col("id").cast("int").alias("pos"), F.lit("/staff").alias("href"), F.lit("Staff").alias("text"))
    links = links.unionByName(links.where("pos = 0").withColumns({"target": F.lit("https://a.example/sales"), "text": F.lit("Our team")}))
    homes = spark.createDataFrame([("https://a.example",)], "url string")
    got = P.people_pages(links, homes, limit=None)
    assert got.count() == 1500 + len(params.CONTACT_PATHS) and got.where("target = 'https://a.example/sales'").first().priority == 0
    assert "Window" not in plan(QUERIES["site_url_union"](spark, "/root/testdata/sf0.001"), capsys)
    assert P.people_pages(links, homes, limit=16).count() == 16


def test_slices_of_a_batch():
    html = pa.array(["x" * 10] * 600 + [None, "", "y" * (P.BYTES_AT_ONCE + 1), "z"] + ["w" * 1_000_000] * 9)
    got = list(P._slices(html))
    assert [start for start, _ in got] == [sum(n for _, n in got[:k]) for k in range(len(got))] and sum(n for _, n in got) == len(html)
    sizes = [len(v or "") for v in html.to_pylist()]
    assert all(n <= P.PAGES_AT_ONCE and (n == 1 or sum(sizes[s : s + n]) <= P.BYTES_AT_ONCE) for s, n in got)
    assert list(P._slices(pa.array([], pa.string()))) == []


def test_features_do_not_depend_on_slices(spark):
    pages = spark.range(1000).repartition(1).select(F.col("id").alias("page_id"), F.concat(F.lit("https://a.example/"), "id").alias("url"), F.when(F.col("id") % 7 > 0, F.concat(F.lit("<title>T"), "id", F.lit('</title><a href="/x">y</a><p>write to m'), "id", F.lit("@a.example"))).alias("html"))
    rows = {r.page_id: r for r in P.page_features(pages, ("html",)).collect()}
    assert len(rows) == 1000
    for k in (0, 1, 255, 256, 257, 999):
        want = P.parse_spans(rows[k].html or "")
        assert {c: rows[k][c] for c in ("title", "text", "json_ld")} == {c: want[c] for c in ("title", "text", "json_ld")}
        assert [a.asDict() for a in rows[k].anchors] == want["anchors"] and [m.asDict() for m in rows[k].email_contexts] == want["email_contexts"]
        assert rows[k].html is None if k % 7 == 0 else f"<title>T{k}<" in rows[k].html


ODD = ("<a", "<A", "<p", "<script", "<style", "<title", "<textarea", "<meta", "<br", "<h1", "<x-y", ">", "/>", " >", ' href="/x"', " href='/x y'", " href=/x", ' href="a&amp;b"', ' href="mailto:a@b.example"', ' class="x>y"', ' name="description"', ' content="some <b> words"',
       ' type="application/ld+json"', ' data-x=""', " checked", '  id="2"', ' id="2"id="3"', "\n", "</a>", "</A>", "</p>", "</script>", "</script >", "</style>", "</title>", "</ a>", "</a b>", "</>", "</", "<!-- c -->", "<!--", "&amp;", "&", "text and more text that is long enough", "me@x.example", '"', "=")


def test_plain_tags_are_read_as_the_library_reads_them(monkeypatch):
    """Quick ways for plain tags change no feature; on a page of such tags no other is taken."""
    plain = '<div class="x"><p>Jane, <b>Manager</b></p><a href="mailto:j@a.example">Mail</a></div>'
    whole = P.parse_spans(plain)
    chance = random.Random(7)
    odd = ["".join(chance.choices(ODD, k=chance.randint(1, 25))) for _ in range(4000)]
    quick = [P.parse_spans(h) for h in odd]
    with monkeypatch.context() as m:
        for name in ("parse_starttag", "parse_endtag", "updatepos"):
            m.setattr(HTMLParser, name, lambda *_: pytest.fail("not the quick way"))
        assert P.parse_spans(plain) == whole
    for name in ("parse_starttag", "parse_endtag", "updatepos"):
        monkeypatch.delattr(P._Tree, name)
    assert P.parse_spans(plain) == whole and [P.parse_spans(h) for h in odd] == quick


MADE = {
    "email_contexts": {"email_contexts", "text"},
    "page_brands": {"json_ld", "og_site_name", "title", "meta_description"},
    "best_page_values": {"json_ld", "og_site_name", "title", "meta_description", "account_key", "html"},
    "page_anchors": {"anchors"},
    "site_names": {"json_ld", "og_site_name", "title"},
}


@pytest.mark.parametrize("name", MADE)
def test_only_used_features_are_made(spark, capsys, name):
    shown = plan(QUERIES[name](spark, "/root/testdata/sf0.001"), capsys)
    made = re.search(r"MapInArrow run\(.*?\)#\d+, \[(.*?)\]", shown)[1]
    assert {re.sub(r"#\d+L?", "", c) for c in made.split(", ")} == {"page_id", "url"} | MADE[name]


def test_texts_are_searched_for_brands_once(spark, capsys):
    assert plan(QUERIES["page_brands"](spark, "/root/testdata/sf0.001"), capsys).count("regexp_extract_all(lower(") == 5


def test_places_are_worked_out_once(spark, capsys):
    shown = plan(QUERIES["best_page_values"](spark, "/root/testdata/sf0.001"), capsys)
    assert shown.count("$.address.addressLocality") == 1 and shown.count("initcap") == 2
    rows = [("", ""), (None, None), ("<p>Visit us in Salem,  OR 97301", ""), ("Here, ZZ. Bend,\nWA", ""), ("Salem, OR", '{"address": {"addressLocality": " ", "addressRegion": "OR"}}'), ("Salem, OR", '{"address": {"addressLocality": "bend", "addressRegion": " wa "}}')]
    frame = spark.createDataFrame([(k, h, [j] if j else []) for k, (h, j) in enumerate(rows)], "k int, h string, j array<string>")
    got = [r.p and tuple(r.p) for r in frame.select("k", E.page_place(F.col("j"), F.col("h")).alias("p")).orderBy("k").collect()]
    assert got == [None, None, ("Visit Us In Salem", "OR", 0.72), ("Zz. Bend", "WA", 0.72), ("Salem", "OR", 0.72), ("Bend", "WA", 0.95)]
