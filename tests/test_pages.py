"""HTML features, contacts, names, brands and places on hand-made pages."""

import pytest
from pyspark.sql import functions as F

from rosterworks import params
from rosterworks.functions import exprs as X
from rosterworks.operators import classify as C
from rosterworks.operators import enrich as E
from rosterworks.operators import pages as P
from rosterworks.operators import people as H
from rosterworks.plans import pages as PP

STAFF = '<div><h3>Jane Smith</h3><p>General Manager</p><a href="mailto:JSmith@AcmeFord.example">Email me here please</a></div>'


def one(spark, column, **values):
    frame = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values))
    return frame.select(column.alias("v")).first().v


def test_page_to_candidate(spark):
    pages = spark.createDataFrame([(1, "https://www.acmeford.example/staff", STAFF)], "page_id long, url string, html string")
    features = P.page_features(pages).withColumns({"account_key": F.lit("acmeford.example"), "page_ord": F.lit(0)})
    accounts = spark.createDataFrame([("acmeford.example", None)], "account_key string, website_url string")
    rows = H.page_candidates(features, accounts).collect()
    assert len(rows) == 1
    row = rows[0]
    assert (row.first_name, row.last_name, row.email) == ("Jane", "Smith", "jsmith@acmeford.example")
    assert (row.role_type, row.role_family, row.role_title) == ("general_manager", "executive", "General Manager")
    assert row.confidence_score == pytest.approx(0.98)


def test_title_first_gives_no_name(spark):
    text = "Sales Manager Bob Jones info@acmeford.example"
    assert one(spark, X.person_near(F.col("t"), F.lit("info@acmeford.example"), F.lit("Sales Manager")), t=text) is None


def test_short_context_is_the_anchor_text():
    got = P.parse_page('<p><a href="mailto:a@b.example">Write me</a></p>')
    assert got["email_contexts"] == [{"pos": 0, "email": "a@b.example", "context": "Write me"}]


def test_features_of_odd_pages():
    got = P.parse_page('<title>A &amp; B</title><meta name="description" content="d"><script>x<b></script><p>one<br>two</i></div><a href=" /x ">L</a>')
    assert got["title"] == "A & B" and got["meta_description"] == "d" and got["anchors"] == [{"pos": 0, "href": "/x", "text": "L"}]
    assert "x<b>" not in got["text"]
    assert P.parse_page("") == {"title": "", "meta_description": "", "og_site_name": "", "text": "", "anchors": [], "json_ld": [], "email_contexts": []}


@pytest.mark.parametrize(("mail", "key", "same"), [("mail.acme.example", "acme.example", True), ("acme.example", "www2.acme.example", True), ("badacme.example", "acme.example", False)])
def test_domains(spark, mail, key, same):
    assert one(spark, X.same_site_domain(F.col("a"), F.col("b")), a=mail, b=key) is same


def test_json_ld(spark):
    frame = spark.createDataFrame([(['[{"name": 5}, {"name": "Acme Motors"}]', "broken {"],), (['{"address": {"addressLocality": "winston-salem", "addressRegion": "nc"}}'],)], "j array<string>")
    rows = frame.select(E.page_name(F.col("j"), F.lit(None).cast("string"), F.lit(None).cast("string")).alias("n"), E.page_place(F.col("j"), F.lit("")).alias("p")).collect()
    assert tuple(rows[0].n) == ("Acme Motors", 0.95) and rows[0].p is None
    assert rows[1].n is None and tuple(rows[1].p) == ("Winston-Salem", "NC", 0.95)


def test_ladders(spark):
    none, empty = F.lit(None).cast("string"), F.array().cast("array<string>")
    name = lambda og, title: tuple(one(spark, E.page_name(empty, F.col("o"), F.col("t")), o=og, t=title))
    assert name("Honda World", "Ford of Salem") == ("Honda World", 0.90)
    assert name("", "Ford Chevrolet") == ("Ford Chevrolet", 0.78)
    assert tuple(one(spark, E.page_brand(F.col("n"), none, none, none, none), n="Honda World")) == ("Honda", 0.98)
    assert tuple(one(spark, E.page_brand(F.col("n"), none, none, none, none), n="Ford Chevrolet")) == ("Chevrolet", 0.98)


@pytest.mark.parametrize(("html", "city"), [("<p>Salem, OR 97301</p>", "Salem"), ("<p>Visit Salem, OR</p>", "Visit Salem")])
def test_places(spark, html, city):
    assert tuple(one(spark, E.page_place(F.array().cast("array<string>"), F.col("h")), h=html)) == (city, "OR", 0.72)


@pytest.mark.parametrize(("name", "short"), [("John Smith General Used", "John Smith"), ("Co", "Co")])
def test_name_endings(spark, name, short):
    assert one(spark, X.trim_name(F.col("n")), n=name) == short


@pytest.mark.parametrize(("token", "rule", "score"), [("instagram.com", 8, 0.89), ("administration.org", 9, 0.86)])
def test_substring_brands(spark, token, rule, score):
    frame = spark.createDataFrame([(token, "https://x.example")], "evidence string, source_url string")
    row = C.classified(C.signals(frame)).first()
    assert (row.classification, row.rule_id, row.confidence) == ("dealer", rule, score)
    assert C.classified(C.signals(frame, min_keyword_len=9)).first().rule_id != 9


@pytest.mark.parametrize(("old", "new", "replaced"), [(("dealer", 0.95), ("vendor", 0.86), True), (("dealer", 0.95), ("vendor", 0.84), False), (("vendor", 0.96), ("dealer", 0.84), True), (("dealer", 0.95), ("dealer", 0.93), False), ((None, None), ("oem", 0.88), True)])
def test_replacement(spark, old, new, replaced):
    accounts = spark.createDataFrame([("k", *old)], "account_key string, classification string, classification_confidence double")
    result = spark.createDataFrame([("k", *new)], "account_key string, classification string, confidence double")
    row = C.apply_classification(accounts, result, F.current_timestamp()).first()
    assert row.replaced is replaced and row.classification == (new if replaced else old)[0]


def test_error_reasons(spark):
    assert one(spark, X.error_reason(F.col("m")), m="net::ERR_CONNECTION_REFUSED at x") == "browser_connection_refused"
    assert one(spark, X.error_reason(F.col("m")), m="net::ERR_TIMED_OUT") == "browser_network_error"
    assert one(spark, X.error_reason(F.col("m")), m="boom") == "browser_navigation_error"


def test_found_people_pages(spark):
    """Links of home pages join the guesses, whatever stands in the tag; other pages' and other sites' links do not."""
    home = '<a class="x" href="/about-us"><b>About</b></a><a href="/people#top">Our team</a><a href="https://other.example/staff">Staff</a><a href="/cars">Cars</a>'
    rows = [(1, "http://www.acme.example/deep", '<a href="/deep-staff">Staff</a>'), (2, "http://www.acme.example/", home), (3, "https://solo.example/en/1", '<a href="contact.html">Write</a>')]
    known = spark.createDataFrame(rows, "page_id long, url string, html string")
    homes = spark.createDataFrame([("https://acme.example",), ("https://solo.example",)], "url string")
    got = {(r.url, r.target): r.priority for r in P.people_pages(PP.site_links(known), homes, limit=1000).collect()}
    found = {k: v for k, v in got.items() if k[1].removeprefix(k[0]) not in params.CONTACT_PATHS}
    assert found == {("https://acme.example", "https://acme.example/people"): 0, ("https://solo.example", "https://solo.example/en/contact.html"): 2}
    assert got["https://acme.example", "https://acme.example/about-us"] == 2 and len(got) == 2 + 2 * len(params.CONTACT_PATHS)


def test_names_from_whole_pages(spark):
    """JSON-LD before the site's name before the title, read from the html of every page."""
    ld = '<script type="application/ld+json">{"name": "Acme Motors"}</script>'
    og = '<meta property="og:site_name" content="Acme Site">'
    rows = [(1, f"<title>T</title>{og}{ld}"), (2, f"<title>T</title>{og}"), (3, "<title>Acme &amp; Co</title>"), (4, ""), (5, None), (3, "<title>Again</title>")]
    known = spark.createDataFrame([(k, "https://a.example/", h) for k, h in rows], "page_id long, url string, html string")
    got = sorted(((r.page_id, r.name, r.confidence) for r in PP.named_pages(known).collect()), key=str)
    assert got == [(1, "Acme Motors", 0.95), (2, "Acme Site", 0.90), (3, "Acme &amp; Co", 0.78), (3, "Again", 0.78), (4, None, None), (5, None, None)]
