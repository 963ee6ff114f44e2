"""Page parses against a plain tree, word scans, host tables, keyword families by hand, range numbers, ledgers and previews."""

import random
import time

import pytest
from pyspark.sql import functions as F

from rosterworks import params
from rosterworks.operators import classify as C
from rosterworks.operators import enrich as E
from rosterworks.operators import pages as P
from rosterworks.operators import people as H
from rosterworks.operators import report as R
from rosterworks.operators import rollups as U

SILENT, VOID = {"script", "style"}, {"br", "meta", "img"}


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


# Parse -------------------------------------------------------------------------------------------


class Plain:
    """A tree that builds every text anew: slow, and easy to see through."""

    def __init__(self, events):
        self.root = now = {"tag": "", "parent": None, "parts": []}
        self.mails, self.links, self.texts = [], [], []
        for kind, value in events:
            if kind == "open":
                tag, href = value
                node = {"tag": tag, "parent": now, "parts": [], "href": href}
                now["parts"].append(node)
                if href:
                    self.links.append(node)
                if tag not in VOID:
                    now = node
            elif kind == "close":
                node = now
                while node is not None and node["tag"] != value:
                    node = node["parent"]
                if node is not None and node["parent"] is not None:
                    now = node["parent"]
            else:
                now["parts"].append(value)
                self.texts.append((now, value))

    def text(self, node):
        out = []
        for part in node["parts"]:
            if isinstance(part, str):
                out += [part.strip()] if part.strip() else []
            elif part["tag"] not in SILENT:
                out += [t for t in [self.text(part)] if t]
        return " ".join(out)

    def nearby(self, node, fallback):
        for _ in range(5):
            if node is None:
                break
            if len(self.text(node)) >= 40:
                return self.text(node)
            node = node["parent"]
        return fallback

    def contexts(self):
        found = {}
        for a in self.links:
            if a["href"].startswith("mailto:"):
                found[a["href"][7:].lower(), self.nearby(a["parent"], self.text(a))] = None
        for node, data in self.texts:
            for word in data.split():
                if "@" in word:
                    found[word.lower(), self.nearby(node, data.strip())] = None
                    break
        return list(found)


def made(draw):
    """Events of a random page, with unclosed and unknown tags, and its html."""
    events, html = [], []
    for _ in range(draw.randrange(5, 60)):
        what = draw.random()
        if what < 0.4:
            tag = draw.choice(["div", "p", "ul", "li", "b", "a", "br", "span"])
            href = draw.choice([f"mailto:M{draw.randrange(4)}@x.example", "/staff"]) if tag == "a" else ""
            events.append(("open", (tag, href)))
            html.append(f'<{tag} href="{href}">' if href else f"<{tag}>")
        elif what < 0.65:
            tag = draw.choice(["div", "p", "ul", "li", "b", "a", "u"])
            events.append(("close", tag))
            html.append(f"</{tag}>")
        elif not events or events[-1][0] != "text":
            text = draw.choice(["word", "two words ", " a longer run of words that is over forty characters ", f"p{draw.randrange(4)}@y.example", f"write to Q{draw.randrange(3)}@y.example now ", " \n "])
            events.append(("text", text))
            html.append(text)
    return events, "".join(html)


def test_parse_against_a_plain_tree():
    draw = random.Random(11)
    for _ in range(400):
        events, html = made(draw)
        tree, got = Plain(events), P.parse_page(html)
        assert got["text"] == tree.text(tree.root), html
        assert [(m["email"], m["context"]) for m in got["email_contexts"]] == tree.contexts(), html
        assert [(a["href"], a["text"]) for a in got["anchors"]] == [(n["href"], tree.text(n)) for n in tree.links], html


@pytest.mark.parametrize("row", ['<li>p{k}@x.example', "<li>p{k}@x.example</li></b>", '<tr><td>Jane</td><td><a href="mailto:p{k}@x.example">mail</a></td></tr>', "<p>info@x.example is the address of all of us here {k}</p>"])
def test_many_addresses_in_linear_time(row):
    began, sizes = time.perf_counter(), []
    for n in (1_000, 100_000):
        page = P.parse_spans("".join(row.format(k=k) for k in range(n)))
        sizes.append(len(page["email_contexts"]))
    assert sizes == [1_000, 100_000] and time.perf_counter() - began < 40


def test_contexts_of_equal_text_count_once():
    got = P.parse_page("<ul><li>same@x.example is an address with a long enough context</li><li>same@x.example is an address with a long enough context</li></ul>")
    assert len(got["email_contexts"]) == 1


@pytest.mark.parametrize(("text", "email"), [("x" * 300_000, None), ("a@b @c.de f@g.example h@i.example", "f@g.example"), ("." * 2000 + "ab@c.example", "ab@c.example"), ("%x@y.example", "x@y.example"), ("a" * 50_000 + "@b.example!", "a" * 50_000 + "@b.example"), ("a@b_c.d e@f.gh", "e@f.gh")])
def test_first_email(text, email):
    assert P.first_email(text) == email
    if len(text) < 10_000:
        match = P._EMAIL.search(text)
        assert (match and match[1]) == email


def test_foreign_addresses_are_dropped_before_contexts(spark):
    page = '<p>Jane Smith, General Manager, jane@acme.example and all the others</p><p>John Black, Sales Manager, john@other.example and all the others</p>'
    pages = spark.createDataFrame([(1, "https://acme.example/staff", page)], "page_id long, url string, html string")
    features = P.page_features(pages).withColumns({"account_key": F.lit("acme.example"), "page_ord": F.lit(0)})
    accounts = spark.createDataFrame([("acme.example", None)], "account_key string, website_url string")
    assert [(r.email, r.full_name) for r in H.page_candidates(features, accounts).collect()] == [("jane@acme.example", "Jane Smith")]


# Words and hosts ---------------------------------------------------------------------------------


def test_first_brand_of_the_list_by_one_scan(spark):
    draw, words = random.Random(2), list(params.BRANDS)
    pool = [*words, "mercedes-benz", "bmw's", "gmc-sierra", "fordham", "miniature", "x", "-", "vw/audi", "RAM", "é"]
    texts = [draw.choice([" ", "-", ", "]).join(draw.choice(pool) for _ in range(draw.randrange(6))) for _ in range(500)] + [None, ""]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    one = frame.select(E.brand_in(F.col("t")).alias("b"))
    each = frame.select(F.coalesce(*[F.when(F.lower("t").rlike(rf"\b{w}\b"), F.lit(n)) for w, n in params.BRANDS.items()]).alias("b"))
    assert [r.b for r in one.collect()] == [r.b for r in each.collect()]
    assert plan(one).lower().count("rlike") == 0 and plan(one).count("regexp_extract_all") == 1


def test_overlapping_words(spark):
    at = lambda text, *words: spark.createDataFrame([(text,)], "t string").select(E.least_word(F.col("t"), words).alias("k")).first().k
    assert at("a b c", "b c", "a b") == 0 and at("a b", "a b", "a") == 0 and at("a b", "a", "a b") == 0 and at("ab", "a") is None and at("b a", "a", "b") == 0


def test_table_of_a_million_hosts(spark):
    hosts = spark.range(1_000_000).select(F.concat(F.lit("shop"), "id", F.lit(".example")).alias("host"))
    rows = [("shop7.example", True), ("parts.shop7.example", True), ("a.b.shop999999.example", True), ("notshop7.example", False), ("shop1000000.example", False), ("example", False), ("", False), (None, False), ("SHOP7.example", True)]
    got = P.in_host_table(spark.createDataFrame([(h,) for h, _ in rows], "h string"), F.col("h"), hosts, "listed")
    assert sorted((r.h or "", r.listed) for r in got.collect()) == sorted((h or "", v) for h, v in rows)
    assert "rlike" not in plan(got).lower()


#: Evidence and every family that it belongs to, written by hand.
FAMILIES = [
    ("reynolds & reynolds partner", {"vendor"}),
    ("a wholesale auction", {"vendor"}),
    ("f&i selling system", {"vendor"}),
    ("truck bodies since 1950", {"vendor", "context"}),
    ("trucks and auctions", {"vendor", "context"}),
    ("auctioneer", set()),
    ("ui/ux for you", {"non_dealer"}),
    ("official website of the university", {"non_dealer"}),
    ("cloudy days", set()),
    ("window tinting", {"industry"}),
    ("wheel and tires", {"industry"}),
    ("style & performance", {"industry"}),
    ("smith auto group", {"group_words", "context", "independent"}),
    ("big motors group", {"group_words", "independent"}),
    ("autoplex", {"group_words", "independent"}),
    ("oil change", {"dealer_words"}),
    ("used vehicles", {"dealer_words", "context", "independent"}),
    ("trade-in", {"dealer_words"}),
    ("general motors", {"oem_words", "independent"}),
    ("nissan motor", {"oem_words", "brand"}),
    ("suvs", {"context"}),
    ("carpet", set()),
    ("pre-owned", {"context"}),
    ("toyota2 corolla", {"brand"}),
    ("2toyota corolla", {"brand"}),
    ("toyotas", set()),
    ("mercedes-benz", {"brand"}),
    ("administration", set()),
    ("usedby", set()),
    ("sales", {"independent"}),
]


def test_families_by_hand(spark):
    names = ("vendor", "non_dealer", "group_words", "dealer_words", "industry", "oem_words", "context", "brand", "independent")
    frame = C.signals(spark.createDataFrame([(k, t, "") for k, (t, _) in enumerate(FAMILIES)], "k int, evidence string, source_url string"))
    got = {r.k: {n for n in names if r[n]} for r in frame.collect()}
    assert {FAMILIES[k][0]: v for k, v in got.items()} == dict(FAMILIES)
    assert set().union(*(f for _, f in FAMILIES)) == set(names)


@pytest.mark.parametrize(("host", "listed"), [("dealer.com", True), ("x.dealer.com", True), ("notdealer.com", False), ("dealer.com.example", False), ("activator.ai", True), ("autonation.com", True)])
def test_vendor_hosts_by_hand(spark, host, listed):
    assert C.signals(spark.createDataFrame([("", f"https://{host}/")], "evidence string, source_url string")).first().vendor_host is listed


# Reports -----------------------------------------------------------------------------------------


def test_numbers_with_one_common_beginning(spark):
    rows = spark.range(20_000).select(F.concat(F.lit("info@"), F.lpad((F.col("id") * 7919 % 20_000).cast("string"), 6, "0")).alias("email"), "id")
    frame = R.numbered(rows.unionByName(rows.where("id < 50").withColumn("id", -F.col("id") - 1)), "email", "n")
    got = sorted((r.n, r.email) for r in frame.collect())
    assert [n for n, _ in got] == list(range(20_050)) and [e for _, e in got] == sorted(e for _, e in got)
    assert "substr" not in plan(frame)


def test_empty_tables_have_no_numbers(spark):
    assert R.numbered(spark.createDataFrame([], "email string"), "email", "n").count() == 0


def audience(spark, n=30):
    return spark.createDataFrame([(f"p{k}@x.example", f"B{k % 3}", f"N{k % 5}" if k % 4 else None) for k in range(n)], "email string, inferred_brand string, account_name string")


def test_ledger_makes_calls_disjoint(spark):
    rows, now = audience(spark), F.expr("TIMESTAMP '2020-01-01'")
    ledger = spark.createDataFrame([], "target_system string, source_record_type string, source_record_id string, sync_status string, last_synced_at timestamp, updated_at timestamp")
    order = [(r.inferred_brand, r.account_name, r.email) for r in rows.orderBy("inferred_brand", F.col("account_name").asc_nulls_first(), "email").collect()]
    sent, last = [], None
    for _ in range(4):
        batch = R.next_audience(rows, ledger, 8, "mail")
        ahead = R.next_audience(rows, ledger, 8, "mail", last) if last else batch
        got = [(r.inferred_brand, r.account_name, r.email) for r in batch.collect()]
        assert got == [(r.inferred_brand, r.account_name, r.email) for r in ahead.collect()]
        sent, last = sent + got, got[-1]
        keys = spark.createDataFrame([(f" {e.upper()}",) for _, _, e in got], "email string")
        ledger = spark.createDataFrame(ledger.unionByName(R.sent_rows(keys, "mail", "synced", now)).collect(), ledger.schema)
    assert sent == order
    assert R.next_audience(rows, ledger, 8, "mail").count() == 0 and R.next_audience(rows, ledger, 8, "other").count() == 8


def test_failed_rows_are_sent_again(spark):
    rows, now = audience(spark, 4), F.expr("TIMESTAMP '2020-01-01'")
    ledger = R.sent_rows(rows.where("email = 'p0@x.example'"), "mail", "failed", now).unionByName(R.sent_rows(rows.where("email = 'p1@x.example'"), "mail", "synced", now))
    assert {r.email for r in R.next_audience(rows, ledger, 9, "mail").collect()} == {"p0@x.example", "p2@x.example", "p3@x.example"}


def test_preview_multiplies_no_rows(spark):
    rows = [("A.example ", "x@a.example", True), ("a.example", "X@A.example", False), (None, "y@b.example", None), ("  ", None, True), ("c.example", "z@c.example", True), ("c.example", "z@c.example", True)]
    raw = spark.createDataFrame(rows, "account_key string, email string, is_personal_email boolean")
    frame = U.source_preview(raw)
    assert "Expand" not in plan(frame)
    got = frame.first().asDict()
    assert got == {"rows": 6, "raw_accounts": 4, "raw_emails": 4, "accounts": 2, "emails": 3, "personal_emails": 2, "rows_without_account": 2}
    assert tuple(U.source_preview(raw.where("false")).first()) == (0,) * 7
