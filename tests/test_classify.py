"""Every rule and every explanation on evidence written by hand."""

import pytest
from pyspark.sql import functions as F

from rosterworks.functions import exprs as X
from rosterworks.operators import classify as C
from rosterworks.operators import merge as M
from rosterworks.operators import work as W

PLAIN = "https://plain.example"
RULES = [
    ("anything", "https://www.dealer.com/about", 1, "vendor", 0.96),
    ("anything", "https://shop.dealer.com", 1, "vendor", 0.96),
    ("anything", "https://audi.com", 2, "oem", 0.95),
    ("anything", "https://parts.ford.com", 2, "oem", 0.95),
    ("anything", "https://my.hondaweb.com", 2, "oem", 0.95),
    ("we are cox automotive", PLAIN, 3, "vendor", 0.92),
    ("family dental practice", PLAIN, 4, "non_dealer", 0.9),
    ("smith auto group at hondasales.com", PLAIN, 5, "dealer", 0.93),
    ("smith auto group account_key_brand_hint", PLAIN, 5, "dealer", 0.93),
    ("smith auto group new inventory", PLAIN, 6, "dealer_group", 0.92),
    ("find us at smithkiamotors.com", PLAIN, 7, "dealer", 0.9),
    ("find us at 1ford.com", PLAIN, 8, "dealer", 0.89),
    ("find us at audiofboise.com", PLAIN, 8, "dealer", 0.89),
    ("find us at hondaofboise.com", PLAIN, 9, "dealer", 0.86),
    ("blocked_site inventory_page_detected honda vehicle", PLAIN, 10, "dealer", 0.96),
    ("blocked_site inventory_page_detected motors vehicle", PLAIN, 11, "dealer", 0.93),
    ("inventory_page_detected honda vehicle", PLAIN, 12, "dealer", 0.95),
    ("inventory_page_detected motors vehicle", PLAIN, 13, "dealer", 0.91),
    ("we do vehicle wraps", PLAIN, 14, "vendor", 0.88),
    ("schedule service for your honda car", PLAIN, 15, "dealer", 0.93),
    ("schedule service for your car", PLAIN, 16, "dealer", 0.9),
    ("general motors head office", PLAIN, 23, "unknown", 0.45),
    ("ford motor company head office", PLAIN, 17, "oem", 0.88),
    ("ford truck finance", PLAIN, 18, "dealer", 0.84),
    ("nothing here", "https://acme-marketing.example", 19, "vendor", 0.82),
    ("dmv help for a dealership", PLAIN, 20, "vendor", 0.84),
    ("tint for windows", PLAIN, 21, "vendor", 0.82),
    ("nothing here", "https://homecare.example", 22, "non_dealer", 0.82),
    ("nothing here", PLAIN, 23, "unknown", 0.45),
]


def test_every_rule(spark):
    rows = [(k, text, url) for k, (text, url, *_) in enumerate(RULES)]
    frame = C.classified(C.signals(spark.createDataFrame(rows, "k int, evidence string, source_url string")))
    got = {r.k: (r.rule_id, r.classification, r.confidence) for r in frame.collect()}
    assert {k: got[k] for k in got} == {k: tuple(r[2:]) for k, r in enumerate(RULES)}
    assert {r[2] for r in RULES} == set(range(1, len(C.RULES) + 1))


#: Evidence and the place of its explanation.
TOLD = [
    ("see https://dealer.com/x now", 1), ("see https://toyota.com now", 2), ("auto group hondasales.com", 3), ("auto group new inventory", 4), ("cox automotive", 5),
    ("lift kits", 6), ("smithkiamotors.com", 7), ("1ford.com", 8), ("hondaofboise.com", 9), ("blocked_site inventory_page_detected honda", 10),
    ("blocked_site inventory_page_detected motors", 11), ("inventory_page_detected honda", 12), ("inventory_page_detected motors", 13), ("inventory_page_detected", 14),
    ("trade-in honda", 15), ("trade-in", 16), ("law firm", 17), ("toyota motor", 18), ("nothing", 19),
]


def test_every_explanation(spark):
    """The host is that of the first URL in the evidence, whatever the source URL is."""
    rows = [(k, text, "https://adesa.com") for k, (text, _) in enumerate(TOLD)]
    frame = C.summarized(C.signals(spark.createDataFrame(rows, "k int, evidence string, source_url string")))
    got = {r.k: r.evidence_summary for r in frame.collect()}
    assert got == {k: C.SUMMARIES[place - 1][1] for k, (_, place) in enumerate(TOLD)}
    assert {p for _, p in TOLD} == set(range(1, len(C.SUMMARIES) + 1))


@pytest.mark.parametrize(("host", "maker"), [("audi.com", True), ("parts.audi.com", False), ("ford.com", True), ("parts.ford.com", True), ("hondaweb.com", True), ("x.hondaweb.com", True), ("notford.com", False), ("fordxcom", False)])
def test_makers(spark, host, maker):
    assert spark.range(1).select(X.maker_host(F.lit(host)).alias("v")).first().v is maker


def test_wide_names(spark):
    text = spark.createDataFrame([("Émile Düfour, CEO",)], "t string")
    near = lambda p: text.select(X.person_near(F.col("t"), F.lit("x"), F.lit("CEO"), p).alias("v")).first().v
    assert near(X.WIDE_NAME) == "Émile Düfour" and near(X.PLAIN_NAME) is None


def test_web_provenance_stays(spark):
    old = spark.createDataFrame([("a", "website_enrichment"), ("b", "contact_master_normalization"), ("c", None)], "account_id string, source_type string")
    new = spark.createDataFrame([("a", "batch"), ("b", "batch"), ("c", "batch")], "account_id string, source_type string")
    merged = {r.account_id: r.source_type for r in M.merge_upsert(old, new, ["account_id"], {"source_type": M.keep_web}).collect()}
    assert merged == {"a": "website_enrichment", "b": "batch", "c": "batch"}
    forced = {r.account_id: r.source_type for r in M.merge_upsert(old, new, ["account_id"], {"source_type": M.overwrite}).collect()}
    assert set(forced.values()) == {"batch"}


def test_given_up_items(spark):
    items = spark.createDataFrame([(1, "in_progress", 5, None, None), (2, "in_progress", 1, None, None)], "work_item_id long, status string, attempt_count long, lease_expires_at timestamp_ntz, next_attempt_at timestamp_ntz")
    failed = spark.createDataFrame([(1, "x"), (2, "y")], "work_item_id long, error string")
    as_of = F.expr("TIMESTAMP_NTZ '2024-01-01 00:00:00'")
    assert {r.work_item_id: r.status for r in W.fail(items, failed, as_of, max_attempts=5).collect()} == {1: "failed", 2: "retry"}
    assert {r.status for r in W.fail(items, failed, as_of).collect()} == {"retry"}
