"""Validation of accounts from raw pages: which page speaks for an account, what it says, and the class that follows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import params
from ..functions.exprs import block_marker, candidate_urls, netloc, page_usable
from .classify import classified, evidence, signals, summarized
from .pages import absolute, inventory_probe, page_features, vehicle_link

REFUSED = 403


def bare_url(url: Column) -> Column:
    """A URL as it is compared: without slashes at its end."""
    return F.regexp_replace(url, "/+$", "")


def visits(pages: DataFrame) -> DataFrame:
    """pages (page_id, url, status_code, final_url, html) with what each visit came to: bare, parsed, usable, marker.

    A page without status_code counts as 200, one without final_url as not moved; one without html was resolved, not read.
    """
    known = pages.withColumns({"status_code": F.coalesce("status_code", F.lit(200)), "final_url": F.coalesce("final_url", "url")})
    return known.withColumns({"bare": bare_url(F.col("url")), "parsed": F.coalesce(F.length("html") > 0, F.lit(False)), "usable": page_usable(F.col("status_code"), F.col("html")), "marker": block_marker(F.col("html"))})


def home_visits(accounts: DataFrame, seen: DataFrame) -> DataFrame:
    """account_key, page_id, source_url, status_code, usable: the page of an account's candidate URLs that speaks for it.

    In the order of the URLs the first usable page counts, else the first that was read at all, else (without page_id)
    the first that was resolved; an account that was not met has its first URL and nothing else. One join and one aggregate: the
    place of the URL travels in the key of the minimum.
    """
    tries = accounts.select("account_key", F.posexplode(candidate_urls(F.col("website_url"), F.col("account_key"))).alias("pos", "tried"))
    met = tries.withColumn("bare", bare_url(F.col("tried"))).join(seen.select("bare", "page_id", "status_code", "final_url", "parsed", "usable"), "bare", "left")
    of = F.struct("page_id", "final_url", "status_code", "usable")
    page = F.min_by(of, F.when(F.col("parsed"), F.struct(~F.col("usable"), F.col("pos"), F.col("page_id")))).alias("page")
    resolved = F.min_by(of, F.when(F.col("page_id").isNotNull(), F.struct("pos", "page_id"))).alias("resolved")
    chosen = met.groupBy("account_key").agg(page, resolved, F.min_by("tried", "pos").alias("first"))
    return chosen.select(
        "account_key",
        F.col("page.page_id").alias("page_id"),
        F.coalesce("page.final_url", "resolved.final_url", "first").alias("source_url"),
        F.coalesce("page.status_code", "resolved.status_code").alias("status_code"),
        F.coalesce("page.usable", F.lit(False)).alias("usable"),
    )


def stock_link(anchors: Column, base: Column) -> Column:
    """Whether a link of the page, on its own site, leads to vehicles in stock."""
    own = lambda a: netloc(absolute(base, a["href"])).isin("", netloc(base))
    return F.exists(anchors, lambda a: vehicle_link(F.lower(F.concat_ws(" ", a["href"], a["text"]))) & own(a))


def home_evidence(homes: DataFrame, seen: DataFrame, features: DataFrame) -> DataFrame:
    """account_key, source_url, text, inventory_link, refused_page, page_id, usable of accounts' home visits.

    features: parsed pages (page_id and what :func:`~rosterworks.operators.pages.page_features` gives). Stock counts where a link of the
    page leads to it or, for accounts whose key or URL is of the trade, where one of the known paths of the site was met.
    """
    told = features.select("page_id", F.concat_ws(" ", "title", "meta_description", "og_site_name", "text").alias("text"), "anchors")
    both = homes.join(told, "page_id", "left")
    wanted = homes.select("account_key", "source_url", F.explode(F.array(*[F.lit(p) for p in params.INVENTORY_PATHS])).alias("path"))
    wanted = wanted.withColumn("bare", bare_url(F.concat(bare_url(F.col("source_url")), F.col("path"))))
    met = wanted.join(seen.select("bare", "status_code", "final_url"), "bare")
    stock = inventory_probe(homes.select("account_key", "source_url"), met.select("account_key", "path", "status_code", "final_url")).select("account_key", F.lit(True).alias("probed"))
    found = F.coalesce(stock_link(F.col("anchors"), F.col("source_url")), F.lit(False)) | F.coalesce("probed", F.lit(False))
    return both.join(stock, "account_key", "left").select("account_key", "page_id", "source_url", F.coalesce("text", F.lit("")).alias("text"), found.alias("inventory_link"), F.coalesce(F.col("status_code") == REFUSED, F.lit(False)).alias("refused_page"), "usable")


def judged(accounts: DataFrame, told: DataFrame) -> DataFrame:
    """account_key, source_url, rule_id, classification, confidence, evidence_summary of accounts with their home evidence."""
    both = accounts.select("account_key", "account_name", "inferred_brand").join(told, "account_key")
    said = evidence(*[F.col(c) for c in ("account_key", "account_name", "inferred_brand", "source_url", "text", "inventory_link", "refused_page")])
    ruled = summarized(classified(signals(both.withColumn("evidence", said))))
    return ruled.select("account_key", "source_url", "rule_id", "classification", "confidence", "evidence_summary")


def validate(accounts: DataFrame, pages: DataFrame) -> DataFrame:
    """Class, score, rule and explanation of accounts (account_key, account_name, inferred_brand, website_url) from raw pages.

    Only the page chosen for each account is parsed, and each such page once.
    """
    seen = visits(pages)
    homes = home_visits(accounts, seen)
    chosen = seen.join(homes.where("page_id IS NOT NULL").select("page_id").distinct(), "page_id", "left_semi")
    return judged(accounts, home_evidence(homes, seen, page_features(chosen)))
