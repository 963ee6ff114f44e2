"""Names, brands and places of accounts from their pages, with a confidence for each."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import params
from ..functions.exprs import clean_state, once, tidy_city, tidy_title


def _valued(value: Column, confidence: float) -> Column:
    return once(value, lambda v: F.when(F.length(v) > 0, F.struct(v.alias("value"), F.lit(confidence).alias("confidence"))))


def _json(texts: Column) -> Column:
    """All top-level objects of the JSON texts, as JSON; broken texts are skipped."""
    one = lambda t: F.when(F.ltrim(t).startswith("["), F.from_json(t, "array<string>")).otherwise(F.array(t))
    return F.flatten(F.transform(F.filter(texts, lambda t: F.try_parse_json(t).isNotNull()), lambda t: F.coalesce(one(t), F.array().cast("array<string>"))))


def json_name(texts: Column) -> Column:
    """The first string ``name`` of a top-level object."""
    names = F.transform(_json(texts), lambda t: F.when(F.schema_of_variant(F.try_variant_get(F.try_parse_json(t), "$.name", "variant")) == "STRING", F.get_json_object(t, "$.name")))
    return F.try_element_at(F.filter(names, lambda n: F.length(F.trim(n)) > 0), F.lit(1))


def json_place(texts: Column) -> Column:
    """Struct(city, state) of the first address with both."""
    places = F.transform(_json(texts), lambda t: F.struct(F.get_json_object(t, "$.address.addressLocality").alias("city"), F.get_json_object(t, "$.address.addressRegion").alias("state")))
    return F.try_element_at(F.filter(places, lambda p: (F.length(p["city"]) > 0) & (F.length(p["state"]) > 0)), F.lit(1))


def page_name(json_ld: Column, site_name: Column, title: Column) -> Column:
    """Struct(value, confidence): structured data, then the site's name, then the title."""
    return F.coalesce(_valued(tidy_title(json_name(json_ld)), 0.95), _valued(tidy_title(site_name), 0.90), _valued(tidy_title(title), 0.78))


def least_word(text: Column, words: Sequence[str]) -> Column:
    """The place in the list (from 0) of the first listed word that stands in the text; null if none does.

    One scan meets every word, also those that overlap: the pattern looks ahead without moving, at each place for the longest
    word. A shorter one that the longest begins with stands there too, so a hit counts as the least of these.
    """
    begins = lambda short, word: word == short or re.match(rf"{re.escape(short)}\b", word)
    least = {w: min(k for k, short in enumerate(words) if begins(short, w)) for w in words}
    longest = "|".join(re.escape(w) for w in sorted(words, key=len, reverse=True))
    hits = F.regexp_extract_all(text, F.lit(rf"\b(?=({longest})\b)"), F.lit(1))
    ranks = F.create_map(*[F.lit(x) for pair in least.items() for x in pair])
    return F.array_min(F.transform(hits, lambda w: F.element_at(ranks, w)))


def brand_in(text: Column, brands: dict[str, str] = params.BRANDS) -> Column:
    """The first brand of the list whose word is in the text: one scan."""
    return F.get(F.array(*map(F.lit, brands.values())), least_word(F.lower(text), list(brands)))


def page_brand(name: Column, title: Column, site_name: Column, description: Column, url: Column) -> Column:
    """Struct(value, confidence) by the first text that names a brand, in this order."""
    texts = ((name, 0.98), (title, 0.90), (site_name, 0.94), (description, 0.72), (url, 0.68))
    return F.coalesce(*[_valued(brand_in(text), score) for text, score in texts])


def page_place(json_ld: Column, html: Column) -> Column:
    """Struct(city, state, confidence): structured data, else the first "City, ST" in the page."""
    pattern = rf"\b[A-Z][A-Za-z.\- ]+?,\s*(?:{'|'.join(params.STATES)})\b"

    def place(city: Column, state: Column, score: float) -> Column:
        """Null unless both are left."""
        tidy = F.struct(tidy_city(city).alias("city"), clean_state(state).alias("state"), F.lit(score).alias("confidence"))
        return once(tidy, lambda p: F.when((F.length(p["city"]) > 0) & p["state"].isNotNull(), p))

    told = once(json_place(json_ld), lambda p: place(p["city"], p["state"], 0.95))
    # A city has no comma.
    read = once(F.regexp_extract(html, pattern, 0), lambda hit: F.when(hit != "", place(F.substring_index(hit, ",", 1), F.regexp_extract(hit, r",\s*(.*)$", 1), 0.72)))
    return F.coalesce(told, read)


def best_values(pages: DataFrame) -> DataFrame:
    """Per account the best name, brand and place of its pages, each with its page; the first page wins ties.

    pages: account_key, page_ord, url, name, brand (structs value, confidence), place (city, state, confidence).
    """
    best = lambda c: F.max_by(F.struct(F.col(c).alias("v"), F.col("url").alias("url")), F.when(F.col(c).isNotNull(), F.struct(F.col(f"{c}.confidence"), -F.col("page_ord")))).alias(c)
    return pages.groupBy("account_key").agg(best("name"), best("brand"), best("place")).select(
        "account_key",
        F.col("name.v.value").alias("account_name"), F.col("name.v.confidence").alias("name_confidence"), F.col("name.url").alias("name_source_url"),
        F.col("brand.v.value").alias("inferred_brand"), F.col("brand.v.confidence").alias("brand_confidence"),
        F.col("place.v.city").alias("account_city"), F.col("place.v.state").alias("account_state"), F.col("place.v.confidence").alias("location_confidence"),
    )


def apply_enrichment(accounts: DataFrame, found: DataFrame, home: DataFrame | None = None) -> DataFrame:
    """accounts with each found field put in if it is at least as sure as the stored one; the row's
    confidence never falls.

    ``home`` (account_key, website_url, website_confidence_score) gives the home pages that were
    met: they become the website and its source, with the higher of both confidences. Without it, found may hold
    these two columns itself, so that what it is made from is worked out once.
    """
    fields = {"account_name": "name_confidence", "inferred_brand": "brand_confidence", "account_city": "location_confidence", "account_state": "location_confidence"}
    scores = list(dict.fromkeys(fields.values()))
    site = "website_confidence_score"
    homed = home is None and {"website_url", site} <= set(found.columns)
    put = found.select("account_key", F.struct(*fields, *scores).alias("n"), *([F.struct("website_url", site).alias("h")] if homed else []))
    # Spark's estimate of parsed pages is that of the narrow table they were made from: a broadcast would hold all values.
    joined = accounts.join(put.hint("merge"), "account_key", "left")
    gate = lambda score: F.coalesce(F.col(f"n.{score}") >= F.coalesce(F.col(score), F.lit(0.0)), F.lit(False))
    changed = {c: F.when(gate(s), F.coalesce(F.col(f"n.{c}"), F.col(c))).otherwise(F.col(c)) for c, s in fields.items()}
    changed |= {s: F.greatest(F.col(s), F.col(f"n.{s}")) for s in scores}
    sure = [F.col("confidence_score"), *[F.col(f"n.{s}") for s in scores]]
    if home is not None:
        joined = joined.join(home.select("account_key", F.struct("website_url", site).alias("h")).hint("merge"), "account_key", "left")
    if home is not None or homed:
        met = F.col("h.website_url").isNotNull()
        changed |= {c: F.when(met, F.col("h.website_url")).otherwise(F.col(c)) for c in ("website_url", "website_source_url")}
        changed[site] = F.greatest(F.col(site), F.col(f"h.{site}"))
        changed["source_type"] = F.when(met, "website_enrichment").otherwise(F.col("source_type"))
        sure.append(F.col(f"h.{site}"))
    changed["confidence_score"] = F.greatest(*sure)
    return joined.select(*[changed.get(c, F.col(c)).alias(c) for c in accounts.columns])
