"""Column functions: keys, ids, hosts, names, places and scores."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import params

_EDGES = r"(?U)^\s+|\s+$"


def strip(c: Column) -> Column:
    """Without white space at either end; trim() would take spaces only."""
    return F.regexp_replace(c, F.lit(_EDGES), F.lit(""))


def norm_key(c: Column) -> Column:
    return F.lower(strip(c))


def is_blank(c: Column) -> Column:
    """Null or white space only."""
    return c.isNull() | (strip(c) == "")


def filled(c: Column) -> Column:
    """Null if blank, else as it is."""
    return F.when(~is_blank(c), c)


def stable_id(*parts: Column) -> Column:
    """Lower-case hex SHA-256 of the parts, joined by "|"; null if a part is null."""
    joined = parts[0] if len(parts) == 1 else F.concat(*[x for k, p in enumerate(parts) for x in ((F.lit("|"), p) if k else (p,))])
    return F.sha2(joined, 256)


def observed_at(last_seen: Column, created: Column, as_of: Column) -> Column:
    return F.coalesce(last_seen, created, as_of)


def once(value: Column, then: Callable[[Column], Column]) -> Column:
    """then(value), with the value worked out once however often ``then`` names it: Spark repeats it where it stands under a condition."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def any_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def alternation(words: Sequence[str]) -> str:
    """A pattern of any of the words, taken literally."""
    return "|".join(re.escape(w) for w in words)


def contains_any(c: Column, words: Sequence[str]) -> Column:
    """Whether the text contains one of the words: one scan."""
    return c.rlike(alternation(words))


def matches_any(c: Column, patterns: Sequence[str]) -> Column:
    """Whether one of the regular expressions is found, ignoring case: one alternation, one scan."""
    return c.rlike("(?i)" + "|".join(f"(?:{p})" for p in patterns))


def first_of(c: Column, words: Sequence[str]) -> Column:
    """The first word of the list that the text contains, else null."""
    return F.coalesce(*[F.when(F.contains(c, F.lit(w)), F.lit(w)) for w in words])


def host_of(url: Column) -> Column:
    """The host of a URL, or the value itself if it has no scheme: lower case, without www. and port."""
    plain = F.regexp_replace(norm_key(url), r"^[a-z][a-z0-9+.-]*://|[/?#].*$", "")
    return F.regexp_replace(F.regexp_replace(plain, r"^www\.", ""), r":.*$", "")


def netloc(url: Column) -> Column:
    """What stands between "//" and the path, as written."""
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)


def email_domain(email: Column) -> Column:
    return F.when(email.rlike("^[^@]+@[^@]+$"), F.lower(F.substring_index(email, "@", -1)))


def first_url(text: Column) -> Column:
    return F.regexp_extract(text, r"https?://[^\s]+", 0)


def display_name(full: Column, first: Column, last: Column) -> Column:
    given = F.concat(F.coalesce(first, F.lit("")), F.lit(" "), F.coalesce(last, F.lit("")))
    return strip(F.coalesce(filled(full), given))


def trim_name(name: Column, endings: Sequence[str] = params.NAME_ENDINGS) -> Column:
    """Without trailing title fragments; one word is always kept."""
    tidy = strip(F.regexp_replace(name, r"\s+", " "))
    return F.regexp_replace(tidy, rf"(\s(?:{'|'.join(endings)}))+$", "")


def split_name(name: Column) -> tuple[Column, Column]:
    """First and last word; the last is "" for one word."""
    words = F.split(strip(name), r"\s+")
    return F.element_at(words, 1), F.when(F.size(words) > 1, F.element_at(words, -1)).otherwise(F.lit(""))


def tidy_title(name: Column, tails: Sequence[str] = params.NAME_TAILS) -> Column:
    """An organisation's name from a page title: spaces collapsed, edges stripped, cut where a page word begins; may be empty."""
    tidy = F.btrim(F.regexp_replace(name, r"\s+", " "), F.lit(" |-:\t\r\n"))
    cut = F.regexp_replace(tidy, rf"(?i)\b(?:{'|'.join(sorted(tails, key=len, reverse=True))})\b.*$", "")
    return F.btrim(cut, F.lit(" |-:\t\r\n"))


def clean_title(name: Column, tails: Sequence[str] = params.NAME_TAILS) -> Column:
    """The same, null if empty."""
    return F.nullif(tidy_title(name, tails), F.lit(""))


def title_case(text: Column) -> Column:
    """A capital after everything that is no letter, as in Winston-Salem."""
    parts = F.regexp_extract_all(text, F.lit(r"\p{L}+|\P{L}+"), 0)
    return F.array_join(F.transform(parts, F.initcap), "")


def tidy_city(city: Column) -> Column:
    return title_case(F.btrim(F.regexp_replace(city, r"\s+", " "), F.lit(" ,")))


def clean_city(city: Column) -> Column:
    return F.nullif(tidy_city(city), F.lit(""))


def clean_state(state: Column, states: Sequence[str] = params.STATES) -> Column:
    code = F.upper(strip(state))
    return F.when(code.isin(*states), code)


def candidate_urls(website: Column, key: Column) -> Column:
    """Home pages to try, in order and once each: the stored URL, then https and http with and without www."""
    guesses = [F.concat(F.lit(p), key) for p in ("https://", "https://www.", "http://", "http://www.")]
    return F.array_distinct(F.array_compact(F.array(filled(website), *guesses)))


def target_url(website: Column, key: Column) -> Column:
    return F.when(~is_blank(website), strip(website)).otherwise(F.concat(F.lit("https://"), key))


def block_marker(html: Column, markers: Sequence[str] = params.BLOCK_MARKERS) -> Column:
    return first_of(F.lower(html), markers)


def page_usable(status: Column, html: Column, markers: Sequence[str] = params.BLOCK_MARKERS) -> Column:
    return F.coalesce(status.between(200, 399) & (F.length(html) > 0) & block_marker(html, markers).isNull(), F.lit(False))


def error_reason(message: Column) -> Column:
    lower = F.lower(message)
    return F.coalesce(*[F.when(F.contains(lower, F.lit(part)), F.lit(reason)) for part, reason in params.ERROR_REASONS], F.when(message.isNotNull(), F.lit(params.OTHER_ERROR)))


def contact_score(email: Column, name: Column, title: Column, url: Column) -> Column:
    """0.7, more for a full name, a title, a page with people and a personal address; 0.98 at most."""
    add = lambda condition, amount: F.when(condition, F.lit(amount)).otherwise(F.lit(0.0))
    score = F.lit(0.7) + add(F.size(F.split(strip(name), r"\s+")) >= 2, 0.1) + add(F.length(title) > 0, 0.1)
    score = score + add(contains_any(F.lower(url), ("staff", "team", "leadership")), 0.07)
    return F.least(score + add(~email.startswith("info@") & ~email.startswith("sales@"), 0.03), F.lit(0.98))


def cooldown_over(last: Column, attempts: Column, as_of: Column) -> Column:
    """Never tried, or the pause for that many attempts has passed."""
    n = F.coalesce(attempts, F.lit(0))
    hours = F.lit(params.LAST_COOLDOWN)
    for most, value in reversed(params.COOLDOWNS):
        hours = F.when(n <= most, F.lit(value)).otherwise(hours)
    return last.isNull() | (as_of >= last + F.make_dt_interval(hours=hours))


def same_site_domain(domain: Column, allowed: Column) -> Column:
    """Equal, or one is a sub-domain of the other."""
    bare = F.regexp_replace(F.lower(domain), r"^www\.", "")
    return (bare == allowed) | F.endswith(bare, F.concat(F.lit("."), allowed)) | F.endswith(allowed, F.concat(F.lit("."), bare))


def host_in(host: Column, hosts: Sequence[str]) -> Column:
    """A host of the list or a sub-domain of one."""
    return host.rlike(rf"(?:^|\.)(?:{alternation(hosts)})$")


def maker_host(host: Column) -> Column:
    """A maker's own site: a root host, any host of its sites, or a sub-domain where the maker runs those."""
    return host.isin(*params.OEM_ROOT_HOSTS) | host_in(host, params.OEM_SITES) | host.rlike(rf"(?:{alternation(params.OEM_SUFFIXES)})$")


def page_priority(text: Column) -> Column:
    rank = F.lit(len(params.PAGE_PRIORITIES))
    for k, words in reversed(list(enumerate(params.PAGE_PRIORITIES))):
        rank = F.when(contains_any(text, words), F.lit(k)).otherwise(rank)
    return rank


def role_of(text: Column) -> Column:
    """Struct(role_type, role_family, role_title) of the first role whose title is found, else null."""
    options = []
    for kind, family, titles in params.ROLES:
        pattern = rf"(?i)\b({titles})\b"
        title = F.regexp_extract(text, pattern, 1)
        options.append(F.when(text.rlike(pattern), F.struct(F.lit(kind).alias("role_type"), F.lit(family).alias("role_family"), title.alias("role_title"))))
    return F.coalesce(*options)


#: Fixed value: a name as the default finds it; WIDE_NAME also takes letters with accents.
PLAIN_NAME = r"\b([A-Z][a-z]+(?:\s+[A-Z][a-z]+){1,2})\b"
WIDE_NAME = r"(?U)\b(\p{Lu}\p{Ll}+(?:\s+\p{Lu}\p{Ll}+){1,2})\b"


def person_near(text: Column, email: Column, title: Column, pattern: str = PLAIN_NAME) -> Column:
    """The first name before the title that does not look like a title, without trailing fragments."""
    bare = F.replace(F.replace(text, email, F.lit(" ")), F.lit("Read my Bio"), F.lit(" "))
    at = F.instr(F.lower(bare), F.lower(title))
    cut = F.when(at > 1, F.substring(bare, F.lit(1), at - 1)).otherwise(bare)
    tidy = strip(F.regexp_replace(cut, r"\s+", " "))
    names = F.regexp_extract_all(tidy, F.lit(pattern), 1)
    good = F.filter(names, lambda n: ~contains_any(F.lower(n), params.TITLE_LIKE_WORDS))
    return trim_name(F.try_element_at(good, F.lit(1)))
