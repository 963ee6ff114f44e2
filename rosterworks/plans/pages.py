"""Queries over pages and texts: features, links, people, classification and enrichment."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import params
from ..functions import exprs as X
from ..operators import classify as C
from ..operators import enrich as E
from ..operators import merge as M
from ..operators import pages as P
from ..operators import people as H
from ..sources.tables import read_table
from ..sources.views import view
from .base import NOW, now, query
from .work import accounts

HOST = "regexp_replace(regexp_replace(regexp_replace(lower(trim({c})), '^[a-z][a-z0-9+.-]*://|[/?#].*$', '', 'g'), '^www\\.', ''), ':.*$', '')".format
TITLE = "regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)"
BARE = "trim(regexp_replace(regexp_replace(html, '(?is)<script\\b.*?</script>|<style\\b.*?</style>|<!--.*?-->|<[^>]*>', ' ', 'g'), '\\s+', ' ', 'g'))"
NETLOC = "regexp_extract({c}, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)".format
LINKS = """SELECT page_id, url, CAST(generate_subscripts(found, 1) - 1 AS INTEGER) AS pos, unnest(regexp_extract_all(array_to_string(found, ''), 'href="([^"]*)"', 1)) AS href,
 unnest(regexp_extract_all(array_to_string(found, ''), '">([^<]*)</a>', 1)) AS text FROM (SELECT page_id, url, regexp_extract_all(html, '<a href="[^"]*">[^<]*</a>') AS found FROM pages) x"""


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def has_any(c: str, words) -> str:
    return "(" + " OR ".join(f"contains({c}, {quoted(w)})" for w in words) + ")"


def pages(spark, root):
    return read_table(spark, root, "pages")


def links(spark, root):
    return pages(spark, root).select("page_id", "url", F.posexplode(P.hrefs(F.col("html")))).select("page_id", "url", "pos", "col.href", "col.text")


@query("page_rows", "SELECT page_id, url, status_code, final_url FROM page_rows_v WHERE html IS NOT NULL")
def pages_scan(spark, root):
    return view(spark, root, "page_rows").where("html IS NOT NULL").select("page_id", "url", "status_code", "final_url")


@query("", f"SELECT page_id, {HOST(c='url')} AS host FROM pages")
def page_hosts(spark, root):
    return pages(spark, root).select("page_id", X.host_of(F.col("url")).alias("host"))


@query("", f"SELECT page_id, {TITLE} AS title FROM pages")
def page_titles(spark, root):
    return pages(spark, root).select("page_id", P.raw_title(F.col("html")).alias("title"))


@query("", f"SELECT page_id, CAST(length(t) AS BIGINT) AS chars, CAST(len(string_split(t, ' ')) AS BIGINT) AS words FROM (SELECT page_id, {BARE} AS t FROM pages) x")
def page_text_stats(spark, root):
    bare = pages(spark, root).select("page_id", P.bare_text(F.col("html")).alias("t"))
    return bare.select("page_id", F.length("t").cast("long").alias("chars"), F.size(F.split("t", " ")).cast("long").alias("words"))


@query("", f"SELECT page_id, pos, href, {NETLOC(c='url')} AS host FROM ({LINKS}) l WHERE starts_with(href, '/')")
def page_links(spark, root):
    return P.same_site_links(links(spark, root)).select("page_id", "pos", "href", P.netloc(F.col("target")).alias("host"))


@query("", f"SELECT page_id, bool_or({has_any('t', params.INVENTORY_HINTS)} AND {has_any('t', params.VEHICLE_WORDS)} AND NOT {has_any('t', params.NOT_VEHICLE_WORDS)}) AS signal FROM (SELECT page_id, lower(href || ' ' || text) AS t FROM ({LINKS}) l) x GROUP BY page_id")
def link_signal(spark, root):
    return links(spark, root).groupBy("page_id").agg(F.bool_or(P.vehicle_link(F.lower(F.concat_ws(" ", "href", "text")))).alias("signal"))


MARKER = "CASE " + " ".join(f"WHEN contains(lower(html), {quoted(m)}) THEN {quoted(m)}" for m in params.BLOCK_MARKERS) + " END"


@query("", f"SELECT page_id, {MARKER} AS marker FROM pages")
def block_marker(spark, root):
    return pages(spark, root).select("page_id", X.block_marker(F.col("html")).alias("marker"))


@query("page_rows", f"SELECT page_id, status_code BETWEEN 200 AND 399 AND length(html) > 0 AND ({MARKER}) IS NULL AS usable FROM page_rows_v")
def page_usable(spark, root):
    return view(spark, root, "page_rows").select("page_id", X.page_usable(F.col("status_code"), F.col("html")).alias("usable"))


@query("", "SELECT doc_id, regexp_extract(text, 'https?://[^\\s]+', 0) AS first FROM documents")
def first_url(spark, root):
    return read_table(spark, root, "documents").select("doc_id", X.first_url(F.col("text")).alias("first"))


CLEAN = "nullif(trim(regexp_replace(trim(regexp_replace({c}, '\\s+', ' ', 'g'), ' |-:\t\r\n'), '(?i)\\b(?:New Vehicles|Used Vehicles|Homepage|Service|Parts|Home)\\b.*$', ''), ' |-:\t\r\n'), '')".format


@query("", f"SELECT page_id, {CLEAN(c=TITLE)} AS name FROM pages")
def clean_title(spark, root):
    return pages(spark, root).select("page_id", X.clean_title(P.raw_title(F.col("html"))).alias("name"))


@query("", f"SELECT page_id, {CLEAN(c=TITLE)} AS name, CASE WHEN {CLEAN(c=TITLE)} IS NOT NULL THEN CAST(0.78 AS DOUBLE) END AS confidence FROM pages")
def page_names(spark, root):
    """The SQL knows titles alone: equal as long as no page has JSON-LD or a site name."""
    return named_pages(pages(spark, root))


def named_pages(known):
    seen = P.page_features(known.withColumn("raw", P.raw_title(F.col("html"))), ("raw",))
    named = seen.select("page_id", E.page_name(F.col("json_ld"), F.col("og_site_name"), F.col("raw")).alias("n"))
    return named.select("page_id", F.col("n.value").alias("name"), F.col("n.confidence").alias("confidence"))


STATES = ", ".join(quoted(s) for s in params.STATES)
TITLE_CASE = "array_to_string(list_transform(string_split(lower({c}), ' '), lambda w: upper(w[1]) || w[2:]), ' ')".format


@query("", f"SELECT n_nationkey, {TITLE_CASE(c='n_name')} AS city FROM nation")
def city_titlecase(spark, root):
    return read_table(spark, root, "nation").select("n_nationkey", X.clean_city(F.lower("n_name")).alias("city"))


@query("", f"SELECT n_nationkey, CASE WHEN substr(n_name, 1, 2) IN ({STATES}) THEN substr(n_name, 1, 2) END AS state FROM nation")
def state_valid(spark, root):
    return read_table(spark, root, "nation").select("n_nationkey", X.clean_state(F.concat(F.lit(" "), F.lower(F.substring("n_name", 1, 2)))).alias("state"))


MAKER = "({h} IN ('audi.com', 'ford.com', 'toyota.com', 'honda.com', 'chevrolet.com', 'nissanusa.com', 'hondaweb.com') OR regexp_matches({h}, '[.](hondaweb|ford|toyota|honda|chevrolet|nissanusa)[.]com$'))".format


@query("account_pages", f"SELECT account_key, h = 'dealer.com' OR ends_with(h, '.dealer.com') OR h = 'adesa.com' OR ends_with(h, '.adesa.com') AS listed, {MAKER(h='h')} AS maker FROM (SELECT account_key, {HOST(c='source_url')} AS h FROM account_pages_v) x")
def host_list_match(spark, root):
    host = X.host_of(F.col("source_url"))
    return view(spark, root, "account_pages").select("account_key", X.host_in(host, ("dealer.com", "adesa.com")).alias("listed"), X.maker_host(host).alias("maker"))


HOST_TABLE = "SELECT 'dealer.com' AS host UNION ALL SELECT 'ford.com' UNION ALL SELECT 'acct' || c_custkey || '.example.net' FROM customer WHERE c_custkey % 7 = 0"


@query("account_pages", f"SELECT account_key, source_url, EXISTS (SELECT 1 FROM ({HOST_TABLE}) t WHERE h = t.host OR ends_with(h, '.' || t.host)) AS listed FROM (SELECT *, {HOST(c='source_url')} AS h FROM account_pages_v) x")
def host_table_match(spark, root):
    known = read_table(spark, root, "customer").where("c_custkey % 7 = 0").select(F.concat(F.lit("acct"), F.col("c_custkey").cast("string"), F.lit(".example.net")).alias("host"))
    hosts = known.unionByName(spark.createDataFrame([("dealer.com",), ("ford.com",)], "host string"))
    seen = view(spark, root, "account_pages").select("account_key", "source_url")
    return P.in_host_table(seen, X.host_of(F.col("source_url")), hosts, "listed")


@query("", "SELECT doc_id, unnest(regexp_extract_all(text, '(?i)\\b[A-Z0-9._%+\\-]+@[A-Z0-9.\\-]+\\.[A-Z]{2,}\\b')) AS email FROM documents")
def email_scan(spark, root):
    pattern = r"(?i)\b[A-Z0-9._%+\-]+@[A-Z0-9.\-]+\.[A-Z]{2,}\b"
    return read_table(spark, root, "documents").select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(pattern), 0)).alias("email"))


def people(spark, root):
    """Sentences with a name, a title and an address."""
    return view(spark, root, "people").withColumn("context", F.concat_ws(" ", "person", "title", "email"))


ROLE = "CASE " + " ".join(f"WHEN regexp_matches(context, '(?i)\\b({t})\\b') THEN {{v{k}}}" for k, (_, _, t) in enumerate(params.ROLES)) + " END"
ROLE_TYPE = ROLE.format(**{f"v{k}": quoted(r[0]) for k, r in enumerate(params.ROLES)})
ROLE_FAMILY = ROLE.format(**{f"v{k}": quoted(r[1]) for k, r in enumerate(params.ROLES)})
ROLE_TITLE = ROLE.format(**{f"v{k}": f"regexp_extract(context, '(?i)\\b({r[2]})\\b', 1)" for k, r in enumerate(params.ROLES)})
CONTEXT = "(SELECT *, person || ' ' || title || ' ' || email AS context FROM people_v) c"


@query("people", f"SELECT event_id, {ROLE_TYPE} AS role_type, {ROLE_FAMILY} AS role_family, {ROLE_TITLE} AS role_title FROM {CONTEXT}")
def role_classify(spark, root):
    return people(spark, root).select("event_id", X.role_of(F.col("context")).alias("r")).select("event_id", "r.*")


@query("people", f"SELECT event_id, person FROM {CONTEXT} WHERE title <> 'Receptionist'")
def person_names(spark, root):
    named = people(spark, root).withColumn("role", X.role_of(F.col("context"))).where("role IS NOT NULL")
    return named.select("event_id", X.person_near(F.col("context"), F.col("email"), F.col("role.role_title")).alias("person"))


SCORE = "least(CAST(0.7 AS DOUBLE) + CAST(0.1 AS DOUBLE) + CAST(0.1 AS DOUBLE) + CASE WHEN contains(url, 'staff') THEN CAST(0.07 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END + CASE WHEN starts_with(email, 'info@') THEN CAST(0 AS DOUBLE) ELSE CAST(0.03 AS DOUBLE) END, CAST(0.98 AS DOUBLE))"


@query("people", f"SELECT event_id, {SCORE} AS score FROM people_v")
def contact_score(spark, root):
    return people(spark, root).select("event_id", X.contact_score(F.col("email"), F.col("person"), F.col("title"), F.col("url")).alias("score"))


def candidates(spark, root):
    seen = people(spark, root)
    features = seen.select("account_key", F.col("event_id").alias("page_ord"), "url", F.array(F.struct(F.lit(0).alias("pos"), "email", "context")).alias("email_contexts"))
    known = seen.select("account_key").distinct().withColumn("website_url", F.lit(None).cast("string"))
    return H.page_candidates(features, known)


BEST = f"""SELECT account_key, email, person, role_type, role_family, url, event_id, score FROM (
 SELECT *, row_number() OVER (PARTITION BY account_key, email ORDER BY score DESC, event_id) AS rn FROM (SELECT *, {ROLE_TYPE} AS role_type, {ROLE_FAMILY} AS role_family, {SCORE} AS score FROM {CONTEXT}) s WHERE role_type IS NOT NULL) b WHERE rn = 1"""


@query("people", f"SELECT account_key, email, person AS full_name, role_type, role_family, url AS source_url, score AS confidence_score FROM ({BEST}) x")
def candidate_dedup(spark, root):
    return H.best_candidates(candidates(spark, root)).select("account_key", "email", "full_name", "role_type", "role_family", "source_url", "confidence_score")


CHOSEN = f"SELECT *, row_number() OVER (PARTITION BY email ORDER BY score DESC, account_key DESC, event_id DESC) AS pick FROM ({BEST}) x"


@query(
    "people",
    f"""SELECT coalesce(t.contact_id, n.contact_id) AS contact_id, CASE WHEN n.score >= coalesce(t.confidence_score, 0) THEN n.person ELSE coalesce(t.full_name, n.person) END AS full_name,
 CASE WHEN n.score >= coalesce(t.confidence_score, 0) THEN n.role_type ELSE n.role_type END AS role_type,
 CASE WHEN n.contact_id IS NULL OR lower(t.contact_status) IN ('suppressed', 'invalid') THEN t.contact_status ELSE 'active' END AS contact_status, greatest(t.confidence_score, n.score) AS confidence_score
 FROM (SELECT sha256(email) AS contact_id, 'Known Person' AS full_name, CASE WHEN max(event_id) % 3 = 0 THEN 'suppressed' ELSE 'new' END AS contact_status, CASE WHEN max(event_id) % 2 = 0 THEN CAST(0.5 AS DOUBLE) ELSE CAST(0.99 AS DOUBLE) END AS confidence_score FROM people_v WHERE event_id % 5 = 0 GROUP BY email) t
 FULL OUTER JOIN (SELECT sha256(email) AS contact_id, * FROM ({CHOSEN}) c WHERE pick = 1) n ON t.contact_id = n.contact_id""",
)
def merge_web_contacts(spark, root):
    known = people(spark, root).where("event_id % 5 = 0").groupBy("email").agg(F.max("event_id").alias("k"))
    target = known.select(
        X.stable_id(F.col("email")).alias("contact_id"), F.lit("Known Person").alias("full_name"), F.lit(None).cast("string").alias("role_type"),
        F.when(F.col("k") % 3 == 0, "suppressed").otherwise("new").alias("contact_status"), F.when(F.col("k") % 2 == 0, F.lit(0.5)).otherwise(F.lit(0.99)).alias("confidence_score"),
    )
    return M.merge_web_contacts(target, H.as_contacts(H.best_candidates(candidates(spark, root))), now())


@query("people", f"SELECT sha256(account_key || '|' || email) AS relationship_id, sha256(account_key) AS account_id, sha256(email) AS contact_id, score AS confidence_score FROM ({BEST}) x")
def merge_web_relationships(spark, root):
    fresh = H.as_relationships(H.best_candidates(candidates(spark, root)), now())
    merged = M.merge_upsert(fresh.where("confidence_score > 0.9"), fresh, ["relationship_id"], M.RELATIONSHIP_RULES)
    return merged.select("relationship_id", "account_id", "contact_id", "confidence_score")


# Classification ---------------------------------------------------------------------------------


def _matches(c: str, patterns) -> str:
    return f"regexp_matches({c}, {quoted('(?i)' + '|'.join(f'(?:{p})' for p in patterns))})"


def _word(c: str, words) -> str:
    listed = "|".join(sorted(words, key=len, reverse=True))
    return f"(regexp_matches({c}, '(^|[^a-z])(?:{listed})([^a-z]|$)') OR regexp_matches({c}, '(^|[^a-z0-9])(?:{listed})([^a-z0-9]|$)'))"


def _listed(h: str, hosts) -> str:
    return "(" + " OR ".join(f"{h} = {quoted(x)} OR ends_with({h}, {quoted('.' + x)})" for x in hosts) + ")"


def _token(condition: str) -> str:
    return f"len(list_filter(tokens, lambda t: {condition})) > 0"


_BARE_HOST = "regexp_replace(t, '^www\\.', '')"
_LABEL = f"split_part({_BARE_HOST}, '.', 1)"
_ALIAS = f"^(?:\\d+|[a-z])[a-z0-9-]*(?:{'|'.join(params.ALIAS_BRANDS)})\\.[a-z]{{2,}}$|^audiof[a-z0-9-]+\\.[a-z]{{2,}}$|^audi[a-z0-9-]{{3,}}\\.[a-z]{{2,}}$"
_ROOFTOP = " OR ".join(f"(contains({_LABEL}, {quoted(w)}) AND {_LABEL} <> {quoted(w)})" for w in (*params.ROOFTOP_ALIASES, *params.BRAND_WORDS))
EVIDENCE = f"""SELECT a.account_key, p.source_url, lower(concat_ws(' ', a.account_key, coalesce(account_name, ''), coalesce(inferred_brand, ''), p.source_url, substr(p.text, 1, 12000),
 CASE WHEN {_word('a.account_key', params.BRAND_WORDS)} THEN 'account_key_brand_hint' ELSE '' END, CASE WHEN p.inventory_link THEN 'inventory_page_detected' ELSE '' END, CASE WHEN p.refused_page THEN 'blocked_site' ELSE '' END)) AS e
 FROM accounts_v a LEFT JOIN account_pages_v p ON a.account_key = p.account_key"""


def signals_sql(evidence: str) -> str:
    """The signals of rows (source_url, e)."""
    return f"""SELECT *, {_listed('h', params.VENDOR_HOSTS)} AS vendor_host, {MAKER(h='h')} AS oem_host, {_listed('told', params.VENDOR_HOSTS)} AS told_vendor_host, {MAKER(h='told')} AS told_oem_host, {_matches('e', params.VENDOR_PATTERNS)} AS vendor, {_matches('e', params.NON_DEALER_PATTERNS)} AS non_dealer,
 {_matches('e', params.GROUP_PATTERNS)} AS group_words, {_matches('e', params.DEALER_PATTERNS)} AS dealer_words, {_matches('e', params.INDUSTRY_PATTERNS)} AS industry, {_matches('e', params.OEM_PATTERNS)} AS oem_words,
 {_matches('e', params.CONTEXT_PATTERNS)} AS context, {_word('e', params.BRAND_WORDS)} AS brand, {_word('e', params.INDEPENDENT_WORDS)} AS independent,
 {_token(f"regexp_matches(t, {quoted(_ALIAS)})")} AS alias_domain, {_token(f"{has_any('t', params.BRAND_WORDS)} AND {has_any('t', params.DOMAIN_WORDS)}")} AS brand_domain,
 {_token(f"NOT {_listed(_BARE_HOST, params.VENDOR_HOSTS)} AND NOT {MAKER(h=_BARE_HOST)} AND ({_ROOFTOP})")} AS rooftop_domain,
 contains(e, 'account_key_brand_hint') AS key_hint, contains(e, 'inventory_page_detected') AS inventory, contains(e, 'blocked_site') AS refused, {has_any('e', params.SHOPPING_WORDS)} AS shopping,
 {has_any('h', params.VENDOR_HOST_WORDS)} AS vendor_host_word, {has_any('e', params.TITLE_WORDS)} AND contains(e, 'dealership') AS title_work, {has_any('e', params.SPECIALTY_WORDS)} AS specialty, {has_any('h', params.CARE_HOST_WORDS)} AS care_host
 FROM (SELECT *, {HOST(c="source_url")} AS h, {HOST(c="regexp_extract(e, 'https?://[^" + chr(92) + "s]+', 0)")} AS told, regexp_extract_all(e, '[a-z0-9.-]+\\.[a-z]{{2,}}') AS tokens FROM ({evidence}) v) w"""


SIGNALS = signals_sql(EVIDENCE)


def _case(values) -> str:
    return "CASE " + " ".join(f"WHEN {rule} THEN {value}" for rule, value in values) + " END"


def decided_sql(signals: str) -> str:
    return f"""SELECT account_key, CAST({_case((r, k + 1) for k, (r, _, _) in enumerate(C.RULES))} AS INTEGER) AS rule_id, {_case((r, quoted(label)) for r, label, _ in C.RULES)} AS classification,
 CAST({_case((r, score) for r, _, score in C.RULES)} AS DOUBLE) AS confidence FROM ({signals}) s"""


DECIDED = decided_sql(SIGNALS)


def told(spark, root):
    both = accounts(spark, root).join(view(spark, root, "account_pages"), "account_key", "left")
    text = C.evidence(F.col("account_key"), F.col("account_name"), F.col("inferred_brand"), F.col("source_url"), F.col("text"), F.col("inventory_link"), F.col("refused_page"))
    return both.select("account_key", "source_url", text.alias("evidence"))


@query("accounts account_pages", f"SELECT account_key, e AS evidence FROM ({EVIDENCE}) v")
def evidence_text(spark, root):
    return told(spark, root).select("account_key", "evidence")


FAMILIES = ("vendor", "non_dealer", "group_words", "dealer_words", "industry", "oem_words", "context", "brand", "independent")
SHAPES = ("alias_domain", "brand_domain", "rooftop_domain")


@query("accounts account_pages", f"SELECT account_key, {', '.join(FAMILIES)} FROM ({SIGNALS}) s")
def keyword_families(spark, root):
    return C.signals(told(spark, root)).select("account_key", *FAMILIES)


@query("accounts account_pages", f"SELECT account_key, {', '.join(SHAPES)} FROM ({SIGNALS}) s")
def domain_shape(spark, root):
    return C.signals(told(spark, root)).select("account_key", *SHAPES)


def decided(spark, root):
    known = accounts(spark, root).select("account_key", "account_name", "inferred_brand")
    seen = view(spark, root, "account_pages").select("account_key", "source_url", "text", F.col("inventory_link"), F.col("refused_page"))
    return C.classify_accounts(known, seen)


@query("accounts account_pages", DECIDED)
def classify_accounts(spark, root):
    return decided(spark, root).select("account_key", "rule_id", "classification", "confidence")


@query("accounts account_pages", f"SELECT account_key, {_case((r, quoted(t)) for r, t in C.SUMMARIES)} AS evidence_summary FROM ({SIGNALS}) s")
def evidence_summary(spark, root):
    return C.summarized(C.signals(told(spark, root))).select("account_key", "evidence_summary")


@query("accounts account_pages", f"SELECT account_key, classification, confidence FROM ({DECIDED}) d WHERE classification <> 'unknown' AND confidence >= 0.8")
def classify_gate(spark, root):
    return decided(spark, root).where(C.write_gate(F.col("classification"), F.col("confidence"))).select("account_key", "classification", "confidence")


@query(
    "accounts account_pages",
    f"""SELECT account_key, CASE WHEN r THEN nc ELSE oc END AS classification, CASE WHEN r THEN ns ELSE os END AS classification_confidence, {NOW} AS last_checked_at, r AS replaced FROM (
 SELECT a.account_key, a.classification AS oc, a.classification_confidence AS os, d.classification AS nc, d.confidence AS ns,
 coalesce(d.classification <> 'unknown' AND d.confidence >= 0.8 AND (a.classification_confidence IS NULL OR d.confidence >= a.classification_confidence
  OR coalesce(a.classification <> d.classification AND d.confidence >= greatest(coalesce(a.classification_confidence, 0) - CAST(0.1 AS DOUBLE), CAST(0.8 AS DOUBLE)), false)
  OR (a.classification = 'vendor' AND d.classification IN ('dealer', 'dealer_group', 'non_dealer', 'oem'))), false) AS r
 FROM accounts_v a JOIN ({DECIDED}) d ON a.account_key = d.account_key) x""",
)
def apply_classification(spark, root):
    return C.apply_classification(accounts(spark, root).select("account_key", "classification", "classification_confidence"), decided(spark, root), now())


# Sites ------------------------------------------------------------------------------------------


SIGN = " OR ".join(f"{_word(c, words)}" for c in ("account_key", "source_url") for words in (params.BRAND_WORDS, params.INDEPENDENT_WORDS))
PATHS = ", ".join(quoted(p) for p in params.INVENTORY_PATHS)


@query("probes", f"SELECT DISTINCT account_key FROM probes_v WHERE ({SIGN}) AND path IN ({PATHS}) AND (status_code = 403 OR ({has_any('final_url', ('inventory', 'new', 'used', 'vehicle'))} AND ({_word('final_url', params.BRAND_WORDS)} OR {_word('account_key', params.BRAND_WORDS)})))")
def path_probe(spark, root):
    seen = view(spark, root, "probes")
    return P.inventory_probe(seen.select("account_key", "source_url").distinct(), seen)


FETCHED = f"(SELECT *, coalesce(status_code BETWEEN 200 AND 399 AND length(html) > 0 AND ({MARKER}) IS NULL, false) AS usable, {MARKER} AS marker FROM fetches_v) f"


def fetched(spark, root):
    """Pages of which some are refused, missing or empty."""
    return view(spark, root, "fetches").withColumns({"usable": X.page_usable(F.col("status_code"), F.col("html")), "marker": X.block_marker(F.col("html"))})


@query("fetches", f"SELECT host AS account_key, page_id, usable FROM (SELECT *, row_number() OVER (PARTITION BY host ORDER BY usable DESC, page_id) AS rn FROM {FETCHED}) x WHERE rn = 1")
def homepage_pick(spark, root):
    seen = fetched(spark, root)
    urls = seen.select(F.col("host").alias("account_key"), F.col("page_id").alias("pos"), "url")
    return P.first_usable(urls, seen).select("account_key", "page_id", "usable")


@query(
    "fetches",
    f"""SELECT host, CASE WHEN ok THEN 'success' WHEN marker IS NOT NULL THEN 'blocked' ELSE 'unavailable' END AS fetch_status, CASE WHEN NOT ok THEN coalesce(marker, 'no_public_html') END AS reason
 FROM (SELECT host, bool_or(usable) AS ok, arg_min(marker, page_id) FILTER (marker IS NOT NULL) AS marker FROM {FETCHED} GROUP BY host) x""",
)
def fetch_outcome(spark, root):
    return P.fetch_outcome(fetched(spark, root))


PRIORITY = "CASE " + " ".join(f"WHEN {has_any('{c}', words)} THEN {k}" for k, words in enumerate(params.PAGE_PRIORITIES)) + " ELSE 4 END"
HOMES = f"(SELECT DISTINCT 'https://' || {HOST(c='url')} AS url FROM pages) h"
GUESSES = f"SELECT url, url || path AS target, CAST({PRIORITY.replace('{c}', 'path')} AS INTEGER) AS priority FROM (SELECT url, unnest([{', '.join(quoted(p) for p in params.CONTACT_PATHS)}]) AS path FROM {HOMES}) g"


def homes(spark, root):
    return pages(spark, root).select(F.concat(F.lit("https://"), X.host_of(F.col("url"))).alias("url")).distinct()


def site_links(known):
    """Same-site links of every host's home page, on the URLs of homes(): the root page, else the first usable one.

    The SQL of the two queries below holds guesses alone; it gives equal rows as long as no home page has a link that names people.
    """
    host = X.host_of(F.col("url"))
    root = F.regexp_extract("url", "^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1).isin("", "/")
    usable = known.select("url", "page_id", X.page_usable(F.lit(200), F.col("html")).alias("usable"))
    urls = known.select(host.alias("account_key"), F.struct(~root, "page_id").alias("pos"), "url")
    first = P.first_usable(urls.dropDuplicates(["account_key", "url"]), usable.dropDuplicates(["url", "page_id"])).select("page_id", "url")
    parsed = P.page_features(known.join(first, ["page_id", "url"], "left_semi").dropDuplicates(["page_id", "url"]))
    found = P.same_site_links(parsed.select("page_id", "url", F.explode("anchors").alias("a")).select("page_id", "url", "a.*"))
    home = F.concat(F.lit("https://"), host)
    moved = F.concat(home, F.regexp_replace("target", "^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*", ""))
    return found.select("page_id", home.alias("url"), "pos", "href", "text", moved.alias("target"))


@query("", f"SELECT url, target, CAST(priority AS INTEGER) AS priority, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY priority, target) AS rank FROM ({GUESSES}) g) x WHERE rank <= 16")
def page_url_rank(spark, root):
    return P.people_pages(site_links(pages(spark, root)), homes(spark, root)).select("url", "target", "priority", "rank")


@query("", f"SELECT url, target FROM ({GUESSES}) g")
def page_url_union(spark, root):
    return P.people_pages(site_links(pages(spark, root)), homes(spark, root), limit=None).select("url", "target")
