"""Account, contact and work tables derived from the star-schema tables.

The SQL is common to Spark and DuckDB but for the hash, written H(...) here; {name} stands for an
input table. Spark and the comparison engine therefore start from equal rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .tables import read_table, spread

AS_OF = "2001-07-01 12:00:00"

VIEWS = {
    "contact_master": """
SELECT concat('c', CAST(event_id AS STRING)) AS contact_id,
 CASE WHEN event_id % 5 = 0 THEN NULL ELSE concat('First', CAST(user_id % 50 AS STRING), ' Last', CAST(user_id AS STRING)) END AS full_name,
 concat('First', CAST(user_id % 50 AS STRING)) AS first_name,
 CASE WHEN event_id % 9 = 0 THEN NULL ELSE concat('Last', CAST(user_id AS STRING)) END AS last_name,
 CASE event_id % 3 WHEN 0 THEN upper(concat('user', CAST(user_id AS STRING), '@', dom))
                   WHEN 1 THEN concat('  user', CAST(user_id AS STRING), '@', dom, ' ')
                   ELSE concat('user', CAST(user_id AS STRING), '@', dom) END AS email,
 CASE WHEN event_id % 2 = 0 THEN upper(dom) ELSE dom END AS email_domain,
 CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 89 = 0 THEN '  '
      WHEN event_id % 2 = 1 THEN concat(' ', upper(dom)) ELSE dom END AS account_key,
 CASE WHEN event_id % 11 = 0 THEN NULL ELSE user_id % 7 = 0 END AS is_personal_email,
 CASE WHEN user_id % 7 = 0 THEN 'personal' ELSE 'business' END AS domain_type,
 CASE event_type WHEN 'error' THEN 'invalid' WHEN 'signup' THEN NULL ELSE 'active' END AS contact_status,
 CASE WHEN event_id % 13 = 0 THEN NULL ELSE value / CAST(1000 AS DOUBLE) END AS confidence_score,
 CASE WHEN event_id % 4 = 0 THEN NULL ELSE ts END AS last_seen_at, ts AS created_at
FROM (SELECT *, CASE WHEN user_id % 7 = 0 THEN concat('mail', CAST(user_id % 3 AS STRING), '.example.com')
                     ELSE concat('acct', CAST(user_id % 40 AS STRING), '.example.net') END AS dom FROM {events}) e""",
    "accounts": """
SELECT H(concat('acct', CAST(c_custkey AS STRING), '.example.net')) AS account_id,
 concat('acct', CAST(c_custkey AS STRING), '.example.net') AS account_key,
 CASE WHEN c_custkey % 8 = 0 THEN NULL ELSE c_name END AS account_name,
 CASE WHEN c_custkey % 6 = 0 THEN NULL WHEN c_custkey % 31 = 0 THEN ' '
      ELSE concat('Brand', CAST(c_custkey % 25 AS STRING)) END AS inferred_brand,
 CASE c_mktsegment WHEN 'BUILDING' THEN 'dealer' WHEN 'AUTOMOBILE' THEN 'dealer_group'
      WHEN 'MACHINERY' THEN 'vendor' WHEN 'HOUSEHOLD' THEN 'non_dealer' ELSE NULL END AS classification,
 CASE WHEN c_mktsegment = 'FURNITURE' THEN NULL
      ELSE round(CAST(80 + c_custkey % 18 AS DOUBLE) / 100, 2) END AS classification_confidence,
 n_name AS account_city,
 CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE concat('S', CAST(n_regionkey AS STRING)) END AS account_state,
 CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE concat('https://acct', CAST(c_custkey AS STRING), '.example.net') END AS website_url,
 CASE c_custkey % 4 WHEN 0 THEN 'blocked' WHEN 1 THEN 'success' WHEN 2 THEN 'unavailable' ELSE NULL END AS fetch_status,
 CAST(CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE c_custkey % 6 END AS BIGINT) AS blocked_attempt_count,
 last_order AS last_fetch_attempt_at, c_custkey % 9 = 0 AS is_personal_domain,
 CASE c_custkey % 3 WHEN 0 THEN 'website_enrichment' WHEN 1 THEN 'website_resolution' ELSE 'contact_master_normalization' END AS source_type,
 CASE WHEN c_custkey % 4 = 1 THEN NULL ELSE last_order END AS last_verified_at
FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey
LEFT JOIN (SELECT o_custkey, max(o_orderdate) AS last_order FROM {orders} GROUP BY o_custkey) o ON o_custkey = c_custkey""",
    "contacts": """
SELECT H(em) AS contact_id, em AS email,
 CASE WHEN k % 4 = 0 THEN '' ELSE concat('Name ', CAST(k AS STRING)) END AS full_name,
 concat('F', CAST(k AS STRING)) AS first_name,
 CASE WHEN k % 8 = 0 THEN NULL ELSE concat('L', CAST(k AS STRING)) END AS last_name,
 CASE k % 5 WHEN 0 THEN NULL WHEN 1 THEN 'executive' WHEN 2 THEN 'sales' WHEN 3 THEN 'service' ELSE ' ' END AS role_family,
 k % 11 = 0 AS is_personal_email,
 CASE k % 13 WHEN 0 THEN 'suppressed' WHEN 1 THEN 'INVALID' WHEN 2 THEN NULL ELSE 'active' END AS contact_status,
 conf AS confidence_score, seen AS last_seen_at
FROM (SELECT o_orderkey % 5000 AS k, concat('p', CAST(o_orderkey % 5000 AS STRING), '@example.net') AS em,
             max(o_totalprice) / CAST(1000000 AS DOUBLE) AS conf, max(o_orderdate) AS seen
      FROM {orders} GROUP BY o_orderkey % 5000) x""",
    "relationships": """
SELECT H(concat(ak, '|', em)) AS relationship_id, H(ak) AS account_id, H(em) AS contact_id,
 CASE WHEN first_order % 23 = 0 THEN 'website_contact_extraction' ELSE 'contact_master_normalization' END AS source_type
FROM (SELECT concat('acct', CAST(o_custkey AS STRING), '.example.net') AS ak,
             concat('p', CAST(o_orderkey % 5000 AS STRING), '@example.net') AS em, min(o_orderkey) AS first_order FROM {orders} GROUP BY 1, 2) x""",
    "work_items": """
SELECT o_orderkey AS work_item_id, concat('acct', CAST(o_custkey AS STRING), '.example.net') AS account_key,
 CASE o_orderkey % 4 WHEN 0 THEN 'validate' WHEN 1 THEN 'enrich' WHEN 2 THEN 'extract_contacts' ELSE 'retry_blocked' END AS task_type,
 CASE WHEN o_orderkey % 19 = 0 THEN 'retry' WHEN o_orderstatus = 'O' THEN 'pending'
      WHEN o_orderstatus = 'P' THEN 'in_progress' ELSE 'completed' END AS status,
 CAST(o_orderkey % 5 * 20 AS BIGINT) AS priority,
 CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderdate END AS next_attempt_at,
 CASE WHEN o_orderstatus = 'P' THEN o_orderdate ELSE NULL END AS lease_expires_at, o_orderdate AS created_at
FROM {orders}""",
    "snapshots": """
SELECT d AS snapshot_at, CAST(sum(n) OVER (ORDER BY d ROWS UNBOUNDED PRECEDING) AS BIGINT) AS accounts, CAST(b AS BIGINT) AS blocked
FROM (SELECT date_trunc('day', ts) AS d, count(*) AS n,
             sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS b
      FROM {events} GROUP BY date_trunc('day', ts)) x""",
    "attempts": """
SELECT concat('acct', CAST(user_id % 400 AS STRING), '.example.net') AS account_key, event_id AS attempt_id, ts AS attempted_at,
 CASE event_type WHEN 'error' THEN 'blocked' WHEN 'view' THEN 'unavailable' ELSE 'success' END AS status,
 CASE WHEN event_type = 'error' THEN CASE event_id % 2 WHEN 0 THEN 'captcha' ELSE 'access denied' END ELSE NULL END AS reason
FROM {events}""",
    "work_events": """
SELECT concat('w', CAST(user_id % 300 AS STRING)) AS work_item_id, event_id, date_trunc('hour', ts) AS happened_at,
 CASE WHEN event_type = 'error' THEN 'fail' WHEN user_id % 5 = 0 AND event_id % 3 = 0 OR event_id % 17 = 0 THEN 'complete' ELSE 'claim' END AS kind,
 CASE WHEN event_type = 'error' THEN concat('error ', CAST(event_id % 4 AS STRING)) ELSE NULL END AS error
FROM {events}""",
    "failures": """
SELECT event_id, CASE event_id % 6 WHEN 0 THEN concat('Page.goto: net::ERR_CONNECTION_REFUSED at https://h', CAST(user_id AS STRING)) WHEN 1 THEN 'NET::err_name_not_resolved' WHEN 2 THEN concat('net::ERR_TIMED_OUT after ', CAST(user_id AS STRING), ' ms')
 WHEN 3 THEN concat('Timeout of ', CAST(user_id AS STRING), ' ms exceeded') WHEN 4 THEN '' ELSE NULL END AS message FROM {events}""",
    "account_pages": """
SELECT concat('acct', CAST(c_custkey AS STRING), '.example.net') AS account_key,
 CASE c_custkey % 9 WHEN 0 THEN 'https://www.dealer.com/about' WHEN 1 THEN 'https://parts.ford.com' WHEN 2 THEN 'https://acme-marketing.example' WHEN 3 THEN 'https://homecare.example/x'
  WHEN 4 THEN 'https://smithhonda.example' ELSE concat('https://acct', CAST(c_custkey AS STRING), '.example.net') END AS source_url,
 CASE c_custkey % 14 WHEN 0 THEN 'Cox Automotive software for dealers' WHEN 1 THEN 'Family medical clinic' WHEN 2 THEN 'Smith Auto Group new inventory' WHEN 3 THEN 'See www.hondasales.com for offers'
  WHEN 4 THEN 'Visit 1ford.com today' WHEN 5 THEN 'Vehicle wraps and more' WHEN 6 THEN 'Schedule service for your Honda car' WHEN 7 THEN 'Used vehicles, car lot' WHEN 8 THEN 'General Motors head office'
  WHEN 9 THEN 'Ford truck finance' WHEN 10 THEN 'DMV dealership forms' WHEN 11 THEN 'Wheels and tires, accessories' WHEN 12 THEN 'Toyota cars and more' ELSE 'Nothing here' END AS text,
 c_custkey % 4 = 0 AS inventory_link, c_custkey % 8 = 0 AS refused_page FROM {customer}""",
    "people": """
SELECT event_id, concat('acct', CAST(user_id % 40 AS STRING), '.example.net') AS account_key, concat(chr(CAST(65 + user_id % 26 AS INT)), 'ames ', chr(CAST(65 + (user_id * 7) % 26 AS INT)), 'mith') AS person,
 CASE event_id % 9 WHEN 0 THEN 'General Manager' WHEN 1 THEN 'Dealer Principal' WHEN 2 THEN 'President' WHEN 3 THEN 'Operations Director' WHEN 4 THEN 'Internet Sales Manager'
  WHEN 5 THEN 'Parts Director' WHEN 6 THEN 'E-Commerce Director' WHEN 7 THEN 'CFO' ELSE 'Receptionist' END AS title,
 concat(CASE event_id % 7 WHEN 0 THEN 'info' ELSE concat('user', CAST(user_id % 200 AS STRING)) END, '@acct', CAST(user_id % 40 AS STRING), '.example.net') AS email,
 concat('https://acct', CAST(user_id % 40 AS STRING), '.example.net/', CASE event_id % 3 WHEN 0 THEN 'staff' ELSE 'page' END) AS url FROM {events}""",
    "sites": """
SELECT c_custkey AS page_id, concat('acct', CAST(c_custkey AS STRING), '.example.net') AS account_key,
 concat('https://acct', CAST(c_custkey AS STRING), '.example.net/', CASE WHEN c_custkey % 11 = 0 THEN 'ford' ELSE '' END) AS url,
 concat('<html><head><title> Acct', CAST(c_custkey AS STRING), CASE WHEN c_custkey % 2 = 0 THEN ' Honda' ELSE '' END, ' | Used Vehicles and more</title>',
  CASE WHEN c_custkey % 3 = 0 THEN concat('<meta name="description" content="Kia and others in town ', CAST(c_custkey AS STRING), '">') ELSE '' END,
  CASE WHEN c_custkey % 4 = 0 THEN concat('<meta property="og:site_name" content="Site', CAST(c_custkey AS STRING), CASE WHEN c_custkey % 8 = 0 THEN ' Toyota' ELSE '' END, ' Motors">') ELSE '' END,
  '<script type="application/ld+json">',
  CASE WHEN c_custkey % 5 = 0 THEN concat('{"name": "Legal', CAST(c_custkey AS STRING), CASE WHEN c_custkey % 10 = 0 THEN ' Jeep' ELSE '' END, ' Inc", "address": {"addressLocality": "port ', chr(CAST(97 + c_custkey % 26 AS INT)), 'ale", "addressRegion": "tx"}}')
       WHEN c_custkey % 7 = 0 THEN '{"name": 12}' ELSE '{broken' END,
  '</script><script>var hidden = "x@hidden.example";</script></head><body><nav><a href="',
  CASE c_custkey % 3 WHEN 0 THEN '/meet-our-staff">Our Staff' WHEN 1 THEN '/people"> <b>Our team' ELSE 'crew/lead">Leadership' END, '</a> <a href="inventory/new">New inventory</a>',
  '<a href="https://other.example/team">Our team elsewhere</a> <a href="/map#where">Map</a>', CASE WHEN c_custkey % 2 = 0 THEN '<a class="x" href="/finance"><i>Financing</a></u>' ELSE '' END, '</nav><!-- y@comment.example --><p>North', chr(CAST(97 + c_custkey % 26 AS INT)), 'ville, ',
  CASE c_custkey % 4 WHEN 0 THEN 'NY' WHEN 1 THEN 'ZZ' WHEN 2 THEN 'OR' ELSE 'ny' END, ' 97301</p><div><p>', chr(CAST(65 + c_custkey % 26 AS INT)), 'ames ', chr(CAST(65 + c_custkey * 7 % 26 AS INT)), 'mith, ',
  CASE c_custkey % 3 WHEN 0 THEN 'General Manager' WHEN 1 THEN 'Sales Manager' ELSE 'Gardener' END, '</p><a href="mailto:boss', CAST(c_custkey AS STRING), '@acct', CAST(c_custkey AS STRING), '.example.net?subject=hi">Mail</a> <span>glad to hear from you at any hour</span></div>',
  '<p>Write to desk', CAST(c_custkey AS STRING), '@elsewhere.example for anything else that you need</p></body></html>') AS html
FROM {customer}""",
    "fetches": """
SELECT c_custkey AS page_id, concat('site', CAST(c_custkey % 40 AS STRING), '.example.net') AS host,
 concat('https://site', CAST(c_custkey % 40 AS STRING), '.example.net/', CAST(c_custkey AS STRING)) AS url,
 CAST(CASE c_custkey % 40 % 5 WHEN 0 THEN 403 WHEN 1 THEN 404 WHEN 2 THEN CASE WHEN c_custkey % 3 = 0 THEN 200 ELSE 500 END ELSE 200 END AS INT) AS status_code,
 CASE WHEN c_custkey % 40 % 5 = 0 THEN CASE WHEN c_custkey % 2 = 0 THEN '<h1>Access Denied</h1>' ELSE '<p>Just a moment...</p>' END WHEN c_custkey % 40 % 5 = 3 AND c_custkey % 3 <> 1 THEN ''
      WHEN c_custkey % 40 % 5 = 4 AND c_custkey % 2 = 0 THEN NULL ELSE concat('<p>page ', CAST(c_custkey AS STRING), '</p>') END AS html
FROM {customer}""",
    "probes": """
SELECT c_custkey AS page_id, concat(CASE c_custkey % 4 WHEN 0 THEN 'honda-town' WHEN 1 THEN 'smith-autos' WHEN 2 THEN 'plain' ELSE 'jeepland' END, CAST(c_custkey AS STRING), '.example.net') AS account_key,
 concat('https://', CASE c_custkey % 4 WHEN 0 THEN 'honda-town' WHEN 1 THEN 'smith-autos' WHEN 2 THEN 'plain' ELSE 'jeepland' END, CAST(c_custkey AS STRING), '.example.net/') AS source_url,
 CASE c_custkey % 9 WHEN 0 THEN '/new-inventory/index.htm' WHEN 1 THEN '/used-inventory/index.htm' WHEN 2 THEN '/inventory/index.htm' WHEN 3 THEN '/new-inventory' WHEN 4 THEN '/used-inventory' WHEN 5 THEN '/cars-for-sale' WHEN 6 THEN '/search/' WHEN 7 THEN '/search' ELSE '/en/about' END AS path,
 CAST(CASE WHEN c_custkey % 5 = 0 THEN 403 ELSE 200 END AS INT) AS status_code,
 CASE WHEN c_custkey % 7 = 0 THEN 'https://elsewhere.example/honda/vehicle' WHEN c_custkey % 7 = 1 THEN 'https://elsewhere.example/' ELSE concat('https://', CASE c_custkey % 4 WHEN 0 THEN 'honda-town' WHEN 1 THEN 'smith-autos' WHEN 2 THEN 'plain' ELSE 'jeepland' END, CAST(c_custkey AS STRING), '.example.net/all-used') END AS final_url
FROM {customer}""",
    "visits": """
SELECT k * 10 + p AS page_id, concat('acct', CAST(k AS STRING), '.example.net') AS account_key,
 CASE p WHEN 0 THEN CASE WHEN k % 5 = 0 THEN concat('http://acct', CAST(k AS STRING), '.example.net') ELSE concat('https://acct', CAST(k AS STRING), '.example.net/') END WHEN 1 THEN concat(base, 'meet-our-staff') ELSE concat(base, 'new-inventory') END AS url,
 CAST(CASE WHEN p = 0 AND k % 4 = 1 OR p = 1 AND k % 8 = 1 OR p = 2 AND k % 4 = 1 THEN 403 WHEN k % 11 = 0 AND p < 2 THEN 404 ELSE 200 END AS INT) AS status_code,
 CASE p WHEN 0 THEN base WHEN 1 THEN concat(base, 'meet-our-staff') ELSE concat(base, 'new-inventory') END AS final_url,
 CASE WHEN p = 2 OR k % 11 = 0 AND NOT (p = 0 AND k % 4 = 1) THEN NULL WHEN p = 1 AND k % 8 = 1 THEN '<p>Access Denied</p>'
  WHEN p = 1 THEN concat('<html><head><title>Staff of Acct', CAST(k AS STRING), '</title></head><body><div><p>', chr(CAST(65 + k % 26 AS INT)), 'ames ', chr(CAST(65 + k * 7 % 26 AS INT)), 'mith, ', CASE k % 3 WHEN 0 THEN 'General Manager' WHEN 1 THEN 'Sales Manager' ELSE 'Gardener' END,
   '</p><a href="mailto:boss', CAST(k AS STRING), '@acct', CAST(k AS STRING), '.example.net">Mail</a> <span>glad to hear from you at any hour</span></div></body></html>')
  ELSE concat('<html><head><title>Acct', CAST(k AS STRING), ' Welcome</title></head><body><p>', said, '<p><a href="', CASE WHEN k % 6 = 2 THEN '/inventory/new' ELSE '/map' END, '">Look</a></body></html>') END AS html,
 CASE WHEN k % 11 = 0 AND k % 4 <> 1 THEN '' ELSE concat('Acct', CAST(k AS STRING), ' Welcome   Acct', CAST(k AS STRING), ' Welcome ', said, ' Look') END AS shown
FROM (SELECT c_custkey AS k, concat('https://acct', CAST(c_custkey AS STRING), '.example.net/', CASE c_custkey % 3 WHEN 0 THEN 'honda/' WHEN 1 THEN 'autos/' ELSE '' END) AS base,
  CASE WHEN c_custkey % 4 = 1 THEN 'Access Denied. Vehicles of all kinds' ELSE CASE c_custkey % 10 WHEN 0 THEN 'Cox Automotive software for dealers' WHEN 2 THEN 'Family medical clinic' WHEN 3 THEN 'Smith Auto Group new inventory' WHEN 4 THEN 'See www.hondasales.com for offers'
   WHEN 6 THEN 'Vehicle wraps and more' WHEN 7 THEN 'Used vehicles, car lot' WHEN 8 THEN 'Ford truck finance' ELSE 'Nothing here' END END AS said FROM {customer}) c
 CROSS JOIN (SELECT 0 AS p UNION ALL SELECT 1 AS p UNION ALL SELECT 2 AS p) n WHERE p < 2 OR k % 2 = 1""",
    "page_rows": """
SELECT page_id, url, html, 200 AS status_code, url AS final_url FROM {pages}""",
}
INPUTS = ("events", "customer", "nation", "orders", "pages", "documents")
#: Views that make whole pages out of a key: what they read is spread by it first, while rows are narrow.
PAGES_OF = {"sites": ("customer", "c_custkey"), "visits": ("customer", "c_custkey")}


def view(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One of the derived tables as a DataFrame."""
    text = VIEWS[name].replace("H(", "sha2_256(")
    while (at := text.find("sha2_256(")) >= 0:
        depth, end = 0, at + len("sha2_256")
        while True:
            depth += {"(": 1, ")": -1}.get(text[end], 0)
            end += 1
            if depth == 0:
                break
        text = f"{text[:at]}sha2({text[at + len('sha2_256(') : end - 1]}, 256){text[end:]}"
    used = {t: read_table(spark, root, t) for t in INPUTS if "{" + t + "}" in text}
    if name in PAGES_OF:
        table, key = PAGES_OF[name]
        used[table] = spread(used[table], key)
    text = text.replace("{", "{{").replace("}", "}}")
    for t in used:
        text = text.replace("{{" + t + "}}", "{" + t + "}")
    return spark.sql(text, **used)


def oracle(names: str, query: str) -> str:
    """DuckDB SQL: the named derived tables as common table expressions before the query."""
    parts = []
    for name in names.split():
        text = VIEWS[name].replace("H(", "sha256(")
        for t in INPUTS:
            text = text.replace("{" + t + "}", f"{t}")
        parts.append(f"{name}_v AS ({text})")
    return f"WITH {', '.join(parts)}\n{query}" if parts else query
