"""The registered queries of this package and the SQL that they are held against."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import langid, quality
from .ann import nearest
from .collocations import collocations
from .decontaminate import leaked_pairs
from .divergence import source_divergences
from .hmm import hmm_scores
from .jaccard import jaccard_components
from .licenses import LICENCE_FILE, ROUND, STOP, TEMPLATES, TERM, VERSION, must_hold, scan_licenses, template_terms, visible_lines
from .mixing import mix
from .pii import find_pii
from .toxicity import score_toxicity, train
from .warc import round_trip

QUERIES, ORACLES = {}, {}


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet")


def op7_ngram_jaccard(spark: SparkSession, root: str) -> DataFrame:
    return jaccard_components(table(spark, root, "documents"))


QUERIES["op7_ngram_jaccard"] = op7_ngram_jaccard


def op10_hidden_markov_lm(spark: SparkSession, root: str) -> DataFrame:
    return hmm_scores(table(spark, root, "documents"))


QUERIES["op10_hidden_markov_lm"] = op10_hidden_markov_lm


def op4_toxicity(spark: SparkSession, root: str) -> DataFrame:
    docs = table(spark, root, "documents")
    return score_toxicity(docs, train(docs, table(spark, root, "labels")))


QUERIES["op4_toxicity"] = op4_toxicity


def op5_pii(spark: SparkSession, root: str) -> DataFrame:
    return find_pii(table(spark, root, "documents"))


QUERIES["op5_pii"] = op5_pii


def op6_decontaminate(spark: SparkSession, root: str) -> DataFrame:
    return leaked_pairs(table(spark, root, "documents"), table(spark, root, "benchmark")).drop("key")


QUERIES["op6_decontaminate"] = op6_decontaminate


def op9_language_id(spark: SparkSession, root: str) -> DataFrame:
    docs = table(spark, root, "documents")
    return langid.identify(docs, langid.train(docs))


QUERIES["op9_language_id"] = op9_language_id


def op3_nearest(spark: SparkSession, root: str) -> DataFrame:
    return nearest(table(spark, root, "embeddings"), F.col("vec_id") % 20 == 0)


QUERIES["op3_nearest"] = op3_nearest
ORACLES["op3_nearest"] = """
WITH v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
), s AS (
  SELECT a.vec_id AS query_id, b.vec_id AS vec_id, list_inner_product(a.e, b.e) AS score
  FROM v a JOIN v b ON a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
) r WHERE rank <= 20
"""


def op2_warc(spark: SparkSession, root: str) -> DataFrame:
    return round_trip(table(spark, root, "pages")).drop("url")


QUERIES["op2_warc"] = op2_warc

#: Weights of the registered mixture: domains and languages that are not listed weigh 1.
MIX_WEIGHTS = {"domain": {"domain0": 4.0, "domain1": 2.0}, "lang": {"en": 2.0, "de": 1.5}}


def op1_mix_sources(spark: SparkSession, root: str) -> DataFrame:
    mixed = mix(table(spark, root, "documents"), total_share=0.6, weights=MIX_WEIGHTS, cut_text=False)
    return mixed.select("doc_id", "mix_domain", "lang", "source", "mix_epoch", "mix_tokens", "mix_taken")


QUERIES["op1_mix_sources"] = op1_mix_sources


def op8_licenses(spark: SparkSession, root: str) -> DataFrame:
    pages = table(spark, root, "pages").select(F.col("page_id").alias("file_id"), F.col("url").alias("path"), F.col("html").alias("body"))
    return scan_licenses(pages, visible_lines).withColumnRenamed("file_id", "page_id")


QUERIES["op8_licenses"] = op8_licenses


def op11_quality_rules(spark: SparkSession, root: str) -> DataFrame:
    kept = quality.judge(table(spark, root, "documents"))
    return kept.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "quality", "kept")


QUERIES["op11_quality_rules"] = op11_quality_rules


def op12_source_divergence(spark: SparkSession, root: str) -> DataFrame:
    return source_divergences(table(spark, root, "documents"))


QUERIES["op12_source_divergence"] = op12_source_divergence


def op13_collocations(spark: SparkSession, root: str) -> DataFrame:
    return collocations(table(spark, root, "documents"))


QUERIES["op13_collocations"] = op13_collocations


# SQL for DuckDB ---------------------------------------------------------------------------------

WORDS = "regexp_extract_all({c}, '[^\\x20\\x09-\\x0D]+')".format
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
ORACLES["op2_warc"] = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS h FROM pages),
d AS (SELECT page_id, strlen(body) AS payload_bytes, h,
  array_to_string(list_transform(range(0, 32), lambda i: substr('{BASE32}', (CAST('0x' || substr(h, CAST(5 * i // 4 AS INTEGER) + 1, 2) AS INTEGER) >> CAST(3 - (5 * i - 4 * (5 * i // 4)) AS INTEGER)) % 32 + 1, 1)), '') AS payload_digest,
  min(page_id) OVER (PARTITION BY h) AS first FROM p)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to FROM d
"""
ORACLES["op7_ngram_jaccard"] = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, {WORDS(c="translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS t FROM documents
), s AS (
  SELECT DISTINCT doc_id, CASE WHEN len(t) < 5 THEN array_to_string(t, ' ') ELSE array_to_string(t[i:i + 4], ' ') END AS shingle
  FROM (SELECT doc_id, t, unnest(range(1, greatest(len(t) - 4, 1) + 1)) AS i FROM w WHERE len(t) > 0) x
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS (SELECT x, y FROM c JOIN n p ON c.x = p.doc_id JOIN n q ON c.y = q.doc_id WHERE 100 * common >= 80 * (p.n + q.n - common)),
reach AS (SELECT doc_id, doc_id AS other FROM documents UNION SELECT reach.doc_id, links.y FROM reach JOIN links ON reach.other = links.x)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, r.component_id FROM documents d LEFT JOIN n ON d.doc_id = n.doc_id
JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) r ON d.doc_id = r.doc_id
"""


def _shares(nodes: str, parents: list[str], level: str) -> str:
    """SQL for the budgets of siblings: path and given."""
    weights = MIX_WEIGHTS.get(level, {})
    w = "CAST(CASE " + " ".join(f"WHEN {level} = '{k}' THEN {v}" for k, v in weights.items()) + " ELSE 1 END AS DOUBLE)" if weights else "CAST(1 AS DOUBLE)"
    family = f"PARTITION BY {', '.join(parents)}" if parents else ""
    before = f"({family} ORDER BY room / w, {level} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    path = ", ".join([*parents, level])
    return f"""SELECT {path}, CASE WHEN filled THEN room ELSE least(room, (given - sum(CASE WHEN filled THEN room ELSE 0 END) OVER ({family})) * w / sum(CASE WHEN filled THEN 0 ELSE w END) OVER ({family})) END AS given FROM (
  SELECT *, fb + room / w * ow <= given * (1 + 1e-12) AS filled FROM (
  SELECT *, coalesce(sum(room) OVER {before}, 0) AS fb, sum(w) OVER ({family}) - coalesce(sum(w) OVER {before}, 0) AS ow FROM (SELECT *, {w} AS w FROM ({nodes}) a) b) c) e"""


ORACLES["op1_mix_sources"] = f"""
WITH d AS (
  SELECT doc_id, 'domain' || CAST(CAST('0x' || substr(md5(source), 1, 6) AS BIGINT) % 4 AS VARCHAR) AS domain, lang, source,
    CAST(len({WORDS(c="coalesce(text, '')")}) AS BIGINT) AS tokens, CAST(doc_id AS VARCHAR) || '|' || md5(coalesce(text, '')) AS id FROM documents
), leaf AS (SELECT domain, lang, source, CAST(sum(tokens) AS BIGINT) AS tokens, CAST(sum(tokens) * 2 AS DOUBLE) AS room FROM d GROUP BY domain, lang, source),
g1 AS ({_shares("SELECT domain, sum(room) AS room, (SELECT CAST(sum(tokens) AS DOUBLE) * 0.6 FROM leaf) AS given FROM leaf GROUP BY domain", [], "domain")}),
g2 AS ({_shares("SELECT l.domain, l.lang, sum(room) AS room, any_value(g1.given) AS given FROM leaf l JOIN g1 ON l.domain = g1.domain GROUP BY l.domain, l.lang", ["domain"], "lang")}),
g3 AS ({_shares("SELECT l.domain, l.lang, l.source, room, g2.given FROM leaf l JOIN g2 ON l.domain = g2.domain AND l.lang = g2.lang", ["domain", "lang"], "source")}),
plan AS (SELECT l.*, CAST(floor(given) AS BIGINT) AS budget, CASE WHEN tokens > 0 THEN CAST(floor(given) AS BIGINT) // tokens ELSE 0 END AS whole FROM leaf l JOIN g3 ON l.domain = g3.domain AND l.lang = g3.lang AND l.source = g3.source),
placed AS (
  SELECT d.doc_id, d.domain, d.lang, d.source, d.tokens, p.whole, p.budget - p.whole * p.tokens AS rest, coalesce(sum(d.tokens) OVER (PARTITION BY d.domain, d.lang, d.source
    ORDER BY CAST('0x' || substr(md5('1|' || CAST(p.whole AS VARCHAR) || '|' || d.id), 1, 15) AS BIGINT) ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS sofar
  FROM d JOIN plan p ON d.domain = p.domain AND d.lang = p.lang AND d.source = p.source
), taken AS (
  SELECT doc_id, domain, lang, source, tokens, e AS epoch, CASE WHEN e < whole THEN tokens ELSE least(tokens, rest - sofar) END AS amount
  FROM (SELECT *, unnest(range(0, whole + CASE WHEN sofar < rest THEN 1 ELSE 0 END)) AS e FROM placed) x
)
SELECT doc_id, domain AS mix_domain, lang, source, CAST(epoch AS INTEGER) AS mix_epoch, tokens AS mix_tokens, CAST(amount AS BIGINT) AS mix_taken FROM taken WHERE amount > 0 OR tokens = 0
"""

_NOTICES = ", ".join(f"('{name}', {k}, '{term}', {n}, {int(must_hold(name, term))})" for name, k, term, n in template_terms(TEMPLATES))
_STOP = ", ".join(f"'{w}'" for w in STOP)
_NAMED = f"regexp_replace(regexp_replace(lower(line), '{VERSION[0]}', '{VERSION[1]}\\1', 'g'), '{ROUND}', '\\1', 'g')"
_TERMS = f"list_filter(regexp_extract_all({_NAMED}, '{TERM}'), lambda t: t NOT IN ({_STOP}))"
_DIRECTORY = "regexp_replace(regexp_replace(coalesce(url, ''), '^[a-zA-Z][a-zA-Z0-9+.-]*://|[?#].*$', '', 'g'), '/?[^/]*$', '')"
ORACLES["op8_licenses"] = f"""
WITH note(license, notice, term, n, must) AS (VALUES {_NOTICES}),
page AS (SELECT page_id, {_DIRECTORY} AS directory, regexp_matches(regexp_extract(regexp_replace(coalesce(url, ''), '[?#].*$', '', 'g'), '([^/]*)$', 1), '{LICENCE_FILE}') AS named,
  string_split(regexp_replace(coalesce(html, ''), '(?is)<script\\b.*?</script>|<style\\b.*?</style>|<!--.*?-->|<[^>]*>', chr(10), 'g'), chr(10)) AS body FROM pages),
line AS (SELECT page_id, unnest(body) AS line, generate_subscripts(body, 1) AS no FROM page),
seen AS (SELECT * FROM (SELECT page_id, no, {_TERMS} AS terms FROM line WHERE length(line) > 0) x WHERE list_has_any(terms, (SELECT list(DISTINCT term) FROM note))),
tf AS (SELECT page_id, no, term, count(*) AS tf FROM (SELECT page_id, no, unnest(terms) AS term FROM seen) x GROUP BY page_id, no, term),
total AS (SELECT greatest(count(*), 1) AS total FROM seen),
idf AS (SELECT v.term, ln((1 + any_value(total)) / (1 + count(tf.page_id))) + 1 AS idf FROM (SELECT DISTINCT term FROM note) v CROSS JOIN total LEFT JOIN tf ON v.term = tf.term GROUP BY v.term),
weight AS (SELECT license, notice, note.term, must, sum(must) OVER (PARTITION BY license, notice) AS musts, n * idf / sqrt(sum(n * idf * n * idf) OVER (PARTITION BY license, notice)) AS weight FROM note JOIN idf ON note.term = idf.term),
norm AS (SELECT page_id, no, sqrt(sum(tf * coalesce(idf, ln(1 + total) + 1) * tf * coalesce(idf, ln(1 + total) + 1))) AS norm FROM tf CROSS JOIN total LEFT JOIN idf ON tf.term = idf.term GROUP BY page_id, no),
dot AS (SELECT tf.page_id, tf.no, license, notice, sum(tf * idf * weight) AS dot FROM tf JOIN idf ON tf.term = idf.term JOIN weight ON tf.term = weight.term GROUP BY tf.page_id, tf.no, license, notice HAVING sum(must) >= max(musts)),
own AS (SELECT page_id, license AS own_license, score AS own_score FROM (
  SELECT dot.page_id, license, round(dot / norm, 9) AS score, row_number() OVER (PARTITION BY dot.page_id ORDER BY round(dot / norm, 9) DESC, license) AS rn FROM dot JOIN norm ON dot.page_id = norm.page_id AND dot.no = norm.no WHERE round(dot / norm, 9) >= 0.75) x WHERE rn = 1),
placed AS (SELECT p.page_id, directory, named, own_license, own_score FROM page p LEFT JOIN own ON p.page_id = own.page_id),
vote AS (SELECT directory, min(own_license) FILTER (named) AS fl, max(own_license) FILTER (named) AS fh, min(own_license) AS lo, max(own_license) AS hi FROM placed WHERE own_license IS NOT NULL GROUP BY directory),
agreed AS (SELECT * FROM (SELECT directory AS license_directory, CASE WHEN fl IS NOT NULL THEN CASE WHEN fl = fh THEN fl END WHEN lo = hi THEN lo END AS inherited FROM vote) x WHERE inherited IS NOT NULL),
climb AS (SELECT directory, depth, array_to_string(string_split(directory, '/')[1:depth], '/') AS license_directory FROM (SELECT directory, unnest(range(1, len(string_split(directory, '/')) + 1)) AS depth FROM (SELECT DISTINCT directory FROM placed) d) x),
near AS (SELECT directory, license_directory, inherited FROM (SELECT c.directory, a.license_directory, a.inherited, row_number() OVER (PARTITION BY c.directory ORDER BY depth DESC) AS rn FROM climb c JOIN agreed a ON c.license_directory = a.license_directory) x WHERE rn = 1)
SELECT p.page_id, p.directory, own_license, own_score, coalesce(own_license, inherited) AS license,
 CASE WHEN own_license IS NOT NULL AND named THEN 'file' WHEN own_license IS NOT NULL THEN 'header' WHEN inherited IS NOT NULL THEN 'inherited' ELSE 'none' END AS found,
 CASE WHEN own_license IS NOT NULL THEN p.directory ELSE license_directory END AS license_directory
FROM placed p LEFT JOIN near n ON p.directory = n.directory
"""


def _quality_sql() -> str:
    """The measures, the votes and every round of the estimates, one table expression after the other."""
    rules = ", ".join(f"CASE WHEN {against} THEN -1 WHEN {for_it} THEN 1 ELSE 0 END" for against, for_it in quality.RULES.values())
    probability = "1 / (1 + exp(-(w[1] + list_sum(list_transform(votes, lambda v, i: w[3 * i + v])))))"
    first = [math.log(quality.PRIOR / (1 - quality.PRIOR))] + [math.log((1 - quality.GOOD) / quality.BAD), 0.0, math.log(quality.GOOD / (1 - quality.BAD))] * len(quality.RULES)
    share = "(coalesce({0}, 0) + CAST({2} AS DOUBLE)) / (coalesce({0}, 0) + coalesce({1}, 0) + {3})".format
    begun, k = quality.BEFORE, 0
    rounds = [f"m0 AS MATERIALIZED (SELECT [{', '.join(f'CAST({x!r} AS DOUBLE)' for x in first)}] AS w)"]
    for k in range(1, quality.ROUNDS + 1):
        rounds.append(f"""s{k} AS MATERIALIZED (SELECT rule, sum(good) AS g, sum(n - good) AS b, sum(good) FILTER (vote = 1) AS g1, sum(good) FILTER (vote = -1) AS g0, sum(n - good) FILTER (vote = -1) AS b0, sum(n - good) FILTER (vote = 1) AS b1
  FROM (SELECT unnest(votes) AS vote, generate_subscripts(votes, 1) AS rule, n, n * p AS good FROM (SELECT votes, n, {probability} AS p FROM pattern CROSS JOIN m{k - 1}) x) y GROUP BY rule),
r{k} AS (SELECT rule, {share("g", "b", begun * quality.PRIOR, begun)} AS prior, {share("b0", "b1", begun * quality.BAD, begun)} AS bad, {share("g1", "g0", begun * quality.GOOD, begun)} AS good FROM s{k}),
m{k} AS MATERIALIZED (SELECT list_concat([min(ln(prior / (1 - prior))) FILTER (rule = 1)], flatten(list([ln((1 - good) / bad), 0, ln(good / (1 - bad))] ORDER BY rule))) AS w FROM (SELECT rule, prior, bad, greatest(1 - bad, good) AS good FROM r{k}) x)""")
    return f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text, {WORDS(c="coalesce(text, '')")} AS words,
  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM documents),
spot AS (SELECT row, i, array_to_string(words[i:i + 2], ' ') AS three FROM (SELECT row, words, unnest(range(1, len(words) - 1)) AS i FROM d WHERE len(words) > 2) x),
often AS (SELECT row, three FROM spot GROUP BY row, three HAVING count(*) > 1),
again AS (SELECT row, count(DISTINCT place) AS n FROM (SELECT spot.row, unnest([i, i + 1, i + 2]) AS place FROM spot JOIN often ON spot.row = often.row AND spot.three = often.three) x GROUP BY row),
f AS MATERIALIZED (SELECT d.row, doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars, CAST(length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
  CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, coalesce(again.n, 0) AS n_repeat_words, len(lines) AS n_lines,
  len(list_filter(lines, lambda x: regexp_matches(x, '[.!?\\x22][\\x20\\x09-\\x0D]*\\z'))) AS n_ended, length(regexp_replace(text, '[\\pL\\pN\\x20\\x09-\\x0D]+', '', 'g')) AS n_marks,
  len(list_distinct(words)) AS n_distinct, length(regexp_replace(text, '[^A-Z]+', '', 'g')) AS n_capitals FROM d LEFT JOIN again ON d.row = again.row),
voted AS MATERIALIZED (SELECT *, [{rules}] AS votes FROM f),
pattern AS MATERIALIZED (SELECT votes, CAST(count(*) AS DOUBLE) AS n FROM voted GROUP BY votes),
{(","+chr(10)).join(rounds)}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, round(p, 6) AS quality, NOT base_failed AND round(p, 6) >= 0.5 AS kept
FROM (SELECT *, {quality.BASE_FAILED} AS base_failed, {probability} AS p FROM voted CROSS JOIN m{k}) x
"""


ORACLES["op11_quality_rules"] = _quality_sql()

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_P = "1 + CAST(CAST(1000000000 AS HUGEINT) * ({0} + 2) // ({1} + 2 * v) AS BIGINT)".format
_APART = "(p - q) * (p - q) // (p + q)"
ORACLES["op12_source_divergence"] = f"""
WITH d AS (SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source, {_LOWER} AS text FROM documents),
seen AS (SELECT row, lang, source, unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term FROM seen GROUP BY lang, term HAVING count(DISTINCT row) >= 10),
c AS (SELECT lang, source, term, count(*) AS n FROM seen GROUP BY lang, source, term),
cell AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n FROM (SELECT DISTINCT lang, source FROM d) g JOIN kept k ON g.lang = k.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
share AS (SELECT lang, source, term, n, {_P("n", "total")} AS p, {_P("whole", "everything")} AS q FROM (
  SELECT *, sum(n) OVER (PARTITION BY lang, source) AS total, sum(n) OVER (PARTITION BY lang, term) AS whole, sum(n) OVER (PARTITION BY lang) AS everything, count(*) OVER (PARTITION BY lang, source) AS v FROM cell) x),
pair AS (SELECT a.lang, a.source, b.source AS item, sum({_APART}) AS value FROM (SELECT lang, source, term, p FROM share) a JOIN (SELECT lang, source, term, p AS q FROM share) b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source),
best AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value FROM (SELECT DISTINCT lang, source FROM d) a JOIN (SELECT DISTINCT lang, source FROM d) b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN pair ON pair.lang = a.lang AND pair.source = a.source AND pair.item = b.source
  UNION ALL SELECT lang, source, 'term', term, CAST({_APART} AS BIGINT) FROM share WHERE n > 0 AND p > q)
SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM best) x WHERE part = 'pair' OR rank <= 10
"""
ORACLES["op13_collocations"] = f"""
WITH piece AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_LOWER}, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM piece),
g AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase FROM w CROSS JOIN (VALUES (1), (2), (3)) s(k) WHERE len(w) >= k),
f AS MATERIALIZED (SELECT lang, k, phrase, string_split(phrase, ' ') AS w, count(*) AS a FROM g GROUP BY lang, k, phrase),
n AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
cand AS (SELECT * FROM f WHERE k > 1 AND a >= 10),
cut AS (SELECT c.lang, c.phrase, c.a, l.a AS l, r.a AS r, c.j, CAST(CAST(1000000 AS HUGEINT) * c.a * c.a // (CAST(l.a AS HUGEINT) * r.a) AS BIGINT) AS score FROM (SELECT *, unnest(range(1, k)) AS j FROM cand) c
  JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:j], ' ') JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[j + 1:], ' ')),
scored AS (SELECT lang, phrase, a, l, r, score FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) AS rn FROM cut) x WHERE rn = 1),
longer AS (SELECT lang, phrase, max(a) AS a FROM (SELECT lang, array_to_string(w[1:2], ' ') AS phrase, a FROM cand WHERE k = 3 UNION ALL SELECT lang, array_to_string(w[2:3], ' '), a FROM cand WHERE k = 3) x GROUP BY lang, phrase)
SELECT lang, CAST(rank AS INTEGER) AS rank, phrase, a, l, r, n, score FROM (
  SELECT s.lang, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, s.a DESC, s.phrase) AS rank, s.phrase, s.a, l, r, n.n, score FROM scored s JOIN n ON n.lang = s.lang LEFT JOIN longer ON longer.lang = s.lang AND longer.phrase = s.phrase
  WHERE longer.a IS NULL OR 100 * longer.a < 50 * s.a) x WHERE rank <= 2000
"""
