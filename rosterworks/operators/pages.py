"""Pages: one parse per page into typed features, and what columns alone can tell."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from html.parser import HTMLParser

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import params
from ..functions.exprs import any_of, contains_any, netloc, page_priority
from .classify import brand_word, independent_word

# What an address looks like in text and in links.
_EMAIL = re.compile(r"\b([A-Z0-9._%+\-]+@[A-Z0-9.\-]+\.[A-Z]{2,})\b", re.IGNORECASE)
_MAILTO = re.compile(r"mailto:([A-Z0-9._%+\-]+@[A-Z0-9.\-]+\.[A-Z]{2,})", re.IGNORECASE)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_SILENT = frozenset(("script", "style"))
#: Elements whose attributes or texts are features; of others the place in the tree is all that counts.
_READ = frozenset(("a", "meta", "script", "title"))
#: Tags in their most common form; the library's own way, which takes all others, reads these as slowly.
_RAW = frozenset("iframe noembed noframes noscript plaintext script style textarea title xmp".split())
_PLAIN_START, _PLAIN_END = re.compile(r'<([a-z][a-z0-9]*)((?: [a-z][a-z-]*="[^"&]*")*)>'), re.compile(r"</([a-z][a-z0-9]*)>")
_PLAIN_ATTR = re.compile(r' ([a-z][a-z-]*)="([^"]*)"')
LEVELS, LEAST_CONTEXT = 5, 40
#: The place of a guessed link: behind every place of a found one.
GUESSED = (1 << 63) - 1

#: What a parse can give, with its type.
FEATURES = {
    "title": "string", "meta_description": "string", "og_site_name": "string", "text": "string", "anchors": "array<struct<pos:int,href:string,text:string>>",
    "json_ld": "array<string>", "email_contexts": "array<struct<pos:int,email:string,start:int,length:int>>",
}


class _Node:
    """An element, with the stretch of the page's pieces of text that lies inside it."""

    __slots__ = ("tag", "attrs", "parent", "start", "end", "own")

    def __init__(self, tag: str, attrs: dict[str, str] | None, parent: _Node | None, start: int) -> None:
        self.tag, self.attrs, self.parent, self.start, self.end = tag, attrs, parent, start, start
        self.own = [] if tag in _SILENT else None


class _Tree(HTMLParser):
    """Reads a page in one pass; an end tag closes the nearest open node of its name, unknown ones are ignored.

    Visible text is a list of stripped pieces. A node knows where its pieces begin and end, so the length of
    any node's text is a difference of two sums, and only texts that are asked for are put together.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.now = _Node("", None, None, 0)
        self.nodes, self.pieces, self.sums, self.mailed = [], [], [0], []
        self.open = Counter()

    def updatepos(self, i, j):
        """Lines and columns are not asked for."""
        return j

    def parse_starttag(self, i):
        plain = _PLAIN_START.match(self.rawdata, i)
        if plain is None or plain[1] in _RAW or self.cdata_elem is not None:
            return super().parse_starttag(i)
        self.handle_starttag(plain[1], _PLAIN_ATTR.findall(plain[2]) if plain[2] else ())
        return plain.end()

    def parse_endtag(self, i):
        plain = _PLAIN_END.match(self.rawdata, i)
        if plain is None or self.cdata_elem is not None:
            return super().parse_endtag(i)
        self.handle_endtag(plain[1])
        return plain.end()

    def handle_starttag(self, tag, attrs):
        if tag in _READ:
            node = _Node(tag, {k: v or "" for k, v in attrs}, self.now, len(self.pieces))
            self.nodes.append(node)
        else:
            node = _Node(tag, None, self.now, len(self.pieces))
        if tag not in _VOID:
            self.now = node
            self.open[tag] += 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self._leave()

    def handle_endtag(self, tag):
        if self.open[tag]:
            while self.now.tag != tag:
                self._leave()
            self._leave()

    def _leave(self):
        self.now.end = len(self.pieces)
        self.open[self.now.tag] -= 1
        self.now = self.now.parent

    def handle_data(self, data):
        if self.now.own is not None:
            self.now.own.append(data)
            return
        if bare := data.strip():
            self.pieces.append(bare)
            self.sums.append(self.sums[-1] + len(bare) + 1)
            if "@" in bare:
                self.mailed.append((self.now, len(self.pieces) - 1))

    def close(self):
        super().close()
        while self.now is not self.root:
            self._leave()
        self.root.end = len(self.pieces)

    def span(self, start: int, end: int) -> tuple[int, int]:
        """Where pieces start to end stand in the page's text: first character and length."""
        return self.sums[start], max(0, self.sums[end] - self.sums[start] - 1)

    def text(self, node: _Node) -> str:
        """Visible text below the node, in document order, joined by spaces."""
        return " ".join(self.pieces[node.start : node.end])

    def nearby(self, node: _Node | None, fallback: tuple[int, int]) -> tuple[int, int]:
        """The span of the nearest of five nodes upwards that has at least 40 characters."""
        for _ in range(LEVELS):
            if node is None:
                break
            span = self.span(node.start, node.end)
            if span[1] >= LEAST_CONTEXT:
                return span
            node = node.parent
        return fallback


_LEFT, _RIGHT = re.compile(r"[A-Z0-9._%+\-]*\Z", re.IGNORECASE), re.compile(r"@[A-Z0-9.\-]+\.[A-Z]{2,}", re.IGNORECASE)
_WIDE = 256


def first_email(text: str) -> str | None:
    """The first address in a text; looks around each @ alone, so that long runs without one cost nothing."""
    at = text.find("@")
    while at >= 0:
        if _RIGHT.match(text, at):
            wide = _WIDE
            while (start := _LEFT.search(text[max(0, at - wide) : at]).start()) == 0 and wide < at:
                wide *= 4
            if match := _EMAIL.search(text, max(0, at - wide) + start):
                return match[1]
        at = text.find("@", at + 1)
    return None


def _distinct(text: str, mails: list[tuple[str, tuple[int, int]]]) -> list[tuple[str, tuple[int, int]]]:
    """Addresses with their spans, each pair of address and context once, the first one."""
    met: dict[tuple[str, int], tuple[set[int], set[str]]] = {}
    kept = []
    for email, (start, length) in mails:
        starts, texts = met.setdefault((email, length), (set(), set()))
        if start in starts:
            continue
        if starts:
            # Only now texts are cut: different nodes with texts of one length lie apart, so together they are no longer than the page.
            if not texts:
                texts.update(text[k : k + length] for k in starts)
            if text[start : start + length] in texts:
                continue
            texts.add(text[start : start + length])
        starts.add(start)
        kept.append((email, (start, length)))
    return kept


def parse_spans(html: str, wanted: Iterable[str] = tuple(FEATURES)) -> dict:
    """The wanted features of one page, contexts of addresses as spans of its text; time and memory grow with the page alone."""
    tree = _Tree()
    tree.feed(html)
    tree.close()
    meta = lambda key, name: next((n.attrs["content"] for n in tree.nodes if n.tag == "meta" and n.attrs.get(key) == name and n.attrs.get("content")), "")
    anchors = [n for n in tree.nodes if n.tag == "a" and "href" in n.attrs]

    def email_contexts():
        mails = [(match[1].lower(), tree.nearby(a.parent, tree.span(a.start, a.end))) for a in anchors if (match := _MAILTO.search(a.attrs["href"]))]
        mails += [(email.lower(), tree.nearby(node, tree.span(k, k + 1))) for node, k in tree.mailed if (email := first_email(tree.pieces[k]))]
        return [{"pos": k, "email": e, "start": start, "length": n} for k, (e, (start, n)) in enumerate(_distinct(tree.text(tree.root), mails))]

    made = {
        "title": lambda: next((tree.text(n) for n in tree.nodes if n.tag == "title"), ""),
        "meta_description": lambda: meta("name", "description"),
        "og_site_name": lambda: meta("property", "og:site_name"),
        "text": lambda: tree.text(tree.root),
        "anchors": lambda: [{"pos": k, "href": a.attrs["href"].strip(), "text": tree.text(a)} for k, a in enumerate(anchors)],
        "json_ld": lambda: ["".join(n.own) for n in tree.nodes if n.tag == "script" and n.attrs.get("type") == "application/ld+json"],
        "email_contexts": email_contexts,
    }
    return {c: made[c]() for c in wanted}


def parse_page(html: str) -> dict:
    """The features of one page, contexts of addresses as text; an empty page has empty ones."""
    page = parse_spans(html)
    return {**page, "email_contexts": [{"pos": m["pos"], "email": m["email"], "context": page["text"][m["start"] : m["start"] + m["length"]]} for m in page["email_contexts"]]}


def with_contexts(mails: Column, text: Column) -> Column:
    """Addresses of a parsed page with their contexts as text: array<struct<pos, email, context>>."""
    return F.transform(mails, lambda c: F.struct(c["pos"].alias("pos"), c["email"].alias("email"), F.substring(text, c["start"] + 1, c["length"]).alias("context")))


_PARSED_TYPES = {
    "title": pa.string(), "meta_description": pa.string(), "og_site_name": pa.string(), "text": pa.string(),
    "anchors": pa.list_(pa.struct([("pos", pa.int32()), ("href", pa.string()), ("text", pa.string())])), "json_ld": pa.list_(pa.string()),
    "email_contexts": pa.list_(pa.struct([("pos", pa.int32()), ("email", pa.string()), ("start", pa.int32()), ("length", pa.int32())])),
}
#: A task holds the parsed features of so many pages, or of so many bytes of HTML, at a time; the rest of the batch stays in its Arrow buffers.
PAGES_AT_ONCE, BYTES_AT_ONCE = 256, 4 << 20


def _slices(html: pa.Array) -> Iterator[tuple[int, int]]:
    """First row and number of rows of stretches of a batch within both limits; a page beyond them is alone."""
    sizes = pc.fill_null(pc.binary_length(html), 0).to_pylist()
    start, held = 0, 0
    for k, size in enumerate(sizes):
        if k > start and (k - start == PAGES_AT_ONCE or held + size > BYTES_AT_ONCE):
            yield start, k - start
            start, held = k, 0
        held += size
    if start < len(sizes):
        yield start, len(sizes) - start


def _features(kept: tuple[str, ...], wanted: tuple[str, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, rows in _slices(batch.column("html")):
                part = batch.slice(start, rows)
                parsed = [parse_spans(h or "", wanted) for h in part.column("html").to_pylist()]
                columns = {c: part.column(c) for c in ("page_id", "url")} | {c: pa.array([p[c] for p in parsed], _PARSED_TYPES[c]) for c in wanted}
                yield pa.RecordBatch.from_arrays([*columns.values(), *(part.column(c) for c in kept)], [*columns, *kept])

    return run


def page_features(pages: DataFrame, kept: tuple[str, ...] = (), wanted: tuple[str, ...] = tuple(FEATURES)) -> DataFrame:
    """One parse of every page (page_id, url, html) into typed columns; all else is column work on them.

    The columns ``kept`` of pages stay beside the features. Spark cannot tell which of these are used later on:
    those that are not ``wanted`` are not made and cross no process.
    """
    schema = ", ".join(("page_id bigint, url string", *(f"{c} {FEATURES[c]}" for c in wanted), *(f"{c} {pages.schema[c].dataType.simpleString()}" for c in kept)))
    typed = {"page_id": F.col("page_id").cast("bigint"), "url": F.col("url").cast("string")}
    return pages.withColumns(typed).select(*dict.fromkeys(("page_id", "url", "html", *kept))).mapInArrow(_features(kept, wanted), schema)


def raw_title(html: Column) -> Column:
    return F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1)


def bare_text(html: Column) -> Column:
    """Text without tags, scripts, styles and comments, spaces collapsed."""
    bare = F.regexp_replace(html, r"(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->|<[^>]*>", " ")
    return F.trim(F.regexp_replace(bare, r"\s+", " "))


def hrefs(html: Column) -> Column:
    """(href, label) of simple anchors, in order, by column functions alone."""
    found = F.regexp_extract_all(html, F.lit(r'<a href="([^"]*)">[^<]*</a>'), 0)
    return F.transform(found, lambda a: F.struct(F.regexp_extract(a, r'href="([^"]*)"', 1).alias("href"), F.regexp_extract(a, r">([^<]*)<", 1).alias("text")))


def absolute(base: Column, href: Column) -> Column:
    """href on the page ``base`` as an absolute URL without its fragment: rooted, relative or absolute."""
    site = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    folder = F.regexp_replace(F.regexp_replace(base, r"[?#].*$", ""), r"^([A-Za-z][A-Za-z0-9+.-]*://[^/]*(?:/.*)?)/[^/]*$", "$1")
    bare = F.substring_index(href, "#", 1)
    return F.when(bare.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), bare).when(bare.startswith("//"), F.concat(F.regexp_extract(base, "^([A-Za-z][A-Za-z0-9+.-]*:)", 1), bare)).when(bare.startswith("/"), F.concat(site, bare)).otherwise(F.concat(folder, F.lit("/"), bare))


def same_site_links(links: DataFrame) -> DataFrame:
    """links (page_id, url, pos, href, text) that stay on their page's host: adds ``target``."""
    found = links.withColumn("target", absolute(F.col("url"), F.col("href")))
    return found.where(netloc(F.col("target")) == netloc(F.col("url")))


def vehicle_link(text: Column) -> Column:
    """Looks like an inventory link that is about vehicles."""
    return contains_any(text, params.INVENTORY_HINTS) & contains_any(text, params.VEHICLE_WORDS) & ~contains_any(text, params.NOT_VEHICLE_WORDS)


def people_pages(links: DataFrame, homes: DataFrame, limit: int | None = 16) -> DataFrame:
    """Pages of a site that may list people: found links and guessed paths, once each, the best first.

    links: url (home page), target, text of same-site links; homes: url. A found link wins over a
    guess of the same URL. At most ``limit`` a site, by priority and URL; without a limit all of them, unranked.
    """
    seen = F.lower(F.concat_ws(" ", "href", "text"))
    found = links.where(contains_any(seen, params.PEOPLE_WORDS)).select("url", "target", page_priority(seen).alias("priority"), F.col("pos").cast("long").alias("pos"))
    guess = homes.select("url", F.explode(F.array(*[F.lit(p) for p in params.CONTACT_PATHS])).alias("path"))
    guess = guess.select("url", F.concat(F.regexp_replace("url", "/+$", ""), "path").alias("target"), page_priority(F.col("path")).alias("priority"), F.lit(GUESSED).alias("pos"))
    both = found.unionByName(guess).groupBy("url", "target").agg(F.min_by("priority", "pos").alias("priority"))
    if limit is None:
        return both
    order = Window.partitionBy("url").orderBy("priority", "target")
    return both.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= limit)


def first_usable(urls: DataFrame, pages: DataFrame) -> DataFrame:
    """Per account the first usable page of its URLs in order, else the first page at all.

    urls: account_key, pos, url; pages: url, page_id, usable.
    """
    met = urls.join(pages.select("url", "page_id", "usable"), "url")
    return met.groupBy("account_key").agg(F.min_by(F.struct("page_id", "url", "usable"), F.struct(~F.col("usable"), F.col("pos"), F.col("page_id"))).alias("p")).select("account_key", "p.*")


def inventory_probe(accounts: DataFrame, probes: DataFrame, paths=params.INVENTORY_PATHS) -> DataFrame:
    """account_key of accounts (account_key, source_url) whose inventory pages were met.

    probes (account_key, path, status_code, final_url): what became of a request for a path of the
    account's site. Only accounts whose key or URL has a brand or a word of the trade are looked at.
    A page counts if it ends on a URL that speaks of stock, the URL or the key having a brand, or if it is refused (403).
    """
    key, final = F.col("account_key"), F.lower("final_url")
    signal = any_of([word(F.coalesce(F.col(c), F.lit(""))) for c in ("account_key", "source_url") for word in (brand_word, independent_word)])
    known = accounts.where(signal).select("account_key")
    met = contains_any(final, ("inventory", "new", "used", "vehicle")) & (brand_word(final) | brand_word(key))
    hit = probes.where(F.col("path").isin(*paths) & F.coalesce(met | (F.col("status_code") == 403), F.lit(False)))
    return known.join(hit.select("account_key").distinct(), "account_key", "left_semi")


def site_pages(accounts: DataFrame, pages: DataFrame, paths=params.SITE_PATHS) -> DataFrame:
    """The pages of accounts' sites: the usable home page and usable pages of the hint paths, once per final URL.

    accounts: account_key, home (URL); pages: url, page_id, usable, final_url. Result: account_key,
    page_ord (place of the path), page_id, url, final_url. Of paths that end on one page the first counts.
    """
    site = F.regexp_replace("home", "/+$", "")
    wanted = accounts.select("account_key", F.posexplode(F.array(*[F.concat(site, F.lit(p)) for p in paths])).alias("page_ord", "url"))
    # Spark's estimate knows nothing of the paths of a site and would broadcast them all.
    met = wanted.hint("merge").join(pages.where("usable"), "url")
    first = met.groupBy("account_key", "final_url").agg(F.min(F.struct("page_ord", "page_id", "url")).alias("p"))
    return first.select("account_key", "p.*", "final_url")


def fetch_outcome(pages: DataFrame, by: str = "host", nothing: str = "no_public_html") -> DataFrame:
    """Per host (or another column): success if a page is usable, else blocked with its first marker, else unavailable.

    pages: host, page_id, usable, marker.
    """
    grouped = pages.groupBy(by).agg(F.bool_or("usable").alias("ok"), F.min_by("marker", F.when(F.col("marker").isNotNull(), F.col("page_id"))).alias("marker"))
    return grouped.select(by, F.when(F.col("ok"), "success").when(F.col("marker").isNotNull(), "blocked").otherwise("unavailable").alias("fetch_status"), F.when(~F.col("ok"), F.coalesce("marker", F.lit(nothing))).alias("reason"))


#: A table of so many hosts (of at most 255 bytes each) is broadcast; a larger one is joined by shuffling.
FEW_HOSTS = 200_000


def host_suffixes(host: Column) -> Column:
    """The host itself and every domain above it: a.b.c, b.c, c."""
    return F.transform(F.sequence(F.lit(1), F.size(F.split(host, r"\."))), lambda k: F.array_join(F.slice(F.split(host, r"\."), k, F.size(F.split(host, r"\."))), "."))


def in_host_table(df: DataFrame, host: Column, hosts: DataFrame, name: str) -> DataFrame:
    """df with the boolean column ``name``: whether a row's host is in the table (host) or below a host of it.

    Each distinct host is looked up once, by its suffixes, with a hash join; so the list may have millions of entries, and a host
    that many rows share costs no more than another.
    """
    listed = hosts.select(F.lower("host").alias("_suffix")).distinct()
    if listed.count() <= FEW_HOSTS:
        listed = F.broadcast(listed)
    keyed = df.withColumn("_host", F.lower(host))
    known = keyed.select("_host").distinct()
    met = known.select("_host", F.explode(host_suffixes(F.col("_host"))).alias("_suffix")).join(listed, "_suffix", "left_semi")
    met = met.select("_host").distinct().withColumn(name, F.lit(True))
    return keyed.join(met, "_host", "left").withColumn(name, F.coalesce(name, F.lit(False))).drop("_host")
