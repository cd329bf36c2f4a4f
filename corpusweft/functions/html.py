"""HTML to titles, paragraphs and links, in one Arrow-batched parse of each page."""

from __future__ import annotations

import codecs
import re
from html.parser import HTMLParser

from pyspark.sql import DataFrame, functions as F

from ..config import SMALL, Config
from .url import resolve, url_join
from . import url as U
from .vectorised import sliced

BLOCKS = frozenset("address article aside blockquote body caption center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main nav ol optgroup option p pre section select table tbody td tfoot th thead title tr ul".split())
SILENT = frozenset("script style noscript template head iframe object embed svg".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
PARAGRAPH = "struct<text:string,words:int,link_chars:int,dom_path:string>"
PAGE = f"title string, paragraphs array<{PARAGRAPH}>, hrefs array<string>, base string"


class PageParser(HTMLParser):
    """Collects paragraphs at block tags; forgives tags that never close."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.stack: list[str] = []
        self.title, self.base = None, None
        self.hrefs: list[str] = []
        self.paragraphs: list[dict] = []
        self._text: list[str] = []
        self._links, self._silent, self._in_link, self._breaks = 0, 0, 0, 0
        self._title: list[str] | None = None

    def flush(self) -> None:
        text = re.sub(r"\s+", " ", "".join(self._text)).strip()
        if text:
            self.paragraphs.append({"text": text, "words": len(text.split()), "link_chars": self._links, "dom_path": ".".join(t for t in self.stack if t in BLOCKS)})
        self._text, self._links = [], 0

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        a = dict(attrs)
        if tag == "base" and self.base is None and a.get("href"):
            self.base = a["href"]
        if tag == "title" and self.title is None and self._title is None:
            self._title = []
        elif self._title is not None and tag != "title":
            self._title = None if not self._title else self._title
        if tag == "a" and a.get("href") and a.get("rel") != "nofollow":
            self.hrefs.append(a["href"])
        if tag == "br":
            self._breaks += 1
            if self._breaks == 2:  # two line breaks part paragraphs
                self.flush()
            else:
                self._text.append(" ")
            return
        if tag in BLOCKS:
            self.flush()
        if tag not in VOID:
            self.stack.append(tag)
            self._silent += tag in SILENT
            self._in_link += tag == "a"

    def handle_endtag(self, tag: str) -> None:
        if tag == "title" and self._title is not None:
            self.title, self._title = "".join(self._title), None
        if tag in BLOCKS:
            self.flush()
        if tag in self.stack:
            while self.stack:
                top = self.stack.pop()
                self._silent -= top in SILENT
                self._in_link -= top == "a"
                if top == tag:
                    break

    def handle_data(self, data: str) -> None:
        if self._title is not None:
            self._title.append(data)
            return
        if self._silent:
            return
        if data.strip():
            self._breaks = 0
        self._text.append(data)
        if self._in_link:
            self._links += len(re.sub(r"\s+", " ", data).strip())


def parse_page(html: str | None) -> dict:
    p = PageParser()
    try:
        p.feed(html or "")
        p.close()
        p.flush()
    except (AssertionError, ValueError):
        pass  # what was read so far stands
    title = re.sub(r"\s+", " ", p.title or "").strip()[:300]
    return {"title": title, "paragraphs": p.paragraphs, "hrefs": p.hrefs, "base": p.base}


@sliced(PAGE)
def parsed_page(html: list[str | None]) -> list[dict]:
    return [parse_page(h) for h in html]


def absolute_links(source: str, base: str | None, hrefs: list[str]) -> list[str]:
    """Distinct absolute links in order; lines of a link are joined."""
    start = base.rstrip("/") + "/" if base else source
    out: dict[str, None] = {}
    for h in hrefs:
        h = "".join(x.replace("%20", " ").strip().replace(" ", "%20") for x in h.split("\n"))
        full = resolve(start, h) if h else None
        if full:
            out[full] = None
    return list(out)


@sliced("array<string>")
def links_of(source: list[str], html: list[str | None]) -> list[list[str]]:
    """Links of whole pages, parsed and resolved in one pass."""
    pages = ((src, parse_page(h)) for src, h in zip(source, html))
    return [absolute_links(src, p["base"], p["hrefs"]) for src, p in pages]


def page_links(pages: DataFrame, url: str = "url", html: str = "html", config: Config = SMALL, **lists) -> DataFrame:
    """(url, link, scheme, host, path, reason) of each distinct link of a URL; a reason marks ignored and binary ones."""
    links = pages.select(F.col(url), F.explode(links_of(F.col(url), F.col(html))).alias("link"))
    return U.admit(links.distinct(), "link", config, **lists)  # two pages can share a URL


def edges(links: DataFrame, url: str = "url") -> DataFrame:
    """Link edges (src_scheme, src_host, scheme, host, path), distinct, of admitted links."""
    u = F.col(url)
    return links.where("reason is null").select(U.scheme_of(u).alias("src_scheme"), U.host_of(u).alias("src_host"), "scheme", "host", "path").distinct()


def codec(name: str | None) -> str | None:
    try:
        return codecs.lookup(name).name if name else None
    except LookupError:
        return None


def decode_html(body: bytes | None, detected: str | None = None) -> tuple[str | None, str | None]:
    """(text, declared encoding): the detected, then the declared, then UTF-8; null text if none fits."""
    head = (body or b"").decode("latin-1")
    m = re.search(r"(?is)<meta[^>]*charset\s*=\s*['\"]?([a-z0-9_:.\-]+)", head) or re.search(r"(?is)<meta[^>]*http-equiv=['\"]?charset['\"]?[^>]*content=['\"]?([a-z0-9_:.\-]+)", head)
    declared = codec(m[1]) if m else None
    for name in (codec(detected), declared if declared != "utf-8" else None, "utf-8"):
        try:
            if name:
                return (body or b"").decode(name), declared
        except UnicodeError:
            continue
    return None, declared


def decode_text(body: bytes | None, candidates: tuple[str, ...] = ()) -> str | None:
    for name in (*candidates, "utf-8"):
        try:
            return (body or b"").decode(name)
        except (UnicodeError, LookupError):
            continue
    return None


@sliced("text string, declared string")
def decoded_html(body: list[bytes | None], detected: list[str | None]) -> list[dict]:
    return [dict(zip(("text", "declared"), decode_html(b, d))) for b, d in zip(body, detected)]


def regex_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Distinct (url, link) of root-relative and absolute hrefs by expressions alone; leaves out nofollow."""
    anchors = F.expr(f"filter(regexp_extract_all({html}, '(?i)<a[^>]*>', 0), x -> not x rlike '(?i)rel=.?nofollow')")
    hrefs = F.transform(anchors, lambda a: F.regexp_extract(a, r"href=\"([^\"#]*)", 1))
    site = url_join(U.scheme_of(F.col(url)), U.host_of(F.col(url)), F.lit("/"))
    full = lambda h: F.when(h.rlike("(?i)^https?://"), h).otherwise(F.concat(F.regexp_replace(site, "/$", ""), h))
    found = pages.select(F.col(url), F.explode_outer(F.array_distinct(F.transform(F.filter(hrefs, lambda h: h.rlike("(?i)^(/|https?://)")), full))).alias("link"))
    return found.where("link is not null").distinct()  # two pages can share a URL
