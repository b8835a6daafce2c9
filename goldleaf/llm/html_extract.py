"""Main text of web pages by consensus paths per host.

1. Every page scores its containers: a block of text counts its characters,
   less those in links, for the container it stands in, and by half for each
   one around it. The path of the best container - tags with classes, numbers
   generalised - is the page's vote.
2. Spark counts the votes by host. Counts aggregate before the shuffle, so a
   host with a third of all pages is no hot key; the winning paths are one row
   per host.
3. Every page is read again: it gives the text under the host's most voted path
   that the page has; a page with none of them keeps its own best container.
   Unlinked blocks that stand directly in a container around it (title, intro)
   belong to the text; other containers beside it do not.

Boilerplate never scores and is never returned: by tag (scripts, styles, forms,
menus, ...), or by a class, id or role that is, begins or ends with one of some
words (sidebar, comments, ad, ...; not has-sidebar). A name that holds more than
the word does not count on an element with more than half of the page's unlinked
text, no name does on one around the page's only article or main, and where a page
would come out empty no name counts at all.
Characters count decoded; white space in a block becomes one space; blocks are
joined in page order by an empty line.

Cases: null or empty html gives empty text; a null or odd url
has no host, so its page keeps its own best container;
unclosed, stray and crossing tags are read as browsers do in the usual cases
(a block start ends an open paragraph, an end tag closes what is open inside);
rows that repeat a page_id are pages of their own; an empty table gives no rows;
other columns are kept, those named like the results are replaced.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType

from goldleaf.llm.common import saved, widened

SHARE = 0.05  # of a host's votes that a path needs to win there

# Kinds of HTML elements, and words in classes, ids and roles.
RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "svg", "math", "xmp", "noembed", "noframes"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
DROPPED = {"aside", "button", "dialog", "fieldset", "footer", "form", "head", "label", "menu", "nav", "object", "select"}
TEXT_BLOCKS = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "ul", "ol", "dl", "dt", "dd", "blockquote", "pre", "figure",
               "figcaption", "address", "table", "thead", "tbody", "tfoot", "tr", "td", "th", "caption", "hr", "summary"}
CONTAINERS = {"html", "body", "div", "article", "section", "main", "header", "center", "details", "hgroup"} | DROPPED
CLOSED_BY_SAME = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
                  "td": {"td", "th"}, "th": {"td", "th"}}
LISTS = {"ul", "ol", "dl", "table"}
BOILER_WORDS = {
    "ad", "ads", "adv", "advert", "adverts", "advertisement", "advertising", "banner", "breadcrumb", "breadcrumbs", "byline",
    "comment", "comments", "consent", "cookie", "cookies", "copyright", "disqus", "footer", "form", "gdpr", "login", "masthead",
    "menu", "menubar", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notices", "pagination", "popup", "promo",
    "promoted", "promotion", "recommended", "related", "replies", "reply", "responses", "search", "share", "sharing", "sidebar",
    "signup", "social", "sponsor", "sponsored", "subscribe", "subscription", "toolbar", "topbar", "widget", "widgets",
    "complementary", "contentinfo", "alert", "dialog",
}
HEADER_WORDS = {"header", "masthead", "topbar"}
JOINING_WORDS = {"has", "with", "no", "without"}  # what follows is only mentioned

# A tag ends before the next "<" outside quotes, so a page of unclosed tags is read
# in linear time. A quoted value may hold "<" or ">"; with both, it must look closed.
_TOKEN = re.compile(
    r"""<!--.*?(?:--!?>|\Z)|<[!?][^>]*+>|<(/?)([a-zA-Z][^\s/<>]*+)((?:[^<>"']++|"[^"<]*+"|'[^'<]*+'"""
    r"""|"[^">]*+"|'[^'>]*+'|"[^"=]*+"(?=[\s/>])|'[^'=]*+'(?=[\s/>])|["'])*+)>""", re.S)
_ATTR = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_ANY_ATTR = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_NONE = re.compile(r"display\s*:\s*none", re.I)
_FORM_TEXT = re.compile(r"<(?:article|main|p)[\s>]", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_NUMBER = re.compile(r"\d+")


@dataclass
class Block:
    text: str
    link_chars: int
    inside: int  # index of the innermost container


@dataclass
class Page:
    """Containers (parent index, path) and text blocks outside boilerplate."""

    parents: list[int]
    paths: list[str]
    blocks: list[Block]

    def scores(self) -> dict[str, float]:
        by = defaultdict(float)
        for b in self.blocks:
            size = len(b.text)
            worth, at = size * max(0.0, 1 - b.link_chars / size) ** 2, b.inside
            while at >= 0 and worth >= 1:
                by[self.paths[at]] += worth
                worth, at = worth / 2, self.parents[at]
        return by

    def best(self) -> str | None:
        by = self.scores()
        return min(by, key=lambda p: (-by[p], len(p), p)) if by else None

    def text(self, path: str | None) -> str:
        """Blocks under containers with ``path``, and the mostly unlinked ones that
        stand directly in a container around one."""
        under: list[bool] = []
        around: set[int] = set()
        for parent, own in zip(self.parents, self.paths):
            under.append(own == path or parent >= 0 and under[parent])
            while own == path and parent >= 0 and parent not in around:
                around.add(parent)
                parent = self.parents[parent]
        return "\n\n".join(b.text for b in self.blocks if under[b.inside]
                           or b.inside in around and 2 * b.link_chars < len(b.text))


def _hidden(attrs: str) -> bool:
    """Whether an attribute hides the element: by its name, or as a style."""
    if "hidden" not in (low := attrs.lower()) and "display" not in low:
        return False
    return any(name.lower() == "hidden" or name.lower() == "style" and _NONE.search("".join(value))
               for name, *value in _ANY_ATTR.findall(attrs))


def _label(tag: str, attrs: str, in_article: bool, dropped: set[str]) -> tuple[str, bool, int]:
    """(generalised tag and classes, whether tag or style make it boilerplate,
    whether its names do: 2 by a whole one, 1 by a part of one)."""
    names, named = [], 0
    known = BOILER_WORDS if in_article else BOILER_WORDS | HEADER_WORDS
    for name, *values in _ATTR.findall(attrs):
        value = html.unescape("".join(values))
        for token in value.split():
            words = [w.lower() for w in _WORD.findall(token)]
            if len(words) == 1 and words[0] in known:
                named = 2
            elif words and (words[0] in known or words[-1] in known and JOINING_WORDS.isdisjoint(words)):
                named = max(named, 1)
        if name.lower() == "class":
            names += sorted(_NUMBER.sub("#", v) for v in value.split())
    if tag in ("html", "body", "article", "main"):
        named = 0
    hard = tag in dropped or tag == "header" and not in_article or _hidden(attrs)
    return ".".join([tag, *names]), hard, named


@dataclass
class Named:
    """An element that its names make boilerplate."""

    around: int  # index of the next such element around it, or -1
    whole: bool
    chars: int = 0  # unlinked, not in boilerplate by tag
    articles: int = 0


def parse(source: str | None) -> Page:
    """Read a page into containers and text blocks. A page whose whole text stands
    in a form that holds paragraphs or an article is read again with the form as a
    plain container; labels, buttons and fields go all the same."""
    page = _read(source, DROPPED)
    if source and not page.scores() and "<form" in source.lower() and _FORM_TEXT.search(source):
        page = _read(source, DROPPED - {"form"})
    return page


def _read(source: str | None, dropped: set[str]) -> Page:
    """One reading; again without the names that turn out to stand on its main text."""
    page, named, chars, articles = _scan(source, frozenset(), dropped)
    if not named:
        return page
    for x in reversed(named):  # inner ones come later
        if x.around >= 0:
            named[x.around].chars += x.chars
            named[x.around].articles += x.articles
    outer = [x for x in named if x.around < 0]
    chars += sum(x.chars for x in outer)
    articles += sum(x.articles for x in outer)
    spared = frozenset(k for k, x in enumerate(named) if articles == 1 and x.articles or not x.whole and 2 * x.chars > chars)
    if spared:
        page = _scan(source, spared, dropped)[0]
    return page if page.scores() else _scan(source, None, dropped)[0]


def _scan(source: str | None, spared: frozenset[int] | None, dropped: set[str]) -> tuple[Page, list[Named], int, int]:
    """One scan over the tags of a page: (page, elements that are boilerplate by
    name, unlinked characters and articles outside them). Elements in ``spared``,
    by their order, are no boilerplate by name; None spares all. Elements called as
    in ``dropped`` are boilerplate by tag."""
    source = source or ""
    last = source.rfind(">")
    parents, paths, blocks = [-1], ["body"], []
    # open elements: (tag, container index, boilerplate by tag, in article, innermost
    # element that is boilerplate by name, in one that is not spared)
    stack = [("", 0, False, False, -1, False)]
    named: list[Named] = []
    free_chars = free_articles = 0
    pieces: list[str] = []
    link_pieces: list[str] = []
    in_link = 0

    def end_block() -> None:
        if pieces:
            text = " ".join(html.unescape("".join(pieces)).split())
            if text:
                linked = len(" ".join(html.unescape("".join(link_pieces)).split()))
                blocks.append(Block(text, min(linked, len(text)), stack[-1][1]))
            pieces.clear()
            link_pieces.clear()

    def add(text: str) -> None:
        nonlocal free_chars
        _, _, hard, _, owner, cut = stack[-1]
        if not text or hard:
            return
        if not in_link:
            size = len("".join(text.split()))
            if owner >= 0:
                named[owner].chars += size
            else:
                free_chars += size
        if not cut:  # boilerplate is never gathered
            pieces.append(text)
            if in_link:
                link_pieces.append(text)

    def close(depth: int) -> None:
        nonlocal in_link
        in_link -= sum(e[0] == "a" for e in stack[depth:])
        del stack[depth:]

    at = 0
    while at < len(source):
        if at > last:  # no tag follows, at most an unclosed comment
            end = source.find("<!--", at)
            add(source[at:end] if end >= 0 else source[at:])
            break
        m = _TOKEN.search(source, at)
        add(source[at:m.start()] if m else source[at:])
        if not m:
            break
        at = m.end()
        if m[2] is None:
            continue
        tag, attrs = m[2].lower(), m[3]
        if not m[1] and tag in RAW and not attrs.endswith("/"):
            shut = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.I).search(source, at)
            at = shut.end() if shut else len(source)
            continue
        breaks = tag in TEXT_BLOCKS or tag in CONTAINERS
        if tag == "br":
            add(" ")
            continue
        if m[1]:
            depth = next((k for k in range(len(stack) - 1, 0, -1) if stack[k][0] == tag), 0)
            if breaks:
                end_block()
            if depth:
                if not breaks and any(e[0] in CONTAINERS or e[0] in TEXT_BLOCKS for e in stack[depth + 1:]):
                    # an inline end tag doesn't close blocks
                    in_link -= stack[depth][0] == "a"
                    stack[depth] = ("", *stack[depth][1:])
                else:
                    close(depth)
            continue
        if breaks:
            end_block()
            shut = CLOSED_BY_SAME.get(tag, {"p"})
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] in shut or stack[k][0] == "p":
                    close(k)
                    break
                if stack[k][0] in CONTAINERS or stack[k][0] in LISTS or stack[k][0] == "blockquote":
                    break
            if tag == "body":  # ends an unclosed head
                close(1)
        if tag in VOID:
            continue
        _, inside, hard, article, owner, cut = stack[-1]
        label, own, by_name = _label(tag, attrs, article, dropped) if breaks or attrs else (tag, tag in dropped, 0)
        if by_name and not hard and not own:
            cut |= spared is not None and len(named) not in spared
            named.append(Named(owner, by_name == 2))
            owner = len(named) - 1
        if tag in ("article", "main") and not article and not hard:
            if owner >= 0:
                named[owner].articles += 1
            else:
                free_articles += 1
        if tag in CONTAINERS and tag not in ("html", "body"):
            parents.append(inside)
            paths.append(f"{paths[inside]}>{label}")
            inside = len(paths) - 1
        stack.append((tag, inside, hard or own, article or tag in ("article", "main"), owner, cut))
        in_link += tag == "a"
        if attrs.endswith("/") and not breaks:
            close(len(stack) - 1)
    end_block()
    return Page(parents, paths, blocks), named, free_chars, free_articles


def _host():
    """Host name of the url, lower case; empty if there is none."""
    return F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))


def host_paths(pages: DataFrame, share: float = SHARE) -> DataFrame:
    """(host, paths): paths with at least ``share`` of the host's votes, most
    votes first."""
    def vote(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column("host"), pa.array([parse(s).best() for s in b.column("html").to_pylist()], pa.string())], ["host", "path"])

    votes = pages.select(_host().alias("host"), "html").where("host != ''").mapInArrow(vote, "host string, path string").where("path is not null")
    counts = saved(votes.groupBy("host", "path").agg(F.count("*").alias("votes")), "html-votes")
    all_votes = counts.groupBy("host").agg(F.sum("votes").alias("all"))
    won = counts.join(all_votes, "host").where(F.col("votes") >= share * F.col("all"))
    return won.groupBy("host").agg(F.transform(
        F.sort_array(F.collect_list(F.struct((-F.col("votes")).alias("v"), "path"))), lambda x: x["path"]).alias("paths"))


def extract(pages: DataFrame, share: float = SHARE) -> DataFrame:
    """``pages`` with ``text``, ``n_chars`` and ``path`` (the container used)."""
    pages = pages.drop("text", "n_chars", "path")
    won = saved(host_paths(pages, share), "html-paths").withColumnsRenamed({"host": "_won_host", "paths": "_won_paths"})
    joined = pages.withColumn("_host", _host()).join(won, F.col("_host") == F.col("_won_host"), "left").drop("_host", "_won_host")

    def run(batches):
        for b in batches:
            texts, paths = [], []
            for source, voted in zip(b.column("html").to_pylist(), b.column("_won_paths").to_pylist()):
                page = parse(source)
                has = page.scores()
                path = next((p for p in voted or () if p in has), None) or page.best()
                texts.append(page.text(path) if path else "")
                paths.append(path)
            out = b.drop_columns(["_won_paths"])
            yield pa.RecordBatch.from_arrays(
                [*out.columns, pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()), pa.array(paths, pa.string())],
                [*out.schema.names, "text", "n_chars", "path"])

    return joined.mapInArrow(run, widened(joined.drop("_won_paths"), text=StringType(), n_chars=LongType(), path=StringType()))
