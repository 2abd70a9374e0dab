"""HTML extraction by equivalence-class template deduction over pages of one host.

1. A page becomes a list of elements (their paths of tags with class and id) and of text blocks, read by a tolerant
   tokenizer: comments, raw-text elements and markup vanish, unclosed paragraphs, items and cells end where the next
   begins, character references are decoded after the markup is gone.
2. In a group of same-host pages every element path has an occurrence vector (its count in each page).  Paths that share
   a vector form an equivalence class; a class is valid if enough pages have it and its paths stand in one order in all
   of them.  Valid classes nest by path into the template; the class that occurs once in every page is its skeleton.
   Blocks hang in the slots between template elements.
3. Slots below elements that are furniture by tag, role, class or id (menus, headers, footers, sidebars, notices,
   adverts, forms, reader comments) are closed; no class word and no form closes the main element or one that holds it,
   and headings in an article's header stay.  What remains is the main text: all article and main elements if the
   page marks any, else the whole page.  In both, blocks that repeat word for word in most pages that fill their slot
   belong to the template (``repeated_blocks``); nothing else goes, not even blocks that are one link (titles, lists of
   references).  Pages with and without marks have templates of their own.
4. White space inside a block becomes one space; blocks are joined in page order by two line feeds.

Hosts with many pages are dealt out into groups of about ``group_pages`` by a hash of page_id, so a host with a third of
all pages is many groups.  Null or empty html, and pages without main text, give an empty text; null URLs are one host;
repeated rows and null page_ids are extracted each.  A single page has no class to compare with: rules 3 and 4 alone.
"""

from __future__ import annotations

import html as entities
import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ripplet.llm.urls import split_url
from ripplet.session import materialize

# Element kinds of HTML and the words that name page furniture.
RAW = "script style noscript template iframe svg canvas object textarea select title math audio video xmp noembed noframes"
# a head counts as void: its texts are raw, so nothing depends on where it ends
VOID = set("area base head br col embed hr img input link meta param source track wbr".split())
INLINE = set("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike "
             "strong sub sup time tt u var wbr".split())
FURNITURE_TAGS = set("nav header footer aside form button dialog menu fieldset".split())
FURNITURE_ROLES = set("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
FURNITURE_WORDS = set("ad ads adv advert adverts advertisement advertising adbox adslot banner sponsor sponsored promo promotion menu nav navbar "
                      "navigation breadcrumb breadcrumbs header masthead topbar footer sidebar aside rail widget widgets related recommended "
                      "recommendations teaser teasers share sharing social follow cookie cookies consent gdpr privacy notice notices notification alert popup "
                      "modal overlay newsletter subscribe subscription signup login paywall search comment comments commentlist disqus "
                      "discussion reply replies respond responses reactions pagination pager copyright legal disclaimer toolbar skip "
                      "hidden trending popular".split())
FURNITURE_STEMS = ("comment", "sidebar", "cookie", "newsletter", "advert", "breadcrumb", "sponsor", "navbar", "masthead")
HEADER_WORDS = {"header", "masthead"}
TALK_WORDS = set("comment comments commentlist disqus discussion reply replies respond responses reactions".split())
LAYOUT_WORDS = {"with", "has", "no", "without"}
STATE_WORDS = {"open", "closed", "enabled", "disabled", "on", "off", "free"}
SUBJECT_WORDS = {"category", "cat", "tag", "topic", "term", "taxonomy"}
POST_WORDS = {"post", "hentry", "entry", "article", "story", "content"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
ITEMS = {"li", "dt", "dd", "td", "th"}
ENDS = {"p": {"p"}, "li": {"li"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"},
        "option": {"option"}, "thead": {"tr", "td", "th"}, "tbody": {"tr", "td", "th", "thead"}}
SCOPE = {"p": set(), "li": {"ul", "ol", "menu"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"}, "dt": {"dl"}, "dd": {"dl"},
         "option": {"select"}, "thead": {"table"}, "tbody": {"table"}}

_RAW = "|".join(RAW.split())
_MARKUP = re.compile(rf"<!--.*?(?:-->|\Z)|<({_RAW})(?=[\s/>])(?:[^>\"']|\"[^\"]*\"|'[^']*')*(?<!/)>.*?(?:</\1\s*>|(?=<body[\s/>])|\Z)|<!\[CDATA\[.*?\]\]>"
                     rf"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*|[^>]*)>|<[!?/][^>]*(?:>|\Z)", re.S | re.I)
_ATTRIBUTE = re.compile(r"""(class|id|role|hidden|aria-hidden|itemprop|style)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+)))?(?=[\s/>]|\Z)""", re.I)
_CAMEL = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


class Element:
    __slots__ = ("tag", "path", "parent", "furniture", "main", "number", "named", "form", "heads", "talk", "title")

    def __init__(self, tag, attributes, parent, number):
        self.tag, self.parent, self.number = tag, parent, number
        values = {m[1].lower(): (m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(attributes)} if attributes else {}
        classes = values.get("class", "").split()
        label = tag + "".join("." + c for c in classes)
        self.path = (parent.path if parent else "") + "/" + label
        role = values.get("role", "").lower()
        self.main = tag in ("article", "main") or role == "main" or values.get("itemprop", "").lower() == "articlebody"
        words, self.title = [], False
        for token in [*classes, *values.get("id", "").split()]:
            parts = [w.lower() for w in _CAMEL.findall(token)]
            # "comments-open" is a state and, of a post, "category-legal" its subject
            if len(parts) > 1 and (parts[-1] in STATE_WORDS or parts[0] in SUBJECT_WORDS and (self.main or not POST_WORDS.isdisjoint(classes))):
                continue
            self.title |= not HEADER_WORDS.isdisjoint(parts) and not POST_WORDS.isdisjoint(parts)
            words += parts
        # "with-sidebar" names a layout, not a sidebar
        words = {w for w, before in zip(words, [""] + words) if before not in LAYOUT_WORDS}
        names = {w for w in words if w in FURNITURE_WORDS or w.startswith(FURNITURE_STEMS)}
        shut = "hidden" in values or values.get("aria-hidden", "").lower() == "true" or "display:none" in values.get("style", "").replace(" ", "").lower()
        self.named = bool(names) and tag not in ("html", "body")
        self.talk = self.named and any(w in TALK_WORDS or w.startswith("comment") for w in names)
        self.form = not shut and (tag == "form" and role not in FURNITURE_ROLES - {"form"} or role == "form" and tag not in FURNITURE_TAGS)
        self.heads = not shut and (tag == "header" or self.named and names <= HEADER_WORDS and tag not in FURNITURE_TAGS and role not in FURNITURE_ROLES)
        # 2: by its tag or role, 1: by its name (unless it turns out to be or hold the main element)
        self.furniture = 2 if tag in FURNITURE_TAGS or role in FURNITURE_ROLES or shut else 1 if self.named else 0

    def line(self):
        e = self
        while e is not None:
            yield e
            e = e.parent


class Page:
    """Elements and blocks (element, text) of one page."""

    def __init__(self, source: str):
        self.elements: list[Element] = []
        self.blocks: list[tuple[Element, str]] = []
        root = self._open("#page", "", None)
        top, text, at = root, [], 0

        def flush(element):
            joined = " ".join("".join(text).split())
            if joined:
                self.blocks.append((element, joined))
            text.clear()

        for m in _MARKUP.finditer(source):
            if m.start() > at:
                text.append(entities.unescape(source[at:m.start()]))
            at = m.end()
            name = (m[3] or "").lower()
            if not name:
                if m[0][:9].upper() == "<![CDATA[":
                    text.append(m[0][9:-3])
                continue
            if name in INLINE:
                if name == "br":
                    text.append(" ")
                continue
            flush(top)
            if m[2]:
                e = top
                while e is not root and e.tag != name:
                    e = e.parent
                if e is not root:
                    top = e.parent
                continue
            if name in VOID:
                continue
            for _ in range(2):  # an element that ends where its kind begins
                e = top
                while e is not root and e.tag in ENDS.get(name, ()) or e is not root and e.tag == "p":
                    top = e = e.parent
                e = top
                while e is not root and e.tag not in ENDS.get(name, ()) and e.tag not in SCOPE.get(name, {e.tag}):
                    e = e.parent
                if e is not root and e.tag in ENDS.get(name, ()):
                    top = e.parent
            top = self._open(name, m[4], top)
        if at < len(source):
            text.append(entities.unescape(source[at:]))
        flush(top)

    def _open(self, tag, attributes, parent):
        e = Element(tag, attributes or "", parent, len(self.elements))
        self.elements.append(e)
        return e


def _sizes(page: Page, shut) -> list[int]:
    """Characters that each element holds outside the elements for which ``shut`` is true."""
    out, off = [0] * len(page.elements), set()
    for e in page.elements:  # parents come first
        if e.parent is not None and e.parent.number in off or shut(e):
            off.add(e.number)
    for e, text in page.blocks:
        if e.number not in off:
            for x in e.line():
                out[x.number] += len(text)
    return out


def _hard(e: Element) -> bool:
    """Closed whatever it holds."""
    return e.furniture == 2 and e.tag != "header" and not e.form


def _main_elements(page: Page) -> list[Element]:
    """The marked elements that no furniture closes.  A class word alone closes none that is the main element: without
    others, or with half of the page's text."""
    marks = [e for e in page.elements if e.main and not any(_hard(x) for x in e.line())]
    names = {e.number: [x for x in e.line() if x.named and x.furniture != 2] for e in marks}
    free = [e for e in marks if not names[e.number]]
    if len(free) == len(marks):
        return free
    articles = {e.number for e in free if e.tag == "article"}
    size = _sizes(page, _hard)
    doubtful = [e for e in marks if names[e.number] and size[e.number] and not any(x.number in articles for x in e.line())]
    large = [e for e in doubtful if 2 * size[e.number] >= size[0]]
    # neither a comment beside an article, nor an element with two such names in a row
    out = free + [e for e in large if not e.named or len(names[e.number]) == 1 and not (e.talk and articles)]
    if not free:
        out += [e for e in doubtful if not e.named and not any(x.talk for x in names[e.number])]
        several = [e for e in doubtful if e.named and len(names[e.number]) == 1 and not e.talk]
        if 2 * sum(size[e.number] for e in several if not any(x.main for x in e.line() if x is not e)) >= size[0]:
            out += several
    return out


def _furniture(page: Page) -> set[int]:
    """Numbers of the elements that are, or stand in, page furniture."""
    main = _main_elements(page)
    keep = {x.number for e in main for x in e.line()}
    forms = [e for e in page.elements if e.form and not e.named and e.number not in keep]
    if forms:  # a form around the text is no furniture
        size = _sizes(page, lambda e: e.number not in keep and not e.form and e.furniture)
        share = 0.9 if main else 0.5
        keep.update(x.number for e in forms if size[e.number] and size[e.number] >= share * size[0] for x in e.line())
    inside = {e.number for e in main}
    out: dict[int, Element] = {}  # the outermost element that closes it
    for e in page.elements:  # parents come first
        top = out.get(e.parent.number) if e.parent is not None else None
        if top is None:
            if _hard(e) or e.furniture and e.number not in keep:
                out[e.number] = e
        # a heading in an article's own header is its title
        elif not (e.tag in HEADINGS and not e.furniture and top.heads and (top.title or any(x.number in inside for x in top.line()))
                  and all(x.heads or not x.furniture for x in e.line() if x.number in out)):
            out[e.number] = top
    return set(out)


class Template:
    """Valid equivalence classes of the element paths of a group of pages."""

    def __init__(self, pages: list[Page], least_pages: int = 3):
        n = len(pages)
        vectors: dict[str, np.ndarray] = {}
        first: list[dict[str, int]] = []
        for i, p in enumerate(pages):
            seen: dict[str, int] = {}
            for e in p.elements:
                vectors.setdefault(e.path, np.zeros(n, np.int32))[i] += 1
                seen.setdefault(e.path, e.number)
            first.append(seen)
        classes: dict[bytes, list[str]] = {}
        for path, v in vectors.items():
            classes.setdefault(v.tobytes(), []).append(path)
        self.skeleton: set[str] = set()
        self.tokens: dict[str, int] = {}  # path -> class number
        for k, paths in enumerate(classes.values()):
            v = vectors[paths[0]]
            has = np.flatnonzero(v)
            if len(has) < min(n, max(least_pages, n // 2)):
                continue
            orders = {tuple(sorted(paths, key=first[i].__getitem__)) for i in has.tolist()}
            if len(orders) > 1:  # its paths change places: no template
                continue
            self.tokens.update(dict.fromkeys(paths, k))
            if (v == 1).all():
                self.skeleton.update(paths)

    def slot(self, e: Element) -> str:
        """The nearest template element around a block."""
        return next((x.path for x in e.line() if x.path in self.tokens), "")


def repeated_blocks(template: Template, pages: list[list[tuple[Element, str]]], least_pages: int = 3) -> set[tuple[str, str, str]]:
    """(slot, path, text) of the blocks that belong to the template: they stand word for word in most pages that fill the
    slot.  Pages that differ in headings and repeated blocks only are copies and count as one, so no copied article
    becomes a template.  Where the text at a path changes from page to page, list items, cells and headings are data even
    if they repeat, and other blocks must stand in nearly all pages and be no more than the changing ones."""
    keys = [{(template.slot(e), e.path, t): e for e, t in blocks} for blocks in pages]

    def often(chosen, share):
        count, holders = {}, {}
        for page in chosen:
            for key in page:
                count[key] = count.get(key, 0) + 1
            for slot in {key[0] for key in page}:
                holders[slot] = holders.get(slot, 0) + 1
        return {key for key, n in count.items() if n >= max(least_pages, share * holders[key[0]])}
    first = often(keys, 0.6)
    if not first:
        return set()
    different = {frozenset(key[2] for key, e in page.items() if key not in first and e.tag not in HEADINGS): page for page in reversed(keys)}
    chosen = list(different.values())
    most, nearly_all = often(chosen, 0.6), often(chosen, 0.9)
    size: dict[tuple, list[int]] = {}  # (slot, path) -> characters and blocks that change, characters and blocks that repeat
    for page in chosen:
        for key in page:
            n, at = size.setdefault(key[:2], [0, 0, 0, 0]), 2 if key in most else 0
            n[at] += len(key[2])
            n[at + 1] += 1
    tags = {key: e.tag for page in chosen for key, e in page.items()}
    out = set()
    for key in most:
        change, changing, repeat, repeating = size[key[:2]]
        if change < 0.25 * (change + repeat) or tags[key] not in HEADINGS | ITEMS and key in nearly_all and repeating <= changing:
            out.add(key)
    return out


def extract(sources: list[str], least_pages: int = 3) -> list[str]:
    """Main text of each page of a group of same-host pages."""
    pages = [Page(s or "") for s in sources]
    closed = [_furniture(p) for p in pages]
    open_blocks = [[b for b in p.blocks if b[0].number not in shut] for p, shut in zip(pages, closed)]
    marked = [{x.number for x in p.elements if x.main and x.number not in shut} for p, shut in zip(pages, closed)]
    out = [""] * len(pages)
    for kind in (True, False):
        chosen = [i for i, m in enumerate(marked) if bool(m) == kind]
        template = Template([pages[i] for i in chosen], least_pages)
        inside = [[b for b in open_blocks[i] if not kind or any(x.number in marked[i] for x in b[0].line())] for i in chosen]
        repeats = repeated_blocks(template, inside, least_pages)
        for i, blocks in zip(chosen, inside):
            out[i] = "\n\n".join(t for e, t in blocks if (template.slot(e), e.path, t) not in repeats)
    return out


def main_text(pages: DataFrame, group_pages: int = 64) -> DataFrame:
    """One row per page: page_id, url, text."""
    host, _ = split_url(F.col("url"))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    named = rows.withColumn("host", host)
    # written first, so that the planner sees its size; dealt out by both keys, or a host's groups would share a task
    groups = materialize(named.groupBy("host").agg(F.count("*").alias("n")).select("host", F.ceil(F.col("n") / group_pages).alias("groups")), "page-hosts")
    dealt = (named.join(groups, "host").withColumn("part", F.pmod(F.xxhash64("page_id", "url"), F.col("groups")))
             .repartition("host", "part"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"page_id": pdf["page_id"], "url": pdf["url"], "text": extract([x if isinstance(x, str) else "" for x in pdf["html"]])})
    return dealt.select("host", "part", "page_id", "url", "html").groupBy("host", "part").applyInPandas(run, "page_id long, url string, text string")
