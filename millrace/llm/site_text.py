"""Main text of web pages, without what a site repeats on its pages.

1. Every page is parsed, tolerantly, and each block element's subtree (names and text, no attributes) hashed.
2. Spark counts, for every host, on how many different pages a subtree of the main part occurs. Pages whose main parts
   have one and the same text count once, so that copies of a page do not make its article a template, whatever
   title, menu or links stand around them.
3. Subtrees on a large part of their host's pages are deleted from those pages: `share` of at least `pages` of them.
   Articles may be copied or quote each other, so for all that is inside an article or marked main part it is
   `prose_share` of at least `prose_pages`, and for what is or holds paragraphs, headings or lists on other pages
   `prose_share` of at least `pages`. What step 4 drops is not counted: a teaser in the sidebars of a site must not
   delete the paragraph that it repeats.
4. From what is left go elements that their name, role, class or id marks as menu, header, footer, sidebar, notice,
   advert, form, script, style or reader comments. Words after `with`, `has` or `no` in a class or id tell how a page is
   laid out and mark nothing, and an element that wraps the page's text is no such part, whatever its class; nor is a form. Within an article a
   class with other words beside the marking one (`market-share`) marks no paragraph, heading, list or table, and no part that
   holds a text. Labels and buttons stay within a sentence. Of the main part, else all articles, else the body, the blocks'
   texts are joined, after a title that stands before them and what follows it.

A null html is an empty page with an empty text; a null or odd url has no host and only step 4 applies.
Repeated rows are extracted alike. An empty table gives no rows. Columns other than `page_id`, `url` and `html`
are not looked at.
"""

from __future__ import annotations

import html as references
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import cut, map_batches
from millrace.session import fits_broadcast

SHARE, PAGES = 0.25, 4
PROSE_SHARE, PROSE_PAGES = 0.6, 10
PLAIN, PROSE_OUTSIDE, INSIDE = range(3)  # kinds of blocks, each with its own threshold

# fixed values: element names by their role
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noscript noembed noframes template svg".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody "
    "tfoot thead tr ul caption option search".split()
)
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 li blockquote pre dl dt dd table tbody thead tr figure figcaption ul ol".split())
DROPPED = frozenset("head nav footer aside menu search dialog select input fieldset object audio video canvas".split()) | RAW
CONTROLS = frozenset("input select textarea button".split())
SPOKEN = frozenset("label button".split())  # may be words of a sentence
DROPPED_ROLES = frozenset(
    "navigation banner contentinfo complementary search alert alertdialog dialog menu menubar toolbar tablist".split()
)
# fixed values: words in a class or id that mark what is not the article
MARKS = frozenset(
    "ad ads adbox adslot advert adverts advertisement advertising sponsor sponsored promo promotion promoted banner "
    "nav navbar navigation menu breadcrumb breadcrumbs sidebar sidenav rail footer masthead topbar toolbar cookie "
    "cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe subscription "
    "signup login share sharing social related recommended recommendations comment comments commentlist disqus "
    "respond widget widgets pagination pager searchbox searchform skip skiplink paywall outbrain taboola copyright "
    "announcement".split()
)
# fixed values: words that say no more than the mark beside them
GENERIC = frozenset(
    "area articles bar block body bottom box btn button buttons col container content count feed form global group header "
    "icons inner item items left link links list main message module outer page panel post posts right row section site "
    "slot small stories text title top unit wrap wrapper".split()
)
PROSE_LEAST = 140  # characters outside links that make a marked part of an article a text
LAYOUT = frozenset("with without has have no not".split())  # what follows in the same class is not the element's own role
MARK_STEMS = ("cookie", "advert", "newsletter", "sidebar", "breadcrumb", "sponsor")
# fixed values: those that tell other articles from the page's own
OTHER_ARTICLE = frozenset("comment comments reply teaser related recommended promo promoted sponsored ad advert".split())
MAIN_MARKS = frozenset("article content post entry story main".split())
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
_TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|"
    r"<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>]*+))*+)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([a-zA-Z][^\s=/>]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.S)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


class Page:
    """Nodes in page order. Of node i: `tag` (None for text), `text` or attributes, `parent`, `end` of its subtree."""

    def __init__(self, source: str) -> None:
        self.tag: list[str | None] = ["#page"]
        self.value: list[str] = [""]
        self.parent = [-1]
        self.end = [0]
        stack = [0]
        opened: Counter[str] = Counter()

        def close(to: int) -> None:
            while len(stack) > to:
                node = stack.pop()
                self.end[node] = len(self.tag)
                opened[self.tag[node]] -= 1

        def add(tag: str | None, value: str) -> int:
            self.tag.append(tag)
            self.value.append(value)
            self.parent.append(stack[-1])
            self.end.append(len(self.tag))
            return len(self.tag) - 1

        def open_at(names, stop) -> int | None:
            if not any(opened[x] for x in names):
                return None
            for at in range(len(stack) - 1, 0, -1):
                name = self.tag[stack[at]]
                if name in names:
                    return at
                if name in stop:
                    return None
            return None

        at, size = 0, len(source)
        while at < size:
            found = _TOKEN.search(source, at)
            start = found.start() if found else size
            if start > at:
                add(None, source[at:start])
            if not found:
                break
            at = found.end()
            name = found[2]
            if not name:
                if found[0].startswith("<![CDATA["):
                    add(None, found[0][9:].removesuffix("]]>"))
                continue
            name = name.lower()
            if found[1]:
                level = open_at({name}, () if name in ("article", "body", "html", "main") else ("article", "body", "main"))
                if level is not None:
                    close(level)
                continue
            if name in CLOSES:
                level = open_at(*CLOSES[name])
                if level is not None:
                    close(level)
            elif name in BLOCK:
                level = open_at({"p"}, {"article", "body", "main", "td", "th", "li", "div", "section", "blockquote"})
                if level is not None:
                    close(level)
            node, closed = add(name, found[3].rstrip("/ \t\r\n")), found[3].endswith("/")
            if name in RAW and not closed:
                stop = re.compile(rf"</{name}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(source, at)
                at = stop.end() if stop else size
            elif name not in VOID and not (closed and name not in BLOCK):
                stack.append(node)
                opened[name] += 1
        close(0)
        self.sizes = [0, *accumulate(len(v) if t is None else 0 for t, v in zip(self.tag, self.value, strict=True))]  # before each node
        self.titles = [i for i, t in enumerate(self.tag) if t == "h1"]

    def attributes(self, node: int) -> dict[str, str]:
        raw = self.value[node]
        if not raw or raw.isspace():
            return {}
        return {k.lower(): references.unescape(a or b or c) for k, a, b, c in _ATTRIBUTE.findall(raw)}

    def names(self, attributes: dict[str, str]) -> list[list[str]]:
        """Words of each class and of the id, up to one that tells of the layout."""
        out = []
        for name in f"{attributes.get('class', '')} {attributes.get('id', '')}".split():
            found = [w.lower() for w in _WORDS.findall(name)]
            out.append(found[: next((k for k, w in enumerate(found) if w in LAYOUT), None)])
        return out

    def words(self, attributes: dict[str, str]) -> set[str]:
        return {w for name in self.names(attributes) for w in name}

    def text_size(self, node: int) -> int:
        return self.sizes[self.end[node]] - self.sizes[node]

    def roots(self) -> list[int]:
        """The nodes that hold the main text, in page order: the main part, else all articles, else the body."""
        tags = self.tag
        articles, mains, marked, body, i = [], [], [], 0, 1
        covered = 0  # end of the last article or main part
        while i < len(tags):
            name = tags[i]
            if name is None:
                i += 1
                continue
            own = self.attributes(i) if self.value[i] else {}
            words = self.words(own) if own else set()
            if name == "body":
                body = body or i
            elif name in DROPPED or own.get("role") in DROPPED_ROLES or own.get("aria-hidden") == "true" or "hidden" in own:
                i = self.end[i]
                continue
            elif name == "article":
                if not words & OTHER_ARTICLE and i >= covered:
                    articles.append(i)
                i = self.end[i]
                continue
            elif name == "main" or own.get("role") == "main":
                if i >= covered:
                    mains.append(i)
                    covered = self.end[i]
            elif own.get("itemprop") == "articleBody" or (name in ("div", "section") and words & MAIN_MARKS and not words & MARKS):
                marked.append(i)
            i += 1
        if mains:
            return [max(mains, key=lambda k: (self.text_size(k), -k))]
        if articles:
            return articles
        best = max(marked, key=lambda k: (self.text_size(k), -k), default=body)
        # a class is a weaker sign than an element: what it marks has to be a good part of the page
        return [best if 3 * self.text_size(best) >= self.text_size(body) else body]

    def lead(self, roots: list[int]) -> int | None:
        """A heading of the first level before the main text, where that has none: the title that stands outside of it."""
        first = roots[0]
        if self.tag[first] in ("#page", "html", "body"):
            return None
        if any(bisect_left(self.titles, k) < bisect_left(self.titles, self.end[k]) for k in roots):
            return None
        before = self.titles[: bisect_left(self.titles, first)]
        return next((k for k in reversed(before) if self.end[k] <= first and not self._in_marked(k)), None)

    def _in_marked(self, node: int) -> bool:
        while node > 0:
            if self.marked(node, False):
                return True
            node = self.parent[node]
        return False

    def wraps(self, node: int, outer: int, inside: bool) -> bool:
        """Does the element hold the text of `outer`, so that its class or id cannot mean that it is something else?

        It has most of the text, and either a heading of the first level or next to nothing is left without it.
        """
        size = self.text_size(node)
        if 2 * size <= self.text_size(outer):
            return False
        if bisect_left(self.titles, node) < bisect_left(self.titles, self.end[node]):
            return True
        left, i, last = 0, outer + 1, self.end[outer]
        while i < last:
            if i == node or (self.tag[i] is not None and self.marked(i, inside)):
                i = self.end[i]
                continue
            left += len(self.value[i].strip()) if self.tag[i] is None else 0
            i += 1
        return 10 * left < size

    def _prose(self, node: int) -> bool:
        """Does the element hold a text: no controls, and enough words outside its links?"""
        linked, i = 0, node
        while i < self.end[node]:
            if self.tag[i] in CONTROLS:
                return False
            if self.tag[i] == "a":
                linked += self.text_size(i)
                i = self.end[i]
            else:
                i += 1
        size = self.text_size(node)
        return size - linked >= PROSE_LEAST and 3 * linked <= size

    def _spoken(self, node: int) -> bool:
        """Is a label or button in the middle of a sentence?"""
        own = self.parent[node]
        if self.tag[own] in BLOCK and self.tag[own] not in PROSE:
            return False
        i = own + 1
        while i < self.end[own]:
            if self.tag[i] is None and len(self.value[i].split()) >= 2:
                return True
            i = self.end[i]
        return False

    def marked(self, node: int, inside: bool) -> str:
        """By what the element is marked as something else than the article's text: `role`, `class` or nothing."""
        name = self.tag[node]
        if name in DROPPED or (name in SPOKEN and not self._spoken(node)):
            return "role"
        if name == "form":
            return "class"  # a form may be around the whole page
        own = self.attributes(node) if self.value[node] else {}
        words = self.words(own) if own else set()
        if name == "header" and not inside and not words & MAIN_MARKS:
            return "role"
        if not own:
            return ""
        if own.get("role", "").lower() in DROPPED_ROLES or "hidden" in own or own.get("aria-hidden") == "true":
            return "role"
        if own.get("role", "").lower() == "form":
            return "class"
        if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", own.get("style", "")):
            return "role"
        if name in ("html", "body", "main"):
            return ""
        if not inside and "header" in words and not words & MAIN_MARKS:
            return "class"
        weak = False
        for found in self.names(own):
            marks = [w in MARKS or w.startswith(MARK_STEMS) for w in found]
            if any(marks):
                if not inside or all(m or w in GENERIC for m, w in zip(marks, found, strict=True)):
                    return "class"
                weak = True
        # within an article `market-share` or `related-work` may be what a part of its text is about
        return "class" if weak and name not in PROSE and not self._prose(node) else ""

    def hashes(self) -> list[int]:
        """Of every node: the hash of its subtree's names and texts; 0 where there is no text."""
        held: list[list[bytes]] = [[] for _ in self.tag]
        out = [0] * len(self.tag)
        for i in range(len(self.tag) - 1, -1, -1):
            if self.tag[i] is None:
                part = " ".join(references.unescape(self.value[i]).split()).encode("utf-8", "replace")
            elif held[i]:
                key = xxhash.xxh64(self.tag[i].encode() + b"\0" + b"\1".join(reversed(held[i])))
                part, out[i] = key.digest(), key.intdigest() - (1 << 63)
            else:
                part = b""
            if part and i:
                held[self.parent[i]].append(part)
        return out

    def kept(self) -> Iterator[tuple[int, bool, int]]:
        """Nodes of the main part, and from a title before it on, that nothing marks: node, whether it is a block, its kind.

        The caller sends True to leave out the subtree it was just given.
        """
        proses = [0, *accumulate(name in PROSE for name in self.tag)]  # before each node
        roots = self.roots()
        title = self.lead(roots)
        spans = [(k, k + 1, self.end[k]) for k in roots]
        if title is not None:
            spans.insert(0, (0, title, roots[0]))
        for root, first, last in spans:
            yield from self._kept_in(root, first, last, root > 0 and self.tag[root] not in ("html", "body"), proses)

    def _kept_in(self, root: int, first: int, last: int, main: bool, proses: list[int]) -> Iterator[tuple[int, bool, int]]:
        inside = main
        outer = [root]  # and the wrappers that node i is in
        i = first
        while i < last:
            while i >= self.end[outer[-1]]:
                outer.pop()
            name = self.tag[i]
            if name is not None and (how := self.marked(i, inside)):
                if how == "role" or not self.wraps(i, outer[-1], inside):
                    i = self.end[i]
                    continue
                outer.append(i)
            kind = INSIDE if main else PROSE_OUTSIDE if proses[self.end[i]] > proses[i] else PLAIN
            skip = yield i, name in BLOCK, kind
            i = self.end[i] if skip else i + 1

    def blocks(self, templates: tuple[frozenset[int], ...]) -> list[str]:
        """Texts of the kept blocks, without the subtrees whose hashes are among those of their kind."""
        keys = self.hashes() if any(templates) else []
        out: list[str] = []
        held: list[str] = []
        edges: list[int] = []  # ends of open blocks

        def flush() -> None:
            text = " ".join(references.unescape("".join(held)).split())
            if text:
                out.append(text)
            held.clear()

        walk = self.kept()
        step = next(walk, None)
        while step is not None:
            node, block, kind = step
            while edges and node >= edges[-1]:
                edges.pop()
                flush()
            name = self.tag[node]
            skip = bool(keys) and block and keys[node] in templates[kind]
            if name is None:
                held.append(self.value[node])
            elif block and not skip:
                flush()
                if self.end[node] > node + 1:
                    edges.append(self.end[node])
            elif name in ("br", "td", "th"):
                held.append(" ")
            elif skip:
                flush()
            try:
                step = walk.send(skip)
            except StopIteration:
                step = None
        flush()
        return out


_NONE = (frozenset[int](),) * 3


def main_text(source: str | None, templates: tuple[frozenset[int], ...] = _NONE) -> str:
    """The page's main text without the subtrees of those hashes, for each kind."""
    return "\n".join(Page(source).blocks(templates)) if source else ""


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows for the blocks of a page, and one without key for the page. A page is the text of its main part."""
    for batch in batches:
        hosts, pages, keys, kinds = [], [], [], []
        for host, source in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
            page = Page(source)
            found = page.hashes()
            seen, texts = set(), []
            for i, block, kind in page.kept():
                if page.tag[i] is None:
                    texts.append(page.value[i])
                elif block:
                    texts.append(" ")
                    if found[i]:
                        seen.add((found[i], kind))
            text = " ".join(references.unescape("".join(texts)).split())
            own = xxhash.xxh64_intdigest(text.encode("utf-8", "replace")) - (1 << 63)
            for key, kind in [(None, PLAIN), *sorted(seen)]:
                hosts.append(host)
                pages.append(own)
                keys.append(key)
                kinds.append(kind)
        yield pa.RecordBatch.from_arrays(
            [pa.array(hosts, pa.string()), pa.array(pages, pa.int64()), pa.array(keys, pa.int64()), pa.array(kinds, pa.int32())],
            names=["host", "page", "key", "kind"],
        )


def host_of(url: Column) -> Column:
    """The host of an absolute url in lower case, without user and port; null if there is none."""
    place = F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1)
    host = F.lower(F.regexp_replace(F.regexp_replace(place, r"^.*@", ""), r":\d*$", ""))
    return F.when(host != "", host)


def site_templates(pages: DataFrame) -> DataFrame:
    """`host, key, kind`: subtrees that recur on a large part of a host's pages."""
    rows = pages.select(host_of(F.col("url").cast("string")).alias("host"), F.col("html").cast("string").alias("html"))
    rows = rows.filter("host IS NOT NULL AND html != ''")
    seen = map_batches(rows, _count, "host string, page long, key long, kind int").distinct()
    n, total, kind = F.col("n"), F.col("all"), F.col("kind")
    counts = seen.groupBy("host", "key", "kind").agg(F.count(F.lit(1)).alias("n"))
    counts = cut(counts.filter((n >= min(PAGES, PROSE_PAGES)) | F.col("key").isNull()))
    every = counts.filter("key IS NULL").select("host", n.alias("all"))
    least = F.when(kind == INSIDE, PROSE_PAGES).otherwise(PAGES)
    share = F.when(kind == PLAIN, SHARE).otherwise(PROSE_SHARE)
    often = counts.filter("key IS NOT NULL").join(every, "host")
    return often.filter((n >= least) & (n >= share * total)).select("host", "key", "kind")


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        columns = (batch.column(c).to_pylist() for c in ("html", "plain", "prose", "inside"))
        for source, *templates in zip(*columns, strict=True):
            texts.append(main_text(source, tuple(frozenset(x or ()) for x in templates)))
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], names=["page_id", "url", "text"]
        )


def extract(pages: DataFrame) -> DataFrame:
    """`page_id, url, text` for every row of `pages(page_id, url, html)`."""
    found = cut(site_templates(pages))
    of = lambda kind: F.collect_list(F.when(F.col("kind") == kind, F.col("key")))
    keys = found.groupBy("host").agg(of(PLAIN).alias("plain"), of(PROSE_OUTSIDE).alias("prose"), of(INSIDE).alias("inside"))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        host_of(F.col("url").cast("string")).alias("host"),
        F.col("html").cast("string").alias("html"),
    )
    rows = rows.join(F.broadcast(keys) if fits_broadcast(found) else keys, "host", "left")
    return map_batches(rows.drop("host"), _extract, "page_id long, url string, text string")
