"""Main text of web pages by consensus of each host's pages.

A page is read once into blocks of text and the containers they lie in. Containers that are no article by their tag,
role or class (menus, footers, adverts, comments and the like) are out; among the others a page proposes the innermost
one that still holds nearly all of the text, scored by that text. An article is never narrowed down, and ``main`` only to
what holds all of its text that is no link. A name that may be chrome or not (search, related) does not rule out prose. The container's path of tags and classes, with numbers generalised,
is the page's vote. Spark counts votes per host, with partial sums before the shuffle, and the path with the most votes
is the host's. In a second pass a page gives the text of the containers with its host's path, or of its own proposal if
it has none.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm._util import ready, staged

#: Outside of an article a container must hold so much of its parent's text, and of the page's, to be preferred to it.
HOLDS = 0.8

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>|<[!?][^>]*>""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/"'<>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title noscript iframe template svg math xmp noembed noframes".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr img picture".split()
)
_CONTAINERS = frozenset("html body main article section div td table tbody tr center".split())
#: An opening tag of the first ends an open one of the second.
_ENDS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"},
}
_SCOPES = frozenset("ul ol dl table body html article section div main td th blockquote".split())
_P_STAYS = _INLINE | _VOID - {"hr"} | _RAW | frozenset("button select object video audio canvas map option optgroup p".split())
_NO_TEXT = frozenset(
    "head nav aside footer form script style noscript template iframe svg math textarea title button select option input menu "
    "dialog object embed canvas video audio xmp noembed noframes".split()
)
_NO_ROLE = frozenset("navigation banner complementary contentinfo search form dialog alert alertdialog menu menubar toolbar status".split())
_NO_NAME = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising adsense adslot banner banners promo promos promotion "
    "promotions sponsor sponsored sponsors sidebar sidebars widget widgets menu menus submenu nav navbar navigation navs navlist "
    "breadcrumb breadcrumbs masthead topbar topnav footer footers foot cookie cookies consent gdpr notice notices notification "
    "notifications alert alerts popup popups modal overlay newsletter subscribe subscription signup signin login register social "
    "share sharing shares related recommended recommendations recirc comment comments commentlist disqus respond reply replies "
    "discussion responses pagination pager toolbar searchform searchbox copyright legal disclaimer skip hidden outbrain taboola "
    "aside advertorial rail tooltip feedback side sidecol search talkback reactions werbung anzeige publicidad".split()
)
#: Kinds that are out even if they hold prose. The names of _SURE are so as any part of a name, others as whole names.
_SURE = frozenset(
    "advert adverts advertisement advertisements advertising adsense adslot sponsored comment comments commentlist disqus talkback "
    "cookie cookies gdpr outbrain taboola werbung anzeige publicidad".split()
)
_CERTAIN = _SURE | frozenset("ad ads adv advertorial sponsor sponsors share sharing shares consent hidden".split())
#: Parts that say where or in what form a thing is; a name of these and of parts of _NO_NAME is one of _NO_NAME as a whole.
_FORM = frozenset(
    "site main page left right top bottom upper lower primary secondary box block area section container wrap wrapper inner outer "
    "content list item items link links bar button buttons btn group row col column header title form icon icons slot unit module "
    "panel post posts article articles story stories entry global fixed sticky mobile desktop the us media text body div holder "
    "zone region view thread reader readers user users field input js wp large small".split()
)
#: A named block is prose if blocks of so many words, without links, make up half of its text.
PROSE_WORDS = 8
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_HEADER_NAME = frozenset("header headers siteheader pageheader".split())
#: A header that names one of these is the article's own.
_ARTICLE_NAME = frozenset("article post entry story content section".split())
_SHELL = frozenset("html body main article".split())
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_RAW_END = {tag: re.compile(f"</{tag}", re.I) for tag in _RAW}
#: What an inline element must have to be kept track of.
_MATTERS = re.compile(r"\b(?:class|id|style|role|hidden|aria-hidden)\b", re.I)
_WITHOUT = frozenset("with has no without".split())


def _attributes(text: str) -> dict[str, str]:
    out = {}
    for m in _ATTRIBUTE.finditer(text):
        out.setdefault(m[1].lower(), html.unescape(m[2] or m[3] or m[4] or ""))
    return out


def _names(value: str) -> list[set[str]]:
    """Lower-case parts of each class or id; what follows "with", "has" or "no" says what a thing has, not what it is."""
    found = []
    for name in value.split():
        parts = []
        for part in _PART.findall(name):
            if part.lower() in _WITHOUT:
                break
            parts.append(part.lower())
        found.append(set(parts))
    return found


class Page:
    """Elements and blocks of text of one page."""

    def __init__(self, source: str, by_name: bool = True):
        # Of each element: parent, number of its path, whether its text is out, whether it may be proposed.
        self.parent, self.path, self.out, self.fit, self.tag, self.inside = [-1], [0], [False], [False], [""], [False]
        # Paths are numbered by their parent path and last step: as text, those of deep pages would grow with the square of the depth.
        self._steps: list[tuple[int, str]] = [(-1, "")]
        self._below: dict[int, dict[str, int]] = {}
        # Of each tag the depths of the stack at which it is open.
        self._depths: dict[str, list[int]] = {}
        self.article, self.named = [False], [False]
        self.blocks: list[tuple[int, str, int]] = []
        self._stack, self._text, self._linked, self._anchor = [0], [], 0, False
        self._by_name = by_name
        self._read(source)

    def _flush(self) -> None:
        if self._text:
            text = " ".join("".join(self._text).split())
            if text:
                owner = self._stack[-1]
                while owner and self.tag[owner] in _INLINE:
                    owner = self.parent[owner]
                self.blocks.append((owner, text, self._linked))
            self._text = []
        self._linked = 0

    def _say(self, text: str) -> None:
        if text and not self.out[self._stack[-1]]:
            text = html.unescape(text) if "&" in text else text
            self._text.append(text)
            if self._anchor:
                self._linked += len(text)

    def _open(self, tag: str, attributes: str) -> None:
        up = self._stack[-1]
        given = _attributes(attributes) if attributes.strip(" /\n\t\r") else {}
        classes = given.get("class", "")
        out = self.out[up] or tag in _NO_TEXT or given.get("role", "").lower() in _NO_ROLE or "hidden" in given
        out = out or given.get("aria-hidden") == "true" or bool(_HIDDEN.search(given.get("style", "")))
        in_article = self.inside[up]
        if not out and tag == "header" and not in_article:
            out = True
        named = False
        if not out and self._by_name and tag not in _SHELL and (classes or "id" in given):
            out, named = self._ruled(tag, classes, given.get("id", ""), in_article)
        self.parent.append(up)
        step = ".".join([tag, *sorted(set(re.sub(r"\d+", "9", c.lower()) for c in classes.split()))]) if classes else tag
        below = self._below.setdefault(self.path[up], {})
        if step not in below:
            below[step] = len(self._steps)
            self._steps.append((self.path[up], step))
        self.path.append(below[step])
        self.out.append(out)
        self.inside.append(in_article or tag in ("article", "main"))
        self.article.append(self.article[up] or tag == "article")
        self.named.append(named)
        self.fit.append(tag in _CONTAINERS)
        self.tag.append(tag)
        self._depths.setdefault(tag, []).append(len(self._stack))
        self._stack.append(len(self.parent) - 1)

    def path_text(self, e: int) -> str:
        """The path of an element as text."""
        steps, at = [], self.path[e]
        while at > 0:
            at, step = self._steps[at]
            steps.append(">" + step)
        return "".join(reversed(steps))

    def at_path(self, text: str) -> list[int]:
        """Elements whose path reads so. A step may hold the mark between steps, so all ways to read it are followed."""
        found, left = set(), [(0, 0)]
        while left:
            at, read = left.pop()
            if read == len(text) and at:
                found.add(at)
            end = text.find(">", read + 1)
            while text.startswith(">", read):
                step = text[read + 1 : end if end >= 0 else len(text)]
                if step in self._below.get(at, ()):
                    left.append((self._below[at][step], read + 1 + len(step)))
                if end < 0 or ">" not in "".join(self._below.get(at, ())):
                    break
                end = text.find(">", end + 1)
        return [e for e, p in enumerate(self.path) if p in found]

    def _ruled(self, tag: str, classes: str, ident: str, in_article: bool) -> tuple[bool, bool]:
        """Whether an element is out by its names, and whether it is unless it holds prose.

        Inline elements and headings go only by the name of a certain kind, as do ids of sections; headings not by their
        ids. In an article or main only whole names count.
        """
        marks = tag in _INLINE or tag in _HEADINGS
        sure = named = False
        for of_id, value in ((False, classes), (True, ident)):
            if of_id and tag in _HEADINGS:
                continue
            for parts in _names(value):
                if not in_article and not marks and parts & _HEADER_NAME and not parts & _ARTICLE_NAME:
                    return True, False
                if not parts & _NO_NAME:
                    continue
                whole = all(part in _NO_NAME or part in _FORM or part.isdigit() for part in parts)
                if whole and parts & _CERTAIN or not in_article and not marks and parts & _SURE:
                    sure = True
                elif (whole or not in_article) and not marks and not (of_id and tag == "section"):
                    named = True
        return sure, named and not sure

    def _settle(self) -> None:
        """Put out the named elements that hold no prose, with all below them."""
        if not any(self.named):
            return
        every, prose = [0] * len(self.parent), [0] * len(self.parent)
        for owner, text, linked in self.blocks:
            every[owner] += len(text)
            if len(text.split()) >= PROSE_WORDS and 2 * linked <= len(text):
                prose[owner] += len(text)
        for e in range(len(every) - 1, 0, -1):
            every[self.parent[e]] += every[e]
            prose[self.parent[e]] += prose[e]
        for e in range(1, len(every)):
            self.out[e] = self.out[e] or self.out[self.parent[e]] or self.named[e] and 2 * prose[e] <= every[e]
        self.blocks = [b for b in self.blocks if not self.out[b[0]]]

    def _close(self, depth: int) -> None:
        """Close what is open from a depth of the stack on."""
        if any(self.tag[e] not in _INLINE for e in self._stack[depth:]):
            self._flush()
        for e in self._stack[depth:]:
            self._depths[self.tag[e]].pop()
        del self._stack[depth:]

    def _end_of(self, tags, stop=frozenset()) -> int | None:
        """Depth of the innermost open element with one of the tags, not looking beyond the stops."""
        innermost = lambda of: max((d[-1] for t in of if (d := self._depths.get(t))), default=0)
        depth = innermost(tags)
        return depth if depth and depth >= innermost(stop) else None

    def _read(self, source: str) -> None:
        at, find, size = 0, _TOKEN.search, len(source)
        while at < size:
            m = find(source, at)
            if m is None:
                self._say(source[at:])
                break
            if m.start() > at:
                self._say(source[at : m.start()])
            at = m.end()
            if m[2] is None:
                continue
            tag = m[2].lower()
            if tag == "a":
                self._anchor = not m[1]
            if m[1]:
                if tag in _INLINE and not self._depths.get(tag):
                    continue
                depth = self._end_of((tag,), _SCOPES - {tag} if tag in _INLINE or tag == "p" else frozenset())
                if depth is not None:
                    self._close(depth)
                elif tag in ("p", "br"):
                    self._flush() if tag == "p" else self._say(" ")
                continue
            if tag not in _P_STAYS or tag == "p":
                depth = self._end_of(("p",), _SCOPES)
                if depth is not None:
                    self._close(depth)
            if tag in _ENDS:
                depth = self._end_of(_ENDS[tag], _SCOPES - _ENDS[tag])
                if depth is not None:
                    self._close(depth)
            if tag in _VOID:
                if tag == "hr":
                    self._flush()
                elif tag != "wbr":
                    self._say(" ")
                continue
            if tag in _RAW:
                end = _RAW_END[tag].search(source, at)
                at = end.start() if end else size
                close = source.find(">", at)
                at = size if close < 0 else close + 1
                continue
            if tag not in _INLINE:
                self._flush()
            elif not _MATTERS.search(m[3]):
                continue  # such an element holds nothing back and ends nothing
            self._open(tag, m[3])
        self._flush()
        self._settle()

    def totals(self) -> list[float]:
        """Of each element, the weight of the text in it and below; linked text counts little."""
        total = [0.0] * len(self.parent)
        for owner, text, linked in self.blocks:
            total[owner] += len(text) - 0.9 * min(linked, len(text))
        for e in range(len(total) - 1, 0, -1):
            total[self.parent[e]] += total[e]
        return total

    def plain(self) -> list[int]:
        """Of each element, how much text that is no link is in it and below."""
        total = [0] * len(self.parent)
        for owner, text, linked in self.blocks:
            total[owner] += max(0, len(text) - linked)
        for e in range(len(total) - 1, 0, -1):
            total[self.parent[e]] += total[e]
        return total

    def proposal(self) -> tuple[int, float]:
        """The innermost container that holds nearly all of the text and leaves no part of an article behind; its score.

        Beside it may stand, outside of an article or main, containers of their own with little text and no h1, and
        inside of main links alone. The tags article and main leave behind what is around them.
        """
        total, plain = self.totals(), self.plain()
        children: dict[int, list[int]] = {}
        own, titled = [0] * len(total), [False] * len(total)
        for owner, text, linked in self.blocks:
            own[owner] += max(0, len(text) - linked)
        for e in range(len(total) - 1, 0, -1):
            if total[e] > 0:
                children.setdefault(self.parent[e], []).append(e)
                titled[e] = titled[e] or self.tag[e] == "h1"
                titled[self.parent[e]] |= titled[e]
        best = at = 0
        while at in children and not self.article[at]:
            top = max(reversed(children[at]), key=total.__getitem__)
            if total[top] < HOLDS * total[best] or not self.fit[top]:
                break
            if self.inside[at]:
                if plain[top] < plain[at]:
                    break
            elif self.tag[top] not in ("article", "main"):
                beside = [e for e in children[at] if e != top and plain[e] > 0]
                if total[top] < HOLDS * total[0] or own[at] or any(titled[e] or not self.fit[e] for e in beside):
                    break
            best = at = top
        return best, total[best]

    def whole(self, chosen: set[int]) -> set[int]:
        """For each element the article it lies in, or what part of main holds more text than it that is no link."""
        plain, top = self.plain(), list(range(len(self.parent)))
        for e in range(1, len(top)):
            up = self.parent[e]
            if self.inside[up] and (self.article[up] or plain[up] > plain[e] or top[up] != up):
                top[e] = top[up]
        return {top[e] for e in chosen}

    def text_of(self, chosen: set[int]) -> str:
        """Blocks below any of the elements, in page order."""
        inside = [False] * len(self.parent)
        for e in range(len(inside)):
            inside[e] = e in chosen or e > 0 and inside[self.parent[e]]
        return "\n\n".join(text for owner, text, _ in self.blocks if inside[owner])


def read_page(source: str | None) -> Page:
    """A page; one that has no text but in parts ruled out by their names is read without looking at names."""
    page = Page(source or "")
    return page if page.blocks else Page(source or "", by_name=False)


def extract(source: str | None, path: str | None) -> str:
    """Main text of a page, given the path its host agreed on."""
    page = read_page(source)
    chosen = {e for e in page.at_path(path) if not page.out[e]} if path else set()
    return (page.text_of(page.whole(chosen)) if chosen else "") or page.text_of({page.proposal()[0]})


def _host(url):
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))


def host_paths(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(host, path): the path most pages of a host propose; of equals the one with more text, then the greater path."""
    ready(pages)
    source = pages.select(_host(F.col(url_col)).alias("host"), F.col(html_col).alias("html"))

    def run(batches):
        for batch in batches:
            hosts, paths, scores = [], [], []
            for host, text in zip(batch.column("host"), batch.column("html")):
                page = read_page(text.as_py())
                best, score = page.proposal()
                if score > 0:
                    hosts.append(host.as_py())
                    paths.append(page.path_text(best))
                    scores.append(round(score))
            yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(paths, pa.string()), pa.array(scores, pa.int64())], ["host", "path", "score"])

    votes = source.mapInArrow(run, "host string, path string, score long").groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("score").alias("score"))
    return votes.groupBy("host").agg(F.max(F.struct("n", "score", "path")).getField("path").alias("path"))


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per input row: page_id, url, text, n_chars (code points of the text).

    A null or empty page has empty text; pages without a URL or host vote together. Ids may be null; repeated rows vote
    and are returned as often as they stand. A very long or deeply nested page is read in time and memory in proportion.
    Other columns are not read; an empty table gives no rows.
    """
    ready(pages)
    source = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    # Written, so that the planner knows its size: small ones are broadcast, large ones joined with skewed hosts split.
    paths = staged(host_paths(source), "host-paths")
    joined = source.withColumn("host", _host(F.col("url"))).join(paths, "host", "left").drop("host")

    def run(batches):
        for batch in batches:
            texts = [extract(text.as_py(), path.as_py()) for text, path in zip(batch.column("html"), batch.column("path"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    return joined.mapInArrow(run, f"page_id {dict(source.dtypes)['page_id']}, url string, text string, n_chars long")
