"""Main text of web pages by consensus of their host.

Every page scores its containers by the text they hold outside links and outside menus, notices and the like, and votes
for the generalised tag-class path of the best one. Votes are counted per host; the paths that enough of a host's pages
chose are its winning paths. The text is then taken from the containers on a winning path, so a page whose own article is
shorter than its surroundings still gets the right part. A page without any container on a winning path keeps its own
choice.

Names say less than places. A class such as ``has-sidebar`` or ``comments-open`` states what a page looks like, so it marks
no part as noise. A container that is left out for its name alone, or a form, is a wrapper after all if it holds most of
the page's text and, unless it is a form, an article, a main part or a headline with text below; its inner parts are then
judged one by one. What one page of a host shows to be a wrapper is one on every page of the host where it stands on the
same path.

Ties: of equally large containers the first on the page gets the vote, of paths with equally many votes that with more text,
then the later one by code point. Very long pages are read whole, in one pass. Null or empty html gives an empty text; a null address belongs to the host without a name. Rows are handled one by one,
so repeated rows vote twice and get equal texts. A table without rows gives no rows. Further columns are carried along.
"""

from __future__ import annotations

import re
from html import unescape

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratescope.llm.common import write_stage

#: Share of a host's votes that makes a path one of its winning paths.
LEAST_SHARE = 0.1
#: A container passes its rank on to a child that holds this share of its text.
MOST_OF = 0.55

_TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>"""
    r"""|<(/?)([a-zA-Z][^\s/<>]*)((?:[^<>"']++|"[^"<]*+"|'[^'<]*+'|["'])*+)>""",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")

#: Elements whose content is no text of the page.
RAW = frozenset("script style title textarea noscript template iframe svg math object xmp noembed noframes".split())
LEFT_OUT = RAW | frozenset("head nav footer aside button select option dialog menu canvas audio video map datalist".split())
CONTAINERS = frozenset("html body article main section div form table tbody thead tfoot tr td th ul ol dl center header figure details blockquote".split())
BLOCKS = CONTAINERS | frozenset("p h1 h2 h3 h4 h5 h6 li dt dd pre address figcaption caption summary hr legend fieldset hgroup".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: A new element of the first kind ends an open one of the second kind that has no end tag.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
NOISE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adbox banner sponsor sponsored promo promotion cookie cookies consent gdpr "
    "notice notification alert sidebar widget widgets menu nav navbar navigation breadcrumb breadcrumbs footer masthead share "
    "sharing social related recommended recommendations comment comments reply replies disqus respond newsletter subscribe "
    "signup login popup modal overlay pagination pager toolbar skip print hidden outbrain taboola".split()
)
NOISE_NAMES = frozenset("header site-header page-header top-header global-header topbar top-bar side-bar side right-column left-column rail".split())
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form".split())
#: First and last words of names that tell what a page has, not what a container is.
STATE_FIRST = frozenset("has have no not with without".split())
STATE_LAST = frozenset("open opened closed enabled disabled".split())
#: Names of page parts written by readers; their headlines and articles are none of the page.
READERS = frozenset("comment comments reply replies disqus respond".split())
#: Text below a headline, in characters, that shows a container left out by name to be a wrapper.
LEAST_BELOW_HEADLINE = 200
GOOD_WORDS = frozenset("article content post entry story main body text maincontent articlebody".split())
_SPLIT = re.compile(r"[^a-z]+")

KEEP, BY_NAME, LEAVE = 0, 1, 2


def _name_words(names: list[str]) -> set[str]:
    """The words of names that are not about the state of the page."""
    words: set[str] = set()
    for name in names:
        parts = [w for w in _SPLIT.split(name) if w]
        if len(parts) > 1 and "print" not in parts and (parts[0] in STATE_FIRST or parts[-1] in STATE_LAST):
            continue
        words.update(parts)
    return words


class Page:
    """Containers and text blocks of one page, in page order."""

    def __init__(self, html: str):
        self.parent, self.path, self.noise, self.hint = [-1], [""], [KEEP], [1.0]
        self.form, self.readers, self.shown = [False], [False], [0]
        self.blocks: list[tuple[int, str, int]] = []
        self._open: list[tuple[str, int]] = [("", 0)]
        self._text: list[str] = []
        self._links: list[str] = []
        self._in_link = False
        self._unclosed: set[str] = set()
        self._read(html)
        self.out = self._left_out(self._wrappers())

    def _read(self, html: str) -> None:
        at, end = 0, len(html)
        while at < end:
            found = _TAG.search(html, at)
            if found is None:
                self._say(html[at:])
                break
            if found.start() > at:
                self._say(html[at:found.start()])
            at = found.end()
            name = found.group(2)
            if name is None:
                continue
            name = name.lower()
            if found.group(1):
                self._close(name)
                continue
            if name in RAW:
                if found.group(3).endswith("/") or name in self._unclosed:
                    continue
                stop = re.compile(rf"</{re.escape(name)}\b[^>]*>", re.I).search(html, at)
                if stop:
                    at = stop.end()
                elif name in ("script", "style"):
                    at = end
                else:
                    self._unclosed.add(name)
                continue
            self._start(name, found.group(3))
        self._flush()

    def _say(self, text: str) -> None:
        self._text.append(text)
        if self._in_link:
            self._links.append(text)

    def _flush(self) -> None:
        if self._text:
            words = " ".join(unescape("".join(self._text)).split())
            if words:
                linked = len(" ".join(unescape("".join(self._links)).split()))
                self.blocks.append((self._open[-1][1], words, linked))
            self._text, self._links = [], []
        self._in_link = False

    def _start(self, name: str, rest: str) -> None:
        if name == "a":
            self._in_link = True
            return
        if name == "br" or name == "wbr":
            self._say(" " if name == "br" else "")
            return
        if name in VOID and name != "hr":
            return
        if name not in BLOCKS and name not in LEFT_OUT:
            if "hidden" not in rest and "class" not in rest and "role" not in rest:
                return
            if self._judge(name, rest)[0] == KEEP:
                return
        self._flush()
        if name == "hr":
            return
        while self._open[-1][0] == "p":
            self._open.pop()
        for other in CLOSES.get(name, ()):
            if self._open[-1][0] == other:
                self._open.pop()
        node = self._open[-1][1]
        noise, key, hint, readers, main = self._judge(name, rest)
        if name in CONTAINERS or noise or main:
            self.parent.append(node)
            self.path.append(f"{self.path[node]}/{key}" if node else key)
            self.noise.append(noise)
            self.hint.append(hint)
            self.form.append(name == "form")
            self.readers.append(readers)
            self.shown.append(2 if main else 0)
            node = len(self.parent) - 1
        if name == "h1":
            self.shown[node] = max(1, self.shown[node])
        self._open.append((name, node))

    def _close(self, name: str) -> None:
        if name == "a":
            self._in_link = False
        elif name == "br":
            self._say(" ")
        elif any(n == name for n, _ in self._open[1:]):
            self._flush()
            while self._open.pop()[0] != name:
                pass
        elif name in BLOCKS:
            self._flush()

    def _judge(self, name: str, rest: str) -> tuple[int, str, float, bool, bool]:
        """Why the element is left out, its generalised name, how much that speaks for an article, whether it holds what
        readers wrote, whether it is marked as the page's article or main part."""
        classes: list[str] = []
        names: list[str] = []
        marked = name in ("article", "main")
        leave = name in LEFT_OUT or (name == "header" and not any(n in ("article", "main") for n, _ in self._open))
        if rest.strip(" /"):
            for m in _ATTRIBUTE.finditer(rest):
                attribute = m.group(1).lower()
                value = (m.group(2) or m.group(3) or m.group(4) or "").lower()
                if attribute == "class":
                    classes = value.split()
                    names += classes
                elif attribute == "id":
                    names.append(value)
                elif attribute == "role":
                    leave |= value in NOISE_ROLES and not (name == "form" and value == "form")
                    marked |= value == "main"
                elif attribute == "hidden" or (attribute == "aria-hidden" and value == "true"):
                    leave = True
                elif attribute == "style":
                    leave |= "display:none" in value.replace(" ", "")
        words = _name_words(names)
        by_name = bool(words & NOISE_WORDS) or any(n in NOISE_NAMES for n in names)
        good = marked or bool({w for n in names for w in _SPLIT.split(n)} & GOOD_WORDS)
        key = ".".join([name, *sorted({re.sub(r"\d+", "#", c) for c in classes})])
        exempt = marked or name in ("html", "body")
        if leave:
            noise = LEAVE
        elif name == "form" or (by_name and not exempt):
            noise = BY_NAME
            key += "!" + "!".join(sorted({re.sub(r"\d+", "#", n) for n in names} - set(classes)))
        else:
            noise = KEEP
        return noise, key, 1.5 if good else 1.0, bool(words & READERS), marked and not by_name and not leave

    def _left_out(self, wrappers: set[int]) -> list[bool]:
        out = [False] * len(self.parent)
        for node in range(1, len(out)):
            noise = self.noise[node]
            out[node] = out[self.parent[node]] or noise == LEAVE or (noise == BY_NAME and node not in wrappers)
        return out

    def _wrappers(self) -> set[int]:
        """Forms and containers left out by name that hold most of the page's text and its article, main part or headline."""
        if BY_NAME not in self.noise:
            return set()
        count = len(self.parent)
        leave = [False] * count
        for node in range(1, count):
            leave[node] = leave[self.parent[node]] or self.noise[node] == LEAVE or self.readers[node]
        size = [0] * count
        for node, words, linked in self.blocks:
            if not leave[node]:
                size[node] += max(0, len(words) - 2 * linked)
        shown = [0 if leave[n] else self.shown[n] for n in range(count)]
        # From the last container up: what it passes to its parent. A part left out by name that shows no article passes nothing.
        for node in range(count - 1, 0, -1):
            above = self.parent[node]
            may_wrap = shown[node] == 2 or (shown[node] == 1 and size[node] >= LEAST_BELOW_HEADLINE) or self.form[node]
            if leave[node] or (self.noise[node] == BY_NAME and not may_wrap):
                size[node] = 0
                continue
            size[above] += size[node]
            shown[above] = max(shown[above], shown[node])
        return {n for n in range(1, count) if self.noise[n] == BY_NAME and 2 * size[n] > size[0]}

    def sizes(self) -> list[float]:
        """Text outside links below each container; what is left out counts nowhere."""
        own = [0.0] * len(self.parent)
        for node, words, linked in self.blocks:
            if not self.out[node]:
                own[node] += max(0, len(words) - 2 * linked)
        for node in range(len(own) - 1, 0, -1):
            own[self.parent[node]] += own[node]
        return own

    def choice(self) -> int:
        """The container that holds most of the page's text and passes it on to no single child."""
        size = self.sizes()
        children: dict[int, list[int]] = {}
        for node in range(1, len(self.parent)):
            if not self.out[node]:
                children.setdefault(self.parent[node], []).append(node)
        at = 0
        while True:
            best = max(children.get(at, ()), key=lambda n: (size[n] * self.hint[n], -n), default=None)
            if best is None or size[best] * self.hint[best] < MOST_OF * size[at] or not size[best]:
                return at
            at = best

    def text_of(self, nodes: set[int], out: list[bool] | None = None) -> str:
        out = self.out if out is None else out
        inside = [False] * len(self.parent)
        for node in range(len(self.parent)):
            inside[node] = node in nodes or (node > 0 and inside[self.parent[node]])
        return "\n".join(words for node, words, _ in self.blocks if inside[node] and not out[node])

    def _above(self, nodes: list[int]) -> set[int]:
        found: set[int] = set()
        for node in nodes:
            while node > 0 and node not in found:
                found.add(node)
                node = self.parent[node]
        return found

    def text(self, winners: list[str]) -> str:
        at: dict[str, list[int]] = {path: [] for path in winners}
        for node in range(1, len(self.path)):
            if self.path[node] in at:
                at[self.path[node]].append(node)
        wrappers: set[int] | None = None
        for path in winners:
            out = self.out
            if "!" in path and at[path]:
                # The host's pages chose below a wrapper: it is one here, too.
                wrappers = self._wrappers() if wrappers is None else wrappers
                out = self._left_out(wrappers | self._above(at[path]))
            nodes = {n for n in at[path] if not out[n]}
            if nodes and (text := self.text_of(nodes, out)):
                return text
        return self.text_of({self.choice()})


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))


def _vote(pages: pd.Series) -> pd.DataFrame:
    out = []
    for html in pages:
        page = Page(html) if isinstance(html, str) else None
        node = page.choice() if page else 0
        out.append((page.path[node], int(page.sizes()[node])) if node else (None, 0))
    return pd.DataFrame(out, columns=["path", "size"])


def _extract(pages: pd.Series, winners: pd.Series) -> pd.Series:
    return pd.Series(
        [Page(h).text(list(w) if w is not None else []) if isinstance(h, str) and h else "" for h, w in zip(pages, winners)], dtype=object
    )


def host_paths(pages: DataFrame, least_share: float = LEAST_SHARE) -> DataFrame:
    """host, winners: the paths with at least ``least_share`` of the host's votes, most votes first.

    At most 1 / ``least_share`` paths can be in the list, however many pages and paths a host has.
    """
    vote = F.pandas_udf(_vote, "path string, size bigint")
    voted = pages.select(host_of(F.col("url")).alias("host"), vote("html").alias("v"))
    counted = (
        voted.where(F.col("v.path").isNotNull()).groupBy("host", F.col("v.path").alias("path"))
        .agg(F.count("*").alias("votes"), F.sum("v.size").alias("size"))
    )
    counted = write_stage(counted, "host-votes")
    total = counted.groupBy(F.col("host").alias("_host")).agg(F.sum("votes").alias("all_votes"))
    strong = counted.join(total, F.col("host") == F.col("_host")).where(F.col("votes") >= least_share * F.col("all_votes"))
    ordered = F.sort_array(F.collect_list(F.struct("votes", "size", "path")), asc=False)
    return strong.groupBy("host").agg(F.transform(ordered, lambda x: x["path"]).alias("winners"))


def extract(pages: DataFrame, least_share: float = LEAST_SHARE) -> DataFrame:
    """``pages`` with the main text in ``text``, in place of any column of that name."""
    winners = write_stage(host_paths(pages, least_share), "host-paths").select(F.col("host").alias("_hp_host"), F.col("winners").alias("_hp_winners"))
    here = pages.drop("text").withColumn("_hp_own", host_of(F.col("url")))
    joined = here.join(winners, F.col("_hp_own") == F.col("_hp_host"), "left")
    text = F.pandas_udf(_extract, "string")
    return joined.withColumn("text", text("html", "_hp_winners")).drop("_hp_own", "_hp_host", "_hp_winners")
