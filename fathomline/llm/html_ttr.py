"""Main text of web pages by text-to-tag ratios.

The standard library's parser streams a page's events into lines, one for each block of text. A line's ratio is its
characters outside links for each tag around them; ratios are smoothed by a Gaussian over neighbouring lines, and lines
above a threshold form clusters. The smallest element that holds all clusters is the main text: every line in it, short
ones too, but for parts without any cluster that are links only.

Structure has a veto, no vote: menus, headers, footers, sidebars, notices, adverts, forms and comments, told by elements
and names, are never text, nor is what lies outside the article or main element that holds the largest cluster. A name
on something that holds the page's articles or main element is layout, and no veto.

White space inside a block becomes one space; blocks are trimmed, empty ones dropped, and joined by a newline. Null and
empty pages have no text. Tags left open and stray ends are taken as browsers take them: a declaration that is none is a
comment, and a comment, tag or instruction without an end goes to the end of the page. Nothing is cut at any length.
Repeated rows give repeated results; columns of any name are kept, but for one of the result's name, which is replaced.
"""

from __future__ import annotations

import re
from collections import Counter
from html.parser import HTMLParser

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Deviation of the smoothing, in lines; share of the deviation of ratios above which a line counts as content, and part
#: of that threshold that the line's own ratio has to reach, so that a long neighbour alone doesn't make it content.
SIGMA, SHARE, OWN = 1.0, 0.5, 0.25

# Elements of the HTML standard by their role.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul br title".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: What a browser doesn't show as text, and controls.
SKIPPED = frozenset("script style head title noscript template iframe canvas audio video select textarea button datalist annotation annotation-xml desc metadata".split())
IN_HEAD = frozenset("base basefont bgsound link meta noframes noscript script style template title".split())
ASIDE = frozenset("nav footer aside menu dialog search".split())
CONTROLS = frozenset("form fieldset".split())
#: Elements that close an open paragraph.
CLOSES_P = BLOCKS - frozenset("br body head html title td th tr tbody thead tfoot caption dd dt li option optgroup legend summary figcaption".split())
#: Elements whose start closes an open one of the same kind, up to the first of the others.
SIBLINGS = {"li": ("li", ("ul", "ol", "menu", "dir")), "dt": ("dt dd", ("dl",)), "dd": ("dt dd", ("dl",)), "tr": ("tr td th", ("table",)), "td": ("td th", ("tr", "table")), "th": ("td th", ("tr", "table")), "option": ("option", ("select",))}
#: Elements whose content may be the article, or a part of it.
HOLDERS = frozenset("article main section div body html td center ul ol dl table".split())

# Words of names (class, id, role) of what surrounds an article.
#: These tell by themselves, whatever other words a name has.
CLEAR = frozenset(
    "ad ads advert adverts advertisement advertisements adsense menu menus navbar navigation breadcrumb breadcrumbs sidebar sidebars footer footers masthead topbar cookie cookies gdpr newsletter newsletters comment comments commentlist disqus pagination complementary contentinfo".split()
)
#: These only among words that say where something is or what it holds.
VAGUE = frozenset(
    "banner banners sponsor sponsored sponsors promo promos promotion promotions toolbar consent notice notices popup popups modal modals overlay overlays subscribe subscription signup reply replies related recommend recommended recommendation recommendations copyright".split()
)
NEUTRAL = frozenset(
    "site page top bottom left right main global header area section box bar block list lists item items link links post posts article articles story stories news entry blog primary secondary inner title text form card cards grid reader user thread below above read more widget module region message".split()
)
#: With these a name may be of layout around the article as well.
LAYOUT = frozenset("wrap wrapper wrappers container outer layout open opened closed page body content on active enabled".split())
NOT = frozenset("has with no without not hide".split())
#: These only as whole names.
WHOLE = frozenset("nav side aside alert alerts login search form forms respond discussion share sharing social widget widgets pager legal disclaimer dialog toc skip skip-link tags tag-list teaser teasers trending paywall".split())
#: Outside an article these are page furniture; within one they may hold the headline.
HEADERS = frozenset("header site-header page-header global-header top-header main-header siteheader pageheader".split())
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_COMMENT_END = re.compile(r"--!?>")

LAYOUT_ONLY, FURNITURE = 1, 2


def named(name: str, inside: bool) -> int:
    """What a name makes of an element: FURNITURE, LAYOUT_ONLY if it may be layout as well, or 0."""
    found = 0
    for token in name.lower().split():
        if token in WHOLE or not inside and token in HEADERS:
            return FURNITURE
        words = re.split(r"[_\W\d]+", token)
        if words[0] in NOT or CLEAR.isdisjoint(words) and VAGUE.isdisjoint(words):
            continue
        rest = set(words) - CLEAR - VAGUE - {""}
        if not LAYOUT.isdisjoint(rest):
            found = max(found, LAYOUT_ONLY)
        elif not CLEAR.isdisjoint(words) or rest <= NEUTRAL:
            return FURNITURE
    return found


class Lines(HTMLParser):
    """Streams a page into lines: text, its characters in links, tags since the line before, nearest holder, mark.

    Holders are numbered as they open, from 1; parent and kind tell each one's holder and name. So are marks, which are
    elements that may be furniture: above, strength, and how many articles and main elements each holds.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, int, int, bool, bool, bool]] = []  # name, nearest holder, mark, skipped, in an article, in a link
        self.names: Counter = Counter()  # of the open elements
        self.parent, self.kind = [0], [""]
        self.above, self.strength, self.articles, self.mains = [0], [0], [0], [0]
        self.texts: list[str] = []
        self.linked: list[int] = []
        self.tags: list[int] = []
        self.held: list[int] = []
        self.mark: list[int] = []
        self.pending = self.in_links = 0
        self.parts: list[str] = []

    # the end of the page ends what has no end of its own

    def parse_comment(self, i, report=1):
        if self.rawdata.startswith(("<!-->", "<!--->"), i):
            return self.rawdata.index(">", i) + 1
        end = _COMMENT_END.search(self.rawdata, i + 4)
        return end.end() if end else len(self.rawdata)

    def parse_html_declaration(self, i):
        return self.parse_comment(i) if self.rawdata.startswith("<!--", i) else self._through(i)

    def parse_pi(self, i):
        return self._through(i)

    def parse_starttag(self, i):
        k = super().parse_starttag(i)
        return len(self.rawdata) if k < 0 else k

    def parse_endtag(self, i):
        k = super().parse_endtag(i)
        return len(self.rawdata) if k < 0 else k

    def _through(self, i: int) -> int:
        end = self.rawdata.find(">", i)
        return len(self.rawdata) if end < 0 else end + 1

    # lines

    def _line(self):
        if self.parts:
            text = " ".join("".join(self.parts).split())
            self.parts = []
            if text:
                self.texts.append(text)
                self.linked.append(self.in_links)
                self.tags.append(self.pending)
                self.held.append(self.open[-1][1] if self.open else 0)
                self.mark.append(self.open[-1][2] if self.open else 0)
                self.pending = 0
            self.in_links = 0

    def _close_to(self, k: int):
        if any(name in BLOCKS for name, *_ in self.open[k:]):
            self._line()
        self.names.subtract(x[0] for x in self.open[k:])
        del self.open[k:]

    def _leave_head(self):
        if self.open and self.open[-1][0] == "head":
            self._close_to(len(self.open) - 1)

    def _marked(self, tag: str, given: dict, mark: int, inside: bool) -> int:
        """The mark of an element that opens: a new one, or the one around it."""
        strength = named(" ".join(v for a in ("class", "id", "role") if (v := given.get(a))), inside) if tag not in ("html", "body", "main") else 0
        if tag in ASIDE or tag == "header" and not inside or "hidden" in given or given.get("aria-hidden") == "true" or _HIDDEN.search(given.get("style") or ""):
            strength = FURNITURE
        elif tag in CONTROLS:
            strength = max(strength, LAYOUT_ONLY)
        if strength:
            for column, value in ((self.above, mark), (self.strength, strength), (self.articles, 0), (self.mains, 0)):
                column.append(value)
            return len(self.above) - 1
        held = self.articles if tag == "article" else self.mains if tag == "main" else None
        if held is not None:
            held[0] += 1
            while mark:
                held[mark] += 1
                mark = self.above[mark]
        return mark

    def handle_starttag(self, tag, attrs):
        if tag not in IN_HEAD and tag != "head":
            self._leave_head()
        self.pending += 1
        if tag in BLOCKS:
            self._line()
        if tag in VOID:
            return
        if tag in CLOSES_P and self.names["p"]:
            for k in range(len(self.open) - 1, -1, -1):
                if self.open[k][0] == "p":
                    self._close_to(k)
                    break
                if self.open[k][0] in HOLDERS or self.open[k][0] in ("button", "object"):
                    break
        if tag in SIBLINGS:
            same, stop = SIBLINGS[tag]
            for k in range(len(self.open) - 1, -1, -1):
                if self.open[k][0] in stop:
                    break
                if self.open[k][0] in same.split():
                    self._close_to(k)
                    if tag != "tr":
                        break
        holder, around, skipped, inside, link = self.open[-1][1:] if self.open else (0, 0, False, False, False)
        given = dict(attrs)
        mark = self._marked(tag, given, around, inside)
        if tag in HOLDERS:
            self.parent.append(holder)
            self.kind.append(tag)
            holder = len(self.kind) - 1
        self.names[tag] += 1
        self.open.append((tag, holder, mark, skipped or tag in SKIPPED, inside or tag in ("article", "main"), link or tag == "a" and "href" in given))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)  # in HTML the slash means nothing but on void elements

    def handle_endtag(self, tag):
        self.pending += 1
        if self.names[tag] <= 0:
            if tag in ("p", "br"):
                self._line()
            return
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0] == tag:
                self._close_to(k)
                return
            if self.open[k][0] in ("article", "main", "table") and tag not in ("body", "html", "main", "article", "section", "div"):
                return  # a stray end tag doesn't close what holds it

    def handle_data(self, data):
        if not data.isspace():
            self._leave_head()
        if not (self.open and self.open[-1][3]):
            self.parts.append(data)
            if self.open and self.open[-1][5]:
                self.in_links += len(" ".join(data.split()))

    def finish(self):
        self.close()
        self._line()


def ratios(texts: list[str], linked: list[int], tags: list[int]) -> np.ndarray:
    """Of each line its characters outside links for each tag."""
    return np.maximum(np.array([len(t) for t in texts], float) - linked, 0) / np.maximum(tags, 1)


def smooth(ratio: np.ndarray) -> np.ndarray:
    """Gaussian smoothing over neighbouring lines; at the ends the weights of the lines there are are scaled up."""
    r = int(3 * SIGMA)
    kernel = np.exp(-0.5 * (np.arange(-r, r + 1) / SIGMA) ** 2)
    return np.convolve(ratio, kernel, "full")[r : r + len(ratio)] / np.convolve(np.ones(len(ratio)), kernel, "full")[r : r + len(ratio)]


def content(ratio: np.ndarray) -> np.ndarray:
    """Whether a line belongs to a cluster: its smoothed ratio is above the threshold, and its own not far below."""
    level = smooth(ratio)
    bar = SHARE * level.std()
    return (level >= bar) & (ratio >= OWN * bar) & (ratio > 0)


def furniture(page: Lines) -> np.ndarray:
    """Whether each line stands in furniture."""
    size = np.array([len(t) for t in page.texts], float)
    held = np.zeros(len(page.above))
    np.add.at(held, page.mark, size)
    for m in range(len(held) - 1, 0, -1):  # a mark has a larger number than the one around it
        held[page.above[m]] += held[m]
    veto = [False] * len(held)
    for m in range(1, len(held)):
        most = held[m] > held[0] / 2
        lifted = page.mains[m] or most and (page.strength[m] == LAYOUT_ONLY or 0 < page.articles[m] == page.articles[0])
        veto[m] = not lifted or veto[page.above[m]]
    return np.array(veto)[page.mark]


def _within(page: Lines, holder: int) -> np.ndarray:
    """Whether each holder lies in the given one."""
    out = [False] * len(page.kind)
    for n in range(len(out)):
        out[n] = n == holder or n > holder and out[page.parent[n]]
    return np.array(out)


def extract(html: str | None) -> str:
    """The main text of a page."""
    if not html:
        return ""
    page = Lines()
    page.feed(html)
    page.finish()
    if not page.texts:
        return ""
    open_ = ~furniture(page)
    if not open_.any():
        return ""
    held = np.array(page.held)
    size = np.array([len(t) for t in page.texts], float)
    # a line of furniture counts as one without text, and so lowers its neighbours
    found = open_ & content(np.where(open_, ratios(page.texts, page.linked, page.tags), 0.0))
    if not found.any():  # nothing but links
        found = open_ & content(np.where(open_, ratios(page.texts, [0] * len(page.texts), page.tags), 0.0))
    turn = np.flatnonzero(np.diff(np.concatenate([[0], found.astype(int), [0]])))
    a, b = max(zip(turn[::2], turn[1::2]), key=lambda r: size[r[0] : r[1]].sum())
    n = page.held[a + int(size[a:b].argmax())]
    scope = 0
    while n:  # the outermost article, unless a main element holds that one only
        if page.kind[n] == "article" or page.kind[n] == "main" and (page.articles[0] < 2 or not scope):
            scope = n
        n = page.parent[n]
    if scope:
        open_ &= _within(page, scope)[held]
        found &= open_
    # the smallest holder of all clusters
    mass = [0] * len(page.kind)
    for n in held[found].tolist():
        mass[n] += 1
    for n in range(len(mass) - 1, 0, -1):  # a holder has a larger number than what holds it
        mass[page.parent[n]] += mass[n]
    holder = max((n for n in range(len(mass)) if mass[n] == mass[0]), default=0)
    if scope and holder != scope:
        holder = scope if _headed(page, scope, holder, open_) else holder
    keep = open_ & _within(page, holder)[held]
    if not scope:
        keep &= ~_link_lists(page, holder, mass, keep)
    return "\n".join(t for t, k in zip(page.texts, keep) if k)


def _headed(page: Lines, scope: int, holder: int, open_: np.ndarray) -> bool:
    """Whether the article has other text that isn't links outside its clusters' holder, as headlines are."""
    inner = _within(page, holder)
    return any(o and not inner[h] and k < len(t) for t, k, h, o in zip(page.texts, page.linked, page.held, open_))


def _link_lists(page: Lines, holder: int, mass: list[int], keep: np.ndarray) -> np.ndarray:
    """Whether each line stands in a part of the holder that has no line of a cluster, and text in links only."""
    part = [0] * len(mass)  # of each holder the outermost one around it without lines of a cluster
    for n in range(holder + 1, len(mass)):
        part[n] = part[page.parent[n]] or (n if not mass[n] else 0)
    free = np.zeros(len(mass))
    for t, k, h, o in zip(page.texts, page.linked, page.held, keep):
        if o:
            free[part[h]] += max(len(t) - k, 0)
    return np.array([bool(part[h]) and not free[part[h]] for h in page.held])


def main_text(pages: DataFrame, source: str = "html", text: str = "text") -> DataFrame:
    """All rows and columns of pages with the main text, which replaces a column of that name."""

    @F.pandas_udf("string")
    def of(rows):
        return rows.map(extract)

    return pages.withColumn(text, of(F.coalesce(source, F.lit(""))))


def query(spark: SparkSession, pages: DataFrame) -> DataFrame:
    got = main_text(pages.select("page_id", "url", "html"))
    return got.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
