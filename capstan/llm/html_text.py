"""Operator 3, HTML extraction by text-to-tag ratios.

Events of the standard library's parser are streamed into blocks (the "lines"
of the method, as pages may hold no newline).  Each block's ratio of text to
tags is smoothed with a Gaussian and blocks are clustered by a threshold on
the smoothed ratio.  The clusters choose the content region: all article and
main elements if these hold most of the text in high blocks, or else the
smallest container of all high blocks, all regions named as an article and the
headings over them.  Blocks that mark-up names as page furniture (menus,
adverts, comments ...) are never returned and, like blocks of links alone, do
not vote; names of layout and forms are only in doubt, and the clusters settle
it: a container that holds an article or, on pages without one, most of the
high text is none; of the region, all other blocks are returned, so a short paragraph is
not lost beside long ones.
"""

from __future__ import annotations

import re
from collections import Counter
from html.parser import HTMLParser
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from capstan.llm.common import col, packed, schema_of
from capstan.llm.registry import query
from capstan.tables import table

FEED = 1 << 16  # characters given to the parser at a time
SIGMA, THRESHOLD = 1.0, 0.5  # width in blocks; share of the ratios' deviation

#: Elements by role.
SKIP = frozenset("script style noscript template svg math iframe object canvas audio video select option textarea button head title datalist".split())
HEAD = frozenset("html head base basefont bgsound link meta noframes noscript script style template title".split())
HELD = frozenset("noscript template title".split())  # what is open in the head keeps other elements to itself
FURNITURE = frozenset("nav footer aside menu dialog".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BREAKS = frozenset("address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption figure footer form "
                   "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
CLOSES_P = BREAKS - {"br"}
REGION = frozenset("article main section div body td".split())
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements whose names count: containers, not the headings, paragraphs and inline elements in them.
CONTAINERS = frozenset("article aside center details div dl fieldset figure footer form header hgroup li main nav ol section table tbody td tfoot th thead tr ul".split())
#: Words of class, id and role that name what never holds the text ...
NEVER = frozenset("""ad ads advert adverts advertisement advertisements adsense adslot sponsor sponsored promoted breadcrumb breadcrumbs
    comment comments commentlist disqus reply replies respond responses cookie cookies consent gdpr notice notices notification alert popup modal
    newsletter subscribe subscription signup login share sharing sharedaddy relatedposts pagination pager""".split())
#: ... and what names a part of the page, unless most of the text or the article is in it.
LAYOUTS = frozenset("""promo promotion banner nav navbar navigation menu sidebar aside side rail widget widgets footer header masthead topbar
    toolbar social related recommended form search skip complementary contentinfo""".split())
#: Words that may stand beside these in a name; any other word makes it a name of its own ("social-science").
BESIDE = frozenset("""site page post posts blog article articles story stories reader user guest left right top bottom main global mobile desktop
    sticky wp fb js my the primary secondary sub list item items thread count author box bar area block section wrapper wrap container holder
    inner outer content body text message link links button buttons icon icons law policy info overlay dialog unit slot row col column more
    first last active toggle trigger level tree group template part module component region field input""".split())
#: Run-together names of furniture: one of these stems, with known beginnings and endings only ("commentary" is none).
STEMS = re.compile(r"(?:site|page|post|blog|article|story|reader|user|guest|left|right|top|bottom|main|global|mobile|desktop|sticky|email|wp|fb|js|my|the|eu)*"
                   r"(comment|cookie|advert|sidebar|newsletter|sponsor|breadcrumb|popup|consent|disqus|gdpr|notice)"
                   r"(?:s|ed|ing|isement|list|item|thread|count|author|form|box|bar|area|block|banner|section|wrapper|wrap|container|holder|inner|outer|content"
                   r"|body|text|message|link|law|policy|info|overlay|modal|dialog|popup|consent|notice|signup|widget|left|right|top|bottom|nav|trail|slot|unit)*")
MILD = frozenset("header banner side promo widget section search form".split())  # also parts of an article's own names
ARTICLE = frozenset("article main post entry content story articlebody postcontent entrycontent maincontent".split())
#: Article elements with one of these in their names are no part of the text.
ASIDE = frozenset("related recommended promo widget".split())
WORDS = re.compile(r"[a-z]+")
LAYOUT = re.compile(r"(?<![a-z0-9])(?:has|with|no|without)[-_][\w-]+")
SPACES = re.compile(r"\s+")
FIELDS = frozenset("input select textarea".split())
MOST = 0.8  # share of the high text that a container in doubt must hold to be none
FIELD_CHARS = 100  # text that a form must have for each of its fields to be no form


class _Region:
    """A container that text may be chosen by; its descendants are numbered
    ``number`` to ``last``."""
    __slots__ = ("up", "number", "last")

    def __init__(self, up, number):
        self.up, self.number, self.last = up, number, 1 << 62


class _Doubt:
    """A container that looks like furniture by its name or as a form."""
    __slots__ = ("up", "form", "article", "fields", "chars", "high", "clear")

    def __init__(self, up, form):
        self.up, self.form, self.article, self.fields, self.chars, self.high, self.clear = up, form, False, 0, 0, 0, False


class _Open:
    """An open element and what holds inside it: skipped, furniture, the
    closest container in doubt, region, in an article or main element, in one or
    a region named so, in a link, heading (rank, number)."""
    __slots__ = ("tag", "skip", "furniture", "doubt", "region", "marked", "named", "link", "heading")

    def __init__(self, tag, skip=False, furniture=False, doubt=None, region=None, marked=False, named=False, link=False, heading=None):
        self.tag, self.skip, self.furniture, self.doubt, self.region = tag, skip, furniture, doubt, region
        self.marked, self.named, self.link, self.heading = marked, named, link, heading


class Block(NamedTuple):
    text: str
    tags: int
    plain: bool  # has text outside links
    place: _Open


class Blocks(HTMLParser):
    """Streams events into blocks."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = _Region(None, 0)
        self.stack, self.open, self.head, self.held = [_Open("", region=self.root)], Counter(), None, 0
        self.out, self.text, self.tags, self.plain, self.regions, self.headings, self.doubts = [], [], 0, False, 0, 0, []

    def drop(self, i):
        """Elements from the i-th on end."""
        for o, up in zip(self.stack[i:], self.stack[i - 1:]):
            self.open[o.tag] -= 1
            self.held -= o.tag in HELD
            if o.region is not up.region:
                o.region.last = self.regions
        del self.stack[i:]
        if self.head is not None and self.head >= i:
            self.head = None

    def close_block(self):
        text = SPACES.sub(" ", "".join(self.text)).strip()
        if text:
            self.out.append(Block(text, max(1, self.tags), self.plain, self.stack[-1]))
            self.tags = 0
        self.text, self.plain = [], False

    def names(self, attrs):
        """Words of furniture in the names an element carries, and whether one
        of them names an article.  A compound name has furniture words only if
        all its other words are of position, or as its last word; a run-together name has the stem
        in it; layout hints ("has-sidebar", "hasSidebar") do not count."""
        words, named = set(), False
        for k, v in attrs:
            if k not in ("class", "id", "role", "itemprop") or not v:
                continue
            for name in LAYOUT.sub("", re.sub(r"([a-z])([A-Z])", r"\1-\2", v).lower()).split():
                parts = WORDS.findall(name)
                bad = {w for w in (*parts, "".join(parts)) if w in NEVER or w in LAYOUTS}
                if len(parts) > 1 and not all(w in NEVER or w in LAYOUTS or w in BESIDE for w in parts):
                    bad &= {"".join(parts), parts[-1]}
                bad |= {m[1] for w in parts if (m := STEMS.fullmatch(w))}
                own = not ARTICLE.isdisjoint(parts) or "".join(parts) in ARTICLE
                if own and bad <= MILD:  # an article's own header
                    named |= not bad
                else:
                    words |= bad
        return words, named

    def end_head(self, always: bool):
        """The end tag of the head is optional."""
        if self.head is not None and (always or not self.held):
            self.close_block()
            self.drop(self.head)

    def handle_starttag(self, tag, attrs):
        self.tags += 1
        if self.stack[-1].skip and tag not in HEAD:
            self.end_head(always=tag == "body")
        if tag in BREAKS:
            self.close_block()
        if tag in CLOSES_P:
            self.end_to(("p",), stop=REGION | {"li", "td", "th", "blockquote"})
        if tag == "li":
            self.end_to(("li",), stop={"ul", "ol", "menu"})
        if tag in FIELDS and self.stack[-1].doubt and ("type", "hidden") not in attrs:
            self.stack[-1].doubt.fields += 1
        if tag in VOID:
            return
        top = self.stack[-1]
        words, own = self.names(attrs) if tag in CONTAINERS or tag == "body" else (set(), False)
        names_region = tag in REGION or tag == "body"
        furniture = top.furniture or tag in FURNITURE or (tag in CONTAINERS and not own and bool(words & (NEVER | ASIDE if tag == "article" else NEVER)))
        doubt = top.doubt
        if not furniture and (tag == "form" or (words & LAYOUTS and tag in CONTAINERS - {"article", "main"} and not own)):
            doubt = _Doubt(top.doubt, tag == "form")
            self.doubts.append(doubt)
        elif doubt and not furniture and tag in ("article", "main"):
            doubt.article = True
        if any(k == "hidden" or (k == "style" and v and "display:none" in v.replace(" ", "").lower()) or (k == "aria-hidden" and v == "true") for k, v in attrs):
            furniture = True
        if tag == "header" and not top.marked:
            furniture = True
        region, heading = top.region, top.heading
        if names_region and not furniture:
            self.regions += 1
            region = _Region(top.region, self.regions)
        if tag in HEADING:
            self.headings += 1
            heading = (int(tag[1]), self.headings)
        marked = top.marked or tag in ("article", "main")
        named = marked or top.named or (names_region and own)
        link = top.link or (tag == "a" and any(k == "href" for k, _ in attrs))
        if tag == "head" and self.head is None:
            self.head = len(self.stack)
        self.open[tag] += 1
        self.held += tag in HELD
        self.stack.append(_Open(tag, top.skip or tag in SKIP, furniture, doubt, region, marked, named, link, heading))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def end_to(self, tags, stop=()):
        """Ends the innermost of ``tags``, unless one of ``stop`` is open in it;
        the block ends with it if a block element ends."""
        if not any(self.open[t] for t in tags):
            return
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].tag in tags:
                if any(o.tag in BREAKS for o in self.stack[i:]):
                    self.close_block()
                self.drop(i)
                return
            if self.stack[i].tag in stop:
                return

    def handle_endtag(self, tag):
        self.tags += 1
        if tag in BREAKS:
            self.close_block()
        self.end_to((tag,), stop=() if tag in BREAKS else {"p", "td", "li", "article", "div", "section", "body"})

    def handle_data(self, data):
        if self.stack[-1].tag == "head" and data.strip():
            self.end_head(always=True)
        if not self.stack[-1].skip:
            self.text.append(data)
            self.plain = self.plain or not (self.stack[-1].link or data.isspace())

    def unknown_decl(self, data):
        pass


def blocks(html: str) -> Blocks:
    p = Blocks()
    try:
        for a in range(0, len(html), FEED):
            p.feed(html[a:a + FEED])
        p.close()
    except AssertionError:  # a declaration the parser rejects is ordinary text
        if "<![" not in html:
            raise
        return blocks(html.replace("<![", "&lt;!["))
    p.close_block()
    return p


def smoothed(ratios: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Gaussian smoothing over neighbouring blocks."""
    reach = int(np.ceil(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    return np.convolve(np.pad(ratios, reach), kernel / kernel.sum(), "valid")


def headed(own: list[Block], chosen: set[int]) -> set[int]:
    """``chosen`` and the headings over them, with no heading of their rank or
    a higher one between."""
    out, below, last, taken = set(chosen), [False] * 7, None, False
    for i in range(len(own) - 1, -1, -1):
        heading = own[i].place.heading
        if heading and heading != last:  # a heading may have several blocks
            taken = below[heading[0]]
            below[heading[0]:] = [False] * (7 - heading[0])
        if heading and taken:
            out.add(i)
        if i in chosen:
            below = [True] * 7 if not heading else [True] * heading[0] + below[heading[0]:]
        last = heading
    return out


def settle(parsed: Blocks, own: list[Block], high: set[int]) -> None:
    """Clears the containers in doubt that hold an article or, on a page without
    one, most of the high text; of forms only those whose text outweighs their fields."""
    total = sum(len(own[i].text) for i in high)
    marked = any(b.place.marked for b in own)
    for i, b in enumerate(own):
        if b.place.doubt:
            b.place.doubt.chars += len(b.text)
            b.place.doubt.high += len(b.text) if i in high else 0
    for d in reversed(parsed.doubts):  # inner ones first
        d.clear = (d.article or not marked and d.high > MOST * total) and (not d.form or d.article or d.chars >= FIELD_CHARS * d.fields)
        if d.up:
            d.up.article |= d.article
            d.up.chars, d.up.high, d.up.fields = d.up.chars + d.chars, d.up.high + d.high, d.up.fields + d.fields
    for d in parsed.doubts:  # outer ones first: what is in furniture is furniture
        d.clear = d.clear and (d.up is None or d.up.clear)


def main_text(html: str | None) -> str:
    """The main text: blocks in page order joined by a newline, white space
    inside a block turned into one space.  Null or empty html gives ''."""
    if not html:
        return ""
    parsed = blocks(html)
    own = [b for b in parsed.out if not b.place.furniture]
    settle(parsed, own, high_blocks(own))
    own = [b for b in own if b.place.doubt is None or b.place.doubt.clear]
    if not own:
        return ""
    high = high_blocks(own)
    marked = {i for i, b in enumerate(own) if b.place.marked}
    if marked and sum(len(own[i].text) * (1 if i in marked else -1) for i in high) >= 0:
        # mark-up tells the text; a headline before it belongs to it if it has none itself
        chosen = marked if any(own[i].place.heading for i in marked) else headed(own, marked)
    else:  # the smallest container of all of them
        held = sorted(own[i].place.region.number for i in headed(own, high | {i for i, b in enumerate(own) if b.place.named}))
        box = next(b.place.region for b in own if b.place.region.number == held[0])
        while box.last < held[-1]:
            box = box.up
        chosen = {i for i, b in enumerate(own) if box.number <= b.place.region.number <= box.last}
    return "\n".join(b.text for i, b in enumerate(own) if i in chosen)


def high_blocks(own: list[Block]) -> set[int]:
    """Blocks whose smoothed text-to-tag ratio reaches the threshold; blocks of
    links alone have no say."""
    voters = [i for i, b in enumerate(own) if b.plain] or list(range(len(own)))
    if not voters:
        return set()
    smooth = smoothed(np.array([len(own[i].text) / own[i].tags for i in voters]))
    return {i for i, s in zip(voters, smooth) if s >= THRESHOLD * smooth.std()}


def _extract(parts):
    for b in parts:
        texts = [main_text(h) for h in b.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["row", "text", "n_chars"])


def extract_text(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """One row per page: ``row`` (struct of all other columns), ``text`` and
    ``n_chars`` (its code points).  A null or empty page has the text ''; rows
    are independent, so repeats, ties and column names do not matter, and an
    empty table gives no row."""
    base = pages.select(packed(pages, (html_col,)), col(html_col).cast("string").alias("html"))
    return base.mapInArrow(_extract, schema_of(base, "text string, n_chars long"))


@query("op3_html_text")
def op3_html_text(spark, sf_dir):
    got = extract_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return got.select("row.page_id", "row.url", "text", "n_chars")
