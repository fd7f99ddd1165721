"""Main text of web pages by text-to-tag ratio.

The standard library's parser streams its events; block tags cut them into lines. A line's ratio is its characters
over its tags; the ratios are smoothed with a Gaussian and cut in two clusters by an iterated threshold. A region (an
container; sections belong to the container around them) that holds a line of the upper cluster is content, and all of its
lines are kept, short ones and headings too; on a page with article or main elements, those are the regions, all of them.
Menus, forms and the like are no lines of any region. They, and elements that only their class, id or role names
so, are judged at the page's end, when it is known what they enclose and whether they were closed.

Every event costs a bounded number of steps, whatever the depth of the markup: open elements are found by name.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import query, slices, table

SIGMA = 1.0
RADIUS = 2
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "frameset h1 h2 h3 h4 h5 h6 header hgroup html legend li main menu nav ol p pre section summary table tbody td tfoot "
    "th thead tr ul".split()
)
MARKED = frozenset(("article", "main"))
CONTAINERS = frozenset("body div td blockquote figure details".split())
NOISE = frozenset(
    "audio button canvas datalist dialog frameset head iframe noframes noscript object script select style svg template "
    "textarea title video".split()
)
#: elements whose content is no main text, judged at the page's end
STRUCTURE = frozenset("aside footer form header menu nav".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
HINTS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies "
    "disqus footer gdpr header login masthead menu modal nav navbar navigation newsletter notice notices "
    "pagination popup promo promoted promotion related reply replies respond share sharing sidebar signup social sponsor "
    "sponsored subscribe subscription toolbar widget widgets".split()
)
#: hints of readers' comments, each often an article of its own
COMMENTS = frozenset("comment comments disqus replies reply respond".split())
#: hints that mean what they say however much of the text their element holds
STRICT = COMMENTS | frozenset(
    "ad ads advert adverts advertisement advertising breadcrumb breadcrumbs consent cookie cookies footer gdpr login "
    "menu nav navbar navigation newsletter pagination related sidebar signup sponsor sponsored subscribe subscription".split()
)
#: elements that no hint makes noise; an article may be a comment beside another
KEPT = frozenset("html body article main h1 h2 h3 h4 h5 h6".split())
#: "with-sidebar" says what is around an element, not what it is
AROUND = frozenset("hide hides has no not with without".split())
#: "comment-list" is what "comment" is
PARTS = frozenset("area bar block bottom box container inner item items left list right section top wrap wrapper".split())
#: an open element of the first kind ends where one of the second kind opens
ENDED_BY = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
}
_NOISE = -1
_OPEN, _CLOSED_BY_NAME, _CLOSED_AROUND = range(3)
_MARKUP = re.compile(r"<[!?/a-zA-Z]")
_TOKEN = re.compile(r"[a-z]+")
_CLOSED = re.compile(r"<!\[\s*(?:temp|cdata|ignore|include|rcdata)\b", re.IGNORECASE)  # sections that end at ]]>
_LONG = re.compile(r"&#[0-9]{4300,};?")  # beyond what int() reads, so no character


def hint_of(attrs: list[tuple[str, str | None]]) -> str | None:
    """The hint that a class, id or role ends in, whole names or their last part."""
    for name, value in attrs:
        if name in ("class", "id", "role") and value:
            for whole in value.lower().split():
                parts = _TOKEN.findall(whole)
                while len(parts) > 1 and parts[-1] in PARTS:
                    parts.pop()
                if parts and parts[-1] in HINTS and AROUND.isdisjoint(parts[:-1]):
                    return parts[-1]
    return None


class Doubt:
    """An element that may be noise, or what follows an article or heading inside one."""

    def __init__(self, outer: int, name: str, hint: str | None = None, of: int = 0):
        self.outer, self.name, self.hint, self.of = outer, name, hint, of
        self.state = _OPEN


class Lines(HTMLParser):
    """Lines of a page: (text, tags, region); text in noise elements is left out."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.raw: list[tuple[list[tuple[int, str]], int, int]] = []  # pieces of a line with their doubtful element
        self.marked: set[int] = set()
        self.stack: list[list] = []  # name, noise: doubtful element or _NOISE, region
        self.places: dict[str, list[int]] = {}  # of open elements in the stack, by name
        self.owners: dict[int, int] = {}  # place in the stack of an open structural element, by its number
        self.doubts: list[Doubt] = [Doubt(0, "")]
        self.enclosing: set[int] = set()  # doubtful elements around an article or main; 0 if one is in none
        self.regions = 1
        self.data: list[tuple[int, str]] = []
        self.tags = 0

    def cut(self) -> None:
        if self.data:
            self.raw.append((self.data, self.tags, self.stack[-1][2] if self.stack else 0))
            self.data, self.tags = [], 0

    def push(self, tag: str, noise: int, region: int) -> None:
        self.places.setdefault(tag, []).append(len(self.stack))
        self.stack.append([tag, noise, region])

    def pop_to(self, place: int, by: str | None = None) -> None:
        """End the open elements from ``place`` on; the one there by its own tag if ``by`` names it."""
        while len(self.stack) > place:
            tag, _, _ = self.stack.pop()
            self.places[tag].pop()
            own = self.owners.pop(len(self.stack), 0)
            if own:
                named = by is not None and len(self.stack) == place
                around = by is not None and by not in ("html", "body")
                self.doubts[own].state = _CLOSED_BY_NAME if named else _CLOSED_AROUND if around else _OPEN

    def doubt(self, place: int, outer: int, name: str, hint: str | None = None) -> int:
        self.doubts.append(Doubt(outer, name, hint))
        self.owners[place] = len(self.doubts) - 1
        return len(self.doubts) - 1

    def split(self, noise: int, tag: str) -> int:
        """Inside a menu or the like an article, main or heading may mean that its end was forgotten.

        What follows gets a number of its own, and counts as outside if the element is never closed.
        """
        inside = self.doubts[noise]
        if inside.name == "heading" and tag in MARKED:
            start, of = inside.of, inside.of
        elif inside.name in STRUCTURE and inside.name != "form" and not inside.hint:
            start, of = noise, noise
        else:
            return noise
        place = next((k for k, own in reversed(self.owners.items()) if own == start), None)
        if place is None:
            return noise
        self.doubts.append(Doubt(noise, "marked" if tag in MARKED else "heading", None, of))
        new = len(self.doubts) - 1
        for entry in self.stack[place:]:
            if entry[1] == noise:
                entry[1] = new
        return new

    def enclose(self, noise: int) -> None:
        if not noise:
            self.enclosing.add(0)
        while noise and noise not in self.enclosing:
            self.enclosing.add(noise)
            noise = self.doubts[noise].outer

    def noise(self) -> set[int]:
        """Numbers of the doubtful elements that are noise.

        An element named as noise is none if it encloses an article or main, or holds most of the text under a name that
        may mean anything. Comments are noise whatever they hold, but for an article beside no other. A form is none if it
        encloses an article or holds most of the text; other structural elements are noise.
        """
        total, sizes = 0, [0] * len(self.doubts)
        for pieces, _, _ in self.raw:
            for k, text in pieces:
                size = len("".join(text.split()))
                total += size
                sizes[k] += size
        for k in range(len(sizes) - 1, 0, -1):  # an element comes after those around it
            sizes[self.doubts[k].outer] += sizes[k]
        noise: set[int] = set()
        for k, d in enumerate(self.doubts[1:], start=1):
            most = 2 * sizes[k] > total
            if d.of:
                state = self.doubts[d.of].state
                forgotten = state == _OPEN or (state == _CLOSED_AROUND and d.name == "marked")
                bad = (self.doubts[d.of].outer if forgotten else d.outer) in noise
            elif d.outer in noise:
                bad = True
            elif d.hint in COMMENTS:
                bad = d.name not in MARKED or 0 in self.enclosing
            elif d.hint:
                bad = k not in self.enclosing and not (most and d.hint not in STRICT)
            elif d.name == "form":
                bad = k not in self.enclosing and not most
            else:
                bad = True
            if bad:
                noise.add(k)
        return noise

    def lines(self) -> list[tuple[str, int, int]]:
        noise = self.noise() if len(self.doubts) > 1 else set()
        out, tags = [], 0
        for pieces, own, region in self.raw:
            text = " ".join("".join([text for k, text in pieces if k not in noise]).split())
            tags += own
            if text:
                out.append((text, tags, region))
                tags = 0
        return out

    def open_place(self, tags: Iterable[str]) -> int:
        """Place in the stack of the innermost open element of these names, -1 if there is none."""
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=-1)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.tags += 1
        block = tag in BLOCKS
        if tag in VOID:
            self.data.append((0, " "))
            return
        hidden, hint = tag in NOISE, None
        if attrs and tag not in ("html", "body"):
            hidden = hidden or any(name == "hidden" or (name == "aria-hidden" and value == "true") for name, value in attrs)
            hint = hint_of(attrs) if not hidden else None
            if tag in KEPT and not (tag == "article" and hint in COMMENTS):
                hint = None
        structure = tag in STRUCTURE
        if block:
            self.cut()
            if self.stack and self.stack[-1][0] == "p":
                self.pop_to(len(self.stack) - 1)
            if tag in ENDED_BY:
                closed, stop = ENDED_BY[tag]
                place = self.open_place(closed)
                if place > self.open_place(stop):
                    self.pop_to(place)
        elif not (hidden or hint):
            return
        _, noise, region = self.stack[-1] if self.stack else ("", 0, 0)
        if noise > 0 and (tag in MARKED or tag in HEADINGS):
            noise = self.split(noise, tag)
        if noise != _NOISE and (hidden or hint or structure):
            if not block:
                self.data.append((noise, " "))
            noise = _NOISE if hidden else self.doubt(len(self.stack), noise, tag, hint)
        if noise != _NOISE:
            if tag in MARKED and not hint:
                self.enclose(noise)
            if (tag in MARKED or tag in CONTAINERS) and region not in self.marked:
                region, self.regions = self.regions, self.regions + 1
                if tag in MARKED:
                    self.marked.add(region)
        self.push(tag, noise, region)

    def handle_startendtag(self, tag: str, attrs) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if tag in BLOCKS:
            self.cut()
        place = self.open_place((tag,))
        if place >= 0 and (tag in BLOCKS or tag in NOISE or len(self.stack) - place <= 8):
            self.pop_to(place, tag)

    def parse_marked_section(self, i: int, report: int = 1) -> int:
        """A section that has its ]]> ends there; any other <![ ends at its >, as a bogus comment does."""
        close = self.rawdata.find("]]>", i + 3) if _CLOSED.match(self.rawdata, i) else -1
        if close >= 0:
            return close + 3
        end = self.rawdata.find(">", i + 3)
        return end + 1 if end >= 0 else -1

    def handle_data(self, data: str) -> None:
        noise = self.stack[-1][1] if self.stack else 0
        if noise != _NOISE:
            self.data.append((noise, data))


def _upper(ratios: np.ndarray) -> np.ndarray:
    """The lines of the upper of two clusters of smoothed ratios."""
    kernel = np.exp(-0.5 * (np.arange(-RADIUS, RADIUS + 1) / SIGMA) ** 2)
    size = np.convolve(np.ones(len(ratios)), kernel, "full")[RADIUS:-RADIUS]
    smooth = np.convolve(ratios, kernel, "full")[RADIUS:-RADIUS] / size
    cut = smooth.mean()
    for _ in range(20):
        high, low = smooth[smooth >= cut], smooth[smooth < cut]
        new = (high.mean() + low.mean()) / 2 if len(high) and len(low) else cut
        if abs(new - cut) < 1e-9:
            break
        cut = new
    return smooth >= min(cut, smooth.max())


def main_text(html: str) -> str:
    """The main text of one page: its content lines in page order, one a line; empty if there are none."""
    parser = Lines()
    parser.feed(_LONG.sub("\ufffd", html))
    unfinished = _MARKUP.search(parser.rawdata)  # a tag or comment that the page ends in is no text
    if unfinished:
        parser.rawdata = parser.rawdata[: unfinished.start()]
    parser.close()
    parser.cut()
    lines = parser.lines()
    if not lines:
        return ""
    upper = _upper(np.array([len(text) / max(1, tags) for text, tags, _ in lines]))
    chosen = {r for _, _, r in lines if r in parser.marked}  # every article and main, short ones too
    if not chosen:
        chosen = {r for (_, _, r), up in zip(lines, upper) if up}
    return "\n".join(text for text, _, r in lines if r in chosen)


def _extract(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, 128):
        texts = [main_text(html.as_py() or "") for html in batch.column("html")]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
            names=["page_id", "url", "text", "n_chars"],
        )


def extract(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every row; a null or empty page has an empty text.

    Pages are handled one by one, whole, so repeated rows give repeated results and an empty table gives none.
    """
    pages = df.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    kinds = ", ".join(f"{c} {pages.schema[c].dataType.simpleString()}" for c in ("page_id", "url"))
    return pages.mapInArrow(_extract, f"{kinds}, text string, n_chars bigint")


@query("op7_html_main_text")
def op7_html_main_text(spark, sf):
    return extract(table(spark, sf, "pages"))
