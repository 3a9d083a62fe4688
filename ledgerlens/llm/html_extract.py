"""Main text of HTML pages by text-to-tag ratio over streaming parser events.

The standard library's parser is fed the whole page; its events build lines, one
for each stretch of text between block tags, with the number of tags in it and
the containers that it stands in. Lines inside containers that are never
article text (menus, page headers and footers, asides, forms, scripts) are
set aside, and so are those in elements whose class, id or role says advert, notice,
comments and the like, articles too, unless the element holds most of the page's content (``post with-comments``) and no
other article does. On the others the ratio of text to tags is smoothed with a Gaussian,
and lines above the threshold (a share of the smoothed ratios' deviation)
cluster into content. The content region is the deepest container that holds
nearly all content; an ``article`` or ``main`` is taken whole, so that its short
lines stay, and elsewhere the region runs from the first content line to the last.

Defined results: null or empty html, and pages without content, give an empty
text. Rows are answered one for one and in place: no shuffle. Further columns of
the input are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

BLOCKS = frozenset("""address article aside blockquote body br button caption center dd details dialog div dl dt
fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html iframe legend li main menu nav noscript ol
option p pre section select summary table tbody td template textarea tfoot th thead title tr ul""".split())
CONTAINERS = frozenset("""article aside blockquote body center details dialog div dl fieldset figure footer form head
header li main menu nav noscript ol section select svg table tbody td template textarea th title tr ul button iframe
object canvas math""".split())
#: Containers that hold no article text.
ASIDE = frozenset("aside button dialog footer form head iframe menu nav noscript object select svg canvas template textarea title".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Words of a class, id or role that say the same.
HINTS = frozenset("""ad ads advert adverts advertisement advertisements banner breadcrumb breadcrumbs comment comments
consent contentinfo cookie cookies disqus footer login masthead menu modal nav navbar navigation newsletter notice notices
pagination popup promo promoted promotion related search share sharing sidebar signup social sponsor sponsored subscribe
toolbar widget""".split())
_PARTS = re.compile(r"[a-z]+")

#: Standard deviation and reach of the Gaussian, in lines.
SIGMA, REACH = 1.0, 3
#: Share of the smoothed ratios' deviation that content exceeds.
THRESHOLD = 0.5
#: Share of the content that a container needs to be the region.
REGION = 0.8


Line = tuple[str, int, int, int, int]


class _Lines(HTMLParser):
    """Lines of a page: (text, tags, container number, characters in links, links); containers: (parent, tag, whether set aside by tags, whether
    its words, or for the articles in it its tag, say that it is no article text)."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.containers: list[tuple[int, str, bool, bool]] = [(-1, "", False, False)]
        self.open: list[int] = [0]
        self.lines: list[Line] = []
        self.text: list[str] = []
        self.tags = self.linked = self.links = 0
        self.in_link = False

    def _end_line(self) -> None:
        text = " ".join("".join(self.text).split())
        if text:
            self.lines.append((text, self.tags, self.open[-1], self.linked, self.links))
            self.tags = self.links = 0
        self.text, self.linked = [], 0

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in BLOCKS:
            self._end_line()
        self.tags += 1
        if tag == "a":
            self.in_link = any(k == "href" for k, _ in attrs)
            self.links += self.in_link
        if tag not in CONTAINERS:
            return
        up = self.open[-1]
        aside = self.containers[up][2]
        if tag in ("article", "main"):
            # a form or the like around the whole page does not hide the article; hints, and tags by way of hints, may
            aside = False
        elif not aside:
            aside = tag in ASIDE or (tag == "header" and not self._inside("article"))
        hinted = tag in ASIDE - {"form"}
        if not hinted and tag not in ("body", "td", "tr", "tbody"):
            said = " ".join(v for k, v in attrs if v and k in ("class", "id", "role"))
            hinted = bool(said) and not HINTS.isdisjoint(_PARTS.findall(said.lower()))
        self.containers.append((up, tag, aside, hinted))
        self.open.append(len(self.containers) - 1)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        if tag in BLOCKS:
            self._end_line()
        self.tags += 1

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCKS:
            self._end_line()
        self.tags += 1
        if tag == "a":
            self.in_link = False
        if tag in CONTAINERS:
            for at in range(len(self.open) - 1, 0, -1):
                name = self.containers[self.open[at]][1]
                if name == tag:
                    del self.open[at:]
                    break
                if name in ("article", "main", "nav", "aside", "footer", "form") and tag in ("div", "li", "ul", "td", "tr"):
                    break  # a stray end tag closes no section around it

    def _inside(self, tag: str) -> bool:
        return any(self.containers[c][1] == tag for c in self.open)

    def handle_data(self, data: str) -> None:
        if self.cdata_elem is None:
            self.text.append(data)
            if self.in_link:
                self.linked += len(data.strip())

    def close(self) -> None:
        super().close()
        self._end_line()


def _smoothed(ratio: np.ndarray) -> np.ndarray:
    reach = np.arange(-REACH, REACH + 1)
    kernel = np.exp(-(reach ** 2) / (2 * SIGMA ** 2))
    kernel /= kernel.sum()
    padded = np.pad(ratio, REACH, mode="edge")
    return np.convolve(padded, kernel, mode="valid")


def _content(lines: list[Line]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sizes of the lines, which are content by their smoothed ratios, and which have half the mean ratio or more."""
    size = np.array([len(x[0]) for x in lines], float)
    ratio = size / np.maximum([x[1] for x in lines], 1)
    smooth = _smoothed(ratio)
    return size, smooth >= THRESHOLD * smooth.std(), ratio >= smooth.mean() / 2


def _joined(lines: list[Line], high: np.ndarray, chosen: list[bool]) -> str:
    """Text of the chosen lines without link lists."""
    out: list[str] = []
    links: list[Line] = []
    for x, is_high, taken in [*zip(lines, high, chosen, strict=True), (("", 0, 0, 0, 0), True, True)]:
        if not taken:
            continue
        if not is_high and 2 * x[3] > len(x[0]):
            links.append(x)
            continue
        if sum(y[4] for y in links) < 2:
            out += [y[0] for y in links]
        links = []
        out.append(x[0])
    return " ".join(out[:-1])


def _without_hinted(page: _Lines, lines: list[Line]) -> list[Line]:
    """The lines outside of containers whose hints count."""
    if not lines or not any(c[3] for c in page.containers):
        return lines
    within: dict[int, list[int]] = {}
    in_article: dict[int, bool] = {}
    for c in {x[2] for x in lines}:
        within[c], in_article[c], at = [], False, c
        while at >= 0:
            up, tag, _, hinted = page.containers[at]
            if hinted:
                within[c].append(at)
            in_article[c] |= tag in ("article", "main")
            at = up
    weight: dict[int, float] = {}
    total = free = 0.0
    for (_, _, c, *_), w, is_content, _ in zip(lines, *_content(lines), strict=True):
        if is_content:
            total += w
            free += w if in_article[c] and not within[c] else 0.0
            for at in within[c]:
                weight[at] = weight.get(at, 0.0) + w
    # where another article holds content every hint counts, elsewhere none on most of the content
    most = total if free > 0 and free >= (1 - REGION) * total else total / 2
    return [x for x in lines if all(weight.get(at, 0.0) > most for at in within[x[2]])]


def main_text(html: str | None) -> str:
    """Main text of one page."""
    if not html:
        return ""
    page = _Lines()
    page.feed(html)
    page.close()
    lines = _without_hinted(page, [x for x in page.lines if not page.containers[x[2]][2]])
    if not lines:
        return ""
    size, content, high = _content(lines)
    weight: dict[int, float] = {}
    above: list[list[int]] = []
    for (_, _, c, *_), w, is_content in zip(lines, size, content, strict=True):
        chain = []
        while c >= 0:
            chain.append(c)
            if is_content:
                weight[c] = weight.get(c, 0.0) + w
            c = page.containers[c][0]
        above.append(chain)
    region, total = 0, weight.get(0, 0.0)
    down: dict[int, list[int]] = {}
    for c in weight:
        down.setdefault(page.containers[c][0], []).append(c)
    while page.containers[region][1] not in ("article", "main"):
        best = max(down.get(region, []), key=lambda c: weight[c], default=None)
        if best is None or weight[best] < REGION * total:
            break
        region = best
    if page.containers[region][1] in ("article", "main"):
        return _joined(lines, high, [region in chain for chain in above])
    # several articles side by side, or none: from the first content line to the last
    articles = {c for c in weight if page.containers[c][1] in ("article", "main")}
    if articles:
        return _joined(lines, high, [not articles.isdisjoint(chain) for chain in above])
    inside = np.array([region in chain for chain in above])
    at = np.flatnonzero(content & inside)
    if not len(at):
        return ""
    return _joined(lines, high, [bool(at[0] <= k <= at[-1] and inside[k]) for k in range(len(lines))])


def extract(pages: DataFrame, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The ``keep`` columns of each row with text and n_chars (code points)."""
    kept = pages.select(*[f"`{c}`" for c in keep]).schema
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + ", text string, n_chars long"
    names = list(keep)

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = pdf[names].copy()
            out["text"] = [main_text(h) for h in pdf["__html"]]
            out["n_chars"] = out["text"].str.len().astype("int64")
            yield out

    from pyspark.sql import functions as F

    return pages.select(*[f"`{c}`" for c in keep], F.col(f"`{html_col}`").alias("__html")).mapInPandas(work, schema)
