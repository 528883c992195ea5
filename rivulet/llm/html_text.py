"""Main text of web pages from parser events and text-to-tag ratios.

A page is read once as a stream of events into lines: the text between two
block tags, with the number of tags met on the way. The text-to-tag ratios of
the lines, smoothed by a Gaussian, are clustered into high and low by an
iterated threshold; the container that holds most of the high text, with the
headings and paragraphs beside it, is the content region. High text in an
`article` or `main` counts double. Containers named like what stands around an
article are left out unless they hold most of the high text.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from rivulet.llm.common import adding

SIGMA = 1.0
#: A container is taken over its parent while it holds this share of the high text.
SHARE = 0.9
#: How much more high text in an article or main element counts than other high text.
HINT = 2

# Elements of the markup language by their role.
INLINE = set(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr".split()
)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = set(
    "head title script style noscript template svg math iframe object audio video canvas map button select option "
    "textarea input fieldset datalist dialog nav menu aside footer".split()
)
CONTENT = {"article", "main"}
#: Text in these is named for itself: a name marks them only if all of its words do ('social-sciences' does not).
TEXT = {"p", "blockquote", "pre", "h1", "h2", "h3", "h4", "h5", "h6"}
#: Start tags that end an open element of the same kind.
ENDS = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
SCOPE = {"ul", "ol", "dl", "table", "div", "section", "article", "main", "body", "blockquote", "td", "th", "aside", "nav", "header", "footer", "form"}
#: Words of class names, ids and roles that mark what stands around an article.
AROUND = set(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu "
    "breadcrumb breadcrumbs sidebar aside complementary footer contentinfo masthead cookie cookies consent gdpr notice notices alert "
    "popup modal overlay comment comments reply replies disqus discussion discussions teaser teasers share sharing social related recommended newsletter subscribe "
    "subscription signup login search pagination pager toolbar widget hidden".split()
)
#: Words that name readers' words; containers named so hold no article beside them.
READERS = set("comment comments reply replies disqus discussion discussions".split())
WORD = re.compile(r"[a-z]+")
#: Names that only say how the page looks ('has-sidebar', 'comments-open') mark nothing.
LOOKS = re.compile(r"(has|no|with|without|show|hide|hides|overflow)[-_].*|.*[-_](open|opened|closed|on|off|enabled|disabled|page|layout|left|right)")
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
BLOCKS = HEADINGS | set("p li dt dd blockquote pre td th figcaption caption summary details ul ol dl".split())


class _Lines(HTMLParser):
    """Collects the lines of a page: text, tags, path of containers, and whether it stands around the article."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, int, bool]] = []  # element, container number, never seen
        self.parents: list[int] = [-1]  # of each container; 0 is the page
        self.kinds: list[str] = [""]
        self.marked: list[bool] = [False]
        self.readers: list[bool] = [False]
        self.classes: list[str | None] = [None]
        self.text: list[str] = []
        self.tags = 0
        self.lines: list[tuple[str, int, int, bool]] = []  # text, tags, container, mostly links
        self.linking = False
        self.linked = 0

    def _place(self) -> tuple[int, bool]:
        return (self.open[-1][1], self.open[-1][2]) if self.open else (0, False)

    def end_line(self) -> None:
        line = " ".join("".join(self.text).split())
        if line:
            self.lines.append((line, self.tags, self._place()[0], 2 * self.linked > len(line)))
            self.tags = 0
        self.text, self.linked = [], 0

    def handle_starttag(self, tag, attrs):
        self.tags += 1
        if tag == "br":
            self.text.append(" ")
        if tag == "a":
            self.linking = True
        # an inline element that stands around the article is marked like any other
        names = [] if tag in ("html", "body") else [
            set(WORD.findall(part)) for name, value in attrs if value and name in ("class", "id", "role")
            for part in value.lower().split() if not LOOKS.fullmatch(part)
        ]
        marked = tag == "form" or any(words and (words <= AROUND if tag in TEXT else words & AROUND) for words in names)
        if tag in VOID:
            if tag not in INLINE:
                self.end_line()
            return
        if tag in INLINE and not marked:
            return
        self.end_line()
        if tag in ENDS:
            for depth in range(len(self.open) - 1, -1, -1):
                if self.open[depth][0] in ENDS[tag]:
                    del self.open[depth:]
                    break
                if self.open[depth][0] in SCOPE:
                    break
        parent, out = self._place()
        inside = any(name in CONTENT for name, _, _ in self.open)
        out = out or tag in UNSEEN or (tag == "header" and not inside)
        self.parents.append(parent)
        self.kinds.append(tag)
        self.marked.append(marked)
        self.readers.append(marked and any(words & READERS for words in names))
        self.classes.append(dict(attrs).get("class"))
        self.open.append((tag, len(self.parents) - 1, out))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)  # the slash means nothing

    def handle_endtag(self, tag):
        self.tags += 1
        if tag == "a":
            self.linking = False
        for depth in range(len(self.open) - 1, -1, -1):
            if self.open[depth][0] == tag:
                self.end_line()
                del self.open[depth:]
                return
        if tag not in INLINE:
            self.end_line()

    def handle_data(self, data):
        if not self._place()[1]:
            self.text.append(data)
            self.linked += len(data.strip()) * self.linking


def smoothed(ratios: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """The ratios under a Gaussian window that is cut off after three sigma and renormalised at the ends."""
    reach = max(1, int(np.ceil(3 * sigma)))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    weight = np.convolve(np.ones(len(ratios)), kernel)[reach : reach + len(ratios)]
    return np.convolve(ratios, kernel)[reach : reach + len(ratios)] / weight


def high(values: np.ndarray) -> np.ndarray:
    """Which values belong to the upper of two clusters, by the threshold midway between the clusters' means."""
    cut = values.mean()
    for _ in range(100):
        upper = values >= cut
        if upper.all() or not upper.any():
            break
        moved = (values[upper].mean() + values[~upper].mean()) / 2
        if moved == cut:
            break
        cut = moved
    return values >= cut


def _chosen(lines: list[tuple]) -> np.ndarray:
    """Which lines are in the upper cluster of the smoothed text-to-tag ratios."""
    return high(smoothed(np.array([len(text) / max(1, tags) for text, tags, *_ in lines])))


def _weights(lines: list[tuple], content: np.ndarray, parents: list[int]) -> list[float]:
    """The high text in each container."""
    weight = [0.0] * len(parents)
    for (text, _, container, _), chosen in zip(lines, content):
        if chosen:
            while container >= 0:
                weight[container] += len(text)
                container = parents[container]
    return weight


def _seen(page: _Lines) -> list[tuple]:
    """The lines outside of marked containers; those that hold most of the high text count as unmarked.

    High text in an article counts double, unless a mark concerns the article
    itself. Containers of readers' words are unmarked only if they hold nearly
    all of it, and no article stands outside of them.
    """
    lines, parents = page.lines, page.parents
    if not any(page.marked):
        return lines
    content = _chosen(lines)
    hinted = [False] * len(parents)  # in an unmarked article
    said = list(page.readers)  # in a container of readers' words
    for container, parent in enumerate(parents):  # parents come first
        article = page.kinds[container] in CONTENT or (parent >= 0 and hinted[parent])
        hinted[container] = article and not page.marked[container]
        said[container] = said[container] or (parent >= 0 and said[parent])
    article = any(hinted[line[2]] and not said[line[2]] for line in lines)
    weight = _weights(lines, content, parents)
    double = _weights([line for line in lines if hinted[line[2]]], content[[hinted[line[2]] for line in lines]], parents)
    weight = [plain + (HINT - 1) * more for plain, more in zip(weight, double)]
    left_out = [False] * len(parents)
    for container, parent in enumerate(parents):
        most = 0.5 if not page.readers[container] else 1.0 if article else SHARE
        marked = page.marked[container] and weight[container] <= most * weight[0]
        left_out[container] = marked or (parent >= 0 and left_out[parent])
    return [line for line in lines if not left_out[line[2]]]


def _widened(lines: list[tuple], content: np.ndarray, parents: list[int], kinds: list[str], top: int, limit: int) -> range:
    """The lines of a container and of the content beside it, up to `limit` while all that stands beside it is content."""
    def child(container: int, ancestor: int) -> int | None:
        """The ancestor's child that holds the container, or the ancestor itself."""
        before = container
        while container >= 0 and container != ancestor:
            before, container = container, parents[container]
        return before if container == ancestor else None

    held = [i for i, line in enumerate(lines) if child(line[2], top) is not None]
    first, last = held[0], held[-1]
    while top != limit:
        top = parents[top]
        groups: dict[tuple, list[int]] = {}
        for i, line in enumerate(lines):
            unit = child(line[2], top)
            if unit is not None and not first <= i <= last:
                groups.setdefault((unit, i if unit == top else -1), []).append(i)
        good = {}
        for group in groups.values():
            fits = all(content[i] or (kinds[lines[i][2]] in BLOCKS and not lines[i][3]) for i in group)
            firm = fits and any(content[i] or kinds[lines[i][2]] in HEADINGS for i in group)
            good.update({i: (fits, firm) for i in group})
        before, after = [i for i in good if i < first], [i for i in good if i > last]
        # what stands between the region and a heading or high text belongs to it
        first = min([i for i in before if good[i][1]], default=first)
        last = max([i for i in after if good[i][1]], default=last)
        while good.get(first - 1, (False,))[0]:
            first -= 1
        while good.get(last + 1, (False,))[0]:
            last += 1
        if any(not first <= i <= last for i in good):
            break
    return range(first, last + 1)


def _region(lines: list[tuple], parents: list[int], kinds: list[str], classes: list[str | None]) -> list[str]:
    """The texts of the content region.

    At the page, and in each article or main element, the heaviest article
    inside is set against the high text outside of all articles; what loses is
    left out. Articles of one class side by side are one.
    """
    within = [-1] * len(parents)  # the next article or main around each container
    for container, parent in enumerate(parents):  # parents come first
        if parent >= 0:
            within[container] = parent if kinds[parent] in CONTENT else within[parent]
    content = _chosen(lines)
    limit = -1
    while True:
        inner = {c for c, kind in enumerate(kinds) if kind in CONTENT and within[c] == limit}
        outside = np.array([line[2] not in inner and (line[2] == limit or within[line[2]] == limit) for line in lines])
        # the low lines of an article are its own as well, but for links
        own = sum(len(line[0]) for line, out, chosen in zip(lines, outside, content) if out and (chosen or (limit >= 0 and not line[3])))
        weight = _weights(lines, content, parents)
        alike: dict[tuple, set[int]] = {}
        for c in inner:
            alike.setdefault((parents[c], classes[c]), set()).add(c)
        best = max(alike.values(), key=lambda group: sum(weight[c] for c in group), default=set())
        held = sum(weight[c] for c in best)
        # articles inside of an article are as a rule about it, or comments
        if held == 0 or (1 if limit >= 0 and kinds[limit] == "article" else HINT) * held < own:
            break
        rest = [not _under(line[2], inner - best, parents) for line in lines]
        lines, content = [line for line, keep in zip(lines, rest) if keep], content[rest]
        if limit >= 0 and kinds[limit] == "main" and len(best) == 1:  # a headline may stand beside the article
            return [lines[i][0] for i in _widened(lines, content, parents, kinds, *best, limit)]
        keep = [_under(line[2], best, parents) for line in lines]
        lines, content = [line for line, k in zip(lines, keep) if k], content[keep]
        if len(best) > 1:
            return [line[0] for line in lines]
        limit, = best
    if limit >= 0:
        return [line[0] for line in lines if not _under(line[2], inner, parents)]
    lines, content = [line for line, out in zip(lines, outside) if out], content[outside]
    # the page marks no article: go down while one child holds nearly all of the high text
    weight = _weights(lines, content, parents)
    children: list[list[int]] = [[] for _ in parents]
    for child, parent in enumerate(parents):
        if parent >= 0:
            children[parent].append(child)
    top = 0
    while children[top]:
        best = max(children[top], key=weight.__getitem__)
        # stop above the blocks themselves: one long paragraph is not the article
        if weight[best] < SHARE * weight[top] or not children[best]:
            break
        top = best
    return [lines[i][0] for i in _widened(lines, content, parents, kinds, top, 0)]


def _under(container: int, tops: set[int], parents: list[int]) -> bool:
    """Whether the container is one of some others, or inside of one."""
    while container >= 0 and container not in tops:
        container = parents[container]
    return container >= 0


def main_text(html: str | None) -> str:
    """The article's lines joined by newlines; empty for pages without text."""
    if not html:
        return ""
    page = _Lines()
    page.feed(html)
    rest = page.rawdata
    if rest.startswith("<") and ">" not in rest:  # markup that the page's end cuts off
        page.rawdata = ""
    page.close()
    page.end_line()
    if not page.lines:
        return ""
    seen = _seen(page)
    return "\n".join(_region(seen, page.parents, page.kinds, page.classes)) if seen else ""


def extract(pages: DataFrame, html: str = "html", text: str = "text") -> DataFrame:
    """Add the main text of each page's whole html as `text`.

    Null, empty and text-free pages get an empty string. Character references
    are decoded, white space inside a line becomes one space, lines are joined
    by newlines in page order. Other columns pass through; repeated rows get
    the same text; an empty table stays empty.
    """
    return adding(pages, html, [T.StructField(text, T.StringType())], lambda values: [pa.array(map(main_text, values), pa.string())])
