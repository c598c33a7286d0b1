"""The main text of web pages from parser events and text-to-tag ratios.

The standard library's streaming parser turns a page into lines, one for each
block of text, with the tags met in it and the element that holds it. It is fed
a page in which every tag is whole (``sound``), so broken markup can neither stop
it nor make it slow. Elements whose tag says what they are (menus, headers,
footers and so on) are left out as they stream by. A class name, id or role, or a
form, is evidence only: how strong depends on how much of the name is known, and
a part that holds most of the page's text is not left out for its name. Over
the remaining lines the ratio of text to tags is smoothed with a Gaussian and the
smoothed ratios are split into two clusters. The content is the nearest region
(lines of one holding element, with those of the elements in it) around all
lines of the upper cluster, widened to a main or article around it and to
holders around it that add no menu. It is kept whole, so short lines, headings
and cells in elements of their own stay; only parts of it that hold no line of
the upper cluster and mostly links (menus without a telling name) go, as do runs
of links and a copyright line at either end, divisions after a single article, and
what stands under a heading that says that readers write there (it must count them
or ask for more, or be followed by elements of their own).

Defined results: null or empty html gives the empty text; a page without content
lines too; unclosed elements end with the element around them, an unclosed
comment with its first ``>``, an unclosed script or style with the page; any
``<!`` that is no comment counts as one; a tag that never ends is text; repeated
rows are handled one by one; any length is read whole, in time that grows with it.
"""

from __future__ import annotations

import heapq
import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastemill.llm.common import map_batches, slices

# Elements by their part in a page (HTML element names).
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
LEFT_OUT = frozenset(
    "aside audio button canvas datalist dialog footer head header iframe menu nav noscript object "
    "script select style svg template textarea title video".split()
)
HOLDERS = frozenset("article body div main section td".split())
BLOCKS = HOLDERS | LEFT_OUT | frozenset(
    "address blockquote caption center dd details dl dt fieldset figcaption figure form h1 h2 h3 h4 h5 h6 hr html li "
    "ol p pre summary table tbody tfoot th thead tr ul".split()
)
TRACKED = HOLDERS | LEFT_OUT | {"a", "form", "ul", "ol", "table", "p", "span"}
INLINE = frozenset({"a", "p", "span"})
# Elements whose content is not markup.
RAW = frozenset("iframe script style textarea title".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CONTROLS = frozenset("button input select textarea".split())
# Words in class names, ids and roles of parts that are not the article.
NOT_ARTICLE = frozenset(
    "ad ads adsense advert adverts advertisement advertising alert banner breadcrumb breadcrumbs comment "
    "comments complementary consent contentinfo cookie cookies disqus footer form gdpr header login masthead "
    "menu modal nav navbar navigation newsletter notice notices notification overlay pager pagination popup "
    "promo promoted promotion recommended related replies reply responses search share sharing sidebar signup social sponsor "
    "sponsored subscribe subscription toolbar widget".split()
)
# Beginnings of such words (commentlist, sidebarleft, advertbox and the like).
NOT_ARTICLE_STARTS = ("advert", "breadcrumb", "comment", "cookie", "newsletter", "sidebar", "sponsor", "subscri")
# What comes after these in a name tells the layout of a wrapper (has-sidebar, no-comments).
LAYOUT = frozenset("has have layout no non with without".split())
# Words beside these in the name of a part that say nothing of what it holds.
NEUTRAL = frozenset(
    "area bar block body bottom box buttons center col column container content count entry global group holder "
    "icons inner item items left link links list main outer page panel post posts primary right row secondary "
    "section site slot text thread top tree unit wrap wrapper".split()
)
# Names under which readers write.
READERS = ("comment", "disqus", "replies", "reply", "responses")
_WORDS = re.compile("[a-z]+")
#: Evidence of a name against an element: none, a part of a longer name, a name of known words, the whole name.
NONE, PART, KNOWN, WHOLE = range(4)


def _listed(word: str) -> bool:
    return word in NOT_ARTICLE or word.startswith(NOT_ARTICLE_STARTS)


def _evidence(attrs: list[tuple[str, str | None]]) -> tuple[int, bool]:
    """How strongly names speak against an element, and whether they tell of readers' comments."""
    most, readers = NONE, False
    for attribute, value in attrs:
        if attribute not in ("class", "id", "role") or not value:
            continue
        names = [_WORDS.findall(name) for name in value.lower().split()]
        every = {w for words in names for w in words}
        if every & {"article", "entry", "post"} and not any(_listed(w) and w != "header" for w in every):
            continue
        for words in names:
            words = words[: next((i for i, w in enumerate(words) if w in LAYOUT), len(words))]
            known = [w for w in words if _listed(w)]
            if not known:
                continue
            if len(words) == 1:
                found = WHOLE
            elif all(w in NEUTRAL or _listed(w) for w in words):
                found = KNOWN
            else:
                found = PART if _listed(words[-1]) and words[-1] != "widget" else NONE
            if found:
                most, readers = max(most, found), readers or any(w.startswith(READERS) for w in known)
    return most, readers


def _hidden(attrs: list[tuple[str, str | None]]) -> bool:
    return any(name == "hidden" or name == "aria-hidden" and value == "true" for name, value in attrs)


_PLAIN_TAG = (
    r"""<(?:/[a-zA-Z][\w:-]*+\s*+|(?!(?:iframe|script|style|textarea|title)(?![\w:-]))[a-zA-Z][\w:-]*+"""
    r"""(?:\s++[a-zA-Z_:@][\w:.@-]*+(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s"'=<>`/][^\s"'<>=`/]*+))?+)*+\s*+/?+)>"""
)
_PLAIN = re.compile(rf"(?:[^<]++|{_PLAIN_TAG})*+", re.I)
# A tag up to its end; a ``>`` in a quoted value does not end it, if the quote is closed.
_ANY_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+)>""")
_OPENS = re.compile("</?[a-zA-Z]")
_SHORT_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>")
_ATTRIBUTE = re.compile(r"""([^\s/>="'<]++)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>"']++)))?+""")
_CLOSERS = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*+>", re.I) for name in RAW}


def sound(html: str) -> str:
    """``html`` with only whole tags in a plain form, and without comments and raw content.

    One walk from front to back. What is searched for and not found is not
    searched for again, so the time grows with the page whatever it holds.
    """
    out: list[str] = []
    at, end, last = 0, len(html), html.rfind(">")
    comments, tags, raw = True, _ANY_TAG, dict(_CLOSERS)
    while at < end:
        run = _PLAIN.match(html, at, last + 1) if at <= last else None
        if run and run.end() > at:
            out.append(html[at : run.end()])
            at = run.end()
        if at > last:
            out.append(html[at:].replace("<", "&lt;"))  # no tag ends here any more
            break
        if html[at] != "<":
            stop = html.find("<", at)
            stop = end if stop < 0 else stop
            out.append(html[at:stop])
            at = stop
            continue
        if html.startswith("<!--", at) and comments:
            stop = html.find("-->", at + 2)
            if stop >= 0:
                at = stop + 3
                continue
            comments = False
        if not _OPENS.match(html, at):
            if html[at + 1] in "!?/":
                at = html.index(">", at) + 1
            else:
                out.append("&lt;")
                at += 1
            continue
        found = tags.match(html, at)
        if not found:
            tags = _SHORT_TAG  # a quote is not closed from here to the end
            continue
        out.append(_plain_form(*found.groups()))
        at = found.end()
        name = found.group(2).lower()
        if name in raw and not found.group(1):
            closer = raw[name].search(html, at)
            out.append(f"</{name}>")
            if closer:
                at = closer.end()
            elif name in ("script", "style"):
                break
            else:
                del raw[name]
    return "".join(out)


def _plain_form(slash: str, name: str, rest: str) -> str:
    name = "".join(c for c in name if c.isalnum() or c in "-_:")
    if slash:
        return f"</{name}>"
    kept = []
    for key, double, single, bare in _ATTRIBUTE.findall(rest):
        if key.lower() in ("class", "id", "role", "hidden", "aria-hidden", "type"):
            kept.append(f' {key}="{(double or single or bare).replace(chr(34), "&quot;")}"')
    return f"<{name}{''.join(kept)}>"


class _Lines(HTMLParser):
    """Collects (region, is an h1, text, letters outside links, tags, level if a heading) for each block of text."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[int, bool, str, int, int, int]] = []
        # element, left out, region, in an article, tags before a doubtful element
        self.open: list[tuple[str, bool, int, bool, int | None]] = []
        self.places: dict[str, list[int]] = {}  # where in ``open`` each element stands
        self.blocks: list[int] = []  # and all that are neither links, spans nor paragraphs
        self.shut = 0  # open elements that are left out by their tag
        self.around = [0]  # the region around each region
        self.kinds = ["body"]  # the element of each region
        self.doubt: dict[int, tuple[int, bool]] = {}  # regions with evidence against them
        self.controls: Counter[int] = Counter()
        self.parts: list[str] = []
        self.plain = self.tags = self.links = 0
        self.level = 0  # of the heading that is open

    def _state(self) -> tuple[bool, int, bool]:
        return self.open[-1][1:4] if self.open else (False, 0, False)

    def end_line(self) -> None:
        out, region, _ = self._state()
        text = " ".join("".join(self.parts).split())
        if text:
            self.lines.append((region, self.level == 1, text, self.plain, self.tags, self.level))
            self.tags = 0
        self.parts.clear()
        self.plain = 0

    def _new_region(self, tag: str, around: int) -> int:
        self.around.append(around)
        self.kinds.append(tag)
        return len(self.kinds) - 1

    def _push(self, tag: str, out: bool, region: int, article: bool, tags: int | None) -> None:
        self.links += tag == "a"
        self.shut += tag in LEFT_OUT
        self.places.setdefault(tag, []).append(len(self.open))
        if tag not in INLINE:
            self.blocks.append(len(self.open))
        self.open.append((tag, out, region, article, tags))

    def _close_from(self, place: int) -> None:
        """Close the open elements from ``place`` on; each is taken off once."""
        while len(self.open) > place:
            tag, out, _, _, tags = self.open[-1]
            if tags is not None and not out:
                self.end_line()
                self.tags = tags
            self.open.pop()
            self.places[tag].pop()
            self.links -= tag == "a"
            self.shut -= tag in LEFT_OUT
            if tag not in INLINE:
                self.blocks.pop()

    def _last(self, tag: str) -> int:
        places = self.places.get(tag)
        return places[-1] if places else -1

    def _end_paragraph(self) -> None:
        """A block inside a paragraph ends the paragraph."""
        place = self._last("p")
        if place >= 0 and (not self.blocks or place > self.blocks[-1]):
            self._close_from(place)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in BLOCKS:
            if not self._state()[0]:
                self.end_line()
            self._end_paragraph()
            self.level = int(tag[1]) if tag in HEADINGS else 0
        out, region, article = self._state()
        if tag == "br" and not out:
            self.parts.append(" ")
        self.tags += not out
        if tag in CONTROLS and ("type", "hidden") not in attrs:
            self.controls[region] += 1
        if tag in VOID or tag not in TRACKED:
            return
        evidence, readers = _evidence(attrs) if attrs and tag != "body" else (NONE, False)
        hidden = bool(attrs) and tag != "body" and _hidden(attrs)
        before = None
        if tag in ("article", "main") and not evidence and not hidden:
            # The nearest element decides, so an article inside a named part counts again.
            article = True
            out, region = self.shut > 0, self._new_region(tag, region)
        elif tag in LEFT_OUT or hidden or evidence and tag not in BLOCKS:
            out = True
        elif not out and (evidence or tag == "form"):
            region = self._new_region(tag, region)
            self.doubt[region] = evidence, readers
            before = self.tags
        elif tag in HOLDERS and not article:
            region = self._new_region(tag, region)
        self._push(tag, out, region, article, before)

    def handle_endtag(self, tag: str) -> None:
        if not self._state()[0]:
            self.tags += 1
            if tag in BLOCKS:
                self.end_line()
                self.level = 0
        place = self._last(tag)
        if tag not in TRACKED or place < 0:
            return
        if tag in INLINE and self.blocks and self.blocks[-1] > place:
            return  # an inline end does not close a block around it
        self._close_from(place)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_data(self, data: str) -> None:
        if not self._state()[0]:
            self.parts.append(data)
            if not self.links:
                self.plain += len(data.strip())

    def left_out(self) -> list[bool]:
        """Which regions go for their names or for being forms.

        The doubtful part with the most text is judged first, against the text
        that is in no doubt; if it stays, its text is in no doubt for the others.
        """
        count = len(self.kinds)
        owner = [-1] * count  # the doubtful region around each region, unless an article is nearer
        for i in range(1, count):
            if i in self.doubt:
                owner[i] = i
            elif self.kinds[i] not in ("article", "main"):
                owner[i] = owner[self.around[i]]
        own = Counter()
        for line in self.lines:
            own[owner[line[0]]] += line[3]
        whole, controls, inside = Counter(own), Counter(self.controls), {}
        for i in range(count - 1, 0, -1):
            controls[self.around[i]] += controls[i]
            if i in self.doubt:
                inside.setdefault(owner[self.around[i]], []).append(i)
                whole[owner[self.around[i]]] += whole[i] if owner[self.around[i]] >= 0 else 0
        sure, kept = own[-1], {-1}
        waiting = [(-whole[i], i) for i in inside.get(-1, [])]
        heapq.heapify(waiting)
        while waiting:
            size, i = -waiting[0][0], heapq.heappop(waiting)[1]
            evidence, readers = self.doubt[i]
            alone = not sure and size >= 200
            if evidence == WHOLE or readers:
                stays = alone
            elif evidence == KNOWN:
                stays = size > sure
            else:
                prose = size >= 200 * (1 + controls[i]) if self.kinds[i] == "form" else size >= 80 and self._in_article(i)
                stays = size > sure or prose
            if stays:
                kept.add(i)
                sure += own[i]
                for j in inside.get(i, []):
                    heapq.heappush(waiting, (-whole[j], j))
        return [owner[i] not in kept for i in range(count)]

    def _in_article(self, region: int) -> bool:
        return self.kinds[self.around[region]] in ("article", "main")


def smoothed(ratios: np.ndarray, sigma: float = 1.0) -> np.ndarray:
    """Gaussian smoothing over neighbouring lines; the kernel is cut at two deviations."""
    reach = int(2 * sigma)
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    weight = np.convolve(np.ones(len(ratios)), kernel, mode="full")[reach : reach + len(ratios)]
    return np.convolve(ratios, kernel, mode="full")[reach : reach + len(ratios)] / weight


def threshold(values: np.ndarray) -> float:
    """The border of two clusters on a line, or the deviation if that is lower."""
    low, high = float(values.min()), float(values.max())
    for _ in range(20):
        middle = (low + high) / 2
        upper = values >= middle
        if upper.all():
            break
        new = float(values[~upper].mean()), float(values[upper].mean())
        if new == (low, high):
            break
        low, high = new
    return min((low + high) / 2, float(values.std()) or high)


def main_text(html: str | None) -> str:
    """Blocks of the article, joined by two line ends."""
    if not html:
        return ""
    parser = _Lines()
    parser.feed(sound(html))
    parser.close()
    if not parser._state()[0]:
        parser.end_line()
    parser._close_from(0)
    if parser.doubt:
        gone = parser.left_out()
        parser.lines = [line for line in parser.lines if not gone[line[0]]]
    parser.lines = _without_readers(parser)
    lines = parser.lines
    if not lines:
        return ""
    ratios = np.array([plain / max(1, tags) for _, _, _, plain, tags, _ in lines], dtype=np.float64)
    values = smoothed(ratios)
    border = threshold(values)
    near = (values >= border) & (ratios > 0)
    # A line that only its neighbours lift over the border makes no region of its own content.
    content = near & (ratios >= border / 2)
    if not content.any():
        content = near
    kept = _trimmed(parser, content, _whole(parser, content))
    return "\n\n".join(line[2] for line, k in zip(lines, kept) if k)


# Headings over what readers write; those that count or ask for it leave no doubt.
_READERS_SAY = re.compile(
    r"(?:\d[\d,.]* (?:(?:reader|user) )?(?:comments?|responses?|replies|reply|thoughts?)(?: (?:on|to|so far)\b.*)?"
    r"|one (?:comment|reply|response|thought on\b.*)|no (?:comments|replies|responses)(?: yet)?"
    r"|(?:reader |user )?(?:comments?|responses?|replies) ?\(\d[\d,.]*\)"
    r"|leave (?:a|your) (?:comment|reply)\b.*|(?:add|post|write) (?:a|your) (?:comment|reply)"
    r"|join the (?:conversation|discussion)|(?:readers?'?s?|user) comments)\W*",
    re.I,
)
_READERS_MAY = re.compile(r"(?:comments?|responses?|replies|discussion)\W*", re.I)
#: Letters that must stand before such a heading; a page of comments alone keeps them.
_ARTICLE_LEAST = 80


def _without_readers(page: _Lines) -> list[tuple[int, bool, str, int, int, int]]:
    """The lines of a page without the parts under headings over readers' comments.

    Such a part reaches to the end of the element that holds the heading and the
    line after it, or to the next heading there that is not a lower one; outside
    of articles also to the next article. Lines of an element stand together, and
    regions are numbered in the order of their starts, so one pass does.
    """
    lines, around, kinds = page.lines, page.around, page.kinds
    marks = [bool(line[5]) and bool(_READERS_SAY.fullmatch(line[2]) or _READERS_MAY.fullmatch(line[2])) for line in lines]
    if not any(marks):
        return lines
    last = list(range(len(kinds)))  # the last region inside each region
    for i in range(len(kinds) - 1, 0, -1):
        last[around[i]] = max(last[around[i]], last[i])
    kept, plain, at = [], 0, 0
    while at < len(lines):
        region, level = lines[at][0], lines[at][5]
        if not marks[at] or at + 1 == len(lines) or plain < _ARTICLE_LEAST:
            kept.append(lines[at])
            plain += lines[at][3]
            at += 1
            continue
        following = lines[at + 1][0]
        while not region <= following <= last[region]:
            region = around[region]
        if following == lines[at][0] and not _READERS_SAY.fullmatch(lines[at][2]):
            kept.append(lines[at])
            at += 1
            continue
        wide = kinds[region] in ("body", "main")
        at += 1
        while at < len(lines) and region <= lines[at][0] <= last[region]:
            own, other = lines[at][0], lines[at][5]
            if own == region and 0 < other <= level and not marks[at] or wide and kinds[own] == "article":
                break
            at += 1
    return kept


# How a line about rights begins.
_RIGHTS = re.compile(r"(?:©|\(c\)|copyright\b|all rights reserved)", re.I)


def _trimmed(page: _Lines, content: np.ndarray, kept: list[bool]) -> list[bool]:
    """``kept`` without runs of links and a line about rights at its ends.

    Only lines outside of articles count as such, and only before the first or
    after the last line of content.
    """
    places = [i for i, k in enumerate(kept) if k]
    firm = [i for i in places if content[i]]
    if not firm:
        return kept
    for ends in ([i for i in places if i < firm[0]][::-1], [i for i in places if i > firm[-1]]):
        run: list[int] = []
        for i in ends:
            region, title, text, plain, *_ = page.lines[i]
            if page.kinds[region] == "article" or title:
                break
            if _RIGHTS.match(text):
                kept[i] = False
            elif 5 * plain < len(text):
                run.append(i)
        if len(run) >= 2:
            for i in run:
                kept[i] = False
    return kept


def _after_article(page: _Lines, top: int, plain: list[int]) -> set[int]:
    """Divisions that follow the one article of a region: what readers wrote, or links to other articles.

    The article must have a title or most of the region's text.
    """
    inside = [i for i in range(1, len(page.kinds)) if page.around[i] == top]
    articles = [i for i in inside if page.kinds[i] == "article" and plain[i]]
    if len(articles) != 1:
        return set()
    titled = any(line[1] and line[0] == articles[0] for line in page.lines)
    if not titled and 2 * plain[articles[0]] < plain[top]:
        return set()
    return {i for i in inside if i > articles[0] and page.kinds[i] in ("section", "div")}


def _whole(page: _Lines, content: np.ndarray) -> list[bool]:
    """Which lines belong to the whole content around the ``content`` lines."""
    lines, around, kinds = page.lines, page.around, page.kinds
    count = len(kinds)
    # Of every region with all that is in it; a region comes after the one around it.
    good, plain, text = [0] * count, [0] * count, [0] * count
    for line, is_content in zip(lines, content):
        good[line[0]] += bool(is_content)
        plain[line[0]] += line[3]
        text[line[0]] += len(line[2])
    for i in range(count - 1, 0, -1):
        good[around[i]] += good[i]
        plain[around[i]] += plain[i]
        text[around[i]] += text[i]
    menu = [
        not good[i] and text[i] > 0 and 2 * plain[i] < text[i] and kinds[i] not in ("article", "main")
        for i in range(count)
    ]
    if not good[0]:
        return [False] * len(lines)
    # The nearest region around all content lines: the last one that holds them all.
    top = max(i for i in range(count) if good[i] == good[0])
    i = top
    while i:
        i = around[i]
        if kinds[i] in ("article", "main"):
            top = i
    with_menu = {around[i] for i in range(1, count) if menu[i]}
    while kinds[top] not in ("body", "main") and kinds[around[top]] != "body" and around[top] not in with_menu:
        top = around[top]
    after = _after_article(page, top, plain)
    inside, kept = [False] * count, [False] * count
    for i in range(count):
        inside[i] = i == top or i > 0 and inside[around[i]]
        kept[i] = i == top or inside[i] and kept[around[i]] and not menu[i] and i not in after
    found = [kept[line[0]] for line in lines]
    # A page's title may stand in an element of its own before the content.
    if not any(line[1] for line, k in zip(lines, found) if k):
        before = [n for n in range(found.index(True)) if lines[n][1] and 2 * lines[n][3] >= len(lines[n][2])]
        if before:
            found[before[-1]] = True
    return found


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches):
        texts = [main_text(h) for h in part.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [part.column(0), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            names=["keys", "text", "n_chars"],
        )


def extract(pages: DataFrame, carry: tuple[str, ...] = ("page_id", "url"), html: str = "html") -> DataFrame:
    """(carry, text, n_chars) of every page."""
    keys = F.struct(*[pages[c].alias(c) for c in carry])
    rows = pages.select(keys.alias("keys"), pages[html].cast("string").alias("html"))
    kind = rows.schema["keys"].dataType.simpleString()
    out = map_batches(rows, _extract, f"keys {kind}, text string, n_chars bigint")
    return out.select(*[F.col("keys").getField(c).alias(c) for c in carry], "text", "n_chars")
