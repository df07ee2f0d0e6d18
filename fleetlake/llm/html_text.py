"""Main text of web pages, by paths that the pages of a host agree on.

Every page's containers are scored by the text that stands right in them, links apart, and the best
one gives its path of tags and classes, numbers generalised. Spark counts these votes per host, and the
text of each page is taken from the containers at its host's winning path.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlake.llm.common import checked_broadcast, prepared, stored
from fleetlake.llm.url_filter import url_host

#: Bytes of a host and its winning path when they are broadcast.
WINNER_BYTES = 512
#: Share of a block's text that the next outer container gets, and so on down to the least share.
OUTER, LEAST_SHARE = 0.5, 0.01
#: Share of the page's text, links apart, above which a form, or an element that is only named after a place, is kept.
MOST = 0.5
#: Share of the page's text from which on its article is its text, whatever stands beside it.
ARTICLE = 0.1
#: Share of a container's text, links apart, that none of its children may leave out.
LEFT_OUT = 0.1

# Element and class names as HTML and its authors use them. Fixed values.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title noscript template textarea iframe".split())
# Elements of other markup, in which any element may close itself.
FOREIGN = ("svg", "math")
DROPPED = frozenset("nav header footer aside button select dialog menu".split())
# Without text, and no boundary of blocks.
UNSEEN = frozenset("svg object annotation annotation-xml".split())
CONTAINERS = frozenset("body main article section div td".split())
BLOCKS = CONTAINERS | frozenset(
    "html p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr th caption blockquote pre address "
    "figure hr details summary fieldset hgroup center".split()
)
# Names of what is never the page's text, however long it is, and of places, which wrappers of the text are named
# after as well ("has-sidebar").
NEVER_TEXT = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion cookie cookies consent gdpr notice "
    "popup modal newsletter subscribe subscription signup comment comments commentlist disqus discussion discussions "
    "reply replies responses share sharing related recommended".split()
)
PLACES = frozenset(
    "banner social sidebar menu nav navbar navigation breadcrumb breadcrumbs footer header masthead widget widgets toolbar "
    "pagination pager login search skip".split()
)
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert menu menubar".split())
PARAGRAPHS = ("p", "h1", "h2", "h3", "h4", "h5", "h6")
SCOPES = DROPPED | UNSEEN | frozenset(("table", "ul", "ol", "dl", "form", "math"))
#: Elements that end an open paragraph, although they aren't blocks themselves.
ENDS_PARAGRAPH = frozenset("nav header footer aside form dialog menu".split())
#: A start tag on the left ends open elements of the tags on the right, one of each group. Fixed values.
ENDS = {
    "li": (("li",),),
    "dt": (("dt", "dd"),),
    "dd": (("dt", "dd"),),
    "tr": (("td", "th"), ("tr",)),
    "td": (("td", "th"),),
    "th": (("td", "th"),),
    "option": (("option",),),
    **dict.fromkeys(("thead", "tbody", "tfoot"), (("td", "th"), ("tr",), ("thead", "tbody", "tfoot"))),
}

# A comment; a start tag with its attributes; an end tag; a declaration; a start tag with a broken attribute; a cut-off tag.
_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|</([a-zA-Z][^\s>]*+)[^>]*+>"""
    r"""|<[!?][^>]*+>|<([a-zA-Z][^\s/>]*+)[^>]*+>|</?[a-zA-Z!?][^>]*+\Z""",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_DIGITS = re.compile(r"\d+")
_HIDDEN = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*hidden)", re.IGNORECASE)
_NAME_PARTS = re.compile(r"[^a-z]+")


@dataclass
class Container:
    """An element that holds blocks: the step of its path, where its blocks start and end, and its score.

    Containers of a page with the same path have the same ``place``. ``own`` has the characters that stand right
    in it, links apart twice, ``total`` those in all of it, ``titles`` those of its level-one headings.
    """

    step: str
    tag: str
    outer: Container | None
    depth: int
    start: int
    end: int = 0
    place: int = 0
    score: float = 0.0
    own: int = 0
    total: int = 0
    titles: int = 0
    own_article: bool = False  # an article or main part that isn't named like noise

    def path(self) -> str:
        steps, at = [], self
        while at.outer is not None:
            steps.append(at.step)
            at = at.outer
        return ">".join(reversed(steps))

    def is_at(self, steps: list[str]) -> bool:
        at = self
        if self.depth != len(steps):
            return False
        for step in reversed(steps):
            if at.step != step:
                return False
            at = at.outer
        return True


@dataclass
class Noise:
    """An element that is dropped, or unless it holds the text: its blocks and containers, from and to.

    ``never`` tells of a name that no text has, ``heads`` of a header within an article, whose title stays. ``first`` has the block and container at which the first article or main part in it starts; ``holds``
    tells of one that is the page's own, neither named like noise nor a part of an article around the element.
    """

    surely: bool
    never: bool
    heads: bool
    in_article: bool
    in_main: bool
    start: tuple[int, int]
    end: tuple[int, int] = (0, 0)
    first: tuple[int, int] | None = None
    holds: bool = False


def _attributes(source: str) -> dict[str, str]:
    return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(source)}


def _noise(tag: str, attributes: dict[str, str]) -> bool:
    """Whether the element is never text, by its tag, role or being hidden."""
    if tag in ("html", "head", "body"):
        return False
    if tag in DROPPED or "hidden" in attributes or attributes.get("aria-hidden") == "true":
        return True
    if _HIDDEN.search(attributes.get("style", "")):
        return True
    return attributes.get("role", "").lower() in NOISE_ROLES


def _names(attributes: dict[str, str]) -> set[str]:
    """The parts of the element's class and id names."""
    return set(_NAME_PARTS.split(f"{attributes.get('class', '')} {attributes.get('id', '')}".lower()))


def _like_noise(tag: str, attributes: dict[str, str], names: set[str]) -> bool:
    """Whether the element is a form or has a class or id like noise; wrappers of the text may be, too."""
    if tag in ("html", "head", "body"):
        return False
    form = tag == "form" or attributes.get("role", "").lower() == "form"
    return form or not NEVER_TEXT.isdisjoint(names) or not PLACES.isdisjoint(names)


def _step(tag: str, attributes: dict[str, str]) -> str:
    """One step of a path: tag and classes in order, every number as #."""
    classes = sorted(set(attributes.get("class", "").split()))
    return ".".join([tag, *(_DIGITS.sub("#", c) for c in classes)])


def containers(page: str) -> tuple[list[Container], list[str]]:
    """The containers of a page in the order in which they start, the page itself first, and its blocks.

    Unclosed elements end where the next block or the container around them does; an end tag
    without a start counts for nothing. What is in dropped elements is in no block. An element without
    its own end tag is dropped up to the first article or main part in it.
    """
    root = Container("", "", None, 0, 0)
    found, blocks = [root], []
    inside: list[Container] = []  # of each block
    sizes: list[tuple[int, int, bool]] = []  # characters of each block and of the links in it; in a title
    places: dict[tuple[int, str], int] = {}
    open_tags: list[tuple[str, Container | None, Noise | None]] = []  # with what it is, if it is one
    opened: Counter[str] = Counter()
    noises: list[Noise] = []
    open_noises: list[Noise] = []
    articles: list[tuple[int, int]] = []  # blocks of the page's own article and main parts
    here = root
    text: list[str] = []
    in_links = 0  # characters of this block
    unseen = 0  # open elements without text

    def flush() -> None:
        nonlocal in_links
        block = " ".join("".join(text).split())
        text.clear()
        if block:
            blocks.append(block)
            inside.append(here)
            sizes.append((len(block), in_links, opened["h1"] > 0))
        in_links = 0

    def close(down_to: int, ended: bool = False) -> None:
        """End the open elements from ``down_to`` on; ``ended`` tells that the first has its own end tag."""
        nonlocal here, unseen
        while len(open_tags) > down_to:
            tag, container, noise = open_tags[-1]
            if tag in BLOCKS or noise is not None:
                flush()
            if container is not None:
                container.end = len(blocks)
                here = container.outer
                if container.own_article:
                    articles.append((container.start, container.end))
            open_tags.pop()
            opened[tag] -= 1
            unseen -= tag in UNSEEN
            if noise is not None:
                own_end = ended and len(open_tags) == down_to
                noise.end = (len(blocks), len(found)) if own_end or noise.first is None else noise.first
                open_noises.pop()

    def close_open(tags: tuple[str, ...]) -> None:
        """End the innermost open element of these, unless another container or list is in between."""
        if not any(opened[t] for t in tags):
            return
        for i in range(len(open_tags) - 1, -1, -1):
            if open_tags[i][0] in tags:
                close(i)
                return
            if open_tags[i][1] is not None or open_tags[i][0] in SCOPES:
                return

    def article_starts(tag: str, own: bool) -> None:
        """Tell the open elements that may be dropped; the outer ones know what an inner one knows."""
        for noise in reversed(open_noises):
            counts = own and (tag == "main" or not noise.in_article)
            if noise.first is not None and (noise.holds or not counts):
                return
            noise.first = noise.first or (len(blocks), len(found))
            noise.holds = noise.holds or counts

    def add(part: str) -> None:
        nonlocal in_links
        if unseen:
            return
        decoded = html.unescape(part)
        text.append(decoded)
        if opened["a"]:
            in_links += len(decoded.strip())

    position = 0
    while m := _TOKEN.search(page, position):
        if m.start() > position:
            add(page[position : m.start()])
        position = m.end()
        if name := m[1] or m[4]:
            tag = name.lower()
            attributes = _attributes(m[2]) if m[2] else {}
            foreign = tag in FOREIGN or any(opened[f] for f in FOREIGN)
            if (m[2] or "").endswith("/") and (foreign or tag == "object"):
                pass  # closes itself
            elif tag in RAW:
                position = _behind_raw(page, tag, position)
            elif tag in VOID:
                if tag == "br":
                    text.append(" ")
                elif tag == "hr":
                    flush()
            else:
                names = _names(attributes)
                surely, like = _noise(tag, attributes), _like_noise(tag, attributes, names)
                if tag in BLOCKS or tag in ENDS_PARAGRAPH:
                    if foreign and not opened["foreignobject"] and not opened["annotation-xml"]:
                        close_open(FOREIGN)
                    close_open(PARAGRAPHS)
                for ended in ENDS.get(tag, ()):
                    close_open(ended)
                if tag in BLOCKS or surely or like:
                    flush()
                noise = None
                if surely or (like and tag not in ("article", "main")):
                    never, heads = not NEVER_TEXT.isdisjoint(names), tag == "header" or "header" in names
                    within = opened["article"] > 0, opened["main"] > 0
                    noise = Noise(surely, never, heads and any(within), *within, (len(blocks), len(found)))
                    noises.append(noise)
                    open_noises.append(noise)
                elif tag in ("article", "main"):
                    article_starts(tag, not like)
                container = None
                if tag in CONTAINERS:
                    step = _step(tag, attributes)
                    container = Container(step, tag, here, here.depth + 1, len(blocks))
                    container.place = places.setdefault((here.place, step), len(places) + 1)
                    container.own_article = tag in ("article", "main") and not like
                    found.append(container)
                    here = container
                open_tags.append((tag, container, noise))
                opened[tag] += 1
                unseen += tag in UNSEEN
        elif m[3] and opened[tag := m[3].lower()]:
            close(next(i for i in range(len(open_tags) - 1, -1, -1) if open_tags[i][0] == tag), ended=True)
    add(page[position:])
    close(0)
    flush()
    root.end = len(blocks)
    return _without_noise(found, blocks, inside, sizes, noises, articles)


def _covered(spans: Iterable[tuple[int, int]], length: int) -> list[bool]:
    """For each of ``length`` positions whether a span has it."""
    change = [0] * (length + 1)
    for start, end in spans:
        change[start] += 1
        change[end] -= 1
    return [depth > 0 for depth in accumulate(change[:-1])]


def _without_noise(
    found: list[Container],
    blocks: list[str],
    inside: list[Container],
    sizes: list[tuple[int, int, bool]],
    noises: list[Noise],
    articles: list[tuple[int, int]],
) -> tuple[list[Container], list[str]]:
    """The containers and blocks that stay, scored.

    An element that is only named like noise, or a form, stays if it holds an article or main part of the
    page's own. A form, and an element named after a place, also stays if it has most of the page's text, links
    apart, and no article or main part with text stands beside it. One named after comments, notices, adverts and the like
    is never text for its length, unless there is no other. Of a header in an article its title stays.
    """
    sure = _covered([(n.start[0], n.end[0]) for n in noises if n.surely], len(blocks))
    plain = [0 if s else max(length - links, 0) for s, (length, links, _) in zip(sure, sizes, strict=True)]
    upto = [0, *accumulate(plain)]
    in_article = _covered(articles, len(blocks))
    article_upto = [0, *accumulate(size * a for size, a in zip(plain, in_article, strict=True))]

    def stays(noise: Noise) -> bool:
        if noise.surely or noise.holds:
            return not noise.surely
        start, end = noise.start[0], noise.end[0]
        if noise.never:
            return upto[end] - upto[start] == upto[-1] > 0
        beside = article_upto[-1] - (article_upto[end] - article_upto[start])
        if beside and not (noise.in_article or noise.in_main):
            return False
        return upto[end] - upto[start] > MOST * upto[-1]

    gone = [n for n in noises if not stays(n)]
    block_gone = _covered([(n.start[0], n.end[0]) for n in gone if not n.heads], len(blocks))
    in_head = _covered([(n.start[0], n.end[0]) for n in gone if n.heads], len(blocks))
    block_gone = [g or (h and not title) for g, h, (_, _, title) in zip(block_gone, in_head, sizes, strict=True)]
    container_gone = _covered([(n.start[1], n.end[1]) for n in gone], len(found))
    kept_upto = [0, *accumulate(not g for g in block_gone)]
    for container in found:
        container.start, container.end = kept_upto[container.start], kept_upto[container.end]
    for at, (length, links, title), dropped in zip(inside, sizes, block_gone, strict=True):
        gain, share = 0 if dropped else max(length - 2 * links, 0), 1.0
        at.own += gain
        at.total += gain
        at.titles += gain * title
        while gain and at is not None and share >= LEAST_SHARE:
            at.score += gain * share
            at, share = at.outer, share * OUTER
    for container in reversed(found[1:]):
        container.outer.total += container.total
        container.outer.titles += container.titles
    kept = [b for b, g in zip(blocks, block_gone, strict=True) if not g]
    return [c for c, g in zip(found, container_gone, strict=True) if not g], kept


def _behind_raw(page: str, tag: str, start: int) -> int:
    """Behind the end tag of an element whose content is no markup; the page's end without one."""
    m = re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.IGNORECASE).search(page, start)
    return m.end() if m else len(page)


def best(found: list[Container]) -> Container:
    """The container of the highest score, the first of equals, or one around it that has more of the text.

    Where the page has articles of its own, or else main parts, with more than a small share of its text, only these and
    what is in them count, and the one around the highest score is taken. Otherwise a parent is taken that has text of
    its own or a title besides, or whose other children have more than a small share of its text.
    """
    for tag in ("article", "main"):
        own: dict[int, Container] = {}  # by container, the innermost such part around it
        for c in found[1:]:
            if c.tag == tag and c.own_article:
                own[id(c)] = c
            elif id(c.outer) in own:
                own[id(c)] = own[id(c.outer)]
        inner = [c for c in found if id(c) in own]
        if inner and max(c.total for c in own.values()) >= ARTICLE * found[0].total > 0:
            return own[id(max(inner, key=lambda c: c.score))]
    chosen = at = max(found, key=lambda c: c.score)
    while (parent := at.outer) is not None:
        left_out = parent.total - at.total
        if parent.own or parent.titles > at.titles or left_out > LEFT_OUT * parent.total:
            chosen = parent
        at = parent
    return chosen


def main_text(page: str, path: str | None) -> str:
    """The blocks in all containers at the path, in the page's order; without text there, at the path of the page's own best."""
    found, blocks = containers(page)
    steps = path.split(">") if path else None

    def parts(chosen: Container | None) -> list[str]:
        return [b for c in found if c.place == chosen.place for b in blocks[c.start : c.end]] if chosen else []

    at_path = next((c for c in found if c.is_at(steps)), None) if steps else None
    return "\n\n".join(parts(at_path) or parts(best(found)))


def votes(pages: DataFrame) -> DataFrame:
    """``host, path, score``: each page's best path; pages without any text have no vote."""

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chosen = [best(containers(p or "")[0]) for p in batch["html"].to_pylist()]
            voted = pa.RecordBatch.from_arrays(
                [
                    batch["host"],
                    pa.array([c.path() for c in chosen], pa.string()),
                    pa.array([float(c.score) for c in chosen], pa.float64()),
                ],
                ["host", "path", "score"],
            )
            yield voted.filter(pa.array([c.total > 0 for c in chosen], pa.bool_()))

    prepared(pages.sparkSession)
    hosted = pages.select(url_host(F.col("url")).alias("host"), "html").where(F.col("host") != "")
    return hosted.mapInArrow(vote, "host string, path string, score double")


def winning_paths(pages: DataFrame) -> DataFrame:
    """``host, path``: for every host the path that most of its pages vote for, of equals the one that sorts last."""
    counted = votes(pages).groupBy("host", "path").agg(F.count(F.lit(1)).alias("pages"))
    return counted.groupBy("host").agg(F.max(F.struct("pages", "path"))["path"].alias("path"))


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text``, one row for every row of ``pages``.

    ``text`` has the blocks of the main container, white space in each made one space and trimmed, in
    the page's order with an empty line between; it is empty where there are none, and for a null or empty html.
    A page whose URL is null or has no host, or that has no text at its host's winning path, uses its own
    best container and those at the same path. Repeated rows vote and are extracted each. Other columns are ignored.
    """
    winners = stored(winning_paths(pages), "html-paths")
    hosted = pages.select("page_id", "url", "html", url_host(F.col("url")).alias("host"))
    page_type = pages.schema["page_id"].dataType.simpleString()

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(batch["html"].to_pylist(), batch["path"].to_pylist(), strict=True)
            yield pa.RecordBatch.from_arrays(
                [batch["page_id"], batch["url"], pa.array([main_text(p or "", path) for p, path in rows], pa.string())],
                ["page_id", "url", "text"],
            )

    joined = hosted.join(checked_broadcast(winners, WINNER_BYTES), "host", "left")
    return joined.select("page_id", "url", "html", "path").mapInArrow(
        texts, f"page_id {page_type}, url string, text string"
    )
