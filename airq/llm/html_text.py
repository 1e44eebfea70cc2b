"""Main text of web pages by consensus of the pages of a host.

Every page scores its containers by the plain text they hold, each score goes to the container's path of tags
and classes with numbers generalised. Spark sums the votes per host and path; the pages are then read again
and the containers on the winning path of their host give the text.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airq.llm.common import byte_slices, texts_of
from airq.llm.url_filter import host_and_path
from airq.session import materialise

# Winning paths are broadcast up to that many bytes of hosts and paths; beyond it pages and paths meet in a shuffle.
BROADCAST_BYTES = 64 << 20
# Pages without a host have no path to meet; their keys are spread over so many values.
NO_HOST_PARTS = 4096

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea xmp iframe noembed noframes noscript template".split())
# Elements of other vocabularies: "/>" closes them, their own tags are passed over, tags of blocks end them.
FOREIGN = frozenset(("svg", "math"))
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label map mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr br svg math object param foreignobject".split()
)
MAIN = frozenset(("article", "main"))
# Parts of a page that are never its main text: by tag, by role, by a word of class or id.
ASIDE_TAGS = frozenset("nav header footer aside form button select fieldset dialog menu".split())
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
ASIDE_WORDS = frozenset(
    "nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager header masthead topbar footer "
    "sidebar side aside rail widget widgets related recommended popular trending "
    "notice notices cookie cookies consent gdpr alert banner popup modal overlay paywall newsletter subscribe signup "
    "ad ads adv advert adverts advertisement advertising adsense adbox adslot sponsor sponsored sponsors promo promotion "
    "form login search comment comments commentlist disqus discussion replies reply respond share sharing social".split()
)
# Marks that name a wrapper of the whole page less often than a part of it.
ASIDE_WORDS_STRONG = frozenset("comment comments commentlist disqus discussion replies reply respond".split())
# Words that mark a part whatever stands beside them in its name.
ASIDE_WORDS_SURE = frozenset(
    "navbar breadcrumb breadcrumbs pagination masthead topbar sidebar gdpr paywall newsletter adsense adbox adslot "
    "advert adverts advertisement advertising sponsored".split()
)
# Words that add nothing to a name: it marks a part if one of its words does and these make up the rest.
NEUTRAL = frozenset(
    "area bar body bottom box block button buttons c card cards col column container content cta group holder inline inner insert "
    "item items js label left link links list main message module my outer page panel post posts row section site slot "
    "small stories story text title top unit wrap wrapper right x".split()
)
# Blocks of text, whose names say what the text is about as often as what kind of part it is.
TEXT_TAGS = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li dt dd td th figcaption".split())
# How many times the text outside it a part marked as aside must hold to be taken for a wrapper.
WRAPPER_TIMES = 9
# A word behind one of these says what a wrapper has, not what it is.
HAVING = frozenset("has with no without is".split())
# An opening tag closes an open element of these kinds that is not shut off by another container.
CLOSES = {
    "p": {"p"}, "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"},
    "td": {"td", "th", "p"}, "th": {"td", "th", "p"}, "option": {"option"},
}
SCOPE = frozenset("ul ol dl table body html div section article main blockquote td th".split())
CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figure figcaption footer form h1 h2 h3 h4 h5 h6 header hr "
    "main menu nav ol pre section table ul".split()
)
ENDS_FOREIGN = CLOSES_P | frozenset("p li dd dt tr td th body br center head img span".split())

_TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:-->|--!>|\Z))"
    r"|<[!?][^>]*+(?:>|\Z)"
    r"|</[^a-zA-Z>][^>]*+(?:>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<rest>(?:[^'\">]++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*+)(?P<rest2>[^>]*+)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]++)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>]++)))?+")
READ_ATTRIBUTES = frozenset("class id role itemprop hidden style".split())
_NOT_SHOWN = re.compile(r"display\s*:\s*none", re.I)
# Inside a script: what starts and ends the parts in which an end tag does not end it.
_SCRIPT = re.compile(r"<!--(?P<shut>-?>)?|-->|<(?P<end>/?)script(?=[\s/>])", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")
_NUMBER = re.compile(r"[0-9]+")


@dataclass
class Element:
    tag: str
    label: str
    parent: int
    mark: int
    named: bool
    main: bool
    doubt: bool = False
    aside: bool = False


@dataclass
class Page:
    """Elements in document order (0 is the root) and blocks of text ``(element, tag of the block, text, link characters)``."""

    elements: list[Element] = field(default_factory=lambda: [Element("", "", -1, 0, False, False)])
    blocks: list[tuple[int, str, str, int]] = field(default_factory=list)

    def lies_on(self, at: int, labels: list[str]) -> bool:
        """Whether the path of an element has these labels, given from the element up to the root."""
        for label in labels:
            if at <= 0 or self.elements[at].label != label:
                return False
            at = self.elements[at].parent
        return at == 0

    def path(self, at: int) -> str:
        labels = []
        while at > 0:
            labels.append(self.elements[at].label)
            at = self.elements[at].parent
        return ">".join(reversed(labels))


def marked_words(values: dict[str, str]) -> tuple[set[str], bool]:
    """Words of class and id that mark a part as aside, and whether one of the names is about nothing else."""
    found, whole = set(), False
    for name in f"{values.get('class', '')} {values.get('id', '')}".split():
        words = [w.lower() for w in _WORD.findall(name)]
        marks = {w for i, w in enumerate(words) if w in ASIDE_WORDS and (i == 0 or words[i - 1] not in HAVING)}
        found |= marks
        if marks:
            whole = whole or bool(marks & ASIDE_WORDS_SURE) or all(w in marks or w in NEUTRAL or w.isdigit() for w in words)
    return found, whole


def not_shown(values: dict[str, str]) -> bool:
    return "hidden" in values or bool(_NOT_SHOWN.search(values.get("style", "")))


def aside_mark(tag: str, values: dict[str, str]) -> tuple[int, bool]:
    """0 for a part that may be main text, 1 for one marked as aside by a word or as a form, 2 by a stronger sign;
    and whether the mark is in doubt, because it rests on one word of a longer name."""
    if tag in ("html", "body", *MAIN):
        return 0, False
    role = values.get("role", "").lower()
    if not_shown(values) or (tag in ASIDE_TAGS and tag != "form") or (role in ASIDE_ROLES and role != "form"):
        return 2, False
    words, whole = marked_words(values)
    if words & ASIDE_WORDS_STRONG:
        return 2, False
    form = tag == "form" or role == "form"
    return int(bool(words) or form), bool(words) and not whole and not form


def settle_doubts(page: Page) -> None:
    """Take back marks in doubt of text blocks, and of parts of an article or main part, that are not mostly links."""
    elements = page.elements
    if not any(e.doubt for e in elements):
        return
    text, links = [0] * len(elements), [0] * len(elements)
    for at, _, block, linked in page.blocks:
        text[at] += len(block)
        links[at] += linked
    for i in range(len(elements) - 1, 0, -1):
        text[elements[i].parent] += text[i]
        links[elements[i].parent] += links[i]
    in_main = [False] * len(elements)
    for i in range(1, len(elements)):
        e = elements[i]
        if e.doubt and (in_main[e.parent] or e.tag in TEXT_TAGS) and 2 * links[i] < text[i]:
            e.mark = 0
        in_main[i] = in_main[e.parent] or (e.main and not e.named)


def keep_titles(page: Page) -> None:
    """First headings in the header of an article or main part belong to it."""
    elements = page.elements
    in_main, marked = [False] * len(elements), [0] * len(elements)
    for i in range(1, len(elements)):
        e = elements[i]
        in_main[i] = in_main[e.parent] or (e.main and not e.named)
        marked[i] = i if e.mark else marked[e.parent]
        by = elements[marked[i]]
        if e.tag == "h1" and e.aside and by.tag == "header" and in_main[by.parent] and not elements[by.parent].aside:
            e.aside = False


def script_end(source: str, at: int) -> int:
    """Where the end tag of the script stands whose text begins at ``at``.

    Behind ``<!--`` a start tag of a script takes the next end tag, up to ``-->``. If that leaves the script open, its first end tag counts.
    """
    escaped = 0
    first = -1
    for m in _SCRIPT.finditer(source, at):
        if m[0].startswith("<!--"):
            escaped = escaped or int(not m["shut"])
        elif m[0] == "-->":
            escaped = 0
        elif m["end"]:
            first = m.start() if first < 0 else first
            if escaped < 2:
                return m.start()
            escaped = 1
        elif escaped:
            escaped = 2
    return first if first >= 0 else len(source)


def settle_asides(page: Page) -> None:
    """Take back the marks of wrappers, then let the others hold for all that lies in a part.

    The mark of a wrapper is one whose part holds the page's largest article or main part (one not marked
    itself, for marks by a word), or nearly all of the text and every first heading.
    """
    elements = page.elements
    if not any(e.mark for e in elements):
        return
    n = len(elements)
    own, headings = [0] * n, [0] * n
    for at, tag, text, links in page.blocks:
        own[at] += len(text) - links
        headings[at] += tag == "h1"
    total, free, largest = list(own), list(own), [0] * n
    for i in range(n - 1, 0, -1):
        e = elements[i]
        if e.main and not e.named and not e.mark:
            largest[i] = max(largest[i], free[i])
        total[e.parent] += total[i]
        headings[e.parent] += headings[i]
        if not e.mark:
            free[e.parent] += free[i]
        largest[e.parent] = max(largest[e.parent], largest[i])
    outside = free[0]
    main_outside = 0
    inner = [False] * n
    for i in range(1, n):
        e = elements[i]
        inner[i] = inner[e.parent] or e.mark > 0
        if e.main and not inner[i] and not e.named:
            main_outside = max(main_outside, free[i])
    for i in range(1, n):
        e = elements[i]
        e.aside = elements[e.parent].aside
        if e.mark and not e.aside:
            holds_main = e.mark == 1 and largest[i] > main_outside and 4 * largest[i] >= outside
            holds_all = total[i] > WRAPPER_TIMES * outside and (e.mark == 1 or 0 < headings[i] == headings[0])
            if holds_main or holds_all:
                outside += free[i]
            else:
                e.aside = True


def parse(source: str) -> Page:
    """Elements and text blocks of a page, with the usual repair of tags left open."""
    page = Page()
    elements, stack = page.elements, [0]
    parts: list[str] = []
    links, link_depth, unseen, at = 0, 0, 0, 0

    def passed_over(element: Element) -> bool:
        """Whether the element is inline and none of its text is shown."""
        return element.tag == "svg" or (element.mark == 2 and element.tag in INLINE)

    def flush() -> None:
        nonlocal links
        text = " ".join("".join(parts).split())
        if text:
            block = next((i for i in reversed(stack) if elements[i].tag not in INLINE), 0)
            page.blocks.append((block, elements[block].tag, text, min(links, len(text))))
        parts.clear()
        links = 0

    def close(upto: int) -> None:
        nonlocal link_depth, unseen
        if any(elements[i].tag not in INLINE for i in stack[upto:]):
            flush()
        for i in stack[upto:]:
            link_depth -= elements[i].tag == "a"
            unseen -= passed_over(elements[i])
        del stack[upto:]

    def add(text: str) -> None:
        nonlocal links
        if text and not unseen:
            text = html.unescape(text) if "&" in text else text
            parts.append(text)
            if link_depth:
                links += len(text)

    size = len(source)
    while at < size:
        token = _TOKEN.search(source, at)
        if token is None:
            add(source[at:])
            break
        add(source[at : token.start()])
        at = token.end()
        tag = (token["tag"] or token["tag2"] or "").lower()
        if not tag:
            continue
        if token["end"] or token["end2"]:
            for depth in range(len(stack) - 1, 0, -1):
                if elements[stack[depth]].tag == tag:
                    close(depth)
                    break
            continue
        if tag in RAW:
            if tag == "script":
                at = script_end(source, at)
                continue
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)", re.I).search(source, at)
            at = end.start() if end else size
            continue
        rest = token["rest"] or token["rest2"] or ""
        if elements[stack[-1]].tag in FOREIGN and tag not in FOREIGN:
            if tag in ENDS_FOREIGN:
                close(len(stack) - 1)
            elif tag != "foreignobject" or rest.endswith("/"):
                continue
        if tag in FOREIGN and rest.endswith("/"):
            continue
        if tag == "br":
            parts.append(" ")
            continue
        if tag not in INLINE:
            shut = CLOSES.get(tag, ()) or (("p",) if tag in CLOSES_P else ())
            for depth in range(len(stack) - 1, 0, -1):
                open_tag = elements[stack[depth]].tag
                if open_tag in shut:
                    close(depth)
                    break
                if open_tag in SCOPE or open_tag in ("object", "foreignobject"):
                    break
            flush()
        if tag in VOID:
            continue
        values = {}
        for m in _ATTRIBUTE.finditer(rest):
            if (name := m[1].lower()) in READ_ATTRIBUTES:
                values.setdefault(name, html.unescape(m[2] or m[3] or m[4] or ""))
        classes = ".".join(_NUMBER.sub("#", c) for c in values.get("class", "").split())
        parent = stack[-1]
        main = tag in MAIN or values.get("role", "").lower() == "main" or values.get("itemprop", "") == "articleBody"
        label = f"{tag}.{classes}" if classes else tag
        named = main and bool(marked_words(values)[0])
        mark, doubt = aside_mark(tag, values)
        elements.append(Element(tag, label, parent, mark, named, main, doubt))
        stack.append(len(elements) - 1)
        link_depth += tag == "a"
        unseen += passed_over(elements[-1])
    flush()
    settle_doubts(page)
    settle_asides(page)
    keep_titles(page)
    return page


def container_scores(page: Page) -> dict[int, float]:
    """Plain text of the blocks of each container; links count against it.

    A block counts for the outermost article or main part around it, else for its nearest container and
    with half its weight for the one around that.
    """
    scores: dict[int, float] = {}
    for element, _, text, links in page.blocks:
        if page.elements[element].aside:
            continue
        weight = len(text) - 2.0 * links
        around = []
        main = 0
        at = element
        while at > 0:
            if page.elements[at].main:
                main = at
            if page.elements[at].tag in SCOPE:
                around.append(at)
            at = page.elements[at].parent
        for holder, share in [(main, 1.0)] if main else zip([*around, 0], (1.0, 0.5)):
            scores[holder] = scores.get(holder, 0.0) + share * weight
    return scores


def best_container(page: Page) -> int:
    """The container with the highest score, the first of equal ones; the root without any text."""
    scores = container_scores(page)
    return max(sorted(scores), key=scores.__getitem__) if scores else 0


def main_text(page: Page, path: str | None) -> str:
    """Text of the containers on ``path``, else of those on the path of the page's best one.

    Parts that are aside and whatever lies in them are left out; a first heading that stands beside the
    container, in one of the elements around it, belongs to the text.
    """
    elements = page.elements

    def on(path: str | None) -> set[int]:
        labels = path.split(">")[::-1] if path else []
        return {i for i in range(len(elements)) if labels and not elements[i].aside and page.lies_on(i, labels)}

    chosen = on(path)
    if not chosen:
        best = best_container(page)
        chosen = on(page.path(best)) or {best}
    inside = [i in chosen for i in range(len(elements))]
    around = set()
    for i in chosen:
        while i >= 0:
            around.add(i)
            i = elements[i].parent
    for i in range(1, len(elements)):
        inside[i] = inside[i] or inside[elements[i].parent]
    kept = [
        text
        for element, tag, text, _ in page.blocks
        if not elements[element].aside and (inside[element] or (tag == "h1" and elements[element].parent in around))
    ]
    return "\n".join(kept)


def host_paths(pages: DataFrame) -> DataFrame:
    """``(host, path)``: the winning path of each host with a name, from all its pages.

    A page has one vote, dealt over its containers by their scores. Votes are summed before the shuffle, so
    a host with any number of pages is one row per task and path.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, "html"):
                hosts, paths, votes = [], [], []
                for host, source in zip(part.column(0).to_pylist(), texts_of(part, "html")):
                    page = parse(source)
                    scores = {i: s for i, s in container_scores(page).items() if s > 0}
                    total = sum(scores.values())
                    for i, s in scores.items():
                        hosts.append(host)
                        paths.append(page.path(i))
                        votes.append(s / total)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hosts, pa.string()), pa.array(paths, pa.string()), pa.array(votes, pa.float64())],
                    ["host", "path", "vote"],
                )

    votes = pages.where("host <> ''").mapInArrow(run, "host string, path string, vote double")
    # whole numbers: sums do not depend on the order of the rows
    summed = votes.groupBy("host", "path").agg(F.sum(F.round(F.col("vote") * 1_000_000).cast("long")).alias("votes"))
    return summed.groupBy("host").agg(F.max_by("path", F.struct("votes", "path")).alias("path"))


def extract_text(
    pages: DataFrame,
    id_column: str = "page_id",
    url_column: str = "url",
    html_column: str = "html",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """One row per row of ``pages``: id, url, ``text`` (blocks joined by a line feed), ``n_chars``.

    Null or empty html and pages without main text give an empty text. Pages without a host (null or odd
    URL) go by their own best container. Repeated rows give repeated results; other columns are not read.
    """
    rows = pages.select(
        host_and_path(F.col(url_column))[0].alias("host"),
        F.col(id_column).alias("_id"),
        F.col(url_column).alias("_url"),
        F.col(html_column).alias("html"),
    )
    winners = materialise(host_paths(rows.select("host", "html")))
    measured = winners.agg(F.sum(F.octet_length("host") + F.octet_length("path")).alias("bytes")).first()["bytes"] or 0
    if measured <= broadcast_bytes:
        joined = rows.join(F.broadcast(winners), "host", "left")
    else:
        spread = F.concat(F.lit("?"), F.pmod(F.xxhash64("_id", "html"), F.lit(NO_HOST_PARTS)).cast("string"))
        joined = rows.withColumn("host", F.when(F.col("host") == "", spread).otherwise(F.col("host"))).join(winners, "host", "left")
    joined = joined.select("_id", "_url", "path", "html")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, "html"):
                found = [main_text(parse(s), p) for p, s in zip(part.column(2).to_pylist(), texts_of(part, "html"))]
                sizes = pa.array(list(map(len, found)), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(found, pa.string()), sizes], ["_id", "_url", "text", "n_chars"]
                )

    kind = pages.schema[id_column].dataType.simpleString()
    out = joined.mapInArrow(run, f"_id {kind}, _url string, text string, n_chars long")
    return out.select(F.col("_id").alias(id_column), F.col("_url").alias(url_column), "text", "n_chars")
