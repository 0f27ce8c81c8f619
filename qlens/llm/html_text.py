"""Main text of web pages by minimum-cut labelling.

A page is a row of text blocks. A linear classifier gives each block a cost of
being called boilerplate or content, from its place in the document tree, its
links and its length; these are the capacities to the two terminals. Blocks
that stand beside each other, or have the same parent, are joined by edges
that are the stronger the nearer they are in the tree. The minimum cut, found
by maximum flow, is the cheapest labelling.
"""

from __future__ import annotations

import re
from collections import Counter, deque
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qlens.llm.common import text_or_empty, travels

# Elements by what they do to the text, as HTML defines them.
BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
UNSEEN = frozenset("head script style template noscript iframe object svg math canvas audio video title".split())
CONTROLS = frozenset("button select option optgroup textarea input label datalist output".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Elements that end an open element of the same group when they begin.
SIBLINGS = {"li": "li", "dt": "dt dd", "dd": "dt dd", "tr": "tr td th", "td": "td th", "th": "td th", "option": "option"}
SIBLINGS = {k: frozenset(v.split()) for k, v in SIBLINGS.items()}

# Words of class, id and role that speak for content or against it.
FOR = frozenset("article content main post entry story body text blog prose".split())
AGAINST = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices notification"
    " alert popup modal overlay newsletter subscribe subscription signup login search sidebar aside widget widgets complementary menu menus nav navbar"
    " navigation breadcrumb breadcrumbs pagination pager toolbar footer contentinfo masthead copyright legal disclaimer share sharing social related"
    " recommended recommendations comment comments reply replies respond discussion disqus form tags".split()
)
# Names that begin so say what a page has, lacks or is filed under, not what the element is.
MODIFIERS = frozenset("has have with without no not category tag".split())
# Against an article only if they say what it is; its other names are about what surrounds it.
KINDS = frozenset("ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion comment reply related recommended widget".split())
# Within a line these are not the author's words, the others may be part of a sentence.
ADVERTS = frozenset("ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion".split())

# The classifier's weights, in hundredths of log-odds.
BIAS = -60
PER_DOUBLING = 40  # of the words in a block
LINKED = -500  # times the linked share of its characters
INSIDE = 500  # an element that speaks for content
OUTSIDE = -900  # an element that speaks against it
WITHIN = -300  # an element within a line that speaks against it, other than an advert
HEADING = 60
SENTENCE = 80  # ends like a sentence
# Smoothness: of blocks beside each other, divided by their distance in the tree, and of blocks with the same parent.
BESIDE = 240
SAME_PARENT = 120
# Of an element within a line and the rest of the line; the second where a sentence runs on from one to the other.
ASIDE = 240
RUNS_ON = 480

ENDS = ".!?\"'”»…"
TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+>?|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>?""", re.S)
ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
NAME_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


@dataclass(eq=False)
class Place:
    """An element's place in the tree, linked to its parent's, so that a block costs no more the deeper it stands."""

    number: int
    parent: Place | None
    depth: int

    def below(self, number: int) -> Place:
        return Place(number, self, self.depth + 1)


@dataclass
class Element:
    tag: str
    place: Place
    opinion: int  # of the nearest element that has one: 1 for content, -1 against
    in_article: bool
    unseen: bool
    within: int = 0  # the number of the outermost element within the line that speaks against its text, if any
    advert: bool = False  # whether that is an advert


@dataclass
class Block:
    text: str
    linked: int
    place: Place
    opinion: int
    heading: bool
    line: int  # the blocks of one line are the elements within it that speak against their text, and its rest
    pieces: list[tuple[int, str]]  # its text as it stands in the line, with places
    tied: int = 0  # to the rest of the line, if this is an element within it
    advert: bool = False


def named(attributes: str) -> tuple[list[list[str]], bool]:
    """The words of each name in an element's class, id and role, without modifiers, and whether it is hidden."""
    names: list[list[str]] = []
    hidden = False
    for m in ATTRIBUTE.finditer(attributes):
        key, value = m[1].lower(), (m[2] or "").strip("\"'")
        if key == "hidden" or (key == "aria-hidden" and value.lower() == "true"):
            hidden = True
        elif key == "style":
            hidden |= "display:none" in value.replace(" ", "").lower()
        elif key != "aria-hidden":
            for name in value.split():
                words = [w.lower() for w in NAME_WORD.findall(name)]
                if words and (len(words) == 1 or words[0] not in MODIFIERS):
                    names.append(words)
    return names, hidden


def speaks(names: list[list[str]], trusting: bool = False) -> int:
    """1 if a name speaks for content, or else -1 if one speaks against it, or else 0.

    A name with words of both kinds speaks against; if ``trusting``, its last such word counts.
    """
    said = 0
    for words in names:
        known = [w for w in words if w in FOR or w in AGAINST or w == "header"]
        if known and (known[-1] in FOR if trusting else FOR.issuperset(known)):
            return 1
        if not AGAINST.isdisjoint(known):
            said = -1
    return said


def opinion(tag: str, attributes: str, parent: Element, trusting: bool) -> tuple[int, bool]:
    """What an element says about its text: 1, -1, or its parent's opinion; and whether it is hidden."""
    names, hidden = named(attributes)
    said = speaks(names, trusting)
    if tag in ("html", "body"):
        said = max(said, 0)  # nothing stands outside of them
    elif tag == "main":
        said = 1
    elif tag == "article":
        said = 1 if said >= 0 or trusting or not any(not KINDS.isdisjoint(words) for words in names) else -1
    if tag in ("nav", "aside", "form", "menu", "search", "dialog") or said < 0:
        return -1, hidden
    if tag in ("header", "footer") or (said == 0 and any("header" in words for words in names)):
        # the header of an article that is not content isn't either
        return (1 if tag != "footer" and parent.in_article and (parent.opinion >= 0 or trusting) else -1), hidden
    if said > 0:
        # an article inside a comment or a list of related ones stays what that is
        return (-1 if parent.opinion < 0 and tag != "main" and not trusting else 1), hidden
    return parent.opinion, hidden


def blocks(html: str, trusting: bool = False) -> list[Block]:
    """Text blocks in page order: character references decoded, white space turned into single blanks, empty ones left out.

    ``trusting`` believes what speaks for content even inside what speaks
    against it, as on a page whose advert is never closed.
    """
    out: list[Block] = []
    numbers = lines = 0
    stack = [Element("", Place(0, None, 0), 0, False, False)]
    open_tags: Counter[str] = Counter()
    parts: list[tuple[str, int, Element]] = []  # text, how much of it is linked, and where it stands
    links = 0
    heading = False

    def close() -> None:
        nonlocal lines
        if not parts:
            return
        lines += 1
        own: dict[int, Block] = {0: Block("", 0, stack[-1].place, stack[-1].opinion, heading, lines, [])}
        for place, (text, linked, element) in enumerate(parts):
            if element.within not in own:
                own[element.within] = Block("", 0, own[0].place.below(element.within), -1, heading, lines, [], ASIDE, element.advert)
            block = own[element.within]
            block.pieces.append((place, text))
            block.linked += linked
        parts.clear()
        for block in own.values():
            block.text = joined_text(block.pieces)
            block.linked = min(block.linked, len(block.text))
        line = own.pop(0)
        if line.text:
            out.append(line)
        for block in own.values():
            if block.text:
                before = joined_text([p for p in line.pieces if p[0] < block.pieces[0][0]])
                after = joined_text([p for p in line.pieces if p[0] > block.pieces[-1][0]])
                if not line.text:
                    block.tied = 0
                elif (before and before[-1] not in ENDS) or (after and not (after[0].isupper() or block.text[-1] in ENDS)):
                    block.tied = RUNS_ON
                out.append(block)

    at, size = 0, len(html)
    while at < size:
        m = TAG.search(html, at)
        end = m.start() if m else size
        if end > at and not stack[-1].unseen:
            raw = html[at:end]
            text = unescape(raw) if "&" in raw else raw
            parts.append((text, len(" ".join(text.split())) if links else 0, stack[-1]))
        if not m:
            break
        at = m.end()
        if not m[2]:
            continue
        tag, ends = m[2].lower(), bool(m[1])
        if not ends and tag in ("script", "style", "title", "textarea"):
            stop = re.compile(rf"</{tag}\b[^>]*>?", re.I).search(html, at)
            at = stop.end() if stop else size
            continue
        if tag == "a":
            links = max(0, links - 1) if ends else links + 1
        if tag in BLOCK:
            close()
            heading = tag in HEADINGS and not ends
            links = links if tag == "br" else 0
        elif tag not in UNSEEN and tag not in CONTROLS:
            # an element within a line counts only where it speaks against its text
            if (ends and stack[-1].tag != tag) or not (ends or speaks(named(m[3])[0], trusting) < 0):
                continue
        if tag in VOID:
            continue
        if ends:
            while open_tags[tag]:
                last = stack.pop().tag
                open_tags[last] -= 1
                if last == tag:
                    break
            continue
        innermost = stack[-1].tag
        # the last is a head that was never closed
        if (innermost == "p" and tag in BLOCK) or (tag in SIBLINGS and innermost in SIBLINGS[tag]) or (innermost == "head" and tag not in UNSEEN):
            open_tags[stack.pop().tag] -= 1
        parent = stack[-1]
        said, hidden = opinion(tag, m[3], parent, trusting)
        numbers += 1
        unseen = parent.unseen or hidden or tag in UNSEEN or tag in CONTROLS
        inside = parent.in_article or tag == "article" or said > parent.opinion
        if tag in BLOCK or tag in UNSEEN or tag in CONTROLS:
            within, advert = 0, False
        else:
            within = parent.within or numbers
            advert = parent.advert or parent.opinion < 0 or any(not ADVERTS.isdisjoint(words) for words in named(m[3])[0])
        open_tags[tag] += 1
        stack.append(Element(tag, parent.place.below(numbers), said, inside, unseen, within, advert))
    close()
    return out


def joined_text(pieces: list[tuple[int, str]]) -> str:
    """Pieces of a line with single blanks for white space and for what is left out between them."""
    out, next_place = [], None
    for place, text in sorted(pieces):
        out.append(text if place == next_place else " " + text)
        next_place = place + 1
    return " ".join("".join(out).split())


# --- labelling ---------------------------------------------------------------


def costs(block: Block) -> int:
    """The classifier: positive speaks for content, negative for boilerplate."""
    words = block.text.count(" ") + 1
    odds = BIAS + PER_DOUBLING * words.bit_length()
    if block.tied and not block.advert:
        odds += WITHIN
    else:
        odds += int(LINKED * block.linked / len(block.text))
        odds += INSIDE if block.opinion > 0 else OUTSIDE if block.opinion < 0 else 0
    odds += HEADING if block.heading else 0
    odds += SENTENCE if block.text[-1] in ENDS else -SENTENCE // 2
    return odds


def tree_distance(a: Place, b: Place, most: int = BESIDE + 1) -> int:
    """Steps from one element to the other through the tree; ``most`` where it is as far or farther."""
    steps = 0
    while a is not b and steps < most:
        if a.depth >= b.depth:
            a, steps = a.parent, steps + 1
        else:
            b, steps = b.parent, steps + 1
    return steps


def alike(a: Block, b: Block) -> float:
    """1 for blocks of the same linked share, 0 for one that is all links beside one without: a list of links says nothing about the text beside it."""
    return 1 - abs(a.linked / len(a.text) - b.linked / len(b.text))


def edges(row: list[Block]) -> list[tuple[int, int, int]]:
    """(i, j, capacity) between neighbours in the page and between neighbours among the blocks of one parent, less where their links differ."""
    out = [(k, k + 1, int(alike(a, b) * BESIDE) // max(1, tree_distance(a.place, b.place))) for k, (a, b) in enumerate(zip(row, row[1:]))]
    last: dict[int, int] = {}
    for k, b in enumerate(row):
        parent = (b.place.parent or b.place).number
        if last.get(parent, k) < k - 1:
            out.append((last[parent], k, int(alike(row[last[parent]], b) * SAME_PARENT)))
        last[parent] = k
    return [e for e in out if e[2]]


def minimum_cut(odds: list[int], joined: list[tuple[int, int, int]]) -> list[bool]:
    """Whether each node is on the content side; maximum flow by shortest augmenting paths in layers."""
    n = len(odds)
    if min(odds) >= 0 or max(odds) <= 0:
        return [o > 0 for o in odds]
    source, sink = n, n + 1
    ends: list[int] = []
    room: list[int] = []
    at: list[list[int]] = [[] for _ in range(n + 2)]

    def edge(a: int, b: int, there: int, back: int) -> None:
        at[a].append(len(ends))
        at[b].append(len(ends) + 1)
        ends.extend((b, a))
        room.extend((there, back))

    for k, o in enumerate(odds):
        if o > 0:
            edge(source, k, o, 0)
        elif o < 0:
            edge(k, sink, -o, 0)
    for a, b, capacity in joined:
        edge(a, b, capacity, capacity)
    while True:
        layer = [-1] * (n + 2)
        layer[source] = 0
        queue = deque([source])
        while queue:
            a = queue.popleft()
            for e in at[a]:
                if room[e] and layer[ends[e]] < 0:
                    layer[ends[e]] = layer[a] + 1
                    queue.append(ends[e])
        if layer[sink] < 0:
            return [x >= 0 for x in layer[:n]]
        tried = [0] * (n + 2)
        path: list[int] = []
        a = source
        while True:
            if a == sink:
                flow = min(room[e] for e in path)
                for e in path:
                    room[e] -= flow
                    room[e ^ 1] += flow
                path, a = [], source
                continue
            while tried[a] < len(at[a]):
                e = at[a][tried[a]]
                if room[e] and layer[ends[e]] == layer[a] + 1:
                    break
                tried[a] += 1
            if tried[a] < len(at[a]):
                path.append(at[a][tried[a]])
                a = ends[path[-1]]
            elif path:
                a = ends[path.pop() ^ 1]
                tried[a] += 1
            else:
                break


def main_text(html: str) -> str:
    """The content blocks, joined by line feeds; empty if there are none.

    What is tied to its line goes with it, or is left out where that is cheaper;
    it doesn't take the line with it.
    """
    for trusting in (False, True):
        row = blocks(html, trusting)
        own = [b for b in row if not b.tied]
        kept = minimum_cut([costs(b) for b in own], edges(own)) if own else []
        if any(kept):
            break
    lines = {b.line: b.pieces for b, keep in zip(own, kept) if keep}
    for b in row:
        if b.tied and b.line in lines and costs(b) + b.tied > 0:
            lines[b.line] = lines[b.line] + b.pieces
    return "\n".join(map(joined_text, lines.values()))


# --- on Spark ----------------------------------------------------------------


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row.

    Null html counts as empty and gives empty text, as does a page without
    content; repeated rows stay, an empty table stays empty. Pages of any
    length and depth are read whole, in memory that grows with their length,
    not with the depth of what is never closed.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h) for h in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), text_or_empty("html").alias("html"))
    return rows.mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint")


travels(__name__)
