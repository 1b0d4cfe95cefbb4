"""Main text of pages: blocks judged by two passes of rules."""

import heapq
import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline.llm.tables import slices

# Parameters of the block rules: characters, share of stop words, share of link text.
SHORT = 70
LONG = 200
LOW_STOP_WORDS = 0.12
HIGH_STOP_WORDS = 0.2
LINK_SHARE = 0.33
_SLICE_BYTES = 8 << 20

# Frequent function words of the four languages of the pages.
STOP_WORDS = frozenset(
    """
    a an and are as at be but by for from had has have he her his i in is it its not of
    on or our she so that the their them there they this to was we were what when which
    who will with would you your
    als am auch auf aus bei bin bis das dass dem den der des die durch ein eine einem
    einen einer es für hat ich ihr im ist mit nach nicht noch nur oder sich sie sind
    über um und uns von vor war wie wir zu zum zur
    au aux avec ce ces cette dans de du elle en est et il ils la le les leur mais ne
    nous ou où par pas plus pour qu que qui sa se ses son sont sur un une vous
    al como con del donde el ella esta este está fue ha hay la las lo los más me mi muy
    no nos para pero por porque se ser si sin sobre su sus también te todo un una y
    """.split()
)

# Elements by what they do to the text.
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_INLINE = frozenset(
    "a abbr b bdi bdo big cite code data del dfn em font i ins kbd mark q s samp small"
    " span strike strong sub sup time tt u var wbr img".split()
)
_OUTSIDE = frozenset(
    "head title nav footer aside form button select menu dialog iframe object audio"
    " video canvas svg math label fieldset header template noscript".split()
)
_RAW = "script|style|textarea|noscript|template|svg|iframe|title"
# A telling name alone, or with a word behind that says what part of the page it is: a
# share-price, related-work or ads-theory is none.
_NAMED = re.compile(
    r"(?:(?P<never>comments?|cookies?|consent|disqus|gdpr|replies)|ads?|advert\w*|adbox|banner|breadcrumbs?"
    r"|footer|(?P<header>header)|masthead|menu|nav(?:bar|igation)?|newsletter|notice"
    r"|notification|pagination|paywall|popup|promo(?:tion)?|related|share|sharing"
    r"|sidebar|social|sponsor(?:ed)?|subscribe|toolbar|widget)"
    r"(?:[_-]++(?:\d+|alert|area|articles?|banner|bar|block|body|bottom|box|buttons?|column"
    r"|consent|container|content|dialog|footer|form|frame|header|icons?|info|inner|items?|left"
    r"|links?|list|main|media|menu|message|modal|nav|note|notice|outer|overlay|panel|policy"
    r"|popup|posts?|primary|prompt|right|row|secondary|section|slot|stories|strip|thread|top"
    r"|unit|widget|wrap|wrapper))*+",
    re.I,
)
_ROLES = frozenset(
    "alert banner complementary contentinfo dialog form menu navigation search".split()
)

# A quote opens a value behind an equals sign only. A tag, value, comment or raw element that
# never ends lasts to the end of the page, so each character is looked at a few times at most.
_INSIDE = r"""(?:[^>=]++|=\s*+(?:"[^"]*+(?:"|\Z)|'[^']*+(?:'|\Z))?+)*+"""
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(?P<raw>{_RAW})(?=[\s/>]){_INSIDE}(?:>.*?(?:</(?P=raw)(?=[\s/>])[^>]*+(?:>|\Z)|\Z)|\Z)"
    r"|</(?P<end>[a-z][^\s/>]*+)[^>]*+(?:>|\Z)"
    rf"|<(?P<start>[a-z][^\s/>]*+)(?P<rest>{_INSIDE})(?:>|\Z)"
    r"|<[!?][^>]*+(?:>|\Z)"
    r"|(?P<text>[^<]+|<)",
    re.I | re.S,
)
_ATTRIBUTE = re.compile(
    r"""(?<![^\s"'/])(class|id|role|hidden|aria-hidden)\s*"""
    r"""(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""",
    re.I,
)
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_LISTS = frozenset("ul ol dl menu".split())
# Elements without main text that hold the page's main or article may be its wrapper. So
# may a LOOSE one that holds most of the good text; HELD ones are comments and the like.
NOT, FIRM, HELD, LOOSE = 1, 2, 3, 4
_KINDS = dict.fromkeys("nav footer aside menu dialog header".split(), FIRM) | dict.fromkeys(
    ("form", "fieldset"), LOOSE
)
_WORD = re.compile(r"[^\W\d_]+")

# Prose of any language has a mark in so many characters.
MARK_EVERY = 150
_MARK = re.compile(r"[.!?…,;:](?=\s|$)|[。！？，、；।؟،]")
_LEGAL = re.compile(r"©|\(c\)\s|copyright\b|all rights reserved", re.I)


@dataclass
class Block:
    text: str
    link_chars: int
    in_article: bool
    in_list: int = 0
    heading: bool = False
    code: bool = False
    dropped: int = -1
    good: bool | None = None


@dataclass
class Dropped:
    """An element without main text: its number, kind, the one around it, what is in it."""

    number: int
    kind: int
    around: int = -1
    chars: int = 0
    mains: int = 0
    articles: int = 0


@dataclass
class Open:
    """An open element and what holds for text in it."""

    name: str
    outside: bool = False
    in_article: bool = False
    # The outermost list in the article, and the innermost dropped element.
    in_list: int = 0
    inner: int = -1
    heading: bool = False
    code: bool = False
    in_link: bool = False
    # Places in the stack: of the innermost block, and of the paragraph a block would end.
    block: int = 0
    paragraph: int = 0


def _outside(name: str, rest: str, in_article: bool, in_heading: bool) -> int:
    """Whether an element holds no main text, by its name, role, class or id; its kind."""
    if name in ("article", "main", "body", "html"):
        return 0
    if name in _OUTSIDE and not (name == "header" and in_article):
        return _KINDS.get(name, NOT)
    kinds = []
    for key, *values in _ATTRIBUTE.findall(rest or ""):
        key, value = key.lower(), "".join(values)
        if key == "hidden":
            return NOT
        if key == "aria-hidden" and value.lower() == "true":
            kinds.append(LOOSE)
        if key == "role" and value.lower() in _ROLES:
            kinds.append(LOOSE if value.lower() == "form" else FIRM)
        for token in value.split() if key in ("class", "id") else ():
            found = _NAMED.fullmatch(token)
            if found and not (in_heading and found["header"]):
                kinds.append(HELD if found["never"] else LOOSE)
    return min(kinds, default=0)


def page_blocks(
    page: str, wrappers: frozenset[int] = frozenset(), every: bool = False
) -> tuple[list[Block], list[Dropped], int]:
    """The blocks of text of a page outside elements that hold no main text.

    Also these elements, and the number of articles and mains outside them. Elements
    whose numbers are among the wrappers are like any other. With ``every``, the blocks
    of elements that may be wrappers come too, with the innermost of them.
    """
    blocks: list[Block] = []
    dropped: list[Dropped] = []
    articles = number = 0
    stack = [Open("")]
    # Places in the stack by name, so that no tag looks through it.
    places: dict[str, list[int]] = {}
    parts: list[str] = []
    links = 0

    def close_block() -> None:
        nonlocal links
        text = " ".join("".join(parts).split())
        if text:
            of = stack[-1]
            blocks.append(
                Block(text, links, of.in_article, of.in_list, of.heading, of.code, of.inner)
            )
        parts.clear()
        links = 0

    def cut(place: int) -> None:
        while len(stack) > place:
            places[stack.pop().name].pop()

    for token in _TOKEN.finditer(page):
        kind, was = token.lastgroup, stack[-1]
        if kind == "text":
            if was.outside:
                dropped[was.inner].chars += len(token["text"])
            else:
                text = html.unescape(token["text"])
                parts.append(text)
                if was.in_link:
                    links += len("".join(text.split()))
            continue
        if kind == "end":
            name = token["end"].lower()
            inline = name in _INLINE
            if not inline and not was.outside:
                close_block()
            # An inline element ends inside its own block only.
            if places.get(name) and not (inline and places[name][-1] < was.block):
                if every and not was.outside and stack[places[name][-1] - 1].inner != was.inner:
                    close_block()
                cut(places[name][-1])
        elif token["start"]:
            name, rest = token["start"].lower(), token["rest"]
            if name == "br":
                if not was.outside:
                    parts.append(" ")
                continue
            if name in _VOID:
                if name == "hr" and not was.outside:
                    close_block()
                continue
            inline = name in _INLINE
            if not inline:
                if not was.outside:
                    close_block()
                # A block ends an open paragraph and what stands open in it, and the
                # body ends the head.
                if name in ("body", "article", "main"):
                    if places.get("head"):
                        cut(places["head"][-1])
                elif was.paragraph:
                    cut(was.paragraph)
                was = stack[-1]
            if rest.endswith("/") and inline:
                continue
            number += 1
            opened = Open(name, was.outside, was.in_article, was.in_list, was.inner)
            if name in ("article", "main"):
                if was.inner >= 0:
                    dropped[was.inner].mains += name == "main"
                    dropped[was.inner].articles += name == "article"
                else:
                    articles += 1
                opened.in_article = True
            opened.heading = was.heading or name in _HEADINGS
            opened.code = was.code or name == "pre"
            if not was.outside and number not in wrappers:
                kind = _outside(name, rest, was.in_article, opened.heading)
                opened.outside = kind == NOT or (kind > 0 and not every)
                if kind:
                    if inline and every:
                        close_block()
                    dropped.append(Dropped(number, kind, was.inner))
                    opened.inner = len(dropped) - 1
            if not was.in_list and opened.in_article and name in _LISTS:
                opened.in_list = number
            opened.in_link = was.in_link or name == "a"
            opened.block = was.block if inline else len(stack)
            # An inline element inside a paragraph, or the paragraph itself.
            opened.paragraph = len(stack) if name == "p" else was.paragraph if inline else 0
            places.setdefault(name, []).append(len(stack))
            stack.append(opened)
    if not stack[-1].outside:
        close_block()
    return blocks, dropped, articles


def judge(blocks: list[Block]) -> None:
    """Decide the clear blocks, then let the others take the label of the nearest.

    A block full of links is bad, in an article only in a list full of links. One with many stop words is good when it is not
    short. A long one with few is bad, in an article undecided. Where no block of the page
    has many, its language has other stop words, and marks between clauses stand for them.
    Preformatted blocks are undecided, short lines on copyright outside an article are bad.
    An undecided heading takes the label of what follows it. Any other undecided block
    takes the label of the nearest decided block before or behind it in the same
    part of the page, an article or the rest; between two equally near, or with
    none, blocks of an article are good and others bad. A block of links inside an
    article says nothing of its neighbours.
    """
    lists: dict[int, list[int]] = {}
    for block in blocks:
        links, chars = lists.setdefault(block.in_list, [0, 0])
        lists[block.in_list] = [links + block.link_chars, chars + _chars(block)]
    densities = [_density(block.text) for block in blocks]
    known = any(
        len(block.text) >= SHORT and density >= HIGH_STOP_WORDS
        for block, density in zip(blocks, densities, strict=True)
    )
    for block, density in zip(blocks, densities, strict=True):
        size = len(block.text)
        links, chars = lists[block.in_list]
        of_links = links > LINK_SHARE * chars if block.in_list else not block.in_article
        if of_links and block.link_chars > LINK_SHARE * _chars(block):
            block.good = False
        elif size >= SHORT and density >= HIGH_STOP_WORDS:
            block.good = True
        elif block.in_article or block.code:
            continue
        elif size < LONG and _LEGAL.match(block.text):
            block.good = False
        elif not known and size >= SHORT and _is_prose(block.text):
            block.good = True
        elif size >= LONG:
            block.good = density >= LOW_STOP_WORDS
    labels = [None if b.in_article and b.good is False else b.good for b in blocks]
    before = _nearest(blocks, labels, range(len(blocks)))
    behind = _nearest(blocks, labels, range(len(blocks) - 1, -1, -1))
    for place, block in enumerate(blocks):
        if block.good is None:
            left, right = before[place], behind[place]
            if block.heading and right[1] is not None:
                block.good = right[1]
            elif left[0] == right[0]:
                block.good = left[1] if left[1] == right[1] else block.in_article
            else:
                block.good = min(left, right)[1]
            if block.good is None:
                block.good = block.in_article


def _density(text: str) -> float:
    words = [w.lower() for w in _WORD.findall(text)]
    return sum(w in STOP_WORDS for w in words) / max(len(words), 1)


def _is_prose(text: str) -> bool:
    marks = len(_MARK.findall(text))
    return marks > 1 and marks * MARK_EVERY >= len(text)


def _chars(block: Block) -> int:
    return len("".join(block.text.split()))


def _nearest(blocks: list[Block], labels: list[bool | None], order: range):
    """For each block the distance to the last decided one met in order, and its label."""
    last: dict[bool, tuple[int, bool]] = {}
    found: list[tuple[float, bool | None]] = [(float("inf"), None)] * len(blocks)
    for place in order:
        part = blocks[place].in_article
        if part in last:
            found[place] = (abs(place - last[part][0]), last[part][1])
        if labels[place] is not None:
            last[part] = (place, labels[place])
    return found


def main_text(page: str) -> str:
    """The good blocks of a page, one a line.

    An element that would be dropped is a wrapper of the page, and stays, when it holds
    its main, its only articles, or, by its kind, more good text than all the rest.
    """
    blocks, dropped, _ = page_blocks(page)
    judge(blocks)
    good = sum(len(block.text) for block in blocks if block.good)
    if any(x.kind != NOT and (x.mains or x.articles or x.chars > good) for x in dropped):
        found = _wrappers(page)
        if found:
            blocks = page_blocks(page, found)[0]
            judge(blocks)
    return "\n".join(block.text for block in blocks if block.good)


def _wrappers(page: str) -> frozenset[int]:
    """The numbers of the elements that would be dropped and are wrappers of the page.

    Sizes are good text as judged with the text of all of them; comments and the like
    do not count for what is around them.
    """
    blocks, dropped, articles = page_blocks(page, every=True)
    judge(blocks)
    rest, own = 0, [0] * len(dropped)
    for block in blocks:
        if block.good and block.dropped < 0:
            rest += len(block.text)
        elif block.good:
            own[block.dropped] += len(block.text)
    direct = [(size, x.mains + x.articles) for size, x in zip(own, dropped, strict=True)]
    inside: list[list[int]] = [[] for _ in dropped]
    for n in range(len(dropped) - 1, -1, -1):
        x = dropped[n]
        if x.around >= 0:
            inside[x.around].append(n)
            dropped[x.around].mains += x.mains
            if x.kind != HELD:
                dropped[x.around].articles += x.articles
                own[x.around] += own[n] if x.kind == LOOSE else 0
    found = set()
    # What the rest holds only grows: an element that is none stays none.
    queue = [(not x.mains, -own[n], n) for n, x in enumerate(dropped) if x.around < 0]
    heapq.heapify(queue)
    while queue:
        _, _, n = heapq.heappop(queue)
        x = dropped[n]
        only = x.articles > 0 and not articles
        loose = x.kind == LOOSE
        larger = own[n] > rest and (loose or (only and x.kind == HELD))
        if x.kind != NOT and (x.mains or (only and loose) or larger):
            found.add(x.number)
            rest += direct[n][0]
            articles += direct[n][1]
            for m in inside[n]:
                heapq.heappush(queue, (not dropped[m].mains, -own[m], m))
    return frozenset(found)


def extract_main_text(pages: DataFrame, id_type: str = "long") -> DataFrame:
    """page_id, url, text and n_chars of every page.

    Every row gives one row, repeated or without page_id too. A missing or empty page
    has the empty text. Markup that never closes lasts to the end of the element
    around it. Other columns are not read.
    """

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html", _SLICE_BYTES):
            texts = [main_text(page or "") for page in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())],
                ["page_id", "url", "text"],
            )

    return (
        pages.select("page_id", "url", "html")
        .mapInArrow(extracted, f"page_id {id_type}, url string, text string")
        .withColumn("n_chars", F.length("text").cast("long"))
    )
