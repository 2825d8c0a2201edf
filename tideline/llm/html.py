"""Main text of web pages: blocks judged by stop words, length and links, undecided ones by their neighbours."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from html import unescape

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.arrow import widen

# Frequent function words of English, German, French and Spanish.
STOP_WORDS = frozenset(
    """
    a about after all also an and any are as at be because been but by can could do for from had has have he her his how i if in
    into is it its may more most my no not of on one only or other our out over she should so some such than that the their them
    then there these they this to up was we were what when which who will with would you your
    aber als am an auch auf aus bei bin bis da dann das dass dem den der des die doch durch ein eine einem einen einer er es für
    hat haben ich im in ist ja kann man mein mit nach nicht noch nur oder sein sich sie sind so über um und uns unter von vor war
    was weil wenn werden wie wir wird zu zum zur
    au aux avec ce cette ces comme dans de des donc du elle en entre est et il ils je la le les leur lui mais ne nous on ont ou où
    par pas plus pour qui que sa se ses son sont sur un une vous y à
    al como con cuando de del desde donde el ella en entre era es esta este la las lo los más mi muy no nos o para pero por porque
    que se ser si sin sobre son su sus también un una uno y ya
    """.split()
)
# HTML elements by their part in a page.
RAW = frozenset(("script", "style", "textarea", "title"))
EMBEDDED = frozenset(("noscript", "template", "svg", "iframe", "select", "object", "canvas", "audio", "video"))
BARRED = frozenset(("nav", "header", "footer", "aside", "form", "menu", "dialog", "button", "head", "fieldset", "label"))
MAIN = frozenset(("article", "main"))
BLOCK = frozenset(
    """
    address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form
    h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot
    th thead tr ul button
    """.split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Words in class, id and role that mark furniture.
FURNITURE = frozenset(
    """
    ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies
    copyright disqus footer header login masthead menu menus modal nav navbar navigation newsletter notice notices overlay pager
    pagination popup promo promoted promotion recommended related reply replies search share sharing sidebar signup skip social
    sponsor sponsored subscribe tags toolbar widget contentinfo complementary alert disclaimer
    """.split()
)

# First words of a class that say how a page is laid out or filed, not what the element is.
LAYOUT = frozenset("category cat col format has hide hides is js no not tag topic type with without".split())

TAG = re.compile(r"</?[a-z]", re.IGNORECASE)
NAME = re.compile(r"[^\s/>]+")
ATTRIBUTES = re.compile(r"""(?:[^>"']++|"[^"]*"|'[^']*')*+>""")
MARKED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.IGNORECASE)
HIDDEN = re.compile(r"""(?:^|\s)hidden(?:[\s=/]|$)|display\s*:\s*none|aria-hidden\s*=\s*["']?true""", re.IGNORECASE)
PART = re.compile(r"[a-z]+")
CLASS = re.compile(r"[^\s]+")
WORD = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class Rules:
    short: int = 70  # characters below which a block outside an article stays undecided
    long: int = 200  # characters from which many stop words are enough
    links: float = 0.4  # share of characters in links that makes a block furniture
    few: float = 0.12  # shares of stop words
    many: float = 0.2
    listed: float = 0.04  # share on a page below which its language is none of the listed ones


@dataclass
class Block:
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    barred: bool = False
    main: int = 0  # number of the article it lies in, 0 outside of any

    def text(self) -> str:
        return " ".join("".join(self.parts).split())


def _is_furniture(word: str, whole: bool) -> bool:
    if word in FURNITURE:
        return True
    parts = PART.findall(word)
    return not whole and bool(parts) and parts[0] not in LAYOUT and (parts[0] in FURNITURE or parts[-1] in FURNITURE)


def _furniture(attrs: str, whole: bool) -> bool:
    """Whether attributes hide an element or name it furniture; ``whole``: only by words that are one class."""
    if not attrs:
        return False
    if HIDDEN.search(attrs):
        return True
    return any(_is_furniture(w, whole) for a, b, c in MARKED.findall(attrs) for w in CLASS.findall((a or b or c).lower()))


def tokens(html: str) -> Iterator[tuple[str, str, str]]:
    """Texts ('', '', text) and tags ('<' or '</', name, attributes), in one forward pass over the page.

    Comments, declarations and the content of scripts, styles, text areas and titles are left out,
    to the end of the page where they have none. A tag that never ends is text; one with an open
    quote ends at its first '>'. Each search that can fail is tried once after it failed, so time is
    linear in the page, whatever its markup.
    """
    at, size, last_end = 0, len(html), html.rfind(">")
    while at < size:
        begin = html.find("<", at)
        if begin < 0 or begin > last_end:
            # Comments may be open to the end; any other '<' past the last '>' is text.
            stop = html.find("<!--", at)
            yield "", "", html[at : stop if stop >= 0 else size]
            return
        if begin > at:
            yield "", "", html[at:begin]
        if html.startswith("<!--", begin):
            end = html.find("-->", begin + 4)
            at = end + 3 if end >= 0 else size
        elif html[begin + 1 : begin + 2] in ("!", "?"):
            at = html.index(">", begin) + 1
        elif not TAG.match(html, begin):
            yield "", "", "<"
            at = begin + 1
        else:
            kind = "</" if html[begin + 1] == "/" else "<"
            name = NAME.match(html, begin + len(kind))
            inside = ATTRIBUTES.match(html, name.end())
            at = inside.end() if inside else html.find(">", name.end()) + 1
            word = name.group().lower()
            yield kind, word, html[name.end() : at - 1]
            if kind == "<" and word in RAW:
                end = re.compile(f"</{word}(?=[\\s/>])", re.IGNORECASE).search(html, at)
                at = end.start() if end else size


def blocks_of(html: str) -> list[Block]:
    """Runs of text between block elements, in page order. Broken markup is read as browsers mostly do.

    An embedded element (a drop-down list, a video) ends with its parent at the latest; one that is
    closed in its own tag or nowhere on the page holds nothing.
    """
    out, now = [], Block()
    open_: list[tuple[str, bool, int]] = []  # element, whether it is furniture, its article
    depth: Counter[str] = Counter()  # open elements by name
    ends: dict[str, int] = {}  # number of the last end tag of each embedded element
    links = articles = 0
    read = list(tokens(html))
    for i, (kind, name, _) in enumerate(read):
        if kind == "</" and name in EMBEDDED:
            ends[name] = i

    def turn() -> None:
        nonlocal now
        if now.parts:
            out.append(now)
        _, barred, main = open_[-1] if open_ else ("", False, 0)
        now = Block(barred=barred, main=main)

    def leave() -> None:
        depth[open_.pop()[0]] -= 1

    for i, (kind, name, attrs) in enumerate(read):
        if not kind:
            text = unescape(attrs)
            now.parts.append(text)
            if links:
                now.linked += len(text)
            continue
        if kind == "</":
            if name == "a":
                links = max(0, links - 1)
            if depth[name]:
                while open_[-1][0] != name:
                    leave()
                leave()
            if name in BLOCK:
                turn()
            elif now.barred != (open_[-1][1] if open_ else False):
                turn()
            continue
        if name == "br":
            now.parts.append("\n")
            continue
        if name in VOID:
            if name in BLOCK:
                turn()
            continue
        if name == "a":
            links = 1  # links do not nest
            continue
        block, embedded = name in BLOCK, name in EMBEDDED
        if name in RAW or (embedded and ends.get(name, -1) < i) or (attrs.endswith("/") and not block):
            continue
        marked = embedded or _furniture(attrs, whole=name in MAIN)
        if not block and not marked:
            continue
        if block and name not in ("option", "optgroup") and open_ and open_[-1][0] in ("select", "option", "optgroup"):
            while open_ and open_[-1][0] in ("select", "option", "optgroup"):
                leave()  # a list never holds blocks: its end tag is missing
        if block and open_ and open_[-1][0] == name and name in ("p", "li", "dd", "dt", "td", "th", "tr", "option"):
            leave()  # an open paragraph or list item ends where the next begins
        elif block and open_ and open_[-1][0] == "p":
            leave()
        _, barred, main = open_[-1] if open_ else ("", False, 0)
        if name in MAIN and not barred:
            articles += not main
            main = main or articles
        # The header of an article holds its title; a class can still mark it.
        barred = barred or marked or (name in BARRED and not (name == "header" and main))
        if name in ("body", "html"):
            barred = False
        open_.append((name, barred, main))
        depth[name] += 1
        links = 0 if block else links
        turn()
    turn()
    return out


def classify(blocks: Sequence[tuple[Block, str]], rules: Rules) -> list[bool]:
    """Whether each block (with its text) is main text: decided by rules first, then by the nearest decided blocks."""
    verdict: list[bool | None] = []
    stops, sizes = [], []
    for _, text in blocks:
        words = WORD.findall(text.lower())
        stops.append(sum(w in STOP_WORDS for w in words))
        sizes.append(len(words))
    own = [i for i, (block, _) in enumerate(blocks) if not block.barred]
    # In a language whose stop words are not listed, length and links decide.
    listed = sum(stops[i] for i in own) >= rules.listed * sum(sizes[i] for i in own)
    for (block, text), n, size in zip(blocks, stops, sizes):
        dense = n / size if size else 0.0
        if not listed:
            dense = rules.many if len(text) >= rules.long else rules.few
        linked = block.linked / max(1, len(text)) > rules.links
        short = len(text) < rules.short
        if block.barred or (linked and (short or not block.main or dense < rules.few)) or ("©" in text and not block.main and len(text) < rules.long):
            verdict.append(False)
        elif block.main:
            verdict.append(True if dense >= rules.few or len(text) >= rules.short else None)
        elif len(text) < rules.short:
            verdict.append(False if block.linked else None)
        elif dense >= rules.many and len(text) >= rules.long:
            verdict.append(True)
        elif dense >= rules.few:
            verdict.append(None if len(text) < rules.long else True)
        else:
            verdict.append(False)
    out = []
    size = len(verdict)
    before: list[int] = []  # nearest decided block at or before, inside the same article
    last: dict[int, int] = {}
    for i, (block, _) in enumerate(blocks):
        if verdict[i] is not None and not block.barred:
            last[block.main] = i
        before.append(last.get(block.main, -1))
    after, last = [0] * size, {}
    for i in range(size - 1, -1, -1):
        if verdict[i] is not None and not blocks[i][0].barred:
            last[blocks[i][0].main] = i
        after[i] = last.get(blocks[i][0].main, -1)
    for i, known in enumerate(verdict):
        if known is None:
            a, b = before[i], after[i]
            if a < 0 and b < 0:
                known = blocks[i][0].main > 0
            elif a < 0 or b < 0:
                known = verdict[max(a, b)]
            else:  # the nearer one; of equally near ones main text wins
                known = verdict[a] or verdict[b] if i - a == b - i else verdict[a if i - a < b - i else b]
        out.append(bool(known))
    return out


def main_text(html: str | None, rules: Rules = Rules()) -> str:
    blocks = [(b, t) for b in blocks_of(html or "") if (t := b.text())]
    return "\n\n".join(t for (_, t), keep in zip(blocks, classify(blocks, rules)) if keep)


def extract(pages: DataFrame, *, html: str = "html", rules: Rules = Rules(), carry: Sequence[str] | None = None) -> DataFrame:
    """Add ``text``, the main text of every page, and ``n_chars``, its code points.

    Blocks are runs of text between block elements, with character references decoded and white
    space made one space; those kept are joined by an empty line. Navigation, headers, footers,
    asides, forms, hidden elements and elements whose class, id or role names furniture (adverts,
    comments, notices and the like; the first or last part of a compound counts, except in `article` and
    `main`, where only whole words do) are never main text. Other blocks are first judged by links,
    length and stop words, and undecided ones take the verdict of the nearest decided blocks, within
    their article if they lie in one. Null, empty and text-free pages give an empty text. Rows stay
    where they are, repeated rows are read alike; columns called text and n_chars are replaced.
    """

    def make():
        def work(values):
            texts = [main_text(v, rules) for v in values]
            return texts, [len(t) for t in texts]

        return work

    return widen(pages.withColumn(html, F.col(html).cast("string")), html, "text string, n_chars long", make, carry)
