"""Main text of web pages by two passes of block rules.

A page is cut into blocks of text at block-level tags.  The first pass decides by link density, stop-word
density and length: blocks of links are boilerplate, long blocks with enough stop words content.  Elements that are
for something else than text (menus, forms, adverts and the like) are boilerplate as a whole.  What
is left are short blocks and those with mixed signs; in the second pass they take the label of the nearest
decided block before or after.  Inside an article only blocks of the article count as
neighbours, and where these do not tell a block is content; elsewhere it is boilerplate.

Stop words are the short words that many pages of the table hold, and those of four languages.  On
a page in a language that neither knows, length and links decide alone.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Link density from which a block is not content, and from which it is boilerplate inside an article; length from
#: which a block is judged by its words, share of stop words from which it is content.
MAX_LINKS = 0.33
ALL_LINKS = 0.9
SHORT = 70
MIN_STOP_WORDS = 0.2
#: Share of stop words in the long blocks of a page below which its language is not known, and length of
#: the blocks that are content then.
KNOWN_STOP_WORDS = 0.05
LONG = 140
#: Learned stop words: letters at most, share of pages at least, and how many are kept.
STOP_LETTERS = 5
STOP_PAGES = 0.02
STOP_COUNT = 400

# Common function words of four languages.
STOP_WORDS = frozenset(
    "a and are as at be by for from he in is it of on or that the this to was with "
    "au aux avec ce dans de des du elle en est et il la le les on ou par pas pour que qui sur un une "
    "als auf das dem den der des die ein eine für im in ist mit nicht sich und von zu "
    "al con de del el en es la las lo los no para por que se su un una y".split()
)
# Elements by what they are for.
SKIPPED = frozenset("script style noscript template svg iframe object select textarea button canvas math head audio video".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ITEMS = HEADINGS | frozenset("p li dt dd td th tr option".split())
BOILERPLATE_TAGS = frozenset("nav footer aside form header menu dialog label".split())
ARTICLE_TAGS = frozenset("article main".split())
BOILERPLATE_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion nav navigation navbar menu breadcrumb breadcrumbs "
    "sidebar aside footer header masthead cookie cookies consent notice notices alert popup modal overlay comment comments respond replies "
    "gdpr disqus share sharing social related recommended newsletter subscribe subscription signup login pagination pager widget toolbar copyright legal".split()
)
# Words that may stand beside those in a name without changing what it says.
NEUTRAL_NAMES = frozenset(
    "site page main article post posts story entry box block area wrapper wrap container inner outer list items item links link bar row col column "
    "section region slot unit button buttons icons form text content top bottom left right global primary secondary small large user users reader readers customer visitor policy next previous prev".split()
)
#: Elements that are never boilerplate by name, nor is what encloses them.
KEPT_TAGS = frozenset("html body main article".split())
#: Two such words together in a class or id name the body of an article.
ARTICLE_NAMES, BODY_NAMES = frozenset("article story post entry".split()), frozenset("body content text".split())
BOILERPLATE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|</?[a-zA-Z!?][^>]*(?:>|\Z)"
    r"|(?P<text>[^<]+|<)",
    re.DOTALL,
)
_BLOCK_TAG = re.compile(rf"</?(?:{'|'.join(sorted(BLOCKS | {'body'}, key=len, reverse=True))})(?=[\s/>])", re.IGNORECASE)
_OPTIONS_END = re.compile(_BLOCK_TAG.pattern.replace("|option|", "|"), re.IGNORECASE)
_HEAD_END = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<whole>script|style|noscript|template|title)\b.*?(?:</(?P=whole)\s*>|\Z)|(?P<stop>{_BLOCK_TAG.pattern})",
    re.DOTALL | re.IGNORECASE,
)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NAMES = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")
_WORDS = re.compile(r"[^\W\d_]+")
_RIGHTS = re.compile(r"©|\bcopyright\b|\ball rights reserved\b", re.IGNORECASE)


class Block:
    """Text, how much of it is linked, whether it stands in boilerplate or an article, whether it is a heading."""

    __slots__ = ("text", "linked", "boilerplate", "article", "heading")

    def __init__(self, text: str, linked: int, boilerplate: bool, article: bool, heading: bool):
        self.text, self.linked, self.boilerplate, self.article, self.heading = text, linked, boilerplate, article, heading


class Open:
    """Open elements of a page, innermost last: name, boilerplate, article, link (each from here on), place of the tag.

    Places of each name and of the blocks are kept, so an end tag costs the elements it closes.
    """

    def __init__(self) -> None:
        self.elements: list[tuple[str, bool, bool, bool, int]] = [("", False, False, False, -1)]
        self.depths: dict[str, list[int]] = {}
        self.blocks: list[int] = [0]

    @property
    def last(self) -> tuple[str, bool, bool, bool, int]:
        return self.elements[-1]

    def add(self, *element) -> None:
        self.depths.setdefault(element[0], []).append(len(self.elements))
        if element[0] in BLOCKS:
            self.blocks.append(len(self.elements))
        self.elements.append(element)

    def cut(self, depth: int) -> None:
        while len(self.elements) > depth:
            name = self.elements.pop()[0]
            self.depths[name].pop()
            if name in BLOCKS:
                self.blocks.pop()

    def close(self, name: str) -> None:
        """End tag: an inline one never closes a block."""
        depths = self.depths.get(name)
        if depths and (name in BLOCKS or depths[-1] > self.blocks[-1]):
            self.cut(depths[-1])

    def start_item(self, name: str) -> None:
        """A new paragraph or item ends an open one of its kind, and the inline elements in it."""
        depth = self.blocks[-1]
        if depth and self.elements[depth][0] in (name, "p"):
            self.cut(depth)


def _named_boilerplate(value: str, allowed: set[str]) -> bool:
    """Whether one of the names in a class or id says boilerplate as a whole, not by one of its words."""
    for name in value.split():
        words = _words_of(name)
        if words <= BOILERPLATE_NAMES | NEUTRAL_NAMES and (BOILERPLATE_NAMES - allowed).intersection(words):
            return True
    return False


def _is_boilerplate(name: str, attributes: list[tuple[str, str]], in_article: bool) -> tuple[bool, bool]:
    """Whether an element is for something else than text, and whether only its name or class says so.

    The head of an article belongs to it.
    """
    allowed = {"header"} if in_article else set()
    for key, value in attributes:
        value = value.lower()
        if key == "role" and value in BOILERPLATE_ROLES or key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and _HIDDEN.search(value):
            return True, False
    if name in KEPT_TAGS:
        return False, False
    named = name in BOILERPLATE_TAGS - allowed or any(key in ("class", "id") and _named_boilerplate(value, allowed) for key, value in attributes)
    return named, named


def _is_article(name: str, attributes: list[tuple[str, str]]) -> bool:
    if name in ARTICLE_TAGS:
        return True
    for key, value in attributes:
        if key == "role" and value.lower() == "main" or key == "itemprop" and value == "articleBody":
            return True
        if key in ("class", "id"):
            words = _words_of(value)
            if ARTICLE_NAMES.intersection(words) and BODY_NAMES.intersection(words):
                return True
    return False


def _words_of(value: str) -> set[str]:
    return {w.lower() for w in _NAMES.findall(value)}


def _attributes(text: str) -> list[tuple[str, str]]:
    return [(key.lower(), "".join(values)) for key, *values in _ATTRIBUTE.findall(text)] if text.strip() else []


def _after_skipped(page: str, name: str, at: int) -> int:
    """Where the page goes on after the start tag of a skipped element that ends at ``at``."""
    end = re.compile(rf"</{name}\s*>", re.IGNORECASE).search(page, at)
    if name in ("script", "style"):
        return end.end() if end else len(page)
    if name == "head":
        stop = next((m for m in _HEAD_END.finditer(page, at) if m["stop"]), None)
        # A block tag ends the head even without an end tag; an end tag after it belongs to no head.
        return stop.start() if stop and not (end and end.start() <= stop.start()) else end.end() if end else len(page)
    again = re.compile(rf"<{name}[\s>]", re.IGNORECASE).search(page, at, end.start() if end else len(page)) if name in ("button", "select") else None
    if end and not again:
        return end.end()
    # Left open: what follows the next block tag is not part of it.
    stop = (_OPTIONS_END if name == "select" else _BLOCK_TAG).search(page, at, again.start() if again else len(page))
    return stop.start() if stop else again.start() if again else at


def blocks_of(page: str) -> list[Block]:
    """Blocks in page order.

    An element that proves to enclose the page's body, main part or article is not boilerplate by name:
    then the page is read again.
    """
    found, named, enclosing = _read_blocks(page, set())
    return _read_blocks(page, named & enclosing)[0] if named & enclosing else found


def _read_blocks(page: str, spared: set[int]) -> tuple[list[Block], set[int], set[int]]:
    """Blocks, places of the start tags that are boilerplate by name, and of those that enclose a kept element."""
    found: list[Block] = []
    named: set[int] = set()
    enclosing: set[int] = set()
    opened = Open()
    parts: list[str] = []
    linked, skip, at = 0, "", 0

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                name, boilerplate, article, _, _ = opened.elements[opened.blocks[-1]]
                _, inner, in_article, _, _ = opened.last
                found.append(Block(text, linked, boilerplate or inner, article or in_article, name in HEADINGS))
            parts.clear()
        linked = 0

    while at < len(page):
        token = _TOKEN.match(page, at)
        place, at = at, token.end()
        text, name = token["text"], token["name"]
        if text is not None:
            parts.append(text)
            if opened.last[3]:
                linked += len(" ".join(html.unescape(text).split()))
            continue
        if name is None:
            continue
        name = name.lower()
        if token["close"]:
            if name in BLOCKS:
                flush()
            opened.close(name)
            continue
        if name in SKIPPED:
            if not token["rest"].endswith("/"):
                at = _after_skipped(page, name, at)
            parts.append(" ")
            continue
        if name == "br" or name in BLOCKS:
            if name == "br":
                parts.append(" ")
            else:
                flush()
        if name in VOID:
            continue
        if name in ITEMS:
            opened.start_item(name)
        _, boilerplate, article, link, _ = opened.last
        attributes = _attributes(token["rest"]) if name != "a" else []
        if name in KEPT_TAGS:
            for element in reversed(opened.elements):
                if element[4] in enclosing:
                    break
                enclosing.add(element[4])
        other, by_name = _is_boilerplate(name, attributes, article)
        if by_name:
            named.add(place)
            other = place not in spared
        opened.add(name, boilerplate or other, article or _is_article(name, attributes), link or name == "a", place)
    flush()
    return found, named, enclosing


def _share(words: list[str], stop_words: frozenset[str]) -> float:
    return sum(w in stop_words for w in words) / len(words) if words else 0.0


def _words(text: str) -> list[str]:
    return [w.lower() for w in _WORDS.findall(text)]


def language_known(blocks: list[Block], stop_words: frozenset[str]) -> bool:
    """Whether the long blocks of a page hold any stop words to speak of."""
    return _share([w for b in blocks if not b.boilerplate and len(b.text) >= SHORT for w in _words(b.text)], stop_words) >= KNOWN_STOP_WORDS


def first_pass(block: Block, stop_words: frozenset[str] = STOP_WORDS, known: bool = True) -> bool | None:
    """True: content, False: boilerplate, None: open."""
    n = len(block.text)
    if block.boilerplate:
        return False
    if block.article:
        # A heading may link to its own page, a paragraph of some links to what it tells of.
        if block.linked > ALL_LINKS * n and not block.heading:
            return False
        return True if n >= SHORT and block.linked <= MAX_LINKS * n and (not known or _share(_words(block.text), stop_words) >= MIN_STOP_WORDS) else None
    if block.linked > MAX_LINKS * n or n < SHORT and _RIGHTS.search(block.text):
        return False
    if n < SHORT:
        return None
    if not known:
        return True if n >= LONG else None
    return _share(_words(block.text), stop_words) >= MIN_STOP_WORDS


def _nearest(labels: list[bool | None]) -> Iterator[tuple[tuple[int, bool], tuple[int, bool]]]:
    """For each block, distance and label of the decided ones before and after; a distance beyond all if there is none."""
    n = len(labels)
    before, after = [(n + 1, False)] * n, [(n + 1, False)] * n
    for order, near in ((range(n), before), (range(n - 1, -1, -1), after)):
        last = None
        for i in order:
            if labels[i] is not None:
                last = i
            if last is not None:
                near[i] = (abs(i - last), labels[last])
    return zip(before, after)


def second_pass(labels: list[bool | None], articles: list[bool] | None = None, linked: list[bool] | None = None) -> list[bool]:
    """Open blocks take the label of the nearest decided one.

    Without any, or where two equally near ones disagree, a block is boilerplate.  ``articles`` marks
    blocks of an article, which are decided first and by each other: an open one is boilerplate if it stands between
    two boilerplate blocks, or beside one without any content and is ``linked`` itself; else it is content.
    """
    n = len(labels)
    articles, linked = articles or [False] * n, linked or [False] * n
    inside = [i for i in range(n) if articles[i]]
    labels = list(labels)
    for i, ((back, earlier), (ahead, later)) in zip(inside, list(_nearest([labels[i] for i in inside]))):
        if labels[i] is None:
            sides = [label for distance, label in ((back, earlier), (ahead, later)) if distance <= len(inside)]
            labels[i] = not sides or any(sides) or len(sides) == 1 and not linked[i]
    out = []
    for label, ((back, earlier), (ahead, later)) in zip(labels, list(_nearest(labels))):
        out.append(label if label is not None else earlier if back < ahead else later if ahead < back else earlier and later)
    return out


def labelled(page: str | None, stop_words: frozenset[str] = STOP_WORDS) -> list[tuple[Block, bool | None, bool]]:
    """Blocks of a page with their labels after the first and the second pass."""
    blocks = blocks_of(page or "")
    known = language_known(blocks, stop_words)
    first = [first_pass(b, stop_words, known) for b in blocks]
    return list(zip(blocks, first, second_pass(first, [b.article and not b.boilerplate for b in blocks], [b.linked > MAX_LINKS * len(b.text) for b in blocks])))


def main_text(page: str | None, stop_words: frozenset[str] = STOP_WORDS) -> str:
    """Content blocks joined by an empty line; an empty string if there is none."""
    return "\n\n".join(b.text for b, _, keep in labelled(page, stop_words) if keep)


def learned_stop_words(df: DataFrame, page: str = "html") -> frozenset[str]:
    """Short words that at least ``STOP_PAGES`` of all pages hold, the ``STOP_COUNT`` most frequent of them."""
    plain = F.regexp_replace(F.col(page).cast("string"), r"(?is)<(script|style)\b.*?(</\1\s*>|\z)|<!--.*?-->|<[^>]*>|&[a-z0-9#]+;", " ")
    words = F.array_distinct(F.filter(F.split(F.lower(plain), r"[^\p{L}]+"), lambda w: F.length(w).between(1, STOP_LETTERS)))
    held = df.filter(F.col(page).isNotNull()).select(words.alias("words"))
    counts = held.select(F.explode("words").alias("word")).groupBy("word").agg(F.count("*").alias("pages"))
    least = held.count() * STOP_PAGES
    found = counts.filter(F.col("pages") >= max(least, 2)).orderBy(F.desc("pages"), "word").limit(STOP_COUNT)
    return frozenset(r["word"] for r in found.collect())


def extract(df: DataFrame, page: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """Columns ``keep`` and ``text``, the main text of every row; a null page is an empty one.

    Stop words are counted over all pages first, then one narrow stage.  Rows, repeated ones included, are read one by one; other columns are not read.
    """
    names = [f"kept_{i}" for i in range(len(keep))]
    stop_words = STOP_WORDS | learned_stop_words(df, page)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([main_text(x.as_py(), stop_words) for x in batch.column(len(names))], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], texts], names=[*names, "text"])

    rows = df.select(*(F.col(k).alias(n) for k, n in zip(keep, names)), F.col(page).cast("string").alias("page"))
    kinds = ", ".join(f"{n} {df.schema[k].dataType.simpleString()}" for k, n in zip(keep, names))
    found = rows.mapInArrow(run, f"{kinds}, text string")
    return found.select(*(F.col(n).alias(k) for k, n in zip(keep, names)), "text")
