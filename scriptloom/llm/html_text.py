"""Main text of web pages by two passes over their blocks.

A page is cut into blocks at block-level tags. First pass: each block is good, bad, short or near
good by its length, the density of stop words and the share of its characters inside links. Second
pass: short and near-good blocks inherit the label of the nearest decided neighbours. Blocks inside
menus, headers, footers, sidebars, notices, adverts, forms and reader comments (by tag, role or
class) are bad before the first pass. If a page marks its article, only the article's blocks are
judged; there a block without stop words may still be prose in another form (a list, a table, a
language without list), so it is left undecided and inherits from its neighbours in the article,
and an article without any decided block is kept whole.

Defined results: null and empty pages give the empty text; repeated rows give repeated rows; only the
named columns are read. White space in a block becomes one space, blocks are joined by an empty line.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

# Frequent function words of four languages, in order of the alphabet.
STOP_WORDS = frozenset(
    """
    a about after all also an and any are as at be been but by can could do for from had has have he
    her his if in into is it its more most my no not of on one only or other our out over she so some
    such than that the their them then there these they this to up was we were what when which who
    will with would you your
    als am auch auf aus bei bis das dass dem den der des die durch ein eine einem einen einer eines er
    es für hat ich ihr im in ist kann mit nach nicht noch nur oder sich sie sind so über um und unter
    von vor war wenn werden wie wird wir zu zum zur
    au aux avec ce ces cette comme dans de des du elle en est et être il ils je la le les leur lui mais
    ne nous on ont ou où par pas plus pour qu que qui sa se ses son sont sur un une vous
    al algo como con de del desde donde el ella en entre era es esta está este ha hay la las lo los más
    me muy no o para pero por que se ser si sin sobre son su sus también tiene un una y ya
    """.split()
)
# Tags that begin and end a block.
BLOCK_TAGS = frozenset(
    """
    address article aside blockquote body caption center col colgroup dd details dialog dir div dl dt
    fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hr html legend li
    main menu nav ol optgroup option p pre section select summary table tbody td textarea tfoot th
    thead title tr ul
    """.split()
)
RAW_TAGS = ("script", "style", "noscript", "template", "svg", "iframe", "object", "textarea", "title", "select")
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Tags, roles and parts of class names of what is not the article.
AROUND_TAGS = frozenset("nav header footer aside form dialog menu button".split())
AROUND_ROLES = frozenset("navigation banner contentinfo complementary search dialog form alert menu menubar".split())
AROUND_NAMES = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|advert\w*|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|notice|popup|modal|"
    r"newsletter|subscribe|signup|login|nav\w*|menu|breadcrumbs?|pagination|pager|sidebar|side|aside|widget|"
    r"header|footer|foot|masthead|copyright|share|sharing|social|related|recommend\w*|comments?|"
    r"commentlist|disqus|replies|toolbar|skip)(?:$|[\s_-])",
    re.IGNORECASE,
)
CLOSES_P = BLOCK_TAGS - {"body", "html", "head"}
TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:[^"'>]|"[^"]*"|'[^']*')*)>""")
ODD_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>")
ATTRIBUTE = re.compile(r"""(class|id|role|hidden|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.IGNORECASE)
SPACE = re.compile(r"\s+")
WORD = re.compile(r"[^\W\d_]+")

LENGTH_LOW, LENGTH_HIGH = 70, 200
STOPS_LOW, STOPS_HIGH = 0.12, 0.22
LINKS_MOST = 0.3
GOOD, BAD, SHORT, NEAR = "good", "bad", "short", "near"


@dataclass
class Block:
    text: str
    linked: int  # characters inside links
    article: int  # number of the article the block is in, 0 for none
    around: bool  # inside a menu, a form and the like
    heading: bool


def is_around(tag: str, attributes: str) -> bool:
    if tag in AROUND_TAGS:
        return True
    if "=" not in attributes and "hidden" not in attributes:
        return False
    for name, value in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return True
        if name == "role" and value.lower() in AROUND_ROLES:
            return True
        if name in ("class", "id") and tag not in ("html", "body", "main") and AROUND_NAMES.search(value):
            return True
    return False


def cut(page: str) -> list[Block]:
    """The blocks of a page that hold text, in order."""
    blocks: list[Block] = []
    pieces: list[str] = []
    linked = links = articles = article = heading = 0
    stack: list[tuple[str, bool, int]] = []  # open tags that matter, around or not, article outside
    opened: dict[str, int] = {}  # how often each tag is in the stack
    around = 0

    def close() -> None:
        nonlocal linked
        text = SPACE.sub(" ", entities.unescape("".join(pieces))).strip()
        if text:
            blocks.append(Block(text, min(linked, len(text)), article, around > 0, heading > 0))
        pieces.clear()
        linked = 0

    def leave(tag: str) -> None:
        """Close the innermost open ``tag`` and what is open inside it."""
        nonlocal around, article
        if not opened.get(tag):
            return
        for at in range(len(stack) - 1, -1, -1):
            if stack[at][0] == tag:
                for name, was_around, _ in stack[at:]:
                    around -= was_around
                    opened[name] -= 1
                article = stack[at][2]
                del stack[at:]
                return

    at, size = 0, len(page)
    while at < size:
        mark = page.find("<", at)
        if mark < 0:
            mark = size
        if mark > at:
            pieces.append(page[at:mark])
            if links:
                linked += mark - at
        if mark == size:
            break
        if page.startswith("<!--", mark):
            end = page.find("-->", mark + 4)
            at = size if end < 0 else end + 3
            continue
        if page.startswith(("<!", "<?"), mark):
            end = page.find(">", mark)
            at = size if end < 0 else end + 1
            continue
        found = TAG.match(page, mark) or ODD_TAG.match(page, mark)
        if not found:
            if re.match(r"</?[a-zA-Z]", page[mark : mark + 3]):
                break  # a tag that the end of the page cuts off
            pieces.append("<")
            at = mark + 1
            continue
        at = found.end()
        closing, tag, attributes = found[1], found[2].lower(), found[3]
        if tag in RAW_TAGS and not closing:
            if not attributes.endswith("/"):
                end = re.compile(f"</{tag}\\b[^>]*>", re.IGNORECASE).search(page, at)
                at = end.end() if end else size
            if tag in BLOCK_TAGS:
                close()
            continue
        if tag == "a":
            links = max(0, links + (-1 if closing else 1))
        elif tag == "br":
            pieces.append(" ")
        if tag in BLOCK_TAGS:
            close()
            links = 0 if tag in ("p", "div", "li", "article", "nav") else links
            if tag in ("h1", "h2", "h3", "h4", "h5", "h6"):
                heading = 0 if closing else 1
            else:
                heading = 0
        if tag in VOID_TAGS:
            continue
        if closing:
            leave(tag)
        elif tag in ("article", "main") or tag in AROUND_TAGS or attributes or tag in ("div", "section", "ul", "ol", "table"):
            if tag in BLOCK_TAGS or is_around(tag, attributes):
                if tag in ("p", "li", "td", "th", "tr", "dd", "dt", "option"):
                    leave_same = stack and stack[-1][0] == tag
                    if leave_same:
                        leave(tag)
                was_around = is_around(tag, attributes)
                if was_around and tag not in BLOCK_TAGS:
                    close()
                stack.append((tag, was_around, article))
                opened[tag] = opened.get(tag, 0) + 1
                around += was_around
                if tag in ("article", "main") and not around and not article:
                    articles += 1
                    article = articles
    close()
    return blocks


def first_pass(block: Block) -> str:
    """The block's own label."""
    size = len(block.text)
    links = block.linked / size
    if block.around or links > LINKS_MOST and not block.heading:
        return BAD
    words = WORD.findall(block.text.lower())
    stops = sum(w in STOP_WORDS for w in words) / len(words) if words else 0.0
    if block.article:
        # prose of the article, or undecided: nothing in it speaks against the block
        return GOOD if size >= LENGTH_LOW and stops >= STOPS_LOW else NEAR
    if size < LENGTH_LOW:
        return BAD if links else SHORT
    if stops >= STOPS_HIGH:
        return GOOD if size > LENGTH_HIGH else NEAR
    return NEAR if stops >= STOPS_LOW else BAD


def second_pass(blocks: list[Block], labels: list[str]) -> list[bool]:
    """Undecided blocks inherit from the nearest decided blocks of their container."""
    keep = []
    n = len(blocks)
    before: list[str | None] = [None] * n
    after: list[str | None] = [None] * n
    for order, out in ((range(n), before), (range(n - 1, -1, -1), after)):
        last: dict[int, str] = {}
        for i in order:
            inside = blocks[i].article
            out[i] = last.get(inside)
            if labels[i] in (GOOD, BAD) and not (inside and blocks[i].around):
                last[inside] = labels[i]
    for i, (block, label) in enumerate(zip(blocks, labels)):
        if label in (GOOD, BAD):
            keep.append(label == GOOD)
        elif block.article:
            keep.append(GOOD in (before[i], after[i]) or before[i] is None and after[i] is None)
        elif block.heading:
            keep.append(after[i] == GOOD)  # a heading goes with what it heads
        elif label == NEAR:
            keep.append(GOOD in (before[i], after[i]))
        else:
            keep.append(before[i] == GOOD and after[i] == GOOD)
    return keep


def main_text(page: str | None) -> str:
    if not page:
        return ""
    blocks = cut(page)
    inside = [b for b in blocks if b.article]
    # blocks outside count where there is no article, or nothing in it is kept
    for some in (inside, blocks):
        keep = second_pass(some, [first_pass(b) for b in some])
        if any(keep):
            return "\n\n".join(b.text for b, kept in zip(some, keep) if kept)
    return ""


def extract(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> DataFrame:
    """Per row: page_id, url, text, n_chars."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, len(batch), 128):
                part = batch.slice(start, 128)
                texts = [main_text(p.as_py()) for p in part.column(2)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())],
                    names=["page_id", "url", "text", "n_chars"],
                )

    chosen = pages.select(
        pages[id_column].cast("long").alias("page_id"), pages[url_column].cast("string").alias("url"),
        pages[html_column].alias("html"),
    )
    return chosen.mapInArrow(run, "page_id long, url string, text string, n_chars long")
