"""Main text of web pages by two passes of block rules.

A page is cut into blocks at block-level tags. The first pass decides a block
from its length, its share of characters inside links and its share of stop
words, or from the part of the page it stands in (menu, footer, advert and the
like). Stop words speak for the block they stand in only: a long block of sentences without any is of a language that the
rules do not know, and length and links decide it. Short blocks, and long ones of middling stop-word share, stay undecided; in the second pass they take
the label of the nearest decided block, counting blocks of the same part of the page as nearer than any other. Lists of
links label short blocks only, never a long plain one or sentences in an unknown language.

Time and memory are linear in the page, however deep its tags are nested and however many stay open.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from recordset.llm.frames import map_text

# Function words of the languages the rules know.
STOP_WORDS = frozenset("""
the of and to a in is that for it was on are as with be by this at from or an have not they which you were but
der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach
de la le les et des en un une du que est dans qui par pour au sur pas plus ce il avec sont ou se son ne
el los y las del se por con para su al lo como más pero sus
""".split())
BLOCK_TAGS = frozenset("""
address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form
h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul
""".split())
# Parts of a page that are not the article, by tag.
CHROME_TAGS = frozenset("nav footer aside form menu dialog select button fieldset".split())
# Parts whose content is no text of the page at all.
SKIPPED_TAGS = frozenset("head title noscript template svg math iframe object canvas audio video textarea".split())
ARTICLE_TAGS = frozenset(("article", "main"))
VOID_TAGS = frozenset("area base br col embed hr img input link meta source track wbr".split())
# Parts of a page that are not the article, by a word of their class, id or role.
CHROME_WORDS = frozenset("""
ad ads advert advertisement adverts advertising banner breadcrumb breadcrumbs byline comment comments consent cookie cookies
copyright disclaimer disqus footer gdpr header login masthead menu modal nav navbar navigation newsletter notice notices pagination
popup popover promo promoted related replies reply respond search share sharing sidebar signup social sponsor sponsored subscribe
subscription tags toolbar widget widgets complementary contentinfo search dialog
""".split())

MIN_LENGTH = 70  # characters below which the first pass leaves a block undecided
LONG = 200
LINK_SHARE = 0.4
STOP_SHARE_LOW, STOP_SHARE_HIGH = 0.05, 0.15

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|<(?P<raw>script|style|xmp|noembed)\b[^>]*+(?:>|\Z).*?(?:</(?P=raw)[^>]*+(?:>|\Z)|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*+)(?P<attrs>(?:\"[^\"<]*+\"|'[^'<]*+'|[^\"'<>])*+)>|<[/!?a-zA-Z][^<>]*+(?:>|\Z)",
    re.S | re.I)
NAMED = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
HIDDEN = re.compile(r"""(?:^|\s)hidden(?:[\s=/]|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
PART = re.compile(r"[a-z]+")
# A class like no-sidebar or has-comments says what stands beside the content, not what the element is.
BESIDE = frozenset("no non not has have with without hide show".split())
FIRM_TAGS = frozenset("nav footer menu select button".split())
SENTENCE_END = re.compile(r"[.!?\u2026](?=[\s\"'\u201d\u2019\u00bb)]|$)")
SENTENCE_WORDS = (8, 60)  # least and most words to an end, for a block to be sentences
# Letters of other scripts than Latin, whose languages share no stop words with those the rules know.
OTHER_LETTER = re.compile(r"[^\W\d_a-zA-Z\u00aa-\u024f\u1e00-\u1eff]")


def _names_chrome(name: str) -> bool:
    parts = PART.findall(name)
    return any(w in CHROME_WORDS for w in parts) and not any(w in BESIDE for w in parts)


def _is_chrome(tag: str, attrs: str, in_article: bool) -> int:
    """0: content, 1: chrome unless the page's text stands in it, 2: chrome."""
    if tag in FIRM_TAGS or (attrs and tag not in ARTICLE_TAGS and tag not in ("body", "html") and HIDDEN.search(attrs)):
        return 2
    if tag in CHROME_TAGS or (tag == "header" and not in_article):
        return 1
    if tag in ARTICLE_TAGS or tag in ("body", "html") or not attrs:
        return 0
    return int(any(_names_chrome(x) for m in NAMED.finditer(attrs) for x in (m[1] or m[2] or m[3] or "").lower().split()))


class Block:
    __slots__ = ("text", "linked", "chrome", "part", "article", "box")

    def __init__(self, text: str, linked: int, chrome: bool, part: int, article: bool, box: int):
        self.text, self.linked, self.chrome, self.part, self.article = text, linked, chrome, part, article
        self.box = box  # the innermost chrome container around it, -1 without any


def blocks(page: str) -> tuple[list[Block], list[tuple[int, bool]]]:
    """The blocks of a page, and its chrome containers in page order: the container around each, and whether it is chrome in any case."""
    out: list[Block] = []
    boxes: list[tuple[int, bool]] = []
    stack: list[tuple[str, bool, bool]] = []  # open container, whether it is chrome, whether it is skipped
    open_tags: dict[str, int] = {}  # how many of each name the stack holds
    box = -1
    pieces: list[str] = []
    linked, in_link, part, parts, at = 0, 0, 0, 0, 0
    chrome = skipped = article = 0

    def flush() -> None:
        nonlocal linked
        text = " ".join(html.unescape("".join(pieces)).split())
        if text:
            out.append(Block(text, min(linked, len(text)), chrome > 0, part, article > 0, box))
        pieces.clear()
        linked = 0

    def add(text: str) -> None:
        nonlocal linked
        if not skipped:
            pieces.append(text)
            if in_link:
                linked += len(" ".join(html.unescape(text).split()))

    def pop() -> None:
        nonlocal chrome, skipped, article, box
        tag, c, s = stack.pop()
        open_tags[tag] -= 1
        if c:
            box = boxes[box][0]
        chrome, skipped, article = chrome - c, skipped - s, article - (tag in ARTICLE_TAGS)

    for m in TOKEN.finditer(page):
        if m.start() > at:
            add(page[at:m.start()])
        at = m.end()
        if m["cdata"] is not None:
            add(html.escape(m["cdata"]))
            continue
        if not m["tag"]:
            continue
        tag, attrs = m["tag"].lower(), m["attrs"] or ""
        if tag == "a":
            in_link = 0 if m["close"] else 1
            continue
        if tag == "br":  # a line end is white space, two of them end a block
            if pieces and pieces[-1] == "\n":
                flush()
            elif pieces:
                pieces.append("\n")
            continue
        is_chrome = not m["close"] and _is_chrome(tag, attrs, article > 0)
        container = tag in BLOCK_TAGS or tag in SKIPPED_TAGS or is_chrome
        if not container and not (m["close"] and open_tags.get(tag)):
            continue
        if tag in BLOCK_TAGS or is_chrome or tag in SKIPPED_TAGS:
            flush()
            in_link = 0 if tag != "li" else in_link
        if m["close"]:
            if open_tags.get(tag):
                flush()
                changed = False
                while stack:
                    t = stack[-1]
                    pop()
                    changed |= t[1] or t[0] in ARTICLE_TAGS
                    if t[0] == tag:
                        break
                if changed:
                    parts += 1
                    part = parts
        elif tag not in VOID_TAGS and not attrs.endswith("/"):
            if tag in ARTICLE_TAGS or tag == "body":
                while stack and (chrome or skipped):  # an article ends the menus that nobody closed
                    pop()
            if tag in ("p", "li", "td", "th", "tr", "dt", "dd", "option") and stack and stack[-1][0] == tag:
                pop()  # these end their own kind
            skip = tag in SKIPPED_TAGS
            stack.append((tag, is_chrome > 0, skip))
            open_tags[tag] = open_tags.get(tag, 0) + 1
            if is_chrome:
                boxes.append((box, is_chrome == 2))
                box = len(boxes) - 1
            chrome, skipped, article = chrome + (is_chrome > 0), skipped + skip, article + (tag in ARTICLE_TAGS)
            if is_chrome or tag in ARTICLE_TAGS:
                parts += 1
                part = parts
    if at < len(page):
        add(page[at:])
    flush()
    return out, boxes


def _plain(b: Block, length: int) -> bool:
    return len(b.text) >= length and b.linked <= LINK_SHARE * len(b.text)


def _stop_share(words: list[str]) -> float:
    return sum(w in STOP_WORDS for w in words) / max(len(words), 1)


def _other_script(text: str) -> bool:
    return 2 * len(OTHER_LETTER.findall(text)) > sum(map(str.isalpha, text))


def _foreign(text: str) -> bool:
    """Sentences, by their length, with hardly a stop word that the rules know."""
    words = re.findall(r"\w+", text.lower())
    ends = len(SENTENCE_END.findall(text))
    return ends > 0 and SENTENCE_WORDS[0] * ends <= len(words) <= SENTENCE_WORDS[1] * ends and _stop_share(words) < STOP_SHARE_LOW


def decide(b: Block) -> bool | None:
    """First pass: True for article text, False for boilerplate, None for undecided."""
    if b.chrome or b.linked > LINK_SHARE * len(b.text):
        return False
    if len(b.text) < MIN_LENGTH:
        return None
    share = _stop_share(re.findall(r"\w+", b.text.lower()))
    if share >= STOP_SHARE_HIGH or (len(b.text) >= LONG and share >= STOP_SHARE_LOW):
        return True
    return None


def lift(found: list[Block], boxes: list[tuple[int, bool]]) -> None:
    """Where no long text stands outside the chrome, a container with most of the page's long text is no chrome."""
    if not any(b.chrome for b in found) or any(not b.chrome and _plain(b, LONG) for b in found):
        return
    held = [0] * len(boxes)
    total = 0
    for b in found:
        if _plain(b, LONG):
            total += len(b.text)
            if b.box >= 0:
                held[b.box] += len(b.text)
    for i in range(len(boxes) - 1, -1, -1):  # a container comes after the one around it
        if boxes[i][0] >= 0:
            held[boxes[i][0]] += held[i]
    chrome: list[bool] = []
    for (around, firm), n in zip(boxes, held):
        chrome.append(firm or 2 * n <= total or (around >= 0 and chrome[around]))
    for b in found:
        b.chrome = b.box >= 0 and chrome[b.box]


def _nearest(found: list[Block], first: list[bool | None], no_links: bool) -> list[list[tuple[int, int, bool]]]:
    """For every undecided block (in another part, distance, label is False) of the nearest decided one on either side.

    Blocks of the same part count first. With ``no_links`` lists of links count as undecided.
    """
    near: list[list[tuple[int, int, bool]]] = [[] for _ in found]
    for order in (range(len(found)), range(len(found) - 1, -1, -1)):
        last: int | None = None
        in_part: dict[int, int] = {}
        for i in order:
            b = found[i]
            if first[i] is not None:
                if first[i] or b.chrome or not no_links:
                    last = in_part[b.part] = i
            elif b.part in in_part:
                j = in_part[b.part]
                near[i].append((0, abs(i - j), not first[j]))
            elif last is not None:
                near[i].append((1, abs(i - last), not first[last]))
    return near


def main_text(page: str | None) -> str:
    found, boxes = blocks(page or "")
    lift(found, boxes)
    first = [decide(b) for b in found]
    # Stop words say nothing of a language they are not of: then length and links decide, for the block or, without any known text, the page.
    known = True in first
    for i, b in enumerate(found):
        if first[i] is None and _plain(b, MIN_LENGTH):
            if (not known and len(b.text) >= LONG) or _other_script(b.text) or _foreign(b.text):
                first[i] = True
    near = [_nearest(found, first, False), _nearest(found, first, True)]
    kept = []
    for i, b in enumerate(found):
        label = first[i]
        if label is None:
            choice = min(near[_plain(b, LONG)][i], default=None)
            if choice is None or (choice[0] == 1 and b.article):
                label = True  # nothing in this article, or on this page, speaks against it
            else:
                label = not choice[2]
        if label:
            kept.append(b.text)
    return "\n\n".join(kept)


def extract_main_text(pages: DataFrame, column: str = "html") -> DataFrame:
    """``pages`` with ``text`` and ``n_chars`` in place of the markup column.

    Whole pages are parsed; a null or empty page, and one without article text, has the empty text. Unclosed and
    crossed tags, broken attributes and cut-off pages are read as far as they go. Repeated rows are treated alike, an empty table
    gives an empty one, and a column named like a new one is replaced by it.
    """
    def make():
        def extract(col: pa.Array) -> list:
            texts = [main_text(x) for x in col.to_pylist()]
            return [texts, [len(t) for t in texts]]

        return extract

    return map_text(pages, column, make, [T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())]).drop(column)
