"""Main text of web pages by two passes over blocks.

A page becomes blocks: the text between block-level tags, with its words, the share of
stop words, the share of characters inside links, and its surroundings.  What stands in
scripts, styles, forms, navigation, headers and footers of the page, asides, notices,
adverts and reader comments is told by its element, role or class, and is never text.

Pass 1 looks at each block alone: many linked characters are *bad*; long blocks with many
stop words are *good*; long ones with some, *near*; the rest is *short* or, where it is
long without stop words, *bad* - but inside an article or main element such blocks are
*short*, since tables and lists there have few stop words.

Where a page's running text has hardly any stop word of the languages known here, length, links and
the ends of sentences take their place.  Headings are told by class only where that is a
plain name of surroundings, and an article's sections not by ids that name their subject.

Pass 2 decides *near* and then *short* blocks by the nearest decided neighbours on both
sides: they inherit the label that both have; where these differ, a *near* block is good
and a *short* one bad.  Blocks of an article only look at blocks of articles, and are good unless they
are very short and stand between bad ones; headings before good text are good.

Character references are decoded once, white space within a block becomes one space, and
blocks of text are joined by a line feed.

Nulls and edges: null and empty pages give an empty text.  Broken markup is tolerated:
unclosed elements end with the page or the element around them, a comment, script or style
without an end runs to the end of the page.  No block is dropped or capped for its length.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_limits, read

_TAG = r"<(?:!--(?P<comment>)|(?P<close>/)?(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>(?:[^>\"']|\"[^\"]%s\"|'[^']%s')*+)>|[!?/](?P<other>[^>]*)>)"
TAG, NEAR_TAG = re.compile(_TAG % ("*", "*")), re.compile(_TAG % ("{0,5000}", "{0,5000}"))
#: After so many tags that the page's end leaves open inside quotes, quotes are followed 5,000 characters only.
OPEN_QUOTES = 50
LOOSE = re.compile(r"<(?P<close>/)?(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>[^>]*)>")
ATTR = re.compile(r"(?:^|\s)(class|id|role|hidden|aria-hidden|style|itemprop)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)

RAW = {"script", "style", "noscript", "template", "textarea", "iframe", "title", "xmp", "noembed", "noframes"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCKS = set(
    "address article aside blockquote body button canvas caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav object ol optgroup option p pre search section select summary svg table tbody "
    "td tfoot th thead tr ul video audio math".split()
)
BAD = {"nav", "footer", "aside", "form", "menu", "dialog", "button", "select", "option", "svg", "canvas", "object", "audio", "video", "head", "search", "fieldset"}
BAD_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alertdialog", "alert", "menu", "menubar", "toolbar", "form", "note", "status", "button"}
#: Words that begin the classes and ids of surroundings, alone or before a separator.
_STRONG = (
    r"ads?|adverts?|advertisements?|advertising|adsense|sponsor(?:ed|s)?|promos?|cookies?|gdpr|ccpa|nav|navbar|menus?|breadcrumbs?|sidebars?|side-bar|footer|masthead|topbar|site-?header|page-?header|"
    r"toolbar|comments?|commentlist|disqus|respond|repl(?:y|ies)|share|newsletter|subscribe|signup|sign-up|login|popups?|modals?|overlay|widgets?|pagination|pager|paywall|skip-link|sr-only|visually-hidden|meta-?nav"
)
#: The same, but these may also be what a text is about: with another word they count only where that is one of layout.
_WEAK = r"side|foot|header|banners?|consent|privacy|notices?|alerts?|navigation|discussion|sharing|social|related|recommend(?:ed|ations?)?|promotions?|subscription|hidden|copyright|legal|disclaimer|tags"
_LAYOUT = (
    r"bar|box|wrap|wrapper|container|inner|outer|block|list|links?|area|section|widget|panel|items?|content|nav|menu|row|col|column|text|title|heading|header|footer|icons?|buttons?|btn|message|msg|"
    r"notice|policy|banner|overlay|popup|modal|posts?|articles?|stories|topics|news|reads?|reading|products|follow|logo|search|image|img|top|bottom|left|right|main|page|site|primary|secondary|media|share|"
    r"form|group|cloud|meta|info|body|warning|danger|success|error|dismissible|fixed|sticky|hidden|visible|active|open|light|dark|small|large|[a-z]*\d+"
)
BAD_NAMES = re.compile(rf"(?:^|\s)(?:(?:{_STRONG})(?:[-_\d][\w-]*)?|(?:{_WEAK})(?:\d+|(?:[-_][\w-]*)?[-_](?:{_LAYOUT}))?)(?=\s|$)", re.I)
STRONG_NAMES = re.compile(rf"(?:^|\s)(?:{_STRONG}|related|social|sharing)(?:[-_\d][\w-]*)?(?=\s|$)", re.I)
#: Sections of an article about relations and the like.
ABOUT = re.compile(rf"(?:^|\s)(?:related|social|sharing)[-_](?!(?:[\w-]*[-_])?(?:{_LAYOUT})(?:\s|$))[\w-]+", re.I)
_HEADING = re.compile(r"h[1-6]")
HIDING = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)

#: Frequent function words of some languages.
STOP_WORDS = frozenset(
    "a about after all also an and are as at be been but by can could do for from had has have he her his how i if in into is it its more no not of on one or other our out "
    "over she so some such than that the their them then there these they this to up was we were what when which who will with would you your "
    "aber als am an auch auf aus bei bin bis da das dass dem den der des die durch ein eine einem einen einer eines er es für hat ich ihr im in ist kann mit nach nicht noch nur "
    "oder sein sich sie sind so über um und uns von vor war was wenn werden wie wir wird zu zum zur "
    "au aux avec ce ces cette comme dans de des du elle en est et eux il ils je la le les leur lui mais me même ne nous on ont ou où par pas plus pour qu que qui sa sans se ses si "
    "son sont sur un une vous y à été "
    "al como con de del desde donde el ella ellos en entre era es esta este esto fue ha hay la las le lo los más me mi muy no nos o para pero por porque que se sin sobre son su sus "
    "también te tiene todo un una uno y ya "
    "che di da dal della gli il nel non per sono che het een van zijn niet op te voor met aan er ook maar dat deze os das dos uma um não ao com mais na nas nos pela pelo".split()
)
STOP_LOW, STOP_HIGH, LINKED, LONG, LENGTH = 0.15, 0.30, 0.3, 200, 70
SENTENCE = re.compile(r"[.!?…。！？।؟۔]")
_TRIM = " .,;:!?\"'()[]*$%&#|"


@dataclass
class Block:
    text: str
    linked: int
    heading: bool
    article: bool
    bad: bool
    label: str = ""


def _surrounding(name: str, attrs: str, in_article: bool) -> bool:
    """Whether an element holds no main text, told by its name, role, class or id."""
    if name in BAD or (name == "header" and not in_article):
        return True
    if "=" not in attrs and "hidden" not in attrs:
        return False
    for m in ATTR.finditer(attrs):
        key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if key == "role" and value.lower() in BAD_ROLES:
            return True
        if key == "hidden" or (key == "aria-hidden" and value.lower() == "true") or (key == "style" and HIDING.search(value)):
            return True
        if key in ("class", "id") and name not in ("html", "body", "main", "article"):
            # an id of a heading or of an article's section is what it is about
            anchor = name == "section" and in_article and key == "id"
            if _HEADING.fullmatch(name):
                if key == "class" and STRONG_NAMES.search(value):
                    return True
            elif (STRONG_NAMES if anchor else BAD_NAMES).search(value) and not (anchor and ABOUT.search(value)):
                return True
    return False


def page_blocks(html: str) -> list[Block]:
    out: list[Block] = []
    stack: list[tuple[str, bool, bool]] = []  # element, inside an article, inside what is no text
    parts: list[str] = []
    linked = 0
    in_link = False
    heading = False
    article = bad = False
    at, n = 0, len(html)
    opened: Counter[str] = Counter()  # how many of each element the stack has
    skipped, depth, floor = "", 0, 0  # an inline surrounding, how often it is nested, and the stack's height there
    ends: dict[str, int] = {}  # where the last end tag of an element's name is
    open_quotes = 0

    def add(text: str) -> None:
        nonlocal linked
        if skipped:
            return
        if "&" in text:
            text = entities.unescape(text)
        parts.append(text)
        if in_link:
            linked += len(text)

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                out.append(Block(text, linked, heading, article, bad))
            parts.clear()
        linked = 0

    while at < n:
        lt = html.find("<", at)
        if lt < 0:
            add(html[at:])
            break
        if lt > at:
            add(html[at:lt])
        m = (TAG if open_quotes < OPEN_QUOTES else NEAR_TAG).match(html, lt)
        if m is None:
            m = LOOSE.match(html, lt)
            open_quotes += m is not None
        if m is None:
            if html.startswith("<", lt) and lt + 1 < n and (html[lt + 1].isalpha() or html[lt + 1] in "/!?") and html.find(">", lt) < 0:
                break  # a tag that the page's end cuts off
            add("<")
            at = lt + 1
            continue
        if m.groupdict().get("comment") is not None:
            end = html.find("-->", lt + 4)
            at = n if end < 0 else end + 3
            continue
        at = m.end()
        if not m["name"]:
            continue
        name, attrs = m["name"].lower(), m["attrs"]
        if m["close"]:
            if name == "a":
                in_link = False
            if name == skipped:
                depth -= 1
                if not depth:
                    skipped, floor = "", 0
            if name in BLOCKS:
                flush()
                if name[0] == "h" and name[1:].isdigit():
                    heading = False
                if opened[name]:
                    while True:
                        gone_name = stack.pop()[0]
                        opened[gone_name] -= 1
                        if gone_name == name:
                            break
                if len(stack) < floor:
                    skipped, floor = "", 0
                _, article, bad = stack[-1] if stack else ("", False, False)
            continue
        if name in RAW:
            end = re.compile(rf"</{name}\s*>", re.I).search(html, at)
            at = end.end() if end else n
            if name in ("textarea", "title", "iframe"):
                flush()
            continue
        if name == "a":
            in_link = not attrs.endswith("/")
        elif name == "br":
            parts.append(" ")
        elif name in BLOCKS:
            flush()
            if name == "p" or name in ("h1", "h2", "h3", "h4", "h5", "h6"):
                in_link = False
            if name[0] == "h" and name[1:].isdigit():
                heading = True
            elif name != "hr":
                heading = heading and name not in ("p", "div", "section", "article", "ul", "ol", "table")
            if name == "body":  # a head without an end stops here
                if opened["head"]:
                    stack = [s for s in stack if s[0] != "head"]
                    opened["head"] = 0
                    skipped, floor = "", 0
                article = bad = False
            if name not in ("p", "hr") and name not in VOID and not attrs.endswith("/"):
                gone = bad or bool(skipped) or _surrounding(name, attrs, article)
                article = article or name in ("article", "main") or "articleBody" in attrs
                bad = gone
                stack.append((name, article, bad))
                opened[name] += 1
                if name in ("li", "td", "th", "dd", "dt", "option", "tr") and len(stack) > 1 and stack[-2][0] == name:
                    del stack[-2]  # the one before was left open
                    opened[name] -= 1
        elif name == skipped:
            depth += not attrs.endswith("/")
        elif not skipped and name not in VOID and name != "a" and attrs and not attrs.endswith("/") and name not in ("b", "i", "em", "strong") and _surrounding(name, attrs, article):
            # an inline element of that kind goes up to its end, or that of the block around it; one without an end stays
            if name not in ends:
                ends[name] = max((e.start() for e in re.finditer(rf"</{re.escape(name)}\s*>", html, re.I)), default=-1)
            if ends[name] >= at:
                skipped, depth, floor = name, 1, len(stack)
    flush()
    return out


def stop_share(text: str) -> float:
    words = text.lower().split()
    return sum(w.strip(_TRIM) in STOP_WORDS for w in words) / len(words) if words else 0.0


def weight(text: str) -> int:
    """Characters, those of scripts without blanks between words counting three times."""
    return len(text) + 2 * sum(c >= "\u2e80" for c in text) if not text.isascii() else len(text)


def foreign(blocks: list[Block]) -> bool:
    """Whether a page's running text is in no language with stop words here."""
    texts = [b.text for b in blocks if not b.bad and b.linked <= LINKED * len(b.text) and weight(b.text) >= LENGTH]
    return bool(texts) and stop_share(" ".join(texts)) < STOP_LOW / 3


def first_pass(b: Block, unknown: bool = False) -> str:
    if unknown:
        return _by_length(b)
    density = b.linked / max(1, len(b.text))
    if b.bad or density > (0.8 if b.article else LINKED):
        return "bad"
    if len(b.text) < LENGTH:
        return "short" if b.article or not b.linked else "bad"
    share = stop_share(b.text)
    if share >= STOP_HIGH:
        return "good" if len(b.text) > LONG else "near"
    if share >= STOP_LOW:
        return "near"
    if b.article:
        return "short"
    return "bad" if "\xa9" in b.text or share < STOP_LOW / 3 else "short"


def _by_length(b: Block) -> str:
    """The label in a language without stop words: by length, links and the ends of sentences."""
    if b.bad or b.linked / max(1, len(b.text)) > (0.8 if b.article else LINKED) or "\xa9" in b.text:
        return "bad"
    if weight(b.text) < LENGTH:
        return "short" if b.article or not b.linked else "bad"
    if not SENTENCE.search(b.text):
        return "short"
    return "good" if weight(b.text) > LONG else "near"


def _nearest(labels: list[str], own: list[int]) -> dict[int, tuple[str, str]]:
    """The labels of the nearest decided blocks before and after each of ``own``."""
    out, last = {}, ""
    for i in own:
        out[i] = last
        last = labels[i] if labels[i] in ("good", "bad") else last
    last = ""
    for i in reversed(own):
        out[i] = (out[i], last)
        last = labels[i] if labels[i] in ("good", "bad") else last
    return out


def second_pass(blocks: list[Block]) -> list[bool]:
    """Whether each block is main text."""
    unknown = foreign(blocks)
    labels = [first_pass(b, unknown) for b in blocks]
    for inside in (True, False):
        own = [i for i, b in enumerate(blocks) if b.article is inside and not b.bad]
        sides = _nearest(labels, own)
        for i in own:
            if labels[i] == "near":
                labels[i] = "bad" if sides[i] == ("bad", "bad") and not inside else "good"
        sides = _nearest(labels, own)
        for i in own:
            if labels[i] == "short":
                p, q = sides[i]
                if inside:
                    lone = p == q == "bad" and len(blocks[i].text) < 25
                    labels[i] = "good" if blocks[i].heading or not lone else "bad"
                else:
                    labels[i] = "good" if p == q == "good" or (blocks[i].heading and q == "good") else "bad"
    return [x == "good" for x in labels]


def main_text(html: str | None) -> str:
    blocks = page_blocks(html or "")
    return "\n".join(b.text for b, k in zip(blocks, second_pass(blocks), strict=True) if k)


def _texts(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for pages in parts:
        yield pd.Series([main_text(h if isinstance(h, str) else "") for h in pages], dtype=object)


def extract_text(pages: DataFrame, *, html_col: str = "html") -> DataFrame:
    """``pages`` with ``text`` in place of ``html_col``, and ``n_chars``."""
    arrow_limits(pages.sparkSession)
    rest = [c for c in pages.columns if c not in (html_col, "text", "n_chars")]
    out = pages.select(*rest, F.pandas_udf(_texts, "string")(html_col).alias("text"))
    return out.withColumn("n_chars", F.length("text").cast("long"))


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(read(spark, sf_dir, "pages").select("page_id", "url", "html"))
