"""Main text of web pages by two passes of block rules.

A page is cut into blocks at block-level tags.  Pass one decides each block by itself: text
in menus, headers, footers, sidebars, notices, adverts, forms and comment sections is
boilerplate, so are blocks that are mostly links; long blocks are text when stop words are
dense enough, or by their length alone where the page's language has no stop words here; short
blocks stay ambiguous.  <article> and <main> count when they hold half of the page's prose:
blocks outside are boilerplate then, and those inside need fewer stop words.  In pass two the ambiguous blocks take the label of the nearest block that was decided by its
words, the one before in a tie, and are text where nothing was decided.

A null or empty page has the empty text.  Rows are kept as they are, repeated or not, and
other columns are not read.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import slices

# Frequent words of the languages served.
STOP_WORDS = frozenset(
    """
    a about all also an and are as at be been but by can for from had has have he her his if in into is it its
    more not of on one or she so than that the their there they this to was we were what when which who will with
    would you
    aber als am an auch auf aus bei bin bis das dem den der des die doch ein eine einem einen einer er es für hat
    ich ihr im in ist ja mit nach nicht noch nur oder sich sie sind so und uns unter vom von vor war was wenn wie
    wir zu zum zur über
    à au aux avec ce ces cette dans de des du elle en est et eux il ils je la le les leur lui mais me ne nous on
    ou où par pas plus pour qu que qui sa se ses son sont sur tu un une vous y
    al como con de del desde el ella en entre era es esta este fue ha hay la las le lo los más muy no nos o para
    pero por que se si sin sobre son su sus también un una y ya
    """.split()
)
# Names of HTML elements.
RAW = frozenset("script style template svg math iframe noscript object select textarea canvas head".split())
UNWANTED = frozenset("nav header footer aside form button dialog menu label".split())
ARTICLE = {"main": 1, "article": 2}  # the larger number marks the article more closely
BLOCKS = frozenset(
    """
    address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption
    figure footer form frameset h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol optgroup option p pre
    section summary table tbody td tfoot th thead title tr ul label
    """.split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose start ends an open paragraph.
ENDS_P = BLOCKS - frozenset("caption td th tr tbody thead tfoot option optgroup legend summary label button body html".split())
# Words of class, id and role values that name what surrounds an article, what may
# follow them, and starts of names that CMSs give to a post's own terms and features.
_PART = (
    r"(?:ad|ads|advert\w*|banner|breadcrumbs?|captcha|comments?|commentlist|complementary|consent|contentinfo|cookies?|"
    r"copyright|disclaimer|disqus|dropdown|feedback|foot|footer|form|gdpr|header|login|masthead|menu|modal|nav|navbar|"
    r"navigation|newsletter|notices?|outbrain|pager|pagination|paywall|popup|promo\w*|recommend\w*|related|replies|"
    r"reply|respond|search|share|sharing|sidebar|signup|site-?info|skip|social|sponsor\w*|subscribe|subscription|"
    r"taboola|tags|toolbar|widget|alert|toc)"
)
_AFTER = (
    r"(?:area|bar|block|body|bottom|box|buttons?|container|content|group|holder|icons?|inner|items?|left|link|links|list|"
    r"main|message|modal|outer|panel|popup|posts?|primary|right|row|secondary|section|slot|text|title|top|unit|wrap|"
    r"wrapper|\d+)"
)
_NAMED = re.compile(
    rf"(?:^|\s)(?!(?:category|tag|has|with|no|is|type|format|status|layout|theme|template|author)[_-])"
    rf"(?:\w+[_-])*{_PART}(?:[_-]+{_AFTER})*(?=$|\s)",
    re.I,
)
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<close2>/?)(?P<name2>[a-zA-Z][^\s/>]*)(?P<rest2>[^>]*+)>|<[!?][^>]*+>",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_SPACE = re.compile(r"\s+")
_WORD = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class Rules:
    """Thresholds of the first pass, in characters and shares."""

    short: int = 70
    long: int = 200
    link_density: float = 0.33
    stop_none: float = 0.08
    stop_low: float = 0.20
    stop_high: float = 0.30


@dataclass(slots=True)
class Block:
    text: str
    linked: int
    unwanted: bool
    article: int
    heading: bool
    named: tuple[int, ...] = ()  # elements around it whose class, id or role names boilerplate


def _unwanted(name: str, rest: str) -> bool | None:
    """Whether an element holds what surrounds an article, by its name or attributes; none if
    only its class, id or role says so."""
    if name in UNWANTED:
        return True
    if "=" not in rest and "hidden" not in rest:
        return False
    weak = False
    for key, a, b, c in _ATTRIBUTE.findall(rest):
        key, value = key.lower(), a or b or c
        if key == "hidden" or key == "aria-hidden" and value.lower() == "true":
            return True
        if key == "style" and _HIDDEN.search(value):
            return True
        if key in ("class", "id", "role") and name not in ("body", "html", *ARTICLE) and _NAMED.search(value):
            weak = True
    return None if weak else False


def blocks(page: str) -> list[Block]:
    """The page's text blocks in order."""
    out: list[Block] = []
    stack: list[tuple[str, bool | None, int]] = []  # element, makes unwanted, marks the article
    named: list[int] = []  # numbers of the open elements that are unwanted by class, id or role
    with_main: set[int] = set()
    numbers = 0
    parts: list[str] = []
    counts = {"unwanted": 0, 0: 0, 1: 0, 2: 0, "a": 0, "heading": 0}
    linked, breaks, at = 0, 0, 0

    def push(text: str) -> None:
        nonlocal linked, breaks
        if text:
            parts.append(text)
            if not text.isspace():
                breaks = 0
                if counts["a"]:
                    linked += len(text.strip())

    def flush() -> None:
        nonlocal linked
        text = _SPACE.sub(" ", html.unescape("".join(parts))).strip()
        if text:
            within = 2 if counts[2] else 1 if counts[1] else 0
            out.append(Block(text, linked, counts["unwanted"] > 0, within, counts["heading"] > 0, tuple(named)))
        parts.clear()
        linked = 0

    def count(entry: tuple[str, bool | None, int], by: int) -> None:
        nonlocal numbers
        name, bad, article = entry
        if bad is None and by > 0:
            named.append(numbers)
            numbers += 1
        elif bad is None:
            named.pop()
        counts["unwanted"] += by * bool(bad)
        counts[article] += by
        counts["a"] += by * (name == "a")
        counts["heading"] += by * (len(name) == 2 and name[0] == "h" and name[1].isdigit())

    def close(name: str) -> None:
        while stack:
            entry = stack.pop()
            count(entry, -1)
            if entry[0] == name:
                return

    while m := _TAG.search(page, at):
        push(page[at : m.start()])
        at = m.end()
        name = (m["name"] or m["name2"] or "").lower()
        if not name:
            continue
        closing = bool(m["close"] or m["close2"])
        if name == "br":
            breaks += 1
            parts.append(" ")
            if breaks > 1:
                flush()
            continue
        if name in BLOCKS or name in RAW:
            flush()
        if closing:
            open_names = [e[0] for e in stack]
            if name in open_names:
                # An inline end tag does not close the blocks around it.
                inner = open_names[len(open_names) - open_names[::-1].index(name) :]
                if name in BLOCKS or not any(n in BLOCKS for n in inner):
                    close(name)
            continue
        rest = m["rest"] or m["rest2"] or ""
        if name in RAW and not rest.endswith("/"):
            end = re.compile(rf"</{name}\b[^>]*>", re.I).search(page, at)
            if end:
                at = end.end()
            elif name in ("script", "style"):
                at = len(page)
            continue
        if name in VOID or rest.endswith("/") and name not in BLOCKS:
            continue
        if name in ENDS_P:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == "p":
                    close("p")
                    break
                if stack[i][0] in BLOCKS:
                    break
        if name == "li" and stack and stack[-1][0] == "li":
            close("li")
        entry = (name, _unwanted(name, rest), ARTICLE.get(name, 2 if "articleBody" in rest else 0))
        stack.append(entry)
        count(entry, 1)
        if name == "main":
            with_main.update(named)
    push(page[at:])
    flush()
    _settle_names(out, with_main)
    return out


def _settle_names(found: list[Block], with_main: set[int], rules: Rules = Rules()) -> None:
    """Blocks in elements that a class, id or role names as boilerplate become unwanted, unless
    the element holds <main>, or most of the page's text with no prose left outside."""
    around = {n for b in found for n in b.named} - with_main
    if not around:
        return
    wanted = [b for b in found if not b.unwanted]
    total = sum(len(b.text) - b.linked for b in wanted)
    held: dict[int, int] = {}
    for b in wanted:
        for n in b.named:
            held[n] = held.get(n, 0) + len(b.text) - b.linked
    wide = {n for n in around if 2 * held.get(n, 0) > total}
    for n in sorted(wide):
        outside = [b for b in wanted if n not in b.named and not around.intersection(b.named) - wide]
        if sum(len(b.text) for b in outside if _prose(b, rules)) < rules.long:
            around.discard(n)
    for b in found:
        b.unwanted = b.unwanted or not around.isdisjoint(b.named)


def _prose(block: Block, rules: Rules) -> bool:
    size = len(block.text)
    return not block.unwanted and not block.heading and size >= rules.short and block.linked / size <= rules.link_density


def marked_level(found: list[Block], rules: Rules = Rules()) -> int:
    """How closely the page marks its article: the closest mark with at least as much prose inside
    as outside, or with no long text outside.  0 if there is none, so a teaser in <article> beside
    the text marks nothing."""
    mass = [0, 0, 0]
    for b in found:
        if _prose(b, rules):
            mass[b.article] += len(b.text)
    for level in (2, 1):
        inside, outside = sum(mass[level:]), sum(mass[:level])
        if (inside >= outside or outside < rules.long) and any(b.article >= level and not b.unwanted for b in found):
            return level
    return 0


def has_stop_words(found: list[Block], rules: Rules = Rules()) -> bool:
    """Whether the page's prose is in a language with words in STOP_WORDS."""
    words = [w for b in found if _prose(b, rules) for w in _WORD.findall(b.text.lower())]
    return sum(w in STOP_WORDS for w in words) >= rules.stop_none * len(words)


def first_pass(block: Block, marked: int, rules: Rules, listed: bool = True) -> bool | None:
    """Text (true), boilerplate (false) or ambiguous (none), from the block alone.  ``marked``:
    how closely the page marks its article; blocks marked less are not the article's, and
    those inside need fewer stop words.  Without a ``listed`` language, length decides."""
    size = len(block.text)
    if block.unwanted or block.article < marked or block.linked / size > rules.link_density:
        return False
    if size < rules.short or block.heading:
        return None
    if not listed:
        return True if marked or size >= rules.long else None
    words = _WORD.findall(block.text.lower())
    density = sum(w in STOP_WORDS for w in words) / max(1, len(words))
    if density >= (rules.stop_low if marked else rules.stop_high) or size >= rules.long and density >= rules.stop_low:
        return True
    # Inside the marked article a block of few stop words (code, names, figures) follows its neighbours.
    return None if marked or density >= rules.stop_none else False


def second_pass(labels: list[bool | None], votes: list[bool]) -> list[bool]:
    """Ambiguous blocks take the label of the nearest decided block that votes."""
    decided = [i for i, label in enumerate(labels) if label is not None and votes[i]]
    out, j = [], 0
    for i, label in enumerate(labels):
        while j < len(decided) and decided[j] < i:
            j += 1
        if label is None:
            near = decided[max(0, j - 1) : j + 1]
            label = labels[min(near, key=lambda k: abs(k - i))] if near else True
        out.append(label)
    return out


def main_text(page: str | None, rules: Rules = Rules()) -> str:
    """The article's blocks, one per line."""
    found = blocks(page or "")
    marked, listed = marked_level(found, rules), has_stop_words(found, rules)
    labels = [first_pass(b, marked, rules, listed) for b in found]
    votes = [not b.unwanted and b.article >= marked for b in found]
    return "\n".join(b.text for b, keep in zip(found, second_pass(labels, votes)) if keep)


def extract_main_text(pages: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` of every page."""
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            texts = [main_text(p, rules) for p in batch["html"].to_pylist()]
            columns = [batch["page_id"], batch["url"], pa.array(texts), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema)], schema=schema)

    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.col("html").cast("string").alias("html"),
    )
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
