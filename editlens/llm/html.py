"""HTML extraction by maximum-scoring subsequence.

A page is a sequence of words and tags. Words score positive, tags and words of
page furniture negative; a linear scan finds the contiguous run of the greatest
sum, the content region. The scores are log-odds learned by Spark from labelled
pages: those whose one ``article`` or ``main`` element says where the content is.

The region is then widened to the element that holds it (its ``article`` or
``main``; on pages without one, to what scores positive across the furniture next
to it and the innermost container; on the bare body, to the neighbouring blocks), and the furniture inside (menus, adverts, forms, comments, ...) is
left out. Text is read from the whole page in one pass.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: element and class names of HTML pages
SKIPPED = frozenset("script style noscript template svg iframe object canvas audio video map head "
                    "textarea select annotation annotation-xml".split())
RAW = ("script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes", "noscript")
FURNITURE_TAGS = frozenset("nav footer aside form button input label fieldset menu dialog datalist output".split())
FURNITURE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert "
                            "status menu menubar toolbar tablist".split())
FURNITURE_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising adsense adslot adbox banner banners sponsor "
    "sponsored promo promos promotion sidebar sidebars menu menus nav navbar navigation breadcrumb breadcrumbs "
    "masthead topbar footer cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe "
    "subscription signup login share sharing social related recommended recommendations comment comments commentlist "
    "commentform disqus respond reply replies widget widgets toolbar pagination pager search skip skiplink paywall".split())
HEADER_NAMES = frozenset("header pageheader siteheader".split())       # furniture unless inside the article
COMMENT_NAMES = frozenset("comment comments commentlist commentform disqus respond reply replies".split())
# parts that make a compound with a furniture name: ad-slot, comment-list, left-sidebar
AFFIXES = frozenset("area bar block body bottom box btn button buttons container form group holder icons inner item "
                    "items left link links list main mobile outer panel post posts primary right secondary section site "
                    "slot sticky top unit wrap wrapper".split())
# the same inside an article or main, where only whole names count: reader-comments, google-ads, sponsored-content
AFFIXES_INSIDE = AFFIXES | frozenset("content dfp google inline label leaderboard mpu native reader readers rectangle "
                                     "thread user users".split())
# inside an article or main the scores of its own words and tags say whether such an element stays
WEAK_NAMES = frozenset("related recommended recommendations social search share sharing reply replies "
                       "widget widgets".split())
TEXT_TAGS = frozenset("h1 h2 h3 h4 h5 h6 p".split())                   # their ids are anchors, made from headings
HEAD_TAGS = frozenset("base basefont bgsound link meta noframes noscript script style template title".split())
# marks of an element: part of a class or id, or a form; a whole class token or id; the same of
# comments; what no wrapper of the text has
LOOSE, FIRM, COMMENTS, HARD = 1, 2, 3, 4
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary "
    "table tbody td tfoot th thead title tr ul xmp".split())
CONTAINERS = frozenset("article main section div td body html".split())
SECTIONS = ("article", "main")
CLOSES_P = BLOCKS - {"html", "body", "legend", "option", "optgroup", "title", "tbody", "thead", "tfoot", "tr", "td", "th"}
SAME = {"li": ("li", "ul ol menu dir"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr td th", "table"),
        "td": ("td th", "tr table"), "th": ("td th", "tr table"), "option": ("option", "select")}

# a quote delimits a value only right after "="; "<!-->" is a whole comment, "--!>" ends one
TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:=\s*(?:\"[^\"]*\"|'[^']*')|[^>])*+)>"
    r"|<(?P<close2>/?)(?P<name2>[a-zA-Z][^\s/>]*)(?P<attrs2>[^>]*)(?:>|\Z)"
    r"|(?P<text>[^<]+|<)", re.S)
ATTR = re.compile(r"([a-zA-Z_:][-a-zA-Z0-9_:.]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
FURNITURE_SCORE = -4.0
MAX_SCORE = 4.0
LINK_SCORE = -0.1        # words of links do not carry a run, whatever the labelled pages say
SHORT = 6                # words of a line at the edge of an article-less region that may be a menu or imprint


@dataclass
class Element:
    tag: str
    parent: int            # -1: none
    furniture: bool
    in_section: bool       # inside an article or main
    mark: int = 0          # its own, whether it counts or not
    weak: bool = False     # has a weak name, inside an article or main


@dataclass
class Block:
    element: int           # innermost element that makes the block
    text: str
    furniture: bool
    token: int             # place of its first word in the token sequence


@dataclass
class Page:
    elements: list[Element]
    blocks: list[Block]
    #: (feature, element, weight count): tags and runs of words in page order
    tokens: list[tuple[str, int, int]]
    #: elements whose mark does not count, as they hold the page's article, main or most words
    wrappers: frozenset[int] = frozenset()


def _parts(token: str) -> list[str]:
    token = re.sub(r"([a-z])([A-Z])", r"\1 \2", re.sub(r"[0-9]+x[0-9]+", " ", token))        # ad-300x250
    return [p for p in re.split(r"[^a-z]+", token.lower()) if p]


def _mark(tag: str, attrs: str, inside: bool) -> tuple[int, bool]:
    """(mark, has a weak name) of an element. Inside an article or main only whole
    class names and compounds of known parts count, and of a section's id only comments."""
    if tag in FURNITURE_TAGS or tag in SKIPPED or (tag == "header" and not inside):
        return (LOOSE if tag == "form" else HARD), False
    if not attrs or tag in ("html", "body", "main"):
        return 0, False
    a = {k.lower(): x or y or z for k, x, y, z in ATTR.findall(attrs)}
    if a.get("role", "").lower() in FURNITURE_ROLES or "hidden" in a or a.get("aria-hidden", "").lower() == "true":
        return HARD, False
    if "style" in a and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", a["style"].lower()):
        return HARD, False
    known = FURNITURE_NAMES if inside else FURNITURE_NAMES | HEADER_NAMES
    if tag == "article":
        known = frozenset({"comment", "comments", "reply", "ad", "ads", "advert", "sponsored", "promo", "related"})
    classes, mark, weak = a.get("class", "").split(), 0, False
    section = tag == "section" or "section" in classes
    for token in classes + ([] if tag in TEXT_TAGS else a.get("id", "").split()):
        parts = set(_parts(token))
        names = parts & known
        whole = parts <= known | (AFFIXES_INSIDE if inside else AFFIXES)
        anchor = section and token not in classes
        if not names or not whole and (inside or anchor) or inside and anchor and not names <= COMMENT_NAMES - WEAK_NAMES:
            continue
        if inside and tag != "article" and names <= WEAK_NAMES:
            weak = True
        else:
            mark = max(mark, COMMENTS if whole and names <= COMMENT_NAMES else FIRM if whole else LOOSE)
    return mark, weak and not mark


def _wrappers(page: Page) -> frozenset[int]:
    """Elements with a furniture mark that hold the page's main, its one article,
    or most of its words (or of those of the unmarked article or main they are in).
    Comments may well be longer than the text, so their words do not count."""
    elements = page.elements
    if not any(0 < e.mark < HARD for e in elements):
        return frozenset()
    words, plain = [0] * len(elements), [0] * len(elements)     # without hard marks; without whole names
    for feature, i, n in page.tokens:
        if feature[0] in "+-":
            words[i] += n
            plain[i] += n
    for i in range(len(elements) - 1, 0, -1):
        e = elements[i]
        if e.mark < HARD:
            words[e.parent] += words[i]
        if e.mark < FIRM:
            plain[e.parent] += plain[i]
    level, scope, nested = [0], [0], [False]                    # marks on the way, unmarked section, inside an article
    for i, e in enumerate(elements[1:], 1):
        up = e.parent
        level.append(level[up] + (math.inf if e.mark == HARD else e.mark > 0))
        scope.append(scope[up] or (i if e.tag in SECTIONS and not level[i] else 0))
        nested.append(nested[up] or elements[up].tag == "article")
    sections = {s for s in scope if s}
    held = [i for i, e in enumerate(elements) if e.tag == "main" and level[i] < math.inf]
    for s in {i for i in sections if elements[i].tag == "main"} or (set() if sections else {0}):
        found = [i for i, e in enumerate(elements) if e.tag == "article" and not e.mark and scope[i] == s
                 and level[i] < math.inf and not nested[i]]
        least = min((level[i] for i in found), default=0)
        first = [i for i in found if level[i] == least]
        if least and len(first) == 1:
            held += first
    out = {c for i in held for c in _chain(page, i) if elements[c].mark}
    open_ = [True]                                              # no mark that counts above
    for i, e in enumerate(elements[1:], 1):
        s = scope[i]
        if open_[e.parent] and 0 < e.mark < COMMENTS and i not in out and (s or not sections) and words[i]:
            if 10 * words[i] > 9 * words[s] or e.mark == LOOSE and 2 * plain[i] > plain[s]:
                out.add(i)
        open_.append(open_[e.parent] and (not e.mark or i in out))
    return frozenset(out)


def parse(source: str | None) -> Page:
    """Elements, blocks and tokens of a page. Tolerant: unclosed, stray and cut-off
    tags do no harm."""
    page = _parse(source, frozenset())
    wrappers = _wrappers(page)
    return _parse(source, wrappers) if wrappers else page


def _parse(source: str | None, wrappers: frozenset[int], dropped: frozenset[int] = frozenset()) -> Page:
    page = Page([Element("#page", -1, False, False)], [], [], wrappers)
    stack = [0]
    parts: list[str] = []
    begun = [0, 0]                        # element and token of the open block

    def flush() -> None:
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            page.blocks.append(Block(begun[0], text, page.elements[begun[0]].furniture, begun[1]))
        parts.clear()
        begun[:] = [_block_of(stack, page), len(page.tokens)]

    def pop_to(place: int) -> None:
        del stack[place:]

    def end_head() -> None:
        if page.elements[stack[-1]].tag == "head":
            stack.pop()
            flush()

    def pieces(text: str, element: int) -> None:
        n = len(text.split())
        e = page.elements[element]
        if n:
            page.tokens.append((("-" if e.furniture else "+") + ("a" if _linked(page, element) else e.tag), element, n))
        if e.furniture and not page.elements[begun[0]].furniture:
            return                        # an inline piece of furniture inside a block
        parts.append(text)

    pos, source = 0, source or ""
    while pos < len(source):
        m = TOKEN.match(source, pos)
        if m is None:                     # cannot happen; never loop for ever
            pos += 1
            continue
        pos = m.end()
        if m["text"] is not None:
            if not m["text"].isspace():
                end_head()
            if m["text"] == "<" and parts:
                parts.append("<")
            else:
                pieces(m["text"], stack[-1])
            continue
        name = m["name"] or m["name2"]
        if name is None:
            if m[0].startswith("<![CDATA["):
                pieces(html.escape(m[0][9:].removesuffix("]]>")), stack[-1])
            continue
        tag, attrs, close = name.lower(), (m["attrs"] or m["attrs2"] or ""), bool(m["close"] or m["close2"])
        if tag == "br":
            parts.append(" ")
            page.tokens.append(("br", stack[-1], 1))
            continue
        if close:
            at = next((k for k in range(len(stack) - 1, 0, -1) if page.elements[stack[k]].tag == tag), None)
            if at is None:
                continue
            if tag not in BLOCKS and any(page.elements[i].tag in CONTAINERS for i in stack[at + 1:]):
                continue                  # a stray inline end tag closes no container
            page.tokens.append(("/" + tag, stack[at], 1))
            if tag in BLOCKS or any(page.elements[i].tag in BLOCKS for i in stack[at:]):
                pop_to(at)
                flush()
            else:
                pop_to(at)
            continue
        if tag not in HEAD_TAGS:
            end_head()
        if tag in CLOSES_P:
            _close(stack, page, ("p",), CONTAINERS | {"li", "blockquote", "th"}, pop_to, flush)
        if tag in SAME:
            what, until = SAME[tag]
            _close(stack, page, tuple(what.split()), frozenset(until.split()), pop_to, flush)
        parent = page.elements[stack[-1]]
        inside = parent.in_section or tag in SECTIONS
        number, (mark, weak) = len(page.elements), _mark(tag, attrs, parent.in_section)
        furniture = parent.furniture or mark > 0 and number not in wrappers or number in dropped
        e = Element(tag, stack[-1], furniture, inside, mark, weak)
        page.elements.append(e)
        page.tokens.append((tag if tag in BLOCKS or tag in VOID or tag in SKIPPED else "inline", number, 1))
        if tag in VOID or attrs.rstrip().endswith("/") and tag not in BLOCKS:
            if tag == "hr":
                flush()
            continue
        stack.append(number)
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(source, pos)
            if tag == "title" and not e.furniture:
                flush()
            if tag == "xmp":                  # shown as it is
                flush()
                pieces(html.escape(source[pos:end.start() if end else len(source)]), number)
            pos = end.end() if end else len(source)
            stack.pop()
            if tag == "xmp":
                flush()
            continue
        if tag in BLOCKS:
            flush()
    flush()
    return page


def _linked(page: Page, element: int) -> bool:
    """Inside a link of its block."""
    while element > 0 and page.elements[element].tag not in BLOCKS:
        if page.elements[element].tag == "a":
            return True
        element = page.elements[element].parent
    return False


def _block_of(stack: list[int], page: Page) -> int:
    return next((i for i in reversed(stack) if page.elements[i].tag in BLOCKS), 0)


def _close(stack, page, tags, until, pop_to, flush) -> None:
    """An element of ``tags`` that is open (not beyond ``until``) ends here."""
    for k in range(len(stack) - 1, 0, -1):
        tag = page.elements[stack[k]].tag
        if tag in tags:
            pop_to(k)
            flush()
            return
        if tag in until:
            return


def _chain(page: Page, element: int) -> list[int]:
    out = []
    while element >= 0:
        out.append(element)
        element = page.elements[element].parent
    return out


def label_counts(page: Page) -> Counter:
    """(feature, inside) counts of a labelled page; empty if the page is not one:
    it needs exactly one outermost article or main that is no furniture."""
    tops = [i for i, e in enumerate(page.elements)
            if e.tag in SECTIONS and not e.furniture and not page.elements[e.parent].in_section]
    if len(tops) != 1:
        return Counter()
    inside = [False] * len(page.elements)
    for i, e in enumerate(page.elements):
        inside[i] = i == tops[0] or (e.parent >= 0 and inside[e.parent])
    out: Counter = Counter()
    for feature, element, n in page.tokens:
        out[feature, inside[element]] += n
    return out


def learn(pages: DataFrame, html_col: str = "html") -> dict[str, float]:
    """Scores from all labelled pages: log-odds of lying in the content, words
    kept above zero and tags below. Features are element names of a fixed list,
    so the table that reaches the driver is small whatever the input."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for b in batches:
            for t in b.column(0):
                for (feature, inside), n in label_counts(parse(t.as_py())).items():
                    word, tag = feature[0] in "+-", feature.lstrip("+-/")
                    known = tag in BLOCKS or tag in VOID or tag in SKIPPED or word and tag == "a"
                    total[(feature[0] if word or feature[0] == "/" else "") + (tag if known else "inline"), inside] += n
        if total:
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in total]), pa.array([k[1] for k in total]), pa.array(list(total.values()), pa.int64())],
                ["feature", "inside", "n"])

    rows = pages.select(F.col(html_col).cast("string").alias("h")).mapInArrow(
        run, "feature string, inside boolean, n bigint").groupBy("feature", "inside").agg(F.sum("n").alias("n")).collect()
    count = {(r["feature"], r["inside"]): r["n"] for r in rows}
    whole = {s: 1 + sum(n for (_, i), n in count.items() if i == s) for s in (True, False)}
    out = {}
    for f in {f for f, _ in count}:
        odds = math.log((count.get((f, True), 0) + 0.5) / whole[True]) - math.log((count.get((f, False), 0) + 0.5) / whole[False])
        if f == "+a":                                      # a menu without any name is links all over
            out[f] = min(max(odds, -MAX_SCORE), LINK_SCORE)
        elif f[0] == "+":
            out[f] = min(max(odds, 0.1), MAX_SCORE)
        elif f[0] == "-":
            out[f] = min(odds, FURNITURE_SCORE)
        else:
            out[f] = max(min(odds / 4, -0.05), -MAX_SCORE)
    return out


def score(feature: str, n: int, weights: dict[str, float]) -> float:
    word, tag = feature[0] in "+-", feature.lstrip("+-/")
    known = tag in BLOCKS or tag in VOID or tag in SKIPPED or word and tag == "a"
    name = (feature[0] if word or feature[0] == "/" else "") + (tag if known else "inline")
    default = LINK_SCORE if feature == "+a" else 0.5 if feature[0] == "+" else FURNITURE_SCORE if feature[0] == "-" else -0.3
    return weights.get(name, default) * n


def best_run(scores: list[float]) -> tuple[int, int]:
    """(first, last + 1) of the contiguous run of greatest sum, the earliest
    among equals; (0, 0) if no score is positive."""
    best, at, cur, start = 0.0, (0, 0), 0.0, 0
    for i, s in enumerate(scores):
        if cur <= 0:
            cur, start = 0.0, i
        cur += s
        if cur > best:
            best, at = cur, (start, i + 1)
    return at


def extract(source: str | None, weights: dict[str, float]) -> str:
    """Main text of a page: its blocks joined by one space; '' if there is none."""
    page = parse(source)
    lo, hi = best_run([score(f, n, weights) for f, _, n in page.tokens])
    if lo == hi:
        return ""
    if again := _mark_again(page, lo, hi):
        page = _parse(source, page.wrappers - again)
    chain = _common(page, lo, hi)
    section = next((e for e in chain if page.elements[e].tag in SECTIONS), None)
    if section is None:
        section = _only_section(page)
    if section is None:
        lo, hi = _widened(page, lo, hi, set(chain), weights)
        chain = _common(page, lo, hi)
        section = next((e for e in chain if page.elements[e].tag in CONTAINERS or e == 0), 0)
    inside = [False] * len(page.elements)
    for i, e in enumerate(page.elements):
        inside[i] = i == section or (e.parent >= 0 and inside[e.parent])
    if dropped := _weak(page, inside, weights):
        page = _parse(source, page.wrappers, dropped)
    blocks = [b for b in page.blocks if inside[b.element]]
    if page.elements[section].tag in ("body", "html", "#page"):
        blocks = _neighbours(page, lo, hi)
    return " ".join(b.text for b in blocks if not b.furniture)


def _only_section(page: Page) -> int | None:
    """The page's one outermost article or main that is no furniture and has words: the region even where
    the run also takes in, or prefers, readers' comments or a menu beside it."""
    tops = [i for i, e in enumerate(page.elements)
            if e.tag in SECTIONS and not e.furniture and not page.elements[e.parent].in_section]
    if len(tops) != 1 or not any(f[0] == "+" and tops[0] in _chain(page, e) for f, e, _ in page.tokens):
        return None
    return tops[0]


def _common(page: Page, lo: int, hi: int) -> list[int]:
    """Elements that hold all words of the run, the innermost first."""
    words = {e for f, e, _ in page.tokens[lo:hi] if f[0] == "+"} or {page.tokens[lo][1]}
    common = set.intersection(*(set(_chain(page, e)) for e in words))
    return sorted(common, reverse=True)                  # numbers grow downwards


def _widened(page: Page, lo: int, hi: int, above: set[int], weights: dict[str, float]) -> tuple[int, int]:
    """The run and what scores positive before and after it, across furniture (an
    advert between two sections, whatever its length) but not across the header or
    footer of an element that holds the run."""
    def reach(places: range) -> int:
        best, cur, far = 0.0, 0.0, 0
        for n, i in enumerate(places, 1):
            f, at, count = page.tokens[i]
            e = page.elements[at]
            if e.furniture:
                if e.tag in ("header", "footer") and e.parent in above:
                    break
                continue
            cur += score(f, count, weights)
            if cur > best:
                best, far = cur, n
        return far

    return lo - reach(range(lo - 1, -1, -1)), hi + reach(range(hi, len(page.tokens)))


def _mark_again(page: Page, lo: int, hi: int) -> frozenset[int]:
    """Wrappers whose mark counts after all: they hold less than half of the run's words."""
    if not page.wrappers:
        return frozenset()
    words = [0] * len(page.elements)
    for f, e, n in page.tokens[lo:hi]:
        if f[0] == "+":
            words[e] += n
    for i in range(len(words) - 1, 0, -1):
        words[page.elements[i].parent] += words[i]
    again = frozenset(i for i in page.wrappers if 2 * words[i] < words[0])
    if all(again.intersection(_chain(page, e)) for f, e, _ in page.tokens[lo:hi] if f[0] == "+"):
        return frozenset()
    return again


def _weak(page: Page, inside: list[bool], weights: dict[str, float]) -> frozenset[int]:
    """Elements of weak names in the region whose words and tags do not score positive."""
    if not any(e.weak and inside[i] for i, e in enumerate(page.elements)):
        return frozenset()
    total = [0.0] * len(page.elements)
    for f, e, n in page.tokens:
        if not page.elements[e].furniture:
            total[e] += score(f, n, weights)
    for i in range(len(total) - 1, 0, -1):
        total[page.elements[i].parent] += total[i]
    return frozenset(i for i, e in enumerate(page.elements) if e.weak and inside[i] and total[i] <= 0)


def _neighbours(page: Page, lo: int, hi: int) -> list[Block]:
    """Blocks of the region, and those before and after it up to the next furniture."""
    places = [i for i, b in enumerate(page.blocks) if lo <= b.token < hi]
    if not places:
        places = [max(i for i, b in enumerate(page.blocks) if b.token < hi)]
    first, last = places[0], places[-1]
    while first > 0 and not page.blocks[first - 1].furniture:
        first -= 1
    while last + 1 < len(page.blocks) and not page.blocks[last + 1].furniture:
        last += 1
    while first < last and _edge(page, page.blocks[first]):
        first += 1
    while last > first and _edge(page, page.blocks[last]):
        last -= 1
    return page.blocks[first:last + 1]


def _edge(page: Page, block: Block) -> bool:
    """A short line that is no heading, paragraph or sentence: at the edge of a page without any
    section it is a menu or an imprint."""
    words = block.text.split()
    text = any(page.elements[e].tag in TEXT_TAGS for e in _chain(page, block.element))
    return not text and len(words) < SHORT and not block.text.endswith((".", "!", "?", ":", ";", "…", '"', "”", "。"))


def main_text(html_col: Column, weights: dict[str, float]) -> Column:
    """Main text of each page. A null page is an empty one."""
    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield pd.Series([extract(t, weights) for t in s], dtype=object)

    return run(html_col)
