"""Main text of web pages by tag-path ratios.

Each block of text hangs on a root-to-leaf tag path.  Text length and
punctuation are summed per path and divided by the path's nodes; the two
ratios are smoothed along the page, fused by their product, and paths whose
fused ratio passes a threshold are content.  The content's container (the
article or main elements they lie in, else the deepest common ancestor
element of the blocks that pass the threshold by themselves, never one text
block, list, table or quote by itself) then gives the page's text: all its
blocks, so short paragraphs and headings inside an article are not lost, less
those under elements that are never article text (menus, headers, footers,
sidebars, notices, adverts, forms, scripts, styles, reader comments).

Some of these are known by their class, id or role only.  A name never
excludes a part of a text (a heading, paragraph, list, table, quote; but for a
list of readers' comments), an article or main element, or what wraps the
text (``class="has-sidebar"``).  Inside article or main a name must be a whole
class, not a word of one, an id counts on ``div`` alone (elsewhere ids are
slugs of headings), and an element that holds content by the ratios stays
where its names may be an article's subject (``SUBJECTS``): see :func:`_wrappers`.

Character references are decoded, white space inside a block becomes one
space, blocks are joined in page order by one space.  Broken markup is read
as browsers do: unclosed paragraphs end at the next block, stray end tags are
ignored, a tag cut off by the end of the page is dropped.

Each page is read alone, so pages split over any number of tasks; memory is
bounded by the longest page.

Edge cases: null or empty html gives an empty text; html without tags is its
own text; other columns are ignored.
"""

from __future__ import annotations

import html as _html
import math
import re

from pyspark.sql import DataFrame, functions as F

from shelfsync.llm.common import map_arrow

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)([^>\"']*(?:\"[^\"]*\"[^>\"']*|'[^']*'[^>\"']*)*|[^>]*)>",
                    re.S)
_CUT_OFF = re.compile(r"<[a-zA-Z/!][^>]*\Z")
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'=<>`]+)))?")
_SPLIT = re.compile(r"[^a-z0-9]+")
_PUNCT = re.compile(r"[.,;:!?…。，；：！？]")

#: Element names and class, id or role words, by what they mean in HTML.
RAW = frozenset("script style noscript template textarea title iframe xmp noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small "
                    "span strike strong sub sup time tt u var wbr img").split())
NEVER = frozenset(("head nav header footer aside form button select option menu dialog svg math canvas object audio video "
                   "script style noscript template textarea title iframe xmp noembed noframes").split())
NEVER_NAMED = frozenset(("ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments cookie cookies "
                         "consent disqus footer header masthead menu nav navbar navigation newsletter notice notices popup "
                         "promo related search share sharing sidebar signup social sponsor sponsored subscribe toolbar "
                         "widget complementary contentinfo alert dialog").split())
#: Of these, the words for readers' comments, which may well hold articles and long texts.
REPLIES = frozenset("comment comments disqus".split())
#: Of these, the words that may as well be an article's subject: inside article or main, the ratios decide.
SUBJECTS = frozenset(("alert banner consent cookie cookies dialog newsletter notice notices popup promo related search share "
                      "sharing signup social sponsor sponsored subscribe widget").split())
ROOTS = frozenset(("article", "main"))
#: Path id, text, allowed but for names, innermost named element, named element around the outermost article or main, element.
Block = tuple[int, str, bool, int, int, int]
#: Elements that are parts of a text: never its container.
PARTS = frozenset("p pre h1 h2 h3 h4 h5 h6 ul ol li dl dt dd blockquote figure figcaption table thead tbody tfoot tr".split())
CLOSED_BY_BLOCK = frozenset(("p",))
SCOPES = frozenset("html body article main section div td th table ul ol blockquote".split())


def _attributes(attrs: str) -> dict[str, str]:
    """Attribute values by lower-cased name; of equal names the first counts."""
    out: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(attrs):
        out.setdefault(m[1].lower(), (m[2] or m[3] or m[4] or "").lower())
    return out


def _named(name: str, attrs: str, rooted: bool) -> frozenset[str]:
    """The words in an element's names that exclude it, unless it holds the
    text; ``rooted``: inside article or main."""
    if not attrs or name in ROOTS or name in ("html", "body"):
        return frozenset()
    found = _attributes(attrs)
    if name in PARTS:
        words = {w for c in found.get("class", "").split() for w in _SPLIT.split(c)} if name in ("ul", "ol", "dl") else set()
        return REPLIES.intersection(words)
    values = [found.get("class", ""), found.get("role", "")]
    if not rooted or name == "div" or found.get("id") in REPLIES:
        values.append(found.get("id", ""))
    if rooted:
        words = {w for v in values for w in v.split()}
        return NEVER_NAMED.intersection(words) or REPLIES.intersection(x for w in words for x in _SPLIT.split(w))
    return NEVER_NAMED.intersection(w for v in values for w in _SPLIT.split(v))


def blocks_of(page: str) -> list[Block]:
    """The blocks in page order.

    Paths are interned as (parent, tag) pairs, so deep nesting costs one step a tag.
    """
    return _parse(page)[0]


def _parse(page: str):
    paths: dict[tuple[int, str], int] = {}
    parents: list[int] = [-1]
    around: list[int] = [-1]  # of each element that is not inline: the one around it
    kinds: list[str] = [""]
    root_of: list[int] = [-1]  # the innermost article or main it lies in or is
    # Elements with an excluding name: (the one around it, its words, inside article or main).
    named: list[tuple[int, frozenset[str], bool]] = [(-1, frozenset(), False)]
    # Name, path, allowed, named, outside, element: as in a block.
    stack: list[tuple[str, int, bool, int, int, int]] = [("", 0, True, 0, -1, 0)]
    n_open: dict[str, int] = {}
    blocks: list[Block] = []
    buf: list[str] = []

    def flush() -> None:
        if buf:
            text = " ".join(_html.unescape("".join(buf)).split())
            buf.clear()
            if text:
                at = next(s for s in reversed(stack) if s[0] not in INLINE)
                blocks.append((at[1], text, *stack[-1][2:5], at[5]))

    def pop_to(i: int) -> None:
        for name, *_ in stack[i:]:
            n_open[name] -= 1
        del stack[i:]

    pos, end = 0, len(page)
    while pos < end:
        m = _TOKEN.search(page, pos)
        if m is None:
            tail = page[pos:]
            buf.append(_CUT_OFF.sub("", tail) if "<" in tail else tail)
            break
        if m.start() > pos:
            buf.append(page[pos:m.start()])
        pos = m.end()
        if m[2] is None:  # comment, doctype, processing instruction
            continue
        name, closing = m[2].lower(), bool(m[1])
        if name in VOID:
            if name in ("br", "hr"):
                buf.append(" ")
            continue
        if name in RAW and not closing:
            stop = re.compile(f"</{re.escape(name)}\\b[^>]*>", re.I).search(page, pos)
            pos = stop.end() if stop else end
            continue
        block = name not in INLINE
        if block:
            flush()
        if closing:
            if n_open.get(name):
                i = len(stack) - 1
                while stack[i][0] != name:
                    i -= 1
                if block or all(s[0] in INLINE for s in stack[i:]):
                    if not block and stack[i][2:5] != stack[i - 1][2:5]:
                        flush()
                    pop_to(i)
            continue
        if block and n_open.get("p") and name not in ("span",):
            i = len(stack) - 1
            while i and stack[i][0] != "p" and stack[i][0] not in SCOPES:
                i -= 1
            if stack[i][0] == "p":
                pop_to(i)
        if name == "li" and n_open.get("li"):
            i = len(stack) - 1
            while i and stack[i][0] not in ("li", "ul", "ol"):
                i -= 1
            if stack[i][0] == "li":
                pop_to(i)
        parent = stack[-1][1]
        path = paths.get((parent, name))
        if path is None:
            path = paths[(parent, name)] = len(parents)
            parents.append(parent)
        allowed = stack[-1][2] and name not in NEVER
        within, outside, element = stack[-1][3:]
        if name in ROOTS and outside < 0:
            outside = within
        if allowed and (words := _named(name, m[3], root_of[element] >= 0)):
            named.append((within, words, root_of[element] >= 0))
            within = len(named) - 1
        if not block and (allowed, within) != stack[-1][2:4]:
            flush()
        if m[3].endswith("/") and not block:
            continue
        if block:
            around.append(element)
            kinds.append(name)
            element = len(around) - 1
            root_of.append(element if name in ROOTS else root_of[around[element]])
        stack.append((name, path, allowed, within, outside, element))
        n_open[name] = n_open.get(name, 0) + 1
    flush()
    return blocks, around, kinds, root_of, named


def content_paths(blocks: list[Block]) -> set[int]:
    """The paths whose smoothed, fused text and punctuation ratios pass the threshold."""
    return _content(blocks)[0]


def _content(blocks: list[Block]) -> tuple[set[int], float]:
    """The content paths and the threshold."""
    stats: dict[int, list[int]] = {}
    for path, text, *_ in blocks:
        s = stats.setdefault(path, [0, 0, 0])
        s[0] += 1
        s[1] += len(text)
        s[2] += len(_PUNCT.findall(text))
    order = list(stats)
    text_ratio = [stats[p][1] / stats[p][0] for p in order]
    punct_ratio = [stats[p][2] / stats[p][0] + 1 for p in order]

    def smooth(x: list[float]) -> list[float]:
        kernel = (0.25, 0.5, 0.25)
        return [sum(w * x[min(max(i + d, 0), len(x) - 1)] for w, d in zip(kernel, (-1, 0, 1), strict=True))
                for i in range(len(x))]

    raw = [t * p for t, p in zip(text_ratio, punct_ratio, strict=True)]
    fused = [a * b for a, b in zip(smooth(text_ratio), smooth(punct_ratio), strict=True)]
    score = [math.sqrt(r * f) for r, f in zip(raw, fused, strict=True)]
    mean = sum(score) / len(score)
    threshold = math.sqrt(sum((s - mean) ** 2 for s in score) / len(score))
    least = min(threshold, max(score))
    return {p for p, s in zip(order, score, strict=True) if s >= least}, least


def _strong(blocks: list[Block]) -> list[Block]:
    """The blocks on content paths that pass the threshold by themselves."""
    content, least = _content(blocks)
    return [b for b in blocks if b[0] in content and len(b[1]) * (len(_PUNCT.findall(b[1])) + 1) >= least]


def _wrappers(blocks: list[Block], named: list[tuple[int, frozenset[str], bool]]) -> set[int]:
    """The named elements that hold the page's text, so their names do not exclude.

    The text is the blocks that pass the threshold by themselves, names
    ignored, inside article or main where there is one (all its blocks if
    none passes).  What wraps an article or main with such a block is kept, and
    what holds more than half of the text, or inside article or main any of it
    under a name that may be its subject; elements named for readers' comments, and any others, only
    where no text would be left: then those around the least wrapped text.
    """
    content, _ = _content(blocks)
    text = _strong(blocks)
    rooted = [b for b in text if b[4] >= 0] or [b for b in blocks if b[4] >= 0]
    text = rooted or text or [b for b in blocks if b[0] in content]

    def line(e: int) -> set[int]:
        out = set()
        while e > 0:
            out.add(e)
            e = named[e][0]
        return out

    size: dict[int, int] = {}
    for b in text:
        size[b[3]] = size.get(b[3], 0) + len(b[1])
    around = {e: line(e) for e in size}
    held: dict[int, int] = {}
    for e, n in size.items():
        for x in around[e]:
            held[x] = held.get(x, 0) + n
    half = sum(size.values()) / 2
    kept = {e for e, n in held.items() if n > half or named[e][2] and named[e][1] <= SUBJECTS}.union(*[line(e) for e in {b[4] for b in text}])
    kept = {e for e in kept if not named[e][1] <= REPLIES}
    if not any(kept >= x for x in around.values()):
        fewest = min(len(x - kept) for x in around.values())
        kept = kept.union(*[x for x in around.values() if len(x - kept) == fewest])
    return kept


def main_text(page: str | None) -> str:
    """The page's article as one line of text."""
    if not page:
        return ""
    blocks, around, kinds, root_of, named = _parse(page)
    allowed = [b for b in blocks if b[2]]
    if not allowed:
        return ""
    if len(named) > 1:
        kept = _wrappers(allowed, named)
        out_of = [False]  # excluded by a name of its own or around it
        for e, (outer, *_) in enumerate(named[1:], 1):
            out_of.append(out_of[outer] or e not in kept)
        allowed = [b for b in allowed if not out_of[b[3]]]
    content = content_paths(allowed)
    holders = {root_of[b[5]] for b in allowed if b[0] in content and root_of[b[5]] >= 0}
    if not holders:
        text = _strong(allowed) or [b for b in allowed if b[0] in content]
        wide = {around[b[5]] for b in allowed}  # a block with none below it is never its own container
        wide |= {around[e] for e in range(len(around) - 1, 0, -1) if e in wide}
        holders = {_common({_holder(b[5], around, kinds, wide) for b in text}, around)}
    inside: list[bool] = []  # an element comes after the one around it
    for e, outer in enumerate(around):
        inside.append(e in holders or (outer >= 0 and inside[outer]))
    return " ".join(b[1] for b in allowed if inside[b[5]])


def _holder(element: int, around: list[int], kinds: list[str], wide: set[int]) -> int:
    """The nearest element that can hold a whole text."""
    while element > 0 and (kinds[element] in PARTS or element not in wide):
        element = around[element]
    return element


def _common(elements: set[int], around: list[int]) -> int:
    """The deepest element above (or equal to) all of ``elements``.  Each step
    replaces the youngest by the one around it, which came before it."""
    left = set(elements)
    while len(left) > 1:
        youngest = max(left)
        left.discard(youngest)
        left.add(around[youngest])
    return left.pop()


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` for each row of ``pages``."""

    def run(batches):
        import pyarrow as pa

        for b in batches:
            texts = [main_text(h) for h in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return rows.transform(map_arrow, run, "page_id long, url string, text string, n_chars long")
