"""Main text of web pages by maximum-scoring subsequence.

A page becomes a sequence of words and tags. Words score positive (less inside links), tags negative; one linear scan
finds the contiguous region of the highest total, and the blocks that it touches are the article. Weights are log odds
of a tag (or of a word in or outside a link) standing inside rather than outside the content, counted over labelled
pages: pages that mark their content by a single article or main element. A sample of at most `sample` pages of any kind
(the least hashes of their id; of repeated ids one page) is read for this, and the marked ones among them count, on top
of fixed prior counts that serve where none is.

Elements that never are article text (menus, forms, footers, sidebars, adverts, notices, reader comments, scripts,
styles; told by element name, role, hiding, or a class or id that names nothing else) give no words. A class or id that
only holds such a word beside others, or one that often goes with furniture (`legal-text`, `related`, `share`), is a
feature: what stands directly in such an element is a sequence of its own, whose score counts `HINTED` of its value for
each such element around it. So an advert inside an article is left out, and an article inside a doubtful container is
found. Inside an article or main element only containers are told by role, class or an unmistakable id, headings nowhere,
and sections never by id: their names speak of the subject.

Defined results: null and empty html give an empty text; open p, li, dt, dd and table elements end where the next one
or their parent's next block begins, other unclosed elements with their parent; end tags without an open element end
nothing; embedded ones (video, svg, object and the like) that are self-closed or never closed drop their tag only,
truncated markup is dropped; the text of formulas is kept, annotations included; character references are decoded once;
repeated rows get equal rows. Extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape
from math import log

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridgeline.llm.common import in_small_batches, tidy

# Element names and hints.
RAW = frozenset("style textarea title iframe option".split())  # text up to the end tag, whatever it holds; an option's may be left out
EMBEDDED = frozenset("noscript template svg object canvas video audio select".split())
LABELS = frozenset("style title option".split())  # unclosed, they still own the text up to the next tag
MATH = frozenset(
    "math mi mn mo ms mspace mtext mrow mfrac msqrt mroot mstyle merror mpadded mphantom mfenced menclose msub msup msubsup munder mover munderover mmultiscripts mprescripts none mtable mtr mlabeledtr mtd maction semantics annotation annotation-xml".split()
)
CONTAINERS = frozenset("div section ul ol li dl table tbody tr td header details figure center".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
SKIPPED = frozenset("nav aside footer form button menu dialog fieldset datalist".split())
#: Open elements that a start tag ends, unless one of the bounds was opened after them.
P_ENDERS = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section summary table ul".split())
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th", "caption", "colgroup"), "td": ("td", "th"), "th": ("td", "th")} | {x: ("tr", "td", "th", "thead", "tbody", "tfoot", "caption", "colgroup") for x in ("thead", "tbody", "tfoot")}
BOUNDS = {"li": ("ul", "ol", "menu", "dir"), "dt": ("dl",), "dd": ("dl",)}
SCOPE = ("table", "td", "th", "caption", "button", "html")
INLINE = frozenset("a abbr acronym b bdi bdo big cite code del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr br".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ROOTS = frozenset("html body main article".split())
CONTENT = frozenset("article main".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar form".split())
HINTS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adbox banner sponsor sponsored promo promotion promoted nav navbar navigation menu menubar breadcrumb breadcrumbs footer foot sidebar side aside widget widgets related recommended recommendations comment comments commentlist respond reply replies disqus discussion cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe subscription signup share sharing social pagination pager toolbar login search searchform form copyright legal".split()
)
HEADS = frozenset("header masthead topbar".split())
#: A class or id of these and fillers alone tells page furniture for sure; an id inside the content is told by nothing else.
FURNITURE = frozenset("ad ads adv advert adverts advertisement advertising adsense adbox banner sponsored nav navbar navigation menubar breadcrumb breadcrumbs sidebar widget widgets comments commentlist respond disqus gdpr newsletter pagination pager toolbar".split())
NAMED = FURNITURE | frozenset("menu footer aside comment cookie cookies consent notice notices sponsor promo popup modal overlay".split())
FILLERS = frozenset("area bar block bottom box container form item left list main page right section site slot thread top unit wrap wrapper".split())
#: What the score of a sequence inside a doubtful element counts for.
HINTED = 0.1

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<script(?=[\s/>])[^>]*>.*?(?:</script(?=[\s/>])[^>]*>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?>[^<>\"']|\"[^\"]*\"|'[^']*')*)>|</?[a-zA-Z][^>]*(?:>|\Z)|<[!?/][^>]*(?:>|\Z)", re.S | re.I)
_ATTRIBUTE = re.compile(r"""(?<![\w-])(class|id|role|style|aria-hidden|hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_END = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.I) for name in RAW}
_PARTS = re.compile(r"[a-z0-9]+")
_SPACE = re.compile(r"\s+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")

#: Prior counts (inside the content, outside) of what a page is made of, as from a handful of ordinary pages (fixed values).
PRIOR = {"word": (900, 200), "link word": (20, 150), "p": (60, 4), "br": (6, 3), "h1": (4, 1), "h2": (8, 2), "h3": (8, 4), "li": (8, 40), "ul": (2, 8), "a": (10, 100), "div": (6, 60), "span": (6, 30), "td": (4, 20), "tr": (2, 10), "table": (1, 3), "b": (8, 2), "i": (8, 2), "em": (8, 2), "strong": (8, 2), "blockquote": (4, 1), "section": (3, 6), "img": (3, 12)}
NOTHING = -1.0


def _all_named(parts: set[str], names: frozenset[str]) -> bool:
    return bool(parts & names) and all(x in names or x in FILLERS or x.isdigit() for x in parts)


def told(tag: str, attributes: str, inside: bool) -> str:
    """'furniture' (surely no article text), 'doubtful', or '' for an element by its name and attributes."""
    if tag in SKIPPED:
        return "furniture"
    if tag in ROOTS:
        return ""
    if tag == "header" and not inside:
        return "furniture"
    heard, doubt = tag not in HEADINGS and (not inside or tag in CONTAINERS or "-" in tag), ""
    for name, value in _ATTRIBUTE.findall(attributes) if attributes else ():
        name, value = name.lower(), value.strip("\"'")
        if name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and "display:none" in value.replace(" ", "").lower():
            return "furniture"
        if not heard:
            continue
        if name == "role" and value.lower() in ROLES:
            return "furniture"
        if name in ("class", "id"):
            each = [set(_PARTS.findall(_CAMEL.sub(" ", x).lower())) for x in value.split()]
            if name == "id" and (inside or tag == "section"):
                if not (inside and tag == "section") and any(_all_named(x, FURNITURE) for x in each):
                    return "furniture"
            elif any(_all_named(x, NAMED) for x in each) or any(x & HEADS for x in each) and not inside:
                return "furniture"
            elif any(x & HINTS for x in each):
                doubt = "doubtful"
    return doubt


def _tags(html: str) -> list[tuple[int, int, str, bool, str]]:
    """(start, end, name, is an end tag, attributes) in page order; what leaves no trace has an empty name.

    A raw or embedded element with its end tag is one such entry; without one, or self-closed, its tag alone is.
    """
    out: list[tuple[int, int, str, bool, str]] = []
    opened: dict[str, list[int]] = {}
    endless: set[str] = set()
    at = 0
    while m := _TOKEN.search(html, at):
        at = m.end()
        name = (m[2] or "").lower()
        if name in RAW:
            close = None
            if not m[1] and not m[3].endswith("/"):
                close = None if name in endless or name == "option" else _END[name].search(html, at)
                if close is None:
                    endless.add(name)
                if close:
                    at = close.end()
                elif name in LABELS:
                    at = n if (n := html.find("<", at)) >= 0 else len(html)
            name = ""
        elif name in EMBEDDED:
            if m[1] and opened.get(name):
                k = opened[name].pop()
                for other in opened.values():  # what opened within has no end tag there
                    while other and other[-1] > k:
                        other.pop()
                start = out[k][0]
                del out[k:]
                out.append((start, at, "", False, ""))
                continue
            if not m[1] and not m[3].endswith("/"):
                opened.setdefault(name, []).append(len(out))
            name = ""
        out.append((m.start(), at, name, bool(m[1]), m[3] or ""))
    return out


class _Open:
    """The open elements of a page, each with what holds inside it: skipped, in the content, its sequence."""

    def __init__(self):
        self.stack: list[tuple[str, bool, bool, int]] = []
        self.at: dict[str, list[int]] = {}
        self.blocks: list[int] = []
        self.links = 0

    def now(self) -> tuple[bool, bool, int]:
        return self.stack[-1][1:] if self.stack else (False, False, 0)

    def last(self, names: tuple[str, ...]) -> int:
        return max((self.at[x][-1] for x in names if self.at.get(x)), default=-1)

    def push(self, name: str, skipped: bool, inside: bool, sequence: int) -> None:
        self.at.setdefault(name, []).append(len(self.stack))
        if name not in INLINE and name not in MATH and "-" not in name:
            self.blocks.append(len(self.stack))
        self.links += name == "a"
        self.stack.append((name, skipped, inside, sequence))

    def cut(self, k: int) -> None:
        """Ends the elements from the k-th on."""
        while len(self.stack) > k:
            name = self.stack.pop()[0]
            self.at[name].pop()
            self.links -= name == "a"
        while self.blocks and self.blocks[-1] >= k:
            self.blocks.pop()

    def end(self, name: str) -> None:
        """An end tag. One of an inline element ends no block, one of another element no cell of a table."""
        k = self.last((name,))
        bound = self.blocks[-1] if self.blocks and (name in INLINE or name in MATH) else self.last(SCOPE) if name not in SCOPE and name not in ("tr", "thead", "tbody", "tfoot") and name not in ROOTS else -1
        if k >= 0 and k >= bound:
            self.cut(k)

    def start(self, name: str) -> None:
        """Ends what the start tag of an element ends."""
        if name in P_ENDERS and (k := self.last(("p",))) > self.last(SCOPE):
            self.cut(k)
        if name in ENDS:
            bound = self.last(BOUNDS.get(name, ("table",)) + (SCOPE if name in BOUNDS else ()))
            opened = [self.at[x][-1] for x in ENDS[name] if self.at.get(x) and self.at[x][-1] > bound]
            if opened:
                self.cut(min(opened))


def pieces(html: str) -> list[tuple[str, object, bool, int]]:
    """('block', [(kind, raw text)...], inside article or main, sequence) and ('tag', name, inside, sequence) in page order.

    kind is 'word' or 'link word'. Furniture leaves no trace, so that a region can reach across an advert. Sequence 0 is the
    page; a doubtful element begins another one. The last piece is ('depths', how many doubtful elements are around each).
    """
    out: list[tuple] = []
    parts: dict[int, list[tuple[str, str]]] = {}
    within: dict[int, bool] = {}
    depths = [0]
    open_ = _Open()
    at = 0

    def text(part: str) -> None:
        skipped, inside, own = open_.now()
        if part and not skipped:
            parts.setdefault(own, []).append(("link word" if open_.links else "word", part))
            within[own] = inside

    def flush() -> None:
        for own, some in parts.items():
            if any(not p.isspace() for _, p in some):
                out.append(("block", some, within[own], own))
        parts.clear()

    for start, end, name, closing, attributes in _tags(html):
        text(html[at:start])
        at = end
        if not name:
            continue
        inline = name in INLINE or name in MATH or "-" in name
        if closing:
            open_.end(name)
            if not inline and not open_.now()[0]:
                flush()
            continue
        if not inline:
            open_.start(name)
        skipped, inside, own = open_.now()
        what = "furniture" if skipped else told(name, attributes, inside)
        if not skipped and not inline:
            flush()
        if what == "doubtful" and name not in VOID:
            depths.append(depths[own] + 1)
            own = len(depths) - 1
        if what != "furniture" and name not in MATH:
            out.append(("tag", name, inside, own))
        if name in ("br", "mtd"):
            text(" ")
        if name in VOID or name in MATH and attributes.endswith("/") or name == "a" and open_.links:
            continue
        open_.push(name, what == "furniture", inside or name in CONTENT, own)
    text(html[at:])
    flush()
    return [*out, ("depths", depths, False, -1)]


def block_text(parts: list[tuple[str, str]]) -> str:
    return _SPACE.sub(" ", unescape("".join(p for _, p in parts))).strip()


def counts(html: str) -> Counter:
    """Counts of (feature, inside) of a labelled page; empty if the page does not mark its content exactly once."""
    found: Counter = Counter()
    marks = 0
    for kind, what, inside, _ in pieces(html)[:-1]:
        if kind == "tag":
            marks += what in CONTENT
            if what not in ROOTS:
                found[what, inside] += 1
        else:
            for part, text in what:
                found[part, inside] += len(text.split())
    return found if marks == 1 else Counter()


def weights(found: Counter) -> dict[str, float]:
    """Log odds of standing inside the content; words at least 0.1, tags at most -0.01 and at least -3."""
    total = Counter(found)
    for name, (a, b) in PRIOR.items():
        total[name, True] += a
        total[name, False] += b
    names = {n for n, _ in total}
    words = {"word", "link word"}
    out = {}
    sums = {(k, side): sum(total[n, side] for n in names if (n in words) == k) for k in (True, False) for side in (True, False)}
    for n in names:
        k = n in words
        odds = log((total[n, True] + 0.5) / (sums[k, True] + 1)) - log((total[n, False] + 0.5) / (sums[k, False] + 1))
        out[n] = max(0.1, min(1.0, 0.5 + 0.5 * odds)) if k else max(-3.0, min(-0.01, odds))
    return out


def best_region(scores: list[float]) -> tuple[int, int]:
    """Start and end (exclusive) of the contiguous run with the highest sum; the first, then the longest of equals; (0, 0) if none is positive."""
    best, region, total, start = 0.0, (0, 0), 0.0, 0
    for i, x in enumerate(scores):
        if total <= 0:
            total, start = 0.0, i
        total += x
        if total > best or total == best and region[0] == start and best > 0:
            best, region = total, (start, i + 1)
    return region


def extract(html: str | None, weight: dict[str, float]) -> str:
    """The main text: blocks of the best region of the best sequence, joined by blank lines."""
    if not html:
        return ""
    *found, (_, depths, _, _) = pieces(html)
    sequences: list[list] = [[] for _ in depths]
    for kind, what, _, own in found:
        sequences[own].append((weight.get(what, NOTHING), None) if kind == "tag" else (sum(weight[k] * len(t.split()) for k, t in what), what))
    best, blocks = 0.0, []
    for depth, sequence in zip(depths, sequences):
        scores = [x for x, _ in sequence]
        a, b = best_region(scores)
        if (total := HINTED**depth * sum(scores[a:b])) > best:
            best, blocks = total, [what for _, what in sequence[a:b] if what]
    return "\n\n".join(t for what in blocks if (t := block_text(what)))


def learn(pages: DataFrame, sample: int = 1000) -> dict[str, float]:
    """Weights from the labelled ones among at most `sample` pages of (page_id, html)."""
    ids = pages.select("page_id").where("page_id is not null").distinct().orderBy(F.xxhash64("page_id"), "page_id").limit(sample)
    some = pages.join(F.broadcast(ids), "page_id", "left_semi").groupBy("page_id").agg(F.min("html").alias("html")).select("html")

    @tidy
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for batch in batches:
            for html in batch.column(0):
                found.update(counts(html.as_py() or ""))
        yield pa.RecordBatch.from_arrays([pa.array([n for n, _ in found], pa.string()), pa.array([i for _, i in found], pa.bool_()), pa.array(list(found.values()), pa.int64())], names=["name", "inside", "n"])

    rows = some.mapInArrow(counted, "name string, inside boolean, n long").groupBy("name", "inside").agg(F.sum("n").alias("n"))
    top = rows.orderBy(F.desc("n"), "name", "inside").limit(2000)  # names of elements; pages can invent any number
    return weights(Counter({(r.name, r.inside): r.n for r in top.collect()}))


def main_text(pages: DataFrame, sample: int = 1000) -> DataFrame:
    """page_id, url, text and n_chars of every row of pages."""
    rows = in_small_batches(pages).select(pages["page_id"].cast("long").alias("page_id"), pages["url"].cast("string").alias("url"), pages["html"].cast("string").alias("html"))
    weight = learn(rows, sample)

    @tidy
    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(h.as_py(), weight) for h in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return rows.mapInArrow(extracted, "page_id long, url string, text string, n_chars long")
