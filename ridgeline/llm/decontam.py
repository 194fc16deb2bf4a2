"""Benchmark decontamination by q-gram lemma filtering.

A benchmark item of m characters that stands in a document with at most k edits shares at least m - q + 1 - k * q of
its q-grams with it, on diagonals (place in the document minus place in the item) that lie within k of each other.
Documents are scanned once: rolling hashes of all q-grams are looked up among the items' q-grams, shared ones are
counted in overlapping diagonal bands, and regions that reach the lemma's bound are verified by banded alignment.

Texts are compared lower-cased, with white space as single spaces. k is `rate` of the item's length, rounded down. An
item of any length has to stand whole, within its k edits: the law is the same for short and long ones. q is `Q`, or
smaller for items so short that the bound would fall below one shared q-gram (q * (k + 1) <= m), so that no match is
missed. `window` cuts longer items into overlapping windows of that many characters first, each an item of its own; it
is off unless asked for.

Shared q-grams are only counted, in steps of at most `PAIRS` pairs and texts in steps of `PASS` characters, so that
neither long texts nor repetitive ones need memory for their pairs. The items' index is broadcast in blocks of at most
`BLOCK_CHARS` characters, each checked against all documents: a benchmark of n blocks costs n scans.

Defined results: null and empty texts and items match nothing; an item of one word is found wherever its letters stand,
so that a benchmark should hold no such items; items without an id count and are reported with a null id; repeated rows
each get their matches; ties go to fewer edits, then the earlier place. Extra columns are ignored by `matches` and kept
by `clean`.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridgeline.llm.common import in_small_batches, mix, pruned, tidy

Q = 8
RATE = 0.08
BLOCK_CHARS = 2_000_000
#: Characters of documents that one numpy pass handles.
PASS = 1 << 18
#: Pairs of places (in the text, in an item) that are counted at a time.
PAIRS = 1 << 20
#: Diagonals that one alignment takes; wider regions are cut into overlapping ones.
LANES = 1 << 16
_FILTER_BITS = 22
_BASE = 0x9E3779B97F4A7C15
_U = np.uint64
_SPACES = re.compile(r"[^\S ]\s*| \s+")


def plain(text: str | None) -> str:
    return _SPACES.sub(" ", text.lower()).strip() if text else ""


def points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def gram_hashes(codes: np.ndarray, q: int) -> np.ndarray:
    """64-bit hash of the q-gram that starts at each place (as many as places, less q - 1), built from doublings."""
    if len(codes) < q:
        return np.zeros(0, np.uint64)
    power, width, out, have = codes.astype(np.uint64), 1, None, 0
    while True:
        if q & width:
            out = power if out is None else out[: len(codes) - have - width + 1] + power[have:] * _U(pow(_BASE, have, 2**64))
            have += width
        if have == q:
            return mix(out)
        power = power[:-width] + power[width:] * _U(pow(_BASE, width, 2**64))
        width *= 2


def budget_of(length: int, rate: float) -> int:
    return int(length * rate)


def gram_size(length: int, rate: float) -> int:
    """The largest q up to Q whose bound asks for one shared q-gram at least."""
    return max(1, min(Q, length // (budget_of(length, rate) + 1)))


def needed(length: int, q: int, rate: float) -> int:
    """The q-gram lemma's bound."""
    return length - q + 1 - budget_of(length, rate) * q


@dataclass
class Grams:
    """q-grams of the items of one q, sorted by hash: their item's number and their place in it."""

    q: int
    hashes: np.ndarray
    item: np.ndarray
    place: np.ndarray
    known: np.ndarray


@dataclass
class Index:
    """Items (id, plain text), the edits each may have, and their q-grams by q."""

    items: list[int | None]
    texts: list[str]
    budget: np.ndarray
    least: np.ndarray
    grams: list[Grams]
    longest: int


def build(items: list[tuple[int | None, str]], rate: float = RATE, window: int | None = None) -> Index:
    names, texts = [], []
    for item, text in items:
        text = plain(text)
        starts = range(0, len(text) - window // 2, window // 2) if window and len(text) > window else (0,)
        for a in starts:
            part = text[max(0, min(a, len(text) - window)) :][:window] if window else text
            if part:
                names.append(item)
                texts.append(part)
    sizes = [gram_size(len(t), rate) for t in texts]
    by_size = []
    for q in sorted(set(sizes)):
        own = [i for i, s in enumerate(sizes) if s == q]
        parts = [gram_hashes(points(texts[i]), q) for i in own]
        hashes = np.concatenate(parts)
        order = np.argsort(hashes, kind="stable")
        item = np.repeat(np.array(own, np.int32), [len(p) for p in parts])[order]
        place = np.concatenate([np.arange(len(p), dtype=np.int32) for p in parts])[order]
        known = np.zeros(1 << _FILTER_BITS, bool)
        known[(hashes >> _U(64 - _FILTER_BITS)).astype(np.int64)] = True
        by_size.append(Grams(q, hashes[order], item, place, known))
    budget = np.array([budget_of(len(t), rate) for t in texts], np.int64)
    least = np.array([needed(len(t), q, rate) for t, q in zip(texts, sizes)], np.int64)
    return Index(names, texts, budget, least, by_size, max(map(len, texts), default=0))


def aligned(item: np.ndarray, text: np.ndarray, low: int, high: int, budget: int) -> tuple[int, int, int] | None:
    """(edits, start, end) of the whole item's best alignment with a part of text whose diagonals (place in text minus
    place in item) stay in [low, high], or None beyond the budget. Row by row over the item, one numpy step a row."""
    width = high - low + 1
    far = budget + 1
    lanes = np.arange(width)
    column = low + lanes  # text characters used before item row 0
    inside = (column >= 0) & (column <= len(text))
    cost = np.where(inside, 0, far)
    start = column.copy()
    for i in range(1, len(item) + 1):
        column = low + lanes + i
        inside = (column >= 0) & (column <= len(text))
        char = text[np.clip(column - 1, 0, max(0, len(text) - 1))] if len(text) else np.zeros(width, np.uint32)
        step = cost + np.where((column >= 1) & (char == item[i - 1]), 0, 1)  # match or replace
        step = np.where(column >= 1, step, far)
        drop = np.append(cost[1:], far) + 1  # item character without partner
        took = drop < step
        now, begin = np.where(took, drop, step), np.where(took, np.append(start[1:], 0), start)
        now = np.where(inside, now, far)
        chain = np.minimum.accumulate(now - lanes)  # text characters without partner, along the row
        run = chain + lanes
        better = run < now
        if better.any():
            source = np.maximum.accumulate(np.where(now - lanes == chain, lanes, 0))
            now, begin = np.where(better, run, now), np.where(better, begin[source], begin)
        cost, start = np.minimum(now, far), begin
        if cost.min() >= far:
            return None
    best = int(np.argmin(cost))
    if cost[best] > budget:
        return None
    return int(cost[best]), int(start[best]), int(low + best + len(item))


def _merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    key, back = np.unique(np.concatenate(keys), return_inverse=True)
    return key, np.bincount(back, np.concatenate(counts), len(key)).astype(np.int64)


class Bands:
    """Shared q-grams of some texts, counted by text, item and diagonal band. Band j of an item covers its diagonals from
    j * k to (j + 1) * k - 1 (k at least 1); two neighbours make one of the lemma's overlapping bands."""

    def __init__(self, index: Index, rows: int, longest: int):
        self.index, self.span = index, np.maximum(index.budget, 1)
        self.shift = index.longest + 1  # bands are numbered from 0
        self.bands = longest + 2 * self.shift + 2
        self.keys: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        assert rows * len(index.items) * self.bands < 2**62

    def add(self, grams: Grams, hashes: np.ndarray, first: int, starts: np.ndarray) -> None:
        """hashes: q-grams from place `first` on of a text, or of several texts that begin at `starts`."""
        hit = np.flatnonzero(grams.known[(hashes >> _U(64 - _FILTER_BITS)).astype(np.int64)])
        left = np.searchsorted(grams.hashes, hashes[hit], "left")
        each = np.searchsorted(grams.hashes, hashes[hit], "right") - left
        hit, left, each = hit[each > 0], left[each > 0], each[each > 0]
        ends = np.cumsum(each)
        i = 0
        while i < len(hit):
            j = max(i + 1, int(np.searchsorted(ends, ends[i] - each[i] + PAIRS, "right")))
            n = each[i:j]
            which = np.repeat(left[i:j] - np.append(0, np.cumsum(n)[:-1]), n) + np.arange(n.sum())
            row = np.searchsorted(starts, hit[i:j], "right") - 1
            item = grams.item[which].astype(np.int64)
            diagonal = np.repeat(hit[i:j] - starts[row] + first, n) - grams.place[which] + self.shift * self.span[item]
            key = (np.repeat(row, n) * len(self.index.items) + item) * self.bands + diagonal // self.span[item]
            low = int(key.min())
            if (reach := int(key.max()) - low + 1) <= 4 * PAIRS:
                count = np.bincount(key - low, minlength=reach)
                some = np.flatnonzero(count)
                self.keys.append(some + low)
                self.counts.append(count[some])
            else:
                key, count = np.unique(key, return_counts=True)
                self.keys.append(key)
                self.counts.append(count)
            if sum(map(len, self.keys[1:])) > 4 * PAIRS:  # entries of the same bands come together again
                self.keys, self.counts = map(lambda x: [x], _merged(self.keys, self.counts))
            i = j

    def regions(self) -> Iterator[tuple[int, int, list[tuple[int, int]]]]:
        """(row, item, ranges of diagonals to align, ascending) wherever two neighbouring bands reach the item's bound."""
        if not self.keys:
            return
        key, count = _merged(self.keys, self.counts)
        near = np.append(np.where(np.diff(key) == 1, count[1:], 0), 0)
        item = key // self.bands % len(self.index.items)
        good = count + near >= self.index.least[item]
        key, item = key[good], item[good]
        owner = key // self.bands
        cuts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1])) if len(key) else []
        for a, b in zip(cuts, np.append(cuts[1:], len(key))):
            w, span = int(item[a]), int(self.span[item[a]])
            k = int(self.index.budget[w])
            band = key[a:b] % self.bands - self.shift
            low, high = band * span - k, (band + 2) * span - 1 + k
            new = np.flatnonzero(np.append(True, low[1:] > high[:-1] + 1))
            ranges = []
            for x, y in zip(low[new].tolist(), high[np.append(new[1:], len(low)) - 1].tolist()):
                ranges += [(s, min(s + LANES + 2 * k, y)) for s in range(x, y + 1, LANES)]
            yield int(owner[a]) // len(self.index.items), w, ranges


def _verified(text: str, codes: np.ndarray | None, index: Index, w: int, ranges: list[tuple[int, int]], first: bool) -> tuple[tuple[int, int, int] | None, np.ndarray | None]:
    """(edits, start, end) of item w in a text, or None, and the text's code points if they were needed."""
    part = index.texts[w]
    exact = text.find(part)
    if exact >= 0:
        return (0, exact, exact + len(part)), codes
    best, k = None, int(index.budget[w])
    own = points(part)
    for low, high in ranges if k else ():
        codes = points(text) if codes is None else codes
        a, b = max(0, low), max(0, min(len(codes), high + len(part) + 1))  # the part of the text that these diagonals meet
        got = aligned(own, codes[a:b], low - a, high - a, k)
        if got is not None:
            got = (got[0], got[1] + a, got[2] + a)
            best = got if best is None or got < best else best
            if first or best[0] == 1:  # it doesn't stand verbatim
                break
    return best, codes


def scan(texts: list[str | None], index: Index, first: bool = False) -> Iterator[tuple[int, int, int, int, int]]:
    """(row, number of the item in the index, edits, start, end) of the items found; with `first`, one item a text is enough."""
    clean = [plain(t) for t in texts]
    longest = max((g.q for g in index.grams), default=1)
    i, n = 0, len(clean)
    while i < n and index.items:
        j, size = i, 0
        while j < n and (j == i or size + len(clean[j]) < PASS):
            size += len(clean[j]) + 1
            j += 1
        some = clean[i:j]
        bands = Bands(index, j - i, max(map(len, some)))
        if j == i + 1:
            starts = np.zeros(1, np.int64)
            for at in range(0, len(some[0]), PASS):
                codes = points(some[0][at : at + PASS + longest - 1])
                for g in index.grams:
                    bands.add(g, gram_hashes(codes, g.q)[:PASS], at, starts)
        else:
            starts = np.append(0, np.cumsum([len(t) + 1 for t in some])[:-1])
            codes = points("\n".join(some))  # no item has a line break, so that no q-gram spans two texts
            for g in index.grams:
                bands.add(g, gram_hashes(codes, g.q), 0, starts)
        row, done, codes = -1, False, None
        for r, w, ranges in bands.regions():
            if r != row:
                row, done, codes = r, False, None
            if done:
                continue
            got, codes = _verified(some[r], codes, index, w, ranges, first)
            if got is not None:
                done = first
                yield i + r, w, *got
        i = j


def found_in(texts: list[str | None], index: Index) -> list[tuple[int, int | None, int, int, int]]:
    """(row, item id, edits, start, end), the best place of each item in each text."""
    best: dict[tuple, tuple[int, int, int]] = {}
    for row, w, *place in scan(texts, index):
        key = (row, index.items[w] is None, index.items[w] if index.items[w] is not None else w)
        best[key] = min(best.get(key, tuple(place)), tuple(place))
    return [(row, None if none else item, *place) for (row, none, item), place in sorted(best.items())]


def blocks(benchmark: DataFrame, rate: float, window: int | None, item_id: str = "item_id", text: str = "text") -> Iterator[Index]:
    """Indexes over blocks of items of at most BLOCK_CHARS characters (a longer item alone)."""
    if not 0 <= rate <= 0.5:
        raise ValueError("rate is a share of edits from 0 to 0.5")
    rows, size = [], 0
    for item, t in benchmark.select(benchmark[item_id].cast("long").alias("i"), benchmark[text].cast("string").alias("t")).orderBy("i", "t").toLocalIterator():
        if not t:
            continue
        if rows and size + len(t) > BLOCK_CHARS:
            yield build(rows, rate, window)
            rows, size = [], 0
        rows.append((item, t))
        size += len(t)
    if rows:
        yield build(rows, rate, window)


_SCHEMA = "doc_id long, item_id long, edits int, start long, end long"


def matches(docs: DataFrame, benchmark: DataFrame, rate: float = RATE, window: int | None = None) -> DataFrame:
    """One row for each document and item found in it: doc_id, item_id, edits, start and end in the plain text."""
    spark, out = docs.sparkSession, None
    for index in blocks(benchmark, rate, window):
        shared = spark.sparkContext.broadcast(index)

        @tidy
        def found(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids = batch.column(0).to_pylist()
                rows = [(ids[r], item, edits, s, e) for r, item, edits, s, e in found_in(batch.column(1).to_pylist(), shared.value)]
                columns = list(zip(*rows)) if rows else [[]] * 5
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["doc_id", "item_id", "edits", "start", "end"])

        part = pruned(docs).mapInArrow(found, _SCHEMA)
        out = part if out is None else out.unionByName(part)
    return spark.createDataFrame([], _SCHEMA) if out is None else out


def clean(docs: DataFrame, benchmark: DataFrame, rate: float = RATE, text: str = "text", window: int | None = None) -> DataFrame:
    """docs without rows that contain an item; columns stay as they are, no row moves."""
    docs = in_small_batches(docs)
    for index in blocks(benchmark, rate, window):
        docs = docs.where(_free(docs.sparkSession.sparkContext.broadcast(index))(docs[text].cast("string")))
    return docs


def _free(shared):
    @tidy
    def free(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            hit = {r for r, *_ in scan(texts.to_pylist(), shared.value, first=True)}
            yield pa.array([r not in hit for r in range(len(texts))], pa.bool_())

    return F.arrow_udf(free, "boolean")
