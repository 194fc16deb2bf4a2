"""Quality rules by compression bands.

zstandard ratios (compressed over plain bytes) of the whole text and of fixed chunks say how predictable a text is. A
rest beyond the last full chunk is tested too, in the last chunk's length of the text, and counts by its own bytes.
Text that repeats itself, or is made of few marks, compresses better than prose of its length, random text worse; short
texts compress badly whatever they say, so that the limits depend on the length. Beside the bands stand plain counts:
words, symbols, repeated lines, words inside repeated three-word windows.

The limits are fixed bands, or fitted (`fitted`) to all labelled texts: the usual ratio at each length is that of texts of
label 1, and the lower (upper) limit the share of it that tells most texts of label 0 from those, where a text lost counts
`LOSS` times one caught. Without labels of both kinds, or beyond the labelled lengths, the fixed bands hold.

Defined results: null counts as empty; an empty text has zero counts, ratio 1.0, and fails the base rule; very long
texts are read whole, chunk by chunk. Repeated rows get equal rows; extra columns are ignored by `quality`.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import log2

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ridgeline.llm.common import SPACES, Tables, filter_bit, in_small_batches, membership, passes, pruned, tidy

SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Band:
    """Limits for texts of fewer than `below` bytes (None: any length)."""

    below: int | None
    lowest: float
    highest: float


#: Bands of the whole text. Frame and table overhead lifts short ratios; the floor falls and the ceiling drops with length.
WHOLE = (Band(64, 0.0, 2.0), Band(256, 0.40, 1.05), Band(1024, 0.36, 0.90), Band(4096, 0.30, 0.80), Band(32768, 0.25, 0.72), Band(None, 0.20, 0.70))
#: Limits of one chunk.
CHUNK_BYTES = 1024
CHUNK = Band(None, 0.30, 0.80)
#: Share of a text's chunks, by the bytes they stand for, that may lie outside the chunk limits.
BAD_CHUNKS = 0.5
#: What a sound text lost weighs against one caught; sound texts a length needs.
LOSS = 10.0
LEAST_SOUND = 20


@dataclass(frozen=True)
class Limits:
    """Fixed bands, and within the labelled lengths (log2 of bytes) shares of the usual ratio there."""

    bands: tuple[Band, ...] = WHOLE
    chunk: Band = CHUNK
    lengths: tuple[float, ...] = ()
    usual: tuple[float, ...] = ()
    low: float | None = None
    high: float | None = None

    def of(self, size: int) -> tuple[float, float]:
        own = next(b for b in self.bands if b.below is None or size < b.below)
        if not self.lengths or not self.lengths[0] <= (x := log2(max(size, 1))) <= self.lengths[-1]:
            return own.lowest, own.highest
        usual = float(np.interp(x, self.lengths, self.usual))
        return own.lowest if self.low is None else self.low * usual, own.highest if self.high is None else self.high * usual


LEVEL = 3
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50


def counts(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    words = text.encode().split()  # bytes split at the six ASCII spaces only
    spaces = sum(map(text.count, SPACES.decode()))
    symbols = sum(map(text.count, SYMBOLS))
    seen: set[str] = set()
    repeated = 0
    for line in text.split("\n"):
        if line in seen:
            repeated += 1
        elif line.strip(SPACES.decode()):
            seen.add(line)
    return len(words), len(text) - spaces, symbols, repeated, repeat_words(words)


def repeat_words(words: list[bytes]) -> int:
    """Words in three-word windows that occur twice or more in the text, the first occurrence included."""
    first: dict[tuple, int] = {}
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    hit = bytearray(len(words))
    for i, w in enumerate(windows):
        j = first.setdefault(w, i)
        if j != i:
            hit[i : i + 3] = hit[j : j + 3] = b"\1\1\1"
    return sum(hit)


def ratios(raw: bytes, compressor: zstandard.ZstdCompressor, chunk_bytes: int = CHUNK_BYTES) -> tuple[float, list[float]]:
    """Ratio of the whole text (1.0 if empty) and of each chunk: the full ones, then the text's last chunk_bytes if they leave a rest."""
    if not raw:
        return 1.0, []
    whole = len(compressor.compress(raw)) / len(raw)
    starts = list(range(0, len(raw) - chunk_bytes + 1, chunk_bytes))
    if starts and len(raw) % chunk_bytes:
        starts.append(len(raw) - chunk_bytes)
    return whole, [len(compressor.compress(raw[i : i + chunk_bytes])) / chunk_bytes for i in starts]


def verdict(whole: float, chunks: list[float], size: int, limits: Limits = Limits(), bad: float = BAD_CHUNKS) -> str:
    """'ok', or why not: 'repetitive' or 'incompressible' (the whole text's limits first, then the share of bad chunks)."""
    lowest, highest = limits.of(size)
    if whole < lowest:
        return "repetitive"
    if whole > highest:
        return "incompressible"
    stands = [min(CHUNK_BYTES, size - i * CHUNK_BYTES) for i in range(len(chunks))]
    low = sum(n for r, n in zip(chunks, stands) if r < limits.chunk.lowest)
    high = sum(n for r, n in zip(chunks, stands) if r > limits.chunk.highest)
    if low + high > bad * sum(stands):
        return "repetitive" if low >= high else "incompressible"
    return "ok"


def best_limit(sound: np.ndarray, junk: np.ndarray, n_sound: np.ndarray | None = None, n_junk: np.ndarray | None = None) -> float | None:
    """The value below which junk falls and sound texts don't, as far as it goes: the share of junk below less LOSS times that
    of sound texts below is highest (the least of equals), or None if it is nowhere above 0."""
    n_sound = np.ones(len(sound)) if n_sound is None else n_sound
    n_junk = np.ones(len(junk)) if n_junk is None else n_junk
    if not n_sound.sum() or not n_junk.sum():
        return None
    values = np.unique(np.concatenate([sound, junk]))
    below = lambda v, n: np.concatenate([[0], np.cumsum(n[np.argsort(v)])])[np.searchsorted(np.sort(v), values)] / n.sum()
    gain = below(junk, n_junk) - LOSS * below(sound, n_sound)
    i = int(np.argmax(gain))
    return float((values[i - 1] + values[i]) / 2) if gain[i] > 0 else None


@tidy
def _measured(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    """Bytes, ratio and chunk ratios (in 256ths) of the texts whose bit is set in the shared filter."""
    compressor = zstandard.ZstdCompressor(level=LEVEL)
    kinds = {"doc_id": pa.int64(), "n": pa.int64(), "ratio": pa.float64(), "chunks": pa.list_(pa.int32())}
    for batch in batches:
        rows = []
        for i in np.flatnonzero(passes(shared.value, np.asarray(batch.column("bit")))):
            raw = (batch.column("text")[i].as_py() or "").encode()
            whole, parts = ratios(raw, compressor)
            rows.append((batch.column("doc_id")[i].as_py(), len(raw), whole, [round(256 * r) for r in parts]))
        columns = zip(*rows) if rows else [[]] * len(kinds)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds.values())], names=list(kinds))


def measured(tables: Tables, docs: DataFrame, labels: DataFrame, label: str, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """A table (n, ratio, chunks, y) of every id of label 0 or 1 and its text. Several labels of one id count as their maximum;
    of several texts of one id that of the least (n, ratio, chunks) stands. No text moves: a filter of the labelled ids spares
    most others the compression, and only numbers meet the labels."""
    given = labels.select(labels[doc_id].cast("long").alias("doc_id"), labels[label].cast("int").alias("y")).where("doc_id is not null and y is not null")
    given = given.groupBy("doc_id").agg(F.max("y").alias("y"))
    shared = membership(given, filter_bit(F.col("doc_id")))
    rows = pruned(docs, text, doc_id).where("doc_id is not null").select("doc_id", filter_bit(F.col("doc_id")).alias("bit"), "text")
    rows = rows.mapInArrow(lambda it: _measured(it, shared), "doc_id long, n long, ratio double, chunks array<int>")
    rows = rows.groupBy("doc_id").agg(F.min(F.struct("n", "ratio", "chunks")).alias("of"))
    out = tables.cut(rows.join(given.hint("merge"), "doc_id").where("y in (0, 1)").select("of.*", "y"))
    shared.unpersist()
    return out


def cell(value: Column) -> Column:
    """A few thousand classes of a value above 0, in its order."""
    return F.floor(256 * F.log2(value))


def running(df: DataFrame, cells: list[Column], order: list[str], counts: list[str]) -> DataFrame:
    """Adds `before_<count>`: the sum of each count over all rows before a row, in the order of cells, then of `order`. The sums
    of cells give each cell's first number (broadcast, no more than there are cells); a window adds up inside a cell."""
    keys = [f"__cell{i}" for i in range(len(cells))]
    dealt = df.withColumns(dict(zip(keys, cells)))
    before = Window.orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    inner = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    first = dealt.groupBy(*keys).agg(*(F.sum(c).alias(c) for c in counts))
    first = first.select(*keys, *(F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"__{c}") for c in counts))
    sums = (F.coalesce(F.sum(c).over(inner), F.lit(0)) + F.col(f"__{c}") for c in counts)
    return dealt.join(F.broadcast(first), keys).select(*df.columns, *(x.alias(f"before_{c}") for x, c in zip(sums, counts)))


def usual_ratios(tables: Tables, texts: DataFrame, sound: int) -> tuple[list[float], list[float]]:
    """Mean log2 of bytes and median ratio of each of up to 40 equal parts of the sound texts, by length, then ratio."""
    parts = max(2, min(40, sound // LEAST_SOUND))
    small, more = divmod(sound, parts)
    start = lambda part: f"({part} * {small}L + least({part}, {more}))"
    part_of = lambda i: f"if({i} < {more * (small + 1)}L, {i} div {small + 1}L, {more} + ({i} - {more * (small + 1)}L) div {small}L)"
    sized = F.greatest("n", F.lit(1))
    placed = running(texts.where("sound > 0"), [cell(sized)], ["n", "ratio"], ["sound"])
    placed = placed.withColumn("part", F.expr(f"explode(sequence({part_of('before_sound')}, {part_of('(before_sound + sound - 1)')}))"))
    placed = tables.cut(placed.select("part", "n", "ratio", F.expr(f"least(before_sound + sound, {start('(part + 1)')}) - greatest(before_sound, {start('part')})").alias("sound")))
    # sums of integers, so that no order of adding shows
    means = {r.part: r.x / 2**24 for r in placed.groupBy("part").agg(F.sum(F.round(F.log2(sized) * 2**24).cast("long") * F.col("sound")).alias("x")).collect()}
    lengths = [means[p] / (small + (p < more)) for p in range(parts)]
    by_ratio = running(placed.groupBy("part", "ratio").agg(F.sum("sound").alias("sound")), [F.col("part"), cell(F.col("ratio"))], ["ratio"], ["sound"])
    middle = [f"{start('part')} + (({start('(part + 1)')} - {start('part')}) - {1 - i}) div 2" for i in (0, 1)]
    holds = [F.max(F.expr(f"if(before_sound <= {m} and {m} < before_sound + sound, ratio, null)")) for m in middle]
    medians = {r.part: (r.low + r.high) / 2 for r in by_ratio.groupBy("part").agg(holds[0].alias("low"), holds[1].alias("high")).collect()}
    return lengths, [medians[p] for p in range(parts)]


def best_limits(shares: DataFrame) -> tuple[float | None, float | None]:
    """`best_limit` of the shares of sound and junk texts from below, and from above, for any number of (share, sound, junk)."""
    total = shares.agg(F.sum("sound").alias("sound"), F.sum("junk").alias("junk")).first()
    if not total.sound or not total.junk:
        return None, None
    gain = lambda junk, sound: junk / F.lit(float(total.junk)) - LOSS * (sound / F.lit(float(total.sound)))
    under = [F.col(f"before_{c}") for c in ("junk", "sound")]
    over = [F.lit(total[c]) - F.col(f"before_{c}") - F.col(c) for c in ("junk", "sound")]
    ranked = running(shares, [cell(F.col("share"))], ["share"], ["sound", "junk"])
    best = ranked.agg(
        F.max(F.struct(gain(*under).alias("gain"), (-F.col("share")).alias("at"))).alias("low"), F.max(F.struct(gain(*over).alias("gain"), F.col("share").alias("at"))).alias("high")
    ).first()
    low, high = -best.low.at, best.high.at
    near = shares.agg(F.max(F.when(F.col("share") < low, F.col("share"))).alias("low"), F.min(F.when(F.col("share") > high, F.col("share"))).alias("high")).first()
    return (near.low + low) / 2 if best.low.gain > 0 else None, (near.high + high) / 2 if best.high.gain > 0 else None


def fitted(docs: DataFrame, labels: DataFrame, label: str = "quality", text: str = "text", doc_id: str = "doc_id") -> Limits:
    """Limits fitted to every labelled id. The driver gets the parts' lengths and ratios, the limits, and a histogram of chunk
    ratios; texts of equal numbers are counted once for all, the rest is ranked in cells."""
    limits, tables = Limits(), Tables(docs.sparkSession)
    try:
        found = measured(tables, docs, labels, label, text, doc_id)
        texts = tables.cut(found.groupBy("n", "ratio").agg(F.sum("y").alias("sound"), F.sum(1 - F.col("y")).alias("junk")))
        sized, is_sound = F.greatest("n", F.lit(1)), F.col("sound") > 0
        total = texts.agg(F.sum("sound").alias("sound"), F.sum("junk").alias("junk"), F.min(F.when(is_sound, sized)).alias("least"), F.max(F.when(is_sound, sized)).alias("most")).first()
        if (total.sound or 0) < 2 * LEAST_SOUND or not total.junk:
            return limits
        lengths, usual = usual_ratios(tables, texts, total.sound)
        first, last = log2(total.least), log2(total.most)
        lengths = [first, *(min(max(x, first), last) for x in lengths[1:-1]), last]

        @tidy
        def share(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
            for n, ratio in batches:
                yield pa.array(np.asarray(ratio) / np.interp(np.log2(np.asarray(n)), lengths, usual), pa.float64())

        inside = texts.where(sized.between(total.least, total.most)).select(F.arrow_udf(share, "double")(sized, "ratio").alias("share"), "sound", "junk")
        low, high = best_limits(tables.cut(inside.groupBy("share").agg(F.sum("sound").alias("sound"), F.sum("junk").alias("junk"))))
        bins = found.select("y", F.explode("chunks").alias("r")).groupBy("y", "r").count().orderBy("y", "r").collect()  # a few hundred values of a label
        (a, n), (b, m) = ((np.array([x.r / 256 for x in bins if x.y == y], float), np.array([x["count"] for x in bins if x.y == y], float)) for y in (1, 0))
        lowest, highest = best_limit(a, b, n, m), best_limit(-a, -b, n, m)
        chunk = Band(None, limits.chunk.lowest if lowest is None else lowest, limits.chunk.highest if highest is None else -highest)
        return Limits(limits.bands, chunk, tuple(lengths), tuple(usual), low, high)
    finally:
        tables.drop(*(x for _, x in list(tables.paths.values())))


_SCHEMA = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, whole_ratio double, n_chunks long, reason string"


@tidy
def _scored(batches: Iterator[pa.RecordBatch], limits: Limits, bad: float) -> Iterator[pa.RecordBatch]:
    compressor = zstandard.ZstdCompressor(level=LEVEL)
    names = [x.split()[0] for x in _SCHEMA.split(", ")]
    kinds = [pa.int64()] * 6 + [pa.bool_()] * 2 + [pa.float64(), pa.int64(), pa.string()]
    for batch in batches:
        ids, texts = batch.column(0), batch.column(1)
        out = []
        for text in texts:
            text = text.as_py() or ""
            raw = text.encode()
            n, chars, symbols, lines, repeats = counts(text)
            whole, chunks = ratios(raw, compressor)
            failed = n < MIN_WORDS or 100 * repeats > MAX_REPEAT_PERCENT * n
            why = verdict(whole, chunks, len(raw), limits, bad)
            out.append((n, chars, symbols, lines, repeats, failed, not failed and why == "ok", whole, len(chunks), "base" if failed else why))
        columns = list(zip(*out)) if out else [[] for _ in names[1:]]
        yield pa.RecordBatch.from_arrays([ids, *(pa.array(c, t) for c, t in zip(columns, kinds[1:]))], names=names)


def quality(docs: DataFrame, labels: DataFrame | None = None, limits: Limits = Limits(), bad: float = BAD_CHUNKS, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """A row of counts, ratios and verdicts for each row of docs; with labels (doc_id, quality) the limits are fitted to them."""
    limits = limits if labels is None else fitted(docs, labels, text=text, doc_id=doc_id)
    return pruned(docs, text, doc_id).mapInArrow(lambda it: _scored(it, limits, bad), _SCHEMA)


def good(docs: DataFrame, labels: DataFrame | None = None, limits: Limits = Limits(), bad: float = BAD_CHUNKS, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """docs without rejected rows, columns as they are, in one pass that moves no row.

    The verdict rides on the row itself as an Arrow-batched column, so that no join by id is needed.
    """
    limits = limits if labels is None else fitted(docs, labels, text=text, doc_id=doc_id)

    @tidy
    def kept(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        compressor = zstandard.ZstdCompressor(level=LEVEL)
        for texts in batches:
            out = []
            for t in texts:
                raw = (t.as_py() or "").encode()
                words = raw.split()
                fine = len(words) >= MIN_WORDS and 100 * repeat_words(words) <= MAX_REPEAT_PERCENT * len(words)
                out.append(fine and verdict(*ratios(raw, compressor), len(raw), limits, bad) == "ok")
            yield pa.array(out, pa.bool_())

    return in_small_batches(docs).where(F.arrow_udf(kept, "boolean")(docs[text].cast("string")))
