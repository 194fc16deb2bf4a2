"""N-gram Jaccard self-join with adaptive multi-match prefixes.

Two documents link when the Jaccard similarity of their sets of word shingles reaches the threshold. The steps, each
over all documents:

1. One pass hashes shingles (64 bits) into sets, a 128-bit digest of each set, and a frequency sketch: `SLOTS` counters
   that every shingle of every document adds to. The sketch has a fixed size, whatever the input; it only orders tokens,
   so that its collisions cost speed, never results. Equal sets become one class.
2. Each class orders its tokens from rare to common. With T = ceil(t * n), any partner shares l tokens among the first
   n - T + l of either side. Each class picks the l whose longer prefix is paid back by fewer expected candidates
   (the sketch's counts over the prefix, divided by l); a pair must then share min(l, l') prefix tokens.
3. Classes meet in tiles: the classes of one token of the shortest (l = 1) prefix. Tokens with the same classes share a
   tile, and a pair belongs to its smallest common tile only. Tiles of more than `BLOCK` classes are split into pairs of
   blocks, so that no task holds an unbounded group. A tile counts common prefix tokens, and keeps classes that have a
   pair with enough of them (`needed_matches`).
4. Kept classes get their whole sets and tiles verify exactly. A tile returns a spanning forest of its links, not its
   pairs, and the number of links of each class.
5. Links become components by minimum labels with pointer jumping, written in the shared folder round by round.

Defined results: null and empty texts have no set, link with nothing and are their own component; a text with fewer
than k words is one shingle; repeated rows are copies (linked, same component); a null id never becomes a component id
unless a component has no other id. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridgeline.llm.common import FILTER_BITS, Tables, filter_bit, membership, might_hold, mix, passes, pruned, shingles, slices, tidy, utf8, words

#: Counters of the frequency sketch: one byte each (an eighth of a power of two) once summed, 16 MB broadcast, whatever
#: the input.
SLOTS = 1 << 24
#: Counters in one row of the sketch.
CHUNK = 1 << 14
#: Tokens that wait before a task adds them to its counters: sorting and counting them takes about 30 bytes each.
WAITING = 1 << 19
#: Bytes of text that become sets at a time: words and shingles take about 35 bytes for each byte of them.
SLICE = 1 << 18
#: Classes in a block of a large tile, and shingles of their whole sets (8 bytes each): long texts make smaller blocks.
BLOCK = 2048
BLOCK_SHINGLES = 1 << 19
#: Rows of a tile's pair matrices that are held at a time.
STRIP = 256
#: Tokens that one matrix product takes.
WIDTH = 1024
#: A class of more than one in so many rows is hot: its rows get their class's results by broadcast, the others by shuffle.
#: There are fewer hot classes than this, whatever the input.
HOT = 8192
#: Lengths l that a prefix may choose from.
MATCHES = (1, 2, 3, 4, 6, 8, 12, 16, 24, 32)

_U = np.uint64


def _sets(batch: pa.RecordBatch, k: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For slices of the batch: first row, end row, distinct shingle hashes, their rows (from the first)."""
    data, offsets = utf8(batch.column(batch.schema.get_field_index("text")))
    for i, j in slices(offsets, SLICE):
        part = offsets[i : j + 1] - offsets[i]
        yield i, j, *shingles(*words(data[offsets[i] : offsets[j]], part), k)


def _digests(value: np.ndarray, row: np.ndarray, n: int) -> tuple[list[bytes | None], np.ndarray]:
    """128-bit digest of each row's set (None if empty) and its size."""
    sizes = np.bincount(row, minlength=n)
    out = np.zeros((n, 2), np.uint64)
    if len(value):
        first = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
        for i, salt in enumerate((0x51ED270B7F3C9D21, 0xC2B2AE3D27D4EB4F)):
            out[row[first], i] = np.add.reduceat(mix(value ^ _U(salt)), first)
    raw = out.tobytes()
    return [raw[16 * i : 16 * i + 16] if sizes[i] else None for i in range(n)], sizes


_STATS = "doc_id long, text_hash long, n long, cls binary, chunk int, payload binary"


class _Sketch:
    """Counters of one task, up to 65,535 each; tokens wait in a list, so that a small task holds little."""

    def __init__(self):
        self.counts, self.waiting, self.n = None, [], 0

    def add(self, slots: np.ndarray) -> None:
        self.waiting.append(slots.astype(np.uint32))
        self.n += len(slots)
        if self.n >= WAITING:
            self.flush()

    def flush(self) -> tuple[np.ndarray, np.ndarray]:
        slot, n = np.unique(np.concatenate([np.zeros(0, np.uint32), *self.waiting]), return_counts=True)
        self.waiting, self.n = [], 0
        if self.counts is None:
            self.counts = np.zeros(SLOTS, np.uint16)
        self.counts[slot] = np.minimum(self.counts[slot] + n, 65_535)

    def chunks(self) -> Iterator[tuple[int, np.ndarray]]:
        """(chunk, its counters) of the chunks that have any."""
        if self.counts is not None:
            self.flush()
            for c in np.flatnonzero(self.counts.reshape(-1, CHUNK).any(1)):
                yield int(c), self.counts[c * CHUNK : (c + 1) * CHUNK]
        elif self.n:
            slot, n = np.unique(np.concatenate(self.waiting), return_counts=True)
            for part in np.split(np.arange(len(slot)), np.flatnonzero(np.diff(slot // CHUNK)) + 1):
                c = int(slot[part[0]]) // CHUNK
                counts = np.zeros(CHUNK, np.uint16)
                counts[slot[part] - c * CHUNK] = np.minimum(n[part], 65_535)
                yield c, counts


@tidy
def _stats(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """A row for each document, then this task's share of the sketch, compressed, a row for each chunk that has any."""
    schema = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("n", pa.int64()), ("cls", pa.binary()), ("chunk", pa.int32()), ("payload", pa.binary())])
    sketch = _Sketch()
    for batch in batches:
        digests, ns = [], []
        for i, j, value, row in _sets(batch, k):
            d, s = _digests(value, row, j - i)
            digests += d
            ns.append(s)
            sketch.add(value & _U(SLOTS - 1))
        if n := batch.num_rows:
            columns = [batch.column("doc_id"), batch.column("text_hash"), pa.array(np.concatenate(ns).astype(np.int64)), pa.array(digests, pa.binary())]
            yield pa.RecordBatch.from_arrays([*columns, pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], schema=schema)
    small, rows = zstandard.ZstdCompressor(level=1), []

    def batch() -> pa.RecordBatch:
        n = len(rows)
        nothing = [pa.nulls(n, pa.int64())] * 3 + [pa.nulls(n, pa.binary())]
        return pa.RecordBatch.from_arrays([*nothing, pa.array([c for c, _ in rows], pa.int32()), pa.array([p for _, p in rows], pa.binary())], schema=schema)

    for c, part in sketch.chunks():
        rows.append((c, small.compress(part.tobytes())))
        if len(rows) == 64:
            yield batch()
            rows = []
    if rows:
        yield batch()


@tidy
def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums each chunk of the sketch, and rounds to eighths of powers of two; rows come sorted by chunk, one is held at a time."""
    large, at, total = zstandard.ZstdDecompressor(), None, None

    def levels() -> pa.RecordBatch:
        found = np.minimum(np.round(8 * np.log2(1 + total.astype(np.float64))), 255).astype(np.uint8).tobytes()
        return pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([found], pa.binary())], names=["chunk", "payload"])

    for batch in batches:
        for c, payload in zip(batch.column(0).to_pylist(), batch.column(1)):
            part = np.frombuffer(large.decompress(payload.as_py()), np.uint16)
            if c != at:
                if at is not None:
                    yield levels()
                at, total = c, np.zeros(CHUNK, np.uint64)
            total += part
    if at is not None:
        yield levels()


def least_overlap(n: np.ndarray | int, percent: int):
    """T: the least intersection that a set of n needs for a similarity of percent / 100."""
    return -(-percent * n // 100)


def choose_matches(frequencies: np.ndarray, n: int, base: int, least: int) -> int:
    """l for one set: frequencies (noise taken off) in token order; base = n - T + 1, the prefix at l = 1.

    A longer prefix costs its tokens in each tile; a candidate costs its set. At most sum / l classes can share l of the
    prefix's tokens, which estimates the candidates.
    """
    sums = np.cumsum(frequencies[: base + MATCHES[-1]])
    if sums[-1] == 0:
        return 1
    best, cost = 1, None
    for m in MATCHES:
        end = base - 1 + m
        if m > least or end > n:
            break
        total = 4.0 * end + n * float(sums[end - 1]) / m
        if cost is None or total < cost:
            best, cost = m, total
    return best


#: Counts that the levels of the summed sketch stand for.
_ABOUT = np.exp2(np.arange(256) / 8) - 1
_PREFIX = "cls binary, n long, least_matches int, base int, edge_level int, edge long, tokens array<long>"


@tidy
def _prefixes(batches: Iterator[pa.RecordBatch], k: int, percent: int, sketch, noise: float) -> Iterator[pa.RecordBatch]:
    """noise: what a slot of the sketch holds in the mean."""
    levels = sketch.value
    for batch in batches:
        for i, j, value, row in _sets(batch, k):
            digests, sizes = _digests(value, row, j - i)
            seen = levels[(value & _U(SLOTS - 1)).astype(np.int64)]
            order = np.lexsort((value, seen, row))
            value, level = value[order], seen[order]
            seen = np.maximum(_ABOUT[level] - noise - 1, 0)
            ends = np.cumsum(sizes)
            out = []
            for r in np.flatnonzero(sizes):
                n = int(sizes[r])
                start = int(ends[r]) - n
                least = int(least_overlap(n, percent))
                base = n - least + 1
                m = choose_matches(seen[start : start + n], n, base, least)
                end = start + base - 1 + m
                out.append((digests[r], n, m, base, int(level[end - 1]), int(value[end - 1].view(np.int64)), value[start:end].view(np.int64)))
            if out:
                names = ["cls", "n", "least_matches", "base", "edge_level", "edge", "tokens"]
                kinds = [pa.binary(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64())]
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), kinds)], names=names)


def _runs(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[dict[str, list]]:
    """Runs of rows with equal keys, as columns of Python values; rows come sorted by the keys."""
    held: dict[str, list] | None = None
    last = None
    for batch in batches:
        columns = {x: batch.column(i).to_pylist() if not pa.types.is_list(batch.schema.field(i).type) else _lists(batch.column(i)) for i, x in enumerate(batch.schema.names)}
        key = list(zip(*(columns[x] for x in keys)))
        i, n = 0, batch.num_rows
        while i < n:
            j = i
            while j < n and key[j] == key[i]:
                j += 1
            part = {x: v[i:j] for x, v in columns.items()}
            if held is not None and last == key[i]:
                for x, v in part.items():
                    held[x] += v
            else:
                if held is not None:
                    yield held
                held, last = part, key[i]
            i = j
    if held is not None:
        yield held


def _lists(column: pa.Array) -> list[np.ndarray]:
    values, offsets = np.asarray(column.values), np.asarray(column.offsets)
    return [values[a:b] for a, b in zip(offsets[:-1], offsets[1:])]


class Overlaps:
    """Sizes of the intersections of arrays of distinct values, a strip of the matrix at a time."""

    def __init__(self, lists: list[np.ndarray]):
        self.m = len(lists)
        value = np.concatenate(lists)
        owner = np.repeat(np.arange(self.m, dtype=np.int32), np.fromiter(map(len, lists), np.int64, self.m))
        order = np.argsort(value, kind="stable")
        value, owner = value[order], owner[order]
        same = value[1:] == value[:-1]
        shared = np.append(False, same) | np.append(same, False) if len(value) else np.zeros(0, bool)
        value, self.owner = value[shared], owner[shared]
        self.token = np.cumsum(np.append(True, value[1:] != value[:-1])) - 1 if len(value) else np.zeros(0, np.int64)

    def strip(self, a: int, b: int) -> np.ndarray:
        """Intersections of lists a to b - 1 with lists a to m - 1."""
        total = np.zeros((b - a, self.m - a), np.float32)  # whole numbers below 2^24 are exact
        here = (self.owner >= a) & (self.owner < b)
        if not here.any():
            return total
        number = np.zeros(int(self.token[-1]) + 1, np.int64)
        number[self.token[here]] = 1
        used = (number[self.token] == 1) & (self.owner >= a)
        number = np.cumsum(number) - 1
        owner, token = self.owner[used] - a, number[self.token[used]]
        top = int(token[-1]) + 1
        cuts = np.searchsorted(token, np.arange(0, top + WIDTH, WIDTH))
        for c, (i, j) in enumerate(zip(cuts[:-1], cuts[1:])):
            has = np.zeros((self.m - a, min(WIDTH, top - c * WIDTH)), np.float32)
            has[owner[i:j], token[i:j] - c * WIDTH] = 1
            total += has[: b - a] @ has.T
        return total


def _strips(run: dict[str, list], percent: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """(a, b, pairs of rows a to b - 1 with rows a on) that this tile has to decide: each pair once, of other blocks where
    there are two, of sizes that can reach the threshold, and with no smaller tile in common."""
    m, sig, n = len(run["cls"]), run["sig"][0], np.asarray(run["n"])
    block = np.asarray(run["block"]) if run["lo"][0] != run["hi"][0] else None
    smaller = None
    for a in range(0, m, STRIP):
        b = min(a + STRIP, m)
        pair = np.arange(a, m) > np.arange(a, b)[:, None]
        if block is not None:
            pair &= block[a:] != block[a:b, None]
        pair &= (100 * n[a:] >= percent * n[a:b, None]) & (100 * n[a:b, None] >= percent * n[a:])
        if pair.any():
            smaller = Overlaps([x[x < sig] for x in run["sigs"]]) if smaller is None else smaller
            pair &= smaller.strip(a, b) == 0
        if pair.any():
            yield a, b, pair


_KEPT = "sig long, lo int, hi int, block int, cls binary, n long, copies long, sigs array<long>"


class Needs:
    """How many prefix tokens each pair of a tile must share.

    min(l, l') by the choice of prefixes; and where r's prefix ends no later than s's in the common order, all tokens
    that r's prefix shares with s lie in s's prefix too, so that the intersection is at most the shared prefix tokens
    and the n - p tokens after r's prefix.
    """

    def __init__(self, run: dict[str, list], percent: int):
        self.percent = percent
        self.n, self.least, base = (np.asarray(run[x]) for x in ("n", "least_matches", "base"))
        tokens, level = np.asarray(run["edge"], np.int64).view(np.uint64), np.asarray(run["edge_level"])
        order = np.lexsort((tokens, level))
        new = np.append(False, (np.diff(level[order]) != 0) | (tokens[order][1:] != tokens[order][:-1]))
        self.rank = np.empty(len(order), np.int64)
        self.rank[order] = np.cumsum(new)
        self.after = self.n - (base - 1 + self.least)

    def strip(self, a: int, b: int) -> np.ndarray:
        n, rank, after = self.n, self.rank, self.after
        overlap = -(-self.percent * (n[a:b, None] + n[a:]) // (100 + self.percent))
        need = np.minimum(self.least[a:b, None], self.least[a:])
        need = np.maximum(need, np.where(rank[a:b, None] <= rank[a:], overlap - after[a:b, None], 0))
        return np.maximum(need, np.where(rank[a:] <= rank[a:b, None], overlap - after[a:], 0))


@tidy
def _filtered(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Of each tile, the classes that have a pair with enough common prefix tokens."""
    names = ["sig", "lo", "hi", "block", "cls", "n", "copies", "sigs"]
    out: dict[str, list] = {x: [] for x in names}

    def batch() -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
        made = pa.RecordBatch.from_arrays([pa.array(out[x], t) for x, t in zip(names, kinds)], names=names)
        for x in names:
            out[x].clear()
        return made

    for run in _runs(batches, ("sig", "lo", "hi")):
        if len(run["cls"]) < 2:
            continue
        paired, shared = np.zeros(len(run["cls"]), bool), None
        for a, b, pair in _strips(run, percent):
            if shared is None:
                shared, needs = Overlaps(run["tokens"]), Needs(run, percent)
            pair &= shared.strip(a, b) >= needs.strip(a, b)
            paired[a:b] |= pair.any(1)
            paired[a:] |= pair.any(0)
        for i in np.flatnonzero(paired):
            for x in names:
                out[x].append(run[x][i])
        if len(out["cls"]) >= 5000:
            yield batch()
    if out["cls"]:
        yield batch()


@tidy
def _whole(batches: Iterator[pa.RecordBatch], k: int, wanted) -> Iterator[pa.RecordBatch]:
    """Whole sets of the classes that pass the filter (a few more may)."""
    for batch in batches:
        for i, j, value, row in _sets(batch, k):
            digests, sizes = _digests(value, row, j - i)
            ends = np.cumsum(sizes)
            has = np.flatnonzero(sizes)
            ok = has[passes(wanted.value, np.array([_bit(digests[r]) for r in has], np.int64))]
            out = [(digests[r], value[ends[r] - sizes[r] : ends[r]].tobytes()) for r in ok]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.binary()), pa.array([x for _, x in out], pa.binary())], names=["cls", "tokens"])


def _bit(cls: bytes) -> int:
    return int.from_bytes(cls[:4], "big") % FILTER_BITS


_LINKS = "cls binary, other binary, links long"


@tidy
def _verified(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Exact links of each tile: for each linked class its root in the tile and how many documents it links with."""
    cls, other, links = [], [], []
    for run in _runs(batches, ("sig", "lo", "hi")):
        m = len(run["cls"])
        if m < 2:
            continue
        n, copies = np.asarray(run["n"]), np.asarray(run["copies"], np.float64)  # counts below 2^53 are exact
        root, degree, common = np.arange(m), np.zeros(m), None
        for a, b, pair in _strips(run, percent):
            common = Overlaps([np.frombuffer(x, np.uint64) for x in run["tokens"]]) if common is None else common
            both = common.strip(a, b).astype(np.int64)
            pair &= 100 * both >= percent * (n[a:b, None] + n[a:] - both)
            degree[a:b] += pair @ copies[a:]
            degree[a:] += copies[a:b] @ pair
            for i in np.flatnonzero(pair.any(1)):
                joined = np.unique(np.append(root[a:][pair[i]], root[a + i]))
                if len(joined) > 1:
                    root[np.isin(root, joined)] = joined[0]
        for i in np.flatnonzero(degree):
            cls.append(run["cls"][i])
            other.append(run["cls"][root[i]])
            links.append(int(degree[i]))
        if len(cls) >= 5000:
            yield pa.RecordBatch.from_arrays([pa.array(cls, pa.binary()), pa.array(other, pa.binary()), pa.array(links, pa.int64())], names=["cls", "other", "links"])
            cls, other, links = [], [], []
    if cls:
        yield pa.RecordBatch.from_arrays([pa.array(cls, pa.binary()), pa.array(other, pa.binary()), pa.array(links, pa.int64())], names=["cls", "other", "links"])


def components(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, label, root): the smallest start label reachable by edges (a, b), and the node that has it (the smallest of
    equals; null labels come last). nodes: (node, label) of every end of an edge.

    Each round takes the least label of the neighbours and then the label's own label, until nothing changes.
    """
    tables = Tables(edges.sparkSession)
    both = tables.cut(edges.select("a", "b").where("a <> b").union(edges.where("a <> b").select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    state = tables.cut(nodes.select("node", F.struct(F.col("label").isNull().alias("none"), "label", "node").alias("best")))
    while True:
        near = both.join(state, both.b == state.node).groupBy("a").agg(F.min("best").alias("near"))
        stepped = state.join(near, state.node == near.a, "left").select("node", F.col("best").alias("old"), F.coalesce(F.least("best", "near"), "best").alias("best"))
        up = stepped.select(F.col("node").alias("up"), F.col("best").alias("top"))
        jumped = stepped.join(up, F.col("best.node") == up.up, "left").select("node", "old", F.coalesce(F.least("best", "top"), "best").alias("best"))
        done = tables.cut(jumped)
        tables.drop(state)
        if done.where("not (old <=> best)").isEmpty():
            tables.drop(both)
            return done.select("node", F.col("best.label").alias("label"), F.col("best.node").alias("root"))
        state = done


def _named(rows: DataFrame, named: DataFrame, total: int, how: str) -> DataFrame:
    """rows joined with named on cls. named: one row for each class, with its `copies`; hot classes are broadcast."""
    hot = F.broadcast(named.where(F.col("copies") * HOT > total))
    cold = rows.join(hot.select("cls"), "cls", "left_anti").join(named.where(F.col("copies") * HOT <= total), "cls", how)
    return rows.join(hot, "cls").unionByName(cold)


def _linked(docs: DataFrame, k: int, percent: int, text: str, doc_id: str) -> tuple[Tables, DataFrame, DataFrame]:
    """rows (doc_id, text_hash, n, cls) of docs, and for each class: cls, copies, first (its first row), links, label and root
    (null unless it links with another class)."""
    spark = docs.sparkSession
    tables = Tables(spark)
    base = pruned(docs, text, doc_id)
    stats = tables.cut(base.select("doc_id", "text", F.xxhash64("text").alias("text_hash")).mapInArrow(lambda it: _stats(it, k), _STATS))
    chunks = stats.where("chunk is not null").select("chunk", "payload").repartition("chunk").sortWithinPartitions("chunk").mapInArrow(_summed, "chunk int, payload binary")
    levels, at = np.zeros(SLOTS, np.uint8), np.zeros(256, np.int64)
    for r in chunks.toLocalIterator():
        part = np.frombuffer(r.payload, np.uint8)
        levels[r.chunk * CHUNK : (r.chunk + 1) * CHUNK] = part
        at += np.bincount(part, minlength=256)
    noise = float(at @ _ABOUT) / SLOTS  # slots of chunks that nobody sent hold nothing
    sketch = spark.sparkContext.broadcast(levels)

    rows = stats.where("chunk is null").select("doc_id", "text_hash", "n", "cls")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("first")
    classes = rows.where("cls is not null").groupBy("cls").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies"), first)
    prefixes = base.mapInArrow(lambda it: _prefixes(it, k, percent, sketch, noise), _PREFIX)
    prefixes = prefixes.groupBy("cls").agg(F.first(F.struct("n", "least_matches", "base", "edge_level", "edge", "tokens")).alias("p"), F.count(F.lit(1)).alias("copies"))
    # two classes of one key only share their candidates; sets decide later
    prefixes = tables.cut(prefixes.select(F.xxhash64("cls").alias("key"), "cls", "p.*", "copies"))
    sketch.unpersist()

    held = prefixes.select("key", "n", "base", F.posexplode("tokens").alias("at", "token")).select("key", "token", F.when(F.col("at") < F.col("base"), F.col("n")).otherwise(F.lit(0)).alias("short"))
    # a token that one class alone has in its prefix links nothing, and is carried no further
    short = F.col("short") > 0
    tiles = held.groupBy("token").agg(F.count(F.lit(1)).alias("all"), F.count_if(short).alias("size"), F.sum("short").alias("weight"), F.bit_xor(F.when(short, F.col("key")).otherwise(F.lit(0).cast("long"))).alias("sig"))
    tiles = tiles.where("`all` > 1").select("token", "size", "weight", F.xxhash64("sig", "size").alias("sig"))
    shared = held.join(tiles, "token")
    tile = F.when(short & (F.col("size") > 1), F.struct("sig", "size", "weight"))
    carried = shared.groupBy("key").agg(F.collect_list("token").alias("tokens"), F.collect_set(tile).alias("tiles"))  # both at most as long as the prefix
    carried = tables.cut(carried.where(F.size("tiles") > 0).join(prefixes.drop("tokens"), "key"))
    tables.drop(prefixes)
    member = carried.select("*", F.col("tiles.sig").alias("sigs"), F.explode("tiles").alias("tile")).select("*", "tile.*")
    parts = F.greatest(F.ceil(F.col("size") / F.lit(float(BLOCK))), F.ceil(F.col("weight") / F.lit(float(BLOCK_SHINGLES)))).cast("int")
    block = F.pmod(F.xxhash64("cls", F.lit(7)), parts).cast("int")
    dealt = member.select("sig", "cls", block.alias("block"), F.explode(F.sequence(F.lit(0), parts - 1)).alias("j"), "n", "copies", "sigs", "least_matches", "base", "edge_level", "edge", "tokens")
    dealt = dealt.withColumn("lo", F.least("block", "j")).withColumn("hi", F.greatest("block", "j")).select("sig", "lo", "hi", "block", "cls", "n", "copies", "sigs", "least_matches", "base", "edge_level", "edge", "tokens")
    kept = tables.cut(dealt.repartition("sig", "lo", "hi").sortWithinPartitions("sig", "lo", "hi").mapInArrow(lambda it: _filtered(it, percent), _KEPT))
    tables.drop(carried)

    wanted = membership(kept.select("cls").distinct(), F.pmod(F.conv(F.hex(F.substring("cls", 1, 4)), 16, 10).cast("long"), F.lit(FILTER_BITS)))
    sets = base.mapInArrow(lambda it: _whole(it, k, wanted), "cls binary, tokens binary").groupBy("cls").agg(F.first("tokens").alias("tokens"))
    ready = kept.join(sets, "cls").select("sig", "lo", "hi", "block", "cls", "n", "copies", "sigs", "tokens")
    linked = tables.cut(ready.repartition("sig", "lo", "hi").sortWithinPartitions("sig", "lo", "hi").mapInArrow(lambda it: _verified(it, percent), _LINKS))
    tables.drop(kept)
    wanted.unpersist()

    degree = linked.groupBy("cls").agg(F.sum("links").alias("links"))
    start = degree.join(classes, "cls").select(F.col("cls").alias("node"), F.col("rep").alias("label"))
    found = components(linked.select(F.col("cls").alias("a"), F.col("other").alias("b")), start)
    named = classes.join(found.withColumnRenamed("node", "cls"), "cls", "left").join(degree, "cls", "left")
    return tables, rows, tables.cut(named)


def ngram_join(docs: DataFrame, k: int = 3, percent: int = 90, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, n_shingles, component_id, n_links of every row of docs. See the module for the method and edge cases.

    n_links counts the other documents whose similarity reaches the threshold, copies included.
    """
    _, rows, named = _linked(docs, k, percent, text, doc_id)
    named = named.select("cls", "copies", F.coalesce("label", "rep").alias("component_id"), (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    out = _named(rows, named, rows.count(), "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def deduplicated(docs: DataFrame, k: int = 3, percent: int = 90, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """docs with one row of each component: the one with the smallest id (null ids come last), then the smallest hash of its
    text. Columns stay as they are.

    Rows are told by id and text, so that other texts under the same id go their own ways; of repeated rows one stays.
    Rows without words link with nothing and all stay.
    """
    tables, rows, named = _linked(docs, k, percent, text, doc_id)
    several = named.where("copies > 1 or root is not null").select("cls", "copies", "first", F.coalesce("root", "cls").alias("root"))
    winner = several.groupBy("root").agg(F.min("first").alias("winner"))
    several = several.join(winner, "root").select("cls", "copies", "winner")
    marked = _named(rows.select("doc_id", "text_hash", "cls"), several, rows.count(), "inner")
    same = F.col("doc_id").eqNullSafe(F.col("winner.doc_id")) & (F.col("text_hash") == F.col("winner.text_hash"))
    keys = marked.groupBy(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")).agg(F.bool_or(same).alias("__stays"), F.count(F.lit(1)).alias("n"))
    keys = tables.cut(keys.where("not __stays or n > 1").select("__id", "__hash", "__stays"))
    # only rows that may go, or come twice, are moved; the filter lets all of those through
    own_id, own_hash = docs[doc_id].cast("long"), F.xxhash64(docs[text].cast("string"))
    doubted = membership(keys, filter_bit(F.col("__id"), F.col("__hash")))
    doubt = might_hold(doubted)(filter_bit(own_id, own_hash))
    asked = docs.where(doubt)
    met = asked.join(keys, own_id.eqNullSafe(keys["__id"]) & (own_hash == keys["__hash"]), "left")
    once = met.where("__stays").dropDuplicates(["__id", "__hash"])
    stay = met.where("__stays is null").unionByName(once).select(*(F.col(f"`{c}`") for c in docs.columns))
    return docs.where(~doubt).unionByName(stay)
