"""What the operators of this package share: tables in the shared folder, Arrow text access, word hashes, numbering."""

from __future__ import annotations

import ctypes
import functools
import re
import tempfile
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space of the word pattern [^\x20\x09-\x0D]+ (fixed values).
SPACES = b" \t\n\v\f\r"
#: Bytes of text that one numpy pass handles at a time (longer single texts are handled alone).
SLICE_BYTES = 1 << 20
#: Bytes of an Arrow batch.
BATCH_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The cluster's spark.checkpoint.dir. Only a single-machine session (tests) that has none gets a folder of its own."""
    context = spark.sparkContext
    held = context._jsc.sc().getCheckpointDir()
    if held.isDefined():
        return held.get()
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.fullmatch(r"local(\[[^]]*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="ridgeline-checkpoints-")
    context.setCheckpointDir(folder)
    return context._jsc.sc().getCheckpointDir().get()


class Tables:
    """Tables written in the shared folder to cut lineage: later jobs restart from them when executors are lost."""

    def __init__(self, spark: SparkSession):
        self.spark, self.folder, self.paths = spark, shared_folder(spark), {}

    def cut(self, df: DataFrame) -> DataFrame:
        path = f"{self.folder}/table-{uuid.uuid4().hex}"
        df.write.option("compression", "zstd").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = (path, out)
        return out

    def drop(self, *tables: DataFrame) -> None:
        """Deletes tables that nothing reads any more."""
        for x in tables:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(self.paths.pop(id(x))[0])
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def cut(df: DataFrame) -> DataFrame:
    """df, written in the shared folder and read again."""
    return Tables(df.sparkSession).cut(df)


def tidy(f):
    """A generator that, once a partition is done, gives the memory it freed back to the system: workers live on, beside
    others, and what their allocators keep adds up."""

    @functools.wraps(f)
    def run(*args):
        try:
            yield from f(*args)
        finally:
            pa.default_memory_pool().release_unused()
            if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
                trim(0)

    return run


def in_small_batches(df: DataFrame) -> DataFrame:
    """df, in a session whose Arrow batches are of at most BATCH_BYTES (a longer row goes alone), whatever the length of texts:
    a batch of ten thousand rows of a megabyte would not fit a worker."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(re.sub(r"\D", "", conf.get(key, "67108864b"))) > BATCH_BYTES:
        conf.set(key, str(BATCH_BYTES))
    return df


def pruned(df: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Only what the operators read, under fixed names, whatever else the table carries."""
    return in_small_batches(df).select(df[doc_id].cast("long").alias("doc_id"), df[text].cast("string").alias("text"))


def utf8(array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (n + 1, from 0) of an Arrow string array; null counts as empty."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    array = pc.fill_null(pc.cast(array, pa.large_binary()), b"")
    n, at = len(array), array.offset
    _, offsets, data = array.buffers()
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(offsets, np.int64)[at : at + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most about `most` bytes each, one row at least."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        yield i, j
        i = j


_SPACE = np.zeros(256, bool)
_SPACE[list(SPACES)] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of the public splitmix64 generator, elementwise."""
    x = x + _U(0x9E3779B97F4A7C15)
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_NEAR = 64
_BYTE_AT = mix(np.arange(_NEAR * 256, dtype=np.uint64))


def words(data: np.ndarray, offsets: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash and row of every word, in order. A word's hash sums a random value for each (byte, position)."""
    if len(data) == 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    inside = ~_SPACE[data]
    start = inside.copy()
    start[1:] &= ~inside[:-1]
    heads = offsets[:-1][offsets[:-1] < len(data)]
    start[heads] = inside[heads]
    at = np.flatnonzero(inside)
    if len(at) == 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    begins = np.flatnonzero(start[at])
    nth = np.arange(len(at), dtype=np.int64)
    nth -= np.repeat(begins, np.diff(np.append(begins, len(at))))
    code = (_LOWER[data[at]] if lower else data[at]).astype(np.int64) + (nth << 8)
    if nth.max() < _NEAR:
        values = _BYTE_AT[code]
    else:
        values = mix(code.astype(np.uint64))
    return np.add.reduceat(values, begins), np.searchsorted(offsets, at[begins], "right") - 1


def shingles(hashes: np.ndarray, rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct k-word shingles as (hash, row), sorted by row, then hash; a row with fewer words has one, of all of them."""
    n = len(hashes)
    if n == 0:
        return hashes, rows
    odd = mix(np.arange(1, 2 * k + 1, dtype=np.uint64)) | _U(1)
    full = np.zeros(0, np.int64)
    if n >= k:
        full = np.flatnonzero(rows[: n - k + 1] == rows[k - 1 :])
    value = np.zeros(len(full), np.uint64)
    for i in range(k):
        value += hashes[full + i] * odd[i]
    value, row = mix(value), rows[full]
    first = np.flatnonzero(np.append(True, rows[1:] != rows[:-1]))
    count = np.diff(np.append(first, n))
    for size in range(1, k):
        short = first[count == size]
        if len(short):
            total = np.full(len(short), size, np.uint64) * odd[k]
            for i in range(size):
                total += hashes[short + i] * odd[k + 1 + i] if k + 1 + i < len(odd) else hashes[short + i] * odd[i]
            value, row = np.append(value, mix(total)), np.append(row, rows[short])
    order = np.lexsort((value, row))
    value, row = value[order], row[order]
    keep = np.append(True, (value[1:] != value[:-1]) | (row[1:] != row[:-1]))
    return value[keep], row[keep]


def labelled(docs: DataFrame, labels: DataFrame, label: str, sample: int, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, text, y) of at most `sample` labelled ids, those with the least hash. Several labels of one id count as their
    maximum; of several texts of one id the smallest stands. The ids are broadcast; no other row of docs moves."""
    given = labels.select(labels[doc_id].cast("long").alias("doc_id"), labels[label].cast("int").alias("y")).where("doc_id is not null and y is not null")
    picked = given.groupBy("doc_id").agg(F.max("y").alias("y")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = pruned(docs, text, doc_id).join(F.broadcast(picked), "doc_id")
    return rows.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("y").alias("y"))


def crc(doc_id: int | None) -> int:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode())


def crc_mod(doc_id: Column, by: int) -> Column:
    """crc32 of the id as text, modulo `by`; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(by))


def numbered(df: DataFrame, group: str, ties: list[Column], slot: str, cells: int = 256) -> DataFrame:
    """Adds `slot`: gapless numbers from 0 inside each value of `group`, without a task for a whole group.

    Rows are dealt by a hash of `ties` into `cells` cells a group. The counts of the cells (as many as groups times
    cells, whatever the input) give each cell's first number; a window numbers rows inside a cell. `cells` bounds the
    small side that is broadcast; raise it with the cluster, not with the data's values.
    """
    names = df.columns
    cell, base = "__cell", "__base"
    dealt = df.withColumn(cell, F.pmod(F.xxhash64(*ties), F.lit(cells)).cast("int"))
    counts = dealt.groupBy(group, cell).agg(F.count(F.lit(1)).alias("__n"))
    from pyspark.sql import Window

    before = Window.partitionBy(group).orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select(group, cell, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias(base))
    inner = Window.partitionBy(group, cell).orderBy(*ties)
    return (
        dealt.join(F.broadcast(first), [group, cell])
        .withColumn(slot, (F.col(base) + F.row_number().over(inner) - 1).cast("long"))
        .select(*names, slot)
    )


#: Bits of a membership filter (8 MB packed, whatever the input).
FILTER_BITS = 1 << 26
_PART = 1 << 16


def filter_bit(*columns: Column) -> Column:
    """Place of a key in a membership filter."""
    return F.pmod(F.xxhash64(*columns), F.lit(FILTER_BITS))


@tidy
def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Packed bits of each part of the filter; rows come sorted by part, one is held at a time."""
    at, held = None, np.zeros(_PART, bool)

    def bits() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([np.packbits(held).tobytes()], pa.binary())], names=["part", "bits"])

    for batch in batches:
        part, low = np.asarray(batch.column(0)), np.asarray(batch.column(1))
        ends = np.append(np.flatnonzero(part[1:] != part[:-1]) + 1, len(part))
        for a, b in zip(np.append(0, ends[:-1]), ends) if len(part) else ():
            if part[a] != at:
                if at is not None:
                    yield bits()
                at, held = int(part[a]), np.zeros(_PART, bool)
            held[low[a:b]] = True
    if at is not None:
        yield bits()


def membership(keys: DataFrame, bit: Column):
    """Broadcast packed filter of the bits of keys. A key of the table always passes; others rarely do, ever more often as
    the table outgrows the filter, so that users of it must check what passes."""
    bits = keys.select((bit / _PART).cast("int").alias("part"), F.pmod(bit, F.lit(_PART)).cast("int").alias("low"))
    packed = np.zeros(FILTER_BITS // 8, np.uint8)
    step = _PART // 8
    for r in bits.repartition("part").sortWithinPartitions("part").mapInArrow(_packed, "part int, bits binary").toLocalIterator():
        packed[r.part * step : (r.part + 1) * step] = np.frombuffer(r.bits, np.uint8)
    return keys.sparkSession.sparkContext.broadcast(packed)


def passes(packed: np.ndarray, bits: np.ndarray) -> np.ndarray:
    return (packed[bits >> 3] >> (7 - (bits & 7)).astype(np.uint8)) & 1 == 1


def might_hold(shared):
    """Arrow-batched column function: whether a bit of a shared filter is set."""

    @tidy
    def test(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for bits in batches:
            yield pa.array(passes(shared.value, np.asarray(bits)))

    return F.arrow_udf(test, "boolean")
