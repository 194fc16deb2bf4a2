"""Packing by optimal length buckets.

Every text's length in tokens (plus one end token) goes into one global histogram. Dynamic programming over the
histogram picks at most `buckets` boundaries, so that padding each text to its bucket's boundary wastes the fewest
tokens. Inside a bucket with boundary L, batches hold max(1, budget // L) texts: the padded batch fits the token budget
(a text longer than the budget is a batch of its own).

The histogram has a row for each length that occurs, however long: the boundaries are the best there are. The driver
holds two numbers for each of them, at most as many as the longest text has tokens, and the programming takes `buckets`
passes over them, in whole numbers.

Defined results: null and empty texts have one token (the end token); texts are never cut or dropped; equal lengths
share a bucket; places inside a bucket follow a hash of the row, so that repeated rows only swap places. An empty table
gives no row. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridgeline.llm.common import cut, in_small_batches, numbered, tidy
from ridgeline.llm.secrets import VOCABULARY, encoder, vocabulary

BUCKETS = 16
BUDGET = 16_384


def boundaries(tops: list[int], counts: list[int], buckets: int) -> list[int]:
    """At most `buckets` of the lengths `tops` (ascending) that minimise sum of (boundary - length); the last is always one.

    For j > i, cost(i, j) = top[j] * (C[j] - C[i]) - (S[j] - S[i]) with prefix sums C and S. Among starts i, the term
    -top[j] * C[i] + (D[i] + S[i]) is a line in top[j] with falling slopes, so that each layer is a lower envelope that
    one scan builds and reads: buckets * lengths steps. Ties go to fewer buckets.
    """
    n = len(tops)
    c, s = [0], [0]
    for top, k in zip(tops, counts):
        c.append(c[-1] + k)
        s.append(s[-1] + top * k)
    never = 2 * tops[-1] * c[-1] + 1 if n else 1  # more than any cost
    best = [0] + [never] * n
    chosen: list[list[int]] = []
    finish, layers = None, 0
    for layer in range(1, min(buckets, n) + 1):
        now, source, lines, at = [never] * (n + 1), [0] * (n + 1), [], 0
        for j in range(1, n + 1):
            i = j - 1
            if best[i] < never:
                m, b = -c[i], best[i] + s[i]
                while len(lines) >= 2 and (b - lines[-2][1]) * (lines[-2][0] - lines[-1][0]) <= (lines[-1][1] - lines[-2][1]) * (lines[-2][0] - m):
                    lines.pop()
                lines.append((m, b, i))
                at = min(at, len(lines) - 1)
            if lines:
                x = tops[j - 1]
                while at + 1 < len(lines) and lines[at + 1][0] * x + lines[at + 1][1] <= lines[at][0] * x + lines[at][1]:
                    at += 1
                now[j] = lines[at][0] * x + lines[at][1] + x * c[j] - s[j]
                source[j] = lines[at][2]
        chosen.append(source)
        best = now
        if finish is None or now[n] < finish:
            finish, layers = now[n], layer
    out, j = [], n
    for layer in range(layers, 0, -1):
        out.append(tops[j - 1])
        j = chosen[layer - 1][j]
    return out[::-1]


def lengths(docs: DataFrame, vocabulary_path: str = VOCABULARY) -> DataFrame:
    """doc_id, n_tokens (without the end token) and text_hash of every row, in one pass over whole texts."""
    words = vocabulary(docs.sparkSession, vocabulary_path)

    @tidy
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(words.value).encode_ordinary
        for batch in batches:
            n = [len(encode(t)) if (t := x.as_py()) else 0 for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), batch.column(2)], names=["doc_id", "n_tokens", "text_hash"])

    rows = in_small_batches(docs).select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"), F.xxhash64(docs["text"].cast("string")).alias("text_hash"))
    return rows.mapInArrow(counted, "doc_id long, n_tokens long, text_hash long")


def packed(rows: DataFrame, buckets: int = BUCKETS, budget: int = BUDGET) -> DataFrame:
    """rows (doc_id, n_tokens, text_hash) with bucket, boundary, batch, place and padding.

    batch is gapless from 0 inside a bucket; (bucket, batch) names a batch and (bucket, batch, place) a row of it.
    """
    spark = rows.sparkSession
    rows = cut(rows.select("doc_id", "n_tokens", "text_hash", (F.col("n_tokens") + 1).alias("length")))
    found = rows.groupBy("length").agg(F.count(F.lit(1)).alias("n")).toArrow().sort_by("length")  # at most as many as the longest length
    tops = boundaries(found["length"].to_pylist(), found["n"].to_pylist(), buckets)
    names = spark.createDataFrame(list(enumerate(tops)), "bucket int, boundary long")
    bucket = F.lit(0)
    for top in tops[:-1]:
        bucket = bucket + (F.col("length") > top).cast("int")
    dealt = rows.withColumn("bucket", bucket.cast("int")).join(F.broadcast(names), "bucket")
    slots = numbered(dealt, "bucket", [F.col("doc_id"), F.col("text_hash")], "slot")
    fit = F.greatest(F.floor(F.lit(budget) / F.col("boundary")), F.lit(1)).cast("long")
    return slots.select(
        "doc_id",
        "n_tokens",
        "bucket",
        "boundary",
        F.floor(F.col("slot") / fit).cast("long").alias("batch"),
        F.pmod(F.col("slot"), fit).cast("long").alias("place"),
        (F.col("boundary") - F.col("length")).alias("padding"),
    )


def packing(docs: DataFrame, vocabulary_path: str = VOCABULARY, buckets: int = BUCKETS, budget: int = BUDGET) -> DataFrame:
    """doc_id, n_tokens, bucket, boundary, batch, place and padding of every row of docs."""
    return packed(lengths(docs, vocabulary_path), buckets, budget)


def padding(tops: np.ndarray, lens: np.ndarray) -> int:
    """Tokens of padding of given lengths under given boundaries."""
    return int((tops[np.searchsorted(tops, lens)] - lens).sum()) if len(lens) else 0
