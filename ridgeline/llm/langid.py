"""Language identification by rank-order profiles.

A language's profile lists its most frequent character n-grams by rank. A document's own list is compared with each
profile: every n-gram adds how far its ranks are apart ("out of place"), or the profile's length if it is missing. The
nearest profile names the language.

Profiles come from labelled rows: at most `per_lang` documents of each language, those with the least hash of their id,
each read whole; of several rows of one id the smallest text counts. Prediction reads every document whole. A profile
takes `size` n-grams on the driver and in each task, for each language that the labels name.

Defined results: a null text or one without a letter is `und` with score 0; ties go to the language that sorts first;
without any labelled row every text is `und`. Repeated rows get equal rows; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ridgeline.llm.common import crc_mod, in_small_batches, tidy

UNKNOWN = "und"
_LETTER = re.compile(r"[^\W\d_]")
_NOT_LETTERS = re.compile(r"[\W\d_]+")
#: Characters of a text that are counted at a time.
BLOCK = 1 << 20
_SPACE = ord(" ")


def summed(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sum of each one's counts (1 each by default)."""
    if counts is None:
        keys = np.sort(keys)
    else:
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.diff(np.append(first, len(keys))) if counts is None else np.add.reduceat(counts, first) if len(first) else counts


def grams(text: str, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys and counts of the 1..longest-grams (at most 3) of the lower-cased words, each padded by a space on both sides.

    A key holds 21 bits for each code point, so that its order is by length, then by code points.
    """
    clean = f" {_NOT_LETTERS.sub(' ', text.lower()).strip()} "
    codes = np.frombuffer(clean.encode("utf-32-le", "surrogatepass"), np.uint32)
    parts = []
    for at in range(0, len(codes), BLOCK):
        part = codes[at : at + BLOCK + longest - 1].astype(np.int64)
        own = min(BLOCK, len(codes) - at)
        key, keys = part, [part[:own]]
        for n in range(2, longest + 1):
            key = (key[:-1] << 21) | part[n - 1 :]
            keys.append(key[:own])
        parts.append(summed(np.concatenate(keys)))
    keys, counts = parts[0] if len(parts) == 1 else summed(np.concatenate([k for k, _ in parts]), np.concatenate([c for _, c in parts]))
    real = keys != _SPACE
    return keys[real], counts[real]


def ranked(keys: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """The `size` most frequent n-grams; ties in the order of the key."""
    return keys[np.argsort(-counts, kind="stable")[:size]]


class Profiles:
    """Ranks of n-grams in each language: languages in order, all n-grams in order, a rank (or `size`) for each pair."""

    def __init__(self, lists: dict[str, np.ndarray], size: int):
        self.langs, self.size = sorted(lists), size
        self.keys = np.unique(np.concatenate([lists[x] for x in self.langs])) if lists else np.zeros(0, np.int64)
        self.ranks = np.full((len(self.keys) + 1, len(self.langs)), -1, np.int32)
        for i, lang in enumerate(self.langs):
            self.ranks[np.searchsorted(self.keys, lists[lang]), i] = np.arange(len(lists[lang]))

    def distances(self, own: np.ndarray) -> np.ndarray:
        """Out-of-place distance of a ranked list to each language."""
        at = np.searchsorted(self.keys, own)
        at[(at == len(self.keys)) | (self.keys[np.minimum(at, len(self.keys) - 1)] != own)] = len(self.keys)
        ranks = self.ranks[at]
        return np.where(ranks < 0, self.size, np.abs(ranks - np.arange(len(own), dtype=np.int32)[:, None])).sum(0)


def predict(text: str | None, profiles: Profiles, longest: int) -> tuple[str, float]:
    """Language and score: how far the second nearest profile lies behind the nearest, from 0.5 on."""
    if not text or not profiles.langs or not _LETTER.search(text):
        return UNKNOWN, 0.0
    own = ranked(*grams(text, longest), profiles.size)
    far = profiles.distances(own)
    order = np.argsort(far, kind="stable")
    best = float(far[order[0]])
    if len(order) == 1:
        return profiles.langs[0], 1.0 - best / (profiles.size * len(own))
    rest = float(far[order[1]])
    return profiles.langs[order[0]], 0.5 + 0.5 * (rest - best) / rest if rest else 0.5


def sample(rows: DataFrame, per_lang: int) -> DataFrame:
    """At most per_lang rows (lang, text) of each language: ids of the least hashes, one row an id.

    The languages are counted first; a hash under the share of per_lang in its language, and a margin, lets a row through, so
    that only about per_lang ids of a language are ever sorted in one place.
    """
    place = F.xxhash64("doc_id", F.lit(5)).cast("double") / 2.0**64 + 0.5
    sums = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    margin = per_lang + 8 * per_lang**0.5 + 64  # fewer ids pass once in many billions
    near = rows.join(F.broadcast(sums), "lang").where(place * F.col("n") <= margin)
    one = near.groupBy("lang", "doc_id").agg(F.min("text").alias("text"), F.min(place).alias("place"))
    first = Window.partitionBy("lang").orderBy("place", "doc_id")
    return one.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= per_lang).select("lang", "text")


@tidy
def _counted(batches: Iterator[pa.RecordBatch], longest: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        own: dict[str, list] = {}
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            own.setdefault(lang, []).append(grams(text.as_py() or "", longest))
        for lang, found in own.items():
            keys, counts = summed(np.concatenate([k for k, _ in found]), np.concatenate([c for _, c in found]))
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keys), pa.string()), pa.array(keys), pa.array(counts.astype(np.int64))], names=["lang", "gram", "n"])


def learn(rows: DataFrame, size: int = 400, longest: int = 3, per_lang: int = 1000) -> Profiles:
    """Profiles from rows (doc_id, lang, text). The driver gets `size` n-grams of a language."""
    picked = sample(rows.where("lang is not null and text is not null"), per_lang)
    sums = picked.mapInArrow(lambda it: _counted(it, longest), "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    top = sums.withColumn("rank", F.row_number().over(order) - 1).where(F.col("rank") < size)
    lists: dict[str, list] = {}
    for r in top.orderBy("lang", "rank").collect():
        lists.setdefault(r.lang, []).append(r.gram)
    return Profiles({k: np.array(v, np.int64) for k, v in lists.items()}, size)


_SCHEMA = "doc_id long, held_out boolean, lang_pred string, score double"


def language_id(docs: DataFrame, held_out: Column | None = None, size: int = 400, longest: int = 3, per_lang: int = 1000) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row; rows where held_out is true are never learned from."""
    out = crc_mod(docs["doc_id"], 5) == 0 if held_out is None else held_out
    rows = in_small_batches(docs).select(docs["doc_id"].cast("long").alias("doc_id"), out.alias("held_out"), docs["lang"].cast("string").alias("lang"), docs["text"].cast("string").alias("text"))
    profiles = docs.sparkSession.sparkContext.broadcast(learn(rows.where(~F.col("held_out")), size, longest, per_lang))

    @tidy
    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = profiles.value
        for batch in batches:
            got = [predict(t.as_py(), known, longest) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([x for x, _ in got], pa.string()), pa.array([x for _, x in got], pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])

    return rows.select("doc_id", "held_out", "text").mapInArrow(scored, _SCHEMA)
