"""Toxicity by a factorization machine over learned terms.

A text's distinct lower-cased words, keyed by a 64-bit hash, are its terms. The machine's logit is a bias, a weight for
each learned term, and for each pair of terms the inner product of two learned vectors, so that an insult together with a group
mention can count for more than either alone. The pair sum costs one pass over the terms:
half of (sum of vectors)^2 minus the sum of squared vectors.

The machine is fitted on the driver, on at most `sample` labelled ids (those with the least hash of their id) of at most
`MOST_TERMS` terms together, by mini-batch AdaGrad with weight decay. A term is learned if its presence goes with the
label (a G-test statistic of `least` or more), or if its presence together with another term's does: for each pair of the
`pair_terms` most frequent terms of the sample, the G-test of the four cases (both, either one, neither) has to exceed
that of the better single term by `least` and twice the logarithm of the number of pairs. So a group mention that says
nothing by itself is learned, and rare words of few texts are not learned by heart; every other word, seen or not, adds
nothing to a score. Scoring reads every text whole.

Defined results: null and empty texts get the bias's score; several labels of one id count as their maximum, of several
texts of one id the smallest is learned from; without labels of both kinds every score is the share of label 1 (0 without
labels). Extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridgeline.llm.common import crc_mod, cut, in_small_batches, labelled, tidy

#: Terms of the sample together, 8 bytes each on the driver.
MOST_TERMS = 4_000_000
PAIR_TERMS = 1024

_WORD = re.compile(r"[^\W_]+")


def terms(text: str | None) -> np.ndarray:
    """Distinct words as 64-bit keys, sorted."""
    found = set(_WORD.findall(text.lower())) if text else ()
    return np.unique(np.frombuffer(b"".join([blake2b(w.encode(), digest_size=8).digest() for w in found]), "<u8"))


@dataclass
class Machine:
    """Weights and vectors of ids; with `keys` (sorted), ids are looked up there and others add nothing."""

    bias: float
    weights: np.ndarray
    vectors: np.ndarray
    keys: np.ndarray | None = None

    def logit(self, ids: np.ndarray) -> float:
        if self.keys is not None:
            at = np.searchsorted(self.keys, ids)
            inside = at < len(self.keys)
            at = at[inside]
            ids = at[self.keys[at] == ids[inside]]
        if not len(ids):
            return self.bias
        v = self.vectors[ids]
        s = v.sum(0)
        return float(self.bias + self.weights[ids].sum() + 0.5 * (s @ s - (v * v).sum()))

    def score(self, ids: np.ndarray) -> float:
        return float(1.0 / (1.0 + np.exp(-np.clip(self.logit(ids), -30, 30))))


def _g(parts: list[tuple[np.ndarray, np.ndarray]], share: float) -> np.ndarray:
    """G statistic of cases (rows with label 1, rows) that make up all rows, against a label of a given share."""
    total = 0.0
    with np.errstate(divide="ignore", invalid="ignore"):
        for ones, has in parts:
            for seen, expected in ((ones, has * share), (has - ones, has * (1 - share))):
                total = total + np.where(seen > 0, seen * np.log(seen / expected), 0)
    return 2 * total


def association(rows: list[np.ndarray], labels: np.ndarray, size: int) -> np.ndarray:
    """G-test statistic of each term's presence against the label."""
    labels = np.asarray(labels, float)
    ids = np.concatenate(rows)
    ones, has = np.bincount(ids, np.repeat(labels, [len(r) for r in rows]), size), np.bincount(ids, minlength=size)
    return _g([(ones, has), (labels.sum() - ones, len(rows) - has)], labels.mean())


def pair_gain(rows: list[np.ndarray], labels: np.ndarray, size: int, pair_terms: int) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent terms, and by how much the G-test of each pair of them exceeds that of the better single term."""
    labels = np.asarray(labels, float)
    frequent = np.argsort(-np.bincount(np.concatenate(rows), minlength=size), kind="stable")[:pair_terms]
    number = np.full(size, -1)
    number[frequent] = np.arange(len(frequent))
    both, toxic = np.zeros((len(frequent),) * 2), np.zeros((len(frequent),) * 2)
    for at in range(0, len(rows), 1024):
        some = rows[at : at + 1024]
        has = np.zeros((len(some), len(frequent) + 1), np.float32)
        has[np.repeat(np.arange(len(some)), [len(r) for r in some]), number[np.concatenate(some)]] = 1
        has = has[:, :-1]  # the last column took all other terms
        both += has.T @ has
        some = has[labels[at : at + 1024] > 0]
        toxic += some.T @ some
    n, t = both.diagonal(), toxic.diagonal()
    first, second = (t[:, None] - toxic, n[:, None] - both), (t - toxic, n - both)
    neither = (labels.sum() - toxic - first[0] - second[0], len(rows) - both - first[1] - second[1])
    single = _g([(t, n), (labels.sum() - t, len(rows) - n)], labels.mean())
    gain = _g([(toxic, both), first, second, neither], labels.mean()) - np.maximum(single[:, None], single)
    np.fill_diagonal(gain, 0)
    return frequent, gain


def telling(rows: list[np.ndarray], labels: np.ndarray, size: int, least: float, pair_terms: int = PAIR_TERMS) -> np.ndarray:
    """Which terms go with the label, by themselves or together with another one."""
    used = np.zeros(size, bool)
    if not size or not 0 < np.mean(labels) < 1:
        return used
    used |= association(rows, labels, size) >= least
    frequent, gain = pair_gain(rows, labels, size, pair_terms)
    if len(frequent) > 1:
        used[frequent[(gain >= least + 2 * np.log(len(frequent) * (len(frequent) - 1) / 2)).any(1)]] = True
    return used


def fit(rows: list[np.ndarray], labels: np.ndarray, size: int, rank: int = 8, epochs: int = 15, steps: int = 1500, rate: float = 0.3, decay: float = 1e-4, batch: int = 256, seed: int = 1) -> Machine:
    """Fits a machine to rows of term ids below `size` and labels 0/1, by `epochs` passes or as many as make `steps` batches."""
    weights, vectors = np.zeros(size, np.float32), np.zeros((size, rank), np.float32)
    share = float(labels.mean()) if len(labels) else 0.0
    bias = float(np.log(share / (1 - share))) if 0 < share < 1 else (30.0 if share == 1 else -30.0)
    if not 0 < share < 1:
        return Machine(bias, weights, vectors)
    rng = np.random.default_rng(seed)
    vectors = rng.normal(0, 0.02, vectors.shape).astype(np.float32)
    gw, gv, gb = np.full(size, 1e-2, np.float32), np.full((size, rank), 1e-2, np.float32), 1e-2
    lengths = np.fromiter(map(len, rows), np.int64, len(rows))
    for _ in range(max(epochs, -(-steps * batch // len(rows)))):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), batch):
            part = order[at : at + batch]
            bare = part[lengths[part] == 0]  # rows without a term only move the bias
            part = part[lengths[part] > 0]
            chance = 1 / (1 + np.exp(-bias))
            if not len(part):
                db = chance - float(labels[bare].mean())
                gb += db * db
                bias -= rate * db / gb**0.5
                continue
            ids = np.concatenate([rows[i] for i in part])
            starts = np.append(0, np.cumsum(lengths[part])[:-1])
            owner = np.repeat(np.arange(len(part)), lengths[part])
            v = vectors[ids]
            sums = np.add.reduceat(v, starts, 0)
            pairs = 0.5 * ((sums * sums).sum(1) - np.add.reduceat((v * v).sum(1), starts))
            logit = bias + np.add.reduceat(weights[ids], starts) + pairs
            error = 1 / (1 + np.exp(-np.clip(logit, -30, 30))) - labels[part]
            each = error[owner].astype(np.float32)
            touched, back = np.unique(ids, return_inverse=True)
            dw = np.bincount(back, each, len(touched)).astype(np.float32) / len(part) + decay * weights[touched]
            dv = np.stack([np.bincount(back, each * (sums[owner, f] - v[:, f]), len(touched)) for f in range(rank)], 1).astype(np.float32) / len(part) + decay * vectors[touched]
            gw[touched] += dw * dw
            weights[touched] -= rate * dw / np.sqrt(gw[touched])
            gv[touched] += dv * dv
            vectors[touched] -= rate * 0.3 * dv / np.sqrt(gv[touched])
            db = float(error.sum() + chance * len(bare) - labels[bare].sum()) / (len(part) + len(bare))
            gb += db * db
            bias -= rate * db / gb**0.5
    return Machine(bias, weights, vectors)


def fit_keys(rows: list[np.ndarray], labels: np.ndarray, least: float = 12.0, pair_terms: int = PAIR_TERMS, **settings) -> Machine:
    """`fit` on rows of 64-bit keys: those that tell the label are numbered, and the machine knows no others."""
    vocabulary = np.unique(np.concatenate([np.zeros(0, "<u8"), *rows]))
    rows = [np.searchsorted(vocabulary, r) for r in rows]
    used = telling(rows, labels, len(vocabulary), least, pair_terms)
    number = np.cumsum(used) - 1
    machine = fit([number[r[used[r]]] for r in rows], labels, int(used.sum()), **settings)
    machine.keys = vocabulary[used]
    return machine


def learn(rows: DataFrame, labels: DataFrame, label: str, sample: int, most_terms: int = MOST_TERMS, **settings) -> Machine:
    """Fits on at most `sample` labelled ids of (doc_id, text), fewer if they have more than most_terms terms together."""
    @tidy
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [terms(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("at"), batch.column("doc_id"), batch.column("y"), pa.array([x.tobytes() for x in ids], pa.binary()), pa.array([len(x) for x in ids], pa.int64())], names=["at", "doc_id", "y", "ids", "n"])

    held = cut(labelled(rows, labels, label, sample).select(F.xxhash64("doc_id").alias("at"), "doc_id", "y", "text").mapInArrow(hashed, "at long, doc_id long, y int, ids binary, n long"))
    total, last = 0, None
    for r in held.select("at", "doc_id", "n").orderBy("at", "doc_id").collect():  # at most `sample` rows
        total += r.n
        if total > most_terms:
            break
        last = (r["at"], r.doc_id)
    if last is None:
        return fit_keys([], np.zeros(0), **settings)
    got = held.where((F.col("at") < last[0]) | (F.col("at") == last[0]) & (F.col("doc_id") <= last[1])).orderBy("at", "doc_id").select("ids", "y").toArrow()
    ids = [np.frombuffer(x.as_py(), "<u8") for x in got.column("ids")]
    return fit_keys(ids, np.asarray(got.column("y"), np.float64) > 0, **settings)


_SCHEMA = "doc_id long, held_out boolean, score double, predicted int"


def toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic", held_out: Column | None = None, threshold: float = 0.3, sample: int = 12_000, **settings) -> DataFrame:
    """doc_id, held_out, score and predicted of every row; rows where held_out is true are never learned from."""
    out = crc_mod(docs["doc_id"], 4) == 2 if held_out is None else held_out
    rows = in_small_batches(docs).select(docs["doc_id"].cast("long").alias("doc_id"), out.alias("held_out"), docs["text"].cast("string").alias("text"))
    allowed = labels if held_out is not None else labels.where(crc_mod(labels["doc_id"], 4) != 2)
    machine = docs.sparkSession.sparkContext.broadcast(learn(rows.where(~F.col("held_out")).select("doc_id", "text"), allowed, label, sample, **settings))

    @tidy
    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = machine.value
        for batch in batches:
            score = np.array([m.score(terms(t.as_py())) for t in batch.column(2)], float)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(score, pa.float64()), pa.array((score >= threshold).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    return rows.mapInArrow(scored, _SCHEMA)
