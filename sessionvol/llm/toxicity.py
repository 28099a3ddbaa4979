"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios (operator 1).

A text's features are its distinct n-grams of folded characters (lower case, white space as one space), hashed to
2 ** BITS numbers. The log-count ratio of a feature is log of (its smoothed share of toxic texts over its smoothed share of clean
texts), counted over all labelled training texts. Features whose ratio is small, or not clearly different from
0 by its own standard error, are left out of the model. Logistic regression on the scaled features is fitted on a bounded sample of the
labelled texts (``fit_rows`` and ``fit_bytes``), half of either class where there are so many; the bias is corrected for that.

At scale: counting is one pass over the labelled texts that sends one small vector block per task and feature range; the model has a
fixed size and is sent to all tasks; scoring reads each text once and shuffles nothing.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionvol.llm import counting
from sessionvol.llm import kernels as K
from sessionvol.llm import letters as L
from sessionvol.llm.rows import keyed, ship
from sessionvol.session import settle

BITS = 20
SIZES = (4, 5, 6)
_RATIO, _LAST = np.uint32(0x9E3779B1), np.uint32(0x85EBCA6B)
_TABLE: list[L.Table] = []


def _folded(points: np.ndarray) -> np.ndarray:
    if not _TABLE:
        _TABLE.append(L.Table(L.folded))
    return _TABLE[0](points)


def features(data: np.ndarray, offsets: np.ndarray, sizes: tuple[int, ...] = SIZES, bits: int = BITS):
    """Feature numbers of a group of texts, with repetitions: the offsets of the texts, and for each size of n-gram
    the number at every character. What crosses the end of a text has number 0, which no n-gram has."""
    points, at = L.points(data, offsets)
    x = _folded(points)
    keep = np.ones(len(x), bool)
    if len(x):
        keep[1:] = (x[1:] != 32) | (x[:-1] != 32)
        keep[at[:-1][at[:-1] < len(x)]] = True
    kept = np.zeros(len(x) + 1, np.int64)
    np.cumsum(keep, out=kept[1:])
    at = kept[at]
    h = x[keep].astype(np.uint32) * np.uint32(0xCC9E2D51)
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x1B873593)
    out, run = [], h
    for n in range(2, max(sizes) + 1):
        run = run[:-1] * _RATIO + h[n - 1 :] if len(run) > 1 else run[:0]
        if n in sizes:
            number = np.zeros(len(h), np.int32)
            v = run ^ (run >> np.uint32(16))
            v *= _LAST
            v >>= np.uint32(32 - bits)
            number[: len(run)] = np.maximum(v, 1)
            for k in range(1, n):
                number[np.maximum(at[1:] - k, at[:-1])[at[1:] > at[:-1]]] = 0
            out.append(number)
    return at, out


@dataclass
class Model:
    """``weights[i]`` is regression weight times log-count ratio of feature i; 0: not used."""

    weights: np.ndarray
    bias: float

    @cached_property
    def used(self) -> np.ndarray:
        return self.weights != 0

    def scores(self, column: pa.Array) -> np.ndarray:
        data, offsets = K.buffer(column)
        out = []
        for a, b in K.chunks(offsets):
            at, sets = features(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            found = [np.zeros(0, np.int64)]
            for numbers in sets:
                i = np.flatnonzero(self.used[numbers])
                row = np.searchsorted(at, i, "right") - 1
                found.append(np.unique((row << BITS) | numbers[i]))
            both = np.unique(np.concatenate(found))
            rows, numbers = both >> BITS, both & ((1 << BITS) - 1)
            z = np.bincount(rows, self.weights[numbers], b - a) + self.bias
            out.append(1 / (1 + np.exp(-np.clip(z, -500, 500))))
        return np.concatenate(out) if out else np.zeros(0)


def presence(data: np.ndarray, offsets: np.ndarray, bits: int = BITS):
    """The distinct feature numbers of each text, one array after the other."""
    seen = np.zeros(1 << bits, bool)
    for a, b in K.chunks(offsets):
        at, sets = features(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], bits=bits)
        for p, q in zip(at.tolist(), at[1:].tolist()):
            for numbers in sets:
                seen[numbers[p:q]] = True
            seen[0] = False
            found = np.flatnonzero(seen)
            seen[found] = False
            yield found


def ratios(
    toxic: np.ndarray, clean: np.ndarray, n_toxic: int, n_clean: int, smooth: float, sure: float, least: float
) -> np.ndarray:
    """Log-count ratio of each feature, 0 where it is less than ``sure`` standard errors or ``least`` from 0."""
    p, q = (toxic + smooth) / (n_toxic + 2 * smooth), (clean + smooth) / (n_clean + 2 * smooth)
    r = np.log(p / q)
    error = np.sqrt((1 - p) / (toxic + smooth) + (1 - q) / (clean + smooth))
    return np.where(np.abs(r) >= np.maximum(sure * error, least), r, 0.0)


def regression(rows, values, columns, y, n_columns: int, l2: float, steps: int = 200) -> tuple[np.ndarray, float]:
    """Weights and bias of logistic regression with a quadratic penalty, by accelerated gradient steps."""
    n = len(y)
    w, b = np.zeros(n_columns), float(np.log((y.sum() + 1) / (n - y.sum() + 1)))
    norm = np.bincount(rows, values**2, n)
    rate = 4.0 / (norm.max(initial=1.0) + 1.0)
    vw, vb, momentum = w.copy(), b, 0.0
    for k in range(steps):
        z = np.bincount(rows, values * vw[columns], n) + vb
        g = 1 / (1 + np.exp(-np.clip(z, -500, 500))) - y
        nw = vw - rate * (np.bincount(columns, values * g[rows], n_columns) / n * 50 + l2 * vw)
        nb = vb - rate * g.mean() * 50
        momentum = k / (k + 3)
        vw, vb, w, b = nw + momentum * (nw - w), nb + momentum * (nb - b), nw, nb
    return w, b


@K.lean
def _count(batches):
    """Labelled texts to counts of texts by feature for either class (0, 1), and of texts (2)."""
    counts, rows = np.zeros((2, 1 << BITS), np.int64), np.zeros(2, np.int64)
    for batch in batches:
        data, offsets = K.buffer(batch.column("text"))
        label = batch.column("toxic").to_numpy().tolist()
        for y, found in zip(label, presence(data, offsets), strict=True):
            counts[y, found] += 1
            rows[y] += 1
    yield from counting.send({0: counts[0], 1: counts[1], 2: rows})


def _sample(r):
    def run(batches):
        use = r.value
        for batch in batches:
            data, offsets = K.buffer(batch.column("text"))
            found = [f[use[f]].astype(np.int32) for f in presence(data, offsets)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(batch.column("toxic")), pa.array([f.tobytes() for f in found], pa.binary())], names=["toxic", "found"]
            )

    return K.lean(run)


def labelled(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, broadcast_rows: int = 2_000_000) -> DataFrame:
    """Texts with a label: K1, K2, text, toxic. A document with several labels is toxic if one of them says so.

    Up to ``broadcast_rows`` labels (checked; 16 bytes each) go to the texts; beyond, texts are shuffled to them.
    """
    known = labels.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{label_col}`").cast("int").alias("toxic"))
    known = known.filter(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    small = labels.count() <= broadcast_rows
    return keyed(docs, id_col, text_col).join(F.broadcast(known) if small else known, "doc_id")


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    fit_rows: int = 8_000, fit_bytes: int = 128 << 20, smooth: float = 1.0, sure: float = 3.0, least: float = 0.8, l2: float = 0.01,
) -> Model:
    """Learn from all given documents that have a label 0 or 1.

    Ratios are counted over all of them; the regression is fitted on about ``fit_rows`` of them, chosen by a hash
    of the row: half of either class, or all of a class that has fewer and more of the other; of very long texts fewer, so that their features are about ``fit_bytes`` on the driver. The bias is corrected for the classes' shares. Without labels of both classes every score is the smoothed share of toxic texts. Runs jobs when called.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = labelled(docs, labels, id_col, text_col, label_col)
    sent = rows.select("text", "toxic").mapInArrow(_count, counting.SENT)
    counts = counting.total(sent, {0: 1 << BITS, 1: 1 << BITS, 2: 2})
    n = counts[2].tolist()
    bias = float(np.log((n[1] + 1) / (n[0] + 1)))
    if not (n[0] and n[1]):
        return Model(np.zeros(1 << BITS, np.float64), bias)
    r = ratios(counts[1], counts[0], n[1], n[0], smooth, sure, least)
    r[0] = 0
    rate = [min(1.0, max(fit_rows // 2, fit_rows - n[1 - c]) / n[c]) for c in (0, 1)]
    use = spark.sparkContext.broadcast(r != 0)

    def chosen(share: float) -> DataFrame:
        bound = F.when(F.col("toxic") == 1, F.lit(int(2**40 * rate[1] * share))).otherwise(F.lit(int(2**40 * rate[0] * share)))
        part = F.pmod(F.xxhash64(F.lit(7), "__llm_k1", "__llm_k2"), F.lit(1 << 40)) < bound
        return rows.filter(part).select("text", "toxic").mapInArrow(_sample(use), "toxic int, found binary")

    got = settle(chosen(1.0))
    size = got.agg(F.sum(F.octet_length("found") + 64)).first()[0] or 0
    got = (got if size <= fit_bytes else chosen(fit_bytes / size)).collect()  # of long texts the same share of either class
    y = np.array([x[0] for x in got], float)
    found = [np.frombuffer(x[1], np.int32) for x in got]
    if not 0 < y.sum() < len(y):
        return Model(np.zeros(1 << BITS, np.float64), bias)
    at, numbers = np.repeat(np.arange(len(y)), list(map(len, found))), np.concatenate(found)
    used = np.flatnonzero(r)
    column = np.zeros(1 << BITS, np.int64)
    column[used] = np.arange(len(used))
    w, b = regression(at, r[numbers], column[numbers], y, len(used), l2)
    b += float(np.log(n[1] / y.sum()) - np.log(n[0] / (len(y) - y.sum())))  # as the classes are in all rows
    weights = np.zeros(1 << BITS)
    weights[used] = w * r[used]
    return Model(weights, b)


def _score(model):
    def run(batches):
        for batch in batches:
            score = model.value.scores(batch.column("text"))
            columns = [batch.column("doc_id"), pa.array(score), pa.array((score >= 0.5).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "score", "predicted"])

    return K.lean(run)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, score (0 to 1), predicted (1 if score >= 0.5). NULL and empty texts have the bias alone."""
    ship(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return keyed(docs, id_col, text_col).select("doc_id", "text").mapInArrow(_score(sent), "doc_id long, score double, predicted int")
