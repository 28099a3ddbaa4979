"""Language ID by hyperdimensional profiles (operator 7).

Every letter, and the gap between words, has a random vector of +1 and -1, drawn from its code point. An n-gram's
vector is the product of its letters' vectors, each rotated by its place from the end (binding and permutation). A text's
vector is the sum of its n-grams' vectors (bundling), a language's prototype the sum over its learning texts, so a long text weighs as its
n-grams do; both are compared by cosine. Letters are lower-cased; everything that is no letter separates words.

Sums are linear, so texts are bundled as products of count matrices with the n-gram vectors.

At scale: learning sends one vector for each language and batch, scoring reads each text once; nothing else is shuffled. The model has
DIMENSIONS numbers for each language.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionvol.llm import kernels as K
from sessionvol.llm import letters as L
from sessionvol.llm.rows import keyed, ship

DIMENSIONS = 1024
SIZE = 3
UNKNOWN = "und"
#: n-grams whose vectors are multiplied at once.
_COLUMNS = 4096
#: Bytes of text whose counts form one matrix.
_BYTES = 1 << 19


class Space:
    """Vectors of letters and n-grams, kept by each Python worker."""

    def __init__(self, dimensions: int = DIMENSIONS, seed: int = 11):
        self.dimensions, self.seed = dimensions, seed
        self.letter = L.Table(L.letter)
        self.vectors: dict[int, np.ndarray] = {}
        self.place: dict[tuple[int, ...], int] = {}
        self.grams = np.zeros((1024, dimensions), np.int8)

    def of(self, point: int) -> np.ndarray:
        if point not in self.vectors:
            draw = np.random.default_rng([self.seed, point]).integers(0, 2, self.dimensions, dtype=np.int8)
            self.vectors[point] = draw * 2 - 1
        return self.vectors[point]

    def gram(self, points: tuple[int, ...]) -> int:
        """The place of an n-gram's vector in ``grams``."""
        at = self.place.get(points)
        if at is None:
            if len(self.place) == len(self.grams):
                if len(self.grams) >= 1 << 16:  # 64 MB; scripts with more n-grams begin anew
                    self.place.clear()
                else:
                    self.grams = np.concatenate([self.grams, np.zeros_like(self.grams)])
            at = self.place[points] = len(self.place)
            vector = np.ones(self.dimensions, np.int8)
            for k, p in enumerate(reversed(points)):
                vector = vector * np.roll(self.of(p), k)
            self.grams[at] = vector
        return at

    def counts(self, data: np.ndarray, offsets: np.ndarray):
        """n-grams of a group of texts: the points of the distinct ones, and row, column and count of each
        that a text has. An n-gram of three has a letter in its middle; gaps are at its ends only."""
        points, at = L.points(data, offsets)
        x = np.insert(self.letter(points), at[:-1], 0)  # a gap before each text
        doc = np.repeat(np.arange(len(at) - 1), np.diff(at) + 1)
        keep = np.ones(len(x), bool)
        keep[1:] = (x[1:] != 0) | (x[:-1] != 0)
        x, doc = np.append(x[keep], 0), doc[keep]
        present = np.flatnonzero(np.bincount(x, minlength=1))
        code = np.zeros(int(present[-1]) + 1, np.int64)
        code[present] = np.arange(len(present))
        c = code[x]
        middle = np.flatnonzero(x[1:-1] != 0) + 1 if len(x) > 2 else np.zeros(0, np.int64)
        key = (c[middle - 1] * len(present) + c[middle]) * len(present) + c[middle + 1]
        grams, column = np.unique(key, return_inverse=True) if len(present) > 128 else _ranks(key, len(present) ** 3)
        n = max(1, len(grams))
        cells, many = np.unique(doc[middle] * n + column, return_counts=True)
        last, first = grams % len(present), grams // len(present)
        triples = np.stack([present[first // len(present)], present[first % len(present)], present[last]], axis=1)
        return triples, cells // n, cells % n, many

    def bundle(self, data: np.ndarray, offsets: np.ndarray, group: np.ndarray, n_groups: int) -> np.ndarray:
        """The sum of the n-gram vectors of the texts of each group."""
        triples, row, column, many = self.counts(data, offsets)
        out = np.zeros((n_groups, self.dimensions))
        row = group[row]
        for a in range(0, len(triples), _COLUMNS):
            b = min(a + _COLUMNS, len(triples))
            here = (column >= a) & (column < b) & (row >= 0)
            matrix = np.bincount(row[here] * (b - a) + column[here] - a, many[here], n_groups * (b - a))
            places = [self.gram(t) for t in map(tuple, triples[a:b].tolist())]
            if len(set(places)) < len(places):  # begun anew in between
                places = [self.gram(t) for t in map(tuple, triples[a:b].tolist())]
            out += matrix.reshape(n_groups, b - a).astype(np.float32) @ self.grams[places].astype(np.float32)
        return out


def _ranks(key: np.ndarray, bound: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys below a bound, and the rank of each key among them."""
    there = np.zeros(bound, bool)
    there[key] = True
    grams = np.flatnonzero(there)
    rank = np.zeros(bound, np.int32)
    rank[grams] = np.arange(len(grams), dtype=np.int32)
    return grams, rank[key].astype(np.int64)


_SPACE: dict[int, Space] = {}


def _space(dimensions: int) -> Space:
    return _SPACE.setdefault(dimensions, Space(dimensions))


@dataclass
class Profiles:
    """Languages in order and their unit prototypes, one in each row."""

    names: list[str] = field(default_factory=list)
    prototypes: np.ndarray = field(default_factory=lambda: np.zeros((0, DIMENSIONS)))

    def predict(self, column: pa.Array) -> tuple[list[str], np.ndarray]:
        data, offsets = K.buffer(column)
        names, scores = [], []
        for a, b in K.chunks(offsets, _BYTES):
            space = _space(self.prototypes.shape[1])
            vectors = space.bundle(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], np.arange(b - a), b - a)
            norm = np.sqrt((vectors**2).sum(axis=1))
            cosine = vectors @ self.prototypes.T / np.maximum(norm, 1)[:, None]
            if not self.names:
                cosine = np.zeros((b - a, 1))
            best = np.argmax(cosine, axis=1)
            known = (norm > 0) & bool(self.names)
            names += [self.names[i] if k else UNKNOWN for i, k in zip(best.tolist(), known.tolist())]
            scores.append(np.where(known, np.clip(cosine[np.arange(b - a), best], 0, 1), 0.0))
        return names, np.concatenate(scores) if scores else np.zeros(0)


def _learn(dimensions: int):
    """Texts to the sum of n-gram vectors of each language in the task."""

    def run(batches):
        space, sums = _space(dimensions), {}
        for batch in batches:
            data, offsets = K.buffer(batch.column("text"))
            lang = batch.column("lang").to_pylist()
            for a, b in K.chunks(offsets, _BYTES):
                names = sorted(set(lang[a:b]))
                group = np.array([names.index(x) for x in lang[a:b]])
                got = space.bundle(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], group, len(names))
                for name, vector in zip(names, got):
                    sums[name] = sums.get(name, 0) + vector
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums)), pa.array([v.tolist() for v in sums.values()])], names=["lang", "v"])

    return K.lean(run)


def learn(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", dimensions: int = DIMENSIONS
) -> Profiles:
    """Prototypes from all given documents with a language. Runs one job when called; the driver gets
    one sum for each language and dimension."""
    ship(docs.sparkSession)
    rows = docs.select(F.col(f"`{text_col}`").alias("text"), F.col(f"`{lang_col}`").cast("string").alias("lang"))
    rows = rows.filter(F.col("text").isNotNull() & F.col("lang").isNotNull())
    sums = (
        rows.mapInArrow(_learn(dimensions), "lang string, v array<double>")
        .select("lang", F.posexplode("v").alias("at", "x")).groupBy("lang", "at").agg(F.sum("x").alias("x"))
        .groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("at", "x"))).alias("v")).collect()
    )
    found = {r["lang"]: np.array([x["x"] for x in r["v"]]) for r in sums}
    names = sorted(k for k, v in found.items() if (v**2).sum() > 0)
    if not names:
        return Profiles([], np.zeros((0, dimensions)))
    prototypes = np.stack([found[k] / np.sqrt((found[k] ** 2).sum()) for k in names])
    return Profiles(names, prototypes)


def _predict(profiles):
    def run(batches):
        for batch in batches:
            names, scores = profiles.value.predict(batch.column("text"))
            columns = [*(batch.column(c) for c in ("__llm_k1", "__llm_k2", "doc_id")), pa.array(names, pa.string()), pa.array(scores)]
            yield pa.RecordBatch.from_arrays(columns, names=["__llm_k1", "__llm_k2", "doc_id", "lang_pred", "score"])

    return K.lean(run)


def predict(docs: DataFrame, profiles: Profiles, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: row key, doc_id, lang_pred, score (the cosine, at least 0).

    ``und`` with score 0 if the text is NULL, has no letter, or no language was learnt. Equal cosines: the first name.
    """
    ship(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(profiles)
    schema = "__llm_k1 long, __llm_k2 long, doc_id long, lang_pred string, score double"
    return keyed(docs, id_col, text_col).mapInArrow(_predict(sent), schema)


def _known(profiles, text_col: str):
    def run(batches):
        for batch in batches:
            names, _ = profiles.value.predict(batch.column(batch.schema.get_field_index(text_col)))
            yield batch.filter(pa.array([n != UNKNOWN for n in names], pa.bool_()))

    return K.lean(run)


def keep_known(docs: DataFrame, profiles: Profiles, text_col: str = "text") -> DataFrame:
    """The rows, with all their columns, whose language is known: NULL texts and those without letters go, whatever their length.

    No text goes for a low cosine: that of an unrelated text is about 0, give or take 1 / sqrt(dimensions), but so may be that of a short text
    with few of its language's n-grams.
    """
    ship(docs.sparkSession)
    return docs.mapInArrow(_known(docs.sparkSession.sparkContext.broadcast(profiles), text_col), docs.schema)
