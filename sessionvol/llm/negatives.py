"""Hard negatives from embeddings, over Hilbert-ordered blocks with zone maps (operator 11).

An anchor's positives are its best other rows of its label; for each of them its hard negatives are the best rows of another label whose score
lies in a window below the positive's. The score is the inner product of whole-number components, so all comparisons are exact.

All rows are candidates. They are put in the order of a Hilbert curve through all dimensions (with ``bits`` bits each) and written to Parquet in blocks of
BLOCK_ROWS, with the smallest and largest value of each dimension (a zone map) and the labels of the block. By interval arithmetic a zone map bounds the scores of
an anchor with all rows of the block; a block is read for an anchor only if the bounds meet one of its windows and the labels allow it. For positives the
window begins at the anchor's ``positives``-th best score in its own block.

At scale: neighbouring blocks form groups of about GROUP_VALUES components. Anchors travel in packs. Every pack meets every chunk of zone maps (a hundredth of
the rows against a 128th of their size), and then only the groups with a block that it needs; a group is held by one task while packs stream past it, scored by one
matrix product for each. Only folders (shelves) of needed groups are opened. Rows go to ranges of the curve by key, id, vector and place in
the input, so copies of one vector fill many blocks. What a task sends on is at most ``negatives`` rows for each window.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionvol.llm import kernels as K
from sessionvol.llm.rows import ship, shuffle_partitions
from sessionvol.session import new_folder, settle

BLOCK_ROWS = 256
#: Components in a group of blocks, and anchors in a pack.
GROUP_VALUES, PACK = 1 << 20, 256
#: Folders of the candidates' table.
SHELVES = 256
#: Anchors that are scored at a time.
TOGETHER = 64
_END = np.iinfo(np.int64).max
_GROUP_BITS, _BLOCK_BITS, _ROW_BITS = 20, 12, 8
_CANDIDATES = "shelf int, grp long, block int, n int, lo binary, hi binary, labels binary, ids binary, known binary, label binary, vecs binary"
_ANCHORS = "pack long, a long, id long, label long, least long, vec binary"
_RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places along a Hilbert curve: from cells (rows, dimensions) of ``bits`` bits each to bytes (rows, length) that sort like the places.

    The published transform between axes and transposed index (J. Skilling, 2004), on all rows at once.
    """
    x = np.ascontiguousarray(cells.T).astype(np.uint32)
    dims = len(x)
    for level in range(bits - 1, 0, -1):
        top, below = np.uint32(1 << level), np.uint32((1 << level) - 1)
        for i in range(dims):
            turned = (x[i] & top) > 0
            swap = np.where(turned, np.uint32(0), (x[0] ^ x[i]) & below)
            x[0] ^= np.where(turned, below, swap)
            if i:
                x[i] ^= swap
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    flip = np.zeros(x.shape[1], np.uint32)
    for level in range(bits - 1, 0, -1):
        flip ^= np.where((x[-1] >> np.uint32(level)) & np.uint32(1) > 0, np.uint32((1 << level) - 1), np.uint32(0))
    x ^= flip
    planes = [(x >> np.uint32(level)) & np.uint32(1) for level in range(bits - 1, -1, -1)]
    return np.packbits(np.concatenate(planes).T.astype(np.uint8), axis=1)


def _scaled(column: pa.Array, scale: float, dims: int) -> np.ndarray:
    """floor(scale * x) of a column of lists, with zeros up to ``dims``."""
    size = np.diff(column.offsets.to_numpy().astype(np.int64))
    values = np.floor(scale * column.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    out = np.zeros((len(column), dims))
    out[np.arange(dims) < size[:, None]] = values
    return out + 0.0  # no negative zeros


def _facts(scale: float):
    def run(batches):
        n = dims = m = 0
        most = s1 = s2 = 0.0
        for batch in batches:
            column = batch.column("vec")
            size = np.diff(column.offsets.to_numpy().astype(np.int64))
            values = np.floor(scale * column.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
            n, dims, m = n + len(batch), max(dims, int(size.max(initial=0))), m + len(values)
            most = max(most, float(np.abs(values).max(initial=0)))
            small = np.clip(values, -1e100, 1e100)
            s1, s2 = s1 + float(small.sum()), s2 + float((small * small).sum())
        if n:
            yield pa.RecordBatch.from_pydict({"n": [n], "dims": [dims], "m": [m], "most": [most], "s1": [s1], "s2": [s2]})

    return K.lean(run)


class Shape:
    """What all tasks know of the vectors: dimensions, how they are stored, and whether inner products are exact as doubles."""

    def __init__(self, dims: int, most: float, mean: float, spread: float, bits: int):
        self.dims, self.bits = max(dims, 1), bits
        self.kind = "<i2" if most < 1 << 15 else "<i4" if most < 1 << 31 else "<f8"
        self.exact = self.dims * most * most < 1 << 53
        self.low, self.width = mean - 2 * spread, max(4 * spread, 1e-9) / (1 << bits)
        self.group_blocks = max(1, min((1 << _BLOCK_BITS) - 1, GROUP_VALUES // (BLOCK_ROWS * self.dims)))

    def vectors(self, raw: bytes) -> np.ndarray:
        return np.frombuffer(raw, self.kind).reshape(-1, self.dims).astype(np.float64)

    def products(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Inner products of all rows of both, exact; those out of a long's range are its ends."""
        if self.exact:
            return (a @ b.T).astype(np.int64)
        whole = lambda x: np.array([[int(v) for v in row] for row in x], object).reshape(x.shape)
        found = whole(a) @ whole(b).T
        return np.clip(found, -_END, _END).astype(np.int64)


def _coded(shape: Shape, scale: float):
    """Vectors to their place on the curve, and their place in the input."""

    def run(batches):
        begin, done = TaskContext.get().partitionId() << 33, 0
        for batch in batches:
            if not len(batch):
                continue
            vecs = _scaled(batch.column("vec"), scale, shape.dims)
            cells = np.clip((vecs - shape.low) / shape.width, 0, (1 << shape.bits) - 1).astype(np.uint32)
            keys = hilbert(cells, shape.bits)
            place = begin + done + np.arange(len(batch))
            done += len(batch)
            packed = vecs.astype(shape.kind)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("label"), pa.array([r.tobytes() for r in keys]), pa.array([r.tobytes() for r in packed]), pa.array(place)],
                names=["id", "label", "key", "vec", "place"],
            )

    return K.lean(run)


def _blocks(shape: Shape, partitions: int):
    """Rows in order to blocks with zone maps."""

    def run(batches):
        part, k = TaskContext.get().partitionId(), 0
        shelf = part * SHELVES // max(partitions, part + 1)

        def made(rows: pa.Table):
            nonlocal k
            ids, label = rows.column("id").combine_chunks(), rows.column("label").combine_chunks().to_numpy()
            raw = b"".join(rows.column("vec").to_pylist())
            vecs = shape.vectors(raw)
            low, high = vecs.min(axis=0), vecs.max(axis=0)
            out = {
                "shelf": shelf, "grp": (part << _GROUP_BITS) + k // shape.group_blocks, "block": k % shape.group_blocks, "n": len(rows),
                "lo": low.tobytes(), "hi": high.tobytes(), "labels": np.unique(label).tobytes(), "ids": ids.fill_null(_END).to_numpy().tobytes(),
                "known": ids.is_valid().to_numpy(zero_copy_only=False).tobytes(), "label": label.tobytes(), "vecs": raw,
            }
            k += 1
            return out

        held, n = [], 0
        kinds = {"shelf": pa.int32(), "grp": pa.int64(), "block": pa.int32(), "n": pa.int32()}

        def sent(found):
            return pa.RecordBatch.from_arrays([pa.array([f[c] for f in found], kinds.get(c, pa.binary())) for c in found[0]], names=list(found[0]))

        for batch in batches:
            if not len(batch):
                continue
            held.append(batch)
            n += len(batch)
            if n >= BLOCK_ROWS:
                rows = pa.Table.from_batches(held)
                yield sent([made(rows.slice(a, BLOCK_ROWS)) for a in range(0, n - BLOCK_ROWS + 1, BLOCK_ROWS)])
                rest = rows.slice(n - n % BLOCK_ROWS)
                held, n = rest.to_batches(), len(rest)
        if n:
            yield sent([made(pa.Table.from_batches(held))])

    return K.lean(run)


class Block:
    """One block's rows."""

    def __init__(self, shape: Shape, ids: bytes, known: bytes, label: bytes, vecs: bytes):
        self.ids, self.known, self.label = np.frombuffer(ids, np.int64), np.frombuffer(known, bool), np.frombuffer(label, np.int64)
        self.vecs = shape.vectors(vecs)


def _anchors(shape: Shape, every: int, positives: int):
    """Blocks to their anchors, each with the score from which on a row of its label can be a positive (NULL: any)."""

    def run(batches):
        begin, done = TaskContext.get().partitionId() << 33, 0
        for batch in batches:
            for grp, number, *raw in zip(*(batch.column(c).to_pylist() for c in ("grp", "block", "ids", "known", "label", "vecs"))):
                block = Block(shape, *raw)
                at = np.flatnonzero(block.known & (block.ids % every == 0))
                if not len(at):
                    continue
                found = shape.products(block.vecs[at], block.vecs)
                least = []
                for i, row in zip(at.tolist(), found):
                    same = block.label == block.label[i]
                    same[i] = False
                    row = row[same]
                    least.append(int(np.partition(row, len(row) - positives)[len(row) - positives]) if len(row) >= positives else None)
                name = (((grp << _BLOCK_BITS) + number) << _ROW_BITS) + at
                vecs = block.vecs[at].astype(shape.kind)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(begin + (done + np.arange(len(at))) // PACK), pa.array(name), pa.array(block.ids[at]), pa.array(block.label[at]),
                     pa.array(least, pa.int64()), pa.array([v.tobytes() for v in vecs])],
                    names=["pack", "a", "id", "label", "least", "vec"],
                )
                done += len(at)

    return K.lean(run)


def _windows(score: Column, percent: int) -> list[Column]:
    """The window below a positive's score: from its share of ``percent``, rounded up, to the score. Whole numbers of any size."""
    wide = score.cast("decimal(20,0)")
    return [F.ceil(wide * percent / 100).cast("long"), score]


def _packed(anchors: DataFrame) -> DataFrame:
    """Packs of anchors, with the windows that rows must be in: pack, names, labels, lows, highs (as many for each anchor), vecs."""
    rows = F.sort_array(F.collect_list(F.struct("a", "label", "lows", "highs", "vec")))
    return anchors.groupBy("pack").agg(rows.alias("r")).select(
        "pack", F.col("r.a").alias("names"), F.col("r.label").alias("labels"), F.col("r.lows").alias("lows"), F.col("r.highs").alias("highs"), F.col("r.vec").alias("vecs")
    )


class Pack:
    """Anchors of a pack."""

    def __init__(self, shape: Shape, names, labels, lows, highs, vecs):
        self.names, self.labels = np.array(names, np.int64), np.array(labels, np.int64)
        widest = max(map(len, lows))
        fill = lambda x, v: np.array([[*row, *[v] * (widest - len(row))] for row in x], np.int64)
        self.lows, self.highs = fill(lows, _END), fill(highs, -_END)  # what is missing is an empty window
        self.vecs = shape.vectors(b"".join(vecs))


_PACK_COLUMNS = ["names", "labels", "lows", "highs", "vecs"]
_PACK_FIELDS = "names array<long>, labels array<long>, lows array<array<long>>, highs array<array<long>>, vecs array<binary>"


def _choose(shape: Shape, own_label: bool):
    """Zone maps, then packs, of a chunk: the blocks that a pack needs, one row for each group with any."""

    def run(batches):
        chunk, zones, ready = None, [], None
        for batch in batches:
            if not len(batch):
                continue
            for row in batch.to_pylist():
                if row["chunk"] != chunk:
                    chunk, zones, ready = row["chunk"], [], None
                if row["kind"] == 0:
                    zones.append((row["grp"], row["block"], *(np.frombuffer(row[c]) for c in ("lo", "hi")), np.frombuffer(row["zone_labels"], np.int64)))
                    continue
                if not zones:
                    continue
                if ready is None:
                    zones.sort(key=lambda z: z[:2])
                    ready = np.stack([z[2] for z in zones]), np.stack([z[3] for z in zones])
                low, high = ready
                pack = Pack(shape, *(row[c] for c in _PACK_COLUMNS))
                if shape.exact:
                    up, down = np.maximum(pack.vecs, 0), np.minimum(pack.vecs, 0)
                    most, least = (up @ high.T + down @ low.T).astype(np.int64), (up @ low.T + down @ high.T).astype(np.int64)
                    need = np.zeros(most.shape, bool)
                    for lows, highs in zip(pack.lows.T, pack.highs.T):
                        need |= (lows <= highs)[:, None] & (most >= lows[:, None]) & (least <= highs[:, None])
                else:  # bounds of doubles aren't exact
                    need = np.repeat((pack.lows <= pack.highs).any(axis=1)[:, None], len(zones), axis=1)
                for k, zone in enumerate(zones):
                    if own_label:
                        need[:, k] &= np.isin(pack.labels, zone[4])
                    elif len(zone[4]) == 1:
                        need[:, k] &= pack.labels != zone[4][0]
                used = need.any(axis=0)
                found: dict[int, np.ndarray] = {}
                for k in np.flatnonzero(used).tolist():
                    mask = found.setdefault(zones[k][0], np.zeros((len(pack.names), shape.group_blocks), bool))
                    mask[:, zones[k][1]] = need[:, k]
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(list(found)), pa.array([row["pack"]] * len(found)), pa.array([np.packbits(m).tobytes() for m in found.values()])],
                        names=["grp", "pack", "mask"],
                    )

    return K.lean(run)


def _best(scores: np.ndarray, ids: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Order of rows: higher scores first, then smaller ids, rows without an id last."""
    return np.lexsort((ids, ~known, -scores))


def _score(shape: Shape, own_label: bool, wanted: int):
    """Blocks, then packs with the blocks they need, of a group: for each anchor and window its best rows."""

    def of_pack(blocks: dict[int, Block], pack: Pack, mask: np.ndarray, grp: int):
        for a in range(0, len(pack.names), TOGETHER):
            part = slice(a, a + TOGETHER)
            some = [b for b in np.flatnonzero(mask[part].any(axis=0)).tolist() if b in blocks]
            if not some:
                continue
            ids, known, label = (np.concatenate([getattr(blocks[b], c) for b in some]) for c in ("ids", "known", "label"))
            place = np.concatenate([(((grp << _BLOCK_BITS) + b) << _ROW_BITS) + np.arange(len(blocks[b].ids)) for b in some])
            scores = shape.products(pack.vecs[part], np.concatenate([blocks[b].vecs for b in some]))
            for i, row in enumerate(scores, a):
                lows, highs = pack.lows[i], pack.highs[i]
                fit = (label == pack.labels[i]) if own_label else (label != pack.labels[i])
                fit &= (row >= lows.min()) & (row <= highs.max())
                if own_label:
                    fit &= place != pack.names[i]
                at = np.flatnonzero(fit)
                if own_label and len(at) > wanted:  # one window without an end: only its best
                    at = at[row[at] >= np.partition(row[at], len(at) - wanted)[len(at) - wanted]]
                if not len(at):
                    continue
                at = at[_best(row[at], ids[at], known[at])]
                for w, (low, high) in enumerate(zip(lows.tolist(), highs.tolist())):
                    begin = np.searchsorted(-row[at], -high, "left")
                    best = at[begin : begin + wanted]
                    best = best[row[best] >= low]
                    if len(best):
                        yield np.full(len(best), pack.names[i]), np.full(len(best), w, np.int32), row[best], ids[best], known[best]

    def run(batches):
        grp, blocks, found, held = None, {}, [], 0
        for batch in batches:
            for row in batch.to_pylist():
                if row["grp"] != grp:
                    grp, blocks = row["grp"], {}
                if row["kind"] == 0:
                    blocks[row["block"]] = Block(shape, *(row[c] for c in ("ids", "known", "label", "rows")))
                    continue
                pack = Pack(shape, *(row[c] for c in _PACK_COLUMNS))
                mask = np.unpackbits(np.frombuffer(row["mask"], np.uint8))[: len(pack.names) * shape.group_blocks].reshape(len(pack.names), -1) > 0
                for part in of_pack(blocks, pack, mask, grp):
                    found.append(part)
                    held += len(part[0])
                if held > 1 << 16:
                    yield _sent(found)
                    found, held = [], 0
        if found:
            yield _sent(found)

    return K.lean(run)


def _sent(found) -> pa.RecordBatch:
    a, w, score, ids, known = map(np.concatenate, zip(*found))
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(w), pa.array(score), pa.array(ids, mask=~known)], names=["a", "w", "score", "id"])


def _search(candidates: DataFrame, folder: str, shape: Shape, packs: DataFrame, n_blocks: int, own_label: bool, wanted: int) -> tuple[DataFrame, DataFrame]:
    """The ``wanted`` best rows of each anchor's windows: a, w (window), score, id, rank; and the blocks that each pack read, by group."""
    spark = candidates.sparkSession
    none = lambda name, kind: F.lit(None).cast(kind).alias(name)
    chunks = max(1, min(shuffle_partitions(spark), n_blocks), n_blocks // 1024)
    zones = candidates.select(
        F.pmod(F.xxhash64("grp", "block"), F.lit(chunks)).cast("int").alias("chunk"), F.lit(0).alias("kind"), none("pack", "long"),
        "grp", "block", "lo", "hi", F.col("labels").alias("zone_labels"), *(none(*f.split(" ", 1)) for f in _PACK_FIELDS.split(", ")),
    )
    every = packs.select(
        F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"), F.lit(1).alias("kind"), "pack", none("grp", "long"), none("block", "int"), none("lo", "binary"),
        none("hi", "binary"), none("zone_labels", "binary"), *_PACK_COLUMNS,
    )
    met = zones.union(every).repartition(chunks, "chunk").sortWithinPartitions("chunk", "kind", "pack")
    needs = settle(met.mapInArrow(_choose(shape, own_label), "grp long, pack long, mask binary"))
    groups = settle(needs.select("grp").distinct())
    shelves = sorted(r[0] for r in candidates.join(groups, "grp", "left_semi").select("shelf").distinct().collect())  # SHELVES at most
    read = spark.read.schema(candidates.schema).parquet(folder).filter(F.col("shelf").isin(shelves)) if shelves else candidates.limit(0)
    read = read.join(groups, "grp", "left_semi")
    rows = read.select(
        "grp", F.lit(0).alias("kind"), none("pack", "long"), "block", "ids", "known", "label", F.col("vecs").alias("rows"), none("mask", "binary"),
        *(none(*f.split(" ", 1)) for f in _PACK_FIELDS.split(", ")),
    )
    asked = needs.join(packs, "pack").select(
        "grp", F.lit(1).alias("kind"), "pack", none("block", "int"), *(none(c, "binary") for c in ("ids", "known", "label", "rows")), "mask", *_PACK_COLUMNS
    )
    parts = max(shuffle_partitions(spark), min(4096, n_blocks // shape.group_blocks))
    dealt = rows.union(asked).repartition(parts, "grp").sortWithinPartitions("grp", "kind", "pack", "block")
    found = settle(dealt.mapInArrow(_score(shape, own_label, wanted), "a long, w int, score long, id long"))
    order = Window.partitionBy("a", "w").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return settle(found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= wanted)), needs


def usable(vectors: DataFrame, id_col: str, label_col: str, vec_col: str) -> DataFrame:
    """Rows that take part: id, label, vec."""
    vec = F.col(f"`{vec_col}`")
    good = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = vectors.filter(F.col(f"`{label_col}`").isNotNull() & vec.isNotNull() & F.coalesce(good, F.lit(False)))
    return rows.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{label_col}`").cast("long").alias("label"), vec.cast("array<double>").alias("vec"))


def hard_negatives(
    vectors: DataFrame, id_col: str = "vec_id", label_col: str = "label", vec_col: str = "embedding", scale: float = 256.0, anchors_every: int = 100,
    positives: int = 5, negatives: int = 5, percent: int = 80, bits: int = 4,
) -> DataFrame:
    """For each anchor and positive: anchor_id, positive_id, rank (of the negative, from 1), negative_id, positive_score, negative_score.

    Components become floor(scale * x). Anchors are rows whose id is divisible by ``anchors_every``; positives the first ``positives`` other rows of the label, negatives
    the first ``negatives`` of the different-label rows whose score is at least ``percent`` hundredths of the positive's and not above it. Higher scores come
    first, then smaller ids, rows without an id last. A negative positive score has no such rows, and so no row here.

    Rows with a NULL label or vector, or a NULL or non-finite component, take no part. Shorter vectors count as ending in zeros. Rows may repeat: each is
    a row of its own, so a copy of an anchor is another row of its label, and another anchor. Scores beyond a long's range count as its ends. An empty table gives no rows. Runs jobs when called.
    """
    found, _ = mine(vectors, id_col, label_col, vec_col, scale, anchors_every, positives, negatives, percent, bits)
    return found


def mine(vectors, id_col, label_col, vec_col, scale, anchors_every, positives, negatives, percent, bits) -> tuple[DataFrame, dict[str, DataFrame]]:
    """``hard_negatives``, and its tables: candidates (blocks), and for positives and negatives the groups that each pack read."""
    spark = vectors.sparkSession
    ship(spark)
    rows = usable(vectors, id_col, label_col, vec_col)
    facts = rows.select("vec").mapInArrow(_facts(scale), "n long, dims long, m long, most double, s1 double, s2 double")
    n, dims, m, most, s1, s2 = facts.agg(F.sum("n"), F.max("dims"), F.sum("m"), F.max("most"), F.sum("s1"), F.sum("s2")).first()
    if not n:
        return spark.createDataFrame([], _RESULT), {}
    mean = s1 / max(m, 1)
    shape = Shape(dims, most, mean, max(s2 / max(m, 1) - mean * mean, 0.0) ** 0.5, bits)

    partitions = max(shuffle_partitions(spark), -(-n // (BLOCK_ROWS * shape.group_blocks)))
    partitions = max(1, min(partitions, -(-n // BLOCK_ROWS)))
    coded = rows.mapInArrow(_coded(shape, scale), "id long, label long, key binary, vec binary, place long")
    ranged = coded.repartitionByRange(partitions, "key", "id", "vec", "place").sortWithinPartitions("key", "id", "vec", "label")
    folder = new_folder(spark, "blocks")
    ranged.mapInArrow(_blocks(shape, partitions), _CANDIDATES).write.partitionBy("shelf").parquet(folder)
    schema = spark.createDataFrame([], _CANDIDATES).schema
    candidates = spark.read.schema(schema).parquet(folder)
    n_blocks = candidates.count()

    anchors = settle(candidates.mapInArrow(_anchors(shape, anchors_every, positives), _ANCHORS))
    open_end = anchors.withColumn("lows", F.array(F.coalesce("least", F.lit(-_END)))).withColumn("highs", F.array(F.lit(_END)))
    best, read_p = _search(candidates, folder, shape, settle(_packed(open_end)), n_blocks, True, positives)
    low, high = _windows(F.col("score"), percent)
    per_anchor = best.groupBy("a").agg(F.sort_array(F.collect_list(F.struct("rank", low.alias("low"), high.alias("high")))).alias("s"))
    per_anchor = per_anchor.select("a", F.col("s.low").alias("lows"), F.col("s.high").alias("highs"))
    packs = settle(_packed(anchors.join(per_anchor, "a")))
    below, read_n = _search(candidates, folder, shape, packs, n_blocks, False, negatives)

    pairs = best.select("a", (F.col("rank") - 1).alias("w"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    names = anchors.select("a", F.col("id").alias("anchor_id"))
    rows = below.select("a", "w", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    result = rows.join(pairs, ["a", "w"]).join(names, "a").select(*(f.split(" ")[0] for f in _RESULT.split(", ")))
    return result, {"candidates": candidates, "positives": read_p, "negatives": read_n, "anchors": anchors}
