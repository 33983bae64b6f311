"""Hard negatives by exact integer scores: Strassen products of anchor and candidate tiles, then mergeable heaps."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changeflow.llm.common import col, written
from changeflow.llm.tiles import BLOCK, TILE, Heaps, finite, groups, matrix, meet

#: A product with a side of at most so many lines or columns is not halved any more.
CUT = 16

#: Scores times 100 must fit a long.
LONGEST = (2**63 - 1) // 100
_LEAST = np.iinfo(np.int64).min


def quantised(vector: Column, scale: float = 256.0) -> Column:
    """floor(scale * x) of each component; null if a component is null, not finite or 2^31 or more after scaling."""
    fits = finite(vector) & F.forall(vector, lambda x: F.abs(x.cast("double") * scale) < 2.0**31)
    return F.when(fits, F.transform(vector, lambda x: F.floor(x.cast("double") * scale)))


def strassen(a: np.ndarray, b: np.ndarray, cut: int = CUT) -> np.ndarray:
    """The product of two int64 matrices by seven products of halves; odd sides get a line of zeros.

    Sums may pass 2^63 on the way: int64 additions wrap around, so the result is
    exact whenever it fits itself.
    """
    (m, k), n = a.shape, b.shape[1]
    if min(m, k, n) <= cut:
        return a @ b
    if m % 2 or k % 2 or n % 2:
        a = np.pad(a, ((0, m % 2), (0, k % 2)))
        b = np.pad(b, ((0, k % 2), (0, n % 2)))
    i, j, h = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:i, :j], a[:i, j:], a[i:, :j], a[i:, j:]
    b11, b12, b21, b22 = b[:j, :h], b[:j, h:], b[j:, :h], b[j:, h:]
    out = np.zeros((2 * i, 2 * h), np.int64)
    c11, c12, c21, c22 = out[:i, :h], out[:i, h:], out[i:, :h], out[i:, h:]
    p = strassen(a11 + a22, b11 + b22, cut)
    c11 += p
    c22 += p
    p = strassen(a21 + a22, b11, cut)
    c21 += p
    c22 -= p
    p = strassen(a11, b12 - b22, cut)
    c12 += p
    c22 += p
    p = strassen(a22, b21 - b11, cut)
    c11 += p
    c21 += p
    p = strassen(a11 + a12, b22, cut)
    c11 -= p
    c12 += p
    c22 += strassen(a21 - a11, b11 + b12, cut)
    c11 += strassen(a12 - a22, b21 + b22, cut)
    return out[:m, :n]


class _Side:
    """Packed rows as arrays, in ascending order of label and id."""

    def __init__(self, rows: pa.StructArray, dim: int) -> None:
        id, label = (rows.field(c).to_numpy(zero_copy_only=False) for c in ("id", "label"))
        self.order = np.lexsort((id, label))
        self.id, self.label = id[self.order], label[self.order]
        self.v = matrix(rows.field("v"), dim, "int64")[self.order]


class _Positives:
    """The best rows of the anchor's own label, over the tiles met so far."""

    def __init__(self, queries: pa.StructArray, dim: int, most: int) -> None:
        self.dim, self.a, self.heaps = dim, _Side(queries, dim), Heaps(most, "int64")

    def add(self, _: dict, rows: pa.StructArray) -> None:
        c = _Side(rows, self.dim)
        for label in np.intersect1d(self.a.label, c.label):
            i, j = np.searchsorted(self.a.label, label, "left"), np.searchsorted(self.a.label, label, "right")
            s, t = np.searchsorted(c.label, label, "left"), np.searchsorted(c.label, label, "right")
            score = strassen(self.a.v[i:j], c.v[s:t].T)
            other = self.a.id[i:j, None] != c.id[None, s:t]
            good = other & (score >= self.heaps.floors(np.arange(i, j))[:, None])
            if t - s > self.heaps.most + 1:  # one more than needed, as the anchor itself may be among them
                good &= score >= np.partition(score, -self.heaps.most - 1, axis=1)[:, -self.heaps.most - 1, None]
            x, y = np.nonzero(good)
            self.heaps.merge(x + i, score[x, y], c.id[s:t][y])

    def result(self) -> pa.RecordBatch:
        h = self.heaps
        return pa.RecordBatch.from_arrays(
            [pa.array(x, pa.int64()) for x in (self.a.id[h.key], h.id, h.score)], ["anchor_id", "positive_id", "positive_score"]
        )


class _Windows:
    """For each anchor and positive the best rows of other labels inside the positive's window, over the tiles met so far."""

    def __init__(self, queries: pa.StructArray, dim: int, most: int, least: tuple[int, int], top: tuple[int, int]) -> None:
        self.dim, self.a, self.heaps = dim, _Side(queries, dim), Heaps(most, "int64")
        positives = queries.field("positives").take(pa.array(self.a.order)).to_pylist()
        self.windows = []  # line of the anchor, positive, its score, lowest and highest score of the window
        for i, some in enumerate(positives):
            for x in some:
                low, high = -(-least[0] * x["score"] // least[1]), top[0] * x["score"] // top[1]
                self.windows.append((i, x["id"], x["score"], low, high))

    def add(self, _: dict, rows: pa.StructArray) -> None:
        c = _Side(rows, self.dim)
        by_id = np.argsort(c.id, kind="stable")
        c.id, c.label, c.v = c.id[by_id], c.label[by_id], c.v[by_id]
        score = strassen(self.a.v, c.v.T)
        score[self.a.label[:, None] == c.label[None, :]] = _LEAST
        order = np.argsort(~score, axis=1, kind="stable")  # ~x is -x-1: no overflow at the least value
        ranked = np.take_along_axis(score, order, axis=1)
        keys, scores, ids = [], [], []
        last, down = -1, None
        for w, (i, _, _, low, high) in enumerate(self.windows):
            if low > high:
                continue
            if i != last:
                last, down = i, -ranked[i][ranked[i] > _LEAST]
            start, end = np.searchsorted(down, -high, "left"), np.searchsorted(down, -low, "right")
            end = min(end, start + self.heaps.most)
            if start < end:
                keys.append(np.full(end - start, w))
                scores.append(ranked[i, start:end])
                ids.append(c.id[order[i, start:end]])
        if keys:
            self.heaps.merge(np.concatenate(keys), np.concatenate(scores), np.concatenate(ids))

    def result(self) -> pa.RecordBatch:
        h = self.heaps
        line, positive, value = (np.array([w[k] for w in self.windows], np.int64)[h.key] for k in range(3))
        return pa.RecordBatch.from_arrays(
            [pa.array(x, pa.int64()) for x in (self.a.id[line], positive, value, h.id, h.score)],
            ["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"],
        )


def mine(
    rows: DataFrame,
    anchor: Column,
    vec_id: str = "vec_id",
    vector: str = "vector",
    label: str = "label",
    positives: int = 5,
    negatives: int = 10,
    least: tuple[int, int] = (30, 100),
    top: tuple[int, int] = (90, 100),
) -> DataFrame:
    """For each anchor and each of its positives the hardest negatives: anchor_id, positive_id, rank, negative_id, both scores.

    ``vector`` is an array of whole numbers (see ``quantised``), ``anchor`` says
    which rows are anchors. Positives are the ``positives`` best rows of the
    anchor's label; a negative has another label and a score from ``least`` to
    ``top`` of the positive's, as fractions. Higher scores come first, ties by
    smaller id.

    Rows with a null id, label, vector or component take no part, nor do vectors
    whose squared length times 100 passes a long, as their scores would. Vectors
    of unequal lengths are filled up with zeros. Rows that repeat an id count
    once, as the one with the smallest label and vector. Without rows, anchors,
    positives or negatives in a window the result is empty there.

    Candidates are compared in tiles, twice: for positives only lines of the same
    label are multiplied, for windows all. What leaves a task is one heap for each
    anchor (or window) and group of tiles.
    """
    long = F.aggregate(col(vector), F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    kept = rows.where(col(vec_id).isNotNull() & col(label).isNotNull() & finite(col(vector)) & (long < float(LONGEST)))
    one = kept.groupBy(col(vec_id).cast("long").alias("id")).agg(
        F.min(F.struct(col(label).cast("long").alias("label"), col(vector).cast("array<bigint>").alias("v"), F.coalesce(anchor, F.lit(False)).alias("anchor"))).alias("r")
    )
    one = written(one.select("id", "r.*"), "hard-negative-rows")
    count, anchors, dim = one.agg(F.count("*"), F.count_if("anchor"), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
    parts = groups(one, count)
    tile = F.pmod(F.xxhash64("id"), F.lit(parts * max(1, -(-count // (parts * TILE)))))
    tiles = one.groupBy(F.pmod(tile, F.lit(parts)).alias("group"), tile.alias("tile")).agg(F.collect_list(F.struct("id", "label", "v")).alias("rows"))
    tiles = written(tiles, "hard-negative-tiles").select("group", "rows")

    def blocks(anchors_: DataFrame, *more: str) -> DataFrame:
        block = F.pmod(F.xxhash64("id"), F.lit(max(1, -(-anchors // BLOCK))))
        packed = anchors_.groupBy(block.alias("block")).agg(F.collect_list(F.struct("id", "label", "v", *more)).alias("queries"))
        return packed.withColumn("group", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))))

    chosen = one.where("anchor")
    near = meet(
        blocks(chosen), tiles, lambda q: _Positives(q, dim, positives), "anchor_id long, positive_id long, positive_score long"
    )
    best = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    near = written(near.withColumn("place", F.row_number().over(best)).where(F.col("place") <= positives), "hard-negative-positives")
    targets = near.groupBy(F.col("anchor_id").alias("id")).agg(
        F.collect_list(F.struct(F.col("positive_id").alias("id"), F.col("positive_score").alias("score"))).alias("positives")
    )
    found = meet(
        blocks(chosen.join(targets, "id"), "positives"),
        tiles,
        lambda q: _Windows(q, dim, negatives, least, top),
        "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long",
    )
    first = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    ranked = found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= negatives)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
