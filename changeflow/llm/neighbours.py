"""Nearest neighbours by inner product: p-stable hash tables, several buckets probed in each, exact scores of what they hold."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changeflow.llm.common import col, written
from changeflow.llm.tiles import BLOCK, TILE, Heaps, finite, groups, matrix, meet

#: Tables, the width of a cell in standard deviations of a projection, and the projections of a table at most:
#: a table has some 4^8 buckets at most, so a list of all buckets stays small at any size of the input.
TABLES, WIDTH, MOST_PROJECTIONS = 2, 3.0, 8

#: A bucket holds about so many rows while the number of projections is below its limit.
BUCKET = 256

#: The probes are calibrated on so many queries: so large a share of their exact neighbours is to be found.
SAMPLE, RECALL = 128, 0.97

#: Buckets further than so many deviations from where a neighbour is expected aren't listed.
REACH = 4.0
_BITS, _HALF = 7, 64


@dataclass(frozen=True)
class Index:
    """Directions and offsets of every table; cells are read off the vectors scaled to the unit sphere."""

    directions: np.ndarray  # tables x (dim + 1) x projections
    offsets: np.ndarray  # tables x projections
    width: float
    longest: float  # length of the longest row
    nearness: float = 0.0  # cosine that a neighbour sought has, on the sphere
    share: float = 1.0  # of the expected places of a neighbour that are visited in each table

    def on_sphere(self, v: np.ndarray, query: bool) -> np.ndarray:
        """A row gets the component that makes it as long as the longest; a query's length doesn't matter.

        On that sphere the nearest row is that with the largest inner product.
        """
        if query:
            return np.c_[v / np.sqrt(_squares(v))[:, None], np.zeros(len(v))]
        v = v / self.longest
        return np.c_[v, np.sqrt(np.maximum(0.0, 1.0 - _squares(v)))]

    def projections(self, v: np.ndarray, query: bool) -> np.ndarray:
        return np.einsum("nd,tdm->tnm", self.on_sphere(v, query), self.directions, optimize=True)

    def buckets(self, projections: np.ndarray) -> np.ndarray:
        """For each table and line the number of its bucket."""
        cells = np.floor((projections + self.offsets[:, None, :]) / self.width)
        return self._code(cells, np.arange(len(projections))[:, None])

    def _code(self, cells: np.ndarray, table: np.ndarray | int) -> np.ndarray:
        cells = np.clip(cells, -_HALF, _HALF - 1).astype(np.int64) + _HALF
        code = np.broadcast_to(np.asarray(table, np.int64), cells.shape[:-1]).copy()
        for k in range(cells.shape[-1]):
            code = (code << _BITS) | cells[..., k]
        return code

    def probes(self, projections: np.ndarray, table: int) -> tuple[np.ndarray, np.ndarray]:
        """Buckets of a table by falling estimated success, and the share of success up to and with each.

        Of a projection f of the query and cosine c, a neighbour's projection is
        normal around c * f with variance 1 - c * c; a bucket's estimate is the
        product of its cells'.
        """
        middle, spread = self.nearness * projections, math.sqrt(max(1.0 - self.nearness**2, 1e-4))
        cells, chance = np.zeros((1, 0)), np.ones(1)
        for f, b in zip(middle, self.offsets[table], strict=True):
            low = math.floor((f - REACH * spread + b) / self.width)
            high = math.floor((f + REACH * spread + b) / self.width)
            edges = [math.erf((e * self.width - b - f) / (spread * math.sqrt(2))) / 2 for e in range(low, high + 2)]
            one = np.diff(edges)
            cells = np.c_[np.repeat(cells, len(one), 0), np.tile(np.arange(low, high + 1), len(cells))]
            chance = np.outer(chance, one).ravel()
        order = np.argsort(-chance, kind="stable")
        share = np.cumsum(chance[order])
        return self._code(cells[order], table), share / share[-1]

    def visits(self, projections: np.ndarray) -> np.ndarray:
        """All buckets that a query visits, of every table."""
        out = []
        for t, f in enumerate(projections):
            codes, share = self.probes(f, t)
            out.append(codes[: int(np.searchsorted(share, self.share)) + 1])
        return np.concatenate(out)


def _squares(v: np.ndarray) -> np.ndarray:
    return np.einsum("nd,nd->n", v, v)


def _scores(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Inner products line by line, added up from the first component on: the same whatever else is in the task."""
    out = np.zeros(len(q))
    for k in range(q.shape[1]):
        out += q[:, k] * c[:, k]
    return out


def _best(heaps: Heaps, lines: np.ndarray, q: np.ndarray, q_id: np.ndarray, c: np.ndarray, c_id: np.ndarray) -> None:
    """Merge the best rows of a tile into the heaps of these lines.

    A matrix product finds which rows may be among the best, with room for its
    rounding; these are then scored in the order of components.
    """
    rough = q @ c.T
    room = 1e-12 * np.sqrt(_squares(q))[:, None] * np.sqrt(_squares(c).max())
    rough[q_id[:, None] == c_id[None, :]] = -np.inf
    floor = heaps.floors(lines)[:, None]
    if len(c) > heaps.most:
        floor = np.maximum(floor, np.partition(rough, -heaps.most, axis=1)[:, -heaps.most, None])
    x, y = np.nonzero((rough > -np.inf) & (rough >= floor - room))
    heaps.merge(lines[x], _scores(q[x], c[y]), c_id[y])


class _Search:
    """The best rows of the buckets that each query of a block visits, over the tiles met so far."""

    def __init__(self, queries: pa.StructArray, dim: int, most: int) -> None:
        self.dim, self.heaps = dim, Heaps(most, "float64")
        self.id, self.v = queries.field("id").to_numpy(), matrix(queries.field("v"), dim, "float64")
        codes = queries.field("codes")
        line = np.repeat(np.arange(len(self.id)), np.diff(codes.offsets.to_numpy()))
        at = codes.offsets.to_numpy()
        flat = codes.values.to_numpy()[at[0] : at[-1]]
        order = np.argsort(flat, kind="stable")
        self.code, self.line = flat[order], line[order]

    def add(self, tile: dict, rows: pa.StructArray) -> None:
        start, end = np.searchsorted(self.code, [tile["code"], tile["code"] + 1])
        if start < end:
            lines = self.line[start:end]
            _best(self.heaps, lines, self.v[lines], self.id[lines], matrix(rows.field("v"), self.dim, "float64"), rows.field("id").to_numpy())

    def result(self) -> pa.RecordBatch:
        h = self.heaps
        return pa.RecordBatch.from_arrays(
            [pa.array(self.id[h.key], pa.int64()), pa.array(h.id, pa.int64()), pa.array(h.score, pa.float64())], ["query_id", "vec_id", "score"]
        )


def _calibrated(index: Index, rows: DataFrame, dim: int, most: int) -> Index:
    """The index with the nearness and share at which RECALL of the sample's exact neighbours is found.

    The sample is ``SAMPLE`` queries by hash of their ids; they are compared with
    all rows, and of their neighbours only the buckets come to the driver.
    """
    sample = rows.where("query").orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("id", "v").collect()
    if not sample:
        return index
    ids, v = np.array([r.id for r in sample]), np.array([list(r.v) + [0.0] * (dim - len(r.v)) for r in sample], float)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps, codes = Heaps(most, "float64"), {}
        for batch in batches:
            c, c_id = matrix(batch.column("v"), dim, "float64"), batch.column("id").to_numpy()
            if len(c):
                _best(heaps, np.arange(len(ids)), v, ids, c, c_id)
                held = set(heaps.id.tolist())
                found = index.buckets(index.projections(c, False))
                codes = {k: x for k, x in codes.items() if k in held} | {int(k): found[:, i].tolist() for i, k in enumerate(c_id) if int(k) in held}
        h = heaps
        yield pa.RecordBatch.from_arrays(
            [pa.array(h.key, pa.int64()), pa.array(h.id, pa.int64()), pa.array(h.score, pa.float64()), pa.array([codes[int(k)] for k in h.id], pa.list_(pa.int64()))],
            ["line", "id", "score", "codes"],
        )

    first = Window.partitionBy("line").orderBy(F.desc("score"), "id")
    near = rows.select("id", "v").mapInArrow(compare, "line long, id long, score double, codes array<bigint>")
    near = near.withColumn("place", F.row_number().over(first)).where(F.col("place") <= most).collect()
    if not near:
        return index
    last = {r.line: r.score for r in sorted(near, key=lambda r: r.place)}
    length = np.sqrt(_squares(v))
    cosines = [s / (length[line] * index.longest) for line, s in last.items()]
    index = Index(index.directions, index.offsets, index.width, index.longest, float(np.clip(np.median(cosines), 0.0, 0.999)))
    projections = index.projections(v, True)
    shares: dict[tuple[int, int], dict[int, float]] = {}
    needed = []
    for r in near:
        best = 1.0
        for t in range(len(projections)):
            if (r.line, t) not in shares:
                codes, share = index.probes(projections[t, r.line], t)
                shares[r.line, t] = dict(zip(codes.tolist(), share.tolist(), strict=True))
            best = min(best, shares[r.line, t].get(r.codes[t], 1.0))
        needed.append(best)
    share = float(np.quantile(needed, RECALL, method="higher"))
    return Index(index.directions, index.offsets, index.width, index.longest, index.nearness, share)


def search(
    rows: DataFrame,
    query: Column,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    most: int = 20,
    tables: int = TABLES,
    width: float = WIDTH,
    seed: int = 7,
) -> DataFrame:
    """For each row that is a ``query`` its ``most`` nearest other rows found: query_id, rank, vec_id, score.

    Nearness is the inner product of the vectors as they are, as a double added up
    from the first component on; higher comes first, ties by smaller id. Every
    row is indexed. Buckets are visited by falling estimated success until the
    calibrated share of it is reached; no bucket or candidate is left out for its
    size, as large buckets are cut into tiles dealt to all groups.

    Vectors that are null, zero, hold null or non-finite components, or whose
    squared length isn't finite, take no part, nor do null ids. Vectors of unequal
    lengths are filled up with zeros. Rows that repeat an id count once, as the
    one with the smallest vector. Without rows or queries the result is empty.
    """
    length = F.aggregate(col(embedding), F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    kept = rows.where(col(vec_id).isNotNull() & finite(col(embedding)) & (length > 0) & (length < float("inf")))
    one = kept.groupBy(col(vec_id).cast("long").alias("id")).agg(
        F.min(F.struct(col(embedding).alias("v"), F.coalesce(query, F.lit(False)).alias("query"))).alias("r")
    )
    one = written(one.select("id", "r.*"), "neighbour-rows")
    size = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    count, asked, dim, longest = one.agg(F.count("*"), F.count_if("query"), F.coalesce(F.max(F.size("v")), F.lit(0)), F.max(size)).first()
    projections = min(MOST_PROJECTIONS, max(1, round(math.log(max(1, count) / BUCKET, 3)))) if count > BUCKET else 1
    random = np.random.default_rng(seed)
    index = Index(
        random.standard_normal((tables, dim + 1, projections)), random.random((tables, projections)) * width, width, math.sqrt(longest or 1.0)
    )
    index = _calibrated(index, one, dim, most)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = index.buckets(index.projections(matrix(batch.column("v"), dim, "float64"), False)).ravel()
            code, n = np.unique(codes, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(code, pa.int64()), pa.array(n, pa.int64())], ["code", "n"])

    directory = one.select("v").mapInArrow(counted, "code long, n long").groupBy("code").agg(F.sum("n").alias("n")).orderBy("code").toPandas()
    parts = groups(one, tables * count)
    codes, n = directory["code"].to_numpy(np.int64), directory["n"].to_numpy(np.int64)
    spread = np.minimum(parts, -(-n // TILE))
    depth = -(-n // (TILE * np.maximum(spread, 1)))
    home = (codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64) % parts

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v, id = batch.column("v"), batch.column("id").to_numpy()
            dealt = (id.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(20)).astype(np.int64)
            for code in index.buckets(index.projections(matrix(v, dim, "float64"), False)):
                at = np.searchsorted(codes, code)
                group, sub = (home[at] + dealt % spread[at]) % parts, dealt // spread[at] % depth[at]
                yield pa.RecordBatch.from_arrays([*(pa.array(x, pa.int64()) for x in (group, code, sub, id)), v], ["group", "code", "sub", "id", "v"])

    def asking(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v, id = batch.column("v"), batch.column("id").to_numpy()
            projected = index.projections(matrix(v, dim, "float64"), True)
            out = [[], [], []]
            for i in range(len(id)):
                visited = index.visits(projected[:, i])
                at = np.searchsorted(codes, visited)
                there = at < len(codes)
                at = at[there][codes[at[there]] == visited[there]]
                each = np.repeat(at, spread[at])
                nth = np.arange(len(each)) - np.repeat(np.cumsum(spread[at]) - spread[at], spread[at])
                group = (home[each] + nth) % parts
                order = np.argsort(group, kind="stable")
                group, code = group[order], codes[each][order]
                new = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if len(group) else np.empty(0, int)
                out[0] += [i] * len(new)
                out[1] += group[new].tolist()
                out[2] += np.split(code, new[1:]) if len(new) else []
            line = pa.array(out[0], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[1], pa.int64()), pa.array(id, pa.int64()).take(line), v.take(line), pa.array(out[2], pa.list_(pa.int64()))], ["group", "id", "v", "codes"]
            )

    kind = one.schema["v"].dataType.simpleString()
    tiles = one.select("id", "v").mapInArrow(hashed, f"group long, code long, sub long, id long, v {kind}")
    tiles = tiles.groupBy("group", "code", "sub").agg(F.collect_list(F.struct("id", "v")).alias("rows")).drop("sub")
    block = F.pmod(F.xxhash64("id"), F.lit(max(1, -(-asked // BLOCK))))
    blocks = one.where("query").select("id", "v").mapInArrow(asking, f"group long, id long, v {kind}, codes array<bigint>")
    blocks = blocks.groupBy("group", block.alias("block")).agg(F.collect_list(F.struct("id", "v", "codes")).alias("queries"))
    found = meet(blocks, tiles, lambda q: _Search(q, dim, most), "query_id long, vec_id long, score double")
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    first = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= most).select("query_id", "rank", "vec_id", "score")
