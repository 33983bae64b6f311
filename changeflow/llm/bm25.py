"""Exact top-k search: BM25 over an inverted index with block-max pruning, by shard.

A shard is an inverted index of some thousand documents, built where they are
read. In it documents with the same common words lie side by side, long ones
first, and are cut into blocks. As in block-max WAND a floor, the k-th best score
known so far, decides what is passed over. Queries are held against a shard many
at a time. Terms that many of its documents have lie in a dense matrix for each
block, in single precision, so their part of the scores is a matrix product; their
largest impacts in each block bound it. The other terms' postings are walked. A
block is multiplied only for the queries whose bound there reaches their floor,
and in steps, the commonest terms first: after each step fewer queries go on.
Documents whose score, with the product's largest possible error, reaches the
floor get their score in double precision. A document is left out only if it can't
be among the best, so the result is that of scoring everything. The floor starts
from one shard that every query is held against, and rises with each shard a task
reads. Tasks are as many as there are cores, so what they send to be merged grows
with the queries only.

Document frequencies, the number of documents and their mean length are taken
over all shards before any is searched, so the scores of all shards are on one
scale and merging their best is exact. Queries go out in blocks of bounded size.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from changeflow.llm.common import col, worker_cache, written

K1, B = 1.2, 0.75
SHARD_DOCS = 8192
SHARD_POSTINGS = 4_000_000
BLOCK_DOCS = 64
QUERY_BLOCK = 8192
QUERY_TASKS = 48
#: Queries that are held against a shard together, and when all their scores are looked at.
QUERY_BATCH, FLOOR_BATCH = 512, 128
#: Terms that this share of a shard's documents has are kept as a dense matrix, in so many cells at most, commonest first.
COMMON_SHARE, COMMON_CELLS = 1 / 64, 8 << 20
#: Within a shard documents are arranged in so many groups, told apart by so many of the commonest terms.
GROUPS, GROUP_TERMS = 8, 256
#: After so many common terms each, queries that can't reach their floor leave a block.
STEPS = (128, 512)
#: Postings of other terms lie in lines of so many; so many lines at a time.
LINE, LINES = 8, 1 << 16
NO_ID = -(1 << 63)
MARKS = ".,;:!?\"'()[]|*#&%$"
#: What a word of marks alone comes to.
NO_TERM = xxhash.xxh64_intdigest(b"") - (1 << 63)
#: Some 200 bytes each.
CACHED_WORDS = 1 << 17
#: Of documents whose scores are taken in double precision, so many common terms at a time.
SCORED_TERMS = 1 << 20

_SHARD = "doc_ids array<bigint>, lengths array<int>, terms array<bigint>, counts array<int>, docs binary, tf binary"


class _Hashes(dict):
    """64-bit hashes of words without marks at either end; the first CACHED_WORDS different ones are kept."""

    def __missing__(self, word: str) -> int:
        bare = word.strip(MARKS)
        out = xxhash.xxh64_intdigest(bare.encode("utf-8", "surrogatepass")) - (1 << 63) if bare else None
        if len(self) < CACHED_WORDS:
            self[word] = out
        return out


def terms_of(text: str | None) -> Counter:
    """Words between white space, lower-cased and without marks at either end, as 64-bit hashes."""
    hashes = worker_cache("bm25").setdefault("hashes", _Hashes())
    out = Counter(map(hashes.__getitem__, (text or "").lower().split()))
    out.pop(None, None)
    return out


def _counted(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """The same of a text that is read once, as two arrays: words are counted before their marks go, so a term may come again.

    A dictionary of all words is too large for the processor's caches; hashing a word anew is quicker.
    """
    words = Counter((text or "").lower().split())
    try:
        found = [xxhash.xxh64_intdigest(w.strip(MARKS)) for w in words]
    except UnicodeEncodeError:
        found = [xxhash.xxh64_intdigest(w.strip(MARKS).encode("utf-8", "surrogatepass")) for w in words]
    terms = (np.fromiter(found, np.uint64, len(found)) ^ np.uint64(1 << 63)).view(np.int64)
    n = np.fromiter(words.values(), np.int32, len(words))
    kept = terms != NO_TERM
    return (terms, n) if kept.all() else (terms[kept], n[kept])


def _arranged(term: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The order in which documents with the same common words lie side by side, those of many words first.

    The blocks of a shard then have low maxima where a query has little to find.
    ``term`` are the terms of one document after another, ``sizes`` how many each has.
    """
    seen, n = np.unique(term[::8], return_counts=True)  # which terms are common need not be known exactly
    common = np.sort(seen[np.argsort(-n, kind="stable")[:GROUP_TERMS]])
    place = np.searchsorted(common, term)
    found = np.flatnonzero(place < len(common))
    found = found[common[place[found]] == term[found]]
    has = np.zeros((len(sizes), len(common)), np.float32)
    has[np.repeat(np.arange(len(sizes)), sizes)[found], place[found]] = 1
    size = has.sum(axis=1)
    has /= np.sqrt(np.maximum(size, 1))[:, None]
    large = np.flatnonzero(size >= np.median(size))
    centres = has[large[[size[large].argmax()]]]
    for _ in range(min(GROUPS, len(large)) - 1):  # the next is least like those before
        centres = np.vstack([centres, has[large[(has[large] @ centres.T).max(axis=1).argmin()]]])
    for _ in range(4):
        group = (has @ centres.T).argmax(axis=1)
        sums = np.array([has[group == g].sum(axis=0) for g in range(len(centres))])
        centres = sums / np.maximum(np.linalg.norm(sums, axis=1), 1e-9)[:, None]
    return np.lexsort((-sizes, (has @ centres.T).argmax(axis=1)))


def _shard(ids: list, docs: list, arranged: bool = False) -> pa.RecordBatch:
    """``docs``: of each document its terms and how often it has them, counted or as two arrays in which terms may come again."""
    docs = [(np.fromiter(d, np.int64, len(d)), np.fromiter(d.values(), np.int32, len(d))) if isinstance(d, Counter) else d for d in docs]
    sizes = np.fromiter((len(t) for t, _ in docs), np.int64, len(docs))
    if arranged and docs:
        order = _arranged(np.concatenate([t for t, _ in docs]), sizes)
        ids, docs, sizes = [ids[i] for i in order], [docs[i] for i in order], sizes[order]
    term = np.concatenate([np.zeros(0, np.int64), *(t for t, _ in docs)])
    tf = np.concatenate([np.zeros(0, np.int32), *(n for _, n in docs)])
    doc = np.repeat(np.arange(len(docs), dtype=np.int32), sizes)
    order = np.argsort(term, kind="stable")
    term, doc, tf = term[order], doc[order], tf[order]
    new = np.flatnonzero(np.r_[True, (term[1:] != term[:-1]) | (doc[1:] != doc[:-1])][: len(term)])
    if len(new) < len(term):
        term, doc, tf = term[new], doc[new], np.add.reduceat(tf, new, dtype=np.int32)
    begin = np.flatnonzero(np.r_[True, term[1:] != term[:-1]][: len(term)])
    terms, counts = term[begin], np.diff(np.r_[begin, len(term)])
    one = lambda values, kind: pa.array([values], pa.list_(kind))
    return pa.RecordBatch.from_arrays(
        [
            one(ids, pa.int64()), one([int(n.sum()) for _, n in docs], pa.int32()), one(terms, pa.int64()), one(counts.astype(np.int32), pa.int32()),
            pa.array([doc.tobytes()], pa.binary()), pa.array([tf.tobytes()], pa.binary()),
        ],
        names=["doc_ids", "lengths", "terms", "counts", "docs", "tf"],
    )


def build_index(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per shard; write it. Every row of ``docs`` is indexed, empty and null texts with length 0."""

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, held, size = [], [], 0
        for batch in batches:
            for i, t in zip(*batch.columns):
                ids.append(i.as_py())
                held.append(_counted(t.as_py()))
                size += len(held[-1][0])
                if len(ids) >= SHARD_DOCS or size >= SHARD_POSTINGS:
                    yield _shard(ids, held, True)
                    ids, held, size = [], [], 0
        if ids:
            yield _shard(ids, held, True)

    return docs.select(col(key).cast("long"), col(text)).mapInArrow(shards, _SHARD)


def query_terms(queries: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(query_id, term, n) of the whole text of each query."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, t in zip(*batch.columns):
                c = terms_of(t.as_py())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([i.as_py()] * len(c), pa.int64()), pa.array(list(c), pa.int64()), pa.array(list(c.values()), pa.int32())],
                    names=["query_id", "term", "n"],
                )

    return queries.select(col(key).cast("long"), col(text)).mapInArrow(made, "query_id long, term long, n int")


class Shard:
    """A shard in memory, with impacts, and the largest of each common term in each block."""

    def __init__(self, row: dict, mean: float, block: int = BLOCK_DOCS):
        self.ids, self.block, self.terms = row["doc_ids"], block, row["terms"]
        counts, n = row["counts"].astype(np.int64), max(1, len(self.ids))
        doc, impact = np.frombuffer(row["docs"], np.int32), np.frombuffer(row["tf"], np.int32).astype(np.float64)
        below = (K1 * (1 - B + B * row["lengths"].astype(np.float64) / max(mean, 1e-9)))[doc]
        below += impact
        impact *= K1 + 1
        impact /= below
        del below
        self.blocks = -(-len(self.ids) // block)
        common = np.argsort(-counts, kind="stable")[: COMMON_CELLS // n]
        common = common[counts[common] >= max(1, COMMON_SHARE * n)]
        self.column = np.full(len(self.terms), -1, np.int32)
        self.column[common] = np.arange(len(common))
        column = np.repeat(self.column, counts)
        inside, outside = np.flatnonzero(column >= 0), np.flatnonzero(column < 0)
        # Postings of the other terms lie in lines of LINE of a term; in its last line some may be of no impact.
        seldom = np.where(self.column < 0, counts, 0)
        lines = -(-seldom // LINE)
        self.start = np.concatenate([[0], np.cumsum(lines)])
        self.docs, self.impacts = np.zeros((self.start[-1], LINE), np.int32), np.zeros((self.start[-1], LINE))
        at = np.arange(len(outside)) + np.repeat(self.start[:-1] * LINE - np.cumsum(seldom) + seldom, seldom)
        self.docs.reshape(-1)[at], self.impacts.reshape(-1)[at] = doc[outside], impact[outside]
        del outside, at
        column, doc, impact = column[inside], doc[inside], impact[inside]
        self.tiles = np.zeros((self.blocks, len(common), block), np.float32)
        self.tiles[doc // block, column, doc % block] = impact
        self.dense = self.tiles.transpose(1, 0, 2)
        self.dense_max = np.ascontiguousarray(self.tiles.max(axis=2).T) if self.blocks else np.zeros((len(common), 0), np.float32)
        by_doc = np.argsort(doc.astype(np.uint16) if n <= 1 << 16 else doc, kind="stable")  # postings of common terms by document
        self.doc_column, self.doc_impact = column[by_doc], impact[by_doc]
        self.doc_start = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=len(self.ids)))])
        ends = [0, *(c for c in STEPS if c < len(common)), len(common)]
        self.steps = [slice(i, j) for i, j in zip(ends, ends[1:])]

    @staticmethod
    def _expand(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All numbers of the ranges, and how many each range has."""
        n = ends - starts
        numbers = np.repeat(starts - np.cumsum(n) + n, n)
        numbers += np.arange(len(numbers))
        return numbers, n

    def seldom(self, query: np.ndarray, at: np.ndarray, weights: np.ndarray, m: int) -> np.ndarray:
        """The part of other than common terms in the scores of all documents, a row for each query."""
        width = self.blocks * self.block
        out = np.zeros((m, width))
        cells = out.reshape(-1)
        seldom = np.flatnonzero(self.column[at] < 0)
        query, at, weights = query[seldom] * width, at[seldom], weights[seldom]
        sums = np.cumsum(self.start[at + 1] - self.start[at])
        cuts = np.flatnonzero(np.diff(sums // LINES, prepend=0)) if len(sums) else np.zeros(0, np.int64)
        for i, j in zip([0, *cuts], [*cuts, len(at)]):
            if i < j:
                lines, n = self._expand(self.start[at[i:j]], self.start[at[i:j] + 1])
                where, parts = self.docs.take(lines, axis=0) + np.repeat(query[i:j], n)[:, None], self.impacts.take(lines, axis=0)
                parts *= np.repeat(weights[i:j], n)[:, None]
                np.add.at(cells, where.reshape(-1), parts.reshape(-1))
        return out

    def common(self, query: np.ndarray, at: np.ndarray, weights: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray]:
        """The weights of common terms, a row for each query, and by how much of itself a score in single precision may be wrong."""
        column = self.column[at]
        often = np.flatnonzero(column >= 0)
        out = np.zeros((m, len(self.dense)))
        out[query[often], column[often]] = weights[often]
        return out, 1e-6 + 2.4e-7 * np.bincount(query[often], minlength=m)  # a single rounds by 6e-8 of itself

    def nearly(self, query: np.ndarray, at: np.ndarray, weights: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray]:
        """Scores of all documents, a row for each of ``m`` queries, and by how much of itself a score may be wrong.

        ``query``, ``at`` and ``weights`` are the queries' terms that the shard has: whose, which, how much.
        """
        scores = self.seldom(query, at, weights, m)
        common, error = self.common(query, at, weights, m)
        common = common.astype(np.float32)
        for b, tile in enumerate(self.tiles):
            scores[:, b * self.block : (b + 1) * self.block] += common @ tile
        return scores, error

    def reaching(self, query: np.ndarray, at: np.ndarray, weights: np.ndarray, floors: np.ndarray, k: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Queries, document numbers and scores, by query: all documents that share a term with a query and reach its floor.

        With ``k`` some that can't be among the query's ``k`` best of the shard are left out.

        The common terms are multiplied out in steps, the commonest first; after each only
        those queries go on in a block that can still reach their floor there, if the other
        common terms have their largest impact.
        """
        m = len(floors)
        rare = self.seldom(query, at, weights, m)
        common, error = self.common(query, at, weights, m)
        low = floors * (1 - error)
        steps = [common[:, s].astype(np.float32) for s in self.steps]
        rest = [np.zeros((m, self.blocks))]  # what the steps from each on can add in a block at most
        for s, part in zip(self.steps[::-1], steps[::-1]):
            rest.insert(0, rest[0] + part @ self.dense_max[s])
        open_ = rare.reshape(m, self.blocks, self.block).max(axis=2) + rest[0] >= low[:, None]
        lacking = [np.ascontiguousarray((low[:, None] - r).T) for r in rest[1:]]
        open_, found = np.ascontiguousarray(open_.T), []
        for b in np.flatnonzero(open_.any(axis=1)).tolist():
            rows, here, tile = np.flatnonzero(open_[b]), slice(b * self.block, (b + 1) * self.block), self.tiles[b]
            scores = rare[rows, here].astype(np.float32)
            for s, part, need in zip(self.steps, steps, lacking):
                scores += part[rows] @ tile[s]
                on = np.flatnonzero(scores.max(axis=1) >= need[b, rows])
                if len(on) < len(rows):
                    rows, scores = rows[on], scores[on]
            i, j = np.nonzero((scores > 0) & (scores >= low[rows, None]))
            if len(i):
                found.append((rows[i], j + here.start, scores[i, j].astype(np.float64)))
        queries, docs, near = (np.concatenate([f[i] for f in found]) if found else np.zeros(0, np.int64) for i in (0, 1, 2))
        if k is not None:
            order = np.lexsort((-near, queries))
            queries, docs, near = queries[order], docs[order], near[order]
            first = np.searchsorted(queries, np.arange(m + 1))
            full = np.flatnonzero(np.diff(first) >= k)
            least = np.full(m, -np.inf)
            least[full] = near[first[full] + k - 1] * (1 - 3 * error[full]) - 4e-6  # rounding included
            kept = near >= least[queries]
            queries, docs = queries[kept], docs[kept]
        order = np.lexsort((docs, queries))
        queries, docs = queries[order], docs[order]
        whole = rare[queries, docs]
        sizes = np.cumsum(self.doc_start[docs + 1] - self.doc_start[docs])
        cuts = np.flatnonzero(np.diff(sizes // SCORED_TERMS, prepend=0)) if len(docs) else np.zeros(0, np.int64)
        for i, j in zip([0, *cuts], [*cuts, len(docs)]):
            if i < j:
                own, n = self._expand(self.doc_start[docs[i:j]], self.doc_start[docs[i:j] + 1])
                parts = common[np.repeat(queries[i:j], n), self.doc_column[own]] * self.doc_impact[own]
                whole[i:j] += np.bincount(np.repeat(np.arange(j - i), n), parts, j - i)
        kept = whole >= floors[queries]
        return queries[kept], docs[kept], whole[kept]

    def search(self, query: np.ndarray, at: np.ndarray, weights: np.ndarray, floors: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """The same, one query after another."""
        queries, docs, scores = self.reaching(query, at, weights, floors)
        bounds = np.searchsorted(queries, np.arange(len(floors) + 1))
        for q in np.flatnonzero(np.diff(bounds)).tolist():
            mine = slice(bounds[q], bounds[q + 1])
            yield q, docs[mine], scores[mine]


class _Best:
    """The k best documents of each query so far, and from them its floor."""

    def __init__(self, floors: np.ndarray, k: int):
        self.k, self.floors = k, floors.copy()
        self.ids, self.scores = np.zeros((len(floors), k), np.int64), np.full((len(floors), k), -np.inf)

    def add(self, first: int, end: int, queries: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        """Documents of the queries from ``first`` to ``end``, which ``queries`` counts from 0."""
        if not len(queries):
            return
        new = np.zeros(end - first, bool)
        new[queries] = True
        old, place = np.nonzero((self.scores[first:end] > -np.inf) & new[:, None])
        queries = np.r_[old, queries]
        ids, scores = np.r_[self.ids[first:end][old, place], ids], np.r_[self.scores[first:end][old, place], scores]
        order = np.lexsort((ids, -scores, queries))
        queries, ids, scores = queries[order], ids[order], scores[order]
        place = np.arange(len(queries)) - np.searchsorted(queries, queries)
        kept = place < self.k
        at = (queries[kept] + first, place[kept])
        self.ids[at], self.scores[at] = ids[kept], scores[kept]
        # Nothing below can be among the best, rounding included.
        self.floors[first:end] = np.maximum(self.floors[first:end], self.scores[first:end, -1] - 2e-6)

    def of(self, q: int) -> tuple[np.ndarray, np.ndarray]:
        n = int((self.scores[q] > -np.inf).sum())
        return self.ids[q, :n], self.scores[q, :n]

    def all(self, first: int, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of the queries from ``first`` to ``end`` the number, the ids and the scores."""
        queries, place = np.nonzero(self.scores[first:end] > -np.inf)
        queries += first
        return queries, self.ids[queries, place], self.scores[queries, place]


class _Queries:
    """Terms and weights of queries, one query after another."""

    def __init__(self, terms: list[np.ndarray], weights: list[np.ndarray]):
        self.count = len(terms)
        #: Each term once, in order, and the place there of each query's terms.
        self.terms, places = np.unique(np.concatenate([np.zeros(0, np.int64), *terms]), return_inverse=True)
        self.places, self.weights = places.astype(np.int32), np.concatenate([np.zeros(0), *weights])
        self.ends = np.cumsum([0, *map(len, terms)])

    def batches(self, shard: Shard, many: int = QUERY_BATCH) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
        """The first and the end of so many queries, and whose, which and how much their terms are that the shard has."""
        place = np.searchsorted(self.terms, shard.terms)
        known = np.flatnonzero(place < len(self.terms))
        known = known[self.terms[place[known]] == shard.terms[known]]
        number = np.full(len(self.terms), -1)
        number[place[known]] = known
        for first in range(0, self.count, many):
            end = min(self.count, first + many)
            i, j = self.ends[first], self.ends[end]
            at = number[self.places[i:j]]
            known = np.flatnonzero(at >= 0)
            query = np.repeat(np.arange(end - first), np.diff(self.ends[first : end + 1]))
            yield first, end, query[known], at[known], self.weights[i:j][known]


def _floor(scores: np.ndarray, k: int) -> float:
    """Nothing below can be among the k best, rounding included."""
    return max(0.0, float(np.partition(scores, len(scores) - k)[len(scores) - k]) - 2e-6) if len(scores) >= k else 0.0


def _read_shard(batch: pa.RecordBatch, i: int, mean: float) -> Shard:
    row = {n: batch.column(n)[i] for n in batch.schema.names}
    ids = row["doc_ids"].values.fill_null(NO_ID)
    arrays = {n: np.array(ids if n == "doc_ids" else v.values) for n, v in row.items() if n not in ("docs", "tf")}
    return Shard(arrays | {n: row[n].as_buffer() for n in ("docs", "tf")}, mean)


def _with_floors(queries: DataFrame, index: DataFrame, mean: float, k: int) -> tuple[np.ndarray, _Queries, np.ndarray]:
    """The ids and the queries of a block, those alike side by side, with a floor each: their k-th best score in one shard, which is sent to all tasks."""
    most = index.agg(F.max(F.size("doc_ids"))).first()[0]
    first = index.where(F.size("doc_ids") == F.lit(most)).limit(1).toArrow()  # SHARD_DOCS documents; the last shard of a task may have a few only
    shared = index.sparkSession.sparkContext.broadcast(first.to_batches())

    def floors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_cache("bm25-search")
        shard = next((_read_shard(b, 0, mean) for b in shared.value if b.num_rows), None)
        for batch in batches:
            queries = _Queries(*([np.array(v.values) for v in batch.column(c)] for c in (1, 2)))
            found = np.zeros(queries.count)
            for first, end, *terms in queries.batches(shard, FLOOR_BATCH) if shard else ():
                scores, error = shard.nearly(*terms, end - first)
                found[first:end] = [_floor(row[row > 0], k) * (1 - e) for row, e in zip(scores, error)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.float64())], names=["query_id", "terms", "weights", "floor"])

    spread = queries.select("query_id", "terms", "weights").repartition(QUERY_TASKS)
    rows = spread.mapInArrow(floors, "query_id long, terms array<bigint>, weights array<double>, floor double").toArrow()
    terms, weights = ([np.array(v.values) for v in rows.column(c)] for c in ("terms", "weights"))
    order = _arranged(np.concatenate(terms), np.fromiter(map(len, terms), np.int64, len(terms))) if terms else np.zeros(0, np.int64)
    ids, lows = (np.array(rows.column(c), kind)[order] for c, kind in (("query_id", np.int64), ("floor", np.float64)))
    return ids, _Queries([terms[i] for i in order], [weights[i] for i in order]), lows


def _search_block(index: DataFrame, queries: tuple[np.ndarray, _Queries, np.ndarray], mean: float, k: int) -> DataFrame:
    shared = index.sparkSession.sparkContext.broadcast(queries)  # QUERY_BLOCK queries

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_cache("bm25-search")  # what building the index took goes back to the system first
        names, queries, floors = shared.value
        best, shard = _Best(floors, k), None
        for batch in batches:
            for i in range(batch.num_rows):
                del shard  # two have no room beside each other
                shard = _read_shard(batch, i, mean)
                for first, end, *terms in queries.batches(shard):
                    whose, docs, scores = shard.reaching(*terms, best.floors[first:end], k)
                    best.add(first, end, whose, shard.ids[docs], np.round(scores, 6))  # one value, however the sum was ordered
        for first in range(0, len(names), QUERY_BATCH):
            found, ids, scores = best.all(first, first + QUERY_BATCH)
            yield pa.RecordBatch.from_arrays([pa.array(names[found]), pa.array(ids), pa.array(scores)], names=["query_id", "doc_id", "score"])

    few = index.coalesce(2 * index.sparkSession.sparkContext.defaultParallelism)
    found = few.mapInArrow(search, "query_id long, doc_id long, score double")
    place = Window.partitionBy("query_id").orderBy(F.desc("score"), "doc_id")
    return found.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k)


def search(docs: DataFrame, queries: DataFrame, k: int = 10, key: str = "doc_id", text: str = "text", query_block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, rank, doc_id and score: the ``k`` best documents of each query by BM25.

    Scores are rounded to six digits; ties go to the smaller id. A query that
    has no word, or a null id, has no rows, nor does a document that shares no
    word with it. Repeated documents are ranked each; queries that repeat an id
    are one query of all their words. Null document ids come first among ties.
    """
    index = written(build_index(docs, key, text), "bm25-index")
    size = index.agg(F.sum(F.size("doc_ids")).alias("n"), F.sum(F.expr("aggregate(lengths, 0L, (a, x) -> a + x)")).alias("words")).first()
    n, mean = size.n or 0, (size.words or 0) / max(1, size.n or 0)
    wanted = written(
        query_terms(queries.where(col(key).isNotNull()), key, text).groupBy("query_id", "term").agg(F.sum("n").alias("n")), "bm25-queries"
    )
    frequency = index.select(F.explode(F.arrays_zip("terms", "counts")).alias("t")).groupBy(F.col("t.terms").alias("term")).agg(F.sum("t.counts").alias("df"))
    weight = F.col("n") * F.log(1 + (F.lit(n) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    ready = wanted.join(frequency, "term").withColumn("weight", weight).groupBy("query_id").agg(F.collect_list(F.struct("term", "weight")).alias("t"))
    ready = ready.select("query_id", F.col("t.term").alias("terms"), F.col("t.weight").alias("weights"))
    blocks = max(1, math.ceil(wanted.select("query_id").distinct().count() / query_block))
    # By hash, so a block holds query_block queries, give or take its square root.
    ready = written(ready.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks))), "bm25-weights")
    found = None
    for b in range(blocks):
        some = _with_floors(ready.where(F.col("block") == b), index, mean, k)
        part = written(_search_block(index, some, mean, k), "bm25-found")
        found = part if found is None else found.union(part)
    null_id = F.when(F.col("doc_id") != NO_ID, F.col("doc_id"))
    return found.select("query_id", "rank", null_id.alias("doc_id"), "score")
