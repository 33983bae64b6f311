"""N-gram Jaccard join by universe partition and the pigeonhole principle.

A document is the set of its distinct word shingles, held as 64-bit hashes. Two
documents link when their sets' Jaccard similarity reaches the threshold.

Candidates. With I shared and D unshared shingles, I / (I + D) >= p / q means
D <= I (q - p) / p. Sizes are cut into bands. For pairs whose smaller set lies in a
band with largest size h, D is at most H = h (q - p) / p, so when the universe is
hashed into H + 1 segments, two linked sets agree in one segment at least. Every
set is indexed by its subset in each segment, in the scheme of its band and of
lower bands that its partners may lie in.

Allocation. A segment where a set has no shingle says nothing, and its list would
grow with the corpus. It gets weight -1 and isn't indexed. Instead as many other
segments get weight 1: they are indexed by their subset and by each subset with
one shingle deleted, which costs a list entry for each of a few shingles. A set
with e empty segments has weight 1 in the first e of its segments, in its band's
order, that hold two shingles or more. That is enough: if two linked sets agree in
empty segments only, t of them, then each other segment differs in one shingle at
least, and D <= H leaves t - 1 more, so among any t segments one that isn't empty in
both differs in exactly one. Take the set whose weights of 1 end first in the order.
Among its e >= t segments is such a one; the larger subset there has two shingles or
more, in either set it is among those with weight 1, and less one shingle it is the
other set's subset, which isn't empty. Sets with fewer than e such segments, of a
few shingles mostly, have a list of their own in the band. Any order will do that all
sets share: it goes by cost, the number of shared shingles that a bounded sample of
documents has in each segment, cheapest first, because a shared shingle is what
makes a list of one-deletion keys long.

Lists. Nearly all keys occur once in a corpus and lead to nothing. Tasks pack
theirs as sorted 40-bit numbers, about three bytes each, and a pass over each
range of keys, which holds them as packed, lets only those through that occur again.

Verification. Copies (equal sets) are one class. A list of similar but different
sets may be long, so lists aren't expanded into pairs. First each member is
compared to leaders of its lists; what links becomes components. Then only
members outside a list's main component are compared to members of other
components. Pairs pass a bound inside the comparison (a parity sketch never shows
more differences than there are) and then meet in an exact count of shared
shingles. Pairs inside one component need no link: components are exact. So of a
member's leaders the one that it meets in most lists is compared first.
"""

from __future__ import annotations

import hashlib
import pickle
import tempfile
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow.llm.common import col, folder_of, worker_cache, written
from changeflow.llm.components import roots
from changeflow.session import delete

SHINGLE_WORDS = 3
THRESHOLD = (90, 100)
BAND_GROWTH = 1.25
SKETCH_BITS = 1024
LEADERS = 2

#: Keys are cut to so many bits: a chance agreement costs a comparison, not a link.
KEY_BITS = 40
#: A task packs about so many keys at a time, and so many bytes of text make a range of keys.
CHUNK_KEYS, RANGE_BYTES = 1 << 19, 16 << 20
#: A task holds so many bytes of a range's packed keys in memory, more in a file of its own.
HELD_BYTES = 64 << 20
#: Segments are ordered by their cost in so many documents.
COST_SAMPLE = 1_000
#: Ids that are broadcast, some 50 bytes each.
BROADCAST_IDS = 1_000_000
#: For the exact count a set travels as 48 bits of each hash.
SET_BITS = 48

_U = np.uint64
#: Beside the band's number, what the sets have in common that have too few segments for weight 1.
_FEW = _U(0xF3E5_0000_0000_0000)
_ODD = (_U(0x9E3779B97F4A7C15), _U(0xC2B2AE3D27D4EB4F), _U(0x165667B19E3779F9))


def _mix(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64, a public generator."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def shingles(text: str | None, n: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted distinct hashes of ``n`` consecutive words of the text, A-Z lower-cased; of all words, where there are fewer.

    Words are cut at the space and at U+0009 to U+000D.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, _U)
    n = min(n, len(words))
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), _U, len(words))
    total = np.full(len(words) - n + 1, n, _U)
    with np.errstate(over="ignore"):
        for k in range(n):
            total = total * _ODD[0] + _mix(h[k : len(words) - n + 1 + k] + _ODD[1])
        return np.unique(_mix(total))


def set_class(s: np.ndarray) -> bytes:
    """Sixteen bytes that stand for the set: equal sets are one class."""
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def sketch(s: np.ndarray, bits: int = SKETCH_BITS) -> np.ndarray:
    """Bit b is whether an odd number of shingles falls into b. A shingle that two sets don't share changes one bit at most."""
    odd = np.bincount((_mix(s + _ODD[2]) % _U(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def wide_sketch(s: np.ndarray) -> np.ndarray:
    """A sketch with a bit for each shingle, to a power of two: of unlike sets, however large, half the bits differ.

    That is more than twice the differences that linked sets may have at a threshold of
    0.8. Folded, by exclusive or, it is the sketch with half the bits.
    """
    return sketch(s, max(SKETCH_BITS, 1 << (len(s) - 1).bit_length()))


class Bands:
    """Bands of set sizes; sets below the first only link with equal ones."""

    def __init__(self, p: int, q: int, growth: float = BAND_GROWTH, costs: dict[int, dict[int, int]] | None = None):
        self.p, self.q, self.growth = p, q, growth
        self.tops = [-(-p // (q - p)) - 1]
        self.costs = costs or {}

    def place_in_order(self, band: int, m: int) -> np.ndarray:
        """For each segment its place in the order of cost, cheapest first, ties by number."""
        cost = np.zeros(m, np.int64)
        for segment, n in self.costs.get(band, {}).items():
            cost[segment] = n
        place = np.empty(m, np.int64)
        place[np.argsort(cost, kind="stable")] = np.arange(m)
        return place

    def _reach(self, size: int) -> None:
        while self.tops[-1] < size:
            low = self.tops[-1] + 1
            self.tops.append(max(low, int(low * self.growth)))

    def differences(self, shared: int) -> int:
        return shared * (self.q - self.p) // self.p

    def schemes(self, size: int) -> list[tuple[int, int]]:
        """(band, segments) in which a set of this size is indexed."""
        self._reach(size)
        b, out = bisect_left(self.tops, size), []
        while b > 0 and (size <= self.tops[b] + self.differences(self.tops[b])):
            out.append((b, self.differences(self.tops[b]) + 1))
            b -= 1
        return out


def _segments(place: np.ndarray, m: int) -> np.ndarray:
    return (place % _U(m)).astype(np.int64)


def signatures(s: np.ndarray, bands: Bands) -> np.ndarray:
    """The keys under which a set is indexed."""
    out = []
    with np.errstate(over="ignore"):
        place, value = _mix(s ^ _ODD[1]), _mix(s + _ODD[0])
        for band, m in bands.schemes(len(s)):
            segment = _segments(place, m)
            if band in bands.costs:
                segment = bands.place_in_order(band, m)[segment]
            order = np.argsort(segment, kind="stable")
            segment, v = segment[order], value[order]
            first = np.flatnonzero(np.concatenate([[True], segment[1:] != segment[:-1]]))
            filled = segment[first]
            sums = np.zeros(m, _U)
            sums[filled] = np.add.reduceat(v, first)  # of a subset, in any order
            salt = _mix(np.arange(m, dtype=_U) + _U(band << 40))
            out.append(_mix(sums[filled] ^ salt[filled]))
            empty = m - len(filled)
            if empty:
                sizes = np.diff(np.r_[first, len(s)])
                good = np.flatnonzero(sizes > 1)[:empty]
                near = np.zeros(m, bool)
                near[filled[good]] = True
                inside = near[segment]
                at = segment[inside]
                out.append(_mix((sums[at] - v[inside]) ^ salt[at]))
                if len(good) < empty:
                    out.append(_mix(np.array([band], _U) + _FEW))
    return np.concatenate(out) if out else np.zeros(0, _U)


def _costs(docs: DataFrame, text: str, n: int, threshold: tuple[int, int], sample: int = COST_SAMPLE) -> dict[int, dict[int, int]]:
    """band -> segment -> how often sampled sets of the band share a shingle there.

    The sample is ``sample`` documents by hash of their text; only counts come to
    the driver, at most one for each shingle that two of these documents share.
    """
    rows = docs.select(col(text).alias("t"), F.xxhash64(col(text)).alias("h")).where("t is not null")
    least = [r.h for r in rows.select("h").distinct().orderBy("h").limit(sample).collect()]
    rows = rows.where(F.col("h").isin(least)).select("t")

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands, seen = Bands(*threshold), set()
        for batch in batches:
            out = [np.zeros((0, 3), np.int64)]
            for t in batch.column(0):
                s = shingles(t.as_py(), n)
                if len(s) == 0 or (c := set_class(s)) in seen:  # copies share everything
                    continue
                seen.add(c)
                for band, m in bands.schemes(len(s)):
                    out.append(np.c_[np.full(len(s), band), _segments(_mix(s ^ _ODD[1]), m), s.view(np.int64)])
            found = np.concatenate(out)
            yield pa.RecordBatch.from_arrays([pa.array(found[:, k]) for k in range(3)], ["band", "segment", "shingle"])

    found = rows.mapInArrow(placed, "band long, segment long, shingle long")
    often = found.groupBy("band", "segment", "shingle").count().where("count > 1").groupBy("band", "segment").agg(F.sum("count").alias("n"))
    out: dict[int, dict[int, int]] = {}
    for r in often.collect():
        out.setdefault(r.band, {})[r.segment] = r.n
    return out


def _planes(values: np.ndarray, width: int) -> bytes:
    """The low ``width`` bytes of each number, first bytes first: the zeros of small numbers come together."""
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def _numbers(planes: bytes, width: int) -> np.ndarray:
    out = np.zeros((len(planes) // width, 8), np.uint8)
    out[:, :width] = np.frombuffer(planes, np.uint8).reshape(width, -1).T
    return out.view("<u8").ravel()


def _packed_ascending(values: np.ndarray, width: int) -> bytes:
    return _planes(np.diff(values, prepend=_U(0)), width)


def _ascending(planes: bytes, width: int) -> np.ndarray:
    return np.cumsum(_numbers(planes, width), dtype=_U)


class _Chunk:
    """Keys of documents until there are enough to pack, by ranges of keys."""

    def __init__(self, ranges: int):
        self.ranges, self.keys, self.docs, self.size, self.count = ranges, [], [], 0, 0

    def add(self, keys: np.ndarray) -> int:
        keys = np.unique(keys >> _U(64 - KEY_BITS))
        self.keys.append(keys)
        self.docs.append(np.full(len(keys), self.count, _U))
        self.size += len(keys)
        self.count += 1
        return self.count - 1

    def packed(self) -> Iterator[tuple[int, bytes, bytes]]:
        """(range, keys, the document of each), compressed"""
        press = zstandard.ZstdCompressor(level=1)
        keys, docs = np.concatenate(self.keys), np.concatenate(self.docs)
        order = np.argsort(keys, kind="stable")
        keys, docs = keys[order], docs[order]
        of = (keys * _U(self.ranges)) >> _U(KEY_BITS)
        cuts = np.flatnonzero(np.r_[True, of[1:] != of[:-1], True]) if len(keys) else np.zeros(1, np.int64)
        for i, j in zip(cuts[:-1], cuts[1:]):
            yield int(of[i]), press.compress(_packed_ascending(keys[i:j], 5)), press.compress(_planes(docs[i:j], 4))


_INDEX = {
    "doc_id": pa.int64(), "text_hash": pa.int64(), "n": pa.int64(), "cls": pa.binary(), "lead": pa.int64(), "sketch": pa.list_(pa.int64()),
    "wide": pa.list_(pa.int64()),
    "chunk": pa.int64(), "at": pa.int64(), "range": pa.int64(), "keys": pa.binary(), "docs": pa.binary(),
}


def _index(docs: DataFrame, key: str, text: str, n: int, threshold: tuple[int, int]) -> DataFrame:
    """Rows of documents (doc_id, text_hash, n, cls, lead, sketch, chunk, at) and, with ``range``, of packed keys of a chunk.

    ``lead`` is the first half of cls, as a number, ``at`` the document's number in
    its chunk, if its keys are there: of equal sets one copy a task is enough.
    """
    rows = docs.select(col(key).cast("long"), col(text), F.xxhash64(col(text)), F.spark_partition_id().cast("long"))
    p, q = threshold
    costs = _costs(docs, text, n, threshold)
    size = docs.agg(F.sum(F.octet_length(col(text)))).first()[0] or 0
    ranges = max(docs.sparkSession.sparkContext.defaultParallelism, size // RANGE_BYTES)

    def batch_of(columns: dict) -> pa.RecordBatch:
        rows = len(next(iter(columns.values())))
        return pa.RecordBatch.from_arrays([pa.array(columns.get(c, [None] * rows), t) for c, t in _INDEX.items()], list(_INDEX))

    def flushed(chunk: _Chunk, number: int) -> Iterator[pa.RecordBatch]:
        for of, keys, held in chunk.packed():
            yield batch_of({"chunk": [number], "range": [of], "keys": [keys], "docs": [held]})

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_cache("similar")
        bands, seen = Bands(p, q, costs=costs), set()
        chunk, number = _Chunk(ranges), 0
        for batch in batches:
            if not number and batch.num_rows:
                number = batch.column(3)[0].as_py() << 32
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                sets = [shingles(t.as_py(), n) for t in part.column(1)]
                classes = [set_class(s) if len(s) else None for s in sets]
                places, numbers = [], []
                for c, s in zip(classes, sets):
                    known = c is None or c in seen
                    numbers.append(None if known else number)
                    places.append(None if known else chunk.add(signatures(s, bands)))
                    if len(seen) < 200_000:
                        seen.add(c)
                    if chunk.size >= CHUNK_KEYS:
                        yield from flushed(chunk, number)
                        chunk, number = _Chunk(ranges), number + 1
                yield batch_of(
                    {
                        "doc_id": part.column(0), "text_hash": part.column(2), "n": [len(s) for s in sets], "cls": classes,
                        "lead": [int.from_bytes(c[:8], "little", signed=True) if c else None for c in classes],
                        "sketch": [sketch(s) if len(s) else None for s in sets],
                        # A copy that isn't indexed here has its sketch where it is.
                        "wide": [None if known is None or len(s) <= SKETCH_BITS else wide_sketch(s) for known, s in zip(places, sets)], "chunk": numbers, "at": places,
                    }
                )
        if chunk.size:
            yield from flushed(chunk, number)

    kinds = {pa.int64(): "long", pa.binary(): "binary", pa.list_(pa.int64()): "array<bigint>"}
    return rows.mapInArrow(index, ", ".join(f"`{c}` {kinds[t]}" for c, t in _INDEX.items()))


class _Repeated:
    """Which keys were added more than once. Each different key is held once, and those added again once more."""

    def __init__(self) -> None:
        self.once, self.twice, self.waiting, self.size = np.zeros(0, _U), np.zeros(0, _U), [], 0

    def add(self, keys: np.ndarray) -> None:
        self.waiting.append(keys)
        self.size += len(keys)
        if self.size > CHUNK_KEYS:
            self._settle()

    def _settle(self) -> None:
        keys = np.sort(np.concatenate([self.once, *self.waiting]))
        self.waiting, self.size = [], 0
        same = keys[1:] == keys[:-1]
        self.twice = np.unique(np.r_[self.twice, keys[1:][same]])
        self.once = keys[np.r_[True, ~same]] if len(keys) else keys

    def has(self, keys: np.ndarray) -> np.ndarray:
        if self.waiting:
            self._settle()
        at = np.searchsorted(self.twice, keys)
        found = at < len(self.twice)
        found[found] = self.twice[at[found]] == keys[found]
        return found


def _again(index: DataFrame) -> DataFrame:
    """(key, chunk, at) of the keys that occur more than once.

    The packed keys of a range are kept as they come until all of them are there and it is
    known which occur again; then these are let through. Keys are shuffled once. Unpacked, a
    task holds a range's different keys only, however long their lists.
    """
    parts = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        now, count, keys_of = None, 0, _Repeated()

        def let_through() -> Iterator[pa.RecordBatch]:
            held.seek(0)
            for _ in range(count):
                chunk, keys, docs = pickle.load(held)
                found = _ascending(unpack.decompress(keys), 5)
                keep = keys_of.has(found)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(found[keep].view(np.int64)), pa.array(np.full(int(keep.sum()), chunk, np.int64)),
                        pa.array(_numbers(unpack.decompress(docs), 4)[keep].view(np.int64)),
                    ],
                    ["key", "chunk", "at"],
                )
            held.seek(0)
            held.truncate()

        with tempfile.SpooledTemporaryFile(HELD_BYTES) as held:
            for batch in batches:
                for of, *row in zip(*(batch.column(c).to_pylist() for c in ("range", "chunk", "keys", "docs"))):
                    if of != now:
                        yield from let_through()
                        now, count, keys_of = of, 0, _Repeated()
                    keys_of.add(_ascending(unpack.decompress(row[1]), 5))
                    pickle.dump(row, held)
                    count += 1
            yield from let_through()

    dealt = index.select("range", "chunk", "keys", "docs").repartition(parts, "range").sortWithinPartitions("range")
    return dealt.mapInArrow(again, "key long, chunk long, at long")


def _sent(ids: DataFrame) -> DataFrame:
    """So few are sent to all tasks, and no text is shuffled; more meet the documents in a shuffled join."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def _sets(docs: DataFrame, key: str, text: str, n: int, ids: DataFrame) -> DataFrame:
    """(cls, packed) of the documents in ``ids`` (wanted_id), once for each class."""
    rows = docs.select(col(key).cast("long").alias("doc_id"), col(text).alias("text"))
    rows = rows.join(_sent(ids), F.col("doc_id").eqNullSafe(F.col("wanted_id")), "left_semi").select("text")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                found = [s for s in (shingles(t.as_py(), n) for t in batch.column(0).slice(at, 500)) if len(s)]
                packed = [_packed_ascending(s >> _U(64 - SET_BITS), SET_BITS // 8) for s in found]
                yield pa.RecordBatch.from_arrays([pa.array(map(set_class, found), pa.binary()), pa.array(packed, pa.binary())], names=["cls", "packed"])

    return rows.mapInArrow(sets, "cls binary, packed binary").dropDuplicates(["cls"])


def _may_link(a: str, b: str, threshold: tuple[int, int]) -> Column:
    """Not more differences, as far as the sketches show, than linked sets of these sizes can have.

    The short sketch decides first, as it is cheap; of larger sets the wide ones follow, folded to the shorter of both.
    """
    p, q = threshold
    # I = (n + m - D) / 2 and D <= I (q - p) / p
    few = f"* {2 * p + (q - p)} <= ({a}.n + {b}.n) * {q - p}"
    differing = " + ".join(f"bit_count({a}.sketch[{i}] ^ {b}.sketch[{i}])" for i in range(SKETCH_BITS // 64))
    to = f"least(size({a}.wide), size({b}.wide))"
    at = lambda x: f"if(size({x}.wide) = {to}, {x}.wide[j], aggregate(sequence(0, size({x}.wide) div {to} - 1), 0L, (f, k) -> f ^ {x}.wide[j + k * {to}]))"
    wide = f"aggregate(sequence(0, {to} - 1), 0L, (s, j) -> s + bit_count({at(a)} ^ {at(b)}))"
    return F.expr(f"({a}.n * {q} >= {b}.n * {p} and {b}.n * {q} >= {a}.n * {p}) and ({differing}) {few} and ({a}.wide is null or {b}.wide is null or {wide} {few})")


def _pairs(rows: DataFrame, a: str, b: str) -> DataFrame:
    end = lambda x: F.struct(F.col(f"{x}.cls").alias("cls"), F.col(f"{x}.doc_id").alias("doc_id"))
    return rows.select(F.least(end(a), end(b)).alias("u"), F.greatest(end(a), end(b)).alias("v")).distinct()


def _linked(pairs: DataFrame, docs: DataFrame, key: str, text: str, n: int, threshold: tuple[int, int]) -> DataFrame:
    """The pairs whose sets reach the threshold, by exact count. ``pairs`` is a written table."""
    p, q = threshold
    ids = pairs.select(F.col("u.doc_id").alias("wanted_id")).union(pairs.select("v.doc_id")).distinct()
    sets = _sets(docs, key, text, n, ids)
    met = pairs.select(F.col("u.cls").alias("u"), F.col("v.cls").alias("v")).join(sets.select(F.col("cls").alias("u"), F.col("packed").alias("a")), "u").join(
        sets.select(F.col("cls").alias("v"), F.col("packed").alias("b")), "v"
    )

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = SET_BITS // 8
        for batch in batches:
            keep = []
            for a, b in zip(batch.column("a"), batch.column("b")):
                a, b = _ascending(a.as_py(), width), _ascending(b.as_py(), width)
                both = np.sort(np.r_[a, b], kind="stable")
                shared = int((both[1:] == both[:-1]).sum())
                keep.append(shared * q >= (len(a) + len(b) - shared) * p)
            yield batch.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))

    return met.select("u", "v", "a", "b").mapInArrow(judged, "u binary, v binary")


def _members(docs: DataFrame, key: str, text: str, n: int, threshold: tuple[int, int]) -> DataFrame:
    """(doc_id, text_hash, n, cls, root, component_id) of every document; cls and root are null for empty sets."""
    kind = F.when(F.col("range").isNull(), "docs").otherwise("keys")
    both = written(_index(docs, key, text, n, threshold).withColumn("kind", kind), "similar-index", by="kind")
    index = both.where("kind = 'docs'").drop("kind", "range", "keys", "docs")
    classes = written(
        index.where("cls is not null").groupBy("cls").agg(F.min("doc_id").alias("doc_id"), F.first("lead").alias("lead"), F.first("n").alias("n"), F.first("sketch").alias("sketch"), F.first("wide", ignorenulls=True).alias("wide")),
        "similar-classes",
    )
    member = F.struct("cls", "doc_id", "n", "sketch", "wide")

    # Lists with two different members or more, and their leaders. All of it is dealt by key once.
    entries = _again(both.where("kind = 'keys'")).join(index.where("at is not null").select("chunk", "at", "lead"), ["chunk", "at"])
    once = written(entries.select("key", "lead"), "similar-entries")
    if both.inputFiles():  # the packed keys, most of the index, have been read for the last time
        delete(docs.sparkSession, folder_of(both) + "/kind=keys")
    # Both readers of the dealt entries have this filter, so that they share one shuffle: a join would give it to one of them.
    entries = once.where("key is not null and lead is not null").repartition("key").dropDuplicates(["key", "lead"])
    leader = lambda j: F.min(F.struct(F.xxhash64("lead", F.lit(j)).alias("at"), F.col("lead").alias("lead")))["lead"]
    together = lambda j: F.bit_xor(F.xxhash64("lead", F.lit(j)))
    heads = entries.groupBy("key").agg(
        F.min("lead").alias("low"), F.max("lead").alias("high"), F.array_distinct(F.array(*(leader(j) for j in range(LEADERS)))).alias("leaders"),
        F.count(F.lit(1)).alias("size"), together(LEADERS).alias("x1"), together(LEADERS + 1).alias("x2"),
    ).where("low != high")
    # Sets that share much share many lists; of lists with the same members one is enough.
    heads = heads.groupBy("low", "high", "size", "x1", "x2").agg(F.min_by(F.struct("key", "leaders"), "key").alias("one"), F.count(F.lit(1)).alias("alike"))
    lists = written(entries.join(heads.select("one.*", "alike"), "key"), "similar-lists")
    if once.inputFiles():
        delete(docs.sparkSession, folder_of(once))

    # Few classes are in a list; what follows joins these, not all.
    listed = written(classes.join(lists.select("lead").distinct(), "lead", "left_semi").select(classes.columns), "similar-listed")

    def as_members(pairs: DataFrame) -> DataFrame:
        """Pairs (lead, leader) as x and y, where the sketches allow them: the short ones first, the wide ones for what these leave."""
        pairs = pairs.select("lead", "leader")
        for of in (F.struct("n", "sketch", F.lit(None).cast("array<bigint>").alias("wide")), member):
            both = pairs.join(listed.select("lead", of.alias("x")), "lead")
            both = both.join(listed.select(F.col("lead").alias("leader"), of.alias("y")), "leader").where(_may_link("x", "y", threshold))
            pairs = both.select("lead", "leader")
        return both

    # A member's first comparison is with the leader it meets in most lists; only pairs that this leaves apart follow.
    led = lists.select("lead", F.explode("leaders").alias("leader"), "alike").where("lead != leader").groupBy("lead", "leader").agg(F.sum("alike").alias("met"))
    led = written(led, "similar-led")
    nearest = led.groupBy("lead").agg(F.max_by("leader", F.struct("met", "leader")).alias("leader"))
    tried = written(_pairs(as_members(nearest), "x", "y"), "similar-tried")
    star = written(_linked(tried, docs, key, text, n, threshold), "similar-star")
    placed = written(roots(star), "similar-star-roots")
    at = listed.join(placed, listed["cls"] == placed["node"], "left").select("lead", F.coalesce("root", "cls").alias("root"))
    apart = led.join(at.withColumnRenamed("root", "a_root"), "lead").join(at.toDF("leader", "b_root"), "leader").where("a_root != b_root")
    rest = written(_pairs(as_members(apart), "x", "y").join(tried, ["u", "v"], "left_anti"), "similar-rest")
    links = _linked(rest, docs, key, text, n, threshold)
    first = written(roots(placed.select(F.col("node").alias("u"), F.col("root").alias("v")).union(links)), "similar-roots")

    # Lists whose members are in several components; there, members outside the main one meet those of other components.
    rooted = listed.join(first, listed["cls"] == first["node"], "left").select("lead", member.alias("x"), F.coalesce("root", "cls").alias("root"))
    rooted = lists.select("key", "lead").join(rooted.select("lead", F.col("root")), "lead")
    counts = rooted.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n"))
    main = counts.groupBy("key").agg(F.max_by("root", F.struct("n", "root")).alias("main"), F.count(F.lit(1)).alias("roots")).where("roots > 1")
    open_lists = rooted.join(main.drop("roots"), "key").join(listed.select("lead", member.alias("x")), "lead")
    open_lists = written(open_lists.select("key", "x", "root", "main"), "similar-open")
    outside = open_lists.where("root != main").select("key", F.col("x").alias("a"), F.col("root").alias("a_root"))
    others = open_lists.select("key", F.col("x").alias("b"), F.col("root").alias("b_root"), (F.col("root") == F.col("main")).alias("b_main"))
    meet = outside.join(others, (outside["key"] == others["key"]) & (F.col("a_root") != F.col("b_root")) & (F.col("b_main") | F.expr("a.cls < b.cls")) & _may_link("a", "b", threshold))
    # What the first comparisons found unlinked needs no second one.
    meet = written(_pairs(meet, "a", "b").join(tried.union(rest), ["u", "v"], "left_anti"), "similar-meet")
    more = _linked(meet, docs, key, text, n, threshold)
    final = roots(first.select(F.col("node").alias("u"), F.col("root").alias("v")).union(more))

    known = classes.join(final, classes["cls"] == final["node"], "left").select("cls", "doc_id", F.coalesce("root", "cls").alias("root"))
    least = known.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    placed = known.join(least, "root").select("cls", "root", "component_id")
    return index.join(placed, "cls", "left").select(
        "doc_id", "text_hash", "n", "cls", "root",
        F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def components(docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = SHINGLE_WORDS, threshold: tuple[int, int] = THRESHOLD) -> DataFrame:
    """doc_id, n_shingles and component_id (the smallest doc_id reachable by links) of every document.

    ``threshold`` (p, q) means a Jaccard similarity of p / q or more. Null texts
    and texts without words have empty sets and link with nothing. Repeated
    rows come as often as they are there. A null id is never the smallest
    unless a component has no other.
    """
    return _members(docs, key, text, n, threshold).select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = SHINGLE_WORDS, threshold: tuple[int, int] = THRESHOLD) -> DataFrame:
    """``docs`` with one document of each component: that with the smallest id, null ids last.

    Of several texts under that id one stays, and of repeated rows one.
    Documents without words all stay.
    """
    members = written(_members(docs, key, text, n, threshold).where("cls is not null").select("doc_id", "text_hash", "root"), "similar-members")
    own = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    best = members.groupBy("root").agg(F.min(own).alias("best"))
    gone = members.join(best, "root").where(~own.eqNullSafe(F.col("best"))).select("doc_id", "text_hash").distinct()
    gone = written(gone.toDF("gone_id", "gone_hash"), "similar-gone")
    twice = members.groupBy("doc_id", "text_hash").count().where("count > 1").select("doc_id", "text_hash")
    twice = written(twice.toDF("gone_id", "gone_hash"), "similar-twice")

    same = lambda other: col(key).cast("long").eqNullSafe(other["gone_id"]) & (F.xxhash64(col(text)) == other["gone_hash"])
    kept = docs.join(_sent(gone), same(gone), "left_anti")
    if twice.isEmpty():
        return kept
    twice = _sent(twice)
    repeated = kept.join(twice, same(twice), "left_semi").dropDuplicates([key, text])
    return kept.join(twice, same(twice), "left_anti").unionByName(repeated)
