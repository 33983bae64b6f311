"""Token ids as shuffled planes.

Documents are tokenised in ascending key order and their ids laid end to end.
Fixed-size blocks of ids are transposed into bit planes or byte planes, so that
the bits of one weight lie together, and each plane is compressed with
zstandard. A segment holds the blocks of some whole documents:

    "IDPLANE1" | planes, one after another | chunk index | length of the index as u32

The chunk index is little-endian: u8 bits per plane (1 or 8), u32 ids in the
segment, u32 ids per block, and per block u32 ids, u8 planes and for each plane
u32 compressed bytes, lowest weight first. Planes above the largest id of a
block are not stored, and any block can be read without the others.

A segment is a row of a Parquet table, so Spark's committer makes the output
whole when tasks are retried. Beside it stand the document index of the segment
(keys and id counts) and its first id's place in the shard. A shard is the
output of one task; shards are in key order.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from changeflow.llm.common import col, worker_cache

MAGIC = b"IDPLANE1"
END_ID = 0
SEGMENT_IDS = 1 << 20
BLOCK_IDS = 1 << 16
#: Text that a task encodes at a time: the more, the fewer distinct pieces it holds for its size, but a worker's memory grows by some 25 times as much.
SLICE_BYTES = 1 << 20

_SEGMENT = "shard int, segment int, first_id long, n_ids long, doc_ids array<bigint>, doc_tokens array<bigint>, content binary"
_ARROW = pa.schema(
    [
        ("shard", pa.int32()), ("segment", pa.int32()), ("first_id", pa.int64()), ("n_ids", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())), ("doc_tokens", pa.list_(pa.int64())), ("content", pa.binary()),
    ]
)


# --- planes ------------------------------------------------------------------------------------


def to_planes(ids: np.ndarray, bits: int) -> list[bytes]:
    """The planes of a block of unsigned 32-bit ids, lowest weight first, without empty upper ones."""
    top = int(ids.max()).bit_length() if len(ids) else 0
    rows = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
    if bits == 8:
        return [rows[:, p].tobytes() for p in range((top + 7) // 8)]
    return [np.packbits(rows[:, p // 8] >> (p % 8) & 1).tobytes() for p in range(top)]


def from_planes(planes: list[bytes], n: int, bits: int) -> np.ndarray:
    rows = np.zeros((n, 4), np.uint8)
    for p, plane in enumerate(planes):
        if bits == 8:
            rows[:, p] = np.frombuffer(plane, np.uint8)
        else:
            rows[:, p // 8] |= np.unpackbits(np.frombuffer(plane, np.uint8), count=n) << (p % 8)
    return rows.view("<u4").reshape(-1)


def pack_segment(ids: np.ndarray, bits: int = 8, block: int = BLOCK_IDS, level: int = 3) -> bytes:
    press, out = zstandard.ZstdCompressor(level=level), [MAGIC]
    index = [struct.pack("<BII", bits, len(ids), block)]
    for at in range(0, len(ids), block):
        part = ids[at : at + block]
        planes = [press.compress(p) for p in to_planes(part, bits)]
        out += planes
        index.append(struct.pack(f"<IB{len(planes)}I", len(part), len(planes), *map(len, planes)))
    tail = b"".join(index)
    return b"".join([*out, tail, struct.pack("<I", len(tail))])


def chunk_index(content: bytes) -> tuple[int, int, list[tuple[int, int, list[int]]]]:
    """Bits per plane, ids in the segment, and per block: its ids, where it begins, bytes of each plane."""
    if content[: len(MAGIC)] != MAGIC:
        raise ValueError("not a segment of id planes")
    at = len(content) - 4 - struct.unpack_from("<I", content, len(content) - 4)[0]
    bits, n, block = struct.unpack_from("<BII", content, at)
    at, blocks, begin = at + 9, [], len(MAGIC)
    for _ in range(-(-n // block)):
        size, planes = struct.unpack_from("<IB", content, at)
        lengths = list(struct.unpack_from(f"<{planes}I", content, at + 5))
        blocks.append((size, begin, lengths))
        at, begin = at + 5 + 4 * planes, begin + sum(lengths)
    return bits, n, blocks


def unpack_block(content: bytes, bits: int, block: tuple[int, int, list[int]]) -> np.ndarray:
    size, begin, lengths = block
    press, planes = zstandard.ZstdDecompressor(), []
    for length in lengths:
        planes.append(press.decompress(content[begin : begin + length]))
        begin += length
    return from_planes(planes, size, bits)


def unpack_segment(content: bytes) -> np.ndarray:
    bits, _, blocks = chunk_index(content)
    return np.concatenate([np.zeros(0, "<u4"), *(unpack_block(content, bits, b) for b in blocks)])


# --- tokens ------------------------------------------------------------------------------------

#: Byte-level BPE never joins what stands before a lone space or line end with what follows, if both are visible.
_CUT = re.compile(r"(?<=[!-~\w])(?=[ \n][!-~\w])")
#: White space other than lone spaces and line ends between visible characters (in the syntax of Arrow's expressions).
_ODD_SPACE = r"[\t\v\f\r\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]|[ \n][ \n]|\A[ \n]|[ \n]\z|\x01"
#: Marks where plain texts are cut; a text with this character isn't plain.
_BEFORE = "\x01"
_MARKS = (".", ",")
_MARKED = r"\pL[.,]\z"
#: Pieces and their ids that a worker holds at most between two slices: some 30 bytes a piece and its text, and 4 an id.
CACHED_PIECES, CACHED_IDS = 700_000, 4 << 20
#: Bytes; a longer piece is not found again.
LONGEST_PIECE = 128
_FACTORS = np.random.default_rng(1).integers(1 << 63, size=LONGEST_PIECE + 1, dtype=np.uint64)


def _room(array: np.ndarray, n: int) -> np.ndarray:
    if n <= len(array):
        return array
    out = np.empty(max(n, len(array) * 3 // 2), array.dtype)
    out[: len(array)] = array
    return out


def _gathered(values: np.ndarray, begin: np.ndarray, size: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The values of these runs, one after another, and how many each has."""
    sizes = size[which]
    ends = np.cumsum(sizes, dtype=np.int64)
    total = int(ends[-1]) if len(ends) else 0
    kind = np.int32 if len(values) + total < 1 << 31 else np.int64  # half the memory, if it does
    at = np.repeat((begin[which] - ends + sizes).astype(kind), sizes)
    at += np.arange(total, dtype=kind)
    return values[at], sizes


def _bytes(pieces: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The UTF-8 bytes of strings, and where those of each begin and how many they are."""
    pieces = pieces.cast(pa.binary())
    _, offsets, data = pieces.buffers()
    if not len(pieces):
        return np.zeros(0, np.uint8), np.zeros(0, np.int32), np.zeros(0, np.int32)
    bounds = np.frombuffer(offsets, np.int32)[pieces.offset : pieces.offset + len(pieces) + 1]
    return np.frombuffer(data or b"", np.uint8), bounds[:-1], np.diff(bounds)


def _hashed(data: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """64-bit hashes: of each piece the sum of its bytes times factors of their places, and of its length."""
    read = np.where(size <= LONGEST_PIECE, size, 0)
    found, _ = _gathered(data, begin, read, np.arange(len(read)))
    place, _ = _gathered(np.arange(LONGEST_PIECE), np.zeros(len(read), np.int32), read, np.arange(len(read)))
    sums = np.zeros(len(found) + 1, np.uint64)
    np.cumsum(_FACTORS[place] * found, out=sums[1:])
    ends = np.cumsum(read)
    return sums[ends] - sums[ends - read] + size.astype(np.uint64) * _FACTORS[-1]


class _Pool:
    """The ids of pieces of text, one after another, and where those of each piece lie.

    In arrays, as a Python string and a dictionary's entry take some 150 bytes a piece: pieces are found by their hash
    among sorted ones, and are the same if their bytes are. Of two with one hash only the first is found.
    """

    def __init__(self) -> None:
        self.ids, self.used = np.empty(1 << 18, "<u4"), 0
        self.text, self.text_used = np.empty(1 << 18, np.uint8), 0
        self.begin, self.size = np.empty(1 << 16, np.int64), np.empty(1 << 16, np.int32)
        self.text_begin, self.text_size = np.empty(1 << 16, np.int64), np.empty(1 << 16, np.int32)
        self.count = 0
        self.hashes, self.order = np.zeros(0, np.uint64), np.zeros(0, np.int32)

    def add(self, pieces: pa.Array, ids: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Where these pieces are held from now on; ``begin`` and ``size`` say which of the ids are a piece's."""
        at, end = self.count, self.count + len(pieces)
        data, text_begin, text_size = _bytes(pieces)
        hashes = _hashed(data, text_begin, text_size)
        kept = np.where(text_size <= LONGEST_PIECE, text_size, 0)
        text, _ = _gathered(data, text_begin, kept, np.arange(len(kept)))
        self.ids, self.text = _room(self.ids, self.used + len(ids)), _room(self.text, self.text_used + len(text))
        self.ids[self.used : self.used + len(ids)] = ids
        self.text[self.text_used : self.text_used + len(text)] = text
        for name, values in (
            ("begin", begin + self.used), ("size", size), ("text_begin", self.text_used + np.cumsum(kept) - kept), ("text_size", text_size),
        ):
            setattr(self, name, _room(getattr(self, name), end))
            getattr(self, name)[at:end] = values
        slots = np.arange(at, end, dtype=np.int32)
        found = np.flatnonzero(text_size <= LONGEST_PIECE)
        found = found[np.argsort(hashes[found], kind="stable")]
        place = np.searchsorted(self.hashes, hashes[found], "right")
        self.hashes, self.order = np.insert(self.hashes, place, hashes[found]), np.insert(self.order, place, slots[found])
        self.used, self.text_used, self.count = self.used + len(ids), self.text_used + len(text), end
        return slots

    @property
    def slots(self) -> dict[str, int]:
        """The pieces that can be found, and where they are held."""
        runs = ((self.text_begin[i], self.text_begin[i] + self.text_size[i], i) for i in self.order.tolist())
        return {self.text[a:b].tobytes().decode(): i for a, b, i in runs}

    def places(self, pieces: pa.Array) -> np.ndarray:
        """Where these pieces are held; -1 for those that are not."""
        out = np.full(len(pieces), -1, np.int64)
        if not len(self.hashes) or not len(pieces):
            return out
        data, begin, size = _bytes(pieces)
        hashes = _hashed(data, begin, size)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        slots = self.order[at]
        which = np.flatnonzero((self.hashes[at] == hashes) & (self.text_size[slots] == size) & (size <= LONGEST_PIECE))
        ours, sizes = _gathered(self.text, self.text_begin, self.text_size, slots[which])
        theirs, _ = _gathered(data, begin, size, which)
        unlike = np.r_[0, np.cumsum(ours != theirs, dtype=np.int64)]
        ends = np.cumsum(sizes)
        same = which[unlike[ends] == unlike[ends - sizes]]
        out[same] = slots[same]
        return out

    def gather(self, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of these pieces, one after another, and how many each has."""
        return _gathered(self.ids, self.begin, self.size, slots)


class Encoder:
    """A byte-level BPE tokenizer that encodes each distinct piece of text once while its cache has room.

    A text is cut only where the tokenizer cuts it anyway, so the ids are those of the whole text.
    Where an added token's string stands in a text, the library gives that token's id, and the text
    is encoded whole; with ``plain_specials`` the strings of special tokens are ordinary text.
    """

    def __init__(self, vocabulary: str | None = None, plain_specials: bool = False):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has the cores
        from tokenizers import Tokenizer

        if vocabulary is None:
            import public_tokenizers

            vocabulary = public_tokenizers.path("byte_bpe_50k.json")
        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.tokenizer.encode_special_tokens = plain_specials
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values() if not (plain_specials and t.special)]
        self.added = re.compile("|".join(map(re.escape, added))) if added else None
        self.unusual = "|".join([_ODD_SPACE, *map(re.escape, added)])
        size = self.tokenizer.get_vocab_size()
        #: By id, whether the token begins with a space, which this vocabulary writes as U+0120.
        self.begins = np.array([(self.tokenizer.id_to_token(i) or "").startswith("\u0120") for i in range(size)])
        self.forget()

    def forget(self) -> None:
        self.pool = _Pool()
        self.pool.add(pa.array([""]), np.zeros(0, "<u4"), np.zeros(1, np.int64), np.zeros(1, np.int64))

    def encode(self, texts: list[str] | pa.Array) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        if isinstance(texts, list):
            texts = pa.array(texts, pa.string())
        if self.pool.count > CACHED_PIECES or self.pool.used > CACHED_IDS:
            self.forget()
        unusual = pc.match_substring_regex(texts, self.unusual)
        out: list[bytes] = [b""] * len(texts)
        for which, encode in ((pc.invert(unusual), self.encode_plain), (unusual, self.encode_unusual)):
            at = np.flatnonzero(which.to_numpy(zero_copy_only=False)).tolist()
            for i, ids in zip(at, encode(texts.filter(which)) if at else ()):
                out[i] = ids
        return out

    def encode_plain(self, texts: pa.Array) -> list[bytes]:
        """Texts whose white space is lone spaces and line ends: cut before each, for all texts at once."""
        marked = pc.replace_substring(pc.replace_substring(texts, " ", _BEFORE + " "), "\n", _BEFORE + "\n")
        parts = pc.split_pattern(marked, _BEFORE)
        bounds = parts.offsets.to_numpy()
        return self.encode_pieces(parts.flatten(), bounds - bounds[0])

    def encode_unusual(self, texts: pa.Array) -> list[bytes]:
        """Other texts; one with an added token is encoded whole."""
        pieces, bounds, whole = [], [0], {}
        for i, text in enumerate(texts.to_pylist()):
            if self.added and self.added.search(text):
                whole[i] = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
            else:
                pieces += _CUT.split(text)
            bounds.append(len(pieces))
        return [whole.get(i, ids) for i, ids in enumerate(self.encode_pieces(pa.array(pieces, pa.string()), np.array(bounds)))]

    def encode_pieces(self, pieces: pa.Array, bounds: np.ndarray) -> list[bytes]:
        """The ids of the pieces between each two bounds. A mark after a letter is a token apart from the word, so words are looked up without it."""
        coded = pieces.dictionary_encode()
        distinct, which = coded.dictionary, coded.indices.to_numpy()
        marked = pc.match_substring_regex(distinct, _MARKED)
        words = pc.if_else(marked, pc.utf8_rtrim(distinct, "".join(_MARKS)), distinct).dictionary_encode()
        slots = np.zeros((len(distinct), 2), np.int64)  # of the word and its mark; 0 is the empty piece
        slots[:, 0] = self.learned(words.dictionary)[words.indices.to_numpy()]
        for mark, at in zip(_MARKS, self.learned(pa.array(_MARKS)).tolist()):
            slots[pc.and_(marked, pc.ends_with(distinct, mark)).to_numpy(zero_copy_only=False), 1] = at
        ids, sizes = self.pool.gather(slots.ravel())
        sizes = sizes.reshape(-1, 2).sum(axis=1)
        ids, sizes = _gathered(ids, np.cumsum(sizes) - sizes, sizes, which)
        ends = np.r_[0, np.cumsum(sizes)][bounds].tolist()
        return [ids[i:j].tobytes() for i, j in zip(ends, ends[1:])]

    def learned(self, wanted: pa.Array) -> np.ndarray:
        """Where the pool holds these, each of which comes once; those that it doesn't are encoded first."""
        at = self.pool.places(wanted)
        missing = np.flatnonzero(at < 0)
        if len(missing):
            new = wanted.take(pa.array(missing))
            at[missing] = self.pool.add(new, *self.encoded(new.to_pylist()))
        return at

    def encoded(self, new: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of these pieces, and where those of each begin and how many they are."""
        plain = [i for i, p in enumerate(new) if p[:1] == " " and p[1:].isalpha()]
        groups = [plain[i : i + 256] for i in range(0, len(plain), 256)]
        done = [x for k in range(0, len(groups), 16) for x in self.encode_words(new, groups[k : k + 16])]
        left = np.ones(len(new), bool)
        for at, _, _ in done:
            left[at] = False
        each = np.flatnonzero(left).tolist()
        done += [self.encode_each(new, each[k : k + 4096]) for k in range(0, len(each), 4096)]
        begin, size = np.zeros(len(new), np.int64), np.zeros(len(new), np.int64)
        at, ids, sizes = (np.concatenate(x) for x in zip(*done))
        size[at], begin[at] = sizes, np.cumsum(sizes) - sizes
        return ids, begin, size

    def encode_words(self, new: list[str], groups: list[list[int]]) -> Iterator[tuple[list[int], np.ndarray, np.ndarray]]:
        """Words with a space before each are encoded as one text a group: a word's first token alone begins with a space."""
        texts = ["".join([new[i] for i in g]) for g in groups]
        for at, found in zip(groups, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
            ids = np.array(found.ids, "<u4")
            ends = np.r_[np.flatnonzero(self.begins[ids]), len(ids)]
            if len(ends) == len(at) + 1 and ends[0] == 0:
                yield at, ids, np.diff(ends)

    def encode_each(self, new: list[str], at: list[int]) -> tuple[list[int], np.ndarray, np.ndarray]:
        found = [e.ids for e in self.tokenizer.encode_batch_fast([new[i] for i in at], add_special_tokens=False)]
        return at, np.array([i for ids in found for i in ids], "<u4"), np.array([len(ids) for ids in found], np.int64)


def _encoder(vocabulary: str | None, plain_specials: bool = False) -> Encoder:
    """One per worker process; tasks that reuse the process reuse it."""
    held, which = worker_cache("encoder"), (vocabulary, plain_specials)
    if which not in held:
        held[which] = Encoder(vocabulary, plain_specials)
    return held[which]


# --- tables ------------------------------------------------------------------------------------


def encode(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    vocabulary: str | None = None,
    end_id: int = END_ID,
    bits: int = 8,
    block: int = BLOCK_IDS,
    segment_ids: int = SEGMENT_IDS,
    plain_specials: bool = False,
) -> DataFrame:
    """Segments of ``docs`` in ascending key order; write them as Parquet.

    Null keys come first, equal keys in the order of their texts' hash. A null
    text counts as empty; every document ends with ``end_id``. Repeated rows
    are encoded as often as they come. Other columns are not read. A special
    token's string in a text gives its id, as the tokenizer does, unless ``plain_specials``.
    """
    if bits not in (1, 8):
        raise ValueError("bits is 1 (bit planes) or 8 (byte planes)")
    rows = docs.select(col(key).cast("long").alias("key"), F.coalesce(col(text), F.lit("")).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    # The hash deals out rows of one key, should a key have very many.
    ranged = rows.repartitionByRange(F.asc_nulls_first("key"), F.asc("tie"))
    ordered = ranged.sortWithinPartitions(F.asc_nulls_first("key"), F.asc("tie"), F.asc("text")).select("key", "text")

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, end = _encoder(vocabulary, plain_specials), np.array([end_id], "<u4").tobytes()
        shard, number, first = TaskContext.get().partitionId(), 0, 0
        keys, counts, parts, held = [], [], [], 0

        def flush():
            nonlocal number, first, keys, counts, parts, held
            content = pack_segment(np.frombuffer(b"".join(parts), "<u4"), bits, block)
            out = pa.RecordBatch.from_pylist(
                [dict(shard=shard, segment=number, first_id=first, n_ids=held, doc_ids=keys, doc_tokens=counts, content=content)],
                schema=_ARROW,
            )
            number, first = number + 1, first + held
            keys, counts, parts, held = [], [], [], 0
            return out

        for some_keys, texts in _slices(batches):
            for k, ids in zip(some_keys, enc.encode(texts)):
                keys.append(k)
                counts.append(len(ids) // 4 + 1)
                parts += (ids, end)
                held += counts[-1]
                if held >= segment_ids:
                    yield flush()
        if keys:
            yield flush()

    return ordered.mapInArrow(segments, _SEGMENT)


def _slices(batches: Iterator[pa.RecordBatch], chars: int = SLICE_BYTES) -> Iterator[tuple[list, pa.Array]]:
    """Whole documents, about so many bytes of text at a time, whatever the size of Spark's batches."""
    keys, texts, held = [], [], 0
    for batch in batches:
        begin = 0
        ends = np.cumsum(pc.binary_length(batch.column(1)).to_numpy(zero_copy_only=False)) if batch.num_rows else np.zeros(0, np.int64)
        for i in np.flatnonzero(np.diff((held + ends) // chars, prepend=held // chars)).tolist():
            keys += batch.column(0)[begin : i + 1].to_pylist()
            yield keys, pa.concat_arrays([*texts, batch.column(1)[begin : i + 1]])
            keys, texts, begin = [], [], i + 1
        keys += batch.column(0)[begin:].to_pylist()
        texts.append(batch.column(1)[begin:])
        held = (held + int(ends[-1] if len(ends) else 0)) % chars
    if keys:
        yield keys, pa.concat_arrays(texts)


def _per_document(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, list, list, np.ndarray]]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = {n: batch.column(n)[i].as_py() for n in ("shard", "segment", "first_id", "doc_ids", "doc_tokens", "content")}
            counts = np.array(row["doc_tokens"], np.int64)
            yield row, row["doc_ids"], counts, unpack_segment(row["content"])


def _shard_starts(segments: DataFrame) -> DataFrame:
    """Ids before each shard. One row per writing task, so broadcasting it is safe at any size of the data."""
    per = segments.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return per.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))


def read_digests(segments: DataFrame) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32 of each document read back."""

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, keys, counts, ids in _per_document(batches):
            ends = np.cumsum(counts)
            begins = ends - counts
            crc = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(begins, ends)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([row["shard"]] * len(keys), pa.int32()), pa.array(keys, pa.int64()),
                    pa.array(begins + row["first_id"], pa.int64()), pa.array(counts, pa.int64()), pa.array(crc, pa.int64()),
                ],
                names=["shard", "doc_id", "at", "n_tokens", "ids_crc32"],
            )

    read = segments.mapInArrow(digests, "shard int, doc_id long, at long, n_tokens long, ids_crc32 long")
    return read.join(F.broadcast(_shard_starts(segments)), "shard").select(
        "doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32"
    )


def read_ids(segments: DataFrame) -> DataFrame:
    """doc_id and the ids of each document read back, the end id included."""

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, keys, counts, ids in _per_document(batches):
            ends = np.cumsum(counts)
            parts = [ids[e - c : e].astype(np.int64) for c, e in zip(counts, ends)]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(parts, pa.list_(pa.int64()))], names=["doc_id", "ids"])

    return segments.mapInArrow(documents, "doc_id long, ids array<bigint>")
