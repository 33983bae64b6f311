"""The trie of conversations' common beginnings; totals of subtrees by time-forward processing.

A node is a distinct sequence of first turns. Its key is the exclusive or of two
64-bit hashes of (place, role, text) over its turns, so a long conversation's keys
come from blocks of its rows and a node's parent is known without a join.

Nodes are dealt to shards: a subtree that few rows pass is one shard, nodes that
many rows pass are cut by bands of depth. Within a shard Spark sorts the nodes by
reverse level order and each sends its total to its parent through a priority
queue; then the same is done across shard roots, and once more within the shards
of passed nodes.
"""

from __future__ import annotations

import hashlib
import heapq
import pickle
import tempfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changeflow.llm.common import SPACED_WORD, col, words, written

#: Rows through a node from which it is no longer in one shard with its subtree, at least; the root of all rows if that is more.
LEAST_ROWS = 16_384
#: A band of passed nodes has two to this power levels.
BAND_BITS = 10
#: Messages that a priority queue holds in memory; the rest waits in sorted runs.
QUEUE = 100_000
#: Ids of members that agree but for so many last bits are joined in a block before they are hashed.
ID_BITS = 12

KEY = ["depth", "x1", "x2"]
PARENT = ["up", "p1", "p2"]


class SpillingQueue:
    """A priority queue of tuples, smallest first, with at most ``most`` of them in memory.

    Above that the larger half goes to a sorted run in an unlinked file that only
    this task can read; with the task the file is gone, and a repeated task makes
    its own.
    """

    def __init__(self, most: int = QUEUE) -> None:
        self.most, self.heap, self.runs = max(2, most), [], []
        self.heads: list[tuple[tuple, int]] = []

    def push(self, item: tuple) -> None:
        heapq.heappush(self.heap, item)
        if len(self.heap) > self.most:
            self._spill()

    def _spill(self) -> None:
        self.heap.sort()
        keep = self.most // 2
        run = tempfile.TemporaryFile()  # noqa: SIM115
        for item in self.heap[keep:]:
            pickle.dump(item, run)
        run.seek(0)
        del self.heap[keep:]
        self.runs.append(run)
        self._head(len(self.runs) - 1)

    def _head(self, run: int) -> None:
        try:
            heapq.heappush(self.heads, (pickle.load(self.runs[run]), run))  # noqa: S301
        except EOFError:
            self.runs[run].close()

    def peek(self) -> tuple | None:
        heap, heads = self.heap[:1], self.heads[:1]
        if heap and (not heads or heap[0] <= heads[0][0]):
            return heap[0]
        return heads[0][0] if heads else None

    def pop(self) -> tuple:
        if self.heap and (not self.heads or self.heap[0] <= self.heads[0][0]):
            return heapq.heappop(self.heap)
        item, run = heapq.heappop(self.heads)
        self._head(run)
        return item


def time_forward(nodes: DataFrame, shard: list[str], queue: int = QUEUE) -> DataFrame:
    """``nodes`` with children, leaves and saved as totals of their subtrees within their shard.

    ``nodes`` has the shard's columns, a key and a parent's key, and as own values
    children, leaves and saved: what is known of the node itself and of parts below
    it in other shards. A node without children in or outside its shard is a leaf.
    """
    session = nodes.sparkSession
    columns = [*shard, *KEY, *PARENT, "children", "leaves", "saved"]
    rows = nodes.select(*columns)
    parts = int(session.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(parts, *shard).sortWithinPartitions(*shard, F.desc("depth"), "x1", "x2")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, waiting = None, SpillingQueue(queue)
        for batch in batches:
            data = {c: batch.column(c).to_pylist() for c in columns}
            shards = list(zip(*(data[c] for c in shard), strict=True))
            for i in range(batch.num_rows):
                if shards[i] != now:  # what still waits is for parents in other shards
                    now, waiting = shards[i], SpillingQueue(queue)
                key = (-data["depth"][i], data["x1"][i], data["x2"][i])
                children, leaves, saved = data["children"][i], data["leaves"][i], data["saved"][i]
                while (top := waiting.peek()) is not None and top[:3] <= key:
                    message = waiting.pop()
                    if message[:3] == key:
                        children, leaves, saved = children + 1, leaves + message[3], saved + message[4]
                if not children:
                    leaves = 1
                data["children"][i], data["leaves"][i], data["saved"][i] = children, leaves, saved
                if data["up"][i] is not None:
                    waiting.push((-data["up"][i], data["p1"][i], data["p2"][i], leaves, saved))
            yield pa.RecordBatch.from_arrays([pa.array(data[c], batch.column(c).type) for c in columns], columns)

    return rows.mapInArrow(run, rows.schema)


def _lanes(depth: Column, digest: Column) -> tuple[Column, Column]:
    return F.xxhash64(F.lit(1), depth, digest), F.xxhash64(F.lit(2), digest, depth)


def turns_in_order(conversations: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """Rows (conv, part, at, digest, n_words) with their places: ``part`` and then ``at`` ascend within a conversation.

    Rows are dealt by ranges of (conversation, turn, ...), so a long conversation
    lies in several parts.
    """
    r, t = (F.coalesce(col(c).cast("string"), F.lit("")) for c in (role, text))
    digest = F.unhex(F.sha2(F.concat_ws(":", F.length(r).cast("string"), r, t), 256))
    rows = conversations.where(col(conv_id).isNotNull()).select(
        col(conv_id).cast("long").alias("conv"),
        col(turn).alias("turn"),
        digest.alias("digest"),
        F.size(words(t, SPACED_WORD)).cast("long").alias("n_words"),
    )
    rows = written(rows, "trie-turns")
    order = [F.asc("conv"), F.asc_nulls_first("turn"), F.asc("digest")]
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    return placed.select("conv", F.shiftright("at", 33).alias("part"), "at", "digest", "n_words")


def shared_beginnings(conv: Column) -> tuple[Column, Column]:
    """Of each conversation the one whose beginning it takes, and how many turns: c - c % 20 and crc32 of c mod 4."""
    return conv - conv % 20, F.crc32(conv.cast("string").cast("binary")) % 4


def paths(
    conversations: DataFrame,
    begin: Callable[[Column], tuple[Column, Column]],
    most: int,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """A row for each rebuilt conversation and depth from 0: conv, depth, x1, x2, p1, p2 (the parent's key), n_words, size.

    ``size`` is the rebuilt conversation's number of turns. ``begin`` gives the
    conversation whose first turns are taken and their number, ``most`` at most.
    """
    turns = written(turns_in_order(conversations, conv_id, turn, role, text), "trie-order")
    # Each conversation has a row for each part it lies in; these carry what a part takes over from those before it.
    parts = turns.groupBy("conv", "part").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    whole = Window.partitionBy("conv")
    before = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    other, taken = begin(F.col("conv"))
    parts = parts.select(
        "conv", "part", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"), F.sum("n").over(whole).alias("n_all"),
        other.alias("other"), taken.cast("long").alias("taken"),
    )
    # Only the first turns of each conversation pass the partial limit that Spark puts before the shuffle.
    nth = F.row_number().over(whole.orderBy("part", "at")).cast("long")
    heads = turns.select("conv", nth.alias("place"), "digest", "n_words").where(F.col("place") <= most)
    heads = heads.groupBy(F.col("conv").alias("other")).agg(F.sort_array(F.collect_list(F.struct("place", "digest", "n_words"))).alias("head"))
    own = parts.join(heads, "other", "left")
    head = F.filter("head", lambda x: x["place"] <= F.col("taken"))
    own = own.withColumn("head", F.coalesce(head, F.array().cast("array<struct<place:bigint,digest:binary,n_words:bigint>>")))
    own = own.withColumn("n_head", F.size("head").cast("long"))
    own = written(own.withColumn("size", F.col("n_head") + F.greatest(F.col("n_all") - F.col("taken"), F.lit(0))), "trie-parts")

    place = F.col("before") + F.col("at") - F.col("first") + 1
    rest = turns.join(own.drop("head", "n_all", "other"), ["conv", "part"]).where(place > F.col("taken"))
    rest = rest.withColumn("depth", place - F.col("taken") + F.col("n_head"))
    l1, l2 = _lanes(F.col("depth"), F.col("digest"))
    rest = rest.select("conv", "part", "depth", l1.alias("l1"), l2.alias("l2"), "n_words", "size")
    upto = Window.partitionBy("conv", "part").orderBy("depth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rest = rest.select("*", F.expr("bit_xor(l1)").over(upto).alias("s1"), F.expr("bit_xor(l2)").over(upto).alias("s2"))
    rest = written(rest, "trie-rest")
    sums = rest.groupBy("conv", "part").agg(F.expr("bit_xor(l1)").alias("b1"), F.expr("bit_xor(l2)").alias("b2"))

    def begun(seed: int) -> Column:
        def step(s: Column, x: Column) -> Column:
            return s.bitwiseXOR(_lanes(x["place"], x["digest"])[seed])

        return F.aggregate("head", F.lit(0).cast("long"), step)

    def carried(block: str, start: str) -> Column:
        return F.coalesce(F.expr(f"bit_xor({block})").over(before), F.lit(0).cast("long")).bitwiseXOR(F.col(start))

    starts = own.select("conv", "part", begun(0).alias("h1"), begun(1).alias("h2")).join(sums, ["conv", "part"])
    starts = starts.select("conv", "part", carried("b1", "h1").alias("c1"), carried("b2", "h2").alias("c2"))
    x1, x2 = F.col("s1").bitwiseXOR(F.col("c1")), F.col("s2").bitwiseXOR(F.col("c2"))
    rest = rest.join(starts, ["conv", "part"]).select(
        "conv", "depth", x1.alias("x1"), x2.alias("x2"), x1.bitwiseXOR(F.col("l1")).alias("p1"), x2.bitwiseXOR(F.col("l2")).alias("p2"), "n_words", "size",
    )
    each = own.where(F.col("before") == 0)
    up = F.array_append(F.col("head"), F.lit(None).cast("struct<place:bigint,digest:binary,n_words:bigint>"))
    begins = each.select("conv", "size", "head", F.posexplode(up).alias("depth", "last")).select(
        "conv", F.col("depth").cast("long").alias("depth"), F.slice("head", F.lit(1), F.col("depth")).alias("head"), "size"
    )
    k = begins.select("*", begun(0).alias("x1"), begun(1).alias("x2"), F.try_element_at("head", F.lit(-1)).alias("last"))
    k1, k2 = _lanes(F.col("last")["place"], F.col("last")["digest"])
    top = F.col("depth") == 0
    k = k.select(
        "conv", "depth", "x1", "x2",
        F.when(~top, F.col("x1").bitwiseXOR(k1)).alias("p1"), F.when(~top, F.col("x2").bitwiseXOR(k2)).alias("p2"),
        F.coalesce(F.col("last")["n_words"], F.lit(0).cast("long")).alias("n_words"), "size",
    )
    return k.unionByName(rest)


def _digests(ends: DataFrame) -> DataFrame:
    """SHA-256 of each node's ids, ascending and comma-joined: blocks of ids are joined apart, then hashed one after the other."""
    block = F.shiftright("conv", ID_BITS)
    blocks = ends.groupBy(*KEY, block.alias("block")).agg(F.array_join(F.sort_array(F.collect_list("conv")).cast("array<string>"), ",").alias("ids"))
    parts = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = blocks.repartition(parts, *KEY).sortWithinPartitions(*KEY, "block")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, running = None, hashlib.sha256()
        for batch in batches:
            done = []
            for key, ids in zip(zip(*(batch.column(c).to_pylist() for c in KEY), strict=True), batch.column("ids").to_pylist(), strict=True):
                if key != now:
                    if now is not None:
                        done.append((*now, running.hexdigest()))
                    now, running = key, hashlib.sha256()
                else:
                    running.update(b",")
                running.update(ids.encode())
            yield _batch(done)
        if now is not None:
            yield _batch([(*now, running.hexdigest())])

    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64()] * 3 + [pa.string()]
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], [*KEY, "ends_sha256"])

    return blocks.select(*KEY, "ids").mapInArrow(run, "depth long, x1 long, x2 long, ends_sha256 string")


def trie(rows: DataFrame, least_rows: int = LEAST_ROWS, band_bits: int = BAND_BITS, queue: int = QUEUE) -> DataFrame:
    """A row for each node of the trie of ``rows`` (see ``paths``).

    conv_id (smallest member), depth, parent_conv_id, n_convs (members), n_children,
    n_leaves and saved_tokens of the subtree, ends_sha256 over the members that end
    there, and the node's key x1, x2. Null roles and texts are empty ones, rows
    without a conversation's id take no part, turns of equal number come in the
    order of their digests, and repeated rows are turns of their own. A
    conversation without turns can't occur in the table; one that is rebuilt
    without any is a member of the root alone. Without rows there is no node.
    """
    rows = written(rows, "trie-paths")
    load = F.sum(F.col("size") - F.col("depth") + 1)
    nodes = rows.groupBy(*KEY).agg(
        F.min("conv").alias("conv"), F.count("*").alias("n_convs"), F.min("p1").alias("p1"), F.min("p2").alias("p2"),
        F.max("n_words").alias("n_words"), load.alias("load"),
    )
    nodes = written(nodes.withColumn("up", F.when(F.col("depth") > 0, F.col("depth") - 1)), "trie-nodes")
    least = max(least_rows, int(nodes.agg(F.coalesce(F.sum("n_convs"), F.lit(0))).first()[0] ** 0.5))

    # Parents are found by key; many children of one parent are on the side that may be split.
    above = nodes.select(F.col("depth").alias("up"), F.col("x1").alias("p1"), F.col("x2").alias("p2"), F.col("conv").alias("parent"), F.col("load").alias("above"))
    nodes = nodes.where("depth > 0").join(above, PARENT).unionByName(nodes.where("depth = 0"), allowMissingColumns=True)
    passed = F.col("load") > least
    slot = F.when(passed, F.shiftright("depth", band_bits)).otherwise(F.lit(-1)).cast("long")
    nodes = written(nodes.withColumn("slot", slot), "trie-linked")
    root = F.when(passed, F.col("depth") % (1 << band_bits) == 0).otherwise((F.col("depth") == 0) | (F.col("above") > least))
    # Each conversation's path has one root of a light shard at most, and one for each band of passed nodes.
    roots = nodes.where(root).select(*KEY, "slot")
    shards = rows.select("conv", *KEY).join(roots, KEY)
    shards = shards.select("conv", "slot", F.col("depth").alias("r0"), F.col("x1").alias("r1"), F.col("x2").alias("r2"))
    shard = ["slot", "r0", "r1", "r2"]
    zero = F.lit(0).cast("long")
    own = nodes.join(shards, ["conv", "slot"]).select(
        *shard, *KEY, *PARENT, zero.alias("children"), zero.alias("leaves"), ((F.col("n_convs") - 1) * F.col("n_words")).alias("saved")
    )
    at_root = (F.col("depth") == F.col("r0")) & (F.col("x1") == F.col("r1")) & (F.col("x2") == F.col("r2"))
    light = written(time_forward(own.where("slot < 0"), shard, queue), "trie-within")

    # Passed nodes take what light shards' roots send, summed before it is shuffled, and know of children in the next band.
    own = own.where("slot >= 0")
    own = _received(own, light.where(at_root), F.lit(1), F.col("leaves"), F.col("saved"))
    own = _received(own, own.where(at_root), F.lit(1), zero, zero)
    own = written(own, "trie-passed")
    # Across shard roots: a band's root sends its total to the root of the band above, a level of a smaller trie.
    tops = time_forward(own, shard, queue).where(at_root)
    place = own.select(F.col("depth").alias("up"), F.col("x1").alias("p1"), F.col("x2").alias("p2"), F.col("r0").alias("q0"), F.col("r1").alias("q1"), F.col("r2").alias("q2"))
    across = tops.join(place, PARENT, "left").select(
        F.lit(0).alias("all"), F.shiftright("depth", band_bits).alias("depth"), "x1", "x2",
        F.shiftright("q0", band_bits).alias("up"), F.col("q1").alias("p1"), F.col("q2").alias("p2"), "children", "leaves", "saved",
    )
    totals = time_forward(across, ["all"], queue).select(F.shiftleft("depth", band_bits).alias("depth"), "x1", "x2", "leaves", "saved")
    below = own.where(at_root).drop("leaves", "saved").join(totals, KEY)
    own = _received(own, below, F.lit(0), F.col("leaves"), F.col("saved"))
    final = light.unionByName(time_forward(own, shard, queue)).select(*KEY, "children", "leaves", "saved")

    ends = _digests(rows.where(F.col("depth") == F.col("size")).select("conv", *KEY))
    return (
        nodes.join(final, KEY)
        .join(ends, KEY, "left")
        .select(
            F.col("conv").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs", F.col("children").alias("n_children"),
            F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
            "x1", "x2",
        )
    )


def _received(own: DataFrame, senders: DataFrame, children: Column, leaves: Column, saved: Column) -> DataFrame:
    """Own values with what nodes of other shards send to their parents."""
    zero = F.lit(0).cast("long")
    sent = senders.where(F.col("up").isNotNull()).groupBy(F.col("up").alias("depth"), F.col("p1").alias("x1"), F.col("p2").alias("x2"))
    sent = sent.agg(F.sum(children.cast("long")).alias("m0"), F.sum(leaves).alias("m1"), F.sum(saved).alias("m2"))
    columns = ("children", "leaves", "saved")
    return own.join(sent, KEY, "left").withColumns({c: F.col(c) + F.coalesce(F.col(f"m{k}"), zero) for k, c in enumerate(columns)}).drop("m0", "m1", "m2")
