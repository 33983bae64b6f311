"""URL filter: a blocked Bloom filter passes possible hits to an exact hash join.

A listed canonical URL is a host and a path. It covers its host, all
subdomains, and every path that begins with its own. A page's URL therefore has
few keys under which it may be listed: each suffix of its host, with the first
characters of its path, for each length that some listed path has.

The filter is a table: one row of eight 32-bit words for each block. A key
belongs to one block and sets one bit in each word, so a lookup touches a single
row. Built by one aggregation and read by one join, it needs no collected
bitmap; it is broadcast only below a checked size. Keys it lets through meet
the list itself in an exact join, which removes false positives.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow.llm.common import LOWER, UPPER, col, free

#: Odd multipliers of the split-block filter of the Parquet format.
SALTS = (0x47B6137B, 0x44974D91, 0x8824AD5B, 0xA2B7289D, 0x705495C7, 0x2DF1424B, 0x9EFC4947, 0x5C6BFB31)
BROADCAST_BYTES = 64 << 20


def host_of(url: Column) -> Column:
    """After the first "://" up to "/", "?", "#" or the end, A-Z lower-cased; empty where there is none."""
    rest = F.substring(url, F.locate("://", url) + 3, F.length(url))
    host = F.translate(F.regexp_extract(rest, r"\A([^/?#]*)", 1), UPPER, LOWER)
    return F.when(F.locate("://", url) > 0, host).otherwise("")


def path_of(url: Column) -> Column:
    """After the host up to "?", "#" or the end."""
    rest = F.substring(url, F.locate("://", url) + 3, F.length(url))
    return F.when(F.locate("://", url) > 0, F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1)).otherwise("")


def host_suffixes(host: Column) -> Column:
    """The host and the hosts it is a subdomain of, longest first."""
    labels = F.split(host, r"\.", -1)
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def _bits(key: Column) -> list[Column]:
    """One bit for each of the block's words."""
    h = F.xxhash64(key, F.lit("bits")).bitwiseAND(F.lit(0x7FFFFFFF))  # the products stay below 2^63
    return [
        F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright((h * F.lit(s)).bitwiseAND(F.lit(0xFFFFFFFF)), 27).cast("int"))
        for s in SALTS
    ]


def bloom_blocks(keys: DataFrame, key: str, count: int, bits_per_key: int = 16) -> tuple[DataFrame, int]:
    """The filter of ``keys``: (block, w0..w7), and its number of blocks. Blocks without a key have no row."""
    blocks = max(1, -(-count * bits_per_key // 256))
    bits = _bits(col(key))
    rows = keys.select(_block(col(key), blocks).alias("block"), *(b.alias(f"b{i}") for i, b in enumerate(bits)))
    return rows.groupBy("block").agg(*(F.bit_or(f"b{i}").alias(f"w{i}") for i in range(len(bits)))), blocks


def possible(rows: DataFrame, key: str, filter_blocks: DataFrame, blocks: int) -> DataFrame:
    """The rows whose key may be listed: no listed key is lost, a few others pass."""
    probe = rows.withColumn("block", _block(col(key), blocks))
    held = F.broadcast(filter_blocks) if blocks * 100 <= BROADCAST_BYTES else filter_blocks
    every = F.lit(True)
    for i, b in enumerate(_bits(col(key))):
        every = every & (F.col(f"w{i}").bitwiseAND(b) == b)
    return probe.join(held, "block").where(every).select(rows.columns)


def judge(pages: DataFrame, rules: DataFrame, url: str = "url", unlisted: str = "allow") -> DataFrame:
    """``pages`` with host, path, rule and verdict.

    ``rules`` (host, path, verdict) lists canonical URLs. Of the rules that fit
    a URL the longest wins (the one with the longer host, if two are as long);
    a rule that is listed twice with both verdicts blocks. Without a rule, rule
    is null and the verdict is ``unlisted``. A null URL or one without "://"
    has an empty host and path, and no rule fits. Columns of ``pages`` named
    like the four results are replaced. Every row of ``pages`` gives one row.
    """
    names = {"host", "path", "rule", "verdict"}
    kept = [c for c in pages.columns if c.lower() not in names]
    row, = free(pages, "row")
    pages = pages.select(F.struct(*(col(c) for c in kept)).alias(row), host_of(col(url)).alias("host"), path_of(col(url)).alias("path"))

    listed = rules.groupBy("host", "path").agg(F.max(F.col("verdict") == "block").alias("blocks"))
    listed = listed.select(
        F.concat("host", F.lit("\t"), "path").alias("key"),
        F.concat("host", "path").alias("rule"),
        F.length("host").alias("host_length"),
        F.when(F.col("blocks"), "block").otherwise("allow").alias("verdict"),
    )
    # Two values; the lengths are those that occur in the list, not one for each rule.
    count, lengths = rules.agg(F.count(F.lit(1)), F.collect_set(F.length("path"))).first()
    if count == 0:
        hits = pages.select("host", "path").limit(0).select("host", "path", F.lit(None).cast("string").alias("rule"), F.lit("").alias("verdict"))
    else:
        hits = _hits(pages, listed, count, sorted(lengths))
    out = pages.join(hits, ["host", "path"], "left")
    return out.select(f"{row}.*" if kept else F.lit(None).alias(row), "host", "path", "rule", F.coalesce("verdict", F.lit(unlisted)).alias("verdict")).select(
        *(col(c) for c in kept), "host", "path", "rule", "verdict"
    )


def _hits(pages: DataFrame, listed: DataFrame, count: int, lengths: list[int]) -> DataFrame:
    """(host, path, rule, verdict) of the distinct URLs that some rule fits. One URL may hold many pages."""
    distinct = pages.select("host", "path").distinct()
    starts = F.filter(F.array(*(F.lit(n) for n in lengths)), lambda n: n <= F.length("path"))
    keys = (
        distinct.withColumn("suffix", F.explode(host_suffixes(F.col("host"))))
        .withColumn("n", F.explode(starts))
        .withColumn("key", F.concat("suffix", F.lit("\t"), F.expr("substring(path, 1, n)")))
        .select("host", "path", "key")
    )
    blocks, n = bloom_blocks(listed, "key", count)
    exact = possible(keys, "key", blocks, n).join(listed, "key")
    longest = F.struct(F.length("rule").alias("n"), "host_length", "rule", "verdict")
    return exact.groupBy("host", "path").agg(F.max(longest).alias("best")).select("host", "path", "best.rule", "best.verdict")
