"""Benchmark decontamination: a broadcast hash set of test n-grams meets every window of the documents.

An item's windows are its n-grams of normalised words (an item with fewer words
is one window). Their hashes and their texts are the set. Each window of a
document is looked up by hash, and a hit is verified by its words.

How the set travels goes by its measured bytes, the results are the same:

* up to ``literal_bytes`` with the plan, as the literals of IN, which Spark turns
  into a hash set; all of it happens inside the row, no document is shuffled;
* up to ``broadcast_bytes`` of hashes as a broadcast table, which the windows of
  the documents meet in a hash join; only rows with a hit are shuffled;
* beyond, in a shuffled join.

Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeflow.llm.common import ITEM_WORD, ascii_lower, col, free, words, written

N = 13
#: The driver parses and serializes literals: with so many bytes (some 20,000 windows) it needs a few hundred MB of heap.
LITERAL_BYTES = 2 << 20
#: A row of the broadcast table takes some 40 bytes in memory: 1.6 million windows.
BROADCAST_BYTES, HASH_BYTES = 64 << 20, 40
#: The same words before lower-casing.
RAW_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def benchmark_windows(benchmark: DataFrame, item: str = "item_id", text: str = "text", n: int = N) -> DataFrame:
    """(item, length, gram): distinct windows of each item. Items without words have none."""
    w = benchmark.select(col(item).cast("string").alias("item"), words(ascii_lower(col(text)), ITEM_WORD).alias("w"))
    w = w.where(F.size("w") > 0).withColumn("length", F.least(F.size("w"), F.lit(n)))
    starts = w.withColumn("i", F.explode(F.expr("sequence(1, size(w) - length + 1)")))
    return starts.select("item", "length", F.expr("array_join(slice(w, i, length), ' ')").alias("gram")).distinct()


def _words_at(array: str, length: int) -> str:
    """The window at i as arguments. slice() would copy the whole array for each window."""
    return ", ".join(f"{array}[i + {k - 1}]" for k in range(length))


def _window_hashes(length: int) -> str:
    return f"transform(sequence(1, size(wh) - {length - 1}), i -> struct(int(i) as start, {length} as length, xxhash64({_words_at('wh', length)}) as hash))"


def _hash_of(gram: str) -> str:
    """The hash of a window's words, as ``_window_hashes`` takes it."""
    return f"xxhash64(transform(split({gram}, ' '), x -> xxhash64(x)))"


def _in_row(w: DataFrame, windows: DataFrame) -> DataFrame:
    """``hits`` by literal sets. ``windows`` (length, gram): at most ``literal_bytes`` of them."""
    sets: dict[int, list] = {}
    for r in windows.select("length", "gram", F.expr(_hash_of("gram")).alias("hash")).distinct().collect():
        sets.setdefault(r.length, []).append((r.hash, r.gram))
    found = []
    for length, rows in sorted(sets.items()):
        hashes = ", ".join(f"{h}L" if h > -(1 << 63) else "bigint('-9223372036854775808')" for h in sorted({h for h, _ in rows}))
        grams = ", ".join(f"'{g}'" for g in sorted({g for _, g in rows}))
        found.append(
            f"""if(size(w) >= {length}, transform(filter(sequence(1, size(w) - {length - 1}), i ->
                xxhash64({_words_at("wh", length)}) in ({hashes}) and concat_ws(' ', {_words_at("w", length)}) in ({grams})),
                i -> struct(int(i) as start, {length} as length)), cast(array() as array<struct<start int, length int>>))"""
        )
    hits = f"concat({', '.join(found)})" if sets else "cast(array() as array<struct<start int, length int>>)"
    # As a generator's output, hits are computed once: a filter on them isn't moved down with the whole expression in it.
    return w.select("*", F.explode(F.array(F.expr(hits))).alias("hits"))


def _joined(w: DataFrame, windows: DataFrame, lengths: list[int], small: bool) -> DataFrame:
    """``hits`` by joins; the set of hashes is broadcast if it is ``small``."""
    w = written(w.withColumn("row_id", F.monotonically_increasing_id()), "decontaminate-rows")
    per_length = [F.expr(f"if(size(wh) >= {n}, {_window_hashes(n)}, null)") for n in lengths]
    probes = w.select("row_id", F.explode(F.flatten(F.array_compact(F.array(*per_length)))).alias("p")).select("row_id", "p.*")
    listed = windows.select(F.expr(_hash_of("gram")).alias("hash")).distinct()
    listed = F.broadcast(listed) if small else listed.hint("merge")
    maybe = probes.join(listed, "hash", "left_semi").groupBy("row_id").agg(F.collect_list(F.struct("start", "length")).alias("maybe"))
    grams = w.join(maybe, "row_id").select("row_id", F.expr("inline(maybe)"), "w").withColumn("gram", F.expr("array_join(slice(w, start, length), ' ')"))
    exact = grams.select("row_id", "start", "length", "gram").join(windows.select("gram").distinct(), "gram", "left_semi")
    hits = exact.groupBy("row_id").agg(F.collect_list(F.struct("start", "length")).alias("hits"))
    none = F.expr("cast(array() as array<struct<start int, length int>>)")
    return w.join(hits, "row_id", "left").withColumn("hits", F.coalesce("hits", none)).drop("row_id")


def scan(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text",
    n: int = N, literal_bytes: int = LITERAL_BYTES, broadcast_bytes: int = BROADCAST_BYTES, prefix: str = "",
) -> DataFrame:
    """``docs`` with n_words, n_hit (words inside hits), contaminated, spans and grams.

    ``spans`` are the merged hits as (start, end) in words from 1, end excluded;
    ``grams`` the distinct windows that occur. A document is contaminated when a
    twentieth of its words or more are hit. Null and empty texts have no words.
    ``prefix`` goes before the new names; columns of ``docs`` so named are replaced.
    """
    names = [prefix + x for x in ("n_words", "n_hit", "contaminated", "spans", "grams")]
    kept = [c for c in docs.columns if c not in names]
    row = "row"
    w = docs.select(F.struct(*(col(c) for c in kept), F.lit(0).alias(free(docs, "none")[0])).alias(row), words(ascii_lower(col(text)), ITEM_WORD).alias("w"))
    w = w.withColumn("w", F.coalesce("w", F.array().cast("array<string>"))).withColumn("wh", F.expr("transform(w, x -> xxhash64(x))"))

    windows = written(benchmark_windows(benchmark, item, item_text, n).select("length", "gram").distinct(), "benchmark-windows")
    # Of a literal the driver holds the gram, its hash and what is around them.
    count, size = windows.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("gram") + 24), F.lit(0))).first()
    if size <= literal_bytes:
        found = _in_row(w, windows)
    else:
        lengths = sorted(r.length for r in windows.select("length").distinct().collect())  # 13 numbers at most
        found = _joined(w, windows, lengths, count * HASH_BYTES <= broadcast_bytes)
    found = found.withColumn("hits", F.array_sort("hits"))
    spans = """aggregate(hits, cast(array() as array<struct<start int, end int>>), (a, h) ->
        if(size(a) > 0 and element_at(a, -1).end >= h.start,
           concat(slice(a, 1, size(a) - 1), array(struct(element_at(a, -1).start as start, greatest(element_at(a, -1).end, h.start + h.length) as end))),
           concat(a, array(struct(h.start as start, h.start + h.length as end)))))"""
    out = found.select(
        row,
        F.size("w").cast("long").alias("n_words"),
        F.expr(spans).alias("spans"),
        F.expr("array_distinct(transform(hits, h -> array_join(slice(w, h.start, h.length), ' ')))").alias("grams"),
    ).withColumn("n_hit", F.expr("aggregate(spans, 0L, (a, s) -> a + s.end - s.start)"))
    out = out.withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * 20 >= F.col("n_words")))
    return out.select(*(F.col(row).getField(c).alias(c) for c in kept), *(F.col(x.removeprefix(prefix) if prefix else x).alias(x) for x in names))


def report(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", n: int = N, **more) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items (sorted as strings) and contaminated of every document; items without an id aren't listed.

    Without documents the result is empty, without benchmark items nothing is hit.
    """
    found = scan(docs.select(col(key).alias("doc_id"), col(text).alias("text")), benchmark, "text", item, item_text, n, **more)
    windows = written(benchmark_windows(benchmark, item, item_text, n).select("item", "gram"), "benchmark-items")
    # Only hits are expanded: a document without any is one row.
    rows = found.drop("text", "spans").withColumn("row_id", F.monotonically_increasing_id())
    hits = rows.select("row_id", "doc_id", "n_words", "n_hit", "contaminated", F.explode_outer("grams").alias("gram"))
    named = hits.join(windows, "gram", "left").groupBy("row_id", "doc_id", "n_words", "n_hit", "contaminated")
    return named.agg(F.array_sort(F.collect_set("item")).alias("items")).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), "items", "contaminated"
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", **more) -> DataFrame:
    """``docs`` without contaminated documents; the others are left as they are."""
    mark = free(docs, "judged_")[0]
    return scan(docs, benchmark, text, prefix=mark, **more).where(~col(mark + "contaminated")).select(*(col(c) for c in docs.columns))


def cut_spans(docs: DataFrame, benchmark: DataFrame, text: str = "text", **more) -> DataFrame:
    """``docs`` with the hit words, and what stands between them in a span, removed from the text."""
    mark = free(docs, "judged_")[0]
    found = scan(docs, benchmark, text, prefix=mark, **more)
    raw, gaps, t = words(col(text), RAW_WORD), F.split(col(text), RAW_WORD, -1), mark + "spans"
    parts = found.withColumn(mark + "raw", raw).withColumn(mark + "gaps", gaps)
    inside = lambda i: F.exists(col(t), lambda s: (s["start"] <= i) & (i < s["end"]))
    body = F.transform(
        F.sequence(F.lit(1), F.size(col(mark + "raw"))),
        lambda i: F.when(inside(i), F.when(inside(i - 1), "").otherwise(F.element_at(col(mark + "gaps"), i))).otherwise(
            F.concat(F.element_at(col(mark + "gaps"), i), F.element_at(col(mark + "raw"), i))
        ),
    )
    cut = F.when(F.size(col(t)) > 0, F.concat(F.array_join(body, ""), F.element_at(col(mark + "gaps"), -1))).otherwise(col(text))
    return parts.withColumn(text, cut).select(*(col(c) for c in docs.columns))
