"""Benchmark decontamination as a prefix-filtered set join, in DataFrame functions only.

An item's windows (ten consecutive words, or the whole item if it is shorter) are the sets to be
contained. Their tokens are shingles of three words (fewer in shorter items). One scan of the
documents keeps the shingles that some item has; all further steps work on these few.

* Shingles are ordered by rarity, counted over all documents. To contain a window whole, a document
  must hold the window's rarest shingle: only that prefix is joined.
* Length and position bounds drop windows that would reach beyond the document's ends.
* What is left is verified over the window's whole length, shingle by shingle in order.

Copies of a text are looked at once, so a text that a third of all rows share costs one row's work
after the scan. Null documents have no words. Items without words, or with a null id, are left out;
items that repeat an id count as one. An empty benchmark contaminates nothing. Shingles and texts
are compared by 64 and 128 bits of hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gustline.llm.shared import documents, written

SHINGLE = 3
# Benchmark shingles or windows up to so many rows (some 100 MB) are broadcast; more are shuffled.
BROADCAST_ROWS = 1_000_000

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Fixed value: what separates words.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """A-Z in lower case, then the runs between separators; null has none."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    low = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.coalesce(F.array_remove(F.split(low, SEPARATORS), ""), F.array().cast("array<string>"))


def bound(value: Column, then) -> Column:
    """``then`` of the value, which is computed once however often ``then`` uses it."""
    return F.transform(F.array(value), then)[0]


def shingles(words: Column, size: int) -> Column:
    """pos and hash of every run of ``size`` words."""
    run = lambda ws, i: F.xxhash64(F.slice(ws, i + 1, size))
    every = lambda ws: F.transform(
        F.sequence(F.lit(0), F.size(ws) - size),
        lambda i: F.struct(i.alias("pos"), F.lit(size).alias("size"), run(ws, i).alias("hash")),
    )
    none = F.array().cast("array<struct<pos:int,size:int,hash:bigint>>")
    return bound(words, lambda ws: F.when(F.size(ws) >= size, every(ws)).otherwise(none))


def small(df: DataFrame) -> DataFrame:
    """A hint to broadcast, only for a written table that is counted to be small."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def item_windows(benchmark: DataFrame, window: int) -> DataFrame:
    """item_id (text), the window's number of words and its shingles in order."""
    items = (
        benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
        .where("item_id IS NOT NULL")
        .distinct()
        .select("item_id", words_of(F.col("text")).alias("words"))
    )
    n = F.size("words")
    starts = items.where(n > 0).select(
        "item_id", "words", F.explode(F.sequence(F.lit(0), F.greatest(n - window, F.lit(0)))).alias("start")
    )
    own = starts.select("item_id", F.slice("words", F.col("start") + 1, window).alias("own"))
    length = F.size("own")
    hashes = F.when(length == 1, shingles(F.col("own"), 1)).when(length == 2, shingles(F.col("own"), 2))
    hashes = hashes.otherwise(shingles(F.col("own"), SHINGLE))
    return own.select(
        "item_id",
        length.alias("length"),
        F.least(length, F.lit(SHINGLE)).alias("size"),
        F.transform(hashes, lambda s: s["hash"]).alias("hashes"),
    ).distinct()


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256 and contaminated.

    The key columns text_a and text_b (hashes of the text) follow, so a caller can tell rows apart
    that repeat an id.
    """
    windows = written(item_windows(benchmark, window), "benchmark-windows")
    wanted = written(
        windows.select("size", F.explode("hashes").alias("hash")).distinct(), "benchmark-shingles"
    )
    # Which shingle sizes occur: three numbers at most.
    sizes = sorted(row["size"] for row in windows.select("size").distinct().collect())

    key = [F.xxhash64("text").alias("text_a"), F.xxhash64(F.lit("b"), F.col("text")).alias("text_b")]
    base = documents(docs).select("doc_id", *key, words_of(F.col("text")).alias("words"))
    # The first entry stands for the document itself and carries its number of words.
    itself = lambda ws: F.array(
        F.struct(F.size(ws).alias("pos"), F.lit(0).alias("size"), F.lit(0).cast("long").alias("hash"))
    )
    entries = bound(F.col("words"), lambda ws: F.concat(itself(ws), *[shingles(ws, s) for s in sizes]))
    wanted = wanted.union(docs.sparkSession.range(1).select(F.lit(0), F.col("id")))
    scan = (
        base.select("doc_id", "text_a", "text_b", F.size("words").alias("n_words"), F.inline(entries))
        .join(small(wanted), ["size", "hash"])
        .select("doc_id", "text_a", "text_b", "n_words", "size", "pos", "hash")
    )
    scan = written(scan, "benchmark-shingles-in-documents")
    rows = scan.where("size = 0").select("doc_id", "text_a", "text_b", "n_words")
    # Copies of a text have the same entries: one of them is enough.
    held = scan.where("size > 0").select("text_a", "text_b", "n_words", "size", "pos", "hash").distinct()

    # Around each entry, what the same text holds within a window's reach.
    reach = Window.partitionBy("text_a", "text_b", "size").orderBy("pos").rangeBetween(1 - window, window - 1)
    near = held.withColumn("near", F.collect_list(F.struct("pos", "hash")).over(reach))

    rarity = held.groupBy("size", "hash").agg(F.count("*").alias("n"))
    distinct_windows = windows.select("length", "size", "hashes").distinct()
    prefixes = written(
        distinct_windows.select("*", F.posexplode("hashes").alias("at", "hash"))
        .join(rarity, ["size", "hash"], "left")
        .groupBy("length", "size", "hashes")
        # Without a count the rarest shingle is in no document, and neither is the window.
        .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "hash", "at")).alias("rarest"))
        .where("rarest.n > 0")
        .select("length", "size", "hashes", "rarest.hash", "rarest.at"),
        "window-prefixes",
    )
    start = F.col("pos") - F.col("at")
    candidates = (
        near.join(small(prefixes), ["size", "hash"])
        .withColumn("start", start)
        .where((F.col("start") >= 0) & (F.col("start") + F.col("length") <= F.col("n_words")))
    )
    last = F.col("start") + F.col("length") - F.col("size")
    there = F.filter("near", lambda x: (x["pos"] >= F.col("start")) & (x["pos"] <= last))
    found = written(
        candidates.where(F.transform(there, lambda x: x["hash"]) == F.col("hashes")).select(
            "text_a", "text_b", "start", "length", "hashes"
        ),
        "windows-found",
    )

    # Words inside any window: what reaches beyond the windows before.
    before = Window.partitionBy("text_a", "text_b").orderBy("start", "length")
    before = before.rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("start") + F.col("length")
    new = end - F.greatest(F.col("start"), F.coalesce(F.max(end).over(before), F.lit(0)))
    hits = (
        found.withColumn("new", F.greatest(new, F.lit(0)))
        .groupBy("text_a", "text_b")
        .agg(F.sum("new").cast("long").alias("n_hit"))
    )
    ids = (
        found.select("text_a", "text_b", "length", "hashes")
        .distinct()
        .join(small(windows.select("item_id", "length", "hashes")), ["length", "hashes"])
        .groupBy("text_a", "text_b")
        .agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    )
    none = F.array().cast("array<string>")
    items = F.coalesce("items", none)
    return (
        rows.join(hits, ["text_a", "text_b"], "left")
        .join(ids, ["text_a", "text_b"], "left")
        .select(
            "doc_id",
            F.col("n_words").cast("long").alias("n_words"),
            F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.size(items).cast("long").alias("n_items"),
            F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
            (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
            "text_a",
            "text_b",
        )
    )
