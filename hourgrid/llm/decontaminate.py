"""Benchmark leaks in documents, by SimHash windows.

1. A window of an item's length can only reach the similarity if it holds one of the item's rarest shingles
   (any ``m - least + 1`` of its ``m``, where ``least`` is the smallest overlap that can pass). Documents
   without such a shingle are left after one scan; nothing that could pass is.
2. In the others, all windows of the item's length with enough shared shingles get a SimHash fingerprint.
3. Fingerprints of windows and of the item that asked for them are joined over Hamming blocks: at distance ``radius`` or
   less one of the blocks differs in at most ``radius // blocks`` bits, and items are listed under all such values.
   A window further away than that can still be similar enough; such windows go on with their item as well.
4. The weighted Jaccard similarity (each shingle weighs its occurrences) of a pair decides.

Items with the same words are one entry, whatever their ids; a window is only ever compared with the entry that asked for it.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourgrid.llm.common import SMALL, col, fresh
from hourgrid.session import materialise

SHINGLE = 5
SIMILARITY = 0.8
#: Windows at the similarity differ in about 10 of 64 bits (standard deviation 3); few are beyond, none is lost.
RADIUS = 20
BLOCKS = 8
_TINY = 1e-9


def _once(df: DataFrame, value: Column, name: str) -> DataFrame:
    """``df`` with ``value`` computed once per row, also where lambdas use it many times."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def _words(text: Column) -> Column:
    """Lower-case runs of letters and digits; the split leaves an empty string at an end that has none."""
    return F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+")


def _with_words(df: DataFrame, text: str) -> DataFrame:
    parts = _once(df, _words(F.col(text)), "parts").drop(text)
    first = (F.element_at("parts", 1) == "").cast("int")
    last = ((F.element_at("parts", -1) == "") & (F.size("parts") > 1)).cast("int")
    return _once(parts, F.slice("parts", first + 1, F.size("parts") - first - last), "words").drop("parts")


def _shingles(words: str, length: int) -> Column:
    """Hashes of all runs of ``length`` words, empty if there are fewer words."""
    runs = F.size(words) - (length - 1)
    return F.when(runs > 0, F.transform(F.sequence(F.lit(1), runs), lambda i: F.xxhash64(F.slice(words, i, length)))).otherwise(
        F.array().cast("array<bigint>"))


def _fingerprint(hashes: Column) -> Column:
    """SimHash of an array of hashes; two bit counts share a number, so arrays may be as long as Spark allows."""
    lanes = F.array(*[F.lit(b) for b in range(32)])
    zero = F.array_repeat(F.lit(0).cast("long"), 32)
    counts = F.aggregate(hashes, zero, lambda acc, h: F.zip_with(
        acc, lanes, lambda a, b: a + F.call_function("shiftrightunsigned", h, b).bitwiseAND(F.lit(0x100000001))))
    half = F.size(hashes)
    bits = F.transform(counts, lambda c, b: F.call_function(
        "shiftleft", F.when(2 * c.bitwiseAND(F.lit(0xFFFFFFFF)) > half, F.lit(1)).otherwise(F.lit(0)).cast("long"), b).bitwiseOR(
        F.call_function("shiftleft", F.when(2 * F.shiftrightunsigned(c, 32) > half, F.lit(1)).otherwise(F.lit(0)).cast("long"), b + 32)))
    return F.aggregate(bits, F.lit(0).cast("long"), lambda acc, x: acc.bitwiseOR(x))


def _overlap(a: str, b: str) -> Column:
    """Shared shingles, each as often as it is in both."""
    both = F.array_intersect(a, b)
    times = lambda of, x: F.size(F.filter(of, lambda y: y == x))
    plain = (F.size(F.array_distinct(a)) == F.size(a)) | (F.size(F.array_distinct(b)) == F.size(b))
    return F.when(plain, F.size(both)).otherwise(
        F.aggregate(both, F.lit(0), lambda acc, x: acc + F.least(times(F.col(a), x), times(F.col(b), x))))


def _blocks(blocks: int) -> list[tuple[int, int]]:
    """Offset and width of each block of the 64 bits."""
    return [(64 * k // blocks, 64 * (k + 1) // blocks - 64 * k // blocks) for k in range(blocks)]


def _block_values(fp: str, blocks: int, spread: int) -> Column:
    """(block, value) structs of a fingerprint, with all values up to ``spread`` bits away."""
    made = []
    for k, (offset, width) in enumerate(_blocks(blocks)):
        own = F.shiftrightunsigned(fp, offset).bitwiseAND(F.lit((1 << width) - 1)).cast("int")
        flips = [sum(1 << b for b in some) for n in range(spread + 1) for some in combinations(range(width), n)]
        masks = F.split(F.lit(",".join(map(str, flips))), ",").cast("array<int>")
        made.append(_pairs(masks, own, k))
    return F.concat(*made)


def _pairs(masks: Column, own: Column, block: int) -> Column:
    return F.transform(masks, lambda m: F.struct(F.lit(block).alias("block"), own.bitwiseXOR(m).alias("value")))


def items_of(benchmark: DataFrame, shingle: int, similarity: float, item: str, text: str) -> DataFrame:
    """``item, entry, size, length, m, shingles, fp``: items with their words, shingle length and fingerprint.

    Items shorter than a shingle are one shingle; items without words are left out. Repeated items stay once. ``entry``
    is the same for items with the same words.
    """
    words = _with_words(benchmark.select(col(benchmark, item).alias("item"), col(benchmark, text).alias("text")), "text")
    words = words.where(F.size("words") > 0).withColumn("size", F.size("words"))
    length = F.least("size", F.lit(shingle))
    whole = words.withColumn("length", length).dropDuplicates()
    runs = F.transform(F.sequence(F.lit(1), F.col("size") - F.col("length") + 1),
                       lambda i: F.xxhash64(F.slice("words", i, F.col("length"))))
    whole = whole.withColumn("entry", F.xxhash64("words"))
    made = _once(whole, runs, "shingles").drop("words")
    return _once(made.withColumn("m", F.size("shingles")), _fingerprint(F.col("shingles")), "fp")


def leaks(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
          item_text: str = "text", shingle: int = SHINGLE, similarity: float = SIMILARITY, radius: int = RADIUS,
          blocks: int = BLOCKS) -> DataFrame:
    """``row, key, item, similarity, start, distance``: per document and item its most similar window.

    ``row`` is a hash of key and text, so that documents that share a key or have none stay apart; repeated
    rows give one result. ``start`` counts words from 0; of equally similar windows the first is named. Documents
    shorter than an item are one window. Items without id are found like others, with a null ``item``; different texts
    under one id are searched one by one, and the most similar window of them all is named. Null and empty texts match
    nothing, as do items without words. No window at the similarity is lost.
    Empty tables give no rows; only the named columns are read, so others cannot clash; very long texts are searched whole.
    """
    named_items = materialise(items_of(benchmark, shingle, similarity, item, item_text), "named-items")
    names = named_items.select("entry", "item").distinct()
    items = materialise(named_items.drop("item").dropDuplicates(["entry"]), "items")
    known = materialise(items.select("entry", "length", "m", F.explode("shingles").alias("shingle")).distinct(), "item-shingles")
    least = F.ceil(F.lit(similarity) * F.col("m") - _TINY)
    by_item = Window.partitionBy("entry", "length", "m").orderBy("items", "shingle")
    rare = (known.join(known.groupBy("shingle").agg(F.count("*").alias("items")), "shingle")
            .withColumn("place", F.row_number().over(by_item)).where(F.col("place") <= F.col("m") - least + 1)
            .select("shingle", "length", "entry"))
    rare = materialise(rare, "rare-shingles")
    lengths = [r[0] for r in rare.select("length").distinct().orderBy("length").collect()]
    named = docs.select(F.xxhash64(col(docs, key), col(docs, text)).alias("row"), col(docs, key).alias("key"), col(docs, text).alias("text"))

    pairs = None
    few = rare.count() <= SMALL
    for length in lengths:  # one scan in general; one more for each length of items shorter than a shingle
        one = rare.where(F.col("length") == length).select("shingle", "entry")
        worded = _with_words(named.select("row", "text"), "text")
        found = worded.select("row", F.explode(_shingles("words", length)).alias("shingle")).join(
            F.broadcast(one) if few else one, "shingle")
        found = found.select("row", F.lit(length).alias("length"), "entry").distinct()
        pairs = found if pairs is None else pairs.unionByName(found)
    if pairs is None:  # no item has a word
        return named.select("row", "key", F.lit(None).cast(names.schema["item"].dataType).alias("item"),
                            F.lit(0.0).alias("similarity"), F.lit(0).alias("start"), F.lit(0).alias("distance")).where("false")
    pairs = materialise(pairs, "leak-pairs")

    rows = pairs.select("row").distinct()
    suspects = named.join(F.broadcast(rows) if pairs.count() <= SMALL else rows, "row", "left_semi")
    suspects = materialise(_with_words(suspects, "text"), "suspects")
    windows = None
    for length in lengths:
        own = suspects.select("row", "key", _shingles("words", length).alias("all"))
        asked = pairs.where(F.col("length") == length).select("row", "entry").join(
            items.where(F.col("length") == length).select("entry", "size", "m", "shingles"), "entry")
        both = own.join(asked, "row").withColumn("w", F.least("m", F.size("all"))).where(F.col("w") > 0)
        both = both.withColumn("need", F.ceil(F.lit(similarity) * (F.col("m") + F.col("w")) / F.lit(1 + similarity) - _TINY).cast("int"))
        hit = F.filter(F.sequence(F.lit(0), F.size("all") - 1), lambda i: F.array_contains("shingles", F.get("all", i)))
        both = _once(both, hit, "hits").where((F.size("hits") >= F.col("need")) & (F.col("need") <= F.col("w")))
        # starts of windows with enough hits: from one hit to the one ``need - 1`` later
        last = F.col("need") - 1
        reach = F.transform(F.sequence(F.lit(0), F.size("hits") - F.col("need")), lambda j: F.struct(
            F.greatest(F.lit(0), F.get("hits", j + last) - F.col("w") + 1).alias("low"),
            F.least(F.get("hits", j), F.size("all") - F.col("w")).alias("high")))
        starts = F.array_distinct(F.flatten(F.transform(
            F.filter(reach, lambda r: r["low"] <= r["high"]), lambda r: F.sequence(r["low"], r["high"]))))
        part = both.select("row", "key", "entry", "w", "all", F.explode(starts).alias("start")).select(
            "row", "key", "entry", "start", F.slice("all", F.col("start") + 1, F.col("w")).alias("window"))
        windows = part if windows is None else windows.unionByName(part)
    windows = materialise(_once(windows, _fingerprint(F.col("window")), "window_fp"), "windows")

    listed = items.select("entry", "shingles", "fp", F.explode(_block_values("fp", blocks, radius // blocks)).alias("b"))
    probes = windows.select("*", F.explode(_block_values("window_fp", blocks, 0)).alias("b"))
    distance = F.bit_count(F.col("fp").bitwiseXOR(F.col("window_fp")))
    near = (probes.select("*", "b.*").drop("b").join(listed.select("*", "b.*").drop("b"), ["entry", "block", "value"])
            .withColumn("distance", distance).where(F.col("distance") <= radius))
    # a pair is met in several blocks; it is checked where its first fitting block is
    fits = F.array_position(F.array(*[
        F.bit_count(F.shiftrightunsigned(F.col("fp").bitwiseXOR(F.col("window_fp")), offset).bitwiseAND(F.lit((1 << width) - 1)))
        <= radius // blocks for offset, width in _blocks(blocks)]), True)
    near = near.where(F.col("block") + 1 == fits).drop("block", "value")
    # the pairs beyond the radius, each known from the item that asked for the window
    beyond = windows.join(items.select("entry", "shingles", "fp"), "entry").withColumn("distance", distance).where(F.col("distance") > radius)
    near = near.unionByName(beyond)
    shared = _overlap("window", "shingles")
    checked = near.withColumn("shared", shared).withColumn(
        "similarity", F.col("shared") / (F.size("window") + F.size("shingles") - F.col("shared")))
    passed = checked.where(F.col("similarity") >= similarity - _TINY).groupBy("row", "entry").agg(
        F.min("key").alias("key"), F.max(F.struct("similarity", (-F.col("start")).alias("s"), (-F.col("distance")).alias("d"))).alias("best"))
    best = (passed.join(names, "entry").groupBy("row", "item").agg(
        F.min("key").alias("key"), F.max("best").alias("best")))
    return best.select("row", "key", "item", F.col("best.similarity").alias("similarity"), (-F.col("best.s")).alias("start"),
                       (-F.col("best.d")).alias("distance"))


def accepted(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` without a leak, with their columns."""
    found = materialise(leaks(docs, benchmark, key, text, **how).select("row").distinct(), "leaks")
    name = fresh(docs.columns, "row")[0]
    marked = found.withColumnRenamed("row", name)
    marked = F.broadcast(marked) if found.count() <= SMALL else marked
    out = docs.withColumn(name, F.xxhash64(col(docs, key), col(docs, text))).join(marked, name, "left_anti")
    return out.select(*[col(out, c) for c in docs.columns])
