"""Benchmark passages in documents, by SimHash of item-sized windows and multi-index Hamming search.

Built-in expressions only.

1. A window that is similar to an item shares most of its 5-word shingles, so it
   holds that many places where a document shingle is one of the item's. Every
   window of the item's size that holds enough of them is proposed, lined up with
   the item or not; shingles of no item are dropped by a bit table of fixed size
   before anything is shuffled.
2. Proposed windows get a 63-bit SimHash of their weighted shingles. `BLOCKS` =
   `RADIUS` + 1 blocks of 3 bits: two fingerprints within the radius agree in a
   whole block, so the join by block and size loses none of them.
3. Pairs within the radius are verified: the weighted shingle similarity, shared
   over joint occurrences, must be `THRESHOLD` or more.

Equal texts are worked on once. At similarity 0.75 fingerprints differ in 11 bits,
with a deviation of 3, so the radius of 20 keeps all but one pair in 700 right at
the threshold, and practically all above 0.8.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamis.llm.bits import let, listed
from tamis.llm.scratch import written

SHINGLE, THRESHOLD = 5, 0.75
RADIUS, BLOCK_BITS = 20, 3
BLOCKS = RADIUS + 1


def words_of(text: Column) -> Column:
    """Lower-cased words between ASCII white space."""
    return F.filter(F.split(F.lower(text), r"[\x20\x09-\x0D]+"), lambda w: w != "")


def shingles_of(words: Column, size: int) -> Column:
    """Hashes of all runs of `size` words, in order; none if there are fewer words."""


    def runs(w: Column) -> Column:
        starts = F.when(F.size(w) >= size, F.sequence(F.lit(0), F.size(w) - size)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(size)]))

    return let(words, runs)


def simhash(shingles: Column) -> Column:
    """Bit b is set if most shingles, counted with repeats, have it set."""

    def fingerprint(all_: Column) -> Column:
        def add(total: Column, b: Column) -> Column:
            ones = F.aggregate(all_, F.lit(0), lambda n, h: n + F.getbit(h, b).cast("int"))
            bit = F.when(2 * ones > F.size(all_), F.call_function("shiftleft", F.lit(1).cast("long"), b)).otherwise(F.lit(0).cast("long"))
            return total.bitwiseOR(bit)

        return F.aggregate(F.sequence(F.lit(0), F.lit(BLOCKS * BLOCK_BITS - 1)), F.lit(0).cast("long"), add)

    return let(shingles, fingerprint)


def _blocks(print_: Column) -> Column:
    """The values of the blocks with their places, one number each."""
    mask = (1 << BLOCK_BITS) - 1
    value = lambda i: F.call_function("shiftright", print_, i * BLOCK_BITS).bitwiseAND(mask).cast("int")
    return F.transform(F.sequence(F.lit(0), F.lit(BLOCKS - 1)), lambda i: i * (mask + 1) + value(i))


def similarity(a: Column, b: Column) -> Column:
    """Shared over joint occurrences of two lists of shingles."""
    count = lambda x, h: F.size(F.filter(x, lambda y: y == h))
    shared = F.aggregate(F.array_distinct(a), F.lit(0), lambda n, h: n + F.least(count(a, h), count(b, h)))
    return shared / (F.size(a) + F.size(b) - shared)


def _starts() -> Column:
    """Starts of all windows that hold enough of `places`, which are ascending, to be similar to the item of `n` shingles.

    A window holds `least` places if it begins at or before one of them and ends
    at or after the one `least` - 1 further on. A text shorter than the item is
    its only window.
    """
    least = F.ceil(2 * THRESHOLD / (1 + THRESHOLD) * F.col("n") - 1e-6).cast("int")

    def around(p: Column, i: Column) -> Column:
        begin = F.get("places", i + least - 1) - F.col("n") + 1
        low = F.greatest(begin, F.lit(0), F.get("places", i - 1) + 1)  # those up to the place before are there already
        high = F.least(p, F.col("last"))
        return F.when((i + least <= F.size("places")) & (low <= high), F.sequence(low, high)).otherwise(F.array().cast("array<int>"))

    return F.when(F.col("last") <= 0, F.array(F.lit(0))).otherwise(F.flatten(F.transform("places", around)))


def matches(docs: DataFrame, items: DataFrame, text_column: str = "text", item_column: str = "item_id", item_text: str = "text") -> DataFrame:
    """Windows of texts that match an item: `text_id` (hash of the text), `item_id`, `first_word`, `n_words`, `distance`, `similarity`."""
    texts = docs.select(F.col(text_column).cast("string").alias("text"))
    texts = texts.select(F.xxhash64("text").alias("text_id"), "text")
    items = items.select(F.col(item_column).alias("item_id"), words_of(F.col(item_text).cast("string")).alias("words")).where("size(words) > 0")
    items = items.withColumn("n_words", F.size("words")).withColumn("k", F.least("n_words", F.lit(SHINGLE)))
    by_size = F.coalesce(*[F.when(F.col("k") == k, shingles_of(F.col("words"), k)) for k in range(1, SHINGLE + 1)])
    items = written(items.select("item_id", "n_words", "k", by_size.alias("shingles")).withColumn("print", simhash(F.col("shingles"))), "items")
    own = written(items.select("item_id", "n_words", "k", F.size("shingles").alias("n"), F.posexplode("shingles").alias("at", "h")), "shingles")

    sizes = [r["k"] for r in own.select("k").distinct().collect()]  # 5, and less for items that short
    found = None
    for k in sizes:
        spread = texts.select("text_id", F.posexplode(shingles_of(words_of(F.col("text")), k)).alias("p", "h"))
        met = spread.where(listed(F.col("h"), own.where(F.col("k") == k), "h")).join(own.where(F.col("k") == k), "h")
        found = met if found is None else found.unionByName(met)
    if found is None:
        return docs.sparkSession.createDataFrame([], "text_id long, item_id long, first_word int, n_words int, distance int, similarity double")
    near = found.groupBy("text_id", "item_id", "n_words", "k", "n").agg(
        F.count_distinct("at").alias("shared"), F.array_sort(F.collect_set("p")).alias("places")
    )
    near = written(near.where(F.col("shared") >= THRESHOLD * F.col("n")).drop("shared"), "near")

    held = texts.join(near.select("text_id").distinct(), "text_id", "left_semi").dropDuplicates(["text_id"])
    held = held.select("text_id", words_of(F.col("text")).alias("words"))
    # Windows are told apart before they get words: a text's words are never held once a window.
    proposed = near.join(held.select("text_id", F.size("words").alias("held")), "text_id").withColumn("last", F.col("held") - F.col("n_words"))
    proposed = proposed.select("text_id", "n_words", "k", F.explode(_starts()).alias("first_word")).distinct().join(held, "text_id")
    window = F.slice("words", F.col("first_word") + 1, F.col("n_words"))
    cut = F.coalesce(*[F.when(F.col("k") == k, shingles_of(window, k)) for k in range(1, SHINGLE + 1)])
    windows = proposed.select("text_id", "n_words", "k", "first_word", cut.alias("cut")).where("size(cut) > 0")
    windows = written(windows.withColumn("print", simhash(F.col("cut"))), "windows")

    # Only fingerprints go through the blocks; the shingles come back for the few pairs within the radius.
    left = windows.select("text_id", "n_words", "first_word", F.col("print").alias("p1"), F.explode(_blocks(F.col("print"))).alias("block"))
    right = items.select("item_id", "n_words", F.xxhash64("shingles").alias("item"), F.col("print").alias("p2"), F.explode(_blocks(F.col("print"))).alias("block"))
    distance = F.bit_count(F.col("p1").bitwiseXOR(F.col("p2")))
    pairs = left.join(right, ["n_words", "block"]).withColumn("distance", distance).where(F.col("distance") <= RADIUS)
    pairs = pairs.select("text_id", "n_words", "first_word", "item_id", "item", "distance").dropDuplicates(["text_id", "n_words", "first_word", "item_id", "item"])
    own = items.select("n_words", "shingles", F.xxhash64("shingles").alias("item")).dropDuplicates(["n_words", "item"])
    pairs = pairs.join(windows.select("text_id", "n_words", "first_word", "cut"), ["text_id", "n_words", "first_word"]).join(own, ["n_words", "item"])
    pairs = pairs.withColumn("similarity", similarity(F.col("cut"), F.col("shingles")))
    return pairs.where(F.col("similarity") >= THRESHOLD).select("text_id", "item_id", "first_word", "n_words", "distance", "similarity")


def contaminations(docs: DataFrame, items: DataFrame, id_column: str = "doc_id", text_column: str = "text", item_column: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per document, item and matching window: `doc_id`, `item_id`, `first_word`, `n_words`, `distance`, `similarity`.

    Words are lower-cased and end at ASCII white space; an item of fewer than 5
    words is one shingle. A text shorter than an item is one window.

    NULL, empty and blank texts and items match nothing. NULL ids are returned as
    they are; rows that share an id are separate. Equal texts get equal rows.
    Further columns are ignored. Empty tables give an empty result.
    """
    found = written(matches(docs, items, text_column, item_column, item_text), "matches")
    own = docs.select(F.col(id_column).alias("doc_id"), F.xxhash64(F.col(text_column).cast("string")).alias("text_id"))
    return own.join(found, "text_id").drop("text_id")


def decontaminate(docs: DataFrame, items: DataFrame, text_column: str = "text", item_column: str = "item_id", item_text: str = "text") -> DataFrame:
    """The documents, all columns, that hold no window matching an item."""
    found = written(matches(docs, items, text_column, item_column, item_text).select("text_id").distinct(), "matched")
    key = f"_{uuid.uuid4().hex}"
    keyed = docs.withColumn(key, F.xxhash64(docs[f"`{text_column}`"].cast("string")))
    return keyed.join(found.withColumnRenamed("text_id", key), key, "left_anti").drop(key)
