"""Mixing of sources to target weights, in whole blocks of words, without a global shuffle of texts.

Built-in expressions only.

1. The words of a source, in a fixed order of its documents, are one stream, cut
   into blocks of `BLOCK` words. A document's place follows from prefix sums in
   two levels: over `CHUNKS` chunks of a source, and within a chunk.
2. Each output shard draws its slots' sources from the multinomial distribution
   of the targets. The few draws by which a source misses its number of slots
   are passed on to sources that lack some.
3. Slot j of a source takes the block at j of a pseudorandom permutation of its
   blocks, a new one for each round through the source: `ROUNDS` rounds of
   swap-or-not, each of which mirrors about half the places at a keyed centre. Slots
   and documents meet in a join by source and block.

Only ids, sizes and block numbers are shuffled; a source with a third of all
words is spread over chunks, shards and blocks like any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tamis.llm.scratch import written

WEIGHTS = (3, 1, 2)
SHARE, MOST = 1.5, 2
BLOCK, CHUNKS, SHARDS = 64, 1024, 256
# Rounds of the permutations; a number of slots that one task numbers.
ROUNDS, CELL = 16, 1 << 16
# A prime for arithmetic that fits 64 bits, and multipliers.
PRIME, FACTORS = (1 << 31) - 1, (48271, 69621)
WORD = r"[^\x20\x09-\x0D]+"

def _before(value: Column, part: list[str], *order: Column) -> Column:
    """The sum of a value over the rows before this one."""
    window = Window.partitionBy(*part).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(value).over(window), F.lit(0))


def targets(sources: DataFrame) -> DataFrame:
    """`sources` (source, source_size) with `ordinal`, `weight` and `target` in words.

    Targets share `SHARE` times all words by weight; none exceeds `MOST` times
    its source, and what it can't take the others share by weight.
    """
    everything = Window.partitionBy()
    place = F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1
    weight = F.get(F.array(*[F.lit(w) for w in WEIGHTS]), F.col("ordinal") % len(WEIGHTS))
    ranked = sources.withColumn("ordinal", place).withColumn("weight", weight).withColumn("cap", MOST * F.col("source_size"))
    # Sources in the order in which a rising level of words per weight fills them up.
    full = F.col("cap") / F.col("weight")
    left = SHARE * F.sum("source_size").over(everything) - _before(F.col("cap"), [], full, F.col("ordinal"))
    shared = F.sum("weight").over(everything) - _before(F.col("weight"), [], full, F.col("ordinal"))
    ranked = ranked.withColumn("level", left / shared)
    reached = F.min(F.when(F.col("level") <= full, F.struct(full.alias("full"), "ordinal", "level"))).over(everything)
    target = F.least(F.col("cap").cast("double"), reached["level"] * F.col("weight"))
    return ranked.select("source", "source_size", "ordinal", target.alias("target"))


def _with_slots(sources: DataFrame) -> DataFrame:
    """Adds the blocks of a source, and the slots that its target comes to."""
    rounds = F.floor(F.col("target") / F.greatest("source_size", F.lit(1)))
    rest = F.floor((F.col("target") - rounds * F.col("source_size")) / BLOCK + 0.5)
    ranked = sources.withColumn("blocks", F.ceil(F.col("source_size") / BLOCK))
    return ranked.withColumn("slots", F.least(rounds * F.col("blocks") + rest, MOST * F.col("blocks")))


def draws(sources: DataFrame, shards: int = SHARDS) -> DataFrame:
    """How many slots of each shard each source fills: `ordinal`, `shard`, `n`, and `first`, the source's slots in earlier shards.

    `sources` has ordinal and slots. Every slot draws a place on the line of all
    slots by a hash of its number.
    """
    total = sources.agg(F.sum("slots")).first()[0] or 0
    cell = max(1, -(-total // 1024))
    bits = F.conv(F.substring(F.md5(F.concat(F.lit("slot:"), F.col("id")).cast("binary")), 1, 12), 16, 10).cast("long")
    drawn = sources.sparkSession.range(total).select(
        F.floor(F.col("id") / max(1, -(-total // shards))).alias("shard"), (bits % max(1, total)).alias("place")
    )
    drawn = drawn.withColumn("cell", F.floor(F.col("place") / cell))
    line = sources.where("slots > 0").select("ordinal", "slots", _before(F.col("slots"), [], F.col("ordinal")).alias("begin"))
    line = line.withColumn("end", F.col("begin") + F.col("slots"))
    cells = F.sequence(F.floor(F.col("begin") / cell), F.floor((F.col("end") - 1) / cell))
    found = drawn.join(line.select("ordinal", "begin", "end", F.explode(cells).alias("cell")), "cell").where("place >= begin AND place < end")
    counts = written(found.groupBy("ordinal", "shard").agg(F.count("*").alias("n")), "draws")

    kept = counts.join(sources.select("ordinal", "slots"), "ordinal").withColumn("before", _before(F.col("n"), ["ordinal"], F.col("shard")))
    kept = kept.withColumn("kept", F.greatest(F.lit(0), F.least("n", F.col("slots") - F.col("before"))))
    over = kept.withColumn("over", F.col("n") - F.col("kept")).where("over > 0")
    over = over.withColumn("from", _before(F.col("over"), [], F.col("ordinal"), F.col("shard")))
    given = over.select("shard", F.explode(F.expr("sequence(`from`, `from` + `over` - 1)")).alias("r"))
    drawn_of = counts.groupBy("ordinal").agg(F.sum("n").alias("drawn"))
    lack = sources.join(drawn_of, "ordinal", "left").withColumn("lack", F.col("slots") - F.coalesce("drawn", F.lit(0))).where("lack > 0")
    lack = lack.withColumn("from", _before(F.col("lack"), [], F.col("ordinal")))
    taken = lack.select("ordinal", F.explode(F.expr("sequence(`from`, `from` + `lack` - 1)")).alias("r"))
    moved = given.join(taken, "r").groupBy("ordinal", "shard").agg(F.count("*").alias("n"))
    both = kept.where("kept > 0").select("ordinal", "shard", F.col("kept").alias("n")).union(moved)
    both = both.groupBy("ordinal", "shard").agg(F.sum("n").alias("n"))
    return both.withColumn("first", _before(F.col("n"), ["ordinal"], F.col("shard")))


def hashed(value: Column, key: Column) -> Column:
    """A number from 0 to PRIME - 1 of a whole number below 2**62 and a key, in arithmetic that any SQL has."""
    first = (value.bitwiseAND(PRIME) * FACTORS[0] + F.shiftright(value, 31) * FACTORS[1] + key) % PRIME
    return (first * first + key) % PRIME


def round_keys(blocks: Column, ordinal: Column, turn: Column) -> Column:
    """The key and the centre of each round of the permutation of a source's blocks, for one turn through them."""
    seed = ((ordinal * 1_000_003 + turn * 8191) % PRIME).cast("long")

    def key_of(number: Column) -> Column:
        key = (seed + number * 7919) % PRIME
        centre = (hashed(key, F.lit(1).cast("long")) * PRIME + hashed(key, F.lit(2).cast("long"))) % blocks
        return F.struct(key.alias("key"), centre.alias("centre"))

    return F.transform(F.sequence(F.lit(1).cast("long"), F.lit(ROUNDS).cast("long")), key_of)


def block_of(slot: Column, blocks: Column, keys: Column) -> Column:
    """The block that a slot takes: the place of the slot within its turn, swapped round by round."""

    def swapped(place: Column, k: Column) -> Column:
        mirrored = (k["centre"] + blocks - place) % blocks
        return F.when(hashed(F.greatest(place, mirrored), k["key"]) % 2 == 1, mirrored).otherwise(place)

    return F.aggregate(keys, (slot % blocks).cast("long"), swapped)


def mix(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source") -> tuple[DataFrame, DataFrame]:
    """Plan a mixture: the documents with what it takes of each, and its pieces.

    Documents: `doc_id`, `text_id` (a hash of the text), `source`, `size` in words,
    `source_size`, `target` (of its source) and `taken`, words with repeats.
    Pieces: `shard`, `ordinal` (of the source), `slot`, `block`, and the words that
    a document contributes, `doc_id`, `text_id`, `first`, `words`.

    NULL, empty and blank texts have size 0 and are taken 0 times. NULL is a
    source of its own, the last; a NULL id comes first in its source. Rows that
    share an id are separate documents. A run over the same rows gives the same
    mixture. Further columns are ignored. An empty table gives empty results.
    """
    sized = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.xxhash64(text_column).alias("text_id"),
        F.col(source_column).cast("string").alias("source"),
        F.coalesce(F.regexp_count(text_column, F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
    )
    chunk = hashed(F.coalesce("doc_id", "size").bitwiseAND((1 << 62) - 1), F.lit(3).cast("long")) % CHUNKS
    sized = written(sized.withColumn("chunk", chunk).withColumn("key", F.coalesce(F.concat(F.lit("="), "source"), F.lit(""))), "sized")

    chunks = sized.groupBy("source", "key", "chunk").agg(F.sum("size").alias("chunk_size"))
    sources = written(_with_slots(targets(chunks.groupBy("source").agg(F.sum("chunk_size").alias("source_size")))), "sources")
    keyed = sources.withColumn("key", F.coalesce(F.concat(F.lit("="), "source"), F.lit(""))).drop("source")
    placed = chunks.drop("source").withColumn("chunk_start", _before(F.col("chunk_size"), ["key"], F.col("chunk"))).join(keyed, "key")
    inside = _before(F.col("size"), ["key", "chunk"], F.asc_nulls_first("doc_id"), F.col("size"), F.col("text_id"))
    rows = sized.withColumn("inside", inside).join(placed, ["key", "chunk"])
    rows = written(rows.withColumn("start", F.col("chunk_start") + F.col("inside")).drop("key", "chunk", "inside"), "placed")

    low, high = F.col("start"), F.col("start") + F.col("size")
    blocks = F.sequence(F.floor(low / BLOCK), F.floor((high - 1) / BLOCK))
    parts = rows.where("size > 0").select("doc_id", "text_id", "ordinal", "start", "size", F.explode(blocks).alias("block"))
    begin = F.greatest("start", F.col("block") * BLOCK)
    parts = parts.withColumn("first", begin - F.col("start"))
    parts = parts.withColumn("words", F.least(high, (F.col("block") + 1) * BLOCK) - begin)

    total = sources.agg(F.sum("slots")).first()[0] or 0
    slots = draws(sources).join(sources.select("ordinal", "blocks"), "ordinal")
    # the few rows of draws are cut into cells first, so that many tasks number the slots
    cells = F.explode(F.expr(f"sequence(0, (n - 1) div {CELL // 64})")).alias("cell")
    slots = slots.select("ordinal", "shard", "blocks", "first", "n", cells).repartition(max(1, -(-total // CELL)), "ordinal", "shard", "cell")
    begin, end = F.col("first") + F.col("cell") * (CELL // 64), F.col("first") + F.least("n", (F.col("cell") + 1) * (CELL // 64)) - 1
    keys = F.array(*[round_keys(F.col("blocks"), F.col("ordinal"), F.lit(turn)) for turn in range(MOST)])
    slots = slots.select("ordinal", "shard", "blocks", keys.alias("keys"), F.sequence(begin, end).alias("run"))
    slots = slots.select("ordinal", "shard", "blocks", "keys", F.explode("run").alias("slot"))
    turn = F.get("keys", F.floor(F.col("slot") / F.col("blocks")).cast("int"))
    slots = slots.select("ordinal", "shard", "slot", block_of(F.col("slot"), F.col("blocks"), turn).alias("block"))
    # what the slots come to isn't seen from the few rows that they are made of: never broadcast them
    pieces = slots.hint("merge").join(parts, ["ordinal", "block"])

    taken = pieces.groupBy("ordinal", F.col("start").alias("at")).agg(F.sum("words").alias("taken"))
    rows = rows.withColumn("at", F.when(F.col("size") > 0, F.col("start"))).join(taken, ["ordinal", "at"], "left")
    taken_of = F.coalesce("taken", F.lit(0)).cast("long").alias("taken")
    documents = rows.select("doc_id", "text_id", "source", "size", "source_size", "target", taken_of)
    return documents, pieces.select("shard", "ordinal", "slot", "block", "doc_id", "text_id", "first", "words")


def mixed_texts(docs: DataFrame, pieces: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The mixture itself: each piece of `mix` with its words, joined by one space, as `text`.

    A document's pieces meet in one row beside its text, so each text is split
    into words once.
    """
    key = F.coalesce("doc_id", F.lit(-(1 << 63))).alias("key")
    own = pieces.groupBy(key, "text_id").agg(F.collect_list(F.struct("shard", "slot", "block", "first", "words")).alias("pieces"))
    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"), F.xxhash64(text_column).alias("text_id"))
    found = texts.select("doc_id", "text", "text_id", key).dropDuplicates(["key", "text_id"]).join(own, ["key", "text_id"])
    split = found.select("doc_id", "pieces", F.regexp_extract_all("text", F.lit(WORD), F.lit(0)).alias("all"))
    split = split.select("doc_id", "all", F.explode("pieces").alias("p"))
    text = F.array_join(F.slice("all", (F.col("p.first") + 1).cast("int"), F.col("p.words").cast("int")), " ")
    return split.select("p.shard", "p.slot", "p.block", "doc_id", "p.words", text.alias("text"))
