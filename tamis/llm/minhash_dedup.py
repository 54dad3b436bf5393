"""Near duplicates by MinHash bands, verified on full shingle sets, grouped by large-star and small-star.

1. One pass over the texts: the set of 5-word shingles, its digest, the minima of
   128 universal hashes as 32 bands of 4, and two bits of each minimum.
2. Texts with the same set are one class from then on, so copies cost nothing.
3. In each band bucket every class is compared with one only, that whose bands
   are the most crowded: the text from which a family of copies stems, if there
   is one, agrees with more of them than they with each other.
4. Components of the links found. Buckets that lie in one component are done. In
   the others, classes are picked whose sizes and signature bits allow a link to
   another component: a semi-join, so no pairs come out. Those outside the
   bucket's largest component are looked up, on full sets, in an index of the
   others' shingles, by tiles of about `TILE` by `TILE` classes and `TILE_SHINGLES`
   shingles a side, or one longer set; only links come out, one per class and component.
5. Full sets are made for classes in some candidate pair only.

Two documents at similarity 0.75 share no band with probability 5e-6; the bits
reject such a pair with probability 2e-6.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamis.llm.arrays import concat, mix, spread, window_hashes, word_bounds, word_hashes
from tamis.llm.bits import listed
from tamis.llm.components import connected
from tamis.llm.scratch import written

SHINGLE, THRESHOLD, BANDS, ROWS = 5, 75, 32, 4
# Of 128 pairs of bits 24 differ on average at similarity 0.75, with a deviation of 4.4.
MOST_APART = 45
TILE, TILE_SHINGLES = 2048, 4 << 20
NULL_ID = -(1 << 63)

_N = BANDS * ROWS
_A = mix(np.arange(1, _N + 1, dtype=np.uint64)) | np.uint64(1)
_B = mix(np.arange(1001, _N + 1001, dtype=np.uint64))
_BAND = mix(np.arange(5001, BANDS + 5001, dtype=np.uint64))
_CHUNK = 4096

_SKETCH = "id long, text_id long, n_shingles long, digest binary, bands array<bigint>, bits array<bigint>"
_SETS = "digest binary, shingles array<bigint>"


def shingle_sets(texts: list[bytes]) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    data, bounds = concat(texts)
    starts, ends = word_bounds(data, bounds[:-1])
    words = word_hashes(data, starts, ends, lower=True)
    at = np.searchsorted(starts, bounds)
    shingles = window_hashes(words, SHINGLE)
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        if b - a >= SHINGLE:
            yield np.unique(shingles[a : b - SHINGLE + 1])
        elif b > a:
            whole = words[a:b]
            yield mix(np.array([sum(int(w) * 31 ** (i + 1) for i, w in enumerate(whole)) + b - a & (1 << 64) - 1], np.uint64))
        else:
            yield np.empty(0, np.uint64)


def minima(shingles: np.ndarray) -> np.ndarray:
    """The least value of each of the universal hashes over a set that isn't empty."""
    least = np.full(_N, np.iinfo(np.uint64).max)
    for at in range(0, len(shingles), _CHUNK):
        part = shingles[at : at + _CHUNK]
        np.minimum(least, (_A[:, None] * part[None, :] + _B[:, None]).min(axis=1), out=least)
    return least >> np.uint64(24)


def _digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def _texts(batch: pa.RecordBatch, column: int) -> list[bytes]:
    return [x.as_buffer().to_pybytes() if x.is_valid else b"" for x in batch.column(column)]


def _parts(batches: Iterator[pa.RecordBatch], most: int = 8 << 20) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Batches cut so that their last column holds about `most` bytes."""
    for batch in batches:
        texts = _texts(batch, batch.num_columns - 1)
        start, held = 0, 0
        for i, t in enumerate(texts):
            held += len(t)
            if held >= most or i == len(texts) - 1:
                yield batch.slice(start, i + 1 - start), texts[start : i + 1]
                start, held = i + 1, 0


def _sketch(batches):
    for batch, texts in _parts(batches):
        sizes, digests, bands, bits = [], [], [], []
        for s in shingle_sets(texts):
            sizes.append(len(s))
            digests.append(_digest(s))
            if len(s):
                least = minima(s)
                groups = least.reshape(BANDS, ROWS)
                key = _BAND.copy()
                for r in range(ROWS):
                    key = mix(key ^ groups[:, r])
                bands.append(key.view(np.int64))
                bits.append(np.packbits([(least >> np.uint64(k) & np.uint64(1)).astype(np.uint8) for k in (0, 1)]).view("<i8"))
            else:
                bands.append(np.empty(0, np.int64))
                bits.append(np.zeros(4, np.int64))
        columns = [
            batch.column(0),
            batch.column(1),
            pa.array(sizes, pa.int64()),
            pa.array(digests, pa.binary()),
            pa.array(bands, pa.list_(pa.int64())),
            pa.array(bits, pa.list_(pa.int64())),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=["id", "text_id", "n_shingles", "digest", "bands", "bits"])


def _sets(batches):
    for batch, texts in _parts(batches):
        found = list(shingle_sets(texts))
        own = [_digest(s) == d for s, d in zip(found, batch.column(0).to_pylist(), strict=True)]
        columns = [
            batch.column(0).filter(pa.array(own)),
            pa.array([s.view(np.int64) for s, o in zip(found, own, strict=True) if o], pa.list_(pa.int64())),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=["digest", "shingles"])


def _near(a: str, b: str) -> Column:
    """Whether sizes and signature bits of two classes allow the similarity asked for."""
    sizes = F.col(f"{a}.n_shingles"), F.col(f"{b}.n_shingles")
    apart = sum(
        F.bit_count(
            F.col(f"{a}.bits")[k].bitwiseXOR(F.col(f"{b}.bits")[k]).bitwiseOR(F.col(f"{a}.bits")[k + 2].bitwiseXOR(F.col(f"{b}.bits")[k + 2]))
        )
        for k in (0, 1)
    )
    return (100 * F.least(*sizes) >= THRESHOLD * F.greatest(*sizes)) & (apart <= MOST_APART)


def _pairs(pairs: DataFrame) -> DataFrame:
    """Distinct pairs of digests, with a text's id and the size of each, of joined rows a and b."""
    x, y = F.struct("a.digest", "a.id", "a.n_shingles"), F.struct("b.digest", "b.id", "b.n_shingles")
    pairs = pairs.select(F.least(x, y).alias("x"), F.greatest(x, y).alias("y"))
    named = [F.col(f"{side}.{c}").alias(f"{n}_{end}") for side, end in (("x", "a"), ("y", "b")) for c, n in (("id", "id"), ("n_shingles", "n"))]
    return pairs.select(F.col("x.digest").alias("a"), F.col("y.digest").alias("b"), *named).dropDuplicates(["a", "b"])


def _full_sets(classes: DataFrame, texts: DataFrame) -> DataFrame:
    """The shingle sets of classes (digest, id of a text); most other texts are dropped before the join."""
    classes = written(classes.select("digest", "id").distinct(), "ends")
    found = texts.where(listed(F.col("id"), classes, "id")).join(classes, "id").select("digest", "text")
    return written(found.mapInArrow(_sets, _SETS).dropDuplicates(["digest"]), "sets")


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Those of the pairs whose full sets are similar enough."""
    ends = pairs.select(F.col("a").alias("digest"), F.col("id_a").alias("id")).union(pairs.select("b", "id_b")).distinct()
    sets = _full_sets(ends, texts)
    shared = F.size(F.array_intersect("shingles_a", "shingles_b"))
    for end in ("a", "b"):
        pairs = pairs.join(sets.select(F.col("digest").alias(end), F.col("shingles").alias(f"shingles_{end}")), end)
    similar = 100 * shared >= THRESHOLD * (F.col("n_a") + F.col("n_b") - shared)
    return pairs.where(similar).select(F.col("a").alias("u"), F.col("b").alias("v"))


def _across(members: DataFrame, stars: DataFrame, texts: DataFrame) -> DataFrame:
    """Links (u, v) between classes of a bucket in different components, at least one per class and component."""
    labelled = members.join(stars.select(F.col("u").alias("digest"), F.col("v").alias("label")), "digest", "left")
    labelled = labelled.withColumn("label", F.coalesce("label", "digest"))
    sizes = labelled.groupBy("key", "label").agg(F.count("*").alias("n"))
    mixed = sizes.groupBy("key").agg(F.max_by("label", F.struct("n", "label")).alias("main"), F.count("*").alias("labels")).where("labels > 1")
    left = written(labelled.join(mixed.select("key", "main"), "key"), "mixed")
    main, rest = left.where("label = main"), left.where("label != main")
    same = (F.col("a.key") == F.col("b.key")) & (F.col("a.label") != F.col("b.label")) & _near("a", "b")
    asking = rest.alias("a").join(left.alias("b"), same, "left_semi").withColumn("asks", F.lit(True))
    asked = main.alias("a").join(rest.alias("b"), same, "left_semi").withColumn("asks", F.lit(False))
    live = written(asking.union(asked).select("key", "digest", "id", "label", "asks", "n_shingles"), "live")
    return _tiled(live, _full_sets(live, texts)).groupBy("key", "r", "c").applyInArrow(_links, "u binary, v binary").distinct()


def _tiled(live: DataFrame, sets: DataFrame) -> DataFrame:
    """Asking classes and targets of each key with their sets, dealt to tiles (r, c) in which every asking class meets every target once."""

    def side(held: Column) -> Column:
        sizes = F.count_if(held) / TILE, F.sum(F.when(held, F.col("n_shingles"))) / TILE_SHINGLES
        return F.ceil(F.greatest(F.lit(1.0), *sizes))

    tiles = live.groupBy("key").agg(side(F.col("asks")).alias("rows"), side(F.lit(True)).alias("columns"))
    live = live.join(sets, "digest").join(tiles, "key")
    place = F.xxhash64("digest")
    others = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    own = ["key", "digest", "label", "shingles"]
    queries = live.where("asks").select(*own, F.pmod(place, F.col("rows")).alias("r"), others("columns").alias("c"), F.lit(True).alias("asks"))
    targets = live.select(*own, others("rows").alias("r"), F.pmod(place, F.col("columns")).alias("c"), F.lit(False).alias("asks"))
    return queries.unionByName(targets)


def _links(table: pa.Table) -> pa.Table:
    """One tile: each asking class against the shingle index of the others."""
    asks = np.array(table.column("asks").to_pylist(), bool)
    digests, labels = table.column("digest").to_pylist(), table.column("label").to_pylist()
    sets = [np.array(x, np.int64) for x in table.column("shingles").to_numpy()]
    targets = np.flatnonzero(~asks)
    out: list[tuple[bytes, bytes]] = []
    if len(targets):
        size = np.array([len(sets[t]) for t in targets])
        shingles, owner = np.concatenate([sets[t] for t in targets]), np.repeat(np.arange(len(targets)), size)
        order = np.argsort(shingles, kind="stable")
        owner = owner[order]
        values, first, count = np.unique(shingles[order], return_index=True, return_counts=True)
        for q in np.flatnonzero(asks).tolist():
            at = np.minimum(np.searchsorted(values, sets[q]), len(values) - 1)
            at = at[values[at] == sets[q]]
            shared = np.bincount(owner[spread(first[at], count[at])], minlength=len(targets))
            linked = targets[100 * shared >= THRESHOLD * (len(sets[q]) + size - shared)]
            found = {labels[t]: digests[t] for t in linked.tolist() if labels[t] != labels[q]}
            out += [(digests[q], d) for d in found.values()]
    schema = pa.schema([("u", pa.binary()), ("v", pa.binary())])
    return pa.table({"u": [u for u, _ in out], "v": [v for _, v in out]}, schema)


def _grouped(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Per document `id` (NULL as `NULL_ID`), `text_id` (a hash of the text), `n_shingles`, its group's `label` and smallest id, `component`."""
    text = F.col(text_column).cast("string")
    texts = docs.select(F.coalesce(F.col(id_column).cast("long"), F.lit(NULL_ID)).alias("id"), F.xxhash64(text).alias("text_id"), text.alias("text"))
    sketch = written(texts.mapInArrow(_sketch, _SKETCH), "sketch")
    of_class = [F.first(c).alias(c) for c in ("n_shingles", "bands", "bits")]
    classes = written(sketch.where("n_shingles > 0").groupBy("digest").agg(F.min("id").alias("id"), *of_class), "classes")

    in_bands = classes.select(F.explode("bands").alias("key"), "digest")
    crowds = in_bands.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    crowded = written(in_bands.join(crowds, "key"), "crowded")
    known = crowded.groupBy("digest").agg(F.sum("n").alias("crowd")).join(classes.drop("bands"), "digest")
    members = written(crowded.select("key", "digest").join(known, "digest"), "members")
    whole = F.struct("crowd", "digest", "id", "n_shingles", "bits")
    pivots = members.groupBy("key").agg(F.max(whole).alias("pivot")).select("key", "pivot.*")
    first = members.alias("b").join(pivots.alias("a"), F.col("a.key") == F.col("b.key")).where(F.col("a.digest") != F.col("b.digest"))
    first = written(_pairs(first.where(_near("a", "b"))), "pairs")
    links = written(_verified(first, texts), "links")
    stars = connected(links)

    stars = connected(stars.union(written(_across(members, stars, texts), "links")))

    nodes = classes.select("digest", "id").join(stars.select(F.col("u").alias("digest"), "v"), "digest", "left")
    nodes = nodes.withColumn("v", F.coalesce("v", "digest"))
    least = nodes.groupBy("v").agg(F.min("id").alias("component_id"))
    named = nodes.join(least, "v").select("digest", F.col("v").alias("label"), "component_id")
    out = sketch.select("id", "text_id", "n_shingles", "digest").join(named, "digest", "left")
    return out.select("id", "text_id", "n_shingles", "label", F.coalesce("component_id", "id").alias("component"))


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per document: `doc_id`, `n_shingles`, `component_id`, `kept`.

    Documents are linked when their sets of 5-word shingles (A-Z lower-cased;
    fewer words: the whole sequence) have a similarity of 0.75 or more;
    `component_id` is the smallest id reachable, `kept` says that it is the
    document's own.

    NULL and blank texts have an empty set and are linked with nothing. A NULL
    id is smaller than any other and is kept as the representative of its group.
    Rows that share an id are separate documents; those that are linked are kept
    together. Any further column is ignored. An empty table gives an empty
    result.
    """
    found = _grouped(docs, id_column, text_column)
    own = lambda c: F.when(F.col(c) != NULL_ID, F.col(c))
    kept = F.col("id") == F.col("component")
    return found.select(own("id").alias("doc_id"), "n_shingles", own("component").alias("component_id"), kept.alias("kept"))


def deduplicate(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The documents, all columns, without near duplicates: of each group the one with the smallest id stays.

    NULL and blank texts all stay. Of rows that share the smallest id one stays,
    of rows with the same id and text one.
    """
    found = written(_grouped(docs, id_column, text_column), "groups")
    first = found.where("n_shingles > 0").groupBy("label").agg(F.min(F.struct("id", "text_id")).alias("first"))
    keys = first.select("first.*").distinct().union(found.where("n_shingles = 0").select("id", "text_id").distinct())
    mark = f"_{uuid.uuid4().hex}"
    keys = keys.select(F.col("id").alias(f"{mark}i"), F.col("text_id").alias(f"{mark}t"))
    keyed = docs.withColumn(f"{mark}i", F.coalesce(docs[f"`{id_column}`"].cast("long"), F.lit(NULL_ID)))
    keyed = keyed.withColumn(f"{mark}t", F.xxhash64(docs[f"`{text_column}`"].cast("string")))
    on = [f"{mark}i", f"{mark}t"]
    return keyed.join(keys, on, "left_semi").dropDuplicates(on).drop(*on)
