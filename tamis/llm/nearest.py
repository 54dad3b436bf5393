"""Approximate nearest neighbours by multiprobe p-stable hashing.

1. A bounded sample (`SAMPLE_ROWS`) tells the width of the hash cells, about the
   distance to a k-th neighbour, and how many functions a table needs so that a bucket
   holds some `BUCKET` rows. Every row is indexed: in each of `TABLES` tables its
   bucket is the tuple floor((a . v + b) / width) for Gaussian a.
2. A query expects a neighbour's projections normally distributed around its own, with
   the distance to its k-th neighbour in the sample as deviation: that gives the
   success probability of every bucket near its own. It visits buckets in descending
   order of it until the tables together reach `SUCCESS`.
3. Rows of a bucket and queries that visit it are packed, sorted by bucket, so that a
   crowded bucket spreads over many packs; each meeting of two packs is a task's work.
   A pack yields a query's k nearest, none farther than its k-th neighbour in
   the sample, by exact distance.
4. What the tables found is merged and ranked. Queries that found fewer than k rows
   meet all packs of the first table, which hold every row once.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tamis.llm.arrays import mix
from tamis.llm.scratch import written
from tamis.llm.vectors import _each, matrix, usable

SAMPLE_ROWS, TABLES, BUCKET, PACK, QUERIES = 4096, 4, 1024, 2048, 512
SUCCESS, MOST_FUNCTIONS = 0.95, 8
_WIDTH, _FAR, _FAINT = 1.2, 4, 1e-5

_PACKS = "pack long, slot int, bucket long, data binary"
_PACKS_ARROW = pa.schema([("pack", pa.int64()), ("slot", pa.int32()), ("bucket", pa.int64()), ("data", pa.binary())])
_ROWS = "slot int, bucket long, row long, vec_id long, v array<double>"
_ROWS_ARROW = pa.schema([("slot", pa.int32()), ("bucket", pa.int64()), ("row", pa.int64()), ("vec_id", pa.int64()), ("v", pa.list_(pa.float64()))])


def _below(z: np.ndarray) -> np.ndarray:
    """The normal distribution function, to seven digits."""
    t = 1 / (1 + 0.3275911 * np.abs(z) / np.sqrt(2))
    # The usual rational approximation of the error function.
    poly = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
    half = 0.5 * poly * np.exp(-z * z / 2)
    return np.where(z > 0, 1 - half, half)


@dataclass(frozen=True)
class Hashing:
    """Tables of hash functions: (tables, functions, dims) directions, offsets in cells, and the width of a cell."""

    directions: np.ndarray
    offsets: np.ndarray
    width: float
    sample: np.ndarray
    k: int

    @classmethod
    def fit(cls, sample: np.ndarray, total: int, k: int) -> Hashing:
        dims, rng = sample.shape[1], np.random.default_rng(13)
        radius = cls._radii(sample, sample, k, own=True)
        known = radius[(radius > 0) & np.isfinite(radius)]
        width = _WIDTH * float(np.median(known)) if len(known) else 1.0
        trial = rng.standard_normal((32, dims))
        cells = np.floor(sample @ trial.T / width + rng.random(32))
        shares = [np.unique(c, return_counts=True)[1] / max(1, len(sample)) for c in cells.T]
        shared = float(np.mean([(s**2).sum() for s in shares])) if len(sample) else 1.0
        functions = 2
        while functions < MOST_FUNCTIONS and total * shared**functions > BUCKET:
            functions += 1
        return cls(rng.standard_normal((TABLES, functions, dims)), rng.random((TABLES, functions)), width, sample, k)

    @staticmethod
    def _radii(queries: np.ndarray, sample: np.ndarray, k: int, own: bool = False) -> np.ndarray:
        """Distance of each query to its k-th nearest of the sample; infinite if the sample has fewer others."""
        out = np.full(len(queries), np.inf)
        if len(sample) <= k:
            return out
        for at in range(0, len(queries), 256):
            part = queries[at : at + 256]
            square = (part**2).sum(axis=1)[:, None] + (sample**2).sum(axis=1) - 2 * part @ sample.T
            # a query may be in the sample itself: then its k + 1st counts
            out[at : at + 256] = np.sqrt(np.maximum(0, np.partition(square, k, axis=1)[:, k]))
        return out

    def radii(self, queries: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore", invalid="ignore"):
            return np.nan_to_num(self._radii(queries, self.sample, self.k), nan=np.inf, posinf=np.inf)

    def _places(self, v: np.ndarray, table: int) -> np.ndarray:
        with np.errstate(over="ignore", invalid="ignore"):
            place = v @ self.directions[table].T / self.width + self.offsets[table]
        return np.clip(np.nan_to_num(place), -(2.0**50), 2.0**50)

    @staticmethod
    def _names(cells: np.ndarray, table: int) -> np.ndarray:
        name = np.full(len(cells), table + 1, np.uint64)
        for column in cells.astype(np.int64).T:
            name = mix(name ^ mix(column.view(np.uint64) + np.uint64(0x9E3779B97F4A7C15)))
        return name.view(np.int64)

    def buckets(self, v: np.ndarray, table: int) -> np.ndarray:
        return self._names(np.floor(self._places(v, table)), table)

    def probes(self, q: np.ndarray, radius: float, table: int) -> np.ndarray:
        """The buckets that one query visits in one table, likeliest first."""
        place = self._places(q[None, :], table)[0]
        home, share = np.floor(place), 1 - (1 - SUCCESS) ** (1 / TABLES)
        steps = np.arange(-_FAR, _FAR + 1)
        spread = max(radius if np.isfinite(radius) else self.width, 1e-9 * self.width) / self.width
        edges = (home[:, None] + np.arange(-_FAR, _FAR + 2) - place[:, None]) / spread
        chance = np.diff(_below(edges), axis=1)
        likely, cells = np.ones(1), np.zeros((1, 0))
        for at in range(len(home)):
            joint = (likely[:, None] * chance[at]).ravel()
            cells = np.hstack([np.repeat(cells, len(steps), axis=0), np.tile(home[at] + steps, len(cells))[:, None]])
            stays = joint > _FAINT * joint.max(initial=0)
            likely, cells = joint[stays], cells[stays]
        order = np.argsort(-likely, kind="stable")
        most = int(np.searchsorted(np.cumsum(likely[order]), share)) + 1
        return self._names(cells[order[:most]], table)


def _rows(slot: np.ndarray, bucket: np.ndarray, row: np.ndarray, vec_id: np.ndarray, v: pa.Array) -> pa.RecordBatch:
    columns = [pa.array(slot, pa.int32()), pa.array(bucket), pa.array(row), pa.array(vec_id), v]
    return pa.RecordBatch.from_arrays(columns, schema=_ROWS_ARROW)


def _packed(rows: DataFrame, dims: int, size: int, name: str) -> DataFrame:
    """Rows of one bucket in packs of up to `size`, the buckets sorted and cut wherever tasks need it."""
    order = ["slot", "bucket", "row"]

    def pack(batches):
        part, seq, held, key = TaskContext.get().partitionId(), 0, [], None

        def closed():
            nonlocal seq, held
            data = pickle.dumps(tuple(np.concatenate([h[n] for h in held]) for n in range(3)))
            out = {"pack": (part << 32) + seq, "slot": key[0], "bucket": key[1], "data": data}
            seq, held = seq + 1, []
            return pa.RecordBatch.from_pylist([out], _PACKS_ARROW)

        for batch in batches:
            slot, bucket, row, ids = (batch.column(n).to_numpy(zero_copy_only=False) for n in range(4))
            v = matrix(batch.column(4), dims)
            cuts = np.flatnonzero((np.diff(slot) != 0) | (np.diff(bucket) != 0)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(slot)], strict=True):
                if a == b:
                    continue
                if held and key != (int(slot[a]), int(bucket[a])):
                    yield closed()
                key = (int(slot[a]), int(bucket[a]))
                while a < b:
                    room = size - sum(len(h[0]) for h in held)
                    held.append((row[a : min(b, a + room)], ids[a : min(b, a + room)], v[a : min(b, a + room)]))
                    a += room
                    if a <= b and sum(len(h[0]) for h in held) == size:
                        yield closed()
        if held:
            yield closed()

    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return written(placed.mapInArrow(pack, _PACKS), name)


def _nearest(q: tuple, c: tuple, radius: np.ndarray, k: int):
    """Of each query the k nearest of some rows, none beyond its radius: queries' rows and ids, rows, ids, distances."""
    q_rows, q_ids, qv = q
    rows, ids, cv = c
    with np.errstate(over="ignore", invalid="ignore"):
        norm_q, norm_c = (qv**2).sum(axis=1), (cv**2).sum(axis=1)
        rough = norm_q[:, None] + norm_c[None, :] - 2 * (qv @ cv.T)
        margin = 1e-9 * (norm_q[:, None] + norm_c[None, :]) + 1e-300
        limit = (radius**2)[:, None]
        if rough.shape[1] > k:
            # one more, as the query itself may be among them
            last = min(rough.shape[1] - 1, k + int((q_ids[:, None] == ids).sum(axis=1).max(initial=0)) - 1)
            limit = np.minimum(limit, np.partition(np.nan_to_num(rough + margin, nan=np.inf), last, axis=1)[:, [last]])
        a, b = np.nonzero(~(rough - margin > limit) & (q_ids[:, None] != ids))
        total = np.zeros(len(a))
        for x, y in zip(qv.T, cv.T, strict=True):
            total += (x[a] - y[b]) ** 2
    score = np.sqrt(total)
    order = np.lexsort((rows[b], ids[b], score, a))
    rank = np.arange(len(order)) - np.searchsorted(a[order], a[order])
    a, b, score = a[order[rank < k]], b[order[rank < k]], score[order[rank < k]]
    return [q_rows[a], q_ids[a], rows[b], ids[b], score]


def nearest(vectors: DataFrame, every: int, k: int = 10, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """For each vector whose id is divisible by `every`, the k nearest others found: `query_id`, `rank`, `vec_id`, `score`.

    The score is the Euclidean distance of the original vectors in doubles; nearest
    first, ties by smaller id. A row's neighbour is missed with an estimated probability
    of 1 - `SUCCESS` at the distance of the k-th nearest; a query never gets
    fewer than k while there are as many others, and gets all where there are fewer.

    Rows with a NULL id, a NULL or zero vector, or a NULL or non-finite component take no
    part; neither do vectors without components. Rows that share a query's id count as
    the query's own; repeated query rows are answered one by one, repeated candidates
    count one by one. Of vectors of different lengths the shorter counts as filled
    up with zeros. A distance beyond all doubles is infinite. Further columns are
    ignored. An empty table gives an empty result.
    """
    found = usable(vectors, id_column, vector_column).where(F.exists("v", lambda x: x != 0))
    rows = written(found.withColumn("row", F.monotonically_increasing_id()), "vectors")
    total, dims = rows.agg(F.count("*"), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
    drawn = rows.orderBy(F.xxhash64("vec_id", "row")).limit(SAMPLE_ROWS).select("v").collect()  # bounded
    sample = np.zeros((len(drawn), dims))
    for i, r in enumerate(drawn):
        sample[i, : len(r["v"])] = r["v"]
    hashing = Hashing.fit(np.clip(sample, -1e150, 1e150), total, k)

    def indexed(batches):
        for batch in batches:
            v = matrix(batch.column(2), dims)
            row, ids = (batch.column(n).to_numpy(zero_copy_only=False) for n in range(2))
            for table in range(TABLES):
                yield _rows(np.full(len(ids), table), hashing.buckets(v, table), row, ids, batch.column(2).cast(_ROWS_ARROW.field("v").type))

    def visiting(batches):
        for batch in batches:
            v = matrix(batch.column(2), dims)
            row, ids = (batch.column(n).to_numpy(zero_copy_only=False) for n in range(2))
            radius, vectors_ = hashing.radii(v), batch.column(2).cast(_ROWS_ARROW.field("v").type)
            for i in range(len(ids)):
                visits = [hashing.probes(v[i], radius[i], table) for table in range(TABLES)]
                slot = np.repeat(np.arange(TABLES), [len(x) for x in visits])
                same = np.full(len(slot), i)
                yield _rows(slot, np.concatenate(visits), row[same], ids[same], vectors_.take(pa.array(same)))

    parts = rows.select("row", "vec_id", "v")
    asked = parts.where(F.col("vec_id") % every == 0)
    packs = _packed(parts.mapInArrow(indexed, _ROWS), dims, PACK, "packs")
    visits = _packed(asked.mapInArrow(visiting, _ROWS), dims, QUERIES, "visits")
    schema = "q_row long, query_id long, row long, vec_id long, score double"
    names = [c.split()[0] for c in schema.split(", ")]

    def compared(bounded: bool):
        def compare(batches):
            for line in _each(batches):
                q, c = pickle.loads(line["visits"]), pickle.loads(line["data"])
                radius = hashing.radii(q[2]) * (1 + 1e-9) if bounded else np.full(len(q[0]), np.inf)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in _nearest(q, c, radius, k)], names=names)

        return compare

    # packs meet by number, each pair a row, so that a crowded bucket is no one task's work
    meetings = visits.select(F.col("pack").alias("visit"), "slot", "bucket").join(packs.select("pack", "slot", "bucket"), ["slot", "bucket"]).select("visit", "pack")
    meetings = meetings.join(visits.select(F.col("pack").alias("visit"), F.col("data").alias("visits")), "visit")
    meetings = meetings.join(packs.select("pack", "data"), "pack").select("visits", "data")
    hits = written(meetings.mapInArrow(compared(True), schema), "hits")

    counts = hits.groupBy("q_row").agg(F.countDistinct("row").alias("n"))
    few = written(asked.join(counts, asked["row"] == counts["q_row"], "left").where(f"coalesce(n, 0) < {k}").select("row", "vec_id", "v"), "few")
    if not few.isEmpty():
        groups = max(1, -(-total // (PACK * 16)))
        short = few.select(F.lit(0).alias("slot"), F.pmod(F.xxhash64("row"), F.lit(-(-few.count() // QUERIES))).alias("bucket"), "row", "vec_id", "v")
        short = _packed(short, dims, QUERIES, "few_packs").select(F.col("data").alias("visits"), F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("g"))
        whole = packs.where("slot = 0").select("data", F.pmod(F.xxhash64("pack"), F.lit(groups)).cast("int").alias("g"))
        hits = hits.union(short.join(whole, "g").select("visits", "data").mapInArrow(compared(False), schema))

    nearest_first = Window.partitionBy("q_row").orderBy("score", "vec_id", "row")
    # a row comes once per table at most, and once more from the search of all packs
    close = hits.withColumn("place", F.row_number().over(nearest_first)).where(F.col("place") <= k * (TABLES + 1))
    fresh = close.withColumn("before", F.lag("row").over(nearest_first)).where("before IS NULL OR before != row")
    ranked = fresh.withColumn("rank", F.row_number().over(nearest_first)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
