"""Blocks of vectors in order, exact integer scores, and the walk of query blocks along candidate blocks.

A block is one row: arrays of up to a fixed number of vectors, pickled. Blocks are
cut by rank in a total order, so their size depends neither on the number of
partitions nor on how often an id or a vector occurs.

Integer vectors are kept as doubles without fraction. Their scores come from a
matrix product where every partial sum stays within 53 bits, and from Python
integers where it may not: they are exact at any magnitude.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamis.llm.scratch import drop, written

_EXACT = float(1 << 53)
_LONG = (1 << 63) - 1
_BLOCK_ARROW = pa.schema([("block", pa.int64()), ("length", pa.float64()), ("data", pa.binary())])


# --- rows and blocks -------------------------------------------------------------


def usable(vectors: DataFrame, id_column: str, vector_column: str, *more: Column) -> DataFrame:
    """Rows (vec_id, v array<double>, more) whose id, vector and components are neither NULL nor non-finite."""
    rows = vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).cast("array<double>").alias("v"), *more)
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return rows.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & F.forall("v", finite))


def drawn(rows: DataFrame, total: int, n: int) -> DataFrame:
    """Some `n` of `total` rows by hash, all if there are fewer; tasks send a quarter more than these at most, not `n` each."""
    marked = rows.withColumn("_mark", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1 << 52)))
    few = marked.where(F.col("_mark") < F.lit(int((1 << 52) * min(1.0, 1.25 * n / max(1, total)))))
    return few.orderBy("_mark").limit(n).drop("_mark")


def matrix(column: pa.ChunkedArray, dims: int) -> np.ndarray:
    """Vectors as rows of `dims` doubles, shorter ones filled up with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(lengths), dims))
    out[np.arange(dims) < lengths[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def blocks_in_order(rows: DataFrame, order: list[Column], size: int, pack: Callable[[pa.Table], tuple[float, object]], name: str) -> DataFrame:
    """Rows in blocks of `size` by rank: `block`, and the `length` and `data` that `pack` makes of the rows.

    The order should hold every column that makes rows differ; equal rows are
    told apart by where they are stored, so that a group of them fills many blocks.
    """
    keyed = rows.withColumn("_stored", F.monotonically_increasing_id())
    order = [*order, F.col("_stored")]
    placed = keyed.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    placed = written(placed.drop("_stored"), f"{name}_sorted")
    part = F.shiftrightunsigned("_at", 33)
    sizes = sorted((r["part"], r["n"]) for r in placed.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect())
    starts = np.cumsum([0, *[n for _, n in sizes]])[:-1].tolist()
    # one row per partition of the sort
    bases = rows.sparkSession.createDataFrame([(p, b) for (p, _), b in zip(sizes, starts, strict=True)], "_part long, _base long")
    rank = F.col("_base") + F.col("_at").bitwiseAND((1 << 33) - 1)
    dealt = placed.withColumn("_part", part).join(F.broadcast(bases), "_part").withColumn("block", F.floor(rank / size)).withColumn("_rank", rank)

    def packed(table: pa.Table) -> pa.Table:
        length, data = pack(table.sort_by("_rank"))
        block = table.column("block")[0].as_py()
        return pa.Table.from_pylist([{"block": block, "length": length, "data": pickle.dumps(data)}], _BLOCK_ARROW)

    found = written(dealt.groupBy("block").applyInArrow(packed, "block long, length double, data binary"), name)
    drop(placed)
    return found


# --- exact scores ------------------------------------------------------------------


def _integers(a: np.ndarray) -> np.ndarray:
    out = np.empty(a.shape, object)
    out.ravel()[:] = [int(x) for x in a.ravel().tolist()]
    return out


def fits(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether all scores of two blocks are exact in doubles."""
    return not a.size or not b.size or bool(a.shape[1] * float(np.abs(a).max()) * float(np.abs(b).max()) <= _EXACT)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All scores of two blocks: exact doubles, or Python integers where those don't suffice."""
    if fits(a, b):
        return a @ b.T
    limit = np.sqrt(_EXACT / a.shape[1])
    wide_a, wide_b = np.abs(a).max(axis=1) > limit, np.abs(b).max(axis=1) > limit
    out = np.empty((len(a), len(b)), object)
    out[np.ix_(~wide_a, ~wide_b)] = _integers(a[~wide_a] @ b[~wide_b].T)
    whole_b = _integers(b)
    if wide_a.any():
        out[wide_a] = _integers(a[wide_a]) @ whole_b.T
    if wide_b.any() and not wide_a.all():
        out[np.ix_(~wide_a, wide_b)] = _integers(a[~wide_a]) @ whole_b[wide_b].T
    return out


def integral(scores: np.ndarray) -> np.ndarray:
    """Scores as integers, ready to be compared and multiplied by 100."""
    return scores if scores.dtype == object else scores.astype(np.int64)


def as_long(scores: np.ndarray) -> np.ndarray:
    """Scores as 64-bit integers; one beyond them becomes the nearest."""
    if scores.dtype != object:
        return scores.astype(np.int64)
    return np.array([max(-_LONG - 1, min(_LONG, int(s))) for s in scores.tolist()], np.int64)


def best_of(rows: np.ndarray, scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the first k of each row: higher scores first, then smaller ids."""
    if scores.dtype == object:
        key = sorted(range(len(rows)), key=lambda i: (rows[i], -scores[i], ids[i]))
        order = np.array(key, np.int64)
    else:
        order = np.lexsort((ids, -scores, rows))
    rank = np.arange(len(order)) - np.searchsorted(rows[order], rows[order])
    return order[rank < k]


def kth(rows: np.ndarray, scores: np.ndarray, n: int, k: int) -> np.ndarray:
    """By row the k-th best of scores that `best_of` has put in order, as doubles; -inf with fewer."""
    out = np.full(n, -np.inf)
    last = np.flatnonzero(np.arange(len(rows)) - np.searchsorted(rows, rows) == k - 1)
    out[rows[last]] = [_double(s) for s in scores[last].tolist()]
    return out


def _double(score: int) -> float:
    """The score, or for one beyond all doubles a bound under it."""
    try:
        return float(score)
    except OverflowError:
        return np.finfo(float).max if score > 0 else -np.inf


# --- the walk ----------------------------------------------------------------------


def _each(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def walk(queries: DataFrame, blocks: DataFrame, meet: Callable, merge: Callable, need: Callable, first: int = 1, factor: int = 4) -> DataFrame:
    """Let every query block meet the candidate blocks in order, in waves that grow by `factor`.

    queries has `block` and `data`, blocks `block`, `length` (falling) and `data`. In a
    wave `meet(state, data)` gives what one pair finds, one row for each pair;
    `merge(state, [found, ...])` streams over what a query block has found and gives
    its new state. A state takes part in a wave while `need(state)`, the least length
    that can still change it, isn't above the wave's longest. Each wave is written.
    """
    ends = blocks.agg(F.max("block")).first()[0]
    state_schema = "block long, need double, data binary"
    arrow = pa.schema([("block", pa.int64()), ("need", pa.float64()), ("data", pa.binary())])

    def opened(batches):
        for row in _each(batches):
            yield pa.RecordBatch.from_pylist([{"block": row["block"], "need": need(pickle.loads(row["data"])), "data": row["data"]}], arrow)

    now = written(queries.select("block", "data").mapInArrow(opened, state_schema), "states")
    if ends is None:
        return now

    def met(batches):
        for row in _each(batches):
            found = meet(pickle.loads(row["state"]), pickle.loads(row["data"]))
            if found is not None:
                yield pa.RecordBatch.from_pylist([{"block": row["q_block"], "need": None, "data": pickle.dumps(found)}], arrow)

    def merged(batches):
        block, state = None, None

        def closed():
            return pa.RecordBatch.from_pylist([{"block": block, "need": need(state), "data": pickle.dumps(state)}], arrow)

        for row in _each(batches):
            if row["need"] is not None:
                if state is not None:
                    yield closed()
                block, state = row["block"], pickle.loads(row["data"])
            else:
                state = merge(state, pickle.loads(row["data"]))
        if state is not None:
            yield closed()

    tasks = 4 * max(1, queries.sparkSession.sparkContext.defaultParallelism)
    low, many = 0, first
    while low <= ends:
        high = min(ends, low + many - 1)
        wave = blocks.where(F.col("block").between(low, high))
        longest = wave.agg(F.max("length")).first()[0]
        if now.where(F.col("need") <= longest).isEmpty():
            break
        group = max(1, (high - low + 1) // tasks)
        groups = F.explode(F.sequence(F.lit(0), F.lit((high - low) // group)))
        asked = now.where(F.col("need") <= longest).select(F.col("block").alias("q_block"), F.col("data").alias("state"), groups.alias("group"))
        # the size of the files says little of packed blocks and nothing of their copies by group: never broadcast them
        pairs = asked.hint("merge").join(wave.select("data", F.floor((F.col("block") - low) / group).cast("int").alias("group")), "group")
        both = now.unionByName(pairs.select("q_block", "state", "data").mapInArrow(met, state_schema))
        before, now = now, written(both.repartition("block").sortWithinPartitions("block", F.col("need").isNull()).mapInArrow(merged, state_schema), "states")
        drop(before)
        low, many = high + 1, many * factor
    return now
