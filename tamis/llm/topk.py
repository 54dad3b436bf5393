"""Exact top-k by inner product: vectors by descending length, rotated partial sums, Cauchy-Schwarz bounds.

1. Components become integers, floor(scale * x). Vectors are sorted by length,
   descending, into blocks of a fixed number; a rotation from the singular vectors of a
   bounded sample puts most of the weight into the leading coordinates.
2. Blocks of queries walk along the candidate blocks, longest vectors first, in growing
   waves. After each wave a query's floor is its k-th best score so far. A query block
   stops where no query of it has a floor under its length times the longest left.
3. Where two blocks meet, partial sums over a prefix of the rotated coordinates, plus
   the product of the lengths of the rests, drop pairs that can't reach the floor; the
   rest is scored exactly, in integers.

The rotation only decides what is skipped, with a margin for rounding: results
do not depend on it.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamis.llm.scratch import written
from tamis.llm.vectors import _each, as_long, best_of, blocks_in_order, drawn, fits, integral, kth, matrix, products, usable, walk

SAMPLE_ROWS, BLOCK, QUERIES = 4096, 4096, 1024
_STEPS = (0.25, 0.5)
_SPARSE = 0.05


class _Search:
    """Scores one block of queries against one of candidates."""

    def __init__(self, rotation: np.ndarray, k: int):
        self.rotation, self.k = rotation, k
        self.cuts = sorted({max(1, int(len(rotation) * s)) for s in _STEPS}) if len(rotation) else []

    def hits(self, q: np.ndarray, ids: np.ndarray, floor: np.ndarray, c: np.ndarray, c_ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows of queries, ids and exact scores of the best k candidates that reach the floor."""
        length_q, length_c = np.linalg.norm(q, axis=1), np.linalg.norm(c, axis=1)
        with np.errstate(invalid="ignore", over="ignore"):
            live = np.flatnonzero(~(length_q * length_c.max(initial=0) * (1 + 1e-9) + 1e-6 < floor))
        pairs = self._few(q[live], floor[live], c, length_q[live], length_c) if len(live) and fits(q, c) else None
        if pairs is None:
            score = products(q[live], c)
            own = ids[live][:, None] == c_ids[None, :]
            keep = (score >= floor[live][:, None]) & ~own
            if score.dtype != object and keep.sum() > 4 * self.k * len(live) and score.shape[1] > self.k:
                score[own] = -np.inf
                keep &= score >= np.partition(score, -self.k, axis=1)[:, [-self.k]]
            a, b = np.nonzero(keep)
            score = integral(score[a, b])
        else:
            a, b = pairs
            score = integral(np.einsum("ij,ij->i", q[live][a], c[b]))
            keep = (score >= floor[live][a]) & (ids[live][a] != c_ids[b])
            a, b, score = a[keep], b[keep], score[keep]
        top = best_of(a, score, c_ids[b], self.k)
        return live[a[top]], c_ids[b[top]], score[top]

    def _few(self, q, floor, c, length_q, length_c):
        """Pairs that may reach the floor, if the bounds leave few of them."""
        rq, rc = q @ self.rotation, c @ self.rotation
        margin = 1e-9 * length_q[:, None] * length_c[None, :] + 1e-6
        for cut in self.cuts:
            bound = rq[:, :cut] @ rc[:, :cut].T
            bound += np.linalg.norm(rq[:, cut:], axis=1)[:, None] * np.linalg.norm(rc[:, cut:], axis=1)[None, :]
            keep = bound + margin >= floor[:, None]
            if np.count_nonzero(keep) <= _SPARSE * keep.size:
                return np.nonzero(keep)
        return None

    def meet(self, state: dict, block: tuple):
        row, ids, score = self.hits(state["q"], state["ids"], state["floor"], block[1], block[0])
        return (row, ids, score) if len(row) else None

    def merge(self, state: dict, found: tuple) -> dict:
        row, ids, score = (np.concatenate([state[n], f]) for n, f in zip(("row", "found", "score"), found, strict=True))
        top = best_of(row, score, ids, self.k)
        state |= {"row": row[top], "found": ids[top], "score": score[top]}
        state["floor"] = kth(state["row"], state["score"], len(state["ids"]), self.k)
        return state

    def need(self, state: dict) -> float:
        """The least length with which a candidate can reach the floor of any query."""
        if np.isneginf(state["floor"]).any():
            return -np.inf
        lengths = np.linalg.norm(state["q"], axis=1) * (1 + 1e-9) + 1e-9
        return float(((state["floor"] - 1e-6) / lengths).min(initial=np.inf))


def _rotation(sample: np.ndarray) -> np.ndarray:
    """The right singular vectors of a sample, the greatest first, in memory of a square of its components only."""
    if not sample.shape[1]:
        return np.zeros((0, 0))
    sample = sample / np.maximum(1, np.abs(sample).max(initial=0))
    return np.ascontiguousarray(np.linalg.eigh(sample.T @ sample)[1][:, ::-1])


def top_k(
    vectors: DataFrame, every: int, k: int = 20, scale: float = 64.0, id_column: str = "vec_id", vector_column: str = "embedding"
) -> DataFrame:
    """For each vector whose id is divisible by `every`, the k others with the highest scores: `query_id`, `rank`, `vec_id`, `score`.

    The score is the inner product of the vectors' floor(scale * x), exact at any
    magnitude; one beyond 64 bits ranks by its true value and is returned as the
    nearest long. Equal scores go by smaller id; fewer than k candidates are all returned.

    Rows with a NULL id, a NULL vector, or a NULL or non-finite component (also
    once scaled) take no part. Rows that share a query's id count as the query's own;
    repeated query rows are answered one by one. Of vectors of different lengths the
    shorter counts as filled up with zeros; one without components scores 0. Further
    columns are ignored. An empty table gives an empty result.
    """
    rows = usable(vectors, id_column, vector_column)
    rows = rows.withColumn("v", F.transform("v", lambda x: F.lit(float(scale)) * x)).where(F.forall("v", lambda x: F.abs(x) != float("inf")))
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + F.floor(x).cast("double") * F.floor(x).cast("double")))
    rows = written(rows.withColumn("length", length), "vectors")
    total, dims = rows.agg(F.count("*"), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
    some = drawn(rows.select("v"), total, SAMPLE_ROWS).collect()  # bounded
    sample = np.zeros((max(1, len(some)), dims))
    for i, r in enumerate(some):
        sample[i, : len(r["v"])] = np.floor(r["v"])
    search = _Search(_rotation(sample), k)

    def candidates(table: pa.Table):
        c = np.floor(matrix(table.column("v"), dims))
        return float(np.linalg.norm(c, axis=1).max(initial=0)), (table.column("vec_id").to_numpy(), c)

    def questions(table: pa.Table):
        top, (ids, q) = candidates(table)
        none = {"row": np.empty(0, np.int64), "found": np.empty(0, np.int64), "score": np.empty(0, np.int64)}
        return top, {"ids": ids, "q": q, "floor": np.full(len(ids), -np.inf)} | none

    order = [F.desc("length"), F.xxhash64("vec_id")]
    blocks = blocks_in_order(rows, order, BLOCK, candidates, "blocks")
    asked = blocks_in_order(rows.where(F.col("vec_id") % every == 0), order, QUERIES, questions, "queries")
    states = walk(asked, blocks, search.meet, search.merge, search.need)

    def ranked(batches):
        for line in _each(batches):
            s = pickle.loads(line["data"])
            rank = np.arange(len(s["row"])) - np.searchsorted(s["row"], s["row"]) + 1
            columns = [s["ids"][s["row"]], rank.astype(np.int32), s["found"], as_long(s["score"])]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["query_id", "rank", "vec_id", "score"])

    return states.select("data").mapInArrow(ranked, "query_id long, rank int, vec_id long, score long")
