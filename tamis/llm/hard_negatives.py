"""Hard negatives by rotated one-bit codes: popcount estimates, Cauchy-Schwarz intervals, integer scores.

Each integer vector x is turned by a fixed random rotation and stored as its signs c
(scaled to length 1), its alignment a = <x, c> and the length of the rest, e = x - a c.
An anchor q, rotated too, is cut to `PLANES` bits a component, so <q', c> is a sum of
popcounts of its bit planes and the code, and |q - q'| is known. Then

    <q, x> = a <q', c> + a <q - q', c> + <q, e>

and, as e is orthogonal to c, the last two terms lie within a |q - q'| and
sqrt(|q|^2 - <q, c>^2) |e|: an interval that holds the score for certain. Pairs whose
interval misses what is still asked for are dropped, all others are scored in integers.

Two walks of anchor blocks along all blocks, longest vectors first (see `vectors`):
the first finds each anchor's positives, with the running last one as its floor; the
second the negatives of each positive, between a share of its score and the score.
What is kept of a block's finds is bounded by anchors x positives x negatives.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamis.llm.scratch import written
from tamis.llm.vectors import _each, as_long, best_of, blocks_in_order, fits, integral, kth, matrix, products, usable, walk

BLOCK, ANCHORS, PLANES = 4096, 512, 8
_SPARSE = 0.05


class Codes:
    """One-bit codes of vectors of `dims` components."""

    def __init__(self, dims: int):
        self.dims, self.words = dims, -(-dims // 64)
        rng = np.random.default_rng(11)
        self.rotation = np.linalg.qr(rng.standard_normal((dims, dims)))[0] if dims else np.zeros((0, 0))

    def _packed(self, bits: np.ndarray) -> np.ndarray:
        lanes = np.zeros((len(bits), 64 * self.words), np.uint8)
        lanes[:, : self.dims] = bits
        return np.packbits(lanes, axis=1).view(np.uint64)

    def stored(self, x: np.ndarray) -> dict[str, np.ndarray]:
        """Codes, alignments and lengths of the rests."""
        r = x @ self.rotation
        align = np.abs(r).sum(axis=1) / np.sqrt(max(1, self.dims))
        length = np.linalg.norm(r, axis=1)
        rest = np.sqrt(np.maximum(0, (length - align) * (length + align)))
        return {"code": self._packed(r >= 0), "align": align, "rest": rest, "length": length}

    def interval(self, q: np.ndarray, s: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Middle and half width of an interval that holds each score of anchors and stored vectors."""
        r = q @ self.rotation
        low = r.min(axis=1, initial=0)
        step = np.maximum((r.max(axis=1, initial=0) - low) / ((1 << PLANES) - 1), 1e-300)
        level = np.clip(np.rint((r - low[:, None]) / step[:, None]), 0, (1 << PLANES) - 1).astype(np.uint8)
        cut = low[:, None] + step[:, None] * level
        lost, length = np.linalg.norm(r - cut, axis=1), np.linalg.norm(r, axis=1)
        ones = np.bitwise_count(s["code"]).sum(axis=1, dtype=np.int64)
        count = np.zeros((len(q), len(ones)), np.float64)
        for plane in range(PLANES):
            bits, seen = self._packed(level >> plane & 1), np.zeros(count.shape, np.uint16)
            for w in range(self.words):
                seen += np.bitwise_count(bits[:, w, None] & s["code"][None, :, w])
            count += float(1 << plane) * seen
        along = 2 * (low[:, None] * ones + step[:, None] * count) - cut.sum(axis=1)[:, None]
        along /= np.sqrt(max(1, self.dims))
        least = np.maximum(0, np.abs(along) - lost[:, None])
        across = np.sqrt(np.maximum(0, length[:, None] ** 2 - least**2))
        half = s["align"] * lost[:, None] + across * s["rest"] + 1e-9 * length[:, None] * s["length"] + 1e-6
        return s["align"] * along, half


class _Miner:
    def __init__(self, codes: Codes, positives: int, negatives: int, least: int, most: int):
        self.codes, self.positives, self.negatives, self.least, self.most = codes, positives, negatives, least, most

    def scored(self, state: dict, block: dict, wanted: np.ndarray, low: np.ndarray, high: np.ndarray):
        """Rows, places and integer scores of wanted pairs whose interval meets [low, high]; some beside it may come along."""
        q, c = state["q"], block["v"]
        if fits(q, c):
            middle, half = self.codes.interval(q, block)
            wanted = wanted & (middle + half >= low[:, None]) & (middle - half <= high[:, None])
            if np.count_nonzero(wanted) <= _SPARSE * wanted.size:
                a, b = np.nonzero(wanted)
                return a, b, integral(np.einsum("ij,ij->i", q[a], c[b]))
        score = products(q, c)
        a, b = np.nonzero(wanted & (score >= low[:, None]) & (score <= high[:, None]))
        return a, b, integral(score[a, b])

    # --- positives

    def meet_positives(self, state: dict, block: dict):
        wanted = (state["label"][:, None] == block["label"]) & (state["ids"][:, None] != block["ids"])
        if not wanted.any():
            return None
        a, b, score = self.scored(state, block, wanted, state["floor"], np.full(len(state["ids"]), np.inf))
        top = best_of(a, score, block["ids"][b], self.positives)
        return (a[top], block["ids"][b[top]], score[top]) if len(top) else None

    def merge_positives(self, state: dict, found: tuple) -> dict:
        row, ids, score = (np.concatenate([state[n], f]) for n, f in zip(("row", "positive", "score"), found, strict=True))
        top = best_of(row, score, ids, self.positives)
        state |= {"row": row[top], "positive": ids[top], "score": score[top]}
        state["floor"] = kth(state["row"], state["score"], len(state["ids"]), self.positives)
        return state

    def need_positives(self, state: dict) -> float:
        return self._need(state, state["floor"])

    def _need(self, state: dict, floor: np.ndarray) -> float:
        """The least length with which a vector can reach the floor of any anchor."""
        lengths = np.linalg.norm(state["q"], axis=1) * (1 + 1e-9) + 1e-9
        with np.errstate(invalid="ignore"):
            need = np.where(np.isneginf(floor), -np.inf, (floor - 1e-6) / lengths)
        return float(np.nan_to_num(need, nan=-np.inf, posinf=np.inf, neginf=-np.inf).min(initial=np.inf))

    # --- negatives

    def asks(self, state: dict) -> dict:
        """Windows of scores for the negatives of each positive, by anchor the widest."""
        n, none = len(state["ids"]), np.empty(0, np.int64)
        state |= {"n_row": none, "negative": none, "n_score": none}
        state["bar"] = np.full(len(state["row"]), -np.inf)
        return self._windows(state | {"n": n})

    def _windows(self, state: dict) -> dict:
        low, high = np.full(state["n"], np.inf), np.full(state["n"], -np.inf)
        share = np.array([self._double(self.least, s) for s in state["score"].tolist()])
        np.minimum.at(low, state["row"], np.maximum(share, state["bar"]))
        np.maximum.at(high, state["row"], np.array([self._double(self.most, s) for s in state["score"].tolist()]))
        return state | {"low": low, "high": high}

    @staticmethod
    def _double(percent: int, score: int) -> float:
        """percent * score / 100 with room for rounding, downwards for the lower bound and upwards for the upper one."""
        try:
            x = percent * int(score) / 100
        except OverflowError:
            return np.inf if percent * score > 0 and percent >= 100 else np.finfo(float).max * (0.5 if score > 0 else -1)
        return x + (abs(x) * 1e-12 + 1e-6) * (1 if percent >= 100 else -1)

    def meet_negatives(self, state: dict, block: dict):
        if not len(state["row"]):
            return None
        wanted = (state["label"][:, None] != block["label"]) & (state["ids"][:, None] != block["ids"])
        a, b, score = self.scored(state, block, wanted, state["low"], state["high"])
        order = np.argsort(a, kind="stable")
        a, b, score = a[order], b[order], score[order]
        begin, end = np.searchsorted(a, state["row"]), np.searchsorted(a, state["row"], side="right")
        rows, found, scores = [], [], []
        for pair, (x, y, s, bar) in enumerate(zip(begin.tolist(), end.tolist(), state["score"].tolist(), state["bar"].tolist(), strict=True)):
            near = score[x:y]
            fit = np.flatnonzero((100 * near >= self.least * s) & (100 * near <= self.most * s) & (near >= bar)) + x
            ids = block["ids"][b[fit]]
            top = best_of(np.zeros(len(fit), np.int64), score[fit], ids, self.negatives)
            rows.append(np.full(len(top), pair))
            found.append(ids[top])
            scores.append(score[fit][top])
        row = np.concatenate(rows)
        return (row, np.concatenate(found), np.concatenate(scores)) if len(row) else None

    def merge_negatives(self, state: dict, found: tuple) -> dict:
        row, ids, score = (np.concatenate([state[n], f]) for n, f in zip(("n_row", "negative", "n_score"), found, strict=True))
        top = best_of(row, score, ids, self.negatives)
        state |= {"n_row": row[top], "negative": ids[top], "n_score": score[top]}
        state["bar"] = kth(state["n_row"], state["n_score"], len(state["row"]), self.negatives)
        return self._windows(state)

    def need_negatives(self, state: dict) -> float:
        return self._need(state, np.where(np.isposinf(state["low"]), np.inf, state["low"]))


def mine(
    vectors: DataFrame,
    every: int,
    *,
    positives: int = 5,
    negatives: int = 5,
    least: int = 80,
    most: int = 100,
    scale: float = 256.0,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label: Column | str = "label",
) -> DataFrame:
    """For each anchor (id divisible by `every`) and each of its `positives`, the first `negatives` of another label whose score lies within `least` to `most` percent of the positive's.

    The score is the inner product of the vectors' floor(scale * x), exact at any
    magnitude; one beyond 64 bits ranks by its true value and is returned as the
    nearest long. Higher scores come first, ties by smaller id. A positive without such
    negatives has no row: `anchor_id`, `positive_id`, `rank`, `negative_id`,
    `positive_score`, `negative_score`.

    Rows with a NULL id, label or vector, or a NULL or non-finite component (also
    once scaled) take no part. Rows that share an anchor's id count as its own; repeated
    anchors are answered one by one, repeated positives and negatives count one by
    one. Of vectors of different lengths the shorter counts as filled up with zeros; one
    without components scores 0. `label` may be an expression; further columns are
    ignored. An empty table gives an empty result.
    """
    label = F.col(label) if isinstance(label, str) else label
    rows = usable(vectors, id_column, vector_column, label.cast("long").alias("kind")).where("kind IS NOT NULL")
    rows = rows.withColumn("v", F.transform("v", lambda x: F.lit(float(scale)) * x)).where(F.forall("v", lambda x: F.abs(x) != float("inf")))
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + F.floor(x).cast("double") * F.floor(x).cast("double")))
    rows = written(rows.withColumn("length", length), "vectors")
    codes = Codes(rows.agg(F.max(F.size("v"))).first()[0] or 0)
    miner = _Miner(codes, positives, negatives, least, most)

    def stored(table: pa.Table):
        v = np.floor(matrix(table.column("v"), codes.dims))
        block = {"ids": table.column("vec_id").to_numpy(), "label": table.column("kind").to_numpy(), "v": v} | codes.stored(v)
        return float(block["length"].max(initial=0)), block

    def anchors(table: pa.Table):
        ids, v, none = table.column("vec_id").to_numpy(), np.floor(matrix(table.column("v"), codes.dims)), np.empty(0, np.int64)
        state = {"ids": ids, "label": table.column("kind").to_numpy(), "q": v, "row": none, "positive": none, "score": none}
        return 0.0, state | {"floor": np.full(len(ids), -np.inf)}

    order = [F.desc("length"), F.xxhash64("vec_id")]
    blocks = blocks_in_order(rows, order, BLOCK, stored, "blocks")
    asked = blocks_in_order(rows.where(F.col("vec_id") % every == 0), order, ANCHORS, anchors, "anchors")
    matched = walk(asked, blocks, miner.meet_positives, miner.merge_positives, miner.need_positives)

    def opened(batches):
        for line in _each(batches):
            state = miner.asks(pickle.loads(line["data"]))
            yield pa.RecordBatch.from_pylist([{"block": line["block"], "data": pickle.dumps(state)}], pa.schema([("block", pa.int64()), ("data", pa.binary())]))

    opened_states = matched.select("block", "data").mapInArrow(opened, "block long, data binary")
    done = walk(opened_states, blocks, miner.meet_negatives, miner.merge_negatives, miner.need_negatives)
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"

    def ranked(batches):
        for line in _each(batches):
            s = pickle.loads(line["data"])
            rank = (np.arange(len(s["n_row"])) - np.searchsorted(s["n_row"], s["n_row"]) + 1).astype(np.int32)
            pair = s["n_row"]
            columns = [s["ids"][s["row"][pair]], s["positive"][pair], rank, s["negative"], as_long(s["score"][pair]), as_long(s["n_score"])]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=[c.split()[0] for c in schema.split(", ")])

    return done.select("data").mapInArrow(ranked, schema)
