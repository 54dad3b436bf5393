"""Toxicity by a small bidirectional gated recurrent network with attention pooling, in numpy.

A word enters as a trained vector of its hash and the maximum, by dimension, of
trained vectors of its character 3- to 7-grams (in UTF-8). Forward and backward GRUs run over windows of `WIDTH`
words, every `STRIDE` words; attention pools the states of a window into a
logit. A document takes its highest window, mapped to a probability by a logistic
fit. Training takes at most `SAMPLE_DOCS` documents of each label (a documented
bound), counts word odds over their whole texts, and of longer ones trains with
`SAMPLE_WINDOWS` windows, the strongest and others from all over the text; scoring takes
all windows of all texts. A toxic document need not be toxic throughout: it trains with its
highest window only, found first by word odds, later by the network itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamis.llm.arrays import concat, mix, spread, window_hashes, word_bounds, word_hashes
from tamis.llm.scratch import written

SAMPLE_DOCS, SAMPLE_WINDOWS = 1500, 48
WIDTH, STRIDE = 32, 16
WORDS, GRAMS, SPANS = 1 << 15, 1 << 17, range(3, 8)
EPOCHS, BATCH = 8, 256
DECISION = 0.3

_EW, _EG, _H, _A = 8, 4, 8, 8
_PIECE = 4 << 20
_NOT_WORD = np.ones(256, bool)
_NOT_WORD[[*range(ord("a"), ord("z") + 1), *range(ord("A"), ord("Z") + 1), *range(ord("0"), ord("9") + 1), *range(128, 256)]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


@dataclass
class Words:
    """The words of some texts: each as an index into the distinct ones, and where each text begins."""

    index: np.ndarray
    at: np.ndarray
    buckets: np.ndarray
    grams: np.ndarray
    gram_at: np.ndarray


def split_words(texts: list[bytes]) -> Words:
    """Runs of letters, digits and bytes above 127, with A-Z lower-cased."""
    data, bounds = concat(texts)
    starts, ends = word_bounds(data, bounds[:-1], _NOT_WORD)
    hashes = word_hashes(data, starts, ends, lower=True)
    values, first, index = np.unique(hashes, return_index=True, return_inverse=True)
    sizes = ends[first] - starts[first]
    # each distinct word once, after a mark; its n-grams, longest last, up to the end of the word
    length = sizes + 1
    begin = np.cumsum(length) - length
    spelt = np.full(int(length.sum()), ord("_"), np.uint8)
    spelt[spread(begin + 1, sizes)] = _LOWER[data[spread(starts[first], sizes)]]
    symbols, parts, owners = mix(spelt.astype(np.uint64)), [], []
    for n in SPANS:
        many = np.maximum(length - n + 1, 1 if n == SPANS[0] else 0)
        hashed = np.concatenate([window_hashes(symbols, n), np.zeros(n, np.uint64)])
        parts.append((hashed[spread(begin, many)] % np.uint64(GRAMS)).astype(np.int32))
        owners.append(np.repeat(np.arange(len(sizes), dtype=np.int32), many))
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    grams = np.concatenate(parts)[order]
    gram_at = np.searchsorted(owner[order], np.arange(len(sizes) + 1))
    return Words(index, np.searchsorted(starts, bounds), (values % np.uint64(WORDS)).astype(np.int64), grams, gram_at)


def _per_word(values: np.ndarray, words: Words) -> np.ndarray:
    """The maximum over the n-grams of each distinct word."""
    return np.maximum.reduceat(values, words.gram_at[:-1], axis=0) if len(words.buckets) else values[:0]


def windows(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """For each window its text and its words (-1 past the end); a text without words has one empty window."""
    sizes = np.diff(words.at)
    many = 1 + np.maximum(0, -(-(sizes - WIDTH) // STRIDE))
    doc = np.repeat(np.arange(len(sizes)), many)
    start = (np.arange(len(doc)) - np.repeat(np.cumsum(many) - many, many)) * STRIDE
    place = start[:, None] + np.arange(WIDTH)
    real = place < sizes[doc][:, None]
    return doc, np.where(real, words.at[doc][:, None] + place, -1)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


@dataclass
class Network:
    """Parameters by name; `forward` keeps what `backward` needs when asked to."""

    p: dict[str, np.ndarray] = field(default_factory=dict)

    @classmethod
    def fresh(cls, odds: np.ndarray, gram_odds: np.ndarray) -> Network:
        """Small random parameters; the first dimension of words and n-grams starts at their log odds."""
        rng = np.random.default_rng(5)
        wide = lambda *s: (rng.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
        p = {"word": (0.1 * rng.standard_normal((WORDS + 1, _EW))).astype(np.float32)}
        p["word"][:, 0] = odds / 2
        p["word"][WORDS] = 0
        p["gram"] = (0.1 * rng.standard_normal((GRAMS, _EG))).astype(np.float32)
        p["gram"][:, 0] = gram_odds / 2
        for d in "fb":
            p |= {f"x{d}": wide(_EW + _EG, 3 * _H), f"h{d}": wide(_H, 3 * _H), f"c{d}": np.zeros(3 * _H, np.float32)}
        p |= {"a": wide(2 * _H, _A), "v": wide(_A), "o": wide(2 * _H), "bias": np.zeros(1, np.float32)}
        return cls(p)

    def inputs(self, words: Words) -> np.ndarray:
        """A row for each distinct word, then one of zeros for places past the end."""
        best = _per_word(self.p["gram"][words.grams], words)
        return np.vstack([np.hstack([self.p["word"][words.buckets], best]), np.zeros((1, _EW + _EG))]).astype(np.float32)

    def states(self, x: np.ndarray, place: np.ndarray, d: str, keep: list | None = None) -> np.ndarray:
        """The states of one direction over (windows, WIDTH) places into the projected rows x."""
        h, out, u = np.zeros((len(place), _H), np.float32), np.empty((WIDTH, len(place), _H), np.float32), self.p[f"h{d}"]
        for t in range(WIDTH) if d == "f" else range(WIDTH - 1, -1, -1):
            row, back = x[place[:, t]], h @ u
            zr = _sigmoid(row[:, : 2 * _H] + back[:, : 2 * _H])
            z, r = zr[:, :_H], zr[:, _H:]
            n = np.tanh(row[:, 2 * _H :] + r * back[:, 2 * _H :])
            if keep is not None:
                keep.append((t, h, z, r, n, back[:, 2 * _H :]))
            real = (place[:, t] != len(x) - 1)[:, None]
            h = np.where(real, n + z * (h - n), h)
            out[t] = h
        return out

    def forward(self, x: np.ndarray, place: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """The logit of each window."""
        hidden, runs = [], {}
        for d in "fb":
            projected = x @ self.p[f"x{d}"] + self.p[f"c{d}"]
            runs[d] = [] if keep is not None else None
            hidden.append(self.states(projected, place, d, runs[d]))
        both = np.concatenate(hidden, axis=2)
        seen = np.tanh(both @ self.p["a"])
        score = seen @ self.p["v"]
        score[(place == len(x) - 1).T] = -1e9
        weight = np.exp(score - score.max(axis=0))
        weight /= weight.sum(axis=0)
        pooled = np.einsum("tn,tnh->nh", weight, both)
        if keep is not None:
            keep |= {"both": both, "seen": seen, "weight": weight, "pooled": pooled, "runs": runs}
        return pooled @ self.p["o"] + self.p["bias"]

    def backward(self, x: np.ndarray, place: np.ndarray, keep: dict, slope: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray]:
        """Gradients of the dense parameters, and of the rows of x."""
        p, g = self.p, {"o": keep["pooled"].T @ slope, "bias": slope.sum(keepdims=True)}
        both, weight, seen = keep["both"], keep["weight"], keep["seen"]
        d_pooled = slope[:, None] * p["o"]
        d_both = weight[:, :, None] * d_pooled
        d_weight = np.einsum("nh,tnh->tn", d_pooled, both)
        d_score = weight * (d_weight - (weight * d_weight).sum(axis=0))
        g["v"] = np.einsum("tn,tna->a", d_score, seen)
        d_seen = d_score[:, :, None] * p["v"] * (1 - seen**2)
        g["a"] = np.einsum("tnh,tna->ha", both, d_seen)
        d_both = d_both + d_seen @ p["a"].T
        dx = np.zeros_like(x)
        for k, d in enumerate("fb"):
            part, u = d_both[:, :, k * _H : (k + 1) * _H], p[f"h{d}"]
            d_row, dh, g[f"h{d}"] = np.zeros((len(x), 3 * _H), np.float32), np.zeros((len(place), _H), np.float32), np.zeros_like(u)
            for t, before, z, r, n, back in reversed(keep["runs"][d]):
                real = (place[:, t] != len(x) - 1)[:, None]
                dh = dh + part[t]
                live = np.where(real, dh, 0)
                dn, dz = live * (1 - z) * (1 - n**2), live * (before - n) * z * (1 - z)
                dr = dn * back * r * (1 - r)
                d_gates = np.hstack([dz, dr, dn])
                d_back = np.hstack([dz, dr, dn * r])
                g[f"h{d}"] += before.T @ d_back
                np.add.at(d_row, place[:, t], d_gates)
                dh = np.where(real, live * z, dh) + d_back @ u.T
            d_row[-1] = 0
            g[f"x{d}"], g[f"c{d}"] = x.T @ d_row, d_row.sum(axis=0)
            dx += d_row @ p[f"x{d}"].T
        return g, dx


@dataclass(frozen=True)
class ToxicityModel:
    network: Network
    slope: float
    offset: float

    def scores(self, texts: list[bytes]) -> np.ndarray:
        """The probability of each text."""
        top = np.full(len(texts), -np.inf)
        for part, at in _pieces(texts):
            words = split_words(part)
            np.maximum.at(top, at, highest(self.network, words)[0])
        return 1 / (1 + np.exp(-np.clip(self.slope * top + self.offset, -50, 50)))


def _pieces(texts: list[bytes]) -> Iterator[tuple[list[bytes], np.ndarray]]:
    """Texts in portions of about `_PIECE` bytes; a longer text alone."""
    start, held = 0, 0
    for i, t in enumerate(texts):
        held += len(t)
        if held >= _PIECE or i == len(texts) - 1:
            yield texts[start : i + 1], np.arange(start, i + 1)
            start, held = i + 1, 0


def highest(network: Network, words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Of each text, the highest logit of its windows; and the logits of all windows."""
    doc, place = windows(words)
    x = network.inputs(words)
    index = np.append(words.index, len(x) - 1)
    logits = np.concatenate([network.forward(x, index[place[a : a + 8192]]) for a in range(0, len(place), 8192)])
    top = np.full(len(words.at) - 1, -np.inf)
    np.maximum.at(top, doc, logits)
    return top, logits


class _Adam:
    def __init__(self):
        self.m, self.v, self.t = {}, {}, 0

    def step(self, p: dict, g: dict, rate: float) -> None:
        self.t += 1
        for k, d in g.items():
            self.m[k] = 0.9 * self.m.get(k, 0) + 0.1 * d
            self.v[k] = 0.999 * self.v.get(k, 0) + 0.001 * d * d
            p[k] -= (rate * (self.m[k] / (1 - 0.9**self.t)) / (np.sqrt(self.v[k] / (1 - 0.999**self.t)) + 1e-8)).astype(np.float32)


def fit(texts: list[bytes], labels: np.ndarray, toxic_share: float) -> ToxicityModel:
    """Train on texts of both labels; `toxic_share` is that of all labelled rows, for the calibration."""
    words = split_words(texts)
    n = len(texts)
    odds, gram_odds = _odds(words, labels)

    doc, place = windows(words)
    place = np.append(words.index, len(words.buckets)).astype(np.int32)[place]
    strength = _strength(words, odds, gram_odds)
    network, rng = Network.fresh(odds, gram_odds), np.random.default_rng(3)
    adam, squares = _Adam(), {"word": np.full((WORDS + 1, 1), 1e-3), "gram": np.full((GRAMS, 1), 1e-3)}
    order = np.arange(len(doc))
    for epoch in range(EPOCHS):
        rank = np.lexsort((-strength, doc))
        best = rank[np.unique(doc[rank], return_index=True)[1]]
        bad = best[labels[doc[best]] > 0]
        fine = np.concatenate([best[labels[doc[best]] == 0], rng.permutation(order[labels[doc] == 0])[: 2 * n]])
        chosen = rng.permutation(np.concatenate([bad, fine]))
        for at in range(0, len(chosen), BATCH):
            part = chosen[at : at + BATCH]
            used, local = np.unique(np.append(place[part], len(words.buckets)), return_inverse=True)
            some = _subset(words, used[:-1])
            x, spots, keep = network.inputs(some), local[:-1].reshape(len(part), WIDTH), {}
            y = (labels[doc[part]] > 0).astype(np.float32)
            logit = network.forward(x, spots, keep)
            weight = np.where(y > 0, 0.5 * len(chosen) / max(1, len(bad)), 0.5 * len(chosen) / max(1, len(fine)))
            slope = ((_sigmoid(logit) - y) * weight / len(part)).astype(np.float32)
            g, dx = network.backward(x, spots, keep, slope)
            adam.step(network.p, g, 0.01)
            _sparse(network.p["word"], squares["word"], some.buckets, dx[:-1, :_EW])
            size = np.diff(some.gram_at)
            chosen_gram = network.p["gram"][some.grams] == np.repeat(x[:-1, _EW:], size, axis=0)
            _sparse(network.p["gram"], squares["gram"], some.grams, chosen_gram * np.repeat(dx[:-1, _EW:], size, axis=0))
        strength = highest(network, words)[1]
    top = np.full(n, -np.inf)
    np.maximum.at(top, doc, strength)
    return ToxicityModel(network, *_calibrated(top, labels, toxic_share))


def _counts(words: Words, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """By label and bucket of words and of n-grams, how many texts hold one."""
    size = np.diff(words.gram_at)
    tables = np.zeros((2, WORDS + 1)), np.zeros((2, GRAMS))
    for label, a, b in zip((labels > 0).astype(int).tolist(), words.at[:-1].tolist(), words.at[1:].tolist(), strict=True):
        own = np.unique(words.index[a:b])
        tables[0][label, np.unique(words.buckets[own])] += 1
        tables[1][label, np.unique(words.grams[spread(words.gram_at[own], size[own])])] += 1
    return tables


def _log_odds(without: np.ndarray, with_it: np.ndarray, n_fine: int, n_toxic: int) -> np.ndarray:
    """By bucket, how much likelier toxic texts hold one than others; 0 without several texts to show it."""
    found = np.log((with_it + 1) / (max(1, n_toxic) + 2)) - np.log((without + 1) / (max(1, n_fine) + 2))
    return np.maximum(found, 0) * np.minimum(1, with_it / 8)


def _odds(words: Words, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n_toxic = int((labels > 0).sum())
    return tuple(_log_odds(*table, len(labels) - n_toxic, n_toxic) for table in _counts(words, labels))


def _subset(words: Words, used: np.ndarray) -> Words:
    size = np.diff(words.gram_at)[used]
    grams = words.grams[spread(words.gram_at[used], size)]
    return Words(np.empty(0, np.int64), np.zeros(1, np.int64), words.buckets[used], grams, np.concatenate([[0], np.cumsum(size)]))


def _sparse(table: np.ndarray, squares: np.ndarray, rows: np.ndarray, grad: np.ndarray) -> None:
    """One Adagrad step of the rows that a batch touched."""
    used, inverse = np.unique(rows, return_inverse=True)
    total = np.zeros((len(used), table.shape[1]))
    np.add.at(total, inverse, grad)
    squares[used] += (total**2).mean(axis=1, keepdims=True)
    table[used] -= (0.05 * total / np.sqrt(squares[used])).astype(np.float32)


def _calibrated(top: np.ndarray, labels: np.ndarray, toxic_share: float) -> tuple[float, float]:
    """Slope and offset of a logistic fit of the labels, weighted to the share of all labelled rows."""
    y = (labels > 0).astype(float)
    weight = np.where(y > 0, toxic_share / max(y.mean(), 1e-9), (1 - toxic_share) / max(1 - y.mean(), 1e-9))
    centre, scale = top.mean(), max(top.std(), 1e-6)
    x, a, b = (top - centre) / scale, 1.0, 0.0
    for _ in range(100):
        q = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        e, h = weight * (q - y), weight * q * (1 - q) + 1e-9
        hessian = np.array([[(h * x * x).sum() + 1, (h * x).sum()], [(h * x).sum(), h.sum() + 1e-3]])
        move = np.linalg.solve(hessian, [(e * x).sum() + (a - 1), e.sum()])
        a, b = a - np.clip(move[0], -2, 2), b - np.clip(move[1], -2, 2)
    a = max(a, 1e-3)
    return a / scale, b - a * centre / scale


def _strength(words: Words, odds: np.ndarray, gram_odds: np.ndarray) -> np.ndarray:
    """The strongest sign of toxicity in each window, by the odds of its words and n-grams."""
    best = np.maximum(odds[words.buckets], _per_word(gram_odds[words.grams], words))
    return np.append(best, 0)[np.append(words.index, len(words.buckets))[windows(words)[1]]].max(axis=1)


def _counted(batches):
    """How many texts of each label hold a bucket of words (kind 0) or n-grams (kind 1), summed up within the task."""
    totals = {0: np.zeros((2, WORDS + 1), np.int64), 1: np.zeros((2, GRAMS), np.int64)}
    for batch in batches:
        labels = batch.column(0).to_numpy(zero_copy_only=False)
        words = split_words([x.as_buffer().to_pybytes() for x in batch.column(1)])
        for kind, counts in enumerate(_counts(words, labels)):
            totals[kind] += counts.astype(np.int64)
    for kind, counts in totals.items():
        label, bucket = np.nonzero(counts)
        columns = [np.full(len(label), kind), label, bucket, counts[label, bucket]]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["kind", "toxic", "bucket", "n"])


def _excerpts(odds: np.ndarray, gram_odds: np.ndarray):
    """Of a text of more than `SAMPLE_WINDOWS` windows the strongest half of that many, and others spread over all of it, in order."""

    def cut(batches):
        for batch in batches:
            out = []
            for text in (x.as_buffer().to_pybytes() for x in batch.column(1)):
                words = split_words([text])
                many = len(windows(words)[0])
                if many > SAMPLE_WINDOWS:
                    strong = np.argsort(-_strength(words, odds, gram_odds), kind="stable")[: SAMPLE_WINDOWS // 2]
                    even = np.linspace(0, many - 1, SAMPLE_WINDOWS - len(strong)).astype(np.int64)
                    chosen = np.union1d(strong, even)
                    place = np.unique((chosen[:, None] * STRIDE + np.arange(WIDTH)).ravel())
                    data, bounds = concat([text])
                    starts, ends = word_bounds(data, bounds[:-1], _NOT_WORD)
                    text = b" ".join(text[starts[p] : ends[p]] for p in place[place < len(starts)].tolist())
                out.append(text)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["toxic", "text"])

    return cut


def drawn(labels: DataFrame, id_column: str = "doc_id", label_column: str = "toxic", sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """Ids to learn from, at most `sample_docs` of each label, 0 or 1, drawn by a hash: `doc_id`, `toxic`, and `share`, that of toxic rows among all."""
    rows = labels.select(F.col(id_column).alias("doc_id"), F.col(label_column).cast("int").alias("toxic")).where("doc_id IS NOT NULL AND toxic IN (0, 1)")
    place = F.xxhash64("doc_id", F.lit("toxicity"))
    some = [rows.where(F.col("toxic") == t).dropDuplicates().orderBy(place, "doc_id").limit(sample_docs) for t in (0, 1)]
    return some[0].union(some[1]).crossJoin(F.broadcast(rows.agg(F.avg("toxic").alias("share"))))  # one row


def train(labelled: DataFrame, text_column: str = "text", label_column: str = "toxic", sample_docs: int = SAMPLE_DOCS) -> ToxicityModel | None:
    """Learn from rows with a text and label 0 or 1; None unless both labels occur.

    Takes `sample_docs` different texts of each label, by a hash. Where `labelled` is itself
    a sample, a column `share` says which share of all labelled rows is toxic. Long texts
    train with windows from all over them (`_excerpts`), found by odds that count whole texts.
    """
    rows = labelled.select(
        F.col(label_column).cast("int").alias("toxic"),
        F.col(text_column).cast("string").alias("text"),
        (F.col("share") if "share" in labelled.columns else F.lit(None)).cast("double").alias("share"),
    )
    rows = rows.where("toxic IN (0, 1) AND length(text) > 0")
    sizes = {r["toxic"]: (r["n"], r["share"]) for r in rows.groupBy("toxic").agg(F.count("*").alias("n"), F.max("share").alias("share")).collect()}
    if len(sizes) < 2:
        return None
    share = sizes[1][1] if sizes[1][1] is not None else sizes[1][0] / (sizes[0][0] + sizes[1][0])
    place = F.xxhash64("text", F.lit("toxicity"))
    rate = F.create_map(*[F.lit(x) for t, (n, _) in sizes.items() for x in (t, min(1.0, 1.5 * sample_docs / n))])
    likely = F.pmod(place, F.lit(1 << 20)) / F.lit(float(1 << 20)) <= rate[F.col("toxic")]
    some = [rows.where((F.col("toxic") == t) & likely).select("toxic", "text").dropDuplicates().orderBy(place, "text").limit(sample_docs) for t in (0, 1)]
    picked = written(some[0].union(some[1]).select("toxic", F.col("text").cast("binary").alias("text")), "labelled")

    counts = picked.mapInArrow(_counted, "kind long, toxic long, bucket long, n long").groupBy("kind", "toxic", "bucket").agg(F.sum("n").alias("n"))
    tables = [np.zeros((2, WORDS + 1)), np.zeros((2, GRAMS))]  # of fixed size
    for r in counts.collect():
        tables[r["kind"]][r["toxic"], r["bucket"]] = r["n"]
    taken = {r["toxic"]: r["n"] for r in picked.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(taken) < 2:
        return None
    odds = [_log_odds(*table, taken[0], taken[1]) for table in tables]
    found = sorted((int(r["toxic"]), bytes(r["text"])) for r in picked.mapInArrow(_excerpts(*odds), "toxic int, text binary").collect())
    return fit([text for _, text in found], np.array([toxic for toxic, _ in found]), share)


def score(docs: DataFrame, model: ToxicityModel | None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per document: `score` in 0 to 1 over all windows of its whole text, and `predicted` (score >= 0.3).

    NULL, empty and wordless texts get the score of one empty window; every text
    gets 0 where the model is None. NULL and repeated ids are passed through, one
    row each; further columns are ignored.
    """

    def scored(batches):
        for batch in batches:
            texts = [x.as_buffer().to_pybytes() if x.is_valid else b"" for x in batch.column(1)]
            found = model.scores(texts) if model else np.zeros(len(texts))
            columns = [batch.column(0), pa.array(found, pa.float64()), pa.array((found >= DECISION).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "score", "predicted"])

    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    return texts.mapInArrow(scored, "doc_id long, score double, predicted int")


def held_out(id_column: str = "doc_id") -> Column:
    """The quarter of the documents, by checksum of the id, that is never learnt from; so is a NULL id."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string")) % 4 == 2, F.lit(True))
