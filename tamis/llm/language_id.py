"""Language identification by error-correcting output codes over character n-grams.

Every language gets a codeword; one binary classifier per bit, linear over hashed
character 1- to 3-grams, is trained by logistic loss. A text goes to the language
whose codeword has the least total loss, and is flagged where the runner-up is
almost as near. Training rows are a stratified sample of at most `SAMPLE_ROWS`
(documented bound); only their features leave the executors.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE_ROWS = 6000
DIMENSIONS = 2048
EPOCHS = 30
AMBIGUOUS = 0.5
UNDETERMINED = "und"

_PIECE = 1 << 20
_LETTER = re.compile(r"[^\W\d_]")
_MULTIPLIERS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)


def codewords(n: int) -> np.ndarray:
    """Codewords of n classes, one row each, in -1 and 1.

    Exhaustive codes for up to 7 classes, else the random code of 15 bits per
    halving with the largest least distance among 50.
    """
    if n <= 7:
        columns = [[1, *[1 if c >> i & 1 else -1 for i in range(n - 1)]] for c in range(2 ** max(n - 1, 0) - 1)]
        return np.array(columns or [[1] * n], np.float32).T.reshape(n, -1)
    rng = np.random.default_rng(7)
    length = 15 * int(np.ceil(np.log2(n)))
    drawn = [np.where(rng.random((n, length)) < 0.5, -1.0, 1.0) for _ in range(50)]
    return max(drawn, key=lambda m: -int((m @ m.T - 2 * length * np.eye(n)).max())).astype(np.float32)


def features(texts: list[str]) -> np.ndarray:
    """Root frequencies of hashed n-grams, one row of length 1 per text."""
    out = np.zeros((len(texts), DIMENSIONS), np.float32)
    at = 0
    while at < len(texts):
        end, held = at, 0
        while end < len(texts) and (end == at or held + len(texts[end]) <= _PIECE):
            held += len(texts[end])
            end += 1
        for start in range(0, held, _PIECE):  # more than one round for a single long text only
            parts = [t[start : start + _PIECE] if end - at == 1 else t for t in texts[at:end]]
            out[at:end] += _counts(parts)
        at = end
    np.sqrt(out, out=out)
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)


def _counts(parts: list[str]) -> np.ndarray:
    spaced = [f" {p.lower()}  " for p in parts]
    code = np.frombuffer("".join(spaced).encode("utf-32-le", "surrogatepass"), "<u4").copy()
    plain = code < 128
    letter = (code >= 97) & (code <= 122)
    code[plain & ~letter] = 32
    row = np.repeat(np.arange(len(parts)), [len(p.encode("utf-32-le", "surrogatepass")) // 4 for p in spaced]) * DIMENSIONS
    counts = np.zeros(len(parts) * DIMENSIONS)
    grams = np.zeros(len(code), np.uint32)
    for n in range(3):
        grams = grams[: len(code) - n] * np.uint32(0x01000193) ^ code[n:] * _MULTIPLIERS[n]
        hashed = grams * np.uint32(0x9E3779B1)
        hashed ^= hashed >> np.uint32(15)
        real = code[: len(code) - n] != 32
        slot = row[: len(code) - n][real] + (hashed[real] & np.uint32(DIMENSIONS - 1))
        counts += np.bincount(slot, minlength=len(counts))
    return counts.reshape(len(parts), DIMENSIONS).astype(np.float32)


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]
    codes: np.ndarray
    weights: np.ndarray

    def decode(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For feature rows: index of the language, its share in 0 to 1, and its lead over the runner-up."""
        bits = rows @ self.weights[:-1] + self.weights[-1]
        loss = np.logaddexp(0, -bits[:, None, :] * self.codes[None]).sum(axis=2)
        best = loss.argmin(axis=1)
        share = np.exp(loss.min(axis=1, keepdims=True) - loss)
        two = np.sort(loss, axis=1)[:, :2]
        lead = two[:, 1] - two[:, 0] if loss.shape[1] > 1 else np.full(len(rows), np.inf)
        return best, 1 / share.sum(axis=1), lead


def fit(rows: np.ndarray, labels: list[str]) -> LanguageModel:
    """Train a classifier per bit; deterministic. Rows may be half precision; only a batch is widened at a time."""
    languages = sorted(set(labels))
    codes = codewords(len(languages))
    target = codes[np.searchsorted(languages, labels)]
    weights = np.zeros((DIMENSIONS + 1, codes.shape[1]), np.float32)
    mean, square = np.zeros_like(weights), np.zeros_like(weights)
    rng, step = np.random.default_rng(11), 0
    for _ in range(EPOCHS):
        for batch in np.array_split(rng.permutation(len(rows)), max(1, len(rows) // 128)):
            x, y = rows[batch].astype(np.float32), target[batch]
            slope = -y / (1 + np.exp(np.clip(y * (x @ weights[:-1] + weights[-1]), -30, 30))) / len(batch)
            grad = np.vstack([x.T @ slope, slope.sum(axis=0)]) + 1e-6 * weights
            step += 1
            mean += 0.1 * (grad - mean)
            square += 0.001 * (grad * grad - square)
            weights -= 0.05 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    return LanguageModel(languages, codes, weights)


def _featurised(batches):
    for batch in batches:
        rows = features([t or "" for t in batch.column(1).to_pylist()])
        packed = [r.astype(np.float16).tobytes() for r in rows]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())], names=["lang", "features"])


def train(docs: DataFrame, text_column: str = "text", lang_column: str = "lang", sample_rows: int = SAMPLE_ROWS) -> LanguageModel | None:
    """Learn from rows with text and language, about `sample_rows` of them, spread evenly over the languages.

    None where there is no such row.
    """
    rows = docs.select(F.col(lang_column).alias("lang"), F.col(text_column).alias("text")).where("lang IS NOT NULL AND text RLIKE '\\\\p{L}'")
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return None
    each = max(1, sample_rows // len(sizes))
    rate = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, min(1.0, each / n))])
    draw = F.pmod(F.xxhash64("text", F.lit("language")), F.lit(1 << 20)) / F.lit(float(1 << 20))
    picked = rows.where(draw <= rate[F.col("lang")]).dropDuplicates().mapInArrow(_featurised, "lang string, features binary")
    found = picked.toArrow()  # without copies of the features as Python rows
    if not found.num_rows:
        return None
    lang = found.column("lang").to_pylist()
    raw = np.empty((len(lang), DIMENSIONS), np.float16)
    for i, x in enumerate(x for chunk in found.column("features").chunks for x in chunk):
        raw[i] = np.frombuffer(x.as_buffer(), np.float16)
    del found, x
    pa.default_memory_pool().release_unused()
    # by language, then by the bytes of the features: no copy of the rows but the ordered one
    order = np.argsort(raw.view(f"S{raw.itemsize * DIMENSIONS}").ravel(), kind="stable")
    order = np.array(sorted(order.tolist(), key=lambda i: lang[i]))
    raw = raw[order]
    return fit(raw, [lang[i] for i in order.tolist()])


_PREDICTED = "doc_id long, lang_pred string, score double, ambiguous boolean"


def identify(docs: DataFrame, model: LanguageModel | None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per document: `lang_pred`, `score` in 0 to 1, and whether the decision is `ambiguous`.

    `und`, with score 0 and ambiguous, where the text is NULL, empty or has no
    letter, or where the model is None. Equal losses go to the language first by
    code point. NULL and repeated ids are passed through, one row each; further
    columns are ignored.
    """

    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))

    def predict(batches):
        for batch in batches:
            found = _predictions(model, batch.column(1).to_pylist())
            columns = [batch.column(0), pa.array(found[0]), pa.array(found[1], pa.float64()), pa.array(found[2])]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "lang_pred", "score", "ambiguous"])

    return texts.mapInArrow(predict, _PREDICTED)


def identified(docs: DataFrame, model: LanguageModel | None, text_column: str = "text") -> DataFrame:
    """The documents, all columns, whose language could be told: neither `und` nor ambiguous."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(text_column).cast("string").alias("text"))

    def choose(batches):
        for batch in batches:
            unsure = _predictions(model, batch.column(1).to_pylist())[2]
            keep = pa.array([not u for u in unsure], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0)], names=["row"]).filter(keep)

    return rows.mapInArrow(choose, rows.select("row").schema).select("row.*")


def _predictions(model: LanguageModel | None, texts: list[str | None]) -> tuple[list[str], list[float], list[bool]]:
    """Language, score and doubt of each text."""
    lang, score, unsure = [UNDETERMINED] * len(texts), [0.0] * len(texts), [True] * len(texts)
    real = [i for i, t in enumerate(texts) if model and t and _LETTER.search(t)]
    for at in range(0, len(real), 256):
        part = real[at : at + 256]
        best, share, lead = model.decode(features([texts[i] for i in part]))
        for i, b, s, d in zip(part, best.tolist(), share.tolist(), lead.tolist(), strict=True):
            lang[i], score[i], unsure[i] = model.languages[b], min(1.0, s), d < AMBIGUOUS
    return lang, score, unsure


def held_out(id_column: str = "doc_id") -> Column:
    """The fifth of the documents, by checksum of the id, that is never learnt from; so is a NULL id."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string")) % 5 == 0, F.lit(True))
