"""Windows of symbols that already start earlier in the corpus, exactly and without hot tasks.

Shared by the suffix-array operator (bytes) and the substring operator (words).

1. Documents are packed into blocks of about `BLOCK_BYTES`, written once,
   bucketed by block: later passes join small verdicts to them in place.
2. Whole copies of a document are settled by digest, one row per block and text.
3. Cover sample: windows of `short` symbols are named at the positions that a
   difference cover modulo `period` holds, with period + short - 1 = width. Two
   equal windows of `width` symbols meet in one aligned sample, whatever their
   offset. Names go out as sorted packed arrays, one per block and bucket, each
   name once per block; the answer is a bit per name: seen in another block?
4. Only a window that reaches a repeated sample can repeat. Their full names are
   dealt to buckets by prefix; each bucket is sorted by itself, and the answer
   is a bit per window: does it start in an earlier document?

A task holds one block, or one bucket; the number of buckets grows with the
corpus. No group of equal windows meets anywhere but as one entry per block.
Windows are equal if their names, 64 bits, and their checks, 16 bits of a second
hash over other symbol values, are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamis.llm.arrays import byte_symbols, covered, mix, spread, window_hashes, word_bounds, word_hashes
from tamis.llm.scratch import written, written_by_key

BLOCK_BYTES = 2 << 20
BLOCK_ROWS = 4096
BUCKET_BYTES = 64 << 20
NULL_ID = -(1 << 63)

_BLOCK = "block long, ids array<bigint>, sizes array<bigint>, data binary, heads array<struct<digest binary, ord int>>"
_NAMES = "bucket int, block long, base long, names binary, checks binary, owners binary"
_BITS = "bucket int, block long, bits binary"


@dataclass(frozen=True)
class Rule:
    """What repeats: `unit` is "bytes" or "words"; `cover` is a difference cover modulo `period`.

    With `within`, a window also repeats an earlier one of its own document.
    """

    unit: str
    width: int
    period: int
    cover: tuple[int, ...]
    within: bool

    @property
    def short(self) -> int:
        return self.width - self.period + 1


# --- packing -------------------------------------------------------------------


def pack_sorted(values: np.ndarray) -> bytes:
    """Ascending integers as differences of as few bytes as pay; larger ones follow in full."""
    if not len(values):
        return b""
    steps = np.diff(values, prepend=np.uint64(0))
    sizes = [len(steps) * k + 8 * int((steps >= np.uint64((1 << 8 * k) - 1)).sum()) for k in range(1, 8)]
    k = int(np.argmin(sizes)) + 1
    escape = np.uint64((1 << 8 * k) - 1)
    large = steps >= escape
    lanes = np.where(large, escape, steps).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :k]
    return bytes([k]) + len(steps).to_bytes(4, "little") + lanes.tobytes() + steps[large].astype("<u8").tobytes()


def unpack_sorted(packed: bytes) -> np.ndarray:
    if not packed:
        return np.empty(0, np.uint64)
    k, n = packed[0], int.from_bytes(packed[1:5], "little")
    lanes = np.zeros((n, 8), np.uint8)
    lanes[:, :k] = np.frombuffer(packed, np.uint8, n * k, 5).reshape(n, k)
    steps = lanes.reshape(-1).view("<u8").astype(np.uint64)
    steps[steps == np.uint64((1 << 8 * k) - 1)] = np.frombuffer(packed, "<u8", offset=5 + n * k)
    return np.cumsum(steps, dtype=np.uint64)


def _pack_owners(offsets: np.ndarray) -> bytes:
    """Distances from the block's smallest id, in 2, 4 or 8 bytes each."""
    top = int(offsets.max()) if len(offsets) else 0
    return offsets.astype("<u2" if top < 1 << 16 else "<u4" if top < 1 << 32 else "<u8").tobytes()


def _unpack_owners(packed: bytes, n: int) -> np.ndarray:
    return np.frombuffer(packed, f"<u{len(packed) // n}").astype(np.uint64) if n else np.empty(0, np.uint64)


# --- blocks --------------------------------------------------------------------


def _blocks(batches: Iterator[pa.RecordBatch], most: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Documents in blocks of `most` bytes or a little more; a longer document is a block of its own."""
    part, seq, rows, held = TaskContext.get().partitionId(), 0, [], 0
    schema = pa.schema(
        [
            ("block", pa.int64()),
            ("ids", pa.list_(pa.int64())),
            ("sizes", pa.list_(pa.int64())),
            ("data", pa.binary()),
            ("heads", pa.list_(pa.struct([("digest", pa.binary()), ("ord", pa.int32())]))),
        ]
    )

    def packed() -> pa.RecordBatch:
        rows.sort(key=lambda r: (NULL_ID if r[0] is None else r[0], r[1]))
        seen, heads = set(), []
        for i, (_, digest, text) in enumerate(rows):
            if text and digest not in seen:
                seen.add(digest)
                heads.append({"digest": digest, "ord": i})
        row = {"block": (part << 24) + seq, "ids": [r[0] for r in rows], "sizes": [len(r[2]) for r in rows]}
        return pa.RecordBatch.from_pylist([row | {"data": b"".join(r[2] for r in rows), "heads": heads}], schema)

    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            raw = text.as_buffer().to_pybytes() if text.is_valid else b""
            rows.append((doc_id, hashlib.blake2b(raw, digest_size=16).digest(), raw))
            held += len(raw)
            if held >= most or len(rows) >= BLOCK_ROWS:
                yield packed()
                seq, rows, held = seq + 1, [], 0
    if rows:
        yield packed()


class Block:
    """One block in a task: its symbols, where its documents begin, which of them count."""

    def __init__(self, row: dict, rule: Rule):
        self.rule, self.ids, self.raw = rule, row["ids"], row["data"]
        self.order = np.array([NULL_ID if i is None else i for i in self.ids], np.int64)
        self.data = np.frombuffer(self.raw, np.uint8)
        self.bytes_at = np.concatenate([[0], np.cumsum(np.array(row["sizes"], np.int64))]).astype(np.int64)
        if rule.unit == "bytes":
            self.at, self.symbols = self.bytes_at, byte_symbols()[self.data]
        else:
            self.starts, self.ends = word_bounds(self.data, self.bytes_at[:-1])
            self.at = np.searchsorted(self.starts, self.bytes_at)
            self.symbols = word_hashes(self.data, self.starts, self.ends)
        self.sizes = np.diff(self.at)
        self.copy = np.zeros(len(self.ids), bool)
        self.copy[list(row.get("copies") or ())] = True
        first: dict[bytes, int] = {}
        view = memoryview(self.raw)
        for i in range(len(self.ids)):
            digest = hashlib.blake2b(view[self.bytes_at[i] : self.bytes_at[i + 1]], digest_size=16).digest()
            head = first.setdefault(digest, i)
            if head != i and (rule.within or self.order[head] < self.order[i]):
                self.copy[i] = True
        self.live = ~self.copy & (self.sizes >= rule.width)

    def sample(self) -> tuple[np.ndarray, np.ndarray]:
        """The cover positions of documents that are no copies, and the names of the short windows there."""
        rule, docs = self.rule, np.flatnonzero(self.live)
        rounds = (self.sizes[docs] - rule.short) // rule.period + 1
        begin = np.repeat(self.at[docs], rounds) + spread(np.zeros(len(docs), np.int64), rounds) * rule.period
        at = (begin[:, None] + np.array(rule.cover)).ravel()
        at = at[at + rule.short <= np.repeat(self.at[docs + 1], rounds * len(rule.cover))]
        return at, window_hashes(self.symbols, rule.short, at)

    def candidates(self, bits: dict[int, bytes], buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Windows that reach a sample which repeats, here or elsewhere, their names and their checks, in document order."""
        at, names = self.sample()
        values, inverse, counts = np.unique(names, return_inverse=True, return_counts=True)
        again = (counts > 1) | _verdicts(values, bits, buckets, _SAMPLE_BITS)
        found = at[again[inverse]]
        doc = self.doc(found)
        low = np.maximum(found - self.rule.period + 1, self.at[doc])
        low[1:] = np.maximum(low[1:], found[:-1] + 1)
        many = np.maximum(0, np.minimum(found, self.at[doc + 1] - self.rule.width) - low + 1)
        starts = spread(low, many)
        other = window_hashes(mix(self.symbols ^ _OTHER), self.rule.width, starts)
        return starts, window_hashes(self.symbols, self.rule.width, starts), (other >> np.uint64(48)).astype("<u2")

    def doc(self, at: np.ndarray) -> np.ndarray:
        """The document of each unit."""
        return np.searchsorted(self.at, at, side="right") - 1

    def removed(self, starts: np.ndarray, names: np.ndarray, checks: np.ndarray, bits: dict[int, bytes], buckets: int) -> np.ndarray:
        """Which units a window covers that starts earlier too."""
        first, inverse = _distinct(names, checks)
        elsewhere = _verdicts(names[first], bits, buckets, _NAME_BITS)[inverse]
        head = starts[first][inverse]
        here = starts > head if self.rule.within else self.order[self.doc(starts)] > self.order[self.doc(head)]
        gone = covered(starts[elsewhere | here], self.rule.width, len(self.symbols))
        return gone | np.repeat(self.copy & (self.sizes >= self.rule.width), self.sizes)


# of a sample's name so many bits that few others agree: those only make candidates; of a window's all that the bucket leaves
_SAMPLE_BITS, _NAME_BITS = 24, 54
# what tells the symbol values of checks from those of names
_OTHER = np.uint64(0xD6E8FEB86659FD93)


def _distinct(names: np.ndarray, checks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first of each different window, by name, then by check, and for each window which of these equals it."""
    order = np.argsort(names, kind="stable")
    fresh, apart = _changes(names[order]), _changes(checks[order])
    if (apart & ~fresh).any():  # one name of different windows
        order = np.lexsort((checks, names))
        fresh = _changes(names[order]) | _changes(checks[order])
    inverse = np.empty(len(order), np.int64)
    inverse[order] = np.cumsum(fresh) - 1
    return order[fresh], inverse


def _changes(values: np.ndarray) -> np.ndarray:
    """Where a value differs from the one before; the first does."""
    out = np.ones(len(values), bool)
    out[1:] = values[1:] != values[:-1]
    return out


def _slices(values: np.ndarray, buckets: int, keep: int) -> Iterator[tuple[int, slice, np.ndarray]]:
    """Sorted names by bucket, the leading bits; of the rest, the next `keep` bits."""
    lead = buckets.bit_length() - 1
    owner = (values >> np.uint64(64 - lead)).astype(np.int64)
    short = (values >> np.uint64(max(0, 64 - lead - keep))) & np.uint64((1 << keep) - 1)
    found, at, many = np.unique(owner, return_index=True, return_counts=True)
    for bucket, a, b in zip(found.tolist(), at.tolist(), (at + many).tolist(), strict=True):
        yield bucket, slice(a, b), short[a:b]


def _verdicts(values: np.ndarray, bits: dict[int, bytes], buckets: int, keep: int) -> np.ndarray:
    out = np.zeros(len(values), bool)
    for bucket, part, _ in _slices(values, buckets, keep):
        if bucket in bits:
            n = part.stop - part.start
            out[part] = np.unpackbits(np.frombuffer(bits[bucket], np.uint8), count=n).astype(bool)
    return out


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def _bits(row: dict, key: str) -> dict[int, bytes]:
    return {x["bucket"]: x["bits"] for x in row.get(key) or ()}


_NAMES_ARROW = pa.schema(
    [("bucket", pa.int32()), ("block", pa.int64()), ("base", pa.int64()), ("names", pa.binary()), ("checks", pa.binary()), ("owners", pa.binary())]
)
_BITS_ARROW = pa.schema([("bucket", pa.int32()), ("block", pa.int64()), ("bits", pa.binary())])


def _send_samples(rule: Rule, buckets: int) -> Callable:
    def send(batches):
        for row in _rows(batches):
            values = np.unique(Block(row, rule).sample()[1])
            out = [
                {"bucket": k, "block": row["block"], "base": 0, "names": pack_sorted(short), "checks": b"", "owners": b""}
                for k, _, short in _slices(values, buckets, _SAMPLE_BITS)
            ]
            yield pa.RecordBatch.from_pylist(out, _NAMES_ARROW)

    return send


def _send_candidates(rule: Rule, buckets: int) -> Callable:
    def send(batches):
        for row in _rows(batches):
            block = Block(row, rule)
            starts, names, checks = block.candidates(_bits(row, "sampled"), buckets)
            first, _ = _distinct(names, checks)
            checks = checks[first]
            owners = block.order[block.doc(starts[first])]
            base = int(block.order[0]) if len(block.order) else 0
            away = owners.astype(np.uint64) - np.int64(base).astype(np.uint64)
            out = [
                {"bucket": k, "block": row["block"], "base": base, "names": pack_sorted(short)}
                | {"checks": checks[part].tobytes(), "owners": _pack_owners(away[part])}
                for k, part, short in _slices(names[first], buckets, _NAME_BITS)
            ]
            yield pa.RecordBatch.from_pylist(out, _NAMES_ARROW)

    return send


def _entries(table: pa.Table) -> tuple[list[dict], np.ndarray, np.ndarray, np.ndarray]:
    rows = table.to_pylist()
    parts = [unpack_sorted(r["names"]) for r in rows]
    sizes = np.array([len(p) for p in parts])
    return rows, sizes, np.concatenate(parts), np.repeat(np.arange(len(rows)), sizes)


def _answer(rows: list[dict], sizes: np.ndarray, verdict: np.ndarray) -> pa.Table:
    out = [
        {"bucket": r["bucket"], "block": r["block"], "bits": np.packbits(part).tobytes()}
        for r, part in zip(rows, np.split(verdict, np.cumsum(sizes)[:-1]), strict=True)
        if part.any()
    ]
    return pa.Table.from_pylist(out, _BITS_ARROW)


def _repeated_samples(table: pa.Table) -> pa.Table:
    """Each name is sent once per block: one that comes twice is in two blocks."""
    rows, sizes, names, _ = _entries(table)
    _, inverse, counts = np.unique(names, return_inverse=True, return_counts=True)
    return _answer(rows, sizes, counts[inverse] > 1)


def _later_windows(rule: Rule) -> Callable:
    def sort_bucket(table: pa.Table) -> pa.Table:
        rows, sizes, names, row = _entries(table)
        owners = np.concatenate(
            [
                (_unpack_owners(r["owners"], n) + np.int64(r["base"]).astype(np.uint64)).astype(np.int64)
                for r, n in zip(rows, sizes.tolist(), strict=True)
            ]
        )
        checks = np.concatenate([np.frombuffer(r["checks"], "<u2") for r in rows])
        block = np.array([r["block"] for r in rows])[row]
        order = np.lexsort((block, owners, checks, names))
        fresh = _changes(names[order]) | _changes(checks[order])
        head = order[np.maximum.accumulate(np.where(fresh, np.arange(len(order)), 0))]
        later = np.empty(len(order), bool)
        later[order] = ~fresh if rule.within else owners[order] > owners[head]
        return _answer(rows, sizes, later)

    return sort_bucket


def _by_block(answers: DataFrame, name: str) -> DataFrame:
    return answers.groupBy("block").agg(F.collect_list(F.struct("bucket", "bits")).alias(name))


def _copies(blocks: DataFrame, rule: Rule) -> DataFrame:
    """By block, the documents whose whole text stands in an earlier document of another block."""
    heads = blocks.select("block", "ids", F.explode("heads").alias("h")).select(
        "block",
        F.col("h.digest").alias("digest"),
        F.col("h.ord").alias("ord"),
        F.coalesce(F.get("ids", F.col("h.ord")), F.lit(NULL_ID)).alias("id"),
    )
    place = F.struct("id", "block", "ord")
    firsts = heads.groupBy("digest").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1")
    later = place > F.col("first") if rule.within else F.col("id") > F.col("first.id")
    found = heads.join(firsts, "digest").where(later)
    return found.groupBy("block").agg(F.collect_list("ord").alias("copies"))


def without_repeats(docs: DataFrame, id_column: str, text_column: str, rule: Rule, finish: Callable, schema: str) -> DataFrame:
    """Apply `finish(block, removed)`, which returns an Arrow batch of `schema`, to every block."""
    texts = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").alias("text"))
    blocks = written_by_key(texts.mapInArrow(partial(_blocks, most=BLOCK_BYTES), _BLOCK), "blocks", "block")
    total = blocks.select(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x))).first()[0] or 0
    buckets = 1024
    while buckets * BUCKET_BYTES < 8 * total:
        buckets *= 2

    slim = blocks.select("block", "ids", "sizes", "data")
    marked = slim.join(written(_copies(blocks, rule), "copies").hint("merge"), "block", "left")
    names = marked.mapInArrow(_send_samples(rule, buckets), _NAMES)
    sampled = written(_by_block(names.groupBy("bucket").applyInArrow(_repeated_samples, _BITS), "sampled"), "sampled")

    marked = marked.join(sampled.hint("merge"), "block", "left")
    names = marked.mapInArrow(_send_candidates(rule, buckets), _NAMES)
    later = written(_by_block(names.groupBy("bucket").applyInArrow(_later_windows(rule), _BITS), "later"), "later")

    def last(batches):
        for row in _rows(batches):
            block = Block(row, rule)
            found = block.candidates(_bits(row, "sampled"), buckets)
            yield finish(block, block.removed(*found, _bits(row, "later"), buckets))

    return marked.join(later.hint("merge"), "block", "left").mapInArrow(last, schema)


def runs(removed: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Removed units and maximal removed runs of each document."""
    total = np.concatenate([[0], np.cumsum(removed)])
    begins = removed.copy()
    begins[1:] &= ~removed[:-1]
    first = at[:-1][at[:-1] < len(removed)]
    begins[first] = removed[first]
    opened = np.concatenate([[0], np.cumsum(begins)])
    return np.diff(total[at]), np.diff(opened[at])
