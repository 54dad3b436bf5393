"""Removal of byte strings that occur earlier, by hashed windows and a difference cover.

This swaps the suffix-array method for hashes: no suffix is sorted by its bytes,
and cover names order no ties. What the samples would shuffle is computed in the
README; the suffix array itself was not built and measured.
Windows of 44 bytes are named by hash at difference-cover positions
(modulo 57). A window of 100 bytes whose covered positions all have names of their
own repeats nowhere and is left out. The hashes of the rest are dealt to buckets by
their leading bits and each bucket is sorted by itself; all but the first of a run
of equal hashes (64 bits and 16 of a second one) are removed, without a comparison
of their bytes. Memory is bounded
by a block and by a bucket, whatever the corpus. See `repeats` for the passes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tamis.llm.repeats import Block, Rule, runs, without_repeats

# A perfect difference set modulo 57.
BYTE_RULE = Rule(unit="bytes", width=100, period=57, cover=(0, 1, 3, 13, 32, 36, 43, 52), within=True)
_SCHEMA = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"


def _finish(block: Block, removed: np.ndarray) -> pa.RecordBatch:
    gone, spans = runs(removed, block.at)
    kept = [
        block.data[a:b][~removed[a:b]].tobytes() if n else block.raw[a:b]
        for a, b, n in zip(block.at[:-1].tolist(), block.at[1:].tolist(), gone.tolist(), strict=True)
    ]
    columns = [pa.array(block.ids, pa.int64()), pa.array(block.sizes), pa.array(gone), pa.array(spans), pa.array(kept, pa.binary())]
    return pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])


def remove_repeated_bytes(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", rule: Rule = BYTE_RULE) -> DataFrame:
    """Per document: its UTF-8 length, the bytes and runs removed, and the bytes kept.

    A byte goes if a string of `rule.width` bytes covers it that also starts
    earlier: in a document with a smaller id, or before in the same one.

    A NULL text counts as empty; a NULL id is smaller than any other. Rows that
    share an id count as documents in a fixed order (whole copies: by place of
    storage). A document shorter than the width keeps all. Any further column is
    ignored. An empty table gives an empty result.
    """
    return without_repeats(docs, id_column, text_column, rule, _finish, _SCHEMA)
