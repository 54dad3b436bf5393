"""Removal of word passages that occur in an earlier document, by difference-cover anchors.

Method: windows of 38 words are hashed only at the cover positions modulo 13, 4
in 13. Any two equal runs of 50 words share an anchor at one aligned position,
so only windows of 50 words that reach a repeated anchor are extended to their
full length and compared. See `repeats` for the passes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tamis.llm.repeats import Block, Rule, runs, without_repeats

# A perfect difference set modulo 13.
WORD_RULE = Rule(unit="words", width=50, period=13, cover=(0, 1, 3, 9), within=False)
_SCHEMA = "doc_id long, n_words long, n_removed long, kept string"


def _finish(block: Block, removed: np.ndarray) -> pa.RecordBatch:
    gone, _ = runs(removed, block.at)
    kept = []
    for i, n in enumerate(gone.tolist()):
        words = block.raw[block.bytes_at[i] : block.bytes_at[i + 1]].split()
        if n:
            stays = ~removed[block.at[i] : block.at[i + 1]]
            words = [w for w, stay in zip(words, stays.tolist(), strict=True) if stay]
        kept.append(b" ".join(words))
    columns = [pa.array(block.ids, pa.int64()), pa.array(block.sizes), pa.array(gone), pa.array(kept, pa.binary()).cast(pa.string())]
    return pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_removed", "kept"])


def remove_repeated_passages(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", rule: Rule = WORD_RULE) -> DataFrame:
    """Per document: its words, how many were removed, and the rest joined by one space.

    Words are separated by ASCII white space. A word goes if a window of
    `rule.width` words covers it whose sequence also starts in a document with a
    smaller id.

    A NULL text has no words; a NULL id is smaller than any other. Rows that
    share an id do not remove each other's words. A document with fewer words
    than the width keeps all. Any further column is ignored. An empty table
    gives an empty result.
    """
    return without_repeats(docs, id_column, text_column, rule, _finish, _SCHEMA)
