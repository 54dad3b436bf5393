"""String expressions. All are built-in Catalyst expressions; no Python worker."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def standard_name(name: str) -> str:
    """`name` in lower case, with every run of other characters than a-z0-9 as one `_`."""
    return re.sub("[^a-z0-9]+", "_", name.strip().lower()).strip("_")


def blank_to_null(text: Column) -> Column:
    """`text` without outer ASCII spaces, NULL if nothing is left, in any collation."""
    trimmed = F.trim(text)
    return F.when(F.octet_length(trimmed) > 0, trimmed)


def repair_encoding(text: Column) -> Column:
    """Undo UTF-8 bytes having been read as Latin-1 (`DÃ©part` -> `Départ`).

    A text changes only if all its characters exist in Latin-1 and its Latin-1
    bytes are valid UTF-8. ASCII text (as many bytes as characters) cannot
    change, so the common case costs two length reads.
    """
    as_utf8 = F.try_validate_utf8(F.encode(text, "ISO-8859-1").cast("string"))
    is_ascii = F.octet_length(text) == F.char_length(text)
    beyond_latin1 = text.rlike(r"[\x{100}-\x{10FFFF}]")
    return F.when(is_ascii | beyond_latin1, text).otherwise(F.coalesce(as_utf8, text))
