"""Names, texts and types brought to the form the spec declares."""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import lenient_cast
from ..functions.text import repair_encoding, standard_name
from ..spec import TableSpec, present, require_frame


def standardize_column_names(df: DataFrame) -> DataFrame:
    """Rename every column to its standard name.

    Two columns with one standard name, or a name without any letter or digit,
    could not be addressed afterwards and raise `ValueError`.
    """
    require_frame(df, "standardize_column_names")
    sources = defaultdict(list)
    for name in df.columns:
        sources[standard_name(name)].append(name)
    clashes = {new: old for new, old in sources.items() if len(old) > 1 or not new}
    if clashes:
        raise ValueError(f"Column names without a distinct standard form: {clashes}")
    return df.toDF(*sources)


def standardize_text_values(df: DataFrame, spec: TableSpec, *, collapse_spaces: bool = False) -> DataFrame:
    """Repair the encoding of the text columns and upper-case the reference columns."""
    require_frame(df, "standardize_text_values")
    texts = {c: repair_encoding(F.col(c)) for c in present(df, spec.text)}
    if collapse_spaces:
        texts = {c: F.trim(F.regexp_replace(e, r"\s+", " ")) for c, e in texts.items()}
    for c in present(df, spec.upper):
        texts[c] = F.upper(texts.get(c, F.col(c)))
    return df.withColumns(texts) if texts else df


def standardize_data_types(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Cast the spec's columns to their declared types; NULLs stay NULL."""
    require_frame(df, "standardize_data_types")
    types = {f.name: f.dataType for f in df.schema}
    casts = {
        c: lenient_cast(F.col(c), types[c], target)
        for c, target in spec.columns.items()
        if c in types and types[c] != target
    }
    return df.withColumns(casts) if casts else df
