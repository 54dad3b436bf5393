"""Typed errors. Each holds its `offenders`, a mapping from what is wrong to why, and words them itself."""

from __future__ import annotations

from collections.abc import Mapping


class TamisError(Exception):
    headline = "The data can't be used"
    reason = "{}: {}"
    """How an offender and its reason are put together."""

    def __init__(self, offenders: Mapping[object, object]) -> None:
        self.offenders = dict(offenders)
        plain = ", ".join(str(name) for name, why in self.offenders.items() if why is None)
        lines = [self.reason.format(name, why) for name, why in self.offenders.items() if why is not None]
        super().__init__("\n".join([f"{self.headline}{': ' if plain else '.'}{plain}", *lines]))


class DataLakeConfigurationError(TamisError):
    headline = "A setting is missing or doesn't suit a cluster"


class DataLakeBucketNotFoundError(TamisError):
    headline = "The root of a layer does not exist"


class NoPartitionFoundError(TamisError):
    headline = "There is no dated snapshot"


class DataLakeReadError(TamisError):
    headline = "A snapshot can't be read"


class DataLakeWriteError(TamisError):
    headline = "A table can't be written"


class SourceDBConnectionError(TamisError):
    headline = "The source database can't be reached"


class SourceDBQueryError(TamisError):
    headline = "The source database refused a query"


class MissingRequiredColumnError(TamisError):
    headline = "Required columns are absent"


class InvalidSchemaError(TamisError):
    headline = "Columns have another type than declared"
    # Fixed value: the line per column.
    reason = "{} : {}"


class HighNullRatioError(TamisError):
    headline = "Too much of a column is NULL"


class InvalidNumericRangeError(TamisError):
    headline = "Measurements lie outside their range"


class DuplicateKeyError(TamisError):
    headline = "A key is not unique"


class FutureDateError(TamisError):
    headline = "Rows are dated in the future"


class InvalidFlagError(TamisError):
    headline = "Flags hold other values than 0 and 1"


class TextTooLongError(TamisError):
    headline = "Texts exceed their column's length"
