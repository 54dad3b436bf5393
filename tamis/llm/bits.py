"""Helpers for built-in expressions: a table of bits, of fixed size, and values computed once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLOTS = 1 << 20


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with the value computed once however often the body uses it, also within lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _slot(value: Column) -> Column:
    return F.pmod(F.xxhash64(value), F.lit(SLOTS)).cast("int")


def listed(value: Column, rows: DataFrame, column: str) -> Column:
    """Whether a value may be in a column of `rows`: never false for one that is, seldom true for others.

    The driver gets 128 KiB whatever the size of `rows`. They reach the query as the one row of a
    subquery: a literal would stand in the text of its plan, wherever the condition is pushed and
    each time that Spark reports on the query.
    """
    spark = rows.sparkSession
    slots = rows.select(_slot(F.col(column)).alias("s"))
    words = slots.groupBy(F.shiftright("s", 6).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, s & 63)")).alias("b"))
    found = dict(words.collect())
    bits = [found.get(i, 0) for i in range(SLOTS // 64)]
    table = spark.createDataFrame([(bits,)], "bits array<bigint>").coalesce(1).scalar()
    slot = _slot(value)
    return F.getbit(F.get(table, F.shiftright(slot, 6)), slot.bitwiseAND(63)) == 1
