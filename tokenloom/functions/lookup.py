"""Lookup tables of bounded size, folded into the plan as array constants."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Token ids are stored in 16 bits, so no vocabulary is larger.
ID_LIMIT = 1 << 16
# Longest array constant put into a plan (Unicode ends below 1.2 million).
CONSTANT_LIMIT = 1_200_000


def constant_array(values: Sequence, element_type: str) -> Column:
    """An array constant; Catalyst folds the split and the cast once at planning."""
    if len(values) > CONSTANT_LIMIT:
        raise ValueError(f"{len(values)} values are too many for a plan constant")
    if not values:
        return F.array().cast(f"array<{element_type}>")
    return F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{element_type}>")


def code_point_table(ids: dict[str, int], missing: int = -1) -> Column:
    """Array from code point to id; `missing` fills the gaps."""
    table = [missing] * (max(map(ord, ids), default=0) + 1)
    for character, token_id in ids.items():
        table[ord(character)] = token_id
    return constant_array(table, "int")


def at_code_point(table: Column, character: Column, missing: int = -1) -> Column:
    return F.coalesce(F.get(table, F.ascii(character)), F.lit(missing))


def count_at_most(ascending: Sequence, element_type: str, value: Column) -> Column:
    """How many of the sorted constants are <= `value`, by binary search."""
    return count_in(constant_array(ascending, element_type), len(ascending), value)


def count_in(table: Column, size: int, value: Column) -> Column:
    """How many of the `size` sorted elements of `table` are <= `value`, by binary search."""
    steps = [1 << p for p in reversed(range(size.bit_length()))]

    def narrow(position: Column, step: Column) -> Column:
        return F.when(F.get(table, position + step - 1) <= value, position + step).otherwise(position)

    if not steps:
        return F.lit(0)
    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), narrow)
