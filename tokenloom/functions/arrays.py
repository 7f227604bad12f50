"""Array expressions over token ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def crop_context(ids: Column, block: int) -> Column:
    """The last `block` ids."""
    return F.when(F.size(ids) > block, F.slice(ids, -block, block)).otherwise(ids)


def truncate_at(ids: Column, token_id: int) -> Column:
    """Ids before the first `token_id`, all of them when it does not occur."""
    at = F.array_position(ids, F.lit(token_id).cast("int")).cast("int")
    return F.when(at > 0, F.slice(ids, F.lit(1), at - 1)).otherwise(ids)


def joined(ids: Column) -> Column:
    """Ids as one space-separated string."""
    return F.array_join(ids.cast("array<string>"), " ")


def digest(ids: Column) -> Column:
    """md5 of the space-separated ids: a short value that covers the whole array."""
    return F.md5(joined(ids))
