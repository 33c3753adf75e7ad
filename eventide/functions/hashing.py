"""Keys and digests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from eventide.constants import SURROGATE_NULL


def surrogate_key(columns: Sequence[str]) -> Column:
    """md5 over the columns as text, joined by '-', with a fixed text in the place of NULL."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit(SURROGATE_NULL)) for c in columns]
    return F.md5(F.concat_ws("-", *parts))


def sha256_hex(column: str | Column) -> Column:
    """SHA-256 in hex; NULL stays NULL."""
    col = F.col(column) if isinstance(column, str) else column
    return F.sha2(col.cast("string"), 256)


def salt_where_null(keys: Sequence[str], spread_by: Sequence[str]) -> Column:
    """0 for rows with complete join keys, a number above 0 for rows with a NULL key.

    Rows with a NULL key match nothing, yet a join would send all of them to one task. Joined as one
    more key against `no_salt` on the other side, this number, a hash, spreads them over any number of
    tasks and changes no match.
    """
    missing = F.lit(False)
    for key in keys:
        missing = missing | F.col(key).isNull()
    number = F.shiftrightunsigned(F.xxhash64(*[F.col(c) for c in spread_by]), 2) + 1
    return F.when(missing, number).otherwise(F.lit(0)).cast("long")


def no_salt(keys: Sequence[str]) -> Column:
    """0, computed from the keys: the optimizer would turn a plain 0 into a filter, not a join key."""
    return F.pmod(F.xxhash64(*[F.col(c) for c in keys]), F.lit(1)).cast("long")


def row_hashes(columns: Sequence[str]) -> tuple[Column, Column]:
    """Two independent 64-bit hashes of a row's values in order; NULL differs from every value.

    Spark's hash passes NULLs over, so which values are missing is hashed as well.
    """
    missing = F.concat(*[F.when(F.col(c).isNull(), "1").otherwise("0") for c in columns])
    values = [F.col(c) for c in columns]
    return F.xxhash64(missing, *values), F.xxhash64(F.lit(1), *reversed(values), missing)
