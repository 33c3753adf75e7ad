"""Row filters given as data."""

from __future__ import annotations

import datetime as dt
import operator
from collections.abc import Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from eventide.context import wall_time

_COMPARE = {
    "=": operator.eq,
    "==": operator.eq,
    "!=": operator.ne,
    "<": operator.lt,
    "<=": operator.le,
    ">": operator.gt,
    ">=": operator.ge,
}


def _literal(value: Any) -> Column:
    return wall_time(value) if isinstance(value, dt.datetime) else F.lit(value)


def _one(name: str, op: str, value: Any) -> Column:
    col = F.col(name)
    if op in _COMPARE:
        return _COMPARE[op](col, _literal(value))
    if op == "in":
        return col.isin([_literal(v) for v in value])
    if op == "not in":
        return ~col.isin([_literal(v) for v in value])
    raise ValueError(f"unknown comparison {op!r} on column {name!r}")


def all_of(filters: Sequence[tuple[str, str, Any]] | None) -> Column:
    """(column, operator, value) triples joined by AND; no filters keep every row."""
    parts = [_one(*f) for f in filters or []]
    return reduce(operator.and_, parts) if parts else F.lit(True)


def any_null(columns: Sequence[str]) -> Column:
    return reduce(operator.or_, [F.col(c).isNull() for c in columns])
