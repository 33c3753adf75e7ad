"""Declared table schemas and the comparison used to gate writes."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

_S, _TS, _D, _L, _B = T.StringType(), T.TimestampType(), T.DateType(), T.LongType(), T.BooleanType()
MONEY = T.DecimalType(18, 2)


def _schema(**columns: tuple[T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, (t, nullable) in columns.items()])


# The declared columns of the source tables, in order. False marks required ones.
EVENTS_SCHEMA = _schema(
    event_id=(_S, False),
    event_timestamp=(_TS, False),
    user_id=(_S, True),
    session_id=(_S, True),
    event_type=(_S, False),
    source_system=(_S, False),
    country_code=(_S, True),
    device_type=(_S, True),
    payload=(_S, True),
    _ingestion_timestamp=(_TS, False),
    _partition_date=(_D, False),
)

STREAM_EVENTS_SCHEMA = _schema(
    event_id=(_S, False),
    event_timestamp=(_TS, False),
    user_id=(_S, True),
    event_type=(_S, True),
    payload=(_S, True),
)

CUSTOMERS_SCHEMA = _schema(
    user_id=(_S, False),
    customer_segment=(_S, True),
    acquisition_channel=(_S, True),
    customer_tenure_days=(_L, True),
    is_premium_subscriber=(_B, True),
)

TRANSACTIONS_SCHEMA = _schema(
    transaction_id=(_S, False),
    amount_usd=(MONEY, False),
    transaction_date=(_D, False),
    customer_id=(_S, False),
    synapse_load_timestamp=(_TS, True),
)

CONTROL_SCHEMA = _schema(
    pipeline_name=(_S, False),
    table_name=(_S, False),
    last_load_timestamp=(_TS, True),
    rows_copied=(_L, True),
)


@dataclass
class SchemaDifference:
    """How an actual schema departs from the declared one. Empty means equal."""

    extra: list[str] = field(default_factory=list)
    missing: list[str] = field(default_factory=list)
    retyped: list[str] = field(default_factory=list)
    reordered: bool = False

    def __bool__(self) -> bool:
        return bool(self.extra or self.missing or self.retyped or self.reordered)

    @property
    def additive_only(self) -> bool:
        return not (self.missing or self.retyped)

    def __str__(self) -> str:
        return (
            f"extra columns: {self.extra}, missing columns: {self.missing}, "
            f"other types: {self.retyped}, other order: {self.reordered}"
        )


class SchemaMismatch(ValueError):
    """Data offered for a write does not have the declared schema."""


def compare_schemas(actual: T.StructType, declared: T.StructType) -> SchemaDifference:
    """Compare names, types and order. Nullability is checked on the data, see `required_nulls`."""
    have = {f.name: f.dataType for f in actual}
    want = {f.name: f.dataType for f in declared}
    shared = [n for n in have if n in want]
    return SchemaDifference(
        extra=sorted(set(have) - set(want)),
        missing=sorted(set(want) - set(have)),
        retyped=[
            f"{n}: {have[n].simpleString()} instead of {want[n].simpleString()}"
            for n in shared
            if have[n] != want[n]
        ],
        reordered=shared != [n for n in want if n in have],
    )
