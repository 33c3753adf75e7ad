"""Payloads as variants: which keys there are, with which types, and columns for the common ones."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Spark's names of variant types, and the column types that hold all of their values.
TYPES = {"BIGINT": "bigint", "DOUBLE": "double", "BOOLEAN": "boolean", "STRING": "string"}
#: Whole numbers and decimals meet in these.
NUMBERS = ("BIGINT", "DECIMAL", "DOUBLE")


def fields(payload: str) -> Column:
    """A payload's top-level entries as variants; NULL where it is no JSON object."""
    return F.from_json(F.col(payload), "map<string,variant>", {"allowSingleQuotes": "false"})


def kind_of(value: Column) -> Column:
    """STRING, BIGINT, DECIMAL, DOUBLE, BOOLEAN, OBJECT, ARRAY, or VOID for a JSON null."""
    return F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)


def discover(df: DataFrame, payload: str) -> DataFrame:
    """(key, kind, rows): how many payloads hold a top-level key with a value of a kind."""
    each = df.select(F.explode(fields(payload)).alias("key", "value"))
    counted = each.withColumn("kind", F.when(F.col("value").isNull(), "VOID").otherwise(kind_of(F.col("value"))))
    return counted.groupBy("key", "kind").agg(F.count(F.lit(1)).alias("rows"))


def whole_schema(df: DataFrame, payload: str) -> str | None:
    """The merged schema of all payloads, nested values included."""
    parsed = F.try_parse_json(F.col(payload))
    return df.agg(F.schema_of_variant_agg(parsed)).first()[0]


@dataclass(frozen=True)
class PayloadColumn:
    key: str
    type: str


def choose_columns(found: DataFrame, total: int, share: float = 0.1, most: int = 200) -> list[PayloadColumn]:
    """Keys that at least `share` of `total` payloads hold, with one scalar type; the most frequent first.

    Values of several kinds of number make a double. A key with texts and numbers, or with nested values, stays in the
    rest. At most `most` keys are chosen, as a table can't have any number of columns; the others stay in the rest as well, and so does a key
    that differs from a more frequent one in case only.
    """
    kinds = F.sort_array(F.collect_set(F.when(F.col("kind") != "VOID", F.col("kind"))))
    keys = found.groupBy("key").agg(F.sum("rows").alias("rows"), kinds.alias("kinds"))
    some = keys.filter(F.col("rows") >= share * total).orderBy(F.desc("rows"), "key").limit(most).collect()
    out, taken = [], set()
    for row in some:
        if row.key.lower() in taken:  # column names don't tell cases apart
            continue
        taken.add(row.key.lower())
        if row.kinds and set(row.kinds) <= set(NUMBERS):
            out.append(PayloadColumn(row.key, "bigint" if row.kinds == ["BIGINT"] else "double"))
        elif len(row.kinds) == 1 and row.kinds[0] in TYPES:
            out.append(PayloadColumn(row.key, TYPES[row.kinds[0]]))
    return out


def typed_payload(
    df: DataFrame, payload: str, columns: Sequence[PayloadColumn], prefix: str = "", rest: str = "payload_rest"
) -> DataFrame:
    """Add a column for each chosen key, and `rest`: the other entries as JSON, NULL if there are none.

    A value that its column can't hold stays in the rest, and so does a payload that is no JSON object, as it is; nothing
    is lost. A column's name is `prefix` and the key.
    """
    names = [f"{prefix}{c.key}" for c in columns] + [rest]
    taken = {n.lower() for n in df.columns}
    clash = [n for n in names if n.lower() in taken]
    if clash or len({n.lower() for n in names}) < len(names):
        raise ValueError(f"column names are taken: {clash or names}")
    parsed = df.withColumn("_fields", fields(payload))
    values = {c: F.try_variant_get(F.col("_fields")[c.key], "$", c.type) for c in columns}
    plain = {"bigint": ("BIGINT",), "double": NUMBERS, "boolean": ("BOOLEAN",), "string": ("STRING",)}
    kept: dict[str, Column] = {}
    for c, value in values.items():
        entry = F.col("_fields")[c.key]
        fits = kind_of(entry).isin(list(plain[c.type]))
        if c.type == "double":  # a number that a double does not hold exactly stays in the rest
            whole_number = F.try_variant_get(entry, "$", "bigint")
            exact = F.when(kind_of(entry) == "BIGINT", F.abs(whole_number) <= 1 << 53)
            fits = fits & exact.otherwise(value.cast("string") == F.to_json(entry))
        kept[f"{prefix}{c.key}"] = F.when(fits, value)
    typed = parsed.withColumns(kept)

    def left(key: Column, value: Column) -> Column:
        held = F.lit(False)
        for c in columns:
            held = held | ((key == c.key) & F.col(f"`{prefix}{c.key}`").isNotNull())
        return ~held

    others = F.map_filter("_fields", left)
    written = F.when(F.size(others) > 0, F.to_json(others, {"ignoreNullFields": "false"}))
    whole = F.when(F.col("_fields").isNull(), F.col(payload)).otherwise(written)
    return typed.withColumn(rest, whole).drop("_fields")
