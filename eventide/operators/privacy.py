"""Personal data: hashing, dropping, redacting payloads, and checking that none is left."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.functions import sha256_hex

# Column names that must not reach a table without personal data.
PERSONAL_COLUMNS = ["email", "phone", "full_name", "ssn", "ip_address", "address", "date_of_birth"]

# Text that looks like personal data.
PERSONAL_PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+\.[A-Za-z]{2,}",
    "phone": r"\+[0-9]{1,3}[ -][0-9]{2,4}[ -][0-9]{3,4}[ -][0-9]{3,4}",
    "ip_address": r"\b[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\b",
    "ssn": r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b",
}

# Text that every match contains; looking for it is much cheaper than trying the pattern.
_NEEDED = {"email": "@", "phone": "+", "ip_address": ".", "ssn": "-"}


def pseudonymize(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace columns by their SHA-256 digests, named with a `_hash` ending."""
    return df.withColumns({f"{c}_hash": sha256_hex(c) for c in columns}).drop(*columns)


def redact_payload(df: DataFrame, payload: str, denied: Sequence[str]) -> DataFrame:
    """Drop keys from a JSON text column, in any case; the other values keep their type and nesting.

    A top-level value that holds a denied key at any depth goes as a whole. A payload that is not a JSON
    object cannot be checked and becomes NULL. A payload in whose text no denied key can occur, not even in
    escaped form, is passed on as it is.
    """
    names, text = df.columns, F.col(payload)
    parsed = df.withColumn("_fields", F.from_json(text, "map<string,variant>", {"allowSingleQuotes": "false"}))
    suspect = text.contains("\\")
    names_denied = [d.lower() for d in denied]
    for key in names_denied:
        suspect = suspect | F.lower(text).contains(key)
    inside = r'(?i)"(?:' + "|".join(map(re.escape, denied)) + r')"\s*:'

    def allowed(key: Column, value: Column) -> Column:
        return ~F.lower(key).isin(names_denied)

    def allowed_whole(key: Column, value: Column) -> Column:
        return allowed(key, value) & ~F.coalesce(F.to_json(value).rlike(inside), F.lit(False))

    # Only where a bracket opens after the first can a value hold keys of its own.
    nested = text.rlike(r"^\s*\{[^\[{]*[\[{]")
    kept = F.when(nested, F.map_filter("_fields", allowed_whole)).otherwise(F.map_filter("_fields", allowed))
    rewritten = F.to_json(kept, {"ignoreNullFields": "false"})
    clean = F.when(F.col("_fields").isNull(), F.lit(None)).when(suspect, rewritten).otherwise(text)
    return parsed.withColumn(payload, clean).select(*names)


def personal_columns(df: DataFrame, denied: Sequence[str] = PERSONAL_COLUMNS) -> list[str]:
    """Columns whose name, or a part of it between underscores, says that they hold personal data.

    Digests, whose names end in `_hash`, do not.
    """
    part = re.compile("(^|_)(" + "|".join(re.escape(d.lower()) for d in denied) + ")(_|$)")
    return [c for c in df.columns if part.search(c.lower()) and not c.lower().endswith("_hash")]


def require_impersonal(df: DataFrame, denied: Sequence[str] = PERSONAL_COLUMNS) -> DataFrame:
    """The same rows, if no column is named like personal data."""
    found = personal_columns(df, denied)
    if found:
        raise ValueError(f"columns with personal data: {found}")
    return df


def scan_text(
    df: DataFrame, columns: Sequence[str] | None = None, patterns: Mapping[str, str] = PERSONAL_PATTERNS
) -> DataFrame:
    """Rows that look like personal data, per text column and pattern, in one pass over whole texts."""
    columns = list(columns or [f.name for f in df.schema if isinstance(f.dataType, T.StringType)])
    pairs = [(c, name, rx) for c in columns for name, rx in patterns.items()]

    def matches(column: str, name: str, pattern: str) -> Column:
        found = F.col(column).rlike(pattern)
        needed = _NEEDED.get(name) if patterns is PERSONAL_PATTERNS else None
        return F.col(column).contains(needed) & found if needed else found

    counts = df.agg(*[F.count_if(matches(*pair)).alias(f"n{i}") for i, pair in enumerate(pairs)])
    lines = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.lit(name).alias("pattern"),
            F.col(f"n{i}").alias("matching_rows"),
        )
        for i, (c, name, _) in enumerate(pairs)
    ]
    return counts.select(F.inline(F.array(*lines)))
