"""JSON payloads and web addresses."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.constants import URL_ORIGIN

_PLAIN_KEY = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")


def parse_payload(payload: str, keys: Sequence[str]) -> Column:
    """Parse a JSON text column once, into a struct with one text field per key."""
    for key in keys:
        if not _PLAIN_KEY.fullmatch(key):
            raise ValueError(f"payload key {key!r} is not a plain name")
    wanted = T.StructType([T.StructField(k, T.StringType()) for k in keys])
    return F.from_json(F.col(payload), wanted, {"allowSingleQuotes": "false"})


def json_scalar(parsed: str, payload: str, key: str) -> Column:
    """A scalar of the parsed payload as text; objects, arrays, null and missing keys give NULL.

    The parser renders objects and arrays as JSON text. Such text starts with a bracket, and so may an
    ordinary string, so only those few rows are looked at again to learn the type of the value.
    """
    text = F.col(parsed)[key]
    value = F.try_variant_get(F.try_parse_json(F.col(payload)), f"$.{key}", "variant")
    is_text = F.coalesce(F.schema_of_variant(value) == "STRING", F.lit(False))
    # Two nested conditions: joined by "and", Spark would parse every payload a second time.
    bracketed = text.startswith("{") | text.startswith("[")
    return F.when(bracketed, F.when(is_text, text)).otherwise(text)


def url_origin(url: str | Column) -> Column:
    """Scheme and host of a web address, NULL where there is none."""
    col = F.col(url) if isinstance(url, str) else url
    return F.regexp_substr(col, F.lit(URL_ORIGIN))
