"""Column helpers. All of them are Spark expressions; none needs Python on the executors."""

from eventide.functions.hashing import no_salt, row_hashes, salt_where_null, sha256_hex, surrogate_key
from eventide.functions.moments import (
    hour_floor,
    in_days,
    utc_day,
    whole_seconds_between,
)
from eventide.functions.predicates import all_of, any_null
from eventide.functions.text import json_scalar, parse_payload, url_origin

__all__ = [
    "all_of",
    "any_null",
    "hour_floor",
    "in_days",
    "json_scalar",
    "no_salt",
    "parse_payload",
    "row_hashes",
    "salt_where_null",
    "sha256_hex",
    "surrogate_key",
    "url_origin",
    "utc_day",
    "whole_seconds_between",
]
