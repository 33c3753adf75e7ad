"""Uniqueness against history by membership filters, so that history is read only where a key may be.

A filter is a table of words of a bit field, one row for each word with a set bit. Filters of days are merged by
taking the words' bits together, in Spark as in the filter: `bit_or`. A key whose bits are all set may be known, any other
key is not; only keys that may be known are looked for in the history itself.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.operators.keyed import small_side
from eventide.operators.merge import touched_partitions
from eventide.sources.lake import read_table, replace_days
from eventide.storage import materialize, table_exists

#: Bits of one day's filter (8 MB if all words are used), and bits a key sets. Of ten million keys a day,
#: eight in a thousand unknown ones seem known.
BITS = 1 << 26
PROBES = 4
FILTER = "word long, bits long, event_date date"


def probes(key: Column, bits: int = BITS, count: int = PROBES) -> Column:
    """The places of a key's bits."""
    return F.array(*[F.pmod(F.xxhash64(F.lit(i), key), F.lit(bits)) for i in range(count)])


def _placed(rows: DataFrame, columns: list[str], key: Column, bits: int, count: int) -> DataFrame:
    """`columns` with word and bit of each probe of a key."""
    each = rows.select(*columns, F.explode(probes(key, bits, count)).alias("place"))
    bit = F.expr("shiftleft(1L, cast(place % 64 AS INT))")
    return each.select(*columns, F.shiftright("place", 6).alias("word"), bit.alias("bit"))


def day_filters(rows: DataFrame, key: str, day: str, bits: int = BITS, count: int = PROBES) -> DataFrame:
    """(event_date, word, bits): the filter of each day's keys. Map tasks put the bits of a word together first."""
    known = rows.filter(F.col(key).isNotNull()).select(F.col(day).alias("event_date"), F.col(key).alias("key"))
    placed = _placed(known, ["event_date"], F.col("key"), bits, count)
    return placed.groupBy("event_date", "word").agg(F.bit_or("bit").alias("bits"))


def merged(filters: DataFrame) -> DataFrame:
    """One filter of all days: at most bits / 64 rows, whatever the number of days."""
    return filters.groupBy("word").agg(F.bit_or("bits").alias("bits"))


def maybe_known(
    keys: DataFrame, key: str, filters: DataFrame, bits: int = BITS, count: int = PROBES
) -> DataFrame:
    """(key, event_date) where that day's filter may hold the key: all known pairs, and few others.

    A key's probes meet the words of all days; what survives is counted by key and day. Days hold words by
    themselves, so a key is looked for only where all of its bits are set.
    """
    some = merged(filters)
    placed = keys.select(F.col(key).alias("key")).dropna().distinct()
    placed = _placed(placed, ["key"], F.col("key"), bits, count).distinct()  # two probes may fall on one bit
    needed = placed.groupBy("key").agg(F.count(F.lit(1)).alias("needed"))
    hit = F.col("bits").bitwiseAND(F.col("bit")) != 0
    held = placed.join(some, "word").filter(hit).groupBy("key").agg(F.count(F.lit(1)).alias("held"))
    candidates = held.join(needed, "key").filter("held = needed").select("key", "needed")
    candidates = small_side(materialize(candidates, "maybe-known"))
    again = placed.join(candidates, "key").join(filters, "word").filter(hit)
    by_day = again.groupBy("key", "event_date", "needed").agg(F.count(F.lit(1)).alias("held"))
    return by_day.filter("held = needed").select("key", "event_date")


def known_keys(
    new: DataFrame, history: DataFrame, filters: DataFrame, key: str, day: str, bits: int = BITS, count: int = PROBES
) -> DataFrame:
    """(key, days): keys of `new` that are in the history, with the days they are on; exact.

    Only days are read that may hold one of the keys, and of these only rows whose key may be known are joined,
    with the few candidates broadcast; so no row of the history is shuffled unless it is a candidate.
    """
    maybe = materialize(maybe_known(new, key, filters, bits, count), "candidates")
    rows, _ = touched_partitions(history, maybe.select(F.col("event_date").alias(day)), day)
    pairs = maybe.select(F.col("key").alias("_key"), F.col("event_date").alias("_day"))
    near = rows.select(F.col(key).alias("key"), F.col(day).alias("event_date"))
    found = near.join(small_side(pairs), (F.col("key") == F.col("_key")) & (F.col("event_date") == F.col("_day")))
    return found.groupBy("key").agg(F.sort_array(F.collect_set("event_date")).alias("days"))


def repeated_in_history(
    new: DataFrame, history: DataFrame, filters: DataFrame, key: str, day: str, bits: int = BITS, count: int = PROBES
) -> DataFrame:
    """Keys of `new` that break uniqueness: (unique_field, n_records, known_days), with rows in `new` and days before."""
    own = new.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("n_records"))
    known = known_keys(new, history, filters, key, day, bits, count)
    none = F.array().cast("array<date>")
    both = own.join(known, "key", "left").withColumn("known_days", F.coalesce("days", none))
    both = both.filter((F.col("n_records") > 1) | (F.size("known_days") > 0))
    return both.select(F.col("key").alias("unique_field"), "n_records", "known_days")


def store_filters(spark: SparkSession, path: str, rows: DataFrame, key: str, day: str, days: list[str]) -> DataFrame:
    """Write the filters of some days and give those of all other stored days."""
    stored = read_table(spark, path, FILTER) if table_exists(spark, path) else spark.createDataFrame([], FILTER)
    listed = [F.lit(d).cast("date") for d in days]
    others = stored.filter(~reduce(lambda a, b: a | b, [F.col("event_date") == d for d in listed]))
    others = materialize(others, "other-filters")
    replace_days(day_filters(rows, key, day), path, "event_date", days)
    return others
