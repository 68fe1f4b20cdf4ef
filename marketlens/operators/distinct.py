"""Exact distinct counts kept as bitmaps, so that they can be merged later.

A count of distinct orders (or customers) per month cannot be added up over months:
a customer may buy in several. ``keep_bitmaps`` keeps, for each group, the set itself:

1. every distinct key gets a number. Keys are numbered in the order of the first group they occur
   in, so that the numbers of a month lie close together and fill few bitmaps;
2. for each group and each bucket of 32,768 numbers there is one bitmap of 4 KB
   (``bitmap_construct_agg``, which folds before the shuffle);
3. any set of groups is answered from the kept table alone: the bitmaps of a bucket are
   merged (``bitmap_or_agg``) and their bits counted.

Scale: one shuffle by key for the numbers and one for the join; a hot key is one row per group
after the distinct, and range bounds hold the key itself, so that a busy month is
numbered by many tasks. Null keys are not counted, as in ``COUNT(DISTINCT)``; null groups are groups.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.session import materialize


def number_keys(rows: DataFrame, key: str, groups: list[str]) -> DataFrame:
    """(key, number): one number for each key, close together for keys of one first group."""
    first = (rows.where(F.col(key).isNotNull()).groupBy(key)
             .agg(F.min(F.struct(*groups)).alias("_first")).repartitionByRange("_first", key))
    return materialize(first.sortWithinPartitions("_first", key)
                       .select(key, F.monotonically_increasing_id().alias("_number")), "numbers")


def keep_bitmaps(rows: DataFrame, key: str, groups: list[str]) -> DataFrame:
    """(groups, bucket, bitmap): the distinct keys of every group, written to the shared folder."""
    pairs = materialize(rows.select(key, *groups).distinct(), "pairs")
    numbered = pairs.join(number_keys(pairs, key, groups), key)
    return materialize(numbered.groupBy(*groups, F.bitmap_bucket_number("_number").alias("bucket"))
                       .agg(F.bitmap_construct_agg(F.bitmap_bit_position("_number")).alias("bitmap")), "bitmaps")


def count_distinct(bitmaps: DataFrame, by: list[str], name: str) -> DataFrame:
    """Distinct keys for each value of ``by``, columns of the bitmaps' groups; the others are merged."""
    merged = bitmaps.groupBy(*by, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    return merged.groupBy(*by).agg(F.sum(F.bitmap_count("bitmap")).alias(name))
