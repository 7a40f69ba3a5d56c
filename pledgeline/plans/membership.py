"""A bitmap of a key set, to filter a fact where it is read, before any of it is shuffled.

A join with a key set shuffles the whole fact first. A bitmap of the hashes of the keys has a fixed size
(``BITS`` bits, 128 KB, whatever the number of keys), so every task of the scan can hold it: rows whose key
is surely not in the set never reach the shuffle. It lets some other keys through, the fewer the smaller the
set is against ``BITS``, so the exact join must follow.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 1 << 20


def _position(key: Column, bits: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(bits).cast("long"))


def bitmap(keys: DataFrame, bits: int = BITS) -> Column:
    """The bitmap of a table's single column, as a scalar subquery: an array of longs."""
    key = F.col(keys.columns[0])
    at = _position(key, bits)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(at, F.lit(64)).cast("int"))
    # every word once, those without a key as zero, in order
    words = keys.sparkSession.range(0, -(-bits // 64), 1, 1).select(
        F.col("id").alias("word"), F.lit(0).cast("long").alias("bits")
    )
    whole = (
        keys.filter(key.isNotNull())
        .select(F.floor(at / 64).cast("long").alias("word"), bit.alias("bits"))
        .union(words)
        .groupBy("word")
        .agg(F.bit_or("bits").alias("bits"))
    )
    in_order = F.sort_array(F.collect_list(F.struct("word", "bits")))
    return whole.agg(F.transform(in_order, lambda w: w["bits"]).alias("words")).scalar()


def may_hold(words: Column, key: Column, bits: int = BITS) -> Column:
    """False for keys that are surely not in the set, and for missing ones."""
    at = _position(key, bits)
    word = F.element_at(words, (F.floor(at / 64) + 1).cast("int"))
    shifted = F.call_function("shiftright", word, F.pmod(at, F.lit(64)).cast("int"))
    return F.coalesce(key.isNotNull() & (shifted.bitwiseAND(F.lit(1).cast("long")) == 1), F.lit(False))
