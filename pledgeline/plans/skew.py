"""Joins and row numbers that stay balanced when one key holds a large share of the rows.

Joins leave the splitting to adaptive execution, which measures the partitions of a sort-merge join
and cuts the oversized ones, or broadcasts an input that turned out small. It can only do so when
both inputs are shuffled for that join and nothing later relies on the join's partitioning;
``splittable_join`` sees to both.

Windows are not split by adaptive execution, so numbering cuts every group by fixed blocks of the id
it is ordered by. An id identifies a row, so a block holds at most ``BLOCK_IDS`` rows (times ties), and
one task never has to hold more of a group than that.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Ids in a block: enough that small groups stay whole, few enough for one task to order.
BLOCK_IDS = 1 << 20


@dataclass(frozen=True)
class Layout:
    """The key that stored facts are bucketed by, and its values that are too hot for one task."""

    key: str
    hot: tuple = ()


_LAYOUT: ContextVar[Layout | None] = ContextVar("layout", default=None)


@contextmanager
def colocated(layout: Layout) -> Iterator[None]:
    """Build queries for facts in a layout (see ``sources.layout``)."""
    before = _LAYOUT.set(layout)
    try:
        yield
    finally:
        _LAYOUT.reset(before)


def splittable_join(
    facts: DataFrame, lookup: DataFrame, keys: list[str], how: str = "inner"
) -> DataFrame:
    """Equi-join (inner, left or left_semi) whose oversized partitions can be split at run time.

    A lookup aggregated on the join key would be joined in place, without an exchange, and adaptive
    execution does not split such a join: all facts of a hot key would meet in one task. Joining on
    the key and one bit of its hash shuffles both sides for this join (the lookup once more, which
    has one row per key), and no later grouping can reuse that partitioning.

    Where facts are co-located by the key, only the rows of hot keys are joined like that; the others
    meet in their buckets, without an exchange.
    """
    layout = _LAYOUT.get()
    if layout is not None and keys == [layout.key]:
        return _bucketed_join(facts, lookup, layout, how)
    return _split_join(facts, lookup, keys, how)


def _bucketed_join(facts: DataFrame, lookup: DataFrame, layout: Layout, how: str) -> DataFrame:
    key = F.col(layout.key)
    if not layout.hot:
        return facts.join(lookup, layout.key, how)
    ordinary = F.lit(True)
    for value in layout.hot:
        # one comparison each: files tell from their statistics that all of a row group is hot
        ordinary = ordinary & (key != value)
    is_hot = key.isin(list(layout.hot))
    in_place = facts.filter(ordinary | key.isNull()).join(lookup.filter(ordinary), layout.key, how)
    return in_place.unionByName(
        _split_join(facts.filter(is_hot), lookup.filter(is_hot), [layout.key], how)
    )


def _split_join(facts: DataFrame, lookup: DataFrame, keys: list[str], how: str) -> DataFrame:
    bit = F.pmod(F.xxhash64(*keys), F.lit(2).cast("long"))
    return (
        facts.withColumn("_bit", bit)
        .join(lookup.withColumn("_bit", bit), [*keys, "_bit"], how)
        .drop("_bit")
    )


def largest_per_key(rows: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """The largest value of each column per key, texts included, one row per key.

    For rows that hash aggregation has brought down to a few per key: an aggregate of a text sorts its
    input before and after the shuffle, this sorts it once.
    """
    same = Window.partitionBy(key)
    tops = [F.max(c).over(same).alias(c) for c in columns]
    first = F.row_number().over(same.orderBy(F.lit(0))).alias("_first")
    return rows.select(key, *tops, first).filter("_first = 1").drop("_first")


def block_of(id_column: str):
    """The block of an id; ids that are missing make a block of their own."""
    return F.floor(F.col(id_column) / F.lit(BLOCK_IDS)).cast("long")


def number_rows(
    rows: DataFrame, numberings: dict[str, list[str]], order_by: str, ties: list[str]
) -> DataFrame:
    """``row_number()`` in the order of an integer column, missing ones last, per set of keys.

    ``numberings`` gives the keys of each new column. A row's number is its number within its block
    plus the sizes of the blocks before it. All sizes come from one grouping of the rows by the keys
    of all numberings and block, which adaptive execution evaluates once.
    """
    if not numberings:
        return rows
    cut = rows.withColumn("_block", block_of(order_by))
    every = sorted({key for keys in numberings.values() for key in keys})
    # one struct as key: no partitioning that is there already serves, so there is an exchange, which all
    # numberings read; by plain keys that are stored together the rows would be made again for each
    counted = (
        cut.groupBy(F.struct(*every, "_block").alias("_of"))
        .agg(F.count(F.lit(1)).alias("_size"))
        .select(*[F.col("_of")[k].alias(k) for k in (*every, "_block")], "_size")
    )
    for name, keys in numberings.items():
        # one struct as key: it is never null, so the join keeps the partitioning of the window
        at = F.struct(*keys, "_block")
        before = (
            Window.partitionBy(*keys)
            .orderBy(F.col("_block").asc_nulls_last())
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        offsets = (
            counted.groupBy(*keys, "_block")
            .agg(F.sum("_size").alias("_size"))
            .select(at.alias("_at"), F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
        )
        within = Window.partitionBy("_at").orderBy(
            F.col(order_by).asc_nulls_last(), *[F.col(c).asc_nulls_last() for c in ties]
        )
        number = (F.col("_number") + F.col("_before")).cast("int").alias(name)
        cut = (
            cut.withColumn("_at", at)
            .withColumn("_number", F.row_number().over(within))
            .join(offsets, "_at")
            .select(*[c for c in cut.columns if c != "_block"], "_block", number)
        )
    return cut.drop("_block")
