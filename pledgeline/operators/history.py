"""First forward move out of stage QU, from validity-dated stage history."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pledgeline.plans.skew import block_of


def first_forward_moves(
    history: DataFrame, as_of: dt.date | dt.datetime, move_order: str = "move_order"
) -> DataFrame:
    """Per proposal, the date of the stage that followed the earliest forward move out of QU.

    Rows are ordered by day, then stage order, then id, missing values last; a move is forward if the
    next row has a higher ``move_order`` (0 stands in where there is no next row). Of several forward
    moves the one with the earliest full stage date, then id, counts. ``move_order="qu_move_order"``
    gives the stricter variant.

    Neighbours are found in three steps, each of which leaves one summary per part (its earliest
    move, its first and its last row): within the rows of one day, stage order and block of ids, then
    between the blocks of a day, then between the days of a proposal. So no task orders more than a
    block of rows, one day's stage orders times blocks, or one proposal's days.
    """
    live = history.filter(
        F.lit(as_of).between(F.col("record_effective_date"), F.col("record_expire_date"))
        & F.col("proposal_id").isNotNull()
    )
    row = F.struct(
        "stage_code", F.col(move_order).alias("move"), "stage_date", "stage_id", "proposal_id"
    )
    parts = live.select(
        "d_proposal_key",
        F.to_date("stage_date").alias("day"),
        F.col("stage_adv_order").alias("adv"),
        block_of("stage_id").alias("block"),
        "stage_id",
        row.alias("first"),
        row.alias("last"),
    ).withColumn("best", F.lit(None).cast(_DEPARTURE))
    parts = _joined(parts, ["d_proposal_key", "day", "adv", "block"], ["stage_id"])
    parts = _joined(parts, ["d_proposal_key", "day"], ["adv", "block"])
    parts = _joined(parts, ["d_proposal_key"], ["day"])
    # nothing follows the last row of a proposal
    at_end = F.when(_leaves(F.col("last"), F.lit(0)), _departure(F.col("last"), F.lit(None)))
    return (
        parts.select(F.least("best", at_end.cast(_DEPARTURE)).alias("move"))
        .filter("move is not null")
        .select("move.proposal_id", F.col("move.moved").alias("qualification_date"))
    )


# ordered by full stage date, missing last, then id
_DEPARTURE = """struct<undated:boolean, stage_date:timestamp, stage_id:bigint, proposal_id:bigint,
    moved:timestamp>"""


def _leaves(row: Column, next_move: Column) -> Column:
    return (row["stage_code"] == "QU") & (next_move > row["move"])


def _departure(row: Column, moved: Column) -> Column:
    return F.struct(
        row["stage_date"].isNull().alias("undated"),
        row["stage_date"].alias("stage_date"),
        row["stage_id"].alias("stage_id"),
        row["proposal_id"].alias("proposal_id"),
        moved.cast("timestamp").alias("moved"),
    ).cast(_DEPARTURE)


def _joined(parts: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One summary per ``keys`` of parts that follow each other in the given order."""
    in_order = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_last() for c in order])
    following = F.lead("first").over(in_order)
    return (
        parts.select(
            *keys,
            "first",
            "last",
            "best",
            following.alias("following"),
            F.lag(F.lit(True)).over(in_order).isNull().alias("is_first"),
            F.lead(F.lit(True)).over(in_order).isNull().alias("is_last"),
        )
        .groupBy(*keys)
        .agg(
            F.min(F.when(F.col("is_first"), F.col("first"))).alias("first"),
            F.min(F.when(F.col("is_last"), F.col("last"))).alias("last"),
            F.least(
                F.min("best"),
                F.min(
                    F.when(
                        _leaves(F.col("last"), F.col("following.move")),
                        _departure(F.col("last"), F.col("following.stage_date")),
                    )
                ),
            ).alias("best"),
        )
    )
