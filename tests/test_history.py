import datetime as dt
import random

import pytest
from conftest import rows

from pledgeline.operators.history import first_forward_moves

AS_OF = dt.date(2024, 12, 31)
# CN ranks below QU
ORDER = {"CN": 0, "QU": 1, "CU": 2, "PD": 3, "SP": 4}


def _history(table, events):
    """events: (proposal, stage id, stage, moment[, overrides])"""
    made = []
    for proposal, stage_id, code, moment, *more in events:
        row = dict(
            d_proposal_key=proposal,
            proposal_id=proposal,
            stage_id=stage_id,
            stage_code=code,
            move_order=ORDER[code],
            qu_move_order=0 if code == "PD" else ORDER[code],
            stage_adv_order=ORDER[code],
            stage_date=moment,
            record_effective_date="2000-01-01",
            record_expire_date="2999-12-31",
        )
        made.append(row | (more[0] if more else {}))
    return table("stage_history", made)


def _moves(df, **options):
    return rows(first_forward_moves(df, AS_OF, **options).selectExpr(
        "proposal_id", "cast(qualification_date as string)"))


def test_first_forward_move(table):
    events = [
        # back to CN first, then forward
        (1, 1, "QU", "2021-01-01"), (1, 2, "CN", "2021-01-02"), (1, 3, "QU", "2021-01-03"),
        (1, 4, "CU", "2021-01-04"),
        # QU is the last row
        (2, 5, "QU", "2021-01-01"),
        # two forward moves: the earliest counts
        (3, 6, "QU", "2021-01-01"), (3, 7, "CU", "2021-02-01"), (3, 8, "QU", "2021-03-01"),
        (3, 9, "CU", "2021-04-01"),
    ]
    assert _moves(_history(table, events)) == [
        (1, "2021-01-04 00:00:00"),
        (3, "2021-02-01 00:00:00"),
    ]


def test_same_day_rows_follow_stage_order(table):
    events = [(1, 1, "CU", "2021-01-01 08:00:00"), (1, 2, "QU", "2021-01-01 09:00:00")]
    # QU comes first on that day although entered later
    assert _moves(_history(table, events)) == [(1, "2021-01-01 08:00:00")]


def test_strict_variant(table):
    events = [(1, 1, "QU", "2021-01-01"), (1, 2, "PD", "2021-01-02"), (1, 3, "SP", "2021-01-03")]
    history = _history(table, events)
    assert _moves(history) == [(1, "2021-01-02 00:00:00")]
    assert _moves(history, move_order="qu_move_order") == []


def test_rows_outside_validity_or_without_proposal_are_ignored(table):
    expired = {"record_expire_date": "2024-06-01"}
    events = [
        (1, 1, "QU", "2021-01-01", expired), (1, 2, "CU", "2021-01-02"),
        (2, 3, "QU", "2021-01-01", {"proposal_id": None}), (2, 4, "CU", "2021-01-02"),
    ]
    assert _moves(_history(table, events)) == []


def test_missing_next_row_counts_as_zero(table):
    events = [(1, 1, "QU", "2021-01-01", {"move_order": -1})]
    assert _moves(_history(table, events)) == [(1, None)]


def test_missing_order_and_date_come_last(table):
    events = [
        (1, 1, "QU", "2021-01-01"),
        (1, 2, "CU", "2021-01-01", {"stage_adv_order": None}),
        (1, 3, "SP", None),
    ]
    assert _moves(_history(table, events)) == [(1, "2021-01-01 00:00:00")]


def _brute_force(events):
    """The same rule, row by row."""
    last = dt.datetime.max
    found = []
    for proposal in {e[0] for e in events}:
        mine = sorted(
            (e for e in events if e[0] == proposal),
            key=lambda e: (e[3] is None, (e[3] or last).date(), ORDER[e[2]], e[1]),
        )
        forward = [
            ((a[3] is None, a[3] or last, a[1]), b[3])
            for a, b in zip(mine, mine[1:])
            if a[2] == "QU" and ORDER[b[2]] > ORDER["QU"]
        ]
        if forward:
            moved = min(forward)[1]
            found.append((proposal, None if moved is None else str(moved)))
    return sorted(found, key=repr)


@pytest.mark.parametrize("size", [1, 300, 5000, 1 << 20])
def test_cutting_proposals_changes_nothing(table, block_ids, size):
    rng = random.Random(size)
    events = []
    for stage_id in rng.sample(range(10_000), 300):
        proposal = 1 if rng.random() < 0.4 else rng.randrange(2, 40)
        moment = dt.datetime(2021, 1, rng.randrange(1, 9), rng.randrange(24))
        if rng.random() < 0.02:
            moment = None
        events.append((proposal, stage_id, rng.choice(list(ORDER)), moment))
    expected = _brute_force(events)
    block_ids(size)
    assert _moves(_history(table, events)) == expected
