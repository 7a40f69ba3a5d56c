import datetime as dt
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_portfolio import assigned, held

from pledgeline.operators.outcomes import (
    total_qualifications,
    unit_disqualified,
    unit_flags,
    unit_outcomes,
    unit_qualified,
    window_portfolio,
)
from pledgeline.operators.qualifications import (
    CAMPUS,
    any_day_between,
    qualification_counts,
    qualification_exclusions,
    qualifications,
    stage_facts,
)

START, END, AS_OF = "2021-07-01", "2022-06-30", "2022-12-31"


def moves(proposal, *stages):
    """Stage events (code, day), with ids in the order given."""
    return [
        dict(proposal_stage_id=proposal * 100 + i, proposal_id=proposal, stage_code=c, stage_date=d)
        for i, (c, d) in enumerate(stages)
    ]


QUALIFIED = (("QU", "2021-01-01"), ("CU", "2021-09-01"))


@pytest.fixture
def inputs(table, spark):
    def make(assignments, stages, proposals, units=None):
        units = units or sorted({(a["assignment_entity_id"], a["office_code"])
                                 for a in assignments})
        portfolio = spark.createDataFrame(
            units, "assignment_entity_id long, office_code string")
        return (portfolio, table("assignment", assignments), table("stage", stages),
                table("proposal", proposals))

    return make


def _ids(df):
    return [tuple(r) for r in rows(df, "assignment_entity_id", "proposal_id")]


def test_inclusion(inputs):
    stages = (
        moves(1, *QUALIFIED)
        + moves(2, ("QU", "2021-10-01"), ("CU", "2021-09-01"))  # moved before QU
        + moves(3, ("CU", "2021-09-01"))  # never in QU
        + moves(4, ("QU", "2021-09-01"), ("CU", "2021-09-01"))  # same day is not after
        + moves(5, ("QU", "2021-01-01"), ("CN", "2021-09-01"))  # CN does not qualify
        + moves(6, ("QU", "2021-01-01"), ("CU", "2022-07-01"))  # after the window
    )
    everyone = [assigned(i, 1, i, start_date="2020-01-01") for i in range(1, 7)]
    data = inputs(everyone, stages, [held(i) for i in range(1, 7)])
    assert _ids(qualifications(*data, START, END)) == [(1, 1)]
    assert rows(qualification_counts(qualifications(*data, START, END))) == [(1, "A", 1)]


def test_assignment_must_cover_the_move(inputs):
    stages = moves(1, *QUALIFIED)
    assignments = [
        assigned(1, 1, 1, start_date="2021-09-01", stop_date="2021-09-01"),
        assigned(2, 2, 1, start_date="2021-09-02"),
        assigned(3, 3, 1, start_date="2020-01-01", stop_date="2021-08-31"),
        assigned(4, 4, 1),  # no start date
    ]
    data = inputs(assignments, stages, [held(1)])
    assert _ids(qualifications(*data, START, END)) == [(1, 1)]
    assert _ids(qualification_exclusions(*data, START, END)) == [(2, 1), (3, 1)]


def test_stopped_or_dead_proposals_are_excluded_whatever_their_stages(inputs):
    stages = sum((moves(i, *QUALIFIED) for i in range(1, 6)), []) + moves(6, ("QU", "2021-01-01"))
    proposals = [
        held(1, stop_dt="2021-06-30"),
        held(2, stop_dt="2021-07-01"),
        # died in QU: expected on a month end, six months later is the last of August
        held(3, stage_code="QU", active_ind="N", expected_date="2021-02-28"),
        held(4, stage_code="QU", active_ind="N", expected_date="2020-12-30"),
        held(5, stage_code="QU", active_ind="Y", expected_date="2020-12-30"),
        held(6, stop_dt="2021-06-30"),
    ]
    assignments = [assigned(i, 1, i, start_date="2020-01-01") for i in range(1, 7)]
    data = inputs(assignments, stages, proposals)
    assert _ids(qualifications(*data, START, END)) == [(1, 2), (1, 3), (1, 5)]
    assert _ids(qualification_exclusions(*data, START, END)) == [(1, 1), (1, 4), (1, 6)]


def test_cn_excludes_here_but_not_in_the_unit_report(inputs):
    stages = moves(1, ("QU", "2021-01-01"), ("CN", "2021-02-01"), ("CU", "2021-09-01"))
    data = inputs([assigned(1, 1, 1, start_date="2020-01-01")], stages, [held(1)])
    assert _ids(qualifications(*data, START, END)) == []
    _, assignment, stage, proposal = data
    assert _ids(unit_qualified(assignment, stage, proposal, "A", START, END)) == [(1, 1)]


def test_filters_bear_on_inclusion_only(inputs):
    stages = moves(1, *QUALIFIED) + moves(2, *QUALIFIED)
    assignments = [
        assigned(1, 1, 1, "A", start_date="2020-01-01"),
        assigned(2, 1, 2, "B", start_date="2020-01-01"),
        # an assignment in another unit excludes proposal 1 all the same
        assigned(3, 2, 1, "A", start_date="2020-01-01"),
        assigned(4, 2, 1, "B", start_date="2022-01-01"),
    ]
    data = inputs(assignments, stages, [held(1), held(2, proposal_type="ESP")],
                  units=[(1, "A"), (1, "B"), (2, "A")])
    run = lambda **o: rows(qualifications(*data, START, END, **o),
                           "assignment_entity_id", "office_code", "proposal_id")
    # the result carries every unit the fundraiser has in the portfolio
    assert run() == [(1, "A", 1), (1, "A", 2), (1, "B", 1), (1, "B", 2)]
    assert run(offices=["A"]) == [(1, "A", 1), (1, "B", 1)]
    assert run(plan_types=["ESP"]) == [(1, "A", 2), (1, "B", 2)]


def _brute_force(assignments, stages, proposals):
    """Every combination of assignment, stage, proposal and QU date, as in the definition."""
    day = lambda x: None if x is None else dt.date.fromisoformat(x)
    first, last = day(START), day(END)
    included, excluded = set(), set()
    for a in assignments:
        for s in (s for s in stages if s["proposal_id"] == a["proposal_id"]):
            for p in (p for p in proposals if p["proposal_id"] == a["proposal_id"]):
                for q in stages:
                    if q["proposal_id"] != a["proposal_id"] or q["stage_code"] != "QU":
                        continue
                    if day(q["stage_date"]) > last:
                        continue
                    key = (a["assignment_entity_id"], a["proposal_id"])
                    on, begin, stop = (day(s["stage_date"]), day(a.get("start_date")),
                                       day(a.get("stop_date")))
                    if (s["stage_code"] in CAMPUS.include and first <= on <= last
                            and begin and begin <= on and (stop is None or stop >= on)
                            and on > day(q["stage_date"])):
                        included.add(key)
                    stopped = day(p.get("stop_dt"))
                    if (s["stage_code"] in CAMPUS.exclude and (
                            on < first or (begin and begin > on) or (stop and stop < on))) or (
                            stopped and stopped < first):
                        excluded.add(key)
    return sorted(included - excluded, key=repr), sorted(excluded, key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_against_every_combination(inputs, seed):
    rng = random.Random(seed)
    on = lambda: str(dt.date(2021, 5, 1) + dt.timedelta(rng.randrange(500)))
    maybe = lambda x: x if rng.random() < 0.7 else None
    stages = sum((
        moves(p, ("QU", on()), *[(rng.choice(["QU", "CU", "SP", "CN", "DQ", "NR"]), on())
                                 for _ in range(rng.randrange(4))]) for p in range(60)), [])
    assignments = [
        assigned(i, rng.randrange(8), rng.randrange(60), start_date=maybe(on()),
                 stop_date=maybe(on())) for i in range(200)
    ]
    proposals = [held(p, stop_dt=on() if rng.random() < 0.2 else None, expected_date=None)
                 for p in range(60)]
    net, excluded = _brute_force(assignments, stages, proposals)
    data = inputs(assignments, stages, proposals)
    assert net and excluded
    assert _ids(qualifications(*data, START, END)) == net
    assert _ids(qualification_exclusions(*data, START, END)) == excluded
    # the two never overlap
    both = qualifications(*data, START, END).join(
        qualification_exclusions(*data, START, END),
        ["assignment_entity_id", "office_code", "proposal_id"], "left_semi")
    assert both.count() == 0


def test_disqualified_does_not_need_a_proposal_row(inputs):
    stages = moves(1, ("QU", "2021-01-01"), ("DQ", "2021-09-01"))
    _, assignment, stage, proposal = inputs(
        [assigned(1, 1, 1, start_date="2020-01-01"), assigned(2, 2, 1, start_date="2022-01-01")],
        stages, [held(7)])
    assert _ids(unit_disqualified(assignment, stage, proposal, "A", START, END)) == [(1, 1)]


def test_unit_flags(inputs):
    assignments = [
        assigned(1, 1, 1, "A", start_date="2020-01-01"),
        assigned(2, 2, 1, "A", start_date="2020-01-01"),
        assigned(3, 2, 1, "B", start_date="2019-01-01"),  # active elsewhere
        assigned(4, 3, 1, "A", start_date="2020-01-01"),
        assigned(5, 3, 1, "B", start_date="2021-01-01", active_ind="N"),
        assigned(6, 4, 1, "B", start_date="2021-01-01"),
        assigned(7, 5, 1, "A"),  # no start date
        assigned(8, 6, 9, "A", start_date="2020-01-01"),  # no such proposal
    ]
    _, assignment, _, proposal = inputs(assignments, moves(1, *QUALIFIED), [held(1)])
    flags = unit_flags(assignment, proposal, "A")
    assert rows(flags, "assignment_entity_id", "flg", "flg2", "unit_exclusive") == [
        (1, "Y", "N", True),
        (2, "Y", "Y", False),
        (3, "Y", "N", True),
        (4, "N", "Y", False),
        (5, "Y", "N", False),
    ]
    assert rows(unit_flags(assignment, proposal, "A", fundraisers=[1]).filter("unit_exclusive"),
                "assignment_entity_id") == [(1,)]


def test_unit_outcomes(inputs, table):
    stop = dict(stop_dt="2021-10-01")
    proposals = [
        held(1, stage_code="RP", granted_amt=5, **stop),
        held(2, stage_code="CN", **stop),
        held(3, stage_code="CN", granted_amt=5, **stop),
        held(4, stage_code="TD", **stop),
        held(5, stage_code="NR", **stop),
        held(6, stage_code="DQ", **stop),
        held(7, stage_code="SP"),
        held(8, stage_code="TD", stop_dt="2022-07-01"),
    ]
    assignments = [assigned(i, 1, i, start_date="2020-01-01") for i in range(1, 9)] + [
        assigned(20, 1, 7, start_date="2021-08-01"),
        assigned(21, 1, 4, start_date="2020-01-01", stop_date="2021-09-01"),
        assigned(22, 2, 1, start_date="2020-01-01"),  # not staff
        assigned(23, 3, 1, start_date="2020-01-01"),
        assigned(24, 3, 2, "B", start_date="2020-01-01"),  # works elsewhere too
    ]
    stages = moves(6, ("QU", "2021-01-01"), ("DQ", "2021-10-01")) + moves(7, *QUALIFIED)
    _, assignment, stage, proposal = inputs(assignments, stages, proposals)
    staff = table("record_type", [dict(entity_id=p, record_type_code="SF") for p in (1, 3)]
                  + [dict(entity_id=1, record_type_code="AL")])
    run = lambda **o: [r.asDict() for r in unit_outcomes(
        assignment, proposal, stage, staff, "A", START, END, AS_OF, **o).collect()]
    assert run() == [dict(
        assignment_entity_id=1, assignment_first_name="F", assignment_last_name="L1",
        starts=1, stops=6, cn_stop=1, td_stop=1, dq_stop=1, nr_stop=1,
        # RP is among the other stops
        other_stop=1, rp_stop=1,
        # the assignment that began in August excludes nothing; proposal 7 moved on 1 September
        qual_cnt=1, portfolio=10)]
    # plan types empty the counts, not the list of people; DQ ignores them
    assert run(plan_types=["ESP"]) == []
    assert run(fundraisers=[2]) == []


def test_window_portfolio(inputs, table):
    cads = lambda p, who, begin, end=None, unit="A": dict(
        proposal_id=p, assigned_to_entity_id_nbr=who, assignment_begin_dt=begin,
        assignment_end_dt=end, office_assigned_to_cd=unit)
    assignments = table("dated_assignment", [
        cads(1, 1, "2020-01-01", "2021-12-31"), cads(1, 1, "2021-02-01"),
        cads(1, 2, "2022-07-01"), cads(1, 3, "2020-01-01", "2021-06-30"),
        cads(1, 4, "2020-01-01", unit="B"), cads(2, 1, "2020-01-01"), cads(3, 1, "2020-01-01"),
    ])
    proposals = table("proposal", [
        held(1, proposal_stage_begin_dt="2022-12-01", stage_code="QU"),
        held(1, proposal_stage_begin_dt="2022-12-21", stage_code="CU", entity_id=5),
        held(2, stop_dt="2021-06-30"), held(3, start_dt="2022-07-01"),
    ])
    got = window_portfolio(assignments, proposals, "A", START, END, AS_OF)
    day = dt.date
    assert rows(got, "proposal_id", "assigned_to_entity_id_nbr", "stage", "days_in_stage",
                "assign_begin_dt", "assign_end_dt") == [
        (1, 1, "QU", 30, day(2020, 1, 1), day(2022, 12, 31))]


def test_total_qualifications(inputs, table):
    stages = (
        moves(1, *QUALIFIED, ("PD", "2021-11-05"))  # two moves: the later id counts
        + moves(2, *QUALIFIED)
    )
    assignments = [
        assigned(1, 1, 1, start_date="2020-01-01"),
        assigned(2, 1, 2, start_date="2020-01-01"),
        # excluded for fundraiser 2 only, yet gone for all
        assigned(3, 2, 2, start_date="2022-01-01"),
    ]
    _, assignment, stage, proposal = inputs(
        assignments, stages, [held(i, stage_desc="d", stage_code="PD") for i in (1, 2)])
    dated = table("dated_assignment", [
        dict(proposal_id=a["proposal_id"], assigned_to_entity_id_nbr=a["assignment_entity_id"],
             assignment_begin_dt=a["start_date"], office_assigned_to_cd="A") for a in assignments])
    prospect = table("prospect", [
        dict(prospect_id=1, entity_id=101, prospect_name="P", prospect_entity_primary_ind="Y"),
        dict(prospect_id=1, entity_id=900, prospect_name="P", prospect_entity_primary_ind="N")])
    summary = table("proposal_summary", [
        dict(proposal_id=i, proposal_assignments="(Unit A) DO") for i in (1, 2)])
    entity = table("entity_prospect_summary", [
        dict(entity_id=100 + i, capacity_rating_desc="c", primary_manager_last_nm="M")
        for i in (1, 2)])
    got = total_qualifications(dated, assignment, stage, proposal, prospect, summary, entity, "A",
                               START, END, AS_OF)
    assert rows(got) == [
        (1, 1, "P", 101, "(Unit A)", "d", "PD", "c", "M, ", "2021-11", "November 2021", 1)]
    # at the grain of the fundraiser the other report keeps proposal 2
    assert _ids(unit_qualified(assignment, stage, proposal, "A", START, END)) == [(1, 1), (1, 2)]


@pytest.mark.parametrize("length", [1, 64, 65, 400])
def test_day_bitmaps(spark, length):
    """Every window length: whether a day of the set lies in an interval, against a search."""
    rng = random.Random(length)
    start = dt.date(2021, 7, 1)
    end = start + dt.timedelta(length - 1)
    near = lambda: start + dt.timedelta(rng.randrange(-40, length + 40))
    stages, asked, days = [], [], {}
    for p in range(60):
        days[p] = {near() for _ in range(rng.randrange(4))}
        stages += [(1000 * p, p, "QU", dt.datetime(2020, 1, 1))]
        stages += [(1000 * p + i, p, "CU", dt.datetime.combine(d, dt.time(13)))
                   for i, d in enumerate(sorted(days[p]), 1)]
        asked += [(p, near(), near()) for _ in range(6)] + [(p, start, start), (p, end, end)]
    facts = stage_facts(
        spark.createDataFrame(
            stages, "proposal_stage_id long, proposal_id long, stage_code string, stage_date timestamp"
        ),
        {"campus": CAMPUS}, start, end, latest=True)
    words = [c for c in facts.columns if c.startswith("campus_days_")]
    assert len(words) == -(-length // 64)
    intervals = spark.createDataFrame(asked, "proposal_id long, first date, last date")
    hit = any_day_between(
        [F.col(w) for w in words], start,
        F.greatest("first", F.lit(start)), F.least("last", F.lit(end)))
    got = intervals.join(facts, "proposal_id").select(
        "proposal_id", "first", "last", hit.alias("hit"), "campus_latest")
    for p, first, last, found, latest in got.collect():
        inside = [d for d in days[p] if start <= d <= end]
        assert found == any(first <= d <= last for d in inside)
        assert latest == max(inside, default=None)


def test_latest_move_by_id_then_day(spark):
    stages = [
        (9, 1, "QU", "2021-01-01"), (8, 1, "CU", "2022-03-01"), (10, 1, "PD", "2021-09-01"),
        (7, 2, "QU", "2021-01-01"), (5, 2, "CU", "2021-09-01"), (5, 2, "PD", "2021-10-01"),
        (None, 3, "QU", "2021-01-01"), (None, 3, "CU", "2021-11-01"), (-4, 3, "CU", "2021-08-01"),
        ((1 << 63) - 1, 4, "CU", "2021-08-01"), (1, 4, "QU", "2021-01-01"),
        (2, 4, "CU", "2021-12-01"),
    ]
    stage = spark.createDataFrame(
        stages, "proposal_stage_id long, proposal_id long, stage_code string, stage_date string")
    facts = stage_facts(stage, {"campus": CAMPUS}, dt.date(2021, 7, 1), dt.date(2022, 6, 30), True)
    assert [(p, str(d)) for p, d in rows(facts, "proposal_id", "campus_latest")] == [
        (1, "2021-09-01"), (2, "2021-10-01"), (3, "2021-08-01"), (4, "2021-08-01")]
