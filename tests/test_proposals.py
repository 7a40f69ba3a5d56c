from conftest import rows
from test_portfolio import assigned, held

from pledgeline.operators.contacts import entity_display_name
from pledgeline.operators.proposals import assigned_proposals, primary_entities, proposal_fact


def _prospect(i, entity, flag=None):
    return dict(prospect_id=i, entity_id=entity, prospect_entity_primary_ind=flag, active_ind="Y")


def test_primary_repair(table):
    prospects = table("prospect", [
        _prospect(1, 10), _prospect(2, 21), _prospect(2, 20),
        _prospect(3, 30, "Y"), _prospect(3, 31), _prospect(3, 32, "N"),
        _prospect(4, 40, "N"), _prospect(4, 41, "N"),
    ])
    columns = ["prospect_id", "entity_id", "primary_entity_revised"]
    assert rows(primary_entities(prospects), *columns) == [
        (1, 10, "Y"), (2, 20, "Y"), (3, 30, "Y"), (4, 40, "Y")]
    # unflagged rows of a prospect with a primary are dropped even here
    assert rows(primary_entities(prospects, primary_entity_only=False), *columns) == [
        (1, 10, "Y"), (2, 20, "Y"), (2, 21, "N"), (3, 30, "Y"), (3, 32, "N"), (4, 40, "Y"),
        (4, 41, "N")]


def test_proposal_rows_that_differ_in_entity_are_one(table):
    assignment = table("assignment", [
        assigned(1, 1, 1), assigned(2, 1, None), assigned(3, 1, 1, assignment_type="PM"),
        assigned(4, 1, 2, active_ind="N"), assigned(5, 1, 9),
    ])
    proposal = table("proposal", [
        held(1), held(1, entity_id=7, primary_ind="N"), held(2, active_ind="N", prospect_id=None)])
    assert rows(assigned_proposals(assignment, proposal), "assignment_id", "proposal_active") == [
        (1, "Y"), (4, "N")]
    both = assigned_proposals(assignment, proposal, primary_prop_only=False)
    assert rows(both, "assignment_id") == [(1,), (1,), (4,)]

    fact = proposal_fact(
        assignment, proposal, table("prospect", [_prospect(1, 10, "Y"), _prospect(1, 11, "N")]),
        table("entity", [dict(entity_id=10, report_name="Ten")]))
    assert rows(fact, "assignment_id", "prospect_id", "entity_id", "report_name",
                "assignment_active", "prospect_active") == [
        (1, 1, 10, "Ten", "Y", "Y"), (4, None, None, None, "N", None)]
    assert {"assignment_start_dt", "proposal_stop_dt", "proposal_crm_id", "expected_date"} <= set(
        fact.columns)
    assert len(fact.columns) == len(set(fact.columns))


def test_entity_display_name(table):
    entity = table("entity", [dict(entity_id=1, last_name="Doe", first_name="Ann",
                                   middle_name="Beth", prof_suffix="PhD")])
    assert rows(entity_display_name(entity)) == [(1, "Doe PhD, Ann B.")]
