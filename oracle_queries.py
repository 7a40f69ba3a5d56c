"""DuckDB SQL for every registered query, over the sample star schema.

Each query tests its rule row by row (EXISTS with inequalities, OR joins, windows over whole groups),
not the way the Spark operators work, so that agreement also checks the operators' rewrites. Dates
and times are given as text and money as double, as in the registered queries.
"""

from __future__ import annotations

import re

AS_OF = "DATE '2001-12-31'"
FROM, TO = "DATE '1997-07-01'", "DATE '1998-06-30'"
UNIT = "'4'"
OFFICES, UNITS = "('1', '3', '4')", "('Unit 0', 'Unit 2')"
PEOPLE = str(tuple(range(1, 60, 2)))

MODEL = {
    "proposal": """
        SELECT o_orderkey AS proposal_id, xor(1000000 + o_custkey, partner) AS entity_id,
            o_custkey - o_custkey % 2 AS prospect_id,
            CASE WHEN partner = 1 OR o_orderkey % 13 = 4 THEN 'N' ELSE 'Y' END AS primary_ind,
            CASE WHEN o_orderstatus = 'F' OR (o_orderstatus = 'O' AND o_orderkey % 7 = 0)
                THEN 'N' ELSE 'Y' END AS active_ind,
            CASE WHEN o_orderpriority = '1-URGENT' THEN 'ESP' ELSE 'MG' END AS proposal_type,
            CASE o_orderstatus WHEN 'O' THEN 'QU' WHEN 'P' THEN 'SP' ELSE
                CASE o_orderkey % 5 WHEN 0 THEN 'CN' WHEN 1 THEN 'TD' WHEN 2 THEN 'DQ'
                    WHEN 3 THEN 'NR' ELSE 'RP' END END AS stage_code,
            stage_code AS stage_desc,
            CAST(o_orderkey % 9 AS VARCHAR) AS stage_rank_code,
            CAST(o_orderdate AS DATE) AS start_dt,
            CASE WHEN o_orderstatus = 'F' THEN start_dt + CAST(30 + o_orderkey % 300 AS INT) END
                AS stop_dt,
            CASE WHEN o_orderkey % 4 <> 0 THEN start_dt + CAST(180 + o_orderkey % 90 AS INT) END
                AS expected_date,
            CASE WHEN o_orderkey % 3 <> 0 AND o_orderkey % 8 <> 5
                THEN start_dt + CAST(o_orderkey % 120 AS INT) END
                AS initial_contribution_dt,
            CASE WHEN o_orderkey % 9 = 0 THEN CAST(0 AS DECIMAL(18,2))
                ELSE CAST(o_totalprice AS DECIMAL(18,2)) END AS original_ask_amt,
            CASE WHEN o_orderkey % 3 = 0 OR o_orderkey % 8 = 6 THEN CAST(0 AS DECIMAL(18,2))
                ELSE CAST(o_totalprice AS DECIMAL(18,2)) END AS ask_amt,
            CASE WHEN o_orderstatus = 'F' AND (o_orderkey % 5 = 4 OR o_orderkey % 4 = 2)
                THEN CAST(o_totalprice AS DECIMAL(18,2)) ELSE CAST(0 AS DECIMAL(18,2)) END
                AS granted_amt,
            'Plan ' || o_orderkey AS proposal_title,
            CAST(o_custkey % 5 AS VARCHAR) AS unit_code, 'Unit ' || unit_code AS unit_desc,
            start_dt + CAST(o_orderkey % 50 AS INT) AS proposal_stage_begin_dt,
            CAST(o_orderkey % 3 AS VARCHAR) AS program_code,
            'Program ' || o_orderkey % 3 AS program_desc, 'R' || o_orderkey AS crm_id
        FROM (SELECT *, unnest(CASE WHEN o_orderkey % 10 = 3 THEN [0, 1] ELSE [0] END) AS partner
            FROM orders)""",
    "assignment": """
        SELECT l_orderkey * 100000 + l_suppkey AS assignment_id, l_orderkey AS proposal_id,
            l_suppkey AS assignment_entity_id, s_name AS assignment_last_name,
            'F' || s_nationkey AS assignment_first_name,
            CAST(CASE WHEN l_suppkey % 3 = 0 THEN (s_nationkey + l_orderkey) % 5
                ELSE s_nationkey % 5 END AS VARCHAR) AS office_code,
            'Unit ' || office_code AS office_desc, office_code AS unit_code,
            office_desc AS unit_desc,
            o_custkey - o_custkey % 2 AS prospect_id, 1000000 + o_custkey AS entity_id,
            CASE WHEN (l_orderkey + l_suppkey) % 11 = 4 THEN 'AD' ELSE 'DO' END AS assignment_type,
            CAST(l_suppkey % 4 AS VARCHAR) AS program_code, 'Program ' || l_suppkey % 4 AS program_desc,
            min(CAST(l_shipdate AS DATE)) AS start_date,
            CASE WHEN max(l_linestatus) = 'F' THEN max(CAST(l_shipdate AS DATE)) + 365 END
                AS stop_date,
            CASE WHEN max(l_linestatus) = 'O' THEN 'Y' ELSE 'N' END AS active_ind
        FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN orders ON o_orderkey = l_orderkey
        GROUP BY l_orderkey, l_suppkey, s_name, s_nationkey, o_custkey""",
    "stage": """
        SELECT l_orderkey * 8 + l_linenumber AS proposal_stage_id, l_orderkey AS proposal_id,
            CASE l_linenumber WHEN 1 THEN 'QU' WHEN 2 THEN 'CU' WHEN 3 THEN 'PD' WHEN 4 THEN 'SP'
                WHEN 5 THEN 'GS' WHEN 6 THEN 'DQ' WHEN 7 THEN 'TD' END AS stage_code,
            min(CAST(l_shipdate AS DATE)) AS stage_date
        FROM lineitem GROUP BY l_orderkey, l_linenumber""",
    "stage_history": """
        SELECT user_id AS d_proposal_key, user_id AS proposal_id, event_id AS stage_id,
            CASE event_type WHEN 'signup' THEN 'QU' WHEN 'view' THEN 'CU' WHEN 'click' THEN 'PD'
                WHEN 'purchase' THEN 'SP' ELSE 'CN' END AS stage_code,
            CASE event_type WHEN 'signup' THEN 1 WHEN 'view' THEN 2 WHEN 'click' THEN 3
                WHEN 'purchase' THEN 4 ELSE 0 END AS move_order,
            CASE WHEN event_type = 'click' THEN 0 ELSE move_order END AS qu_move_order,
            move_order AS stage_adv_order, ts AS stage_date, ts AS effective,
            CASE WHEN event_id % 50 = 0 THEN TIMESTAMP '2024-06-01' ELSE TIMESTAMP '9999-12-31' END
                AS expire
        FROM events""",
    "line_history": """
        SELECT proposal_id AS d_proposal_key, proposal_id, proposal_stage_id AS stage_id, stage_code,
            proposal_stage_id % 8 AS move_order,
            CASE WHEN stage_code IN ('DQ','TD') THEN 0 ELSE proposal_stage_id % 8 END
                AS qu_move_order,
            proposal_stage_id % 8 AS stage_adv_order, CAST(stage_date AS TIMESTAMP) AS stage_date,
            CAST(stage_date AS TIMESTAMP) AS effective,
            CASE WHEN proposal_stage_id % 50 = 0 THEN TIMESTAMP '2001-06-01'
                ELSE TIMESTAMP '9999-12-31' END AS expire
        FROM stage""",
    "contact": """
        SELECT l_orderkey * 8 + l_linenumber AS report_id,
            CAST(l_shipdate AS DATE) AS contact_date,
            CASE l_returnflag WHEN 'A' THEN 'V' WHEN 'R' THEN 'VIR' ELSE 'E' END AS contact_type,
            contact_type AS contact_type_desc, CAST(NULL AS VARCHAR) AS contact_purpose_code,
            CAST(NULL AS VARCHAR) AS contact_purpose_desc,
            CASE WHEN l_linestatus = 'O' THEN 'Y' ELSE 'N' END AS contact_attitude_code,
            contact_attitude_code AS contact_attitude_desc,
            1000000 + o_custkey AS contact_entity_id,
            CASE WHEN l_linenumber % 2 = 1 THEN 1000000 + l_partkey % 100 END
                AS contact_alt_entity_id,
            CASE WHEN l_linenumber <> 7 THEN l_suppkey END AS contact_credit_entity_id,
            l_partkey % 10 AS author_entity_id,
            CAST(l_suppkey % 5 AS VARCHAR) AS contact_credit_unit_code,
            CAST(l_partkey % 5 AS VARCHAR) AS unit_code, 'Unit ' || unit_code AS unit_desc
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey""",
    "entity": """
        SELECT 1000000 + c_custkey AS entity_id,
            1000000 + c_custkey - c_custkey % 2 AS hh_corp_entity_id, c_name AS report_name,
            c_mktsegment AS capacity_rating_desc, 'A' AS record_status_code,
            CASE WHEN c_custkey % 2 = 1 THEN 1000000 + c_custkey - 1 END AS spouse_entity_id,
            substr(c_mktsegment, 1, 1) AS capacity_rating_code, c_name AS last_name,
            CASE WHEN (1000000 + c_custkey) % 5 <> 0 THEN c_mktsegment END AS first_name,
            CASE WHEN (1000000 + c_custkey) % 3 <> 0 THEN c_mktsegment END AS middle_name,
            CASE WHEN (1000000 + c_custkey) % 7 = 0 THEN 'Jr' END AS pers_suffix,
            CASE WHEN (1000000 + c_custkey) % 11 = 0 THEN 'PhD' END AS prof_suffix
        FROM customer
        UNION ALL
        SELECT s_suppkey, s_suppkey, s_name, NULL, 'A', NULL, NULL, s_name, NULL, NULL, NULL, NULL
        FROM supplier""",
    "prospect": """
        SELECT c_custkey - c_custkey % 2 AS prospect_id, 1000000 + c_custkey AS entity_id,
            'Prospect ' || (c_custkey - c_custkey % 2) AS prospect_name,
            CASE WHEN c_custkey % 6 = 0 THEN 'Y' WHEN c_custkey % 6 <= 3 THEN 'N' END
                AS prospect_entity_primary_ind,
            c_custkey % 2 AS active_ind_cnt,
            CASE WHEN c_custkey % 6 = 5 THEN 'N' ELSE 'Y' END AS active_ind,
            DATE '1995-01-01' + CAST(c_custkey % 6 AS INT) AS start_date,
            CASE WHEN c_custkey % 6 = 5 THEN DATE '1999-12-31' END AS stop_date,
            'X' || c_custkey AS crm_id
        FROM customer""",
    "date_dim": """
        SELECT CAST(d AS DATE) AS calendar_dt,
            CAST(year(d) + CASE WHEN month(d) >= 7 THEN 1 ELSE 0 END AS INTEGER) AS fiscal_yr
        FROM generate_series(DATE '1995-01-01', DATE '2003-06-30', INTERVAL 1 DAY) t(d)""",
    "goal": """
        SELECT s_suppkey AS entity_id, fy AS fiscal_year,
            CASE (s_nationkey + k) % 3 WHEN 0 THEN 'Major Gift' WHEN 1 THEN 'Annual'
                ELSE 'Planned' END AS fundraiser_role,
            CASE WHEN k = 0 THEN 'Y' WHEN s_suppkey % 8 <> 0 THEN 'N' END AS active,
            make_date(fy - 1, 7, 1) + CAST(k AS INT) AS created_date
        FROM supplier, (SELECT CAST(range AS INTEGER) AS fy FROM range(1995, 2003)) years,
            (SELECT range AS k FROM range(0, 2)) ks
        WHERE k = 0 OR s_suppkey % 4 = 0""",
    "record_type": """
        SELECT s_suppkey AS entity_id,
            CASE WHEN s_suppkey % 10 = 9 THEN 'SX' ELSE 'SF' END AS record_type_code FROM supplier
        UNION ALL SELECT s_suppkey, 'AL' FROM supplier WHERE s_suppkey % 2 = 0""",
    "gift": """
        SELECT l_orderkey AS proposal_id, 1000000 + o_custkey AS donor_entity_id_nbr,
            CAST(l_shipdate AS DATE) AS gift_credit_dt,
            CASE WHEN l_returnflag = 'N' THEN 'N' ELSE 'Y' END AS pledged_basis_flg,
            CAST(l_extendedprice AS DECIMAL(18,2)) AS transaction_credited_amt
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey""",
    "dated_assignment": """
        SELECT proposal_id, assignment_entity_id AS assigned_to_entity_id_nbr,
            start_date AS assignment_begin_dt, stop_date AS assignment_end_dt,
            office_code AS office_assigned_to_cd
        FROM assignment""",
    "proposal_summary": """
        SELECT o_orderkey AS proposal_id, '(Unit ' || (o_orderkey % 5) || ') DO'
            AS proposal_assignments
        FROM orders""",
    "entity_prospect_summary": """
        SELECT 1000000 + c_custkey AS entity_id, c_mktsegment AS capacity_rating_desc,
            CASE WHEN c_custkey % 4 <> 0 THEN 'Mgr' || c_nationkey END AS primary_manager_last_nm,
            'M' || c_nationkey AS primary_manager_first_nm
        FROM customer""",
}

# -- building blocks shared by several queries -----------------------------------------------------

ROLE_2000 = """
    SELECT entity_id, fundraiser_role, fiscal_year FROM goal WHERE fiscal_year = 2000
    QUALIFY row_number() OVER (PARTITION BY entity_id
        ORDER BY active DESC NULLS FIRST, created_date DESC NULLS FIRST) = 1"""
PORTFOLIO = """
    SELECT a.assignment_id, a.assignment_entity_id,
        concat_ws(', ', a.assignment_last_name, a.assignment_first_name) AS assignment_name,
        a.office_code, a.office_desc, p.proposal_id, p.entity_id, p.prospect_id, p.primary_ind,
        p.proposal_type, p.stop_dt, p.stage_code, p.initial_contribution_dt, p.expected_date,
        p.ask_amt, p.original_ask_amt,
        row_number() OVER (PARTITION BY p.prospect_id, a.office_code ORDER BY a.assignment_id)
            AS rn2,
        row_number() OVER (PARTITION BY p.proposal_id, a.office_code ORDER BY a.assignment_id)
            AS rn3,
        row_number() OVER (PARTITION BY p.proposal_id, a.office_code, a.assignment_entity_id
            ORDER BY a.assignment_id) AS rn4
    FROM assignment a JOIN proposal p USING (proposal_id)
    WHERE p.active_ind = 'Y' AND a.active_ind = 'Y' AND p.primary_ind = 'Y'
        AND a.assignment_type = 'DO'
        AND EXISTS (FROM record_type r WHERE r.entity_id = a.assignment_entity_id)"""
ROLE_PORTFOLIO = f"""
    SELECT * REPLACE (row_number() OVER (PARTITION BY proposal_id, office_code
        ORDER BY assignment_id) AS rn3)
    FROM portfolio WHERE proposal_type = 'MG' AND assignment_entity_id IN (
        SELECT entity_id FROM ({ROLE_2000}) WHERE fundraiser_role = 'Major Gift')"""

PLANNED = "(expected_date IS NOT NULL AND ask_amt = 0 AND original_ask_amt > 0 AND stop_dt IS NULL)"
BY_FUNDRAISER = f"""
    SELECT assignment_entity_id, assignment_name, office_code,
        coalesce(sum(original_ask_amt) FILTER ({PLANNED}), 0) AS total_target_ask,
        count(DISTINCT proposal_id) FILTER ({PLANNED}) AS total_target_ask_cnt,
        count(DISTINCT proposal_id) FILTER ({PLANNED} AND rn3 = 1) AS unit_target_ask_cnt,
        sum(original_ask_amt) FILTER ({PLANNED} AND rn3 = 1) AS unit_target_ask
    FROM portfolio GROUP BY ALL"""

# a day on which somebody with this assignment held the proposal
OPEN_END = "DATE '9999-12-31'"


def _held_on(day: str) -> str:
    return f"{day} BETWEEN a.start_date AND coalesce(a.stop_date, {OPEN_END})"


ACTIVITY = f"""
    SELECT DISTINCT office_code, assignment_entity_id, proposal_id,
        CASE WHEN asked THEN proposal_id END AS asks, CASE WHEN asked THEN ask_amt END AS ask_amt,
        CASE WHEN committed THEN proposal_id END AS commits,
        CASE WHEN by_gift THEN gift_amt
            WHEN proposal_type <> 'ESP' AND committed THEN granted_amt END AS commit_amt
    FROM (
        SELECT a.office_code, a.assignment_entity_id, p.*,
            p.ask_amt > 0 AND p.initial_contribution_dt BETWEEN {FROM} AND {TO}
                AND {_held_on('p.initial_contribution_dt')} AS asked,
            p.granted_amt > 0 AND p.stop_dt BETWEEN {FROM} AND {TO} AND {_held_on('p.stop_dt')}
                AS committed,
            p.proposal_type = 'ESP' AND p.granted_amt > 0 AND p.stop_dt <= {TO}
                AND p.stop_dt BETWEEN a.start_date AND coalesce(a.stop_date, {AS_OF}) AS by_gift
        FROM assignment a JOIN proposal p USING (proposal_id)
        WHERE a.assignment_type = 'DO' AND p.primary_ind = 'Y'
            AND a.start_date <= {TO} AND p.start_dt <= {TO}
            AND coalesce(a.stop_date, {OPEN_END}) >= {FROM}
            AND EXISTS (FROM record_type r WHERE r.record_type_code = 'SF'
                AND r.entity_id = a.assignment_entity_id)
            AND EXISTS (FROM portfolio f WHERE f.office_code = a.office_code
                AND f.assignment_entity_id = a.assignment_entity_id)) held
    LEFT JOIN (SELECT proposal_id AS gift_proposal, donor_entity_id_nbr AS donor,
            transaction_credited_amt AS gift_amt
        FROM gift WHERE pledged_basis_flg = 'Y' AND gift_credit_dt BETWEEN {FROM} AND {TO}) given
        ON given.gift_proposal = held.proposal_id AND given.donor = held.entity_id"""

# the same with the number of equal gifts of each amount
ACTIVITY_APART = (
    ACTIVITY.replace("AS commit_amt\n", "AS commit_amt, gift_copies\n")
    .replace("AS gift_amt\n", "AS gift_amt, count(*) AS gift_copies\n")
    .replace(f"BETWEEN {FROM} AND {TO}) given", f"BETWEEN {FROM} AND {TO} GROUP BY ALL) given")
    + " AND held.by_gift"
)

# Stage codes
EIGHT = "('PD', 'SP', 'GS', 'DS', 'CU', 'RP', 'DQ', 'TD')"
NINE = "('PD', 'SP', 'GS', 'DS', 'CU', 'CN', 'RP', 'DQ', 'TD')"
FIVE = "('PD', 'SP', 'GS', 'DS', 'CU')"
# Stages that a stop is counted under by name
STOPS = "('CN', 'TD', 'DQ', 'NR')"


def _half_year_later(day: str) -> str:
    later = f"CAST({day} + INTERVAL 6 MONTH AS DATE)"
    return f"if({day} = last_day({day}), last_day({later}), {later})"


def _included(stages: str, proposal: str = "TRUE") -> str:
    """Whether assignment ``a`` held the proposal on a day in the window it moved on from QU."""
    return f"""EXISTS (
        FROM stage m, stage q
        WHERE m.proposal_id = a.proposal_id AND q.proposal_id = a.proposal_id
            AND q.stage_code = 'QU' AND q.stage_date < m.stage_date AND q.stage_date <= {TO}
            AND m.stage_code IN {stages} AND m.stage_date BETWEEN {FROM} AND {TO}
            AND {_held_on('m.stage_date')})
        AND EXISTS (FROM proposal p WHERE p.proposal_id = a.proposal_id AND {proposal})"""


def _excluded(stages: str) -> str:
    """Whether assignment ``a`` bars the proposal: out of QU too early, too late, or for good."""
    return f"""EXISTS (FROM stage q WHERE q.proposal_id = a.proposal_id AND q.stage_code = 'QU'
            AND q.stage_date <= {TO})
        AND EXISTS (FROM proposal p WHERE p.proposal_id = a.proposal_id AND (
            p.stop_dt < {FROM}
            OR (p.stage_code = 'QU' AND p.active_ind <> 'Y' AND p.stop_dt IS NULL
                AND {_half_year_later('p.expected_date')} < {FROM})
            OR EXISTS (FROM stage e WHERE e.proposal_id = a.proposal_id
                AND e.stage_code IN {stages}
                AND (e.stage_date < {FROM} OR e.stage_date < a.start_date
                    OR e.stage_date > a.stop_date))))"""


def _net(keys: str, source: str, included: str, excluded: str) -> str:
    return f"""SELECT DISTINCT {keys} FROM {source} WHERE {included}
        EXCEPT SELECT {keys} FROM {source} WHERE {excluded}"""


CAMPUS_ROWS = """assignment a JOIN (SELECT DISTINCT assignment_entity_id, office_code
    FROM portfolio) f USING (assignment_entity_id)"""
CAMPUS_KEYS = "assignment_entity_id, f.office_code, a.proposal_id"
CAMPUS_NET = _net(CAMPUS_KEYS, CAMPUS_ROWS, _included(EIGHT), _excluded(NINE))
CAMPUS_OUT = f"SELECT DISTINCT {CAMPUS_KEYS} FROM {CAMPUS_ROWS} WHERE {_excluded(NINE)}"


def _unit_moves(stages: str) -> str:
    return _net(
        "assignment_entity_id, office_desc, proposal_id",
        "assignment a",
        f"a.office_code = {UNIT} AND {_included(stages)}",
        _excluded(stages),
    )


FLAGS = f"""
    SELECT assignment_entity_id, if(bool_or(here), 'Y', 'N') AS flg,
        max(start_date) FILTER (here) AS unitdt, if(bool_or(elsewhere), 'Y', 'N') AS flg2,
        coalesce(max(start_date) FILTER (elsewhere), DATE '1930-01-01') AS othunitdt
    FROM (SELECT *, coalesce(office_code = {UNIT}, FALSE) AS here,
            coalesce(office_code <> {UNIT} AND active_ind = 'Y', FALSE) AS elsewhere
        FROM assignment a WHERE EXISTS (FROM proposal p WHERE p.proposal_id = a.proposal_id))
    GROUP BY assignment_entity_id"""

OUTCOMES = f"""
    SELECT assignment_entity_id, assignment_first_name, assignment_last_name,
        count(DISTINCT assignment_id) FILTER (start_date BETWEEN {FROM} AND {TO}) AS starts,
        count(DISTINCT proposal_id) FILTER (ended) AS stops,
        count(DISTINCT proposal_id) FILTER (ended AND code = 'CN' AND granted_amt = 0) AS cn_stop,
        count(DISTINCT proposal_id) FILTER (ended AND code = 'TD' AND granted_amt = 0) AS td_stop,
        (SELECT count(DISTINCT d.proposal_id) FROM disqualified d
            WHERE d.assignment_entity_id = held.assignment_entity_id) AS dq_stop,
        count(DISTINCT proposal_id) FILTER (ended AND code = 'NR' AND granted_amt = 0) AS nr_stop,
        count(DISTINCT proposal_id) FILTER (ended AND code NOT IN {STOPS})
            AS other_stop,
        count(DISTINCT proposal_id) FILTER (ended AND code = 'RP') AS rp_stop,
        (SELECT count(DISTINCT q.proposal_id) FROM qualified q
            WHERE q.assignment_entity_id = held.assignment_entity_id) AS qual_cnt,
        count(DISTINCT assignment_id) FILTER (start_date <= {TO}
            AND coalesce(stop_date, {OPEN_END}) >= {FROM}) AS portfolio
    FROM (SELECT a.*, p.stage_code AS code, p.granted_amt,
            p.stop_dt BETWEEN {FROM} AND {TO} AND p.stop_dt
                BETWEEN coalesce(a.start_date, DATE '0001-01-01') AND coalesce(a.stop_date, {AS_OF})
                AS ended
        FROM assignment a JOIN proposal p USING (proposal_id)
        WHERE a.office_code = {UNIT} AND a.assignment_type = 'DO') held
    WHERE EXISTS (FROM record_type r WHERE r.record_type_code = 'SF'
            AND r.entity_id = held.assignment_entity_id)
        AND EXISTS (FROM flags g WHERE g.assignment_entity_id = held.assignment_entity_id
            AND g.flg = 'Y' AND g.flg2 = 'N' AND g.unitdt > g.othunitdt)
    GROUP BY assignment_entity_id, assignment_first_name, assignment_last_name"""

# two intervals overlap if each begins by the end of the other; open ones last until today
WINDOW_PORTFOLIO = f"""
    WITH held AS (
        SELECT proposal_id,
            max(prospect_id) AS prospect_id,
            max(stage_code) AS stage,
            max(stage_desc) AS stage_desc,
            max(stage_rank_code) AS stage_rank,
            max(start_dt) AS proposal_begin_dt,
            max(proposal_title) AS proposal_title,
            max(original_ask_amt) AS target_ask,
            max(expected_date) AS target_date,
            max(ask_amt) AS actual_ask,
            max(initial_contribution_dt) AS actual_date,
            max(granted_amt) AS commit_amt,
            max(stop_dt) AS commit_dt,
            max(date_diff('day', proposal_stage_begin_dt, {AS_OF})) AS days_in_stage
        FROM proposal
        WHERE start_dt <= {TO} AND coalesce(stop_dt, {AS_OF}) >= {FROM}
        GROUP BY proposal_id),
    assigned AS (
        SELECT proposal_id, assigned_to_entity_id_nbr,
            min(assignment_begin_dt) AS assign_begin_dt,
            max(coalesce(assignment_end_dt, {AS_OF})) AS assign_end_dt
        FROM dated_assignment
        WHERE office_assigned_to_cd = {UNIT}
            AND assignment_begin_dt <= {TO} AND coalesce(assignment_end_dt, {AS_OF}) >= {FROM}
        GROUP BY proposal_id, assigned_to_entity_id_nbr)
    SELECT * FROM held JOIN assigned USING (proposal_id)"""

TOTAL_QUALIFICATIONS = f"""
    SELECT net.proposal_id, p.prospect_id, s.prospect_name,
        (SELECT max(y.entity_id) FROM prospect y WHERE y.prospect_id = s.prospect_id
            AND y.prospect_entity_primary_ind = 'Y') AS entity_id,
        replace(t.proposal_assignments, ') DO', ')') AS proposal_assignments, p.stage_desc,
        p.stage_code, e.capacity_rating_desc,
        e.primary_manager_last_nm || ', ' || e.primary_manager_first_nm AS primary_manager_last_nm,
        strftime(m.moved, '%Y-%m') AS dt_sort, strftime(m.moved, '%B %Y') AS dt_disp,
        CAST(1 AS BIGINT) AS quals
    FROM (
        (SELECT proposal_id FROM window_portfolio
        INTERSECT SELECT a.proposal_id FROM assignment a
            WHERE a.office_code = {UNIT} AND {_included(EIGHT, "p.primary_ind = 'Y'")})
        EXCEPT SELECT a.proposal_id FROM assignment a
            WHERE {_excluded(NINE)} AND a.assignment_entity_id IN (
                SELECT assigned_to_entity_id_nbr FROM window_portfolio)) net
    JOIN (SELECT proposal_id, arg_max(stage_date, proposal_stage_id) AS moved FROM stage
        WHERE stage_code IN {EIGHT} AND stage_date BETWEEN {FROM} AND {TO}
        GROUP BY proposal_id) m USING (proposal_id)
    JOIN proposal p ON p.proposal_id = net.proposal_id AND p.primary_ind = 'Y'
    JOIN proposal_summary t ON t.proposal_id = net.proposal_id
    JOIN entity_prospect_summary e ON e.entity_id = p.entity_id
    JOIN (SELECT DISTINCT a.proposal_id, x.prospect_id, x.prospect_name
        FROM assignment a JOIN prospect x USING (prospect_id)) s
        ON s.proposal_id = net.proposal_id"""


def _first_moves(history: str, order: str, as_of: str) -> str:
    return f"""
    SELECT proposal_id, next_date AS qualification_date FROM (
        SELECT *, lead({order}, 1, 0) OVER following AS next_order,
            lead(stage_date) OVER following AS next_date
        FROM {history}
        WHERE effective <= TIMESTAMP '{as_of}' AND expire >= TIMESTAMP '{as_of}'
            AND proposal_id IS NOT NULL
        WINDOW following AS (PARTITION BY d_proposal_key ORDER BY
            CAST(stage_date AS DATE) NULLS LAST, stage_adv_order NULLS LAST, stage_id NULLS LAST))
    WHERE stage_code = 'QU' AND next_order > {order}
    QUALIFY row_number() OVER (PARTITION BY d_proposal_key
        ORDER BY stage_date NULLS LAST, stage_id) = 1"""


ROLES = """SELECT DISTINCT entity_id AS fundraiser_entity_id FROM goal
    WHERE fiscal_year = 2002 AND fundraiser_role = 'Major Gift'"""
ENRICHED = """
    SELECT c.*,
        (SELECT d.fiscal_yr FROM date_dim d WHERE d.calendar_dt = c.contact_date) AS fiscal_yr,
        own.hh_corp_entity_id, other.hh_corp_entity_id AS alt_hh_corp_entity_id,
        ifnull(credited.report_name, writer.report_name) AS fundraiser_name
    FROM (FROM contact WHERE contact_date BETWEEN DATE '{start}' AND DATE '{end}') c
    LEFT JOIN entity own ON own.entity_id = c.contact_entity_id
    LEFT JOIN entity other ON other.entity_id = c.contact_alt_entity_id
    LEFT JOIN entity credited ON credited.entity_id = c.contact_credit_entity_id
    LEFT JOIN entity writer ON writer.entity_id = c.author_entity_id"""
ALL_YEARS = ENRICHED.format(start="1995-07-01", end="2001-12-31")
IN_ROLE = """SELECT * FROM enriched
    WHERE contact_credit_entity_id IN (SELECT fundraiser_entity_id FROM in_role)
        OR author_entity_id IN (SELECT fundraiser_entity_id FROM in_role)"""
REPAIRED = """
    SELECT x.*, CASE
        WHEN EXISTS (FROM prospect y WHERE y.prospect_id = x.prospect_id
            AND y.prospect_entity_primary_ind = 'Y') THEN x.prospect_entity_primary_ind
        WHEN EXISTS (FROM prospect y WHERE y.prospect_id = x.prospect_id
            AND y.entity_id < x.entity_id) THEN 'N'
        ELSE 'Y' END AS primary_entity_revised
    FROM prospect x"""


def _fact(proposals: str, kept: tuple) -> str:
    return f"""
    SELECT a.assignment_id, a.assignment_entity_id, a.proposal_id, a.assignment_first_name,
        a.assignment_last_name, a.assignment_type, a.office_code, a.office_desc,
        a.active_ind AS assignment_active, a.start_date AS assignment_start_dt,
        a.stop_date AS assignment_stop_dt, a.program_code AS assignment_program_code,
        a.program_desc AS assignment_program_desc, a.unit_code AS assignment_unit_code,
        a.unit_desc AS assignment_unit_desc,
        p.prospect_id, p.active_ind AS proposal_active, p.proposal_type,
        p.stage_code AS proposal_stage_code, p.stage_desc AS proposal_stage_desc, p.stage_rank_code,
        p.start_dt AS proposal_start_dt, p.stop_dt AS proposal_stop_dt, p.expected_date,
        p.initial_contribution_dt, p.original_ask_amt, p.ask_amt, p.granted_amt, p.proposal_title,
        p.program_code AS proposal_program_code, p.program_desc AS proposal_program_desc,
        p.unit_code AS proposal_unit_code, p.unit_desc AS proposal_unit_desc,
        p.crm_id AS proposal_crm_id, p.proposal_stage_begin_dt,
        x.entity_id, x.prospect_name, x.prospect_entity_primary_ind, x.active_ind_cnt,
        x.primary_entity_revised, x.active_ind AS prospect_active, x.start_date AS prospect_start_dt,
        x.stop_date AS prospect_stop_dt, x.crm_id AS prospect_crm_id,
        e.report_name, e.record_status_code, e.spouse_entity_id, e.capacity_rating_code,
        e.capacity_rating_desc
    FROM (FROM assignment WHERE assignment_type = 'DO') a
    JOIN (SELECT * EXCLUDE (entity_id, primary_ind) FROM {proposals}) p USING (proposal_id)
    LEFT JOIN (FROM ({REPAIRED}) WHERE primary_entity_revised IN {kept}) x
        ON x.prospect_id = p.prospect_id
    LEFT JOIN entity e ON e.entity_id = x.entity_id"""


PROPOSAL_FACT = _fact(
    """(SELECT DISTINCT * EXCLUDE (entity_id, primary_ind),
        NULL AS entity_id, NULL AS primary_ind FROM proposal)""",
    ("Y", "Y"),
)
SCOPED_PROPOSALS = """SELECT * FROM proposal_fact
    WHERE assignment_entity_id IN (SELECT fundraiser_entity_id FROM in_role)"""
SCOPED_QUALIFICATIONS = """SELECT * FROM moves
    WHERE proposal_id IN (SELECT proposal_id FROM scoped_proposals)"""


def _fy(day: str) -> str:
    return f"CAST(year({day}) + CASE WHEN month({day}) >= 7 THEN 1 ELSE 0 END AS INTEGER)"


def _ytd(day: str) -> str:
    # 31 December 2001 is day 184 of its fiscal year
    return f"(CAST({day} AS DATE) - make_date({_fy(day)} - 1, 7, 1) + 1 <= 184)"


def _trend(totals: str, extra: str = "") -> str:
    """The trend columns over (extra, fiscal_yr, total, ytd)."""
    part = f"PARTITION BY {extra}" if extra else ""

    def block(value: str, prefix: str) -> str:
        average = f"""CAST(sum({value}) OVER ({part} ORDER BY fiscal_yr
            ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) - {value} AS DOUBLE) / 3"""
        last = f"lag({value}) OVER ({part} ORDER BY fiscal_yr)"
        number = f"CAST({value} AS DOUBLE)"
        return f"""round({number} / nullif(CAST({last} AS DOUBLE), 0), 6) AS {prefix}vs_last_yr,
            round({average}, 6) AS {prefix}three_yr_avg,
            round({number} / nullif({average}, 0), 6) AS {prefix}vs_three_yr_avg"""

    keys = f"{extra}, " if extra else ""
    return f"""SELECT {keys}fiscal_yr, CAST(total AS DOUBLE) AS total, CAST(ytd AS DOUBLE) AS ytd,
        {block('total', '')}, {block('ytd', 'ytd_')} FROM ({totals})"""


def _reports(where: str) -> str:
    return f"""SELECT fiscal_yr, count(DISTINCT report_id) AS total,
        count(DISTINCT CASE WHEN {_ytd('contact_date')} THEN report_id END) AS ytd
    FROM scoped_contacts WHERE {where} AND fiscal_yr >= 1996 GROUP BY fiscal_yr"""


VISITS = _reports("contact_type IN ('V','VIR')")
SIGNIFICANT = _reports("contact_attitude_code = 'Y'")
HOUSEHOLDS = f"""
    SELECT fiscal_yr, count(DISTINCT id) AS total, count(DISTINCT CASE WHEN isytd THEN id END) AS ytd
    FROM (SELECT fiscal_yr, id, max(isytd) AS isytd FROM (
            SELECT fiscal_yr, hh_corp_entity_id AS id, {_ytd('contact_date')} AS isytd
            FROM scoped_contacts WHERE contact_type IN ('V','VIR')
            UNION ALL
            SELECT fiscal_yr, alt_hh_corp_entity_id, {_ytd('contact_date')}
            FROM scoped_contacts WHERE contact_type IN ('V','VIR'))
        WHERE id IS NOT NULL AND fiscal_yr >= 1996 GROUP BY fiscal_yr, id)
    GROUP BY fiscal_yr"""
QUALIFICATIONS = f"""
    SELECT {_fy('qualification_date')} AS fiscal_yr, count(DISTINCT proposal_id) AS total,
        count(DISTINCT CASE WHEN {_ytd('qualification_date')} THEN proposal_id END) AS ytd
    FROM scoped_qualifications WHERE {_fy('qualification_date')} BETWEEN 1996 AND 2002 GROUP BY 1"""


def _number(day: str, amount: str) -> str:
    return f"""SELECT {_fy(day)} AS fiscal_yr, count(DISTINCT proposal_id) AS total,
        count(DISTINCT CASE WHEN {_ytd(day)} THEN proposal_id END) AS ytd
    FROM scoped_proposals WHERE {_fy(day)} BETWEEN 1996 AND 2002 AND {amount} > 0 GROUP BY 1"""


def _amount(day: str, amount: str) -> str:
    return f"""SELECT fiscal_yr, sum(amt) AS total, sum(ytd_amt) AS ytd FROM (
        SELECT {_fy(day)} AS fiscal_yr, proposal_id, max({amount}) AS amt,
            max(CASE WHEN {_ytd(day)} THEN {amount} ELSE 0 END) AS ytd_amt
        FROM scoped_proposals WHERE {_fy(day)} BETWEEN 1996 AND 2002 AND {amount} > 0
        GROUP BY 1, 2) GROUP BY fiscal_yr"""


ASKED_ON, COMMITTED_ON = ("initial_contribution_dt", "ask_amt"), ("proposal_stop_dt", "granted_amt")
SECTION_TOTALS = {
    "visits": VISITS,
    "unique_v": HOUSEHOLDS,
    "sig_contacts": SIGNIFICANT,
    "qualifications": QUALIFICATIONS,
    "asks_n": _number(*ASKED_ON),
    "asks_total": _amount(*ASKED_ON),
    "commits_n": _number(*COMMITTED_ON),
    "commits_total": _amount(*COMMITTED_ON),
}
LONG = " UNION ALL ".join(
    f"SELECT '{name}' AS section, fiscal_yr, CAST(total AS DECIMAL(28,2)) AS total, "
    f"CAST(ytd AS DECIMAL(28,2)) AS ytd FROM ({sql})"
    for name, sql in SECTION_TOTALS.items()
)


def _captions(prefix: str, value: str) -> str:
    rows = ", ".join(
        [
            "('this_yr', total)",
            f"('pct_vs_prev', {prefix}vs_last_yr - 1)",
            "('prev_yr', prev)",
            f"('pct_vs_three_yr', {prefix}vs_three_yr_avg - 1)",
            f"('three_yr', {prefix}three_yr_avg)",
        ]
    )
    return f"""SELECT section, type, round(val, 6) AS val FROM (
        SELECT * FROM (SELECT *, lag({value}) OVER (PARTITION BY section ORDER BY fiscal_yr) AS prev,
                row_number() OVER (PARTITION BY section ORDER BY fiscal_yr DESC) AS rn
            FROM trends) WHERE rn = 1) last_row,
        LATERAL (VALUES {rows}) t(type, val)"""


DERIVED = {
    "portfolio": PORTFOLIO,
    "role_portfolio": ROLE_PORTFOLIO,
    "by_fundraiser": BY_FUNDRAISER,
    "activity": ACTIVITY,
    "qualified": _unit_moves(FIVE),
    "disqualified": _unit_moves("('DQ')"),
    "flags": FLAGS,
    "window_portfolio": WINDOW_PORTFOLIO,
    "in_role": ROLES,
    "enriched": ALL_YEARS,
    "scoped_contacts": IN_ROLE,
    "proposal_fact": PROPOSAL_FACT,
    "scoped_proposals": SCOPED_PROPOSALS,
    "moves": _first_moves("line_history", "move_order", "2001-12-31"),
    "scoped_qualifications": SCOPED_QUALIFICATIONS,
    "trends": _trend(LONG, "section"),
}
_ALL = MODEL | DERIVED


def _mentioned(sql: str) -> set[str]:
    words = set(re.findall(r"[a-z_]+", re.sub(r"'[^']*'", "", sql)))
    return words & set(_ALL)


def _with(sql: str) -> str:
    """Put the tables a query mentions, and those they mention, in front of it."""
    needed: list[str] = []

    def visit(name: str) -> None:
        if name in needed:
            return
        for other in sorted(_mentioned(_ALL[name]) - {name}):
            visit(other)
        needed.append(name)

    for name in sorted(_mentioned(sql)):
        visit(name)
    if not needed:
        return sql
    return "WITH " + ",\n".join(f"{n} AS ({_ALL[n]})" for n in needed) + "\n" + sql


def _select(table: str, plain: str, money: str = "", days: str = "", times: str = "") -> str:
    """Columns of a table with money as double and dates and times as text."""
    columns = plain.split()
    columns += [f"CAST({c} AS DOUBLE) AS {c}" for c in money.split()]
    columns += [f"CAST({c} AS VARCHAR) AS {c}" for c in days.split()]
    columns += [f"strftime({c}, '%Y-%m-%d %H:%M:%S.%f') AS {c}" for c in times.split()]
    return f"SELECT {', '.join(columns)} FROM {table}"


PORTFOLIO_COLUMNS = (
    "assignment_id assignment_entity_id assignment_name office_code office_desc proposal_id "
    "entity_id prospect_id primary_ind stage_code"
)
PORTFOLIO_DAYS = "stop_dt initial_contribution_dt expected_date"
CONTACT_COLUMNS = (
    "report_id contact_type contact_type_desc contact_purpose_code contact_purpose_desc "
    "contact_attitude_code contact_attitude_desc"
)
ENRICHED_COLUMNS = CONTACT_COLUMNS + (
    " contact_entity_id contact_alt_entity_id contact_credit_entity_id author_entity_id "
    "contact_credit_unit_code unit_code unit_desc fiscal_yr hh_corp_entity_id "
    "alt_hh_corp_entity_id fundraiser_name"
)
FACT_COLUMNS = (
    "assignment_id assignment_entity_id assignment_first_name assignment_last_name assignment_type "
    "office_code office_desc assignment_active assignment_unit_code assignment_unit_desc "
    "proposal_id prospect_id proposal_active proposal_type proposal_stage_code proposal_title "
    "entity_id prospect_name prospect_entity_primary_ind active_ind_cnt primary_entity_revised "
    "report_name spouse_entity_id capacity_rating_desc assignment_program_code "
    "assignment_program_desc proposal_program_code proposal_program_desc proposal_crm_id "
    "proposal_stage_desc stage_rank_code proposal_unit_code proposal_unit_desc prospect_active "
    "prospect_crm_id record_status_code capacity_rating_code"
)
FACT_MONEY = "original_ask_amt ask_amt granted_amt"
FACT_DAYS = (
    "assignment_start_dt assignment_stop_dt proposal_start_dt proposal_stop_dt expected_date "
    "initial_contribution_dt proposal_stage_begin_dt prospect_start_dt prospect_stop_dt"
)
PLANNED_ROWS = f"""(SELECT *, original_ask_amt AS target_ask,
    proposal_id AS target_ask_without_actual FROM portfolio WHERE {PLANNED})"""
CONTACT_PAIRS = f"""(SELECT f.assignment_entity_id, f.office_code, c.*,
        (SELECT count(*) FROM activity x WHERE x.office_code = f.office_code
            AND x.assignment_entity_id = f.assignment_entity_id) AS activity_rows
    FROM (SELECT * RENAME (unit_code AS unit) FROM contact
        WHERE contact_date BETWEEN {FROM} AND {TO}) c
    JOIN (SELECT DISTINCT assignment_entity_id, office_code FROM activity) f
        ON f.assignment_entity_id IN (c.contact_credit_entity_id, c.author_entity_id)
        AND f.office_code IN (c.contact_credit_unit_code, c.unit))"""
ACTUAL_ASKS = """(SELECT assignment_entity_id, assignment_name, office_code, proposal_id, rn3,
        sum(ask_amt) AS actual_ask, count(*) AS actual_ask_cnt
    FROM portfolio
    WHERE initial_contribution_dt IS NOT NULL AND ask_amt > 0 AND stop_dt IS NULL
    GROUP BY ALL HAVING count(*) = 1)"""
MOVES = "proposal_id"


def _name() -> str:
    given = lambda c: f"nullif(trim({c}), '')"
    suffix = given("concat_ws(' ', pers_suffix, prof_suffix)")
    return f"""SELECT entity_id, concat(last_name, ' ' || {suffix},
            ', ' || if({given('first_name')} IS NULL, NULL, first_name),
            ' ' || left({given('middle_name')}, 1) || '.') AS fundraiser_name
        FROM entity"""


QUERIES = {
    "current_role": ROLE_2000,
    "active_portfolio": _select(
        "portfolio", PORTFOLIO_COLUMNS + " rn2 rn3 rn4", "ask_amt original_ask_amt", PORTFOLIO_DAYS
    ),
    "active_portfolio_in_role": _select(
        "role_portfolio",
        PORTFOLIO_COLUMNS + " rn3",
        "ask_amt original_ask_amt",
        PORTFOLIO_DAYS,
    ),
    "active_portfolio_filtered": _select(
        f"""portfolio WHERE office_code IN {OFFICES} AND assignment_entity_id IN {PEOPLE}
            AND assignment_entity_id IN (SELECT entity_id FROM ({ROLE_2000})
                WHERE fundraiser_role IN ('Major Gift', 'Annual'))""",
        PORTFOLIO_COLUMNS,
        "ask_amt original_ask_amt",
        PORTFOLIO_DAYS,
    ),
    "planned_asks_by_fundraiser": _select(
        "by_fundraiser",
        "assignment_entity_id assignment_name office_code total_target_ask_cnt unit_target_ask_cnt",
        "total_target_ask unit_target_ask",
    ),
    "planned_ask_rows": _select(
        PLANNED_ROWS,
        PORTFOLIO_COLUMNS + " target_ask_without_actual rn2 rn3 rn4",
        "ask_amt original_ask_amt target_ask",
        PORTFOLIO_DAYS,
    ),
    "planned_asks_by_unit": """SELECT office_code,
        CAST(sum(unit_target_ask) AS DOUBLE) AS unit_target_ask FROM by_fundraiser
        GROUP BY office_code""",
    "actual_asks": _select(
        ACTUAL_ASKS,
        "assignment_entity_id assignment_name office_code proposal_id actual_ask_cnt rn3",
        "actual_ask",
    ),
    "activity_window": _select(
        "activity",
        "office_code assignment_entity_id proposal_id asks commits",
        "ask_amt commit_amt",
    ),
    "activity_window_gifts_apart": _select(
        f"({ACTIVITY_APART})",
        "office_code assignment_entity_id proposal_id asks commits gift_copies",
        "ask_amt commit_amt",
    ),
    "portfolio_contacts": _select(
        CONTACT_PAIRS,
        "assignment_entity_id office_code activity_rows " + CONTACT_COLUMNS,
        days="contact_date",
    ),
    "portfolio_contacts_repeated": _select(
        f"(FROM {CONTACT_PAIRS} JOIN range(1000000) copies(copy) ON copy < activity_rows)",
        "assignment_entity_id " + CONTACT_COLUMNS,
        days="contact_date",
    ),
    "qualifications": CAMPUS_NET,
    "qualifications_filtered": _net(
        CAMPUS_KEYS,
        CAMPUS_ROWS,
        f"""a.office_code IN {OFFICES} AND {_included(EIGHT, "p.proposal_type = 'MG'")}""",
        _excluded(NINE),
    ),
    "qualification_exclusions": CAMPUS_OUT,
    "qualification_counts": f"""SELECT assignment_entity_id, office_code,
        count(DISTINCT proposal_id) AS qual_cnt FROM ({CAMPUS_NET})
        GROUP BY assignment_entity_id, office_code""",
    "unit_exclusive_fundraisers": """SELECT assignment_entity_id, flg, flg2,
        CAST(unitdt AS VARCHAR) AS unitdt, CAST(othunitdt AS VARCHAR) AS othunitdt,
        coalesce(flg = 'Y' AND flg2 = 'N' AND unitdt > othunitdt, FALSE) AS unit_exclusive
        FROM flags""",
    "unit_qualified": "SELECT * FROM qualified",
    "unit_disqualified": "SELECT * FROM disqualified",
    "unit_outcomes": OUTCOMES,
    "proposal_window_portfolio": _select(
        "window_portfolio",
        "proposal_id assigned_to_entity_id_nbr prospect_id stage stage_desc stage_rank "
        "proposal_title days_in_stage",
        "target_ask actual_ask commit_amt",
        "proposal_begin_dt target_date actual_date commit_dt assign_begin_dt assign_end_dt",
    ),
    "total_qualifications": TOTAL_QUALIFICATIONS,
    "first_forward_moves": _select(
        "(" + _first_moves("stage_history", "move_order", "2024-12-31") + ")",
        MOVES,
        times="qualification_date",
    ),
    "first_forward_moves_strict": _select(
        "(" + _first_moves("stage_history", "qu_move_order", "2024-12-31") + ")",
        MOVES,
        times="qualification_date",
    ),
    "first_forward_moves_lines": _select(
        "(" + _first_moves("line_history", "qu_move_order", "2001-12-31") + ")",
        MOVES,
        times="qualification_date",
    ),
    "fundraisers_in_role": "SELECT fundraiser_entity_id FROM in_role",
    "contacts_enriched": _select(
        f"({ENRICHED.format(start='1997-07-01', end='1998-06-30')})",
        ENRICHED_COLUMNS,
        days="contact_date",
    ),
    "proposal_fact": _select("proposal_fact", FACT_COLUMNS, FACT_MONEY, FACT_DAYS),
    "proposal_fact_whole": _select(
        f"({_fact('proposal', ('Y', 'N'))})", FACT_COLUMNS, FACT_MONEY, FACT_DAYS
    ),
    "scoped_proposals_filtered": _select(
        f"""scoped_proposals
            WHERE assignment_unit_desc IN {UNITS} AND assignment_entity_id IN {PEOPLE}""",
        FACT_COLUMNS,
        FACT_MONEY,
        FACT_DAYS,
    ),
    "scoped_contacts": _select("scoped_contacts", ENRICHED_COLUMNS, days="contact_date"),
    "scoped_proposals": _select("scoped_proposals", FACT_COLUMNS, FACT_MONEY, FACT_DAYS),
    "scoped_qualifications": _select("scoped_qualifications", MOVES, times="qualification_date"),
    "trend_visits": _trend(VISITS),
    "trend_significant": _trend(SIGNIFICANT),
    "trend_households": _trend(HOUSEHOLDS),
    "trend_visits_by_unit": _trend(
        VISITS.replace("SELECT fiscal_yr", "SELECT unit_desc, fiscal_yr").replace(
            "GROUP BY fiscal_yr", "GROUP BY unit_desc, fiscal_yr"
        ),
        "unit_desc",
    ),
    "trend_qualifications": _trend(QUALIFICATIONS),
    "trend_asks_n": _trend(SECTION_TOTALS["asks_n"]),
    "trend_asks_amt": _trend(SECTION_TOTALS["asks_total"]),
    "trend_commits_n": _trend(SECTION_TOTALS["commits_n"]),
    "trend_commits_amt": _trend(SECTION_TOTALS["commits_total"]),
    "dashboard_long": "SELECT * FROM trends",
    "dashboard_bars": "SELECT section, "
    + ", ".join(
        f'max(CASE WHEN fiscal_yr = {y} THEN total END) AS "{y}"' for y in range(1996, 2003)
    )
    + " FROM trends GROUP BY section",
    "dashboard_captions": _captions("", "total"),
    "dashboard_captions_ytd": _captions("ytd_", "ytd"),
    "entity_display_name": _name(),
}


def oracle_sql() -> dict[str, str]:
    return {name: _with(sql) for name, sql in QUERIES.items()}
