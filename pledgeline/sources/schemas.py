"""Schemas of the model tables, as DDL. Money is decimal so that sums do not depend on their order."""

from __future__ import annotations

SCHEMAS = {
    "proposal": """
        proposal_id long, entity_id long, summary_entity_id long, prospect_id long, primary_ind string,
        primary_ind_cnt int, active_ind string, proposal_type string, stage_code string,
        stage_desc string, stage_rank_code string, start_dt date, stop_dt date, expected_date date,
        initial_contribution_dt date, original_ask_amt decimal(18,2), ask_amt decimal(18,2),
        granted_amt decimal(18,2), proposal_title string, program_code string, program_desc string,
        unit_code string, unit_desc string, crm_id string, proposal_stage_begin_dt date""",
    "assignment": """
        assignment_id long, assignment_entity_id long, proposal_id long, prospect_id long,
        entity_id long, assignment_first_name string, assignment_last_name string,
        assignment_type string, active_ind string, office_code string, office_desc string,
        program_code string, program_desc string, unit_code string, unit_desc string,
        start_date date, stop_date date""",
    "stage": "proposal_stage_id long, proposal_id long, stage_code string, stage_date date",
    "stage_history": """
        d_proposal_key long, proposal_id long, stage_id long, stage_code string, stage_desc string,
        move_order int, qu_move_order int, stage_adv_order int, stage_date timestamp,
        record_effective_date timestamp, record_expire_date timestamp""",
    "contact": """
        report_id long, contact_date date, contact_type string, contact_type_desc string,
        contact_purpose_code string, contact_purpose_desc string, contact_attitude_code string,
        contact_attitude_desc string, contact_entity_id long, contact_alt_entity_id long,
        contact_credit_entity_id long, author_entity_id long, contact_credit_unit_code string,
        unit_code string, unit_desc string""",
    "entity": """
        entity_id long, hh_corp_entity_id long, report_name string, record_status_code string,
        spouse_entity_id long, capacity_rating_code string, capacity_rating_desc string,
        last_name string, first_name string, middle_name string, pers_suffix string,
        prof_suffix string""",
    "prospect": """
        prospect_id long, entity_id long, prospect_name string, prospect_entity_primary_ind string,
        active_ind string, active_ind_cnt int, start_date date, stop_date date, expected_date date,
        crm_id string""",
    "date_dim": "calendar_dt date, fiscal_yr int",
    "goal": """
        entity_id long, fiscal_year int, fundraiser_role string, active string,
        created_date date""",
    "record_type": "entity_id long, record_type_code string",
    "gift": """
        proposal_id long, donor_entity_id_nbr long, gift_credit_dt date, pledged_basis_flg string,
        transaction_credited_amt decimal(18,2)""",
    "dated_assignment": """
        proposal_id long, assigned_to_entity_id_nbr long, assignment_begin_dt date,
        assignment_end_dt date, office_assigned_to_cd string""",
    "proposal_summary": "proposal_id long, proposal_assignments string",
    "entity_prospect_summary": """
        entity_id long, capacity_rating_desc string, primary_manager_last_nm string,
        primary_manager_first_nm string""",
}
