"""Source table schemas of the two operational systems (DDL strings Spark readers accept).

Fixed values: column names and types of the source tables, as declared by the systems
this library loads from. Staging adds the envelope in ``STAGING_ENVELOPE``.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TS = "timestamp_ntz"

PROGRAM_OPS = {
    "centers": f"id int, name string, city string, address string, is_active boolean, created_at {TS}, updated_at {TS}",
    "children": ("id int, center_id int, first_name string, last_name string, national_code string, birth_date date, "
                 f"gender string, enrollment_date date, status string, created_at {TS}, updated_at {TS}"),
    "teachers": ("id int, center_id int, first_name string, last_name string, phone string, email string, "
                 f"employment_status string, is_active boolean, created_at {TS}, updated_at {TS}"),
    "users": ("id int, username string, password_hash string, role string, teacher_id int, is_active boolean, "
              f"created_at {TS}, updated_at {TS}"),
    "domains": f"id int, name string, description string, is_active boolean, created_at {TS}, updated_at {TS}",
    "score_scales": ("id int, name string, min_score decimal(10,2), max_score decimal(10,2), description string, "
                     f"is_active boolean, created_at {TS}, updated_at {TS}"),
    "task_templates": ("id int, domain_id int, title string, description string, default_score_scale_id int, "
                       f"is_active boolean, created_by int, created_at {TS}, updated_at {TS}"),
    "closure_reasons": f"id int, title string, description string, is_active boolean, created_at {TS}, updated_at {TS}",
    "absence_reasons": f"id int, title string, description string, is_active boolean, created_at {TS}, updated_at {TS}",
    "no_score_reasons": f"id int, title string, description string, is_active boolean, created_at {TS}, updated_at {TS}",
    "center_daily_status": ("id int, center_id int, date date, status string, closure_reason_id int, note string, "
                            f"created_by int, created_at {TS}, updated_at {TS}"),
    "child_daily_status": ("id int, child_id int, date date, status string, absence_reason_id int, note string, "
                           f"created_by int, created_at {TS}, updated_at {TS}"),
    "child_task_plans": ("id int, child_id int, task_template_id int, domain_id int, task_title string, "
                         "score_scale_id int, start_date date, end_date date, is_active boolean, created_by int, "
                         f"created_at {TS}, updated_at {TS}"),
    "daily_task_assignments": ("id int, child_id int, date date, child_task_plan_id int, task_template_id int, "
                               "domain_id int, task_title string, score_scale_id int, planned_by int, status string, "
                               f"created_at {TS}, updated_at {TS}"),
    "assessment_sessions": ("id int, child_id int, teacher_id int, center_id int, date date, started_at " + TS +
                            f", ended_at {TS}, session_status string, general_note string, created_at {TS}, "
                            f"updated_at {TS}"),
    "task_assessments": ("id int, daily_task_assignment_id int, assessment_session_id int, child_id int, "
                         "teacher_id int, date date, score decimal(10,2), normalized_score decimal(10,4), "
                         "assessment_status string, no_score_reason_id int, attempt_no int, note string, "
                         f"created_at {TS}, updated_at {TS}"),
    "notes": ("id int, note_scope string, center_id int, child_id int, teacher_id int, date date, "
              "daily_task_assignment_id int, task_assessment_id int, note_text string, created_by int, "
              f"created_at {TS}, updated_at {TS}"),
    "note_batches": f"id int, created_by int, note_scope string, note_text string, created_at {TS}",
    "note_batch_items": "id int, note_batch_id int, note_id int",
    "audit_logs": ("id long, user_id int, entity_name string, entity_id int, action string, old_value string, "
                   f"new_value string, created_at {TS}"),
}

FINANCE_OPS = {
    "donors": ("id int, full_name string, national_id string, phone string, email string, donor_type string, "
               f"is_active boolean, created_at {TS}, updated_at {TS}"),
    "campaigns": ("id int, title string, description string, target_amount decimal(18,2), start_date date, "
                  f"end_date date, status string, created_at {TS}, updated_at {TS}"),
    "donations": ("id int, donor_id int, campaign_id int, amount decimal(18,2), currency string, donation_type string, "
                  f"donation_date date, status string, reference_code string, created_at {TS}, updated_at {TS}"),
    "expense_categories": f"id int, name string, is_active boolean, created_at {TS}, updated_at {TS}",
    "expenses": ("id int, center_id int, child_id int, category_id int, amount decimal(18,2), currency string, "
                 "expense_date date, description string, approved_by_user_id int, status string, "
                 f"created_at {TS}, updated_at {TS}"),
    "payments": ("id int, payment_type string, teacher_id int, center_id int, amount decimal(18,2), currency string, "
                 f"payment_date date, status string, created_at {TS}, updated_at {TS}"),
    "budget_allocations": ("id int, source_type string, source_id int, center_id int, child_id int, category_id int, "
                           f"allocated_amount decimal(18,2), allocation_date date, reason string, created_at {TS}"),
    "financial_transactions": ("id long, entity_type string, entity_id int, transaction_type string, "
                               f"amount decimal(18,2), transaction_date date, created_at {TS}"),
    "currency_rates": "id int, from_currency string, to_currency string, rate decimal(18,8), rate_date date",
}

STAGING_ENVELOPE = (f"stg_row_id long, etl_batch_id int, source_system string, source_database string, "
                    f"source_schema string, source_table string, extracted_at {TS}, source_updated_at {TS}, "
                    "row_hash string, is_valid boolean, validation_message string")


def source_ddl(table: str) -> str:
    return PROGRAM_OPS.get(table) or FINANCE_OPS[table]


def columns(table: str) -> list[str]:
    parts = re.split(r",(?![^()]*\))", source_ddl(table))   # commas outside decimal(p,s)
    return [part.strip().split(" ")[0] for part in parts]


def empty(spark: SparkSession, table: str) -> DataFrame:
    return spark.createDataFrame([], source_ddl(table))


def from_rows(spark: SparkSession, table: str, rows: list) -> DataFrame:
    """Build a source frame from tuples/dicts with the table's schema (tests and fixtures)."""
    return spark.createDataFrame(rows, source_ddl(table))
