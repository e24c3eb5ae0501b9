"""Schemas of the stored tables and of the nested digest document, as Spark DDL."""

from __future__ import annotations

MANIFEST = (
    "url STRING, year INT, date DATE, local_path STRING, download_status STRING, "
    "file_size_bytes BIGINT, downloaded_at TIMESTAMP_NTZ, error_message STRING"
)

PARSING = (
    "pdf_path STRING, markdown_path STRING, parsing_status STRING, page_count INT, "
    "markdown_length INT, parsed_at TIMESTAMP_NTZ, error_message STRING"
)

ACTIONS = (
    "id BIGINT, digest_date DATE, action_type STRING, title STRING, settlement BOOLEAN, "
    "court STRING, case_number STRING, release_number STRING, full_text STRING, "
    "extraction_notes STRING, created_at TIMESTAMP_NTZ"
)

RESPONDENTS = (
    "id BIGINT, action_id BIGINT, name STRING, entity_type STRING, location STRING"
)

VIOLATIONS = (
    "id BIGINT, action_id BIGINT, statute STRING, description STRING"
)

SANCTIONS = (
    "id BIGINT, action_id BIGINT, sanction_type STRING, description STRING, "
    "duration STRING, amount STRING"
)

ENFORCEMENT_TABLES = {
    "enforcement_actions": ACTIONS,
    "respondents": RESPONDENTS,
    "violations": VIOLATIONS,
    "sanctions": SANCTIONS,
}

PRIMARY_KEYS = {
    "download_manifest": "url",
    "parsing_results": "pdf_path",
    "enforcement_actions": "id",
    "respondents": "id",
    "violations": "id",
    "sanctions": "id",
}

REQUIRED_COLUMNS = {
    "enforcement_actions": ["digest_date", "action_type"],
    "respondents": ["action_id", "name"],
    "violations": ["action_id"],
    "sanctions": ["action_id"],
}

RESPONDENT_ELEMENT = "STRUCT<name: STRING, entity_type: STRING, location: STRING>"
VIOLATION_ELEMENT = "STRUCT<statute: STRING, description: STRING>"
SANCTION_ELEMENT = (
    "STRUCT<sanction_type: STRING, description: STRING, duration: STRING, amount: STRING>"
)
ACTION_ELEMENT = (
    "STRUCT<action_type: STRING, title: STRING, "
    f"respondents: ARRAY<{RESPONDENT_ELEMENT}>, "
    f"violations: ARRAY<{VIOLATION_ELEMENT}>, "
    f"sanctions: ARRAY<{SANCTION_ELEMENT}>, "
    "settlement: BOOLEAN, court: STRING, case_number: STRING, "
    "release_number: STRING, full_text: STRING>"
)
DIGEST = (
    "digest_date DATE, has_enforcement_actions BOOLEAN, "
    f"actions ARRAY<{ACTION_ELEMENT}>, extraction_notes STRING"
)

FIRST_YEAR = 1956
LAST_YEAR = 2014
