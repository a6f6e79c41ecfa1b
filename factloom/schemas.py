"""Column layouts of the layers, their defaults, required columns and physical layout."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Layer:
    ddl: str
    key: list[str]
    required: list[str]
    defaults: dict[str, str] = field(default_factory=dict)
    partition_by: list[str] = field(default_factory=list)
    sort_by: list[str] = field(default_factory=list)


LAYERS: dict[str, Layer] = {
    "raw_documents": Layer(
        "document_id string, department_id string, department_code string, gcs_uri string, source_url string, "
        "title string, document_type string, file_format string, language string, published_date date, "
        "effective_date date, fiscal_year_label string, checksum string, source_system string, "
        "ingested_at timestamp, ingestion_status string",
        ["department_id", "document_id"], ["document_id", "department_id", "gcs_uri"],
        {"source_system": "'open.canada.ca'", "ingested_at": "current_timestamp()"},
        ["department_id"],
    ),
    "extracted_tables": Layer(
        "table_id string, document_id string, department_id string, table_index bigint, page_number bigint, "
        "sheet_name string, table_title_raw string, table_subtitle_raw string, section_title_raw string, "
        "extraction_method string, parser_version string, extraction_confidence double, gcs_uri string, "
        "created_at timestamp",
        ["table_id"], ["table_id", "document_id"],
        {"parser_version": "'0.1.0'", "created_at": "current_timestamp()"}, ["department_id"],
    ),
    "extracted_cells": Layer(
        "cell_id string, table_id string, row_number bigint, column_number bigint, header_raw string, "
        "value_raw string, value_type_guess string, unit_raw string, note_flag boolean, created_at timestamp",
        ["cell_id"], ["cell_id", "table_id"], {"note_flag": "false", "created_at": "current_timestamp()"},
    ),
    "headers": Layer(
        "header_id string, department_id string, document_id string, table_id string, column_number bigint, "
        "header_raw string, header_normalized string, header_language string, header_class string, "
        "classification_confidence double, first_seen_at timestamp",
        ["table_id", "column_number"], ["header_id", "table_id"], {"first_seen_at": "current_timestamp()"},
        ["department_id"],
    ),
    "mapping_candidates": Layer(
        "header_id string, canonical_entity_type string, canonical_entity_id string, candidate_method string, "
        "candidate_score double, approved_flag boolean, approved_by string, approved_at timestamp",
        ["header_id", "canonical_entity_type", "canonical_entity_id", "candidate_method"], ["header_id"],
    ),
    "row_values_long": Layer(
        "staging_value_id string, department_id string, document_id string, table_id string, "
        "source_row_number bigint, source_column_number bigint, row_label_raw string, header_id string, "
        "header_raw string, value_raw string, value_numeric_guess double, value_date_guess date, "
        "unit_raw string, created_at timestamp",
        ["staging_value_id"], ["staging_value_id", "table_id"], {"created_at": "current_timestamp()"},
        ["department_id"], ["table_id", "source_row_number", "source_column_number"],
    ),
    "fact_observation": Layer(
        "observation_id string, department_id string, document_id string, table_id string, metric_id string, "
        "time_id string, geography_id string, scenario_id string, value_numeric double, value_text string, "
        "unit_raw string, scale_factor double, currency_code string, source_row_number bigint, "
        "source_column_number bigint, quality_score double, created_at timestamp",
        ["observation_id"],
        ["observation_id", "department_id", "document_id", "table_id", "metric_id", "time_id"],
        {"scale_factor": "1.0D", "created_at": "current_timestamp()"},
        ["department_id"], ["metric_id", "time_id"],
    ),
    "dim_time": Layer(
        "time_id string, time_type string, label string, start_date date, end_date date, "
        "fiscal_year_start_month bigint, is_projection boolean, created_at timestamp",
        ["time_id"], ["time_id"],
        {"fiscal_year_start_month": "4L", "is_projection": "false", "created_at": "current_timestamp()"},
    ),
    "dim_metric": Layer(
        "metric_id string, canonical_name string, canonical_name_fr string, metric_family string, "
        "default_unit_id string, description string, is_additive boolean, created_at timestamp",
        ["metric_id"], ["metric_id"], {"is_additive": "false", "created_at": "current_timestamp()"},
    ),
    "dim_geography": Layer(
        "geography_id string, geo_type string, code string, name_en string, name_fr string, created_at timestamp",
        ["geography_id"], ["geography_id"], {"created_at": "current_timestamp()"},
    ),
    "dim_scenario": Layer(
        "scenario_id string, scenario_name string, scenario_group string, created_at timestamp",
        ["scenario_id"], ["scenario_id"], {"created_at": "current_timestamp()"},
    ),
    "dim_department": Layer(
        "department_id string, department_code string, department_name_en string, department_name_fr string, "
        "active_flag boolean, created_at timestamp",
        ["department_id"], ["department_id"], {"active_flag": "true", "created_at": "current_timestamp()"},
    ),
    "dim_document": Layer(
        "document_id string, department_id string, title string, document_type string, language string, "
        "published_date date, fiscal_year_label string, source_url string, gcs_uri string, parser_version string, "
        "created_at timestamp",
        ["document_id"], ["document_id"], {"created_at": "current_timestamp()"},
    ),
    "dim_attribute_type": Layer(
        "attribute_type_id string, attribute_type_name string, description string, created_at timestamp",
        ["attribute_type_id"], ["attribute_type_id"], {"created_at": "current_timestamp()"},
    ),
    "dim_attribute_value": Layer(
        "attribute_value_id string, attribute_type_id string, value_en string, value_fr string, "
        "normalized_value string, created_at timestamp",
        ["attribute_value_id"], ["attribute_value_id"], {"created_at": "current_timestamp()"},
    ),
    "bridge_observation_attribute": Layer(
        "observation_id string, attribute_value_id string, created_at timestamp",
        ["observation_id", "attribute_value_id"], ["observation_id", "attribute_value_id"],
        {"created_at": "current_timestamp()"},
    ),
    "observation_quality": Layer(
        "observation_id string, quality_confidence double, issue_codes string, issue_notes string, "
        "review_status string, reviewed_by string, reviewed_at timestamp",
        ["observation_id"], ["observation_id"], {"review_status": "'unreviewed'"},
    ),
    "rejects": Layer(
        "layer string, record_id string, document_id string, table_id string, reason string, rejected_at timestamp",
        ["layer", "record_id"], ["layer", "record_id", "reason"], {"rejected_at": "current_timestamp()"},
    ),
    "document_status": Layer(
        "document_id string, department_id string, stage string, status string, tables_kept bigint, tables_skipped bigint, updated_at timestamp",
        ["document_id", "department_id", "stage"], ["document_id", "stage"], {"updated_at": "current_timestamp()"},
    ),
    "batch_commits": Layer(
        "batch string, committed_at timestamp", ["batch"], ["batch"], {"committed_at": "current_timestamp()"},
    ),
}
