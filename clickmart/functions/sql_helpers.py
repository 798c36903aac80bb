"""The scalar helpers again as SQL functions, for users who write SQL against the marts."""

from __future__ import annotations

from pyspark.sql import SparkSession

from clickmart.functions.expressions import (
    MAX_INT_TEXT,
    NUMBER,
    SEGMENT_LADDER,
    SEGMENT_REST,
    STRENGTHS,
)


def register_helpers(spark: SparkSession) -> list[str]:
    """Create the temporary SQL functions of this session and return their names."""
    ladder = " ".join(f"WHEN spend >= {bound} THEN '{label}'" for bound, label in SEGMENT_LADDER)
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION spend_segment(spend DOUBLE) RETURNS STRING "
        f"RETURN CASE {ladder} ELSE '{SEGMENT_REST}' END"
    )
    cases = " ".join(f"WHEN '{name}' THEN {value}" for name, value in STRENGTHS.items())
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION interaction_strength(kind STRING) RETURNS INT "
        f"RETURN CASE kind {cases} END"
    )
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION whole_number(txt STRING) RETURNS BIGINT "
        f"RETURN CASE WHEN length(txt) > {MAX_INT_TEXT} OR NOT txt RLIKE r'{NUMBER}' THEN 0 "
        "ELSE coalesce(try_cast(try_cast(txt AS DOUBLE) AS BIGINT), 0) END"
    )
    return ["spend_segment", "interaction_strength", "whole_number"]
