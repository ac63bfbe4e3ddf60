"""CORE models: cleaned, renamed projections of the raw tables (M1-M4)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import rules as R
from ..functions import iff, minute_diff, null_if


def patients(raw: DataFrame) -> DataFrame:
    """One row per patient; unknown zip3 '000' becomes NULL, geo_known flags it.
    A NULL zip3 takes IFF's ELSE branch, so geo_known is TRUE there."""
    return raw.select(
        F.col("Id").alias("patient_id"),
        F.col("BIRTHDATE").alias("birth_date"),
        F.col("DEATHDATE").alias("death_date"),
        F.col("GENDER").alias("gender"),
        F.col("RACE").alias("race"),
        F.col("ETHNICITY").alias("ethnicity"),
        F.col("MARITAL").alias("marital_status"),
        F.col("STATE").alias("state"),
        F.col("COUNTY").alias("county"),
        F.col("FIPS").alias("fips"),
        null_if("ZIP3", R.UNKNOWN_ZIP3).alias("zip3"),
        iff(F.col("ZIP3") == R.UNKNOWN_ZIP3, F.lit(False), F.lit(True)).alias("geo_known"),
        F.col("HEALTHCARE_EXPENSES").alias("healthcare_expenses"),
        F.col("HEALTHCARE_COVERAGE").alias("healthcare_coverage"),
        F.col("INCOME").alias("income"),
    )


def encounters(raw: DataFrame) -> DataFrame:
    """One row per encounter; length of stay in hours from minute boundaries."""
    return raw.select(
        F.col("Id").alias("encounter_id"),
        F.col("PATIENT").alias("patient_id"),
        F.col("START").alias("start_ts"),
        F.col("STOP").alias("stop_ts"),
        F.col("ENCOUNTERCLASS").alias("encounter_class"),
        F.col("ORGANIZATION").alias("organization_id"),
        F.col("PROVIDER").alias("provider_id"),
        F.col("PAYER").alias("payer_id"),
        F.col("CODE").alias("code"),
        F.col("DESCRIPTION").alias("description"),
        F.col("BASE_ENCOUNTER_COST").alias("base_encounter_cost"),
        F.col("TOTAL_CLAIM_COST").alias("total_claim_cost"),
        F.col("PAYER_COVERAGE").alias("payer_coverage"),
        F.col("REASONCODE").alias("reason_code"),
        F.col("REASONDESCRIPTION").alias("reason_description"),
        (minute_diff("START", "STOP").cast("double") / F.lit(60.0)).alias("length_of_stay_hours"),
    )


def conditions(raw: DataFrame) -> DataFrame:
    """One row per condition record; is_disorder from the semantic tag."""
    return raw.select(
        F.col("START").alias("start_date"),
        F.col("STOP").alias("stop_date"),
        F.col("PATIENT").alias("patient_id"),
        F.col("ENCOUNTER").alias("encounter_id"),
        F.col("SYSTEM").alias("code_system"),
        F.col("CODE").alias("condition_code"),
        F.col("DESCRIPTION").alias("description"),
        F.col("DESCRIPTION").like(R.DISORDER_PATTERN).alias("is_disorder"),
    )


def procedures(raw: DataFrame) -> DataFrame:
    """One row per procedure record; is_chemotherapy by case-insensitive match."""
    return raw.select(
        F.col("START").alias("start_ts"),
        F.col("STOP").alias("stop_ts"),
        F.col("PATIENT").alias("patient_id"),
        F.col("ENCOUNTER").alias("encounter_id"),
        F.col("SYSTEM").alias("code_system"),
        F.col("CODE").alias("procedure_code"),
        F.col("DESCRIPTION").alias("description"),
        F.col("BASE_COST").alias("base_cost"),
        F.col("REASONCODE").alias("reason_code"),
        F.col("REASONDESCRIPTION").alias("reason_description"),
        F.col("DESCRIPTION").ilike(R.CHEMOTHERAPY_PATTERN).alias("is_chemotherapy"),
    )
