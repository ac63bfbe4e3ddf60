"""Registered queries: the models and their building blocks (windows,
joins, scalar functions, predicates)."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import oracle as O
from ..functions import (age_years, concat_null, day_diff, first_group_ci, hour_diff,
                         minute_diff, month_day, year_diff)
from .common import models
from .episodes import with_lead

Q: dict = {}
SQL: dict = {}


def q(name):
    def deco(fn):
        Q[name] = fn
        return fn
    return deco


# --- M1-M6 -----------------------------------------------------------------

@q("core_patients")
def core_patients(spark, sf):
    return models(spark, sf).patients


SQL["core_patients"] = O.with_models("SELECT * FROM patients")


@q("core_encounters")
def core_encounters(spark, sf):
    return models(spark, sf).encounters


SQL["core_encounters"] = O.with_models("SELECT * FROM encounters")


@q("core_conditions")
def core_conditions(spark, sf):
    return models(spark, sf).conditions


SQL["core_conditions"] = O.with_models("SELECT * FROM conditions")


@q("core_procedures")
def core_procedures(spark, sf):
    return models(spark, sf).procedures


SQL["core_procedures"] = O.with_models("SELECT * FROM procedures")


@q("core_inpatient_episodes")
def core_inpatient_episodes(spark, sf):
    return models(spark, sf).inpatient_episodes


SQL["core_inpatient_episodes"] = O.with_models(f"SELECT {O.EPISODE_COLS} FROM inpatient_episodes")


@q("episode_features")
def episode_features(spark, sf):
    return models(spark, sf).episode_features


SQL["episode_features"] = O.with_models(f"SELECT {O.FEATURE_COLS} FROM episode_features")


# --- windows (W1-W5) ---------------------------------------------------------

@q("running_prior_max")
def running_prior_max(spark, sf):
    """Running MAX of earlier discharges per patient."""
    return models(spark, sf).stays.select("patient_id", "encounter_id", "admitted_at",
                                          "discharged_at", "prev_max_discharge")


SQL["running_prior_max"] = O.with_models(
    "SELECT patient_id, encounter_id, admitted_at, discharged_at, prev_max_discharge "
    "FROM stays_numbered")


@q("episode_numbering")
def episode_numbering(spark, sf):
    """New-episode flag and its running sum."""
    return models(spark, sf).stays.select("patient_id", "encounter_id", "new_episode",
                                          "episode_number", "stay_seq")


SQL["episode_numbering"] = O.with_models(
    "SELECT patient_id, encounter_id, new_episode, episode_number, stay_seq FROM stays_numbered")


@q("gaps_and_islands_merge")
def gaps_and_islands_merge(spark, sf):
    """Stays merged into episode spans."""
    return models(spark, sf).spans


SQL["gaps_and_islands_merge"] = O.with_models(
    "SELECT patient_id, episode_number, admitted_at, discharged_at, stay_in_episode FROM span")


@q("lead_next_admission")
def lead_next_admission(spark, sf):
    """W3 + W4: next admission and the next episode's chemotherapy flag."""
    m = models(spark, sf)
    e = m.hospice_chemo.join(m.patients.select("patient_id"), "patient_id", "left_semi")
    has = F.coalesce(F.col("next_chemo") <= F.col("discharged_at"), F.lit(False))
    e = e.select(concat_null("patient_id", F.lit("-"), "episode_number").alias("episode_id"),
                 "patient_id", "episode_number", "admitted_at", has.alias("has_chemotherapy"))
    return with_lead(e, "episode_number", bool(m.buckets), next_admission_at="admitted_at",
                     next_has_chemotherapy="has_chemotherapy").select(
        "episode_id", "patient_id", "admitted_at", "next_admission_at", "next_has_chemotherapy")


SQL["lead_next_admission"] = O.with_models(
    "SELECT episode_id, patient_id, admitted_at, next_admission_at, "
    "LEAD(has_chemotherapy) OVER (PARTITION BY patient_id ORDER BY admitted_at, episode_number) "
    "AS next_has_chemotherapy FROM inpatient_episodes")


# --- joins (J1-J5) -------------------------------------------------------------

@q("join_episode_patient")
def join_episode_patient(spark, sf):
    """Episode -> patient (death, birth, gender)."""
    m = models(spark, sf)
    return (m.inpatient_episodes.select("episode_id", "patient_id")
            .join(m.patients.select("patient_id", "death_date", "birth_date", "gender"),
                  "patient_id", "inner"))


SQL["join_episode_patient"] = O.with_models(
    "SELECT e.episode_id, e.patient_id, p.death_date, p.birth_date, p.gender "
    "FROM inpatient_episodes e JOIN patients p ON e.patient_id = p.patient_id")


def _flags(spark, sf):
    """Episode spans of known patients (the EXISTS flags are computed after the
    join to patients) with their hospice / chemotherapy sweep results."""
    m = models(spark, sf)
    return m.hospice_chemo.join(m.patients.select("patient_id"), "patient_id", "left_semi")


@q("exists_hospice")
def exists_hospice(spark, sf):
    """Hospice encounter starting within a day after discharge."""
    from ..functions import plus_days_keep_time
    return _flags(spark, sf).select(
        "patient_id", "episode_number", "discharged_at",
        F.coalesce(F.col("next_hospice") <= plus_days_keep_time("discharged_at", 1), F.lit(False))
        .alias("discharged_to_hospice"))


SQL["exists_hospice"] = O.with_models(
    "SELECT patient_id, episode_number, discharged_at, discharged_to_hospice FROM inpatient_episodes")


@q("exists_chemotherapy")
def exists_chemotherapy(spark, sf):
    """Chemotherapy procedure inside the episode."""
    return _flags(spark, sf).select(
        "patient_id", "episode_number", "admitted_at", "discharged_at",
        F.coalesce(F.col("next_chemo") <= F.col("discharged_at"), F.lit(False))
        .alias("has_chemotherapy"))


SQL["exists_chemotherapy"] = O.with_models(
    "SELECT patient_id, episode_number, admitted_at, discharged_at, has_chemotherapy FROM inpatient_episodes")


@q("prior_episodes_365d")
def prior_episodes_365d(spark, sf):
    """J4 for every episode (history includes ineligible episodes)."""
    return models(spark, sf).history.select("episode_id", "prior_episodes_365d")


SQL["prior_episodes_365d"] = O.with_models(
    "SELECT e.episode_id, COUNT(e2.episode_id) AS prior_episodes_365d "
    "FROM inpatient_episodes e LEFT JOIN inpatient_episodes e2 "
    "ON e.patient_id = e2.patient_id AND e2.admitted_at < e.admitted_at "
    "AND date_diff('day', CAST(e2.admitted_at AS DATE), CAST(e.admitted_at AS DATE)) <= 365 "
    "GROUP BY e.episode_id")


@q("active_disorders_at_discharge")
def active_disorders_at_discharge(spark, sf):
    """J5 for every eligible episode."""
    return models(spark, sf).timeline.select("episode_id", "active_disorders_at_discharge")


SQL["active_disorders_at_discharge"] = O.with_models(
    "SELECT episode_id, active_disorders_at_discharge FROM episode_features")


# --- scalar functions and predicates ---------------------------------------------

@q("scalar_datetime")
def scalar_datetime(spark, sf):
    """F1-F3, F6-F8 over every encounter."""
    e = models(spark, sf).encounters
    return e.select(
        "encounter_id",
        F.to_date("start_ts").alias("start_date"),
        day_diff("start_ts", "stop_ts").alias("days"),
        hour_diff("start_ts", "stop_ts").alias("hours"),
        minute_diff("start_ts", "stop_ts").alias("minutes"),
        F.date_add(F.to_date("stop_ts"), 1).alias("stop_date_plus_1"),
        (F.col("stop_ts") + F.make_dt_interval(F.lit(1))).alias("stop_ts_plus_1d"),
    )


SQL["scalar_datetime"] = O.with_models(
    "SELECT encounter_id, CAST(start_ts AS DATE) AS start_date, "
    "CAST(date_diff('day', start_ts, stop_ts) AS INTEGER) AS days, "
    "date_diff('hour', start_ts, stop_ts) AS hours, "
    "date_diff('minute', start_ts, stop_ts) AS minutes, "
    "CAST(CAST(stop_ts AS DATE) + 1 AS DATE) AS stop_date_plus_1, "
    "stop_ts + INTERVAL 1 DAY AS stop_ts_plus_1d FROM encounters")


@q("scalar_string")
def scalar_string(spark, sf):
    """F14 (NULL-propagating concatenation), F15, F18, F20 (first regex group,
    case-insensitive, NULL when absent)."""
    e = models(spark, sf).encounters
    return e.select(
        "encounter_id",
        concat_null("patient_id", F.lit("-"), "reason_code").alias("patient_reason"),
        first_group_ci("description", r"ENCOUNTER FOR (\w+)").alias("encounter_for"),
        F.substring("description", 1, 3).alias("desc3"),
        F.nullif(F.col("reason_code"), F.lit("0")).alias("reason_code_nz"),
    )


SQL["scalar_string"] = O.with_models(
    "SELECT encounter_id, patient_id || '-' || reason_code AS patient_reason, "
    "CASE WHEN regexp_matches(description, '(?i)ENCOUNTER FOR (\\w+)') "
    "THEN regexp_extract(description, '(?i)ENCOUNTER FOR (\\w+)', 1) END AS encounter_for, "
    "substring(description, 1, 3) AS desc3, NULLIF(reason_code, '0') AS reason_code_nz "
    "FROM encounters")


@q("predicates_suite")
def predicates_suite(spark, sf):
    """P10 BETWEEN / NOT BETWEEN (NULL on NULL), P11 LIKE suffix / infix /
    NOT LIKE / ILIKE, over every condition record."""
    c = models(spark, sf).conditions
    return c.select(
        "patient_id", "encounter_id", "condition_code", "start_date", "stop_date",
        F.col("description").like("%(disorder)").alias("like_suffix"),
        F.col("description").like("%(situation)%").alias("like_infix"),
        (~F.col("description").like("%(finding)")).alias("not_like"),
        F.col("description").ilike("%RING%").alias("ilike_ring"),
        F.col("start_date").between(F.lit("1996-01-01").cast("date"),
                                    F.lit("1996-12-31").cast("date")).alias("start_in_1996"),
        (~F.col("stop_date").between(F.lit("1996-01-01").cast("date"),
                                     F.lit("1996-12-31").cast("date"))).alias("stop_not_in_1996"),
    )


SQL["predicates_suite"] = O.with_models(
    "SELECT patient_id, encounter_id, condition_code, start_date, stop_date, "
    "description LIKE '%(disorder)' AS like_suffix, "
    "description LIKE '%(situation)%' AS like_infix, "
    "description NOT LIKE '%(finding)' AS not_like, "
    "description ILIKE '%RING%' AS ilike_ring, "
    "start_date BETWEEN DATE '1996-01-01' AND DATE '1996-12-31' AS start_in_1996, "
    "stop_date NOT BETWEEN DATE '1996-01-01' AND DATE '1996-12-31' AS stop_not_in_1996 "
    "FROM conditions")


@q("age_at_admission")
def age_at_admission(spark, sf):
    """F4, F5, F9 for every eligible episode."""
    m = models(spark, sf)
    e = m.inpatient_episodes.filter(F.col("is_eligible_index")).join(
        m.patients.select("patient_id", "birth_date"), "patient_id")
    d = F.to_date("admitted_at")
    return e.select(
        "episode_id", "birth_date", d.alias("admit_date"),
        year_diff("birth_date", d).alias("year_diff"),
        month_day(d).alias("admit_mmdd"), month_day("birth_date").alias("birth_mmdd"),
        age_years("birth_date", "admitted_at").alias("age_at_admission"))


SQL["age_at_admission"] = O.with_models(
    "SELECT e.episode_id, p.birth_date, CAST(e.admitted_at AS DATE) AS admit_date, "
    "CAST(date_diff('year', p.birth_date, CAST(e.admitted_at AS DATE)) AS INTEGER) AS year_diff, "
    "strftime(CAST(e.admitted_at AS DATE), '%m-%d') AS admit_mmdd, "
    "strftime(p.birth_date, '%m-%d') AS birth_mmdd, "
    "CAST(date_diff('year', p.birth_date, CAST(e.admitted_at AS DATE)) "
    "- CASE WHEN strftime(CAST(e.admitted_at AS DATE), '%m-%d') < strftime(p.birth_date, '%m-%d') "
    "THEN 1 ELSE 0 END AS INTEGER) AS age_at_admission "
    "FROM inpatient_episodes e JOIN patients p ON e.patient_id = p.patient_id "
    "WHERE e.is_eligible_index")


@q("age_boundary_cases")
def age_boundary_cases(spark, sf):
    """V19 re-aimed at every patient: the age rule on the day before the
    30th birthday, on it, and on 1 Jan / 31 Dec of that year (29, 30, and
    29 or 30). Leap-day births land on 28 Feb."""
    p = models(spark, sf).patients.filter(F.col("birth_date").isNotNull())
    b = F.col("birth_date")
    d30 = F.add_months(b, 360)
    y = F.year(b) + 30
    return p.select(
        "patient_id", "birth_date",
        age_years(b, F.date_sub(d30, 1)).alias("age_day_before"),
        age_years(b, d30).alias("age_on_day"),
        age_years(b, F.make_date(y, F.lit(1), F.lit(1))).alias("age_jan_1"),
        age_years(b, F.make_date(y, F.lit(12), F.lit(31))).alias("age_dec_31"),
        year_diff(b, d30).alias("naive_year_diff"))


def _age_sql(b, d):
    return (f"CAST(date_diff('year', {b}, {d}) - CASE WHEN strftime({d}, '%m-%d') < "
            f"strftime({b}, '%m-%d') THEN 1 ELSE 0 END AS INTEGER)")


SQL["age_boundary_cases"] = O.with_models(
    "SELECT patient_id, birth_date, "
    f"{_age_sql('birth_date', 'CAST(birth_date + INTERVAL 360 MONTH - INTERVAL 1 DAY AS DATE)')} "
    "AS age_day_before, "
    f"{_age_sql('birth_date', 'CAST(birth_date + INTERVAL 360 MONTH AS DATE)')} AS age_on_day, "
    f"{_age_sql('birth_date', 'make_date(CAST(year(birth_date) + 30 AS INTEGER), 1, 1)')} "
    "AS age_jan_1, "
    f"{_age_sql('birth_date', 'make_date(CAST(year(birth_date) + 30 AS INTEGER), 12, 31)')} "
    "AS age_dec_31, "
    "CAST(date_diff('year', birth_date, CAST(birth_date + INTERVAL 360 MONTH AS DATE)) AS INTEGER) "
    "AS naive_year_diff FROM patients WHERE birth_date IS NOT NULL")
