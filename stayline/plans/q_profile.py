"""Registered queries: profiling and validation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import oracle as O
from ..functions import day_diff, hour_diff, pct, plus_days_keep_time
from ..operators.chunks import ordered_chunks
from ..operators.profile import column_profile, ordered_template
from ..operators.scan import asc_nulls_last
from .common import (avg1, check_row, cnt, cnt_if, models, side_by_side, sql_avg1, sql_check,
                     sql_cif, sql_pct)
from .episodes import with_lead

Q: dict = {}
SQL: dict = {}

# oracle predicates used in several statements
ZIP3_UNKNOWN = '"ZIP3" = \'000\''
NUMERIC_MISSING = '"TYPE" = \'numeric\' AND VALUE_NUM IS NULL'
TEXT_WITH_NUM = '"TYPE" <> \'numeric\' AND VALUE_NUM IS NOT NULL'
HOUR_DIFF = "date_diff('hour', start_ts, stop_ts)"
NEXT_WITHIN_30 = "date_diff('day', discharged_at, next_admitted_at) <= 30"
NEXT_IN_1_30 = "date_diff('day', discharged_at, next_admitted_at) BETWEEN 1 AND 30"
STOP_NULL = '"STOP" IS NULL'


def q(name):
    def deco(fn):
        Q[name] = fn
        return fn
    return deco


def stays_with_next(m) -> DataFrame:
    """Each inpatient stay with the next stay's admission."""
    return with_lead(m.stays, "stay_seq", m._plain(m.rows_per_patient["encounters"]), next_admitted_at="admitted_at")


SQL_STAYS_NEXT = ("stays_next AS (SELECT *, LEAD(admitted_at) OVER (PARTITION BY patient_id "
                  f"ORDER BY {O.ORDER_STAYS}) AS next_admitted_at FROM stays_numbered)")


def spans_with_next(m) -> DataFrame:
    """Each episode span with the next one's admission."""
    return with_lead(m.spans, "episode_number", m._plain(m.rows_per_patient["encounters"]),
                     next_admitted_at="admitted_at")


SQL_SPANS_NEXT = ("spans_next AS (SELECT *, LEAD(admitted_at) OVER (PARTITION BY patient_id "
                  "ORDER BY admitted_at, episode_number) AS next_admitted_at FROM span)")


# --- raw-layer checks (V1-V4) -------------------------------------------------

@q("validate_patients_load")
def validate_patients_load(spark, sf):
    p = models(spark, sf).source("patients")
    return p.agg(cnt().alias("rows_loaded"),
                 F.count_distinct("Id").cast("bigint").alias("distinct_ids"),
                 F.min("BIRTHDATE").alias("oldest"), F.max("BIRTHDATE").alias("youngest"),
                 cnt_if(F.col("ZIP3") == "000").alias("unknown_geo"))


SQL["validate_patients_load"] = O.with_models(
    "SELECT CAST(COUNT(*) AS BIGINT) AS rows_loaded, CAST(COUNT(DISTINCT \"Id\") AS BIGINT) "
    "AS distinct_ids, MIN(\"BIRTHDATE\") AS oldest, MAX(\"BIRTHDATE\") AS youngest, "
    f"{sql_cif(ZIP3_UNKNOWN)} AS unknown_geo FROM raw_patients")


@q("point_lookup_encounter")
def point_lookup_encounter(spark, sf):
    """V2: one encounter by key (here the smallest id), to check the timestamps."""
    m = models(spark, sf)
    return encounter_by_id(m, m.encounters.agg(F.min("encounter_id")).first()[0])


def encounter_by_id(m, encounter_id: str) -> DataFrame:
    """The encounter with a given id; the equality reaches the scan."""
    return m.encounters.where(F.col("encounter_id") == F.lit(encounter_id)).select(
        "encounter_id", "start_ts", "stop_ts", "encounter_class", "total_claim_cost",
        "length_of_stay_hours")


SQL["point_lookup_encounter"] = O.with_models(
    "SELECT encounter_id, start_ts, stop_ts, encounter_class, total_claim_cost, "
    "length_of_stay_hours FROM encounters "
    "WHERE encounter_id = (SELECT MIN(encounter_id) FROM encounters)")


@q("profile_value_num")
def profile_value_num(spark, sf):
    """Value counts of TYPE and VALUE_NUM consistency, on a
    two-column projection of the observations."""
    o = models(spark, sf).source("observations").select("TYPE", "VALUE_NUM")
    num = F.col("TYPE") == "numeric"
    return o.groupBy("TYPE").agg(
        cnt().alias("rows"),
        cnt_if(num & F.col("VALUE_NUM").isNull()).alias("numeric_missing_num"),
        cnt_if(~num & F.col("VALUE_NUM").isNotNull()).alias("text_with_num"),
        F.round(F.sum("VALUE_NUM"), 2).alias("value_num_sum"))


SQL["profile_value_num"] = O.with_models(
    "SELECT \"TYPE\", CAST(COUNT(*) AS BIGINT) AS rows, "
    f"{sql_cif(NUMERIC_MISSING)} AS numeric_missing_num, "
    f"{sql_cif(TEXT_WITH_NUM)} AS text_with_num, ROUND(SUM(VALUE_NUM), 2) AS value_num_sum "
    "FROM raw_observations GROUP BY \"TYPE\"")


@q("table_row_counts")
def table_row_counts(spark, sf):
    """V4: rows of the six raw tables in one result."""
    m = models(spark, sf)
    parts = [m.source(t).agg(cnt().alias("row_count")).select(
        F.lit(t.upper()).alias("table_name"), "row_count")
        for t in ["patients", "encounters", "conditions", "medications", "procedures",
                  "observations"]]
    return reduce(DataFrame.unionByName, parts)


SQL["table_row_counts"] = O.with_models(" UNION ALL ".join(
    f"SELECT '{t.upper()}' AS table_name, CAST(COUNT(*) AS BIGINT) AS row_count FROM raw_{t}"
    for t in ["patients", "encounters", "conditions", "medications", "procedures",
              "observations"]))


# --- raw profile of stays and episodes (V5-V11) -------------------------------------

@q("profile_encounter_classes")
def profile_encounter_classes(spark, sf):
    e = models(spark, sf).encounters
    return e.groupBy("encounter_class").agg(
        cnt().alias("encounters"),
        F.count_distinct("patient_id").cast("bigint").alias("patients"),
        avg1(hour_diff("start_ts", "stop_ts")).alias("avg_hours"))


SQL["profile_encounter_classes"] = O.with_models(
    "SELECT encounter_class, CAST(COUNT(*) AS BIGINT) AS encounters, "
    "CAST(COUNT(DISTINCT patient_id) AS BIGINT) AS patients, "
    f"{sql_avg1(HOUR_DIFF)} AS avg_hours "
    "FROM encounters GROUP BY encounter_class")


@q("naive_readmission_rate")
def naive_readmission_rate(spark, sf):
    """V6: next inpatient stay within 30 days, before any merging."""
    s = stays_with_next(models(spark, sf))
    r = s.agg(cnt().alias("index_stays"),
              cnt_if(day_diff("discharged_at", "next_admitted_at") <= 30).alias("readmitted_30d"))
    return r.select("*", pct("readmitted_30d", "index_stays").alias("readmit_rate_pct"))


SQL["naive_readmission_rate"] = O.with_models(
    "SELECT index_stays, readmitted_30d, "
    f"{sql_pct('readmitted_30d', 'index_stays')} AS readmit_rate_pct FROM ("
    "SELECT CAST(COUNT(*) AS BIGINT) AS index_stays, "
    f"{sql_cif(NEXT_WITHIN_30)} "
    "AS readmitted_30d FROM stays_next) t", SQL_STAYS_NEXT)


def _gap_bucket(g):
    return (F.when(g < 0, "1: negative (overlap)").when(g == 0, "2: same day (transfer?)")
            .when(g.between(1, 30), "3: 1-30 days (readmission)").otherwise("4: over 30 days"))


@q("gap_distribution")
def gap_distribution(spark, sf):
    """V7: gaps between consecutive stays in four buckets."""
    s = stays_with_next(models(spark, sf)).filter(F.col("next_admitted_at").isNotNull())
    g = s.select(day_diff("discharged_at", "next_admitted_at").alias("gap_days"))
    return (g.withColumn("gap_bucket", _gap_bucket(F.col("gap_days")))
            .groupBy("gap_bucket").agg(cnt().alias("stays")).orderBy("gap_bucket"))


SQL["gap_distribution"] = O.with_models(
    "SELECT CASE WHEN gap_days < 0 THEN '1: negative (overlap)' "
    "WHEN gap_days = 0 THEN '2: same day (transfer?)' "
    "WHEN gap_days BETWEEN 1 AND 30 THEN '3: 1-30 days (readmission)' "
    "ELSE '4: over 30 days' END AS gap_bucket, CAST(COUNT(*) AS BIGINT) AS stays "
    "FROM (SELECT date_diff('day', discharged_at, next_admitted_at) AS gap_days FROM stays_next "
    "WHERE next_admitted_at IS NOT NULL) g GROUP BY 1 ORDER BY 1", SQL_STAYS_NEXT)


@q("episode_readmission_rate")
def episode_readmission_rate(spark, sf):
    """V8: label rate once stays are merged into episodes."""
    e = spans_with_next(models(spark, sf))
    r = e.agg(cnt().alias("episodes"),
              cnt_if(day_diff("discharged_at", "next_admitted_at").between(1, 30))
              .alias("readmitted_30d"))
    return r.select("*", pct("readmitted_30d", "episodes").alias("readmit_rate_pct"))


SQL["episode_readmission_rate"] = O.with_models(
    f"SELECT episodes, readmitted_30d, {sql_pct('readmitted_30d', 'episodes')} AS readmit_rate_pct "
    "FROM (SELECT CAST(COUNT(*) AS BIGINT) AS episodes, "
    f"{sql_cif(NEXT_IN_1_30)} "
    "AS readmitted_30d FROM spans_next) t", SQL_SPANS_NEXT)


def _exclusions(m) -> DataFrame:
    """Profiling form of the exclusions: 'died' is any death on or before the
    discharge day + 1 (it also takes deaths before admission)."""
    e = m.hospice_chemo.join(m.patients.select("patient_id", "death_date"), "patient_id")
    return e.select(
        "patient_id", "episode_number", "admitted_at", "death_date",
        (F.col("death_date").isNotNull()
         & (F.col("death_date") <= F.to_date(plus_days_keep_time("discharged_at", 1))))
        .alias("died_in_episode"),
        F.coalesce(F.col("next_hospice") <= plus_days_keep_time("discharged_at", 1), F.lit(False))
        .alias("to_hospice"))


SQL_EXCL = (
    "excl AS (SELECT c.*, p.death_date, coalesce(p.death_date <= c.last_day + 1, false) AS died_in_episode, "
    "c.discharged_to_hospice AS to_hospice FROM course c JOIN patients p USING (patient_id))")


@q("exclusion_counts")
def exclusion_counts(spark, sf):
    """V9."""
    x = _exclusions(models(spark, sf))
    return x.agg(cnt().alias("episodes"), cnt_if(F.col("died_in_episode")).alias("died_in_episode"),
                 cnt_if(F.col("to_hospice")).alias("discharged_to_hospice"),
                 cnt_if(~F.col("died_in_episode") & ~F.col("to_hospice"))
                 .alias("eligible_index_episodes"))


SQL["exclusion_counts"] = O.with_models(
    "SELECT CAST(COUNT(*) AS BIGINT) AS episodes, "
    f"{sql_cif('died_in_episode')} AS died_in_episode, "
    f"{sql_cif('to_hospice')} AS discharged_to_hospice, "
    f"{sql_cif('NOT died_in_episode AND NOT to_hospice')} AS eligible_index_episodes FROM excl",
    SQL_EXCL)


@q("death_timing_split")
def death_timing_split(spark, sf):
    """The profiling deaths split by timing."""
    x = _exclusions(models(spark, sf)).filter(F.col("died_in_episode"))
    when = F.when(F.col("death_date") < F.to_date("admitted_at"),
                  "1: died BEFORE admission (data issue)").otherwise("2: died during episode")
    return x.withColumn("when_died", when).groupBy("when_died").agg(cnt().alias("episodes"))


SQL["death_timing_split"] = O.with_models(
    "SELECT CASE WHEN death_date < CAST(admitted_at AS DATE) "
    "THEN '1: died BEFORE admission (data issue)' ELSE '2: died during episode' END AS when_died, "
    "CAST(COUNT(*) AS BIGINT) AS episodes FROM excl WHERE died_in_episode GROUP BY 1", SQL_EXCL)


@q("label_funnel")
def label_funnel(spark, sf):
    """Stays -> episodes -> exclusions -> eligible -> rate (one row)."""
    m = models(spark, sf)
    stays = m.stays.agg(cnt().alias("inpatient_stays"))
    e = m.inpatient_episodes
    el = F.col("is_eligible_index")
    agg = e.agg(cnt().alias("episodes"), cnt_if(F.col("died_in_episode")).alias("died_in_episode"),
                cnt_if(F.col("death_before_admission")).alias("death_before_admission"),
                cnt_if(F.col("discharged_to_hospice")).alias("discharged_to_hospice"),
                cnt_if(el).alias("eligible"),
                cnt_if(el & F.col("readmitted_30d")).alias("readmitted_eligible"))
    r = side_by_side(stays, agg)
    return r.select("*", pct("readmitted_eligible", "eligible").alias("rate_pct"))


SQL["label_funnel"] = O.with_models(
    "SELECT s.inpatient_stays, a.*, "
    f"{sql_pct('a.readmitted_eligible', 'a.eligible')} AS rate_pct FROM "
    "(SELECT CAST(COUNT(*) AS BIGINT) AS inpatient_stays FROM stay) s, "
    "(SELECT CAST(COUNT(*) AS BIGINT) AS episodes, "
    f"{sql_cif('died_in_episode')} AS died_in_episode, "
    f"{sql_cif('death_before_admission')} AS death_before_admission, "
    f"{sql_cif('discharged_to_hospice')} AS discharged_to_hospice, "
    f"{sql_cif('is_eligible_index')} AS eligible, "
    f"{sql_cif('is_eligible_index AND readmitted_30d')} AS readmitted_eligible "
    "FROM inpatient_episodes) a")


# --- core checks (V12-V18) ----------------------------------------------------------

@q("validate_core_patients")
def validate_core_patients(spark, sf):
    p = models(spark, sf).patients
    return p.agg(cnt().alias("total_rows"),
                 F.count_distinct("patient_id").cast("bigint").alias("distinct_patients"),
                 cnt_if(F.col("geo_known") == False).alias("geo_unknown"),  # noqa: E712
                 cnt_if(F.col("zip3").isNull()).alias("zip3_null"))


SQL["validate_core_patients"] = O.with_models(
    "SELECT CAST(COUNT(*) AS BIGINT) AS total_rows, "
    "CAST(COUNT(DISTINCT patient_id) AS BIGINT) AS distinct_patients, "
    f"{sql_cif('geo_known = FALSE')} AS geo_unknown, {sql_cif('zip3 IS NULL')} AS zip3_null "
    "FROM patients")


@q("validate_core_encounters")
def validate_core_encounters(spark, sf):
    e = models(spark, sf).encounters
    return e.agg(cnt().alias("total_rows"),
                 F.count_distinct("encounter_id").cast("bigint").alias("distinct_encounters"),
                 cnt_if(F.col("length_of_stay_hours") < 0).alias("neg_length"))


SQL["validate_core_encounters"] = O.with_models(
    "SELECT CAST(COUNT(*) AS BIGINT) AS total_rows, "
    "CAST(COUNT(DISTINCT encounter_id) AS BIGINT) AS distinct_encounters, "
    f"{sql_cif('length_of_stay_hours < 0')} AS neg_length FROM encounters")


@q("validate_episode_shape")
def validate_episode_shape(spark, sf):
    e = models(spark, sf).inpatient_episodes
    return e.agg(cnt().alias("total_rows"),
                 F.count_distinct("episode_id").cast("bigint").alias("distinct_episode_ids"),
                 F.count_distinct("patient_id").cast("bigint").alias("patients"),
                 F.max("episode_number").alias("most_episodes_one_patient"))


SQL["validate_episode_shape"] = O.with_models(
    "SELECT CAST(COUNT(*) AS BIGINT) AS total_rows, "
    "CAST(COUNT(DISTINCT episode_id) AS BIGINT) AS distinct_episode_ids, "
    "CAST(COUNT(DISTINCT patient_id) AS BIGINT) AS patients, "
    "MAX(episode_number) AS most_episodes_one_patient FROM inpatient_episodes")


@q("validate_episode_merge")
def validate_episode_merge(spark, sf):
    e = models(spark, sf).inpatient_episodes
    return e.agg(cnt().alias("episodes"), F.sum("stay_in_episode").cast("bigint").alias("total_stays"),
                 cnt_if(F.col("stay_in_episode") > 1).alias("merged_episodes"),
                 F.max("stay_in_episode").alias("most_stays_in_one"))


SQL["validate_episode_merge"] = O.with_models(
    "SELECT CAST(COUNT(*) AS BIGINT) AS episodes, CAST(SUM(stay_in_episode) AS BIGINT) AS total_stays, "
    f"{sql_cif('stay_in_episode > 1')} AS merged_episodes, "
    "MAX(stay_in_episode) AS most_stays_in_one FROM inpatient_episodes")


@q("validate_death_flags")
def validate_death_flags(spark, sf):
    e = models(spark, sf).inpatient_episodes
    d, b, h = F.col("died_in_episode"), F.col("death_before_admission"), F.col("discharged_to_hospice")
    return e.agg(cnt().alias("episodes"), cnt_if(d).alias("died"), cnt_if(b).alias("data_issue"),
                 cnt_if(d & b).alias("both_flags"), cnt_if(h).alias("hospice"),
                 cnt_if(h & d).alias("hospice_and_died"),
                 cnt_if(~d & ~b & ~h).alias("eligible"))


SQL["validate_death_flags"] = O.with_models(
    "SELECT CAST(COUNT(*) AS BIGINT) AS episodes, "
    f"{sql_cif('died_in_episode')} AS died, {sql_cif('death_before_admission')} AS data_issue, "
    f"{sql_cif('died_in_episode AND death_before_admission')} AS both_flags, "
    f"{sql_cif('discharged_to_hospice')} AS hospice, "
    f"{sql_cif('discharged_to_hospice AND died_in_episode')} AS hospice_and_died, "
    f"{sql_cif('NOT died_in_episode AND NOT death_before_admission AND NOT discharged_to_hospice')} "
    "AS eligible FROM inpatient_episodes")


@q("validate_label_rate")
def validate_label_rate(spark, sf):
    e = models(spark, sf).inpatient_episodes
    el, r = F.col("is_eligible_index"), F.col("readmitted_30d")
    a = e.agg(cnt().alias("episodes"),
              F.count_distinct("episode_id").cast("bigint").alias("distinct_ids"),
              cnt_if(r).alias("readmitted_all"), cnt_if(el).alias("eligible"),
              cnt_if(el & r).alias("readmitted_eligible"))
    return a.select("*", pct("readmitted_eligible", "eligible").alias("rate_pct"))


SQL["validate_label_rate"] = O.with_models(
    f"SELECT *, {sql_pct('readmitted_eligible', 'eligible')} AS rate_pct FROM ("
    "SELECT CAST(COUNT(*) AS BIGINT) AS episodes, CAST(COUNT(DISTINCT episode_id) AS BIGINT) "
    f"AS distinct_ids, {sql_cif('readmitted_30d')} AS readmitted_all, "
    f"{sql_cif('is_eligible_index')} AS eligible, "
    f"{sql_cif('is_eligible_index AND readmitted_30d')} AS readmitted_eligible "
    "FROM inpatient_episodes) t")


@q("patient_episode_history")
def patient_episode_history(spark, sf):
    """The episodes of one patient, in order: the patient with the most
    episodes (smallest id on ties)."""
    e = models(spark, sf).inpatient_episodes
    top = (e.groupBy("patient_id").agg(F.max("episode_number").alias("n"))
           .orderBy(F.desc("n"), F.asc("patient_id")).limit(1))
    return e.join(F.broadcast(top.select("patient_id")), "patient_id").orderBy("admitted_at")


SQL["patient_episode_history"] = O.with_models(
    f"SELECT {O.EPISODE_COLS} FROM inpatient_episodes WHERE patient_id = ("
    "SELECT patient_id FROM inpatient_episodes GROUP BY patient_id "
    "ORDER BY MAX(episode_number) DESC, patient_id LIMIT 1) ORDER BY admitted_at")


# --- features (V20-V24) -------------------------------------------------------------

def _bnr(admitted, birth):
    return F.when(F.date_format(F.to_date(admitted), "MM-dd") < F.date_format(birth, "MM-dd"),
                  F.lit(1)).otherwise(F.lit(0))


@q("birthday_not_reached")
def birthday_not_reached(spark, sf):
    m = models(spark, sf)
    f = m.episode_features.select("episode_id", "patient_id", "admitted_at").join(
        m.patients.select("patient_id", "birth_date"), "patient_id")
    return (f.withColumn("birthday_not_reached", _bnr("admitted_at", F.col("birth_date")))
            .groupBy("birthday_not_reached").agg(cnt().alias("episodes")))


SQL["birthday_not_reached"] = O.with_models(
    "SELECT CASE WHEN strftime(CAST(e.admitted_at AS DATE), '%m-%d') < strftime(p.birth_date, '%m-%d') "
    "THEN 1 ELSE 0 END AS birthday_not_reached, CAST(COUNT(*) AS BIGINT) AS episodes "
    "FROM episode_features e JOIN patients p ON p.patient_id = e.patient_id GROUP BY 1")


@q("validate_feature_ranges")
def validate_feature_ranges(spark, sf):
    f = models(spark, sf).episode_features
    return f.agg(
        F.min("age_at_admission").alias("min_age"), F.max("age_at_admission").alias("max_age"),
        F.min("length_of_stay_days").alias("min_los"), F.max("length_of_stay_days").alias("max_los"),
        F.min("prior_episodes").alias("min_prior"), F.max("prior_episodes").alias("max_prior"),
        F.min("prior_episodes_365d").alias("min_prior365"),
        F.max("prior_episodes_365d").alias("max_prior365"),
        F.min(hour_diff("admitted_at", "discharged_at")).alias("shortest_episode_hours"))


SQL["validate_feature_ranges"] = O.with_models(
    "SELECT MIN(age_at_admission) AS min_age, MAX(age_at_admission) AS max_age, "
    "MIN(length_of_stay_days) AS min_los, MAX(length_of_stay_days) AS max_los, "
    "MIN(prior_episodes) AS min_prior, MAX(prior_episodes) AS max_prior, "
    "MIN(prior_episodes_365d) AS min_prior365, MAX(prior_episodes_365d) AS max_prior365, "
    "MIN(date_diff('hour', admitted_at, discharged_at)) AS shortest_episode_hours "
    "FROM episode_features")


@q("leak_first_episode")
def leak_first_episode(spark, sf):
    """prior_episodes = 0 must be the patient's first episode."""
    f = models(spark, sf).episode_features
    return check_row("prior_zero_not_first",
                     f.filter((F.col("prior_episodes") == 0) & ~F.col("episode_id").like("%-1")))


SQL["leak_first_episode"] = O.with_models(sql_check(
    "prior_zero_not_first",
    "SELECT episode_id FROM episode_features WHERE prior_episodes = 0 "
    "AND episode_id NOT LIKE '%-1'"))


@q("leak_365d_checks")
def leak_365d_checks(spark, sf):
    """365-day history never exceeds all-time history; none without
    history; no NULLs."""
    f = models(spark, sf).episode_features
    p, y = F.col("prior_episodes"), F.col("prior_episodes_365d")
    parts = [check_row("365d_gt_all_time", f.filter(y > p)),
             check_row("no_history_but_recent", f.filter((p == 0) & (y != 0))),
             check_row("365d_null", f.filter(y.isNull()))]
    return reduce(DataFrame.unionByName, parts)


SQL["leak_365d_checks"] = O.with_models(" UNION ALL ".join([
    sql_check("365d_gt_all_time",
              "SELECT 1 FROM episode_features WHERE prior_episodes_365d > prior_episodes"),
    sql_check("no_history_but_recent", "SELECT 1 FROM episode_features WHERE prior_episodes = 0 "
              "AND prior_episodes_365d <> 0"),
    sql_check("365d_null", "SELECT 1 FROM episode_features WHERE prior_episodes_365d IS NULL")]))


@q("signal_prior_episodes")
def signal_prior_episodes(spark, sf):
    """Readmission rate by prior_episodes_365d bucket."""
    f = models(spark, sf).episode_features
    y = F.col("prior_episodes_365d")
    b = F.when(y == 0, "0").when(y == 1, "1").when(y == 2, "2").otherwise("3+")
    g = f.withColumn("bucket", b).groupBy("bucket").agg(
        F.count("episode_id").cast("bigint").alias("episodes"),
        cnt_if(F.col("readmitted_30d")).alias("readmitted"))
    return g.select("*", pct("readmitted", "episodes").alias("rate_pct")).orderBy("bucket")


SQL["signal_prior_episodes"] = O.with_models(
    f"SELECT *, {sql_pct('readmitted', 'episodes')} AS rate_pct FROM ("
    "SELECT CASE WHEN prior_episodes_365d = 0 THEN '0' WHEN prior_episodes_365d = 1 THEN '1' "
    "WHEN prior_episodes_365d = 2 THEN '2' ELSE '3+' END AS bucket, "
    "CAST(COUNT(episode_id) AS BIGINT) AS episodes, "
    f"{sql_cif('readmitted_30d')} AS readmitted FROM episode_features GROUP BY 1) t ORDER BY bucket")


# --- stay classification (V25) ------------------------------------------------------

def _labelled(m) -> DataFrame:
    s = m.stays
    g = day_diff("prev_max_discharge", "admitted_at")
    return s.select("patient_id", "encounter_id", "admitted_at", "discharged_at", "prev_max_discharge",
                    g.alias("gap_days"), "new_episode", "episode_number")


def stay_type():
    g = F.col("gap_days")
    return (F.when(F.col("prev_max_discharge").isNull(), "1: first stay")
            .when(g < 0, "2: overlap (same episode)")
            .when(g == 0, "3: same-day transfer (same episode)").otherwise("4: new episode"))


STAY_TYPE = (
    "CASE WHEN prev_max_discharge IS NULL THEN '1: first stay' "
    "WHEN date_diff('day', prev_max_discharge, admitted_at) < 0 THEN '2: overlap (same episode)' "
    "WHEN date_diff('day', prev_max_discharge, admitted_at) = 0 "
    "THEN '3: same-day transfer (same episode)' ELSE '4: new episode' END")


@q("stay_type_classification")
def stay_type_classification(spark, sf):
    s = _labelled(models(spark, sf))
    return (s.withColumn("stay_type", stay_type()).groupBy("stay_type")
            .agg(cnt().alias("stays"), F.sum("new_episode").cast("bigint").alias("new_episode_flags"))
            .orderBy("stay_type"))


SQL["stay_type_classification"] = O.with_models(
    f"SELECT {STAY_TYPE} AS stay_type, "
    "CAST(COUNT(*) AS BIGINT) AS stays, CAST(SUM(new_episode) AS BIGINT) AS new_episode_flags "
    "FROM stays_numbered GROUP BY 1 ORDER BY 1")


@q("patients_all_stay_types")
def patients_all_stay_types(spark, sf):
    """Patients showing an overlap, a same-day transfer and a new episode;
    the ten with fewest stays (a top-k report)."""
    s = _labelled(models(spark, sf))
    g = F.col("gap_days")
    a = s.groupBy("patient_id").agg(cnt().alias("stays"), cnt_if(g < 0).alias("overlaps"),
                                    cnt_if(g == 0).alias("same_day_transfers"),
                                    cnt_if(g > 0).alias("new_episodes"))
    a = a.filter((F.col("overlaps") > 0) & (F.col("same_day_transfers") > 0)
                 & (F.col("new_episodes") > 0))
    return a.orderBy("stays", "patient_id").limit(10)


SQL["patients_all_stay_types"] = O.with_models(
    "SELECT * FROM (SELECT patient_id, CAST(COUNT(*) AS BIGINT) AS stays, "
    f"{sql_cif('g < 0')} AS \"overlaps\", {sql_cif('g = 0')} AS same_day_transfers, "
    f"{sql_cif('g > 0')} AS new_episodes FROM (SELECT patient_id, "
    "date_diff('day', prev_max_discharge, admitted_at) AS g FROM stays_numbered) l "
    "GROUP BY patient_id) a WHERE \"overlaps\" > 0 AND same_day_transfers > 0 AND new_episodes > 0 "
    "ORDER BY stays, patient_id LIMIT 10")


# --- conditions (V26-V36) -------------------------------------------------------------

@q("profile_open_conditions")
def profile_open_conditions(spark, sf):
    c = models(spark, sf).source("conditions")
    return c.agg(F.count_distinct("PATIENT").cast("bigint").alias("distinct_patients"),
                 cnt().alias("total_rows"), cnt_if(F.col("STOP").isNull()).alias("open_rows"))


SQL["profile_open_conditions"] = O.with_models(
    "SELECT CAST(COUNT(DISTINCT \"PATIENT\") AS BIGINT) AS distinct_patients, "
    "CAST(COUNT(*) AS BIGINT) AS total_rows, "
    f"{sql_cif(STOP_NULL)} AS open_rows FROM raw_conditions")


@q("top_descriptions")
def top_descriptions(spark, sf):
    c = models(spark, sf).source("conditions")
    return (c.groupBy(F.col("DESCRIPTION").alias("description")).agg(cnt().alias("n_rows"))
            .orderBy(F.desc("n_rows"), F.asc_nulls_last("description")).limit(15))


SQL["top_descriptions"] = O.with_models(
    "SELECT \"DESCRIPTION\" AS description, CAST(COUNT(*) AS BIGINT) AS n_rows FROM raw_conditions "
    "GROUP BY 1 ORDER BY n_rows DESC, description ASC NULLS LAST LIMIT 15")


@q("distinct_situations")
def distinct_situations(spark, sf):
    c = models(spark, sf).source("conditions")
    return (c.filter(F.col("DESCRIPTION").like("%(situation)%"))
            .select(F.col("DESCRIPTION").alias("description")).distinct())


SQL["distinct_situations"] = O.with_models(
    "SELECT DISTINCT \"DESCRIPTION\" AS description FROM raw_conditions "
    "WHERE \"DESCRIPTION\" LIKE '%(situation)%'")


@q("chronic_open_share")
def chronic_open_share(spark, sf):
    """Share of open rows per disorder, top 25 by rows."""
    c = models(spark, sf).source("conditions").filter(F.col("DESCRIPTION").like("%(disorder)"))
    g = c.groupBy(F.col("DESCRIPTION").alias("description")).agg(
        cnt().alias("total_rows"), cnt_if(F.col("STOP").isNull()).alias("open_rows"))
    return (g.select("*", pct("open_rows", "total_rows").alias("pct_open"))
            .orderBy(F.desc("total_rows"), F.asc_nulls_last("description")).limit(25))


SQL["chronic_open_share"] = O.with_models(
    f"SELECT *, {sql_pct('open_rows', 'total_rows')} AS pct_open FROM ("
    "SELECT \"DESCRIPTION\" AS description, CAST(COUNT(*) AS BIGINT) AS total_rows, "
    f"{sql_cif(STOP_NULL)} AS open_rows FROM raw_conditions "
    "WHERE \"DESCRIPTION\" LIKE '%(disorder)' GROUP BY 1) t "
    "ORDER BY total_rows DESC, description ASC NULLS LAST LIMIT 25")


@q("validate_disorder_flag")
def validate_disorder_flag(spark, sf):
    """Flag count in core, independent recount from raw, NULL flags."""
    m = models(spark, sf)
    core = m.conditions.agg(cnt_if(F.col("is_disorder")).alias("disorder_rows"),
                            cnt_if(F.col("is_disorder").isNull()).alias("null_flags"),
                            cnt_if(F.col("is_disorder") == False).alias("false_flags"))  # noqa: E712
    raw = m.source("conditions").filter(F.col("DESCRIPTION").like("%(disorder)")).agg(
        cnt().alias("disorder_rows_raw"))
    return side_by_side(core, raw).select(
        "disorder_rows", "disorder_rows_raw", "false_flags", "null_flags")


SQL["validate_disorder_flag"] = O.with_models(
    f"SELECT a.disorder_rows, b.disorder_rows_raw, a.false_flags, a.null_flags FROM "
    f"(SELECT {sql_cif('is_disorder')} AS disorder_rows, {sql_cif('is_disorder IS NULL')} "
    f"AS null_flags, {sql_cif('is_disorder = FALSE')} AS false_flags FROM conditions) a, "
    "(SELECT CAST(COUNT(*) AS BIGINT) AS disorder_rows_raw FROM raw_conditions "
    "WHERE \"DESCRIPTION\" LIKE '%(disorder)') b")


@q("validate_active_disorders")
def validate_active_disorders(spark, sf):
    f = models(spark, sf).episode_features
    a = F.col("active_disorders_at_discharge")
    return f.agg(cnt_if(a.isNull()).alias("null_rows"), F.min(a).alias("min_active"),
                 F.max(a).alias("max_active"))


SQL["validate_active_disorders"] = O.with_models(
    f"SELECT {sql_cif('active_disorders_at_discharge IS NULL')} AS null_rows, "
    "MIN(active_disorders_at_discharge) AS min_active, "
    "MAX(active_disorders_at_discharge) AS max_active FROM episode_features")


@q("distribution_active_disorders")
def distribution_active_disorders(spark, sf):
    f = models(spark, sf).episode_features
    return (f.groupBy("active_disorders_at_discharge").agg(cnt().alias("episodes"))
            .orderBy("active_disorders_at_discharge"))


SQL["distribution_active_disorders"] = O.with_models(
    "SELECT active_disorders_at_discharge, CAST(COUNT(*) AS BIGINT) AS episodes "
    "FROM episode_features GROUP BY 1 ORDER BY 1")


@q("signal_active_disorders")
def signal_active_disorders(spark, sf):
    """Rate by active-disorder bucket, buckets ordered by their smallest
    value (an aggregate that is not selected)."""
    f = models(spark, sf).episode_features
    a = F.col("active_disorders_at_discharge")
    b = (F.when(a == 0, "0").when(a.between(1, 2), "1-2").when(a.between(3, 5), "3-5")
         .when(a.between(6, 9), "6-9").when(a.between(10, 14), "10-14").otherwise("15+"))
    g = f.withColumn("bucket", b).groupBy("bucket").agg(
        cnt().alias("episodes"), cnt_if(F.col("readmitted_30d")).alias("readmitted"),
        F.min(a).alias("__lo"))
    return (g.select("bucket", "episodes", "readmitted",
                     pct("readmitted", "episodes").alias("rate_pct"), "__lo")
            .orderBy("__lo").drop("__lo"))


SQL["signal_active_disorders"] = O.with_models(
    f"SELECT bucket, episodes, readmitted, {sql_pct('readmitted', 'episodes')} AS rate_pct FROM ("
    "SELECT CASE WHEN active_disorders_at_discharge = 0 THEN '0' "
    "WHEN active_disorders_at_discharge BETWEEN 1 AND 2 THEN '1-2' "
    "WHEN active_disorders_at_discharge BETWEEN 3 AND 5 THEN '3-5' "
    "WHEN active_disorders_at_discharge BETWEEN 6 AND 9 THEN '6-9' "
    "WHEN active_disorders_at_discharge BETWEEN 10 AND 14 THEN '10-14' ELSE '15+' END AS bucket, "
    f"CAST(COUNT(*) AS BIGINT) AS episodes, {sql_cif('readmitted_30d')} AS readmitted, "
    "MIN(active_disorders_at_discharge) AS lo FROM episode_features GROUP BY 1) t ORDER BY lo")


@q("zero_disorder_profile")
def zero_disorder_profile(spark, sf):
    f = models(spark, sf).episode_features.filter(F.col("active_disorders_at_discharge") == 0)
    return f.groupBy("gender").agg(cnt().alias("episodes"),
                                   F.avg("age_at_admission").alias("avg_age"),
                                   F.avg("length_of_stay_days").alias("avg_stay_days"))


SQL["zero_disorder_profile"] = O.with_models(
    "SELECT gender, CAST(COUNT(*) AS BIGINT) AS episodes, AVG(age_at_admission) AS avg_age, "
    "AVG(length_of_stay_days) AS avg_stay_days FROM episode_features "
    "WHERE active_disorders_at_discharge = 0 GROUP BY gender")


def _zero_group_encounters(m) -> DataFrame:
    """Zero-disorder episodes joined to the inpatient encounter that
    starts them (two keys + a constant predicate)."""
    f = m.episode_features.filter(F.col("active_disorders_at_discharge") == 0)
    en = m.encounters.filter(F.col("encounter_class") == "inpatient").select(
        "patient_id", F.col("start_ts").alias("admitted_at"), "description", "reason_description")
    return f.join(en, ["patient_id", "admitted_at"], "inner")


@q("admission_reason_top")
def admission_reason_top(spark, sf):
    j = _zero_group_encounters(models(spark, sf))
    g = j.groupBy("gender", "description", "reason_description").agg(
        F.count_distinct("episode_id").cast("bigint").alias("episodes"))
    return g.orderBy(F.desc("episodes"), *asc_nulls_last("gender", "description", "reason_description")) \
        .limit(10)


SQL["admission_reason_top"] = O.with_models(
    "SELECT f.gender, en.description, en.reason_description, "
    "CAST(COUNT(DISTINCT f.episode_id) AS BIGINT) AS episodes FROM episode_features f "
    "JOIN encounters en ON en.patient_id = f.patient_id AND en.start_ts = f.admitted_at "
    "AND en.encounter_class = 'inpatient' WHERE f.active_disorders_at_discharge = 0 "
    "GROUP BY 1, 2, 3 ORDER BY episodes DESC, gender ASC NULLS LAST, description ASC NULLS LAST, "
    "reason_description ASC NULLS LAST LIMIT 10")


@q("validate_patient_conditions")
def validate_patient_conditions(spark, sf):
    """One zero-disorder example admitted for a given reason, then that
    patient's condition rows that match a text or lie near the stay."""
    m = models(spark, sf)
    ex = (_zero_group_encounters(m).filter(F.col("reason_description").like("%Appendicitis%"))
          .orderBy("episode_id").limit(1)
          .select("patient_id", F.year("admitted_at").alias("y")))
    c = m.conditions.join(F.broadcast(ex), "patient_id")
    lo = F.make_date(F.col("y") - 1, F.lit(1), F.lit(1))
    hi = F.make_date(F.col("y") + 1, F.lit(12), F.lit(31))
    c = c.filter(F.col("description").ilike("%ring%") | F.col("start_date").between(lo, hi))
    return c.select("patient_id", "start_date", "stop_date", "description", "is_disorder") \
        .orderBy("start_date")


SQL["validate_patient_conditions"] = O.with_models(
    "SELECT c.patient_id, c.start_date, c.stop_date, c.description, c.is_disorder "
    "FROM conditions c JOIN (SELECT f.patient_id, year(f.admitted_at) AS y "
    "FROM episode_features f JOIN encounters en ON en.patient_id = f.patient_id "
    "AND en.start_ts = f.admitted_at AND en.encounter_class = 'inpatient' "
    "WHERE f.active_disorders_at_discharge = 0 AND en.reason_description LIKE '%Appendicitis%' "
    "ORDER BY f.episode_id LIMIT 1) ex ON c.patient_id = ex.patient_id "
    "WHERE c.description ILIKE '%ring%' OR c.start_date BETWEEN make_date(CAST(ex.y - 1 AS INTEGER), 1, 1) "
    "AND make_date(CAST(ex.y + 1 AS INTEGER), 12, 31) ORDER BY c.start_date")


# --- column inventory (V37, S5, A15) ----------------------------------------------------

ENCOUNTER_TYPES = [
    ("encounter_id", "string"), ("patient_id", "string"), ("start_ts", "timestamp_ntz"),
    ("stop_ts", "timestamp_ntz"), ("encounter_class", "string"), ("organization_id", "string"),
    ("provider_id", "string"), ("payer_id", "string"), ("code", "string"),
    ("description", "string"), ("base_encounter_cost", "decimal(14,2)"),
    ("total_claim_cost", "decimal(14,2)"), ("payer_coverage", "decimal(14,2)"),
    ("reason_code", "string"), ("reason_description", "string"),
    ("length_of_stay_hours", "double"),
]


@q("column_profile")
def column_profile_q(spark, sf):
    return column_profile(models(spark, sf).encounters)


def _profile_sql(table: str, cols: list[tuple[str, str]], table_col: str | None = None) -> str:
    parts = []
    for i, (c, t) in enumerate(cols):
        fmt = f"printf('%.6f', {{}}({c}))" if t == "double" else f"CAST({{}}({c}) AS VARCHAR)"
        tc = f"'{table_col}' AS table_name, " if table_col else ""
        parts.append(
            f"SELECT {tc}{i + 1} AS ordinal, '{c}' AS column_name, '{t}' AS data_type, "
            f"CAST(COUNT(*) AS BIGINT) AS rows, {sql_cif(c + ' IS NULL')} AS nulls, "
            f"CAST(COUNT(DISTINCT {c}) AS BIGINT) AS distinct_values, "
            f"{fmt.format('MIN')} AS min_value, {fmt.format('MAX')} AS max_value FROM {table}")
    return " UNION ALL ".join(parts)


SQL["column_profile"] = O.with_models(_profile_sql("encounters", ENCOUNTER_TYPES))

RAW_TYPES = {
    "patients": [("Id", "string"), ("BIRTHDATE", "date"), ("DEATHDATE", "date"),
                 ("MARITAL", "string"), ("RACE", "string"), ("ETHNICITY", "string"),
                 ("GENDER", "string"), ("STATE", "string"), ("COUNTY", "string"),
                 ("FIPS", "string"), ("HEALTHCARE_EXPENSES", "decimal(14,2)"),
                 ("HEALTHCARE_COVERAGE", "decimal(14,2)"), ("INCOME", "int"), ("ZIP3", "string")],
    "conditions": [("START", "date"), ("STOP", "date"), ("PATIENT", "string"),
                   ("ENCOUNTER", "string"), ("SYSTEM", "string"), ("CODE", "string"),
                   ("DESCRIPTION", "string")],
    "encounters": [("Id", "string"), ("START", "timestamp_ntz"), ("STOP", "timestamp_ntz"),
                   ("PATIENT", "string"), ("ORGANIZATION", "string"), ("PROVIDER", "string"),
                   ("PAYER", "string"), ("ENCOUNTERCLASS", "string"), ("CODE", "string"),
                   ("DESCRIPTION", "string"), ("BASE_ENCOUNTER_COST", "decimal(14,2)"),
                   ("TOTAL_CLAIM_COST", "decimal(14,2)"), ("PAYER_COVERAGE", "decimal(14,2)"),
                   ("REASONCODE", "string"), ("REASONDESCRIPTION", "string")],
    "medications": [("START", "timestamp_ntz"), ("STOP", "timestamp_ntz"), ("PATIENT", "string"),
                    ("PAYER", "string"), ("ENCOUNTER", "string"), ("CODE", "string"),
                    ("DESCRIPTION", "string"), ("BASE_COST", "decimal(14,2)"),
                    ("PAYER_COVERAGE", "decimal(14,2)"), ("DISPENSES", "int"),
                    ("TOTALCOST", "decimal(14,2)"), ("REASONCODE", "string"),
                    ("REASONDESCRIPTION", "string")],
    "procedures": [("START", "timestamp_ntz"), ("STOP", "timestamp_ntz"), ("PATIENT", "string"),
                   ("ENCOUNTER", "string"), ("SYSTEM", "string"), ("CODE", "string"),
                   ("DESCRIPTION", "string"), ("BASE_COST", "decimal(14,2)"),
                   ("REASONCODE", "string"), ("REASONDESCRIPTION", "string")],
    "observations": [("DATE", "timestamp_ntz"), ("PATIENT", "string"), ("ENCOUNTER", "string"),
                     ("CATEGORY", "string"), ("CODE", "string"), ("DESCRIPTION", "string"),
                     ("VALUE", "string"), ("UNITS", "string"), ("TYPE", "string"),
                     ("VALUE_NUM", "double")],
}
CORE_TYPES = {
    "patients": [("patient_id", "string"), ("birth_date", "date"), ("death_date", "date"),
                 ("gender", "string"), ("race", "string"), ("ethnicity", "string"),
                 ("marital_status", "string"), ("state", "string"), ("county", "string"),
                 ("fips", "string"), ("zip3", "string"), ("geo_known", "boolean"),
                 ("healthcare_expenses", "decimal(14,2)"), ("healthcare_coverage", "decimal(14,2)"),
                 ("income", "int")],
    "encounters": ENCOUNTER_TYPES,
    "conditions": [("start_date", "date"), ("stop_date", "date"), ("patient_id", "string"),
                   ("encounter_id", "string"), ("code_system", "string"),
                   ("condition_code", "string"), ("description", "string"),
                   ("is_disorder", "boolean")],
    "procedures": [("start_ts", "timestamp_ntz"), ("stop_ts", "timestamp_ntz"),
                   ("patient_id", "string"), ("encounter_id", "string"), ("code_system", "string"),
                   ("procedure_code", "string"), ("description", "string"),
                   ("base_cost", "decimal(14,2)"), ("reason_code", "string"),
                   ("reason_description", "string"), ("is_chemotherapy", "boolean")],
}


@q("ordered_array_agg")
def ordered_array_agg(spark, sf):
    """Each table's profile rows folded into one ordered array of
    column objects (the template a table is created from)."""
    m = models(spark, sf)
    parts = [column_profile(m.source(t)).withColumn("table_name", F.lit(t)) for t in RAW_TYPES]
    return ordered_template(reduce(DataFrame.unionByName, parts), "table_name")


def _template_sql() -> str:
    prof = " UNION ALL ".join(
        "(" + _profile_sql(f"raw_{t}", [(f'"{c}"', ty) for c, ty in cols], t) + ")"
        for t, cols in RAW_TYPES.items())
    return (
        "SELECT table_name, CAST(COUNT(*) AS BIGINT) AS n_columns, "
        "string_agg(CAST(ordinal AS VARCHAR) || ':' || replace(column_name, '\"', '') || ':' || "
        "data_type || ':' || CASE WHEN nulls > 0 THEN 'true' ELSE 'false' END, ',' ORDER BY ordinal) "
        f"AS template FROM ({prof}) p GROUP BY table_name")


SQL["ordered_array_agg"] = O.with_models(_template_sql())


@q("column_inventory")
def column_inventory(spark, sf):
    """Raw and core columns of each table side by side, with the NULLs
    counted in either."""
    m = models(spark, sf)

    def nulls(df, side):
        counts = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(f"n{i}") for i, c in enumerate(df.columns)])
        cols = ", ".join(f"{i + 1}, '{c}', '{t}', n{i}" for i, (c, t) in enumerate(df.dtypes))
        return counts.selectExpr(f"stack({len(df.columns)}, {cols}) AS "
                                 f"(ordinal, {side}_column, {side}_type, {side}_nulls)")
    parts = [nulls(m.source(t), "raw").join(nulls(m.ref(t), "core"), "ordinal", "full")
             .withColumn("table_name", F.lit(t)) for t in CORE_TYPES]
    return reduce(DataFrame.unionByName, parts)


def _inventory_sql() -> str:
    def side(table, cols, name):
        return "(" + " UNION ALL ".join(
            f"SELECT {i + 1} AS ordinal, '{c}' AS {name}_column, '{t}' AS {name}_type, "
            f"count(*) FILTER (\"{c}\" IS NULL) AS {name}_nulls FROM {table}"
            for i, (c, t) in enumerate(cols)) + ")"
    return " UNION ALL ".join(
        f"SELECT *, '{t}' AS table_name FROM {side('raw_' + t, RAW_TYPES[t], 'raw')} r "
        f"FULL JOIN {side(t, CORE_TYPES[t], 'core')} c USING (ordinal)" for t in CORE_TYPES)


SQL["column_inventory"] = O.with_models(_inventory_sql())


@q("patient_stay_trace")
def patient_stay_trace(spark, sf):
    """Stay by stay, one patient (the one with most stays, the smallest
    id among equals): gap to what came before, type and episode."""
    s = _labelled(models(spark, sf))
    top = (s.groupBy("patient_id").agg(cnt().alias("n")).orderBy(F.desc("n"), "patient_id").limit(1)
           .select(F.col("patient_id").alias("p")))
    return (s.join(F.broadcast(top), F.col("patient_id") == F.col("p"))  # one row
            .select("patient_id", "encounter_id", "admitted_at", "discharged_at", "prev_max_discharge",
                    "gap_days", stay_type().alias("stay_type"), "new_episode", "episode_number"))


SQL["patient_stay_trace"] = O.with_models(
    "SELECT patient_id, encounter_id, admitted_at, discharged_at, prev_max_discharge, "
    "CAST(date_diff('day', prev_max_discharge, admitted_at) AS INTEGER) AS gap_days, "
    f"{STAY_TYPE} AS stay_type, new_episode, episode_number FROM stays_numbered WHERE patient_id = "
    "(SELECT patient_id FROM stays_numbered GROUP BY patient_id ORDER BY COUNT(*) DESC, patient_id LIMIT 1)")


# --- samples (S10, O4, O5) ---------------------------------------------------------

SAMPLE_HEAD = 200_000


def _before(columns: list[str], row) -> F.Column:
    """Whether a row sorts before ``row`` by ``columns`` (NULLs last)."""
    less, same = F.lit(False), F.lit(True)
    for c in columns:
        v, x = F.col(c), F.lit(row[c])
        first = v.isNotNull() if row[c] is None else F.coalesce(v < x, F.lit(False))
        less = less | (same & first)
        same = same & v.eqNullSafe(x)
    return less


def head_sample(o: DataFrame, order: list[str], kinds: dict[str, F.Column], head: int, n: int = 3) -> DataFrame:
    """The first ``n`` rows of each kind among the first ``head`` rows by
    ``order``. The first rows of each kind are taken from the whole table (a
    top-n), then one aggregate counts how many rows precede each of them, so
    the head itself is never gathered."""
    spark = o.sparkSession
    tops = reduce(DataFrame.unionByName, [
        o.filter(cond).orderBy(*asc_nulls_last(*order)).limit(n).withColumn("sample", F.lit(name))
        for name, cond in kinds.items()])
    rows = tops.collect()  # at most n rows a kind
    if rows:
        ahead = o.agg(*[F.count_if(_before(order, r)) for r in rows]).first()
        rows = [r for r, k in zip(rows, ahead) if k < head]
    return spark.createDataFrame(rows, tops.schema)


@q("sample_rows_by_type")
def sample_rows_by_type(spark, sf):
    """S10 + O5: of the first 200,000 observations in (DATE, ENCOUNTER) order,
    the first three numeric and the first three text rows. Both limits are
    the feature."""
    o = models(spark, sf).source("observations").select(
        "DATE", "ENCOUNTER", "TYPE", "VALUE", "VALUE_NUM", "UNITS")
    return head_sample(o, ["DATE", "ENCOUNTER"], {"numeric": F.col("TYPE") == "numeric",
                                                  "text": F.col("TYPE") != "numeric"}, SAMPLE_HEAD)


SQL["sample_rows_by_type"] = O.with_models(
    "SELECT * FROM (SELECT *, 'numeric' AS sample FROM head WHERE \"TYPE\" = 'numeric' "
    "ORDER BY \"DATE\" NULLS LAST, \"ENCOUNTER\" NULLS LAST LIMIT 3) a UNION ALL "
    "SELECT * FROM (SELECT *, 'text' AS sample FROM head WHERE \"TYPE\" <> 'numeric' "
    "ORDER BY \"DATE\" NULLS LAST, \"ENCOUNTER\" NULLS LAST LIMIT 3) b",
    "head AS (SELECT \"DATE\", \"ENCOUNTER\", \"TYPE\", \"VALUE\", VALUE_NUM, \"UNITS\" "
    f"FROM raw_observations ORDER BY \"DATE\" NULLS LAST, \"ENCOUNTER\" NULLS LAST "
    f"LIMIT {SAMPLE_HEAD})")


STAYS_PER_CHUNK = 5


@q("patient_stay_array")
def patient_stay_array(spark, sf):
    """Each patient's whole history of stays as ordered arrays of row
    objects (start, stop, id), rendered as text."""
    g = ordered_chunks(models(spark, sf).stays, ["patient_id"], "stay_seq",
                       ["admitted_at", "discharged_at", "encounter_id"], STAYS_PER_CHUNK)
    return g.select(
        "patient_id", "chunk", F.size("items").cast("bigint").alias("n_stays"),
        F.array_join(F.transform("items", lambda x: F.concat_ws(
            "|", x["admitted_at"].cast("string"), x["discharged_at"].cast("string"),
            x["encounter_id"])), ";").alias("stays"))


SQL["patient_stay_array"] = O.with_models(
    f"SELECT patient_id, (stay_seq - 1) // {STAYS_PER_CHUNK} AS chunk, count(*) AS n_stays, "
    "string_agg(concat_ws('|', CAST(admitted_at AS VARCHAR), CAST(discharged_at AS VARCHAR), "
    "encounter_id), ';' ORDER BY stay_seq) AS stays FROM stays_numbered GROUP BY ALL")
