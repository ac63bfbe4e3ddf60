"""core.inpatient_episodes (M5): stays merged into episodes, exclusions and
the 30-day readmission label.

Plan shape (all per-patient logic is skew-safe, see operators.scan):
stays -> gaps-and-islands numbering -> episode spans (partial aggregate) ->
hospice / chemotherapy EXISTS as one timeline sweep whose query rows carry the
span, so no join back -> death flags (equi-join to patients) -> next episode
-> flags. Where every patient is known to fit one task all of it runs on one
layout by patient (operators.layout): each input is hashed once, and the next
episode is a LEAD. Otherwise scans run in range blocks and the next episode is
an equi-join on (patient, episode_number + 1).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import rules as R
from ..functions import concat_null, day_diff, plus_days_keep_time
from ..operators.intervals import number_islands
from ..operators.sweep import pick, sweep

EPISODE_COLUMNS = [
    "episode_id", "patient_id", "episode_number", "admitted_at", "discharged_at",
    "stay_in_episode", "death_date", "died_in_episode", "death_before_admission",
    "discharged_to_hospice", "is_eligible_index", "next_admission_at",
    "days_to_next_admission", "readmitted_30d", "is_planned_readmission",
    "unplanned_readmitted_30d",
]


def inpatient_stays(encounters: DataFrame) -> DataFrame:
    """Inpatient encounters as stays."""
    return encounters.filter(F.col("encounter_class") == R.INPATIENT_CLASS).select(
        "patient_id", "encounter_id",
        F.col("start_ts").alias("admitted_at"), F.col("stop_ts").alias("discharged_at"))


def numbered_stays(encounters: DataFrame, plain: bool | None = None) -> DataFrame:
    """Stays with prev_max_discharge (W1), new_episode, episode_number
    and stay_seq (position of the stay within the patient)."""
    s = number_islands(inpatient_stays(encounters), "patient_id", "admitted_at",
                       "discharged_at", "encounter_id", plain=plain)
    return s.select("patient_id", "encounter_id", "admitted_at", "discharged_at",
                    F.col("prev_max_end").alias("prev_max_discharge"),
                    F.col("new_island").alias("new_episode"),
                    F.col("island_number").alias("episode_number"),
                    F.col("seq").alias("stay_seq"))


def episode_spans(encounters: DataFrame, stays: DataFrame | None = None) -> DataFrame:
    """One row per (patient, episode_number) with first admission, last
    discharge and number of stays (W5). ``stays``: already numbered stays."""
    stays = numbered_stays(encounters) if stays is None else stays
    return stays.groupBy("patient_id", "episode_number").agg(
        F.min("admitted_at").alias("admitted_at"),
        F.max("discharged_at").alias("discharged_at"),
        F.count(F.lit(1)).alias("stay_in_episode"))


def with_death_flags(spans: DataFrame, patients: DataFrame) -> DataFrame:
    """Death date from the patient; died in episode = admit day <= death
    <= discharge day + 1; death before admission = death < admit day."""
    p = patients.select("patient_id", "death_date", "birth_date", "gender")
    e = spans.join(p, "patient_id", "inner")
    admit_d, dis_d = F.to_date("admitted_at"), F.to_date("discharged_at")
    dd = F.col("death_date")
    return e.select(
        "*",
        (dd.isNotNull() & (dd < admit_d)).alias("death_before_admission"),
        (dd.isNotNull() & (dd >= admit_d)
         & (dd <= F.date_add(dis_d, R.DEATH_AFTER_DISCHARGE_DAYS))).alias("died_in_episode"),
    )


def chemo_points(procedures: DataFrame) -> DataFrame:
    """Start times of chemotherapy procedures per patient."""
    return procedures.filter(F.col("is_chemotherapy") == True).select(  # noqa: E712
        "patient_id", F.col("start_ts").alias("ts"))


SPAN = ["admitted_at", "discharged_at", "stay_in_episode"]


def hospice_points(encounters: DataFrame) -> DataFrame:
    """Start times of hospice encounters per patient."""
    return encounters.filter(F.col("encounter_class") == R.HOSPICE_CLASS).select(
        "patient_id", F.col("start_ts").alias("ts"))


def hospice_and_chemo(episodes: DataFrame, encounters: DataFrame,
                      procedures: DataFrame | None, plain: bool | None = None,
                      chemo: DataFrame | None = None, hospice: DataFrame | None = None) -> DataFrame:
    """J2 + J3 as one sweep: per episode, a hospice encounter starting in
    [discharge, discharge + 1 day] and a chemotherapy procedure starting in
    [admission, discharge]. Returns the episode spans (patient_id,
    episode_number, SPAN) with next_hospice and next_chemo; the spans travel
    with the query rows. ``chemo`` / ``hospice``: point rows already built."""
    def query(ts):
        return episodes.select("patient_id", "episode_number", *SPAN, F.col(ts).alias("ts"))

    points = {
        "hospice": hospice_points(encounters) if hospice is None else hospice,
        "chemo": chemo_points(procedures) if chemo is None else chemo,
    }
    ops = [("next_hospice", "hospice", "next"), ("next_chemo", "chemo", "next")]
    hits = sweep(["patient_id"], ["episode_number", *SPAN],
                 {"admit": query("admitted_at"), "discharge": query("discharged_at")},
                 points, ops, plain=plain)
    return hits.groupBy("patient_id", "episode_number").agg(
        *[pick("admit", c).alias(c) for c in SPAN],
        pick("discharge", "next_hospice").alias("next_hospice"),
        pick("admit", "next_chemo").alias("next_chemo"))


def with_lead(rows: DataFrame, number: str, plain: bool, **columns: str) -> DataFrame:
    """LEAD within the patient, rows being numbered 1..n by ``number``:
    ``columns`` maps a new column to the one taken from the next row. In place
    where every patient is known to fit one task (``plain``); otherwise an
    equi-join on the unique (patient, number + 1), which spreads even the
    busiest patient over all tasks (NULL-safe: NULL patients form one group)."""
    if plain:
        w = Window.partitionBy("patient_id").orderBy(number)
        return rows.withColumns({new: F.lead(old).over(w) for new, old in columns.items()})
    nxt = rows.select(F.col("patient_id").alias("__p"), (F.col(number) - 1).alias("__n"),
                      *[F.col(old).alias(new) for new, old in columns.items()])
    on = rows["patient_id"].eqNullSafe(nxt["__p"]) & (rows[number] == nxt["__n"])
    return rows.join(nxt, on, "left").drop("__p", "__n")


def inpatient_episodes(patients: DataFrame, encounters: DataFrame,
                       procedures: DataFrame | None, stays: DataFrame | None = None,
                       plain: bool | None = None, chemo: DataFrame | None = None,
                       spans: DataFrame | None = None, hc: DataFrame | None = None) -> DataFrame:
    """The episode table (EPISODE_COLUMNS), and the patient's birth_date and
    gender, so that the features need not join the patients again."""
    if hc is None:
        spans = episode_spans(encounters, stays) if spans is None else spans
        hc = hospice_and_chemo(spans, encounters, procedures, plain=plain, chemo=chemo)
    e = with_death_flags(hc, patients)
    e = e.select(
        "patient_id", "episode_number", "admitted_at", "discharged_at", "stay_in_episode",
        "death_date", "died_in_episode", "death_before_admission", "birth_date", "gender",
        F.coalesce(F.col("next_hospice")
                   <= plus_days_keep_time("discharged_at", R.HOSPICE_WINDOW_DAYS), F.lit(False))
        .alias("discharged_to_hospice"),
        F.coalesce(F.col("next_chemo") <= F.col("discharged_at"), F.lit(False))
        .alias("has_chemotherapy"),
    )
    e = with_lead(e, "episode_number", bool(plain), next_admission_at="admitted_at",
                  next_has_chemotherapy="has_chemotherapy")
    gap = day_diff("discharged_at", "next_admission_at")
    within = F.col("next_admission_at").isNotNull() & (gap <= R.READMISSION_WINDOW_DAYS)
    return e.select(
        concat_null("patient_id", F.lit("-"), "episode_number").alias("episode_id"),
        "patient_id", "episode_number", "admitted_at", "discharged_at", "stay_in_episode",
        "death_date", "died_in_episode", "death_before_admission", "discharged_to_hospice",
        (~F.col("died_in_episode") & ~F.col("death_before_admission")
         & ~F.col("discharged_to_hospice")).alias("is_eligible_index"),
        "next_admission_at",
        gap.alias("days_to_next_admission"),
        within.alias("readmitted_30d"),
        (within & (F.col("next_has_chemotherapy") == True)).alias("is_planned_readmission"),  # noqa: E712
        (within & ~F.col("next_has_chemotherapy")).alias("unplanned_readmitted_30d"),
        "birth_date", "gender",
    )
