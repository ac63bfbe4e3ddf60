"""feature_store.episode_features (M6): one row per eligible episode with
point-in-time features and the all-cause 30-day label."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import rules as R
from ..functions import age_years, concat_null, day_diff, midnight_days_before
from ..operators.intervals import count_covering, island_events
from ..operators.scan import Spec, asc, ordered_scan
from ..operators.sweep import QSET, pick, sweep

FEATURE_COLUMNS = [
    "episode_id", "patient_id", "admitted_at", "discharged_at", "stay_in_episode",
    "readmitted_30d", "gender", "age_at_admission", "length_of_stay_days", "prior_episodes",
    "prior_episodes_365d", "active_disorders_at_discharge",
]

#: columns of an eligible episode that its timeline row carries
PATIENT = ["birth_date", "gender"]
#: they are put together from the 'admit' rows by a hash aggregate, so all have
#: a fixed width; the gender, which has not, is a grouping key on all queries
EPISODE = ["admitted_at", "discharged_at", "stay_in_episode", "readmitted_30d", "birth_date"]


def episode_id() -> Column:
    return concat_null("patient_id", F.lit("-"), "episode_number").alias("episode_id")


def history_365d(episodes: DataFrame, targets: DataFrame | None = None,
                 plain: bool | None = None) -> DataFrame:
    """For each target episode, the patient's episodes (eligible or not)
    admitted strictly earlier and at most 365 calendar days before.

    count(earlier) - count(before midnight of admit day - 365), both read off
    one sweep of the patient's admissions. Returns patient_id,
    episode_number, episode_id, prior_episodes_365d, earlier_episodes.
    """
    targets = episodes if targets is None else targets
    ts_type = episodes.schema["admitted_at"].dataType.simpleString()
    queries = {
        "admit": targets.select("patient_id", "episode_number", F.col("admitted_at").alias("ts")),
        "year": targets.select("patient_id", "episode_number",
                               midnight_days_before("admitted_at", R.HISTORY_WINDOW_DAYS, ts_type).alias("ts")),
    }
    points = {"episode": episodes.select("patient_id", F.col("admitted_at").alias("ts"))}
    hits = sweep(["patient_id"], ["episode_number"], queries, points,
                 [("n_before", "episode", "count_before")], plain=plain)
    g = hits.groupBy("patient_id", "episode_number").agg(
        pick("admit", "n_before").alias("earlier"), pick("year", "n_before").alias("too_old"))
    return g.select("patient_id", "episode_number", episode_id(),
                    (F.coalesce("earlier", F.lit(0)) - F.coalesce("too_old", F.lit(0)))
                    .cast("bigint").alias("prior_episodes_365d"),
                    F.coalesce("earlier", F.lit(0)).cast("bigint").alias("earlier_episodes"))


def active_disorders(targets: DataFrame, conditions: DataFrame) -> DataFrame:
    """Distinct disorder codes active on the discharge date (start <=
    day and stop NULL or >= day). Each patient's intervals are merged per
    code into disjoint islands, so counting covering islands counts codes."""
    dis = conditions.filter((F.col("is_disorder") == True)  # noqa: E712
                            & F.col("condition_code").isNotNull())
    events = island_events(dis, ["patient_id", "condition_code"], "start_date", "stop_date")
    return count_covering(events, "patient_id",
                          targets.select("patient_id", "episode_number", "discharged_at"),
                          F.to_date("discharged_at"), ["episode_number"],
                          "active_disorders_at_discharge")


def disorder_rows(conditions: DataFrame) -> DataFrame:
    """Disorder condition records with a code (the J5 input)."""
    return conditions.filter((F.col("is_disorder") == True)  # noqa: E712
                             & F.col("condition_code").isNotNull()).select(
        "patient_id", "condition_code", "start_date", "stop_date")


def feature_timeline(episodes: DataFrame, eligible: DataFrame,
                     conditions: DataFrame | None, plain_islands: bool | None = None,
                     plain_timeline: bool | None = None,
                     disorders: DataFrame | None = None) -> DataFrame:
    """J4 + J5 in ONE sweep of each patient's timeline.

    Rows on the timeline, ordered by (ts, kind):
      kind 0  disorder island events (+1 first day, -1 day after the end)
      kind 1  'cover' query at midnight of the discharge day
      kind 2  'admit' query at the admission and 'year' query at midnight of
              (admission day - 365)
      kind 3  every episode's admission (eligible or not)
    A running SUM of the event deltas up to a 'cover' query counts the
    disorders active on the discharge day; the number of kind-3 rows before a
    kind-2 query counts earlier admissions. The 'admit' query carries the
    eligible episode's own columns (EPISODE), so nothing is joined back.
    Returns episode_id, patient_id, episode_number, EPISODE, gender,
    prior_episodes_365d, active_disorders_at_discharge.
    """
    ts_type = episodes.schema["admitted_at"].dataType.simpleString()
    dis = disorder_rows(conditions) if disorders is None else disorders
    ev = island_events(dis, ["patient_id", "condition_code"], "start_date", "stop_date",
                       plain=plain_islands)

    def row(df, ts, kind, qset, delta, point, with_id=True):
        return df.select(
            "patient_id", ts.cast(ts_type).alias("ts"), F.lit(kind).alias("kind"),
            F.lit(qset).cast("string").alias(QSET),
            (F.col("episode_number") if with_id else F.lit(None).cast("bigint"))
            .alias("episode_number"),
            F.lit(delta).cast("int").alias("delta") if not isinstance(delta, F.Column)
            else delta.cast("int").alias("delta"),
            F.lit(point).alias("point"),
            *[(F.col(c) if has else F.lit(None).cast(episodes.schema[c].dataType)).alias(c)
              for c, has in [("gender", qset is not None), *[(c, qset == "admit") for c in EPISODE]]])

    # NULL patients never match in the joins this replaces: their events and
    # admissions are left out, so their queries count nothing
    ev = ev.filter(F.col("patient_id").isNotNull())
    episodes = episodes.filter(F.col("patient_id").isNotNull())
    parts = [
        row(ev, F.col("day"), 0, None, F.col("delta"), 0, with_id=False),
        row(eligible, F.to_date("discharged_at"), 1, "cover", 0, 0),
        row(eligible, F.col("admitted_at"), 2, "admit", 0, 0),
        row(eligible, midnight_days_before("admitted_at", R.HISTORY_WINDOW_DAYS, ts_type), 2, "year", 0, 0),
        row(episodes, F.col("admitted_at"), 3, None, 0, 1, with_id=False),
    ]
    u = parts[0]
    for p_ in parts[1:]:
        u = u.unionByName(p_)
    res = ordered_scan(u, ["patient_id"], asc("ts", "kind"),
                       [Spec("run_delta", "sum", "delta", "upto"),
                        Spec("n_before", "sum", "point", "before")], plain=plain_timeline)
    q = res.filter(F.col("kind").isin(1, 2))
    g = q.groupBy("patient_id", "episode_number", "gender").agg(
        *[pick("admit", c).alias(c) for c in EPISODE],
        pick("cover", F.when(F.col("ts").isNotNull(), F.col("run_delta")).otherwise(F.lit(0)))
        .alias("active"),
        pick("admit", "n_before").alias("earlier"), pick("year", "n_before").alias("too_old"))
    return g.select(
        episode_id(), "patient_id", "episode_number", *EPISODE, "gender",
        (F.coalesce("earlier", F.lit(0)) - F.coalesce("too_old", F.lit(0))).cast("bigint")
        .alias("prior_episodes_365d"),
        F.coalesce("active", F.lit(0)).cast("bigint").alias("active_disorders_at_discharge"))


def episode_features(episodes: DataFrame, patients: DataFrame,
                     conditions: DataFrame | None, plain_islands: bool | None = None,
                     plain_timeline: bool | None = None,
                     disorders: DataFrame | None = None,
                     timeline: DataFrame | None = None) -> DataFrame:
    """``timeline``: :func:`feature_timeline` already built."""
    if timeline is None:
        wide = episodes.join(patients.select("patient_id", *PATIENT), "patient_id", "inner")
        eligible = wide.filter(F.col("is_eligible_index") == True)  # noqa: E712
        timeline = feature_timeline(wide, eligible, conditions, plain_islands, plain_timeline, disorders)
    return timeline.select(
        "episode_id", "patient_id", "admitted_at", "discharged_at", "stay_in_episode",
        "readmitted_30d", "gender",
        age_years("birth_date", "admitted_at").alias("age_at_admission"),
        day_diff("admitted_at", "discharged_at").alias("length_of_stay_days"),
        (F.col("episode_number") - 1).alias("prior_episodes"),
        "prior_episodes_365d", "active_disorders_at_discharge",
    )
