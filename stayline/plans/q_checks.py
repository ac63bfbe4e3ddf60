"""Registered queries: the data-quality suite (Q1-Q14).

The column tests are declared as data; both the Spark checks and the oracle
SQL are generated from the same declarations, while the check logic itself is
written on each side. The report fuses them by table (``operators.checks``).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import oracle as O
from ..operators import checks, quality
from ..operators.sweep import sweep
from ..session import materialize
from .common import cnt, cnt_if, models, sql_check
from .q_profile import SQL_EXCL, _exclusions

Q: dict = {}
SQL: dict = {}


def q(name):
    def deco(fn):
        Q[name] = fn
        return fn
    return deco


# --- fixed values: the declared column tests ------------------------------------
NOT_NULL = {
    "raw.patients": ["Id"],
    "raw.encounters": ["Id"],
    "patients": ["patient_id", "geo_known"],
    "encounters": ["encounter_id", "patient_id"],
    "inpatient_episodes": ["episode_id", "patient_id", "is_eligible_index", "readmitted_30d",
                           "is_planned_readmission", "unplanned_readmitted_30d"],
    "conditions": ["patient_id", "start_date", "condition_code", "is_disorder"],
    "procedures": ["patient_id", "encounter_id", "procedure_code", "is_chemotherapy"],
    "episode_features": ["episode_id", "patient_id", "gender", "age_at_admission",
                         "length_of_stay_days", "prior_episodes", "readmitted_30d",
                         "prior_episodes_365d", "active_disorders_at_discharge"],
}
UNIQUE = [("raw.patients", "Id"), ("raw.encounters", "Id"), ("patients", "patient_id"),
          ("encounters", "encounter_id"), ("inpatient_episodes", "episode_id"),
          ("episode_features", "episode_id")]
RELATIONSHIPS = [("encounters", "patient_id", "patients", "patient_id"),
                 ("inpatient_episodes", "patient_id", "patients", "patient_id"),
                 ("conditions", "patient_id", "patients", "patient_id"),
                 ("procedures", "patient_id", "patients", "patient_id"),
                 ("procedures", "encounter_id", "encounters", "encounter_id"),
                 ("episode_features", "patient_id", "patients", "patient_id")]


def _resolve(m, name: str) -> DataFrame:
    return m.source(name[4:]) if name.startswith("raw.") else m.ref(name)


def _sql_table(name: str) -> str:
    return "raw_" + name[4:] if name.startswith("raw.") else name


def _sql_col(model: str, c: str) -> str:
    return f'"{c}"' if model.startswith("raw.") else c


# --- Spark side -----------------------------------------------------------------

def not_null_rows(m) -> DataFrame:
    return reduce(DataFrame.unionByName,
                  [quality.not_null_counts(_resolve(m, t), t, cols) for t, cols in NOT_NULL.items()])


def unique_rows(m) -> DataFrame:
    return reduce(DataFrame.unionByName, [
        quality.duplicated_keys(_resolve(m, t), c).agg(cnt().alias("violations"))
        .select(F.lit(t).alias("model"), F.lit(c).alias("column_name"), "violations")
        for t, c in UNIQUE])


def relationship_rows(m) -> DataFrame:
    return reduce(DataFrame.unionByName, [
        quality.orphans(_resolve(m, t), c, _resolve(m, pt), pc).agg(cnt().alias("violations"))
        .select(F.lit(t).alias("model"), F.lit(c).alias("column_name"),
                F.lit(pt).alias("to_model"), "violations")
        for t, c, pt, pc in RELATIONSHIPS])


class _Lazy(dict):
    """Tables by name, resolved when a check asks for them."""

    def __init__(self, m):
        self.m = m

    def __missing__(self, name: str) -> DataFrame:
        self[name] = _resolve(self.m, name)
        return self[name]


def row_rules() -> dict:
    """The singular tests on rows of one table: name -> (table, violation)."""
    r, pl, un = F.col("readmitted_30d"), F.col("is_planned_readmission"), \
        F.col("unplanned_readmitted_30d")
    zip3, geo = F.col("zip3"), F.col("geo_known")
    return {
        "encounters_no_negative_stay": ("encounters", F.col("length_of_stay_hours") < 0),
        "episodes_planned_unplanned_split": ("inpatient_episodes", (r != (pl | un)) | (pl & un)),
        "episodes_readmission_window": (
            "inpatient_episodes", (r == True) & ~F.col("days_to_next_admission").between(1, 30)),  # noqa: E712
        "patients_geo_consistency": (
            "patients", (zip3.isNull() & (geo == True)) | (zip3.isNotNull() & (geo == False))),  # noqa: E712
        "features_365d_within_all_time": (
            "episode_features", F.col("prior_episodes_365d") > F.col("prior_episodes")),
        "features_valid_ranges": (
            "episode_features", (F.col("age_at_admission") < 0) | (F.col("age_at_admission") > 120)
            | (F.col("length_of_stay_days") < 0) | (F.col("prior_episodes") < 0)),
    }


def singular_checks(m) -> dict:
    """The singular tests: name -> builder of its violating rows."""
    rules = {name: lambda t=t, p=p: _resolve(m, t).filter(p) for name, (t, p) in row_rules().items()}
    return {**rules, "features_prior_episodes_match": lambda: prior_mismatches(m)}


def prior_mismatches(m, features: DataFrame | None = None) -> DataFrame:
    """Recount every feature row's earlier episodes (all episodes
    of the patient admitted strictly before it) and keep the mismatches.
    The recount is a timeline sweep, not a self-join, so no pairs are made;
    its query rows carry the count to be checked."""
    f = m.episode_features if features is None else features
    hits = sweep(["patient_id"], ["episode_id", "prior_episodes"],
                 {"f": f.select("patient_id", "episode_id", "prior_episodes", F.col("admitted_at").alias("ts"))},
                 {"e": m.inpatient_episodes.select("patient_id", F.col("admitted_at").alias("ts"))},
                 [("earlier", "e", "count_before")])
    recounted = F.coalesce("earlier", F.lit(0)).cast("bigint")
    return hits.select("episode_id", "prior_episodes", recounted.alias("recounted")) \
        .filter(F.col("recounted") != F.col("prior_episodes"))


#: rows counted and held against an expected number: check -> (table, rows)
def row_counts() -> dict:
    return {"episodes_eligible_count": ("inpatient_episodes", F.col("is_eligible_index")),
            "features_row_count": ("episode_features", F.lit(True))}


def _expected(m, expected: int | None):
    """The expected count as a column. Without an explicit number it is the
    eligible count of the profiling path (deaths by date, hospice EXISTS): one
    number, so a scalar subquery and not a join."""
    if expected is not None:
        return F.lit(expected).cast("bigint")
    return _exclusions(m).agg(cnt_if(~F.col("died_in_episode") & ~F.col("to_hospice"))).scalar()


def row_count_checks(m, expected: int | None = None) -> DataFrame:
    """Q5 + Q11: eligible episodes and feature rows against an expected
    count."""
    actual = reduce(DataFrame.unionByName, [
        checks.tally(_resolve(m, t), [({"check_name": n}, p)]) for n, (t, p) in row_counts().items()])
    r = actual.withColumnRenamed("violations", "actual").withColumn("expected", _expected(m, expected))
    return r.select("check_name", "actual", "expected",
                    F.when(F.col("actual") != F.col("expected"), 1).otherwise(0).cast("bigint")
                    .alias("violations"))


# --- registered keys --------------------------------------------------------------

@q("dq_not_null")
def dq_not_null(spark, sf):
    return not_null_rows(models(spark, sf))


@q("dq_unique")
def dq_unique(spark, sf):
    return unique_rows(models(spark, sf))


@q("dq_relationships")
def dq_relationships(spark, sf):
    return relationship_rows(models(spark, sf))


_SINGULAR_KEYS = {
    "dq_no_negative_stay": "encounters_no_negative_stay",
    "dq_planned_unplanned_split": "episodes_planned_unplanned_split",
    "dq_readmission_window": "episodes_readmission_window",
    "dq_geo_consistency": "patients_geo_consistency",
    "dq_365d_within_all_time": "features_365d_within_all_time",
    "dq_prior_episodes_match": "features_prior_episodes_match",
    "dq_valid_ranges": "features_valid_ranges",
}


def _singular(check_name):
    def run(spark, sf):
        return quality.count_rows(check_name, singular_checks(models(spark, sf))[check_name]())
    run.__name__ = check_name
    return run


for _k, _n in _SINGULAR_KEYS.items():
    Q[_k] = _singular(_n)


@q("dq_row_count")
def dq_row_count(spark, sf):
    return row_count_checks(models(spark, sf))


def _narrow(m, name: str) -> DataFrame:
    """The columns of a core table that checks read, written once where the
    model is not a table already."""
    columns = dict.fromkeys(NOT_NULL[name] + [c for t, c, *_ in RELATIONSHIPS if t == name])
    return _resolve(m, name) if name in m.tables else materialize(_resolve(m, name).select(*columns))


def full_report(m, expected: int | None = None) -> DataFrame:
    """Q14: every check in one report (name, violations, status), fused: one
    aggregate per table for all its row checks and counts, one grouping of keys
    for all uniqueness and referential checks, one sweep for the recount.
    ``expected``: the number of eligible episodes the row-count checks hold
    the model against."""
    frames = _Lazy(m)
    frames.update({t: _narrow(m, t) for t in ("conditions", "procedures")})
    f = m.episode_features
    frames["episode_features"] = f = f if "episode_features" in m.tables else materialize(f)
    by_table: dict[str, list] = {t: [({"check_name": f"not_null_{t}_{c}"}, F.col(c).isNull()) for c in cols]
                                 for t, cols in NOT_NULL.items()}
    for name, (t, p) in {**row_rules(), **row_counts()}.items():
        by_table[t].append(({"check_name": name}, p))
    keys = checks.key_pass(
        frames, unique=[({"check_name": f"unique_{t}_{c}"}, t, c) for t, c in UNIQUE],
        related=[({"check_name": f"relationships_{t}_{c}_{pt}"}, t, c, pt, pc) for t, c, pt, pc in RELATIONSHIPS])
    counted = [checks.tally(frames[t], of) for t, of in by_table.items()]
    rows = reduce(DataFrame.unionByName, [keys, *counted]).withColumn(
        "violations", F.when(F.col("check_name").isin(*row_counts()),
                             (F.col("violations") != _expected(m, expected)).cast("bigint")).otherwise(F.col("violations")))
    return quality.report([rows, quality.count_rows("features_prior_episodes_match", prior_mismatches(m, f))])


@q("dq_report")
def dq_report(spark, sf):
    return full_report(models(spark, sf))


# --- oracle SQL ---------------------------------------------------------------------

def _sql_not_null() -> str:
    return " UNION ALL ".join(
        f"SELECT '{t}' AS model, '{c}' AS column_name, "
        f"CAST(COUNT(*) FILTER (WHERE {_sql_col(t, c)} IS NULL) AS BIGINT) AS violations "
        f"FROM {_sql_table(t)}" for t, cols in NOT_NULL.items() for c in cols)


def _sql_unique() -> str:
    return " UNION ALL ".join(
        f"SELECT '{t}' AS model, '{c}' AS column_name, CAST(COUNT(*) AS BIGINT) AS violations "
        f"FROM (SELECT {_sql_col(t, c)} FROM {_sql_table(t)} WHERE {_sql_col(t, c)} IS NOT NULL "
        f"GROUP BY 1 HAVING COUNT(*) > 1) d" for t, c in UNIQUE)


def _sql_rel() -> str:
    return " UNION ALL ".join(
        f"SELECT '{t}' AS model, '{c}' AS column_name, '{pt}' AS to_model, "
        f"CAST(COUNT(*) AS BIGINT) AS violations FROM {_sql_table(t)} ch "
        f"WHERE ch.{c} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {_sql_table(pt)} pa "
        f"WHERE pa.{pc} = ch.{c})" for t, c, pt, pc in RELATIONSHIPS)


#: rows that break a rule, each said in another way than the checks above
SINGULAR_SQL = {
    "encounters_no_negative_stay":
        "SELECT encounter_id FROM encounters "
        "WHERE date_trunc('minute', stop_ts) < date_trunc('minute', start_ts)",
    "episodes_planned_unplanned_split":  # a readmission is of one kind, no readmission of none
        "SELECT episode_id FROM inpatient_episodes WHERE CAST(readmitted_30d AS INTEGER) <> "
        "CAST(is_planned_readmission AS INTEGER) + CAST(unplanned_readmitted_30d AS INTEGER)",
    "episodes_readmission_window":
        "SELECT episode_id FROM inpatient_episodes WHERE readmitted_30d AND "
        "(days_to_next_admission > 30 OR days_to_next_admission < 1)",
    "patients_geo_consistency":
        "SELECT patient_id FROM patients WHERE geo_known = (zip3 IS NULL)",
    "features_365d_within_all_time":
        "SELECT episode_id FROM episode_features WHERE prior_episodes - prior_episodes_365d < 0",
    "features_prior_episodes_match":
        "SELECT episode_id FROM episode_features f WHERE prior_episodes <> (SELECT count(*) "
        "FROM span s WHERE s.patient_id = f.patient_id AND s.admitted_at < f.admitted_at)",
    "features_valid_ranges":
        "SELECT episode_id FROM episode_features WHERE NOT (age_at_admission BETWEEN 0 AND 120 "
        "AND least(length_of_stay_days, prior_episodes) >= 0)",
}

SQL_ROW_COUNT = (
    "SELECT c.check_name, c.actual, x.expected, CAST(CASE WHEN c.actual <> x.expected THEN 1 "
    "ELSE 0 END AS BIGINT) AS violations FROM ("
    "SELECT 'episodes_eligible_count' AS check_name, CAST(COUNT(*) AS BIGINT) AS actual "
    "FROM inpatient_episodes WHERE is_eligible_index = TRUE UNION ALL "
    "SELECT 'features_row_count', CAST(COUNT(*) AS BIGINT) FROM episode_features) c, "
    "(SELECT CAST(COUNT(*) FILTER (WHERE NOT died_in_episode AND NOT to_hospice) AS BIGINT) "
    "AS expected FROM excl) x")

SQL["dq_not_null"] = O.with_models(_sql_not_null())
SQL["dq_unique"] = O.with_models(_sql_unique())
SQL["dq_relationships"] = O.with_models(_sql_rel())
for _k, _n in _SINGULAR_KEYS.items():
    SQL[_k] = O.with_models(sql_check(_n, SINGULAR_SQL[_n]))
SQL["dq_row_count"] = O.with_models(SQL_ROW_COUNT, SQL_EXCL)
SQL["dq_report"] = O.with_models(
    "SELECT check_name, violations, CASE WHEN violations = 0 THEN 'PASS' ELSE 'FAIL' END AS status "
    "FROM (" + " UNION ALL ".join(
        [f"SELECT 'not_null_' || model || '_' || column_name AS check_name, violations "
         f"FROM ({_sql_not_null()}) a",
         f"SELECT 'unique_' || model || '_' || column_name, violations FROM ({_sql_unique()}) b",
         f"SELECT 'relationships_' || model || '_' || column_name || '_' || to_model, violations "
         f"FROM ({_sql_rel()}) c",
         f"SELECT check_name, violations FROM ({SQL_ROW_COUNT}) d"]
        + [f"SELECT check_name, violations FROM ({sql_check(n, s)}) s{i}"
           for i, (n, s) in enumerate(SINGULAR_SQL.items())]) + ") r", SQL_EXCL)
