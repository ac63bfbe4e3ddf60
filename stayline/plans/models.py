"""The model DAG as Python calls: raw -> core -> episodes -> features.

``Models`` resolves ``source('raw', t)`` through a callable and ``ref(m)``
through cached properties, so one build reuses each model's DataFrame
(Spark then reuses identical exchanges inside a plan).
"""

from __future__ import annotations

from functools import cached_property, reduce
from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from ..operators import layout
from ..operators.scan import bound_ok
from .. import rules as R
from ..session import materialize
from ..sources.driver import DriverSources
from . import core
from .episodes import (EPISODE_COLUMNS, chemo_points, episode_spans, hospice_and_chemo,
                       hospice_points, inpatient_episodes, numbered_stays)
from .features import (FEATURE_COLUMNS, PATIENT, disorder_rows, episode_features, feature_timeline,
                       history_365d)


class Models:
    def __init__(self, raw: Callable[[str], DataFrame]):
        self._raw = raw
        self.tables: set[str] = set()  # models read from written tables

    @classmethod
    def from_driver(cls, spark: SparkSession, sf_dir: str) -> "Models":
        return cls(DriverSources(spark, sf_dir).raw)

    @classmethod
    def from_paths(cls, spark: SparkSession, root: str) -> "Models":
        """Curated Parquet datasets laid out as ``root/<table>/``."""
        return cls(lambda t: spark.read.parquet(f"{root.rstrip('/')}/{t}"))

    def source(self, table: str) -> DataFrame:
        return self._raw(table)

    @cached_property
    def patients(self) -> DataFrame:
        return core.patients(self._raw("patients"))

    @cached_property
    def encounters(self) -> DataFrame:
        return core.encounters(self._raw("encounters"))

    @cached_property
    def conditions(self) -> DataFrame:
        return core.conditions(self._raw("conditions"))

    @cached_property
    def procedures(self) -> DataFrame:
        return core.procedures(self._raw("procedures"))

    # --- rows per patient, and the layout they allow -----------------------------

    @cached_property
    def rows_per_patient(self) -> dict[str, int]:
        """Largest number of rows one patient brings, by input (encounters,
        chemo, disorders). Every scan below is bounded by a sum of these, so its
        strategy is decided without probing its own intermediate input."""
        return _Bounds(self)

    def _plain(self, bound: int) -> bool:
        return bound_ok(self.encounters.sparkSession, bound)

    @cached_property
    def buckets(self) -> int | None:
        """Parts of the layout by patient; None where a patient is too big for
        one task. Decides for all inputs of the episode model at once, by the
        rows that meet in a part: those of the sweep (see ``hospice_chemo``),
        or of the features' timelines if the disorders were counted before."""
        b = self.rows_per_patient
        b.probe("encounters", "chemo")
        if not self._plain(3 * b["encounters"] + b["chemo"]):
            return None
        rows = 3 * b.rows["encounters"] + b.rows["chemo"]
        if "disorders" in b:
            rows = max(rows, self._timeline_rows)
        return layout.bucket_count(self.encounters.sparkSession, rows)

    @property
    def _timeline_rows(self) -> int:
        """Bound of the rows on the features' timelines: 3 events per disorder
        row + 4 rows per episode."""
        b = self.rows_per_patient
        b.probe("encounters", "disorders")
        return 3 * b.rows["disorders"] + 4 * b.rows["encounters"]

    def _placed(self, df: DataFrame, buckets: int | None) -> DataFrame:
        return layout.placed(df, "patient_id", buckets) if buckets else df

    def _written(self, df: DataFrame, buckets: int | None) -> DataFrame:
        """Written once; in the layout by patient where there is one."""
        return layout.bucketed(df, "patient_id", buckets) if buckets else materialize(df)

    # --- the models ----------------------------------------------------------------

    @cached_property
    def stays(self) -> DataFrame:
        """Inpatient stays with their episode numbering (intermediate)."""
        b = self.rows_per_patient
        return numbered_stays(self.encounters, plain=self._plain(b["encounters"]))

    @cached_property
    def spans(self) -> DataFrame:
        """Episode spans alone, for reports that need no sweep: on the stays'
        own window, or written where the stays are scanned in blocks."""
        s = episode_spans(None, self.stays)
        return s if self._plain(self.rows_per_patient["encounters"]) else materialize(s)

    @cached_property
    def episode_spans(self) -> DataFrame:
        """Written once: both sweep queries and the checks start from it."""
        b, e = self.rows_per_patient, self.encounters
        if self.buckets:
            e = self._placed(e.where(F.col("encounter_class") == R.INPATIENT_CLASS).select(
                "patient_id", "encounter_id", "encounter_class", "start_ts", "stop_ts"), self.buckets)
        return self._written(episode_spans(None, numbered_stays(e, plain=self._plain(b["encounters"]))), self.buckets)

    @cached_property
    def chemo_points(self) -> DataFrame:
        """Written once: counted per patient before they are laid out."""
        return materialize(chemo_points(self.procedures))

    @cached_property
    def hospice_chemo(self) -> DataFrame:
        """Episode spans with the next hospice start after discharge and the
        next chemotherapy start after admission (one timeline sweep). Sweep rows
        per patient <= 2 queries per stay + hospice encounters + chemo."""
        return hospice_and_chemo(self.episode_spans, None, None, plain=bool(self.buckets),
                                 hospice=self._placed(hospice_points(self.encounters), self.buckets),
                                 chemo=self._placed(self.chemo_points, self.buckets))

    @cached_property
    def _episodes(self) -> DataFrame:
        """The episode table and the patient's columns the features need,
        written like a model table: every feature branch reads it."""
        e = inpatient_episodes(self.patients, None, None, hc=self.hospice_chemo, plain=bool(self.buckets))
        return self._written(e, self.buckets)

    @cached_property
    def inpatient_episodes(self) -> DataFrame:
        return self._episodes.select(*EPISODE_COLUMNS)

    @property
    def _feature_episodes(self) -> DataFrame:
        """Episodes with birth_date and gender."""
        if "inpatient_episodes" not in self.tables:
            return self._episodes
        return self.inpatient_episodes.join(self.patients.select("patient_id", *PATIENT), "patient_id")

    @cached_property
    def _feature_buckets(self) -> int | None:
        """Parts of the features' layout by patient: the episode model's, or
        more where they would hold too many timeline rows. Islands: rows per
        (patient, code) <= disorder rows per patient; timeline rows per patient
        <= 3 events per disorder row + 4 rows per episode."""
        b = self.rows_per_patient
        if not self._plain(3 * b["disorders"] + 4 * b["encounters"]):
            return None
        least = layout.bucket_count(self.encounters.sparkSession, self._timeline_rows)
        return max(least, self._episode_buckets or 0)

    @property
    def _episode_buckets(self) -> int | None:
        """Parts the episode table is laid out in; tables written elsewhere have no layout."""
        return None if "inpatient_episodes" in self.tables else self.buckets

    @cached_property
    def disorder_rows(self) -> DataFrame:
        """Written once: counted per patient before they are laid out."""
        return materialize(disorder_rows(self.conditions))

    @cached_property
    def timeline(self) -> DataFrame:
        """J4 + J5 per eligible episode (one sweep)."""
        b = self.rows_per_patient
        # all inputs together, before the episode model decides on its layout
        b.probe("encounters", "disorders", *(["chemo"] if "inpatient_episodes" not in self.tables else []))
        e = self._feature_episodes
        if self._feature_buckets != self._episode_buckets:
            e = self._placed(e, self._feature_buckets)
        eligible = e.filter(F.col("is_eligible_index"))
        return feature_timeline(e, eligible, None, disorders=self._placed(self.disorder_rows, self._feature_buckets),
                                plain_islands=self._plain(b["disorders"]),
                                plain_timeline=self._plain(3 * b["disorders"] + 4 * b["encounters"]))

    @cached_property
    def history(self) -> DataFrame:
        """J4 for every episode: 2 queries + 1 point per episode."""
        return history_365d(self.inpatient_episodes,
                            plain=self._plain(3 * self.rows_per_patient["encounters"]))

    @cached_property
    def episode_features(self) -> DataFrame:
        return episode_features(None, None, None, timeline=self.timeline).select(*FEATURE_COLUMNS)

    def ref(self, name: str) -> DataFrame:
        return getattr(self, name)

    def use_tables(self, paths: dict[str, str]) -> "Models":
        """Read the named models from tables already written (e.g. by
        :func:`layers.materialize_layers`) instead of computing them."""
        spark = self.encounters.sparkSession
        for name, path in paths.items():
            self.__dict__[name] = spark.read.parquet(path)
            self.tables.add(name)
        return self

    def share(self, *names: str) -> "Models":
        """Write the named models once (reliable checkpoint) so that many
        consumers read the table instead of recomputing it."""
        for n in names:
            self.__dict__[n] = materialize(getattr(self, n))
        return self


class _Bounds(dict):
    """rows_per_patient[...] counted on first use: one job with one grouping by
    patient for all inputs asked for together."""

    def __init__(self, m: Models):
        super().__init__()
        self._m, self.rows = m, {}  # rows: all rows of an input

    def _input(self, name: str) -> DataFrame:
        m = self._m
        return {"encounters": lambda: m.encounters, "chemo": lambda: m.chemo_points,
                "disorders": lambda: m.disorder_rows}[name]()

    def probe(self, *names: str) -> None:
        names = [n for n in names if n not in self]
        if not names:
            return
        u = reduce(DataFrame.unionByName, [
            self._input(n).select("patient_id", *[F.lit(int(n == k)).alias(k) for k in names]) for n in names])
        per = u.groupBy("patient_id").agg(*[F.sum(n).alias(n) for n in names])
        r = per.agg(*[F.max(n).alias(n) for n in names], *[F.sum(n).alias(f"all_{n}") for n in names]).first()
        self.update({n: int(r[n] or 0) for n in names})
        self.rows.update({n: int(r[f"all_{n}"] or 0) for n in names})

    def __missing__(self, name: str) -> int:
        self.probe(name)
        return self[name]
