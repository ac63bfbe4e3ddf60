"""Hand-made raw tables for micro cases (tests only)."""

from __future__ import annotations

import datetime as dt


from stayline.plans.models import Models
from stayline.sources.schemas import SCHEMAS, curated_columns


def ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


def d(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


def curated_frame(spark, table: str, rows: list[dict]):
    """A curated-shaped frame: missing columns are NULL."""
    schema = SCHEMAS[table]
    fields = {f.name: f.dataType for f in schema.fields}
    if table == "patients":
        from pyspark.sql.types import StringType
        fields["ZIP3"] = StringType()
    if table == "observations":
        from pyspark.sql.types import DoubleType
        fields["VALUE_NUM"] = DoubleType()
    cols = curated_columns(table)
    data = [tuple(r.get(c) for c in cols) for r in rows]
    from pyspark.sql.types import StructField, StructType
    st = StructType([StructField(c, fields[c], True) for c in cols])
    return spark.createDataFrame(data, st)


def models_from(spark, patients=(), encounters=(), conditions=(), procedures=()) -> Models:
    tables = {
        "patients": curated_frame(spark, "patients", list(patients)),
        "encounters": curated_frame(spark, "encounters", list(encounters)),
        "conditions": curated_frame(spark, "conditions", list(conditions)),
        "procedures": curated_frame(spark, "procedures", list(procedures)),
    }
    return Models(lambda t: tables[t])


def inpatient(eid, pid, start, stop, cls="inpatient"):
    return {"Id": eid, "PATIENT": pid, "START": ts(start), "STOP": ts(stop) if stop else None,
            "ENCOUNTERCLASS": cls, "DESCRIPTION": "Encounter for problem"}


def patient(pid, birth="1950-06-15", death=None, gender="F", zip3="123"):
    return {"Id": pid, "BIRTHDATE": d(birth), "DEATHDATE": d(death) if death else None,
            "GENDER": gender, "ZIP3": zip3}


def by_key(df, key="episode_id"):
    return {r[key]: r.asDict() for r in df.collect()}


