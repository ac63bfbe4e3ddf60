"""All registered queries (key -> callable(spark, sf_dir)) and their DuckDB
oracle SQL (key -> statement). Keys without SQL get a rows-only check."""

from __future__ import annotations


def queries() -> dict:
    from .plans import q_checks, q_files, q_models, q_profile
    out: dict = {}
    for mod in (q_models, q_profile, q_checks, q_files):
        out.update(mod.Q)
    return out


def oracle_sql() -> dict:
    from .plans import q_checks, q_files, q_models, q_profile
    out: dict = {}
    for mod in (q_models, q_profile, q_checks, q_files):
        out.update(mod.SQL)
    return out
