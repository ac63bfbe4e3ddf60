"""K5: materialise the models as full-refresh tables, one folder per layer.

The target layer of a model comes from the schema-name rule: a model
without a custom schema goes to the default layer; a custom name is
trimmed and upper-cased.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from .models import Models

DEFAULT_LAYER = "CORE"

# --- fixed values: model -> custom schema (None = default layer) -------------
MODEL_SCHEMAS = {
    "patients": None,
    "encounters": None,
    "conditions": None,
    "procedures": None,
    "inpatient_episodes": None,
    "episode_features": "feature_store",
}


def schema_name(custom: str | None, default: str = DEFAULT_LAYER) -> str:
    return default if custom is None else custom.strip().upper()


def materialize_layers(m: Models, root: str) -> dict[str, str]:
    """Write every model (overwrite) to ``root/<LAYER>/<model>``; returns
    model -> path. Each later model is built from the tables already
    written, so a lost executor re-reads files instead of recomputing."""
    paths = {}
    for name, custom in MODEL_SCHEMAS.items():
        path = f"{root.rstrip('/')}/{schema_name(custom)}/{name}"
        df: DataFrame = m.ref(name)
        df.write.mode("overwrite").parquet(path)
        m.use_tables({name: path})
        paths[name] = path
    return paths
