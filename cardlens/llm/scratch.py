"""Written tables in the cluster's shared folder: lineage cuts that survive a
lost executor."""

from __future__ import annotations

from pyspark.sql import DataFrame

from cardlens.operators.materialize import materialize


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under ``spark.checkpoint.dir`` and read it back."""
    return materialize(df, f"llm-{name}")
