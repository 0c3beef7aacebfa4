"""Parquet sources: single tables and the named three-table source set."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

# default file names of the three sources inside a raw-data folder
RAW_SOURCE_FILES = {
    "business_cards": "business_cards.parquet",
    "consumer_cards": "consumer_cards.parquet",
    "merchants_reference": "merchants_reference.parquet",
}

def load_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Lazy parquet scan (filters and projections reach the reader)."""
    return spark.read.parquet(path)


def validate_sources(spark: SparkSession, paths: dict[str, str]) -> dict[str, DataFrame]:
    """Open every source; fail once, listing all that are missing."""
    frames, missing = {}, []
    for name, path in paths.items():
        try:
            frames[name] = load_parquet(spark, path)
        except AnalysisException as exc:
            if "PATH_NOT_FOUND" in str(exc) or "Path does not exist" in str(exc):
                missing.append(path.rstrip("/").split("/")[-1])
            else:
                raise
    if missing:
        raise FileNotFoundError(f"not found in the source set: {', '.join(sorted(missing))}")
    return frames


def load_raw_data(
    spark: SparkSession, raw_dir: str | None = None, paths: dict[str, str] | None = None
) -> dict[str, DataFrame]:
    """The three raw sources as lazy DataFrames (paths are parameters)."""
    if paths is None:
        if raw_dir is None:
            raise ValueError("give raw_dir or paths")
        paths = {k: f"{raw_dir.rstrip('/')}/{v}" for k, v in RAW_SOURCE_FILES.items()}
    return validate_sources(spark, paths)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a scale-factor folder (``{sf_dir}/{name}.parquet``)."""
    return load_parquet(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")
