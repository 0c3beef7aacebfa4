"""Lineage cuts as parquet tables in the cluster's shared checkpoint folder.

Used where one intermediate feeds several passes (the card-feature build reads the
prepared transactions three times; model steps reuse card rows). Writing the
frame once as compressed, columnar parquet under ``spark.checkpoint.dir`` and
reading it back means later passes scan only the columns they need, no upstream
parse/join is repeated, and a lost executor costs a re-read, not a
recomputation. The folder is read from the session (set by the cluster); only
local tests get a scratch folder. A job that wraps its work in :func:`run_folder`
leaves nothing behind.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from cardlens.session import ensure_checkpoint_dir

_RUN_FOLDER: list[str] = []


@contextmanager
def run_folder(spark: SparkSession) -> Iterator[str]:
    """All tables that :func:`materialize` writes inside the block go to one folder,
    which is deleted when the block ends: nothing may read them afterwards."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/cardlens-run-{uuid.uuid4().hex}"
    _RUN_FOLDER.append(path)
    try:
        yield path
    finally:
        _RUN_FOLDER.pop()
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder's name in the run's folder, or in the checkpoint folder."""
    base = _RUN_FOLDER[-1] if _RUN_FOLDER else ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/cardlens-{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
