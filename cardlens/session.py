"""SparkSession helpers.

On a cluster the session comes from ``spark-submit`` and its settings are
used untouched. Local tests and the bench call :func:`get_session` with a
master URL, which applies :data:`DEFAULT_CONF`.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job here relies on. AQE re-plans joins at runtime from measured
# shuffle sizes (broadcast only below the threshold, otherwise sort-merge with
# skew splitting) and coalesces small shuffle partitions.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # all timestamps are TIMESTAMP_NTZ; UTC keeps any LTZ step stable
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # the JVM does not compile larger methods; such a stage runs better unfused
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def get_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "cardlens",
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Session for this library.

    Without ``master`` (spark-submit on a cluster) the existing/submitted
    configuration is used as is — size shuffle partitions, AQE advisory size
    and ``spark.checkpoint.dir`` there. With ``master`` (local runs, tests,
    the bench) :data:`DEFAULT_CONF` plus ``extra_conf`` are applied.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
        conf = dict(DEFAULT_CONF)
        if shuffle_partitions:
            conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
        conf.update(extra_conf or {})
        for key, value in conf.items():
            builder = builder.config(key, value)
    spark = builder.getOrCreate()
    if master:
        spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names a shared folder there and it is used as is. Only when the
    setting is absent (local tests, the bench) a scratch folder is created.
    """
    sc = spark.sparkContext
    current = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if current:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(current)
        return sc.getCheckpointDir() or current
    # local and local[...] share one disk; local-cluster[...] has executors of its own
    if spark.sparkContext.master.split("[")[0] != "local":
        raise RuntimeError(
            "spark.checkpoint.dir is not set: name a shared folder (HDFS/S3/...) "
            "for lineage cuts on a cluster"
        )
    path = tempfile.mkdtemp(prefix="cardlens-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def checkpoint_dir(spark: SparkSession) -> str:
    return ensure_checkpoint_dir(spark)
