"""Session construction and the shared folder used for checkpoints and scratch output."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(master: str | None = None, app: str = "lathe",
              shuffle_partitions: int | None = None,
              conf: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with AQE on and the UI off.

    On a cluster pass no ``master`` and let the launcher decide; the
    checkpoint folder must then come from ``spark.checkpoint.dir``.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in _DEFAULTS.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (conf or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder.

    Read from the session (``spark.checkpoint.dir`` or an already set
    checkpoint dir). Only a local-mode session without one gets a private
    folder under the temp dir, as in tests; a cluster session without one is
    an error, because a machine-local folder would not survive executor loss.
    """
    sc = spark.sparkContext
    cur = None
    try:
        cur = sc.getCheckpointDir()
    except Exception:  # pragma: no cover - older API
        cur = None
    if not cur:
        cur = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
        if not cur:
            if not _is_local(spark):
                raise RuntimeError("set spark.checkpoint.dir to a shared folder before running lathe jobs")
            cur = tempfile.mkdtemp(prefix="lathe-ckpt-")
        sc.setCheckpointDir(cur)
        cur = sc.getCheckpointDir() or cur
    return cur


def scratch_folder(spark: SparkSession) -> str:
    """The folder of this application's written tables, under the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/lathe-scratch/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in ``scratch_folder``, with the folder's scheme."""
    return f"{scratch_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to a scratch path and read back: it is computed once, a lost executor costs a re-read, and
    the planner knows its size."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear_scratch(spark: SparkSession) -> bool:
    """Remove this application's written tables (call it when no frame read from them is needed any more); true if there
    were any."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(scratch_folder(spark))
    return bool(path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True))
