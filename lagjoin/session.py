"""Session helpers.

The library never changes session-wide settings behind the caller's back;
``get_spark`` is a convenience for scripts and tests only.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_spark(master: str | None = None, app: str = "lagjoin",
              shuffle_partitions: int | None = None,
              extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or return) a session with the settings the library assumes:
    AQE on (coalescing + skew-join splitting), UTC session zone, UI off."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_LOCAL_DIR: list[str] = []


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and scratch tables: the session's
    ``spark.checkpoint.dir``, else the context's checkpoint folder.  Where
    neither is set, a local master gets a scratch folder of this process; a
    cluster has no folder that all its machines share, so that raises."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise RuntimeError("spark.checkpoint.dir is not set; name a folder that the whole cluster shares")
    if not _LOCAL_DIR:
        _LOCAL_DIR.append(tempfile.mkdtemp(prefix="lagjoin-"))
    return _LOCAL_DIR[0]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/lagjoin-scratch/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table of the shared folder, reread: this cuts its lineage,
    and later passes read it instead of computing it again."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
