"""Session helpers: shared scratch folder and local test sessions."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see. A machine-local folder is made only in local
    mode, where the session names none; on a cluster that is an error."""
    sc = spark.sparkContext
    path = spark.conf.get(CHECKPOINT_CONF, None) or sc.getCheckpointDir()
    if not path:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="storecast-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/storecast/{label}-{uuid.uuid4().hex[:12]}"


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch table of ours, on whatever file system holds it."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write a table that several steps read to the shared folder, once, and read
    it back. This also ends its lineage: a lost executor costs a re-read, not a
    recomputation of everything before it."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def local_session(cores: int | str = 8, app: str = "storecast") -> SparkSession:
    """A local session with the settings the tests and the bench use."""
    return (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
