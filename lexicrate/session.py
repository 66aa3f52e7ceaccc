"""Spark session helpers.

Cluster settings (executor sizing, shuffle partitions, checkpoint folder) come
from the cluster's own configuration.  The helpers here only fill in values
that are unset, which is what happens in tests and local benchmarks.
"""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# Conservative defaults for a local session; a cluster submit overrides them.
LOCAL_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "lexicrate", memory: str = "16g") -> SparkSession:
    """A local[N] session for tests and benchmarks."""
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", memory))
    for k, v in LOCAL_DEFAULTS.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder.

    The folder set on the SparkContext wins, then ``spark.checkpoint.dir``.  A
    scratch folder is made only for a local master (tests); on a cluster a
    missing setting is an error, because executors share no local folder.
    """
    sc = spark.sparkContext
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not conf_dir:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="lexicrate-ckpt-")
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(conf_dir)
        return conf_dir
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for written intermediate tables."""
    return os.path.join(ensure_checkpoint_dir(spark), name)


@contextlib.contextmanager
def finished_shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Tables made and written inside drop the shuffle files of their plan when the write ends, on all executors.  Without it
    the files stay until the driver happens to collect its garbage, so the disk holds those of all steps so far.
    A setting of the cluster's own wins."""
    given = spark.conf.get(DROP_SHUFFLES, None)
    if given is None:
        spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        if given is None:
            spark.conf.unset(DROP_SHUFFLES)


def store(df: DataFrame, name: str = "table", schema: StructType | None = None) -> DataFrame:
    """Write ``df`` as Parquet to the shared checkpoint folder and return a
    DataFrame that reads it back: lineage is cut, a lost executor costs
    nothing, and later scans prune columns.  The shuffle files of the write are dropped.  The files go when the session's
    JVM ends.  ``schema`` reads columns back as another type with the same storage (ML vectors)."""
    spark = df.sparkSession
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    with finished_shuffles_dropped(spark):
        df.select("*").write.parquet(path)  # a plan keeps the setting it was made with
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop_path)
    out = spark.read.schema(schema or df.schema).parquet(path)
    out._stored_at = hadoop_path
    return out


def discard(stored: DataFrame) -> None:
    """Delete the files of a table that ``store`` returned, when nothing reads it any more."""
    path = stored._stored_at
    path.getFileSystem(stored.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back."""
    return store(df, "materialized")
