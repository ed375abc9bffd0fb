"""Written tables that cut lineage.

Operators that number rows need each row to keep its place when a task is run
again after an executor is lost.  They write their sorted input once, as parquet,
below the folder named by ``spark.checkpoint.dir`` and go on from the files.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

_local_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder that the driver and all executors can reach.

    It is read from the session.  Only a ``local`` session, as in tests, may go
    without the setting; it then gets a temporary folder of its own.
    """
    sc = spark.sparkContext
    named = (
        spark.conf.get("spark.checkpoint.dir", None)
        or sc.getConf().get("spark.checkpoint.dir")
        or sc.getCheckpointDir()
    )
    if named:
        return named.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = sc.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = "file:" + tempfile.mkdtemp(prefix="ionweave-")
    return _local_dirs[app]


def new_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no other call returns."""
    return f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str = "stage", by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` to the shared folder, in folders by the values of ``by``, and return a scan of the written table."""
    spark = df.sparkSession
    path = new_path(spark, label)
    writer = df.write.partitionBy(*by) if by else df.write
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_staged(spark: SparkSession) -> bool:
    """Delete every table this application has staged.  Call it after the last action."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/{spark.sparkContext.applicationId}")
    return root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(root, True)
