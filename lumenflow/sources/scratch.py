"""Tables that cut a long lineage, in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``. Where it is unset a local session takes a temporary folder; on a cluster, whose machines don't
    share one, that is an error."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    known = spark.sparkContext._jsc.sc().getCheckpointDir()
    if known.isEmpty():
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-shared-"))
        known = spark.sparkContext._jsc.sc().getCheckpointDir()
    return known.get()


def new_folder(spark: SparkSession) -> str:
    """A path of its own in the shared folder, for the tables of a job."""
    return f"{shared_folder(spark).rstrip('/')}/job-{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """The rows as a table in the shared folder: read again rather than worked out again, also after the loss of an executor."""
    path = f"{shared_folder(df.sparkSession).rstrip('/')}/rows-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def is_whole(spark: SparkSession, path: str) -> bool:
    """Whether a table was written to its end."""
    mark = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return mark.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(mark)


def kept(spark: SparkSession, path: str, make: Callable[[], DataFrame]) -> DataFrame:
    """The table at ``path``, made and written unless a whole one is there: a job that was lost goes on after its last stage."""
    if not is_whole(spark, path):
        make().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
