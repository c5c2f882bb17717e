"""Session helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Records per Arrow batch: bounds, with Spark's own bound of bytes for a batch, what a Python worker holds at once.
#: A batch holds one row at least, so a single text may be as large as a task's memory allows.
ARROW_RECORDS = 1000


def session(df: DataFrame) -> SparkSession:
    """The session of a DataFrame, with Arrow batches of at most ``ARROW_RECORDS``; a smaller setting stays."""
    spark, name = df.sparkSession, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= ARROW_RECORDS:
        spark.conf.set(name, str(ARROW_RECORDS))
    return spark


def quoted(name: str) -> Column:
    """The column of exactly this name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def private(df: DataFrame, *names: str) -> list[str]:
    """The names, made longer until no column of the DataFrame has them."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder for cut lineage: ``spark.checkpoint.dir``. Where that is unset a local session
    takes a temporary folder; on a cluster, whose nodes don't share one, it is an error."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        known = spark.sparkContext._jsc.sc().getCheckpointDir()
        if known.isEmpty():
            if not spark.sparkContext.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
            spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-ckpt-"))
            known = spark.sparkContext._jsc.sc().getCheckpointDir()
        folder = known.get()
    return folder


def store(df: DataFrame) -> DataFrame:
    """Cut the lineage with a compressed table in the shared folder, for larger intermediate results."""
    path = f"{checkpoint_folder(df.sparkSession).rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder of the cluster.

    The folder is ``spark.checkpoint.dir``; only where that is unset (tests, local
    sessions) a temporary folder is taken.
    """
    checkpoint_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def text_key(text: Column) -> Column:
    """Tells apart different texts under one doc_id; equal rows share it."""
    return F.coalesce(F.xxhash64(text), F.lit(0))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions_for(df: DataFrame, least: int = 8) -> int:
    """Shuffle width: the session's setting, which the deployment scales with its input."""
    return max(least, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))
