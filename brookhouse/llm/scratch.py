"""Intermediate tables in the folder that all executors share, and names that do not clash."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession) -> str:
    """A new folder below `spark.checkpoint.dir`. A session in one process (tests) may do without that setting and gets one of its own."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if spark.sparkContext.master.partition("[")[0] != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="brookhouse-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root}/{uuid.uuid4().hex}"


def keep(df: DataFrame, compression: str = "snappy") -> DataFrame:
    """Write and read back: cuts the lineage with a table that survives the loss of executors."""
    path = folder(df.sparkSession)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """A checkpoint in the shared folder: as `keep`, and the partitions stay what they are."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder(df.sparkSession))
    return df.checkpoint()


def discard(df: DataFrame) -> None:
    """Remove a table that `keep` made."""
    jvm = df.sparkSession._jvm
    conf = df.sparkSession._jsc.hadoopConfiguration()
    for folder_of in {file.rpartition("/")[0] for file in df.inputFiles()}:
        at = jvm.org.apache.hadoop.fs.Path(folder_of)
        at.getFileSystem(conf).delete(at, True)


def fresh(columns: list[str], name: str) -> str:
    """`name`, or a longer one if a column has it; Spark compares names without case."""
    taken = {column.lower() for column in columns}
    while name.lower() in taken:
        name += "_"
    return name
