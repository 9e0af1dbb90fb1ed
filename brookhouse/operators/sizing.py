"""Keeping small sides small: measured broadcasts and shared scratch tables."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_ROWS = 200_000
MAX_BYTES = 32 * 1024 * 1024
PARTS = 32


def fits(df: DataFrame, max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES) -> bool:
    """Count and weigh the rows now; each task sends two numbers."""
    weight = F.octet_length(F.to_json(F.struct("*")))
    rows, size = df.agg(F.count("*"), F.coalesce(F.sum(weight), F.lit(0))).first()
    return rows <= max_rows and size <= max_bytes


def small_join(rows: DataFrame, side: DataFrame, on: list[str], how: str = "inner", parts: int = PARTS) -> DataFrame:
    """Join with a side that is small as a rule: by broadcast if it fits, else by shuffle.

    The keys of such sides are few (tables, codes), so in the shuffle the rows of each key are dealt to `parts` slots,
    and the side's rows are copied to all of them. With one part, for keys that are many and about equally frequent, nothing is
    copied. What does not fit is not left to the planner, which would weigh the copies by the compressed file that they come
    from, and broadcast them.
    """
    if fits(side):
        return rows.join(F.broadcast(side), on, how)
    if parts == 1:
        return rows.join(side.hint("merge"), on, how)
    hashed = [f.name for f in rows.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    rows = rows.withColumn("_part", F.pmod(F.xxhash64(*hashed), F.lit(parts)).cast("int"))
    copies = side.withColumn("_part", F.explode(F.array(*map(F.lit, range(parts)))))
    return rows.join(copies.hint("merge"), [*on, "_part"], how).drop("_part")


def scratch_dir(spark: SparkSession) -> str:
    """The folder that the cluster names for files all executors reach; a session in one process (tests) may do without."""
    if spark.conf.get("spark.checkpoint.dir", None) is None:
        if spark.sparkContext.master.partition("[")[0] != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="brookhouse-"))
    return spark.conf.get("spark.checkpoint.dir").rstrip("/")


def new_scratch(spark: SparkSession, name: str) -> str:
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str = "table") -> DataFrame:
    """Write the rows once to the shared folder and read them back.

    The plan behind them runs a single time, survives lost executors, and the planner sees the real size, so its
    own broadcast threshold decides how the result is joined.
    """
    path = new_scratch(df.sparkSession, name)
    df.write.parquet(path, compression="zstd")
    return df.sparkSession.read.schema(df.schema).parquet(path)
