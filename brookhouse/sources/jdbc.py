"""Relational tables: routing snapshots and the dictionary."""

from pyspark.sql import DataFrame, SparkSession


def read_table(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str] | None = None,
    split_on: str | None = None,
    bounds: tuple[int, int] | None = None,
    tasks: int = 8,
) -> DataFrame:
    """A table or `(query) alias`. A large table is read by `tasks` ranges of the numeric column `split_on`.

    Column names keep their underscores, and credentials come from `properties`.
    """
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**(properties or {}))
    if split_on is not None:
        low, high = bounds
        reader = (
            reader.option("partitionColumn", split_on).option("lowerBound", low).option("upperBound", high)
            .option("numPartitions", tasks)
        )
    return reader.load()


def read_routes(spark: SparkSession, url: str, table: str, properties: dict[str, str] | None = None) -> DataFrame:
    """Preloaded routing table."""
    return read_table(spark, url, table, properties)


def read_dictionary(spark: SparkSession, url: str, properties: dict[str, str] | None = None) -> DataFrame:
    """Dictionary with dic_code, dic_name, parent_code."""
    return read_table(spark, url, "base_dic", properties).select("dic_code", "dic_name", "parent_code")
