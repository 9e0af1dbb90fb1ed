"""Dimension tables of the warehouse, kept as one log of routed changes."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brookhouse.operators.dimension import fold_cells, fold_maps
from brookhouse.operators.routing import FIRST
from brookhouse.operators.sizing import small_join
from brookhouse.schemas import STR_MAP
from brookhouse.streaming.keyedlog import KeyedLog, in_order

EVENTS = T.StructType([
    T.StructField("sink_table", T.StringType()),
    T.StructField("generation", T.StringType()),
    T.StructField("bucket", T.IntegerType()),
    T.StructField("row_key", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("offset", T.LongType()),
    T.StructField("data", STR_MAP),
])


def bucket_of(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


class DimensionTables:
    """Folder per table, generation and bucket of row keys; recreating a table starts a generation, dropping it leaves none
    current. Tables must always be opened with the same number of buckets."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = 8):
        self.spark, self.buckets = spark, buckets
        self.log = KeyedLog(spark, root, EVENTS, ("sink_table", "generation", "bucket"))

    def write(self, routed: DataFrame, tables: DataFrame, batch_id: int) -> None:
        """Append routed changes, with their positions on the bus, to the current generation of their tables.

        Changes apply as they come: by batch, then by position. A table known from the preloaded snapshot only is in
        generation 0.
        """
        known = tables.select("sink_table", "generation")
        rows = small_join(routed, known, ["sink_table"], "left").withColumn("generation", F.coalesce("generation", F.lit(FIRST)))
        self.log.append(rows.withColumn("bucket", bucket_of(F.col("row_key"), self.buckets)), batch_id)

    def events(self, sink_table: str, generation: str = FIRST, keys: DataFrame | None = None) -> DataFrame:
        """Changes of a table, from the buckets of the one column of `keys` only, if given."""
        only = {"sink_table": [sink_table], "generation": [generation]}
        if keys is not None:
            of_key = keys.select(F.col(keys.columns[0]).cast("string").alias("k")).filter("k IS NOT NULL")
            only["bucket"] = [r[0] for r in of_key.select(bucket_of(F.col("k"), self.buckets)).distinct().collect()]  # `buckets` rows at most
        return self.log.read(only=only)

    def read(
        self, sink_table: str, columns: list[str], generation: str = FIRST, overwrite_nulls: bool = False, keys: DataFrame | None = None
    ) -> DataFrame:
        """Current rows of a table: `row_key` and the given columns; with `keys` at least the rows of these."""
        return fold_cells(self.events(sink_table, generation, keys), ["row_key"], columns, in_order("source", "offset"),
                          overwrite_nulls)

    def compact(self) -> int | None:
        """Fold every row of the touched buckets into a put of its values and, if cells were set to NULL later, one of those."""
        keys = ["sink_table", "generation", "bucket", "row_key"]

        def fold(rows: DataFrame) -> DataFrame:
            folded = fold_maps(rows, keys, in_order("source", "offset"))
            puts = F.filter(F.array("data", "nulls"), lambda cells: F.size(cells) > 0)
            return folded.select(*keys, F.posexplode(puts).alias("offset", "data")).withColumns(
                {"type": F.lit("insert"), "source": F.lit(""), "offset": F.col("offset").cast("bigint")})

        return self.log.compact(fold)
