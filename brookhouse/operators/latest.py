"""What a keyed topic holds: the last row per key."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brookhouse.operators.packing import packable, packed, unpacked


def latest_by_key(rows: DataFrame, keys: list[str], order: Column, deleted: Column | None = None) -> DataFrame:
    """Last row per key by `order`; keys whose last row is a delete disappear.

    An aggregate, so each task reduces its rows to one per key before the shuffle, however often a key occurs.
    """
    mark = F.coalesce(deleted, F.lit(False)) if deleted is not None else F.lit(False)
    packed = F.struct(F.struct(*rows.columns).alias("row"), mark.alias("gone"))
    last = rows.groupBy(*keys).agg(F.max_by(packed, order).alias("_last"))
    return last.filter(~F.col("_last.gone")).select("_last.row.*")


def compacted(messages: DataFrame) -> DataFrame:
    """What a compacted topic holds: of messages (key, value, source, offset) the last of each key, unless it deletes it."""
    return latest_by_key(messages, ["key"], F.struct("source", "offset"), F.col("value").isNull()).select("key", "value")


# Kinds of change in the column `op` of a changelog.
INSERT, DELETE = "+I", "-D"


def fold_changes(changes: DataFrame) -> DataFrame:
    """The rows that a changelog leaves: each as often as it was inserted more than deleted, in whatever order."""
    fields = [c for c in changes.columns if c != "op"]
    carried = packable(changes, fields)
    rows = packed(changes, carried)
    n = F.sum(F.when(F.col("op") == INSERT, 1).otherwise(-1)).alias("_n")
    left = rows.groupBy(*[c for c in rows.columns if c != "op"]).agg(n).filter("_n > 0")
    left = left.withColumn("_each", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_n"))))
    return unpacked(left, [changes.schema[c] for c in carried]).select(*fields)


def keyed_messages(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Key and value of each row as JSON, for a compacted topic."""
    return rows.select(
        F.to_json(F.struct(*keys)).alias("key"), F.to_json(F.struct("*")).alias("value")
    )
