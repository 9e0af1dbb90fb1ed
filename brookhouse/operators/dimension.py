"""Keyed dimension tables from routed changes."""

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold_cells(
    events: DataFrame, keys: list[str], columns: list[str], order: Column, overwrite_nulls: bool = False
) -> DataFrame:
    """State of a keyed table after all events: one text column per cell.

    A put writes its non-NULL cells only, so an update to NULL keeps the old value; with `overwrite_nulls` it writes
    the NULL. A delete clears the row. A row exists while it has a cell. One aggregate over the events; each task folds
    its own events per key first, so a key with very many events is no hot spot.
    """
    put = F.coalesce(F.col("type"), F.lit("")) != "delete"
    steps = events.select(*keys, "data", order.alias("_seq"), put.alias("_put"))

    def last_write(name: str) -> Column:
        value = F.col("data")[name]
        written = F.map_contains_key("data", name) if overwrite_nulls else value.isNotNull()
        return F.max(F.when(F.col("_put") & written, F.struct("_seq", value.alias("value")))).alias(f"_cell_{name}")

    folded = steps.groupBy(*keys).agg(
        F.max(F.when(~F.col("_put"), F.col("_seq"))).alias("_deleted"),
        *[last_write(c) for c in columns],
    )

    def alive(name: str) -> Column:
        seq = F.col(f"_cell_{name}")["_seq"]
        return seq.isNotNull() & (F.col("_deleted").isNull() | (seq > F.col("_deleted")))

    cells = [F.when(alive(c), F.col(f"_cell_{c}")["value"]).alias(c) for c in columns]
    return folded.filter(reduce(or_, map(alive, columns))).select(*keys, *cells)


def fold_maps(events: DataFrame, keys: list[str], order: Column) -> DataFrame:
    """The same state for tables whose columns are not known beforehand: `data` has each cell's last value that is not
    NULL, `nulls` the cells that were set to NULL after that. Without `nulls` the rows are those of a table that keeps
    old values, with them on top those of one that overwrites.
    """
    steps = events.select(*keys, "type", "data", order.alias("_seq"))
    gone = F.coalesce(F.col("type"), F.lit("")) == "delete"
    deleted = steps.filter(gone).groupBy(*keys).agg(F.max("_seq").alias("_deleted"))
    written = (
        steps.filter(~gone)
        .select(*keys, "_seq", F.explode("data").alias("_name", "_value"))
        .withColumn("_null", F.col("_value").isNull())
        .groupBy(*keys, "_name", "_null")
        .agg(F.max("_seq").alias("_seq"), F.max_by("_value", "_seq").alias("_value"))
    )
    live = written.join(deleted, keys, "left").filter(
        F.col("_deleted").isNull() | (F.col("_seq") > F.col("_deleted")))
    cells = live.groupBy(*keys, "_name").agg(
        F.max(F.when(~F.col("_null"), F.struct("_seq", "_value"))).alias("_last"),
        F.max(F.when(F.col("_null"), F.col("_seq"))).alias("_nulled"),
    )
    written_last = F.when(F.col("_last").isNotNull(), F.struct("_name", F.col("_last._value").alias("_value")))
    nulled_last = F.when(
        F.col("_nulled").isNotNull() & (F.col("_last").isNull() | (F.col("_nulled") > F.col("_last._seq"))),
        F.struct("_name", F.lit(None).cast("string").alias("_value")))
    return cells.groupBy(*keys).agg(
        F.map_from_entries(F.collect_list(written_last)).alias("data"),
        F.map_from_entries(F.collect_list(nulled_last)).alias("nulls"),
    )
