"""Reading and cleansing the business change log."""

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brookhouse.functions.dates import event_time, proc_time
from brookhouse.functions.jsons import parse_objects
from brookhouse.schemas import CHANGE_LOG

# Markers that frame a full-table replay; fixed values.
REPLAY_MARKERS = ("bootstrap-start", "bootstrap-complete")


def parse_changes(raw: DataFrame, only_tables: tuple[str, ...] = ()) -> DataFrame:
    """Change records of a topic; what is not a JSON object is dropped.

    `only_tables` skips lines that do not mention one of these table names before they are parsed. It is a coarse
    test: the caller still filters on `table`.
    """
    if only_tables:
        raw = raw.filter(reduce(or_, [F.col("value").contains(f'"{t}"') for t in only_tables]))
    return parse_objects(raw, CHANGE_LOG).withColumn("ts", F.col("ts").try_cast("bigint"))


def clean_changes(raw: DataFrame, database: str) -> DataFrame:
    """Records that feed dimension tables: one database, no replay markers, data present.

    A record without a `type` passes.
    """
    return parse_changes(raw).filter(
        (F.col("database") == database)
        & ~F.coalesce(F.col("type"), F.lit("")).isin(*REPLAY_MARKERS)
        & F.col("data").isNotNull()
        & (F.size("data") > 0)
    )


def with_times(changes: DataFrame, delay: str | None = "5 seconds") -> DataFrame:
    """Add event time (watermarked on streams) and processing time."""
    timed = changes.withColumns({"row_time": event_time("ts"), "proc_time": proc_time()})
    return timed.withWatermark("row_time", delay) if delay and timed.isStreaming else timed


def changes_of(changes: DataFrame, database: str, table: str, *types: str) -> DataFrame:
    """Records of one table with one of the given change types."""
    return changes.filter(
        (F.col("database") == database) & (F.col("table") == table) & F.col("type").isin(*types)
    )


def cells(*names: str, source: str = "data", **renamed: str) -> list[Column]:
    """Pick cells of a record by name; a missing cell is NULL. `alias=name` renames."""
    return [F.col(source)[n].alias(n) for n in names] + [F.col(source)[n].alias(a) for a, n in renamed.items()]

