"""Routing by configuration: which tables go where, with which columns.

The configuration is a table of its own: a snapshot of the relational table, overlaid by its change feed. It is looked
at for every batch, so a change takes effect with the next batch and there is no start-up race.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brookhouse.functions.jsons import parse_objects
from brookhouse.operators.latest import latest_by_key
from brookhouse.operators.sizing import small_join
from brookhouse.schemas import route_feed

FACT_KEY = ["source_table", "source_type"]
DIM_KEY = ["source_table"]
# Generation of a table that was never emptied.
FIRST = "0"


def decode_feed(raw: DataFrame, route: T.StructType) -> DataFrame:
    """Change events of a routing table: the row image that counts, the operation and its position.

    A delete carries the row in `before`, all other operations in `after`. Events without that image are dropped.
    """
    image = F.when(F.col("op") == "d", F.col("before")).otherwise(F.col("after"))
    return (
        parse_objects(raw, route_feed(route))
        .withColumn("image", image)
        .filter(F.col("image").isNotNull())
        .select(
            "image.*", "op", "before",
            F.struct(F.coalesce("ts_ms", F.lit(0)).alias("ts_ms"),
                     F.coalesce("source.pos", F.lit(0)).alias("pos")).alias("seq"),
        )
    )


def route_events(feed: DataFrame, route: T.StructType, key: list[str]) -> DataFrame:
    """What each change does to its key; a change that moves a route to another key also deletes the old one."""
    names = route.fieldNames()
    changes = feed.select(*names, "op", "seq", F.lit(1).alias("_rank"))
    moved = feed.filter(
        (F.col("op") != "d") & F.col("before").isNotNull()
        & (F.struct(*key) != F.struct(*[F.col("before")[k] for k in key]))
    ).select(*[F.col("before")[n].alias(n) for n in names], F.lit("d").alias("op"), "seq", F.lit(0).alias("_rank"))
    return changes.unionByName(moved)


def snapshot_events(snapshot: DataFrame, route: T.StructType) -> DataFrame:
    """Rows of the relational table, as events before all changes."""
    before_all = F.struct(F.lit(-1).cast("bigint").alias("ts_ms"), F.lit(-1).cast("bigint").alias("pos"))
    return snapshot.select(*route.fieldNames()).withColumns({"op": F.lit("r"), "seq": before_all, "_rank": F.lit(1)})


def last_events(events: DataFrame, key: list[str]) -> DataFrame:
    """The last event of each key, deletes too: with later events it folds to what all of them fold to."""
    return latest_by_key(events, key, F.struct("seq", "_rank", "sink_table"))


def live_routes(last: DataFrame, route: T.StructType) -> DataFrame:
    return last.filter(F.col("op") != "d").select(*route.fieldNames())


def current_routes(snapshot: DataFrame | None, feed: DataFrame, route: T.StructType, key: list[str]) -> DataFrame:
    """One route per key: the last change wins, a delete removes the route, the snapshot serves untouched keys."""
    events = route_events(feed, route, key)
    if snapshot is not None:
        events = events.unionByName(snapshot_events(snapshot, route))
    return live_routes(last_events(events, key), route)


def keep_listed(data: Column, columns: Column) -> Column:
    """Cells of `data` whose names are in the comma list; names must match exactly."""
    return keep_named(data, names_in(columns))


def names_in(columns: Column) -> Column:
    """The names of a comma list. Taken of the routes, a list is split once and not for each cell of each record."""
    return F.split(columns, ",")


def keep_named(data: Column, names: Column) -> Column:
    return F.map_filter(data, lambda name, _: F.array_contains(names, name))


def route_facts(changes: DataFrame, routes: DataFrame) -> DataFrame:
    """Pruned cells of every routed change and the table they go to; everything else is dropped."""
    side = routes.select(F.col("source_table").alias("table"), F.col("source_type").alias("type"), "sink_table",
                         names_in(F.col("sink_columns")).alias("_names"))
    return small_join(changes, side, ["table", "type"]).select(
        "sink_table", keep_named(F.col("data"), F.col("_names")).alias("data")
    )


def route_dimensions(changes: DataFrame, routes: DataFrame) -> DataFrame:
    """Pruned cells of every change of a dimension source, with its target table and row key.

    The key is read before pruning, so it need not be among the listed columns. Records without a key are dropped:
    the keyed table cannot hold them.
    """
    side = routes.select(F.col("source_table").alias("table"), "sink_table", names_in(F.col("sink_columns")).alias("_names"),
                         "sink_family", "sink_row_key")
    rest = [c for c in changes.columns if c not in ("database", "table", "old", "commit", "data")]
    return (
        small_join(changes, side, ["table"])
        .withColumn("row_key", F.col("data")[F.col("sink_row_key")])
        .filter(F.col("row_key").isNotNull())
        .select("sink_table", "sink_family", "row_key", *rest,
                keep_named(F.col("data"), F.col("_names")).alias("data"))
    )


def routed_messages(routed: DataFrame) -> DataFrame:
    """Topic and JSON of routed facts; the routing tag is not part of the message.

    NULL cells are left out of the text, as for every other message.
    """
    present = F.map_filter("data", lambda _, v: v.isNotNull())
    return routed.select(F.col("sink_table").alias("topic"), F.to_json(present).alias("value"))


def registry_actions(feed: DataFrame) -> DataFrame:
    """What each configuration change does to its dimension table."""
    action = (
        F.when(F.col("op") == "d", "drop").when(F.col("op").isin("c", "r"), "create").otherwise("recreate")
    )
    return feed.select("sink_table", action.alias("action"), "sink_family", "seq")


def table_events(actions: DataFrame) -> DataFrame:
    """Actions in the shape of `last_tables`."""
    return actions.select("sink_table", "action", "sink_family", "seq", F.when(F.col("action") != "create", F.col("seq")).alias("emptied"))


def last_tables(events: DataFrame) -> DataFrame:
    """The last action on each table and the last that emptied it; folds with later events as `last_events` does."""
    last = events.groupBy("sink_table").agg(
        F.max_by(F.struct("action", "sink_family", "seq"), "seq").alias("last"), F.max("emptied").alias("emptied"))
    return last.select("sink_table", "last.*", "emptied")


def existing_tables(last: DataFrame) -> DataFrame:
    """Tables that exist and the generation they are in."""
    generation = F.when(F.col("emptied").isNotNull(), F.concat_ws("-", "emptied.ts_ms", "emptied.pos")).otherwise(FIRST)
    return last.filter(F.col("action") != "drop").select("sink_table", "sink_family", generation.alias("generation"))


def registered_tables(actions: DataFrame) -> DataFrame:
    """Tables that exist after all actions and the generation they are in.

    Creating a table that exists keeps its rows; recreating it starts a new, empty generation.
    """
    return existing_tables(last_tables(table_events(actions)))
