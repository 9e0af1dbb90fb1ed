"""Routing tables kept up to date from their feeds: a batch reads only what is new on the feed."""

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brookhouse.operators import routing
from brookhouse.sources.bus import Bus
from brookhouse.streaming.keyedlog import _fs, commit, number_in, read_text, staging, write_text

SEQ = T.StructType([T.StructField("ts_ms", T.LongType()), T.StructField("pos", T.LongType())])
TABLES = T.StructType([
    T.StructField("sink_table", T.StringType()), T.StructField("action", T.StringType()), T.StructField("sink_family", T.StringType()),
    T.StructField("seq", SEQ), T.StructField("emptied", SEQ)])


@dataclass(frozen=True)
class Routes:
    """The last event of each route and table (deletes too), and how many messages of the feed were read for them."""

    last: DataFrame
    tables: DataFrame | None
    route: T.StructType
    read: int

    def live(self) -> DataFrame:
        return routing.live_routes(self.last, self.route)

    def registered(self) -> DataFrame:
        return routing.existing_tables(self.tables)


class RouteTable:
    """`<root>/state/batch_id=<n>` has the last events of routes and tables as of batch n, and the position on the feed that
    they have reached. A batch folds what the feed holds behind that position into the next state; without anything new the
    old one serves. A repeated batch finds its own state, so it routes as it did before.

    `snapshot` gives the relational table, for the first state only.
    """

    def __init__(self, spark: SparkSession, root: str, bus: Bus, topic: str, route: T.StructType, key: list[str], snapshot=None):
        self.spark, self.root, self.bus, self.topic, self.route, self.key, self.snapshot = spark, root.rstrip("/"), bus, topic, route, key, snapshot
        self.registers = "sink_family" in route.fieldNames()
        self.events = T.StructType([*route.fields, T.StructField("op", T.StringType()), T.StructField("seq", SEQ), T.StructField("_rank", T.IntegerType())])

    def _states(self) -> list[int]:
        fs, p = _fs(self.spark, f"{self.root}/state")
        return sorted(int(s.getPath().getName().split("=", 1)[1]) for s in fs.listStatus(p)) if fs.exists(p) else []

    def _folder(self, number: int) -> str:
        return f"{self.root}/state/batch_id={number}"

    def _load(self, number: int, read: int | None = None) -> Routes:
        folder = self._folder(number)
        known = json.loads(read_text(self.spark, f"{folder}/position.json"))["read"] if read is None else read
        tables = self.spark.read.schema(TABLES).parquet(f"{folder}/tables") if self.registers else None
        return Routes(self.spark.read.schema(self.events).parquet(f"{folder}/routes"), tables, self.route, known)

    def _next(self, before: int | None) -> tuple[Routes | None, dict]:
        """The state after `before` (None: from the start) and its position; no state if the feed has nothing new."""
        position = json.loads(read_text(self.spark, f"{self._folder(before)}/position.json"))["position"] if before is not None else None
        messages, reached = self.bus.read_since(self.spark, self.topic, position)
        if messages is None and before is not None:
            return None, reached
        if messages is None:
            messages = self.spark.createDataFrame([], "value string")
        feed = routing.decode_feed(messages, self.route)
        events = routing.route_events(feed, self.route, self.key)
        tables = routing.table_events(routing.registry_actions(feed)) if self.registers else None
        if before is not None:
            old = self._load(before)
            events = events.unionByName(old.last)
            tables = tables.unionByName(old.tables) if self.registers else None
        elif self.snapshot is not None:
            events = events.unionByName(routing.snapshot_events(self.snapshot(), self.route))
        last = routing.last_events(events, self.key).select(*self.events.fieldNames())
        tables = routing.last_tables(tables).select(*TABLES.fieldNames()) if self.registers else None
        return Routes(last, tables, self.route, messages.count()), reached

    def advance(self, batch_id: int) -> Routes:
        """The routes for a batch, after everything that the feed holds now is folded in."""
        number = number_in(self.spark, self.root, batch_id)
        states = self._states()
        if number in states:
            return self._load(number)
        before = max((n for n in states if n < number), default=None)
        after, reached = self._next(before)
        if after is None:
            return self._load(before, 0)
        aside = staging(self.root)
        after.last.coalesce(1).write.parquet(f"{aside}/routes")  # a row per route
        if self.registers:
            after.tables.coalesce(1).write.parquet(f"{aside}/tables")
        write_text(self.spark, f"{aside}/position.json", json.dumps({"position": reached, "read": after.read}))
        commit(self.spark, aside, self._folder(number))
        for old in states[:-2]:  # readers of the last ones go on
            fs, p = _fs(self.spark, self._folder(old))
            fs.delete(p, True)
        return self._load(number)

    def current(self) -> Routes:
        """The routes as the feed has them now, for a reader: nothing is written."""
        states = self._states()
        after, _ = self._next(states[-1] if states else None)
        return self._load(states[-1]) if after is None else after


def table_now(routes: Routes, sink_table: str) -> tuple[str, bool]:
    """Generation of a dimension table and whether it is dropped; a table without any action is in the first one."""
    known = routes.tables.filter(F.col("sink_table") == sink_table)
    row = routing.existing_tables(known).first()
    return (row["generation"], False) if row else (routing.FIRST, not known.isEmpty())
