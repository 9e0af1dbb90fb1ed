"""Sinks of the jobs, all called with a micro-batch and its number."""

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from brookhouse.operators.latest import INSERT, keyed_messages
from brookhouse.sources.bus import Bus, keyed_lines
from brookhouse.streaming.keyedlog import KeyedLog, batch_of, commit, complete, number_in, staging


# State of streams is kept off the heap, so it may be larger than the executors' memory.
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def publish(bus: Bus, messages: DataFrame, writer: str, batch_id: int) -> None:
    """Send messages (topic, value and maybe key) to the topics they name; with a key, a NULL value deletes it.

    Files: a batch is written aside and then committed whole, and a repeated batch of a run is skipped, so each record is
    there once per run and none is read before its batch is. The text is compressed, as its field names repeat. Kafka: Spark's sink delivers at least once; a consumer that needs exactly once drops
    repeated keys. `bus.producer` is passed on to Kafka's producers.
    """
    if bus.kind == "kafka":
        sent = [c for c in ("topic", "key", "value") if c in messages.columns]
        writer_of = messages.select(*sent).write.format("kafka").option("kafka.bootstrap.servers", bus.location)
        writer_of.options(**bus.producer).save()
        return
    spark, root = messages.sparkSession, f"{bus.location}/{writer}"
    folder = f"{root}/batch_id={number_in(spark, root, batch_id)}"
    if not complete(spark, folder):
        aside = staging(root)
        keyed = "key" in messages.columns
        (keyed_lines(messages) if keyed else messages.select("topic", "value")).write.partitionBy(
            "keyed" if keyed else "topic").text(aside, compression="gzip")
        commit(spark, aside, folder)


def json_messages(rows: DataFrame, topic: str) -> DataFrame:
    """Rows as JSON for an append topic."""
    return rows.select(F.lit(topic).alias("topic"), F.to_json(F.struct("*")).alias("value"))


def upsert_messages(rows: DataFrame, topic: str, keys: list[str]) -> DataFrame:
    """Rows as keyed JSON for a compacted topic."""
    return keyed_messages(rows, keys).withColumn("topic", F.lit(topic))


def upsert_changes(changes: DataFrame, topic: str, keys: list[str]) -> DataFrame:
    """A changelog (`op` +I or -D, and the rows' columns) as keyed JSON for a compacted topic: the new row of each key, or
    no value if it only lost one."""
    fields = [c for c in changes.columns if c != "op"]
    rows = changes.select("op", F.to_json(F.struct(*keys)).alias("key"), F.to_json(F.struct(*fields)).alias("value"))
    last = rows.groupBy("key").agg(F.max(F.when(F.col("op") == INSERT, F.col("value"))).alias("value"))
    return last.withColumn("topic", F.lit(topic))


def upsert_rows(table: KeyedLog, rows: DataFrame, batch_id: int) -> None:
    """Rows into a keyed table; `latest_by_key` over its log gives the current rows."""
    table.append(rows, batch_id)


def append_jdbc(rows: DataFrame, url: str, table: str, properties: dict[str, str] | None = None) -> None:
    """Aggregates into an OLAP table through JDBC."""
    rows.write.format("jdbc").option("url", url).option("dbtable", table).options(**(properties or {})).mode(
        "append").save()


def start(
    rows: DataFrame, name: str, checkpoints: str, trigger: dict, sink: Callable[[DataFrame, int], None]
) -> StreamingQuery:
    """Run a stream into a sink, with its own checkpoint; a restart goes on where the last run ended.

    The sink gets the batch's number with its run, so a checkpoint that is lost or renewed makes new batches of old
    numbers, not repeated ones.
    """
    checkpoint = f"{checkpoints.rstrip('/')}/{name}"
    return (
        rows.writeStream.queryName(name)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .foreachBatch(lambda batch, n: sink(batch, batch_of(batch.sparkSession, checkpoint, n)))
        .start()
    )


def to_console(rows: DataFrame, checkpoint: str, trigger: dict) -> StreamingQuery:
    """Print a stream."""
    return (
        rows.writeStream.format("console").option("truncate", "false").option("checkpointLocation", checkpoint)
        .trigger(**trigger).start()
    )
