"""Message bus: Kafka, or a folder tree with the same topics for runs without a broker."""

import json
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brookhouse.functions.dates import event_time
from brookhouse.functions.jsons import parse_objects
from brookhouse.operators.changes import parse_changes, with_times

LINES = T.StructType([T.StructField("value", T.StringType())])


@dataclass(frozen=True)
class Bus:
    """`location`: bootstrap servers (kafka) or a shared root folder (files).

    The folder layout is `<root>/<writer>/batch_id=<n>/topic=<name>/`, one JSON object per line, plain or gzip; messages with a key are
    in `keyed=<name>` beside it, key and value with a tab between them. Streams begin at the earliest record. `options` go to the reader, e.g. a limit per trigger, `producer` to Kafka's writer, e.g. security
    and transaction settings.
    """

    kind: str
    location: str
    options: dict[str, str] = field(default_factory=dict)
    producer: dict[str, str] = field(default_factory=dict)

    def _kafka(self, reader, topic: str, keys: bool = False, **options: str) -> DataFrame:
        value = [F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value")] if keys else [text_of("value")]
        return (
            reader.format("kafka")
            .option("kafka.bootstrap.servers", self.location)
            .option("subscribe", topic)
            .option("startingOffsets", "earliest")
            .options(**self.options, **options)
            .load()
            .select(*value, F.lpad(F.col("partition").cast("string"), 10, "0").alias("source"), "offset")
        )

    def _folders(self, topic: str) -> str:
        return f"{self.location}/*/batch_id=*/{{topic,keyed}}={topic}"

    def _files(self, reader, topic: str, keys: bool = False, folders: list[str] | None = None) -> DataFrame:
        lines = reader.schema(LINES).options(**self.options).text(folders or self._folders(topic))
        file = F.col("_metadata")
        keyed = F.substring_index(file["file_path"], "/", -2).startswith("keyed=")
        value = F.when(keyed, F.nullif(F.expr("substring(value, instr(value, '\t') + 1)"), F.lit(""))).otherwise(F.col("value")).alias("value")
        if keys:
            lines = lines.select(F.when(keyed, F.expr("left(value, instr(value, '\t') - 1)")).alias("key"), value, file)
            value = [F.col("key"), F.col("value")]
        else:
            value = [F.coalesce(value, F.lit("")).alias("value")]
        batch = F.lpad(F.substring_index(F.substring_index(file["file_path"], "/batch_id=", -1), "/", 1), 20, "0")
        begin = F.lpad(file["file_block_start"].cast("string"), 20, "0")
        return lines.select(*value, F.concat_ws("/", batch, file["file_name"], begin).alias("source"))

    def stream(self, spark: SparkSession, topic: str, positions: bool = False) -> DataFrame:
        """Messages; with `positions` also what `positioned` needs."""
        messages = (self._kafka if self.kind == "kafka" else self._files)(spark.readStream, topic)
        return messages if positions else messages.select("value")

    def read(self, spark: SparkSession, topic: str) -> DataFrame:
        return (self._kafka if self.kind == "kafka" else self._files)(spark.read, topic).select("value")

    def read_keyed(self, spark: SparkSession, topic: str) -> DataFrame:
        """Messages with key, value (NULL deletes the key) and place, see `positioned`; messages without a key are left out."""
        messages = (self._kafka if self.kind == "kafka" else self._files)(spark.read, topic, keys=True)
        return positioned(messages).filter(F.col("key").isNotNull())

    def read_since(self, spark: SparkSession, topic: str, position: dict[str, int] | None) -> tuple[DataFrame | None, dict[str, int]]:
        """Messages behind a position (None: all), or None if there are none, and the position behind these.

        A position is the next offset of each partition (Kafka) or the last batch of each writer (folders). Nothing before
        it is read; of folders only the names are listed.
        """
        before = position or {}
        if self.kind == "kafka":
            rows = self._kafka(spark.read, topic, **({"startingOffsets": json.dumps({topic: before})} if before else {}))
            ends = rows.groupBy("source").agg(F.max("offset").alias("offset")).collect()  # a row per partition
            return (rows.select("value") if ends else None), before | {str(int(r.source)): r.offset + 1 for r in ends}
        pattern = spark._jvm.org.apache.hadoop.fs.Path(self._folders(topic))
        found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern) or []
        new, reached = [], dict(before)
        for folder in (status.getPath() for status in found):
            batch = folder.getParent()
            writer, number = batch.getParent().getName(), int(batch.getName().split("=", 1)[1])
            if number > before.get(writer, -1):
                new.append(folder.toString())
                reached[writer] = max(reached.get(writer, -1), number)
        return (self._files(spark.read, topic, folders=new).select("value") if new else None), reached


def keyed_lines(messages: DataFrame) -> DataFrame:
    """(keyed, value): the lines of messages with a key in a folder bus. JSON text has no tab of its own."""
    return messages.select(F.col("topic").alias("keyed"), F.concat("key", F.lit("\t"), F.coalesce("value", F.lit(""))).alias("value"))


def positioned(batch: DataFrame) -> DataFrame:
    """A micro-batch with the place of each message (`source`, `offset`): of two messages that come from one partition or
    one writer of folders, the later one has the larger place. Call it before anything else is done with the batch."""
    return batch if "offset" in batch.columns else batch.withColumn("offset", F.monotonically_increasing_id())


def text_of(value: str) -> Column:
    """Message text; a missing value is the empty text."""
    return F.coalesce(F.col(value).cast("string"), F.lit("")).alias("value")


def change_log(raw: DataFrame, only_tables: tuple[str, ...] = (), delay: str | None = "5 seconds") -> DataFrame:
    """Change-log topic as a table with event time, watermark and processing time."""
    return with_times(parse_changes(raw, only_tables), delay)


def json_table(raw: DataFrame, schema: T.StructType) -> DataFrame:
    """Topic of JSON rows as a table."""
    return parse_objects(raw, schema)


def timed_json_table(raw: DataFrame, schema: T.StructType, delay: str | None = "5 seconds") -> DataFrame:
    """Same, with the event time of its `ts` (seconds)."""
    timed = json_table(raw, schema).withColumn("row_time", event_time("ts"))
    return timed.withWatermark("row_time", delay) if delay and timed.isStreaming else timed
