"""Line dedup with levelled sorted runs of line hashes.

Batches come in ascending order of doc_id. A batch's distinct line keys are merge-joined with the runs: a key that is in
a run was held by an earlier document, so all its lines of the batch go; a new key stays in the batch's smallest
document and goes into a run of the batch. A run is a table bucketed and sorted by the 128-bit hash of the key, so only
the batch is shuffled. When a level has `fanout` runs, they are merged into one of the next level, so a store of n
batches has about fanout * log(n) runs. A list of the runs is written after each batch; a batch that fails before that
changes nothing, and a new `LineRuns` on the same folder goes on from the last list.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brookhouse.llm.scratch import folder, keep
from brookhouse.llm.sqlwords import LOWER, UPPER

LEAST_CHARACTERS = 10
HASH = ["h1", "h2"]


def line_keys(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, pos, h1, h2) of the lines whose key is long enough. Rows without doc_id have none.

    A line's key is the line without white space (space, \\t..\\r) at both ends and with A-Z lower-cased. text_hash tells
    rows apart that have the same doc_id.
    """
    lines = docs.where("doc_id is not null").select("doc_id", _text_hash().alias("text_hash"), F.posexplode(_lines()).alias("pos", "line"))
    key = F.translate(F.btrim("line", F.lit("\t\n\x0b\x0c\r ")), UPPER, LOWER)
    return lines.select("doc_id", "text_hash", "pos", key.alias("key")).where(F.char_length("key") >= LEAST_CHARACTERS).select(
        "doc_id", "text_hash", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"))


def _lines():
    return F.split(F.coalesce(F.col("text"), F.lit("")), "\n", -1)


def _text_hash():
    return F.xxhash64(F.coalesce(F.col("text"), F.lit("")))


class LineRuns:
    def __init__(self, spark: SparkSession, path: str, fanout: int = 2, buckets: int | None = None):
        self.spark, self.path, self.fanout = spark, path, fanout
        self.runs: list[dict] = []
        self.batches = 0
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        root = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/lists")
        files = root.getFileSystem(spark._jsc.hadoopConfiguration())
        if files.exists(root):
            done = [status.getPath().getName() for status in files.listStatus(root) if files.exists(spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS"))]
            if done:
                state = json.loads(spark.read.text(f"{path}/lists/{max(done, key=int)}").first().value)
                self.runs, self.batches, self.buckets = state["runs"], state["batches"], state["buckets"]

    def add(self, batch: DataFrame) -> DataFrame:
        """(doc_id, text_hash, pos) of the batch's lines to drop. All doc_ids must be above those of earlier batches."""
        lines = line_keys(batch)
        held = lines.groupBy(*HASH).agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).withColumn("seen", F.lit(False))
        for run in self.runs:
            known = self._table(run).select(*HASH, F.lit(True).alias("known"))
            held = held.join(known, HASH, "left").withColumn("seen", F.col("seen") | F.col("known").isNotNull()).drop("known")
        held = keep(held)
        repeated = held.where("seen or first < last").select(*HASH, F.when(~F.col("seen"), F.col("first")).alias("stays"))
        dropped = keep(lines.join(repeated, HASH).where("stays is null or doc_id > stays").select("doc_id", "text_hash", "pos"))
        self.runs = [*self.runs, self._write(held.where("not seen").select(*HASH), 0)]
        self._compact()
        self.batches += 1
        self.spark.createDataFrame([(json.dumps({"runs": self.runs, "batches": self.batches, "buckets": self.buckets}),)], "value string").coalesce(1).write.text(
            f"{self.path}/lists/{self.batches}")
        return dropped

    def _compact(self) -> None:
        level = 0
        while len(own := [run for run in self.runs if run["level"] == level]) >= self.fanout:
            merged = self._table(own[0])
            for run in own[1:]:
                merged = merged.unionByName(self._table(run))
            self.runs = [run for run in self.runs if run["level"] != level] + [self._write(merged, level + 1)]
            level += 1

    def _table(self, run: dict) -> DataFrame:
        """The run, registered in this session as bucketed."""
        name = f"line_run_{run['name']}"
        if not self.spark.catalog.tableExists(name):
            self.spark.sql(f"CREATE TABLE {name} (h1 BIGINT, h2 BIGINT) USING parquet CLUSTERED BY (h1, h2) SORTED BY (h1, h2) "
                           f"INTO {self.buckets} BUCKETS LOCATION '{self.path}/runs/{run['name']}'")
        return self.spark.table(name)

    def _write(self, hashes: DataFrame, level: int) -> dict:
        run = {"name": uuid.uuid4().hex, "level": level}
        self._table(run)
        hashes.repartition(self.buckets, *HASH).sortWithinPartitions(*HASH).select(*HASH).write.insertInto(f"line_run_{run['name']}")
        return run


def without_lines(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept) for each row of docs; a NULL text is one empty line."""
    gone = dropped.groupBy("doc_id", "text_hash").agg(F.collect_set("pos").alias("gone"))
    rows = docs.select("doc_id", "text", _text_hash().alias("text_hash")).join(gone, ["doc_id", "text_hash"], "left")
    rows = rows.select("doc_id", _lines().alias("lines"), F.coalesce("gone", F.array().cast("array<int>")).alias("gone"))
    left = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone"))
    kept = F.when(F.size("gone") == 0, F.array_join("lines", "\n")).otherwise(F.array_join(F.transform(left, lambda i: F.element_at("lines", i + 1)), "\n"))
    return rows.select("doc_id", F.size("lines").cast("long").alias("n_lines"), F.size("gone").cast("long").alias("n_dropped"), kept.alias("kept"))


def deduplicate(docs: DataFrame, batches: int = 4, path: str | None = None) -> DataFrame:
    """`without_lines` of docs, added to new runs in `batches` parts of about as many rows each."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    runs = LineRuns(spark, path or folder(spark))
    shares = [k / batches for k in range(1, batches)]
    cuts = sorted({int(x) for x in docs.approxQuantile("doc_id", shares, 0.01)}) if shares else []
    dropped = None
    for low, high in zip([None, *cuts], [*cuts, None], strict=True):
        part = docs
        if low is not None:
            part = part.where(F.col("doc_id") > low)
        if high is not None:
            part = part.where(F.col("doc_id") <= high)
        own = runs.add(part)
        dropped = own if dropped is None else dropped.unionByName(own)
    return without_lines(docs, dropped)


def op2_lines(spark, sf_dir: str) -> DataFrame:
    kept = deduplicate(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.encode("kept", "UTF-8"), 256).alias("kept_sha256"))


OP2_SQL = r"""
WITH lines AS (
  SELECT doc_id, i, list_extract(l, i) AS line FROM (
    SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS i FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents))),
keyed AS (
  SELECT *, translate(trim(line, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines),
repeated AS (SELECT k, min(doc_id) AS first FROM keyed WHERE length(k) >= 10 GROUP BY k HAVING count(DISTINCT doc_id) > 1),
marked AS (SELECT a.*, b.k IS NOT NULL AND a.doc_id <> b.first AS gone FROM keyed a LEFT JOIN repeated b ON a.k = b.k)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
