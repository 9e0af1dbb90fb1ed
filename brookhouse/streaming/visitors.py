"""New-visitor repair of a stream, with the first visit of each device as state.

`VisitorLog` keeps the state as a keyed table of its own and repairs each micro-batch with joins, so a device with a
large share of the records is spread over tasks. `repair_stream` keeps it in the engine's state store: no table to
read and records may come out of order, but all records of a device pass through one task.
"""

import json
from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from brookhouse.operators.behaviour import first_day, first_visits, repair_from, repaired_flag
from brookhouse.operators.sizing import fits
from brookhouse.streaming.keyedlog import KeyedLog

FIRST_VISIT = T.StructType([
    T.StructField("bucket", T.IntegerType()), T.StructField("mid", T.StringType()), T.StructField("code", T.LongType())])


class VisitorLog:
    """Table of first visits, in folders by a hash of the device. A device is written once, so a batch appends its new
    devices only. Of the table a batch reads the folders that its devices are in; these rows are not shuffled, but met
    where they lie by the batch's devices, unless those are too many to be sent to all tasks.
    """

    def __init__(self, spark: SparkSession, root: str, zone: str | None = None, buckets: int = 16):
        self.zone, self.buckets = zone, buckets
        self.log = KeyedLog(spark, root, FIRST_VISIT, ("bucket",))

    def known(self, visits: DataFrame, batch_id: int) -> DataFrame:
        """Stored first visits of the devices of a batch."""
        met = visits.select("bucket").distinct().collect()  # `buckets` rows at most
        buckets = [r.bucket for r in met]
        stored = self.log.read(before=batch_id, only={"bucket": buckets}).filter(F.col("bucket").isin(buckets))
        stored = stored.select("mid", F.col("code").alias("_known"))
        devices = visits.select("mid")
        return stored.join(F.broadcast(devices) if fits(devices) else devices, "mid", "left_semi")

    @contextmanager
    def repaired(self, log: DataFrame, batch_id: int) -> Iterator[DataFrame]:
        """One repaired batch, after its new devices are remembered; a repeated batch sees the state it saw before.

        The batch and its devices are cached inside the block, as both are used more than once.
        """
        log.persist()
        seen = first_visits(log).withColumn("bucket", F.pmod(F.xxhash64("mid"), F.lit(self.buckets)).cast("int")).persist()
        visits = seen.join(self.known(seen, batch_id), "mid", "left").persist()
        try:
            self.log.append(visits.filter(F.col("_known").isNull() & F.col("code").isNotNull()), batch_id)
            yield repair_from(log, visits.withColumn("code", F.coalesce("_known", "code")), self.zone)
        finally:
            visits.unpersist()
            seen.unpersist()
            log.unpersist()

    def compact(self) -> int | None:
        return self.log.compact(lambda rows: rows.groupBy("bucket", "mid").agg(F.min("code").alias("code")))


def _release_in_time():
    """Group function: hold the records of a bucket of devices until the watermark has passed them, release them in order of
    time, each with the code of its device's first deciding record (-1: none yet). What follows from the code is left to
    the engine.

    The state is those codes by device and the records that wait, as JSON. (An inner function is sent to the workers whole.)
    """
    def step(key, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        codes, waiting = map(json.loads, state.get if state.exists else ("{}", "[]"))
        if not state.hasTimedOut:
            for frame in frames:
                waiting += [list(x) for x in zip(*(frame[c].tolist() for c in ("ts", "is_new", "mid", "record")))]
        passed = state.getCurrentWatermarkMs()
        ready = sorted((x for x in waiting if x[0] <= passed), key=lambda x: (x[0], x[1] or "", x[3]))
        waiting = [x for x in waiting if x[0] > passed]
        for ts, flag, mid, _ in ready:
            if flag in ("0", "1"):
                codes.setdefault(mid, ts * 2 + int(flag))
        state.update((json.dumps(codes), json.dumps(waiting)))
        if waiting:
            state.setTimeoutTimestamp(min(x[0] for x in waiting))
        if ready:
            yield pd.DataFrame({"code": [codes.get(x[2], -1) for x in ready], "record": [x[3] for x in ready]})

    return step


def repair_stream(log: DataFrame, zone: str, delay: str = "5 seconds", buckets: int = 1 << 14) -> DataFrame:
    """Repair with native state and the log's own watermark.

    Records may come out of order by up to `delay`; each waits for the watermark and is then released by an event-time
    timer, in order of time within its device. A record that comes later than that is dropped. One number per device is
    kept for ever. The record crosses to Python as one text, and the first visit's code comes back with it. Needs the RocksDB state store.

    The state is kept by `buckets` of devices, as a call of the function costs far more than a record: a batch calls it once
    per bucket that it meets, and rewrites what is known of the bucket's devices. So many more devices want more buckets;
    their number must stay as the checkpoint has it.
    """
    timed = log.withColumn("_time", F.timestamp_millis("ts")).withWatermark("_time", delay)
    plain = timed.select(
        F.pmod(F.xxhash64("common.mid"), F.lit(buckets)).alias("bucket"), F.col("common.mid").alias("mid"), "ts", F.col("common.is_new").alias("is_new"), F.to_json(F.struct(*log.columns)).alias("record"), "_time")
    released = plain.groupBy("bucket").applyInPandasWithState(
        _release_in_time(), "code bigint, record string", "codes string, held string", "append", GroupStateTimeout.EventTimeTimeout)
    records = released.select("code", F.inline(F.array(F.from_json("record", log.schema))))
    flag = repaired_flag(first_day(F.when(F.col("code") >= 0, F.col("code")), zone), zone)
    return records.withColumn("common", F.col("common").withField("is_new", flag)).select(*log.columns)
