"""Streaming forms of the rolling budget, the queue and the batched upsert."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import partial

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from slotwise.operators import merge


def budget(events: DataFrame, ts: str, by: Sequence[str], window: str = "300 seconds", slide: str = "60 seconds", late: str = "10 minutes") -> DataFrame:
    """Requests in sliding windows; events later than the watermark are dropped."""
    return events.withWatermark(ts, late).groupBy(F.window(ts, window, slide), *by).agg(F.count("*").alias("requests"))


def unseen(events: DataFrame, ts: str, key: Sequence[str], late: str = "10 minutes") -> DataFrame:
    """Each key once: a queue that doesn't queue what it has queued."""
    return events.withWatermark(ts, late).dropDuplicatesWithinWatermark(list(key))


class _Queued(StatefulProcessor):
    """A key's state is when it was last seen; a timer ends it."""

    def __init__(self, names: Sequence[str], keep_ms: int):
        self.names, self.keep_ms = list(names), keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.seen = handle, handle.getValueState("seen", "ms long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        first, last = None, None
        for batch in rows:
            ms = batch.iloc[:, -1]  # Spark may name computed columns anew
            low, high = int(ms.min()), int(ms.max())
            first, last = low if first is None else min(first, low), high if last is None else max(last, high)
        old = self.seen.get()[0] if self.seen.exists() else None
        if old is not None:
            self.handle.deleteTimer(old + self.keep_ms)
        latest = last if old is None else max(last, old)
        self.seen.update((latest,))
        self.handle.registerTimer(latest + self.keep_ms)
        if old is None or first - old > self.keep_ms:  # its timer may not have come up yet
            yield pd.DataFrame({**{n: [v] for n, v in zip(self.names, key, strict=True)}, "queued_ms": [first]})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.seen.clear()
        return iter(())

    def close(self) -> None:
        pass


def queue(events: DataFrame, ts: str, key: Sequence[str], keep: str = "30 days", late: str = "10 minutes") -> DataFrame:
    """key and queued_ms (the milliseconds of the sighting that it came with) of each key that isn't queued yet. A key that hasn't been
    seen for `keep` of event time is forgotten and may be queued again, so the state is of the keys of that time only;
    rows later than the watermark are dropped. The state is in the checkpoint, by the RocksDB store."""
    spark = events.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    keep_ms = int(pd.Timedelta(keep).total_seconds() * 1000)
    rows = events.withWatermark(ts, late).select(*key, ts, F.unix_millis(F.col(ts).cast("timestamp")).alias("_ms"))
    kinds = dict(events.dtypes)
    schema = ", ".join([*(f"`{k}` {kinds[k]}" for k in key), "queued_ms long"])
    return rows.groupBy(*key).transformWithStateInPandas(_Queued(key, keep_ms), schema, "append", "eventTime")


def upserting(events: DataFrame, folder: str, key: Sequence[str], seq: str, checkpoint: str) -> StreamingQuery:
    """Micro-batches upserted into versions of a table: folder/v=<batch>. A batch that runs again writes the same
    version from the same predecessor. For small tables; `upserting_buckets` writes what a batch touches only."""

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        new = merge.last_of_batch(batch, key, seq)
        if number:
            new = merge.upsert(spark.read.schema(batch.schema).parquet(f"{folder}/v={number - 1}"), new, key)
        new.write.mode("overwrite").parquet(f"{folder}/v={number}")

    return events.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def upserting_buckets(events: DataFrame, folder: str, key: Sequence[str], seq: str, checkpoint: str, buckets: int = 64) -> StreamingQuery:
    """Micro-batches upserted into a table of buckets of the key; of a key the row with the greatest seq stays."""
    write = partial(upsert_batch, folder=folder, key=key, seq=seq, buckets=buckets)
    return events.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def upsert_batch(batch: DataFrame, number: int, *, folder: str, key: Sequence[str], seq: str, buckets: int) -> None:
    """One micro-batch: the buckets that it touches are merged aside and then replaced, the others aren't read or written.

    A batch that runs again gives the same table, since the greatest seq of a key wins, whichever way it came."""
    spark, aside = batch.sparkSession, f"{folder}-aside"
    new = batch.withColumn("bucket", F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int"))
    new.write.mode("overwrite").parquet(f"{aside}/new")
    new = spark.read.schema(new.schema).parquet(f"{aside}/new")
    both = new
    if exists(spark, folder):
        touched = [r[0] for r in new.select("bucket").distinct().collect()]  # as many as there are buckets at most
        both = upserted(spark, folder).where(F.col("bucket").isin(touched)).unionByName(new)
    merged = merge.last_of_batch(both, [*key, "bucket"], seq)
    merged.repartition("bucket").write.mode("overwrite").parquet(f"{aside}/merged")
    rows = spark.read.schema(merged.schema).parquet(f"{aside}/merged")
    rows.repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(folder)


def exists(spark: SparkSession, folder: str) -> bool:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def upserted(spark: SparkSession, folder: str) -> DataFrame:
    """The table as it is, with its bucket column."""
    return spark.read.parquet(folder)
