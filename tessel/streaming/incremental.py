"""The incremental parts as streams: changed documents by content, counts by window, upserts by micro-batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def files(spark: SparkSession, folder: str, pattern: str, schema) -> DataFrame:
    """New Parquet files of a folder, as they come."""
    return spark.readStream.schema(schema).option("pathGlobFilter", pattern).option("recursiveFileLookup", True).parquet(folder)


def windowed_counts(events: DataFrame, length: str = "1 day", late: str = "1 hour") -> DataFrame:
    """start, event_type, n and total by window of ts; state older than the watermark is dropped."""
    timed = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    rows = timed.groupBy(F.window("ts", length).alias("w"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))
    return rows.select(F.col("w.start").cast("timestamp_ntz").alias("start"), "event_type", "n", "total")


def first_of_content(docs: DataFrame, late: str = "1 day") -> DataFrame:
    """Documents (url, text, ts) with content that their URL has not had within the watermark."""
    return docs.withColumn("hash", F.sha2("text", 256)).withWatermark("ts", late).dropDuplicatesWithinWatermark(["url", "hash"])


def upserted(current: DataFrame, batch: DataFrame, key: str, content: list[str], order: str) -> DataFrame:
    """current with the batch's last row of each key, where its content differs; changed_at moves only then."""
    last = batch.groupBy(key).agg(F.max_by(F.struct(*content, order), order).alias("new"))
    both = current.select(key, F.struct(*content).alias("old"), "changed_at").join(last, key, "full")
    same = F.col("new").isNull() | (F.col("old").isNotNull() & F.struct(*(F.col(f"old.{c}") for c in content)).eqNullSafe(F.struct(*(F.col(f"new.{c}") for c in content))))
    value = lambda c: F.when(same, F.col(f"old.{c}")).otherwise(F.col(f"new.{c}")).alias(c)
    return both.select(key, *(value(c) for c in content), F.when(same, F.col("changed_at")).otherwise(F.col(f"new.{order}")).alias("changed_at"))


class Upserts:
    """A table kept by foreachBatch: each micro-batch writes the version of its number beside the earlier ones.

    The last complete version is looked for in the folder, so a restart goes on from it; a
    repeated batch starts from the version before its own, so it is harmless.
    """

    def __init__(self, spark: SparkSession, folder: str, key: str, content: list[str], order: str, schema: str):
        self.spark, self.folder, self.key, self.content, self.order, self.schema = spark, folder, key, content, order, schema

    def versions(self) -> list[int]:
        """Numbers of the complete versions, in order."""
        sc = self.spark.sparkContext
        path = sc._jvm.org.apache.hadoop.fs.Path(self.folder)
        files = path.getFileSystem(sc._jsc.hadoopConfiguration())
        names = [s.getPath().getName() for s in files.listStatus(path)] if files.exists(path) else []
        done = lambda n: files.exists(sc._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{n}/_SUCCESS"))
        return sorted(int(n) for n in names if n.isdigit() and done(n))

    @property
    def version(self) -> int | None:
        return max(self.versions(), default=None)

    def table(self, before: int | None = None) -> DataFrame:
        """The last version, or the last one before a number."""
        found = [v for v in self.versions() if before is None or v < before]
        return self.spark.read.parquet(f"{self.folder}/{found[-1]}") if found else self.spark.createDataFrame([], self.schema)

    def __call__(self, batch: DataFrame, number: int) -> None:
        upserted(self.table(before=number), batch, self.key, self.content, self.order).write.mode("overwrite").parquet(f"{self.folder}/{number}")


def run_available(stream: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None]) -> None:
    """All that is there now, then an end."""
    query = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def result(stream: DataFrame, name: str, mode: str = "complete") -> DataFrame:
    """A small aggregated stream's result over all that is there now."""
    query = stream.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    query.awaitTermination()
    return stream.sparkSession.table(name)
