"""Micro-batches: deliveries into the store, duplicates across batches, first and last sighting, replaced children, maintenance."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from almoneda.operators.delivery import DeliveryStore
from almoneda.plans.runtime import Files, fresh_path

Sink = Callable[[DataFrame, int], None]


def stream_file(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table of a folder as a stream. Which files were read is remembered by the checkpoint given to what runs the stream."""
    at = f"{folder}/{name}.parquet"
    files = Files(spark, folder)
    reader = spark.readStream.schema(spark.read.parquet(at).schema)
    if files.fs.getFileStatus(files.path(at)).isDirectory():
        return reader.option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").parquet(at)
    return reader.option("pathGlobFilter", f"{name}.parquet").parquet(folder)


def run_available(stream: DataFrame, sink: Sink, checkpoint: str) -> None:
    """Takes in what has come since the last run with this checkpoint, and stops; ``sink`` gets each batch and its number and must stand a
    repeated batch, as after a crash the batch under way comes again under its number."""
    stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def deliver(stream: DataFrame, store: DeliveryStore, checkpoint: str, after: Callable[[], None] | None = None) -> None:
    """Every new batch through the store, then ``after`` (what is derived from it). A batch that comes again changes nothing, as its rows are
    the ones kept."""
    run_available(stream, lambda batch, _: store.apply(batch), checkpoint)
    store.vacuum()
    if after is not None:
        after()


def maintenance(steps: list[tuple[str, Callable[[], object]]]) -> dict[str, str]:
    """What follows a load, in the order given: each step's name with 'ok' or its error. A failed step doesn't stop those after it."""
    out = {}
    for name, step in steps:
        try:
            step()
            out[name] = "ok"
        except Exception as e:  # noqa: BLE001
            out[name] = f"{type(e).__name__}: {str(e)[:200]}"
    return out


def sightings(stream: DataFrame, key: str, when: str) -> DataFrame:
    """Streaming state per key: first and last time and number of sightings."""
    return stream.groupBy(key).agg(F.min(when).alias("primera_vez"), F.max(when).alias("ultima_vez"), F.count(F.lit(1)).alias("n"))


class Sightings:
    """First and last sighting per key, kept as versions of a table: a batch is summed up by itself and merged with the last version, so that
    nothing but the batch is held in a stream's state. A batch number that was already merged is left alone."""

    def __init__(self, spark: SparkSession, root: str, key: str, when: str) -> None:
        self.spark, self.root, self.key, self.when, self.files = spark, root.rstrip("/"), key, when, Files(spark, root)

    def version(self) -> int:
        return max((int(n[1:]) for n in self.files.names(self.root) if n.startswith("v") and self.files.exists(f"{self.root}/{n}/_SUCCESS")), default=-1)

    def snapshot(self) -> DataFrame | None:
        v = self.version()
        return None if v < 0 else self.spark.read.parquet(f"{self.root}/v{v}")

    def merge(self, batch: DataFrame, number: int) -> None:
        v = self.version()
        if v >= number:
            return
        seen = batch.groupBy(self.key).agg(F.min(self.when).alias("primera_vez"), F.max(self.when).alias("ultima_vez"), F.count(F.lit(1)).alias("n"))
        if v >= 0:
            both = seen.unionByName(self.spark.read.parquet(f"{self.root}/v{v}"))
            seen = both.groupBy(self.key).agg(F.min("primera_vez").alias("primera_vez"), F.max("ultima_vez").alias("ultima_vez"), F.sum("n").alias("n"))
        seen.write.mode("overwrite").parquet(f"{self.root}/v{number}")
        for old in self.files.names(self.root):
            if old.startswith("v") and int(old[1:]) < v:  # the one before stays for readers
                self.files.delete(f"{self.root}/{old}")


def distinct_stream(stream: DataFrame, keys: list[str]) -> DataFrame:
    """Each key exactly once, across batches, however late a repetition comes: the state holds every key, and no value of it."""
    return stream.dropDuplicates(keys)


def recent_distinct_stream(stream: DataFrame, keys: list[str], when: str, late: str) -> DataFrame:
    """Each key once within ``late``: bounded state, for streams whose repetitions have a proven bound. A later one comes through again."""
    return stream.withColumn(when, F.col(when).cast("timestamp")).withWatermark(when, late).dropDuplicatesWithinWatermark(keys)


def collected(df: DataFrame, mode: str) -> DataFrame:
    """The final result of a streaming query over what is available, as a table."""
    spark, out = df.sparkSession, fresh_path(df.sparkSession, "stream-result")
    if mode == "append":
        df.writeStream.format("parquet").option("path", out).option("checkpointLocation", fresh_path(spark, "stream-checkpoint")).outputMode("append").trigger(availableNow=True).start().awaitTermination()
    else:
        q = df.writeStream.outputMode("complete").option("checkpointLocation", fresh_path(spark, "stream-checkpoint")).foreachBatch(lambda b, _: b.write.mode("overwrite").parquet(out)).trigger(availableNow=True)
        q.start().awaitTermination()
    return spark.read.parquet(out)
