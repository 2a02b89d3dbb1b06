"""Incremental ingestion and event streams as Structured Streaming plans."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmesh.session import cut


def file_stream(spark: SparkSession, folder: str, schema, files_per_trigger: int = 100) -> DataFrame:
    """Parquet files of a folder as a stream; new files are found by the file source's log."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def unseen(files: DataFrame, seen: DataFrame, key: str = "file_id", forced: list[str] | None = None) -> DataFrame:
    """Files whose key is not in the state, or is forced."""
    fresh = files.join(seen.select(key), key, "left_anti")
    return fresh if not forced else fresh.unionByName(files.join(seen.select(key), key, "left_semi").where(F.col(key).isin(forced)))


def once(stream: DataFrame, keys: list[str], time: str | None = None, late: str = "1 hour") -> DataFrame:
    """The first row of each key; with a time column the state is bounded by a watermark."""
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark(keys) if time else stream.dropDuplicates(keys)


def changed(stream: DataFrame, key: str = "file_id", digest: str = "sha") -> DataFrame:
    """A row for each new content of a key."""
    return stream.dropDuplicates([key, digest])


def tumbling(events: DataFrame, time: str, width: str, by: list[str], late: str = "1 hour") -> DataFrame:
    e = events.withWatermark(time, late) if events.isStreaming else events
    return e.groupBy(F.window(time, width), *by).agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("window.start").alias("start"), *by, "n", F.round("total", 4).alias("total"))


def sliding(events: DataFrame, time: str, width: str, step: str, by: list[str], late: str = "1 hour") -> DataFrame:
    e = events.withWatermark(time, late) if events.isStreaming else events
    return e.groupBy(F.window(time, width, step), *by).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), *by, "n")


def sessions(events: DataFrame, time: str, gap: str, by: list[str], late: str = "1 hour") -> DataFrame:
    e = events.withWatermark(time, late) if events.isStreaming else events
    return e.groupBy(F.session_window(time, gap), *by).agg(F.count("*").alias("n")).select(*by, F.col("session_window.start").alias("start"), "n")


def sync(files: DataFrame, state: str, key: str = "file_id", forced: list[str] | None = None, reset: bool = False, dry_run: bool = False) -> DataFrame:
    """The files to process, and, but in a dry run, the state with them added.

    The state is a table of the seen keys at the path `state`, to which each run
    appends; with reset it starts anew. A forced key is processed though it was seen,
    and stands in the state once.
    """
    spark = files.sparkSession
    known = files.select(key).limit(0) if reset else _table(spark, state, files.select(key))
    fresh = cut(unseen(files, known, key, forced))
    if not dry_run:
        new = fresh.select(key).join(known, key, "left_anti").distinct()
        new.write.mode("overwrite" if reset else "append").parquet(state)
    return fresh


def _table(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    there = place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)
    return spark.read.schema(like.schema).parquet(path) if there else like.limit(0)


def altered(files: DataFrame, state: DataFrame, key: str = "path", marks: tuple[str, ...] = ("modified", "size")) -> DataFrame:
    """Files that are new, or whose time or size is not the last that the state has for them: what a watch rebuilds."""
    last = state.groupBy(key).agg(F.max_by(F.struct(*marks), "modified").alias("_last"))
    met = files.join(last, key, "left").where(F.col("_last").isNull() | ~F.struct(*marks).eqNullSafe(F.col("_last")))
    return met.drop("_last")


def watch(spark: SparkSession, folder: str, schema, checkpoint: str, rebuild: Callable[[DataFrame, int], None], every: str | None = None) -> None:
    """Call rebuild with the rows of new files, every so often; without a period, once for all that is there."""
    writer = file_stream(spark, folder, schema).writeStream.foreachBatch(rebuild).option("checkpointLocation", checkpoint)
    query = (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()
    if not every:
        query.awaitTermination()


def drain(stream: DataFrame, target: str, checkpoint: str, mode: str = "append", each: Callable[[DataFrame, int], None] | None = None) -> None:
    """Process all that is there and stop; a restart goes on from the checkpoint."""
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    query = (writer.foreachBatch(each) if each else writer.format("parquet").option("path", target)).start()
    query.awaitTermination()
