"""Incremental loading: file streams, keyed upserts, checkpoint windows."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomwork.core.artifacts import exists, make_folder, remove, replace

#: Files a little older than the watermark are read again; loading must be idempotent.
OVERLAP = timedelta(seconds=5)


def months_later(day: date, months: int) -> date:
    """The same day some months on, or the last day of that month."""
    total = day.year * 12 + day.month - 1 + months
    year, month = divmod(total, 12)
    for d in range(day.day, 27, -1):
        try:
            return date(year, month + 1, d)
        except ValueError:
            continue
    return date(year, month + 1, min(day.day, 28))


def windows(checkpoint: date, months: int, now: date) -> list[tuple[date, date]]:
    """Whole extraction windows from a checkpoint; none whose end lies in the future."""
    out = []
    while (end := months_later(checkpoint, months)) <= now:
        out.append((checkpoint, end))
        checkpoint = end
    return out


def newer_files(files: DataFrame, checkpoint: datetime | None) -> DataFrame:
    """Rows of (path, modified, ...) at or after the checkpoint less the overlap."""
    return files if checkpoint is None else files.where(F.col("modified") >= F.lit(checkpoint - OVERLAP))


def next_checkpoint(files: DataFrame, checkpoint: datetime | None) -> datetime | None:
    """The latest modification seen; files come in no order, so only at the end."""
    last = files.agg(F.max("modified")).first()[0]
    return max((d for d in (last, checkpoint) if d is not None), default=None)


def stream_files(spark: SparkSession, folder: str, schema: T.StructType | str, kind: str = "json", files_per_batch: int | None = None) -> DataFrame:
    """Stream of the files that land in a folder."""
    reader = spark.readStream.schema(schema).format(kind)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(folder)


#: Folders of an upsert's target, by hash of the key.
TARGET_PARTS = 64


def upsert_stream(stream: DataFrame, target: str, keys: list[str], checkpoint: str, order: str, parts: int = TARGET_PARTS) -> None:
    """Merge all that has landed into a Parquet dataset by key, then stop.

    The latest row by ``order`` wins, also over what an earlier batch brought,
    since files come in no order. The target lies in ``parts`` folders by hash
    of the key, and a batch reads and replaces only those that its keys fall
    in. A batch that runs twice, after a crash between the merge and the
    stream's own commit, gives the same dataset; read_target reads it.
    """
    spark = stream.sparkSession
    part = F.pmod(F.xxhash64(*keys), F.lit(parts)).cast("int")

    def merge(batch: DataFrame, number: int) -> None:
        touched = sorted(r[0] for r in batch.select(part.alias("p")).distinct().collect())  # as many as there are folders
        held = [f"{target}/part={p}" for p in touched if exists(spark, f"{target}/part={p}")]
        rows = spark.read.parquet(*held).unionByName(batch) if held else batch
        latest = F.max_by(F.struct(*rows.columns), F.struct(order, F.xxhash64(*rows.columns)))
        staged = f"{target}.batch"
        remove(spark, staged)
        rows.groupBy(*keys).agg(latest.alias("_row")).select("_row.*").withColumn("part", part).write.partitionBy("part").parquet(staged)
        make_folder(spark, target)
        for p in touched:
            replace(spark, f"{staged}/part={p}", f"{target}/part={p}")
        remove(spark, staged)

    stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def read_target(spark: SparkSession, target: str) -> DataFrame:
    """What upsert_stream has merged."""
    return spark.read.parquet(target).drop("part")


def window_counts(stream: DataFrame, time: str, size: str, keys: list[str], late: str) -> DataFrame:
    """Extra: rows by event-time window; what comes later than ``late`` is dropped."""
    return stream.withWatermark(time, late).groupBy(F.window(time, size).alias("w"), *keys).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), *keys, "n")


def resume(inputs: DataFrame, done_path: str, key: str) -> DataFrame:
    """Inputs that the dataset at ``done_path`` lacks; all if there is none."""
    spark = inputs.sparkSession
    if not exists(spark, done_path):
        return inputs
    return inputs.join(spark.read.parquet(done_path).select(key).distinct(), key, "left_anti")


def reset(spark: SparkSession, *paths: str) -> None:
    for p in paths:
        remove(spark, p)
