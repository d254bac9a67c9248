"""Shared helpers: table access, scratch tables and two-level prefix sums."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: ASCII white space as the contracts define it: space and U+0009..U+000D.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"

_own_scratch: str | None = None


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Table ``name`` of a data folder that Spark can open."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only on a local master, where driver and executors are one process, a
    temporary folder stands in if the session names none, once for each process
    and gone with it; on a cluster that is an error.
    """
    global _own_scratch
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
    if _own_scratch is None:
        folder = tempfile.mkdtemp(prefix="loomwork-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        _own_scratch = f"file://{folder}"
    return _own_scratch


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` to a scratch table and read it back.

    Cuts the lineage with files that survive the loss of any executor, and
    fixes values that a second evaluation could change (row numbers).
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{spark.sparkContext.applicationId}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch_path = path  # for discard()
    return out


#: Rows of an Arrow batch: texts are long, and both ends of the pipe hold a batch.
BATCH_ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of BATCH_ROWS rows for the whole session, if it has more.

    The setting is read when a plan runs, so an operator cannot set it for
    itself; the registered queries and the pipeline call this, operators do not.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def map_arrow(df: DataFrame, function, schema) -> DataFrame:
    """``df.mapInArrow``; batches are bounded by the session's maxBytesPerBatch and maxRecordsPerBatch."""
    return df.mapInArrow(function, schema)


def regrouped(batches: Iterator[pa.RecordBatch], rows: int = 65_536) -> Iterator[pa.RecordBatch]:
    """The same rows in larger batches, for narrow rows."""
    held: list[pa.RecordBatch] = []
    n = 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= rows:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, n = [], 0
    if n:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def discard(df: DataFrame) -> None:
    """Delete a scratch table that no later plan reads."""
    path = getattr(df, "_scratch_path", None)
    if path is None:
        return
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def packed(docs: DataFrame, **columns: Column) -> DataFrame:
    """The rows of ``docs`` as one struct column ``doc``, beside ``columns``.

    Working columns then never clash with those of the table; ``unpacked``
    gives the rows back.
    """
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    return docs.select(whole, *[c.alias(name) for name, c in columns.items()])


def unpacked(df: DataFrame) -> DataFrame:
    return df.select("doc.*")


def prefix_sum(
    df: DataFrame,
    group: list[str],
    bucket: str,
    order: list[Column],
    value: str,
    out: str,
) -> DataFrame:
    """Exclusive running sum of ``value`` in each group, without a hot window.

    Rows are ordered by (bucket, *order). The window inside a bucket holds only
    that bucket's rows; the sums of whole buckets come from a partial
    aggregate. ``df`` is read twice, so it should be a scratch table.
    """
    keys = [*group, bucket]
    totals = df.groupBy(*keys).agg(F.sum(value).alias("_bucket_total"))
    before = Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*keys, F.coalesce(F.sum("_bucket_total").over(before), F.lit(0)).alias("_bucket_start"))
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = df.withColumn("_inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    renamed = offsets.select(*[F.col(k).alias(f"_k_{k}") for k in keys], "_bucket_start")
    match = [local[k].eqNullSafe(renamed[f"_k_{k}"]) for k in keys]
    condition = match[0]
    for part in match[1:]:
        condition = condition & part
    joined = local.join(renamed, condition, "left")
    return joined.withColumn(out, (F.col("_bucket_start") + F.col("_inside")).cast("long")).drop(
        "_bucket_start", "_inside", *[f"_k_{k}" for k in keys]
    )
