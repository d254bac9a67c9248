"""Datasets published with manifests: atomic, resumable, fingerprinted.

All file operations go through Hadoop's file systems, so a dataset may lie
wherever Spark can write. A dataset or file is replaced by two renames: the old
one to ``<path>.old``, the new one in. Whatever fails or stops in between, a
complete one remains, and the next call on that path puts things right. One
writer a path at a time is assumed.
"""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _fs(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def _rename(spark: SparkSession, source: str, target: str) -> bool:
    fs, at = _fs(spark, source)
    return fs.rename(at, _fs(spark, target)[1])


def _is_there(spark: SparkSession, path: str) -> bool:
    fs, target = _fs(spark, path)
    return fs.exists(target)


def recover(spark: SparkSession, path: str) -> None:
    """Finish or undo a replacement that stopped between its steps."""
    old = f"{path}.old"
    if not _is_there(spark, old):
        return
    if _is_there(spark, path):
        remove(spark, old)
    elif not _rename(spark, old, path):
        raise OSError(f"cannot restore {path} from {old}")


def replace(spark: SparkSession, new: str, path: str) -> None:
    """Put the complete dataset or file ``new`` in the place of ``path``.

    If it cannot be put there the old one is put back, ``new`` is kept, and an
    OSError names both.
    """
    recover(spark, path)
    old = f"{path}.old"
    had = _is_there(spark, path)
    if had and not _rename(spark, path, old):
        raise OSError(f"cannot set {path} aside; the new dataset is {new}")
    if not _rename(spark, new, path):
        if had:
            _rename(spark, old, path)
        raise OSError(f"cannot rename to {path}; the new dataset is {new}")
    if had:
        remove(spark, old)


def exists(spark: SparkSession, path: str) -> bool:
    recover(spark, path)
    return _is_there(spark, path)


def remove(spark: SparkSession, path: str) -> None:
    fs, target = _fs(spark, path)
    fs.delete(target, True)


def make_folder(spark: SparkSession, path: str) -> None:
    fs, target = _fs(spark, path)
    fs.mkdirs(target)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """One small file, by a temporary name and a replacement."""
    part = f"{path}.{uuid.uuid4().hex}.tmp"
    fs, target = _fs(spark, part)
    out = fs.create(target, True)
    out.write(bytearray(text.encode()))
    out.close()
    replace(spark, part, path)


def read_text(spark: SparkSession, path: str) -> str:
    recover(spark, path)
    fs, target = _fs(spark, path)
    reader = spark.sparkContext._jvm.java.io.BufferedReader(
        spark.sparkContext._jvm.java.io.InputStreamReader(fs.open(target), spark.sparkContext._jvm.java.nio.charset.StandardCharsets.UTF_8)
    )
    lines = []
    while (line := reader.readLine()) is not None:
        lines.append(line)
    reader.close()
    return "\n".join(lines)


def publish(df: DataFrame, path: str, partition_by: list[str] | None = None, sort_by: list[str] | None = None, compression: str = "zstd", row_group_bytes: int | None = None) -> None:
    """Write beside ``path`` and replace it, so that a failed run leaves the old dataset.

    An unfinished write is removed; a complete one that could not be renamed is kept.
    """
    spark = df.sparkSession
    part = f"{path}.{uuid.uuid4().hex}.tmp"
    rows = df.sortWithinPartitions(*sort_by) if sort_by else df
    writer = rows.write.option("compression", compression)
    if row_group_bytes:
        writer = writer.option("parquet.block.size", str(row_group_bytes))
    try:
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(part)
    except BaseException:
        remove(spark, part)
        raise
    replace(spark, part, path)


def export_chunks(df: DataFrame, path: str, key: str, chunks: int, sort_by: list[str]) -> list[int]:
    """Datasets ``path``/chunk=K by key modulo ``chunks``; those already there are skipped.

    Returns the chunks written. One scan deals the rows of all missing chunks to
    folders; each folder is then put in its place, so a rerun after a failure
    goes on where it ended. A chunk without rows is an empty dataset.
    """
    spark = df.sparkSession
    missing = [k for k in range(chunks) if not exists(spark, f"{path}/chunk={k}/_SUCCESS")]
    if not missing:
        return []
    part = f"{path}.{uuid.uuid4().hex}.tmp"
    dealt = df.withColumn("chunk", F.pmod(F.col(key), F.lit(chunks)).cast("int")).where(F.col("chunk").isin(missing))
    try:
        dealt.repartition("chunk", F.pmod(F.xxhash64(key), F.lit(8))).sortWithinPartitions("chunk", *sort_by).write.option("compression", "zstd").partitionBy("chunk").parquet(part)
        for k in missing:
            if not _is_there(spark, f"{part}/chunk={k}"):
                df.limit(0).write.parquet(f"{part}/chunk={k}")
            fs, mark = _fs(spark, f"{part}/chunk={k}/_SUCCESS")
            fs.create(mark, True).close()
            make_folder(spark, path)
            replace(spark, f"{part}/chunk={k}", f"{path}/chunk={k}")
    finally:
        remove(spark, part)
    return missing


def write_json_array(df: DataFrame, path: str, limit: int = 100_000) -> int:
    """A small result as one JSON array file; an error if it has more than ``limit`` rows."""
    rows = [r[0] for r in df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"})).take(limit + 1)]
    if len(rows) > limit:
        raise ValueError("too many rows for one JSON file")
    write_text(df.sparkSession, path, "[" + ",\n".join(rows) + "]")
    return len(rows)


def fingerprint(df: DataFrame, id_col: str) -> DataFrame:
    """One row (n, id_sum, id_xor) that tells which ids a table holds; null ids count in n alone."""
    return df.agg(
        F.count("*").alias("n"),
        F.coalesce(F.sum(F.col(id_col).cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)")).alias("id_sum"),
        F.coalesce(F.bit_xor(F.col(id_col).cast("long")), F.lit(0).cast("long")).alias("id_xor"),
    )


@dataclass
class Stamp:
    """A fingerprint that combines over disjoint id sets."""

    n: int = 0
    id_sum: int = 0
    id_xor: int = 0

    def __add__(self, other: Stamp) -> Stamp:
        return Stamp(self.n + other.n, self.id_sum + other.id_sum, self.id_xor ^ other.id_xor)

    @classmethod
    def of(cls, df: DataFrame, id_col: str) -> Stamp:
        row = fingerprint(df, id_col).first()
        return cls(row["n"], int(row["id_sum"]), row["id_xor"])


@dataclass
class Manifest:
    """What a side output was computed from; one file beside it for each scope (tier).

    An export also notes its rows, bytes and seconds, and the digest of its inputs.
    """

    stamp: Stamp
    shards: list[int] = field(default_factory=list)
    of: int = 1
    rows: int | None = None
    bytes: int | None = None
    seconds: float | None = None
    inputs: str | None = None

    @staticmethod
    def path(output: str, scope: str = "all") -> str:
        return f"{output}.manifest-{scope}.json"

    def save(self, spark: SparkSession, output: str, scope: str = "all") -> None:
        write_text(spark, self.path(output, scope), json.dumps(asdict(self)))

    @classmethod
    def load(cls, spark: SparkSession, output: str, scope: str = "all") -> Manifest | None:
        at = cls.path(output, scope)
        if not exists(spark, at):
            return None
        data = json.loads(read_text(spark, at))
        return cls(Stamp(**data.pop("stamp")), **data)


def input_digest(spark: SparkSession, paths: list[str]) -> str:
    """sha256 over the names, sizes and times of the files under the paths, in order."""
    seen = hashlib.sha256()
    for path in paths:
        fs, target = _fs(spark, path)
        walk = fs.listFiles(target, True)
        found = []
        while walk.hasNext():
            f = walk.next()
            found.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
        seen.update(json.dumps(sorted(found)).encode())
    return seen.hexdigest()


def export(df: DataFrame, path: str, id_col: str, inputs: list[str], **options) -> Manifest:
    """Publish with a manifest; refuses to replace an export of other inputs."""
    spark, began = df.sparkSession, time.time()
    digest = input_digest(spark, inputs)
    earlier = Manifest.load(spark, path)
    if earlier is not None and earlier.inputs not in (None, digest):
        raise Stale(f"{path} was exported from other inputs")
    publish(df, path, **options)
    written = spark.read.parquet(path)
    fs, target = _fs(spark, path)
    manifest = Manifest(Stamp.of(written, id_col), [0], 1, written.count(), fs.getContentSummary(target).getLength(), round(time.time() - began, 3), digest)
    manifest.save(spark, path)
    return manifest


class Stale(RuntimeError):
    """A side output is missing, incomplete or of another input."""


def check_current(spark: SparkSession, output: str, stamp: Stamp, scope: str = "all", allow_stale: bool = False, allow_incomplete: bool = False) -> bool:
    """Whether the output can be used; raises Stale unless the fault is allowed."""
    manifest = Manifest.load(spark, output, scope)
    if manifest is None or sorted(manifest.shards) != list(range(manifest.of)):
        if allow_incomplete:
            return manifest is not None
        raise Stale(f"{output} ({scope}) is missing or incomplete")
    if manifest.stamp != stamp:
        if allow_stale:
            return True
        raise Stale(f"{output} ({scope}) was computed from another input")
    return True


def finish_shard(spark: SparkSession, output: str, shard: int, of: int, stamp: Stamp, scope: str = "all") -> Manifest:
    """Mark a shard done; a manifest of another input or shard count starts anew."""
    manifest = Manifest.load(spark, output, scope)
    if manifest is None or manifest.stamp != stamp or manifest.of != of:
        manifest = Manifest(stamp, [], of)
    manifest.shards = sorted({*manifest.shards, shard})
    manifest.save(spark, output, scope)
    return manifest


def write_sparse(hits: DataFrame, seen: DataFrame, path: str) -> None:
    """Append a sparse output: the hits first, then the ids looked at, so that a
    crash between the two repeats work but loses none."""
    hits.write.mode("append").parquet(path)
    seen.write.mode("append").parquet(seen_path(path))


def seen_path(path: str) -> str:
    """Where write_sparse notes the ids it has looked at."""
    return f"{path}-seen"


def pending(inputs: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Inputs whose key no earlier run has produced."""
    return inputs.join(done.select(key).distinct(), key, "left_anti")
