"""Loading exported parts into versions of an index that an alias names.

A version is a folder of Parquet, one part a source file. What has been loaded
is noted after each part, so a load that stops goes on with the next file; the
alias is switched only when the counts agree.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

from loomwork.core.artifacts import _fs, exists, publish, read_text, write_text


class CountMismatch(RuntimeError):
    """A version does not hold as many rows as its sources."""


def _state_path(root: str, version: str) -> str:
    return f"{root}/{version}.state.json"


def loaded(spark: SparkSession, root: str, version: str) -> dict[str, int]:
    """Rows by source file that a version has taken."""
    path = _state_path(root, version)
    return json.loads(read_text(spark, path)) if exists(spark, path) else {}


def load_version(spark: SparkSession, sources: list[str], root: str, version: str, stop_after: int | None = None) -> dict[str, int]:
    """Load the sources that a version lacks; ``stop_after`` parts, to try a stop.

    A part is published whole before it is noted; a stop between the two makes
    it be written again in its own place, never twice.
    """
    done = loaded(spark, root, version)
    for place, source in enumerate(sources):
        if source in done:
            continue
        if stop_after is not None and len(done) >= stop_after:
            break
        part = f"{root}/{version}/part={place}"
        publish(spark.read.parquet(source), part)
        done[source] = spark.read.parquet(part).count()
        write_text(spark, _state_path(root, version), json.dumps(done))
    return done


def switch_alias(spark: SparkSession, sources: list[str], root: str, version: str, alias: str) -> int:
    """Point an alias at a version that holds all rows of its sources; returns their number."""
    want = sum(spark.read.parquet(s).count() for s in sources)
    have = spark.read.parquet(f"{root}/{version}").count() if exists(spark, f"{root}/{version}") else 0
    if want != have or sorted(loaded(spark, root, version)) != sorted(sources):
        raise CountMismatch(f"{version} has {have} of {want} rows")
    write_text(spark, f"{root}/{alias}.alias", version)
    return have


def read_alias(spark: SparkSession, root: str, alias: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{read_text(spark, f'{root}/{alias}.alias')}").drop("part")


def copy_dataset(spark: SparkSession, source: str, target: str) -> None:
    """A copy of a dataset's files, for a stage that starts from an earlier one's output."""
    fs, at = _fs(spark, source)
    to_fs, to = _fs(spark, target)
    spark.sparkContext._jvm.org.apache.hadoop.fs.FileUtil.copy(fs, at, to_fs, to, False, True, spark.sparkContext._jsc.hadoopConfiguration())
