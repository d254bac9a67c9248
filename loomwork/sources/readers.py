"""Readers for landed files."""

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def list_files(spark: SparkSession, pattern: str) -> list[str]:
    """Files of a glob, sorted by name."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path) or []
    return sorted(s.getPath().toString() for s in found)


def read_ndjson(spark: SparkSession, patterns: str | list[str], schema: T.StructType | str | None = None, first_files: int | None = None) -> DataFrame:
    """Newline-delimited JSON, gzip or plain, from one or many globs.

    With ``first_files`` only that many files of each glob, by name. A gzip
    file is one task; repartition after reading where files are few and large.
    """
    patterns = [patterns] if isinstance(patterns, str) else patterns
    if first_files is not None:
        patterns = [f for p in patterns for f in list_files(spark, p)[:first_files]]
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.json(patterns)


def read_json_document(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """One JSON document or array a file."""
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema is not None else reader).json(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """CSV with a header, quotes doubled; all text unless a schema is given."""
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", True)
    return (reader.schema(schema) if schema is not None else reader).csv(path)


def read_table_file(spark: SparkSession, path: str) -> DataFrame:
    """CSV or Parquet, by suffix."""
    return spark.read.parquet(path) if path.rstrip("/").endswith(".parquet") else read_csv(spark, path)


def read_parquet_union(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Parquet files of differing columns by name, typed; empty if there are none."""
    typed = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if not list_files(spark, f"{path.rstrip('/')}/*.parquet"):
        return empty(spark, typed)
    found = spark.read.option("mergeSchema", True).parquet(path)
    return found.select(*[(F.col(f.name) if f.name in found.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in typed])


def empty(spark: SparkSession, schema: T.StructType | str) -> DataFrame:
    return spark.createDataFrame([], schema)


def inline(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """VALUES: a few literal rows."""
    return spark.createDataFrame(rows, schema)


def register_tables(spark: SparkSession, folder: str, prefix: str = "") -> list[str]:
    """Each Parquet table under a folder as a temporary view (ATTACH)."""
    names = []
    for path in list_files(spark, f"{folder.rstrip('/')}/*.parquet"):
        name = prefix + path.rstrip("/").rsplit("/", 1)[-1].removesuffix(".parquet")
        spark.read.parquet(path).createOrReplaceTempView(name)
        names.append(name)
    return names


def register_frame(df: DataFrame, name: str) -> DataFrame:
    """A frame under a name that SQL can use."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def read_appended(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Newline-delimited JSON that a writer may have left with a torn last record: records that do not parse go."""
    torn = spark.read.schema(f"{schema}, _torn string").option("columnNameOfCorruptRecord", "_torn").json(path)
    return torn.where("_torn IS NULL").drop("_torn")


def at_path(text: str, path: str) -> Column:
    """The value at a known path of a JSON text, as JSON text without quotes; null where there is none."""
    return F.try_variant_get(F.try_parse_json(F.col(text)), path, "string")


def table_columns(spark: SparkSession, table: str) -> DataFrame:
    """(position, column, type) of a table or view."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(spark.table(table).schema)]
    return spark.createDataFrame(rows, "position int, column string, type string")


def read_documents(spark: SparkSession, folder: str, suffixes: tuple[str, ...] = (".json", ".xml")) -> DataFrame:
    """(path, modified, text) of the documents under a folder, at any depth."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    wanted = F.lit(False)
    for s in suffixes:
        wanted = wanted | F.lower("path").endswith(s)
    return files.where(wanted).select("path", F.col("modificationTime").alias("modified"), F.decode("content", "UTF-8").alias("text"))


def read_xml(spark: SparkSession, path: str, row_tag: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Elements of a tag as rows; attributes are fields with ``_`` before their name, text is ``_VALUE``."""
    reader = spark.read.format("xml").option("rowTag", row_tag)
    return (reader.schema(schema) if schema is not None else reader).load(path)


def find_key(text: str, key: str):
    """Column: every value of a key at any depth of a JSON text, as JSON texts; null if it does not parse."""
    import pandas as pd

    def walk(node):
        if isinstance(node, dict):
            for k, v in node.items():
                if k == key:
                    yield json.dumps(v, ensure_ascii=False)
                yield from walk(v)
        elif isinstance(node, list):
            for v in node:
                yield from walk(v)

    def values(t: str | None) -> list[str] | None:
        try:
            return list(walk(json.loads(t)))
        except (TypeError, ValueError):
            return None

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def found(texts: pd.Series) -> pd.Series:
        return texts.map(values)

    return found(F.col(text))
