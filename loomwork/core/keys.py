"""Builders for patterns that other engines spell as clauses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_by(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row a key: the first in ``order`` (QUALIFY row_number() = 1).

    ``order`` should be total, so that reruns agree. Planned with a group
    limit before the shuffle.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def top_by(df: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    """The first ``n`` rows of each key."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")


def ordered_list(value: str, *order: str) -> Column:
    """list(value ORDER BY ...) ascending, nulls of ``value`` dropped."""
    packed = F.array_sort(F.collect_list(F.when(F.col(value).isNotNull(), F.struct(*[F.col(o) for o in order], F.col(value).alias("_value")))))
    return F.transform(packed, lambda x: x["_value"])


def distinct_list(value: str) -> Column:
    """Sorted distinct non-null values."""
    return F.array_sort(F.collect_set(value))


def merged_list(value: Column, separator: str = ";") -> Column:
    """Sorted distinct trimmed parts of delimited strings, '' dropped: an aggregate."""
    parts = F.transform(F.split(value, separator), lambda x: F.btrim(x))
    return F.array_sort(F.array_distinct(F.filter(F.flatten(F.collect_list(parts)), lambda x: x != "")))


def count_where(condition: Column) -> Column:
    return F.count_if(condition)


def count_distinct_rows(*cols: str) -> Column:
    """Distinct tuples, null parts included."""
    return F.count_distinct(F.struct(*cols))


def equal_split(amount: Column, parts: Column) -> Column:
    return amount / F.nullif(parts, F.lit(0))


def null_if_zero(c: Column) -> Column:
    return F.nullif(c, F.lit(0))


def anti(df: DataFrame, other: DataFrame, on: list[str]) -> DataFrame:
    """NOT EXISTS: rows without a partner; nulls never match."""
    return df.join(other.select(*on).distinct(), on, "left_anti")


def semi(df: DataFrame, other: DataFrame, on: list[str]) -> DataFrame:
    return df.join(other.select(*on), on, "left_semi")


def overlay(df: DataFrame, values: DataFrame, on: list[str], columns: list[str], only_null: bool = False) -> DataFrame:
    """UPDATE ... FROM: ``columns`` taken from ``values``, whose keys are unique.

    With ``only_null`` a value replaces only null; otherwise any matched
    non-null value wins. The order of columns stays.
    """
    renamed = values.select(*on, *[F.col(c).alias(f"_new_{c}") for c in columns])
    joined = df.join(renamed, on, "left")
    new = {c: F.coalesce(F.col(c), F.col(f"_new_{c}")) if only_null else F.coalesce(F.col(f"_new_{c}"), F.col(c)) for c in columns}
    return joined.select(*[new[c].alias(c) if c in new else F.col(c) for c in df.columns])


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """INSERT OR REPLACE: rows of ``new``, and those of ``old`` it has no key for."""
    return old.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new)


def insert_missing(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """INSERT OR IGNORE: ``old``, and the rows of ``new`` whose key is unknown."""
    return old.unionByName(new.dropDuplicates(keys).join(old.select(*keys), keys, "left_anti"))


def add_missing_columns(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """ALTER TABLE ADD COLUMN IF NOT EXISTS."""
    return df.withColumns({c: F.lit(None).cast(t) for c, t in columns.items() if c not in df.columns})


def require_columns(df: DataFrame, columns: list[str], strict: bool = True) -> list[str]:
    """Missing columns; an error if ``strict`` and there are any."""
    missing = [c for c in columns if c not in df.columns]
    if missing and strict:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return missing


def assert_schema(df: DataFrame, declared: dict[str, str]) -> DataFrame:
    """An error unless names and types are exactly those declared."""
    actual = dict(df.dtypes)
    wrong = {c for c in {*actual, *declared} if actual.get(c) != declared.get(c)}
    if wrong:
        raise ValueError(f"schema differs in: {', '.join(sorted(wrong))}")
    return df


def assert_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    if df.groupBy(*keys).count().where("count > 1").limit(1).count():
        raise ValueError(f"duplicate keys: {', '.join(keys)}")
    return df
