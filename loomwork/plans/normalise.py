"""Nested documents to entity and junction tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def entity_id(*natural_key: Column) -> Column:
    """Id of a natural key: the same in every load; nulls and '' differ from values."""
    return F.xxhash64(*[F.coalesce(k.cast("string"), F.lit("\0")) for k in natural_key])


def normalise(docs: DataFrame, parent_key: list[str], child: str, child_key: list[str]) -> tuple[DataFrame, DataFrame]:
    """(entities, junction) of a column of struct arrays.

    Entities are the distinct children by natural key, with the largest value
    of each other field; the junction is (parent_id, child_id, position), a
    child that repeats within a document at its first place. Null elements and
    children whose whole key is null are dropped.
    """
    exploded = docs.select(entity_id(*[F.col(k) for k in parent_key]).alias("parent_id"), F.posexplode(child).alias("position", "c"))
    named = exploded.where(F.coalesce(*[F.col(f"c.{k}").cast("string") for k in child_key]).isNotNull())
    keyed = named.withColumn("child_id", entity_id(*[F.col(f"c.{k}") for k in child_key]))
    fields = [f.name for f in docs.schema[child].dataType.elementType.fields]
    entities = keyed.groupBy(F.col("child_id").alias("id")).agg(*[F.max(F.col(f"c.{f}")).alias(f) for f in fields])
    junction = keyed.groupBy("parent_id", "child_id").agg(F.min("position").alias("position"))
    return entities, junction
