"""Parsing of loosely typed strings; what does not parse is null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_bool(c: Column) -> Column:
    word = F.lower(F.btrim(c))
    return F.when(word.isin("true", "1", "yes", "y", "t"), True).when(word.isin("false", "0", "no", "n", "f"), False)


def parse_long(c: Column) -> Column:
    return F.when(F.btrim(c).rlike(r"^[+-]?\d+$"), F.btrim(c)).try_cast("long")


def parse_double(c: Column) -> Column:
    return F.replace(F.btrim(c), F.lit(","), F.lit(".")).try_cast("double")


def parse_date(c: Column) -> Column:
    """First ten characters as an ISO date."""
    return F.substring(F.btrim(c), 1, 10).try_cast("date")


def parse_point(c: Column, longitude_first: bool = False) -> Column:
    """struct<lat, lon> of "a, b" with optional brackets, within bounds."""
    parts = F.split(F.regexp_replace(c, r"[\[\]()\s]", ""), ",")
    first, second = F.get(parts, F.lit(0)).try_cast("double"), F.get(parts, F.lit(1)).try_cast("double")
    lat, lon = (second, first) if longitude_first else (first, second)
    fits = (F.size(parts) == 2) & lat.between(-90, 90) & lon.between(-180, 180)
    return F.when(fits, F.struct(lat.alias("lat"), lon.alias("lon")))


def ensure_list(c: Column, element: str = "string") -> Column:
    """A one-element array of a value, an empty one of null."""
    return F.when(c.isNull(), F.array().cast(f"array<{element}>")).otherwise(F.array(c))


def nuts_level(code: Column) -> Column:
    """Level of a NUTS code by its length: two letters are level 0."""
    size = F.length(F.btrim(code))
    return F.when(size.between(2, 5), size - 2)
