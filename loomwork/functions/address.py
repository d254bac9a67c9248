"""Postal addresses: comparison keys, parts, and a plan of what to geocode."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomwork.functions.text import fold_accents

_NUMBER = r"\d+[A-Za-z]?"
_LAST = rf"[\s,]+({_NUMBER})(?:\s*[-/].*)?\z"
_FIRST = rf"^({_NUMBER})[\s,]+(?=\p{{L}})"


def tidy(c: Column) -> Column:
    """Single spaces, no spaces or commas at the ends; null as ''."""
    return F.regexp_replace(F.regexp_replace(F.coalesce(c, F.lit("")), r"[\s\p{Z}]+", " "), r"^[ ,]+|[ ,]+\z", "")


def fold(c: Column) -> Column:
    """Key that ignores case, marks and punctuation."""
    return F.btrim(F.regexp_replace(F.lower(fold_accents(tidy(c))), r"[^\p{L}\p{N}]+", " "))


def city_parts(c: Column) -> Column:
    """Names of a city given in several languages; a dash inside a name does not part it."""
    parts = F.split(tidy(c), r"\s*[/;,]\s*|\s+[-–—]\s+")
    return F.filter(F.transform(parts, tidy), lambda p: p != "")


def split_street(c: Column) -> Column:
    """struct<number, street>: the number stands last or first; of a range the first counts.

    Without a clear number, or a street of two characters and a letter, the
    whole is the street.
    """
    whole = tidy(c)
    tail, head = F.regexp_replace(whole, _LAST, ""), F.regexp_replace(whole, _FIRST, "")
    fits = lambda s: (s != whole) & (F.length(tidy(s)) >= 2) & s.rlike(r"\p{L}")
    number = F.when(fits(tail), F.regexp_extract(whole, _LAST, 1)).when(fits(head), F.regexp_extract(whole, _FIRST, 1))
    return F.struct(number.alias("number"), F.when(fits(tail), tidy(tail)).when(fits(head), tidy(head)).otherwise(whole).alias("street"))


def address_key(street: Column, postcode: Column, city: Column, country: Column) -> Column:
    """One key for one request: equal addresses are asked once."""
    return F.sha1(F.concat_ws("\x1f", *[F.lower(tidy(x)) for x in (street, postcode, city, country)]))


def geocode_plan(rows: DataFrame, cache: DataFrame, budget: int) -> DataFrame:
    """(key, street, postcode, city, country, n): requests to make, the most wanted first.

    ``rows`` has street, postcode, city, country; a row without a street, city
    and country is never asked for. ``cache`` has the keys already answered,
    misses included, so that no answer is paid for twice.
    """
    parts = {c: tidy(F.col(c)).alias(c) for c in ("street", "postcode", "city", "country")}
    real = rows.select(*parts.values()).where("street <> '' AND city <> '' AND country <> ''")
    keyed = real.withColumn("key", address_key(*[F.col(c) for c in parts]))
    wanted = keyed.groupBy("key").agg(*[F.min(c).alias(c) for c in parts], F.count("*").alias("n"))
    return wanted.join(cache.select("key"), "key", "left_anti").orderBy(F.desc("n"), "key").limit(budget)


def tiered_cost(n: int, tiers: list[tuple[float, float]], used: int = 0) -> float:
    """Price of ``n`` more requests; tiers are (upper bound, price per 1,000), the last bound may be infinite."""
    total, lower = 0.0, 0.0
    for upper, price in tiers:
        inside = max(0.0, min(used + n, upper) - max(used, lower))
        total += inside * price / 1000
        lower = upper
    return total
