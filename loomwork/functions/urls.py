"""Links of a work, chosen by rule from its nested instances.

An instance is struct<accessRight: struct<label>, urls: array<string>, pids:
array<struct<scheme, value>>>.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_NONE = "array<string>"


def _urls(instances: Column) -> Column:
    return F.flatten(F.transform(instances, lambda i: F.coalesce(i["urls"], F.array().cast(_NONE))))


def all_urls(instances: Column) -> Column:
    return _urls(instances)


def open_urls(instances: Column) -> Column:
    """URLs of instances whose access label is OPEN."""
    return _urls(F.filter(instances, lambda i: i["accessRight"]["label"] == "OPEN"))


def is_pdf(url: Column, loose: bool = False) -> Column:
    """The path ends in .pdf; loosely, or the URL has /pdf."""
    strict = F.lower(F.split_part(url, F.lit("?"), F.lit(1))).endswith(".pdf")
    return strict | F.contains(F.lower(url), F.lit("/pdf")) if loose else strict


def _first(values: Column, test=None) -> Column:
    return F.get(F.filter(values, test) if test else values, F.lit(0))


def pdf_url(instances: Column) -> Column:
    """First open .pdf, first open /pdf, then the same of any instance."""
    tests = (lambda u: is_pdf(u), lambda u: is_pdf(u, loose=True))
    choices = [_first(urls(instances), test) for urls in (open_urls, all_urls) for test in tests]
    return _amp(F.coalesce(*choices))


def doi_of(pids: Column) -> Column:
    """Value of the first DOI, without a resolver prefix."""
    value = F.get(F.filter(pids, lambda p: F.lower(p["scheme"]) == "doi"), F.lit(0))["value"]
    return F.regexp_replace(value, r"^https?://(dx\.)?doi\.org/", "")


def any_doi(pids: Column, instances: Column) -> Column:
    """DOI of the work, else of its instances."""
    inner = F.flatten(F.transform(instances, lambda i: F.coalesce(i["pids"], F.array().cast("array<struct<scheme:string,value:string>>"))))
    return F.coalesce(doi_of(pids), doi_of(inner))


def landing_url(pids: Column, instances: Column) -> Column:
    """The DOI's address, else the first open URL, else the first."""
    return _amp(F.coalesce(F.concat(F.lit("https://doi.org/"), any_doi(pids, instances)), _first(open_urls(instances)), _first(all_urls(instances))))


def _amp(url: Column) -> Column:
    return F.replace(url, F.lit("&amp;"), F.lit("&"))
