"""Shared rollups and denormalised documents.

Input frames: projects (pid, ...), participations (pid, oid, is_coord),
organisations (oid, name, region, country). Rollups are aggregated before any
wide row is joined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomwork.core.keys import top_by


def participation(rel: DataFrame, orgs: DataFrame) -> DataFrame:
    """One row a (pid, oid), with the organisation's columns; unknown regions are 'Unknown'."""
    unique = rel.groupBy("pid", "oid").agg(F.bool_or("is_coord").alias("is_coord"))
    return unique.join(orgs, "oid").withColumn("region", F.coalesce("region", F.lit("Unknown")))


def project_orgs(po: DataFrame) -> DataFrame:
    """Ordered and distinct lists of a project's organisations, coordinators first."""
    first = (~F.col("is_coord")).cast("int").alias("o")
    packed = F.array_sort(F.collect_list(F.struct(first, "oid", "name")))
    return (
        po.groupBy("pid")
        .agg(
            packed.alias("p"),
            F.array_sort(F.collect_set("region")).alias("org_regions"),
            F.array_sort(F.collect_set("country")).alias("org_countries"),
            F.array_sort(F.collect_list(F.when(F.col("is_coord"), F.col("oid").cast("string")))).alias("coordinator_ids"),
            F.count("*").cast("int").alias("org_count"),
        )
        .select(
            "pid",
            F.transform("p", lambda x: x["oid"].cast("string")).alias("org_ids"),
            F.filter(F.transform("p", lambda x: x["name"]), lambda n: n.isNotNull()).alias("org_names"),
            "org_regions",
            "org_countries",
            "coordinator_ids",
            "org_count",
        )
    )


def streams(fundings: DataFrame) -> DataFrame:
    """(pid, stream_id, programme, action, funder): parts of 'funder::programme::action'.

    ``fundings`` is (pid, funder, sid); without a sid the stream is the pseudo
    stream 'NONE::<funder>', which has no parts.
    """
    part = lambda i: F.nullif(F.split_part("sid", F.lit("::"), F.lit(i)), F.lit(""))
    return fundings.select("pid", F.coalesce("sid", F.concat(F.lit("NONE::"), "funder")).alias("stream_id"), part(2).alias("programme"), part(3).alias("action"), "funder")


def grants(streams_: DataFrame, amounts: DataFrame) -> DataFrame:
    """(id, funder, project_count, total_eur): an amount is split equally over a project's fundings.

    Shares are summed as whole millionths, so that the order of rows does not show.
    """
    n = streams_.groupBy("pid").agg(F.count("*").alias("n_fund"))
    joined = streams_.join(n, "pid").join(amounts, "pid", "left")
    return joined.groupBy(F.col("stream_id").alias("id")).agg(
        F.min("funder").alias("funder"), F.count_distinct("pid").alias("project_count"), (F.sum(F.floor(F.col("amount") * 1000000 / F.col("n_fund")).cast("long")) / 1000000).alias("total_eur")
    )


def counted_by_clean(rows: DataFrame, raw: str, clean) -> DataFrame:
    """(name, n): raw values are counted first, so that each is cleaned once."""
    counted = rows.groupBy(raw).agg(F.count("*").alias("n"))
    return counted.select(clean(F.col(raw)).alias("name"), "n").where("name IS NOT NULL").groupBy("name").agg(F.sum("n").alias("n"))


def text_blob(rows: DataFrame, key: str, text: str, order: list[str], most: int, longest: int) -> DataFrame:
    """(key, blob): the first ``most`` texts of a key by order, joined and cut to ``longest`` characters."""
    best = top_by(rows, [key], [F.col(o) for o in order], most)  # so many rows a key move, however many it has
    packed = F.array_sort(F.collect_list(F.struct(*order, F.col(text).alias("_t"))))
    return best.groupBy(key).agg(F.substring(F.array_join(F.transform(packed, lambda x: x["_t"]), " "), 1, longest).alias("blob"))


def key_counts(rows: DataFrame, key: str, value: str) -> DataFrame:
    """(key, counts): array of (value, n), the most frequent first, then by value."""
    counted = rows.groupBy(key, F.col(value).alias("value")).agg(F.count("*").alias("n"))
    packed = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("o"), "value", "n")))
    return counted.groupBy(key).agg(F.transform(packed, lambda x: F.struct(x["value"].alias("value"), x["n"].alias("n"))).alias("counts"))


def left_chain(base: DataFrame, sides: list[DataFrame], key: str, fill: dict[str, Column] | None = None) -> DataFrame:
    """Left joins of rollups that are unique by key."""
    out = base
    for side in sides:
        out = out.join(side, key, "left")
    return out.withColumns({c: F.coalesce(F.col(c), v) for c, v in (fill or {}).items()})
