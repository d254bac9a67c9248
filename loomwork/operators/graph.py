"""Typed edges between projects, works and organisations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

EDGE = ["source", "source_type", "target", "target_type"]


#: Type of ids that may be unsigned 64-bit numbers.
UNSIGNED = "decimal(20,0)"


def edges(df: DataFrame, source: Column, source_type: str, target: Column, target_type: str, id_type: str = "long") -> DataFrame:
    """Distinct edges of one kind; ``id_type`` is UNSIGNED where ids go beyond a long."""
    return df.select(
        source.cast(id_type).alias("source"), F.lit(source_type).alias("source_type"), target.cast(id_type).alias("target"), F.lit(target_type).alias("target_type")
    ).distinct()


def edges_from_lists(docs: DataFrame, id_col: str, source_type: str, list_col: str, target_type: str) -> DataFrame:
    """Distinct edges of documents that hold the ids of their targets in a list."""
    return edges(docs.select(F.col(id_col).alias("_s"), F.explode(list_col).alias("_t")), F.col("_s"), source_type, F.col("_t"), target_type)


def keep_edges(rel: DataFrame, nodes: dict[str, DataFrame]) -> DataFrame:
    """Edges whose two ends exist: one pass, a semi join on type and id for each end.

    ``nodes`` maps a type to a frame whose first column is its id; an edge with
    a type that is not listed goes.
    """
    known = reduce(DataFrame.unionByName, [n.select(F.lit(kind).alias("type"), F.col(n.columns[0]).alias("id")) for kind, n in nodes.items()])
    at = lambda end: known.select(F.col("type").alias(f"{end}_type"), F.col("id").alias(end))
    kept = rel.join(at("source"), ["source_type", "source"], "left_semi").join(at("target"), ["target_type", "target"], "left_semi")
    return kept.select(*rel.columns)


def cascade_report(rel: DataFrame, kept: DataFrame) -> DataFrame:
    """(source_type, target_type, n_all, n_kept, n_dropped)."""
    kind = ["source_type", "target_type"]
    all_, left = rel.groupBy(*kind).agg(F.count("*").alias("n_all")), kept.groupBy(*kind).agg(F.count("*").alias("n_kept"))
    joined = all_.join(left, kind, "left").withColumn("n_kept", F.coalesce("n_kept", F.lit(0)))
    return joined.withColumn("n_dropped", F.col("n_all") - F.col("n_kept"))


def dangling(rel: DataFrame, nodes: dict[str, DataFrame]) -> DataFrame:
    """(end, type, n): edges whose end of a type is no node."""
    out = []
    for end in ("source", "target"):
        for kind, node in nodes.items():
            part = rel.where(F.col(f"{end}_type") == kind).select(F.col(end).alias("id"))
            lost = part.join(node.select(F.col(node.columns[0]).alias("id")), "id", "left_anti")
            out.append(lost.agg(F.count("*").alias("n")).select(F.lit(end).alias("end"), F.lit(kind).alias("type"), "n"))
    return reduce(DataFrame.unionByName, out)


def link_tiers(tiers: list[DataFrame]) -> DataFrame:
    """(id, link_tier): the best tier of each id; a frame's place is its tier."""
    parts = [t.select(F.col(t.columns[0]).alias("id"), F.lit(i).cast("short").alias("link_tier")) for i, t in enumerate(tiers)]
    return reduce(DataFrame.unionByName, parts).groupBy("id").agg(F.min("link_tier").alias("link_tier"))


def trim(works: DataFrame, tiers: DataFrame, cap: int, date: str, has_text: Column, today: Column) -> DataFrame:
    """The ``cap`` best works: (id, link_tier, sort_date, has_text).

    Order: tier, later dates first with unknown and future ones last, works
    with text first, smallest id. Only these narrow columns are sorted; join
    the wide rows afterwards. For a cap that a driver cannot hold use
    ``trim_ranked``.
    """
    return narrow(works, tiers, date, has_text, today).orderBy(*trim_order()).limit(cap)


def narrow(works: DataFrame, tiers: DataFrame, date: str, has_text: Column, today: Column) -> DataFrame:
    day = F.col(date).cast("date")
    return works.select("id", F.when(day <= today, day).alias("sort_date"), has_text.alias("has_text")).join(tiers, "id").select("id", "link_tier", "sort_date", "has_text")


def trim_order() -> list[Column]:
    return [F.col("link_tier").asc(), F.col("sort_date").desc_nulls_last(), F.col("has_text").desc(), F.col("id").asc()]


def trim_ranked(rows: DataFrame, cap: int) -> DataFrame:
    """``trim`` for a large cap, without a global sort of one task.

    Counts by (tier, date) are small; their running sum finds the group in
    which the cap falls. Groups before it are kept whole, and only that group
    is ranked.
    """
    groups = rows.groupBy("link_tier", "sort_date").agg(F.count("*").alias("n"))
    order = Window.orderBy(F.col("link_tier").asc(), F.col("sort_date").desc_nulls_last())
    running = groups.withColumn("before", F.sum("n").over(order) - F.col("n")).where(F.col("before") < cap)
    keyed = running.select(F.col("link_tier").alias("_t"), F.col("sort_date").alias("_d"), "n", "before")
    placed = rows.join(keyed, (F.col("link_tier") == F.col("_t")) & F.col("sort_date").eqNullSafe(F.col("_d")))
    whole = placed.where(F.col("before") + F.col("n") <= cap)
    cut = placed.where(F.col("before") + F.col("n") > cap)
    ranked = cut.withColumn("_k", F.row_number().over(Window.partitionBy("link_tier", "sort_date").orderBy(F.col("has_text").desc(), F.col("id"))))
    best = ranked.where(F.col("before") + F.col("_k") <= cap)
    return whole.select(*rows.columns).unionByName(best.select(*rows.columns))


def cutoff(ranked: DataFrame, kept: DataFrame) -> DataFrame:
    """One row: the last tier kept, its last date, how many of that date are there and kept."""
    last = kept.agg(F.max("link_tier").alias("tier"))
    day = kept.join(F.broadcast(last), F.col("link_tier") == F.col("tier")).agg(
        F.max("tier").alias("cutoff_tier"), F.when(F.count_if(F.col("sort_date").isNull()) == 0, F.min("sort_date")).alias("cutoff_date")
    )
    at = (F.col("link_tier") == F.col("cutoff_tier")) & F.col("sort_date").eqNullSafe(F.col("cutoff_date"))
    there = ranked.join(F.broadcast(day), at).agg(F.count("*").alias("on_cutoff_date"))
    held = kept.join(F.broadcast(day), at).agg(F.count("*").alias("kept_on_cutoff_date"))
    one = lambda df: df.withColumn("_one", F.lit(1))  # noqa: E731  aggregates of one row each
    return one(day).join(one(there), "_one").join(one(held), "_one").drop("_one")


#: Members of a group whose pairs one task makes.
PAIR_BLOCK = 2048


def pairs(members: DataFrame, groups: str | list[str], member: str, directed: bool = False, by: list[str] | None = None) -> DataFrame:
    """(by..., a, b, shared): pairs of members with the number of groups they share.

    The pairs are the result, so their number cannot shrink, but no task makes
    those of a whole large group: its members are dealt into blocks, each pair
    of blocks is a join key of its own, and counts are summed within tasks
    before they move. ``directed`` gives both orders; ``by`` are columns of the
    group to count by.
    """
    groups, by = [groups] if isinstance(groups, str) else groups, by or []
    distinct = members.select(*groups, member).distinct()
    large = distinct.groupBy(*groups).agg(F.count("*").alias("_n")).where(F.col("_n") > PAIR_BLOCK)
    blocks = large.select(*groups, F.ceil(F.col("_n") / PAIR_BLOCK).alias("_k"))
    dealt = distinct.join(blocks, groups, "left").withColumn("_k", F.coalesce("_k", F.lit(1).cast("long"))).withColumn("_b", F.pmod(F.xxhash64(member), F.col("_k")))
    others = F.explode(F.expr("sequence(0L, _k - 1)"))
    key = [*groups, "_x", "_y"]
    left = dealt.withColumn("_y", others).select(*groups, F.col("_b").alias("_x"), "_y", F.col(member).alias("a"))
    right = dealt.withColumn("_x", others).select(*groups, "_x", F.col("_b").alias("_y"), F.col(member).alias("b"))
    apart = F.col("a") != F.col("b") if directed else F.col("a") < F.col("b")
    return left.join(right, key).where(apart).groupBy(*by, "a", "b").agg(F.count("*").alias("shared"))


def partners(members: DataFrame, group: str, member: str, center: int) -> DataFrame:
    """(partner, shared) of one member: groups it is in, then their other members."""
    own = members.where(F.col(member) == center).select(group).distinct()
    others = members.select(group, member).distinct().join(own, group, "left_semi").where(F.col(member) != center)
    return others.groupBy(F.col(member).alias("partner")).agg(F.count("*").alias("shared"))
