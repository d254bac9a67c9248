"""Tables of groups and their tags on entities."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomwork.plans.enrich import deny


def chosen_parents(groups: DataFrame) -> DataFrame:
    """(child, parent): of the groups whose name a group's ``part_of`` lists, the one of the smallest id.

    ``groups`` is (group_id, name, part_of); a group is no parent of itself.
    """
    listed = groups.select(F.col("group_id").alias("child"), F.explode("part_of").alias("parent_name"))
    named = groups.select(F.col("group_id").alias("parent"), F.col("name").alias("parent_name"))
    return listed.join(named, "parent_name").where("child <> parent").groupBy("child").agg(F.min("parent").alias("parent"))


def with_subgroups(groups: DataFrame, excluded: DataFrame) -> DataFrame:
    """(group_id, name, part_of, subgroups): groups that are neither excluded nor part of another.

    Subgroups are (name, group_id) by name, then id. ``excluded`` is (group_id).
    """
    kept = groups.join(excluded.select("group_id").distinct(), "group_id", "left_anti")
    parents = chosen_parents(kept)
    named = parents.join(kept.select(F.col("group_id").alias("child"), "name"), "child")
    listed = named.groupBy(F.col("parent").alias("group_id")).agg(F.array_sort(F.collect_list(F.struct("name", F.col("child").alias("group_id")))).alias("subgroups"))
    top = kept.join(parents.select(F.col("child").alias("group_id")), "group_id", "left_anti")
    none = F.array().cast("array<struct<name:string,group_id:bigint>>")
    return top.join(listed, "group_id", "left").withColumn("subgroups", F.coalesce("subgroups", none))


def tag_source(stored: DataFrame, override: DataFrame | None = None, exclude: DataFrame | None = None, entities: DataFrame | None = None) -> DataFrame:
    """(id, keys): the stored tags, or all of an override, or the stored ones less excluded pairs.

    The modes exclude each other. An override may name only ids of
    ``entities``; excluded pairs must be stored ones. Empty lists go.
    """
    if override is not None and exclude is not None:
        raise ValueError("an override and an exclude list exclude each other")
    if exclude is not None:
        return deny(stored, exclude)
    if override is None:
        return stored.where("size(keys) > 0")
    if entities is not None and override.join(entities.select("id"), "id", "left_anti").limit(1).count():
        raise ValueError("the override names unknown ids")
    return override.where("size(keys) > 0").select("id", "keys")


@dataclass(frozen=True)
class Evidence:
    """Which rules of re-evaluation are on, and the keywords that they name.

    ``never``: (key, keyword) pairs that never count; ``weak``: pairs that need
    a second signal near them; ``institution``: pairs that do not count where
    all their places are names of institutions; ``single_typo`` is keep, drop or
    second-signal.
    """

    never: tuple[tuple, ...] = ()
    weak: tuple[tuple, ...] = ()
    institution: tuple[tuple, ...] = ()
    single_typo: str = "second-signal"


def _among(pairs: tuple[tuple, ...]) -> Column:
    out = F.lit(False)
    for key, keyword in pairs:
        out = out | ((F.col("key") == F.lit(key)) & (F.col("keyword") == F.lit(keyword)))
    return out


def drop_reason(rules: Evidence) -> Column:
    """Why a match (key, keyword, typo, signal, institution_only) does not support its tag; null if it does."""
    several = F.contains("keyword", F.lit(" "))
    single = F.col("typo") & ~several
    weak = _among(rules.weak)
    needs = (weak | single) if rules.single_typo == "second-signal" else weak
    named = _among(rules.institution)
    return (
        F.when(F.col("typo") & several, "R1")
        .when(_among(rules.never), "R2")
        .when(named, F.when(F.col("institution_only"), "R5"))
        .when(single & F.lit(rules.single_typo == "drop"), "R4")
        .when(needs & ~F.col("signal"), F.when(weak, "R3").otherwise("R4"))
    )


def reevaluated(matches: DataFrame, rules: Evidence) -> DataFrame:
    """(id, key, kept, reason): a tag stays if any match supports it; else the commonest reason, ties to the first by name."""
    judged = matches.select("id", "key", drop_reason(rules).alias("r")).groupBy("id", "key", "r").agg(F.count("*").alias("n"))
    best = F.min(F.when(F.col("r").isNotNull(), F.struct((-F.col("n")).alias("o"), "r")))
    whole = judged.groupBy("id", "key").agg(F.bool_or(F.col("r").isNull()).alias("kept"), best.alias("b"))
    return whole.select("id", "key", "kept", F.when(~F.col("kept"), F.col("b.r")).alias("reason"))


def candidates(labels: DataFrame, drop: str, seeds: DataFrame, dimensions: list[DataFrame]) -> DataFrame:
    """(id, name, labels, seeded, ...): groups by id with the union of their labels.

    ``labels`` is (id, name, label); names that match ``drop`` go, unless they
    are seeds; seeds (id, name) without a row are added; each dimension is
    (id, ...) and is joined to the left by id, its first value by order.
    """
    found = labels.groupBy("id").agg(F.min("name").alias("name"), F.array_sort(F.collect_set("label")).alias("labels"))
    marked = seeds.groupBy("id").agg(F.min("name").alias("_seed"))
    both = found.join(marked, "id", "full")
    out = both.select("id", F.coalesce("name", "_seed").alias("name"), F.coalesce("labels", F.array().cast("array<string>")).alias("labels"), F.col("_seed").isNotNull().alias("seeded"))
    out = out.where(F.col("seeded") | ~F.col("name").rlike(drop))
    for frame in dimensions:
        columns = [c for c in frame.columns if c != "id"]
        out = out.join(frame.groupBy("id").agg(*[F.min(c).alias(c) for c in columns]), "id", "left")
    return out


def merged(parts: dict[str, list[DataFrame]]) -> dict[str, DataFrame]:
    """Tables of several loads appended by name, columns that a load lacks null."""
    out = {}
    for name, frames in parts.items():
        whole = frames[0]
        for frame in frames[1:]:
            whole = whole.unionByName(frame, allowMissingColumns=True)
        out[name] = whole
    return out
