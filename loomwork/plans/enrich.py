"""Attributes derived from text: full texts, pillars, themes, topics, keywords."""

from __future__ import annotations

import operator
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomwork.core.keys import first_by


def full_text(rows: DataFrame, fields: list[str], translated: DataFrame | None = None, separator: str = " ") -> DataFrame:
    """(id, full_text): fields joined, each by its translation where there is one.

    ``translated`` is (id, field, text_en). Rows without any text go.
    """
    joined = rows
    if translated is not None:
        wide = translated.groupBy("id").pivot("field", fields).agg(F.max("text_en"))
        joined = rows.join(wide.select("id", *[F.col(f"`{f}`").alias(f"_en_{f}") for f in fields]), "id", "left")
    parts = [F.coalesce(F.col(f"_en_{f}"), F.col(f)) if translated is not None else F.col(f) for f in fields]
    return joined.select("id", F.concat_ws(separator, *parts).alias("full_text")).where("full_text <> ''")


def pillar_mask(text: Column, pillars: dict[str, list[str]]) -> Column:
    """Bit i is set if a stem of the i-th pillar begins a word.

    Words are runs of a-z, 0-9 and underline in the lower-case text. One pass
    puts a space for everything else; stems are then plain searches.
    """

    def mask(spaced: Column) -> Column:
        bits = F.lit(0)
        for i, stems in enumerate(pillars.values()):
            begins = reduce(operator.or_, [F.contains(spaced, F.lit(f" {s}")) for s in stems])
            bits = bits.bitwiseOR(F.when(begins, 1 << i).otherwise(0))
        return F.coalesce(bits, F.lit(0)).cast("short")

    spaced = F.concat(F.lit(" "), F.regexp_replace(F.lower(text), "[^a-z0-9_]+", " "))
    return F.get(F.transform(F.array(spaced), mask), F.lit(0))


def pillar_hits(rows: DataFrame, id_col: str, text_col: str, pillars: dict[str, list[str]]) -> DataFrame:
    """(id, pillars) of the rows with a bit set; the mask is computed once a row, not once more for the filter."""
    found = F.filter(F.array(pillar_mask(F.col(text_col), pillars)), lambda m: m != 0)
    return rows.select(F.col(id_col).alias("id"), F.explode(found).alias("pillars"))


def pillar_rate(hits: DataFrame, total: int, most: float = 0.3) -> DataFrame:
    """(bit, n, rate, flagged): how often each bit is set; a rate above ``most`` is flagged as a stem too broad."""
    bits = hits.select(F.explode(F.filter(F.sequence(F.lit(0), F.lit(15)), lambda i: F.col("pillars").cast("int").bitwiseAND(F.call_function("shiftleft", F.lit(1), i)) != 0)).alias("bit"))
    rate = F.col("n") / F.lit(float(max(total, 1)))
    return bits.groupBy("bit").agg(F.count("*").alias("n")).select("bit", "n", rate.alias("rate"), (rate > most).alias("flagged"))


def mask_names(mask: Column, names: list[str]) -> Column:
    """Names of the bits that are set, in bit order."""
    return F.filter(F.array(*[F.lit(n) for n in names]), lambda _, i: mask.cast("int").bitwiseAND(F.call_function("shiftleft", F.lit(1), i)) != 0)


@dataclass(frozen=True)
class ThemeRule:
    """A theme for topics whose column has one of the values."""

    theme: str
    column: str
    values: tuple


def themes(scores: DataFrame, topics: DataFrame, rules: list[ThemeRule], least: float) -> DataFrame:
    """(id, theme): the first rule that the best topic meets; its score must reach ``least``."""
    best = first_by(scores, ["id"], [F.col("score").desc(), F.col("topic_id")]).where(F.col("score") >= least)
    case = F.lit(None).cast("string")
    for rule in reversed(rules):
        case = F.when(F.col(rule.column).isin(*rule.values), rule.theme).otherwise(case)
    return best.join(topics, "topic_id").select("id", case.alias("theme")).where("theme IS NOT NULL")


def weigh(tf: DataFrame, vocabulary: DataFrame) -> DataFrame:
    raw = tf.join(vocabulary, "token").select("id", "token", (F.col("tf") * F.col("idf")).alias("x"))
    norms = raw.groupBy("id").agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("norm"))
    return raw.join(norms, "id").select("id", "token", (F.col("x") / F.col("norm")).alias("w"))


def best_topic(weights: DataFrame, topic_weights: DataFrame) -> DataFrame:
    """(id, topic_id, score): the topic of the highest cosine, ties to the smallest id.

    A sparse product by a join on the token; both sides are normalised.
    """
    t = topic_weights.select(F.col("id").alias("topic_id"), "token", F.col("w").alias("tw"))
    dots = weights.join(t, "token").groupBy("id", "topic_id").agg(F.sum(F.col("w") * F.col("tw")).alias("score"))
    return first_by(dots.withColumn("score", F.round("score", 9)), ["id"], [F.col("score").desc(), F.col("topic_id")])


def every_topic(rows: DataFrame, best: DataFrame) -> DataFrame:
    """(id, topic_id, score) for every row: topic -1 with score 0 where no topic shares a known term."""
    return rows.select("id").join(best, "id", "left").select("id", F.coalesce("topic_id", F.lit(-1)).alias("topic_id"), F.coalesce("score", F.lit(0.0)).alias("score"))


def score_batches(rows: DataFrame, id_col: str, text_col: str, load, schema: str = "id long, score double"):
    """Scores of an external model: ``load()`` gives, once a task, a function from a list of texts to scores."""
    import pandas as pd

    def run(batches):
        model = load()
        for batch in batches:
            yield pd.DataFrame({"id": batch["id"], "score": model(batch["text"].tolist())})

    return rows.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInPandas(run, schema)


def assemble(base: DataFrame, key: str, side: dict[str, tuple[DataFrame, dict[str, object]]]) -> DataFrame:
    """``base`` with the columns of sparse side outputs, defaults where absent.

    Each side is (frame, defaults by column); a frame is reduced to one row a
    key first, so the row count cannot change.
    """
    out = base
    for frame, defaults in side.values():
        unique = frame.groupBy(key).agg(*[F.min(c).alias(c) for c in defaults])
        out = out.join(unique, key, "left").withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items() if v is not None})
    return out


def supported_tags(matches: DataFrame, rules: list[tuple[str, Column]]) -> DataFrame:
    """(id, key, rule): tags that some match supports, with the first rule that holds.

    Subtractive: a tag without a supporting match goes.
    """
    case = F.lit(None).cast("string")
    for name, condition in reversed(rules):
        case = F.when(condition, name).otherwise(case)
    return matches.withColumn("rule", case).where("rule IS NOT NULL").groupBy("id", "key").agg(F.min("rule").alias("rule"))


def deny(tags: DataFrame, denied: DataFrame) -> DataFrame:
    """(id, keys) without the denied (id, key) pairs; ids left without keys go. An error on unknown pairs."""
    pairs = tags.select("id", F.explode("keys").alias("key"))
    unknown = denied.select("id", "key").join(pairs, ["id", "key"], "left_anti")
    if unknown.limit(1).count():
        raise ValueError("the deny list has pairs that are not tagged")
    return pairs.join(denied, ["id", "key"], "left_anti").groupBy("id").agg(F.array_sort(F.collect_set("key")).alias("keys"))


def ranked(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
