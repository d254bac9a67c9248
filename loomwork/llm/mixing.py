"""Mixing sources to target weights by a low-discrepancy schedule.

Slot s of the schedule takes the golden-ratio point frac((s + 0.5) / phi); the
source whose interval of cumulative target weights holds the point owns the
slot. A source's slots are ranked, and rank r takes block r of the source: its
documents in hash order, laid end to end as often as the target asks for and
cut into blocks of equal tokens. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomwork.llm.common import WORD_PATTERN, materialize, packed, prefix_sum, unpacked

WEIGHT_CYCLE = (1.0, 2.0, 3.0)
MAX_REPEATS = 3
SHARE = 1.0
SEED = 17
GOLDEN = 0.6180339887498949
#: Bounds of the number of tokens in a block, and of the number of slots.
BLOCK_TOKENS = (1, 4096)
MAX_SLOTS = 1 << 22
#: Blocks that the smallest target should fill.
BLOCKS_EACH = 1000
_BUCKETS = 1024
_CHUNK = 1 << 16
_BINS = 4096


def with_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Scratch table (row, doc_id, source, size, h, bucket): one row per document.

    ``row`` tells repeated documents apart; size counts words, 0 for null.
    """
    spread = F.xxhash64(F.lit(SEED), F.col(id_col).cast("long"))
    return materialize(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            F.col(id_col).cast("long").alias("doc_id"),
            F.col(source_col).cast("string").alias("source"),
            F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD_PATTERN)), F.lit(0)).cast("long").alias("size"),
            spread.alias("h"),
            F.pmod(spread, F.lit(_BUCKETS)).alias("bucket"),
        )
    )


def source_targets(sized: DataFrame, share: float = SHARE, repeats: int = MAX_REPEATS, cycle: tuple[float, ...] = WEIGHT_CYCLE) -> DataFrame:
    """(source, source_size, position, weight, target): one row per source.

    Sources take the weights of ``cycle`` in code point order, null last. A
    target stops at ``repeats`` times its source's size; what it leaves is
    shared by weight among the others until none is above.
    """
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    # positions without a window over all sources: ranges, then offsets of ranges
    ranged = totals.repartitionByRange(8, F.col("source").asc_nulls_last()).sortWithinPartitions(F.col("source").asc_nulls_last())
    placed = materialize(ranged.select("*", F.spark_partition_id().alias("part"), F.expr("monotonically_increasing_id() & ((1L << 33) - 1)").alias("inside")))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("part").agg(F.count("*").alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    weights = F.element_at(F.array(*[F.lit(float(w)) for w in cycle]), (F.pmod(F.col("position"), F.lit(len(cycle))) + 1).cast("int"))
    known = materialize(
        placed.join(offsets, "part")
        .withColumn("position", F.col("inside") + F.col("start"))
        .withColumn("weight", weights)
        .withColumn("cap", F.col("source_size") * F.lit(float(repeats)))
        .select("source", "source_size", "position", "weight", "cap")
    )
    whole = known.agg(F.sum("source_size")).first()[0]
    total = share * float(whole or 0)
    level, full_n = 0.0, -1
    while True:  # one aggregate row a round; a source that is full stays full
        full = (F.col("cap") <= F.col("weight") * F.lit(level)) if full_n >= 0 else F.lit(False)
        row = known.agg(
            F.sum(F.when(full, F.col("cap")).otherwise(0.0)).alias("taken"),
            F.sum(F.when(full, 0.0).otherwise(F.col("weight"))).alias("open"),
            F.sum(F.when(full, 1).otherwise(0)).alias("n"),
        ).first()
        if row["n"] == full_n or not row["open"]:
            break
        full_n, level = row["n"], max(0.0, total - row["taken"]) / row["open"]
    share_of = F.col("weight") * F.lit(level)
    return materialize(known.withColumn("target", F.least("cap", share_of)).select("source", "source_size", "position", "weight", "target"))


def schedule(targets: DataFrame) -> DataFrame:
    """(slot, position, rank, start, tokens): what each slot takes of its source.

    ``start`` is the slot's first token in the source's repeated stream. The
    ranks of a source reach up to its target, whose last slot is cut to fit;
    a source too small for the points to meet gets its slots at the end.
    """
    quota = F.round("target").cast("long")
    shape = targets.where(quota > 0).agg(F.sum(quota).alias("all"), F.min(quota).alias("least")).first()
    total, least = shape["all"] or 0, shape["least"] or 1
    block = max(BLOCK_TOKENS[0], min(BLOCK_TOKENS[1], least // BLOCKS_EACH), -(-total // MAX_SLOTS))
    slots = -(-total // block)
    needed = F.ceil(quota / F.lit(block)).cast("long")
    # intervals of cumulative weight; the running sum is taken over bins of positions
    flat = materialize(targets.select("position", "target", quota.alias("quota"), needed.alias("needed"), F.expr("position div 1024").alias("bin")))
    sums = _cumulative(flat)
    intervals = materialize(sums.select("position", "quota", "needed", (F.col("lo") / F.lit(max(total, 1))).alias("lo"), ((F.col("lo") + F.col("quota")) / F.lit(max(total, 1))).alias("hi")))
    binned = intervals.where("quota > 0").withColumn("bin", F.explode(F.sequence(F.floor(F.col("lo") * _BINS), F.least(F.floor(F.col("hi") * _BINS), F.lit(_BINS - 1).cast("long")))))
    spark = targets.sparkSession
    extra = max(64, slots // 64)  # so that every source meets its last slot
    point = F.expr(f"(id + 0.5D) * {GOLDEN}D - floor((id + 0.5D) * {GOLDEN}D)")
    points = spark.range(slots + extra).select(F.col("id").alias("slot"), point.alias("u")).withColumn("bin", F.least(F.floor(F.col("u") * _BINS), F.lit(_BINS - 1).cast("long")))
    owned = points.join(binned, "bin").where("u >= lo AND u < hi").select("slot", "position", "needed", "quota", F.expr(f"slot div {_CHUNK}").alias("chunk"))
    counts = materialize(owned.groupBy("position", "chunk").agg(F.count("*").alias("n")))
    before = Window.partitionBy("position").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("position", "chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    inside = F.row_number().over(Window.partitionBy("position", "chunk").orderBy("slot")) - 1
    ranked = (
        owned.withColumn("inside", inside)
        .join(starts, ["position", "chunk"])
        .withColumn("rank", F.col("inside") + F.col("first"))
        .where("rank < needed")
        .select("slot", "position", "rank", "quota")
    )
    met = counts.groupBy("position").agg(F.sum("n").alias("met"))
    short = intervals.join(met, "position", "left").withColumn("met", F.coalesce("met", F.lit(0))).where("met < needed")
    added = short.select("position", "quota", F.explode(F.expr("sequence(met, needed - 1)")).alias("rank")).select(
        (F.lit(slots + extra) + F.col("rank")).alias("slot"), "position", "rank", "quota"
    )
    begin = F.col("rank") * F.lit(block)
    return ranked.unionByName(added).select(
        "slot", "position", "rank", begin.alias("start"), F.least(F.lit(block).cast("long"), F.col("quota") - begin).alias("tokens"), F.lit(block).cast("long").alias("block")
    )


def _cumulative(flat: DataFrame) -> DataFrame:
    """Exclusive running sum of quota by position, bins first."""
    totals = flat.groupBy("bin").agg(F.sum("quota").alias("t"))
    starts = totals.select("bin", F.coalesce(F.sum("t").over(Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("s"))
    inside = F.coalesce(F.sum("quota").over(Window.partitionBy("bin").orderBy("position").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return flat.withColumn("i", inside).join(starts, "bin").withColumn("lo", F.col("i") + F.col("s"))


def mix(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """(slot, row, doc_id, epoch, doc_start, tokens): the words each slot takes.

    A row is the part of one pass over one document that lies in the slot's
    block. Documents without words have none.
    """
    known = targets.select(F.col("source").alias("_s"), "position", "source_size", F.round("target").cast("long").alias("quota"))
    worded = sized.where("size > 0")
    placed = prefix_sum(worded, ["source"], "bucket", [F.col("h"), F.col("doc_id"), F.col("row")], "size", "begin")
    passes = (
        placed.join(known, placed["source"].eqNullSafe(known["_s"]))
        .where("begin < quota")
        .withColumn("epoch", F.explode(F.expr("sequence(0L, (quota - begin - 1) div source_size)")))
        .withColumn("from", F.col("epoch") * F.col("source_size") + F.col("begin"))
        .withColumn("to", F.least(F.col("from") + F.col("size"), F.col("quota")))
    )
    slots = schedule(targets)
    block = slots.select("block").limit(1).first()
    size = block[0] if block else 1
    parts = passes.withColumn("rank", F.explode(F.expr(f"sequence(from div {size}, (to - 1) div {size})")))
    taken = F.least(F.col("to"), F.col("start") + F.col("tokens")) - F.greatest(F.col("from"), F.col("start"))
    return parts.join(slots, ["position", "rank"]).select(
        "slot", "row", "doc_id", "epoch", (F.greatest(F.col("from"), F.col("start")) - F.col("from")).alias("doc_start"), taken.alias("tokens")
    )


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(doc_id, source, size, source_size, target, taken): one row per document.

    Null and empty texts have size 0 and are never taken; a null source is a
    source of its own; repeated rows are mixed as documents of their own; an
    empty table gives an empty result.
    """
    sized = with_words(docs, id_col, text_col, source_col)
    targets = source_targets(sized)
    taken = mix(sized, targets).groupBy("row").agg(F.sum("tokens").alias("taken"))
    named = targets.select(F.col("source").alias("_s"), "source_size", "target")
    out = sized.join(taken, "row", "left").join(named, F.col("source").eqNullSafe(F.col("_s")), "left")
    return out.select("doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def mixed_corpus(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``docs`` as the mix repeats them: each document round(taken / size) times.

    All columns stay. A document of which the mix takes less than half goes;
    one without words, which no weight counts, stays once.
    """
    plan = mixed_documents(docs, id_col, text_col, source_col)
    times = plan.groupBy(F.col("doc_id").alias("_doc")).agg(F.sum("taken").alias("_taken"), F.sum("size").alias("_all"))
    joined = packed(docs, _id=F.col(id_col).cast("long")).join(times, F.col("_id").eqNullSafe(F.col("_doc")), "left")
    copies = F.when(F.col("_all") > 0, F.round(F.col("_taken") / F.col("_all"))).otherwise(F.lit(1.0)).cast("int")
    return unpacked(joined.where(copies > 0).withColumn("_copy", F.explode(F.sequence(F.lit(1), copies))))
