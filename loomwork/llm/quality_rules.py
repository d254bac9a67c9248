"""Quality rules: repetition and length rules, then a log-likelihood ratio.

Words and word pairs are hashed to buckets. One multinomial is fitted on
trusted documents, one on the whole raw corpus; a document's ratio is the mean
log of their quotient over its features. Every document is decided by one
threshold, set below the ratios of trusted documents that were kept out of the
fit. DataFrame functions only.
"""

from __future__ import annotations

import itertools
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomwork.llm.common import materialize, packed, unpacked

BUCKETS = 1 << 15
SMOOTHING = 1.0
#: The threshold lies below the lowest hundredth of the ratios of trusted
#: documents outside the fit: by their distance to the median, and by this.
MARGIN = 0.04
#: Trusted ids that are broadcast, at most; more are joined by a shuffle.
BROADCAST_IDS = 2_000_000
#: Steps of a unit, and of such a step, by which ratios are counted for the threshold.
GRID = 1000
#: One of so many trusted documents sets the threshold, the others the multinomial.
CALIBRATE_EVERY = 5
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
SEED = 5

_SPACES = "[\\x20\\x09-\\x0D]+"


def words_of(text: Column) -> Column:
    """Words of a text as an array: split at ASCII white space, null as empty."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), _SPACES), "")


def feature_buckets(words: Column, buckets: int = BUCKETS) -> Column:
    """Hash buckets of the words and of the pairs of neighbours."""

    def place(*parts: Column) -> Column:
        return F.pmod(F.xxhash64(*parts), F.lit(buckets)).cast("int")

    def both(w: Column) -> Column:
        pairs = F.slice(F.transform(w, lambda x, i: place(x, F.get(w, i + 1))), F.lit(1), F.greatest(F.size(w) - 1, F.lit(0)))
        return F.concat(F.transform(w, lambda x: place(x)), pairs)

    return bind(words, both)


def repeated_words(words: Column) -> Column:
    """Words that lie in a 3-word window found twice or more in the text.

    Windows are told apart by 64-bit hashes. Their places are sorted by hash,
    so that equal ones are neighbours, and the places that remain are sorted
    again to count what they cover.
    """

    def windows(w: Column) -> Column:
        return F.slice(F.transform(w, lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2))), F.lit(1), F.size(w) - 2)

    def covered(hashes: Column) -> Column:
        placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        same = lambda a, b: F.coalesce(a["h"] == b["h"], F.lit(False))

        def places(rows: Column) -> Column:
            twice = F.filter(rows, lambda x, k: same(x, F.get(rows, k - 1)) | same(x, F.get(rows, k + 1)))
            return F.sort_array(F.transform(twice, lambda x: x["i"]))

        def count(starts: Column) -> Column:
            gaps = F.transform(starts, lambda s, k: F.least(F.lit(3), F.coalesce(F.get(starts, k + 1) - s, F.lit(3))))
            return F.aggregate(gaps, F.lit(0), lambda a, x: a + x)

        return bind(placed, places, count)

    def total(hashes: Column) -> Column:
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(covered(hashes))

    return F.when(F.size(words) < 4, F.lit(0)).otherwise(bind(words, windows, total))


def bind(value: Column, *steps) -> Column:
    """Apply steps one after another, each seeing its input as a bound variable.

    An expression that a lambda's body names is evaluated again for each
    element; a bound variable is evaluated once.
    """
    for step in steps:
        value = F.get(F.transform(F.array(value), step), F.lit(0))
    return value


def base_columns(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` plus _words and the six base columns."""
    t = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(t, "\n", -1), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    counted = docs.withColumn("_words", words_of(F.col(text))).withColumn("_lines", lines)
    measured = counted.withColumns(
        {
            "n_words": F.size("_words").cast("long"),
            "word_chars": F.length(F.regexp_replace(t, _SPACES, "")).cast("long"),
            "n_symbols": F.length(F.regexp_replace(t, "[^#*$%&|<>]+", "")).cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "n_repeat_words": repeated_words(F.col("_words")).cast("long"),
        }
    ).drop("_lines")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))
    return measured.withColumn("base_failed", failed)


def chosen_ids(trusted: DataFrame) -> DataFrame:
    """(id, fits): the distinct ids of the first column, and their part."""
    ids = trusted.select(F.col(trusted.columns[0]).cast("long").alias("_id")).where("_id IS NOT NULL").distinct()
    spread = F.xxhash64(F.lit(SEED), "_id")
    return materialize(ids.select("_id", (F.pmod(spread, F.lit(CALIBRATE_EVERY)) != 0).alias("_fits")))


def small(ids: DataFrame) -> DataFrame:
    """``ids``, marked for a broadcast if they are few enough."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def quantiles(ratios: DataFrame, shares: list[float]) -> list[float] | None:
    """Interpolated quantiles of the column ``ratio``, to a millionth; None without a value.

    Counts on a grid of thousandths tell in which cells the wanted ranks lie,
    counts of millionths within those cells give the values: some ten thousand
    rows however many ratios there are, and reruns agree.
    """
    fine = F.round(F.col("ratio") * (GRID * GRID)).cast("long")
    placed = ratios.where("ratio IS NOT NULL").select(fine.alias("fine")).withColumn("cell", F.floor(F.col("fine") / GRID))
    cells = sorted((r["cell"], r["n"]) for r in placed.groupBy("cell").agg(F.count("*").alias("n")).collect())
    total = sum(n for _, n in cells)
    if not total:
        return None
    ranks = [share * (total - 1) for share in shares]
    wanted = sorted({r for rank in ranks for r in (math.floor(rank), math.ceil(rank))})
    begins = dict(zip((c for c, _ in cells), itertools.accumulate((n for _, n in cells), initial=0)))
    inside = {rank: max((c for c in begins if begins[c] <= rank), key=begins.get) for rank in wanted}
    steps = sorted((r["fine"], r["cell"], r["n"]) for r in placed.where(F.col("cell").isin(sorted(set(inside.values())))).groupBy("fine", "cell").agg(F.count("*").alias("n")).collect())

    def value(rank: int) -> float:
        seen = begins[inside[rank]]
        for step, cell, n in steps:
            if cell == inside[rank]:
                seen += n
                if seen > rank:
                    return step / (GRID * GRID)
        raise AssertionError("a rank lies within its cell")

    return [value(math.floor(r)) + (r - math.floor(r)) * (value(math.ceil(r)) - value(math.floor(r))) for r in ranks]


def bucket_weights(rows: DataFrame, chosen: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, weight): log of the trusted over the raw share, smoothed.

    ``rows`` is (_doc, _text); every bucket has a row in the result.
    """
    fit = small(chosen.where("_fits").select("_id"))
    marked = rows.join(fit, F.col("_doc") == F.col("_id"), "left")
    flagged = marked.select("_id", F.explode(feature_buckets(words_of(F.col("_text")), buckets)).alias("bucket"))
    known = materialize(flagged.groupBy("bucket").agg(F.count("*").alias("raw"), F.count("_id").alias("good")))
    totals = known.agg(F.coalesce(F.sum("raw"), F.lit(0)).alias("raw"), F.coalesce(F.sum("good"), F.lit(0)).alias("good")).first()
    every = rows.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    filled = every.join(known, "bucket", "left").na.fill(0, ["raw", "good"])
    share = lambda c, n: (F.col(c) + F.lit(SMOOTHING)) / F.lit(float(n) + SMOOTHING * buckets)
    weight = F.log(share("good", totals["good"]) / share("raw", totals["raw"])) if totals["good"] else F.lit(0.0)
    return materialize(filled.select("bucket", weight.cast("float").alias("weight")))


def fit_rules(docs: DataFrame, trusted: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, float]:
    """(weights, threshold) over all documents and all trusted ones; without trusted documents outside the fit the threshold keeps all."""
    rows = docs.select(F.col(id_col).cast("long").alias("_doc"), F.col(text_col).alias("_text"))
    chosen = chosen_ids(trusted)
    weights = bucket_weights(rows, chosen)
    others = small(chosen.where("NOT _fits").select("_id"))
    apart = rows.join(others, F.col("_doc") == F.col("_id")).select("_text")
    ratio = F.when(~F.col("base_failed"), F.col("llr")).alias("ratio")  # no filter, which would be pushed below the join
    found = quantiles(materialize(judged(apart, weights, "_text", 0.0).select(ratio)), [0.01, 0.5])
    return weights, float("-inf") if found is None else 2 * found[0] - found[1] - MARGIN


def weight_table(weights: DataFrame) -> Column:
    """The weights in bucket order, one number a bucket, as a scalar subquery."""
    ordered = F.sort_array(F.collect_list(F.struct("bucket", "weight")))
    return weights.agg(F.transform(ordered, lambda x: x["weight"]).alias("w")).scalar()


def mean_weight(buckets: Column, table: Column) -> Column:
    """Mean weight of a document's features; 0 without any."""

    def mean(found: Column) -> Column:
        return bind(table, lambda w: F.aggregate(found, F.lit(0.0), lambda acc, b: acc + F.get(w, b).cast("double")) / F.nullif(F.size(found), F.lit(0)))

    return F.coalesce(bind(buckets, mean), F.lit(0.0))


def judged(rows: DataFrame, weights: DataFrame, text: str, threshold: float) -> DataFrame:
    """``rows`` plus the base columns, llr and kept; no row moves.

    The ratio of what fails the base rules is not computed and is 0.
    """
    # the analyzer wants it as a column of its own; its size is fixed
    based = base_columns(rows, text).withColumn("_weights", weight_table(weights))
    llr = F.when(F.col("base_failed"), F.lit(0.0)).otherwise(mean_weight(feature_buckets(F.col("_words")), F.col("_weights")))
    scored = based.withColumn("llr", llr).drop("_words", "_weights")
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("llr") >= F.lit(threshold)))


def quality_verdicts(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, base columns, llr, kept): one row per row of ``docs``.

    ``trusted`` has ids in its first column; repeats and nulls are allowed. A
    null or empty text has no words and fails the base rules. The ratio of
    what fails them is 0, as is every ratio if there are no trusted documents.
    Repeated rows and null ids are decided one by one.
    """
    weights, threshold = fit_rules(docs, trusted, id_col, text_col)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("_text"))
    return judged(rows, weights, "_text", threshold).drop("_text")


def kept_documents(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that the rules reject, all columns kept."""
    weights, threshold = fit_rules(docs, trusted, id_col, text_col)
    # the row number keeps the filter above the verdict, which it would otherwise repeat
    decided = judged(packed(docs, _text=F.col(text_col)), weights, "_text", threshold).withColumn("_row", F.monotonically_increasing_id())
    return unpacked(decided.where("kept AND _row >= 0"))


def trusted_ids(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Ids of the documents labelled good and not toxic."""
    return labels.where("quality = 1 AND coalesce(toxic, 0) = 0").select(id_col)
