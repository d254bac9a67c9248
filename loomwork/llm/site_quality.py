"""Quality classifier with hierarchical empirical Bayes over sites.

Evidence of a document: the probability of a ridge logistic regression over
hashed words and style bins. Hosts and paths get posterior rates from grouped
sums of that evidence over all documents, a label standing in for it where one
is known; sparse paths shrink towards their host, sparse hosts towards the
global rate. A document's score joins its evidence with the rate of the rest
of its path.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomwork.llm.common import map_arrow, materialize

WORD_BUCKETS = 1 << 16
#: Style bins, after the word buckets.
STYLES = 6
STYLE_BINS = 32
#: Labelled documents that the evidence is fitted on, at most: those of the smallest id hashes.
LABELLED_SAMPLE = 20_000
#: A feature counts if so many distinct sampled documents have it.
MIN_DOCS = 10
RIDGE = 1.0
ROUNDS = 150
THRESHOLD = 0.5
#: Bounds of the pseudo-counts that the data choose for hosts and paths.
PSEUDO = (2.0, 200.0)
SEED = 23
_EDGE = 1e-4
_FEATURES = WORD_BUCKETS + STYLES * STYLE_BINS

_UPPER, _LOWER = bytes(range(65, 91)), bytes(range(97, 123))
_DIGITS, _MARKS = b"0123456789", b"!#*$%&|<>@^~_=+{}[]\\"


def features(text: str | None) -> np.ndarray:
    """Distinct feature numbers of a text, ascending; empty without a word."""
    raw = (text or "").encode()
    words = raw.lower().split()
    if not words:
        return np.zeros(0, dtype=np.int64)
    kinds = set(words)
    size = len(raw)
    share = lambda chars: (size - len(raw.translate(None, chars))) / size
    upper, lower = share(_UPPER), share(_LOWER)
    style = (
        upper / (upper + lower + 1e-9),
        min(1.0, 4 * share(_MARKS)),
        min(1.0, 4 * share(_DIGITS)),
        len(kinds) / len(words),
        min(1.0, np.log2(len(words)) / 16),
        min(1.0, size / len(words) / 24),
    )
    bins = [WORD_BUCKETS + k * STYLE_BINS + min(STYLE_BINS - 1, int(v * STYLE_BINS)) for k, v in enumerate(style)]
    # edges of words off, so that "idiot," meets "idiot"
    hashed = [zlib.crc32(w.strip(b".,;:?\"'()-")) % WORD_BUCKETS for w in kinds]
    return np.unique(np.array(hashed + bins, dtype=np.int64))


@dataclass
class Evidence:
    """Weights by feature and the shift of their sum."""

    weights: np.ndarray
    shift: float = 0.0

    def probability(self, texts: list[str | None]) -> np.ndarray:
        total = np.array([self.weights[features(t)].sum() for t in texts], dtype=np.float64)
        return 1 / (1 + np.exp(-np.clip(total + self.shift, -30, 30)))


def copy_weights(rows: list[np.ndarray]) -> np.ndarray:
    """One over the number of rows that share a row's sketch, so that copies count as one."""
    sketches = [tuple(np.sort((r * 2654435761) % (1 << 32))[:4].tolist()) for r in rows]
    times: dict[tuple, int] = {}
    for s in sketches:
        times[s] = times.get(s, 0) + 1
    return np.array([1 / times[s] for s in sketches])


def fit_logistic(rows: list[np.ndarray], label: np.ndarray, ridge: float = RIDGE, rounds: int = ROUNDS) -> tuple[np.ndarray, float]:
    """Ridge logistic regression over present features, copies down-weighted.

    Features of fewer than MIN_DOCS distinct documents stay at 0. Adam on the
    full gradient: the sample is small and the result does not depend on order.
    """
    weight = copy_weights(rows)
    size = np.array([len(r) for r in rows])
    flat = np.concatenate([*rows, np.zeros(0, dtype=np.int64)]).astype(np.int64)
    doc = np.repeat(np.arange(len(rows)), size)
    frequency = np.bincount(flat, weights=weight[doc], minlength=_FEATURES)
    kept = frequency[flat] >= MIN_DOCS
    names, at = np.unique(flat[kept], return_inverse=True)
    doc, n = doc[kept], len(names)
    theta, shift = np.zeros(n), 0.0
    first, second = np.zeros(n + 1), np.zeros(n + 1)
    for step in range(1, rounds + 1):
        z = np.bincount(doc, weights=theta[at], minlength=len(rows)) + shift
        error = weight * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - label)
        gradient = np.r_[np.bincount(at, weights=error[doc], minlength=n) + ridge * theta, error.sum()]
        first = 0.9 * first + 0.1 * gradient
        second = 0.99 * second + 0.01 * gradient**2
        move = 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-9)
        theta, shift = theta - move[:-1], shift - move[-1]
    out = np.zeros(_FEATURES)
    out[names] = theta
    return out, float(shift)


def fit_evidence(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, sample: int = LABELLED_SAMPLE) -> Evidence | None:
    """Evidence from a bounded sample of labelled documents; None without both classes.

    ``labels`` has _id and _good. The driver gets the feature numbers of the
    sampled documents, at most ``sample`` of them.
    """
    chosen = materialize(labels.orderBy(F.xxhash64(F.lit(SEED), "_id"), "_id").limit(sample))
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = texts.join(F.broadcast(chosen), F.col("doc_id") == F.col("_id")).select("doc_id", "_good", "text")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(t.as_py()).astype(np.int32).tobytes() for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.binary())], ["id", "good", "f"])

    drawn = sorted((r["id"], bytes(r["f"]), r["good"]) for r in map_arrow(rows, encode, "id long, good boolean, f binary").collect())
    label = np.array([good for _, _, good in drawn], dtype=np.float64)
    if not len(label) or label.min() == label.max():
        return None
    return Evidence(*fit_logistic([np.frombuffer(f, dtype=np.int32).astype(np.int64) for _, f, _ in drawn], label))


def logit(p: Column) -> Column:
    bounded = F.least(F.greatest(p, F.lit(_EDGE)), F.lit(1 - _EDGE))
    return F.log(bounded / (1 - bounded))


def _pseudo(groups: DataFrame, prior: str) -> float:
    """Pseudo-count by the method of moments: within over between variance of the groups' rates."""
    rate = F.col("s") / F.col("n")
    row = groups.where("n > 1").agg(
        F.sum("n").alias("n"),
        F.sum(F.col("n") * F.pow(rate - F.col(prior), 2)).alias("between"),
        F.sum(F.col("q") - F.col("n") * rate * rate).alias("within"),
        F.count("*").alias("k"),
        F.sum(F.col("n").cast("double") * F.col("n")).alias("nn"),
    ).first()
    if not row["n"] or row["k"] < 2 or row["n"] <= row["k"]:
        return PSEUDO[0]
    within = max(float(row["within"]), 1e-9) / (row["n"] - row["k"])
    spread = row["n"] - row["nn"] / row["n"]
    between = (float(row["between"]) - (row["k"] - 1) * within) / max(spread, 1.0)
    return float(min(PSEUDO[1], max(PSEUDO[0], within / between))) if between > 0 else PSEUDO[1]


def classify_sites(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    host: Column | None = None,
    path: Column | None = None,
    sample: int = LABELLED_SAMPLE,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """(doc_id, doc_score, host_rate, path_rate, score, kept) of every row.

    ``labels`` has the id, quality and toxic; a document counts as good if its
    quality is 1 and toxic is not, a repeated label counts if any is bad, a
    null quality is no label. Host defaults to the column source, path to
    source and lang; nulls are a site of their own. Null or empty texts have
    the evidence of the shift alone. Without labels of both classes the
    evidence is 0.5 for all. Repeated rows are scored one by one.
    """
    host = F.col("source") if host is None else host
    path = F.struct(F.col("source"), F.col("lang")) if path is None else path
    known = labels.where("quality IS NOT NULL").groupBy(F.col(labels.columns[0]).cast("long").alias("_id"))
    known = known.agg(F.min((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)).alias("_good")).where("_id IS NOT NULL")
    evidence = fit_evidence(docs, known, id_col, text_col, sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            p = evidence.probability(batch.column(3).to_pylist()) if evidence else np.full(n, 0.5)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(p, pa.float64())], ["doc_id", "host", "path", "p"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), host.cast("string").alias("host"), F.to_json(F.struct(path.alias("p"))).alias("path"), F.col(text_col).alias("text"))
    scored = materialize(map_arrow(rows, run, "doc_id long, host string, path string, p double"))
    held = materialize(
        scored.join(known, F.col("doc_id") == F.col("_id"), "left").select("doc_id", "host", "path", "p", F.coalesce(F.col("_good").cast("double"), F.col("p")).alias("e"))
    )
    whole = held.agg(F.avg("e").alias("rate")).first()
    rate = float(whole["rate"]) if whole["rate"] is not None else 0.5
    paths = held.groupBy("host", "path").agg(F.sum("e").alias("s"), F.sum(F.col("e") * F.col("e")).alias("q"), F.count("*").alias("n"))
    paths = materialize(paths)
    hosts = paths.groupBy("host").agg(F.sum("s").alias("s"), F.sum("q").alias("q"), F.sum("n").alias("n"))
    k_host = _pseudo(hosts.withColumn("prior", F.lit(rate)), "prior")
    hosts = materialize(hosts.withColumn("host_rate", (F.col("s") + F.lit(k_host * rate)) / (F.col("n") + F.lit(k_host))))
    nested = materialize(paths.join(hosts.select(F.col("host").alias("_h"), "host_rate"), F.col("host").eqNullSafe(F.col("_h"))).drop("_h"))
    k_path = _pseudo(nested, "host_rate")
    sites = nested.withColumn("path_rate", (F.col("s") + F.lit(k_path) * F.col("host_rate")) / (F.col("n") + F.lit(k_path)))
    sites = sites.select(F.col("host").alias("_h"), F.col("path").alias("_p"), "host_rate", "path_rate", "s", "n")
    joined = held.join(sites, F.col("host").eqNullSafe(F.col("_h")) & F.col("path").eqNullSafe(F.col("_p")))
    rest = (F.col("s") - F.col("e") + F.lit(k_path) * F.col("host_rate")) / (F.col("n") - 1 + F.lit(k_path))
    total = logit(F.col("p")) + logit(rest) - logit(F.lit(rate))
    score = 1 / (1 + F.exp(-total))
    return joined.select("doc_id", F.col("p").alias("doc_score"), "host_rate", "path_rate", score.alias("score"), (score >= F.lit(threshold)).alias("kept"))
