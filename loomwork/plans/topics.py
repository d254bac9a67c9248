"""Topic classification by tf-idf cosine.

Terms are words of letters, stop words and words under three letters left out,
and pairs of neighbours among what remains. A vocabulary of the most frequent
terms is found in two counting passes that never move a text; the topics, few
and known, go to every task as lists by term, and each document is scored where
it lies. Lemmas, which need a language model, are not taken.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwork.plans.enrich import best_topic, every_topic, weigh

LETTERS = regex.compile(r"\p{L}+")
FEATURES = 10_000
#: Words that pairs may be made of, at most, for the set to be sent to the tasks.
PAIR_WORDS = 200_000
#: Weights of all topics, at most, for the matrix to be sent to the tasks.
MATRIX = 20_000_000
_HELD = 400_000

# English words that carry no topic.
STOP_WORDS = frozenset(
    """about above after again against all also although always among and another any anybody anyone anything are around because been before behind being
    below between both but can cannot could did does doing done down during each either else enough etc even ever every few for from further had has have
    having hence her here hers herself him himself his how however into its itself just less made many may might mine more most much must myself neither
    never next nobody none nor not nothing now off often once one only onto other others our ours ourselves out over own per perhaps rather same several
    she should since some something still such than that the their theirs them themselves then there therefore these they this those though through thus
    together too toward towards under until upon very was well were what whatever when whenever where whether which while who whole whom whose why will
    with within without would yet you your yours yourself""".split()
)


def words_of(lowered: str) -> list[str]:
    """The words that count, in order, of a text in lower case."""
    return [w for w in LETTERS.findall(lowered) if len(w) > 2 and w not in STOP_WORDS]


def terms_of(lowered: str) -> list[str]:
    """Words and pairs of neighbouring words."""
    words = words_of(lowered)
    return words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def _term_counts(docs: DataFrame, text: str, terms: Callable[[str], list[str]]) -> DataFrame:
    """(token, df, total): in how many rows a term is, and how often; summed within tasks first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, total = Counter(), Counter()
        for batch in batches:
            for value in batch.column(0).to_pylist():
                if value:
                    own = Counter(terms(value))
                    total.update(own)
                    df.update(own.keys())
            if len(df) > _HELD:
                yield flush(df, total)
                df, total = Counter(), Counter()
        yield flush(df, total)

    def flush(df: Counter, total: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(df), pa.string()), pa.array(list(df.values()), pa.int64()), pa.array([total[t] for t in df], pa.int64())], ["token", "df", "total"])

    partial = docs.select(F.lower(F.col(text)).alias("text")).mapInArrow(run, "token string, df long, total long")
    return partial.groupBy("token").agg(F.sum("df").alias("df"), F.sum("total").alias("total"))


def vocabulary(docs: DataFrame, text: str, n_docs: int, min_df: int = 2, max_df: float = 0.8, features: int = FEATURES) -> dict[str, float]:
    """idf by term, ln((1 + n) / (1 + df)) + 1: the ``features`` most frequent terms in the bounds of df, ties by term.

    A pair is never more frequent than either of its words, so once the
    ``features`` best words are known, pairs of rarer words need no counting.
    That set of words is sent to the tasks while it is small; on small tables,
    where the last place is low and the set could be large, all pairs are counted.
    """
    usable = (F.col("df") >= min_df) & (F.col("df") <= F.lit(max_df * n_docs))
    best = lambda counts: [(r["token"], r["df"], r["total"]) for r in counts.where(usable).orderBy(F.desc("total"), "token").limit(features).collect()]
    words = _term_counts(docs, text, words_of).persist()
    try:
        top = best(words)
        least = top[-1][2] if len(top) == features else 0
        frequent = words.where((F.col("df") >= min_df) & (F.col("total") >= least)).select("token").limit(PAIR_WORDS + 1).collect()
    finally:
        words.unpersist()
    known = frozenset(r[0] for r in frequent) if len(frequent) <= PAIR_WORDS else None

    def pairs(lowered: str) -> list[str]:
        found = words_of(lowered)
        return [f"{a} {b}" for a, b in zip(found, found[1:]) if known is None or (a in known and b in known)]

    both = sorted(top + best(_term_counts(docs, text, pairs)), key=lambda t: (-t[2], t[0]))[:features]
    return {token: math.log((1.0 + n_docs) / (1 + df)) + 1 for token, df, _ in both}


@dataclass(frozen=True)
class Topics:
    """Topic ids ascending; for each term its idf, the places of the topics that have it and their weights."""

    ids: list
    idf: dict[str, float]
    lists: dict[str, tuple[np.ndarray, np.ndarray]]

    def classify(self, lowered: str | None) -> tuple[object, float]:
        """(topic, cosine), ties to the smallest topic; (-1, 0) if no topic shares a known term."""
        counts = Counter(t for t in terms_of(lowered or "") if t in self.idf)
        found = [(n * self.idf[t], *self.lists[t]) for t, n in counts.items() if t in self.lists]
        if not found:
            return -1, 0.0
        norm = math.sqrt(sum((n * self.idf[t]) ** 2 for t, n in counts.items()))
        dots = np.bincount(np.concatenate([p for _, p, _ in found]), np.concatenate([x / norm * w for x, _, w in found]), len(self.ids))
        dots = np.round(dots, 9)
        at = int(dots.argmax())
        return (self.ids[at], float(dots[at])) if dots[at] > 0 else (-1, 0.0)


def topic_matrix(topics: list[tuple[object, str]], idf: dict[str, float]) -> Topics:
    """Normalised weights of (id, lower-case text) rows; texts of one id are one topic."""
    texts: dict[object, Counter] = {}
    for key, lowered in topics:
        texts.setdefault(key, Counter()).update(t for t in terms_of(lowered or "") if t in idf)
    ids = sorted(texts)
    lists: dict[str, tuple[list[int], list[float]]] = {}
    for place, key in enumerate(ids):
        norm = math.sqrt(sum((n * idf[t]) ** 2 for t, n in texts[key].items()))
        for t, n in texts[key].items():
            at, weight = lists.setdefault(t, ([], []))
            at.append(place)
            weight.append(n * idf[t] / norm)
    return Topics(ids, idf, {t: (np.array(a, dtype=np.int64), np.array(w)) for t, (a, w) in lists.items()})


def classify(docs: DataFrame, id_col: str, text_col: str, topics: DataFrame, topic_id: str, topic_text: str, features: int = FEATURES) -> DataFrame:
    """(id, topic_id, score) of every row: the topic of the highest tf-idf cosine, -1 and 0 without one.

    Topic texts of up to MATRIX terms go to the tasks whole; a larger
    taxonomy is joined by term instead. Topic ids are longs.
    """
    idf = vocabulary(docs, text_col, docs.count(), features=features)
    rows = docs.select(F.col(id_col).alias("id"), F.lower(F.col(text_col)).alias("text"))
    named = topics.select(F.col(topic_id).cast("long").alias("topic_id"), F.lower(F.col(topic_text)).alias("text")).where("topic_id IS NOT NULL")
    size = named.agg(F.sum(F.length("text"))).first()[0] or 0
    if size > MATRIX:
        return _joined(rows, named, idf)
    matrix = docs.sparkSession.sparkContext.broadcast(topic_matrix([tuple(r) for r in named.collect()], idf))  # at most MATRIX characters
    kind = rows.schema["id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [matrix.value.classify(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.float64())], ["id", "topic_id", "score"])

    return rows.mapInArrow(run, f"id {kind.simpleString()}, topic_id long, score double")


#: Numbers of the centroids that one pass sends to the tasks.
CENTROID_NUMBERS = 4_000_000


def nearest_centroid(vectors: DataFrame, id_col: str, vector_col: str, centroids: DataFrame) -> DataFrame:
    """(id, label): the centroid of the highest cosine, to nine places, ties to the smallest label.

    ``centroids`` is (label long, c array<double>). They go to the tasks in passes
    of CENTROID_NUMBERS numbers; each pass scores every vector where it lies,
    and the best of the passes is taken, so any number of labels is answered.
    """
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("e"))
    kind = rows.schema["id"].dataType.simpleString()
    numbers = centroids.agg(F.sum(F.size("c"))).first()[0] or 0
    passes = max(1, math.ceil(numbers / CENTROID_NUMBERS))
    out = None
    for k in range(passes):
        part = centroids.where(F.pmod(F.xxhash64("label"), F.lit(passes)) == k).orderBy("label").collect()  # about CENTROID_NUMBERS numbers
        if not part:
            continue
        labels, matrix = np.array([r["label"] for r in part], dtype=np.int64), np.array([r["c"] for r in part])
        shared = vectors.sparkSession.sparkContext.broadcast((labels, matrix / np.linalg.norm(matrix, axis=1, keepdims=True)))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            names, units = shared.value
            for batch in batches:
                e = np.array(batch.column(1).to_pylist(), dtype=np.float64).reshape(batch.num_rows, -1)
                cosine = np.round(e @ units.T / np.linalg.norm(e, axis=1, keepdims=True), 9) if batch.num_rows else np.zeros((0, len(names)))
                best = cosine.argmax(axis=1) if batch.num_rows else np.zeros(0, dtype=int)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names[best]), pa.array(cosine[np.arange(len(best)), best])], ["id", "label", "cosine"])

        scored = rows.mapInArrow(run, f"id {kind}, label long, cosine double")
        out = scored if out is None else out.unionByName(scored)
    if out is None or passes == 1:
        return (out if out is not None else rows.select("id", F.lit(None).cast("long").alias("label"))).select("id", "label")
    return out.groupBy("id").agg(F.max_by("label", F.struct("cosine", -F.col("label"))).alias("label"))


def _joined(rows: DataFrame, named: DataFrame, idf: dict[str, float]) -> DataFrame:
    """The same by joins on the term, for a taxonomy beyond a task's memory."""
    known = rows.sparkSession.createDataFrame(list(idf.items()), "token string, idf double")

    def counts(frame: DataFrame) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                own = [Counter(t for t in terms_of(v or "") if t in idf) for v in batch.column(1).to_pylist()]
                at = pa.array(np.repeat(np.arange(len(own)), [len(c) for c in own]))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(at), pa.array([t for c in own for t in c], pa.string()), pa.array([n for c in own for n in c.values()], pa.int64())], ["id", "token", "tf"])

        kind = frame.schema["id"].dataType.simpleString()
        return frame.select("id", "text").mapInArrow(run, f"id {kind}, token string, tf long").groupBy("id", "token").agg(F.sum("tf").alias("tf"))

    topics = weigh(counts(named.withColumnRenamed("topic_id", "id")), known)
    best = best_topic(weigh(counts(rows), known), topics).where("score > 0")
    return every_topic(rows, best)
