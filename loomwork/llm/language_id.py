"""Language ID with interpolated Kneser-Ney character models.

One character n-gram model a language. All models lie in sorted hash arrays
shared by the languages: for each n-gram that some language has seen, the log
probability under every language, back-off included; for each context, the
log weight of the back-off. A text gets the language of the lowest
cross-entropy per character; calibration on held-out training texts says from
which cross-entropy on a text is rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomwork.llm.common import map_arrow, materialize, packed

ORDER = 4
#: Training texts of a language, at most: those of the smallest id hashes.
SAMPLE_PER_LANGUAGE = 800
#: Characters of the training texts of all languages together, at most; a
#: language has an equal share, and its first text whatever its length.
SAMPLE_CHARS = 64_000_000
#: Every so many training texts one calibrates instead of being counted.
CALIBRATE_EVERY = 5
#: Rejected: cross-entropy above the calibration's mean by so many standard
#: errors of a text of its length, plus so many nats.
REJECT_ERRORS = 6.0
REJECT_NATS = 1.0
SEED = 11
_SPACE = 32
_SMALL = 1e-12

_letters: np.ndarray | None = None


def letter_table() -> np.ndarray:
    """True at the code points that are letters."""
    global _letters
    if _letters is None:
        _letters = np.fromiter((not 0xD800 <= i < 0xE000 and chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)
    return _letters


def symbols(text: str) -> np.ndarray:
    """Lower-case letters as 16-bit symbols, other runs as one space, one at each end."""
    codes = np.frombuffer(f" {text.lower()} ".encode("utf-32-le"), dtype=np.uint32)
    letter = letter_table()[codes]
    keep = letter.copy()
    keep[0] = True
    keep[1:] |= letter[:-1]
    folded = (codes ^ (codes >> 16)) & 0xFFFF
    folded[folded == _SPACE] = _SPACE + 1  # no letter folds to the space
    return np.where(letter, folded, _SPACE)[keep].astype(np.uint64)


def grams(stream: np.ndarray, n: int) -> np.ndarray:
    """Keys of the n-grams that end at positions n-1 and later."""
    key = np.zeros(max(0, len(stream) - n + 1), dtype=np.uint64)
    for i in range(n):
        key = (key << np.uint64(16)) | stream[i : i + len(key)]
    return key


def _tail(key: np.ndarray, n: int) -> np.ndarray:
    return key & np.uint64((1 << 16 * n) - 1)


@dataclass
class _One:
    """One language's counts: by order, n-grams ascending with their counts."""

    keys: list[np.ndarray]
    counts: list[np.ndarray]
    discount: list[float]


def _count(streams: list[np.ndarray], order: int) -> _One:
    keys, counts, discount = [np.zeros(0, dtype=np.uint64)] * order, [np.zeros(0, dtype=np.int64)] * order, [0.5] * order
    for n in range(order, 0, -1):
        if n == order:
            found = np.concatenate([grams(s, n) for s in streams] or [np.zeros(0, dtype=np.uint64)])
        else:  # continuation counts: in how many distinct contexts
            found = _tail(keys[n], n)
        keys[n - 1], counts[n - 1] = np.unique(found, return_counts=True)
        once, twice = int((counts[n - 1] == 1).sum()), int((counts[n - 1] == 2).sum())
        discount[n - 1] = min(0.95, max(0.1, once / (once + 2 * twice))) if once else 0.5
    return _One(keys, counts, discount)


def _find(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, whether there) of keys in a sorted array."""
    if not len(table):
        return np.zeros(len(keys), dtype=np.int64), np.zeros(len(keys), dtype=bool)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return at, table[at] == keys


@dataclass
class Models:
    """``log_p[n]``: rows beside ``keys[n]``; ``back[n]``: beside ``contexts[n]``."""

    languages: list[str]
    order: int
    keys: list[np.ndarray]
    log_p: list[np.ndarray]
    contexts: list[np.ndarray]
    back: list[np.ndarray]
    floor: float
    mean: np.ndarray | None = None
    deviation: np.ndarray | None = None

    def surprisal(self, key: np.ndarray, n: int | None = None) -> np.ndarray:
        """-log p of the last character of each n-gram: a row a key, a column a language."""
        n = self.order if n is None else n
        if n == 0:
            return np.full((len(key), len(self.languages)), -self.floor, dtype=np.float32)
        at, there = _find(self.keys[n - 1], key)
        out = -self.log_p[n - 1][at] if len(self.keys[n - 1]) else np.zeros((len(key), len(self.languages)), dtype=np.float32)
        missing = np.flatnonzero(~there)
        if len(missing):
            lower = self.surprisal(_tail(key[missing], n - 1), n - 1)
            at, there = _find(self.contexts[n - 1], key[missing] >> np.uint64(16))
            if len(self.contexts[n - 1]):
                lower = lower - np.where(there[:, None], self.back[n - 1][at], np.float32(0))
            out[missing] = lower
        return out

    def cross_entropies(self, streams: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """(nats per character by text and language, characters by text)."""
        pad = np.full(self.order - 2, _SPACE, dtype=np.uint64)
        padded = [np.concatenate([pad, s]) for s in streams]
        n_chars = np.array([max(1, len(s) - self.order + 1) for s in padded])
        total = np.zeros((len(streams), len(self.languages)))
        group: list[int] = []
        room = 0
        for i, s in enumerate(padded):
            group.append(i)
            room += len(s)
            if room > 400_000 or i + 1 == len(padded):
                keys = [grams(padded[k], self.order) for k in group]
                seen = self.surprisal(np.concatenate(keys))
                begin = np.r_[0, np.cumsum([len(k) for k in keys])[:-1]]
                total[group] = np.add.reduceat(seen, begin, axis=0, dtype=np.float64)
                group, room = [], 0
        return total / n_chars[:, None], n_chars

    def predict(self, streams: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(index of the language, confidence 0..1, rejected) of texts that have a letter."""
        entropy, n = self.cross_entropies(streams)
        best = entropy.argmin(axis=1)
        odds = np.exp(np.maximum(-np.minimum(n, 200)[:, None] * (entropy - entropy.min(axis=1, keepdims=True)), -60))
        score = 1 / odds.sum(axis=1)
        limit = self.mean[best] + REJECT_ERRORS * self.deviation[best] / np.sqrt(n) + REJECT_NATS
        return best, score, entropy.min(axis=1) > limit


def train(texts: dict[str, list[str]], order: int = ORDER) -> Models:
    """Models of the languages named by the keys; languages in sorted order."""
    languages = sorted(texts)
    pad = np.full(order - 2, _SPACE, dtype=np.uint64)
    held: list[list[np.ndarray]] = []
    ones: list[_One] = []
    for lang in languages:  # one language's symbols in memory at a time
        enough = len(texts[lang]) >= 2 * CALIBRATE_EVERY
        held.append([symbols(t) for t in texts[lang][:: CALIBRATE_EVERY if enough else 1]])
        fit = [t for i, t in enumerate(texts[lang]) if i % CALIBRATE_EVERY or not enough]
        ones.append(_count([np.concatenate([pad, symbols(t)]) for t in fit], order))
    alphabet = np.unique(np.concatenate([o.keys[0] for o in ones] or [np.zeros(0, dtype=np.uint64)]))
    floor = -float(np.log(len(alphabet) + 1))
    models = Models(languages, order, [], [], [], [], floor)
    for n in range(1, order + 1):
        union = np.unique(np.concatenate([o.keys[n - 1] for o in ones]))
        parents = np.unique(np.concatenate([o.keys[n - 1] >> np.uint64(16) for o in ones]))
        back = np.zeros((len(parents), len(ones)), dtype=np.float32)
        log_p = np.zeros((len(union), len(ones)), dtype=np.float32)
        lower = -models.surprisal(_tail(union, n - 1), n - 1) if len(union) else log_p
        for k, one in enumerate(ones):
            keys, counts, d = one.keys[n - 1], one.counts[n - 1], one.discount[n - 1]
            if not len(keys):
                log_p[:, k] = lower[:, k]
                continue
            own, which, kinds = np.unique(keys >> np.uint64(16), return_inverse=True, return_counts=True)
            totals = np.bincount(which, weights=counts)
            weight = d * kinds / totals
            at, _ = _find(parents, own)
            back[at, k] = np.log(weight)
            at, there = _find(own, union >> np.uint64(16))
            seen_at, seen = _find(keys, union)
            share = np.where(seen, np.maximum(counts[seen_at] - d, 0) / totals[at], 0.0)
            mixed = share + weight[at] * np.exp(lower[:, k])
            log_p[:, k] = np.where(there, np.log(np.maximum(mixed, _SMALL)), lower[:, k])
        models.keys.append(union)
        models.log_p.append(log_p)
        models.contexts.append(parents)
        models.back.append(back)
    models.mean, models.deviation = np.zeros(len(languages)), np.ones(len(languages))
    for k, streams in enumerate(held):
        streams = [s for s in streams if len(s) > 2]
        if streams:
            entropy, n = models.cross_entropies(streams)
            models.mean[k] = np.average(entropy[:, k], weights=n)
            models.deviation[k] = max(1.0, float(np.sqrt(np.average((entropy[:, k] - models.mean[k]) ** 2 * n, weights=n))))
    return models


def held_out(id_col: str = "doc_id"):
    """Column: crc32 of the id as text leaves 2 modulo 4."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def training_texts(docs: DataFrame, id_col: str, text_col: str, lang_col: str, sample: int) -> dict[str, list[str]]:
    """At most ``sample`` whole texts of each language, the smallest id hashes first.

    A language's texts stop where their characters would exceed its share of
    SAMPLE_CHARS, so that the driver's memory is bounded.

    A language's count says below which hash its sample must lie, so that what
    is ranked is a few times the sample, however large the language.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"), held_out(id_col).alias("out"))
    usable = rows.where("NOT out AND lang IS NOT NULL").where(F.col("text").rlike(r"\p{L}"))
    narrow = materialize(usable.select("id", "lang", F.length("text").alias("chars"), F.pmod(F.xxhash64(F.lit(SEED), "id"), F.lit(1 << 40)).alias("h")))
    counts = narrow.groupBy("lang").agg(F.count("*").alias("n"))
    limits = materialize(counts.select(F.col("lang").alias("_l"), F.ceil(F.lit(float(1 << 40)) * F.least(F.lit(1.0), (F.lit(2.0 * sample) + 100) / F.col("n"))).alias("_limit")))
    n_languages = limits.count()
    few = n_languages <= 10_000
    near = narrow.join(F.broadcast(limits) if few else limits, F.col("lang") == F.col("_l")).where("h < _limit")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h", "id"))
    share = F.lit(SAMPLE_CHARS) / F.lit(max(1, n_languages))
    so_far = F.sum("chars").over(Window.partitionBy("lang").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0))
    first = near.withColumn("rank", rank).where(F.col("rank") <= sample).withColumn("so_far", so_far).where((F.col("rank") == 1) | (F.col("so_far") <= share))
    chosen = first.groupBy(F.col("id").alias("_id")).agg(F.min("rank").alias("rank"))
    drawn = usable.join(F.broadcast(chosen), F.col("id") == F.col("_id")).select("lang", "rank", "text")
    out: dict[str, list[tuple[int, str]]] = {}
    for lang, place, text in drawn.collect():  # bounded by SAMPLE_CHARS
        out.setdefault(lang, []).append((place, text))
    return {lang: [t for _, t in sorted(rows)[:sample]] for lang, rows in out.items()}


def identify_languages(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    sample: int = SAMPLE_PER_LANGUAGE,
    training: DataFrame | None = None,
    whole: bool = False,
) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, rejected) of every row.

    With ``whole`` also ``doc``, the row as a struct. Learned from ``training``
    (``docs`` if none): texts with a letter and a language whose id's crc32
    modulo 4 is not 2. A text that is null or has no letter is ``und`` with
    score 0 and rejected, and so is every text if there is nothing to learn
    from. Other texts get a learned language, also where ``rejected`` says
    that no model fits. Repeated rows are predicted one by one; a null id is
    not held out.
    """
    texts = training_texts(docs if training is None else training, id_col, text_col, lang_col, sample)
    models = docs.sparkSession.sparkContext.broadcast(train(texts)) if texts else None  # bounded by the sample

    def predicted(column: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        lang, score, rejected = ["und"] * len(column), np.zeros(len(column)), np.ones(len(column), dtype=bool)
        streams = [symbols(t) if t else np.zeros(0, dtype=np.uint64) for t in column]
        known = [i for i, s in enumerate(streams) if (s != _SPACE).any()]
        if known and models is not None:
            best, confidence, bad = models.value.predict([streams[i] for i in known])
            for i, b in zip(known, best.tolist()):
                lang[i] = models.value.languages[b]
            score[known], rejected[known] = confidence, bad
        return lang, score, rejected

    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                part = batch.slice(i, 512)
                text = pc.struct_field(part.column(2), [at]) if whole else part.column(2)
                lang, score, rejected = predicted(text.to_pylist())
                columns = [part.column(0), part.column(1), pa.array(lang, pa.string()), pa.array(score), pa.array(rejected), *[part.column(2)] * whole]
                yield pa.RecordBatch.from_arrays(columns, [f.name for f in schema])

    inputs = {"doc_id": F.col(id_col).cast("long"), "held_out": held_out(id_col), "text": F.col(text_col)}
    rows = packed(docs, **inputs).select("doc_id", "held_out", "doc" if whole else "text")
    fields = [T.StructField("doc_id", T.LongType()), T.StructField("held_out", T.BooleanType()), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType())]
    schema = T.StructType(fields + ([rows.schema["doc"]] if whole else []))
    return map_arrow(rows, run, schema)
