"""Near-duplicates by the similarity of shingle sets, found by SimHash with pigeonring filtering.

Two documents are linked if the Jaccard similarity of their sets of five-word
shingles is at least 0.8. A set's fingerprint is a SimHash of 256 bits, a ring
of four segments: pairs at 0.8 differ in about 39 bits, others in 128. If two
differ in at most RADIUS bits, the pigeonring principle gives a segment from
which every chain of l segments differs in at most l * RADIUS / 4 bits. Tables
of bits drawn from one segment find the chain's first link, the longer chains
prune what met. Only sets of close sizes can be similar, so blocks of one class
of size meet those of the next. What the ring leaves together is judged by the
sets themselves, hashed anew from the texts; groups leave a task, never pairs.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwork.llm.common import discard, map_arrow, materialize
from loomwork.llm.components import Forest
from loomwork.llm.simhash import _BYTE_BITS, name_components, shingle_hashes

SHINGLE_WORDS = 5
#: Least similarity of a link, as a fraction of whole numbers.
SIMILARITY = (4, 5)
#: Segments of 64 bits on the ring.
RING = 4
#: Bits in which fingerprints may differ: four deviations above the mean of a pair at 0.8, also of sets of few shingles.
RADIUS = 72
#: Tables are drawn until a pair with 12 of 64 bits off meets in one with probability 1 - MISS.
MISS = 0.001
#: Members that are compared without tables.
BRUTE = 512
#: Members of a size class that form a block.
BLOCK = 100_000
#: Members of a group, those with the most partners, whose partners are judged before others'.
LEADERS = 1
#: Members of a group that one task judges; a larger group is dealt into pairs of blocks.
CELL = 1024
#: Hashes in the sets of a group that one task holds.
CELL_HASHES = 4_000_000

_SEEDS = np.random.default_rng(42).integers(0, 1 << 64, RING - 1, dtype=np.uint64)
_LANES = np.arange(8 * RING, dtype=np.int64) * 256
_BITS = _BYTE_BITS.astype(np.float64)


def shingle_set(text: str | None) -> np.ndarray:
    """Distinct unsigned shingle hashes of a text, ascending."""
    return np.unique(np.array(shingle_hashes(text, SHINGLE_WORDS), dtype=np.uint64))


def _set_id(hashes: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(hashes.tobytes()) if len(hashes) else 0


def wide_fingerprint(hashes: np.ndarray) -> np.ndarray:
    """SimHash of a set of unsigned hashes: RING words, the first from the hashes as they are, the others from mixes of them."""
    words = np.empty((len(hashes), RING), dtype="<u8")
    words[:, 0] = hashes
    for i, seed in enumerate(_SEEDS, 1):
        x = hashes ^ seed
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        words[:, i] = x ^ (x >> np.uint64(31))
    seen = np.bincount((words.view(np.uint8).reshape(-1, 8 * RING) + _LANES).ravel(), minlength=2048 * RING).reshape(8 * RING, 256) @ _BITS
    return np.packbits((2 * seen > len(hashes)).ravel(), bitorder="little").view("<u8")


_WORDS = [f"w{i}" for i in range(RING)]


def wide_fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, key, fp, n, w0..w3) of rows (doc_id, text): fp is the same for equal sets only, 0 for a text without a word; n is the set's size, key the text's hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t.as_py()) for t in batch.column(2)]
            fps = np.array([_set_id(s) for s in sets], dtype=np.uint64).view(np.int64)
            wide = np.array([wide_fingerprint(s) for s in sets], dtype=np.uint64).reshape(-1, RING).view(np.int64)
            sizes = np.array([len(s) for s in sets], dtype=np.int64)
            columns = [batch.column(0), batch.column(1), pa.array(fps), pa.array(sizes), *[pa.array(np.ascontiguousarray(wide[:, i])) for i in range(RING)]]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "key", "fp", "n", *_WORDS])

    rows = docs.select("doc_id", F.xxhash64("text").alias("key"), "text")
    return map_arrow(rows, run, "doc_id long, key long, fp long, n long, " + ", ".join(f"{w} long" for w in _WORDS))


def _chained(wide: np.ndarray, a: np.ndarray, b: np.ndarray, start: int) -> np.ndarray:
    """Which pairs hold every chain's budget from a start."""
    open_ = np.arange(len(a))
    off = np.zeros(len(a), dtype=np.int64)
    for l in range(1, RING + 1):
        word = wide[(start + l - 1) % RING]
        off = off + np.bitwise_count(word[a[open_]] ^ word[b[open_]])
        within = off <= l * RADIUS // RING
        open_, off = open_[within], off[within]
    return open_


def _tables(members: int, brute: int = BRUTE) -> Iterator[tuple[int, list[int]]]:
    """(start, bits of its segment) of each table; no bits, so one table, for few members."""
    k = 0 if members <= brute else max(1, round(math.log2(members / 4)))
    meet = math.prod((52 - i) / (64 - i) for i in range(k))
    drawn = np.random.default_rng(7)
    for t in range(RING if k == 0 else math.ceil(-math.log(MISS) / meet)):
        yield t % RING, drawn.choice(64, k, replace=False).tolist()


def _groups(side: np.ndarray, n: np.ndarray, wide: np.ndarray, brute: int = BRUTE) -> np.ndarray:
    """Group of each member (its own place, if alone): joined are those that a table and the ring bring together."""
    part, whole = SIMILARITY
    group, forest = np.arange(len(n)), Forest()
    bits = {s: np.ascontiguousarray(np.unpackbits(wide[s].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").T) for s in range(RING)}
    for start, drawn in _tables(len(n), brute):
        key = np.zeros(len(n), dtype=np.uint32)
        for j, bit in enumerate(drawn):
            key |= bits[start][bit].astype(np.uint32) << np.uint32(j)
        order = np.argsort(key, kind="stable")
        key = key[order]
        begin = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        # a bucket of one group has nothing to join
        mixed = np.minimum.reduceat(group[order], begin) != np.maximum.reduceat(group[order], begin)
        end = np.r_[begin[1:], len(key)]
        at = np.flatnonzero(np.repeat(mixed, end - begin))
        last = np.repeat(end, end - begin)
        d = 0
        while len(at := at[at + d + 1 < last[at]]):
            d += 1
            a, b = order[at], order[at + d]
            fits = (group[a] != group[b]) & ((side[a] != side[b]) | (side[a] == 0)) & (np.minimum(n[a], n[b]) * whole >= np.maximum(n[a], n[b]) * part)
            a, b = a[fits], b[fits]
            met = _chained(wide, a, b, start)
            if len(met):
                forest.add(a[met], b[met])
                moved = np.fromiter(forest.parent, dtype=np.int64)
                group[moved] = [forest.find(x) for x in moved.tolist()]
    return group


def _by_cell(columns: int, one: Callable[[pa.Table], Iterator[pa.RecordBatch]]):
    """A function of batches sorted by their first columns that gives each cell to ``one``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []
        for batch in batches:
            cells = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(columns)], axis=1)
            cuts = np.flatnonzero((cells[1:] != cells[:-1]).any(axis=1)) + 1
            for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(cells)]):
                if hi > lo:
                    if (now := tuple(cells[lo].tolist())) != key:
                        if held:
                            yield from one(pa.Table.from_batches(held))
                        key, held = now, []
                    held.append(batch.slice(lo, hi - lo))
        if held:
            yield from one(pa.Table.from_batches(held))

    return run


_MEMBER = ["bucket", "side", "fp", "n", *_WORDS]
_MEMBER_SCHEMA = "bucket long, side long, fp long, n long, " + ", ".join(f"{w} long" for w in _WORDS)


def _wide(rows: pa.Table) -> np.ndarray:
    return np.stack([rows.column(w).to_numpy() for w in _WORDS]).view(np.uint64)


def _grouped(rows: pa.Table, most: int, most_hashes: int, brute: int) -> Iterator[pa.RecordBatch]:
    """The members of a cell's groups; those of many members or long sets in pairs of blocks."""
    side, fp, n = (rows.column(c).to_numpy() for c in ("side", "fp", "n"))
    group = _groups(side, n, _wide(rows), brute)
    order = np.argsort(group, kind="stable")
    begin = np.flatnonzero(np.r_[True, group[order][1:] != group[order][:-1]])
    ends = np.r_[begin[1:], len(order)]
    cell = rows.column("lo")[0].as_py(), rows.column("hi")[0].as_py()
    place, bucket, sides = [], [], []
    for lo, hi in zip(begin[ends - begin > 1].tolist(), ends[ends - begin > 1].tolist()):
        held = order[lo:hi]
        blocks = np.array_split(held, min(len(held), max(-(-len(held) // most), -(-int(n[held].sum()) // most_hashes))))
        for x, left in enumerate(blocks):
            for y in range(x, len(blocks)):
                name = np.uint64(xxhash.xxh64_intdigest(np.array([*cell, fp[held[0]], x, y], dtype=np.int64).tobytes())).view(np.int64)
                # two sides: those of the cell within a block, the blocks otherwise
                for rows_, mark in ((left, side[left]),) if x == y else ((left, np.full(len(left), 1)), (blocks[y], np.full(len(blocks[y]), 2))):
                    place.append(rows_)
                    bucket.append(np.full(len(rows_), name))
                    sides.append(mark)
    if place:
        at = pa.array(np.concatenate(place))
        taken = rows.select(["fp", "n", *_WORDS]).take(at)
        columns = [np.concatenate(bucket), np.concatenate(sides).astype(np.int64), *[taken.column(c).to_numpy() for c in taken.column_names]]
        yield from pa.table(dict(zip(_MEMBER, columns))).to_batches(max_chunksize=10_000)


def _linked(rows: pa.Table, leaders: int) -> Iterator[pa.RecordBatch]:
    """Links within one group; what they have joined already is not judged again."""
    fp = rows.column("fp").to_numpy()
    side = rows.column("side").to_numpy()
    _, once = np.unique(np.stack([fp, side]), axis=1, return_index=True)  # a repeated row gives its set twice
    rows = rows.take(pa.array(once))
    fp, side, wide = fp[once], side[once], _wide(rows)
    lists = rows.column("hashes").combine_chunks()
    flat = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)  # ascending as such
    n = rows.column("n").to_numpy()
    ends = np.cumsum(n)
    part, whole = SIMILARITY
    every = np.arange(len(fp))

    def partners(a: int) -> np.ndarray:
        b = every[(every != a) & ((side != side[a]) | (side == 0)) & (np.minimum(n, n[a]) * whole >= np.maximum(n, n[a]) * part)]
        return b[(np.bitwise_count(wide[:, b] ^ wide[:, a : a + 1]).sum(axis=0) <= RADIUS)]

    turns = every
    if leaders and len(fp) > 2:  # the centre of a group of copies links most of it
        most = np.argsort([-len(partners(a)) for a in every.tolist()], kind="stable")[:leaders]
        turns = np.r_[most, np.setdiff1d(every, most)]
    forest = Forest()
    for a in turns.tolist():
        root = forest.find(a)
        b = np.array([j for j in partners(a).tolist() if forest.find(j) != root], dtype=np.int64)
        if not len(b):
            continue
        own = flat[ends[a] - n[a] : ends[a]]
        other = np.concatenate([flat[ends[j] - n[j] : ends[j]] for j in b.tolist()])
        at = np.minimum(np.searchsorted(own, other), len(own) - 1)
        shared = np.add.reduceat((own[at] == other).astype(np.int64), np.r_[0, np.cumsum(n[b])[:-1]])
        b = b[shared * (part + whole) >= (n[b] + n[a]) * part]
        for j in b.tolist():
            forest.union(a, j)
        if len(b):
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(b), fp[a])), pa.array(fp[b])], ["src", "dst"])


def _cells(distinct: DataFrame) -> DataFrame:
    """(lo, hi, side, fp, n, w0..w3): blocks of size classes, each with itself and with those that may hold similar sets."""
    part, whole = SIMILARITY
    # a hair wider than the ratio, so that rounding never parts similar sets by two classes
    staged = distinct.withColumn("class", F.floor(F.log(F.col("n").cast("double")) / math.log(whole / part * 1.0001)).cast("long"))
    counts = {r["class"]: r["count"] for r in staged.groupBy("class").count().collect()}  # as many rows as sizes have powers
    first, blocks = 0, []
    for c in sorted(counts):
        blocks.append((c, first, -(-counts[c] // BLOCK)))
        first += blocks[-1][2]
    known = {c: (at, k) for c, at, k in blocks}
    spans = [(c, at, k, known.get(c - 1, (at, 0))[0], (at + k - 1) + known.get(c + 1, (0, 0))[1]) for c, at, k in blocks]
    table = distinct.sparkSession.createDataFrame(spans, "class long, at long, k long, from long, upto long")
    dealt = staged.join(F.broadcast(table), "class").withColumn("b", F.col("at") + F.pmod(F.xxhash64("fp"), F.col("k"))).withColumn("o", F.explode(F.sequence("from", "upto")))
    side = F.when(F.col("o") == F.col("b"), 0).when(F.col("b") < F.col("o"), 1).otherwise(2).cast("long")
    return dealt.select(F.least("b", "o").alias("lo"), F.greatest("b", "o").alias("hi"), side.alias("side"), "fp", "n", *_WORDS)


def _sets(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """(fp, hashes) of the documents ``chosen`` (_id, _key); a repeated row gives its set once a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            sets = [s for s in map(shingle_set, batch.column(0).to_pylist()) if not ((i := _set_id(s)) in seen or seen.add(i))]
            fps = np.array([_set_id(s) for s in sets], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(fps), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], ["fp", "hashes"])

    rows = docs.join(chosen, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_key")), "left_semi")
    return map_arrow(rows.select("text"), run, "fp long, hashes array<long>")


def near_links(docs: DataFrame, found: DataFrame) -> DataFrame:
    """Edges (src, dst) that join the fps of similar sets of rows (doc_id, text), whose fingerprints are ``found``."""
    firsts = [F.first(c).alias(c) for c in ("n", *_WORDS)]
    distinct = materialize(found.where("n > 0").groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")).alias("rep"), *firsts))
    placed = _cells(distinct).repartition("lo", "hi").sortWithinPartitions("lo", "hi")
    members = materialize(map_arrow(placed, _by_cell(2, partial(_grouped, most=CELL, most_hashes=CELL_HASHES, brute=BRUTE)), _MEMBER_SCHEMA))
    wanted = distinct.join(members.select("fp").distinct(), "fp", "left_semi").select(F.col("rep.doc_id").alias("_id"), F.col("rep.key").alias("_key"))
    judged = members.join(_sets(docs, wanted), "fp").select(*_MEMBER, "hashes").repartition("bucket").sortWithinPartitions("bucket")
    links = materialize(map_arrow(judged, _by_cell(1, partial(_linked, leaders=LEADERS)), "src long, dst long"))
    for table in (distinct, members):
        discard(table)
    return links


def near_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp, component_id) of every row of ``docs``, named as ``hamming_components`` names them."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    found = materialize(wide_fingerprints(rows))
    return name_components(found.select("doc_id", "fp"), near_links(rows, found))
