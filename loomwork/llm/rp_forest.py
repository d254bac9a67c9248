"""Embedding near-duplicates by a random-projection tree forest.

Trees split recursively along random projections, with spill: vectors close to
a split go to both sides. The first levels cut near the medians of a sample,
further ones into slabs at places drawn by hash, so depth follows the number of
vectors without a bound. Vectors are compared only within leaves, by a sketch of
one byte a number whose error is bounded; pairs that the bound leaves open are
verified on the vectors themselves in double precision. A link counts in the
first leaf, in tree order, that its two vectors share. Counts, forests of links
and single rows leave a task, never pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomwork.llm.common import discard, map_arrow, materialize
from loomwork.llm.components import Forest, connected_components

THRESHOLD = 0.9
#: Share of the pairs right at the threshold that the forest should bring together.
RECALL = 0.93
#: Vectors a leaf should hold, those that spill into it included.
LEAF = 2500
#: Vectors that the first levels are fitted on, at most; every vector is indexed.
SAMPLE = 20_000
#: Sampled vectors that a fitted cut rests on, at least.
NODE = 32
#: Half width of the spill, in standard deviations of the projected difference
#: of two unit vectors at the threshold.
SPILL = 0.25
#: Width of a slab below the fitted levels, in the same unit.
SLAB = 6.0
#: Rows of a leaf that one task holds; a larger leaf is dealt into block pairs.
CELL = 6144
#: Vector lengths that get fitted levels; others are split by hash alone.
FITTED_LENGTHS = 64
_TILE = 512
_PATH = (1 << 54) - 1
_MIX = np.int64(0x1E3779B97F4A7C15)
#: Slack for sums in single precision.
_SLACK = 1e-5


def depth_for(n: int, leaf: int, threshold: float, spill: float) -> int:
    """Levels after which a leaf holds about ``leaf`` of ``n`` vectors, where each level halves it but for the spill."""
    both = 2 * spill * math.sqrt(max(0.0, 2 - 2 * threshold)) / math.sqrt(2 * math.pi)
    return max(1, round(math.log(n / leaf) / math.log(2 / (1 + both)) + 0.2))


def trees_for(depth: int, threshold: float, spill: float, recall: float) -> int:
    """Trees after which a pair at the threshold has shared a leaf with probability ``recall``.

    One level parts such a pair if its projected difference exceeds the spill
    on both sides and a cut near the median falls between the two.
    """
    if depth == 0:
        return 1
    c, density = 2 * spill, 1 / math.sqrt(2 * math.pi)
    tail = density * math.exp(-c * c / 2) - c * 0.5 * math.erfc(c / math.sqrt(2))
    together = 1 - 2 * math.sqrt(max(0.0, 2 - 2 * threshold)) * density * tail
    return max(4, math.ceil(math.log(1 - recall) / math.log(1 - min(0.999, together**depth))))


@dataclass
class Tree:
    """Splits of unit vectors; ``cuts`` holds the fitted thresholds by (level, path)."""

    dim: int
    depth: int
    seed: int
    margin: float
    width: float
    cuts: list[np.ndarray] = field(default_factory=list)

    @cached_property
    def directions(self) -> np.ndarray:
        out = np.random.default_rng((self.seed, self.dim)).standard_normal((max(self.depth, 1), self.dim))
        return out / np.linalg.norm(out, axis=1, keepdims=True)

    @cached_property
    def offsets(self) -> np.ndarray:
        return np.random.default_rng((self.seed, self.dim, 1)).uniform(0, self.width, max(self.depth, 1))

    def leaves(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, path) pairs; a row has several paths where it spills."""
        row = np.arange(len(unit))
        path = np.zeros(len(unit), dtype=np.int64)
        along = unit @ self.directions.T
        for level in range(self.depth):
            at = along[row, level]
            if level < len(self.cuts):
                gap = at - self.cuts[level][path]
                left, right = gap <= self.margin, gap >= -self.margin
                row, path = np.concatenate([row[left], row[right]]), np.concatenate([2 * path[left], 2 * path[right] + 1])
                continue
            place = (at + self.offsets[level]) / self.width
            slab = np.floor(place)
            below, above = (place - slab) * self.width <= self.margin, (slab + 1 - place) * self.width <= self.margin
            slab = np.concatenate([slab, slab[below] - 1, slab[above] + 1]).astype(np.int64)
            row, path = np.concatenate([row, row[below], row[above]]), np.concatenate([path, path[below], path[above]])
            path = (((path + level + 1) * _MIX) ^ ((slab + 77) * np.int64(0x2545F4914F6CDD1D))) >> 9 & _PATH
        return row, path


def fit_tree(sample: np.ndarray, depth: int, seed: int, threshold: float = THRESHOLD, spill: float = SPILL) -> Tree:
    """Tree over unit vectors; fitted cuts are quantiles in 0.45..0.55 of each node's sample."""
    dim = sample.shape[1]
    unit = math.sqrt(max(1e-12, 2 - 2 * threshold) / dim)
    tree = Tree(dim, depth, seed, spill * unit, SLAB * unit)
    rng = np.random.default_rng((seed, dim, 2))
    fitted = min(depth, max(0, int(math.log2(max(1, len(sample) / NODE)))))
    path = np.zeros(len(sample), dtype=np.int64)
    for level in range(fitted):
        at = sample @ tree.directions[level]
        order = np.lexsort((at, path))
        nodes, begin, size = np.unique(path[order], return_index=True, return_counts=True)
        cut = np.full(1 << level, float(np.median(at)))
        place = begin + np.minimum(size - 1, (size * rng.uniform(0.45, 0.55, len(size))).astype(int))
        cut[nodes] = at[order][place]
        tree.cuts.append(cut)
        path = 2 * path + (at > cut[path])
    return tree


@dataclass
class Index:
    """Trees by dimension; a dimension without trees has one leaf."""

    trees: dict[int, list[Tree]] = field(default_factory=dict)

    def leaves(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf) pairs without repeats; a leaf number holds the tree and the path."""
        trees = self.trees.get(unit.shape[1])
        if not trees:
            return np.arange(len(unit)), np.zeros(len(unit), dtype=np.int64)
        rows, leaves = zip(*((r, p + (t << 54)) for t, tree in enumerate(trees) for r, p in [tree.leaves(unit)]))
        row, leaf = np.concatenate(rows), np.concatenate(leaves)
        order = np.lexsort((leaf, row))
        row, leaf = row[order], leaf[order]
        new = np.r_[True, (row[1:] != row[:-1]) | (leaf[1:] != leaf[:-1])][: len(row)]
        return row[new], leaf[new]


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors.astype(np.float64)
    # a power of two keeps the scaling exact while squares stay finite
    vectors = np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=1, keepdims=True))[1])
    return vectors / np.sqrt(np.einsum("ij,ij->i", vectors, vectors))[:, None]


def sketch_rows(vectors: np.ndarray) -> np.ndarray:
    """Whole numbers from -127 to 127 in proportion to each vector's numbers."""
    unit = unit_rows(vectors)
    return np.rint(unit * (127 / np.abs(unit).max(axis=1, keepdims=True))).astype(np.int8)


def _by_length(sizes: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    for n in np.unique(sizes):
        yield int(n), np.flatnonzero(sizes == n)


def _lists(values: pa.Array, at: np.ndarray, size: np.ndarray, dim: int) -> np.ndarray:
    """The lists at the given places, all of length ``dim``, as a matrix."""
    flat = values.flatten().to_numpy(zero_copy_only=False)
    begin = np.r_[0, np.cumsum(size)[:-1]]
    return flat[begin[at][:, None] + np.arange(dim)]


def _bytes(values: pa.Array, at: np.ndarray, dim: int) -> np.ndarray:
    """The binary values at the given places, all of length ``dim``, as a matrix of int8."""
    _, offsets, data = values.buffers()
    begin = np.frombuffer(offsets, dtype=np.int32)[values.offset : values.offset + len(values)]
    return np.frombuffer(data, dtype=np.int8)[begin[at].astype(np.int64)[:, None] + np.arange(dim)]


def _binary(matrix: np.ndarray) -> pa.Array:
    offsets = np.arange(len(matrix) + 1, dtype=np.int32) * matrix.shape[1]
    return pa.Array.from_buffers(pa.binary(), len(matrix), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(matrix))])


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column(3)
        size = lists.value_lengths().to_numpy(zero_copy_only=False)
        for dim, at in _by_length(size):
            q = sketch_rows(_lists(lists, at, size, dim))
            rest = [batch.column(i).take(pa.array(at)) for i in range(3)]
            yield pa.RecordBatch.from_arrays([*rest, _binary(q)], ["id", "h1", "h2", "q"])


def _normed(q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(directions of sketches in double precision, their norms)."""
    whole = q.astype(np.float64)
    norm = np.sqrt(np.einsum("ij,ij->i", whole, whole))
    return whole / norm[:, None], norm


def fit_index(reps: DataFrame, threshold: float, recall: float, leaf: int, sample: int, seed: int) -> Index:
    """Trees for each dimension that has more vectors than a leaf.

    The first levels are fitted on about ``sample`` vectors in all, taken by
    hash; depth and number of trees follow the count of all vectors.
    """
    counts = [(r["d"], r["n"]) for r in reps.groupBy("d").agg(F.count("*").alias("n")).where(F.col("n") > leaf).orderBy(F.desc("n"), "d").collect()]
    index = Index()
    for place, (dim, n) in enumerate(counts):
        drawn = np.zeros((0, dim))
        if place < FITTED_LENGTHS:
            wanted = sample / min(len(counts), FITTED_LENGTHS)
            rows = reps.where(F.col("d") == dim)
            if wanted < n:
                rows = rows.where(F.pmod(F.xxhash64(F.lit(seed), "rid"), F.lit(1 << 30)) < F.lit(int(wanted / n * (1 << 30))))
            taken = rows.select("q").limit(int(2 * wanted) + 1).collect()
            drawn = _normed(np.frombuffer(b"".join(bytes(r[0]) for r in taken), dtype=np.int8).reshape(-1, dim))[0]
        depth = depth_for(n, leaf, threshold, SPILL)
        index.trees[dim] = [fit_tree(drawn, depth, seed * 1000 + t, threshold) for t in range(trees_for(depth, threshold, SPILL, recall))]
    return index


def _assign(index: Index):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, weight = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False)
            for dim, at in _by_length(pc.binary_length(batch.column(2)).to_numpy(zero_copy_only=False)):
                q = _bytes(batch.column(2), at, dim)
                row, leaf = index.leaves(_normed(q)[0])
                for i in range(0, len(row), 16384):
                    r = row[i : i + 16384]
                    dims = pa.array(np.full(len(r), dim, dtype=np.int32))
                    yield pa.RecordBatch.from_arrays([dims, pa.array(leaf[i : i + 16384]), pa.array(ids[at][r]), pa.array(weight[at][r]), _binary(q[r])], ["d", "leaf", "rid", "w", "q"])

    return run


def _leaf_sizes(index: Index):
    """Rows by leaf, summed over a task as far as memory stays small."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], int] = {}
        for batch in batches:
            for dim, at in _by_length(pc.binary_length(batch.column(0)).to_numpy(zero_copy_only=False)):
                _, leaf = index.leaves(_normed(_bytes(batch.column(0), at, dim))[0])
                for name, n in zip(*(x.tolist() for x in np.unique(leaf, return_counts=True))):
                    held[dim, name] = held.get((dim, name), 0) + n
            if len(held) > 500_000:
                yield flush(held)
                held = {}
        yield flush(held)

    def flush(held: dict[tuple[int, int], int]) -> pa.RecordBatch:
        dims, names = pa.array([k[0] for k in held], pa.int32()), pa.array([k[1] for k in held], pa.int64())
        return pa.RecordBatch.from_arrays([dims, names, pa.array(list(held.values()), pa.int64())], ["d", "leaf", "n"])

    return run


class _Comparison:
    """Rows of one leaf, or of one pair of its blocks, compared by their sketches."""

    def __init__(self, index: Index, threshold: float, leaf: int, side: np.ndarray, q: np.ndarray, exact: np.ndarray | None = None) -> None:
        self.index, self.leaf, self.side, self.q, self.exact = index, leaf, side, q, exact
        self.threshold, self.angle = threshold, math.acos(max(-1.0, min(1.0, threshold)))
        self.unit, norm = _normed(q)
        #: the angle between a vector and its sketch is at most this
        self.error = np.arcsin(np.minimum(1.0, 0.5 * math.sqrt(q.shape[1]) / norm)) + 1e-9

    @cached_property
    def earlier(self) -> np.ndarray:
        return self._earlier(np.arange(len(self.unit)))

    def _earlier(self, rows: np.ndarray) -> np.ndarray:
        """Bits of the leaves before this one that each of the rows is in."""
        row, other = self.index.leaves(self.unit[rows])
        before = other < self.leaf
        row, other = row[before], other[before]
        names, at = np.unique(other, return_inverse=True)
        out = np.zeros((len(rows), max(1, len(names))), dtype=bool)
        out[row, at] = True
        return np.packbits(out, axis=1)

    def _new(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Whether no earlier leaf holds both ends of a pair."""
        rows, at = np.unique(np.concatenate([x, y]), return_inverse=True)
        bits = self._earlier(rows) if 4 * len(rows) < len(self.unit) else self.earlier[rows]
        return ~(bits[at[: len(x)]] & bits[at[len(x) :]]).any(axis=1)

    def links(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(x, y, sure, new): pairs by place that may link, whether the sketches prove it, whether no earlier leaf holds both."""
        single = self.unit.astype(np.float32)
        lefts, rights = np.flatnonzero(self.side != 2), np.flatnonzero(self.side != 1)
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        loosest = np.float32(math.cos(min(math.pi, self.angle + 2 * float(self.error.max(initial=0)))) - _SLACK)
        for i in range(0, len(lefts), _TILE):
            a = lefts[i : i + _TILE]
            for j in range(0, len(rights), _TILE):
                b = rights[j : j + _TILE]
                if b[-1] <= a[0] and (self.side == 0).all():
                    continue
                close = single[a] @ single[b].T
                hit = close >= loosest
                some = np.flatnonzero(hit.any(axis=1))
                if not len(some):
                    continue
                x, y = np.nonzero(hit[some])
                x = some[x]
                near = close[x, y].astype(np.float64)
                x, y = a[x], b[y]
                keep = (self.side[x] != 0) | (x < y)
                x, y, near = x[keep], y[keep], near[keep]
                held.append((x, y, near))
                if sum(len(h[0]) for h in held) >= 65536:
                    yield from self._judged(*map(np.concatenate, zip(*held)))
                    held = []
        if held:
            yield from self._judged(*map(np.concatenate, zip(*held)))

    def _judged(self, x: np.ndarray, y: np.ndarray, near: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        slack = self.error[x] + self.error[y]
        low, high = np.cos(np.minimum(math.pi, self.angle + slack)), np.cos(np.maximum(0.0, self.angle - slack))
        high[slack >= self.angle] = np.inf
        # where rounding could matter the whole numbers decide, alike in every pass
        edge = np.flatnonzero((np.abs(near - low) < _SLACK) | (np.abs(near - high) < _SLACK))
        near[edge] = np.einsum("ij,ij->i", self.unit[x[edge]], self.unit[y[edge]])
        may = near >= low
        x, y, sure = x[may], y[may], near[may] >= high[may]
        if len(x):
            yield x, y, sure, self._new(x, y)


def _join(ids: np.ndarray, x: np.ndarray, y: np.ndarray, forest: Forest) -> None:
    """Union the linked rows by passing the smallest id along the pairs."""
    if not len(x):
        return
    rows, at = np.unique(np.concatenate([x, y]), return_inverse=True)
    label, a, b = ids[rows].copy(), at[: len(x)], at[len(x) :]
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        if (new == label).all():
            break
        label = new
    forest.add(ids[rows], label)


_FOUND = "kind int, a long, b long, d int, leaf long, cell long"
_COUNT, _EDGE, _OPEN = 0, 1, 2


def _found(kind: int, a: np.ndarray, b: np.ndarray, key: tuple[int, int, int] = (0, 0, 0)) -> pa.RecordBatch:
    n = len(a)
    fixed = [np.full(n, kind, np.int32), a.astype(np.int64), b.astype(np.int64), np.full(n, key[0], np.int32), np.full(n, key[1], np.int64), np.full(n, key[2], np.int64)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in fixed], ["kind", "a", "b", "d", "leaf", "cell"])


def _compare(index: Index, threshold: float, exact: bool):
    """Compare cells given in runs of (d, leaf, cell, side, rid, w, sketch or vector).

    Without ``exact`` the proven links are counted and the rows of open pairs
    are named; with it, the rows so named come with their vectors and only the
    open pairs are judged.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = Forest()
        held: list[pa.RecordBatch] = []
        key: tuple[int, int, int] | None = None

        def close() -> Iterator[pa.RecordBatch]:
            rows = pa.Table.from_batches(held).combine_chunks() if held else None
            if rows is None or rows.num_rows < 2:
                return
            side, ids, weight = (rows.column(c).to_numpy() for c in ("side", "rid", "w"))
            _, first = np.unique(ids, return_index=True)  # a repeated row may bring its vector twice
            values = rows.column(6).combine_chunks()
            values = values.chunk(0) if isinstance(values, pa.ChunkedArray) else values
            side, ids, weight, vectors = side[first], ids[first], weight[first], None
            if exact:
                vectors = _lists(values, first, np.full(len(values), key[0]), key[0])
                q, vectors = sketch_rows(vectors), unit_rows(vectors)
            else:
                q = _bytes(values, first, key[0])
            count, open_ = np.zeros(len(ids), dtype=np.int64), np.zeros(len(ids), dtype=bool)
            for x, y, sure, new in _Comparison(index, threshold, key[1], side, q).links():
                if exact:
                    x, y, new = x[~sure], y[~sure], new[~sure]
                    linked = np.einsum("ij,ij->i", vectors[x], vectors[y]) >= threshold
                    linked &= new
                else:
                    left = ~sure & new
                    open_[x[left]] = True
                    open_[y[left]] = True
                    linked = sure & new
                x, y = x[linked], y[linked]
                np.add.at(count, x, weight[y])
                np.add.at(count, y, weight[x])
                _join(ids, x, y, forest)
            if count.any():
                yield _found(_COUNT, ids[count > 0], count[count > 0])
            if open_.any():
                yield _found(_OPEN, ids[open_], side[open_], key)
            if len(forest.parent) > 500_000:
                yield edges()

        def edges() -> pa.RecordBatch:
            star = forest.drain()
            return _found(_EDGE, *(star.column(i).to_numpy(zero_copy_only=False) for i in range(2)))

        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(3)], axis=1)
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(keys)]):
                now = tuple(keys[lo].tolist())
                if now != key:
                    yield from close()
                    held, key = [], now
                held.append(batch.slice(lo, hi - lo))
        yield from close()
        yield edges()

    return run


def _vector(rows: DataFrame, vector_col: str) -> Column:
    """The vectors as they are stored, anything but 32-bit floats as doubles."""
    kind = rows.schema[vector_col].dataType
    single = isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType)
    return F.col(f"`{vector_col}`") if single else F.col(f"`{vector_col}`").cast("array<double>")


def _can_link(v: Column) -> Column:
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(v.isNotNull() & ~bad & F.exists(v, lambda x: x != 0), F.lit(False))


def embedding_links(
    rows: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    threshold: float = THRESHOLD,
    recall: float = RECALL,
    leaf: int = LEAF,
    sample: int = SAMPLE,
    seed: int = 7,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row.

    Vectors that are null, empty, zero, or hold null or non-finite components
    link with nothing: n_links 0, their own component. Vectors of different
    lengths never link. Equal vectors are compared once and count as often as
    they come; repeated ids count as rows of their own. A row with a null id
    links with nothing, its component_id and kept are null. Equal vectors are
    known by 128 bits of hash. Cosines that decide are in double precision,
    over the type that the table holds.
    """
    named = rows.select(F.col(f"`{id_col}`").cast("long").alias("id"), _vector(rows, vector_col).alias("v"))
    good = F.col("id").isNotNull() & _can_link(F.col("v"))
    hashed = named.where(good).select("id", F.xxhash64("v").alias("h1"), F.xxhash64(F.lit(1), "v").alias("h2"), "v")
    sketches = map_arrow(hashed, _sketch, "id long, h1 long, h2 long, q binary")
    reps = materialize(
        sketches.groupBy("h1", "h2")
        .agg(F.min("id").alias("id"), F.count("*").alias("w"), F.first("q").alias("q"))
        .select(F.monotonically_increasing_id().alias("rid"), "h1", "h2", "id", "w", "q", F.length("q").alias("d"))
    )
    index = fit_index(reps, threshold, recall, leaf, sample, seed)
    leaves = map_arrow(reps.select("rid", "w", "q"), _assign(index), "d int, leaf long, rid long, w long, q binary")
    sizes = map_arrow(reps.select("q"), _leaf_sizes(index), "d int, leaf long, n long")
    hot = materialize(sizes.groupBy("d", "leaf").agg(F.sum("n").alias("n")).where(F.col("n") > CELL))
    cell, side = F.lit(0).cast("long"), F.lit(0)
    n_hot = hot.count()
    if n_hot:
        blocks = hot.select("d", "leaf", F.ceil(F.col("n") / CELL).cast("long").alias("k"))
        blocks = F.broadcast(blocks) if n_hot <= 10_000 else blocks
        leaves = leaves.join(blocks, ["d", "leaf"], "left").withColumn("k", F.coalesce("k", F.lit(1).cast("long")))
        leaves = leaves.withColumn("b", F.pmod(F.xxhash64("rid"), F.col("k"))).withColumn("o", F.explode(F.expr("sequence(0L, k - 1)")))
        cell = (F.least("b", "o") * F.col("k") + F.greatest("b", "o")).cast("long")
        side = F.when(F.col("o") == F.col("b"), 0).when(F.col("b") < F.col("o"), 1).otherwise(2)
    cells = leaves.select("d", "leaf", cell.alias("cell"), side.alias("side"), "rid", "w", "q")
    placed = cells.repartition("d", "leaf", "cell").sortWithinPartitions("d", "leaf", "cell")
    found = materialize(map_arrow(placed, _compare(index, threshold, False), _FOUND))
    open_ = found.where(F.col("kind") == _OPEN).select("d", "leaf", "cell", F.col("b").cast("int").alias("side"), F.col("a").alias("rid"))
    wanted = materialize(open_.join(reps.select("rid", "h1", "h2", "id", "w"), "rid"))
    vectors = wanted.join(hashed, ["h1", "h2", "id"]).select("d", "leaf", "cell", "side", "rid", "w", "v")
    judged = materialize(map_arrow(vectors.repartition("d", "leaf", "cell").sortWithinPartitions("d", "leaf", "cell"), _compare(index, threshold, True), _FOUND))
    both = found.unionByName(judged)
    counts = both.where(F.col("kind") == _COUNT).groupBy(F.col("a").alias("rid")).agg(F.sum("b").alias("n"))
    parts = connected_components(both.where(F.col("kind") == _EDGE).select(F.col("a").alias("src"), F.col("b").alias("dst")))
    part = reps.select("rid", "h1", "h2", "id", "w").join(parts.withColumnRenamed("node", "rid"), "rid", "left").join(counts, "rid", "left")
    linked = materialize(part.where("component IS NOT NULL OR w > 1").withColumn("component", F.coalesce("component", "rid")))
    lowest = linked.groupBy("component").agg(F.min("id").alias("_c"))
    known = materialize(linked.join(lowest, "component").select("h1", "h2", (F.coalesce("n", F.lit(0)) + F.col("w") - 1).alias("_n"), "_c"))
    for table in (reps, hot, found, wanted, judged, linked):
        discard(table)
    told = hashed.select("id", "h1", "h2").join(known, ["h1", "h2"], "left")
    told = told.select(F.col("id").alias("vec_id"), F.coalesce("_n", F.lit(0)).alias("n_links"), F.coalesce("_c", "id").alias("component_id"))
    alone = named.where(~good).select(F.col("id").alias("vec_id"), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return told.unionByName(alone).withColumn("kept", F.col("vec_id") == F.col("component_id"))
