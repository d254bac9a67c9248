"""SimHash near-duplicates found with pigeonring filtering.

The 64 bits of a fingerprint form a ring of five segments. If two fingerprints
differ in at most 4 bits, the pigeonring principle gives a segment from which
every chain of l consecutive segments differs in at most floor(4 * l / 5) bits:
0, 1, 2, 3, 4. The first two links of the chain are found by equality (a
segment exact, the next exact or with one bit flipped); the third and fourth
prune what met before the full Hamming check.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwork.llm.common import map_arrow, materialize, packed, regrouped, unpacked
from loomwork.llm.components import FOREST_NODES, Forest, connected_components

MAX_BITS = 4
SHINGLE_WORDS = 4
HASH_SEED = 42
#: Widths of the ring's segments, lowest bits first.
SEGMENTS = (13, 13, 13, 13, 12)
STARTS = tuple(sum(SEGMENTS[:i]) for i in range(len(SEGMENTS)))
#: Fingerprints of a bucket that one task compares with the rest of it.
BLOCK = 4096
#: Rows of a batch compared by shifting; a longer bucket is compared in blocks.
SHIFTS = 32
_TILE = 1024

_BYTE_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)
_LANE = np.arange(8, dtype=np.int64) * 256


def shingle_hashes(text: str | None, shingle: int) -> list[int]:
    """Unsigned hash of each shingle of a text in order; none if it has no word.

    A-Z are lower-cased, words end at ASCII white space, a text of fewer words
    is one shingle.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return []
    if len(words) <= shingle:
        return [xxhash.xxh64_intdigest(b" ".join(words), HASH_SEED)]
    joined = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))
    begins = [0, *ends]
    digest = xxhash.xxh64_intdigest
    return [digest(joined[b : e - 1], HASH_SEED) for b, e in zip(begins, ends[shingle - 1 :])]


def fingerprint(text: str | None, shingle: int = SHINGLE_WORDS) -> int:
    """Unsigned SimHash of a text; 0 if it has no word. Repeated shingles count each time."""
    hashes = shingle_hashes(text, shingle)
    if not hashes:
        return 0
    lanes = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8) + _LANE
    seen = np.bincount(lanes.ravel(), minlength=2048).reshape(8, 256) @ _BYTE_BITS
    return int.from_bytes(np.packbits((2 * seen > len(hashes)).ravel(), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, fp) of every row; fp is the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(1)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], ["doc_id", "fp"])

    ids = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return map_arrow(ids, run, "doc_id long, fp long")


def _segment(start: F.Column, shift: int) -> F.Column:
    """Value of the segment that is ``shift`` places after ``start`` on the ring."""
    out = F.lit(None).cast("long")
    for s in range(len(SEGMENTS)):
        at = (s + shift) % len(SEGMENTS)
        out = F.when(start == s, F.shiftrightunsigned("fp", STARTS[at]).bitwiseAND(F.lit((1 << SEGMENTS[at]) - 1))).otherwise(out)
    return out


def ring_entries(distinct: DataFrame) -> DataFrame:
    """(bucket, role, fp): role 0 stands in its own bucket, role 1 one bit off.

    A bucket names a start, its segment and a value of the next segment. Each
    fingerprint gives 5 rows of role 0 and 64 of role 1, whatever the data.
    """
    started = distinct.select("fp", F.explode(F.array(*[F.lit(s) for s in range(len(SEGMENTS))])).alias("start"))
    width = F.element_at(F.array(*[F.lit(SEGMENTS[(s + 1) % 5]) for s in range(5)]), F.col("start") + 1)
    keyed = started.select(
        "fp",
        "start",
        F.shiftleft(F.col("start").cast("long"), 26).bitwiseOR(F.shiftleft(_segment(F.col("start"), 0), 13)).bitwiseOR(_segment(F.col("start"), 1)).alias("own"),
        F.explode(F.sequence(F.lit(-1), width - 1)).alias("flip"),
    )
    return keyed.select(
        F.when(F.col("flip") < 0, F.col("own")).otherwise(F.expr("own ^ shiftleft(1L, greatest(flip, 0))")).alias("bucket"),
        F.when(F.col("flip") < 0, 0).otherwise(1).cast("long").alias("role"),
        "fp",
    )


def _chains() -> np.ndarray:
    """masks[start, l]: bits of the chain of l + 1 segments from start."""
    out = np.zeros((5, 5), dtype=np.uint64)
    for s in range(5):
        mask = 0
        for l in range(5):
            at = (s + l) % 5
            mask |= ((1 << SEGMENTS[at]) - 1) << STARTS[at]
            out[s, l] = mask
    return out


_CHAINS = _chains()


def _viable(diff: np.ndarray, start: np.ndarray | int) -> np.ndarray:
    """Chains of three and four segments within budget, then the full check."""
    three = np.bitwise_count(diff & _CHAINS[start, 2]) <= 3 * MAX_BITS // 5
    four = np.bitwise_count(diff & _CHAINS[start, 3]) <= 4 * MAX_BITS // 5
    return three & four & (np.bitwise_count(diff) <= MAX_BITS)


def _link_tile(left: np.ndarray, right: np.ndarray, start: int, forest: Forest) -> None:
    """Union what one tile links, by label passing rather than pair by pair."""
    linked = _viable(left[:, None] ^ right[None, :], start)
    rows, cols = linked.any(1), linked.any(0)
    if not rows.any():
        return
    linked, left, right = linked[rows][:, cols], left[rows], right[cols]
    top = np.iinfo(np.int64).max
    lab_l, lab_r = left.view(np.int64).copy(), right.view(np.int64).copy()
    while True:
        new_r = np.minimum(lab_r, np.where(linked, lab_l[:, None], top).min(0))
        new_l = np.minimum(lab_l, np.where(linked, new_r[None, :], top).min(1))
        if (new_r == lab_r).all() and (new_l == lab_l).all():
            break
        lab_l, lab_r = new_l, new_r
    forest.add(left.view(np.int64), lab_l)
    forest.add(right.view(np.int64), lab_r)


def _link_blocks(left: np.ndarray, right: np.ndarray, start: int, forest: Forest) -> None:
    for i in range(0, len(left), _TILE):
        for j in range(0, len(right), _TILE):
            _link_tile(left[i : i + _TILE], right[j : j + _TILE], start, forest)


def _link_sorted(cell: np.ndarray, start: np.ndarray, role: np.ndarray, fp: np.ndarray, forest: Forest) -> None:
    """Link whole cells; rows are sorted by cell, role 0 first."""
    if not len(cell):
        return
    begin = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
    size = np.diff(np.r_[begin, len(cell)])
    for b, n in zip(begin[size > SHIFTS].tolist(), size[size > SHIFTS].tolist()):
        lefts = int((role[b : b + n] == 0).sum())
        if lefts:
            _link_blocks(fp[b : b + lefts], fp[b : b + n], int(start[b]), forest)
    short = np.repeat(size <= SHIFTS, size)
    at = np.flatnonzero(short & (role == 0))
    for d in range(1, SHIFTS):
        at = at[at + d < len(cell)]
        at = at[cell[at] == cell[at + d]]
        if not len(at):
            break
        diff = fp[at] ^ fp[at + d]
        hit = at[_viable(diff, start[at])]
        forest.add(fp[hit].view(np.int64), fp[hit + d].view(np.int64))


def _link_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Star edges of a partition sorted by (bucket, block, role)."""
    forest = Forest()
    rest = np.zeros((0, 4), dtype=np.int64)

    def link(rows: np.ndarray) -> None:
        cell = np.cumsum(np.r_[0, ((rows[1:, 0] != rows[:-1, 0]) | (rows[1:, 1] != rows[:-1, 1])).astype(np.int64)]) if len(rows) else rows[:, 0]
        _link_sorted(cell, (rows[:, 0] >> 26).astype(np.int64), rows[:, 2], np.ascontiguousarray(rows[:, 3]).view(np.uint64), forest)

    for batch in regrouped(batches):
        new = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)], axis=1)
        rows = np.concatenate([rest, new]) if len(rest) else new
        if not len(rows):
            continue
        last = np.flatnonzero((rows[:, 0] != rows[-1, 0]) | (rows[:, 1] != rows[-1, 1]))
        cut = int(last[-1]) + 1 if len(last) else 0
        link(rows[:cut])
        rest = rows[cut:]
        lefts = int((rest[:, 2] == 0).sum())
        if len(rest) - lefts > 64 * BLOCK:  # a long cell: compared so far, its left block stays
            link(rest)
            rest = rest[:lefts]
        if len(forest.parent) > FOREST_NODES:
            yield forest.drain()
    link(rest)
    yield forest.drain()


def simhash_links(distinct: DataFrame) -> DataFrame:
    """Forest edges (src, dst) that join fingerprints at 4 or fewer bits.

    ``distinct`` has each fp once. Pairs are never written: a bucket's links
    leave a task as a forest. A bucket with over BLOCK members is dealt into
    blocks, each compared with the whole bucket, so no task holds all of it.
    """
    entries = ring_entries(distinct)
    own = ring_entries(distinct).where("role = 0")
    hot = materialize(own.groupBy("bucket").agg(F.count("*").alias("n")).where(F.col("n") > BLOCK))
    n_hot = hot.count()
    if n_hot:
        blocks = hot.select("bucket", F.ceil(F.col("n") / BLOCK).cast("long").alias("blocks"))
        blocks = F.broadcast(blocks) if n_hot <= 10_000 else blocks
        dealt = entries.join(blocks, "bucket", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1).cast("long")))
        mine = F.pmod(F.xxhash64("fp"), F.col("blocks"))
        cells = dealt.select("bucket", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"), "role", "fp", mine.alias("mine"))
        cells = cells.select("bucket", "block", F.when((F.col("role") == 0) & (F.col("mine") == F.col("block")), 0).otherwise(1).cast("long").alias("role"), "fp")
        placed = cells.repartition("bucket", "block")
    else:
        cells = entries.select("bucket", F.lit(0).cast("long").alias("block"), "role", "fp")
        placed = cells.repartition("bucket")
    ordered = placed.sortWithinPartitions("bucket", "block", "role")
    return map_arrow(ordered, _link_cells, "src long, dst long")


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp, component_id) of every row of ``docs`` by the stages' rule.

    Linked are documents whose sets of five-word shingles have a similarity of
    0.8 or more; fp stands for the set (``near_dup``). The contract of op8, 4
    bits of a fingerprint over four words, is ``hamming_components``.
    """
    from loomwork.llm.near_dup import near_components

    return near_components(docs, id_col, text_col)


def hamming_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, fp, component_id) of every row of ``docs``, linked at 4 or fewer bits.

    component_id is the smallest doc_id that links reach; texts without a word
    (null, empty, white space) share fingerprint zero and link like any other.
    Rows with a null id get a component but never name one, unless no id of
    the component is known; repeated rows are returned as often as they come.
    """
    found = materialize(fingerprints(docs, id_col, text_col, shingle))
    distinct = materialize(found.select("fp").distinct())
    return name_components(found, simhash_links(distinct))


def name_components(found: DataFrame, links: DataFrame) -> DataFrame:
    """(doc_id, fp, component_id) of every row of ``found`` (doc_id, fp), whose fps ``links`` (src, dst) join."""
    distinct = found.select("fp").distinct()
    parts = connected_components(links)
    labelled = distinct.join(parts, distinct["fp"] == parts["node"], "left").select(
        distinct["fp"].alias("_fp"), F.coalesce("component", distinct["fp"]).alias("_part")
    )
    first = found.groupBy("fp").agg(F.min("doc_id").alias("_first"))
    by_fp = labelled.join(first, F.col("_fp") == first["fp"]).select("_fp", "_part", "_first")
    smallest = by_fp.groupBy("_part").agg(F.min("_first").alias("component_id"))
    named = materialize(by_fp.join(smallest, "_part").select("_fp", "component_id"))
    return found.join(named, F.col("fp") == F.col("_fp"), "left").select("doc_id", "fp", "component_id")


def simhash_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each near-duplicate group: the smallest id."""
    return one_of_each(docs, simhash_components(docs, id_col, text_col), id_col)


def one_of_each(docs: DataFrame, parts: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``docs`` with the document of the smallest id of each component of ``parts``.

    All columns stay. Repeated rows of a kept id count as copies of each other
    and leave one; rows whose id is null are kept only if nothing stands for
    their group.
    """
    stands = F.col("doc_id").eqNullSafe(F.col("component_id"))
    ids = materialize(parts.groupBy("doc_id").agg(F.max(stands).alias("stands"), F.count("*").alias("rows")).where("NOT stands OR rows > 1"))
    # the few ids that go, not the many that stay: a join that can broadcast moves no text
    gone, again = (ids.where(c).select(F.col("doc_id").alias("_other")) for c in ("NOT stands", "stands AND rows > 1"))
    same = F.col("_id").eqNullSafe(F.col("_other"))
    rows = packed(docs, _id=F.col(id_col).cast("long")).join(gone, same, "left_anti")
    if not again.limit(1).count():
        return unpacked(rows)
    first = rows.join(again, same, "left_semi").groupBy("_id").agg(F.first("doc").alias("doc"))
    return unpacked(rows.join(again, same, "left_anti").select("doc").unionByName(first.select("doc")))
