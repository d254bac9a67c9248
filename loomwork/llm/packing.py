"""Order-preserving packing of token streams by dynamic programming.

Documents are laid end to end in their order; a window is what lies between
two cuts. Cuts may fall after a document, after a sentence or, in a long run
without either, every FORCED tokens; each kind has its penalty. The cheapest
cuts minimise padding plus penalties; a monotone queue gives each transition
over all starts within one window. A partition packs alone: no shuffle.
"""

from __future__ import annotations

import base64
import zlib
from collections import deque
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwork.llm.common import map_arrow

WINDOW = 2048
END_ID = 1
#: Strings that the library reads as one token where they stand in a text.
SPECIAL = ("<|endoftext|>",)
#: Price of a cut, in tokens of padding: after a sentence, inside one.
SENTENCE_CUT = 8
FORCED_CUT = 48
#: Tokens between possible cuts inside a long sentence.
FORCED = 64
#: Price of a window that is short and a power of two: it has no padding but is
#: a sequence more, so it pays at the end of a stream and not within.
SHORT = 256
#: Tokens planned at once; the last windows of a plan wait for what follows.
HORIZON = 1 << 19
_KEEP = 16


class Tokenizer:
    """ids of texts under a byte-level BPE file of the ``tokenizers`` library.

    The same vocabulary as tiktoken ranks gives the same ids about five times
    as fast; where it is absent, or a text is too much for its pattern engine,
    the library itself encodes. It is loaded only then: a worker's memory
    rarely holds both.
    """

    def __init__(self, path: str, ranks_path: str | None = None, special: tuple[str, ...] = SPECIAL) -> None:
        self.path, self.special, self.fast = path, special, None
        if ranks_path:
            import public_tokenizers
            import tiktoken

            with open(ranks_path, "rb") as lines:
                ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines)}
            self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
            ends = [i for token, i in ranks.items() if token[-1] in b".!?" or b"\n" in token]
            size = max(ranks.values()) + 1 + len(special)
        else:
            vocabulary = self.library.get_vocab()
            ends = [i for token, i in vocabulary.items() if token[-1] in ".!?" or "\u010a" in token]  # U+010A: a line feed in this alphabet
            size = len(vocabulary)
        self.sentence_end = np.zeros(max(size, END_ID) + 1, dtype=bool)
        self.sentence_end[ends] = True

    @cached_property
    def library(self):
        from tokenizers import Tokenizer as Library

        return Library.from_file(self.path)

    def encode(self, text: str) -> np.ndarray:
        if self.fast is not None and not any(s in text for s in self.special):
            try:
                return np.asarray(self.fast.encode_ordinary(text), dtype=np.uint32)
            except BaseException as e:  # the pattern engine's panics are no Exception
                if isinstance(e, (KeyboardInterrupt, SystemExit, GeneratorExit)):
                    raise
        return np.asarray(self.library.encode(text, add_special_tokens=False).ids, dtype=np.uint32)


def cut_places(ids: np.ndarray, doc_ends: np.ndarray, sentence_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ascending places where a window may end, and their penalties.

    A place p is a cut after the first p tokens; the last is the stream's end.
    """
    marked = sentence_end[ids]
    runs = np.flatnonzero(marked[:-1] & ~marked[1:]) + 1  # after the last mark of a run
    base = np.unique(np.concatenate([runs, doc_ends, [len(ids)]]))
    gaps = np.diff(np.r_[0, base])
    long = np.flatnonzero(gaps > FORCED)
    inner = [np.arange(base[k] - gaps[k] + FORCED, base[k], FORCED) for k in long]
    places = np.unique(np.concatenate([base, *inner]))
    penalty = np.full(len(places), FORCED_CUT, dtype=np.int64)
    penalty[np.searchsorted(places, runs)] = SENTENCE_CUT
    penalty[np.searchsorted(places, doc_ends)] = 0
    penalty[-1] = 0
    return places, penalty


def plan_windows(places: np.ndarray, penalty: np.ndarray, window: int = WINDOW, short: int = SHORT) -> list[int]:
    """The cheapest cuts: ascending places, the last included.

    A window of n tokens costs window - n of padding, or SHORT at most if n is a
    smaller power of two, plus the penalty of its end. Places lie at most ``window``
    apart.
    """
    n = len(places)
    at = np.r_[0, places]
    exact: dict[int, list[int]] = {}
    power = 1
    while power < window:  # starts from which a window has no padding
        start = np.searchsorted(at, at - power)
        found = np.flatnonzero((at >= power) & (at[np.minimum(start, n)] == at - power))
        for j, i in zip(found.tolist(), start[found].tolist()):
            exact.setdefault(j, []).append(i)
        power *= 2
    at_list, price = at.tolist(), penalty.tolist()
    best, back = [0] * (n + 1), [0] * (n + 1)
    queue: deque[tuple[int, int]] = deque([(0, 0)])  # (best + place, index), least first
    for j in range(1, n + 1):
        here = at_list[j]
        floor = here - window
        while at_list[queue[0][1]] < floor:
            queue.popleft()
        value, i = queue[0]
        cost = value + window - here
        if j in exact:
            for k in exact[j]:
                if best[k] + short < cost:
                    cost, i = best[k] + short, k
        cost += price[j - 1]
        best[j], back[j] = cost, i
        key = cost + here
        while queue and queue[-1][0] >= key:
            queue.pop()
        queue.append((key, j))
    cuts, j = [], n
    while j:
        cuts.append(at_list[j])
        j = back[j]
    return cuts[::-1]


class Packer:
    """Packs one ordered stream of documents; pieces come out as they are sure."""

    def __init__(self, tokenizer: Tokenizer, first_sequence: int, window: int = WINDOW) -> None:
        self.tokenizer, self.sequence, self.window = tokenizer, first_sequence, window
        self.parts: list[np.ndarray] = []
        self.docs: list[list[int]] = []  # doc_id, start of the part, its length, all its ids
        self.waiting = 0

    def add(self, doc_id: int | None, text: str | None) -> Iterator[dict]:
        ids = np.append(self.tokenizer.encode(text or ""), np.uint32(END_ID)).astype(np.uint32)
        self.parts.append(ids)
        self.docs.append([doc_id, 0, len(ids), len(ids)])
        self.waiting += len(ids)
        if self.waiting >= HORIZON:
            yield from self._plan(False)

    def close(self) -> Iterator[dict]:
        if self.waiting:
            yield from self._plan(True)

    def _plan(self, last: bool) -> Iterator[dict]:
        ids = np.concatenate(self.parts)
        lengths = np.array([d[2] for d in self.docs], dtype=np.int64)
        ends = np.cumsum(lengths)
        places, penalty = cut_places(ids, ends, self.tokenizer.sentence_end)
        cuts = plan_windows(places, penalty, self.window)
        if not last:
            cuts = cuts[: max(1, len(cuts) - _KEEP)]
        edges = np.unique(np.concatenate([np.array(cuts, dtype=np.int64), ends[ends < cuts[-1]]]))
        begins = np.r_[0, edges[:-1]]
        owner = np.searchsorted(ends, begins, side="right")
        window = np.searchsorted(np.array(cuts), begins, side="right")
        cut_starts = np.r_[0, cuts]
        raw = ids.astype("<u4")
        for b, e, d, w in zip(begins.tolist(), edges.tolist(), owner.tolist(), window.tolist()):
            doc_id, start, length, total = self.docs[d]
            yield {
                "doc_id": doc_id,
                "start": start + b - (int(ends[d]) - length),
                "length": e - b,
                "ids_crc32": zlib.crc32(raw[b:e].tobytes()),
                "doc_tokens": total,
                "sequence_id": self.sequence + w,
                "offset": b - int(cut_starts[w]),
                "ids": raw[b:e],
            }
        self.sequence += len(cuts)
        done = cuts[-1]
        first = int(np.searchsorted(ends, done, side="right"))
        rest = [list(d) for d in self.docs[first:]]
        if rest:
            used = done - (int(ends[first]) - int(lengths[first]))
            rest[0][1] += used
            rest[0][2] -= used
        self.docs, self.parts, self.waiting = rest, [ids[done:].copy()] if rest else [], len(ids) - done


_SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
_loaded: dict[tuple, Tokenizer] = {}


def _tokenizer(path: str, ranks_path: str | None) -> Tokenizer:
    key = (path, ranks_path)
    if key not in _loaded:
        _loaded[key] = Tokenizer(path, ranks_path)
    return _loaded[key]


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    ranks_path: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece of a document in a sequence.

    Columns doc_id, start, length, ids_crc32, doc_tokens, sequence_id and
    offset, with ``with_ids`` also the piece's ids. A null or empty text is
    the end id alone; repeated rows are packed one by one, with their id as it
    is, null included; an empty table gives an empty result. Sequence ids are unique: the partition in the
    high bits, a running number below.
    """
    schema = _SCHEMA + (", ids array<long>" if with_ids else "")
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        context = TaskContext.get()
        packer = Packer(_tokenizer(tokenizer_path, ranks_path), (context.partitionId() if context else 0) << 33, window)
        rows: list[dict] = []

        def table() -> pa.RecordBatch:
            columns = [pa.array([r[c] for r in rows], pa.list_(pa.int64()) if c == "ids" else pa.int64()) for c in names]
            return pa.RecordBatch.from_arrays(columns, names)

        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                rows.extend(packer.add(doc_id.as_py(), text.as_py()))
                if len(rows) >= (1000 if with_ids else 10_000):
                    yield table()
                    rows = []
        rows.extend(packer.close())
        yield table()

    return map_arrow(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), run, schema)
