"""Licence scan with ordered signature rules.

One pass of a keyword automaton says which rules can match a text; only those
run. Of the detections, one that lies inside another of higher order is
suppressed.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, replace

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwork.llm.common import map_arrow

from loomwork.llm.license_rules import BASE_PHRASES, RULES, Rule

#: Bytes to what separates words there: all ASCII but digits and letters to spaces, A-Z to a-z.
_FOLD = bytes(
    c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else c + 32 if 0x41 <= c <= 0x5A else 32 for c in range(256)
)

_SPACE = re.compile(r"\s+")
_SPACES = re.compile(r"\s\s+")


@dataclass(frozen=True)
class Detection:
    label: str
    start: int
    end: int
    priority: int
    rule: int


class Scanner:
    """Compiled rules behind their keyword prefilter."""

    def __init__(self, rules: tuple[Rule, ...] = RULES) -> None:
        self.rules = rules
        self.patterns = [re.compile(r.pattern) for r in rules]
        by_keyword: dict[str, list[int]] = {}
        for i, r in enumerate(rules):
            by_keyword.setdefault(r.keyword, []).append(i)
        self.automaton = ahocorasick.Automaton()
        for keyword, numbers in by_keyword.items():
            self.automaton.add_word(keyword, numbers)
        self.automaton.make_automaton()

    def candidates(self, lowered: str) -> list[int]:
        """Rules whose keyword occurs, in order."""
        return sorted({i for _, numbers in self.automaton.iter(lowered) for i in numbers})

    def scan(self, lowered: str) -> list[Detection]:
        """Detections that no other suppresses, by place.

        Rules see each run of white space as one space, so that a wrapped text
        matches; places are those of ``lowered``.
        """
        plain = _SPACE.sub(" ", lowered)
        found = [
            Detection(self.rules[i].label, m.start(), m.end(), self.rules[i].priority, i)
            for i in self.candidates(plain)
            for m in self.patterns[i].finditer(plain)
        ]
        if not found or len(plain) == len(lowered):
            return suppress(found)
        # places[k] of the plain text and all after it lie shifts[k] further on
        places, shifts = [0], [0]
        for m in _SPACES.finditer(lowered):
            places.append(m.start() - shifts[-1] + 1)
            shifts.append(shifts[-1] + m.end() - m.start() - 1)
        origin = lambda at: at + shifts[bisect_right(places, at) - 1]
        return suppress([replace(d, start=origin(d.start), end=origin(d.end - 1) + 1) for d in found])


def suppress(found: list[Detection]) -> list[Detection]:
    """Drop a detection that lies inside another of higher order.

    The order is priority, then length, then rule. Sorted by start and falling
    end, what contains a detection comes before it; it is of higher order if its
    priority is no less. The furthest end by priority tells, so the cost is
    linear in detections times priorities.
    """
    out: list[Detection] = []
    reach: dict[int, int] = {}
    for d in sorted(found, key=lambda d: (d.start, -d.end, -d.priority, d.rule)):
        if not any(end >= d.end for priority, end in reach.items() if priority >= d.priority):
            out.append(d)
        reach[d.priority] = max(reach.get(d.priority, 0), d.end)
    return out


def base_places(text: str) -> tuple[int, list[tuple[int, int, str]]]:
    """(number of words, base places as (first word, last word + 1, label)).

    Words are runs of ASCII letters and digits and of all beyond ASCII, A-Z
    lower-cased. Every start counts, overlapping ones too.
    """
    words = text.encode().translate(_FOLD).split()
    joined = b" " + b" ".join(words) + b" "
    places = []
    for phrase, label in BASE_PHRASES.items():
        needle = f" {phrase} ".encode()
        at, seen, first = joined.find(needle), 0, 0
        while at >= 0:
            first += joined.count(b" ", seen, at)
            seen = at
            places.append((first, first + phrase.count(" ") + 1, label))
            at = joined.find(needle, at + 1)
    return len(words), sorted(places)


def scan_text(text: str | None, scanner: Scanner) -> dict:
    """The digest of one text; a null text is empty."""
    text = text or ""
    n_words, places = base_places(text)
    base = {label for _, _, label in places}
    detections = scanner.scan(text.encode().lower().decode())  # bytes: A-Z alone
    labels = base | {d.label for d in detections}
    score = max([d.priority / 100 for d in detections] + [0.6] * bool(base), default=0.0)
    return {
        "n_words": n_words,
        "n_base": len(places),
        "first_word": min((p[0] for p in places), default=None),
        "last_word": max((p[0] for p in places), default=None),
        "base_labels": ",".join(sorted(base)),
        "labels": ",".join(sorted(labels)),
        "score": score,
        "spans": [(d.label, d.start, d.end, d.priority) for d in detections],
    }


_scanner: Scanner | None = None


def shared_scanner() -> Scanner:
    global _scanner
    if _scanner is None:
        _scanner = Scanner()
    return _scanner


_DIGEST = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"
_SPANS = "spans array<struct<label: string, start: int, end: int, priority: int>>"


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, the digest and the spans found.

    Null and empty texts have no word, no label ('' in both lists) and score
    0; spans are code point places in the lower-cased text. Repeated rows and
    null ids are returned as they come; other columns are not read.
    """
    names = [c.split()[0] for c in _DIGEST.split(", ")]
    span_type = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("priority", pa.int32())]))
    types = [pa.int64()] * 4 + [pa.string(), pa.string(), pa.float64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = shared_scanner()
        for batch in batches:
            rows = [scan_text(t.as_py(), scanner) for t in batch.column(1)]
            columns = [pa.array([r[c] for r in rows], t) for c, t in zip(names, types)]
            spans = [[dict(zip(("label", "start", "end", "priority"), s)) for s in r["spans"]] for r in rows]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns, pa.array(spans, span_type)], ["doc_id", *names, "spans"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return map_arrow(rows, run, f"doc_id long, {_DIGEST}, {_SPANS}")
