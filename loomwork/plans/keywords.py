"""Keywords of groups found in texts as whole words, misspelt ones too.

Names are compared without marks and case. Short or common keywords count only
capitalised; long ones also with one typing error (a letter left out, added,
changed, or two neighbours swapped, the first letter kept), unless the result
is a keyword itself, a common word, or near keywords of different groups. The
keywords, a configuration of bounded size, are indexed by what one deletion
leaves of them, and each task remembers the words that it has judged.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, StructField, StructType

from loomwork.functions.text import match_key

#: Keywords, at most: they go to every task.
MOST = 200_000
#: Words that a task remembers.
_MEMORY = 500_000
# Letters that an error can bring in, the least length of a keyword that may be misspelt,
# the greatest of one that counts only capitalised, and the endings of regular English forms.
LETTERS = frozenset("abcdefghijklmnopqrstuvwxyz")
LEAST_MISSPELT = 8
MOST_AMBIGUOUS = 4
FORMS = (("ies", "y"), ("ses", "s"), ("xes", "x"), ("zes", "z"), ("ches", "ch"), ("shes", "sh"), ("s", ""), ("ed", ""), ("ed", "e"), ("ing", ""), ("ing", "e"), ("ly", ""))
_WORD = regex.compile(r"[\p{L}\p{N}]+")


@dataclass(frozen=True)
class Rules:
    """What a deployment says of its keywords: never match, match in any case, only capitalised; and known words."""

    blocked: frozenset[str] = frozenset()
    always: frozenset[str] = frozenset()
    capitalised: frozenset[str] = frozenset()
    known_words: frozenset[str] = frozenset()


def is_known(word: str, words: frozenset[str]) -> bool:
    """Whether a word, or what it is a regular form of, is known."""
    bases = (word[: len(word) - len(a)] + b for a, b in FORMS if word.endswith(a) and not (a == "s" and word.endswith("ss")))
    return word in words or any(base in words for base in bases)


def without_one(word: str) -> set[str]:
    """What leaving one character out gives, the first kept."""
    return {word[:i] + word[i + 1 :] for i in range(1, len(word))}


def one_error(right: str, written: str) -> bool:
    """Whether one typing error turns ``right`` into ``written``, the first letter kept."""
    n, m = len(right), len(written)
    if right == written or abs(n - m) > 1 or right[:1] != written[:1]:
        return False
    if m < n:
        return written in without_one(right)
    if m > n:
        return any(written[i] in LETTERS and written[:i] + written[i + 1 :] == right for i in range(1, m))
    apart = [i for i in range(n) if right[i] != written[i]]
    if len(apart) == 1:
        return right[apart[0]] != " " and written[apart[0]] in LETTERS
    return len(apart) == 2 and apart[1] == apart[0] + 1 and right[apart[0]] == written[apart[1]] and right[apart[1]] == written[apart[0]]


@dataclass
class Matcher:
    """Keywords of (key, normalised keyword) rows, ready to search."""

    rows: Iterable[tuple[object, str]]
    rules: Rules = Rules()
    typos: bool = True
    exact: dict[str, frozenset] = field(default_factory=dict)
    capital: dict[str, frozenset] = field(default_factory=dict)
    near: dict[str, list[str]] = field(default_factory=dict)

    def __post_init__(self) -> None:
        keys: dict[str, set] = {}
        for key, keyword in self.rows:
            if keyword and keyword not in self.rules.blocked:
                keys.setdefault(keyword, set()).add(key)
        self.rows = ()
        self.every = frozenset(keys)
        for keyword, owners in keys.items():
            short = len(keyword) <= MOST_AMBIGUOUS and keyword not in self.rules.always
            if short or keyword in self.rules.capitalised:
                self.capital[keyword[0].upper() + keyword[1:]] = frozenset(owners)
                continue
            self.exact[keyword] = frozenset(owners)
            if self.typos and len(keyword) >= LEAST_MISSPELT:
                for left in {keyword} | without_one(keyword):
                    self.near.setdefault(left, []).append(keyword)
        runs = [len(_WORD.findall(k)) for k in self.every]
        self.longest = max(runs, default=0) + (1 if self.near else 0)
        self.widest = max(map(len, self.every), default=0) + 1
        self.memory: dict[str, frozenset] = {}

    def misspelt(self, written: str) -> frozenset:
        """The groups of the keywords that ``written`` misspells, if they agree."""
        if not LEAST_MISSPELT - 1 <= len(written) or written in self.every or written in self.rules.blocked:
            return frozenset()
        close = {k for left in {written} | without_one(written) for k in self.near.get(left, ())}
        owners = {self.exact[k] for k in close if one_error(k, written)}
        if len(owners) != 1 or is_known(written, self.rules.known_words):
            return frozenset()
        return owners.pop()

    def _judge(self, written: str) -> frozenset:
        if written not in self.memory:
            if len(self.memory) > _MEMORY:
                self.memory.clear()
            lowered = written.lower()
            found = self.exact.get(lowered, frozenset()) | self.capital.get(written, frozenset())
            self.memory[written] = found | (self.misspelt(lowered) if self.near else frozenset())
        return self.memory[written]

    def keys(self, plain: str) -> set:
        """Keys of the keywords in a text without marks, its case kept."""
        spans = [m.span() for m in _WORD.finditer(plain)]
        out: set = set()
        for i, (begin, _) in enumerate(spans):
            for _, end in spans[i : i + self.longest]:
                if end - begin > self.widest:
                    break
                out |= self._judge(plain[begin:end])
        return out


def keyword_hits(rows: DataFrame, id_col: str, text_col: str, keywords: DataFrame, rules: Rules = Rules(), typos: bool = True) -> DataFrame:
    """(id, keys): sorted distinct keys of the rows with a hit.

    ``keywords`` is (key, keyword) in any spelling; more than MOST are refused.
    Each row is searched where it lies.
    """
    listed = keywords.select("key", match_key(F.col("keyword")).alias("keyword")).where("key IS NOT NULL AND keyword <> ''").distinct().limit(MOST + 1).collect()
    if len(listed) > MOST:
        raise ValueError(f"more than {MOST} keywords")
    shared = rows.sparkSession.sparkContext.broadcast(([tuple(r) for r in listed], rules, typos))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(*shared.value)
        for batch in batches:
            found = [sorted(matcher.keys(t)) if t else [] for t in batch.column(1).to_pylist()]
            some = [i for i, keys in enumerate(found) if keys]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(some, pa.int64())), pa.array([found[i] for i in some], schema.field("keys").type)], ["id", "keys"])

    frame = rows.select(F.col(id_col).alias("id"), match_key(F.col(text_col), lower=False).alias("text"))
    out = StructType([frame.schema["id"], StructField("keys", ArrayType(keywords.schema["key"].dataType))])
    schema = to_arrow_schema(out)
    return frame.mapInArrow(run, out)
