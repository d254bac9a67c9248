"""Boolean text queries over DataFrames.

Words are joined by AND; AND, OR, NOT, +, |, -word as operators, "..." for
phrases, parentheses for grouping, ~N after a word or phrase is read over. Text
and queries go through one analyser: Latin letters folded to ASCII, lower case,
runs of letters and digits of any script as words, Han and kana signs one by
one, English plurals off in prose. Evaluated in one scan, or from a table of
positions dealt by word.
"""

from __future__ import annotations

import operator
import re
import unicodedata
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

import regex
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomwork.functions.text import STROKED, fold_ascii

TOTAL_CAP = 10_000
WINDOW = 10_000
#: A sign of a script written without spaces, or a run of letters, digits and marks.
WORD = r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}]|[\p{L}\p{M}\p{N}&&[^\p{IsHan}\p{IsHiragana}\p{IsKatakana}]]+"
_QUERY_WORD = regex.compile(r"(?V1)[\p{Han}\p{Hiragana}\p{Katakana}]|[[\p{L}\p{M}\p{N}]--[\p{Han}\p{Hiragana}\p{Katakana}]]+")
#: English plural endings and what they become, the first that fits; for words over three letters.
PLURALS = ((r"(?<![ae])ies", "y"), (r"(?<![aeo])es", "e"), (r"(?<![us])s", ""))
_LEXEME = re.compile(
    r'"(?P<phrase>[^"]*)"(?:~\d*)?|(?P<open>\()|(?P<close>\))|(?P<either>\||\bOR\b)|(?P<both>\+|\bAND\b)|(?P<without>-(?=[^\s)])|\bNOT\b)|(?P<word>[^\s()|+"~]+)(?:~\d*)?|(?P<other>.)',
    re.S,
)


@dataclass(frozen=True)
class Term:
    """One word, or the words of a phrase."""

    words: tuple[str, ...]


@dataclass(frozen=True)
class Node:
    """and, or, not over parts; none matches nothing."""

    kind: str
    parts: tuple


def analysed(c: Column, stem: bool = False) -> Column:
    """The words of a text in order; null has none."""
    words = F.regexp_extract_all(F.lower(fold_ascii(F.coalesce(c, F.lit("")))), F.lit(WORD), F.lit(0))
    return F.transform(words, stemmed) if stem else words


def stemmed(word: Column) -> Column:
    """An English word without its plural ending."""
    shorter = word
    for ending, instead in reversed(PLURALS):
        shorter = F.when(word.rlike(f"{ending}\\z"), F.regexp_replace(word, f"{ending}\\z", instead)).otherwise(shorter)
    return F.when((F.length(word) > 3) & word.endswith("s"), shorter).otherwise(word)


def analyse(text: str, stem: bool = False) -> tuple[str, ...]:
    """analysed() of a query's words."""
    for letter, plain in STROKED.items():
        text = text.replace(letter, plain)
    parts = (unicodedata.normalize("NFD", x) for x in text)
    folded = "".join(p[0] if p[0].isascii() else x for p, x in zip(parts, text))
    words = _QUERY_WORD.findall(re.sub("[\u0300-\u036f]", "", folded).lower())
    return tuple(_stem(w) for w in words) if stem else tuple(words)


def _stem(word: str) -> str:
    if len(word) > 3:
        for ending, instead in PLURALS:
            if re.search(rf"{ending}\Z", word):
                return re.sub(rf"{ending}\Z", instead, word)
    return word


@dataclass
class _Group:
    """What stands between two brackets while it is read: alternatives of parts that must all hold."""

    negated: bool = False
    alternatives: list[list] = field(default_factory=lambda: [[]])
    minus: bool = False

    def add(self, part: Node | Term | None) -> None:
        if part is not None:
            self.alternatives[-1].append(Node("not", (part,)) if self.minus else part)
        self.minus = False

    def tree(self) -> Node | Term | None:
        full = [a[0] if len(a) == 1 else Node("and", tuple(a)) for a in self.alternatives if a]
        out = None if not full else full[0] if len(full) == 1 else Node("or", tuple(full))
        return Node("not", (out,)) if out is not None and self.negated else out


def parse(q: str, stem: bool = False) -> Node | Term | None:
    """Predicate tree of a query.

    None, for an empty query, matches all; a query whose words all vanish
    matches nothing. Operators without a partner, single quotes and brackets
    are read over.
    """
    groups = [_Group()]

    def close() -> None:
        done = groups.pop()
        groups[-1].add(done.tree())

    for found in _LEXEME.finditer(q):
        kind, here = found.lastgroup, groups[-1]
        if kind == "open":
            groups.append(_Group(negated=here.minus))
            here.minus = False
        elif kind == "close" and len(groups) > 1:
            close()
        elif kind == "either":
            here.minus = False
            here.alternatives.append([])
        elif kind == "without":
            here.minus = not here.minus
        elif kind in ("word", "phrase"):
            words = analyse(found[kind], stem)
            here.add(Term(words) if words else None)
    while len(groups) > 1:
        close()
    tree = groups[0].tree()
    return Node("none", ()) if tree is None and q.strip() else tree


def terms(tree: Node | Term | None) -> list[Term]:
    if tree is None:
        return []
    if isinstance(tree, Term):
        return [tree]
    return list(dict.fromkeys(t for p in tree.parts for t in terms(p)))


def postings(rows: DataFrame, id_col: str, text_col: str, stem: bool = False) -> DataFrame:
    """(id, pos, token) of the analysed text."""
    return rows.select(F.col(id_col).alias("id"), F.posexplode(analysed(F.col(text_col), stem)).alias("pos", "token"))


def _test(node: Node | Term | None, holds: Callable[[Term], Column]) -> Column:
    """The tree as a condition over what tells whether a term is there."""
    if node is None:
        return F.lit(True)
    if isinstance(node, Term):
        return holds(node)
    parts = [_test(p, holds) for p in node.parts]
    if node.kind == "none":
        return F.lit(False)
    if node.kind == "not":
        return ~parts[0]
    return reduce(operator.and_ if node.kind == "and" else operator.or_, parts)


def _score(tree: Node | Term | None, fields: dict[str, float], times: Callable[[Term, str], Column]) -> Column:
    parts = (F.lit(float(weight)) * F.log1p(times(t, f).cast("double")) for t in positive(tree) for f, weight in fields.items())
    return reduce(operator.add, parts, F.lit(0.0))


def matches(rows: DataFrame, id_col: str, fields: dict[str, float], q: str, stem: bool = False) -> DataFrame:
    """(id, score) of the rows a query matches.

    The score adds, for each positive term, the weight of every field that has
    it times ln(1 + occurrences). Each row decides alone: no shuffle.
    """
    tree = parse(q, stem)
    padded = {f: F.concat(F.lit(" "), F.array_join(analysed(F.col(f), stem), "  "), F.lit(" ")) for f in fields}
    staged = rows.select(F.col(id_col).alias("id"), *[c.alias(f"_f_{f}") for f, c in padded.items()])
    names = {t: f"_t{i}" for i, t in enumerate(terms(tree))}

    def count(term: Term, f: str) -> Column:
        return F.regexp_count(F.col(f"_f_{f}"), F.lit(" " + "  ".join(term.words) + " "))

    def times(term: Term, f: str) -> Column:
        return F.col(f"{names[term]}.{f}")

    counted = staged.select("id", *[F.struct(*[count(t, f).alias(f) for f in fields]).alias(n) for t, n in names.items()])
    holds = lambda t: F.greatest(F.lit(0), *[times(t, f) for f in fields]) > 0
    return counted.where(_test(tree, holds)).select("id", _score(tree, fields, times).alias("score"))


#: Parts of an index by hash of the word.
INDEX_PARTS = 64


def write_index(rows: DataFrame, id_col: str, fields: list[str], path: str, parts: int = INDEX_PARTS, stem: bool = False) -> None:
    """Positions of every word as Parquet, dealt to folders by hash of the word and sorted by it.

    A very frequent word is spread over eight files by id, so that no task
    writes a hot word alone.
    """
    listed = F.array(*[F.struct(F.lit(f).alias("field"), analysed(F.col(f), stem).alias("words")) for f in fields])
    by_field = rows.select(F.col(id_col).alias("id"), F.explode(listed).alias("f"))
    found = by_field.select("id", F.col("f.field").alias("field"), F.posexplode("f.words").alias("pos", "token"))
    dealt = found.groupBy("token", "id", "field").agg(F.array_sort(F.collect_list("pos")).alias("at"))
    dealt = dealt.withColumn("part", F.pmod(F.xxhash64("token"), F.lit(parts)).cast("int"))
    placed = dealt.repartition("part", F.pmod(F.xxhash64("id"), F.lit(8))).sortWithinPartitions("part", "token", "id")
    placed.write.option("compression", "zstd").partitionBy("part").parquet(path)


def index_matches(spark: SparkSession, path: str, fields: dict[str, float], q: str, parts: int = INDEX_PARTS, stem: bool = False) -> DataFrame:
    """matches() from an index: only the parts and row groups of the query's words are read.

    The query needs a positive term in every alternative, as what it excludes
    alone has no postings.
    """
    tree = parse(q, stem)
    words = sorted({w for t in terms(tree) for w in t.words})
    if tree is None or not words or not _bound(tree):
        raise ValueError("an index answers queries with a positive term in every alternative")
    places = [r[0] for r in spark.createDataFrame([(w,) for w in words], "w string").select(F.pmod(F.xxhash64("w"), F.lit(parts)).cast("int")).collect()]
    read = spark.read.parquet(path).where(F.col("part").isin(places) & F.col("token").isin(words))
    at = {(w, f): f"p{i}_{j}" for i, w in enumerate(words) for j, f in enumerate(fields)}
    pick = [F.max(F.when((F.col("token") == w) & (F.col("field") == f), F.col("at"))).alias(name) for (w, f), name in at.items()]
    held = read.groupBy("id").agg(*pick)

    def times(term: Term, f: str) -> Column:
        return F.size(reduce(F.array_intersect, [begins(F.col(at[w, f]), i) for i, w in enumerate(term.words)]))

    def begins(positions: Column, place: int) -> Column:
        """Where a phrase would begin that has a word at its ``place``."""
        return F.transform(F.coalesce(positions, F.array().cast("array<int>")), lambda p: p - place)

    holds = lambda t: F.greatest(F.lit(0), *[times(t, f) for f in fields]) > 0
    return held.where(_test(tree, holds)).select("id", _score(tree, fields, times).alias("score"))


def _bound(node: Node | Term | None) -> bool:
    """Whether every row that a tree matches has one of its terms."""
    if node is None or isinstance(node, Term):
        return node is not None
    if node.kind in ("and", "none"):
        return node.kind == "none" or any(_bound(p) for p in node.parts)
    return node.kind == "or" and all(_bound(p) for p in node.parts)


def blended(score: Column, rank: Column, weight: float = 0.5) -> Column:
    """Relevance with a bounded share of popularity: the logarithm of a count."""
    return score + F.lit(weight) * F.log1p(F.coalesce(rank.cast("double"), F.lit(0.0)))


def ordered_by(mode: str, id_col: str = "id", date_col: str = "date") -> list[Column]:
    """Sort columns of a mode: relevance, newest or oldest; missing last, then score, then id."""
    modes = {
        "relevance": [F.desc_nulls_last("score")],
        "newest": [F.desc_nulls_last(date_col), F.desc_nulls_last("score")],
        "oldest": [F.asc_nulls_last(date_col), F.desc_nulls_last("score")],
    }
    if mode not in modes:
        raise ValueError(f"unknown sort mode {mode}")
    return [*modes[mode], F.col(id_col)]


def page_after(rows: DataFrame, key: str, last: object | None, size: int) -> DataFrame:
    """The next ``size`` rows by ``key`` after the key ``last``; from the start for None."""
    following = rows if last is None else rows.where(F.col(key) > F.lit(last))
    return following.orderBy(key).limit(size)


def positive(tree: Node | Term | None, sign: bool = True) -> list[Term]:
    if tree is None:
        return []
    if isinstance(tree, Term):
        return [tree] if sign else []
    return list(dict.fromkeys(t for p in tree.parts for t in positive(p, sign != (tree.kind == "not"))))


def page(hits: DataFrame, order: list[Column], number: int, size: int) -> DataFrame | None:
    """Rows of a 1-based page; None beyond the window."""
    first = (max(number, 1) - 1) * size
    if first >= WINDOW:
        return None
    return hits.orderBy(*order).offset(first).limit(min(size, WINDOW - first))


def total(hits: DataFrame, cap: int = TOTAL_CAP) -> tuple[int, bool]:
    """(count, whether it is only a lower bound)."""
    n = hits.limit(cap + 1).count()
    return min(n, cap), n > cap


def facet(hits: DataFrame, column: str, size: int) -> DataFrame:
    """(key, n): the most frequent values, exact; an array counts each element once."""
    kind = dict(hits.dtypes)[column]
    keys = hits.select(F.explode(F.array_distinct(column)).alias("key")) if kind.startswith("array") else hits.select(F.col(column).alias("key"))
    return keys.where("key IS NOT NULL").groupBy("key").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "key").limit(size)


def autocomplete(rows: DataFrame, id_col: str, name_col: str, prefix: str, rank: Column, size: int = 8) -> DataFrame:
    """(id, name, score): names that hold every word but the last, and a word that begins with the last.

    Nothing typed gives the highest ranked names; words that all vanish give none.
    """
    words = analyse(prefix)
    staged = rows.withColumn("_w", analysed(F.col(name_col)))
    for w in words[:-1]:
        staged = staged.where(F.array_contains("_w", w))
    if words:
        staged = staged.where(F.exists("_w", lambda x: x.startswith(words[-1])))
    elif prefix.strip():
        staged = staged.where(F.lit(False))
    scored = staged.select(F.col(id_col).alias("id"), F.col(name_col).alias("name"), rank.alias("score"))
    return scored.orderBy(F.desc_nulls_last("score"), "id").limit(size)


def autocomplete_all(kinds: dict[str, DataFrame], prefix: str, size: int = 8) -> DataFrame:
    """(kind, id, name, score): the best of each kind of entity, every frame being (id, name, rank)."""
    parts = [autocomplete(df, "id", "name", prefix, F.log1p(F.col("rank").cast("double")), size).select(F.lit(k).alias("kind"), F.col("id").cast("string").alias("id"), "name", "score") for k, df in kinds.items()]
    return reduce(DataFrame.unionByName, parts)


def typed_words_found(rows: DataFrame, id_col: str, name_col: str, rank: Column, asked: Column, words: list[int], size: int = 8) -> DataFrame:
    """(words, asked, found): of the names ``asked`` for by their first words, the last as a prefix, those among the first ``size``.

    ``id_col`` is unique. A typed text is answered once, however many names begin with it, and only the
    first ``size`` names of equal words, and of each word (with the first typed word), can be among its answers.
    """
    w = analysed(F.col(name_col))

    def first(df: DataFrame, by: list[str]) -> DataFrame:
        place = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc_nulls_last("rank"), "id"))
        return df.withColumn("place", place).where(F.col("place") <= size).drop("place")

    names = first(rows.select(F.col(id_col).alias("id"), rank.alias("rank"), F.array_distinct(F.array_sort(w)).alias("w")), ["w"])
    tokens = names.select(F.explode("w").alias("token")).distinct()
    begins = tokens.select("token", F.explode(F.transform(F.sequence(F.lit(1), F.length("token")), lambda n: F.substring("token", F.lit(1), n))).alias("last"))
    typed = rows.where(asked).select(F.col(id_col).alias("q_id"), w.alias("q"))
    out = []
    for k in words:
        queries = typed.where(F.size("q") >= k).select("q_id", F.slice("q", 1, k).alias("text"))
        texts = queries.select("text").distinct().select("text", F.slice("text", 1, min(k - 1, 1)).alias("head"), F.element_at("text", k).alias("last"))
        asked_of = begins.join(texts.select("last").distinct(), "last", "left_semi")
        held = names.select("id", "rank", "w", F.explode("w").alias("token"))
        held = held.select("*", F.explode(F.transform("w", lambda x: F.array(x)) if k > 1 else F.array(F.array().cast("array<string>"))).alias("head"))
        held = first(held, ["head", "token"]) if k <= 2 else held
        answers = held.join(asked_of, "token").join(texts, ["head", "last"])
        if k > 2:  # head is all that stands before the last of two words
            answers = answers.where(F.forall(F.slice("text", 1, k - 1), lambda x: F.array_contains("w", x)))
        best = first(answers.select("text", "id", "rank").distinct(), ["text"]).select("text", F.col("id").alias("q_id"), F.lit(True).alias("hit"))
        found = queries.join(best, ["text", "q_id"], "left")
        out.append(found.agg(F.count("*").alias("asked"), F.count("hit").alias("found")).select(F.lit(k).alias("words"), "asked", "found"))
    return reduce(DataFrame.unionByName, out)


def tags_of_hits(hits: DataFrame, tags: DataFrame, size: int) -> DataFrame:
    """(key, n, first_id): the most frequent tags of the hits, and the smallest hit of each.

    ``hits`` is (id), ``tags`` distinct (id, key).
    """
    counted = tags.join(hits, "id", "left_semi").groupBy("key").agg(F.count("*").alias("n"), F.min("id").alias("first_id"))
    return counted.orderBy(F.desc("n"), "key").limit(size)


def edits_allowed(word: str) -> int:
    return 0 if len(word) <= 2 else 1 if len(word) <= 5 else 2


def expansions(vocabulary: DataFrame, word: str, prefix: int = 2, most: int = 20) -> DataFrame:
    """(token, distance): vocabulary within the edits a word allows, first letters equal.

    A swap of neighbours counts as one edit, by testing the word's swaps too.
    ``vocabulary`` is (token, n).
    """
    k = edits_allowed(word)
    swaps = {word[:i] + word[i + 1] + word[i] + word[i + 2 :] for i in range(prefix, len(word) - 1)} - {word}
    near = vocabulary.where(F.col("token").startswith(word[:prefix])).where(F.abs(F.length("token") - len(word)) <= k)
    plain = F.levenshtein(F.col("token"), F.lit(word))
    swapped = [1 + F.levenshtein(F.col("token"), F.lit(s)) for s in sorted(swaps)] if k else []
    distance = F.least(plain, *swapped) if swapped else plain
    return near.withColumn("distance", distance).where(F.col("distance") <= k).orderBy("distance", F.desc("n"), "token").limit(most).select("token", "distance", "n")


def did_you_mean(vocabulary: DataFrame, word: str, most: int = 3) -> DataFrame:
    """The closest words to one that the vocabulary lacks; none if it has it."""
    if len(word) < 4 or vocabulary.where(F.col("token") == word).limit(1).count():
        return vocabulary.limit(0).select("token", F.lit(0).alias("distance"), "n")
    return expansions(vocabulary, word, most=most)


def fuzzy_matches(rows: DataFrame, id_col: str, fields: dict[str, float], q: str, vocabulary: DataFrame, threshold: int = 5) -> tuple[str, DataFrame]:
    """Strict matches, or with fewer than ``threshold`` those where every word may be misspelt."""
    strict = matches(rows, id_col, fields, q)
    if strict.limit(threshold).count() >= threshold or not q.strip():
        return "strict", strict
    tree = parse(q)
    wanted = [w for t in positive(tree) for w in t.words]
    alternatives = [[r["token"] for r in expansions(vocabulary, w).collect()] or [w] for w in wanted]  # at most 20 a word
    loose = " ".join("(" + " | ".join(a) + ")" for a in alternatives)
    negated = [t for t in terms(tree) if t not in positive(tree)]
    return "fuzzy", matches(rows, id_col, fields, loose + "".join(' -"' + " ".join(t.words) + '"' for t in negated))
