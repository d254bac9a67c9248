"""Search queries over documents and parts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwork.queries.registry import query, table
from loomwork.search import text_query as tq

#: The analyser said again for DuckDB: words by the characters that split them, plurals by string functions.
_FOLDED = "replace(lower(strip_accents({})), 'ß', 'ss')"
_WORDS = "list_filter(regexp_split_to_array(" + _FOLDED + r", '[^\p{{L}}\p{{N}}]+'), lambda w: w <> '')"
_STEM = """CASE WHEN length(w) <= 3 OR right(w, 1) <> 's' THEN w WHEN right(w, 3) = 'ies' AND NOT list_contains(['a', 'e'], left(right(w, 4), 1)) THEN left(w, -3) || 'y'
      WHEN right(w, 2) = 'es' AND NOT list_contains(['a', 'e', 'o'], left(right(w, 3), 1)) THEN left(w, -1) WHEN list_contains(['u', 's'], left(right(w, 2), 1)) THEN w ELSE left(w, -1) END"""
_STEMS = f"list_transform({_WORDS}, lambda w: {_STEM})"


@query(
    f"""SELECT doc_id AS id FROM (SELECT doc_id, {_STEMS.format('text')} AS t FROM documents) WHERE list_contains(t, 'the') AND NOT list_contains(t, 'of')
    AND (list_contains(t, 'that') OR len(list_filter(range(1, len(t)), lambda i: t[i] = 'by' AND t[i + 1] = 'the')) > 0)"""
)
def text_search_bool(spark: SparkSession, sf_dir: str) -> DataFrame:
    """the NOT of AND (that OR "by the")."""
    return tq.matches(table(spark, sf_dir, "documents"), "doc_id", {"text": 1.0}, 'the NOT of AND (that OR "by the")', stem=True).select("id")


@query(
    f"""WITH c AS (SELECT doc_id, len(list_filter(t, lambda w: w = 'public')) AS a, len(list_filter(t, lambda w: w = 'license')) AS b FROM (SELECT doc_id, {_STEMS.format('text')} AS t FROM documents))
    SELECT doc_id AS id, round(ln(1.0 + a) + ln(1.0 + b), 6) AS score FROM c WHERE a > 0 AND b > 0 ORDER BY 2 DESC, 1 LIMIT 20"""
)
def text_search_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First page of a weighted search, ties by id."""
    hits = tq.matches(table(spark, sf_dir, "documents"), "doc_id", {"text": 1.0}, "public licenses", stem=True).select("id", F.round("score", 6).alias("score"))
    return tq.page(hits, [F.desc("score"), F.col("id")], 1, 20)


#: Documents with a name of another script or spelling before their text, by id.
_NAMES = ["Zürich Universität", "東京大学", "Łódź École", "résumés", "Straße"]


def _named(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.element_at(F.array(*[F.lit(n) for n in _NAMES]), (F.col("doc_id") % 5 + 1).cast("int"))
    return table(spark, sf_dir, "documents").select("doc_id", F.concat_ws(" ", name, "text").alias("text"))


@query(
    f"""WITH d AS (SELECT doc_id, doc_id % 5 AS k, {_STEMS.format('text')} AS t FROM documents) SELECT doc_id AS id, 'folded' AS query FROM d WHERE k = 0
    UNION ALL SELECT doc_id, 'signs' FROM d WHERE k = 1 UNION ALL SELECT doc_id, 'stroked' FROM d WHERE k = 2
    UNION ALL SELECT doc_id, 'plural' FROM d WHERE k = 3 OR list_contains(t, 'resume') UNION ALL SELECT doc_id, 'sharp' FROM d WHERE k = 4 OR list_contains(t, 'strasse')
    UNION ALL SELECT doc_id, 'words' FROM d WHERE len(list_filter(t, lambda w: starts_with(w, 'uber') AND length(w) = 4)) > 0"""
)
def text_search_scripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queries beyond ASCII: marks, Han signs, strokes, plurals; a part of a word and signs alone find nothing."""
    docs = _named(spark, sf_dir)
    asked = {"folded": "ZURICH universitat", "signs": '"京大"', "stroked": "Łodz ecole", "plural": "resume", "sharp": "STRASSE", "words": "über", "part": "universit", "nothing": "!? …"}
    found = [tq.matches(docs, "doc_id", {"text": 1.0}, q, stem=True).select("id", F.lit(name).alias("query")) for name, q in asked.items()]
    return reduce(DataFrame.unionByName, found)


@query("SELECT lang AS key, count(*) AS n FROM documents WHERE source IN ('src0', 'src1', 'src2') AND n_chars BETWEEN 500 AND 5000 GROUP BY 1 ORDER BY n DESC, key LIMIT 10")
def facet_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facet of a filtered result: term, range and list filters."""
    hits = table(spark, sf_dir, "documents").where(F.col("source").isin("src0", "src1", "src2") & F.col("n_chars").between(500, 5000))
    return tq.facet(hits, "lang", 10)


@query("SELECT key, count(*) AS n FROM (SELECT DISTINCT l_orderkey, l_suppkey AS key FROM lineitem) GROUP BY 1 ORDER BY n DESC, key LIMIT 50")
def facet_organisations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facet over an array field."""
    docs = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_set("l_suppkey").alias("org_ids"))
    return tq.facet(docs, "org_ids", 50)


@query(
    """SELECT p_partkey AS id, p_name AS name, round(ln(1.0 + p_size), 6) AS score FROM part WHERE (lower(p_name) LIKE 'w%' OR lower(p_name) LIKE '% w%') AND ' ' || lower(p_name) || ' ' LIKE '% red %' ORDER BY score DESC, id LIMIT 8"""
)
def autocomplete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Type-ahead: all words but the last equal, the last a prefix; ranked by a log."""
    return tq.autocomplete(table(spark, sf_dir, "part"), "p_partkey", "p_name", "red w", F.round(F.log(F.col("p_size") + 1.0), 6))


_VOC = f"voc AS (SELECT token, count(*) AS n FROM (SELECT unnest({_WORDS.format('text')}) AS token FROM documents) GROUP BY 1)"


@query(
    f"""WITH {_VOC} SELECT token, distance::INTEGER AS distance, n FROM (SELECT token, n, least(levenshtein(token, 'licnese'), 1 + least(levenshtein(token, 'lincese'), levenshtein(token, 'license'),
      levenshtein(token, 'licnsee'), levenshtein(token, 'licnees'))) AS distance FROM voc WHERE starts_with(token, 'li') AND abs(length(token) - 7) <= 2) WHERE distance <= 2 ORDER BY distance, n DESC, token LIMIT 20"""
)
def fuzzy_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vocabulary close to a misspelt word; a swap of neighbours is one edit."""
    voc = tq.postings(table(spark, sf_dir, "documents"), "doc_id", "text").groupBy("token").agg(F.count("*").alias("n"))
    return tq.expansions(voc, "licnese")


@query(
    f"""WITH {_VOC}, near AS (SELECT token FROM (SELECT token, n, least(levenshtein(token, 'licnese'), 1 + least(levenshtein(token, 'lincese'), levenshtein(token, 'license'), levenshtein(token, 'licnsee'),
      levenshtein(token, 'licnees'))) AS distance FROM voc WHERE starts_with(token, 'li') AND abs(length(token) - 7) <= 2) WHERE distance <= 2 ORDER BY distance, n DESC, token LIMIT 20)
    SELECT doc_id AS id FROM (SELECT doc_id, {_WORDS.format('text')} AS t FROM documents) d WHERE EXISTS (SELECT 1 FROM near WHERE list_contains(d.t, token))"""
)
def fuzzy_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A misspelt query falls back to close words."""
    docs = table(spark, sf_dir, "documents")
    voc = tq.postings(docs, "doc_id", "text").groupBy("token").agg(F.count("*").alias("n"))
    return tq.fuzzy_matches(docs, "doc_id", {"text": 1.0}, "licnese", voc)[1].select("id")


@query("SELECT least(count(*), 10000) AS total, count(*) > 10000 AS capped FROM lineitem WHERE l_quantity > 10")
def capped_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hit count up to a cap."""
    n, capped = tq.total(table(spark, sf_dir, "lineitem").where("l_quantity > 10"))
    return spark.createDataFrame([(n, capped)], "total long, capped boolean")


@query(
    """WITH m AS (SELECT conv_id AS group_id, list(role ORDER BY turn) AS roles, count(*) AS turns FROM conversations GROUP BY 1) SELECT group_id, turns, array_to_string(roles, '>') AS path FROM m
    WHERE len(list_filter(roles, lambda r: r = 'assistant')) > 1"""
)
def nested_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups whose nested list has a matching element, with the ordered path."""
    c = table(spark, sf_dir, "conversations")
    listed = c.groupBy(F.col("conv_id").alias("group_id")).agg(F.array_sort(F.collect_list(F.struct("turn", "role"))).alias("m"), F.count("*").alias("turns"))
    return listed.where(F.size(F.filter("m", lambda x: x["role"] == "assistant")) > 1).select("group_id", "turns", F.array_join(F.col("m.role"), ">").alias("path"))
