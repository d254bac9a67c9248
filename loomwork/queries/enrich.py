"""Enrichment and assembly queries over documents, labels and embeddings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwork.core.keys import first_by, merged_list
from loomwork.functions.text import match_key
from loomwork.plans import enrich, keywords, topics
from loomwork.plans.normalise import entity_id, normalise
from loomwork.queries.registry import query, table

#: Stems that begin words of the test corpus.
PILLARS = {"heritage": ["thre", "ing"], "language": ["the", "der"], "place": ["ciudad", "que"], "memory": ["eau", "ment"]}


def _mask_sql() -> str:
    """Words by what parts them, each compared with the stems."""
    words = "regexp_split_to_array(lower(text), '[^a-z0-9_]')"
    any_ = lambda stems: " OR ".join(f"starts_with(w, '{s}')" for s in stems)
    parts = [f"(CASE WHEN len(list_filter({words}, lambda w: {any_(s)})) > 0 THEN {1 << i} ELSE 0 END)" for i, s in enumerate(PILLARS.values())]
    return " | ".join(parts)


@query(
    """SELECT doc_id AS id, concat_ws(' ', coalesce('EN ' || t.title, d.title), d.body) AS full_text FROM (SELECT doc_id, split_part(text, chr(10), 1) AS title, text AS body FROM documents) d
    LEFT JOIN (SELECT doc_id AS tid, max(quality) || '/' || max(toxic) AS title FROM labels GROUP BY 1) t ON tid = doc_id WHERE concat_ws(' ', coalesce('EN ' || t.title, d.title), d.body) <> ''"""
)
def doc_full_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full text of fields, a sparse translation taking the place of its field."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.split_part("text", F.lit("\n"), F.lit(1)).alias("title"), F.col("text").alias("body"))
    labels = table(spark, sf_dir, "labels").groupBy(F.col("doc_id").alias("id")).agg(F.concat(F.lit("EN "), F.max("quality"), F.lit("/"), F.max("toxic")).alias("text_en"))
    return enrich.full_text(docs, ["title", "body"], labels.withColumn("field", F.lit("title")))


@query(f"SELECT doc_id AS id, ({_mask_sql()})::SMALLINT AS pillars FROM documents WHERE ({_mask_sql()}) <> 0")
def pillar_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sparse bit masks of the pillars whose stems occur."""
    return enrich.pillar_hits(table(spark, sf_dir, "documents"), "doc_id", "text", PILLARS)


@query(f"SELECT b AS bit, n, round(n / (SELECT count(*) FROM documents), 6) AS rate, n > 0.3 * (SELECT count(*) FROM documents) AS flagged FROM (SELECT b, count(*) AS n FROM (SELECT unnest(range(16)) AS b, m FROM (SELECT ({_mask_sql()}) AS m FROM documents)) WHERE (m & (1::INTEGER << b::INTEGER)) <> 0 GROUP BY 1)")
def pillar_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each pillar occurs, with a flag on those above 30 %."""
    docs = table(spark, sf_dir, "documents")
    return enrich.pillar_rate(enrich.pillar_hits(docs, "doc_id", "text", PILLARS), docs.count()).withColumn("rate", F.round("rate", 6))


@query(
    f"SELECT doc_id AS id, list_filter({list(PILLARS)!r}, lambda x, i: (({_mask_sql()}) & (1::INTEGER << (i - 1)::INTEGER)) <> 0) AS names FROM documents"
)
def pillar_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of the bits of the mask."""
    mask = enrich.pillar_mask(F.col("text"), PILLARS)
    return table(spark, sf_dir, "documents").withColumn("m", mask).select(F.col("doc_id").alias("id"), enrich.mask_names(F.col("m"), list(PILLARS)).alias("names"))


@query(
    """WITH s AS (SELECT l_orderkey AS id, p_size AS topic_id, max(l_quantity / 50) AS score FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1, 2),
    b AS (SELECT id, topic_id FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY score DESC, topic_id) AS k FROM s) WHERE k = 1 AND score >= 0.8),
    t AS (SELECT DISTINCT p_size AS topic_id, p_size // 10 AS field_id FROM part)
    SELECT id, theme FROM (SELECT id, CASE WHEN field_id IN (0, 1) THEN 'small' WHEN topic_id IN (25, 26, 27) THEN 'middle' WHEN field_id IN (4, 5) THEN 'large' END AS theme FROM b JOIN t USING (topic_id)) WHERE theme IS NOT NULL"""
)
def theme_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Theme of the best topic, by ordered rules above a least score."""
    parts = table(spark, sf_dir, "part")
    scores = (
        table(spark, sf_dir, "lineitem")
        .join(parts, F.col("p_partkey") == F.col("l_partkey"))
        .groupBy(F.col("l_orderkey").alias("id"), F.col("p_size").alias("topic_id"))
        .agg(F.max(F.col("l_quantity") / 50).alias("score"))
    )
    topics = parts.select(F.col("p_size").alias("topic_id"), F.floor(F.col("p_size") / 10).alias("field_id")).distinct()
    rules = [enrich.ThemeRule("small", "field_id", (0, 1)), enrich.ThemeRule("middle", "topic_id", (25, 26, 27)), enrich.ThemeRule("large", "field_id", (4, 5))]
    return enrich.themes(scores, topics, rules, 0.8)


#: Words in the spelling that names are compared in, and in their case; a name is a word of five letters or more that one item alone has.
_PLAIN = "list_filter(regexp_split_to_array(replace(strip_accents({}), 'ß', 'ss'), '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> '')"
_NAMES = f"names AS (SELECT name, any_value(item_id) AS key FROM (SELECT DISTINCT item_id, unnest({_PLAIN.format('lower(text)')}) AS name FROM benchmark) WHERE length(name) >= 5 GROUP BY 1 HAVING count(*) = 1)"
#: Names that count only capitalised.
_CAPITALISED = ["mention", "condition", "nation"]


def _names(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = F.explode(F.array_distinct(F.regexp_extract_all(match_key(F.col("text")), F.lit(r"[\p{L}\p{N}]+"), F.lit(0)))).alias("keyword")
    found = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("key"), words).distinct().where("length(keyword) >= 5")
    return found.groupBy("keyword").agg(F.min("key").alias("key"), F.count("*").alias("n")).where("n = 1").select("key", "keyword")


@query(
    f"""WITH {_NAMES}, d AS (SELECT DISTINCT doc_id, unnest({_PLAIN.format('text')}) AS w FROM documents)
    SELECT doc_id AS id, list_sort(list(DISTINCT key)) AS keys FROM d JOIN names ON lower(w) = name WHERE name NOT IN ({', '.join(map(repr, _CAPITALISED))}) OR w = upper(left(name, 1)) || substr(name, 2) GROUP BY 1"""
)
def keyword_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinguishing words of the benchmark items found as whole words, some only capitalised."""
    rules = keywords.Rules(capitalised=frozenset(_CAPITALISED))
    return keywords.keyword_hits(table(spark, sf_dir, "documents"), "doc_id", "text", _names(spark, sf_dir), rules, typos=False)


@query(
    f"""WITH {_NAMES}, d AS (SELECT DISTINCT doc_id, unnest({_PLAIN.format('lower(text)')}) AS w FROM documents), voc AS (SELECT DISTINCT w FROM d),
    near AS (SELECT w, key FROM voc JOIN names ON left(w, 1) = left(name, 1) AND abs(length(w) - length(name)) <= 1 AND length(name) >= 8 AND damerau_levenshtein(w, name) = 1 WHERE w NOT IN (SELECT name FROM names)
      AND NOT regexp_matches(w, '[^a-z]')),
    one AS (SELECT w, min(key) AS key FROM near GROUP BY 1 HAVING count(DISTINCT key) = 1), hit AS (SELECT name AS w, key FROM names UNION ALL SELECT w, key FROM one)
    SELECT doc_id AS id, list_sort(list(DISTINCT key)) AS keys FROM d JOIN hit USING (w) GROUP BY 1"""
)
def keyword_typos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with one typing error allowed in names of eight letters or more."""
    plain = _names(spark, sf_dir)
    return keywords.keyword_hits(table(spark, sf_dir, "documents"), "doc_id", "text", plain)


_STOP = "[" + ", ".join(f"'{w}'" for w in sorted(topics.STOP_WORDS)) + "]"
_GRAMS = (
    "(SELECT {id}, unnest(list_concat(t, [t[i] || ' ' || t[i + 1] for i in range(1, len(t))])) AS token FROM (SELECT {id}, list_filter(regexp_split_to_array(lower(text), '[^\\p{{L}}]+'), "
    "lambda w: length(w) > 2 AND NOT list_contains(" + _STOP + ", w)) AS t FROM {table}))"
)


@query(
    f"""WITH tf AS (SELECT doc_id AS id, token, count(*) AS tf FROM {_GRAMS.format(id='doc_id', table='documents')} GROUP BY 1, 2),
    voc AS (SELECT token, ln((1.0 + (SELECT count(*) FROM documents)) / (1 + df)) + 1 AS idf FROM (SELECT token, count(*) AS df, sum(tf) AS total FROM tf GROUP BY 1)
      WHERE df >= 2 AND df <= 0.8 * (SELECT count(*) FROM documents) ORDER BY total DESC, token LIMIT 10000),
    raw AS (SELECT id, token, tf * idf AS x FROM tf JOIN voc USING (token)), w AS (SELECT id, token, x / sqrt(sum(x * x) OVER (PARTITION BY id)) AS w FROM raw),
    ttf AS (SELECT item_id AS id, token, count(*) AS tf FROM {_GRAMS.format(id='item_id', table='benchmark')} GROUP BY 1, 2),
    traw AS (SELECT id, token, tf * idf AS x FROM ttf JOIN voc USING (token)), tw AS (SELECT id AS topic_id, token, x / sqrt(sum(x * x) OVER (PARTITION BY id)) AS tw FROM traw),
    dots AS (SELECT id, topic_id, round(sum(w * tw), 9) AS score FROM w JOIN tw USING (token) GROUP BY 1, 2),
    best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY score DESC, topic_id) AS k FROM dots) WHERE k = 1 AND score > 0)
    SELECT doc_id AS id, coalesce(topic_id, -1) AS topic_id, round(coalesce(score, 0), 6) AS score FROM documents LEFT JOIN best ON id = doc_id"""
)
def topic_tfidf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best topic of every document by tf-idf cosine over 10,000 words and pairs, -1 without one; topics are benchmark items."""
    found = topics.classify(table(spark, sf_dir, "documents"), "doc_id", "text", table(spark, sf_dir, "benchmark"), "item_id", "text")
    return found.select("id", "topic_id", F.round("score", 6).alias("score"))


@query(
    """SELECT d.doc_id AS id, d.lang, coalesce(q.quality, -1) AS quality, coalesce(q.toxic, 0) AS toxic, coalesce(n.n, 0) AS turns FROM documents d
    LEFT JOIN (SELECT doc_id, min(quality) AS quality, min(toxic) AS toxic FROM labels GROUP BY 1) q USING (doc_id) LEFT JOIN (SELECT conv_id, count(*) AS n FROM conversations GROUP BY 1) n ON conv_id = d.doc_id"""
)
def assemble_entity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their sparse side outputs and defaults; no row is lost or doubled."""
    base = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "lang")
    labels = table(spark, sf_dir, "labels").withColumnRenamed("doc_id", "id")
    turns = table(spark, sf_dir, "conversations").groupBy(F.col("conv_id").alias("id")).agg(F.count("*").alias("turns"))
    return enrich.assemble(base, "id", {"labels": (labels, {"quality": -1, "toxic": 0}), "turns": (turns, {"turns": 0})})


@query(
    """SELECT CASE WHEN source_type = 'work' OR target_type = 'work' THEN 'works' ELSE 'projects' END AS part, count(*) AS n FROM (
      SELECT DISTINCT l_orderkey, 'project' AS source_type, l_suppkey, 'organization' AS target_type FROM lineitem UNION ALL SELECT DISTINCT l_orderkey, 'project', l_partkey, 'work' FROM lineitem
      UNION ALL SELECT DISTINCT l_partkey, 'work', l_suppkey, 'organization' FROM lineitem) GROUP BY 1"""
)
def relation_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges with a work on either side belong to the works file, others to the projects file."""
    from loomwork.queries.graph import relations

    part = F.when((F.col("source_type") == "work") | (F.col("target_type") == "work"), "works").otherwise("projects")
    return relations(spark, sf_dir).groupBy(part.alias("part")).agg(F.count("*").alias("n"))


@query(
    """SELECT 'work' AS type, source_id, topic_id, round(score, 4) AS score FROM (SELECT p_partkey AS source_id, p_size AS topic_id, max(p_retailprice) AS score FROM part JOIN lineitem ON l_partkey = p_partkey
      GROUP BY 1, 2) WHERE source_id IN (SELECT l_partkey FROM lineitem WHERE l_linenumber = 1)"""
)
def relation_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topic links, one row a pair, stale ids dropped by a semi join."""
    lines = table(spark, sf_dir, "lineitem")
    pairs = table(spark, sf_dir, "part").join(lines, F.col("l_partkey") == F.col("p_partkey"))
    unique = pairs.groupBy(F.col("p_partkey").alias("source_id"), F.col("p_size").alias("topic_id")).agg(F.max("p_retailprice").alias("score"))
    alive = lines.where("l_linenumber = 1").select(F.col("l_partkey").alias("source_id"))
    return unique.join(alive, "source_id", "left_semi").select(F.lit("work").alias("type"), "source_id", "topic_id", F.round("score", 4).alias("score"))


_TAGS = "tags AS (SELECT o_orderkey AS id, l_suppkey % 7 AS key, bool_or(l_returnflag = 'R') AS r, bool_or(l_discount >= 0.05) AS d FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1, 2)"


@query(f"WITH {_TAGS} SELECT id, key, CASE WHEN r THEN 'R1' ELSE 'R2' END AS rule FROM tags WHERE r OR d")
def tag_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tags that a match supports, with the first rule that holds."""
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("id"), (F.col("l_suppkey") % 7).alias("key"), "l_returnflag", "l_discount")
    return enrich.supported_tags(lines, [("R1", F.col("l_returnflag") == "R"), ("R2", F.col("l_discount") >= 0.05)])


@query(f"WITH {_TAGS} SELECT id, list_sort(list(key)) AS keys FROM tags WHERE NOT (r AND key = 2) GROUP BY id")
def deny_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tag lists without denied pairs; emptied rows go."""
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("id"), (F.col("l_suppkey") % 7).alias("key"), "l_returnflag")
    pairs = lines.select("id", "key").distinct()
    tags = pairs.groupBy("id").agg(F.array_sort(F.collect_set("key")).alias("keys"))
    return enrich.deny(tags, lines.where("l_returnflag = 'R' AND key = 2").select("id", "key").distinct())


@query(
    """WITH g AS (SELECT s_nationkey AS k, list_sort(list(DISTINCT trim(p))) AS labels FROM (SELECT s_nationkey, unnest(string_split(s_name || ' ; ' || (s_suppkey % 3) || ';', ';')) AS p FROM supplier) WHERE trim(p) <> '' GROUP BY 1)
    SELECT n_nationkey AS group_id, n_name AS group_name, labels FROM g JOIN nation ON n_nationkey = k WHERE n_nationkey NOT IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 9900)"""
)
def group_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups with their duplicate labels merged; excluded groups by anti join."""
    s = table(spark, sf_dir, "supplier")
    label = F.concat("s_name", F.lit(" ; "), (F.col("s_suppkey") % 3).cast("string"), F.lit(";"))
    merged = s.groupBy("s_nationkey").agg(merged_list(label).alias("labels"))
    out = merged.join(s.where("s_acctbal > 9900").select("s_nationkey").distinct(), "s_nationkey", "left_anti")
    return out.join(table(spark, sf_dir, "nation"), F.col("n_nationkey") == F.col("s_nationkey")).select(F.col("n_nationkey").alias("group_id"), F.col("n_name").alias("group_name"), "labels")


@query(
    """SELECT id, label FROM (SELECT a.vec_id AS id, b.label, row_number() OVER (PARTITION BY a.vec_id ORDER BY round(list_dot_product(a.e, b.e) / sqrt(list_dot_product(a.e, a.e)) / sqrt(list_dot_product(b.e, b.e)), 9) DESC, b.label) AS k
      FROM (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings) a, (SELECT label, list(m ORDER BY i) AS e FROM (SELECT label, i, avg(x) AS m FROM (SELECT label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings) GROUP BY 1, 2) GROUP BY 1) b) WHERE k = 1"""
)
def nearest_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topic whose centroid has the highest cosine with each vector."""
    v = table(spark, sf_dir, "embeddings").select("vec_id", "label", F.col("embedding").cast("array<double>").alias("e"))
    points = v.select("label", F.posexplode("e").alias("i", "x")).groupBy("label", "i").agg(F.avg("x").alias("m"))
    centroids = points.groupBy(F.col("label").cast("long").alias("label")).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "m"))), lambda s: s["m"]).alias("c"))
    return topics.nearest_centroid(v, "vec_id", "e", centroids).select("id", F.col("label").cast("int").alias("label"))


@query("SELECT lang, source, text AS sample, doc_id FROM (SELECT *, row_number() OVER (PARTITION BY lang, source ORDER BY n_chars DESC, doc_id) AS k FROM documents) WHERE k = 1")
def longest_by_site(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The longest document of each language and source."""
    best = first_by(table(spark, sf_dir, "documents"), ["lang", "source"], [F.col("n_chars").desc(), F.col("doc_id")])
    return best.select("lang", "source", F.col("text").alias("sample"), "doc_id")


@query(
    """SELECT conv_id, role, min(k - 1)::INTEGER AS position FROM (SELECT conv_id, role, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS k FROM conversations) WHERE role IS NOT NULL GROUP BY 1, 2"""
)
def normalised_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested turns as entity and junction tables, joined back by their ids."""
    turns = F.array_sort(F.collect_list(F.struct("turn", "role", "text")))
    docs = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(turns.alias("turns"))
    entities, junction = normalise(docs, ["conv_id"], "turns", ["role"])
    parents = docs.select(entity_id(F.col("conv_id")).alias("parent_id"), "conv_id")
    named = junction.join(entities.select(F.col("id").alias("child_id"), "role"), "child_id").join(parents, "parent_id")
    return named.select("conv_id", "role", "position")
