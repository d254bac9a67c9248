"""Groups and their tags, merges, samples and text preparation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwork.functions import text
from loomwork.operators import graph, profile
from loomwork.plans import groups
from loomwork.queries.registry import query, table
from loomwork.search import text_query as tq

#: Nations as groups; each names its region's first nation and one that does not exist as what it is part of.
_GROUPS = """g AS (SELECT n_nationkey AS id, n_name AS name, ['nowhere', (SELECT min(m.n_name) FROM nation m WHERE m.n_regionkey = n.n_regionkey)] AS part_of FROM nation n),
    kept AS (SELECT * FROM g WHERE id NOT IN (SELECT n_nationkey FROM nation WHERE n_nationkey % 11 = 3)),
    child AS (SELECT c.id AS child, min(p.id) AS parent FROM kept c JOIN kept p ON list_contains(c.part_of, p.name) AND p.id <> c.id GROUP BY 1)"""


def _groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    first = nation.groupBy("n_regionkey").agg(F.min("n_name").alias("first"))
    return nation.join(first, "n_regionkey").select(F.col("n_nationkey").cast("long").alias("group_id"), F.col("n_name").alias("name"), F.array(F.lit("nowhere"), "first").alias("part_of"))


def _excluded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").where("n_nationkey % 11 = 3").select(F.col("n_nationkey").alias("group_id"))


@query(f"WITH {_GROUPS} SELECT child, parent FROM child")
def parent_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of several possible parents the smallest id."""
    kept = _groups(spark, sf_dir).join(_excluded(spark, sf_dir), "group_id", "left_anti")
    return groups.chosen_parents(kept)


@query(
    f"""WITH {_GROUPS} SELECT k.id AS group_id, k.name, coalesce((SELECT list(c.name || ':' || c.id ORDER BY c.name, c.id) FROM child JOIN kept c ON c.id = child WHERE parent = k.id), []) AS subgroups
    FROM kept k WHERE k.id NOT IN (SELECT child FROM child)"""
)
def group_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups with their subgroups; those excluded and those that are subgroups go."""
    found = groups.with_subgroups(_groups(spark, sf_dir), _excluded(spark, sf_dir))
    return found.select("group_id", "name", F.transform("subgroups", lambda s: F.concat_ws(":", s["name"], s["group_id"].cast("string"))).alias("subgroups"))


_TAGS = "t AS (SELECT l_orderkey AS id, l_suppkey % 7 AS key FROM lineitem GROUP BY 1, 2)"


@query(
    f"""WITH {_TAGS} SELECT 'stored' AS mode, count(DISTINCT id) AS n, count(*) AS tags FROM t UNION ALL SELECT 'exclude', count(DISTINCT id), count(*) FROM t WHERE NOT (key = 3 AND id % 2 = 0)
    UNION ALL SELECT 'override', count(DISTINCT id), count(*) FROM t WHERE key < 2"""
)
def tag_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored tags, an exclude list and an override."""
    pairs = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("id"), (F.col("l_suppkey") % 7).alias("key")).distinct()
    listed = lambda df: df.groupBy("id").agg(F.array_sort(F.collect_set("key")).alias("keys"))
    stored = listed(pairs)
    modes = {
        "stored": groups.tag_source(stored),
        "exclude": groups.tag_source(stored, exclude=pairs.where("key = 3 AND id % 2 = 0")),
        "override": groups.tag_source(stored, override=listed(pairs.where("key < 2")), entities=stored),
    }
    counts = [df.agg(F.count("*").alias("n"), F.sum(F.size("keys")).alias("tags")).select(F.lit(m).alias("mode"), "n", "tags") for m, df in modes.items()]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


@query(
    """WITH m AS (SELECT l_orderkey AS id, l_suppkey % 3 AS key, CASE l_partkey % 5 WHEN 0 THEN 'lay people' WHEN 1 THEN 'same' WHEN 2 THEN 'rus' WHEN 3 THEN 'hebrew' ELSE 'silesian' END AS keyword,
      l_quantity > 30 AS typo, l_discount > 0.04 AS signal, l_tax > 0.03 AS inst FROM lineitem),
    r AS (SELECT id, key, CASE WHEN typo AND keyword = 'lay people' THEN 'R1' WHEN key = 0 AND keyword = 'same' THEN 'R2' WHEN key = 1 AND keyword = 'hebrew' THEN (CASE WHEN inst THEN 'R5' END)
      WHEN key = 2 AND keyword = 'rus' AND NOT signal THEN 'R3' WHEN typo AND keyword <> 'lay people' AND NOT signal THEN 'R4' END AS why FROM m),
    c AS (SELECT id, key, why, count(*) AS n FROM r GROUP BY ALL), top AS (SELECT id, key, why FROM (SELECT *, row_number() OVER (PARTITION BY id, key ORDER BY n DESC, why) AS k FROM c WHERE why IS NOT NULL) WHERE k = 1)
    SELECT id, key, kept, CASE WHEN NOT kept THEN why END AS reason FROM (SELECT id, key, bool_or(why IS NULL) AS kept FROM r GROUP BY 1, 2) LEFT JOIN top USING (id, key)"""
)
def tag_reevaluation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules R1 to R5 over matches: a tag stays if one match supports it."""
    words = F.array(*[F.lit(w) for w in ("lay people", "same", "rus", "hebrew", "silesian")])
    matches = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("id"),
        (F.col("l_suppkey") % 3).alias("key"),
        F.get(words, (F.col("l_partkey") % 5).cast("int")).alias("keyword"),
        (F.col("l_quantity") > 30).alias("typo"),
        (F.col("l_discount") > 0.04).alias("signal"),
        (F.col("l_tax") > 0.03).alias("institution_only"),
    )
    return groups.reevaluated(matches, groups.Evidence(never=((0, "same"),), weak=((2, "rus"),), institution=((1, "hebrew"),)))


@query(
    """WITH l AS (SELECT s_nationkey AS id, n_name AS name, 'L' || (s_suppkey % 4) AS label FROM supplier JOIN nation ON n_nationkey = s_nationkey), g AS (SELECT id, min(name) AS name, list_sort(list(DISTINCT label)) AS labels FROM l GROUP BY 1),
    seed AS (SELECT n_nationkey AS id, n_name AS name FROM nation WHERE n_nationkey % 6 = 1 UNION ALL SELECT 1000, 'added')
    SELECT coalesce(g.id, seed.id) AS id, coalesce(g.name, seed.name) AS name, coalesce(labels, []) AS labels, seed.id IS NOT NULL AS seeded, n_regionkey AS region FROM g FULL JOIN seed ON g.id = seed.id
    LEFT JOIN nation ON n_nationkey = coalesce(g.id, seed.id) WHERE seed.id IS NOT NULL OR NOT (contains(coalesce(g.name, seed.name), 'IA') OR contains(coalesce(g.name, seed.name), '1'))"""
)
def group_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates with their labels united, some names dropped, seeds added, a dimension joined."""
    nation = table(spark, sf_dir, "nation")
    labels = table(spark, sf_dir, "supplier").join(nation, F.col("n_nationkey") == F.col("s_nationkey"))
    labels = labels.select(F.col("s_nationkey").cast("long").alias("id"), F.col("n_name").alias("name"), F.concat(F.lit("L"), (F.col("s_suppkey") % 4).cast("string")).alias("label"))
    seeds = nation.where("n_nationkey % 6 = 1").select(F.col("n_nationkey").cast("long").alias("id"), F.col("n_name").alias("name")).unionByName(spark.createDataFrame([(1000, "added")], "id long, name string"))
    region = nation.select(F.col("n_nationkey").cast("long").alias("id"), F.col("n_regionkey").alias("region"))
    return groups.candidates(labels, "IA|1", seeds, [region])


@query(
    """SELECT 'organisation' AS "table", count(*) AS n, count(segment) AS n_segment, (SELECT count(*) FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier)) AS n_dangling
    FROM (SELECT s_suppkey, NULL AS segment FROM supplier UNION ALL SELECT c_custkey + 1000000, c_mktsegment FROM customer)"""
)
def merge_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loads appended into one table and verified: rows, columns that one load lacks, links without an end."""
    suppliers = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("long").alias("id"))
    customers = table(spark, sf_dir, "customer").select((F.col("c_custkey") + 1000000).cast("long").alias("id"), F.col("c_mktsegment").alias("segment"))
    whole = groups.merged({"organisation": [suppliers, customers]})["organisation"]
    rel = graph.edges(table(spark, sf_dir, "lineitem"), F.monotonically_increasing_id(), "line", F.col("l_suppkey"), "organisation")
    lost = graph.dangling(rel, {"organisation": whole}).where("end = 'target'").select(F.col("n").alias("n_dangling"))
    return whole.agg(F.count("*").alias("n"), F.count("segment").alias("n_segment")).join(lost).select(F.lit("organisation").alias("table"), "n", "n_segment", "n_dangling")


@query("SELECT c_custkey AS left_id, min(s_suppkey) AS right_id FROM customer JOIN supplier ON right(c_name, 4) = right(s_name, 4) GROUP BY 1")
def match_single_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The older merge: one pass by name alone, the smallest id of several."""
    from loomwork.operators import matching

    key = lambda c: F.right(F.col(c), F.lit(4))
    found = matching.match_by(table(spark, sf_dir, "customer"), table(spark, sf_dir, "supplier"), "c_custkey", "s_suppkey", (key("c_name"), key("s_name")), "name")
    return found.groupBy("left_id").agg(F.min("right_id").alias("right_id"))


@query("SELECT DISTINCT l_orderkey AS source, 'project' AS source_type, l_suppkey AS target, 'organization' AS target_type FROM lineitem WHERE l_orderkey % 3 = 1")
def relations_from_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges rebuilt from the id lists of documents, a part of the ids."""
    docs = table(spark, sf_dir, "lineitem").where("l_orderkey % 3 = 1").groupBy("l_orderkey").agg(F.collect_set("l_suppkey").alias("org_ids"))
    return graph.edges_from_lists(docs, "l_orderkey", "project", "org_ids", "organization")


@query(
    """WITH s AS (SELECT p_partkey AS id, string_split(lower(p_name), ' ') AS w FROM part), q AS (SELECT id, w, k FROM s, (VALUES (1), (2)) v(k) WHERE len(w) >= k),
    hit AS (SELECT q.id, q.k, p.p_partkey, row_number() OVER (PARTITION BY q.id, q.k ORDER BY p_size DESC, p_partkey) AS pos FROM q JOIN part p ON len(list_filter(w[1:k - 1], lambda x: NOT list_contains(string_split(lower(p_name), ' '), x))) = 0
      AND len(list_filter(string_split(lower(p_name), ' '), lambda x: starts_with(x, w[k]))) > 0)
    SELECT k AS words, (SELECT count(*) FROM q q2 WHERE q2.k = q.k) AS asked, (SELECT count(*) FROM hit WHERE hit.k = q.k AND pos <= 8 AND p_partkey = hit.id) AS found FROM q GROUP BY k"""
)
def autocomplete_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many of all names are among the first eight after one and after two typed words."""
    return tq.typed_words_found(table(spark, sf_dir, "part"), "p_partkey", "p_name", F.col("p_size"), F.lit(True), [1, 2])


@query(
    """WITH tagged AS (SELECT l_orderkey AS pid, l_suppkey % 7 AS key FROM lineitem GROUP BY 1, 2), top AS (SELECT key, count(*) AS n FROM tagged JOIN orders ON o_orderkey = pid WHERE o_orderpriority = '1-URGENT' GROUP BY 1 ORDER BY n DESC, key LIMIT 3)
    SELECT key, n, (SELECT min(pid) FROM tagged t JOIN orders ON o_orderkey = pid WHERE t.key = top.key AND o_orderpriority = '1-URGENT') AS first_id FROM top"""
)
def two_step_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Projects that match, their most frequent tags, then an example of each."""
    tags = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("id"), (F.col("l_suppkey") % 7).alias("key")).distinct()
    hits = table(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_orderkey").alias("id"))
    return tq.tags_of_hits(hits, tags, 3)


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey > 1000 ORDER BY l_orderkey * 10 + l_linenumber LIMIT 50")
def keyset_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The page after a key."""
    keyed = table(spark, sf_dir, "lineitem").withColumn("k", F.col("l_orderkey") * 10 + F.col("l_linenumber"))
    return tq.page_after(keyed, "k", 10009, 50).select("l_orderkey", "l_linenumber")


@query("SELECT o_orderkey, 7::BIGINT AS seed FROM orders ORDER BY ((o_orderkey % 2147483647 + 7) * 48271) % 2147483647, o_orderkey LIMIT 100")
def seeded_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exactly 100 rows that a seed decides."""
    return profile.hash_sample(table(spark, sf_dir, "orders"), "o_orderkey", 100, 7).select("o_orderkey", F.lit(7).cast("long").alias("seed"))


_PLAIN = "trim(regexp_replace(lower(replace(strip_accents({}), 'ß', 'ss')), '\\s+', ' ', 'g'))"


@query(f"SELECT doc_id, {_PLAIN.format('text')} || ' lodz aero ''x'' 2' AS key FROM documents WHERE trim(text) <> ''")
def match_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What names are compared by: marks, strokes, ligatures, apostrophes and wide digits."""
    marked = F.concat("text", F.lit("  ŁÓDŹ ærö ’x` ２"))
    return table(spark, sf_dir, "documents").where("trim(text) <> ''").select("doc_id", text.match_key(marked).alias("key"))


@query(
    """SELECT page_id, left(regexp_replace(regexp_replace(url, '[^A-Za-z0-9._-]+', '_', 'g'), '^[._-]+|[._-]+$', '', 'g'), 120) AS file_name,
      trim(regexp_replace(regexp_replace('see ' || url || ' or a@b.org 12 now', '(https?://|www\\.)\\S+|\\S+@\\S+\\.\\S+|[0-9]+', ' ', 'g'), '\\s+', ' ', 'g')) AS bare FROM pages"""
)
def prepared_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File names of addresses, and what a language model should see of a text."""
    around = F.concat(F.lit("see "), "url", F.lit(" or a@b.org 12 now"))
    return table(spark, sf_dir, "pages").select("page_id", text.safe_file_name(F.col("url")).alias("file_name"), text.clean_for_lid(around).alias("bare"))


@query(
    """SELECT doc_id, CASE WHEN length(text) <= 100 THEN text WHEN 2 * length(regexp_replace(left(text, 100), '\\s+\\S*$', '')) >= 100 THEN regexp_replace(left(text, 100), '\\s+\\S*$', '') ELSE left(text, 100) END AS head,
      len(list_filter(regexp_split_to_array(trim(regexp_replace(text, '([.!?])\\s+', '\\1' || chr(1), 'g')), chr(1)), lambda s: trim(s) <> ''))::INTEGER AS n_sentences FROM documents"""
)
def truncated_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts cut at a word, and their number of sentences."""
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", text.truncate_text(F.col("text"), 100).alias("head"), F.size(text.split_sentences(F.col("text"))).alias("n_sentences"))
