"""Graph queries: projects are orders, organisations suppliers, works parts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwork.core.keys import count_where, equal_split, null_if_zero, top_by
from loomwork.functions.codes import MAX_EUR
from loomwork.operators import graph
from loomwork.queries.registry import query, table

TODAY = "1998-06-01"


def relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Project-organisation, project-work and work-organisation edges."""
    lines = table(spark, sf_dir, "lineitem")
    return (
        graph.edges(lines, F.col("l_orderkey"), "project", F.col("l_suppkey"), "organization")
        .unionByName(graph.edges(lines, F.col("l_orderkey"), "project", F.col("l_partkey"), "work"))
        .unionByName(graph.edges(lines, F.col("l_partkey"), "work", F.col("l_suppkey"), "organization"))
    )


def participants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(pid, oid, is_coord): one row a pair, the coordinator's line has number 1."""
    lines = table(spark, sf_dir, "lineitem")
    return lines.groupBy(F.col("l_orderkey").alias("pid"), F.col("l_suppkey").alias("oid")).agg(F.bool_or(F.col("l_linenumber") == 1).alias("is_coord"))


_PO = "po AS (SELECT l_orderkey AS pid, l_suppkey AS oid, bool_or(l_linenumber = 1) AS is_coord FROM lineitem GROUP BY 1, 2)"
_SHARE = f"share AS (SELECT pid, (CASE WHEN o_totalprice > 0 AND o_totalprice <= {MAX_EUR} THEN o_totalprice END) / nullif(n, 0) AS eur FROM (SELECT pid, count(*) AS n FROM po GROUP BY pid) JOIN orders ON o_orderkey = pid)"
_REL = (
    "rel AS (SELECT DISTINCT l_orderkey AS source, 'project' AS source_type, l_suppkey AS target, 'organization' AS target_type FROM lineitem"
    " UNION ALL SELECT DISTINCT l_orderkey, 'project', l_partkey, 'work' FROM lineitem"
    " UNION ALL SELECT DISTINCT l_partkey, 'work', l_suppkey, 'organization' FROM lineitem)"
)


def shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(pid, eur): each project's amount split equally over its organisations."""
    counts = participants(spark, sf_dir).groupBy("pid").agg(F.count("*").alias("n"))
    amount = F.when((F.col("o_totalprice") > 0) & (F.col("o_totalprice") <= MAX_EUR), F.col("o_totalprice"))
    return counts.join(table(spark, sf_dir, "orders"), F.col("pid") == F.col("o_orderkey")).select("pid", equal_split(amount, F.col("n")).alias("eur"))


@query(
    f"""WITH {_PO}, {_SHARE}
    SELECT s_suppkey AS org_id, s_name AS org_name, coalesce(r_name, 'Unknown') AS region, coalesce(k.project_count, 0) AS project_count,
      coalesce(k.coordinator_count, 0) AS coordinator_count, round(k.total_eur, 2) AS total_funding_eur, nullif(coalesce(k.project_count, 0), 0) AS rank_projects
    FROM supplier LEFT JOIN nation ON n_nationkey = s_nationkey LEFT JOIN region ON r_regionkey = n_regionkey
    LEFT JOIN (SELECT oid, count(*) AS project_count, count(*) FILTER (WHERE is_coord) AS coordinator_count, sum(eur) AS total_eur
               FROM po JOIN share USING (pid) GROUP BY oid) k ON k.oid = s_suppkey"""
)
def org_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Organisations with project counts and their share of the funding."""
    rolled = (
        participants(spark, sf_dir)
        .join(shares(spark, sf_dir), "pid")
        .groupBy("oid")
        .agg(F.count("*").alias("project_count"), count_where(F.col("is_coord")).alias("coordinator_count"), F.sum("eur").alias("total_eur"))
    )
    nation = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("r_regionkey") == F.col("n_regionkey"), "left")
    n = F.coalesce("project_count", F.lit(0).cast("long"))
    return (
        table(spark, sf_dir, "supplier")
        .join(nation, F.col("n_nationkey") == F.col("s_nationkey"), "left")
        .join(rolled, F.col("oid") == F.col("s_suppkey"), "left")
        .select(
            F.col("s_suppkey").alias("org_id"),
            F.col("s_name").alias("org_name"),
            F.coalesce("r_name", F.lit("Unknown")).alias("region"),
            n.alias("project_count"),
            F.coalesce("coordinator_count", F.lit(0).cast("long")).alias("coordinator_count"),
            F.round("total_eur", 2).alias("total_funding_eur"),
            null_if_zero(n).alias("rank_projects"),
        )
    )


def _nodes(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Projects that are not finished, organisations in credit, small works."""
    return {
        "project": table(spark, sf_dir, "orders").where("o_orderstatus <> 'F'").select("o_orderkey"),
        "organization": table(spark, sf_dir, "supplier").where("s_acctbal > 0").select("s_suppkey"),
        "work": table(spark, sf_dir, "part").where("p_size <= 25").select("p_partkey"),
    }


_NODES = (
    "node AS (SELECT 'project' AS type, o_orderkey AS id FROM orders WHERE o_orderstatus <> 'F'"
    " UNION ALL SELECT 'organization', s_suppkey FROM supplier WHERE s_acctbal > 0"
    " UNION ALL SELECT 'work', p_partkey FROM part WHERE p_size <= 25)"
)


@query(
    f"""WITH {_REL}, {_NODES}, kept AS (SELECT * FROM rel r WHERE EXISTS (SELECT 1 FROM node n WHERE n.type = r.source_type AND n.id = r.source)
      AND EXISTS (SELECT 1 FROM node n WHERE n.type = r.target_type AND n.id = r.target))
    SELECT source_type, target_type, count(*) AS n_all, coalesce(any_value(k), 0) AS n_kept, count(*) - coalesce(any_value(k), 0) AS n_dropped
    FROM rel LEFT JOIN (SELECT source_type, target_type, count(*) AS k FROM kept GROUP BY 1, 2) USING (source_type, target_type) GROUP BY 1, 2"""
)
def edge_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges kept and dropped by kind when both ends must exist."""
    rel = relations(spark, sf_dir)
    return graph.cascade_report(rel, graph.keep_edges(rel, _nodes(spark, sf_dir)))


@query(
    f"""WITH {_REL}, {_NODES}
    SELECT e."end", t.type, (SELECT count(*) FROM rel r WHERE (CASE e."end" WHEN 'source' THEN r.source_type ELSE r.target_type END) = t.type
      AND (CASE e."end" WHEN 'source' THEN r.source ELSE r.target END) NOT IN (SELECT id FROM node n WHERE n.type = t.type)) AS n
    FROM (VALUES ('source'), ('target')) e("end"), (VALUES ('project'), ('organization'), ('work')) t(type)"""
)
def dangling_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Integrity check: edge ends without a node, by end and type."""
    return graph.dangling(relations(spark, sf_dir), _nodes(spark, sf_dir))


def _works(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, F.Column]:
    lines = table(spark, sf_dir, "lineitem")
    dates = lines.groupBy(F.col("l_partkey").alias("_p")).agg(F.max(F.col("l_shipdate").cast("date")).alias("last_date"))
    works = table(spark, sf_dir, "part").join(dates, F.col("p_partkey") == F.col("_p"), "left").select(F.col("p_partkey").alias("id"), "last_date", "p_type")
    tiers = graph.link_tiers([lines.where("l_linenumber = 1").select("l_partkey"), lines.where("l_linenumber > 1 AND l_quantity > 25").select("l_partkey")])
    return works, tiers, F.contains(F.col("p_type"), F.lit("ECONOMY"))


_RANK = f"""w AS (SELECT p_partkey AS id, p_type LIKE '%ECONOMY%' AS has_text, CASE WHEN d <= DATE '{TODAY}' THEN d END AS sort_date
      FROM part LEFT JOIN (SELECT l_partkey, max(l_shipdate::DATE) AS d FROM lineitem GROUP BY 1) ON l_partkey = p_partkey),
    tier AS (SELECT id, min(t)::SMALLINT AS link_tier FROM (SELECT l_partkey AS id, 0 AS t FROM lineitem WHERE l_linenumber = 1
      UNION ALL SELECT l_partkey, 1 FROM lineitem WHERE l_linenumber > 1 AND l_quantity > 25) GROUP BY id),
    ranked AS (SELECT id, link_tier, sort_date, has_text FROM w JOIN tier USING (id)),
    kept AS (SELECT * FROM ranked ORDER BY link_tier, sort_date DESC NULLS LAST, has_text DESC, id LIMIT 500)"""


@query(f"WITH {_RANK} SELECT id, link_tier, strftime(sort_date, '%Y-%m-%d') AS sort_date, has_text FROM kept")
def work_trim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 500 best linked works by tier, date and text."""
    works, tiers, text = _works(spark, sf_dir)
    kept = graph.trim(works, tiers, 500, "last_date", text, F.lit(TODAY).cast("date"))
    return kept.withColumn("sort_date", F.date_format("sort_date", "yyyy-MM-dd"))


@query(f"WITH {_RANK} SELECT id, link_tier, strftime(sort_date, '%Y-%m-%d') AS sort_date, has_text FROM kept")
def work_trim_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same selection by group counts, for caps beyond a driver's memory."""
    works, tiers, text = _works(spark, sf_dir)
    kept = graph.trim_ranked(graph.narrow(works, tiers, "last_date", text, F.lit(TODAY).cast("date")), 500)
    return kept.withColumn("sort_date", F.date_format("sort_date", "yyyy-MM-dd"))


@query(
    f"""WITH {_RANK}, c AS (SELECT max(link_tier) AS t, (SELECT CASE WHEN count(*) FILTER (WHERE sort_date IS NULL) = 0 THEN min(sort_date) END
      FROM kept WHERE link_tier = (SELECT max(link_tier) FROM kept)) AS d FROM kept)
    SELECT t AS cutoff_tier, strftime(d, '%Y-%m-%d') AS cutoff_date,
      (SELECT count(*) FROM ranked, c WHERE link_tier = t AND sort_date IS NOT DISTINCT FROM d) AS on_cutoff_date,
      (SELECT count(*) FROM kept, c WHERE link_tier = t AND sort_date IS NOT DISTINCT FROM d) AS kept_on_cutoff_date FROM c"""
)
def trim_cutoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where the cap of work_trim falls."""
    works, tiers, text = _works(spark, sf_dir)
    ranked = graph.narrow(works, tiers, "last_date", text, F.lit(TODAY).cast("date"))
    found = graph.cutoff(ranked, ranked.orderBy(*graph.trim_order()).limit(500))
    return found.withColumn("cutoff_date", F.date_format("cutoff_date", "yyyy-MM-dd"))


@query(f"WITH {_PO} SELECT x.oid AS a, y.oid AS b, count(*) AS shared FROM po x JOIN po y ON x.pid = y.pid AND x.oid < y.oid GROUP BY 1, 2")
def collab_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Organisations that share projects, each pair once."""
    return graph.pairs(participants(spark, sf_dir), "pid", "oid")


@query(
    f"""WITH {_PO}, d AS (SELECT x.oid AS a, y.oid AS b, count(*) AS shared FROM po x JOIN po y ON x.pid = y.pid AND x.oid <> y.oid GROUP BY 1, 2),
    r AS (SELECT *, row_number() OVER (PARTITION BY a ORDER BY shared DESC, b) AS k FROM d)
    SELECT s_suppkey AS org_id, s_name AS org_name, list(r.b ORDER BY r.shared DESC, r.b) AS partner_ids, list(r.shared ORDER BY r.shared DESC, r.b) AS partner_counts
    FROM r JOIN supplier ON s_suppkey = a WHERE k <= 10 GROUP BY 1, 2"""
)
def collaboration_network(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Map view: each organisation with its ten closest partners, ordered."""
    directed = graph.pairs(participants(spark, sf_dir), "pid", "oid", directed=True)
    best = top_by(directed, ["a"], [F.col("shared").desc(), F.col("b")], 10)
    listed = best.groupBy("a").agg(F.array_sort(F.collect_list(F.struct((-F.col("shared")).alias("o"), "b", "shared"))).alias("p"))
    return listed.join(table(spark, sf_dir, "supplier"), F.col("a") == F.col("s_suppkey")).select(
        F.col("s_suppkey").alias("org_id"), F.col("s_name").alias("org_name"), F.col("p.b").alias("partner_ids"), F.col("p.shared").alias("partner_counts")
    )


@query(
    """WITH m AS (SELECT DISTINCT l_orderkey AS pid, l_suppkey AS oid, split_part(p_type, ' ', 1) AS topic FROM lineitem JOIN part ON p_partkey = l_partkey)
    SELECT x.topic, x.oid AS a, y.oid AS b, count(*) AS shared FROM m x JOIN m y ON x.pid = y.pid AND x.topic = y.topic AND x.oid < y.oid GROUP BY 1, 2, 3"""
)
def collaboration_by_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of organisations that share projects, by topic of the works."""
    parts = table(spark, sf_dir, "part").select("p_partkey", F.split_part("p_type", F.lit(" "), F.lit(1)).alias("topic"))
    lines = table(spark, sf_dir, "lineitem").join(parts, F.col("p_partkey") == F.col("l_partkey"))
    return graph.pairs(lines, ["l_orderkey", "topic"], "l_suppkey", by=["topic"])


@query(
    f"""WITH {_PO} SELECT s_suppkey AS org_id, s_name AS org_name, n_name AS country, list(pid ORDER BY o_orderdate DESC, pid) AS project_ids,
      list(round(o_totalprice, 2) ORDER BY o_orderdate DESC, pid) AS amounts FROM po JOIN orders ON o_orderkey = pid JOIN supplier ON s_suppkey = oid
      JOIN nation ON n_nationkey = s_nationkey WHERE s_acctbal > 0 GROUP BY 1, 2, 3"""
)
def institution_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Map view: organisations in credit with their projects, latest first."""
    orders = table(spark, sf_dir, "orders")
    projects = participants(spark, sf_dir).join(orders, F.col("o_orderkey") == F.col("pid"))
    packed = F.struct((-F.unix_micros(F.col("o_orderdate").cast("timestamp"))).alias("k"), "pid", F.round("o_totalprice", 2).alias("amount"))
    listed = projects.groupBy("oid").agg(F.array_sort(F.collect_list(packed)).alias("p"))
    orgs = table(spark, sf_dir, "supplier").where("s_acctbal > 0").join(table(spark, sf_dir, "nation"), F.col("n_nationkey") == F.col("s_nationkey"))
    return orgs.join(listed, F.col("oid") == F.col("s_suppkey")).select(
        F.col("s_suppkey").alias("org_id"), F.col("s_name").alias("org_name"), F.col("n_name").alias("country"), F.col("p.pid").alias("project_ids"), F.col("p.amount").alias("amounts")
    )


@query(
    """SELECT id, title, topic, round(score, 2) AS score FROM (SELECT o_orderkey AS id, o_orderpriority AS title, p_brand AS topic, l_extendedprice AS score,
      row_number() OVER (PARTITION BY o_orderkey ORDER BY l_extendedprice DESC, p_brand) AS k FROM orders LEFT JOIN (lineitem JOIN part ON p_partkey = l_partkey) ON l_orderkey = o_orderkey) WHERE k = 1"""
)
def project_list_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """List view: each project with its best-scored topic (DISTINCT ON)."""
    scored = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part"), F.col("p_partkey") == F.col("l_partkey"))
    best = scored.groupBy("l_orderkey").agg(F.max(F.col("l_extendedprice")).alias("score"))
    named = scored.join(best, "l_orderkey").where("l_extendedprice = score").groupBy("l_orderkey").agg(F.min("p_brand").alias("topic"), F.first("score").alias("score"))
    return table(spark, sf_dir, "orders").join(named, F.col("l_orderkey") == F.col("o_orderkey"), "left").select(
        F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("title"), "topic", F.round("score", 2).alias("score")
    )


@query(f"WITH {_PO} SELECT y.oid AS partner, count(*) AS shared FROM po x JOIN po y ON x.pid = y.pid WHERE x.oid = 1 AND y.oid <> 1 GROUP BY 1")
def org_network(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partners of organisation 1 with the number of shared projects."""
    return graph.partners(participants(spark, sf_dir), "pid", "oid", 1)


@query(
    f"""WITH {_PO}, k AS (SELECT s_suppkey, lower(n_name) AS name_key FROM supplier JOIN nation ON n_nationkey = s_nationkey)
    SELECT k.name_key, count(DISTINCT y.oid) AS ids, sum(shared)::BIGINT AS doc_count FROM (SELECT y.oid, count(*) AS shared FROM po x JOIN po y ON x.pid = y.pid
      WHERE x.oid = 1 AND y.oid <> 1 GROUP BY 1) y JOIN k ON k.s_suppkey = y.oid WHERE k.name_key <> (SELECT name_key FROM k WHERE s_suppkey = 1) GROUP BY 1"""
)
def network_by_name_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partners of organisation 1 merged by key, its own key dropped."""
    keys = table(spark, sf_dir, "supplier").join(table(spark, sf_dir, "nation"), F.col("n_nationkey") == F.col("s_nationkey")).select(F.col("s_suppkey").alias("partner"), F.lower("n_name").alias("name_key"))
    center = keys.where("partner = 1").select(F.col("name_key"))
    merged = graph.partners(participants(spark, sf_dir), "pid", "oid", 1).join(keys, "partner").join(center, "name_key", "left_anti")
    return merged.groupBy("name_key").agg(F.count("*").alias("ids"), F.sum("shared").alias("doc_count"))


@query(f"WITH {_PO}, {_SHARE} SELECT oid, round(sum(eur), 2) AS funding, count(*) AS projects FROM po JOIN share USING (pid) JOIN orders ON o_orderkey = pid WHERE o_orderpriority = '1-URGENT' GROUP BY oid ORDER BY sum(eur) DESC, oid LIMIT 500")
def funding_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top 500 organisations by funding over the projects of a filter."""
    chosen = table(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_orderkey").alias("pid"))
    po = participants(spark, sf_dir).join(chosen, "pid", "left_semi").join(shares(spark, sf_dir), "pid")
    total = po.groupBy("oid").agg(F.sum("eur").alias("s"), F.count("*").alias("projects"))
    return total.orderBy(F.desc("s"), "oid").limit(500).select("oid", F.round("s", 2).alias("funding"), "projects")


@query(f"WITH {_PO} SELECT oid, count(*) AS projects FROM po JOIN orders ON o_orderkey = pid WHERE o_totalprice > 200000 GROUP BY oid ORDER BY projects DESC, oid LIMIT 200")
def experts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top 200 organisations by matching projects."""
    chosen = table(spark, sf_dir, "orders").where("o_totalprice > 200000").select(F.col("o_orderkey").alias("pid"))
    po = participants(spark, sf_dir).join(chosen, "pid", "left_semi")
    return po.groupBy("oid").agg(F.count("*").alias("projects")).orderBy(F.desc("projects"), "oid").limit(200)


@query(
    f"""WITH {_PO}, top AS (SELECT o_orderkey AS pid FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 300),
    m AS (SELECT pid, oid, row_number() OVER (PARTITION BY pid ORDER BY oid) AS k FROM po JOIN top USING (pid))
    SELECT x.oid AS a, y.oid AS b, count(*) AS weight FROM m x JOIN m y ON x.pid = y.pid AND x.oid < y.oid WHERE x.k <= 20 AND y.k <= 20 GROUP BY 1, 2 ORDER BY weight DESC, a, b LIMIT 1000"""
)
def query_network(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges among at most 20 organisations of each of the 300 largest projects; the 1000 heaviest."""
    top = table(spark, sf_dir, "orders").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(300).select(F.col("o_orderkey").alias("pid"))
    members = top_by(participants(spark, sf_dir).join(top, "pid", "left_semi"), ["pid"], [F.col("oid")], 20)
    found = graph.pairs(members, "pid", "oid").withColumnRenamed("shared", "weight")
    return found.orderBy(F.desc("weight"), "a", "b").limit(1000)
