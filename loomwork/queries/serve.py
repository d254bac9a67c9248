"""Denormalised documents for serving."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwork.functions.codes import norm_language, sane_year
from loomwork.functions.text import norm_doi, sanitize_string
from loomwork.plans import documents as docs
from loomwork.plans.enrich import mask_names
from loomwork.queries.graph import participants, shares
from loomwork.queries.registry import query, table

_PO = """po AS (SELECT p.pid, p.oid, p.is_coord, s_name AS name, coalesce(r_name, 'Unknown') AS region, n_name AS country FROM (SELECT l_orderkey AS pid, l_suppkey AS oid, bool_or(l_linenumber = 1) AS is_coord
      FROM lineitem GROUP BY 1, 2) p JOIN supplier ON s_suppkey = p.oid LEFT JOIN nation ON n_nationkey = s_nationkey LEFT JOIN region ON r_regionkey = n_regionkey)"""
_ORGS = f"""{_PO}, orgs AS (SELECT pid, list(oid::VARCHAR ORDER BY is_coord DESC, oid) AS org_ids, list(name ORDER BY is_coord DESC, oid) FILTER (name IS NOT NULL) AS org_names,
      list_sort(list(DISTINCT region)) AS org_regions, list_sort(list(DISTINCT country)) AS org_countries, list_sort(list(oid::VARCHAR) FILTER (is_coord)) AS coordinator_ids, count(*)::INTEGER AS org_count FROM po GROUP BY pid)"""


def _po(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("r_regionkey") == F.col("n_regionkey"), "left")
    orgs = (
        table(spark, sf_dir, "supplier")
        .join(nations, F.col("n_nationkey") == F.col("s_nationkey"), "left")
        .select(F.col("s_suppkey").alias("oid"), F.col("s_name").alias("name"), F.col("r_name").alias("region"), F.col("n_name").alias("country"))
    )
    return docs.participation(participants(spark, sf_dir), orgs)


@query(f"WITH {_ORGS} SELECT pid, org_ids, org_names, org_regions, org_countries, coalesce(coordinator_ids, []) AS coordinator_ids, org_count FROM orgs")
def project_orgs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ordered lists per project."""
    return docs.project_orgs(_po(spark, sf_dir))


@query(
    f"""WITH {_PO}, n AS (SELECT pid, count(*) AS n FROM po GROUP BY pid), f AS (SELECT oid, count(*) AS project_count, count(*) FILTER (is_coord) AS coordinator_count, sum(o_totalprice / n) AS eur,
      list_sort(list(DISTINCT o_orderpriority)) AS programmes, min(year(o_orderdate))::INTEGER AS first_year, max(year(o_orderdate))::INTEGER AS last_year FROM po JOIN n USING (pid) JOIN orders ON o_orderkey = pid GROUP BY oid),
    w AS (SELECT l_suppkey AS oid, count(DISTINCT l_partkey) AS work_count, list_sort(list(DISTINCT p_size // 10)) AS field_ids FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1)
    SELECT s_suppkey::VARCHAR AS id, s_name AS name, lower(s_name) || '|' || lower(n_name) AS name_key, n_name AS country, coalesce(r_name, 'Unknown') AS region, round(s_acctbal, 2) AS balance, s_acctbal < 0 AS in_debt,
      coalesce(project_count, 0) AS project_count, coalesce(coordinator_count, 0) AS coordinator_count, nullif(coalesce(project_count, 0), 0) AS rank_projects, coalesce(work_count, 0) AS work_count, round(eur, 2) AS total_funding_eur,
      round(eur / nullif(project_count, 0), 2) AS mean_funding_eur, coalesce(programmes, []) AS programmes, coalesce(field_ids, []) AS field_ids, first_year, last_year,
      round((s_nationkey % 90)::DOUBLE, 1) AS lat, round((s_suppkey % 170)::DOUBLE, 1) AS lon
    FROM supplier LEFT JOIN nation ON n_nationkey = s_nationkey LEFT JOIN region ON r_regionkey = n_regionkey LEFT JOIN f ON f.oid = s_suppkey LEFT JOIN w ON w.oid = s_suppkey"""
)
def organisations_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row an organisation: place, counts, funding, years, key; rank fields null at 0."""
    lines = table(spark, sf_dir, "lineitem").withColumnRenamed("l_suppkey", "oid").join(table(spark, sf_dir, "part"), F.col("p_partkey") == F.col("l_partkey"))
    works = lines.groupBy("oid").agg(F.count_distinct("l_partkey").alias("work_count"), F.array_sort(F.collect_set(F.floor(F.col("p_size") / 10).cast("int"))).alias("field_ids"))
    projects = participants(spark, sf_dir).join(shares(spark, sf_dir), "pid").join(table(spark, sf_dir, "orders"), F.col("o_orderkey") == F.col("pid"))
    year = F.year("o_orderdate")
    funded = projects.groupBy("oid").agg(
        F.count("*").alias("project_count"),
        F.count_if("is_coord").alias("coordinator_count"),
        F.sum("eur").alias("eur"),
        F.array_sort(F.collect_set("o_orderpriority")).alias("programmes"),
        F.min(year).alias("first_year"),
        F.max(year).alias("last_year"),
    )
    places = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("r_regionkey") == F.col("n_regionkey"), "left")
    base = table(spark, sf_dir, "supplier").join(places, F.col("n_nationkey") == F.col("s_nationkey"), "left").withColumnRenamed("s_suppkey", "oid")
    zero = F.lit(0).cast("long")
    fill = {"work_count": zero, "project_count": zero, "coordinator_count": zero, "programmes": F.array().cast("array<string>"), "field_ids": F.array().cast("array<int>")}
    joined = docs.left_chain(base, [works, funded], "oid", fill)
    fields = {
        "id": F.col("oid").cast("string"),
        "name": F.col("s_name"),
        "name_key": F.concat(F.lower("s_name"), F.lit("|"), F.lower("n_name")),
        "country": F.col("n_name"),
        "region": F.coalesce("r_name", F.lit("Unknown")),
        "balance": F.round("s_acctbal", 2),
        "in_debt": F.col("s_acctbal") < 0,
        "rank_projects": F.nullif(F.col("project_count"), zero),
        "total_funding_eur": F.round("eur", 2),
        "mean_funding_eur": F.round(F.col("eur") / F.nullif(F.col("project_count"), zero), 2),
        "first_year": F.col("first_year"),
        "last_year": F.col("last_year"),
        "lat": F.round((F.col("s_nationkey") % 90).cast("double"), 1),
        "lon": F.round((F.col("oid") % 170).cast("double"), 1),
    }
    return joined.select(*[c.alias(name) for name, c in fields.items()], *fill)


@query(
    """WITH a AS (SELECT l_partkey AS wid, list(name ORDER BY oid) AS names, list(oid::VARCHAR ORDER BY oid) AS ids FROM (SELECT DISTINCT l_partkey, l_suppkey AS oid, s_name AS name FROM lineitem JOIN supplier ON s_suppkey = l_suppkey) GROUP BY 1),
    h AS (SELECT l_partkey AS wid, list_sort(list(DISTINCT l_orderkey)) AS pids, bool_or(o_orderstatus = 'F') AS via_finished, bool_or((l_orderkey % 100) / 100.0 > 0.55) AS is_ch_via_project, list_sort(list(DISTINCT o_orderpriority)) AS priorities,
      max(l_shipdate)::DATE AS day, count(*)::INTEGER AS citations, min(CASE WHEN l_linenumber = 1 THEN 0 ELSE 1 END)::SMALLINT AS tier FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1),
    m AS (SELECT l_partkey AS wid, list_sort(list(DISTINCT l_suppkey % 7)) AS minority_ids FROM lineitem WHERE l_orderkey IN (SELECT l_orderkey FROM lineitem) AND l_discount >= 0.05 GROUP BY 1)
    SELECT p_partkey::VARCHAR AS id, p_name AS title, names[1:20] AS authors, len(names)::INTEGER AS author_count, strftime(day, '%Y-%m-%d') AS publication_date, year(day)::INTEGER AS year, p_brand AS publisher,
      split_part(p_type, ' ', 1) AS container_name, CASE p_size % 3 WHEN 0 THEN 'gold' WHEN 1 THEN 'green' END AS open_access_color, CASE WHEN p_size % 3 = 2 THEN 'CLOSED' ELSE 'OPEN' END AS best_access_right,
      CASE p_size % 4 WHEN 0 THEN 'eng' WHEN 1 THEN 'deu' WHEN 2 THEN 'fra' END AS language, citations AS citation_count, '10.9/' || p_partkey AS doi, CASE WHEN p_size % 2 = 0 THEN 'https://w.example/' || p_partkey || '.pdf' END AS pdf_url,
      'https://doi.org/10.9/' || p_partkey AS landing_url, list_transform(pids[1:20], lambda x: x::VARCHAR) AS project_ids, ids[1:100] AS organisation_ids, len(ids)::INTEGER AS org_count, is_ch_via_project, coalesce(minority_ids, []) AS minority_ids,
      tier AS link_tier, p_size >= 25 AS large, via_finished, priorities FROM part JOIN h ON h.wid = p_partkey LEFT JOIN a ON a.wid = p_partkey LEFT JOIN m ON m.wid = p_partkey"""
)
def works_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row a work: its own fields, authors, links, and proxies of its projects over two hops; lists capped with their true counts."""
    lines = table(spark, sf_dir, "lineitem")
    hop = lines.join(table(spark, sf_dir, "orders"), F.col("o_orderkey") == F.col("l_orderkey")).withColumnRenamed("l_partkey", "wid")
    rolled = hop.groupBy("wid").agg(
        F.array_sort(F.collect_set("l_orderkey")).alias("pids"),
        F.bool_or(F.col("o_orderstatus") == "F").alias("via_finished"),
        F.bool_or((F.col("l_orderkey") % 100) / 100.0 > 0.55).alias("is_ch_via_project"),
        F.array_sort(F.collect_set("o_orderpriority")).alias("priorities"),
        F.max("l_shipdate").alias("day"),
        F.count("*").cast("int").alias("citation_count"),
        F.min(F.when(F.col("l_linenumber") == 1, 0).otherwise(1)).cast("short").alias("link_tier"),
        F.array_sort(F.collect_set(F.when(F.col("l_discount") >= 0.05, F.col("l_suppkey") % 7))).alias("minority_ids"),
    )
    people = lines.select(F.col("l_partkey").alias("wid"), "l_suppkey").distinct().join(table(spark, sf_dir, "supplier"), F.col("s_suppkey") == F.col("l_suppkey"))
    authors = people.groupBy("wid").agg(F.array_sort(F.collect_list(F.struct("s_suppkey", "s_name"))).alias("a"))
    base = table(spark, sf_dir, "part").withColumnRenamed("p_partkey", "wid")
    joined = base.join(rolled, "wid").join(authors, "wid", "left")
    key, size, text_id = F.col("wid").cast("string"), F.col("p_size"), F.concat(F.lit("10.9/"), F.col("wid").cast("string"))
    fields = {
        "id": key,
        "title": F.col("p_name"),
        "authors": F.transform(F.slice("a", 1, 20), lambda x: x["s_name"]),
        "author_count": F.size("a"),
        "publication_date": F.date_format("day", "yyyy-MM-dd"),
        "year": sane_year(F.col("day")),
        "publisher": F.col("p_brand"),
        "container_name": F.split_part("p_type", F.lit(" "), F.lit(1)),
        "open_access_color": F.when(size % 3 == 0, "gold").when(size % 3 == 1, "green"),
        "best_access_right": F.when(size % 3 == 2, "CLOSED").otherwise("OPEN"),
        "language": norm_language(F.when(size % 4 == 0, "eng").when(size % 4 == 1, "ger/deu").when(size % 4 == 2, "fre").otherwise("und")),
        "citation_count": F.col("citation_count"),
        "doi": norm_doi(F.concat(F.lit("https://doi.org/"), text_id)),
        "pdf_url": F.when(size % 2 == 0, F.concat(F.lit("https://w.example/"), key, F.lit(".pdf"))),
        "landing_url": F.concat(F.lit("https://doi.org/"), text_id),
        "project_ids": F.transform(F.slice("pids", 1, 20), lambda x: x.cast("string")),
        "organisation_ids": F.transform(F.slice("a", 1, 100), lambda x: x["s_suppkey"].cast("string")),
        "org_count": F.size("a"),
        "large": size >= 25,
    }
    return joined.select(*[c.alias(name) for name, c in fields.items()], "is_ch_via_project", "minority_ids", "link_tier", "via_finished", "priorities")


@query(
    """WITH t AS (SELECT s_nationkey AS id, p_size AS topic_id, p_name, l_extendedprice AS pred, l_orderkey, l_linenumber FROM lineitem JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey), r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY pred DESC, l_orderkey, l_linenumber) AS k FROM t)
    SELECT id, n_name AS name, b.blob,
      c.topic_counts, count(DISTINCT l_orderkey) AS project_count
    FROM t JOIN nation ON n_nationkey = id JOIN (SELECT id, left(string_agg(p_name, ' ' ORDER BY k), 20000) AS blob FROM r WHERE k <= 200 GROUP BY 1) b USING (id)
    JOIN (SELECT id, list(topic_id || ':' || n ORDER BY n DESC, topic_id) AS topic_counts FROM (SELECT id, topic_id, count(*) AS n FROM t GROUP BY 1, 2) GROUP BY 1) c USING (id) GROUP BY ALL"""
)
def groups_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row a group: capped title blob, ordered topic counts, project count."""
    t = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part"), F.col("p_partkey") == F.col("l_partkey")).join(table(spark, sf_dir, "supplier"), F.col("s_suppkey") == F.col("l_suppkey"))
    t = t.select(F.col("s_nationkey").alias("id"), F.col("p_size").alias("topic_id"), "p_name", (-F.col("l_extendedprice")).alias("o"), "l_orderkey", "l_linenumber")
    blob = docs.text_blob(t, "id", "p_name", ["o", "l_orderkey", "l_linenumber"], 200, 20_000)
    counts = docs.key_counts(t, "id", "topic_id").select("id", F.transform("counts", lambda x: F.concat_ws(":", x["value"].cast("string"), x["n"].cast("string"))).alias("topic_counts"))
    projects = t.groupBy("id").agg(F.count_distinct("l_orderkey").alias("project_count"))
    named = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"))
    return named.join(blob, "id").join(counts, "id").join(projects, "id")


_STREAMS = """f AS (SELECT l_orderkey AS pid, l_shipdate, 'F' || (l_suppkey % 5) AS funder, CASE WHEN l_returnflag <> 'R' THEN 'F' || (l_suppkey % 5) || '::' || p_brand || '::' || split_part(p_type, ' ', 1) END AS sid
      FROM lineitem JOIN part ON p_partkey = l_partkey), s AS (SELECT pid, coalesce(sid, 'NONE::' || funder) AS stream_id, nullif(split_part(sid, '::', 2), '') AS programme, nullif(split_part(sid, '::', 3), '') AS action, funder FROM f)"""


def _streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part"), F.col("p_partkey") == F.col("l_partkey"))
    funder = F.concat(F.lit("F"), (F.col("l_suppkey") % 5).cast("string"))
    sid = F.when(F.col("l_returnflag") != "R", F.concat_ws("::", funder, "p_brand", F.split_part("p_type", F.lit(" "), F.lit(1))))
    return docs.streams(lines.select(F.col("l_orderkey").alias("pid"), funder.alias("funder"), sid.alias("sid")))


#: What stands for fields that the tables lack.
_CURRENCIES = ("EUR", "USD", "XXX")
_PILLARS = ("inclusive", "sustainable", "resilient", "innovative", "global")
_RATE = "CASE o_custkey % 3 WHEN 0 THEN 1.0 WHEN 1 THEN 1.146 END"


@query(
    f"""WITH {_ORGS}, {_STREAMS}, works AS (SELECT l_orderkey AS pid, count(DISTINCT l_partkey)::INTEGER AS work_count, max(l_shipdate)::DATE AS end_date, list_sort(list(DISTINCT p_brand)) AS keywords,
      list_sort(list(DISTINCT split_part(p_type, ' ', 1))) AS subjects FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1),
    best AS (SELECT pid, topic_id, p_size AS subfield_id, p_size // 10 AS field_id, p_size // 25 AS domain_id FROM (SELECT l_orderkey AS pid, l_partkey AS topic_id, p_size, row_number() OVER (PARTITION BY l_orderkey
      ORDER BY l_extendedprice DESC, l_partkey) AS k FROM lineitem JOIN part ON p_partkey = l_partkey) WHERE k = 1),
    fund AS (SELECT pid, list_sort(list(DISTINCT funder)) AS funder, list_sort(list(DISTINCT programme) FILTER (programme IS NOT NULL)) AS programme, list_sort(list(DISTINCT stream_id)) AS funding_stream_ids,
      list_sort(list(DISTINCT action) FILTER (action IS NOT NULL)) AS actions FROM s GROUP BY 1),
    tags AS (SELECT l_orderkey AS pid, list_sort(list(DISTINCT l_suppkey % 7)) AS minority_ids FROM lineitem WHERE l_discount >= 0.05 GROUP BY 1),
    p AS (SELECT o_orderkey AS pid, *, {_RATE} AS rate, o_orderkey % 32 AS mask, (o_orderkey % 100) / 100.0 AS pr FROM orders)
    SELECT pid::VARCHAR AS id, 'G' || pid AS grant_id, 'Project ' || o_orderpriority AS title, nullif(upper(split_part(o_orderpriority, '-', 2)), '') AS acronym, 'https://p.example/' || pid AS website_url,
      strftime(o_orderdate, '%Y-%m-%d') AS start_date, strftime(end_date, '%Y-%m-%d') AS end_date, CASE WHEN year(o_orderdate) BETWEEN 1950 AND 2040 THEN year(o_orderdate)::INTEGER END AS year,
      o_orderstatus = 'F' AS open_access_publications, o_orderstatus = 'P' AS open_access_datasets, coalesce(keywords, []) AS keywords, coalesce(subjects, []) AS subjects,
      CASE o_custkey % 3 WHEN 0 THEN 'EUR' WHEN 1 THEN 'USD' ELSE 'XXX' END AS currency, round(o_totalprice, 2) AS funded_amount, floor(o_totalprice / rate * 100) / 100 AS funded_amount_eur,
      floor(o_totalprice / rate / nullif(org_count, 0) * 10000) / 10000 AS funded_eur_per_org, pid % 4 = 0 AS is_translated, pr > 0.55 AS is_ch, round(pr, 2) AS pred, coalesce(minority_ids, []) AS minority_ids, mask::INTEGER AS pillars,
      list_filter({list(_PILLARS)!r}, lambda x, i: (mask::INTEGER >> (i - 1)::INTEGER) & 1 = 1) AS pillar_list, CASE WHEN field_id <= 1 THEN 'small' WHEN domain_id = 1 THEN 'large' END AS theme,
      topic_id::VARCHAR AS topic_id, subfield_id::VARCHAR AS subfield_id, field_id::VARCHAR AS field_id, domain_id::VARCHAR AS domain_id, coalesce(org_ids, []) AS org_ids, coalesce(org_names, []) AS org_names,
      coalesce(org_regions, []) AS org_regions, coalesce(org_countries, []) AS org_countries, coalesce(coordinator_ids, []) AS coordinator_ids, coalesce(org_count, 0) AS org_count, coalesce(work_count, 0) AS work_count,
      coalesce(funder, []) AS funder, coalesce(programme, []) AS programme, coalesce(actions, []) AS funder_names, coalesce(funding_stream_ids, []) AS funding_stream_ids
    FROM p LEFT JOIN orgs USING (pid) LEFT JOIN works USING (pid) LEFT JOIN best USING (pid) LEFT JOIN fund USING (pid) LEFT JOIN tags USING (pid)"""
)
def projects_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row a project: its own fields, and those of organisations, works, topic, fundings and tags from rollups by project."""
    parts = table(spark, sf_dir, "part")
    lines = table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "pid").join(parts, F.col("p_partkey") == F.col("l_partkey"))
    kind = F.split_part("p_type", F.lit(" "), F.lit(1))
    sorted_set = lambda c: F.array_sort(F.collect_set(c))
    works = lines.groupBy("pid").agg(F.count_distinct("l_partkey").cast("int").alias("work_count"), F.max("l_shipdate").alias("end_date"), sorted_set("p_brand").alias("keywords"), sorted_set(kind).alias("subjects"))
    best = lines.groupBy("pid").agg(F.max_by(F.struct("l_partkey", "p_size"), F.struct("l_extendedprice", -F.col("l_partkey"))).alias("t"))
    fund = _streams(spark, sf_dir).groupBy("pid").agg(
        sorted_set("funder").alias("funder"), sorted_set("programme").alias("programme"), sorted_set("stream_id").alias("funding_stream_ids"), sorted_set("action").alias("funder_names")
    )
    tags = lines.where("l_discount >= 0.05").groupBy("pid").agg(sorted_set(F.col("l_suppkey") % 7).alias("minority_ids"))
    none = F.array().cast("array<string>")
    lists = ("org_ids", "org_names", "org_regions", "org_countries", "coordinator_ids", "keywords", "subjects", "funder", "programme", "funder_names", "funding_stream_ids")
    fill = {c: none for c in lists} | {"minority_ids": F.array().cast("array<bigint>"), "org_count": F.lit(0), "work_count": F.lit(0)}
    base = table(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "pid")
    p = docs.left_chain(base, [docs.project_orgs(_po(spark, sf_dir)), works, best, fund, tags], "pid", fill)
    key, third = F.col("pid"), F.col("o_custkey") % 3
    amount, rate = F.col("o_totalprice"), F.when(third == 0, 1.0).when(third == 1, 1.146)
    mask, pred, size = key % 32, (key % 100) / 100.0, F.col("t.p_size")
    field, domain = F.floor(size / 10), F.floor(size / 25)
    day = lambda c: F.date_format(c, "yyyy-MM-dd")
    fields = {
        "id": key.cast("string"),
        "grant_id": F.concat(F.lit("G"), key.cast("string")),
        "title": F.concat(F.lit("Project "), "o_orderpriority"),
        "acronym": F.nullif(F.upper(F.split_part("o_orderpriority", F.lit("-"), F.lit(2))), F.lit("")),
        "website_url": F.concat(F.lit("https://p.example/"), key.cast("string")),
        "start_date": day("o_orderdate"),
        "end_date": day("end_date"),
        "year": sane_year(F.col("o_orderdate")),
        "open_access_publications": F.col("o_orderstatus") == "F",
        "open_access_datasets": F.col("o_orderstatus") == "P",
        "currency": F.when(third == 0, "EUR").when(third == 1, "USD").otherwise("XXX"),
        "funded_amount": F.round(amount, 2),
        "funded_amount_eur": F.floor(amount / rate * 100) / 100,  # cut, as engines round halves differently
        "funded_eur_per_org": F.floor(amount / rate / F.nullif(F.col("org_count"), F.lit(0)) * 10000) / 10000,
        "is_translated": key % 4 == 0,
        "is_ch": pred > 0.55,
        "pred": F.round(pred, 2),
        "pillars": mask.cast("int"),
        "pillar_list": mask_names(mask, list(_PILLARS)),
        "theme": F.when(field <= 1, "small").when(domain == 1, "large"),
        "topic_id": F.col("t.l_partkey").cast("string"),
        "subfield_id": size.cast("string"),
        "field_id": field.cast("string"),
        "domain_id": domain.cast("string"),
    }
    return p.select(*[c.alias(name) for name, c in fields.items()], *fill)


@query(f"WITH {_STREAMS} SELECT stream_id, min(programme) AS programme, min(action) AS action, count(*) AS n FROM s GROUP BY 1")
def funding_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Streams split into levels; funders without one get a pseudo stream."""
    return _streams(spark, sf_dir).groupBy("stream_id").agg(F.min("programme").alias("programme"), F.min("action").alias("action"), F.count("*").alias("n"))


@query(
    f"""WITH {_STREAMS}, n AS (SELECT pid, count(*) AS n_fund FROM s GROUP BY 1) SELECT stream_id AS id, min(funder) AS funder, count(DISTINCT s.pid) AS project_count, sum(floor(o_totalprice * 1000000 / n_fund)::BIGINT)::BIGINT / 1000000 AS total_eur
    FROM s JOIN n USING (pid) LEFT JOIN orders ON o_orderkey = s.pid GROUP BY 1"""
)
def grants_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row a stream with its equal share of the amounts."""
    amounts = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("pid"), F.col("o_totalprice").alias("amount"))
    return docs.grants(_streams(spark, sf_dir), amounts)


@query("SELECT name, sum(n)::BIGINT AS n FROM (SELECT regexp_extract(lower(raw), '^https?://([^/?#]+)', 1) AS name, count(*) AS n FROM (SELECT regexp_extract(url, '^[^?#]+') AS raw FROM pages) GROUP BY raw) WHERE name <> '' GROUP BY 1 ORDER BY n DESC, name LIMIT 100")
def publisher_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top hosts: addresses counted raw, cleaned once each, counted again."""
    rows = table(spark, sf_dir, "pages").select(F.regexp_extract("url", "^[^?#]+", 0).alias("raw"))
    host = lambda c: sanitize_string(F.regexp_extract(F.lower(c), "^https?://([^/?#]+)", 1))
    return docs.counted_by_clean(rows, "raw", host).orderBy(F.desc("n"), "name").limit(100)
