"""Joins, aggregates, windows, sets, samples and profiles over the star schema."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomwork.core import artifacts
from loomwork.core.keys import anti, count_distinct_rows, count_where, insert_missing, semi, upsert
from loomwork.operators import profile as prof
from loomwork.queries.registry import ORACLES, query, table


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_totalprice BETWEEN 1000 AND 50000 AND o_orderpriority LIKE '1%' AND o_orderstatus IS DISTINCT FROM 'P'")
def filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Range, prefix and null-safe filters, pushed to the scan."""
    o = table(spark, sf_dir, "orders")
    return o.where(F.col("o_totalprice").between(1000, 50000) & F.col("o_orderpriority").like("1%") & ~F.col("o_orderstatus").eqNullSafe("P")).select("o_orderkey", "o_custkey", "o_totalprice")


@query("SELECT * EXCLUDE (c_acctbal) REPLACE (lower(c_mktsegment) AS c_mktsegment) FROM customer")
def exclude_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns dropped and replaced, order kept."""
    return table(spark, sf_dir, "customer").drop("c_acctbal").withColumn("c_mktsegment", F.lower("c_mktsegment"))


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)")
def semi_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    big = table(spark, sf_dir, "orders").where("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey"))
    return semi(table(spark, sf_dir, "customer"), big, ["c_custkey"]).select("c_custkey", "c_name")


@query("SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 100000)")
def anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    big = table(spark, sf_dir, "orders").where("o_totalprice > 100000").select(F.col("o_custkey").alias("c_custkey"))
    return anti(table(spark, sf_dir, "customer"), big, ["c_custkey"]).select("c_custkey", "c_name")


@query("SELECT event_id, w FROM (SELECT event_id, unnest(string_split(event_type, '_')) AS w FROM events) WHERE w <> ''")
def lateral_unnest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each element of a list."""
    e = table(spark, sf_dir, "events")
    return e.select("event_id", F.explode(F.split("event_type", "_")).alias("w")).where("w <> ''")


@query(
    """SELECT l_returnflag, count(*) AS n, count(DISTINCT l_suppkey) AS suppliers, count(DISTINCT (l_suppkey, l_linestatus)) AS pairs, count(*) FILTER (WHERE l_discount > 0.05) AS discounted,
      bool_or(l_quantity > 49) AS any_large, min(l_shipdate)::DATE::VARCHAR AS first_day, max(l_partkey) AS last_part, arg_max(l_orderkey, (l_extendedprice, l_orderkey)) AS dearest, round(avg(l_quantity), 4) AS mean_quantity
    FROM lineitem GROUP BY 1"""
)
def aggregates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, distinct tuples, filtered counts, bool_or, arg_max."""
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_returnflag")
        .agg(
            F.count("*").alias("n"),
            F.count_distinct("l_suppkey").alias("suppliers"),
            count_distinct_rows("l_suppkey", "l_linestatus").alias("pairs"),
            count_where(F.col("l_discount") > 0.05).alias("discounted"),
            F.bool_or(F.col("l_quantity") > 49).alias("any_large"),
            F.date_format(F.min("l_shipdate"), "yyyy-MM-dd").alias("first_day"),
            F.max("l_partkey").alias("last_part"),
            F.max_by("l_orderkey", F.struct("l_extendedprice", "l_orderkey")).alias("dearest"),
            F.round(F.avg("l_quantity"), 4).alias("mean_quantity"),
        )
    )


@query("SELECT l_suppkey, round(max(l_extendedprice) FILTER (WHERE l_returnflag = 'A'), 2) AS a, round(max(l_extendedprice) FILTER (WHERE l_returnflag = 'N'), 2) AS n, round(max(l_extendedprice) FILTER (WHERE l_returnflag = 'R'), 2) AS r FROM lineitem GROUP BY 1")
def pivot_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pivot by filtered maxima."""
    p = table(spark, sf_dir, "lineitem").groupBy("l_suppkey").pivot("l_returnflag", ["A", "N", "R"]).agg(F.round(F.max("l_extendedprice"), 2))
    return p.select("l_suppkey", F.col("A").alias("a"), F.col("N").alias("n"), F.col("R").alias("r"))


@query("SELECT lang, round(quantile_cont(n_chars, 0.5), 4) AS p50, round(quantile_cont(n_chars, 0.9), 4) AS p90, round(quantile_cont(n_chars, 0.99), 4) AS p99 FROM documents GROUP BY 1")
def length_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = prof.quantiles(table(spark, sf_dir, "documents"), "n_chars", [0.5, 0.9, 0.99], ["lang"])
    return found.select("lang", *[F.round(c, 4).alias(c) for c in ("p50", "p90", "p99")])


@query("SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY ALL HAVING count(*) > 100")
def group_having(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").groupBy("o_orderstatus", "o_orderpriority").agg(F.count("*").alias("n")).where("n > 100")


@query("SELECT (year(o_orderdate) // 5 * 5)::BIGINT AS bucket, count(*) AS n FROM orders GROUP BY 1")
def year_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").groupBy(prof.buckets(F.year("o_orderdate"), 5).alias("bucket")).agg(F.count("*").alias("n"))


@query("SELECT count(*) AS n, sum(doc_id)::BIGINT AS id_sum, bit_xor(doc_id) AS id_xor FROM documents")
def fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Count, sum and xor of a table's ids."""
    return artifacts.fingerprint(table(spark, sf_dir, "documents"), "doc_id").select("n", F.col("id_sum").cast("long").alias("id_sum"), "id_xor")


_DOC_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@query()
def table_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and present values by column, in one scan."""
    return prof.profile(table(spark, sf_dir, "documents"))


ORACLES["table_profile"] = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) AS n, count({f"nullif({c}, '')" if c in ("text", "lang", "source") else c}) AS n_present, round(100.0 * count({f"nullif({c}, '')" if c in ("text", "lang", "source") else c}) / count(*), 2) AS percent FROM documents""" for c in _DOC_COLUMNS
)


@query("SELECT source, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 4) AS percent FROM documents GROUP BY 1")
def share_of_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prof.share_of_total(table(spark, sf_dir, "documents"), ["source"])


@query("SELECT o_custkey AS k, count(*) AS n, sum(count(*)) OVER (ORDER BY count(*) DESC)::BIGINT AS cumulative FROM orders GROUP BY 1")
def cumulative_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prof.cumulative_share(table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k")), "k")


_MIX = "(({id} % 2147483647) + {seed}) * 48271 % 2147483647"


@query(f"SELECT c_custkey, c_name FROM customer ORDER BY {_MIX.format(id='c_custkey', seed=42)}, c_custkey LIMIT 100")
def hash_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exactly 100 rows that look random and repeat."""
    return prof.hash_sample(table(spark, sf_dir, "customer"), "c_custkey", 100, 42).select("c_custkey", "c_name")


@query(f"SELECT c_custkey, c_mktsegment FROM (SELECT *, row_number() OVER (PARTITION BY c_mktsegment ORDER BY {_MIX.format(id='c_custkey', seed=7)}, c_custkey) AS k FROM customer) WHERE k <= 10")
def stratified_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prof.stratified_sample(table(spark, sf_dir, "customer"), ["c_mktsegment"], "c_custkey", 10, 7).select("c_custkey", "c_mktsegment")


@query(f"WITH s AS (SELECT o_orderkey FROM orders ORDER BY {_MIX.format(id='o_orderkey', seed=3)}, o_orderkey LIMIT 200) SELECT l_orderkey, l_linenumber, l_suppkey FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM s)")
def connected_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of 200 sampled orders."""
    lines = table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey").withColumnRenamed("l_suppkey", "s")
    _, (reached,) = prof.connected_sample(table(spark, sf_dir, "orders"), "o_orderkey", [(lines, "o_orderkey", "s")], 200, 3)
    return reached.select(F.col("o_orderkey").alias("l_orderkey"), "l_linenumber", F.col("s").alias("l_suppkey"))


@query(
    f"""WITH s AS (SELECT o_orderkey FROM orders ORDER BY {_MIX.format(id='o_orderkey', seed=5)}, o_orderkey LIMIT 20), l AS (SELECT * FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM s)),
    u AS (SELECT DISTINCT l_suppkey AS id FROM l), n AS (SELECT DISTINCT s_nationkey AS id FROM supplier WHERE s_suppkey IN (SELECT id FROM u)), c AS (SELECT c_custkey AS id FROM customer WHERE c_nationkey IN (SELECT id FROM n))
    SELECT 'order' AS kind, (SELECT count(*) FROM s) AS n UNION ALL SELECT 'supplier', (SELECT count(*) FROM u) UNION ALL SELECT 'nation', (SELECT count(*) FROM n) UNION ALL SELECT 'customer', (SELECT count(*) FROM c)
    UNION ALL SELECT 'lines', (SELECT count(*) FROM l)"""
)
def closed_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sample of orders with all that their links lead to, and the links with both ends in it."""
    lines, supplier, customer = (table(spark, sf_dir, t) for t in ("lineitem", "supplier", "customer"))
    links = [
        (customer.select(F.col("c_nationkey").alias("f"), F.col("c_custkey").alias("t")), "f", "nation", "t", "customer"),
        (lines.select(F.col("l_orderkey").alias("f"), F.col("l_suppkey").alias("t")), "f", "order", "t", "supplier"),
        (supplier.select(F.col("s_suppkey").alias("f"), F.col("s_nationkey").alias("t")), "f", "supplier", "t", "nation"),
    ]
    nodes, kept = prof.closed_sample(table(spark, sf_dir, "orders"), "o_orderkey", "order", links, 20, 5)
    parts = [df.agg(F.count("*").alias("n")).select(F.lit(kind).alias("kind"), "n") for kind, df in {**nodes, "lines": kept[1]}.items()]
    return reduce(DataFrame.unionByName, parts)


@query(
    """WITH g AS (SELECT (CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 1 END)::INTEGER AS t, o_orderdate::DATE AS d, count(*) AS n FROM orders GROUP BY 1, 2), r AS (SELECT *, sum(n) OVER (ORDER BY t, d DESC NULLS LAST) AS upto FROM g)
    SELECT cap::INTEGER AS cap, t AS cutoff_tier, d::VARCHAR AS cutoff_date, (upto - n)::BIGINT AS kept_before, (cap - upto + n)::BIGINT AS kept_on_cutoff, round((cap - upto + n) / n, 6) AS share FROM r, (VALUES (1000), (5000), (12000)) c(cap) WHERE upto - n < cap AND upto >= cap"""
)
def cap_simulation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where caps of three sizes would cut, from counts by tier and date."""
    o = table(spark, sf_dir, "orders").select(F.when(F.col("o_orderstatus") == "F", 0).otherwise(1).alias("t"), F.col("o_orderdate").cast("date").alias("d"))
    return prof.cap_simulation(o, "t", "d", [1000, 5000, 12000]).withColumn("cutoff_date", F.date_format("cutoff_date", "yyyy-MM-dd"))


@query("SELECT s_nationkey AS k FROM supplier UNION SELECT c_nationkey FROM customer WHERE c_acctbal < 0")
def union_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("k"))
    return a.union(table(spark, sf_dir, "customer").where("c_acctbal < 0").select("c_nationkey")).distinct()


@query("(SELECT o_orderkey AS id, 'dear' AS why FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10) UNION ALL (SELECT o_orderkey, 'late' FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 10)")
def union_of_tops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Union of arms that have their own order and limit."""
    o = table(spark, sf_dir, "orders")
    dear = o.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(10).select(F.col("o_orderkey").alias("id"), F.lit("dear").alias("why"))
    return dear.unionAll(o.orderBy(F.desc("o_orderdate"), "o_orderkey").limit(10).select("o_orderkey", F.lit("late")))


@query("SELECT c_custkey AS id FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_totalprice > 200000")
def set_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id")).subtract(table(spark, sf_dir, "orders").where("o_totalprice > 200000").select("o_custkey"))


@query(
    """SELECT l_orderkey AS id, list_sort(list(DISTINCT l_suppkey)) AS suppliers, list(l_linenumber ORDER BY l_extendedprice DESC, l_linenumber)[1:3] AS dearest, len(list(l_suppkey)) AS n,
      list_has_any(list(l_suppkey), [1, 2, 3]) AS has_first FROM lineitem GROUP BY 1"""
)
def list_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sorted, distinct, sliced and tested lists."""
    packed = F.array_sort(F.collect_list(F.struct((-F.col("l_extendedprice")).alias("o"), "l_linenumber")))
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("id"))
        .agg(
            F.array_sort(F.collect_set("l_suppkey")).alias("suppliers"),
            F.slice(F.transform(packed, lambda x: x["l_linenumber"]), 1, 3).alias("dearest"),
            F.count("l_suppkey").alias("n"),
            F.bool_or(F.col("l_suppkey").isin(1, 2, 3)).alias("has_first"),
        )
    )


@query("SELECT event_id, json_extract_string(props, '$.k') AS k, props LIKE '{%' AS is_object FROM events")
def json_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A field of a JSON text."""
    return table(spark, sf_dir, "events").select("event_id", F.get_json_object("props", "$.k").alias("k"), F.col("props").like("{%").alias("is_object"))


@query(
    """SELECT c_custkey AS id, coalesce(n.v, c_name) AS name FROM customer c LEFT JOIN (SELECT o_custkey, max(o_orderkey)::VARCHAR AS v FROM orders WHERE o_totalprice > 300000 GROUP BY 1) n ON o_custkey = c_custkey
    UNION ALL SELECT o_custkey + 1000000, max(o_orderkey)::VARCHAR FROM orders WHERE o_totalprice > 450000 GROUP BY 1"""
)
def upsert_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keyed replace, then insert of what is missing."""
    old = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    o = table(spark, sf_dir, "orders")
    new = o.where("o_totalprice > 300000").groupBy(F.col("o_custkey").alias("id")).agg(F.max("o_orderkey").cast("string").alias("name"))
    more = o.where("o_totalprice > 450000").groupBy((F.col("o_custkey") + 1000000).alias("id")).agg(F.max("o_orderkey").cast("string").alias("name"))
    known = old.select("id")
    return insert_missing(upsert(old, new.join(known, "id", "left_semi"), ["id"]), more, ["id"])


@query("SELECT date_trunc('hour', ts)::VARCHAR AS hour, event_type, count(*) AS n, max(event_id) AS last_id FROM events WHERE ts >= (SELECT max(ts) - INTERVAL 3 DAY - INTERVAL 5 SECOND FROM events) GROUP BY 1, 2")
def checkpoint_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events after a checkpoint less five seconds, by hour and type."""
    e = table(spark, sf_dir, "events")
    last = e.agg(F.max("ts").alias("m")).first()["m"]
    late = e.where(F.col("ts") >= F.lit(last) - F.expr("INTERVAL '3 00:00:05' DAY TO SECOND"))
    return late.groupBy(F.date_format(F.date_trunc("hour", "ts"), "yyyy-MM-dd HH:mm:ss").alias("hour"), "event_type").agg(F.count("*").alias("n"), F.max("event_id").alias("last_id"))


@query("SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def resume_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inputs that no earlier run has produced."""
    return artifacts.pending(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "doc_id").select("doc_id", "lang")


@query("SELECT doc_id % 4 AS shard, count(*) AS n, sum(doc_id)::BIGINT AS id_sum FROM documents GROUP BY 1")
def id_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Disjoint shards by id modulo N."""
    d = table(spark, sf_dir, "documents")
    return d.groupBy(F.pmod("doc_id", F.lit(4)).alias("shard")).agg(F.count("*").alias("n"), F.sum("doc_id").alias("id_sum"))


# Extras: not operators of the graph engine, but free with Spark.


@query("SELECT o_orderstatus AS status, year(o_orderdate)::INTEGER AS year, count(*) AS n FROM orders GROUP BY ROLLUP (1, 2)")
def extra_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extra: grouping sets."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("status"), F.year("o_orderdate").alias("year"))
    return o.rollup("status", "year").agg(F.count("*").alias("n"))


@query("SELECT time_bucket(INTERVAL 6 HOUR, ts)::VARCHAR AS window_start, event_type, count(*) AS n, round(sum(value), 3) AS total FROM events GROUP BY 1, 2")
def extra_tumbling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extra: tumbling event-time windows."""
    e = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    w = e.groupBy(F.window("ts", "6 hours").alias("w"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 3).alias("total"))
    return w.select(F.date_format(F.col("w.start"), "yyyy-MM-dd HH:mm:ss").alias("window_start"), "event_type", "n", "total")


@query(
    """SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS session_start, count(*) AS n FROM (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS s FROM (SELECT *,
      CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) < INTERVAL 2 HOUR THEN 0 ELSE 1 END AS new FROM events)) GROUP BY user_id, s"""
)
def extra_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extra: sessions that end after two idle hours."""
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    e = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    marked = e.withColumn("new", F.when(F.col("ts") - F.lag("ts").over(w) < F.expr("INTERVAL 2 HOURS"), 0).otherwise(1))
    numbered = marked.withColumn("s", F.sum("new").over(w))
    return numbered.groupBy("user_id", "s").agg(F.date_format(F.min("ts"), "yyyy-MM-dd HH:mm:ss").alias("session_start"), F.count("*").alias("n")).drop("s")
