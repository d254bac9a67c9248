"""Sources and sinks as queries: test tables are landed as files and read back."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwork.core import artifacts, keys, serving
from loomwork.core.scratch import fresh_folder
from loomwork.operators import profile
from loomwork.queries.registry import query, table
from loomwork.sources import readers


@query("SELECT event_id, user_id, event_type, round(value, 6) AS value FROM events")
def read_ndjson_gzip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newline-delimited JSON, gzip, over two globs."""
    root = fresh_folder(spark, "read_ndjson_gzip")
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    for k in (0, 1):
        events.where(F.col("event_id") % 2 == k).repartition(3, "event_id").write.option("compression", "gzip").json(f"{root}/part{k}")
    found = readers.read_ndjson(spark, [f"{root}/part0/*.json.gz", f"{root}/part1/*.json.gz"], events.schema)
    return found.select("event_id", "user_id", "event_type", F.round("value", 6).alias("value"))


@query("SELECT n_nationkey, n_name FROM nation WHERE n_nationkey < 10")
def read_ndjson_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first file of a glob, by name."""
    root = fresh_folder(spark, "read_ndjson_sample")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    for name, part in (("a", nation.where("n_nationkey < 10")), ("b", nation.where("n_nationkey >= 10"))):
        lines = [r[0] for r in part.select(F.to_json(F.struct("*"))).collect()]  # a nation a row, 25 at most
        artifacts.write_text(spark, f"{root}/{name}.json", "\n".join(lines) + "\n")
    return readers.read_ndjson(spark, f"{root}/*.json", nation.schema, first_files=1)


@query("SELECT n_nationkey, n_name, n_regionkey FROM nation")
def json_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A small result as one JSON array file, read back as a document."""
    path = f"{fresh_folder(spark, 'json_array')}/nation.json"
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    artifacts.write_json_array(nation, path)
    return readers.read_json_document(spark, path, nation.schema)


@query("SELECT doc_id::VARCHAR AS doc_id, text, lang FROM documents WHERE text <> ''")
def read_csv_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with quotes, commas and line breaks through CSV, all columns text; the file kind by its suffix."""
    path = f"{fresh_folder(spark, 'read_csv_text')}/documents.csv"
    docs = table(spark, sf_dir, "documents").where("text <> ''").select("doc_id", "text", "lang")
    docs.write.option("header", True).option("escape", '"').option("quoteAll", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return readers.read_table_file(spark, path)


@query("SELECT s_suppkey AS id, s_name AS name, NULL::VARCHAR AS segment FROM supplier UNION ALL SELECT c_custkey, c_name, c_mktsegment FROM customer")
def read_parquet_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parquet files of differing columns as one typed table."""
    root = fresh_folder(spark, "read_parquet_by_name")
    table(spark, sf_dir, "supplier").select(F.col("s_name").alias("name"), F.col("s_suppkey").alias("id")).write.mode("append").parquet(root)
    table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("segment"), F.col("c_name").alias("name")).write.mode("append").parquet(root)
    return readers.read_parquet_union(spark, root, "id long, name string, segment string")


@query("SELECT 0::BIGINT AS id, '' AS name WHERE false")
def read_nothing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder without files is an empty table of the declared type."""
    return readers.read_parquet_union(spark, fresh_folder(spark, "read_nothing"), "id long, name string")


@query("SELECT 'n_' || table_name AS view, (ordinal_position - 1)::INTEGER AS position, column_name AS \"column\" FROM information_schema.columns WHERE table_name IN ('nation', 'region')")
def registered_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tables of a folder as views, and their columns."""
    names = [n for n in readers.register_tables(spark, sf_dir, "n_") if n in ("n_nation", "n_region")]
    parts = [readers.table_columns(spark, n).select(F.lit(n).alias("view"), "position", "column") for n in sorted(names)]
    return parts[0].unionByName(parts[1])


@query("SELECT event_type, count(*) AS n FROM events WHERE value > 10 GROUP BY 1")
def registered_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A frame under a name, queried by SQL."""
    readers.register_frame(table(spark, sf_dir, "events").where("value > 10"), "large_events")
    return spark.sql("SELECT event_type, count(*) AS n FROM large_events GROUP BY event_type")


@query("SELECT * FROM (VALUES (1, 'a'), (2, NULL), (3, '')) t(id, name)")
def inline_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.inline(spark, [(1, "a"), (2, None), (3, "")], "id int, name string")


@query("SELECT n_regionkey::VARCHAR AS folder, n_name AS name FROM nation")
def read_document_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON documents of a folder tree, others left alone."""
    root = fresh_folder(spark, "read_document_tree")
    for r in table(spark, sf_dir, "nation").collect():  # 25 rows
        artifacts.write_text(spark, f"{root}/{r['n_regionkey']}/{r['n_nationkey']}.json", json.dumps({"nation": {"name": r["n_name"]}}))
    artifacts.write_text(spark, f"{root}/0/note.txt", "no document")
    found = readers.read_documents(spark, root)
    return found.select(F.element_at(F.split("path", "/"), -2).alias("folder"), readers.at_path("text", "$.nation.name").alias("name"))


@query("SELECT n_nationkey AS id, n_name AS name, n_regionkey AS region FROM nation")
def read_xml_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Elements of XML files as rows, an attribute among their fields."""
    path = fresh_folder(spark, "read_xml_rows")
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("_id"), F.col("n_name").alias("name"), F.col("n_regionkey").alias("region"))
    nation.write.format("xml").option("rowTag", "nation").option("rootTag", "nations").save(path)
    return readers.read_xml(spark, path, "nation", "_id long, name string, region long").withColumnRenamed("_id", "id")


@query("SELECT conv_id AS id, list_sort(list('\"' || role || '\"')) AS found FROM conversations GROUP BY 1")
def json_find_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every value of a key at any depth of a JSON text."""
    turns = F.collect_list(F.struct(F.struct("role").alias("inner"), "turn"))
    docs = table(spark, sf_dir, "conversations").groupBy(F.col("conv_id").alias("id")).agg(F.to_json(F.struct(turns.alias("turns"))).alias("j"))
    return docs.select("id", F.array_sort(readers.find_key("j", "role")).alias("found"))


@query("SELECT n_nationkey AS id, n_name AS name FROM nation WHERE n_nationkey < (SELECT max(n_nationkey) FROM nation)")
def read_torn_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file whose last record a crash cut off: the whole records."""
    path = f"{fresh_folder(spark, 'read_torn_file')}/log.json"
    rows = table(spark, sf_dir, "nation").orderBy("n_nationkey").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name")).collect()  # 25 rows
    text = "\n".join(json.dumps(r.asDict()) for r in rows)
    artifacts.write_text(spark, path, text[:-5])
    return readers.read_appended(spark, path, "id long, name string")


@query("SELECT event_type, count(*) AS n, min(event_id) AS first_id FROM events GROUP BY 1")
def publish_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published twice by value, sorted within files; the second run replaces the first."""
    path = fresh_folder(spark, "publish_partitioned")
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    artifacts.publish(events.limit(3), path, ["event_type"], ["event_id"])
    artifacts.publish(events, path, ["event_type"], ["event_id"], row_group_bytes=1 << 20)
    return spark.read.parquet(path).groupBy("event_type").agg(F.count("*").alias("n"), F.min("event_id").alias("first_id"))


@query("SELECT (o_orderkey % 4)::INTEGER AS chunk, count(*) AS n, sum(o_orderkey)::BIGINT AS keys FROM orders GROUP BY 1")
def export_in_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks by key; a rerun writes the missing one alone."""
    path = fresh_folder(spark, "export_in_chunks")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    artifacts.export_chunks(orders, path, "o_orderkey", 4, ["o_orderkey"])
    artifacts.remove(spark, f"{path}/chunk=2")
    assert artifacts.export_chunks(orders, path, "o_orderkey", 4, ["o_orderkey"]) == [2]
    return spark.read.parquet(path).groupBy("chunk").agg(F.count("*").alias("n"), F.sum("o_orderkey").alias("keys"))


@query("SELECT count(*) AS n, sum(p_partkey)::BIGINT AS id_sum, true AS has_bytes, false AS replaced_by_others FROM part")
def export_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An export's manifest: rows, fingerprint, bytes; another input is refused."""
    path = f"{fresh_folder(spark, 'export_manifest')}/part"
    parts = table(spark, sf_dir, "part")
    m = artifacts.export(parts, path, "p_partkey", [f"{sf_dir}/part.parquet"])
    try:
        artifacts.export(parts, path, "p_partkey", [f"{sf_dir}/nation.parquet"])
        replaced = True
    except artifacts.Stale:
        replaced = False
    row = (m.rows, m.stamp.id_sum, bool(m.bytes and m.inputs), replaced)
    return spark.createDataFrame([row], "n long, id_sum long, has_bytes boolean, replaced_by_others boolean")


@query("SELECT (SELECT count(*) FROM documents WHERE lang = 'en') AS hits, (SELECT count(*) FROM documents) AS seen, 0::BIGINT AS pending")
def sparse_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits and the ids looked at, in two runs; nothing is left to do."""
    path = f"{fresh_folder(spark, 'sparse_output')}/hits"
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    for k in (0, 1):
        part = docs.where(F.pmod("doc_id", F.lit(2)) == k)
        artifacts.write_sparse(part.where("lang = 'en'").select("doc_id"), part.select("doc_id"), path)
    seen = spark.read.parquet(artifacts.seen_path(path))
    left = artifacts.pending(docs, seen, "doc_id")
    count = lambda df, name: df.agg(F.count("*").alias(name))  # noqa: E731  one row each
    return count(spark.read.parquet(path), "hits").join(count(seen, "seen")).join(count(left, "pending"))


@query("SELECT s_suppkey, s_name, NULL::DOUBLE AS lat, NULL::VARCHAR AS region FROM supplier")
def add_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keys.add_missing_columns(table(spark, sf_dir, "supplier").select("s_suppkey", "s_name"), {"s_name": "string", "lat": "double", "region": "string"})


@query("SELECT * FROM (VALUES ('complete', true), ('incomplete', false), ('other input', false)) t(state, current)")
def shard_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether a side output can be used: all shards done, from this input."""
    root = fresh_folder(spark, "shard_states")
    stamp, other = artifacts.Stamp.of(table(spark, sf_dir, "part"), "p_partkey"), artifacts.Stamp.of(table(spark, sf_dir, "orders"), "o_orderkey")
    for shard in (1, 0):
        artifacts.finish_shard(spark, f"{root}/a", shard, 2, stamp)
    artifacts.finish_shard(spark, f"{root}/b", 0, 2, stamp)

    def current(name: str, of: artifacts.Stamp) -> bool:
        try:
            return artifacts.check_current(spark, f"{root}/{name}", of)
        except artifacts.Stale:
            return False

    rows = [("complete", current("a", stamp)), ("incomplete", current("b", stamp)), ("other input", current("a", other))]
    return spark.createDataFrame(rows, "state string, current boolean")


@query("SELECT o_orderkey, o_orderstatus FROM orders")
def index_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts loaded into a version that stops and goes on; the alias is switched when the counts agree."""
    root = fresh_folder(spark, "index_load")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    artifacts.export_chunks(orders, f"{root}/export", "o_orderkey", 3, ["o_orderkey"])
    sources = [f"{root}/export/chunk={k}" for k in range(3)]
    serving.load_version(spark, sources, root, "v1", stop_after=1)
    try:
        serving.switch_alias(spark, sources, root, "v1", "orders")
        raise AssertionError("an unfinished version was switched to")
    except serving.CountMismatch:
        serving.load_version(spark, sources, root, "v1")
    serving.switch_alias(spark, sources, root, "v1", "orders")
    return serving.read_alias(spark, root, "orders")


@query("SELECT event_id, CASE WHEN event_id % 3 = 0 THEN NULL ELSE round(value, 4) END AS value FROM events")
def json_safe_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows as JSON texts without NaN or infinities, parsed again."""
    odd = F.when(F.col("event_id") % 3 == 0, F.lit(float("nan"))).otherwise(F.round("value", 4))
    texts = profile.json_rows(table(spark, sf_dir, "events").select("event_id", odd.alias("value")))
    return texts.select(F.from_json("json", "event_id long, value double").alias("r")).select("r.*")


@query("SELECT n_nationkey, n_name FROM nation")
def fresh_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stage that starts from a copy; the copied dataset may then be replaced."""
    root = fresh_folder(spark, "fresh_copy")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    artifacts.publish(nation, f"{root}/base")
    serving.copy_dataset(spark, f"{root}/base", f"{root}/copy")
    artifacts.publish(nation.limit(1), f"{root}/base")
    return spark.read.parquet(f"{root}/copy")
