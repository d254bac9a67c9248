import os
import datetime

import pytest
from pyspark.sql import functions as F

from loomwork.core import artifacts, keys
from loomwork.operators import graph, matching, profile
from loomwork.plans import documents, enrich
from loomwork.plans.runner import Runner, Stage
from loomwork.search import text_query as tq
from loomwork.sources import readers
from loomwork.streaming import incremental

D = datetime.date


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def work_frames(spark, works, tiers):
    w = spark.createDataFrame(works, "id long, d date, t boolean")
    t = [spark.createDataFrame([(i,) for i in ids], "id long") for ids in tiers]
    return w, graph.link_tiers(t)


def today():
    return F.lit("2025-01-01").cast("date")


def trims(spark, works, tiers, cap):
    w, t = work_frames(spark, works, tiers)
    a = graph.trim(w, t, cap, "d", F.col("t"), today())
    b = graph.trim_ranked(graph.narrow(w, t, "d", F.col("t"), today()), cap)
    assert rows(a, "id") == rows(b, "id")
    return [r[0] for r in rows(a, "id")]


def test_trim_drops_unlinked_and_prefers_tier_then_date(spark):
    works = [(1, D(1990, 1, 1), False), (2, D(2024, 1, 1), False), (3, D(2023, 1, 1), False), (4, D(2020, 1, 1), False), (5, None, False), (6, D(2024, 5, 5), False)]
    assert trims(spark, works, [[1], [1, 2, 3, 4, 5]], 3) == [1, 2, 3]
    assert trims(spark, works, [[1], [1, 2, 3, 4, 5]], 10) == [1, 2, 3, 4, 5]


def test_trim_undated_and_future_last(spark):
    works = [(1, None, False), (2, D(2001, 1, 1), False), (3, D(2999, 1, 1), False)]
    assert trims(spark, works, [[1, 2, 3]], 1) == [2]
    assert trims(spark, works, [[1, 2, 3]], 2) == [1, 2]


@pytest.mark.parametrize("flip", [1, -1])
def test_trim_ties_do_not_depend_on_row_order(spark, flip):
    works = [(i, D(2020, 1, 1), i % 2 == 0) for i in range(1, 7)][::flip]
    assert trims(spark, works, [[1, 2, 3, 4, 5, 6]], 4) == [1, 2, 4, 6]


def test_cutoff(spark):
    works = [(1, D(2024, 1, 1), False), (2, D(2023, 1, 1), False), (3, D(2023, 1, 1), False)]
    w, t = work_frames(spark, works, [[1, 2, 3]])
    ranked = graph.narrow(w, t, "d", F.col("t"), today())
    row = graph.cutoff(ranked, ranked.orderBy(*graph.trim_order()).limit(2)).first()
    assert (row["cutoff_tier"], row["cutoff_date"], row["on_cutoff_date"], row["kept_on_cutoff_date"]) == (0, D(2023, 1, 1), 2, 1)


def test_cascade_and_dangling(spark):
    rel = spark.createDataFrame([(1, "project", 10, "org"), (1, "project", 11, "org"), (2, "project", 10, "org"), (1, "odd", 10, "org")], "source long, source_type string, target long, target_type string")
    nodes = {"project": spark.createDataFrame([(1,)], "id long"), "org": spark.createDataFrame([(10,)], "id long")}
    kept = graph.keep_edges(rel, nodes)
    assert rows(kept, "source") == [(1, "project", 10, "org")]
    lost = {(r["end"], r["type"]): r["n"] for r in graph.dangling(rel, nodes).collect()}
    assert lost == {("source", "project"): 1, ("source", "org"): 0, ("target", "project"): 0, ("target", "org"): 1}
    report = {r["source_type"]: (r["n_all"], r["n_kept"], r["n_dropped"]) for r in graph.cascade_report(rel, kept).collect()}
    assert report == {"project": (3, 1, 2), "odd": (1, 0, 1)}


def test_pairs_and_partners(spark):
    m = spark.createDataFrame([(1, 1), (1, 2), (1, 2), (2, 1), (2, 2), (2, 3)], "g long, m long")
    assert rows(graph.pairs(m, "g", "m"), "a", "b") == [(1, 2, 2), (1, 3, 1), (2, 3, 1)]
    assert graph.pairs(m, "g", "m", directed=True).count() == 6
    assert rows(graph.partners(m, "g", "m", 1), "partner") == [(2, 2), (3, 1)]


def test_matching_fallback_and_routes(spark):
    left = spark.createDataFrame([(1, "p1", "n1"), (2, None, "n2"), (3, None, None)], "id long, pic string, name string")
    right = spark.createDataFrame([(10, "p1", "x"), (11, "q", "n1"), (12, "q", "n2"), (13, None, None)], "rid long, pic string, name string")
    pic = matching.match_by(left, right, "id", "rid", (F.col("pic"), F.col("pic")), "pic")
    name = matching.match_by(left, right, "id", "rid", (F.col("name"), F.col("name")), "name")
    assert rows(matching.match_fallback([pic, name]), "left_id") == [(1, 10, "pic"), (2, 12, "name")]
    assert rows(matching.match_routes([pic, name]), "left_id", "right_id") == [(1, 10, 1, 1), (1, 11, 2, 1), (2, 12, 2, 1)]


def test_first_by_overlay_upsert(spark):
    a = spark.createDataFrame([(1, "x", 2), (1, "y", 1), (2, "z", 5)], "k long, v string, o int")
    assert rows(keys.first_by(a, ["k"], [F.col("o")]).select("k", "v"), "k") == [(1, "y"), (2, "z")]
    assert rows(keys.top_by(a, ["k"], [F.col("o").desc()], 1).select("k", "v"), "k") == [(1, "x"), (2, "z")]
    base = spark.createDataFrame([(1, None), (2, "b"), (3, None)], "k long, v string")
    new = spark.createDataFrame([(1, "n"), (2, "n")], "k long, v string")
    assert rows(keys.overlay(base, new, ["k"], ["v"]), "k") == [(1, "n"), (2, "n"), (3, None)]
    assert rows(keys.overlay(base, new, ["k"], ["v"], only_null=True), "k") == [(1, "n"), (2, "b"), (3, None)]
    assert rows(keys.upsert(base, new, ["k"]), "k") == [(1, "n"), (2, "n"), (3, None)]
    assert keys.insert_missing(base, new, ["k"]).count() == 3
    assert keys.add_missing_columns(base, {"z": "double", "k": "int"}).dtypes == [("k", "bigint"), ("v", "string"), ("z", "double")]
    with pytest.raises(ValueError):
        keys.require_columns(base, ["nope"])
    with pytest.raises(ValueError):
        keys.assert_unique(a, ["k"])
    with pytest.raises(ValueError):
        keys.assert_schema(base, {"k": "int"})


def test_lists(spark):
    df = spark.createDataFrame([("b; a;;b", 2, "y"), ("c ;a", 1, "x"), (None, 3, None)], "s string, o int, v string")
    row = df.agg(keys.merged_list(F.col("s")), keys.ordered_list("v", "o"), keys.distinct_list("v")).first()
    assert list(row) == [["a", "b", "c"], ["x", "y"], ["x", "y"]]


def test_profile_counts_empty_as_absent(spark):
    df = spark.createDataFrame([("a", [1]), ("", []), (None, None)], "s string, l array<int>")
    assert rows(profile.profile(df), "column") == [("l", 3, 1, 33.33), ("s", 3, 1, 33.33)]
    assert "| s | string | 1 |" in profile.profile_markdown(df, "t")


def test_samples_repeat(spark):
    df = spark.range(1000).repartition(7)
    a = [r[0] for r in profile.hash_sample(df, "id", 50, 3).collect()]
    assert a == [r[0] for r in profile.hash_sample(df.repartition(2), "id", 50, 3).collect()] and len(a) == 50
    members = spark.range(100).select(F.col("id").alias("root"), (F.col("id") % 40).alias("m"))
    picked, n = profile.shrinking_sample(spark.range(100).withColumnRenamed("id", "root"), "root", members, "root", "m", 100, 20)
    assert n < 100 and picked.join(members, "root").select("m").distinct().count() <= 20


def test_artifacts(spark, tmp_path):
    out = f"file://{tmp_path}/side"
    df = spark.range(10).withColumnRenamed("id", "k")
    stamp = artifacts.Stamp.of(df, "k")
    assert stamp == artifacts.Stamp.of(df.where("k < 4"), "k") + artifacts.Stamp.of(df.where("k >= 4"), "k")
    with pytest.raises(artifacts.Stale):
        artifacts.check_current(spark, out, stamp)
    artifacts.finish_shard(spark, out, 0, 2, stamp)
    with pytest.raises(artifacts.Stale):
        artifacts.check_current(spark, out, stamp)
    assert artifacts.check_current(spark, out, stamp, allow_incomplete=True)
    artifacts.finish_shard(spark, out, 1, 2, stamp)
    assert artifacts.check_current(spark, out, stamp)
    with pytest.raises(artifacts.Stale):
        artifacts.check_current(spark, out, artifacts.Stamp(1, 1, 1))
    assert artifacts.export_chunks(df, f"{out}-x", "k", 3, ["k"]) == [0, 1, 2]
    assert artifacts.export_chunks(df, f"{out}-x", "k", 3, ["k"]) == []
    assert spark.read.parquet(f"{out}-x").count() == 10
    assert artifacts.write_json_array(df, f"{out}.json") == 10
    with pytest.raises(ValueError):
        artifacts.write_json_array(df, f"{out}.json", limit=3)


def _numbers(spark, path):
    return sorted(r[0] for r in spark.read.parquet(path).collect())


def test_publish_survives_a_failing_rename(spark, tmp_path, monkeypatch):
    """Whichever rename fails or stops the process, a complete dataset stays and the next call goes on."""
    real = artifacts._rename
    for step in (0, 1):
        for crash in (False, True):
            out = f"file://{tmp_path}/ds-{step}-{crash}"
            artifacts.publish(spark.range(3), out)
            calls = []

            def broken(session, source, target):
                calls.append(target)
                if len(calls) - 1 == step:
                    if crash:
                        raise KeyboardInterrupt
                    return False
                if crash and len(calls) - 1 > step:
                    raise KeyboardInterrupt
                return real(session, source, target)

            monkeypatch.setattr(artifacts, "_rename", broken)
            with pytest.raises((OSError, KeyboardInterrupt)):
                artifacts.publish(spark.range(5), out)
            monkeypatch.setattr(artifacts, "_rename", real)
            kept = [f for f in os.listdir(tmp_path) if f.startswith(f"ds-{step}-{crash}.") and f.endswith(".tmp")]
            assert len(kept) == 1 and _numbers(spark, f"file://{tmp_path}/{kept[0]}") == list(range(5))
            assert artifacts.exists(spark, out) and _numbers(spark, out) == [0, 1, 2]
            artifacts.publish(spark.range(7), out)
            assert _numbers(spark, out) == list(range(7)) and not artifacts._is_there(spark, f"{out}.old")


def test_stop_before_the_old_dataset_is_removed(spark, tmp_path):
    out = f"file://{tmp_path}/late"
    artifacts.publish(spark.range(2), f"{out}.old")
    artifacts.publish(spark.range(4), f"{out}.new")
    artifacts._rename(spark, f"{out}.new", out)
    assert artifacts.exists(spark, out) and _numbers(spark, out) == [0, 1, 2, 3] and not artifacts._is_there(spark, f"{out}.old")


def test_text_file_is_replaced_whole(spark, tmp_path, monkeypatch):
    out = f"file://{tmp_path}/note.txt"
    artifacts.write_text(spark, out, "one")
    real = artifacts._rename
    monkeypatch.setattr(artifacts, "_rename", lambda s, a, b: False if b == out and a.endswith(".tmp") else real(s, a, b))
    with pytest.raises(OSError):
        artifacts.write_text(spark, out, "two")
    monkeypatch.setattr(artifacts, "_rename", real)
    assert artifacts.read_text(spark, out) == "one"
    artifacts.write_text(spark, out, "two")
    assert artifacts.read_text(spark, out) == "two"


def test_failed_publish_keeps_the_old_dataset(spark, tmp_path):
    out = f"file://{tmp_path}/d"
    artifacts.publish(spark.range(3), out)
    with pytest.raises(Exception):
        artifacts.publish(spark.range(3).select(F.raise_error(F.lit("no")).alias("x")), out)
    assert spark.read.parquet(out).count() == 3


def test_readers(spark, tmp_path):
    import gzip

    for i, name in enumerate(("a", "b")):
        with gzip.open(tmp_path / f"{name}.json.gz", "wt") as f:
            f.write(f'{{"id": {i}, "n": "{name}"}}\n')
    (tmp_path / "t.csv").write_text('id,txt\n1,"a ""q"", b"\n')
    (tmp_path / "doc.xml").write_text('<r><item k="1">x</item><item k="2">y</item></r>')
    (tmp_path / "arr.json").write_text('[{"a": 1}, {"a": 2}]')
    base = f"file://{tmp_path}"
    assert readers.read_ndjson(spark, f"{base}/*.json.gz", "id long, n string").count() == 2
    assert readers.read_ndjson(spark, [f"{base}/*.json.gz"], "id long, n string", first_files=1).first()["n"] == "a"
    assert readers.read_csv(spark, f"{base}/t.csv").first()["txt"] == 'a "q", b'
    assert [r["_k"] for r in readers.read_xml(spark, f"{base}/doc.xml", "item", "_k string, _VALUE string").collect()] == ["1", "2"]
    assert readers.read_json_document(spark, f"{base}/arr.json", "a long").count() == 2
    assert readers.read_documents(spark, base).count() == 2
    assert readers.read_parquet_union(spark, f"{base}/none", "a long").count() == 0
    spark.range(2).write.parquet(f"{base}/u/x.parquet")
    assert readers.register_tables(spark, f"{base}/u", "t_") == ["t_x"]
    assert readers.table_columns(spark, "t_x").first()["column"] == "id"
    df = spark.createDataFrame([('{"a": {"k": 1}, "l": [{"k": "v"}]}',), ("bad",)], "j string")
    assert [r[0] for r in df.select(readers.find_key("j", "k")).collect()] == [["1", '"v"'], None]


def test_enrich(spark):
    docs = spark.createDataFrame([(1, "Der Hund", None), (2, None, "two"), (3, None, None)], "id long, title string, body string")
    en = spark.createDataFrame([(1, "title", "The dog")], "id long, field string, text_en string")
    assert rows(enrich.full_text(docs, ["title", "body"], en), "id") == [(1, "The dog"), (2, "two")]
    m = spark.createDataFrame([(1, "Museum heritage"), (2, "xmuseum"), (3, None)], "id long, t string")
    masks = m.select("id", enrich.pillar_mask(F.col("t"), {"a": ["museum"], "b": ["herit"]}).alias("m"))
    assert rows(masks, "id") == [(1, 3), (2, 0), (3, 0)]
    assert masks.where("id = 1").select(enrich.mask_names(F.col("m"), ["a", "b"])).first()[0] == ["a", "b"]
    hits = enrich.pillar_hits(m, "id", "t", {"a": ["museum"], "b": ["herit"]})
    assert rows(hits, "id") == [(1, 3)]
    assert rows(enrich.pillar_rate(hits, 4, 0.2), "bit") == [(0, 1, 0.25, True), (1, 1, 0.25, True)]
    tags = spark.createDataFrame([(1, ["a", "b"]), (2, ["a"])], "id long, keys array<string>")
    denied = spark.createDataFrame([(1, "b"), (2, "a")], "id long, key string")
    assert rows(enrich.deny(tags, denied), "id") == [(1, ["a"])]
    with pytest.raises(ValueError):
        enrich.deny(tags, spark.createDataFrame([(9, "a")], "id long, key string"))
    side = spark.createDataFrame([(1, True), (1, True)], "id long, flag boolean")
    assert rows(enrich.assemble(docs.select("id"), "id", {"s": (side, {"flag": False})}), "id") == [(1, True), (2, False), (3, False)]


def test_score_batches(spark):
    df = spark.createDataFrame([(1, "ab"), (2, "abc")], "doc long, t string")
    assert rows(enrich.score_batches(df, "doc", "t", lambda: lambda texts: [float(len(t)) for t in texts]), "id") == [(1, 2.0), (2, 3.0)]


def test_streams_and_grants(spark):
    f = spark.createDataFrame([(1, "EC", "EC::H2020::RIA"), (1, "NSF", None)], "pid long, funder string, sid string")
    s = documents.streams(f)
    assert rows(s.select("stream_id", "programme", "action"), "stream_id") == [("EC::H2020::RIA", "H2020", "RIA"), ("NONE::NSF", None, None)]
    g = documents.grants(s, spark.createDataFrame([(1, 10.0)], "pid long, amount double"))
    assert rows(g.select("id", "total_eur"), "id") == [("EC::H2020::RIA", 5.0), ("NONE::NSF", 5.0)]


def W(*words):
    return tq.Term(words)


def AND(*parts):
    return tq.Node("and", parts)


def NOT(part):
    return tq.Node("not", (part,))


TREES = [
    ("a AND b", AND(W("a"), W("b"))),
    ("a + b c", AND(W("a"), W("b"), W("c"))),
    ("a OR b", tq.Node("or", (W("a"), W("b")))),
    ("a | b c", tq.Node("or", (W("a"), AND(W("b"), W("c"))))),
    ("a NOT b", AND(W("a"), NOT(W("b")))),
    ("a -b", AND(W("a"), NOT(W("b")))),
    ("NOT (a OR b) c", AND(NOT(tq.Node("or", (W("a"), W("b")))), W("c"))),
    ('"x AND y" z', AND(W("x", "and", "y"), W("z"))),
    ('say "open', AND(W("say"), W("open"))),
    ("word~2 x~ \"p q\"~3", AND(W("word"), W("x"), W("p", "q"))),
    ("AND a OR", W("a")),
    ("a - b", AND(W("a"), W("b"))),
    ("ORCID NOTE", AND(W("orcid"), W("note"))),
    ("state-of-the-art", W("state", "of", "the", "art")),
    ("((a)", W("a")),
    ("a) b", AND(W("a"), W("b"))),
    ("Łódź 東京 e\u0301cole", AND(W("lodz"), W("東", "京"), W("ecole"))),
    ("", None),
    ("  ", None),
    ("!? …", tq.Node("none", ())),
    ("))((", tq.Node("none", ())),
]


@pytest.mark.parametrize("q,want", TREES)
def test_parse(q, want):
    assert tq.parse(q) == want


TEXTS = ["Zürich Universität", "東京大学の研究", "ŁÓDŹ straße Œuvre", "e\u0301cole", "studies buses classes virus glass boxes", "x_y don't 3D", "हिन्दी भाषा", "", None]


def test_text_and_queries_share_the_analyser(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "id long, t string")
    for stem in (False, True):
        got = [tuple(r[0]) for r in df.orderBy("id").select(tq.analysed(F.col("t"), stem)).collect()]
        assert got == [tq.analyse(t or "", stem) for t in TEXTS]
    assert tq.analyse(TEXTS[4], True) == ("study", "buse", "classe", "virus", "glass", "boxe")


def test_search_beyond_ascii(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "id long, t string")
    find = lambda q: [r[0] for r in rows(tq.matches(df, "id", {"t": 1.0}, q), "id")]
    assert find("zurich") == [0] and find("rich") == [] and find("Zürich universitat") == [0]
    assert find("東京") == [1] and find("京東") == [] and find("漢") == []
    assert find("lodz strasse oeuvre") == [2] and find("école") == [3]
    assert find("…") == [] and find("((") == []
    names = df.selectExpr("id", "t AS name", "id AS rank")
    assert [r["id"] for r in tq.autocomplete(names, "id", "name", "zur", F.col("rank")).collect()] == [0]
    assert tq.autocomplete(names, "id", "name", "…", F.col("rank")).count() == 0
    both = tq.autocomplete_all({"org": names, "project": names}, "東").collect()
    assert [(r["kind"], r["id"]) for r in both] == [("org", "1"), ("project", "1")]


def test_index_agrees_with_the_scan(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", F.col("source").alias("title"))
    path, fields = f"file://{tmp_path}/index", {"text": 1.0, "title": 2.0}
    tq.write_index(docs, "doc_id", ["text", "title"], path, parts=8, stem=True)
    for q in ("the of", '"of the" -and', "src1 OR license", "(über OR une) NOT the", "nowhere"):
        assert_same = [rows(f(), "id") for f in (lambda: tq.index_matches(spark, path, fields, q, 8, True), lambda: tq.matches(docs, "doc_id", fields, q, True))]
        assert [(r[0], round(r[1], 9)) for r in assert_same[0]] == [(r[0], round(r[1], 9)) for r in assert_same[1]]
    plan = tq.index_matches(spark, path, fields, "license", 8)._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(part" in plan or "PartitionFilters: [part" in plan
    for q in ("", "-the", "a OR -b"):
        with pytest.raises(ValueError):
            tq.index_matches(spark, path, fields, q, 8)


def test_orders_and_pages(spark):
    df = spark.createDataFrame([(1, 0.5, None), (2, 0.5, 2020), (3, 0.9, 2020), (4, None, 2021)], "id long, score double, date int")
    order = lambda mode: [r["id"] for r in df.orderBy(*tq.ordered_by(mode)).collect()]
    assert order("relevance") == [3, 1, 2, 4] and order("newest") == [4, 3, 2, 1] and order("oldest") == [3, 2, 4, 1]
    with pytest.raises(ValueError):
        tq.ordered_by("best")
    after = lambda last: [r["id"] for r in tq.page_after(df, "id", last, 2).collect()]
    assert after(None) == [1, 2] and after(2) == [3, 4] and after(4) == []
    assert df.select(tq.blended(F.col("score"), F.lit(0))).first()[0] == 0.5


def test_boolean_search(spark):
    df = spark.createDataFrame([(1, "red blue"), (2, "blue green"), (3, "green red blue"), (4, None)], "id long, t string")
    find = lambda q: [r[0] for r in rows(tq.matches(df, "id", {"t": 1.0}, q), "id")]
    assert find("") == [1, 2, 3, 4]
    assert find("red blue") == [1, 3]
    assert find('"red blue"') == [1, 3]
    assert find('"blue red"') == []
    assert find("red OR green") == [1, 2, 3]
    assert find("blue -red") == [2]
    assert find("(red | green) NOT blue") == []
    assert find("green AND (red OR nope)") == [3]
    assert find("))((") == []


def test_fuzzy_and_suggestions(spark):
    voc = spark.createDataFrame([("museum", 5), ("museums", 3), ("music", 9), ("mu", 1)], "token string, n long")
    assert [r["token"] for r in tq.expansions(voc, "musuem").collect()] == ["museum", "museums"]
    assert tq.did_you_mean(voc, "museum").count() == 0
    assert tq.did_you_mean(voc, "museun").first()["token"] == "museum"
    df = spark.createDataFrame([(1, "the museum"), (2, "music")], "id long, t string")
    mode, hits = tq.fuzzy_matches(df, "id", {"t": 1.0}, "musuem", voc)
    assert mode == "fuzzy" and [r["id"] for r in hits.collect()] == [1]


def test_paging(spark):
    df = spark.range(30)
    assert [r[0] for r in tq.page(df, [F.col("id")], 2, 10).collect()] == list(range(10, 20))
    assert tq.page(df, [F.col("id")], 1001, 10) is None
    assert tq.total(df, 20) == (20, True) and tq.total(df, 30) == (30, False)


def test_autocomplete(spark):
    df = spark.createDataFrame([(1, "Open University", 3), (2, "University of Oslo", 9), (3, "Opera House", 99)], "id long, name string, n int")
    assert [r["id"] for r in tq.autocomplete(df, "id", "name", "univ", F.log1p("n")).collect()] == [2, 1]
    assert [r["id"] for r in tq.autocomplete(df, "id", "name", "open u", F.log1p("n")).collect()] == [1]


def test_windows_and_checkpoints(spark):
    assert incremental.windows(D(2024, 1, 31), 1, D(2024, 4, 1)) == [(D(2024, 1, 31), D(2024, 2, 29)), (D(2024, 2, 29), D(2024, 3, 29))]
    ts = datetime.datetime
    files = spark.createDataFrame([("a", ts(2024, 1, 1, 0, 0, 0)), ("b", ts(2024, 1, 1, 0, 0, 8))], "path string, modified timestamp")
    assert [r["path"] for r in incremental.newer_files(files, ts(2024, 1, 1, 0, 0, 10)).collect()] == ["b"]
    assert incremental.newer_files(files, None).count() == 2
    assert incremental.next_checkpoint(files, None) == ts(2024, 1, 1, 0, 0, 8)


def test_stream_upsert_is_idempotent(spark, tmp_path):
    base = f"file://{tmp_path}"
    spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "c")], "k long, o long, v string").write.parquet(f"{base}/in")
    for run in range(2):
        stream = incremental.stream_files(spark, f"{base}/in", "k long, o long, v string", "parquet")
        incremental.upsert_stream(stream, f"{base}/out", ["k"], f"{base}/cp{run}", "o")
        assert rows(incremental.read_target(spark, f"{base}/out"), "k") == [(1, 2, "b"), (2, 1, "c")]


def test_runner(spark, tmp_path):
    calls = []

    def build(name):
        def f(session, *inputs):
            calls.append(name)
            return session.range(1 + sum(i.count() for i in inputs))

        return f

    stages = [Stage("c", build("c"), ["b"]), Stage("a", build("a")), Stage("b", build("b"), ["a"])]
    runner = Runner(spark, f"file://{tmp_path}/r", stages)
    assert runner.run() == ["a", "b", "c"] and runner.run() == []
    assert runner.run(force={"b"}) == ["b", "c"]
    assert [s.name for s in runner.order(skip={"b"})] == ["a"]
    with pytest.raises(ValueError):
        Runner(spark, "x", [Stage("a", build("a"), ["b"]), Stage("b", build("b"), ["a"])]).order()


def test_typed_words_found_answers_each_typed_text(spark):
    """Against the plain rule; a first word of one letter also begins longer words."""
    vocabulary = ["a", "ab", "abc", "b", "bolt", "blue", "東", "ring"]
    names = [(i, " ".join(vocabulary[(i * m) % 8] for m in (1, 3, 5)[: 1 + i % 3]), None if i % 11 == 0 else i * 7 % 5) for i in range(200)]
    df = spark.createDataFrame(names, "id long, name string, rank long")
    got = {r["words"]: (r["asked"], r["found"]) for r in tq.typed_words_found(df, "id", "name", F.col("rank"), F.col("id") % 3 == 0, [1, 2, 3]).collect()}
    order = sorted(names, key=lambda n: (n[2] is None, -(n[2] or 0), n[0]))
    want = {}
    for k in (1, 2, 3):
        asked = [(i, name.split()[:k]) for i, name, _ in names if i % 3 == 0 and len(name.split()) >= k]
        hits = lambda q: [i for i, name, _ in order if set(q[:-1]) <= set(name.split()) and any(x.startswith(q[-1]) for x in name.split())][:8]
        want[k] = (len(asked), sum(i in hits(q) for i, q in asked))
    assert got == want
