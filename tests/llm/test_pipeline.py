import corpus_pipeline
from loomwork.llm import language_id, mixing, packing, quality_rules, simhash
from loomwork.llm.queries import tokenizer_paths
from tests.llm.fixtures import documents, empty


def test_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "quality_rules", "simhash_dedup", "mixing", "packing"]


def test_stages_keep_the_columns(spark, sf_dir):
    for docs in (documents(spark), empty(spark)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, docs, sf_dir).columns == docs.columns
            assert stage(spark, docs, sf_dir).dtypes == docs.dtypes
        assert corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).where("start = 0").count() == docs.count()


def test_each_stage_follows_its_operator(spark, sf_dir):
    """What a stage keeps is what its operator's rows say, computed apart."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    ids = lambda df: sorted(r["doc_id"] for r in df.select("doc_id").collect())
    one = corpus_pipeline.identify_language(spark, docs, sf_dir)
    assert ids(one) == sorted(r["doc_id"] for r in language_id.identify_languages(docs).collect() if not r["rejected"])
    trusted = quality_rules.trusted_ids(spark.read.parquet(f"{sf_dir}/labels.parquet"))
    two = corpus_pipeline.apply_quality_rules(spark, docs, sf_dir)
    assert ids(two) == sorted(r["doc_id"] for r in quality_rules.quality_verdicts(docs, trusted).collect() if r["kept"])
    three = corpus_pipeline.remove_near_duplicates(spark, docs, sf_dir)
    assert ids(three) == sorted({r["component_id"] for r in simhash.simhash_components(docs).collect()})
    four = corpus_pipeline.mix_sources(spark, docs, sf_dir)
    want = []
    for r in mixing.mixed_documents(docs).collect():
        want += [r["doc_id"]] * (int(r["taken"] / r["size"] + 0.5) if r["size"] else 1)
    assert ids(four) == sorted(want)


def test_run(spark, sf_dir):
    pieces = corpus_pipeline.run(spark, sf_dir).collect()
    used = {}
    for r in pieces:
        used[r["sequence_id"]] = used.get(r["sequence_id"], 0) + r["length"]
    assert pieces and max(used.values()) <= packing.WINDOW
    assert tokenizer_paths()[0].endswith(".json")
