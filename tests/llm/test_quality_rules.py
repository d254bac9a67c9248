import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomwork.llm import quality_rules as q
from tests.llm.fixtures import documents, empty, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if times[w] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed


TEXTS = [
    None, "", " \n\t", "a", "a b", "a b c", "a b c d", "a a a", "a a a a", "a b c a b c", "x\nx\n\nx y\n x", "#*$ %&|<> é☃", "a b c x a b c y b c x a", prose(1, 49), prose(1, 50),
    "w " * 60, (prose(2, 30) + " ") * 3, " lead and trail \n", "a\x0bb\x0cc\rd", "a b\x85c\x1cd",
]


def test_base_equals_brute_force(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i int, text string")
    for r in q.base_columns(df).collect():
        got = (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"])
        assert got == base(r["text"]), r["text"]


def test_ratio_equals_brute_force(spark):
    rows = [(i, prose(i % 7, 60 + i)) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    trusted = spark.createDataFrame([(i,) for i in (*range(30), 8, 8, 999, None)], "doc_id long")
    part = {r["_id"]: r["_fits"] for r in q.chosen_ids(trusted).collect()}
    assert set(part) == {*range(30), 999} and set(part.values()) == {True, False}
    hashed = {}
    for r in docs.select("doc_id", q.feature_buckets(q.words_of(F.col("text"))).alias("f")).collect():
        assert len(r["f"]) == 2 * len(WORD.findall(dict(rows)[r["doc_id"]])) - 1
        hashed[r["doc_id"]] = r["f"]
    raw = Counter(b for f in hashed.values() for b in f)
    good = Counter(b for i, f in hashed.items() if part.get(i) for b in f)
    share = lambda c, b: (c[b] + 1) / (sum(c.values()) + q.BUCKETS)
    want = {i: sum(math.log(share(good, b) / share(raw, b)) for b in f) / len(f) for i, f in hashed.items()}
    held = [want[i] for i, fits in part.items() if not fits and i in want and not base(dict(rows)[i])[-1]]
    low, middle = np.percentile(held, 1), np.percentile(held, 50)
    threshold = 2 * low - middle - q.MARGIN
    assert q.fit_rules(docs, trusted, "doc_id", "text")[1] == pytest.approx(threshold, abs=1e-5)
    for r in q.quality_verdicts(docs, trusted).collect():
        if not r["base_failed"]:
            assert r["llr"] == pytest.approx(want[r["doc_id"]], abs=1e-5)
            assert r["kept"] == (r["llr"] >= threshold)


@pytest.mark.parametrize("values", [[], [0.5], [None, None], [1.0, 2.0], [3.25] * 9, [((i * 7919) % 997) / 313 - 1.5 for i in range(500)], [-2.0000004, -2.0, 0.0, 1e-7, 14.9]])
def test_quantiles_equal_the_sorted_values(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "ratio double")
    got, held = q.quantiles(df, [0.01, 0.5, 0.9]), [v for v in values if v is not None]
    assert got == (pytest.approx(np.percentile(held, [1, 50, 90]).tolist(), abs=2e-6) if held else None)


def test_large_sets_of_ids_are_joined(spark, monkeypatch):
    """Beyond the bound of a broadcast the same verdicts come from a shuffle."""
    docs = documents(spark)
    trusted = docs.select("doc_id")
    rows = lambda: sorted((r["doc_id"] or 0, round(r["llr"], 9), r["kept"]) for r in q.quality_verdicts(docs, trusted).collect())
    want = rows()
    monkeypatch.setattr(q, "BROADCAST_IDS", 0)
    assert rows() == want


def test_awkward_documents(spark):
    docs = documents(spark)
    trusted = spark.createDataFrame([(1,), (3,), (7,), (8,)], "doc_id long")
    got = q.quality_verdicts(docs, trusted).collect()
    want = Counter((r["doc_id"], base(r["text"])) for r in docs.collect())
    assert Counter((r["doc_id"], (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"])) for r in got) == want
    assert all(not r["kept"] for r in got if r["base_failed"])
    kept = q.kept_documents(docs, trusted)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] or 0) for r in kept.collect()) == sorted((r["doc_id"] or 0) for r in got if r["kept"])
    none = q.quality_verdicts(docs, spark.createDataFrame([], "doc_id long")).collect()
    assert all(r["llr"] == 0 and r["kept"] == (not r["base_failed"]) for r in none)
    assert q.quality_verdicts(empty(spark), trusted).count() == 0


def test_labelled_documents(spark, sf_dir):
    """Clean documents stay; labelled junk that the base rules let through goes."""
    big = sf_dir.replace("sf0.001", "sf0.1")
    labels = spark.read.parquet(f"{big}/labels.parquet")
    got = q.quality_verdicts(spark.read.parquet(f"{big}/documents.parquet"), q.trusted_ids(labels)).join(labels, "doc_id").where("NOT base_failed").collect()
    clean = [r["kept"] for r in got if r["quality"] == 1]
    junk = [r["kept"] for r in got if r["quality"] == 0]
    assert sum(clean) >= 0.99 * len(clean) and sum(junk) <= 0.1 * len(junk)


def test_no_python_in_the_plan(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    plan = q.quality_verdicts(docs, docs.select("doc_id"))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|ArrowEval|MapInArrow", plan)
