import math
from collections import Counter

import pytest

from loomwork.plans import enrich, keywords, topics


def test_terms():
    assert topics.terms_of("über die café-kultur of the art, 42 x") == ["über", "die", "café", "kultur", "art", "über die", "die café", "café kultur", "kultur art"]
    assert topics.terms_of("the of 42") == []


def test_texts_without_a_known_term_get_topic_minus_one(spark):
    rows = spark.createDataFrame([(1,), (2,)], "id long")
    best = spark.createDataFrame([(1, 7, 0.5)], "id long, topic_id long, score double")
    assert sorted(tuple(r) for r in enrich.every_topic(rows, best).collect()) == [(1, 7, 0.5), (2, -1, 0.0)]


def slow_vocabulary(texts, features, min_df=2, max_df=0.8):
    df, total = Counter(), Counter()
    for t in texts:
        own = Counter(topics.terms_of((t or "").lower()))
        df.update(own.keys())
        total.update(own)
    kept = [t for t in df if min_df <= df[t] <= max_df * len(texts)]
    kept.sort(key=lambda t: (-total[t], t))
    return {t: math.log((1.0 + len(texts)) / (1 + df[t])) + 1 for t in kept[:features]}


@pytest.mark.parametrize("features,most", [(50, 200_000), (400, 200_000), (100_000, 200_000), (400, 10)])
def test_vocabulary_equals_counting_everything(spark, sf_dir, monkeypatch, features, most):
    """Also where pairs are pruned by their words, and where the set of words is too large for that."""
    monkeypatch.setattr(topics, "PAIR_WORDS", most)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = [r[0] for r in docs.select("text").collect()]
    assert topics.vocabulary(docs, "text", len(texts), features=features) == pytest.approx(slow_vocabulary(texts, features))


def test_joins_agree_with_the_matrix(spark, sf_dir, monkeypatch):
    docs, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    got = [sorted((r["id"], r["topic_id"], round(r["score"], 6)) for r in topics.classify(docs, "doc_id", "text", items, "item_id", "text", features=2000).collect())]
    monkeypatch.setattr(topics, "MATRIX", 10)
    got.append(sorted((r["id"], r["topic_id"], round(r["score"], 6)) for r in topics.classify(docs, "doc_id", "text", items, "item_id", "text", features=2000).collect()))
    assert got[0] == got[1] and len(got[0]) == docs.count()


def test_awkward_topics(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "museum art museum"), (3, "museum art museum"), (None, "river bank"), (4, "art river")], "id long, text string")
    items = spark.createDataFrame([(7, "museum art"), (5, "river bank"), (9, None), (None, "art"), (8, "museum art")], "k long, t string")
    got = sorted((r["id"] or 0, r["topic_id"]) for r in topics.classify(docs, "id", "text", items, "k", "t").collect())
    assert got == [(0, 5), (1, -1), (2, -1), (3, 7), (3, 7), (4, 5)]
    assert topics.classify(docs.limit(0), "id", "text", items, "k", "t").count() == 0
    assert topics.classify(docs, "id", "text", items.limit(0), "k", "t").where("topic_id = -1").count() == 6


ALPHABET = "abcdefghijklmnopqrstuvwxyz"


def all_errors(word):
    out = {word[:i] + word[i + 1 :] for i in range(1, len(word))}
    out |= {word[:i] + word[i + 1] + word[i] + word[i + 2 :] for i in range(1, len(word) - 1)}
    out |= {word[:i] + c + word[i + 1 :] for i in range(1, len(word)) for c in ALPHABET if word[i] != " "}
    out |= {word[:i] + c + word[i:] for i in range(1, len(word) + 1) for c in ALPHABET}
    return out - {word}


@pytest.mark.parametrize("word", ["silesians", "roma people", "aabbccdd"])
def test_one_error_is_every_kind(word):
    errors = all_errors(word)
    assert all(keywords.one_error(word, e) for e in errors)
    for other in ["xilesians", word, word + "xy", word[::-1], word[:-2], word.upper()]:
        assert keywords.one_error(word, other) == (other in errors)


def test_rules_of_matching():
    rules = keywords.Rules(blocked=frozenset(["forbidden"]), always=frozenset(["inu"]), capitalised=frozenset(["turkish"]), known_words=frozenset(["minority", "garden"]))
    rows = [("q1", "sami"), ("q2", "inu"), ("q3", "turkish"), ("q4", "silesians"), ("q5", "minorita"), ("q6", "forbidden"), ("q7", "roma people"), ("q8", "franconian"), ("q9", "franconians")]
    m = keywords.Matcher(rows, rules)
    find = lambda t: "".join(k[1] for k in sorted(m.keys(t)))
    assert find("the sami") == "" and find("the Sami people") == "1" and find("SAMI") == ""
    assert find("an inu and INU") == "2" and find("turkish") == "" and find("Turkish") == "3"
    assert find("Silesians") == "4" and find("silesianss silesiasn silesans silesiano") == "4" and find("xilesians") == "" and find("silesianism") == ""
    assert find("a minority and minorities") == "" and find("minoritas") == "5" and find("minorita") == "5"
    assert find("forbidden forbiden") == "" and find("roma  people") == "" and find("Roma people, romapeople") == "7"
    assert find("franconian") == "8" and find("franconians") == "9" and find("franconianx") == ""
    assert find("") == "" and keywords.Matcher([], rules).keys("word") == set()
    assert keywords.is_known("gardens", rules.known_words) and not keywords.is_known("gardenes", rules.known_words)


def test_keyword_frames(spark):
    rows = spark.createDataFrame([(1, "Café de la Sámi"), (2, None), (None, "silesiann"), (1, "x Łódźka"), (3, "none")], "i long, t string")
    kw = spark.createDataFrame([("a", "Sami"), ("b", " SILESIAN "), ("c", "lodzka"), (None, "none"), ("d", None), ("d", "")], "key string, keyword string")
    got = sorted((r["id"] or 0, r["keys"]) for r in keywords.keyword_hits(rows, "i", "t", kw).collect())
    assert got == [(0, ["b"]), (1, ["a"]), (1, ["c"])]
    assert keywords.keyword_hits(rows, "i", "t", kw.limit(0)).count() == 0
