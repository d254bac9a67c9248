import numpy as np
import pytest

from loomwork.llm import site_quality as sq
from tests.llm.fixtures import documents, empty, prose


def test_features():
    f = sq.features("Red red, blue. RED!")
    assert len(f) == len(set(f.tolist())) and (np.diff(f) > 0).all() and f.max() < sq._FEATURES
    assert set(sq.features("idiot,").tolist()) & set(sq.features("IDIOT").tolist())
    for t in (None, "", "  "):
        assert len(sq.features(t)) == 0


def test_logistic_learns_and_ignores_copies():
    rng = np.random.default_rng(0)
    rows, label = [], []
    for i in range(400):
        good = i % 4 != 0
        noise = rng.integers(100, 400, 20)
        rows.append(np.unique(np.r_[noise, [1] if good else [2]]))
        label.append(float(good))
    bad_copy = np.unique(np.r_[rng.integers(100, 400, 20), [3]])
    rows += [bad_copy] * 200
    label += [0.0] * 200
    weights, shift = sq.fit_logistic(rows, np.array(label))
    assert weights[1] > 1 and weights[2] < -1
    assert weights[3] == 0  # one distinct document is below MIN_DOCS
    assert sq.copy_weights(rows)[-200:].sum() == pytest.approx(1)


def corpus(spark):
    """Sites a good, b bad, c sparse; junk words tell bad documents."""
    docs, labels = [], []
    for i in range(240):
        site = "a" if i < 120 else "b" if i < 236 else "c"
        bad = (i % 20 == 0) if site == "a" else (i % 20 != 0) if site == "b" else i % 2 == 0
        docs.append((i, prose(i, 60) + (" scum trash moron" if bad else ""), "en", site))
        if i % 2 == 0 and site != "c":
            labels.append((i, 0 if bad else 1, 0))
    return spark.createDataFrame(docs, "doc_id long, text string, lang string, source string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_scores_equal_brute_force(spark):
    docs, labels = corpus(spark)
    got = {r["doc_id"]: r for r in sq.classify_sites(docs, labels).collect()}
    known = {r["doc_id"]: float(r["quality"] == 1) for r in labels.collect()}
    source = {r["doc_id"]: r["source"] for r in docs.collect()}
    e = {i: known.get(i, r["doc_score"]) for i, r in got.items()}
    rate = np.mean(list(e.values()))
    sites = {s: [e[i] for i in e if source[i] == s] for s in set(source.values())}

    def pseudo(prior):
        n = sum(map(len, sites.values()))
        within = max(sum(sum(x * x for x in v) - sum(v) ** 2 / len(v) for v in sites.values()), 1e-9) / (n - len(sites))
        spread = n - sum(len(v) ** 2 for v in sites.values()) / n
        between = (sum(len(v) * (np.mean(v) - prior[s]) ** 2 for s, v in sites.items()) - (len(sites) - 1) * within) / max(spread, 1)
        return min(sq.PSEUDO[1], max(sq.PSEUDO[0], within / between)) if between > 0 else sq.PSEUDO[1]

    kh = pseudo(dict.fromkeys(sites, rate))
    host = {s: (sum(v) + kh * rate) / (len(v) + kh) for s, v in sites.items()}
    kp = pseudo(host)  # one path a host here
    logit = lambda p: np.log(min(max(p, 1e-4), 1 - 1e-4) / (1 - min(max(p, 1e-4), 1 - 1e-4)))
    for i, r in got.items():
        v, h = sites[source[i]], host[source[i]]
        rest = (sum(v) - e[i] + kp * h) / (len(v) - 1 + kp)
        want = 1 / (1 + np.exp(-(logit(r["doc_score"]) + logit(rest) - logit(rate))))
        assert r["host_rate"] == pytest.approx(h) and r["path_rate"] == pytest.approx((sum(v) + kp * h) / (len(v) + kp))
        assert r["score"] == pytest.approx(want, abs=1e-6) and r["kept"] == (r["score"] >= 0.5)
    assert host["a"] > rate > host["b"]


def test_awkward_documents(spark):
    docs = documents(spark)
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (3, 0, None), (8, None, 1), (None, 1, 0), (10, 1, 1)], "doc_id long, quality int, toxic int")
    got = sq.classify_sites(docs, labels).collect()
    assert len(got) == docs.count() and all(0 <= r["score"] <= 1 and r["kept"] is not None for r in got)
    none = sq.classify_sites(docs, spark.createDataFrame([], labels.schema)).collect()
    assert {r["doc_score"] for r in none} == {0.5}
    assert sq.classify_sites(empty(spark), labels).count() == 0


def test_held_out_labels(spark, sf_dir):
    """Fitted on half of the labels, judged on the rest."""
    big = sf_dir.replace("sf0.001", "sf0.1")
    docs, labels = spark.read.parquet(f"{big}/documents.parquet"), spark.read.parquet(f"{big}/labels.parquet")
    got = sq.classify_sites(docs, labels.where("doc_id % 2 = 0")).join(labels.where("doc_id % 2 = 1"), "doc_id").collect()
    clean = [r["kept"] for r in got if r["quality"] == 1 and r["toxic"] == 0]
    junk = [r["kept"] for r in got if r["quality"] == 0]
    toxic = [r["kept"] for r in got if r["toxic"] == 1]
    assert np.mean(clean) >= 0.97 and np.mean(junk) <= 0.2 and np.mean(toxic) <= 0.6
