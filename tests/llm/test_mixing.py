import re

import pytest

from loomwork.llm import mixing
from tests.llm.fixtures import documents, empty


def water_fill(sizes, cycle=(1, 2, 3), cap=3.0):
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: cycle[i % len(cycle)] for i, s in enumerate(names)}
    total, target, open_ = sum(sizes.values()), {}, set(names)
    while open_:
        rest = total - sum(target.values())
        w = sum(weight[s] for s in open_)
        over = [s for s in open_ if rest * weight[s] / w > cap * sizes[s]]
        if not over:
            target |= {s: rest * weight[s] / w for s in open_}
            break
        for s in over:
            target[s] = cap * sizes[s]
            open_.remove(s)
    return target


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def test_awkward_documents(spark):
    docs = documents(spark)
    got = mixing.mixed_documents(docs).collect()
    rows = docs.collect()
    assert len(got) == len(rows)
    sizes = {}
    for r in rows:
        sizes[r["source"]] = sizes.get(r["source"], 0) + words(r["text"])
    want = water_fill(sizes)
    taken = dict.fromkeys(sizes, 0)
    for r in got:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]])
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
    assert all(abs(taken[s] - want[s]) <= 1 for s in sizes)
    assert mixing.mixed_documents(empty(spark)).count() == 0


def test_table_and_rerun(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    a = sorted(map(tuple, mixing.mixed_documents(docs).select("doc_id", "size", "target", "taken").collect()))
    b = sorted(map(tuple, mixing.mixed_documents(docs.repartition(5)).select("doc_id", "size", "target", "taken").collect()))
    assert [(x[0], x[1], x[3]) for x in a] == [(x[0], x[1], x[3]) for x in b]
    assert {r["doc_id"]: words(r["text"]) for r in docs.collect()} == {x[0]: x[1] for x in a}


def test_schedule_is_spread_and_complete(spark):
    docs = documents(spark)
    sized = mixing.with_words(docs)
    targets = mixing.source_targets(sized)
    slots = mixing.schedule(targets).collect()
    quota = {r["position"]: round(r["target"]) for r in targets.collect()}
    taken, starts = {}, {}
    for s in slots:
        taken[s["position"]] = taken.get(s["position"], 0) + s["tokens"]
        starts.setdefault(s["position"], []).append(s["start"])
    assert taken == {p: q for p, q in quota.items() if q}
    assert all(len(set(v)) == len(v) for v in starts.values())
    largest = max(quota, key=quota.get)
    order = [s["position"] == largest for s in sorted(slots, key=lambda s: s["slot"])]
    half = len(order) // 2
    assert abs(sum(order[:half]) - sum(order) / 2) <= 4  # low discrepancy


def test_segments_cover_the_quota(spark):
    sized = mixing.with_words(documents(spark))
    targets = mixing.source_targets(sized)
    total = sum(r["tokens"] for r in mixing.mix(sized, targets).collect())
    assert total == sum(round(r["target"]) for r in targets.collect())


def test_corpus(spark):
    docs = documents(spark)
    mixed = mixing.mixed_corpus(docs)
    assert mixed.columns == docs.columns
    ids = [r["doc_id"] for r in mixed.collect()]
    assert {4, 5, 6} <= set(ids) and max(ids.count(i) for i in set(ids)) <= 6
    assert mixing.mixed_corpus(empty(spark)).count() == 0
