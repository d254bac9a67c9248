import random

import numpy as np
import pytest

from loomwork.llm import near_dup, simhash
from tests.llm.fixtures import documents, empty, prose


def brute(texts):
    """Component of each text by all pairs."""
    sets = [set(simhash.shingle_hashes(t, 5)) for t in texts]
    part = list(range(len(texts)))

    def root(i):
        while part[i] != i:
            i = part[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] | sets[j])
            if (not both or 5 * len(sets[i] & sets[j]) >= 4 * both) and root(i) != root(j):
                part[max(root(i), root(j))] = min(root(i), root(j))
    return [root(i) for i in range(len(texts))]


def changed(text, every):
    words = text.split()
    return " ".join(w + "x" if i % every == every // 2 else w for i, w in enumerate(words))


def test_pairs_at_similarity_above_0_8_are_linked(spark):
    """Also those whose SimHashes differ in more than 4 bits, and none below."""
    texts = []
    for seed in range(12):
        base = prose(seed + 50, 300)
        texts += [base, base.upper(), changed(base, 60), changed(base, 30), changed(changed(base, 60), 75)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in simhash.simhash_components(docs).collect()}
    want = dict(enumerate(brute(texts)))
    assert got == want
    assert any(bin(simhash.fingerprint(texts[k]) ^ simhash.fingerprint(texts[want[k]])).count("1") > 4 for k in want)
    assert sorted(r["doc_id"] for r in simhash.simhash_dedup(docs).collect()) == sorted(set(want.values()))


@pytest.mark.parametrize("leaders,cell,hashes", [(2, 4096, 4_000_000), (0, 4096, 4_000_000), (0, 3, 4_000_000), (1, 4096, 900)])
def test_groups_whose_copies_are_not_alike(spark, monkeypatch, leaders, cell, hashes):
    """Copies near an original but not each other, and texts that share a passage only: every way of comparing finds the same."""
    monkeypatch.setattr(near_dup, "LEADERS", leaders)
    monkeypatch.setattr(near_dup, "CELL", cell)
    monkeypatch.setattr(near_dup, "CELL_HASHES", hashes)
    texts = []
    for seed in range(4):
        base = prose(seed + 10, 200).split()
        texts.append(" ".join(base))
        for k in range(9):  # each changes a run of its own
            texts.append(" ".join(base[: 20 * k] + [f"c{seed}{k}{i}" for i in range(15)] + base[20 * k + 15 :]))
        texts += [" ".join(base[:150]) + " " + prose(100 * seed + k, 60) for k in range(8)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in near_dup.near_components(docs).collect()}
    assert got == dict(enumerate(brute(texts))) and len(set(got.values())) < len(texts) - 30


def test_awkward_rows(spark):
    docs = documents(spark)
    kept = simhash.simhash_dedup(docs)
    assert kept.dtypes == docs.dtypes
    assert sorted((r["doc_id"] or 0) for r in kept.collect()) == [0, 1, 3, 4, 7, 8, 9, 10]
    assert simhash.simhash_dedup(empty(spark)).count() == 0


def test_op8_keeps_its_contract(spark):
    """Fingerprints over four words, links at 4 or fewer bits."""
    base = prose(50, 300)
    texts = [base, base.upper(), changed(base, 30), None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in simhash.hamming_components(docs).collect()}
    assert [got[i]["fp"] % (1 << 64) for i in range(4)] == [simhash.fingerprint(t, 4) for t in texts]
    near = [i for i in range(3) if bin(simhash.fingerprint(texts[i]) ^ simhash.fingerprint(base)).count("1") <= 4]
    assert [got[i]["component_id"] for i in range(4)] == [0 if i in near else i for i in range(4)]
    assert near == [0, 1]


def test_op8_awkward_rows(spark):
    docs = documents(spark)
    got = simhash.hamming_components(docs).collect()
    assert len(got) == docs.count()
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], set()).add(r["component_id"])
    assert by[1] == by[2] == {1} and by[4] == by[5] == by[6] == {4}
    assert by[8] == {8} and by[None] == {None}
    assert simhash.hamming_components(empty(spark)).count() == 0


def test_the_stage_rests_on_simhash(spark, monkeypatch):
    """Its fingerprints are SimHashes of the sets, and without the ring's budget nothing is linked."""
    text = prose(3, 200)
    hashes = [int(x) for x in near_dup.shingle_set(text)]
    assert sorted(set(simhash.shingle_hashes(text, 5))) == hashes
    plain = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    assert int(near_dup.wide_fingerprint(near_dup.shingle_set(text))[0]) == plain
    other = near_dup.wide_fingerprint(near_dup.shingle_set(changed(text, 60)))
    wide = np.stack([near_dup.wide_fingerprint(near_dup.shingle_set(text)), other]).T.copy()
    two, n = np.zeros(2, dtype=np.int64), np.array([196, 196])
    assert len(set(near_dup._groups(two, n, wide).tolist())) == 1
    monkeypatch.setattr(near_dup, "RADIUS", -1)
    assert len(set(near_dup._groups(two, n, wide).tolist())) == 2


def test_every_pair_within_the_radius_has_a_start():
    rng = random.Random(2)
    for _ in range(500):
        d = sum(1 << b for b in rng.sample(range(256), rng.randrange(0, near_dup.RADIUS + 1)))
        wide = np.array([[0, d >> 64 * i & (1 << 64) - 1] for i in range(near_dup.RING)], dtype=np.uint64)
        a, b = np.array([0]), np.array([1])
        assert any(len(near_dup._chained(wide, a, b, s)) for s in range(near_dup.RING))


@pytest.mark.parametrize("off", [39, 48])
def test_tables_bring_pairs_together(off):
    """Planted pairs at the distance of similarity 0.8 and beyond, among others; strangers stay apart."""
    rng = np.random.default_rng(off)
    pairs = 3000
    left = rng.integers(0, 1 << 64, (near_dup.RING, pairs), dtype=np.uint64)
    flips = np.zeros((pairs, 256), dtype=np.uint8)
    for row in flips:
        row[rng.choice(256, off, replace=False)] = 1
    right = left ^ np.packbits(flips, axis=1, bitorder="little").view("<u8").T
    wide = np.ascontiguousarray(np.concatenate([left, right], axis=1))
    group = near_dup._groups(np.zeros(2 * pairs, dtype=np.int64), np.full(2 * pairs, 100), wide)
    met = group[:pairs] == group[pairs:]
    assert met.mean() >= 0.995 and len(set(group.tolist())) == 2 * pairs - met.sum()


@pytest.mark.parametrize("few,block", [(512, 5), (0, 100_000)])
def test_blocks_and_tables_in_the_stage(spark, monkeypatch, few, block):
    """Classes of several blocks, and tables in small cells, find what all pairs find."""
    monkeypatch.setattr(near_dup, "BRUTE", few)
    monkeypatch.setattr(near_dup, "BLOCK", block)
    texts = []
    for seed in range(10):
        base = prose(seed + 50, 150 + 5 * seed)
        texts += [base, changed(base, 60), changed(base, 40), base + " " + prose(seed + 500, 20)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] * 2, "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in near_dup.near_components(docs).collect()}
    assert got == dict(enumerate(want := brute(texts))) and len(set(want)) < len(texts)
