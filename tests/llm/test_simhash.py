import random

import numpy as np
import pytest
import xxhash

from loomwork.llm import components, simhash
from tests.llm.fixtures import documents, empty, prose


def plain_fingerprint(text):
    words = [w for w in "".join(c if c.isascii() and c in " \t\n\x0b\x0c\r" else c for c in (text or "")).translate({i: i + 32 for i in range(65, 91)}).replace("\t", " ").replace("\n", " ").replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ").split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps):
    parent = list(range(len(fps)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= 4:
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return [find(i) for i in range(len(fps))]


@pytest.mark.parametrize("text", [None, "", " \n", "one", "A b C", "a b c d", "a a a a a a", "É ß x \x1c y z w", prose(1, 300)])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_same_hash_as_spark(spark):
    from pyspark.sql import functions as F

    got = spark.range(1).select(F.xxhash64(F.lit("alpha beta"))).first()[0]
    assert got % (1 << 64) == xxhash.xxh64_intdigest(b"alpha beta", 42)


def planted(seed, n):
    rng = random.Random(seed)
    fps = [0, (1 << 64) - 1]
    while len(fps) < n:
        base = rng.getrandbits(64) if rng.random() < 0.5 else rng.choice(fps)
        for b in rng.sample(range(64), rng.randrange(0, 7)):
            base ^= 1 << b
        fps.append(base)
    return sorted(set(fps))


@pytest.mark.parametrize("block", [4, 4096])
def test_links_equal_brute_force(spark, monkeypatch, block):
    """Also with a block so small that buckets are dealt out."""
    monkeypatch.setattr(simhash, "BLOCK", block)
    fps = planted(5, 700)
    signed = [(int(np.uint64(x).view(np.int64)),) for x in fps]
    distinct = spark.createDataFrame(signed, "fp long")
    found = {r["node"]: r["component"] for r in components.connected_components(simhash.simhash_links(distinct)).collect()}
    mine = [found.get(s[0], s[0]) for s in signed]
    want = brute_components(fps)
    groups = lambda labels: sorted(sorted(i for i, x in enumerate(labels) if x == k) for k in set(labels))
    assert groups(mine) == groups(want)


def test_every_pair_within_four_bits_has_a_start():
    rng = random.Random(1)
    for _ in range(2000):
        d = sum(1 << b for b in rng.sample(range(64), rng.randrange(0, 5)))
        diff = np.array([d], dtype=np.uint64)
        ok = False
        for s in range(5):
            own = int(simhash._CHAINS[s, 0]) & d
            two = int(simhash._CHAINS[s, 1]) & d
            if own == 0 and bin(two).count("1") <= 1 and simhash._viable(diff, s)[0]:
                ok = True
        assert ok


def test_components(spark):
    docs = documents(spark)
    got = simhash.simhash_components(docs).collect()
    assert len(got) == docs.count()
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], set()).add(r["component_id"])
    assert by[1] == by[2] == {1}
    assert by[4] == by[5] == by[6] == {4}  # no word: fingerprint zero
    assert by[8] == {8} and by[None] == {None}
    assert simhash.simhash_components(empty(spark)).count() == 0


def test_dedup(spark):
    docs = documents(spark)
    kept = simhash.simhash_dedup(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] or 0) for r in kept.collect()) == [0, 1, 3, 4, 7, 8, 9, 10]
    assert simhash.simhash_dedup(empty(spark)).count() == 0


def test_components_of_a_long_chain(spark):
    n = 300
    edges = spark.createDataFrame([(i + 1, i) for i in range(n)] + [(1000, 1001), (5, 5), (None, 3)], "src long, dst long")
    got = {r["node"]: r["component"] for r in components.connected_components(edges.repartition(8)).collect()}
    assert all(got[i] == 0 for i in range(n + 1)) and got[1001] == 1000


def test_components_with_tiny_forests(spark, monkeypatch):
    monkeypatch.setattr(components, "FOREST_NODES", 1)
    rng = random.Random(3)
    pairs = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)]
    got = {r["node"]: r["component"] for r in components.connected_components(spark.createDataFrame(pairs, "src long, dst long")).collect()}
    forest = components.Forest()
    forest.add(np.array([a for a, _ in pairs]), np.array([b for _, b in pairs]))
    assert all(got[x] == forest.find(x) for x in got)
