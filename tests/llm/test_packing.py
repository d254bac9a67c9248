import random
import zlib

import numpy as np
import pytest

from loomwork.llm import packing
from loomwork.llm.queries import tokenizer_paths
from tests.llm.fixtures import documents, empty, prose


@pytest.fixture(scope="module")
def tokenizer():
    return packing.Tokenizer(*tokenizer_paths())


def slow_cost(places, penalty, window, short):
    at = [0, *places]
    best = [0] + [10**9] * len(places)
    for j in range(1, len(at)):
        for i in range(j):
            n = at[j] - at[i]
            if n <= window:
                pad = window - n if n & (n - 1) else min(window - n, short)
                best[j] = min(best[j], best[i] + pad + penalty[j - 1])
    return best[-1]


def cost_of(cuts, places, penalty, window, short):
    price = dict(zip(places, penalty))
    out, last = 0, 0
    for c in cuts:
        n = c - last
        assert 0 < n <= window
        out += (window - n if n & (n - 1) else min(window - n, short)) + price[c]
        last = c
    return out


@pytest.mark.parametrize("seed", range(30))
def test_plan_is_optimal(seed):
    rng = random.Random(seed)
    window = 64
    places, p = [], 0
    for _ in range(rng.randrange(1, 60)):
        p += rng.randrange(1, 30)
        places.append(p)
    penalty = [rng.choice([0, 3, 20]) for _ in places]
    short = rng.choice([0, 5, 16])
    cuts = packing.plan_windows(np.array(places), np.array(penalty), window, short)
    assert cuts[-1] == places[-1]
    assert cost_of(cuts, places, penalty, window, short) == slow_cost(places, penalty, window, short)


def test_places_are_close():
    ids = np.zeros(5000, dtype=np.uint32)
    places, penalty = packing.cut_places(ids, np.array([1000, 5000]), np.zeros(1, dtype=bool))
    assert np.diff(np.r_[0, places]).max() <= packing.FORCED
    assert penalty[list(places).index(1000)] == 0 and penalty[0] == packing.FORCED_CUT


@pytest.mark.parametrize("text", ["", "Hello, world.", " a  b\n\nc ", "<|endoftext|>x", "日本 é 😀", "x" * 3000, "1234 don't"])
def test_ids_equal_the_library(tokenizer, text):
    assert tokenizer.encode(text).tolist() == tokenizer.library.encode(text, add_special_tokens=False).ids


def check(rows, texts, tokenizer):
    """Every id of every document lies in one piece, at its place in its sequence."""
    sequences, docs = {}, {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append(r)
        docs.setdefault(r["doc_id"], []).append(r)
    for pieces in sequences.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at and r["length"] > 0
            at += r["length"]
        assert at <= packing.WINDOW
    for i, text in texts.items():
        ids = np.append(tokenizer.encode(text or ""), 1).astype("<u4")
        at = 0
        for r in sorted(docs[i], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    used = [sum(r["length"] for r in s) for s in sequences.values()]
    return sum(0 if n & (n - 1) == 0 else packing.WINDOW - n for n in used) / max(1, sum(used))


def test_awkward_documents(spark, tokenizer):
    docs = documents(spark).where("doc_id IS NULL OR doc_id <> 8").coalesce(1)
    rows = packing.pack_documents(docs, *tokenizer_paths()).collect()
    check(rows, {r["doc_id"]: r["text"] for r in docs.collect()}, tokenizer)
    twice = packing.pack_documents(documents(spark).where("doc_id = 8"), *tokenizer_paths()).collect()
    assert len({(r["sequence_id"], r["offset"]) for r in twice}) == len(twice) and sum(r["start"] == 0 for r in twice) == 2
    assert packing.pack_documents(empty(spark), *tokenizer_paths()).count() == 0


def test_little_padding_over_horizons(spark, tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "HORIZON", 1 << 15)
    texts = {i: prose(i, 20 + i * 37 % 900) for i in range(150)}
    packer = packing.Packer(tokenizer, 5)
    rows = [r for i, t in texts.items() for r in packer.add(i, t)]
    rows += packer.close()
    assert check(rows, texts, tokenizer) < 0.02
    order = [r["doc_id"] for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"]))]
    assert order == sorted(order)


def test_pieces_hold_their_ids(spark, tokenizer):
    rows = packing.pack_documents(documents(spark).where("doc_id = 3"), *tokenizer_paths(), with_ids=True).collect()
    ids = [x for r in sorted(rows, key=lambda r: r["start"]) for x in r["ids"]]
    assert ids == tokenizer.encode(prose(3, 120)).tolist() + [1]


def test_no_more_sequences_than_needed(spark, tokenizer):
    """Short windows of a power of two end a stream; they do not fill it."""
    texts = {i: prose(i, 20 + i * 37 % 900) for i in range(200)}
    packer = packing.Packer(tokenizer, 0)
    rows = [r for i, t in texts.items() for r in packer.add(i, t)] + list(packer.close())
    used: dict[int, int] = {}
    for r in rows:
        used[r["sequence_id"]] = used.get(r["sequence_id"], 0) + r["length"]
    assert len(used) <= 1.02 * sum(used.values()) / packing.WINDOW + 2
    assert sum(n < packing.WINDOW // 2 for n in used.values()) <= 2
