import random

import numpy as np
import pytest
import zlib

from loomwork.llm import language_id as lid
from tests.llm.fixtures import documents, empty


def corpus(seed, syllables, n):
    rng = random.Random(seed)
    return [" ".join("".join(rng.choices(syllables, k=rng.randrange(1, 4))) for _ in range(rng.randrange(5, 60))) for _ in range(n)]


TEXTS = {"aa": corpus(1, ["ba", "lo", "mi", "ne"], 60), "bb": corpus(2, ["tra", "sch", "un", "der"], 60), "cc": corpus(3, ["øy", "ær", "ba", "un"], 60)}


@pytest.fixture(scope="module")
def models():
    return lid.train(TEXTS)


def test_probabilities_of_a_context_sum_to_one(models):
    """Over the alphabet and one unseen symbol, for seen and unseen contexts."""
    alphabet = [int(k) for k in models.keys[0]] + [0x2603]
    for context in ("bal", "tra", "xyz", "  b", "øyb"):
        key = 0
        for c in context:
            key = key << 16 | (lid._SPACE if c == " " else ord(c))
        keys = np.array([key << 16 | a for a in alphabet], dtype=np.uint64)
        total = np.exp(-models.surprisal(keys).astype(np.float64)).sum(axis=0)
        assert np.allclose(total, 1, atol=1e-3), (context, total)


def test_kneser_ney_by_hand():
    """Order 2 on one tiny text: discounts, continuation counts and interpolation."""
    m = lid.train({"x": ["abab"]}, order=2)
    sp, a, b = lid._SPACE, ord("a"), ord("b")
    pairs = {(sp, a): 1, (a, b): 2, (b, a): 1, (b, sp): 1}
    d2 = min(0.95, max(0.1, 3 / (3 + 2 * 1)))
    left = {a: 2, b: 1, sp: 1}
    d1 = min(0.95, max(0.1, 2 / (2 + 2 * 1)))
    uniform = 1 / 4
    p1 = {c: max(n - d1, 0) / 4 + d1 * 3 / 4 * uniform for c, n in left.items()}
    for (h, c), n in pairs.items():
        total = sum(k for (g, _), k in pairs.items() if g == h)
        kinds = sum(g == h for g, _ in pairs)
        want = max(n - d2, 0) / total + d2 * kinds / total * p1[c]
        got = np.exp(-m.surprisal(np.array([h << 16 | c], dtype=np.uint64)))[0, 0]
        assert got == pytest.approx(want, rel=1e-4)


def test_held_out_accuracy(models):
    fresh = {lang: corpus(seed + 50, s, 40) for lang, seed, s in (("aa", 1, ["ba", "lo", "mi", "ne"]), ("bb", 2, ["tra", "sch", "un", "der"]), ("cc", 3, ["øy", "ær", "ba", "un"]))}
    for lang, texts in fresh.items():
        best, score, rejected = models.predict([lid.symbols(t) for t in texts])
        assert np.mean([models.languages[b] == lang for b in best]) >= 0.95
        assert not rejected.any() and ((score >= 0) & (score <= 1)).all()


def test_rejection(models):
    junk = ["qxzwvk " * 30, "ЖЩЮ ЫЪЭ " * 20]
    assert models.predict([lid.symbols(t) for t in junk])[2].all()


def test_awkward_documents(spark):
    docs = documents(spark)
    got = lid.identify_languages(docs).collect()
    assert len(got) == docs.count()
    by = {r["doc_id"]: r for r in got}
    for i in (4, 5, 6):
        assert (by[i]["lang_pred"], by[i]["score"], by[i]["rejected"]) == ("und", 0.0, True)
    assert all(by[i]["lang_pred"] in ("en", "de") for i in (1, 3, 7, 8, 9, 10))
    assert all(by[i]["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i in range(1, 11))
    assert by[None]["held_out"] is False
    assert lid.identify_languages(empty(spark)).count() == 0
    untaught = lid.identify_languages(docs, training=empty(spark)).collect()
    assert {r["lang_pred"] for r in untaught} == {"und"}


def test_held_out_rows_teach_nothing(spark):
    rows = [(i, t, lang) for k, (lang, texts) in enumerate(TEXTS.items()) for i, t in enumerate(texts, start=1000 * k)]
    rows = [(i, t, "zz" if zlib.crc32(str(i).encode()) % 4 == 2 else lang) for i, t, lang in rows]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r["doc_id"]: r["lang_pred"] for r in lid.identify_languages(df).collect()}
    assert set(got.values()) <= set(TEXTS)
    want = {i: lang for k, lang in enumerate(TEXTS) for i in range(1000 * k, 1000 * k + 60)}
    assert np.mean([got[i] == want[i] for i in want]) > 0.95


def test_sample_is_bounded(spark):
    rows = [(i, f"wort{i} abc", "de") for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    texts = lid.training_texts(df, "doc_id", "text", "lang", 50)
    assert len(texts["de"]) == 50


def test_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = lid.identify_languages(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in got]) > 0.95


def test_every_letter_is_a_symbol(spark):
    """Letters whose 16 bits would be those of the space, beyond the basic plane too."""
    for letter in ("\U00020022", "\U00010021", "a", "漢", "я"):
        assert (lid.symbols(letter) != 32).any()
    letters = np.flatnonzero(lid.letter_table())
    codes = "".join(chr(c) for c in letters if chr(c).lower() == chr(c))
    assert (lid.symbols(codes)[1:-1] != 32).all()
    train = [(4 * i, "the quick brown fox and the lazy dog", "en") for i in range(40)] + [(4 * i + 1, "der schnelle Fuchs und der faule Hund", "de") for i in range(40)]
    rows = [*train, (1000, "\U00020022\U00020022", None), (1001, "\U00010021", "en")]
    got = {r["doc_id"]: r["lang_pred"] for r in lid.identify_languages(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert got[1000] in ("en", "de") and got[1001] in ("en", "de")


def test_characters_of_the_sample_are_bounded(spark, monkeypatch):
    rows = [(i, f"word{i % 7} " * 200, "en" if i % 2 else "de") for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    monkeypatch.setattr(lid, "SAMPLE_CHARS", 20_000)
    texts = lid.training_texts(df, "doc_id", "text", "lang", 800)
    assert set(texts) == {"en", "de"} and all(0 < sum(map(len, t)) <= 10_000 for t in texts.values())
    monkeypatch.setattr(lid, "SAMPLE_CHARS", 10)
    assert all(len(t) == 1 for t in lid.training_texts(df, "doc_id", "text", "lang", 800).values())
