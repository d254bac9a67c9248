import random
import unicodedata

import pytest
from pyspark.sql import functions as F

from loomwork.functions import codes, markup, parse, text, urls

ALPHABET = list("ab Zé\t\n\r\0–—  ​﻿‍\x0b\x0c\x1c\x85&;<>") + ["￾", "　", "x" * 3]


def random_strings(n, seed):
    rng = random.Random(seed)
    return [None, "", " "] + ["".join(rng.choices(ALPHABET, k=rng.randrange(0, 14))) for _ in range(n)]


@pytest.mark.parametrize("name", ["sanitize_string", "sanitize_name", "sanitize_title", "sanitize_content", "sanitize_url"])
def test_sanitizers_equal_python(spark, name):
    values = random_strings(3000, name)
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    got = {r["i"]: r["o"] for r in df.select("i", getattr(text, name)(F.col("s")).alias("o")).collect()}
    oracle = getattr(text.python_oracles, name)
    wrong = [(v, got[i], oracle(v)) for i, v in enumerate(values) if got[i] != oracle(v)]
    assert not wrong, wrong[:3]


CLEAN = [
    (None, None),
    ("", None),
    ("plain", "plain"),
    ("a &amp; b", "a & b"),
    ("a &amp;amp; b", "a & b"),
    ("&amp;lt;sub&amp;gt;2&lt;/sub&gt;", "2"),
    ("CO<sub>2</sub>", "CO2"),
    ("a<br>b", "a b"),
    ("a<br/>b<p class=\"x\">c</p>", "a b c"),
    ("p < 0.05 and x > 3", "p < 0.05 and x > 3"),
    ("<Background >x", "<Background >x"),
    ("&eacute;&Eacute;&#233;&#xE9;&#XE9;", "éÉééé"),
    ("&unknown; &", "&unknown; &"),
    ("a&nbsp;b&#160;c", "a b c"),
    ("a&#0;b&#55296;c&#7;d", "abcd"),
    ("x&shy;y&zwnj;z&#8203;", "xyz"),
    ("<mml:mi>x</mml:mi><jats:p>y</jats:p>", "xy"),
    ("&apos;&quot;&euro;&Scaron;&lstrok;", "'\"€Šł"),
    ("  <p> </p> ", None),
]


def test_clean_markup(spark):
    df = spark.createDataFrame([(i, s) for i, (s, _) in enumerate(CLEAN)], "i int, s string")
    got = [r["o"] for r in df.select("i", markup.clean_markup(F.col("s")).alias("o")).orderBy("i").collect()]
    assert got == [o for _, o in CLEAN]


def test_clean_markup_is_idempotent(spark):
    df = spark.createDataFrame([(o,) for _, o in CLEAN if o and "&" not in o], "s string")
    assert df.where(~markup.clean_markup(F.col("s")).eqNullSafe(F.col("s"))).count() == 0


def test_clean_list(spark):
    df = spark.createDataFrame([(["a &lt; b", "<p></p>", None],)], "l array<string>")
    assert df.select(markup.clean_markup_list(F.col("l"))).first()[0] == ["a < b"]


def test_code_points_equal_python(spark):
    points = [0, 7, 9, 32, 65, 127, 160, 173, 8203, 8364, 55296, 65279, 119070, 1114111, 1114112]
    df = spark.createDataFrame([(p,) for p in points], "p long")
    assert [r[0] for r in df.select(markup.code_point_text(F.col("p"))).collect()] == [markup.point_text(p) for p in points]


def test_fold_accents(spark):
    plain, marked = text.accent_pairs()
    assert all(unicodedata.normalize("NFD", m)[0] == p for p, m in zip(plain, marked))
    assert spark.range(1).select(text.fold_accents(F.lit("Éàñł ǖ"))).first()[0] == "Eanł u"


def test_name_key(spark):
    df = spark.createDataFrame([("  Université de Liège (ULg) ", "BE"), (None, None)], "n string, c string")
    assert [r[0] for r in df.select(text.name_key(F.col("n"), F.col("c"))).collect()] == ["universite de liege ulg|be", "|"]


def test_doi_and_keys(spark):
    row = spark.range(1).select(
        text.norm_doi(F.lit(" HTTPS://doi.org/10.1/AB ")), text.norm_doi(F.lit(" ")), text.key_alnum(F.lit("A-1 2b")), text.key_alnum(F.lit("ab")), text.key_zeros(F.lit("00-1234")), text.key_prefix(F.lit("AB000123456"))
    ).first()
    assert list(row) == ["10.1/ab", None, "a12b", None, "1234", "123456"]


def test_countries_equal_python(spark):
    valid = codes.iso_countries(spark)
    assert "XK" in valid and "AN" not in valid and len(valid) == 250
    cases = [None, "", "de", " uk ", "EL", "EU", "QAT", "XX", "xk", "WORLD", "AN", *valid[:5]]
    want = []
    for c in cases:
        key = (c or "").strip().upper()
        key = codes.COUNTRY_REMAP.get(key, key)
        want.append(key if key in valid else None)
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, c string")
    assert [r[0] for r in df.orderBy("i").select(codes.norm_country(F.col("c"), valid)).collect()] == want


def test_language_and_currency(spark):
    df = spark.createDataFrame([("fra/fre",), ("ger",), ("und",), ("",), (None,), ("ESL",)], "c string")
    assert [r[0] for r in df.select(codes.norm_language(F.col("c"))).collect()] == ["fra", "deu", None, None, None, "spa"]
    df = spark.createDataFrame([(None, ["SNSF"]), ("$", ["NHMRC"]), ("$", None), ("EUR", [])], "c string, f array<string>")
    assert [r[0] for r in df.select(codes.norm_currency(F.col("c"), F.col("f"))).collect()] == ["CHF", "AUD", "USD", "EUR"]


def test_euros(spark):
    df = spark.createDataFrame([(1, 114.6, "USD"), (2, 0.0, "EUR"), (3, -1.0, "EUR"), (4, 2e9, "EUR"), (5, 5.0, "XXX"), (6, None, "EUR")], "i int, a double, c string")
    got = {r["i"]: r["amount_eur"] for r in codes.with_euros(df, "a", "c").collect()}
    assert got[1] == pytest.approx(100) and [got[i] for i in range(2, 7)] == [None] * 5


def test_parsing(spark):
    row = spark.range(1).select(
        parse.parse_bool(F.lit(" Yes")), parse.parse_bool(F.lit("maybe")), parse.parse_long(F.lit(" 12 ")), parse.parse_long(F.lit("1e3")), parse.parse_double(F.lit("1,5")),
        parse.parse_date(F.lit("2024-02-30")), parse.parse_point(F.lit("[13.4, 52.5]"), True), parse.parse_point(F.lit("200, 1")), parse.nuts_level(F.lit("DE300")),
    ).first()
    assert list(row)[:6] == [True, None, 12, None, 1.5, None]
    assert (row[6]["lat"], row[6]["lon"]) == (52.5, 13.4) and row[7] is None and row[8] == 3


def test_links(spark):
    schema = "i array<struct<accessRight:struct<label:string>,urls:array<string>,pids:array<struct<scheme:string,value:string>>>>"
    inst = [({"label": "CLOSED"}, ["http://a/x.PDF?y=1&amp;z"], None), ({"label": "OPEN"}, ["http://b", "http://b/pdf/3"], [("DOI", "https://doi.org/10.1/q")]), (None, None, None)]
    df = spark.createDataFrame([(inst,), (None,), ([],)], schema)
    none = F.lit(None).cast("array<struct<scheme:string,value:string>>")
    got = df.select(urls.pdf_url(F.col("i")), urls.landing_url(none, F.col("i"))).collect()
    assert list(got[0]) == ["http://b/pdf/3", "https://doi.org/10.1/q"]
    assert list(got[1]) == [None, None] and list(got[2]) == [None, None]
