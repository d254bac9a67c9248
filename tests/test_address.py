import pytest
from pyspark.sql import functions as F

from loomwork.functions import address
from loomwork.plans.normalise import entity_id, normalise

STREETS = [
    ("Hauptstr. 1", "1", "Hauptstr."),
    ("10 Downing Street", "10", "Downing Street"),
    ("Rue de la Loi 200-204", "200", "Rue de la Loi"),
    ("Via Roma, 12b", "12b", "Via Roma"),
    ("  Campus   Nord ", None, "Campus Nord"),
    ("123", None, "123"),
    (None, None, ""),
]


def test_streets(spark):
    df = spark.createDataFrame([(i, s) for i, (s, _, _) in enumerate(STREETS)], "i int, s string")
    got = [tuple(r[0]) for r in df.orderBy("i").select(address.split_street(F.col("s"))).collect()]
    assert got == [(n, s) for _, n, s in STREETS]


def test_cities_and_keys(spark):
    row = spark.range(1).select(
        address.city_parts(F.lit("LOUVAIN / LEUVEN, ")), address.city_parts(F.lit("Aix-en-Provence")), address.fold(F.lit(" Köln-Süd, ")), address.city_parts(F.lit(None).cast("string"))
    ).first()
    assert list(row) == [["LOUVAIN", "LEUVEN"], ["Aix-en-Provence"], "koln sud", []]


def test_plan_skips_what_is_cached(spark):
    rows = spark.createDataFrame([("A 1", "1", "X", "DE"), (" a  1", "1", "x", "de"), ("B 2", None, "Y", "FR"), (None, None, "Z", "FR")], "street string, postcode string, city string, country string")
    none = spark.createDataFrame([], "key string")
    plan = address.geocode_plan(rows, none, 10).collect()
    assert [r["n"] for r in plan] == [2, 1]
    cached = spark.createDataFrame([(plan[0]["key"],)], "key string")
    assert [r["city"] for r in address.geocode_plan(rows, cached, 10).collect()] == ["Y"]
    assert address.geocode_plan(rows, none, 1).count() == 1


def test_tiers():
    tiers = [(100, 0.0), (500, 10.0), (float("inf"), 5.0)]
    assert address.tiered_cost(100, tiers) == 0
    assert address.tiered_cost(600, tiers) == pytest.approx(4 + 0.5)
    assert address.tiered_cost(100, tiers, used=450) == pytest.approx(0.5 + 0.25)


def test_normalise(spark):
    docs = spark.createDataFrame(
        [("p1", [("Ann", "x"), ("Bob", None), ("Ann", "y"), (None, "z"), None]), ("p2", [("Bob", "b")]), ("p3", None)],
        "doc string, authors array<struct<name:string,mail:string>>",
    )
    entities, junction = normalise(docs, ["doc"], "authors", ["name"])
    assert sorted((r["name"], r["mail"]) for r in entities.collect()) == [("Ann", "y"), ("Bob", "b")]
    names = {r["id"]: r["name"] for r in entities.collect()}
    docs_by = {r[0]: r[1] for r in docs.select(entity_id(F.col("doc")), "doc").collect()}
    got = sorted((docs_by[r["parent_id"]], names[r["child_id"]], r["position"]) for r in junction.collect())
    assert got == [("p1", "Ann", 0), ("p1", "Bob", 1), ("p2", "Bob", 0)]
