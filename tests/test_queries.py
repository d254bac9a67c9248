import pytest

import __spark_entry__ as entry_points
from loomwork.queries import ORACLES, QUERIES
from tests.compare import duck, from_duck, from_spark


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_duckdb(spark, con, sf_dir, name):
    assert from_spark(QUERIES[name](spark, sf_dir)) == from_duck(con, ORACLES[name])


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


def test_registered():
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(ORACLES) <= set(entry_points.oracle_sql())


def test_autocomplete_quality_asks_for_every_name(spark, tmp_path):
    """Against the plain rule and the SQL, on keys of which only two are divisible by 20."""
    import duckdb

    vocabulary = ["bolt", "blue", "b", "ring", "rod", "red"]
    names = [(i, None if i == 30 else " ".join(vocabulary[(i * m) % 6] for m in (1, 5)[: 1 + i % 2]), None if i % 13 == 0 else i * 7 % 5) for i in range(1, 60)]
    values = ", ".join(f"({i}, {'NULL' if name is None else repr(name)}, {'NULL' if size is None else size})" for i, name, size in names)
    duckdb.sql(f"COPY (SELECT p_partkey::BIGINT AS p_partkey, p_name, p_size::INT AS p_size FROM (VALUES {values}) v(p_partkey, p_name, p_size)) TO '{tmp_path}/part.parquet' (FORMAT parquet)")
    split = {i: name.split() for i, name, _ in sorted(names, key=lambda n: (n[2] is None, -(n[2] or 0), n[0])) if name}
    want = []
    for k in (1, 2):
        asked = [(i, w[:k]) for i, w in split.items() if len(w) >= k]
        hits = lambda q: [i for i, w in split.items() if set(q[:-1]) <= set(w) and any(x.startswith(q[-1]) for x in w)][:8]
        want.append((k, len(asked), sum(i in hits(q) for i, q in asked)))
    got = QUERIES["autocomplete_quality"](spark, str(tmp_path))
    assert sorted((r["words"], r["asked"], r["found"]) for r in got.collect()) == want
    assert from_spark(got) == from_duck(duck(str(tmp_path)), ORACLES["autocomplete_quality"])
