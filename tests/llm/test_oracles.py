import pytest

from loomwork.llm import queries
from tests.compare import duck, from_duck, from_spark


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_against_duckdb(spark, sf_dir, name):
    """Over the smallest tables and the ones that are checked."""
    for folder in (sf_dir, sf_dir.replace("sf0.001", "sf0.01")):
        assert from_spark(queries.queries()[name](spark, folder)) == from_duck(duck(folder), queries.oracle_sql()[name])


def test_session_keeps_its_batches(spark):
    """Operators leave the session as it is; only the queries ask for small batches."""
    from loomwork.llm import license_scan
    from tests.llm.fixtures import documents

    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "10000")
    try:
        license_scan.scan_licenses(documents(spark)).collect()
        assert spark.conf.get(key) == "10000"
    finally:
        spark.conf.set(key, before)
