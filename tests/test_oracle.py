"""Every registered query against its DuckDB oracle (the driver's gate),
on the small test tables; PLOTCOVER_TEST_SF picks another scale."""

import pytest

import __spark_entry__ as entry_mod
from tests.oracle_compare import compare, duck_connection

QUERIES = entry_mod._survey_queries()
ORACLES = entry_mod._survey_oracles()


@pytest.fixture(scope="module")
def duck(sf_dir):
    return duck_connection(sf_dir)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, sf_dir, duck, name):
    r = compare(spark, sf_dir, QUERIES[name], ORACLES[name], duck)
    assert r["columns_match"], (r["spark_columns"], r["oracle_columns"])
    assert r["rows_spark"] == r["rows_oracle"]
    assert r["hash_match"]


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["communitytype", "vegetationtype", "speciescode",
                          "location_name", "abs_cover"]
