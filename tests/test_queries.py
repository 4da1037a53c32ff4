"""Every query of the posting model against its SQL, at the smallest size."""

import math
import re

import duckdb
import pytest

from tidemark.plans import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents pages".split()
QUERIES, ORACLE = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.9g}")
    if hasattr(value, "isoformat"):
        return re.sub("T00:00:00$", "", value.isoformat())
    if isinstance(value, (list, tuple)):
        return tuple(map(plain, value))
    return float(value) if type(value).__name__ == "Decimal" else value


def rows(columns, found):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(repr(tuple(plain(r[i]) for i in order)) for r in found)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, duck, name):
    found = QUERIES[name](spark, SF)
    wanted = duck.execute(ORACLE[name])
    columns = [c[0] for c in wanted.description]
    assert sorted(found.columns) == sorted(columns)
    assert rows(found.columns, found.collect()) == rows(columns, wanted.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_runs_without_sql(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_postcodes_longer_than_five_digits_stay_whole(spark, tmp_path):
    """More customers than a postcode of five digits has numbers."""
    customers = [(k, k % 25) for k in (0, 7, 12345, 99999, 100000, 1234567)]
    spark.createDataFrame(customers, "c_custkey long, c_nationkey int").coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    spark.read.parquet(f"{SF}/nation.parquet").write.parquet(f"{tmp_path}/nation.parquet")
    connection = duckdb.connect()
    for name in ("customer", "nation"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    found, wanted = QUERIES["three_way_crosswalk"](spark, str(tmp_path)), connection.execute(ORACLE["three_way_crosswalk"])
    assert rows(found.columns, found.collect()) == rows([c[0] for c in wanted.description], wanted.fetchall())
