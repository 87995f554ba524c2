import duckdb
import pytest

from prosemill.llm.catalog import ORACLE, QUERIES
from tests.conftest import rows
from tests.llm.common import SF


def test_one_query_for_each_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_agrees_with_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "benchmark", "pages"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    found = duck.execute(ORACLE[name])
    names = [d[0] for d in found.description]
    df = QUERIES[name](spark, SF)
    assert sorted(names) == sorted(df.columns)
    assert sorted(rows(df, *names)) == sorted(found.fetchall())
