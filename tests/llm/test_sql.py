import duckdb
import pytest

from flowguard.llm.queries import ORACLE, QUERIES
from tests.llm.util import SF


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for name_ in ("documents", "conversations"):
        con.sql(f"CREATE VIEW {name_} AS SELECT * FROM read_parquet('{SF}/{name_}.parquet')")
    rel = con.sql(ORACLE[name])
    df = QUERIES[name](spark, SF)
    assert sorted(df.columns) == sorted(rel.columns)

    def rows(found):
        return sorted(tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in found)
    assert rows(df.select(rel.columns).collect()) == rows(rel.fetchall())
