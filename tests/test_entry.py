import duckdb
import pytest

import __spark_entry__ as entry
from stridelake.plans import catalog

SF = "/root/testdata/sf0.001"


def test_entry_has_rows(spark):
    assert entry.entry(spark).limit(1).count() == 1


@pytest.mark.parametrize("name", ["flagship", "nearest_valid_fill", "percentile_ranks", "upsert_summary", "interval_join", "supplied_events"])
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for table in ("events", "customer", "orders", "lineitem"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    df = catalog.queries()[name](spark, SF)
    names = sorted(df.columns)
    expected = con.execute(f"SELECT {', '.join(f'"{n}"' for n in names)} FROM ({catalog.oracle_sql()[name]})").fetchall()
    assert sorted(map(repr, expected)) == sorted(repr(tuple(r)) for r in df.select(*names).collect())
