import duckdb
import pytest

import __spark_entry__ as entry
from corpuskiln.plans import oracles

SF = "/root/testdata/sf0.001"


def rows(frame_columns, data):
    order = sorted(range(len(frame_columns)), key=lambda i: frame_columns[i])
    show = lambda v: "null" if v is None or v != v else f"{v:.9g}" if isinstance(v, float) else str(v)
    return sorted(tuple(show(r[i]) for i in order) for r in data)


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).columns[0] == "rank" and entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(oracles.SQL))
def test_query_equals_its_sql(spark, name):
    db = duckdb.connect()
    for t in ("documents", "pages", "conversations", "labels", "events", "part", "benchmark"):
        db.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    want = db.sql(entry.oracle_sql()[name])
    got = entry.queries()[name](spark, SF)
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got.columns, [tuple(r) for r in got.collect()]) == rows(want.columns, want.fetchall())
