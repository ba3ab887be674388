"""Every registered query against its SQL, on the smallest tables."""

from collections import Counter
from pathlib import Path

import duckdb
import pytest

from siftwell import queries as q

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    if not Path(DATA).is_dir():
        pytest.skip("no test tables")
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return c


def _plain(v):
    if isinstance(v, (list, tuple)):
        return tuple(map(_plain, v))
    return v.replace(tzinfo=None).isoformat() if hasattr(v, "tzinfo") else str(v)


def compare(df, cursor):
    names, theirs = df.columns, [x[0] for x in cursor.description]
    assert sorted(names) == sorted(theirs)
    rows = Counter(tuple(_plain(r[c]) for c in sorted(names)) for r in df.collect())
    expected = Counter(tuple(_plain(r[theirs.index(c)]) for c in sorted(names)) for r in cursor.fetchall())
    assert rows == expected


@pytest.mark.parametrize("name", sorted(q.ORACLE_SQL))
def test_query_equals_sql(spark, duck, name):
    compare(q.QUERIES[name](spark, DATA), duck.execute(q.ORACLE_SQL[name]))


def test_cut_references_in_titles(spark, tmp_path):
    titles = ["a &amp", "a &amp; b", "&amp;lt; &lt;b&gt; &quot;&#x27;", "&lt", "&eacute;&nbsp;&#39;", "& &&amp", None]
    pages = [(i, f"<head><title> {x} </title></head><h1>no</h1>" if x else x) for i, x in enumerate(titles)]
    spark.createDataFrame(pages, "page_id long, html string").write.parquet(f"{tmp_path}/pages.parquet")
    c = duckdb.connect()
    c.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    compare(q.html_title(spark, str(tmp_path)), c.execute(q.ORACLE_SQL["html_title"]))


@pytest.mark.parametrize("name", ["publisher_candidates", "whole_run", "listed_by_source"])
def test_listings_around_midnight(spark, tmp_path, name):
    moments = [f"2024-01-{day} {time}" for day in ("04", "05", "06", "08", "12", "13") for time in ("00:00:00", "00:00:00.25", "00:00:01", "23:59:59.75")]
    events = [(3 * i + j, m) for i, m in enumerate(moments) for j in range(3)]
    spark.createDataFrame(events, "event_id long, ts string").selectExpr("event_id", "cast(ts as timestamp_ntz) as ts").write.parquet(f"{tmp_path}/events.parquet")
    c = duckdb.connect()
    c.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet/*.parquet'")
    compare(q.QUERIES[name](spark, str(tmp_path)), c.execute(q.ORACLE_SQL[name]))


def test_entry(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).count() >= 0
