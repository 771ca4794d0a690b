"""Each showcase query against the SQL that says the same."""

import glob
import math
import os

import duckdb
import pytest
from conftest import SMALL

from millrace.plans import edge_showcase, feed_showcase, serve, showcase

QUERIES = showcase.QUERIES | feed_showcase.QUERIES | edge_showcase.QUERIES
SQL = showcase.SQL | feed_showcase.SQL | edge_showcase.SQL


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for p in glob.glob(f"{SMALL}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return con


def canon(pdf, cols):
    def text(v):
        if v is None or v != v:
            return "-"
        if isinstance(v, float):
            return f"{v:.9g}" if math.isfinite(v) else str(v)
        return str(v).replace(" 00:00:00", "")

    return sorted(tuple(text(v) for v in r) for r in pdf[cols].astype(object).itertuples(index=False))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    got, want = QUERIES[name](spark, SMALL).toPandas(), duck.execute(SQL[name]).df()
    cols = sorted(got.columns)
    assert cols == sorted(want.columns)
    assert len(got) > 0 and canon(got, cols) == canon(want, cols)


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


def test_headlines(spark):
    e = spark.createDataFrame([("a", 6455, 48), ("b", 44, 18)], "media_name string, load_count long, play_count long")
    assert {r.media_name: round(r.play_rate, 4) for r in serve.play_rates(e).collect()} == {"a": 0.0074, "b": 0.4091, None: 0.0102}
    s = spark.createDataFrame([("p", 9, 1, "x", 2), ("p", 9, 1, "y", 3), ("q", 9, 1, "x", 9)], "perspective string, hour_of_day long, day_of_week long, channel string, bookings long")
    assert [(r.bookings, r.dow_label) for r in serve.heatmap(s, "p").collect()] == [(5, "Mon")]
    f = spark.createDataFrame([("other", 4, 2, 1), ("x", 0, 0, 0)], "channel string, bookings long, bookings_with_email long, bookings_with_prior_video long")
    assert {r.channel_label: r.email_coverage for r in serve.funnel_by_channel(f).collect()} == {"Other / organic": 0.5, "x": None}
