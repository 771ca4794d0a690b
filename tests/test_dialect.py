import datetime as dt

import pytest
from feeds import crm

from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.functions import dialect as D
from millrace.operators import gold, silver
from millrace.sources import bronze


def one(spark, **cols):
    return spark.range(1).select(*[c.alias(n) for n, c in cols.items()]).first().asDict()


def test_iso_ts_takes_only_iso(spark):
    rows = spark.createDataFrame([("2025-05-20T12:14:56.409000",), ("2025-05-20T12:14:56+00:00",), ("2025-05-20T08:14:56-04:00",), ("2025",), ("12:00",), ("x",), (None,)], "s string").select(D.iso_ts("s").alias("t")).collect()
    assert [r.t for r in rows] == [dt.datetime(2025, 5, 20, 12, 14, 56, 409000), dt.datetime(2025, 5, 20, 12, 14, 56), dt.datetime(2025, 5, 20, 12, 14, 56), None, None, None, None]


def test_rounding_ratios_and_greatest(spark):
    r = one(spark, a=D.round_to(F.lit(1.005), 2), b=D.ratio_to(F.lit(1), F.lit(3), 4), c=D.ratio(F.lit(1), F.lit(0)), d=D.greatest_strict(F.lit(1.0), F.lit(None).cast("double")), e=D.greatest_strict(F.lit(1.0), F.lit(2.0)))
    assert r == {"a": 1.0, "b": 0.3333, "c": None, "d": None, "e": 2.0}


def test_text_helpers(spark):
    r = one(spark, a=D.norm_email(F.lit("\t Ann@X.Com \n")), b=D.not_blank(F.lit(" \t")), c=D.last_segment(F.lit("https://a/b/c//")), d=D.last_segment(F.lit("")), e=D.stem(F.lit("/x/y/abc.json")), f=D.stem(F.lit("/x/y/abc.txt")))
    assert r == {"a": "ann@x.com", "b": False, "c": "c", "d": None, "e": "abc", "f": None}


def test_zones_and_weekdays(spark):
    t = F.lit("2025-07-09 03:30:00").cast("timestamp")
    r = one(spark, d=D.local_date(t), h=D.hour_of(D.local_ts(t)), w=D.iso_dow(t), bad=D.local_ts(t, D.known_zone(F.lit("nonsense"))), week=D.week_start(t))
    assert r == {"d": dt.date(2025, 7, 8), "h": 23, "w": 3, "bad": None, "week": dt.date(2025, 7, 7)}


def test_json_fields_parse_once(spark):
    raw = '{"a": {"b.c": 1e3, "o": {"x": 1}, "n": 7}, "d": [1, 2]}'
    df = spark.createDataFrame([(raw,), ("not json",), (None,)], "raw string")
    out = D.json_fields(df, {"bc": ("a", "b.c"), "o": ("a", "o"), "n": ("a", "n"), "d": ("d",)}, documents=("d",)).collect()
    assert out[0]["n"] == "7" and float(out[0]["bc"]) == 1000.0 and out[0]["o"] is None and out[0]["d"] == "[1,2]"
    assert out[1].asDict() == out[2].asDict() == {"bc": None, "o": None, "n": None, "d": None}


def test_latest_by_puts_nulls_last(spark):
    df = spark.createDataFrame([("k", None, 1), ("k", 5, 2), ("k", 5, 3)], "k string, t int, i int")
    assert D.latest_by(df, ["k"], [D.desc("t"), D.desc("i")]).first()["i"] == 3


def test_json_scalars_know_their_types(spark):
    """A string is a string, whatever it looks like."""
    values = {'"[VIP] Jane"': "[VIP] Jane", '"{{x}}"': "{{x}}", '"[1]"': "[1]", '{"a":1}': None, "[1]": None, "[]": None, "7": "7", "1.50": "1.5", "true": "true", "null": None, '""': "", '" a\\n"': " a\n", "12345678901234567890123": "12345678901234567890123"}
    df = spark.createDataFrame([(k, f'{{"o": {{"v.w": {k}}}}}') for k in values], "k string, raw string")
    fields = {r.k: r.v for r in D.json_fields(df, {"v": ("o", "v.w")}, keep=("k",)).collect()}
    assert fields == values
    assert {r.k: r.v for r in df.select("k", D.json_scalar("raw", "$.o['v.w']").alias("v")).collect()} == values
    assert D.keys_of("$.a['b.c'].d") == ("a", "b.c", "d")
    with pytest.raises(ValueError):
        D.keys_of("$.a[0]")


def test_no_builder_parses_a_line_twice(spark, land):
    """One parse for each scan of a feed in the optimised plans of all Silver tables, and of what is filtered and joined after them."""
    root = land("crm/events/dt=2025-05-20/a.json", [crm("ev_1")])
    land("seeds/channel_map/map.ndjson", [{"event_type": "e", "channel": "c", "is_paid": True}])
    feeds = {n: spark.createDataFrame([], "raw string, dt string, asof string, source_path string") for n in bronze.CATALOG}
    made = {}
    for name, builder in silver.BUILDERS.items():
        made[name] = builder(silver.BuildContext("b", "2025-07-12", "cf"), feeds, *([made["dim_lead"]] if name == "dq_lead_coverage" else []))
        for df in (made[name], made[name].where("build_date is not null").where(F.col(made[name].columns[0]).isNotNull())):
            plan = df._jdf.queryExecution().optimizedPlan().toString()
            scans = plan.count("LogicalRDD") + plan.count("LocalRelation")
            assert 0 < plan.count("from_json(StructField") <= scans, (name, plan)
            for line in plan.splitlines():
                assert "from_json(StructField" not in line or "Generate" in line, (name, line)
    assert bronze.read(spark, root, "crm_event").count() == 1


@pytest.mark.parametrize("rows, buckets", [(0, 4), (1, 4), (300, 4), (300, 64), (3000, 8)])
def test_ranks_of_all_rows(spark, rows, buckets):
    """Equal to rank() over one partition, with ties across every border, one value that a third of the rows have, and nulls."""
    v = F.when(F.col("id") % 3 == 0, 5.5).when(F.col("id") % 7 != 0, (F.col("id") * 7919 % 101) / 4.0)
    df = spark.range(rows).select("id", v.alias("v"))
    want = df.select("id", F.rank().over(Window.orderBy(D.desc("v"))).cast("long").alias("r"))
    got = D.ranked(df, -F.col("v"), "r", buckets)
    assert got.columns == ["id", "v", "r"]
    assert sorted(map(tuple, got.select("id", "r").collect())) == sorted(map(tuple, want.collect()))


def test_rank_has_no_single_partition(spark):
    """The window of host load is dealt by bucket, and no sort is global."""
    df = spark.range(50).select(F.col("id").cast("string").alias("host_user_uri"), F.lit("n").alias("host_name"), F.lit("e").alias("host_email"), F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("meeting_date_est"))
    out = gold.meeting_load_by_employee(silver.BuildContext("b", "2024-02-01"), {"fct_booking_host": df})
    plan = out._jdf.queryExecution().sparkPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert len(windows) == 1 and windows[0].count("__b") >= 1 and "RunningWindowFunction" not in windows[0]
    assert "rank(" not in plan and out.count() == 50
