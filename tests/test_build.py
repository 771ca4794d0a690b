import json
import threading
import time

import pytest
from feeds import FUNNEL, crm

from millrace.operators import silver
from millrace.plans import build, serve
from millrace.sources import bronze
from millrace.streaming import alerts


@pytest.fixture
def root(land):
    land("crm/events/dt=2025-05-20/a.json", [crm("ev_1")])
    return land("seeds/custom_field_map/map.ndjson", [{"field_id": FUNNEL, "field_name": "funnel"}])


def test_build_swaps_and_prunes(spark, root, tmp_path):
    out = str(tmp_path / "wh")
    calls = []
    for n in range(3):
        s = build.build(spark, root, out, "2025-07-12", f"2025071{n}t000000", before=calls.append, keep=2)
    assert len(s.swapped) == 18 and calls == ["2025-07-12"] * 3
    assert build.versions(spark, "silver", "fct_booking") == ["fct_booking__20250712t000000", "fct_booking__20250711t000000"]
    assert "silver.fct_booking_host__20250710t000000" in s.pruned and (tmp_path / "wh/silver/dim_lead/build=20250710t000000").exists()
    assert serve.silver(spark, "dim_lead", where="lead_id = 'lead_1'", order_by="lead_id DESC", limit=5).first()["funnel"] == "VSL"
    assert serve.gold(spark, "daily_calls_by_source").count() == 0


def test_failure_swaps_nothing(spark, root, tmp_path):
    def broken(ctx, tables, *same):
        raise ValueError("no such thing")

    build.build(spark, root, str(tmp_path / "wh2"), "2025-07-12", "20250601t000000")
    layers = {"silver": {"dim_lead": silver.dim_lead, "fct_spend": broken}, "gold": {"x": broken}}
    with pytest.raises(build.BuildFailed, match="silver.fct_spend"):
        build.build(spark, root, str(tmp_path / "wh2"), "2025-07-12", "20990101t000000", layers=layers)
    assert [r["tableName"] for r in spark.sql("SHOW TABLES IN silver LIKE 'dim_lead__20990101*'").collect()] == ["dim_lead__20990101t000000"]  # built
    assert "20990101t000000" not in spark.sql("SHOW CREATE TABLE silver.dim_lead").first()[0]  # but not swapped in


def test_owner_snapshot_goes_first(spark, root, tmp_path):
    state = str(tmp_path / "state")
    owner = [("lead_1", "Bob", "a@x", "VSL", "Ann", "Potential", "2025-05-20", 5)]
    alerts.StateTable(spark, f"{state}/owners", alerts.OWNERS).write(spark.createDataFrame(owner, alerts.OWNERS))
    build.build(spark, root, str(tmp_path / "wh"), "2025-07-12", "20980101t000000", before=build.owner_snapshot(spark, state, root))
    got = serve.silver(spark, "dim_lead", where="lead_id = 'lead_1'").first()
    assert got["has_owner"] and got["enrichment_status"] == "ENRICHED"

    def broken(asof):
        raise OSError("no state")

    with pytest.raises(OSError):
        build.build(spark, root, str(tmp_path / "wh"), "2025-07-12", "20980102t000000", before=broken)
    assert not build.versions(spark, "silver", "dim_lead")[0].endswith("20980102t000000")


def test_order_and_missing_seed(spark, tmp_path):
    names = build.ordered(silver.BUILDERS)
    assert names.index("dim_lead") < names.index("dq_lead_coverage")
    with pytest.raises(ValueError):
        build.ordered({})
    with pytest.raises(LookupError):
        build.build(spark, str(tmp_path / "empty"), str(tmp_path / "wh3"), "2025-07-12", "x")


def quick(ctx, tables, *same):
    return tables["crm_event"].select("raw")


def shown(spark, names):
    return {n: build.current_build(spark, "silver", n) for n in names}


def test_a_slow_table_is_cancelled_alone(spark, root, tmp_path):
    """The slow one fails by name and its jobs are gone; the others are built at the same time; no view changes."""
    names = {n: quick for n in ("fast_a", "fast_b", "fast_c")}

    def slow(ctx, tables, *same):
        def crawl(frames):
            for f in frames:
                time.sleep(120)
                yield f

        return spark.range(4).mapInPandas(crawl, "id long")

    out = str(tmp_path / "wh")
    build.build(spark, root, out, "2025-07-12", "a1", layers={"silver": names | {"slow": quick}})
    began = time.monotonic()
    with pytest.raises(build.BuildFailed, match="silver.slow failed|slow.*took longer than 8 s") as e:
        build.build(spark, root, out, "2025-07-12", "a2", layers={"silver": {"slow": slow} | names, "gold": {"x": quick}}, seconds=8)
    assert time.monotonic() - began < 60 and "fast_a" not in str(e.value)
    assert shown(spark, ["slow", *names]) == dict.fromkeys(["slow", *names], "a1")
    assert all(spark.catalog.tableExists(f"silver.{n}__a2") for n in names) and not spark.catalog.tableExists("gold.x__a2")
    end = time.monotonic() + 30
    while spark.sparkContext.statusTracker().getActiveJobsIds() and time.monotonic() < end:
        time.sleep(0.2)
    assert spark.sparkContext.statusTracker().getActiveJobsIds() == []


def test_tables_are_built_at_once(spark):
    """Four that wait for each other are done; whoever reads a table of the build comes after it; a failed source fails its reader."""
    meet = threading.Barrier(4, timeout=30)
    one = spark.range(1)
    made, failed = build.build_layer(spark, "l", {f"t{k}": None for k in range(4)}, lambda n, made: (meet.wait(), one)[1], "b", at_once=4)
    assert list(made) == ["t0", "t1", "t2", "t3"] and failed == {}
    seen = {}
    made, failed = build.build_layer(spark, "l", {"dq_lead_coverage": None, "dim_lead": None}, lambda n, made: (seen.__setitem__(n, sorted(made)), one)[1], "b")
    assert seen == {"dim_lead": [], "dq_lead_coverage": ["dim_lead"]}

    def broken(name, made):
        raise ValueError("no such thing")

    assert set(build.build_layer(spark, "l", {"dq_lead_coverage": None, "dim_lead": None}, broken, "b")[1]) == {"dim_lead", "dq_lead_coverage"}


@pytest.mark.parametrize("dies", [False, True])
def test_a_swap_that_stops_half_way(spark, root, tmp_path, monkeypatch, dies):
    """The fifth view can't be swapped: the first four go back. If the process dies there, the next start finishes the swap."""
    names = [f"half{k}_{dies}".lower() for k in range(6)]
    layers, out = {"silver": {n: quick for n in names}}, str(tmp_path / "wh")
    build.build(spark, root, out, "2025-07-12", "c1", layers=layers)
    real, count = build.swap_view, [0]

    def stops(*args):
        count[0] += 1
        if count[0] >= 5 and (dies or count[0] == 5):
            raise KeyboardInterrupt if dies else OSError("catalog is away")
        real(*args)

    monkeypatch.setattr(build, "swap_view", stops)
    with pytest.raises(KeyboardInterrupt if dies else OSError):
        build.build(spark, root, out, "2025-07-12", "c2", layers=layers)
    monkeypatch.setattr(build, "swap_view", real)
    if dies:
        assert len(set(shown(spark, names).values())) == 2  # half-way
        with pytest.raises(build.BuildFailed, match="recover first"):
            build.publish(spark, out, "silver", names, "c1")
        assert build.recover(spark, out) == ["silver"]
    assert shown(spark, names) == dict.fromkeys(names, "c2" if dies else "c1")
    assert build.recover(spark, out) == []
    build.build(spark, root, out, "2025-07-12", "c3", layers=layers)
    assert shown(spark, names) == dict.fromkeys(names, "c3")


def test_a_swap_that_cannot_be_finished_goes_back(spark, root, tmp_path):
    out, names = str(tmp_path / "wh"), ["back0", "back1"]
    build.build(spark, root, out, "2025-07-12", "d1", layers={"silver": {n: quick for n in names}})
    bronze.create_new(spark, build._journal(out, "silver"), json.dumps({"build": "gone", "before": {"back0": "d1", "back1": None}}))
    assert build.recover(spark, out) == ["silver"] and shown(spark, names) == {"back0": "d1", "back1": None}


def jobs(spark, work):
    tag = f"t{time.monotonic_ns()}"
    spark.sparkContext.setJobGroup(tag, tag)
    try:
        work()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(tag))
    finally:
        spark.sparkContext.setJobGroup("", "")


def test_served_results_are_kept(spark, root, tmp_path):
    """The second read runs no job; another query, a new build and time do; pages are full and in order."""
    out, clock = str(tmp_path / "wh"), [0.0]
    size = [2500]
    layers = {"gold": {"served": lambda ctx, tables: spark.range(size[0]).withColumnRenamed("id", "n")}}
    build.build(spark, root, out, "2025-07-12", "e1", layers=layers)
    results = serve.Results(spark, str(tmp_path / "served"), clock=lambda: clock[0])
    ask = lambda **how: [p.column("n").to_pylist() for p in results.pages(serve.gold(spark, "served", order_by="n DESC", **how))]
    got = []
    assert jobs(spark, lambda: got.extend(ask())) > 0
    assert [len(p) for p in got] == [1000, 1000, 500] and sum(got, []) == list(range(2499, -1, -1))
    again = []
    assert jobs(spark, lambda: again.extend(ask())) == 0 and again == got
    assert jobs(spark, lambda: ask(limit=10)) > 0 and jobs(spark, lambda: ask(limit=10)) == 0
    clock[0] = 599.0
    assert jobs(spark, ask) == 0
    clock[0] = 600.0
    assert jobs(spark, ask) > 0 and len(bronze.children(spark, str(tmp_path / "served"))) == 1
    size[0] = 3
    build.build(spark, root, out, "2025-07-12", "e2", layers=layers)
    assert ask() == [[2, 1, 0]]
    assert list(results.pages(serve.gold(spark, "served", where="n < 0"))) == []
