import threading

import pytest
from pyspark.sql import functions as F

from millrace.sources import bronze, state
from millrace.sources.state import Conflict, StateTable

SCHEMA = "k string, n int"


def rows(t):
    return sorted((r.k, r.n) for r in t.read().collect())


def test_state_forgets_old_versions(spark, tmp_path):
    t = StateTable(spark, str(tmp_path / "t"), "k string")
    for n in range(6):
        t.write(spark.createDataFrame([(str(n),)], "k string"))
    assert [r.k for r in t.read().collect()] == ["5"] and len(t._versions()) == state.KEEP_VERSIONS
    assert len(bronze.children(spark, f"{t.path}/data")) == state.KEEP_VERSIONS


def test_changes_replace_and_remove(spark, tmp_path):
    t = StateTable(spark, str(tmp_path / "t"), SCHEMA)
    assert rows(t) == [] and t.version() == -1
    t.update(lambda r: spark.createDataFrame([("a", 1), ("b", 2)], SCHEMA))
    t.update(lambda r: r.where("k = 'a'").withColumn("n", F.col("n") + 10))
    t.update(lambda r: r.where("k = 'b'").withColumn("__gone", F.lit(True)))
    assert rows(t) == [("a", 11)]
    t.update(lambda r: spark.createDataFrame([("b", 5), ("b", 7)], SCHEMA))  # one row a key stays
    assert rows(t) == [("a", 11), ("b", 7)] and t.version() == 3


def test_many_changes_are_gathered(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(state, "COMPACT", 3)
    t = StateTable(spark, str(tmp_path / "t"), SCHEMA)
    for n in range(14):
        t.update(lambda r: spark.createDataFrame([(f"k{n % 5}", n)], SCHEMA))
        assert len(t._recent()[1]) < 3
    assert rows(t) == [("k0", 10), ("k1", 11), ("k2", 12), ("k3", 13), ("k4", 9)]
    assert len(t._versions()) <= state.KEEP_VERSIONS * 4


def test_a_commit_names_what_it_read(spark, tmp_path):
    t = StateTable(spark, str(tmp_path / "t"), SCHEMA)
    t.write(spark.createDataFrame([("a", 3)], SCHEMA))
    v, mine = t.snapshot()
    _, other = t.snapshot()
    t.commit(v, mine.withColumn("n", F.col("n") + 1))
    with pytest.raises(Conflict):
        t.commit(v, other.withColumn("n", F.col("n") + 1))
    with pytest.raises(Conflict):
        t.commit(-1, other)
    assert rows(t) == [("a", 4)]


def test_writers_at_once_lose_nothing(spark, tmp_path):
    """Six writers add one each to the same row and a row of their own, all from the same version."""
    t = StateTable(spark, str(tmp_path / "t"), SCHEMA)
    t.write(spark.createDataFrame([("a", 0)], SCHEMA))
    start, tries = threading.Barrier(6, timeout=60), []

    def add(k):
        first = [True]

        def change(r):
            tries.append(k)
            out = r.where("k = 'a'").withColumn("n", F.col("n") + 1).unionByName(spark.createDataFrame([(f"w{k}", k)], SCHEMA))
            if first.pop() if first else False:
                start.wait()
            return out

        t.update(change)

    many = [threading.Thread(target=add, args=(k,)) for k in range(6)]
    [m.start() for m in many]
    [m.join() for m in many]
    assert rows(t) == [("a", 6)] + [(f"w{k}", k) for k in range(6)] and len(tries) > 6


def test_a_file_is_made_once(spark, tmp_path):
    path, told = str(tmp_path / "x/one"), []
    many = [threading.Thread(target=lambda k=k: told.append((bronze.create_new(spark, path, str(k)), str(k)))) for k in range(12)]
    [m.start() for m in many]
    [m.join() for m in many]
    winner = [k for made, k in told if made]
    assert len(told) == 12 and winner == [bronze.read_text(spark, path)] and bronze.children(spark, str(tmp_path / "x")) == ["one"]
