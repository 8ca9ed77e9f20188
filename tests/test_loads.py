"""Keys across loads, and gaps of slots as intervals, against plain Python."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from millwright.operators import membership, registry, reshape
from millwright.operators.cleaning import dedupe
from millwright.sources.publishing import PublishConflict, published_set

KEYS = ["a", "b"]


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(2)
    rows = []
    for i in range(3000):
        a = rng.choice([None, 0, 0, 0, rng.randrange(800)])
        rows.append((a, rng.choice([None, "x", "y"]), float(i)))
    return spark.createDataFrame(rows, "a bigint, b string, v double").repartition(5).cache()


def test_a_filter_misses_no_key_and_hits_few_others(spark):
    old = spark.range(20_000).select((F.col("id") * 7).alias("k"))
    words = membership.words_for(20_000)
    filled = membership.key_filter(old, ["k"], words)
    assert filled.count() <= words
    assert membership.maybe_known(old, ["k"], filled, words).count() == 20_000
    others = spark.range(50_000).select((F.col("id") * 7 + 3).alias("k"))
    assert membership.maybe_known(others, ["k"], filled, words).count() < 50_000 * 0.02


def test_filters_of_nothing(spark):
    none = spark.range(0).select(F.col("id").alias("k"))
    filled = membership.key_filter(none, ["k"], membership.words_for(0))
    assert membership.maybe_known(spark.range(5).toDF("k"), ["k"], filled, 1).count() == 0
    assert membership.known_keys(none, none, ["k"], filled, 1).count() == 0


@pytest.mark.parametrize("words", [1, 7, 800])
@pytest.mark.parametrize("hits", [0, 200_000])
def test_two_loads_give_what_one_dedupe_gives(spark, table, words, hits, monkeypatch):
    """Also with a filter too small to tell anything, and with hits too many to broadcast."""
    monkeypatch.setattr(membership, "BROADCAST_HITS", hits)
    first, second = table.filter("v % 3 <> 0"), table.filter("v % 3 = 0")
    kept = dedupe(first, KEYS, ["v"])
    filled = membership.key_filter(kept, KEYS, words)
    new = membership.dedupe_load(kept, second, KEYS, filled, words, ["v"])
    order = table.withColumn("late", (F.col("v") % 3 == 0).cast("int"))
    want = dedupe(order, KEYS, ["late", "v"]).drop("late")
    assert rows_of(kept.unionByName(new)) == rows_of(want)


def test_the_old_table_is_not_shuffled(spark, table, tmp_path):
    dedupe(table, KEYS, ["v"]).write.parquet(str(tmp_path / "old"))
    old = spark.read.parquet(str(tmp_path / "old"))
    words = membership.words_for(old.count())
    filled = membership.key_filter(old, KEYS, words)
    seen = []
    plain = membership.stage
    membership.stage = lambda df: seen.append(df) or plain(df)
    try:
        membership.known_keys(old, table, KEYS, filled, words)
    finally:
        membership.stage = plain
    plan = seen[-1]._jdf.queryExecution().executedPlan().toString()
    head = plan.split("tmp_path")[0]
    assert "BroadcastNestedLoopJoin" not in plan and "BroadcastHashJoin" in plan
    # The one shuffle is that of the distinct keys found, above the join.
    assert head.index("BroadcastHashJoin") > head.index("Exchange hashpartitioning")
    assert head.count("Exchange hashpartitioning") == 1


def numbers(rows):
    return {r[0]: r[1] for r in rows}


def test_registered_keys_stay(spark, tmp_path):
    folder = str(tmp_path / "keys")
    first = spark.createDataFrame([("m",), ("c",), ("x",), ("c",), (None,)], "k string")
    assert registry.register(first, ["k"], folder) == 3
    assert registry.register(first, ["k"], folder) == 0
    assert published_set(spark, folder).version == 1
    second = spark.createDataFrame([("a",), ("m",), ("z",), ("b",)], "k string")
    assert registry.register(second, ["k"], folder) == 3
    want = {"c": "K001", "m": "K002", "x": "K003", "a": "K004", "b": "K005", "z": "K006"}
    everything = first.union(second).distinct()
    keyed = registry.with_registered_keys(everything, ["k"], folder, "K", width=3)
    assert numbers(keyed.collect()) == {**want, None: None}
    seqs = sorted(r["seq"] for r in registry.registered(spark, folder).collect())
    assert seqs == list(range(1, 7))


def test_registering_in_another_order_and_over_many_loads(spark, tmp_path):
    folder = str(tmp_path / "keys")
    rows = spark.range(600).select((F.col("id") % 200).alias("k"), F.lit("x").alias("seq"))
    for k in (5, 3, 2):
        registry.register(rows.filter(F.col("k") % k == 0), ["k"], folder, [F.col("k").desc()])
    got = numbers(registry.registered(spark, folder).select("k", "seq").collect())
    order = []
    for k in (5, 3, 2):
        order += [i for i in range(199, -1, -1) if i % k == 0 and i not in order]
    assert got == {k: i + 1 for i, k in enumerate(order)}


def test_nothing_is_registered_by_a_load_that_fails(spark, tmp_path):
    folder = str(tmp_path / "keys")
    assert registry.registered(spark, folder) is None
    bad = spark.range(9).select(F.when(F.col("id") == 8, F.raise_error(F.lit("lost"))).otherwise(F.col("id").cast("string")).alias("k"))
    with pytest.raises(Exception, match="lost"):
        registry.register(bad, ["k"], folder)
    assert registry.registered(spark, folder) is None
    unkeyed = registry.with_registered_keys(spark.range(2).toDF("k"), ["k"], folder, "K")
    assert [r["key"] for r in unkeyed.collect()] == [None, None]


def test_a_registry_that_changed_meanwhile_is_not_written(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "keys")
    registry.register(spark.range(3).toDF("k"), ["k"], folder)
    plain = registry.number_rows

    def meanwhile(*args, **kwargs):
        monkeypatch.setattr(registry, "number_rows", plain)
        registry.register(spark.range(5).toDF("k"), ["k"], folder)
        return plain(*args, **kwargs)

    monkeypatch.setattr(registry, "number_rows", meanwhile)
    with pytest.raises(PublishConflict):
        registry.register(spark.range(9).toDF("k"), ["k"], folder)
    assert sorted(r["seq"] for r in registry.registered(spark, folder).collect()) == [1, 2, 3, 4, 5]


def day(n):
    return dt.date(2024, 2, 25) + dt.timedelta(days=n)


def test_gaps_of_slots(spark):
    rng = random.Random(5)
    rows = [(m, day(d), s) for m in "abc" for s in (0, 1) for d in range(30) if rng.random() < 0.6]
    rows += [("a", day(0), 0), ("c", day(29), 1), ("a", None, 0), (None, day(3), 0), ("z", day(4), 0), ("a", day(3), 7)]
    production = spark.createDataFrame(rows * 2, "machine_id string, date date, shift_id int")
    machines = spark.createDataFrame([("a",), ("b",), ("c",), ("idle",), ("a",)], "id string")
    found = reshape.missing_intervals(machines, "id", production, [0, 1])
    got = {}
    for r in found.collect():
        assert r["days"] == (r["last"] - r["first"]).days + 1
        for k in range(r["days"]):
            slot = (r["machine_id"], r["first"] + dt.timedelta(days=k), r["shift_id"])
            assert slot not in got
            got[slot] = 1
    have = set(rows)
    want = {(m, day(d), s) for m in ("a", "b", "c", "idle") for s in (0, 1) for d in range(30)} - have
    assert set(got) == want
    # Neighbouring intervals do not touch.
    ends = {(r["machine_id"], r["shift_id"], r["last"]) for r in found.collect()}
    assert not any((r["machine_id"], r["shift_id"], r["first"] - dt.timedelta(days=1)) in ends for r in found.collect())


def test_gaps_without_any_production(spark):
    none = spark.createDataFrame([], "machine_id string, date date, shift_id int")
    machines = spark.createDataFrame([("a",)], "id string")
    assert reshape.missing_intervals(machines, "id", none, [0]).collect() == []


def test_no_row_is_made_for_a_slot(spark):
    """Forty years of one record each at both ends: two edges, one gap."""
    rows = [("a", dt.date(1984, 1, 1), 0), ("a", dt.date(2024, 1, 1), 0)]
    production = spark.createDataFrame(rows, "machine_id string, date date, shift_id int")
    machines = spark.createDataFrame([("a",)], "id string")
    gaps = reshape.missing_intervals(machines, "id", production, [0]).collect()
    assert [tuple(r)[2:] for r in gaps] == [(dt.date(1984, 1, 2), dt.date(2023, 12, 31), 14609)]
