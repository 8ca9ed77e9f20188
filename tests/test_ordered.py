"""Distributed ordered operators against brute force in pandas."""

import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from millwright.operators import ordered, quantiles, reshape, summaries
from millwright.sources.staging import stage


def hot_rows(n=600, seed=3):
    """Two thirds of the rows under one key, a null key, tied order values, many gaps."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = rng.choice(["hot", "hot", "hot", "hot", "a", "b", None])
        value = None if rng.random() < 0.4 else float(rng.randrange(50))
        rows.append((i, key, i // 3, value))
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="module")
def hot(spark):
    return spark.createDataFrame(hot_rows(), "id bigint, k string, t bigint, v double").cache()


@pytest.fixture(scope="module")
def frame():
    return pd.DataFrame(hot_rows(), columns=["id", "k", "t", "v"])


def test_chunks_split_a_hot_group(spark, hot):
    chunks = ordered.ordered_chunks(stage(hot, row_ids=True), ["k", "t"])
    sizes = [r["count"] for r in chunks.filter("k = 'hot'").groupBy(ordered.CHUNK).count().collect()]
    assert len(sizes) > 2
    assert max(sizes) < 250


def test_chunks_split_identical_rows(spark):
    copies = spark.range(500).select(F.lit("same").alias("k"))
    chunks = ordered.ordered_chunks(stage(copies, row_ids=True), ["k"])
    sizes = [r["count"] for r in chunks.groupBy(ordered.CHUNK).count().collect()]
    assert sum(sizes) == 500
    assert max(sizes) < 250


def test_running_sum_by_key(hot, frame):
    got = ordered.running_sum(
        hot, "id", ["t", "id"], partition_by=["k"], total="whole"
    ).toPandas()
    want = frame.sort_values("id")
    group = want.groupby("k", dropna=False)["id"]
    want = want.assign(run=group.cumsum(), whole=group.transform("sum"))
    merged = got.merge(want, on="id")
    assert len(merged) == len(frame)
    assert (merged["running_sum"] == merged["run"]).all()
    assert (merged["whole_x"] == merged["whole_y"]).all()


def test_running_sum_over_everything(hot, frame):
    got = ordered.running_sum(hot, F.lit(1), ["id"]).toPandas()
    assert (got["running_sum"] == got["id"] + 1).all()
    assert len(got) == len(frame)


def test_running_sum_of_gaps_crosses_chunks(hot, frame):
    got = ordered.running_sum(hot, "v", ["id"], partition_by=["k"]).toPandas().sort_values("id")
    want = frame.sort_values("id")
    # Null until the group's first value, then the sum so far, also at later gaps.
    seen = want.groupby("k", dropna=False)["v"]
    sums = seen.transform(lambda s: s.fillna(0).cumsum().where(s.notna().cummax()))
    np.testing.assert_array_equal(got["running_sum"].to_numpy(), sums.to_numpy())


def test_running_sum_of_few_values(spark):
    rows = spark.range(40).withColumn("v", F.when(F.col("id") % 10 == 0, 1))
    got = ordered.running_sum(rows, "v", ["id"]).orderBy("id").collect()
    assert [r["running_sum"] for r in got] == [i // 10 + 1 for i in range(40)]


def test_number_rows_is_gap_free(hot, frame):
    got = ordered.number_rows(hot, ["t"]).toPandas().sort_values("seq")
    assert list(got["seq"]) == list(range(1, len(frame) + 1))
    assert got["t"].is_monotonic_increasing


@pytest.mark.parametrize("keys", [[], ["k"]])
def test_fill_gaps(hot, frame, keys):
    got = ordered.fill_gaps(hot, ["v"], ["t", "id"], partition_by=keys).toPandas()
    want = frame.sort_values("id").copy()
    if keys:
        want["v"] = want.groupby("k", dropna=False)["v"].transform(lambda s: s.ffill().bfill())
    else:
        want["v"] = want["v"].ffill().bfill()
    got = got.sort_values("id")
    np.testing.assert_array_equal(got["v"].to_numpy(), want["v"].to_numpy())
    assert list(got.columns) == ["id", "k", "t", "v"]


def test_fill_gaps_across_many_empty_chunks(spark):
    df = spark.range(300).withColumn("v", F.when(F.col("id") == 150, 7.0))
    got = ordered.fill_gaps(df, ["v"], ["id"])
    assert got.filter("v = 7").count() == 300
    nothing = df.withColumn("v", F.lit(None).cast("double"))
    assert ordered.fill_gaps(nothing, ["v"], ["id"]).dropna().count() == 0


def test_exact_quantiles(hot, frame):
    shares = {"q0": 0.0, "q1": 0.25, "med": 0.5, "q9": 0.9, "q10": 1.0}
    got = quantiles.exact_quantiles(hot, "v", shares, by=["k"]).toPandas().set_index("k")
    for key, group in frame.dropna(subset=["v"]).groupby("k"):
        for name, share in shares.items():
            assert got.loc[key, name] == pytest.approx(np.quantile(group["v"], share), abs=1e-12)


def test_exact_medians_of_several_columns(hot, frame):
    got = {r["column"]: r["median"] for r in quantiles.exact_medians(hot, ["v", "t"]).collect()}
    assert got == {"v": frame["v"].median(), "t": frame["t"].median()}


def test_medians_of_empty_columns(spark):
    empty = spark.createDataFrame([(None,), (None,)], "v double")
    assert quantiles.exact_medians(empty, ["v"]).count() == 0


def test_roster_pages(spark):
    members = spark.range(25).select(
        F.when(F.col("id") < 20, "big").otherwise("small").alias("g"), F.col("id").alias("m")
    )
    rows = reshape.roster(members, "g", "m", page_size=8).orderBy("g", "page").collect()
    assert [(r["g"], r["page"], r["members"]) for r in rows] == [
        ("big", 0, 8), ("big", 1, 8), ("big", 2, 4), ("small", 0, 5),
    ]
    assert ",".join(r["roster"] for r in rows[:3]) == ",".join(map(str, range(20)))


@pytest.mark.parametrize("n", [1, 30, 199, 500])
def test_tail_extract(spark, n):
    df = spark.range(200).select(F.col("id"), (F.col("id") % 7).alias("x"))
    got = reshape.tail_extract(df, ["id"], n).collect()
    assert [r["id"] for r in got] == list(range(200))[-n:]
    by_text = reshape.tail_extract(df.select(F.col("id").cast("string")), ["id"], n)
    assert [r["id"] for r in by_text.collect()] == sorted(map(str, range(200)))[-n:]


def test_tail_extract_with_a_hot_leading_value(spark):
    df = spark.range(600).select(
        F.when(F.col("id") % 3 == 0, F.lit(9)).otherwise(F.col("id") % 9).alias("lead"), "id"
    )
    got = [tuple(r) for r in reshape.tail_extract(df, ["lead", "id"], 50).collect()]
    want = sorted((9 if i % 3 == 0 else i % 9, i) for i in range(600))[-50:]
    assert got == want


def test_tail_candidates_keep_too_many_rather_than_too_few(spark):
    df = spark.range(10_000).withColumn("lead", F.when(F.col("id") >= 100, F.col("id")))
    assert 200 <= reshape._tail_candidates(df, "lead", 200).count() < 1000
    nulls = df.withColumn("lead", F.lit(None).cast("bigint"))
    assert reshape._tail_candidates(nulls, "lead", 200).count() == 10_000


def test_surrogate_keys(hot, frame):
    keyed = reshape.surrogate_keys(hot, "DF", ["id"]).collect()
    assert {r["id"]: r["key"] for r in keyed} == {i: f"DF{i + 1:07d}" for i in frame["id"]}


def test_expand_units_by_blocks(spark, monkeypatch):
    monkeypatch.setattr(reshape, "EXPAND_BLOCK", 4)
    df = spark.createDataFrame([("a", 0), ("b", 1), ("c", 4), ("d", 9), ("e", None)], "p string, n bigint")
    got = reshape.expand_units(df, "n").groupBy("p").agg(F.sort_array(F.collect_list("unit_no")).alias("u"))
    assert {r["p"]: r["u"] for r in got.collect()} == {
        "b": [1], "c": [1, 2, 3, 4], "d": list(range(1, 10)),
    }


def test_expand_units_spreads_one_large_count(spark):
    df = spark.createDataFrame([("a", 3_000_000)], "p string, n bigint")
    units = reshape.expand_units(df, "n").select("unit_no", F.spark_partition_id().alias("task"))
    sizes = [r["count"] for r in units.groupBy("task").count().collect()]
    assert sum(sizes) == 3_000_000
    assert len(sizes) >= 4
    assert units.agg(F.countDistinct("unit_no")).first()[0] == 3_000_000


EXTREMES = [
    0.0, -0.0, 5e-324, -5e-324, 2.2250738585072009e-308, 2.2250738585072014e-308, 1.0, 2.0, 0.5,
    *(float(np.nextafter(a, b)) for a, b in ((1, 0), (1, 2), (2, 1), (1024, 0))),
    0.1, 1 / 3, 1e300, -1e300, 1.7976931348623157e308, -1.7976931348623157e308,
    float("inf"), float("-inf"), 4503599627370497.0, -3.0,
]


def test_buckets_order_as_the_doubles_do(spark):
    rng = np.random.default_rng(4)
    bits = rng.integers(0, 2047 << 52, 20_000).view(np.float64)
    powers = 2.0 ** np.arange(-1074, 1024)
    around = np.concatenate([powers, np.nextafter(powers, 0), np.nextafter(powers, np.inf)])
    close = 1.0 + rng.integers(0, 1 << 22, 5000) * 2.0**-52
    values = np.concatenate([EXTREMES, bits, -bits, around, -around, close])
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    rows = df.select("v", *[quantiles.leading("v", d).alias(f"d{d}") for d in (1, 12, 33)]).collect()
    ordered_rows = sorted(rows, key=lambda r: r["v"])
    for a, b in zip(ordered_rows, ordered_rows[1:], strict=False):
        assert all(x <= y for x, y in zip(a, b, strict=True))
    for row in rows:
        if math.isfinite(row["d12"]) and row["v"]:
            digits, _ = math.frexp(row["d12"])
            assert digits * 2**12 == int(digits * 2**12)
            assert abs(row["d12"] - row["v"]) <= abs(row["v"]) * 2.0**-12
    # Between 1 and 2 there are 2048 numbers of twelve digits, and 2 ** 21 of 33 in each.
    assert len({r["d12"] for r in rows if 1 <= r["d12"] < 2}) <= 2048


def test_quantiles_of_extreme_values(spark):
    df = spark.createDataFrame([(v,) for v in EXTREMES], "v double").repartition(3)
    ranked = sorted(EXTREMES)
    names = {f"q{i}": i / (len(ranked) - 1) for i in range(len(ranked))}
    got = quantiles.exact_quantiles(df, "v", names).first()
    assert [got[n] for n in names] == ranked


@pytest.mark.parametrize("seed", range(3))
def test_quantiles_of_crowded_values(spark, seed):
    """Values that differ in their last bits only, many times over, beside far ones."""
    rng = np.random.default_rng(seed)
    crowd = 1.0 + rng.integers(0, 40, 4000) * 2.0**-52
    values = np.concatenate([crowd, rng.normal(0, 1e6, 500), np.full(900, -7.25)])
    groups = rng.integers(0, 3, len(values))
    df = spark.createDataFrame([(int(g), float(v)) for g, v in zip(groups, values, strict=True)], "g int, v double")
    shares = {"a": 0.01, "b": 1 / 3, "c": 0.5, "d": 0.77, "e": 0.999}
    for row in quantiles.exact_quantiles(df.repartition(4), "v", shares, by=["g"]).collect():
        own = np.sort(values[groups == row["g"]])
        for name, share in shares.items():
            at = (len(own) - 1) * share
            low, high = own[int(np.floor(at))], own[int(np.ceil(at))]
            assert low <= row[name] <= high
            assert row[name] == low + (high - low) * (at - np.floor(at))


def test_quantiles_keep_a_null_group(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 5.0), ("a", float("nan")), ("b", None)], "k string, v double")
    got = quantiles.exact_quantiles(df, "v", {"m": 0.5}, by=["k"]).collect()
    assert sorted(map(tuple, got), key=repr) == [("a", 5.0), (None, 2.0)]


def test_what_is_kept_between_passes_does_not_grow_with_the_rows(spark, monkeypatch):
    """A million rows around one value: the staged buckets stay a handful."""
    staged = []
    monkeypatch.setattr(quantiles, "stage", lambda df: staged.append(stage(df)) or staged[-1])
    df = spark.range(1_000_000).select((100 + F.col("id") / 1e9).alias("v"))
    got = quantiles.exact_quantiles(df, "v", {"m": 0.5}).first()["m"]
    low, high = (100 + np.array([499_999, 500_000]) / 1e9).tolist()
    assert got == low + (high - low) * 0.5
    values, *buckets = staged
    assert values.count() == 1_000_000
    assert [b.count() <= 2 for b in buckets] == [True, True]


def test_quartiles_without_broadcast(spark, hot, frame):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        test_box_stats_of_a_hot_group(hot, frame)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_box_stats_of_a_hot_group(hot, frame):
    rows = {r["k"]: r for r in summaries.box_stats(hot, ["k"], "v").collect()}
    values = frame[frame["k"] == "hot"]["v"].dropna()
    q1, q3 = np.quantile(values, [0.25, 0.75])
    assert (rows["hot"]["n"], rows["hot"]["q1"], rows["hot"]["q3"]) == (len(values), q1, q3)


def test_quantile_of_an_ungrouped_column(hot, frame):
    row = quantiles.exact_quantiles(hot, "v", {"q": 0.3}).first()
    assert row["q"] == pytest.approx(np.quantile(frame["v"].dropna(), 0.3))
