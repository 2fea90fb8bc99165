"""Hot keys: split and salted plans give the results of the plain ones."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ballast.functions.skew import SEGMENT, cuts, hot_keys, lookup_join, split_hot
from ballast.operators import history, liquidation, positions
from ballast.operators.asof import as_of
from ballast.params import Scale
from tests.conftest import rows
from tests.test_plans import plan

HOT = Scale(hot_rows=8, salts=4)
T0 = datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def ticks(spark):
    """One symbol holds over a third of the ticks, in days of very different size."""
    rnd, out = random.Random(3), []
    for n in range(400):
        symbol = "HOT" if n % 5 < 2 else f"S{rnd.randrange(40)}"
        day = rnd.choice([0, 0, 0, 1, 2, 3, 5, 8, 13, 14, 15, 16, 30, 31])
        ts = T0 + timedelta(days=day, minutes=rnd.randrange(0, 600, 30))
        out.append((symbol, round(rnd.uniform(1, 9), 3), ts, n))
    # many days of a single tick: a window has to reach back over many segments
    out += [("HOT", 5.0 + d / 7, T0 + timedelta(days=40 + d), 1000 + d) for d in range(45)]
    return spark.createDataFrame(out, "symbol STRING, price DOUBLE, ts TIMESTAMP_NTZ, seq BIGINT").cache()


ORDER = ["ts", "seq", "price"]


def rounded(df, *names):
    return rows(df.withColumns({n: F.round(n, 9) for n in names}))


def test_hot_key_is_found(ticks):
    assert [r.symbol for r in hot_keys(ticks, ["symbol"], Scale(hot_rows=100)).collect()] == ["HOT"]


def test_returns(ticks):
    plain = Window.partitionBy("symbol").orderBy(*ORDER)
    want = ticks.withColumn("return", (F.col("price") - F.lag("price").over(plain)) / F.lag("price").over(plain))
    assert rounded(history.price_returns(ticks, scale=HOT), "return") == rounded(want, "return")


def test_only_hot_keys_are_spread(ticks, no_broadcast):
    """A lookup as long as the list of keys is not shuffled once for every salt."""
    nobody = ticks.limit(3).withColumn("symbol", F.lit(None).cast("string"))
    left = ticks.unionByName(nobody)
    names = ticks.select("symbol").distinct().withColumn("name", F.concat(F.lit("n"), "symbol")).filter("symbol <> 'S7'")
    hot = hot_keys(ticks, ["symbol"], Scale(hot_rows=100))
    for how in ("left", "inner", "left_semi"):
        got = lookup_join(left, names, "symbol", spread=["seq"], how=how, scale=HOT, hot=hot)
        assert rows(got) == rows(left.join(names, "symbol", how))
    spreading = lambda df: [line for line in plan(df).split("\n") if "Generate explode" in line]
    assert spreading(got) and all("_hot" in line for line in spreading(got))  # not every key four times


def test_rolling_volatility(ticks):
    plain = Window.partitionBy("symbol").orderBy(*ORDER)
    want = ticks.withColumn(
        "return", (F.col("price") - F.lag("price").over(plain)) / F.lag("price").over(plain)
    ).withColumn("volatility", F.stddev_samp("return").over(plain.rowsBetween(-30, 0)))
    got = history.rolling_volatility(ticks, scale=HOT).drop("volatility_annual")
    assert rounded(got, "return", "volatility") == rounded(want, "return", "volatility")


def test_latest_volatility_is_the_last_rolling_one(ticks):
    last = Window.partitionBy("symbol").orderBy(*[F.col(o).desc() for o in ORDER])
    want = (
        history.rolling_volatility(ticks, scale=HOT)
        .withColumn("rn", F.row_number().over(last))
        .filter("rn = 1")
        .select("symbol", "volatility", "volatility_annual")
    )
    got = history.latest_volatility(ticks)
    assert rounded(got, "volatility", "volatility_annual") == rounded(want, "volatility", "volatility_annual")


@pytest.mark.parametrize("strict", [False, True])
def test_as_of(spark, ticks, strict):
    rnd = random.Random(5)
    probes = [("HOT" if n % 3 == 0 else f"S{rnd.randrange(45)}", T0 + timedelta(days=rnd.randrange(-1, 90), minutes=rnd.randrange(0, 600, 30)), n) for n in range(200)]
    probes += [(None, T0, 900 + n) for n in range(5)]
    events = spark.createDataFrame(probes, "symbol STRING, ts TIMESTAMP_NTZ, id INT")
    known = sorted((r.symbol, r.ts, r.seq, r.price) for r in ticks.collect())

    def in_force(symbol, ts):
        best = [p for s, t, _, p in known if s == symbol and (t < ts if strict else t <= ts)]
        return best[-1] if best else None

    want = {n: in_force(s, t) for s, t, n in probes}
    for scale in (HOT, Scale()):
        got = as_of(events, ticks, "price", "mark", strict=strict, scale=scale)
        assert {r.id: r.mark for r in got.collect()} == want


def test_liquidation_over_segments(spark):
    rnd, held, margins = random.Random(7), [], []
    for a, n in (("HOT", 120), ("b", 9), ("c", 3)):
        for s in range(n):
            held.append((a, s * 3000, rnd.randrange(1, 30), 10.0, rnd.choice([0.5, 1.0, 1.5])))
        margins.append((a, -rnd.uniform(500, 9000), n))
    valued = spark.createDataFrame(held, "account_id STRING, symbol BIGINT, qty BIGINT, price DOUBLE, beta DOUBLE").withColumn(
        "market_value", F.col("qty") * F.col("price")
    )
    margin = spark.createDataFrame(margins, "account_id STRING, excess DOUBLE, positions BIGINT")
    plain = liquidation.liquidation_selection(valued, margin)
    split = liquidation.liquidation_selection(valued, margin, scale=HOT)
    assert rounded(split, "proceeds_before") == rounded(plain, "proceeds_before")
    assert plain.filter("account_id = 'HOT'").count() > 8


def test_salted_lookup_equals_broadcast(spark, no_broadcast):
    left = spark.range(500).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 20).alias("k"), "id")
    right = spark.range(15).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    for how in ("left", "inner"):
        salted = lookup_join(left, right, "k", ["id"], how, HOT)
        assert "_salt" in salted._jdf.queryExecution().analyzed().toString()
        assert rows(salted.select("k", "id", "v")) == rows(left.join(right, "k", how).select("k", "id", "v"))


def test_weights_with_salted_totals(spark, no_broadcast):
    valued = spark.createDataFrame(
        [("a", f"s{i}", float(i)) for i in range(1, 30)] + [("z", "s1", 0.0)],
        "account_id STRING, symbol STRING, market_value DOUBLE",
    )
    got = {(r.account_id, r.symbol): r.weight for r in positions.position_weights(valued, HOT).collect()}
    assert got[("a", "s29")] == pytest.approx(29 / 435) and got[("z", "s1")] is None
    assert sum(v for k, v in got.items() if k[0] == "a") == pytest.approx(1.0)


@pytest.fixture(scope="module")
def instant(spark):
    """A key whose rows all have one time stamp."""
    rnd = random.Random(4)
    out = [("HOT", rnd.choice([3.0, 4.0, 5.0, 6.0]), T0, n) for n in range(4000)] + [(f"S{n % 7}", 2.0 + n, T0, n) for n in range(50)]
    return spark.createDataFrame(out, "symbol STRING, price DOUBLE, ts TIMESTAMP_NTZ, seq BIGINT").repartition(5).cache()


def test_a_hot_key_at_one_instant_is_cut_evenly(instant):
    scale = Scale(hot_rows=200, samples=32)
    hot = hot_keys(instant, ["symbol"], scale)
    parts = split_hot(instant, ["symbol"], ORDER, cuts(instant, ["symbol"], ORDER, hot, scale))
    found = parts.groupBy("symbol", SEGMENT).agg(F.count("*").alias("n"), F.min(F.struct(*ORDER)).alias("lo"), F.max(F.struct(*ORDER)).alias("hi"))
    sizes = sorted((r[SEGMENT], r.n, r.lo, r.hi) for r in found.filter("symbol = 'HOT'").collect())
    assert len(sizes) > 10 and [s[0] for s in sizes] == list(range(len(sizes)))
    counts = sorted(s[1] for s in sizes)
    assert counts[-1] < 2 * counts[len(counts) // 2] and sum(counts) == 4000
    assert all(a[3] < b[2] for a, b in zip(sizes, sizes[1:], strict=False))  # no stretch reaches into the next
    assert found.filter("symbol <> 'HOT'").agg(F.max(SEGMENT)).first()[0] == 0


def test_windows_over_a_hot_key_at_one_instant(instant):
    plain = Window.partitionBy("symbol").orderBy(*ORDER)
    before = F.lag("price").over(plain)
    want = instant.withColumn("return", (F.col("price") - before) / before)
    assert rounded(history.price_returns(instant, scale=HOT), "return") == rounded(want, "return")
    want = want.withColumn("volatility", F.stddev_samp("return").over(plain.rowsBetween(-30, 0)))
    got = history.rolling_volatility(instant, scale=Scale(hot_rows=100, samples=4)).drop("volatility_annual")
    assert rounded(got, "return", "volatility") == rounded(want, "return", "volatility")


def test_as_of_at_one_instant(spark, instant):
    events = spark.range(900).select(F.lit("HOT").alias("symbol"), F.expr("TIMESTAMP_NTZ '2024-01-01 00:00:00'").alias("ts"), "id")
    last = instant.filter("symbol = 'HOT'").agg(F.max_by("price", F.struct(*ORDER))).first()[0]
    got = as_of(events, instant, "price", "mark", scale=HOT)
    assert got.count() == 900 and {r.mark for r in got.collect()} == {last}


def test_order_of_input_does_not_matter(ticks):
    shuffled = ticks.orderBy(F.rand(7))
    assert rows(positions.latest_value(ticks, "price")) == rows(positions.latest_value(shuffled, "price"))
    assert rows(positions.latest_value(ticks, "price")) == rows(
        positions.latest_value_ranked(shuffled, "price").drop("ts")
    )
