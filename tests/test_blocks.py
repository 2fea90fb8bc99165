"""State of many keys in few values, with the results of one key at a time."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from ballast.operators import asof, history
from ballast.session import work_folder
from ballast.streaming import blocks, enforcement, feeds, firm
from ballast.streaming import history as history_stream
from ballast.streaming import positions as position_stream
from ballast.streaming.ladder_state import ladder_state
from tests.conftest import rows
from tests.test_ladder import SCHEMA, event, taken, walk
from tests.test_streaming import T0, TICKS, fed, logged


def watched(start, sizes):
    """Start the query, and note how many values its state holds in the end."""

    def run(stream):
        query = start(stream)
        query.awaitTermination()
        sizes.append(max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress))
        return query

    return run


def test_ladder_of_many_accounts(spark):
    home, sizes = work_folder(spark, "test"), []
    events = [event(n, n % 90, (n % 13 - 5) / 100, f"a{n % 150}") for n in range(600)]
    events.sort(key=lambda e: (e[1], e[2]))
    sink = enforcement.EnforcementSink(home)

    def start(stream):
        query = ladder_state(stream, sink.params, True, buckets=4).writeStream.outputMode("update")
        return query.option("checkpointLocation", f"{home}/checkpoint").trigger(availableNow=True).foreachBatch(sink).start()

    fed(spark, home, [events[:300], events[300:]], SCHEMA, watched(start, sizes))
    assert taken(spark.read.parquet(f"{home}/actions")) == walk(events, True)
    assert 0 < sizes[-1] <= 4  # 150 before: a call of the processor for each account


def test_volatility_of_many_symbols(spark):
    home, sizes = work_folder(spark, "test"), []
    ticks = [(f"s{n % 120}", 50.0 + n * 7 % 31, T0 + timedelta(seconds=n * 37 % 5000), n) for n in range(5000)]
    ticks += [("s1", 60.0, None, 9000), ("s2", None, T0, 9001), (None, 1.0, T0, 9002)]
    start = lambda s: logged(history_stream.latest_volatility(s, buckets=4), home)
    fed(spark, home, [ticks[1::2], ticks[::2]], TICKS, watched(start, sizes))
    got = feeds.newest(spark, f"{home}/out", history_stream.VOLATILITY.format(key="STRING"), ["symbol"])
    want = history.latest_volatility(spark.createDataFrame(ticks, TICKS).filter("price IS NOT NULL AND symbol IS NOT NULL"))
    shown = lambda df: rows(df.select("symbol", F.round("volatility_annual", 6)))
    assert shown(got) == shown(want)
    assert 0 < sizes[-1] <= 4


def test_marks_of_many_symbols(spark):
    home, sizes = work_folder(spark, "test"), []
    kind = "kind STRING, account_id STRING, symbol STRING, price DOUBLE, ts TIMESTAMP, seq BIGINT"
    ticks = [("tick", None, f"s{n % 80}", float(n % 97), T0 + timedelta(seconds=n * 37 % 300), n) for n in range(800)]
    fills = [("fill", f"a{n}", f"s{n % 90}", None, T0 + timedelta(seconds=n * 11 % 300), n) for n in range(300)]
    end = [("tick", None, "zz", 1.0, T0 + timedelta(hours=1), 0)]

    def halves(df):
        return df.filter("kind = 'fill'").select("account_id", "symbol", "ts", "seq"), df.filter("kind = 'tick'").select("symbol", "price", "ts", "seq")

    def start(stream):
        return logged(history_stream.as_of(*halves(stream.withWatermark("ts", "0 seconds")), "price", "mark", slices=2, buckets=3), home, "append")

    both = ticks + fills
    fed(spark, home, [[r for r in both if r[4] < T0 + timedelta(seconds=150)], [r for r in both if r[4] >= T0 + timedelta(seconds=150)], end], kind, watched(start, sizes))
    want = asof.as_of(*halves(spark.createDataFrame(both, kind)), "price", "mark")
    assert rows(spark.read.schema(want.schema).parquet(f"{home}/out").select(*want.columns)) == rows(want)
    assert 0 < max(sizes) <= 3 * 4  # ticks, waiting events, next time and timer of a bucket


def test_positions_of_many_symbols(spark):
    home, sizes = work_folder(spark, "test"), []
    moves = [("position", f"a{n % 50}", f"s{n % 70}", n % 9 - 3, None, None) for n in range(700)]
    quotes = [("price", None, f"s{n}", None, 10.0 + n, [1]) for n in range(60)] + [("price", None, f"s{n}", None, 20.0 + n, [2]) for n in range(30)]
    ddl = "kind STRING, account_id STRING, symbol STRING, qty BIGINT, val DOUBLE, place ARRAY<BIGINT>"

    def start(stream):
        return logged(position_stream.deltas(stream.withColumn("slice", F.lit(0)), buckets=4), home, "append")

    fed(spark, home, [moves[:400] + quotes[:60], quotes[60:] + moves[400:]], ddl, watched(start, sizes))
    held = {}
    for _, account, symbol, qty, *_ in moves:
        held[account, symbol] = held.get((account, symbol), 0) + qty
    kept = position_stream.held(spark, f"{home}/checkpoint")
    assert {(r.account_id, r.symbol): r.qty for r in kept.collect()} == held
    price = {f"s{n}": (20.0 if n < 30 else 10.0) + n for n in range(60)}
    assert {r.symbol: r.price for r in position_stream.marked(spark, f"{home}/checkpoint").collect()} == price
    worth = {}
    for (account, symbol), qty in held.items():
        worth[account] = worth.get(account, 0.0) + qty * price.get(symbol, 0.0)
    changed = spark.read.schema(f"{position_stream.DELTAS}, batch INT").parquet(f"{home}/out").drop("batch")
    assert {r.account_id: (r.total_mv, r.positions) for r in position_stream.totals(changed).collect()} == {
        a: (w, sum(k[0] == a for k in held)) for a, w in worth.items()
    }
    assert 0 < sizes[-1] <= 8  # holders and marks


def test_firm_of_many_accounts(spark):
    home, sizes = work_folder(spark, "test"), []
    ddl = "account_id STRING, total_mv DOUBLE, beta_weighted_exposure DOUBLE, batch BIGINT"
    parts = [[(f"a{n}", float(n), 2.0 * n, 0) for n in range(90)], [(f"a{n}", 1.0, 1.0, 1) for n in range(40)] + [("a50", 7.0, 7.0, -1)]]
    fed(spark, home, parts, ddl, watched(lambda s: logged(firm.bucket_totals(s, 3), home, "append"), sizes))
    out = spark.read.schema(f"{firm.BUCKET}, batch INT").parquet(f"{home}/out")
    last = out.groupBy("bucket").agg(F.max_by(F.struct("exposure", "value", "accounts"), "version").alias("s")).agg(F.sum("s.exposure"), F.sum("s.value"), F.sum("s.accounts"))
    assert tuple(last.first()) == (2.0 * sum(range(40, 90)) + 40, float(sum(range(40, 90))) + 40, 90)
    assert 0 < sizes[-1] <= 6


def test_a_block_keeps_its_rows():
    table = position_stream.HOLDERS.empty_table()
    assert blocks.unpacked(blocks.packed(table)).schema == position_stream.HOLDERS
