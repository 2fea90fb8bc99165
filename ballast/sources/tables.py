"""Brokerage relations projected from the star-schema tables.

Each function reads one or more parquet tables of ``root`` and yields a frame
with the column names the operators expect. ``ts`` is the event time; ``seq``
orders rows of one instant. The tables hold every order of a line item and
every part of it (declared foreign keys), so a relation that takes no column
of ``orders`` or ``part`` does not join it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ballast.functions.skew import lookup_join

TICK_ORDER = ("ts", "seq", "price")


# schemas by application and path: reading one costs a job over the file footers
_SCHEMAS: dict[tuple[str, str], StructType] = {}


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    path = f"{root}/{name}.parquet"
    key = (spark.sparkContext.applicationId, path)
    if key not in _SCHEMAS:
        _SCHEMAS[key] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[key]).parquet(path)


SIGNED_QTY = "CAST(l_quantity AS INT) * CASE WHEN l_returnflag = 'R' THEN -1 ELSE 1 END AS qty"
FACTOR = "(1 + (l_tax - l_discount) * 0.25D * (1 + l_partkey % 4))"
TRADE_PRICE = f"p_retailprice * {FACTOR} AS price"
SEQ = "struct(l_orderkey, l_linenumber, l_suppkey) AS seq"


def _with_order(lines: DataFrame, orders: DataFrame) -> DataFrame:
    return lines.join(orders.selectExpr("o_orderkey AS l_orderkey", "o_custkey AS account_id"), "l_orderkey")


def _with_part(lines: DataFrame, parts: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    listed = parts.selectExpr("p_partkey AS l_partkey", "p_retailprice")
    keys = None if hot is None else hot.withColumnRenamed("symbol", "l_partkey")
    return lookup_join(lines, listed, "l_partkey", spread=["l_orderkey", "l_linenumber"], how="inner", hot=keys)


def project_fills(lines: DataFrame, orders: DataFrame, parts: DataFrame | None = None, hot: DataFrame | None = None) -> DataFrame:
    """account_id, symbol, qty, ts, seq and, when ``parts`` is given, price. Batch or, without ``hot`` symbols, stream.

    A fill must name account and symbol, as on the wire. Stating it here also
    keeps the filters of all branches of a plan alike, so they share exchanges.
    """
    traded = _with_order(lines.filter("l_partkey IS NOT NULL"), orders.filter("o_custkey IS NOT NULL"))
    columns = ["account_id", "l_partkey AS symbol", SIGNED_QTY, "l_shipdate AS ts", SEQ]
    if parts is not None:
        traded = _with_part(traded, parts, hot)
        columns.insert(3, TRADE_PRICE)
    return traded.selectExpr(*columns)


def fills(spark: SparkSession, root: str, hot: DataFrame | None = None) -> DataFrame:
    return project_fills(
        table(spark, root, "lineitem"), table(spark, root, "orders"), table(spark, root, "part"), hot
    )


def trades(spark: SparkSession, root: str) -> DataFrame:
    """Fills without their price, enough for positions."""
    return project_fills(table(spark, root, "lineitem"), table(spark, root, "orders"))


def project_prices(lines: DataFrame, parts: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    quoted = _with_part(lines.filter("l_partkey IS NOT NULL"), parts, hot)
    return quoted.selectExpr("l_partkey AS symbol", TRADE_PRICE, "l_shipdate AS ts", SEQ, "p_retailprice")


def prices(spark: SparkSession, root: str, hot: DataFrame | None = None) -> DataFrame:
    """Price ticks, one per line item."""
    return project_prices(table(spark, root, "lineitem"), table(spark, root, "part"), hot).drop("p_retailprice")


def last_prices(spark: SparkSession, root: str) -> DataFrame:
    """Newest price per symbol. Ticks are reduced before they meet their list price, so none is shuffled.

    Of ticks that agree in time and sequence the dearest wins: within a symbol the price follows its factor.
    """
    ticks = table(spark, root, "lineitem").filter("l_partkey IS NOT NULL").selectExpr("l_partkey", f"{FACTOR} AS factor", "l_shipdate AS ts", SEQ)
    newest = ticks.groupBy("l_partkey").agg(F.max_by("factor", F.struct("ts", "seq", "factor")).alias("factor"))
    listed = table(spark, root, "part").selectExpr("p_partkey AS l_partkey", "p_retailprice")
    return newest.join(listed, "l_partkey").selectExpr("l_partkey AS symbol", "p_retailprice * factor AS price")


def project_betas(parts: DataFrame) -> DataFrame:
    return parts.selectExpr("p_partkey AS symbol", "0.5D + CAST(p_size % 16 AS DOUBLE) / 10 AS beta")


def betas(spark: SparkSession, root: str) -> DataFrame:
    """One beta per symbol."""
    return project_betas(table(spark, root, "part"))


def project_cash(customers: DataFrame, priced_fills: DataFrame) -> DataFrame:
    """Opening balance less a loan of 60 to 78 % of the account's net cost."""
    cost = priced_fills.groupBy("account_id").agg(F.expr("sum(qty * price) AS cost"))
    balances = customers.selectExpr("c_custkey AS account_id", "c_acctbal")
    loan = "CAST(60 + 2 * (account_id % 10) AS DOUBLE) / 100 * greatest(coalesce(cost, 0D), 0D)"
    return balances.join(cost, "account_id", "left").selectExpr("account_id", f"c_acctbal - {loan} AS cash")


def cash(spark: SparkSession, root: str) -> DataFrame:
    return project_cash(table(spark, root, "customer"), fills(spark, root))


def accounts(spark: SparkSession, root: str) -> DataFrame:
    """Account reference data: id, opening balance, risk profile."""
    return table(spark, root, "customer").selectExpr(
        "c_custkey AS account_id", "c_acctbal AS cash", "lower(c_mktsegment) AS risk_profile"
    )


def margin_events(spark: SparkSession, root: str) -> DataFrame:
    """Account snapshots over time, derived from the event stream."""
    return project_margin_events(table(spark, root, "events"))


def project_margin_events(events: DataFrame) -> DataFrame:
    mv, cushion = "CAST(1000 * (1 + event_id % 7) AS DOUBLE)", "(value - 15) / 100"
    return events.selectExpr(
        "event_id",
        "CAST(user_id * 100 + dayofmonth(ts) AS BIGINT) AS account_id",
        "ts",
        f"{mv} AS total_mv",
        f"{mv} * (0.25D + {cushion}) AS equity",
        "CAST(250 * (1 + event_id % 7) AS DOUBLE) AS maintenance_req",
        f"{mv} * ({cushion}) AS excess",
        f"{mv} * (0.5D + CAST(event_id % 16 AS DOUBLE) / 10) AS beta_weighted_exposure",
    )
