"""Custody arithmetic over the driver's order lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerleaf.functions import money
from ledgerleaf.operators import measures
from ledgerleaf.plans.adapters import Tables, with_tables
from ledgerleaf.plans.catalog import query
from ledgerleaf.session import materialise

_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
_K = ", ".join(_KEYS)
_D = "DECIMAL(18,2)"


def _cents(expression: str) -> str:
    return f"CAST(round({expression}, 2) AS {_D})"


_COMMISSION = _cents("CAST(gross AS DECIMAL(18,2)) * 0.001")


@query(
    "trade_measures",
    with_tables("trades")
    + f"""SELECT {_K}, side, CAST(gross AS DOUBLE) AS gross, CAST({_COMMISSION} AS DOUBLE) AS commission,
  CAST(15 AS DOUBLE) AS settlement_fee, CAST(CASE side WHEN 'BUY' THEN gross + {_COMMISSION} + CAST(15 AS {_D})
    ELSE gross - {_COMMISSION} - CAST(15 AS {_D}) END AS DOUBLE) AS net FROM trades""",
)
def trade_measures(t: Tables) -> DataFrame:
    rows = measures.with_trade_measures(t.trades, "side", "gross")
    return rows.select(*_KEYS, "side", "gross", "commission", "settlement_fee", "net")


@query(
    "settlement_dates",
    with_tables("trades")
    + f"""SELECT {_K}, strftime(trade_date, '%Y-%m-%d') AS trade_date,
  strftime(trade_date + INTERVAL 2 DAY, '%Y-%m-%d') AS settlement_date,
  strftime(trade_date + INTERVAL 30 DAY, '%Y-%m-%d') AS due_date FROM trades""",
)
def settlement_dates(t: Tables) -> DataFrame:
    day = F.col("trade_date")
    return t.trades.select(
        *_KEYS,
        "trade_date",
        measures.settlement_date(day).alias("settlement_date"),
        measures.due_date(day).alias("due_date"),
    )


_SURCHARGE = f"""CASE WHEN l_linenumber % 3 = 0 THEN CAST(l_linenumber * 25 AS {_D})
  ELSE {_cents("gross * rate_pct * 0.01")} END"""


def _surcharge(t: Tables):
    flat = F.when(F.col("l_linenumber") % 3 == 0, F.col("l_linenumber") * 25).otherwise(F.lit(0)).cast("decimal(18,2)")
    return measures.surcharge(F.col("gross"), F.col("rate_pct"), flat)


@query(
    "surcharges",
    with_tables("trades") + f"SELECT {_K}, CAST({_SURCHARGE} AS DOUBLE) AS surcharge FROM trades",
)
def surcharges(t: Tables) -> DataFrame:
    return t.trades.select(*_KEYS, _surcharge(t).alias("surcharge"))


_WITHHELD = _cents("gross * rate_pct * 0.01")


@query(
    "income",
    with_tables("trades")
    + f"""SELECT {_K}, CAST({_WITHHELD} AS DOUBLE) AS withheld, CAST(gross - {_WITHHELD} AS DOUBLE) AS net,
  CAST({_cents("gross * 0.01")} AS DOUBLE) AS processing_fee FROM trades""",
)
def income(t: Tables) -> DataFrame:
    gross, held = F.col("gross"), measures.withheld(F.col("gross"), F.col("rate_pct"))
    return t.trades.select(
        *_KEYS,
        held.alias("withheld"),
        measures.income_net(gross, held).alias("net"),
        measures.processing_fee(gross).alias("processing_fee"),
    )


@query(
    "valuation_share",
    with_tables(
        "trades",
        also=f"""positions AS (
  SELECT {_K}, CAST(l_suppkey % 50 AS BIGINT) AS portfolio, {_cents(
      "CASE WHEN l_returnflag = 'R' THEN quantity * gross * 0.01 ELSE quantity * gross END")} AS value FROM trades),
totals AS (SELECT portfolio, sum(value) AS nav FROM positions GROUP BY portfolio)""",
    )
    + f"""SELECT {_K}, portfolio, CAST(value AS DOUBLE) AS value, CAST(nav AS DOUBLE) AS nav,
  round(CAST(value AS DOUBLE) * 100 / CAST(nav AS DOUBLE), 1) AS pct_of_nav FROM positions JOIN totals USING (portfolio)""",
)
def valuation_share(t: Tables) -> DataFrame:
    kind = F.when(F.col("l_returnflag") == "R", F.lit("BOND")).otherwise(F.lit("EQUITY"))
    positions = t.heavy_trades.select(
        *_KEYS,
        (F.col("l_suppkey") % 50).alias("portfolio"),
        measures.market_value(kind, F.col("quantity"), F.col("gross")).alias("value"),
    )
    return measures.valuation(positions, "portfolio", "value")


_RECLAIM = _cents("gross * greatest(CAST(0 AS DECIMAL(18,2)), rate_pct * 4 - 15) * 0.01")
_HELD4 = _cents("gross * rate_pct * 4 * 0.01")


@query(
    "reclaim",
    with_tables("trades")
    + f"""SELECT l_orderkey AS claim, CAST(sum({_HELD4}) AS DOUBLE) AS total_withheld,
  CAST(sum({_RECLAIM}) AS DOUBLE) AS total_reclaimable, CAST(sum({_HELD4}) - sum({_RECLAIM}) AS DOUBLE) AS non_reclaimable
FROM trades GROUP BY l_orderkey""",
)
def reclaim(t: Tables) -> DataFrame:
    items = t.heavy_trades.select(
        F.col("l_orderkey").alias("claim"), "gross", (F.col("rate_pct") * 4).cast("decimal(18,2)").alias("rate")
    )
    return measures.reclaim_totals(items, "claim", "gross", "rate")


@query(
    "invoice_totals",
    with_tables("trades")
    + f"""SELECT l_orderkey AS invoice, CAST(sum({_cents("quantity * gross")}) AS DOUBLE) AS subtotal,
  CAST(sum({_SURCHARGE}) AS DOUBLE) AS surcharges,
  CAST(sum({_cents("quantity * gross")}) + sum({_SURCHARGE}) AS DOUBLE) AS total FROM trades GROUP BY l_orderkey""",
)
def invoice_totals(t: Tables) -> DataFrame:
    lines = t.heavy_trades.select(F.col("l_orderkey").alias("invoice"), "quantity", "gross", _surcharge(t).alias("extra"))
    return measures.invoice_totals(lines, "invoice", "quantity", "gross", "extra")


@query(
    "corporate_action_bills",
    with_tables("trades")
    + """SELECT l_orderkey AS bill, CAST(sum(quantity) AS DOUBLE) AS event_fees,
  CAST(sum(quantity) + 450 AS DOUBLE) AS total_billed FROM trades GROUP BY l_orderkey""",
)
def corporate_action_bills(t: Tables) -> DataFrame:
    fees = t.trades.select(F.col("l_orderkey").alias("bill"), "quantity")
    return measures.corporate_action_bill(fees, "bill", "quantity")


@query(
    "dividend_totals",
    with_tables("trades")
    + """SELECT o_custkey AS client, CAST(sum(gross) AS DOUBLE) AS total_dividends
FROM trades JOIN orders ON l_orderkey = o_orderkey GROUP BY o_custkey""",
)
def dividend_totals(t: Tables) -> DataFrame:
    owners = t.raw("orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("client"))
    items = t.trades.select("l_orderkey", "gross").join(owners, "l_orderkey")
    return measures.dividend_totals(items, "client", "gross")


@query(
    "capital_gains",
    with_tables("trades")
    + f"""SELECT {_K}, CAST(gross - CAST(p_retailprice AS {_D}) AS DOUBLE) AS gain
FROM trades JOIN part ON l_partkey = p_partkey""",
)
def capital_gains(t: Tables) -> DataFrame:
    cost = t.raw("part").select(
        F.col("p_partkey").alias("l_partkey"), F.col("p_retailprice").cast("decimal(18,2)").alias("basis")
    )
    rows = t.trades.select(*_KEYS, "gross").join(cost, "l_partkey")
    return rows.select(*_KEYS, measures.capital_gain(F.col("gross"), F.col("basis")).alias("gain"))


@query(
    "amount_text",
    """SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey, CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) AS amount,
  CASE WHEN l_linenumber % 4 = 0 THEN NULL ELSE round(l_discount * 100, 4) END AS rate_pct FROM lineitem""",
)
def amount_text(t: Tables) -> DataFrame:
    """Numbers written with signs and separators and read back."""
    shown = F.concat(F.lit("$"), F.format_number("l_extendedprice", 2))
    rate = F.when(F.col("l_linenumber") % 4 == 0, F.lit("flat")).otherwise(
        F.concat(F.format_number(F.col("l_discount") * 100, 4), F.lit("%"))
    )
    return t.raw("lineitem").select(*_KEYS, money.amount(shown).alias("amount"), money.rate(rate).alias("rate_pct"))


@query(
    "reconcile",
    with_tables("trades")
    + f"""SELECT {_K}, CASE WHEN l_linenumber = 5 THEN CASE WHEN l_returnflag = 'R' THEN 'gross,net' ELSE 'gross,commission,net' END
    ELSE 'settlement_date' END AS failed_checks
FROM trades WHERE l_linenumber IN (5, 6)""",
)
def reconcile(t: Tables) -> DataFrame:
    """Statements written from the trades, wrong on two line numbers: amounts on 5, settlement day on 6.

    The statements are stored first, as reports are; checking them is then one scan.
    """
    bond = F.col("l_returnflag") == "R"
    rows = t.heavy_trades.withColumn("asset_class", F.when(bond, F.lit("BOND")).otherwise(F.lit("EQUITY")))
    true_gross = measures.market_value(F.col("asset_class"), F.col("quantity"), F.col("gross"))
    wrong = F.when(F.col("l_linenumber") == 5, F.lit(100)).otherwise(F.lit(0))
    rows = rows.withColumn("true_gross", true_gross).withColumn("gross_value_usd", (F.col("true_gross") + wrong * 100).cast("decimal(18,2)"))
    statement = rows.select(
        *_KEYS,
        "asset_class",
        "quantity",
        F.col("gross").alias("price_usd"),
        F.col("side").alias("txn_type"),
        "gross_value_usd",
        measures.commission(F.col("true_gross")).alias("commission_usd"),
        F.lit("15.00").cast("decimal(18,2)").alias("settlement_fee_usd"),
        measures.trade_net(F.col("side"), F.col("true_gross")).alias("net_value_usd"),
        "trade_date",
        F.date_add("trade_date", F.when(F.col("l_linenumber") == 6, 3).otherwise(2)).alias("settlement_date"),
    )
    stored = materialise(statement, "statements")
    return measures.reconcile_trades(stored).select(*_KEYS, "failed_checks")
