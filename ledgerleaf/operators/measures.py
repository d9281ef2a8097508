"""Custody arithmetic on exact decimals."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerleaf.functions.money import AMOUNT, cents

# Rates and fees (fixed values).
COMMISSION_RATE = "0.001"
SETTLEMENT_FEE = "15.00"
SETTLEMENT_DAYS = 2
PROCESSING_FEE_RATE = "0.01"
TREATY_RATE = "15"
INVOICE_DUE_DAYS = 30
NOTIFICATION_FEE = "200.00"
ELECTION_FEE = "250.00"
TOLERANCE = "0.01"


def _dec(text: str) -> Column:
    whole, _, fraction = text.partition(".")
    return F.lit(text).cast(f"decimal({len(whole) + len(fraction)},{len(fraction)})")


def commission(gross: Column) -> Column:
    return cents(gross * _dec(COMMISSION_RATE))


def trade_net(side: Column, gross: Column, fee: Column | None = None) -> Column:
    """A buyer pays commission and fee on top, a seller receives that much less."""
    costs = commission(gross) + (_dec(SETTLEMENT_FEE) if fee is None else fee)
    return F.when(side == "BUY", gross + costs).otherwise(gross - costs).cast(AMOUNT)


def with_trade_measures(df: DataFrame, side: str, gross: str) -> DataFrame:
    """Adds commission, settlement_fee and net to trades with a gross amount."""
    g = F.col(gross)
    return (
        df.withColumn("commission", commission(g))
        .withColumn("settlement_fee", _dec(SETTLEMENT_FEE).cast(AMOUNT))
        .withColumn("net", trade_net(F.col(side), g))
    )


def gross_value(quantity: Column, price: Column) -> Column:
    return cents(quantity.cast(AMOUNT) * price.cast(AMOUNT))


def settlement_date(trade_date: Column) -> Column:
    return F.date_add(trade_date.cast("date"), SETTLEMENT_DAYS)


def due_date(invoice_date: Column) -> Column:
    return F.date_add(invoice_date.cast("date"), INVOICE_DUE_DAYS)


def surcharge(base: Column, rate_pct: Column, flat: Column) -> Column:
    """The flat amount when there is one, else base times percentage."""
    return F.when(flat > 0, flat).otherwise(cents(base * rate_pct * _dec("0.01"))).cast(AMOUNT)


def income_net(gross: Column, withheld: Column) -> Column:
    return (gross - withheld).cast(AMOUNT)


def processing_fee(gross: Column) -> Column:
    return cents(gross * _dec(PROCESSING_FEE_RATE))


def capital_gain(proceeds: Column, basis: Column) -> Column:
    return (proceeds - basis).cast(AMOUNT)


def withheld(gross: Column, rate_pct: Column) -> Column:
    return cents(gross * rate_pct * _dec("0.01"))


def reclaimable(gross: Column, rate_pct: Column) -> Column:
    """What the source country kept beyond the treaty rate."""
    excess = F.greatest(F.lit(0).cast("decimal(18,6)"), rate_pct.cast("decimal(18,6)") - _dec(TREATY_RATE))
    return cents(gross * excess * _dec("0.01"))


def reclaim_totals(items: DataFrame, by: str, gross: str, rate_pct: str) -> DataFrame:
    """Per document: withheld, reclaimable and the part the treaty keeps."""
    rows = items.select(
        by, withheld(F.col(gross), F.col(rate_pct)).alias("w"), reclaimable(F.col(gross), F.col(rate_pct)).alias("r")
    )
    return rows.groupBy(by).agg(
        F.sum("w").alias("total_withheld"),
        F.sum("r").alias("total_reclaimable"),
        (F.sum("w") - F.sum("r")).alias("non_reclaimable"),
    )


def market_value(asset_class: Column, units: Column, price: Column) -> Column:
    """Bonds are quoted per hundred of face value, everything else per unit."""
    value = units.cast(AMOUNT) * price.cast(AMOUNT)
    return cents(F.when(asset_class == "BOND", value * _dec("0.01")).otherwise(value))


def valuation(positions: DataFrame, by: str, value: str) -> DataFrame:
    """Adds ``nav``, the total per portfolio, and ``pct_of_nav`` to one decimal.

    Total and positions meet by join, not by window: totals are pre-aggregated in every task, and a portfolio with
    very many positions is split by the join instead of landing in one window task.
    """
    totals = positions.groupBy(by).agg(F.sum(value).cast(AMOUNT).alias("nav"))
    share = F.round(F.try_divide(F.col(value) * 100, F.col("nav")), 1)
    return positions.join(totals, by).withColumn("pct_of_nav", share.cast("decimal(9,1)"))


def invoice_totals(lines: DataFrame, by: str, units: str, price: str, surcharge_col: str) -> DataFrame:
    """Per invoice: subtotal of units times price, surcharges, total."""
    rows = lines.select(
        by,
        cents(F.col(units).cast(AMOUNT) * F.col(price).cast(AMOUNT)).alias("line"),
        F.col(surcharge_col).cast(AMOUNT).alias("extra"),
    )
    return rows.groupBy(by).agg(
        F.sum("line").cast(AMOUNT).alias("subtotal"),
        F.sum("extra").cast(AMOUNT).alias("surcharges"),
        (F.sum("line") + F.sum("extra")).cast(AMOUNT).alias("total"),
    )


def corporate_action_bill(fees: DataFrame, by: str, fee: str) -> DataFrame:
    """Per bill: event fees plus the notification and election fees."""
    total = F.sum(F.col(fee).cast(AMOUNT))
    fixed = _dec(NOTIFICATION_FEE) + _dec(ELECTION_FEE)
    return fees.groupBy(by).agg(total.cast(AMOUNT).alias("event_fees"), (total + fixed).cast(AMOUNT).alias("total_billed"))


def dividend_totals(items: DataFrame, by: str, gross: str) -> DataFrame:
    return items.groupBy(by).agg(F.sum(F.col(gross).cast(AMOUNT)).cast(AMOUNT).alias("total_dividends"))


def _off(stated: Column, expected: Column) -> Column:
    return F.coalesce(F.abs(stated - expected) > _dec(TOLERANCE), F.lit(True))


def reconcile_trades(trades: DataFrame) -> DataFrame:
    """Rows of a transactions report that disagree with the arithmetic by more than a cent.

    ``asset_class`` tells bonds apart: their gross is per hundred and their commission is not checked.
    """
    gross = market_value(F.col("asset_class"), F.col("quantity"), F.col("price_usd"))
    bond = F.col("asset_class") == "BOND"
    costs = F.col("commission_usd") + F.col("settlement_fee_usd")
    net = F.when(F.col("txn_type") == "BUY", F.col("gross_value_usd") + costs).otherwise(
        F.col("gross_value_usd") - costs
    )
    return _flag(
        trades,
        {
            "gross": _off(F.col("gross_value_usd"), gross),
            "commission": ~bond & _off(F.col("commission_usd"), commission(F.col("gross_value_usd"))),
            "net": _off(F.col("net_value_usd"), net),
            "settlement_date": ~F.col("settlement_date").eqNullSafe(settlement_date(F.col("trade_date"))),
        },
    )


def reconcile_surcharges(rows: DataFrame) -> DataFrame:
    """Percentage rows only; a flat surcharge has nothing to recompute."""
    expected = cents(F.col("base_amount_usd") * F.col("rate_pct") * _dec("0.01"))
    off = F.col("rate_pct").isNotNull() & _off(F.col("surcharge_amount_usd"), expected)
    return _flag(rows, {"surcharge": off})


def reconcile_income(rows: DataFrame) -> DataFrame:
    return _flag(
        rows,
        {
            "net": _off(F.col("net_amount_usd"), income_net(F.col("gross_amount_usd"), F.col("tax_withheld_usd"))),
            "processing_fee": _off(F.col("processing_fee_usd"), processing_fee(F.col("gross_amount_usd"))),
        },
    )


def _flag(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """Keeps rows with at least one failed check and names the failed ones.

    The checks are settled as flags first, so filter and names share one evaluation.
    """
    flags = {f"__{name}": off for name, off in checks.items()}
    flagged = df.withColumns(flags).where(reduce(or_, [F.col(c) for c in flags]))
    failed = F.concat_ws(",", *[F.when(F.col(f"__{name}"), F.lit(name)) for name in checks])
    return flagged.withColumn("failed_checks", failed).drop(*flags)
