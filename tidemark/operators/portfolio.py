"""Valuation of holdings, rebalance plans and ledger replay."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RATE = 0.011


def fee(notional: Column, rate: float = RATE) -> Column:
    return F.floor(notional * rate + 0.5).cast("double")


def buy_cost(quantity: Column, price: Column, rate: float = RATE) -> Column:
    return quantity * price + fee(quantity * price, rate)


def sell_proceeds(quantity: Column, price: Column, rate: float = RATE) -> Column:
    return quantity * price - fee(quantity * price, rate)


def positions(holdings: DataFrame, quotes: DataFrame) -> DataFrame:
    """Holdings (portfolio, symbol, quantity, avg_cost) with last price, invested, market_value, pnl, pnl_pct and weight; without a price what was invested counts in the weight."""
    own = holdings.where("quantity > 0").join(quotes.select("symbol", "last"), "symbol", "left")
    own = own.withColumn("invested", F.col("quantity") * F.col("avg_cost")).withColumn("market_value", F.col("quantity") * F.col("last"))
    own = own.withColumn("pnl", F.col("market_value") - F.col("invested")).withColumn("pnl_pct", F.when(F.col("invested") > 0, 100 * F.col("pnl") / F.col("invested")))
    total = own.groupBy("portfolio").agg(F.sum(F.coalesce("market_value", "invested")).alias("total_"))
    return own.join(total, "portfolio").withColumn("weight", F.try_divide(F.coalesce("market_value", "invested"), "total_")).drop("total_")


def totals(held: DataFrame, cash: DataFrame, deposits: DataFrame) -> DataFrame:
    """Per portfolio of cash (portfolio, cash): holdings value, invested, unrealised gain and %, total value, total return and % (null without deposits)."""
    value = F.coalesce("market_value", "invested")
    own = held.groupBy("portfolio").agg(F.sum(value).alias("holdings_value"), F.sum("invested").alias("invested"))
    own = cash.join(own, "portfolio", "left").join(deposits, "portfolio", "left").na.fill(0.0, ["holdings_value", "invested", "net_deposits"])
    own = own.withColumn("unrealised", F.col("holdings_value") - F.col("invested")).withColumn("total_value", F.col("holdings_value") + F.col("cash"))
    own = own.withColumn("unrealised_pct", F.when(F.col("invested") > 0, 100 * F.col("unrealised") / F.col("invested")))
    own = own.withColumn("total_return", F.col("total_value") - F.col("net_deposits"))
    return own.withColumn("total_return_pct", F.when(F.col("net_deposits") > 0, 100 * F.col("total_return") / F.col("net_deposits")))


def rebalance_plan(allocation: DataFrame, quotes: DataFrame, holdings: DataFrame, signals: DataFrame, capital: Column) -> DataFrame:
    """Per line of the allocation (symbol, weight): whole shares to hold, delta, action, amount and signal; without a price nothing is bought."""
    own = allocation.join(quotes.select("symbol", "last"), "symbol", "left").join(holdings.select("symbol", F.col("quantity").alias("held")), "symbol", "left").join(signals.select("symbol", "signal"), "symbol", "left")
    own = own.withColumn("held", F.coalesce("held", F.lit(0)))
    own = own.withColumn("target", F.when(F.col("last") > 0, F.floor(F.col("weight") * capital / F.col("last"))).otherwise(F.lit(0)))
    own = own.withColumn("delta", F.col("target") - F.col("held"))
    action = F.when(F.col("delta") > 0, "BUY").when(F.col("delta") < 0, "SELL").otherwise("HOLD")
    return own.select("symbol", "weight", "last", "held", "target", "delta", action.alias("action"), (F.col("target") * F.col("last")).alias("amount"), "signal").orderBy(F.desc("weight"), "symbol")


REPLAYED = "portfolio long, seq long, applied boolean, reason string, cash double, symbol string, quantity long, avg_cost double"


def replay(rows, state: dict, rate: float = RATE) -> list[tuple]:
    """Applies transactions (portfolio, seq, type, symbol, quantity, price) of one portfolio to its state {'cash', 'held'}.

    A purchase beyond the cash, a sale beyond the shares and a withdrawal beyond the cash are
    flagged and change nothing. Fees are part of the average cost.
    """
    out = []
    for portfolio, seq, kind, symbol, quantity, price in rows:
        held = state["held"].get(symbol, (0, 0.0))
        notional = float(quantity or 0) * float(price or 0.0)
        fees, reason = float(int(notional * rate + 0.5)), None
        if kind in ("DEPOSIT", "WITHDRAW"):
            moved = notional if kind == "DEPOSIT" else -notional
            reason = "INVALID" if notional <= 0 else "INSUFFICIENT_CASH" if state["cash"] + moved < 0 else None
            state["cash"] += 0.0 if reason else moved
        elif notional <= 0 or symbol is None or kind not in ("BUY", "SELL"):
            reason = "INVALID"
        elif kind == "BUY" and notional + fees > state["cash"]:
            reason = "INSUFFICIENT_CASH"
        elif kind == "SELL" and held[0] < quantity:
            reason = "INSUFFICIENT_SHARES"
        elif kind == "BUY":
            n = held[0] + int(quantity)
            held = n, (held[0] * held[1] + notional + fees) / n
            state["held"][symbol], state["cash"] = held, state["cash"] - notional - fees
        else:
            held = held[0] - int(quantity), held[1]
            state["cash"] += notional - fees
            if held[0]:
                state["held"][symbol] = held
            else:
                state["held"].pop(symbol)
        out.append((portfolio, seq, reason is None, reason, state["cash"], symbol, held[0], held[1]))
    return out


def rank() -> Column:
    """Of transactions with the same seq money comes in first: deposits, sales, purchases, withdrawals, others."""
    return F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, ("DEPOSIT", "SELL", "BUY", "WITHDRAW"))), F.col("type")), F.lit(0)), F.lit(9))


def replayed(ledger: DataFrame, rate: float = RATE) -> DataFrame:
    """REPLAYED for a ledger (portfolio, seq, type, symbol, quantity, price): a portfolio's transactions in order of seq (and rank), streamed through its task. Rows without a portfolio are one."""
    order = ["portfolio", "seq", "type", "symbol", "quantity", "price"]
    none = object()  # null is a portfolio like any other
    columns = [f.split()[0] for f in REPLAYED.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, state = none, {}
        for batch in batches:
            rows = batch.astype(object).where(batch.notna(), None).itertuples(index=False, name=None)
            out = []
            for row in rows:
                if row[0] != at:
                    at, state = row[0], {"cash": 0.0, "held": {}}
                out += replay([row], state, rate)
            yield pd.DataFrame(out, columns=columns)

    own = ledger.select(*order).repartition("portfolio").sortWithinPartitions("portfolio", "seq", rank(), *order[2:])
    return own.mapInPandas(run, REPLAYED)
