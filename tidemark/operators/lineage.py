"""One lineage from bars to curves: forecasts, covariance, weights, holding returns, curves; the document of the newest signals; a portfolio against an index.

Every rebalancing date sees rows before it only. All dates run in one job: rows carry their
as_of, what several steps read is written once, and the small results of a step (a period's
weights and returns) are joined by the period's start.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators import allocation, bars
from tidemark.sources.scratch import written


def month_periods(history: DataFrame) -> DataFrame:
    """start, end: neighbouring first days of months between the first and the last date; one row a month."""
    edges = history.agg(F.min("date").alias("first_"), F.max("date").alias("last_")).where("first_ is not null")
    days = edges.select(allocation.month_grid(F.col("first_"), F.col("last_")))
    return days.select(F.add_months("date", -1).alias("start"), F.col("date").alias("end")).join(days.select(F.col("date").alias("start")), "start", "left_semi")


def holding_returns(panel: DataFrame, periods: DataFrame) -> DataFrame:
    """start, symbol, ret over each period of months: from the panel's first date in [start, end] to its last.

    panel (symbol, date, close) has the last known close of every date from a symbol's first on.
    ret is null where the symbol has no close at the period's first date; periods with fewer
    than two dates have no rows.
    """
    month = F.trunc("date", "month").cast("date")
    own = F.when(F.dayofmonth("date") == 1, F.array(month, F.add_months(month, -1))).otherwise(F.array(month))
    edges = panel.select("date").distinct().select("date", F.explode(own).alias("start")).groupBy("start").agg(F.min("date").alias("lo"), F.max("date").alias("hi")).where("lo < hi")
    edges = edges.join(periods.select("start"), "start", "left_semi")
    sides = edges.select("start", F.explode(F.array(F.struct(F.col("lo").alias("date"), F.lit(0).alias("side")), F.struct(F.col("hi").alias("date"), F.lit(1).alias("side")))).alias("s")).select("start", "s.*")
    at = lambda k: F.max(F.when(F.col("side") == k, F.col("close")))
    # Two rows a month.
    return panel.join(F.broadcast(sides), "date").groupBy("start", "symbol").agg((at(1) / at(0) - 1).alias("ret"))


@dataclass
class Lineage:
    """The tables of a walk-forward run, all written: forecasts, covariance and weights by as_of, returns by period, curves."""

    periods: DataFrame
    forecasts: DataFrame
    covariance: DataFrame
    weights: DataFrame
    returns: DataFrame
    curves: DataFrame


def walk_forward(history: DataFrame, years: int = 3, least: int = 60, most: float = 0.25, views: int = 2) -> Lineage:
    """The run over bars (symbol, date, close) with a rebalancing at each first day of a month; as_of is the day before it.

    A month without an answer (too few views, too little common history, no weights that beat
    the rate) carries all curves.
    """
    own = written(history.select("symbol", "date", F.col("close").cast("double").alias("close")).where("date is not null and close is not null"), "history")
    panel = written(bars.filled(own, own.select("date").distinct()), "panel")
    periods = written(month_periods(own), "periods")
    grid = periods.select(F.date_sub("start", 1).alias("as_of"))
    forecast = written(allocation.forecasts(own, grid, years, least=least), "forecasts")
    returns = written(allocation.aligned_returns(own, grid, years), "returns")
    covariance = written(allocation.conditioned(allocation.shrunk_covariance(returns)), "covariance")
    view, variance = allocation.view_columns()
    seen = forecast.withColumn("target", F.col("yhat")).where("last_price > 0").select("as_of", "symbol", view.alias("view"), variance.alias("variance"))
    weights = written(allocation.weights(covariance, seen, most, least=views).withColumn("start", F.date_add("as_of", 1)), "weights")
    held = written(holding_returns(panel, periods), "held")
    curves = written(allocation.walk_forward(periods, weights.select("start", "symbol", "weight"), held), "curves")
    return Lineage(periods, forecast, covariance, weights, held, curves)


def signals_document(history: DataFrame, as_of: DataFrame, years: int = 3, least: int = 60) -> DataFrame:
    """as_of, document: one JSON document for each as_of with the window, the horizon, the diagnostics of concentration and liquidity, and the signals by symbol.

    history (symbol, date, close, volume); the rows of a document are as many as there are symbols. Illiquid symbols have a diagnosis and no signal.
    """
    flags = written(bars.flagged(history), "flags")
    diagnoses = written(bars.liquidity(flags), "liquidity")
    usable = flags.where(~F.col("illiquid")).join(diagnoses.where(~F.col("excluded")).select("symbol"), "symbol", "left_semi").select("symbol", "date", "close")
    found = written(allocation.signals(allocation.forecasts(usable, as_of, years, least=least)), "signals")
    fields = [c for c in found.columns if c not in ("as_of", "symbol")]
    by_symbol = found.groupBy("as_of").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("symbol", F.struct(*fields))))).alias("signals"))
    counts = found.groupBy("as_of", "signal").agg(F.count("*").alias("c"))
    common = counts.groupBy("as_of").agg(F.min_by("signal", F.struct(-F.col("c"), "signal")).alias("dominant"), F.max("c").alias("c"), F.sum("c").alias("n"))
    ratio = F.bround(F.col("c") / F.col("n"), 4)
    common = common.select("as_of", F.struct("dominant", ratio.alias("ratio"), (F.col("c") / F.col("n") > 0.7).alias("flagged"), "n").alias("concentration_diagnostic"))
    row = F.struct("symbol", F.bround("illiquid_ratio", 4).alias("illiquid_ratio"), "rows_raw", "rows_kept", "excluded")
    liquidity = diagnoses.agg(F.sort_array(F.collect_list(row)).alias("liquidity_diagnostics"))
    own = as_of.select("as_of").distinct().join(by_symbol, "as_of", "left").join(common, "as_of", "left").crossJoin(F.broadcast(liquidity))  # one row
    return own.select("as_of", F.to_json(F.struct(F.col("as_of"), F.lit(years).alias("training_window_years"), F.lit(allocation.HORIZON).alias("horizon_days"), "concentration_diagnostic", "liquidity_diagnostics", F.coalesce("signals", F.expr("map()").cast(by_symbol.schema["signals"].dataType)).alias("signals"))).alias("document"))


def against_index(curves: DataFrame, index: DataFrame) -> DataFrame:
    """portfolio, date, level, index_level, drawdown, index_drawdown: both on the union of their dates from the first on that both know, the last known value carried, base 100.

    curves (portfolio, date, value), index (date, value); a portfolio's days are one window.
    """
    dates = index.select("date", F.col("value").alias("index_"))
    spans = curves.groupBy("portfolio").agg(F.min("date").alias("first_"))
    grid = spans.join(dates, F.col("date") >= F.col("first_")).select("portfolio", "date", "index_")
    before = spans.join(dates, F.col("date") < F.col("first_")).groupBy("portfolio").agg(F.max("date").alias("date"), F.max_by("index_", "date").alias("index_"))
    own = grid.unionByName(before.select("portfolio", "date", "index_")).join(curves.select("portfolio", "date", F.col("value").alias("value_")), ["portfolio", "date"], "full_outer")
    w = Window.partitionBy("portfolio").orderBy("date")
    past = w.rowsBetween(Window.unboundedPreceding, 0)
    carried = own.select("portfolio", "date", *(F.last(c, ignorenulls=True).over(past).alias(c) for c in ("value_", "index_"))).where("value_ is not null and index_ is not null")
    based = carried.select("portfolio", "date", *((100 * F.col(c) / F.first(c).over(w)).alias(n) for c, n in (("value_", "level"), ("index_", "index_level"))))
    falls = [(F.col(c) / F.max(c).over(past) - 1).alias(n) for c, n in (("level", "drawdown"), ("index_level", "index_drawdown"))]
    return based.select("*", *falls)


def compared(series: DataFrame, rate: float = 0.03, days: int = 252) -> DataFrame:
    """portfolio and, for it and for the index: performance, yearly volatility, Sharpe ratio, largest drawdown; ratios by 0 are 0."""
    w = Window.partitionBy("portfolio").orderBy("date")
    own = series.select("*", *((F.col(c) / F.lag(c).over(w) - 1).alias(f"{c}_ret") for c in ("level", "index_level")))
    out = []
    for c, name in (("level", ""), ("index_level", "index_")):
        ret, vol = F.avg(f"{c}_ret") * days, F.stddev_samp(f"{c}_ret") * F.sqrt(F.lit(float(days)))
        fall = "drawdown" if c == "level" else "index_drawdown"
        out += [(F.max_by(c, "date") / 100 - 1).alias(f"{name}performance"), F.coalesce(vol, F.lit(0.0)).alias(f"{name}volatility"), F.coalesce(F.try_divide(ret - rate, F.when(vol > 0, vol)), F.lit(0.0)).alias(f"{name}sharpe"), F.min(fall).alias(f"{name}max_drawdown")]
    return own.groupBy("portfolio").agg(F.count("*").alias("n"), *out)
