"""Series operators over bars (symbol, date, close, ...); windows have the symbol as their key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def by_date():
    return Window.partitionBy("symbol").orderBy("date")


def flagged(bars: DataFrame, streak: int = 3) -> DataFrame:
    """Adds illiquid: no volume, or a close that stays the same for more than streak rows (all of them count)."""
    step = F.when(F.col("close") == F.lag("close").over(by_date()), 0).otherwise(1)
    runs = bars.withColumn("step_", step).withColumn("run_", F.sum("step_").over(by_date()))
    long = F.count("*").over(Window.partitionBy("symbol", "run_")) > streak
    return runs.withColumn("illiquid", (F.coalesce("volume", F.lit(0)) <= 0) | long).drop("step_", "run_")


def liquidity(flags: DataFrame, symbols: DataFrame | None = None, most: float = 0.4) -> DataFrame:
    """symbol, rows_raw, rows_kept, illiquid_ratio, excluded; symbols without a row have ratio 1."""
    own = flags.groupBy("symbol").agg(F.count("*").alias("rows_raw"), F.count_if(~F.col("illiquid")).alias("rows_kept"))
    own = own if symbols is None else symbols.select("symbol").distinct().join(own, "symbol", "left").na.fill(0)
    ratio = F.when(F.col("rows_raw") > 0, 1 - F.col("rows_kept") / F.col("rows_raw")).otherwise(1.0)
    return own.withColumn("illiquid_ratio", ratio).withColumn("excluded", ratio > most)


def liquid(bars: DataFrame, streak: int = 3, most: float = 0.4, least_rows: int = 0) -> DataFrame:
    """The liquid rows of symbols that are not excluded and keep least_rows rows."""
    flags = flagged(bars, streak)
    stay = liquidity(flags, most=most).where(~F.col("excluded") & (F.col("rows_kept") >= least_rows)).select("symbol")
    return flags.where(~F.col("illiquid")).drop("illiquid").join(stay, "symbol", "left_semi")


def change(percent_digits: int | None = 2) -> Column:
    """Change to the last known close before, in percent rounded half to even, or as a ratio where digits are None."""
    before = F.last("close", ignorenulls=True).over(by_date().rowsBetween(Window.unboundedPreceding, -1))
    now = F.last("close", ignorenulls=True).over(by_date().rowsBetween(Window.unboundedPreceding, 0))
    ratio = F.try_divide(now, before) - 1
    return ratio if percent_digits is None else F.bround(100 * ratio, percent_digits)


def turnover() -> Column:
    return F.bround(F.col("volume") * (F.col("high") + F.col("low")) / 2, 0)


def as_of(bars: DataFrame, at, years: int) -> DataFrame:
    """Rows of the years up to a date, both ends included."""
    at = F.lit(at).cast("date")
    return bars.where(F.col("date").between(F.add_months(at, -12 * years), at))


def filled(bars: DataFrame, dates: DataFrame) -> DataFrame:
    """symbol, date, close for all dates from each symbol's first on, the last known close carried on; one sort, no product of rows that are dropped later."""
    first = bars.groupBy("symbol").agg(F.min("date").alias("first_"))
    grid = first.join(F.broadcast(dates.select("date").distinct()), F.col("date") >= F.col("first_")).select("symbol", "date")
    own = grid.join(bars.select("symbol", "date", "close"), ["symbol", "date"], "left")
    return own.withColumn("close", F.last("close", ignorenulls=True).over(by_date().rowsBetween(Window.unboundedPreceding, 0)))


def last_bars(bars: DataFrame, n: int) -> DataFrame:
    newest = Window.partitionBy("symbol").orderBy(F.desc("date"))
    return bars.withColumn("rank_", F.row_number().over(newest)).where(F.col("rank_") <= n).drop("rank_")


def sparklines(bars: DataFrame, n: int = 30) -> DataFrame:
    """symbol, dates and closes of the last n bars in order."""
    own = last_bars(bars, n).groupBy("symbol").agg(F.sort_array(F.collect_list(F.struct("date", "close"))).alias("own_"))
    return own.select("symbol", F.col("own_.date").alias("dates"), F.col("own_.close").alias("closes"))


def period_start(date: Column, period: str) -> Column:
    """First day of the week, month, quarter, semester or year."""
    if period == "semester":
        return F.make_date(F.year(date), F.when(F.month(date) > 6, 7).otherwise(1), F.lit(1))
    return F.trunc(date, period)


def calendar_attributes(dates: DataFrame) -> DataFrame:
    """year, quarter, semester, month, iso_week, weekday (Monday is 1), year_month and flags of period starts for each date."""
    d = F.col("date")
    flags = [(d == period_start(d, p)).alias(f"starts_{p}") for p in ("week", "month", "quarter", "semester", "year")]
    return dates.select("date", F.year(d).alias("year"), F.quarter(d).alias("quarter"), F.when(F.month(d) > 6, 2).otherwise(1).alias("semester"), F.month(d).alias("month"), F.weekofyear(d).alias("iso_week"), (F.weekday(d) + 1).alias("weekday"), F.date_format(d, "yyyy-MM").alias("year_month"), *flags)


def returns_since(bars: DataFrame, period: str) -> DataFrame:
    """symbol, ret: from the last close before the period of the symbol's last bar to that bar."""
    end = bars.groupBy("symbol").agg(F.max("date").alias("end_"), F.max_by("close", "date").alias("last_"))
    own = bars.join(end, "symbol").where(F.col("date") < period_start(F.col("end_"), period))
    return own.groupBy("symbol").agg((F.first("last_") / F.max_by("close", "date") - 1).alias("ret"))


def kendall_pairs(values: DataFrame) -> DataFrame:
    """a, b, n, tau (tau-b) of series (symbol, date, value); every pair of dates of a pair of symbols counts, so keep the dates few (months, not days)."""
    x = values.select(F.col("symbol").alias("a"), "date", F.col("value").alias("x"))
    y = values.select(F.col("symbol").alias("b"), "date", F.col("value").alias("y"))
    own = x.join(y, "date").where("a < b")
    late = own.select("a", "b", F.col("date").alias("date2"), F.col("x").alias("x2"), F.col("y").alias("y2"))
    two = own.join(late, ["a", "b"]).where("date < date2").select("a", "b", F.signum(F.col("x2") - F.col("x")).alias("dx"), F.signum(F.col("y2") - F.col("y")).alias("dy"))
    sums = two.groupBy("a", "b").agg(F.sum(F.col("dx") * F.col("dy")).alias("s"), F.sum(F.abs("dx")).alias("px"), F.sum(F.abs("dy")).alias("py"), F.count("*").alias("n"))
    return sums.select("a", "b", "n", F.try_divide("s", F.sqrt(F.col("px") * F.col("py"))).alias("tau"))


def parabolic_sar(bars: DataFrame, step: float = 0.02, most: float = 0.2) -> DataFrame:
    """symbol, date, sar, rising: Wilder's stop and reverse from each symbol's second bar on.

    The first trend is that of the first two closes, equal ones count as rising. Bars with a
    null date, high, low or close are left out. A group is one symbol's days.
    """

    def follow(own):
        own = own.sort_values("date", kind="stable")
        high, low, close = (own[c].to_numpy(float) for c in ("high", "low", "close"))
        stops, trends = [], []
        for i in range(1, len(own)):
            if i == 1:
                rising = close[1] >= close[0]
                stop, extreme, pace = (low[0], max(high[0], high[1]), step) if rising else (high[0], min(low[0], low[1]), step)
            else:
                stop += pace * (extreme - stop)
                stop = min(stop, low[i - 1], low[i - 2]) if rising else max(stop, high[i - 1], high[i - 2])
                if low[i] < stop if rising else high[i] > stop:
                    rising, stop, extreme, pace = not rising, extreme, low[i] if rising else high[i], step
                elif high[i] > extreme if rising else low[i] < extreme:
                    extreme, pace = high[i] if rising else low[i], min(pace + step, most)
            stops.append(stop)
            trends.append(bool(rising))
        return own[["symbol", "date"]].iloc[1:].assign(sar=stops, rising=trends)

    own = bars.select("symbol", "date", *(F.col(c).cast("double").alias(c) for c in ("high", "low", "close"))).dropna(subset=["date", "high", "low", "close"])
    kinds = dict(own.dtypes)
    return own.groupBy("symbol").applyInPandas(follow, f"symbol {kinds['symbol']}, date {kinds['date']}, sar double, rising boolean")
