"""Covariance, views, weights, forecasts and walk-forward curves; everything is keyed by as_of, so all dates run in one job."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HORIZON = 30
RISK_FREE = 1.03 ** (30 / 365) - 1
YEAR = 365.25
#: Sine and cosine pairs of the yearly season in a forecast.
ORDER = 3
Z80 = 1.2815515655446004


def aligned_returns(bars: DataFrame, grid: DataFrame, years: int = 3, least: int = 30) -> DataFrame:
    """as_of, symbol, date, ret: daily returns over the dates on which every symbol with enough rows in the window has a close."""
    own = bars.select("symbol", "date", "close").join(F.broadcast(grid.select("as_of")), F.col("date").between(F.add_months("as_of", -12 * years), F.col("as_of")))
    enough = own.groupBy("as_of", "symbol").agg(F.count("*").alias("n")).where(F.col("n") >= least).select("as_of", "symbol")
    own = own.join(enough, ["as_of", "symbol"], "left_semi")
    full = own.groupBy("as_of", "date").agg(F.count("*").alias("n")).join(enough.groupBy("as_of").agg(F.count("*").alias("p")), "as_of").where("n = p and p >= 2").select("as_of", "date")
    own = own.join(full, ["as_of", "date"], "left_semi")
    ret = F.col("close") / F.lag("close").over(Window.partitionBy("as_of", "symbol").orderBy("date")) - 1
    return own.withColumn("ret", ret).where("ret is not null").select("as_of", "symbol", "date", "ret")


def shrunk_covariance(returns: DataFrame) -> DataFrame:
    """as_of, a, b (both orders), raw (sample covariance), shrunk (Ledoit and Wolf 2004, towards the mean variance), shrinkage.

    All are sums over dates: products of pairs by a join on the date, and the squared norm of each date.
    """
    centred = returns.withColumn("x", F.col("ret") - F.avg("ret").over(Window.partitionBy("as_of", "symbol"))).select("as_of", "date", "symbol", "x")
    left, right = (centred.select("as_of", "date", F.col("symbol").alias(s), F.col("x").alias(f"x{s}")) for s in "ab")
    pairs = left.join(right, ["as_of", "date"]).groupBy("as_of", "a", "b").agg(F.sum(F.col("xa") * F.col("xb")).alias("s"), F.count("*").alias("n"))
    pairs = pairs.withColumn("cov", F.col("s") / F.col("n"))
    fourth = centred.groupBy("as_of", "date").agg(F.sum(F.col("x") * F.col("x")).alias("q")).groupBy("as_of").agg(F.sum(F.col("q") * F.col("q")).alias("q2"))
    whole = pairs.groupBy("as_of").agg(F.sum(F.when(F.col("a") == F.col("b"), F.col("cov"))).alias("trace"), F.sum(F.col("cov") * F.col("cov")).alias("norm"), F.count_if(F.col("a") == F.col("b")).alias("p"), F.max("n").alias("dates")).join(fourth, "as_of")
    p, n = F.col("p"), F.col("dates")
    mu = F.col("trace") / p
    delta = F.col("norm") / p - mu * mu
    beta = F.least(delta, (F.col("q2") / n - F.col("norm")) / (p * n))
    whole = whole.select("as_of", mu.alias("mu"), F.when(delta > 0, F.greatest(beta, F.lit(0.0)) / delta).otherwise(0.0).alias("shrinkage"))
    w = F.col("shrinkage")
    target = F.when(F.col("a") == F.col("b"), F.col("mu")).otherwise(0.0)
    raw = F.when(F.col("n") > 1, F.col("s") / (F.col("n") - 1))
    return pairs.join(F.broadcast(whole), "as_of").select("as_of", "a", "b", raw.alias("raw"), ((1 - w) * F.col("cov") + w * target).alias("shrunk"), "shrinkage")


def matrix(own: pd.DataFrame, value: str) -> tuple[list[str], np.ndarray]:
    names = sorted(own["a"].unique())
    return names, own.pivot(index="a", columns="b", values=value).loc[names, names].to_numpy(float)


def condition_number(m: np.ndarray) -> float:
    """Infinite where there is none, as for a covariance of a single date."""
    try:
        return float(np.linalg.cond(m)) if np.isfinite(m).all() else float("inf")
    except np.linalg.LinAlgError:
        return float("inf")


def conditioned(covariance: DataFrame, most: float = 1000.0, horizon: int = HORIZON) -> DataFrame:
    """as_of, a, b, cov (over the horizon; diagonal only where the condition number stays above most), cond_raw, cond_shrunk, fallback. One matrix of the symbols for each as_of."""

    def one(own: pd.DataFrame) -> pd.DataFrame:
        names, shrunk = matrix(own, "shrunk")
        raw = condition_number(matrix(own, "raw")[1])
        cond = condition_number(shrunk)
        fallback = cond > most
        if fallback:
            shrunk = np.diag(np.diag(shrunk))
            cond = condition_number(shrunk)
        p = len(names)
        return pd.DataFrame({"as_of": [own["as_of"].iloc[0]] * p * p, "a": np.repeat(names, p), "b": names * p, "cov": horizon * shrunk.ravel(), "cond_raw": raw, "cond_shrunk": cond, "fallback": fallback})

    return covariance.groupBy("as_of").applyInPandas(one, "as_of date, a string, b string, cov double, cond_raw double, cond_shrunk double, fallback boolean")


def view_columns() -> tuple[Column, Column]:
    """Expected return and variance of a view from last_price, target, yhat and its bounds."""
    width = (F.col("yhat_upper") - F.col("yhat_lower")) / F.greatest(F.col("yhat"), F.lit(1e-9))
    return F.col("target") / F.col("last_price") - 1, F.greatest(width * width, F.lit(1e-4))


def posterior(cov: np.ndarray, views: np.ndarray, variances: np.ndarray, seen: np.ndarray, tau: float = 0.05) -> tuple[np.ndarray, np.ndarray]:
    """Black and Litterman with a prior of zero and a view on each seen symbol: returns and covariance."""
    p = np.eye(len(cov))[seen]
    gain = tau * cov @ p.T @ np.linalg.inv(p @ (tau * cov) @ p.T + np.diag(variances))
    return gain @ views, cov + tau * cov - gain @ p @ (tau * cov)


def projected(v: np.ndarray, most: float) -> np.ndarray:
    """The nearest weights between 0 and most that add up to 1."""
    low, high = v.min() - most - 1, v.max() + 1
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if np.clip(v - mid, 0, most).sum() > 1 else (low, mid)
    return np.clip(v - (low + high) / 2, 0, most)


def largest_return(mu: np.ndarray, most: float) -> np.ndarray:
    """Weights of largest return, between 0 and most and adding up to 1: the best symbols as far as they may go."""
    w = np.zeros(len(mu))
    for k in np.argsort(-mu, kind="stable"):
        w[k] = min(most, 1 - w.sum())
    return w


def least_variance(cov: np.ndarray, most: float = 1.0, rounds: int = 20_000) -> np.ndarray:
    """Weights of smallest variance, between 0 and most and adding up to 1, by accelerated projected steps."""
    w = before = projected(np.full(len(cov), 1 / len(cov)), most)
    pace = 1 / max(float(np.linalg.eigvalsh(cov)[-1]), 1e-300)
    t = 1.0
    for _ in range(rounds):
        later = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead = w + (t - 1) / later * (w - before)
        before, w, t = w, projected(ahead - pace * (cov @ ahead), most), later
        if np.abs(w - before).max() < 1e-14:
            break
        if (ahead - w) @ (w - before) > 0:  # the pace overshot
            t = 1.0
    return w


def max_sharpe(mu: np.ndarray, cov: np.ndarray, most: float = 0.25, rate: float = RISK_FREE, rounds: int = 4000) -> np.ndarray | None:
    """Weights of largest excess return per deviation, between 0 and most, adding up to 1; None where no such weights beat the rate or the bounds allow no sum of 1.

    The ratio does not change with the weights' scale, so y = w / excess minimises y'Cy where the
    excess is 1; the bounds become y <= most * sum(y). Solved by projected steps on w with the
    sum and the bounds held by a shift.
    """
    n = len(mu)
    excess = mu - rate
    if n * most < 1 - 1e-12:
        return None
    w = largest_return(excess, most)
    if excess @ w <= 0:
        return None
    project = lambda v: projected(v, most)
    step, ratio = 1.0, lambda w: excess @ w / np.sqrt(w @ cov @ w)
    best = ratio(w)
    for _ in range(rounds):
        risk = w @ cov @ w
        slope = excess / np.sqrt(risk) - (excess @ w) * (cov @ w) / risk**1.5
        scale = max(np.abs(slope).max(), 1e-18)
        while step > 1e-12:
            new = project(w + step * slope / scale)
            got = ratio(new)
            if got > best + 1e-15:
                w, best, step = new, got, min(step * 2, 1.0)
                break
            step /= 2
        else:
            break
    return w


WEIGHTS = "as_of date, symbol string, weight double, expected_return double, expected_volatility double, sharpe double"


def weights(cov: DataFrame, views: DataFrame, most: float = 0.25, cutoff: float = 1e-4, least: int = 2) -> DataFrame:
    """WEIGHTS from cov (as_of, a, b, cov) and views (as_of, symbol, view, variance): symbols with a weight; dates without an answer, or with fewer views than least, have no row."""

    def one(key, own: pd.DataFrame, seen: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({f.split()[0]: pd.Series([], dtype=object) for f in WEIGHTS.split(", ")})
        if own.empty or len(seen) < least:
            return none
        names, c = matrix(own, "cov")
        seen = seen[seen["symbol"].isin(names)].sort_values("symbol")
        if seen.empty:
            return none
        at = np.array([names.index(s) for s in seen["symbol"]])
        mu, sigma = posterior(c, seen["view"].to_numpy(float), seen["variance"].to_numpy(float), at)
        w = max_sharpe(mu, sigma, most)
        if w is None:
            return none
        w = np.where(w < cutoff, 0.0, w)
        ret, vol = float(mu @ w), float(np.sqrt(w @ sigma @ w))
        held = np.flatnonzero(w)
        return pd.DataFrame({"as_of": [key[0]] * len(held), "symbol": [names[k] for k in held], "weight": w[held], "expected_return": ret, "expected_volatility": vol, "sharpe": (ret - RISK_FREE) / vol})

    return cov.select("as_of", "a", "b", "cov").groupBy("as_of").cogroup(views.groupBy("as_of")).applyInPandas(one, WEIGHTS)


def _terms(day: Column) -> list[Column]:
    """Features of a forecast at a day counted from the end of its training."""
    out = [F.lit(1.0), day / YEAR]
    for k in range(1, ORDER + 1):
        out += [F.sin(2 * np.pi * k * day / YEAR), F.cos(2 * np.pi * k * day / YEAR)]
    return out


FORECAST = "as_of date, symbol string, last_price double, last_date date, yhat double, yhat_lower double, yhat_upper double, train_rows long, train_start date, train_annualized_return double"


def forecasts(bars: DataFrame, grid: DataFrame, years: int = 3, horizon: int = HORIZON, least: int = 60, ridge: float = 1e-3) -> DataFrame:
    """FORECAST for each as_of and symbol with enough rows: trend and yearly season by ridge regression, and its 80 % interval.

    The sums of products are Spark aggregates over (as_of, symbol); a task solves one small
    system for each group. It is another estimator than the usual additive models, with the same fields and guards.
    """
    own = bars.select("symbol", "date", "close").join(F.broadcast(grid.select("as_of")), F.col("date").between(F.add_months("as_of", -12 * years), F.col("as_of")))
    end = own.groupBy("as_of", "symbol").agg(F.max("date").alias("last_date"), F.max_by("close", "date").alias("last_price"), F.count("*").alias("n"), F.min("date").alias("train_start"), F.min_by("close", "date").alias("first_")).where(F.col("n") >= least)
    days = F.datediff("last_date", "train_start")
    yearly = F.when((F.col("first_") > 0) & (F.col("last_price") > 0) & (days > 0), F.pow(F.col("last_price") / F.col("first_"), 365.0 / days) - 1).otherwise(0.0)
    end = end.withColumn("train_annualized_return", yearly).drop("first_")
    own = own.join(end, ["as_of", "symbol"]).withColumn("day", F.datediff("date", "last_date").cast("double"))
    x = _terms(F.col("day"))
    m = len(x)
    sums = [F.sum(x[i] * x[j]).alias(f"xx{i}_{j}") for i in range(m) for j in range(i, m)] + [F.sum(x[i] * F.col("close")).alias(f"xy{i}") for i in range(m)]
    own = own.groupBy("as_of", "symbol", "last_date", "last_price", "n", "train_start", "train_annualized_return").agg(*sums, F.sum(F.col("close") * F.col("close")).alias("yy"))
    ahead = [1.0, horizon / YEAR] + [f(2 * np.pi * k * horizon / YEAR) for k in range(1, ORDER + 1) for f in (np.sin, np.cos)]

    def solve(batches):
        for batch in batches:
            out = []
            for r in batch.to_dict("records"):
                a = np.zeros((m, m))
                for i in range(m):
                    for j in range(i, m):
                        a[i, j] = a[j, i] = r[f"xx{i}_{j}"]
                b = np.array([r[f"xy{i}"] for i in range(m)])
                keep = np.diag([0.0] + [ridge * r["n"]] * (m - 1))
                w = np.linalg.lstsq(a + keep, b, rcond=None)[0]
                rest = max(r["yy"] - 2 * w @ b + w @ a @ w, 0.0)
                y, s = float(np.dot(ahead, w)), Z80 * float(np.sqrt(rest / max(r["n"] - m, 1)))
                out.append((r["as_of"], r["symbol"], r["last_price"], r["last_date"], y, y - s, y + s, r["n"], r["train_start"], r["train_annualized_return"]))
            yield pd.DataFrame(out, columns=[f.split()[0] for f in FORECAST.split(", ")])

    return own.mapInPandas(solve, FORECAST)


def signal_class(last: Column, target: Column) -> Column:
    rise = F.try_divide(target, last) - 1
    return F.when((last <= 0) | last.isNull(), "NEUTRE").when(rise >= 0.10, "ACHAT FORT").when(rise >= 0.03, "ACHAT").when(rise >= -0.03, "NEUTRE").when(rise >= -0.10, "VENTE").otherwise("VENTE FORTE")


def confidence(lower: Column, upper: Column, middle: Column) -> Column:
    width = F.try_divide(upper - lower, middle)
    return F.when(middle <= 0, "Basse").when(width < 0.15, "Haute").when(width < 0.30, "Moyenne").otherwise("Basse")


def signals(forecast: DataFrame) -> DataFrame:
    """The forecast's record: class, confidence, trend and rounded values."""
    two = lambda c: F.bround(c, 2).alias(c)
    return forecast.select("as_of", "symbol", two("last_price"), "last_date", signal_class(F.col("last_price"), F.col("yhat")).alias("signal"), confidence(F.col("yhat_lower"), F.col("yhat_upper"), F.col("yhat")).alias("confidence"), F.bround("yhat", 2).alias("target_30d"), F.when(F.col("yhat") > F.col("last_price"), "UP").otherwise("DOWN").alias("trend"), two("yhat"), two("yhat_lower"), two("yhat_upper"), "train_start", F.col("last_date").alias("train_end"), "train_rows", F.bround("train_annualized_return", 4).alias("train_annualized_return"))


def concentration(classes: DataFrame, most: float = 0.7) -> DataFrame:
    """One row for signals (signal): the commonest class (ties: first by name), its share, whether it is above most, and n; for no signals null, 0, false and 0."""
    own = classes.groupBy("signal").agg(F.count("*").alias("c"))
    own = own.agg(F.min_by("signal", F.struct(-F.col("c"), "signal")).alias("dominant"), F.max("c").alias("c"), F.coalesce(F.sum("c"), F.lit(0)).alias("n"))
    ratio = F.when(F.col("n") > 0, F.col("c") / F.col("n")).otherwise(0.0)
    return own.select("dominant", ratio.alias("ratio"), (ratio > most).alias("flagged"), "n")


def month_grid(first, last) -> Column:
    """First days of the months between two dates."""
    return F.explode(F.sequence(F.trunc(F.add_months(F.date_sub(first, 1), 1), "month"), F.trunc(last, "month"), F.expr("interval 1 month"))).alias("date")


def walk_forward(periods: DataFrame, weight_rows: DataFrame, returns: DataFrame) -> DataFrame:
    """date, curve, level: three curves from 1.0 on over periods (start, end).

    weight_rows (start, symbol, weight), returns (start, symbol, ret: null where the symbol has no
    price). Curves: 'algo' by the period's weights, 'bh' by the first weights of all, 'bench' equal
    over the symbols that had a return in the first valid period. A period without weights or
    returns carries all curves. The curve's window has one row a period.
    """
    valid = weight_rows.select("start").distinct().join(returns.where("ret is not null").select("start").distinct(), "start", "left_semi")
    first = valid.agg(F.min("start").alias("start"))
    bh = weight_rows.join(first, "start", "left_semi").select("symbol", F.col("weight").alias("bh"))
    equal = returns.where("ret is not null").join(first, "start", "left_semi").select("symbol", (F.lit(1.0) / F.count("*").over(Window.partitionBy(F.lit(1)))).alias("bench"))
    own = returns.join(valid, "start", "left_semi").join(weight_rows.select("start", "symbol", F.col("weight").alias("algo")), ["start", "symbol"], "left").join(bh, "symbol", "left").join(equal, "symbol", "left")
    gains = own.groupBy("start").agg(*(F.sum(F.coalesce(c, F.lit(0.0)) * F.coalesce("ret", F.lit(0.0))).alias(c) for c in ("algo", "bh", "bench")))
    steps = periods.join(gains, "start", "left").select(F.col("end").alias("date"), *(F.coalesce(c, F.lit(0.0)).alias(c) for c in ("algo", "bh", "bench")))
    steps = periods.agg(F.min("start").alias("date")).where("date is not null").select("date", *(F.lit(0.0).alias(c) for c in ("algo", "bh", "bench"))).unionByName(steps)
    long = steps.unpivot("date", ["algo", "bh", "bench"], "curve", "gain")
    return long.withColumn("level", F.product(1 + F.col("gain")).over(Window.partitionBy("curve").orderBy("date"))).select("date", "curve", "level")


def curve_metrics(curves: DataFrame) -> DataFrame:
    """curve, sharpe, max_drawdown, cagr of monthly curves (curve, date, level), rounded to 3 digits; zeros for fewer than two points or a flat curve."""
    by_date = Window.partitionBy("curve").orderBy("date")
    own = curves.withColumn("ret", F.col("level") / F.lag("level").over(by_date) - 1).withColumn("fall", F.col("level") / F.max("level").over(by_date) - 1)
    own = own.groupBy("curve").agg(F.count("*").alias("n"), F.avg("ret").alias("mean"), F.stddev_samp("ret").alias("dev"), F.min("fall").alias("fall"), F.min_by("level", "date").alias("first"), F.max_by("level", "date").alias("final"), F.datediff(F.max("date"), F.min("date")).alias("days"))
    some = F.col("n") >= 2
    sharpe = F.when(some & (F.col("dev") > 0), F.col("mean") * 12 / (F.col("dev") * F.sqrt(F.lit(12.0)))).otherwise(0.0)
    cagr = F.when(some, F.pow(F.col("final") / F.col("first"), F.lit(365.0) / F.greatest(F.col("days"), F.lit(1))) - 1).otherwise(0.0)
    return own.select("curve", F.bround(sharpe, 3).alias("sharpe"), F.bround(F.when(some, F.col("fall")).otherwise(0.0), 3).alias("max_drawdown"), F.bround(cagr, 3).alias("cagr"))
