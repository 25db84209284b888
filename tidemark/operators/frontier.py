"""The efficient frontier: a cloud of random portfolios and the portfolios at its ends."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.allocation import largest_return, least_variance, matrix, max_sharpe

#: Symbols of a frontier: its matrix goes to every task.
MOST_SYMBOLS = 2000
ROWS = "kind string, id long, ret double, risk double, sharpe double, weights array<double>"


def random_weights(ids: np.ndarray, symbols: int, seed: int) -> np.ndarray:
    """Weights that add up to 1, evenly distributed over all such, as a function of the seed and the portfolio's id alone."""
    x = (ids.astype(np.uint64)[:, None] * np.uint64(symbols) + np.arange(symbols, dtype=np.uint64)) + np.uint64(seed) * np.uint64(0x9E3779B97F4A7C15)
    with np.errstate(over="ignore"):
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
        x ^= x >> np.uint64(31)
    parts = -np.log1p(-((x >> np.uint64(11)) * 2.0**-53))
    parts += 1e-300
    return parts / parts.sum(1, keepdims=True)


def described(kind: str, ids, weights: np.ndarray, mu: np.ndarray, cov: np.ndarray, rate: float) -> pd.DataFrame:
    ret, risk = weights @ mu, np.sqrt(np.maximum(np.einsum("ri,ij,rj->r", weights, cov, weights, optimize=True), 0))
    sharpe = np.divide(ret - rate, risk, out=np.zeros_like(ret), where=risk > 0)
    return pd.DataFrame({"kind": kind, "id": ids, "ret": ret, "risk": risk, "sharpe": sharpe, "weights": list(weights)})


def frontier(expected: DataFrame, covariance: DataFrame, portfolios: int, rate: float = 0.0, most: float = 1.0, seed: int = 1) -> DataFrame:
    """ROWS: portfolios of kind simulated, and those of least variance, largest return and largest Sharpe ratio (where one beats the rate).

    expected (symbol, ret) and covariance (a, b, cov, both orders) are of one date and at most
    MOST_SYMBOLS symbols; weights are in order of the symbols' names. The cloud is drawn in
    tasks, and a portfolio is the same whichever task draws it. Without symbols there are no rows.
    """
    spark = expected.sparkSession
    means = dict(expected.where("ret is not null").select("symbol", "ret").limit(MOST_SYMBOLS + 1).collect())
    assert len(means) <= MOST_SYMBOLS, "too many symbols for one frontier"
    own = covariance.select("a", "b", "cov").where(F.col("a").isin(list(means)) & F.col("b").isin(list(means))).toPandas()
    if own.empty:
        return spark.createDataFrame([], ROWS)
    names, cov = matrix(own, "cov")
    mu = np.array([means[s] for s in names])

    def draw(batches):
        for batch in batches:
            ids = batch["id"].to_numpy()
            for at in range(0, len(ids), 4096):
                yield described("simulated", ids[at : at + 4096], random_weights(ids[at : at + 4096], len(mu), seed), mu, cov, rate)

    ends = {"min_variance": least_variance(cov, most), "max_return": largest_return(mu, most), "max_sharpe": max_sharpe(mu, cov, most, rate)}
    ends = pd.concat([described(k, [-1 - i], w[None], mu, cov, rate) for i, (k, w) in enumerate(ends.items()) if w is not None])
    ends["weights"] = [[float(x) for x in w] for w in ends["weights"]]
    return spark.range(portfolios).mapInPandas(draw, ROWS).unionByName(spark.createDataFrame(ends, ROWS))
