"""The classifier, the walk-forward lineage, the frontier and comparisons against plain Python."""

import datetime as dt
import json
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import allocation, direction, frontier, lineage

D = dt.date


def series(spark, values, start=D(2020, 1, 1), step=1):
    """Bars of symbols' closes, a day apart; a null close is a missing bar."""
    rows = [(s, start + dt.timedelta(step * k), float(c), float(c), float(c), 10.0 + k % 3) for s, own in values.items() for k, c in enumerate(own) if c is not None]
    return spark.createDataFrame(rows, "symbol string, date date, high double, low double, close double, volume double")


def walk(seed, n, drift=0.0005, sigma=0.01):
    rng = np.random.default_rng(seed)
    return list(100 * np.exp(np.cumsum(rng.normal(drift, sigma, n))))


def test_direction_looks_back_only(spark):
    whole = series(spark, {"A": walk(1, 120), "B": walk(2, 120)})
    early = whole.where(F.col("date") < D(2020, 3, 20))
    columns = ["symbol", "date", *direction.FEATURES]
    a = {tuple(r) for r in direction.features(whole, 3).where(F.col("date") < D(2020, 3, 20)).select(*columns).collect()}
    assert a == {tuple(r) for r in direction.features(early, 3).select(*columns).collect()} and len(a) == 2 * (79 - 20)
    parts = direction.split(direction.features(whole, 3)).groupBy("part").agg(F.min("date").alias("first"), F.max("label_date").alias("reach"), F.count("*").alias("n"))
    parts = {r.part: r for r in parts.collect()}
    assert parts["train"].reach < parts["test"].first and parts["open"].n == 6 and parts["between"].n > 0
    by_hand = {k: c for k, c in enumerate(walk(1, 120))}
    for r in direction.features(whole, 3).where("symbol = 'A'").collect():
        k = (r.date - D(2020, 1, 1)).days
        assert r.label == (None if k + 3 > 119 else int(by_hand[k + 3] > by_hand[k]))
        assert r.ret5 == pytest.approx(by_hand[k] / by_hand[k - 5] - 1) and r.mean10 == pytest.approx(by_hand[k] / np.mean([by_hand[j] for j in range(k - 9, k + 1)]) - 1)


def test_direction_measures(spark):
    rng = random.Random(4)
    rows = [(rng.choice([0, 1, None]), rng.choice([0, 1])) for _ in range(300)]
    got = direction.measured(spark.createDataFrame(rows, "label int, predicted int")).first()
    known = [r for r in rows if r[0] is not None]

    def f1(c):
        tp = sum(y == z == c for y, z in known)
        precision, recall = tp / sum(z == c for _, z in known), tp / sum(y == c for y, _ in known)
        return 2 * precision * recall / (precision + recall)

    assert got.n == len(known) and got.accuracy == pytest.approx(sum(y == z for y, z in known) / len(known))
    assert (got.f1_up, got.f1_down, got.f1_macro) == pytest.approx((f1(1), f1(0), (f1(0) + f1(1)) / 2))
    assert tuple(direction.measured(spark.createDataFrame([], "label int, predicted int")).first()) == (0, 0, 0, 0, 0)


def test_direction_learns(spark):
    """A series that turns every three days can be foretold; one class alone cannot be learned."""
    wave = [100 + 5 * abs(k % 6 - 3) + 0.01 * (k * 7 % 5) for k in range(260)]
    rows = direction.split(direction.features(series(spark, {"A": wave, "B": wave[2:]})))
    model = direction.trained(rows.where("part = 'train'"), rounds=5)
    got = direction.measured(direction.predicted(model, rows.where("part = 'test'"))).first()
    assert got.accuracy > 0.95 and got.f1_macro > 0.95
    found = direction.importances(spark, model).collect()
    assert [r.feature for r in found] == direction.FEATURES and sum(r.importance for r in found) == pytest.approx(1)
    rising = direction.split(direction.features(series(spark, {"A": list(range(1, 90))})))
    assert direction.trained(rising.where("part = 'train'")) is None


@pytest.fixture(scope="module")
def runs(spark):
    values = {s: walk(k, 330, 0.001 * (k + 1), 0.008) for k, s in enumerate("ABCDE")}
    values["F"] = [None] * 200 + walk(9, 130)  # listed late
    whole = series(spark, values)
    cut = D(2020, 10, 1)
    return lineage.walk_forward(whole, years=1), lineage.walk_forward(whole.where(F.col("date") <= cut), years=1), cut, whole


def test_later_rows_change_nothing_earlier(runs):
    whole, early, cut, _ = runs
    rows = lambda t, *c: {tuple(r[:2]): r[2] for r in t.select(*c).collect()}
    a, b = rows(whole.weights.where(F.col("start") < cut), "start", "symbol", "weight"), rows(early.weights, "start", "symbol", "weight")
    assert a == pytest.approx(b, abs=1e-5) and len({r[0] for r in a}) >= 4  # sums of other partitions differ in their last digits
    assert rows(whole.curves.where(F.col("date") <= cut), "date", "curve", "level") == pytest.approx(rows(early.curves, "date", "curve", "level"), abs=1e-5)
    assert all(r.as_of < r.start for r in whole.weights.collect()) and max(r.last_date for r in whole.forecasts.collect()) < D(2020, 12, 1)


def test_curves_follow_the_weights(runs):
    run, _, _, bars = runs
    closes = {}
    for r in bars.collect():
        closes.setdefault(r.symbol, {})[r.date] = r.close
    weights = {}
    for r in run.weights.collect():
        weights.setdefault(r.start, {})[r.symbol] = r.weight
    periods = sorted((r.start, r.end) for r in run.periods.collect())
    assert periods[0] == (D(2020, 1, 1), D(2020, 2, 1)) and all(b == c for (_, b), (c, _) in zip(periods, periods[1:], strict=False))
    levels, first, equal, want = {"algo": 1.0, "bh": 1.0, "bench": 1.0}, None, None, {(periods[0][0], c): 1.0 for c in ("algo", "bh", "bench")}
    for start, end in periods:
        if start in weights:
            at = lambda s, d: closes[s].get(d)
            ret = {s: at(s, end) / at(s, start) - 1 if at(s, start) else None for s in closes}
            first = first or weights[start]
            equal = equal or {s: 1 / sum(r is not None for r in ret.values()) for s, r in ret.items() if r is not None}
            for c, w in (("algo", weights[start]), ("bh", first), ("bench", equal)):
                levels[c] *= 1 + sum(x * (ret[s] or 0) for s, x in w.items())
        want |= {(end, c): v for c, v in levels.items()}
    got = {(r.date, r.curve): r.level for r in run.curves.collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want) and levels["algo"] != 1.0
    for own in weights.values():
        assert sum(own.values()) == pytest.approx(1, abs=1e-3) and max(own.values()) <= 0.25 + 1e-9


def test_holding_returns_of_a_gap(spark):
    panel = spark.createDataFrame([("A", D(2021, 1, 31), 10.0), ("A", D(2021, 2, 3), 20.0), ("A", D(2021, 2, 25), 30.0), ("B", D(2021, 2, 25), 5.0), ("A", D(2021, 3, 1), 60.0), ("B", D(2021, 3, 1), 10.0), ("A", D(2021, 4, 20), 70.0), ("B", D(2021, 4, 20), 20.0)], "symbol string, date date, close double")
    got = {(r.start, r.symbol): r.ret for r in lineage.holding_returns(panel, lineage.month_periods(panel)).collect()}
    # February: first date the 3rd, last the 1st of March; March has a single date and April does not end.
    assert got == {(D(2021, 2, 1), "A"): 2.0, (D(2021, 2, 1), "B"): None}
    assert lineage.month_periods(panel.limit(0)).count() == 0


def test_document(spark):
    values = {s: walk(k, 100) for k, s in enumerate("ABC")} | {"Z": [5.0] * 100}
    bars = series(spark, values)
    got = lineage.signals_document(bars, bars.agg(F.max("date").alias("as_of"))).first()
    doc = json.loads(got.document)
    assert set(doc["signals"]) == {"A", "B", "C"} and doc["as_of"] == str(got.as_of) and doc["horizon_days"] == 30
    assert {r["symbol"]: r["excluded"] for r in doc["liquidity_diagnostics"]} == {"A": False, "B": False, "C": False, "Z": True}
    one = doc["signals"]["A"]
    assert one["train_rows"] == 100 and one["train_start"] == "2020-01-01" and one["train_end"] == one["last_date"] == "2020-04-09"
    yearly = (values["A"][-1] / values["A"][0]) ** (365 / 99) - 1
    assert one["train_annualized_return"] == pytest.approx(yearly, abs=1e-4)
    assert doc["concentration_diagnostic"]["n"] == 3
    none = lineage.signals_document(bars.limit(10), bars.agg(F.min("date").alias("as_of"))).first()
    assert json.loads(none.document)["signals"] == {}


def test_frontier(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(40, 6))
    cov, mu, names = x.T @ x / 40, rng.normal(size=6), list("ABCDEF")
    expected = spark.createDataFrame([(s, float(m)) for s, m in zip(names, mu, strict=True)] + [("G", None)], "symbol string, ret double")
    pairs = spark.createDataFrame([(a, b, float(cov[i, j])) for i, a in enumerate(names) for j, b in enumerate(names)], "a string, b string, cov double")
    rows = frontier.frontier(expected, pairs, 3000).collect()
    cloud = [r for r in rows if r.kind == "simulated"]
    ends = {r.kind: r for r in rows if r.kind != "simulated"}
    assert len(cloud) == 3000 and {r.id for r in cloud} == set(range(3000))
    assert all(sum(r.weights) == pytest.approx(1) and min(r.weights) >= 0 and r.risk == pytest.approx(math.sqrt(np.array(r.weights) @ cov @ r.weights)) for r in cloud[::50])
    assert ends["min_variance"].risk <= min(r.risk for r in cloud) and ends["max_return"].ret >= max(r.ret for r in cloud) and ends["max_sharpe"].sharpe >= max(r.sharpe for r in cloud) - 1e-9
    w = np.array(ends["min_variance"].weights)
    slope = cov @ w  # all held symbols have the same marginal risk, the others a higher one
    assert np.ptp(slope[w > 1e-6]) < 1e-6 and slope[w <= 1e-6].min(initial=np.inf) >= slope[w > 1e-6].max() - 1e-6
    again = {r.id: r.weights for r in frontier.frontier(expected.repartition(5), pairs, 100).where("kind = 'simulated'").collect()}
    assert all(again[r.id] == r.weights for r in cloud if r.id < 100)
    assert frontier.frontier(expected.limit(0), pairs, 10).count() == 0


def test_no_weights_beat_the_rate():
    mu = np.array([0.05, -0.5, -0.5, -0.5, -0.5])
    assert allocation.max_sharpe(mu, np.eye(5)) is None
    w = allocation.max_sharpe(np.array([0.5, 0.1, 0.1, 0.1, -0.5]), np.eye(5))
    assert w is not None and w.sum() == pytest.approx(1) and w.max() <= 0.25 + 1e-9


def test_two_views_are_needed(spark):
    cov = spark.createDataFrame([(D(2024, 1, 1), a, b, 0.01 if a == b else 0.001) for a in "ABCDE" for b in "ABCDE"], "as_of date, a string, b string, cov double")
    views = spark.createDataFrame([(D(2024, 1, 1), s, 0.1, 0.01) for s in "ABCDE"], "as_of date, symbol string, view double, variance double")
    assert allocation.weights(cov, views.where("symbol = 'A'")).count() == 0
    assert allocation.weights(cov, views).count() == 5


def test_one_common_date_has_no_condition(spark):
    rows = [(D(2024, 1, 1), a, b, None, 1e-4 if a == b else 0.0) for a in "AB" for b in "AB"]
    got = allocation.conditioned(spark.createDataFrame(rows, "as_of date, a string, b string, raw double, shrunk double")).first()
    assert math.isinf(got.cond_raw) and got.cond_shrunk == 1 and not got.fallback


def test_against_index(spark):
    curve = spark.createDataFrame([("P", D(2024, 1, 3), 50.0), ("P", D(2024, 1, 5), 60.0), ("P", D(2024, 1, 8), 45.0), ("Q", D(2024, 1, 1), 1.0)], "portfolio string, date date, value double")
    index = spark.createDataFrame([(D(2024, 1, 2), 200.0), (D(2024, 1, 4), 220.0), (D(2024, 1, 8), 210.0)], "date date, value double")
    got = {(r.portfolio, r.date.day): (r.level, r.index_level, round(r.drawdown, 6), round(r.index_drawdown, 6)) for r in lineage.against_index(curve, index).collect()}
    want = {3: (100, 100, 0, 0), 4: (100, 110, 0, 0), 5: (120, 110, 0, 0), 8: (90, 105, -0.25, round(105 / 110 - 1, 6))}
    assert {k[1]: v for k, v in got.items() if k[0] == "P"} == {k: pytest.approx(v) for k, v in want.items()}
    assert {k[1]: v[:2] for k, v in got.items() if k[0] == "Q"} == {2: (100, 100), 4: (100, pytest.approx(110)), 8: (100, pytest.approx(105))}
    ratios = {r.portfolio: r for r in lineage.compared(lineage.against_index(curve, index)).collect()}
    steps = [0, 0.2, -0.25]
    assert ratios["P"].performance == pytest.approx(-0.1) and ratios["P"].max_drawdown == pytest.approx(-0.25) and ratios["P"].volatility == pytest.approx(np.std(steps, ddof=1) * math.sqrt(252))
    assert ratios["P"].sharpe == pytest.approx((np.mean(steps) * 252 - 0.03) / (np.std(steps, ddof=1) * math.sqrt(252))) and ratios["Q"].sharpe == 0
