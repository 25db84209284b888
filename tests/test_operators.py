"""Operators on small rows, against plain Python where that says it best."""

import datetime as dt
import json
import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.functions import french
from tidemark.operators import allocation, bars, dividends, news, pages, portfolio
from tidemark.sources import files, sinks
from tidemark.streaming import ingest

D = dt.date


def one(spark, value, build, kind="string"):
    return spark.createDataFrame([(value,)], f"c {kind}").select(build(F.col("c"))).first()[0]


@pytest.mark.parametrize(("text", "want"), [("8 377", 8377.0), ("8 377", 8377.0), ("31 372 MFCFA", 31372.0), ("28,97%", 28.97), ("", None), ("-", None), ("n/a", None), (None, None), ("abc", None), ("NaN", None), ("-1 740,5", -1740.5)])
def test_numbers(spark, text, want):
    assert one(spark, text, french.clean_number) == want


def test_texts_and_dates(spark):
    assert [one(spark, t, french.first_comma_number) for t in ("1,5", "1,2,3", "")] == [1.5, None, None]
    assert [str(one(spark, t, french.french_date)) for t in ("15 juin 2026", "1 Août 2025", "3 févr 2024", "")] == ["2026-06-15", "2025-08-01", "None", "None"]
    assert [one(spark, t, french.slash_date) for t in ("22/4/2026", " reporté ", None)] == ["2026-04-22", "reporté", ""]
    assert one(spark, "L’Électricité  œ", french.plain) == "l'electricite  " and one(spark, "a  b ", french.spaces_normalised) == "a b"
    assert one(spark, -1234.5, lambda c: french.signed_percent(c), "double") == "-1 234,50 %" and one(spark, None, french.signed_percent, "double") == "—"
    assert [one(spark, v, lambda c: french.half_up(c, 0), "double") for v in (0.5, 1.5, -0.5)] == [1.0, 2.0, 0.0]
    rows = spark.createDataFrame([("2024.0", None, None), ("", "x/exercice_2022.pdf", "2025-01-01"), (None, "", "2025-01-01"), ("nan", None, "soon")], "v string, u string, p string")
    assert [r[0] for r in rows.select(french.exercice(F.col("v"), F.col("u"), F.col("p"))).collect()] == ["2024", "2022", "2024", ""]


def closes(spark, rows):
    return spark.createDataFrame([(s, D(2024, 1, 1) + dt.timedelta(k), float(c), float(v)) for s, k, c, v in rows], "symbol string, date date, close double, volume double")


@pytest.mark.parametrize(("values", "streak", "want"), [([100] * 5 + [105, 105, 110], 3, [True] * 5 + [False] * 3), ([100] * 4 + [102, 103], 3, [True] * 4 + [False] * 2), ([100] * 4 + [102, 103], 4, [False] * 6)])
def test_flat_runs(spark, values, streak, want):
    got = bars.flagged(closes(spark, [("A", k, c, 9) for k, c in enumerate(values)]), streak).orderBy("date").collect()
    assert [r.illiquid for r in got] == want


def test_liquidity(spark):
    rows = [("A", k, 1000 + k, v) for k, v in enumerate((100, 0, 50, 0, 75))] + [("B", k, 1000 + k, 0 if k % 2 else 9) for k in range(9)] + [("C", k, 7, 5) for k in range(8)]
    flags = bars.flagged(closes(spark, rows))
    symbols = spark.createDataFrame([("A",), ("B",), ("C",), ("none",)], "symbol string")
    got = {r.symbol: (r.rows_raw, r.rows_kept, round(r.illiquid_ratio, 3), r.excluded) for r in bars.liquidity(flags, symbols).collect()}
    assert got == {"A": (5, 3, 0.4, False), "B": (9, 5, 0.444, True), "C": (8, 0, 1.0, True), "none": (0, 0, 1.0, True)}
    assert {r.symbol for r in bars.liquid(closes(spark, rows)).collect()} == {"A"}


def test_series(spark):
    own = closes(spark, [("A", 0, 100, 1), ("A", 2, 102.5, 1), ("B", 1, 10, 1)])
    dates = own.select("date").distinct()
    assert sorted((r.symbol, r.date.day, r.close) for r in bars.filled(own, dates).collect()) == [("A", 1, 100.0), ("A", 2, 100.0), ("A", 3, 102.5), ("B", 2, 10.0), ("B", 3, 10.0)]
    gap = spark.createDataFrame([("A", D(2024, 1, 1), 100.0), ("A", D(2024, 1, 2), None), ("A", D(2024, 1, 3), 110.124)], "symbol string, date date, close double")
    assert [r[0] for r in gap.select(bars.change().alias("c"), "date").orderBy("date").collect()] == [None, 0.0, 10.12]
    window = [r.date for r in bars.as_of(spark.createDataFrame([(D(2021, 3, 1),), (D(2021, 2, 28),), (D(2024, 2, 29),), (D(2024, 3, 1),)], "date date"), D(2024, 2, 29), 3).collect()]
    assert sorted(window) == [D(2021, 2, 28), D(2021, 3, 1), D(2024, 2, 29)]


def test_parabolic_sar(spark):
    """Worked by hand: a rise, then a fall below the stop."""
    prices = [(10, 9, 9.5), (11, 10, 10.5), (12, 11, 11.5), (11.5, 8, 8.5), (9, 7, 7.5)]
    rows = [("A", D(2024, 1, k + 1), float(h), float(low), float(c)) for k, (h, low, c) in enumerate(prices)] + [("A", D(2024, 1, 9), None, 1.0, 1.0), ("B", D(2024, 1, 1), 1.0, 1.0, 1.0)]
    own = spark.createDataFrame(rows, "symbol string, date date, high double, low double, close double")
    got = [(r.symbol, r.date.day, round(r.sar, 9), r.rising) for r in bars.parabolic_sar(own).orderBy("date").collect()]
    assert got == [("A", 2, 9.0, True), ("A", 3, 9.0, True), ("A", 4, 12.0, False), ("A", 5, 12.0, False)]
    assert bars.parabolic_sar(own.limit(0)).count() == 0


def test_kendall(spark):
    rng = random.Random(1)
    x, y = ([rng.randint(0, 5) for _ in range(20)] for _ in "ab")
    rows = [("A", D(2024, 1, 1) + dt.timedelta(k), float(v)) for k, v in enumerate(x)] + [("B", D(2024, 1, 1) + dt.timedelta(k), float(v)) for k, v in enumerate(y)]
    s = [(np.sign(x[j] - x[i]), np.sign(y[j] - y[i])) for i in range(20) for j in range(i + 1, 20)]
    want = sum(a * b for a, b in s) / math.sqrt(sum(a * a for a, _ in s) * sum(b * b for _, b in s))
    got = bars.kendall_pairs(spark.createDataFrame(rows, "symbol string, date date, value double")).first()
    assert got.n == 190 and got.tau == pytest.approx(want)


def test_fusion(spark):
    rows = [("A", "2024", "official", 1, None, "x", None, None, "n1"), ("A", "2024", "official", 2, "2024-01-09", None, 9.0, None, "n2"), ("A", "2024", "up", 3, "2024-01-02", "2024-02-02", 5.0, 1.5, None), ("A", "2024", "hist", 4, None, None, 6.0, None, None), ("B", "2023", "up", 5, None, None, None, 2.0, None), ("B", "2023", "hist", 6, "2023-01-01", None, 7.0, 3.0, None), ("C", "2022", "official", 7, None, None, 4.0, 8.0, None), ("C", "2022", "up", 8, None, None, 4.5, None, None)]
    got = {r.ticker: r for r in dividends.fused(spark.createDataFrame(rows, "ticker string, exercice string, src string, seq int, ex_date string, pay_date string, amount double, yield_pct double, notice string")).collect()}
    assert (got["A"].ex_date, got["A"].pay_date, got["A"].amount, got["A"].yield_pct, got["A"].notice, got["A"].sources) == ("2024-01-02", "2024-02-02", 5.0, None, "n1", "hist,official,up")
    assert (got["B"].ex_date, got["B"].amount, got["B"].yield_pct) == (None, None, 2.0) and got["C"].amount == 4.0 and got["C"].yield_pct is None and got["C"].diverges
    today = F.lit(D(2024, 5, 1))
    assert [one(spark, t, lambda c: dividends.status(c, today)) for t in ("2024-04-30", "2024-05-01", "bientôt", None)] == ["Passé", "A venir", "A préciser", "A préciser"]


def test_news(spark):
    rows = spark.createDataFrame([(1, "Sonatel gagne"), (2, "ONATEL : résultats"), (3, "Nestlé Côte d’Ivoire et Onatel"), (4, None)], "id int, title string")
    links = news.linked(rows, {"ONTBF.bf": ["onatel"], "NTLC.ci": ["Nestlé Côte d'Ivoire"], "none": []})
    assert {r.id: (r.key, r.outcome) for r in links.collect()} == {1: (None, "unlinked"), 2: ("ONTBF.bf", "linked"), 3: (None, "ambiguous"), 4: (None, "unlinked")}
    assert tuple(news.link_statistics(links).first()) == (4, 1, 1, 2)


LEDGER = [(1, 1, "DEPOSIT", None, 1, 10_000.0), (1, 2, "BUY", "A", 10, 100.0), (1, 3, "BUY", "A", 10, 200.0), (1, 4, "SELL", "A", 25, 100.0), (1, 5, "BUY", "B", 999, 100.0), (1, 6, "SELL", "A", 20, 150.0), (1, 7, "WITHDRAW", None, 1, 99_999.0), (2, 1, "SELL", "A", 1, 5.0), (2, 2, "BUY", "A", None, 5.0)]
LEDGER_SCHEMA = "portfolio long, seq long, type string, symbol string, quantity long, price double"


def test_ledger(spark, tmp_path):
    ledger = spark.createDataFrame(LEDGER, LEDGER_SCHEMA)
    batch = sorted(map(tuple, portfolio.replayed(ledger).collect()))
    assert [r[2] for r in batch] == [True, True, True, False, False, True, False, False, False]
    assert batch[2][6] == 20 and batch[2][7] == pytest.approx((1011 + 2022) / 20) and batch[5][4] == pytest.approx(10_000 - 1011 - 2022 + 3000 - 33)
    ledger.where("seq <= 3").write.parquet(f"{tmp_path}/in/a")
    out = []
    for part in ("seq <= 3", "seq > 3"):
        ledger.where(part).coalesce(1).write.mode("append").parquet(f"{tmp_path}/stream")
        query = ingest.replayed(ingest.file_stream(spark, f"{tmp_path}/stream", LEDGER_SCHEMA)).writeStream.foreachBatch(lambda df, _: out.extend(map(tuple, df.collect()))).option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start()
        query.awaitTermination()
    assert sorted(out) == batch


def test_upserts(spark, tmp_path):
    old = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "k int, v string, seq int")
    new = spark.createDataFrame([(2, "c", 1), (2, "d", 2), (3, "e", 1)], "k int, v string, seq int")
    table = sinks.StoredTable(spark, str(tmp_path / "t"))
    assert table.read() is None
    table.upsert(old, ["k"], "seq")
    for _ in range(2):
        table.upsert(new, ["k"], "seq")
        assert sorted(map(tuple, table.read().collect())) == [(1, "a", 1), (2, "d", 2), (3, "e", 1)]
    assert sorted(map(tuple, sinks.inserted(old, new, ["k"], "seq").collect())) == [(1, "a", 1), (2, "b", 1), (3, "e", 1)]
    assert sorted(map(tuple, sinks.updated(old, new.where("seq = 2").union(spark.createDataFrame([(1, None, 0)], "k int, v string, seq int")), ["k"], ["v"]).collect())) == [(1, "a", 1), (2, "d", 1)]
    days = spark.createDataFrame([("A", 3), ("A", 5), ("B", 1)], "s string, d int")
    assert sorted(map(tuple, sinks.increments(spark.createDataFrame([("A", 3)], "s string, d int"), days, "s", "d").collect())) == [("A", 5), ("B", 1)]
    new.write.parquet(f"{tmp_path}/stream")
    for _ in range(2):
        ingest.upserted(ingest.file_stream(spark, f"{tmp_path}/stream", "k int, v string, seq int"), str(tmp_path / "s"), ["k"], "seq", f"{tmp_path}/c").awaitTermination()
    assert sorted(map(tuple, sinks.StoredTable(spark, str(tmp_path / "s")).read().collect())) == [(2, "d", 2), (3, "e", 1)]


def test_files(spark, tmp_path):
    head = "﻿Date;Ouverture;Plus_Haut;Plus_Bas;Cloture;Volume_Titres;Volume_FCFA;Variation_Pct"
    (tmp_path / "AAAA_ci_historique.csv").write_text(f"{head}\n2024-01-02;1,5;2;1;1 000,25;x;0;\nbad;1;1;1;1;1;1;1\n2024-01-03;1;1;1;;5;0;\n", encoding="utf-8")
    got = files.bars(spark, str(tmp_path / "*_historique.csv")).collect()
    assert len(got) == 1 and (got[0].symbol_key, got[0].close, got[0].volume, got[0].variation) == ("AAAA_ci", 1000.25, 0.0, None)
    (tmp_path / "p1_societe.json").write_text('﻿{"Nombre_Titres": "", "Nombre de titres": "1 200"}', encoding="utf-8")
    (tmp_path / "p2_societe.json").write_text("{broken", encoding="utf-8")
    assert [(r.file[:2], r.shares, r.readable) for r in files.profiles(spark, str(tmp_path / "*_societe.json")).orderBy("file").collect()] == [("p1", 1200, True), ("p2", None, False)]
    (tmp_path / "f_fond.json").write_text(json.dumps({"ticker": "A", "annees": ["2023"], "metrics": {"PER": {"2023": "7,5", "2022": "-"}}}))
    assert sorted((r.exercice, r.metric, r.value) for r in files.fundamentals(spark, str(tmp_path / "f_fond.json")).collect()) == [(2022, "PER", None), (2023, "PER", 7.5)]
    (tmp_path / "alloc.json").write_text(json.dumps({"allocation": {"A": 0.25, "B": 0.75}}))
    assert sorted(map(tuple, files.allocation(spark, str(tmp_path / "alloc.json")).collect())) == [("A", 0.25), ("B", 0.75)]
    (tmp_path / "sig.json").write_text(json.dumps({"signals": {"A": {"signal": "ACHAT", "last_price": 5.0}}}))
    assert files.signals(spark, str(tmp_path / "sig.json")).first().signal == "ACHAT"
    sinks.to_french_csv(spark.createDataFrame([("A", 1.5), ("B", None)], "s string, v double"), str(tmp_path / "out"))
    assert sorted(map(tuple, files.text_table(spark, str(tmp_path / "out")).collect())) == [("A", "1,50"), ("B", None)]


def test_pages():
    html = '<html><head><meta property="og:title" content="T3"><script type="application/ld+json">{broken</script><script type="application/ld+json">[{"@type": "Other"}, {"@type": "NewsArticle", "headline": "T1", "author": [{"name": "Ann"}], "image": {"url": "i.png"}}]</script></head><body><h1>T2</h1><nav>menu</nav><article><p>One &eacute;l<p>Two<aside>no</aside></article></body></html>'
    assert pages.article(html) == ("T1", None, "Ann", None, "One él\nTwo", "i.png")
    assert pages.article("<p>x")[0] is None and pages.article("")[4] == ""
    long = "word " * 60
    assert pages.article(f"<h1>a</h1><div class='post-content'>{long}</div><div>short</div>")[4] == long.strip()
    table = "<table><tr><th>x<th>2022<th>2023<tr><td>PER :<td>7,5<td>-<tr><td>CA<td>1 000<td>2 000</table><dl><dt>ISIN<dd>CI0000000001</dl><p><b>Flottant : </b> 20 %</p>"
    assert pages.year_matrix(table) == {"PER :": {"2022": "7,5"}, "CA": {"2022": "1 000", "2023": "2 000"}}
    assert pages.pairs(table) == {"x": "2022", "PER": "7,5", "CA": "1 000", "ISIN": "CI0000000001", "Flottant": "20 %"}


def test_shrinkage_and_weights(spark):
    rng = np.random.default_rng(3)
    n, p = 200, 6
    x = rng.normal(size=(n, p)) @ rng.normal(size=(p, p)) * 0.01
    rows = [(D(2024, 6, 1), f"S{j}", D(2023, 1, 1) + dt.timedelta(i), float(x[i, j])) for i in range(n) for j in range(p)]
    got = allocation.shrunk_covariance(spark.createDataFrame(rows, "as_of date, symbol string, date date, ret double"))
    c = x - x.mean(0)
    s = c.T @ c / n
    mu, norm = np.trace(s) / p, (s * s).sum()
    delta = norm / p - mu * mu
    beta = min(delta, (((c * c).sum(1) ** 2).sum() / n - norm) / (p * n))
    want = (1 - beta / delta) * s + beta / delta * mu * np.eye(p)
    own = got.toPandas()
    assert np.allclose(allocation.matrix(own, "shrunk")[1], want) and np.allclose(allocation.matrix(own, "raw")[1], np.cov(x.T))
    cov = allocation.conditioned(got)
    first = cov.first()
    assert first.cond_shrunk < 10 * first.cond_raw + 1 and not first.fallback and allocation.conditioned(got, most=1.0).where("a <> b and cov <> 0").count() == 0
    views = spark.createDataFrame([(D(2024, 6, 1), f"S{j}", 0.02 * (j - 1), 0.01) for j in range(p)], "as_of date, symbol string, view double, variance double")
    w = {r.symbol: r.weight for r in allocation.weights(cov, views).collect()}
    assert sum(w.values()) == pytest.approx(1, abs=1e-3) and max(w.values()) <= 0.25 + 1e-9


@pytest.mark.parametrize("seed", range(5))
def test_max_sharpe_is_best(seed):
    rng = np.random.default_rng(seed)
    p = 8
    a = rng.normal(size=(p, p))
    cov, mu = a @ a.T / p + 0.1 * np.eye(p), rng.normal(0.05, 0.1, p)
    w = allocation.max_sharpe(mu, cov)
    assert w.sum() == pytest.approx(1) and w.min() >= 0 and w.max() <= 0.25 + 1e-9
    excess = mu - allocation.RISK_FREE
    slope = excess / (excess @ w) - cov @ w / (w @ cov @ w)  # moving weight from one symbol to another must not help
    low, high = slope[w < 0.25 - 1e-6], slope[w > 1e-6]
    assert low.max() - high.min() < 2e-3 * np.abs(slope).max()


def test_forecasts(spark):
    rng = np.random.default_rng(5)
    days = sorted(rng.choice(900, 300, replace=False).tolist())
    rows = [("A", D(2022, 1, 1) + dt.timedelta(k), 100 + 0.05 * k + 5 * math.sin(2 * math.pi * k / 365.25)) for k in days] + [("B", D(2022, 1, 1), 1.0)]
    own = spark.createDataFrame(rows, "symbol string, date date, close double")
    grid = spark.createDataFrame([(D(2024, 7, 1),), (D(2022, 2, 1),)], "as_of date")
    got = allocation.forecasts(own, grid, ridge=1e-9).collect()
    assert len(got) == 1 and got[0].symbol == "A" and got[0].train_rows == 300
    k = max(days) + 30
    assert got[0].yhat == pytest.approx(100 + 0.05 * k + 5 * math.sin(2 * math.pi * k / 365.25), rel=1e-4) and got[0].yhat_lower <= got[0].yhat <= got[0].yhat_upper
    cases = [(100.0, 120.0, "ACHAT FORT"), (100.0, 105.0, "ACHAT"), (100.0, 100.0, "NEUTRE"), (100.0, 95.0, "VENTE"), (100.0, 80.0, "VENTE FORTE"), (0.0, 5.0, "NEUTRE")]
    rows = spark.createDataFrame(cases, "a double, b double, want string")
    assert all(r[0] == r[1] for r in rows.select(allocation.signal_class(F.col("a"), F.col("b")), "want").collect())
    few = spark.createDataFrame([("ACHAT",)] * 8 + [("VENTE",)] * 2, "signal string")
    assert tuple(allocation.concentration(few).first()) == ("ACHAT", 0.8, True, 10) and tuple(allocation.concentration(few.limit(0)).first()) == (None, 0.0, False, 0)


def test_walk_forward(spark):
    m = [D(2024, k, 1) for k in range(1, 6)]
    periods = spark.createDataFrame(list(zip(m, m[1:])), "start date, end date")
    weights = spark.createDataFrame([(m[1], "A", 0.5), (m[1], "B", 0.5), (m[3], "A", 1.0)], "start date, symbol string, weight double")
    returns = spark.createDataFrame([(t, s, r) for t, a, b in ((m[0], 0.5, 0.5), (m[1], 0.1, -0.2), (m[2], 0.3, 0.3), (m[3], 0.2, None)) for s, r in (("A", a), ("B", b), ("C", None))], "start date, symbol string, ret double")
    got = {}
    for r in allocation.walk_forward(periods, weights, returns).orderBy("date").collect():
        got.setdefault(r.curve, []).append(round(r.level, 6))
    assert got == {"algo": [1.0, 1.0, 0.95, 0.95, 1.14], "bh": [1.0, 1.0, 0.95, 0.95, 1.045], "bench": [1.0, 1.0, 0.95, 0.95, 1.045]}
    metrics = {r.curve: (r.sharpe, r.max_drawdown, r.cagr) for r in allocation.curve_metrics(allocation.walk_forward(periods, weights, returns).unionByName(spark.createDataFrame([("one", m[0], 1.0), ("flat", m[0], 1.0), ("flat", m[1], 1.0)], "curve string, date date, level double"))).collect()}
    rets = pd.Series([1.0, 1.0, 0.95, 0.95, 1.14]).pct_change().dropna()
    assert metrics["algo"] == (round(rets.mean() * 12 / (rets.std() * 12**0.5), 3), -0.05, round(1.14 ** (365 / 121) - 1, 3)) and metrics["one"] == metrics["flat"] == (0.0, 0.0, 0.0)


def test_portfolio(spark):
    held = spark.createDataFrame([(1, "A", 10, 100.0), (1, "B", 5, 10.0), (1, "C", 0, 1.0)], "portfolio int, symbol string, quantity int, avg_cost double")
    quotes = spark.createDataFrame([("A", 120.0)], "symbol string, last double")
    own = portfolio.positions(held, quotes)
    assert {r.symbol: (r.market_value, r.pnl, r.pnl_pct, round(r.weight, 3)) for r in own.collect()} == {"A": (1200.0, 200.0, 20.0, 0.96), "B": (None, None, None, 0.04)}
    got = portfolio.totals(own, spark.createDataFrame([(1, 50.0), (2, 7.0)], "portfolio int, cash double"), spark.createDataFrame([(1, 1000.0)], "portfolio int, net_deposits double")).orderBy("portfolio").collect()
    assert (got[0].total_value, got[0].unrealised, got[0].total_return_pct) == (1300.0, 200.0, 30.0) and got[1].total_return_pct is None
    plan = portfolio.rebalance_plan(spark.createDataFrame([("A", 0.6), ("B", 0.4)], "symbol string, weight double"), quotes, held.where("symbol = 'A'"), spark.createDataFrame([("A", "ACHAT")], "symbol string, signal string"), F.lit(1000.0)).collect()
    assert [(r.symbol, r.target, r.delta, r.action) for r in plan] == [("A", 5, -5, "SELL"), ("B", 0, 0, "HOLD")]
