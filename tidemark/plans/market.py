"""Warehouse, market, risk and portfolio queries over the role views."""

from __future__ import annotations

W = "PARTITION BY symbol ORDER BY date"
PERIODS = {"d1": 1, "w1": 7, "m1": 30, "m3": 91, "m6": 182, "y1": 365, "y3": 1095}
SQL: dict[str, str] = {
    # warehouse queries
    "latest_bar": "SELECT symbol, max(date) AS date, max_by(close, date) AS close, max_by(volume, date) AS volume FROM bars GROUP BY symbol",
    "latest_bar_by_row_number": f"SELECT symbol, date, close FROM (SELECT *, row_number() OVER ({W} DESC) AS rn FROM bars) x WHERE rn = 1",
    "top_companies_by_cap": "SELECT name, cap FROM company ORDER BY cap DESC NULLS LAST, name LIMIT 10",
    "top_yields": "SELECT p_partkey AS id, round(p_size / p_retailprice, 6) AS yield FROM part WHERE p_size > 10 ORDER BY yield DESC NULLS LAST, id LIMIT 10",
    "sector_counts": "SELECT sector, count(*) AS n, round(sum(cap), 2) AS cap FROM company GROUP BY sector",
    "news_by_month": "SELECT CAST(date_trunc('month', ts) AS DATE) AS month, count(*) AS n FROM events GROUP BY 1 ORDER BY month DESC LIMIT 12",
    "table_counts": " UNION ALL ".join(f"SELECT '{t}' AS name, count(*) AS n FROM {t}" for t in ("customer", "supplier", "part", "orders", "lineitem", "events", "documents")),
    "index_last_year": "SELECT date, level FROM market WHERE date >= (SELECT BACK(max(date);365) FROM market)",
    "first_last_close": "SELECT symbol, min(date) AS first_date, max(date) AS last_date, min_by(close, date) AS first_close, max_by(close, date) AS last_close FROM bars GROUP BY symbol",
    "companies_without_history": "SELECT c_custkey AS id, c_name AS name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)",
    "company_latest_order": "SELECT c_custkey AS id, o.last FROM customer LEFT JOIN (SELECT o_custkey, max_by(o_totalprice, o_orderkey) AS last FROM orders GROUP BY o_custkey) o ON c_custkey = o_custkey",
    "fact_to_dim": "SELECT s_name AS name, n_name AS nation, r_name AS region FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'EUROPE'",
    "name_search": "SELECT id, name, sector FROM company WHERE lower(name) LIKE '%1%' OR lower(sector) LIKE '%an%'",
    "distinct_symbols": "SELECT count(DISTINCT symbol) AS n FROM bars",
    # coverage, liquidity, quality
    "coverage": "SELECT symbol, count(*) AS n, min(date) AS first_date, max(date) AS last_date, max_by(close, date) AS last_close FROM bars GROUP BY symbol",
    "illiquid_rows": "SELECT symbol, date, close, volume FROM flagged WHERE illiquid = 1",
    "liquidity": "SELECT symbol, count(*) AS rows_raw, sum(1 - illiquid) AS rows_kept, round(avg(CAST(illiquid AS DOUBLE)), 4) AS illiquid_ratio, CASE WHEN avg(CAST(illiquid AS DOUBLE)) > 0.4 THEN 1 ELSE 0 END AS excluded FROM flagged GROUP BY symbol",
    "liquid_bars": "SELECT f.symbol, f.date, f.close FROM flagged f JOIN (SELECT symbol FROM flagged GROUP BY symbol HAVING avg(CAST(illiquid AS DOUBLE)) <= 0.4 AND sum(1 - illiquid) >= 60) k ON f.symbol = k.symbol WHERE f.illiquid = 0",
    "dq_duplicate_keys": "SELECT l_orderkey AS orderkey, l_linenumber AS linenumber, count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1",
    "dq_ranges": "SELECT count(*) AS n, sum(CASE WHEN high < low THEN 1 ELSE 0 END) AS high_low, sum(CASE WHEN close < 0 THEN 1 ELSE 0 END) AS negative, sum(CASE WHEN volume < 0 THEN 1 ELSE 0 END) AS volume FROM bars",
    "dq_orphans": "SELECT o_orderkey AS orderkey FROM orders LEFT JOIN customer ON o_custkey = c_custkey WHERE c_custkey IS NULL",
    "dq_domains": "SELECT c_custkey AS id, CASE WHEN c_acctbal < 0 THEN 'balance' ELSE 'segment' END AS reason FROM customer WHERE c_acctbal < 0 OR c_mktsegment NOT IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'MACHINERY', 'HOUSEHOLD')",
    # series
    "variation": f"SELECT symbol, date, round(100 * (close / lag(close) OVER ({W}) - 1), 4) AS variation FROM bars",
    "daily_returns": "SELECT symbol, date, round(ret, 8) AS ret FROM returns WHERE ret IS NOT NULL",
    "turnover": "SELECT symbol, date, turnover FROM bars",
    "forward_filled": "SELECT symbol, date, close FROM panel WHERE close IS NOT NULL",
    "complete_dates": "SELECT date, count(*) AS n FROM bars GROUP BY date HAVING count(*) = (SELECT count(DISTINCT symbol) FROM bars)",
    "movers": f"SELECT symbol, close, previous, round(100 * (close / previous - 1), 4) AS change FROM (SELECT *, row_number() OVER ({W} DESC) AS rn, lag(close) OVER ({W}) AS previous FROM bars) x WHERE rn = 1 AND previous > 0",
    "top_movers": f"SELECT symbol, change FROM (SELECT symbol, round(100 * (close / previous - 1), 4) AS change FROM (SELECT *, row_number() OVER ({W} DESC) AS rn, lag(close) OVER ({W}) AS previous FROM bars) x WHERE rn = 1 AND previous > 0) y ORDER BY change DESC, symbol LIMIT 5",
    "last_bars": f"SELECT symbol, date, close FROM (SELECT *, row_number() OVER ({W} DESC) AS rn FROM bars) x WHERE rn <= 22",
    "running_max_drawdown": "SELECT symbol, date, round(drawdown, 8) AS drawdown FROM drawdowns",
    "max_drawdown": "SELECT symbol, round(min(drawdown), 8) AS max_drawdown FROM drawdowns GROUP BY symbol",
    "base_100": f"SELECT symbol, date, round(100 * close / first_value(close) OVER ({W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 6) AS level FROM bars",
    "rolling_volatility": f"SELECT symbol, date, round(stddev_samp(ret) OVER ({W} ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) * sqrt(252), 6) AS volatility FROM returns WHERE ret IS NOT NULL",
    "moving_averages": f"SELECT symbol, date, round(avg(close) OVER ({W} ROWS BETWEEN 19 PRECEDING AND CURRENT ROW), 6) AS ma20, round(avg(close) OVER ({W} ROWS BETWEEN 49 PRECEDING AND CURRENT ROW), 6) AS ma50 FROM bars",
    "bollinger": f"SELECT symbol, date, round(m, 6) AS middle, round(m + 2 * s, 6) AS upper, round(m - 2 * s, 6) AS lower FROM (SELECT symbol, date, avg(close) OVER ({W} ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS m, stddev_pop(close) OVER ({W} ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS s FROM bars) x",
    "stochastic": f"SELECT symbol, date, CASE WHEN hi > lo THEN round(100 * (close - lo) / (hi - lo), 6) END AS k FROM (SELECT symbol, date, close, max(high) OVER ({W} ROWS BETWEEN 13 PRECEDING AND CURRENT ROW) AS hi, min(low) OVER ({W} ROWS BETWEEN 13 PRECEDING AND CURRENT ROW) AS lo FROM bars) x",
    "williams_r": f"SELECT symbol, date, CASE WHEN hi > lo THEN round(-100 * (hi - close) / (hi - lo), 6) + 0.0 END AS r FROM (SELECT symbol, date, close, max(high) OVER ({W} ROWS BETWEEN 13 PRECEDING AND CURRENT ROW) AS hi, min(low) OVER ({W} ROWS BETWEEN 13 PRECEDING AND CURRENT ROW) AS lo FROM bars) x",
    "momentum_roc": f"SELECT symbol, date, floor((close - lag(close, 10) OVER ({W})) * 10000 + 0.5) / 10000 AS momentum, round(100 * (close / lag(close, 12) OVER ({W}) - 1), 6) AS roc FROM bars",
    "ichimoku": f"SELECT symbol, date, floor((max(high) OVER ({W} ROWS BETWEEN 8 PRECEDING AND CURRENT ROW) + min(low) OVER ({W} ROWS BETWEEN 8 PRECEDING AND CURRENT ROW)) / 2 * 10000 + 0.5) / 10000 AS tenkan, floor((max(high) OVER ({W} ROWS BETWEEN 25 PRECEDING AND CURRENT ROW) + min(low) OVER ({W} ROWS BETWEEN 25 PRECEDING AND CURRENT ROW)) / 2 * 10000 + 0.5) / 10000 AS kijun FROM bars",
    "on_balance_volume": f"SELECT symbol, date, sum(signed) OVER ({W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS obv FROM (SELECT symbol, date, CASE WHEN close > lag(close) OVER ({W}) THEN volume WHEN close < lag(close) OVER ({W}) THEN -volume ELSE 0 END AS signed FROM bars) x",
    "accumulation": f"SELECT symbol, date, round(sum(flow) OVER ({W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 4) AS ad FROM (SELECT symbol, date, CASE WHEN high > low THEN volume * ((close - low) - (high - close)) / (high - low) ELSE 0 END AS flow FROM bars) x",
    # performance
    "period_returns": "SELECT q.symbol, " + ", ".join(f"round(q.last / max_by(CASE WHEN b.date <= BACK(q.date;{n}) THEN b.close END, CASE WHEN b.date <= BACK(q.date;{n}) THEN b.date END) - 1, 6) AS {k}" for k, n in PERIODS.items()) + " FROM quotes q JOIN bars b ON q.symbol = b.symbol GROUP BY q.symbol, q.last",
    "calendar_returns": "SELECT q.symbol, " + ", ".join(f"round(q.last / max_by(CASE WHEN b.date < CAST(date_trunc('{u}', q.date) AS DATE) THEN b.close END, CASE WHEN b.date < CAST(date_trunc('{u}', q.date) AS DATE) THEN b.date END) - 1, 6) AS {k}" for k, u in (("wtd", "week"), ("mtd", "month"), ("qtd", "quarter"), ("ytd", "year"))) + ", round(q.last / min_by(b.close, b.date) - 1, 6) AS otd FROM quotes q JOIN bars b ON q.symbol = b.symbol GROUP BY q.symbol, q.last",
    "descriptive": "SELECT b.symbol, count(*) AS n, round(avg(b.close), 6) AS mean, round(stddev_samp(b.close), 6) AS std, min(b.close) AS low, max(b.close) AS high, round(max_by(b.close, b.date) / min_by(b.close, b.date) - 1, 6) AS total_return, round(stddev_samp(r.ret) * sqrt(252), 6) AS volatility FROM bars b JOIN returns r ON b.symbol = r.symbol AND b.date = r.date GROUP BY b.symbol",
    "year_high": "SELECT b.symbol, max(b.close) AS high FROM bars b JOIN quotes q ON b.symbol = q.symbol WHERE b.date > BACK(q.date;365) GROUP BY b.symbol",
    "cap_hierarchy": "SELECT country, sector, round(sum(cap), 2) AS cap, grouping(country) + grouping(sector) AS level FROM company GROUP BY ROLLUP (country, sector)",
    "median_sessions": "SELECT round(median(n), 4) AS sessions FROM (SELECT symbol, count(*) AS n FROM bars GROUP BY symbol) x",
    "market_cap": "SELECT q.symbol, r.shares, q.last, round(q.last * r.shares, 4) AS cap FROM quotes q JOIN brand r ON q.symbol = r.symbol",
    "market_banner": "SELECT max(date) AS last_session, max_by(level, date) AS level, count(*) AS sessions FROM market",
    # composition
    "composition_weights": "SELECT c.symbol, c.date, round(c.value / t.total, 8) AS weight FROM caps c JOIN totals t ON c.date = t.date",
    "reconciliation": "SELECT count(*) AS n, round(avg(gap), 6) AS mean_gap, round(median(gap), 6) AS median_gap, round(avg(abs(gap)), 6) AS mean_abs_gap FROM (SELECT t.date, 100 * (t.total / (m.level * 10) - 1) AS gap FROM totals t JOIN market m ON t.date = m.date) x",
    # risk
    "correlation_pairs": "SELECT a.symbol AS a, b.symbol AS b, round(corr(a.ret, b.ret), 6) AS pearson, count(*) AS n FROM returns a JOIN returns b ON a.date = b.date AND a.symbol < b.symbol WHERE a.ret IS NOT NULL AND b.ret IS NOT NULL GROUP BY a.symbol, b.symbol HAVING count(*) >= 30",
    "covariance_pairs": "SELECT a.symbol AS a, b.symbol AS b, round(covar_samp(a.ret, b.ret), 6) AS covariance FROM returns a JOIN returns b ON a.date = b.date AND a.symbol <= b.symbol WHERE a.ret IS NOT NULL AND b.ret IS NOT NULL GROUP BY a.symbol, b.symbol",
    "beta": "SELECT r.symbol, round(covar_samp(r.ret, m.mret) / var_samp(m.mret), 6) AS beta, round(corr(r.ret, m.mret), 6) AS correlation FROM returns r JOIN market_returns m ON r.date = m.date WHERE r.ret IS NOT NULL AND m.mret IS NOT NULL GROUP BY r.symbol",
    "regression": "SELECT r.symbol, round(regr_slope(r.ret, m.mret), 6) AS slope, round(regr_intercept(r.ret, m.mret), 6) AS intercept, round(regr_r2(r.ret, m.mret), 6) AS r2 FROM returns r JOIN market_returns m ON r.date = m.date WHERE r.ret IS NOT NULL AND m.mret IS NOT NULL GROUP BY r.symbol",
    "spearman_pairs": "WITH k AS (SELECT symbol, date, rank() OVER (PARTITION BY symbol ORDER BY ret) + (count(*) OVER (PARTITION BY symbol, ret) - 1) / 2.0 AS pos FROM returns WHERE ret IS NOT NULL) SELECT a.symbol AS a, b.symbol AS b, round(corr(CAST(a.pos AS DOUBLE), CAST(b.pos AS DOUBLE)), 6) AS spearman FROM k a JOIN k b ON a.date = b.date AND a.symbol < b.symbol GROUP BY a.symbol, b.symbol",
    "regime": "WITH m AS (SELECT date, level, avg(level) OVER (ORDER BY date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS ma20, avg(level) OVER (ORDER BY date ROWS BETWEEN 199 PRECEDING AND CURRENT ROW) AS ma200 FROM market) SELECT date, CASE WHEN level > ma200 AND ma20 > ma200 THEN 'Haussier' WHEN level < ma200 AND ma20 < ma200 THEN 'Baissier' ELSE 'Neutre' END AS regime FROM m",
    "breadth": f"SELECT date, round(avg(CAST(CASE WHEN close > ma THEN 1 ELSE 0 END AS DOUBLE)), 6) AS breadth FROM (SELECT date, close, avg(close) OVER ({W} ROWS BETWEEN 199 PRECEDING AND CURRENT ROW) AS ma FROM bars) x GROUP BY date",
    "annualised_return": "SELECT symbol, CASE WHEN n < 2 OR days <= 0 OR first <= 0 THEN 0 ELSE round(power(last / first, CAST(365 AS DOUBLE) / days) - 1, 6) END AS annualised FROM (SELECT symbol, n, first, last, DAYS(d2;d1) AS days FROM (SELECT symbol, count(*) AS n, min_by(close, date) AS first, max_by(close, date) AS last, max(date) AS d2, min(date) AS d1 FROM bars GROUP BY symbol) y) x",
    # signals
    "signal_classes": f"SELECT symbol, CASE WHEN last <= 0 THEN 'NEUTRE' WHEN target / last - 1 >= 0.10 THEN 'ACHAT FORT' WHEN target / last - 1 >= 0.03 THEN 'ACHAT' WHEN target / last - 1 >= -0.03 THEN 'NEUTRE' WHEN target / last - 1 >= -0.10 THEN 'VENTE' ELSE 'VENTE FORTE' END AS signal FROM (SELECT symbol, close AS last, avg(close) OVER ({W} ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS target, row_number() OVER ({W} DESC) AS rn FROM bars) x WHERE rn = 1",
    # dividends, portfolio
    # with an official row the first amount there is, official ones first; without one the first row's, even a null
    "two_source_fusion": "SELECT ticker, exercice, max(CASE WHEN src = 'official' THEN 1 ELSE 0 END) AS official, CASE WHEN max(CASE WHEN src = 'official' THEN 1 ELSE 0 END) = 0 THEN min_by(coalesce(amount, -1), seq) ELSE coalesce(min_by(coalesce(amount, -1), CASE WHEN src = 'official' THEN seq END), -1) END AS first_amount, min_by(amount, CASE WHEN src <> 'official' AND amount IS NOT NULL THEN seq END) AS other_amount, count(*) AS n FROM two_source GROUP BY ticker, exercice",
    "keep_last": "SELECT ticker, exercice, seq, amount FROM (SELECT *, row_number() OVER (PARTITION BY ticker, exercice ORDER BY seq DESC) AS rn FROM two_source) x WHERE rn = 1",
    "status_counts": "SELECT sum(CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END) AS nb_a_venir, sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS nb_passes, sum(CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END) AS nb_a_preciser FROM orders",
    "net_deposits": "SELECT portfolio, sum(CASE type WHEN 'DEPOSIT' THEN amount WHEN 'WITHDRAW' THEN -amount ELSE 0 END) AS net_deposits, count(*) AS n FROM ledger GROUP BY portfolio",
    "brokerage_fees": "SELECT event_id, floor(amount * 0.011 + 0.5) AS fee FROM ledger WHERE type IN ('BUY', 'SELL')",
    "latest_transactions": "SELECT event_id, portfolio, type FROM ledger ORDER BY ts DESC, event_id DESC LIMIT 200",
    "rebalance_plan": "SELECT q.symbol, floor(1000000.0 / 25 / q.last) AS target, CASE WHEN floor(1000000.0 / 25 / q.last) > r.shares THEN 'BUY' WHEN floor(1000000.0 / 25 / q.last) < r.shares THEN 'SELL' ELSE 'HOLD' END AS action FROM quotes q JOIN brand r ON q.symbol = r.symbol",
    "sector_allocation": "SELECT r.sector, round(sum(q.last * r.shares), 4) AS value FROM quotes q JOIN brand r ON q.symbol = r.symbol GROUP BY r.sector",
    "calendar_dim": "SELECT DISTINCT date, year(date) AS year, quarter(date) AS quarter, month(date) AS month, day(date) AS day, CAST(date_trunc('week', date) AS DATE) AS week_start FROM bars",
}
