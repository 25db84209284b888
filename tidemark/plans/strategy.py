"""Signals, sentiment, allocation and walk-forward curves over the role views.

The walk-forward run weighs symbols by inverse volatility of the 365 days before each
month (the allocation by optimiser is not built); curves have one row per month, the
sentiment one row per date, so their ordered windows stay small.
"""

from __future__ import annotations

W = "PARTITION BY symbol ORDER BY date"
_MONTHLY = "m AS (SELECT symbol, CAST(date_trunc('month', date) AS DATE) AS month, min_by(close, date) AS first, max_by(close, date) AS last FROM bars GROUP BY symbol, CAST(date_trunc('month', date) AS DATE))"
_WALK = f"""WITH {_MONTHLY},
  vol AS (SELECT m.symbol, m.month, stddev_samp(r.ret) AS vol FROM m JOIN returns r ON m.symbol = r.symbol AND r.date < m.month AND r.date >= BACK(m.month;365) WHERE r.ret IS NOT NULL GROUP BY m.symbol, m.month HAVING count(*) >= 30 AND stddev_samp(r.ret) > 0),
  w AS (SELECT symbol, month, (1 / vol) / sum(1 / vol) OVER (PARTITION BY month) AS w FROM vol),
  f AS (SELECT symbol, w FROM w WHERE month = (SELECT min(month) FROM w)),
  c AS (SELECT m.month, sum(w.w * (m.last / m.first - 1)) AS algo, sum(coalesce(f.w, 0) * (m.last / m.first - 1)) AS fixed, avg(m.last / m.first - 1) AS bench FROM w JOIN m ON w.symbol = m.symbol AND w.month = m.month LEFT JOIN f ON w.symbol = f.symbol GROUP BY m.month),
  long AS (SELECT month, 'algo' AS curve, algo AS r FROM c UNION ALL SELECT month, 'fixed', fixed FROM c UNION ALL SELECT month, 'bench', bench FROM c),
  level AS (SELECT month, curve, r, exp(sum(ln(1 + r)) OVER (PARTITION BY curve ORDER BY month ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS level FROM long)"""
_SIGNALS = f"SELECT symbol, close AS last, target, width, row_number() OVER ({W} DESC) AS rn FROM (SELECT symbol, date, close, avg(close) OVER ({W} ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS target, 2.5631 * stddev_samp(close) OVER ({W} ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS width FROM bars) s0"
_CLASS = "CASE WHEN last <= 0 THEN 'NEUTRE' WHEN target / last - 1 >= 0.10 THEN 'ACHAT FORT' WHEN target / last - 1 >= 0.03 THEN 'ACHAT' WHEN target / last - 1 >= -0.03 THEN 'NEUTRE' WHEN target / last - 1 >= -0.10 THEN 'VENTE' ELSE 'VENTE FORTE' END"
_PAIRS = "SELECT a.symbol AS a, b.symbol AS b, round(corr(a.ret, b.ret), 6) AS pearson FROM returns a JOIN returns b ON a.date = b.date AND a.symbol < b.symbol WHERE a.ret IS NOT NULL AND b.ret IS NOT NULL GROUP BY a.symbol, b.symbol HAVING count(*) >= 30"


def _scaled(x: str) -> str:
    frame = "OVER (ORDER BY date ROWS BETWEEN 249 PRECEDING AND CURRENT ROW)"
    return f"CASE WHEN max({x}) {frame} > min({x}) {frame} THEN ({x} - min({x}) {frame}) / (max({x}) {frame} - min({x}) {frame}) ELSE 0.5 END"


_FEATURES = f"""by_date AS (SELECT b.date, avg(CAST(CASE WHEN b.close > b.ma THEN 1 ELSE 0 END AS DOUBLE)) AS wide, coalesce(stddev_samp(r.ret), 0) AS disp FROM (SELECT symbol, date, close, avg(close) OVER ({W} ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS ma FROM bars) b JOIN returns r ON b.symbol = r.symbol AND b.date = r.date GROUP BY b.date),
  of_index AS (SELECT date, level / avg(level) OVER (ORDER BY date ROWS BETWEEN 124 PRECEDING AND CURRENT ROW) - 1 AS momentum FROM market),
  of_vol AS (SELECT date, coalesce(stddev_samp(mret) OVER (ORDER BY date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW), 0) AS vol FROM market_returns)"""

SQL = {
    "signal_confidence": f"SELECT symbol, {_CLASS} AS class, CASE WHEN target <= 0 THEN 'Basse' WHEN width / target < 0.15 THEN 'Haute' WHEN width / target < 0.30 THEN 'Moyenne' ELSE 'Basse' END AS confidence, CASE WHEN target >= last THEN 'UP' ELSE 'DOWN' END AS trend FROM ({_SIGNALS}) s WHERE rn = 1",
    "signal_concentration": f"WITH k AS (SELECT class, count(*) AS n FROM (SELECT {_CLASS} AS class FROM ({_SIGNALS}) s WHERE rn = 1) x GROUP BY class) SELECT class AS dominant, round(CAST(n AS DOUBLE) / total, 4) AS ratio, CASE WHEN CAST(n AS DOUBLE) / total > 0.7 THEN 1 ELSE 0 END AS flagged, total AS n FROM (SELECT class, n, sum(n) OVER () AS total, row_number() OVER (ORDER BY n DESC, class) AS rn FROM k) y WHERE rn = 1",
    "signals_by_upside": f"SELECT symbol, round(100 * (target / last - 1), 4) + 0.0 AS upside FROM ({_SIGNALS}) s WHERE rn = 1 AND last > 0",
    "signal_history": f"SELECT g.month AS as_of, s.symbol, max_by(s.close, s.date) AS last, round(avg(s.close), 4) AS mean FROM (SELECT DISTINCT CAST(date_trunc('month', date) AS DATE) AS month FROM bars) g JOIN bars s ON s.date < g.month AND s.date >= BACK(g.month;90) GROUP BY g.month, s.symbol",
    "period_prices": f"WITH {_MONTHLY} SELECT symbol, month, first, last, round(last / first - 1, 8) AS ret FROM m",
    "walk_forward_curves": f"{_WALK} SELECT curve, month, round(ln(level), 6) + 0.0 AS log_level FROM level",
    "walk_forward_metrics": f"{_WALK} SELECT curve, round(mean * 12 / (dev * sqrt(12)), 3) + 0.0 AS sharpe, round(deepest, 3) + 0.0 AS max_drawdown, round(power(final, CAST(365 AS DOUBLE) / DAYS(d2;d1)) - 1, 3) + 0.0 AS cagr FROM (SELECT curve, avg(r) AS mean, stddev_samp(r) AS dev, min(level / peak - 1) AS deepest, max_by(level, month) AS final, max(month) AS d2, min(month) AS d1 FROM (SELECT *, max(level) OVER (PARTITION BY curve ORDER BY month ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS peak FROM level) x GROUP BY curve HAVING count(*) >= 2) y WHERE dev > 0",
    "inverse_volatility_weights": f"{_WALK} SELECT symbol, month, round(w, 8) AS weight FROM w",
    "rolling_beta": f"SELECT symbol, date, CASE WHEN n = 60 THEN round(cov / var, 6) + 0.0 END AS beta FROM (SELECT r.symbol, r.date, count(*) OVER (PARTITION BY r.symbol ORDER BY r.date ROWS BETWEEN 59 PRECEDING AND CURRENT ROW) AS n, covar_samp(r.ret, m.mret) OVER (PARTITION BY r.symbol ORDER BY r.date ROWS BETWEEN 59 PRECEDING AND CURRENT ROW) AS cov, var_samp(m.mret) OVER (PARTITION BY r.symbol ORDER BY r.date ROWS BETWEEN 59 PRECEDING AND CURRENT ROW) AS var FROM returns r JOIN market_returns m ON r.date = m.date WHERE r.ret IS NOT NULL AND m.mret IS NOT NULL) x",
    "extreme_pairs": f"WITH p AS ({_PAIRS}) SELECT * FROM (SELECT a, b, pearson, 'most' AS side FROM p ORDER BY pearson DESC, a, b LIMIT 10) x UNION ALL SELECT * FROM (SELECT a, b, pearson, 'least' AS side FROM p ORDER BY pearson, a, b LIMIT 10) y",
    "fear_greed": f"WITH {_FEATURES} SELECT date, round(score, 4) AS score, CASE WHEN score < 25 THEN 'extreme fear' WHEN score < 45 THEN 'fear' WHEN score < 55 THEN 'neutral' WHEN score < 75 THEN 'greed' ELSE 'extreme greed' END AS zone FROM (SELECT date, 10 * (3 * wide_s + 3 * (1 - vol_s) + 2 * momentum_s + 2 * (1 - disp_s)) AS score FROM (SELECT date, {_scaled('wide')} AS wide_s, {_scaled('vol')} AS vol_s, {_scaled('momentum')} AS momentum_s, {_scaled('disp')} AS disp_s FROM (SELECT d.date, d.wide, d.disp, i.momentum, v.vol FROM by_date d JOIN of_index i ON d.date = i.date JOIN of_vol v ON d.date = v.date) f) g) h",
    "sector_rotation": "SELECT r.sector, round(avg(x.m1), 6) AS m1, round(avg(x.y1), 6) AS y1 FROM (SELECT q.symbol, q.last / max_by(CASE WHEN b.date <= BACK(q.date;30) THEN b.close END, CASE WHEN b.date <= BACK(q.date;30) THEN b.date END) - 1 AS m1, q.last / max_by(CASE WHEN b.date <= BACK(q.date;365) THEN b.close END, CASE WHEN b.date <= BACK(q.date;365) THEN b.date END) - 1 AS y1 FROM quotes q JOIN bars b ON q.symbol = b.symbol GROUP BY q.symbol, q.last) x JOIN brand r ON x.symbol = r.symbol GROUP BY r.sector",
    "allocation_guard": "SELECT q.symbol, round(q.last * r.shares / t.total, 8) AS weight, CASE WHEN q.last * r.shares / t.total > 0.25 THEN 1 ELSE 0 END AS flagged FROM quotes q JOIN brand r ON q.symbol = r.symbol CROSS JOIN (SELECT sum(x.last * y.shares) AS total FROM quotes x JOIN brand y ON x.symbol = y.symbol) t",
    "freshness": "SELECT symbol, date AS last_date, DAYS(m.top;date) AS days_behind FROM quotes CROSS JOIN (SELECT max(date) AS top FROM bars) m",
    "aligned_covariance": f"WITH k AS (SELECT date FROM panel WHERE close IS NOT NULL GROUP BY date HAVING count(*) = (SELECT count(DISTINCT symbol) FROM bars)), al AS (SELECT b.symbol, b.date, b.close / lag(b.close) OVER (PARTITION BY b.symbol ORDER BY b.date) - 1 AS ret FROM panel b JOIN k ON b.date = k.date) SELECT x.symbol AS a, y.symbol AS b, round(30 * covar_samp(x.ret, y.ret), 6) + 0.0 AS covariance, count(*) AS n FROM al x JOIN al y ON x.date = y.date AND x.symbol <= y.symbol WHERE x.ret IS NOT NULL AND y.ret IS NOT NULL GROUP BY x.symbol, y.symbol HAVING count(*) >= 2",
    "scaled_series": f"SELECT symbol, date, CASE WHEN hi > lo THEN round((close - lo) / (hi - lo), 6) END AS scaled, CASE WHEN last >= first THEN 'up' ELSE 'down' END AS direction FROM (SELECT symbol, date, close, max(close) OVER (PARTITION BY symbol) AS hi, min(close) OVER (PARTITION BY symbol) AS lo, max_by(close, date) OVER (PARTITION BY symbol) AS last, min_by(close, date) OVER (PARTITION BY symbol) AS first FROM (SELECT *, row_number() OVER ({W} DESC) AS rn FROM bars) y WHERE rn <= 30) x",
    "company_card": "SELECT q.symbol, r.sector, q.last, round(q.last * r.shares, 4) AS cap, max(b.close) AS year_high, min(b.close) AS year_low FROM quotes q JOIN brand r ON q.symbol = r.symbol JOIN bars b ON b.symbol = q.symbol AND b.date > BACK(q.date;365) GROUP BY q.symbol, r.sector, q.last, r.shares",
}
