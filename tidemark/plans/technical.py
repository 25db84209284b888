"""Recursive indicators and volume indicators as windows over the bars.

Exponential smoothing is a sum of values weighted by powers of q = 1 - a. Powers grow
without bound along a long series, so positions count anew every BLOCK rows: a row's
value is its block's sum and what the end of the block before still weighs. What is two
blocks back weighs less than 1e-60 for every span used here. So no series is gathered
into an array, and every window has the symbol as its key.
"""

from __future__ import annotations

BLOCK = 2048
W = "PARTITION BY symbol ORDER BY date"


def smoothed(source: str, x: str, a: float, out: str, keep: str) -> str:
    """The rows of source with keep and x smoothed as out; x has no nulls."""
    weight = f"CAST('{a!r}' AS DOUBLE)"
    placed = f"SELECT {keep}, {x} AS x_, row_number() OVER ({W}) - 1 AS pos_ FROM {source}"
    blocks = f"SELECT {keep}, x_, pos_, CAST(floor(pos_ / {BLOCK}) AS BIGINT) AS b_, CAST(pos_ % {BLOCK} AS DOUBLE) AS j_ FROM ({placed}) p_"
    sums = f"SELECT {keep}, b_, j_, power(1 - {weight}, j_) * sum(CASE WHEN pos_ = 0 THEN 1 ELSE {weight} END * x_ * power(1 - {weight}, -j_)) OVER (PARTITION BY symbol, b_ ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS l_ FROM ({blocks}) b_"
    return f"(SELECT {keep}, l_ + power(1 - {weight}, j_ + 1) * coalesce(max_by(l_, j_) OVER (PARTITION BY symbol ORDER BY b_ RANGE BETWEEN 1 PRECEDING AND 1 PRECEDING), 0) AS {out} FROM ({sums}) s_) {out}_"


def over(n: int) -> str:
    return f"OVER ({W} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


_E12 = smoothed("bars", "close", 2 / 13, "fast", "symbol, date, close")
_E26 = smoothed(_E12, "close", 2 / 27, "slow", "symbol, date, close, fast")
_MACD = smoothed(_E26, "fast - slow", 2 / 10, "sig", "symbol, date, close, fast, slow")
_MOVES = f"(SELECT * FROM (SELECT symbol, date, close, high, low, lag(close) OVER ({W}) AS pc, lag(high) OVER ({W}) AS ph, lag(low) OVER ({W}) AS pl FROM bars) m0 WHERE pc IS NOT NULL) moves_"
_GAIN = smoothed(_MOVES, "greatest(close - pc, 0)", 1 / 14, "gain", "symbol, date, close, pc")
_RSI = f"(SELECT symbol, date, close, CASE WHEN gain + loss > 0 THEN 100 * gain / (gain + loss) END AS rsi FROM {smoothed(_GAIN, 'greatest(pc - close, 0)', 1 / 14, 'loss', 'symbol, date, close, gain')}) rsi_"
_RANGE = "greatest(high - low, abs(high - pc), abs(low - pc))"
_ATR = smoothed(_MOVES, _RANGE, 1 / 14, "atr", "symbol, date, close, high, low, ph, pl")
_UP = smoothed(_ATR, "CASE WHEN high - ph > pl - low AND high > ph THEN high - ph ELSE 0 END", 1 / 14, "up", "symbol, date, atr, high, low, ph, pl")
_DOWN = smoothed(_UP, "CASE WHEN pl - low > high - ph AND pl > low THEN pl - low ELSE 0 END", 1 / 14, "down", "symbol, date, atr, up")
_ADX = smoothed(_DOWN, "CASE WHEN up + down > 0 THEN 100 * abs(up - down) / (up + down) ELSE 0 END", 1 / 14, "adx", "symbol, date, atr, up, down")
_T1 = smoothed("bars", "close", 2 / 16, "t1", "symbol, date")
_T2 = smoothed(_T1, "t1", 2 / 16, "t2", "symbol, date")
_T3 = smoothed(_T2, "t2", 2 / 16, "t3", "symbol, date")
_TYPICAL = f"(SELECT symbol, date, (high + low + close) / 3 AS tp, volume, row_number() OVER ({W}) AS pos, avg((high + low + close) / 3) {over(20)} AS ma FROM bars) typical_"

SQL = {
    "ema": f"SELECT symbol, date, round(fast, 4) AS ema12, round(slow, 4) AS ema26 FROM {_E26}",
    "macd": f"SELECT symbol, date, round(fast - slow, 4) + 0.0 AS macd, round(sig, 4) + 0.0 AS macd_signal, round(fast - slow - sig, 4) + 0.0 AS histogram FROM {_MACD}",
    "ppo": f"SELECT symbol, date, round(100 * (fast - slow) / slow, 4) + 0.0 AS ppo FROM {_E26}",
    "rsi": f"SELECT symbol, date, round(rsi, 4) AS rsi, CASE WHEN rsi > 70 THEN 'high' WHEN rsi < 30 THEN 'low' ELSE 'mid' END AS zone FROM {_RSI}",
    "stochastic_rsi": f"SELECT symbol, date, CASE WHEN hi - lo > 1e-6 THEN round((rsi - lo) / (hi - lo), 4) END AS stoch_rsi FROM (SELECT symbol, date, rsi, max(rsi) {over(14)} AS hi, min(rsi) {over(14)} AS lo FROM {_RSI}) x",
    "atr": f"SELECT symbol, date, round(atr, 4) AS atr, round(100 * atr / close, 4) AS atr_pct, round(close - 2 * atr, 4) + 0.0 AS stop FROM {_ATR}",
    "adx": f"SELECT symbol, date, round(100 * up / atr, 4) AS plus_di, round(100 * down / atr, 4) AS minus_di, round(adx, 4) AS adx FROM {_ADX} WHERE atr > 0",
    "trix": f"SELECT symbol, date, round(100 * (t3 / lag(t3) OVER ({W}) - 1), 4) + 0.0 AS trix FROM {_T3}",
    "cci": f"WITH t AS (SELECT * FROM {_TYPICAL}) SELECT a.symbol, a.date, CASE WHEN avg(abs(b.tp - a.ma)) > 1e-9 THEN round((a.tp - a.ma) / (0.015 * avg(abs(b.tp - a.ma))), 4) + 0.0 END AS cci FROM (SELECT symbol, date, tp, ma, pos, explode(sequence(0, 19)) AS back FROM t) a JOIN t b ON a.symbol = b.symbol AND b.pos = a.pos - a.back GROUP BY a.symbol, a.date, a.tp, a.ma",
    "money_flow": f"SELECT symbol, date, CASE WHEN plus + minus > 0 THEN round(100 * plus / (plus + minus), 4) END AS mfi FROM (SELECT symbol, date, sum(CASE WHEN tp > ptp THEN tp * volume ELSE 0 END) {over(14)} AS plus, sum(CASE WHEN tp < ptp THEN tp * volume ELSE 0 END) {over(14)} AS minus FROM (SELECT *, lag(tp) OVER ({W}) AS ptp FROM {_TYPICAL}) y) x",
    "indicator_votes": f"SELECT m.symbol, m.date, CASE WHEN r.rsi < 30 THEN 1 WHEN r.rsi > 70 THEN -1 ELSE 0 END AS momentum_vote, CASE WHEN m.fast - m.slow - m.sig > 1e-6 THEN 1 WHEN m.fast - m.slow - m.sig < -1e-6 THEN -1 ELSE 0 END AS trend_vote FROM {_MACD.removesuffix('sig_')} m JOIN {_RSI.removesuffix('rsi_')} r ON m.symbol = r.symbol AND m.date = r.date",
}
