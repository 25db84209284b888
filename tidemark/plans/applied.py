"""Queries that apply the operators to the given tables; their SQL is written on its own, not made from theirs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import french
from tidemark.operators import allocation, bars, dividends, news, portfolio
from tidemark.plans import roles
from tidemark.sources import sinks
from tidemark.sources.scratch import written

# What the news query looks for.
PATTERNS = {"apache": ["apache license"], "cc": ["cc by-nc 4.0"], "gpl": ["gnu general public license"], "mit": ["mit license"], "any": ["licensed under", "released under"]}
TRADES = """trades AS (SELECT p_brand AS symbol, CAST(o_orderdate AS DATE) AS date, l_extendedprice / l_quantity AS price, l_quantity AS quantity, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)"""
BARS = f"{TRADES}, bars AS (SELECT symbol, date, max(price) AS high, min(price) AS low, arg_max(price, (l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, quantity)) AS close, sum(CAST(quantity AS BIGINT)) AS volume FROM trades GROUP BY symbol, date)"


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def daily_bars(spark: SparkSession, sf: str) -> DataFrame:
    """symbol, date, high, low, close, volume of the brands; trades of a day are ordered by their keys."""
    return roles.stored_bars(spark, sf).select("symbol", "date", "high", "low", "close", "volume")


def percent_changes(spark, sf):
    return daily_bars(spark, sf).select("symbol", "date", F.round(bars.change(None), 8).alias("ret")).where("ret is not null")


def flagged_runs(spark, sf):
    """Runs of equal rounded closes (logarithms, so that runs occur)."""
    own = daily_bars(spark, sf).withColumn("close", F.floor(F.log2("close") / 3))
    flags = bars.liquidity(bars.flagged(own))
    return flags.select("symbol", "rows_raw", "rows_kept", F.round("illiquid_ratio", 6).alias("illiquid_ratio"), F.col("excluded").cast("int").alias("excluded"))


def semester_returns(spark, sf):
    return bars.returns_since(daily_bars(spark, sf), "semester").select("symbol", F.round("ret", 6).alias("ret"))


def date_attributes(spark, sf):
    return bars.calendar_attributes(_table(spark, sf, "orders").select(F.col("o_orderdate").cast("date").alias("date")).distinct()).select("date", "year", "quarter", "semester", "month", "iso_week", "weekday", "year_month", F.col("starts_semester").cast("int").alias("starts_semester"), F.col("starts_week").cast("int").alias("starts_week"))


def monthly_kendall(spark, sf):
    month = F.trunc("date", "month").cast("date")
    own = daily_bars(spark, sf).groupBy("symbol", month.alias("month")).agg(F.max_by("close", "date").alias("value"))
    return bars.kendall_pairs(own.withColumnRenamed("month", "date")).select("a", "b", "n", F.round("tau", 6).alias("tau"))


def shrunk_covariances(spark, sf):
    """Of monthly returns, which all brands have; months and returns are written once, as each is read several times."""
    own = written(daily_bars(spark, sf).groupBy("symbol", F.trunc("date", "month").cast("date").alias("date")).agg(F.max_by("close", "date").alias("close")), "months")
    grid = own.agg(F.max("date").alias("as_of"))
    got = allocation.shrunk_covariance(written(allocation.aligned_returns(own, grid, years=10), "returns"))
    return got.select("a", "b", F.round("raw", 6).alias("raw"), F.round("shrunk", 6).alias("shrunk"), F.round("shrinkage", 6).alias("shrinkage"))


def fused_dividends(spark, sf):
    o = _table(spark, sf, "orders")
    key = F.col("o_orderkey")
    rows = o.select(F.col("o_custkey").alias("ticker"), F.year("o_orderdate").alias("exercice"), F.when(key % 2 == 0, "official").when(key % 4 == 1, "history").otherwise("upcoming").alias("src"), key.alias("seq"), F.when(key % 5 != 0, F.date_format("o_orderdate", "yyyy-MM-dd")).alias("ex_date"), F.when(key % 3 != 0, F.date_format("o_orderdate", "yyyy-MM-dd")).alias("pay_date"), F.when(key % 7 != 0, F.col("o_totalprice")).alias("amount"), F.when(key % 11 != 0, F.round(F.col("o_totalprice") / 1000, 2)).alias("yield_pct"), F.when(key % 13 != 0, key.cast("string")).alias("notice"))
    return dividends.fused(rows.dropDuplicates(["seq"])).withColumn("diverges", F.coalesce(F.col("diverges"), F.lit(False)).cast("int"))


def news_links(spark, sf):
    titles = _table(spark, sf, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("title"))
    return news.linked(titles, PATTERNS)


def held_positions(spark, sf):
    own = _table(spark, sf, "lineitem").join(_table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).join(_table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
    held = own.groupBy(F.col("o_custkey").alias("portfolio"), F.col("p_brand").alias("symbol")).agg(F.sum(F.when(F.col("l_returnflag") == "R", 0).otherwise(F.col("l_quantity").cast("long"))).alias("quantity"), (F.sum("l_extendedprice") / F.sum("l_quantity")).alias("avg_cost"))
    quotes = daily_bars(spark, sf).groupBy("symbol").agg(F.max_by("close", "date").alias("last")).where("symbol <> 'Brand#11'")
    got = portfolio.positions(held, quotes)
    return got.select("portfolio", "symbol", "quantity", F.round(F.col("invested") + 1e-6, 4).alias("invested"), F.round(F.col("market_value") + 1e-6, 4).alias("market_value"), F.round(F.col("pnl_pct") + 1e-7, 4).alias("pnl_pct"), F.round("weight", 6).alias("weight"))


def stored_upsert(spark, sf):
    """Urgent orders' totals by customer and year, upserted into those of the others, from the stored table, after a replay."""
    from tidemark.plans.roles import scratch_folder

    o = _table(spark, sf, "orders").select(F.col("o_custkey").alias("k"), F.year("o_orderdate").alias("y"), F.round("o_totalprice", 2).alias("v"), F.col("o_orderkey").alias("seq"), (F.col("o_orderpriority") < "3").alias("first"))
    own = sinks.StoredTable(spark, scratch_folder(spark, "upsert"))
    own.upsert(o.where("first").drop("first"), ["k", "y"], "seq")
    for _ in range(2):
        got = own.upsert(o.where("not first").drop("first"), ["k", "y"], "seq")
    return got


def parsed_numbers(spark, sf):
    """Prices written as French text with spaces that do not break, units, dashes and blanks."""
    p = F.col("p_partkey")
    text = F.concat(F.replace(F.format_number(F.col("p_retailprice"), 2), F.lit(","), F.lit(" ")), F.lit(""))
    text = F.translate(text, ".", ",")
    text = F.when(p % 5 == 0, F.translate(text, " ", " ")).when(p % 5 == 1, F.concat(F.translate(text, " ", " "), F.lit(" %"))).when(p % 5 == 2, F.lit("-")).when(p % 5 == 3, F.concat(F.lit(" "), text, F.lit(" MFCFA"))).otherwise(F.lit(""))
    return _table(spark, sf, "part").select(p.alias("id"), F.round(french.clean_number(text), 2).alias("value"), french.clean_int(text).alias("whole"))


def ledger_states(spark, sf):
    """Events as transactions of their users: the ledger replayed."""
    e = _table(spark, sf, "events")
    size = F.floor(F.abs("value")).cast("long") + 1
    kind = F.when(F.col("event_type") == "click", "DEPOSIT").when(F.col("event_type") == "view", "BUY").when(F.col("event_type") == "purchase", "SELL").otherwise("WITHDRAW")
    rows = e.select(F.col("user_id").alias("portfolio"), F.col("event_id").alias("seq"), kind.alias("type"), F.when(kind.isin("BUY", "SELL"), F.concat(F.lit("S"), F.col("event_id") % 3)).alias("symbol"), F.when(kind.isin("BUY", "SELL"), size % 5 + 1).otherwise(size).alias("quantity"), F.when(kind.isin("BUY", "SELL"), 10.0).otherwise(1.0).alias("price"))
    return portfolio.replayed(rows)


def month_forecasts(spark, sf):
    own = daily_bars(spark, sf)
    grid = own.select(F.trunc("date", "month").cast("date").alias("as_of")).distinct()
    got = allocation.signals(allocation.forecasts(own, grid))
    return got


def article_fields(spark, sf):
    from tidemark.operators import pages

    own = pages.articles(_table(spark, sf, "pages").select(F.col("page_id").alias("id"), "html"))
    return own.select("id", "title", "published", "author", "category", F.length("content").alias("n_chars"), F.sha2("content", 256).alias("content_sha256"), "image")


def parabolic_stops(spark, sf):
    """Rounded away from ties, which the engines' rounding treats differently."""
    return bars.parabolic_sar(daily_bars(spark, sf)).select("symbol", "date", F.round(F.col("sar") + 1.23e-6, 4).alias("sar"), F.col("rising").cast("int").alias("rising"))


QUERIES = {f.__name__: f for f in (parabolic_stops, percent_changes, flagged_runs, semester_returns, date_attributes, monthly_kendall, shrunk_covariances, fused_dividends, news_links, held_positions, stored_upsert, parsed_numbers, ledger_states, month_forecasts, article_fields)}

_MONTHS = f"{BARS}, months AS (SELECT symbol, CAST(date_trunc('month', date) AS DATE) AS month, arg_max(close, date) AS value FROM bars GROUP BY 1, 2)"
_PLAIN = "regexp_replace(translate(lower(replace(replace(coalesce(text, ''), '’', ''''), '‘', '''')), 'àâäáãåçéèêëíìîïñóòôöõúùûüýÿ', 'aaaaaaceeeeiiiinooooouuuuyy'), '[^\\x00-\\x7F]', '', 'g')"
_HITS = ", ".join(f"CASE WHEN regexp_matches(t, '\\b({'|'.join(x.replace('.', chr(92) + '.') for x in v)})\\b') THEN '{k}' END" for k, v in sorted(PATTERNS.items()))
ORACLE = {
    "parabolic_stops": f"""WITH RECURSIVE {BARS}, n AS MATERIALIZED (SELECT symbol, date, CAST(high AS DOUBLE) AS h, CAST(low AS DOUBLE) AS l, CAST(close AS DOUBLE) AS c, row_number() OVER w AS i, CAST(lag(high) OVER w AS DOUBLE) AS h1, CAST(lag(low) OVER w AS DOUBLE) AS l1, CAST(lag(close) OVER w AS DOUBLE) AS c1, CAST(lag(high, 2) OVER w AS DOUBLE) AS h2, CAST(lag(low, 2) OVER w AS DOUBLE) AS l2 FROM bars WINDOW w AS (PARTITION BY symbol ORDER BY date)),
      s AS (SELECT symbol, i, date, c >= c1 AS up, CASE WHEN c >= c1 THEN l1 ELSE h1 END AS sar, CASE WHEN c >= c1 THEN greatest(h1, h) ELSE least(l1, l) END AS ep, 2e-2 AS af FROM n WHERE i = 2
      UNION ALL SELECT symbol, i, date, up <> flip, CASE WHEN flip THEN ep ELSE x END, CASE WHEN flip AND up THEN l WHEN flip THEN h WHEN up THEN greatest(ep, h) ELSE least(ep, l) END, CASE WHEN flip THEN 2e-2 WHEN (up AND h > ep) OR (NOT up AND l < ep) THEN least(af + 2e-2, 2e-1) ELSE af END
      FROM (SELECT *, CASE WHEN up THEN l < x ELSE h > x END AS flip FROM (SELECT n.*, up, ep, af, CASE WHEN up THEN least(sar + af * (ep - sar), l1, l2) ELSE greatest(sar + af * (ep - sar), h1, h2) END AS x FROM s JOIN n ON n.symbol = s.symbol AND n.i = s.i + 1)))
      SELECT symbol, date, round(sar + 1.23e-6, 4) AS sar, CAST(up AS INT) AS rising FROM s""",
    "percent_changes": f"WITH {BARS} SELECT symbol, date, ret FROM (SELECT symbol, date, round(close / lag(close) OVER (PARTITION BY symbol ORDER BY date) - 1, 8) AS ret FROM bars) WHERE ret IS NOT NULL",
    "flagged_runs": f"""WITH {BARS}, c AS (SELECT symbol, date, floor(log2(close) / 3) AS close, volume, row_number() OVER (PARTITION BY symbol ORDER BY date) AS i FROM bars),
      k AS (SELECT *, i - row_number() OVER (PARTITION BY symbol, close ORDER BY date) AS island FROM c),
      r AS (SELECT *, count(*) OVER (PARTITION BY symbol, close, island) > 3 OR volume <= 0 AS bad FROM k)
      SELECT symbol, count(*) AS rows_raw, count(*) FILTER (WHERE NOT bad) AS rows_kept, round(1 - count(*) FILTER (WHERE NOT bad) / count(*), 6) AS illiquid_ratio, CAST(1 - count(*) FILTER (WHERE NOT bad) / count(*) > 0.4 AS INT) AS excluded FROM r GROUP BY symbol""",
    "semester_returns": f"""WITH {BARS}, e AS (SELECT symbol, max(date) AS d, arg_max(close, date) AS last FROM bars GROUP BY symbol),
      s AS (SELECT *, CASE WHEN month(d) <= 6 THEN make_date(year(d), 1, 1) ELSE make_date(year(d), 7, 1) END AS start FROM e)
      SELECT s.symbol, round(any_value(s.last) / arg_max(b.close, b.date) - 1, 6) AS ret FROM s JOIN bars b ON b.symbol = s.symbol AND b.date < s.start GROUP BY s.symbol""",
    "date_attributes": """SELECT DISTINCT d AS date, year(d) AS year, quarter(d) AS quarter, CASE WHEN quarter(d) <= 2 THEN 1 ELSE 2 END AS semester, month(d) AS month, week(d) AS iso_week, isodow(d) AS weekday, strftime(d, '%Y-%m') AS year_month, CASE WHEN strftime(d, '%m-%d') IN ('01-01', '07-01') THEN 1 ELSE 0 END AS starts_semester, CASE WHEN isodow(d) = 1 THEN 1 ELSE 0 END AS starts_week FROM (SELECT CAST(o_orderdate AS DATE) AS d FROM orders)""",
    "monthly_kendall": f"""WITH {_MONTHS}, p AS (SELECT x.symbol AS a, y.symbol AS b, x.month, x.value AS v, y.value AS w FROM months x JOIN months y ON x.month = y.month AND x.symbol < y.symbol),
      t AS (SELECT p.a, p.b, sign(q.v - p.v) AS dv, sign(q.w - p.w) AS dw FROM p JOIN p q ON p.a = q.a AND p.b = q.b AND p.month < q.month)
      SELECT a, b, count(*) AS n, round((count(*) FILTER (WHERE dv * dw > 0) - count(*) FILTER (WHERE dv * dw < 0)) / sqrt(CAST(count(*) FILTER (WHERE dv <> 0) AS DOUBLE) * count(*) FILTER (WHERE dw <> 0)), 6) AS tau FROM t GROUP BY a, b""",
    "shrunk_covariances": f"""WITH {_MONTHS}, top AS (SELECT max(month) AS hi FROM months), m AS (SELECT months.* FROM months, top WHERE month >= hi - INTERVAL 10 YEAR),
      f AS (SELECT month FROM m GROUP BY month HAVING count(*) = (SELECT count(DISTINCT symbol) FROM m)),
      r AS (SELECT * FROM (SELECT symbol, month, value / lag(value) OVER (PARTITION BY symbol ORDER BY month) - 1 AS ret FROM m SEMI JOIN f USING (month)) WHERE ret IS NOT NULL),
      c AS (SELECT symbol, month, ret - avg(ret) OVER (PARTITION BY symbol) AS x FROM r),
      s AS (SELECT u.symbol AS a, v.symbol AS b, avg(u.x * v.x) AS cov, covar_samp(u.x, v.x) AS raw, count(*) AS n FROM c u JOIN c v USING (month) GROUP BY 1, 2),
      d AS (SELECT count(DISTINCT symbol) AS p, count(DISTINCT month) AS n FROM c), q AS (SELECT sum(k * k) AS q2 FROM (SELECT sum(x * x) AS k FROM c GROUP BY month)),
      w AS (SELECT sum(CASE WHEN a = b THEN cov END) / any_value(p) AS mu, sum(cov * cov) / any_value(p) - power(sum(CASE WHEN a = b THEN cov END) / any_value(p), 2) AS delta, (any_value(q2) / any_value(d.n) - sum(cov * cov)) / (any_value(p) * any_value(d.n)) AS beta FROM s, d, q)
      SELECT a, b, round(raw, 6) AS raw, round((1 - least(beta, delta) / delta) * cov + CASE WHEN a = b THEN least(beta, delta) / delta * mu ELSE 0 END, 6) AS shrunk, round(least(beta, delta) / delta, 6) AS shrinkage FROM s, w""",
    "fused_dividends": """WITH o AS (SELECT DISTINCT ON (o_orderkey) * FROM orders),
      r AS (SELECT o_custkey AS ticker, CAST(year(o_orderdate) AS INT) AS exercice, o_orderkey AS seq, CASE WHEN o_orderkey % 2 = 0 THEN 'official' WHEN o_orderkey % 4 = 1 THEN 'history' ELSE 'upcoming' END AS src, CASE WHEN o_orderkey % 5 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS ex_date, CASE WHEN o_orderkey % 3 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS pay_date, CASE WHEN o_orderkey % 7 <> 0 THEN o_totalprice END AS amount, CASE WHEN o_orderkey % 11 <> 0 THEN round(o_totalprice / 1000, 2) END AS yield_pct, CASE WHEN o_orderkey % 13 <> 0 THEN CAST(o_orderkey AS VARCHAR) END AS notice FROM o),
      l AS (SELECT ticker, exercice, list({'src': src, 'e': ex_date, 'p': pay_date, 'a': amount, 'y': yield_pct, 'n': notice} ORDER BY seq) AS everything, string_agg(DISTINCT src, ',' ORDER BY src) AS sources FROM r GROUP BY 1, 2),
      k AS (SELECT *, list_filter(everything, lambda x: x.src = 'official') AS off, list_filter(everything, lambda x: x.src <> 'official') AS rest FROM l),
      g AS (SELECT *, len(off) > 0 AS known, CASE WHEN len(off) > 0 THEN off[1] ELSE rest[1] END AS h, list_filter(rest, lambda x: x.a IS NOT NULL)[1].a AS oa FROM k)
      SELECT ticker, exercice, CASE WHEN known AND h.e IS NULL THEN list_filter(rest, lambda x: x.e IS NOT NULL)[1].e ELSE h.e END AS ex_date, CASE WHEN known AND h.p IS NULL THEN list_filter(rest, lambda x: x.p IS NOT NULL)[1].p ELSE h.p END AS pay_date, CASE WHEN known AND h.a IS NULL THEN oa ELSE h.a END AS amount, CASE WHEN known AND len(rest) > 0 THEN rest[-1].y ELSE h.y END AS yield_pct, h.n AS notice, sources, CAST(coalesce(known AND abs(h.a - oa) > 0.01, false) AS INT) AS diverges FROM g""",
    "news_links": f"WITH p AS (SELECT doc_id AS id, {_PLAIN} AS t FROM documents), h AS (SELECT id, list_filter([{_HITS}], lambda x: x IS NOT NULL) AS keys FROM p) SELECT id, CASE WHEN len(keys) = 1 THEN keys[1] END AS key, CAST(len(keys) AS INT) AS n_keys, CASE len(keys) WHEN 0 THEN 'unlinked' WHEN 1 THEN 'linked' ELSE 'ambiguous' END AS outcome FROM h",
    "held_positions": f"""WITH {BARS}, q AS (SELECT symbol, arg_max(close, date) AS last FROM bars WHERE symbol <> 'Brand#11' GROUP BY symbol),
      h AS (SELECT o_custkey AS portfolio, p_brand AS symbol, CAST(sum(l_quantity) FILTER (WHERE l_returnflag <> 'R') AS BIGINT) AS quantity, sum(l_extendedprice) / sum(l_quantity) AS cost FROM lineitem, orders, part WHERE l_orderkey = o_orderkey AND l_partkey = p_partkey GROUP BY 1, 2),
      v AS (SELECT h.*, quantity * cost AS inv, quantity * last AS mv FROM h LEFT JOIN q USING (symbol) WHERE quantity > 0)
      SELECT portfolio, symbol, quantity, round(inv + 1e-6, 4) AS invested, round(mv + 1e-6, 4) AS market_value, round(100 * (mv - inv) / inv + 1e-7, 4) AS pnl_pct, round(coalesce(mv, inv) / sum(coalesce(mv, inv)) OVER (PARTITION BY portfolio), 6) AS weight FROM v""",
    "stored_upsert": "SELECT k, y, last.v AS v, last.seq AS seq FROM (SELECT o_custkey AS k, CAST(year(o_orderdate) AS INT) AS y, max(struct_pack(urgent := CAST(o_orderpriority >= '3' AS INT), seq := o_orderkey, v := round(o_totalprice, 2))) AS last FROM orders GROUP BY 1, 2)",
    "parsed_numbers": "SELECT p_partkey AS id, CASE WHEN p_partkey % 5 IN (0, 1, 3) THEN round(p_retailprice, 2) END AS value, CAST(CASE WHEN p_partkey % 5 IN (0, 1, 3) THEN trunc(round(p_retailprice, 2)) END AS BIGINT) AS whole FROM part",
}
