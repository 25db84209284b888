"""Queries that put the smaller operators, sources and sinks to work on the given tables; SQL written on its own."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import french
from tidemark.operators import allocation, bars, dividends, news, portfolio
from tidemark.plans.applied import BARS, PATTERNS, _table, daily_bars
from tidemark.sources import files, sinks
from tidemark.sources.scratch import scratch_folder
from tidemark.streaming import ingest

TIE = 1.23e-6  # keeps rounded values off ties, which the engines' rounding treats differently


def transaction_costs(spark, sf):
    q, p = F.col("l_quantity"), F.col("l_extendedprice") / F.col("l_quantity")
    own = _table(spark, sf, "lineitem").select("l_orderkey", portfolio.fee(F.col("l_extendedprice")).alias("fee"), portfolio.buy_cost(q, p).alias("cost"), portfolio.sell_proceeds(q, p).alias("proceeds"))
    return own.groupBy("l_orderkey").agg(F.sum("fee").alias("fee"), *(F.round(F.sum(c) + TIE, 3).alias(c) for c in ("cost", "proceeds")))


def _holdings(spark, sf):
    own = _table(spark, sf, "lineitem").join(_table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).join(_table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return own.groupBy(F.col("o_custkey").alias("portfolio"), F.col("p_brand").alias("symbol")).agg(F.sum(F.when(F.col("l_returnflag") == "R", 0).otherwise(F.col("l_quantity").cast("long"))).alias("quantity"), (F.sum("l_extendedprice") / F.sum("l_quantity")).alias("avg_cost"))


def _quotes(spark, sf):
    return daily_bars(spark, sf).groupBy("symbol").agg(F.max_by("close", "date").alias("last")).where("symbol <> 'Brand#11'")


def portfolio_totals(spark, sf):
    """Customers' holdings with their balance as cash, and deposits of some of them."""
    c = _table(spark, sf, "customer")
    cash = c.select(F.col("c_custkey").alias("portfolio"), F.col("c_acctbal").alias("cash"))
    deposits = c.where("c_custkey % 3 > 0").select(F.col("c_custkey").alias("portfolio"), (F.col("c_custkey") % 2 * 5000.0).alias("net_deposits"))
    got = portfolio.totals(portfolio.positions(_holdings(spark, sf), _quotes(spark, sf)), cash, deposits)
    return got.select("portfolio", *(F.round(F.col(x) + TIE, 3).alias(x) for x in ("holdings_value", "invested", "unrealised", "unrealised_pct", "total_value", "total_return", "total_return_pct")))


def rebalance_lines(spark, sf):
    """A plan of a million over the brands by their number of parts, held as all customers hold them."""
    parts = _table(spark, sf, "part").groupBy(F.col("p_brand").alias("symbol")).agg(F.count("*").alias("n"))
    weights = parts.crossJoin(F.broadcast(parts.agg(F.sum("n").alias("all")))).select("symbol", (F.col("n") / F.col("all")).alias("weight"))  # one row
    held = _holdings(spark, sf).where("portfolio % 50 = 0").groupBy("symbol").agg(F.sum("quantity").alias("quantity"))
    signals = parts.where("n % 2 = 0").select("symbol", F.lit("ACHAT").alias("signal"))
    got = portfolio.rebalance_plan(weights, _quotes(spark, sf), held, signals, F.lit(1e6))
    return got.select("symbol", "last", "held", "target", "delta", "action", F.round(F.col("amount") + TIE, 3).alias("amount"), "signal")


def dividend_years(spark, sf):
    """A wide table of dividends as a page gives it, in text, a row for each year from it."""
    o = _table(spark, sf, "orders").where("o_custkey % 5 = 0")
    text = lambda c: F.replace(F.format_string("%.2f", c), F.lit("."), F.lit(","))
    year = F.year("o_orderdate")
    wide = o.groupBy(F.col("o_custkey").alias("ticker")).agg(*(x for y in (1995, 1996, 1997) for x in (text(F.max(F.when(year == y, F.col("o_totalprice")))).alias(f"Div_{y}"), F.concat(text(F.max(F.when(year == y, F.col("o_orderkey") % 100 / 4))), F.lit(" %")).alias(f"Rend_{y}_Pct"))))
    return dividends.history_rows(wide, [1995, 1996, 1997])


def carried_closes(spark, sf):
    own = daily_bars(spark, sf).where("dayofmonth(date) % 2 = 0")
    return bars.filled(own, own.select("date").distinct()).select("symbol", "date", F.round(F.col("close") + TIE, 3).alias("close"))


def last_closes(spark, sf):
    """The closes of each brand's last bars, as a text."""
    own = bars.sparklines(daily_bars(spark, sf), 7)
    return own.select("symbol", F.array_join(F.transform("closes", lambda x: F.round(x + TIE, 2).cast("decimal(18,2)").cast("string")), ",").alias("closes"), F.size("dates").alias("n"))


def bar_turnovers(spark, sf):
    own = daily_bars(spark, sf)
    return bars.as_of(own, "2000-06-30", 2).select("symbol", "date", F.round(bars.turnover(), 0).alias("turnover"), F.round(bars.period_start(F.col("date"), "semester").cast("timestamp").cast("long") / 86400, 0).cast("long").alias("semester_day"))


def parsed_texts(spark, sf):
    """Dates and numbers written as French pages write them."""
    d, k = F.col("o_orderdate").cast("date"), F.col("o_orderkey")
    months = F.array(*(F.lit(m) for m in ("janvier", "Février", "mars", "avril", "mai", "juin", "juillet", "Août", "septembre", "octobre", "novembre", "décembre")))
    written = F.concat_ws(" ", F.dayofmonth(d).cast("string"), F.element_at(months, F.month(d)), F.year(d).cast("string"))
    slashed = F.concat_ws("/", F.dayofmonth(d).cast("string"), F.month(d).cast("string"), F.year(d).cast("string"))
    url = F.concat(F.lit("https://x.example/avis_exercice_"), F.year(d).cast("string"), F.lit("_"), k.cast("string"), F.lit(".PDF?v=1"))
    given = F.when(k % 3 == 0, F.concat((F.year(d) - 2).cast("string"), F.lit(".0"))).when(k % 3 == 1, F.lit(" nan "))
    paid = d.cast("string")
    return _table(spark, sf, "orders").select(k.alias("id"), french.french_date(written).alias("written"), french.slash_date(slashed).alias("slashed"), french.exercice(given, F.when(k % 2 == 0, url), paid).alias("exercice"), french.notice_path(F.lit("AB.ci"), F.year(d).cast("string"), url).alias("path"), french.first_comma_number(F.concat((k % 100).cast("string"), F.lit(","), (k % 9).cast("string"), F.lit(" %"))).alias("number"), french.spaces_normalised(F.concat(F.lit("  a  b "), k.cast("string"))).alias("spaces"), french.country(F.concat(k.cast("string"), F.lit(".CI"))).alias("country"), french.symbol_key(F.concat(F.lit("A-B."), k.cast("string"))).alias("key"), french.half_up(F.col("o_totalprice") / 10, 1).alias("half_up"))


def link_counts(spark, sf):
    titles = _table(spark, sf, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("title"))
    return news.link_statistics(news.linked(titles, PATTERNS))


def selected_news(spark, sf):
    own = _table(spark, sf, "documents").select("doc_id", F.col("text").alias("title"), F.col("source").alias("category"), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 300).cast("int")).alias("date"))
    return news.selected(own, "License", None, "2024-02-01", "2024-09-30").select("doc_id", "category", "date")


def signal_concentration(spark, sf):
    """Classes of brands by the last close against the first."""
    own = daily_bars(spark, sf).groupBy("symbol").agg(F.min_by("close", "date").alias("first"), F.max_by("close", "date").alias("last"))
    got = allocation.concentration(own.select(allocation.signal_class(F.col("first"), F.col("last")).alias("signal")), most=0.3)
    return got.select("dominant", F.round("ratio", 6).alias("ratio"), F.col("flagged").cast("int").alias("flagged"), "n")


def monthly_metrics(spark, sf):
    month = F.trunc("date", "month").cast("date")
    own = daily_bars(spark, sf).groupBy(F.col("symbol").alias("curve"), month.alias("date")).agg(F.max_by("close", F.col("date")).alias("level"))
    return allocation.curve_metrics(own)


def kept_first_writes(spark, sf):
    """Late orders do not replace what is known of a customer and year."""
    o = _table(spark, sf, "orders").select(F.col("o_custkey").alias("k"), F.year("o_orderdate").alias("y"), F.round("o_totalprice", 2).alias("v"), F.col("o_orderkey").alias("seq"))
    early, late = o.where("seq % 4 = 0"), o.where("seq % 4 > 0")
    none = early.limit(0)
    return sinks.inserted(sinks.inserted(none, early, ["k", "y"], "seq"), late, ["k", "y"], "seq")


def filled_values(spark, sf):
    """Values that are known replace what stands there; unknown ones clear nothing."""
    s = _table(spark, sf, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("v"))
    new = s.where("k % 3 < 2").select("k", F.when(F.col("k") % 3 == 0, F.lit("x")).alias("name"), (F.col("v") * 2).alias("v"))
    return sinks.updated(s, new, ["k"], ["name", "v"])


def new_increments(spark, sf):
    own = daily_bars(spark, sf).select("symbol", "date", "volume")
    known = own.where("date < '2000-01-01' and symbol <> 'Brand#21' and (symbol <> 'Brand#22' or date < '1999-01-01')")
    return sinks.increments(known, own, "symbol", "date")


def csv_round_trip(spark, sf):
    """Bars as French CSV files and back, by the header of each file."""
    path = scratch_folder(spark, "csv")
    own = daily_bars(spark, sf)
    sinks.to_french_csv(own.select((F.col("close") + TIE).alias("Cloture"), F.col("date").alias("Date"), F.col("volume").cast("double").alias("Volume_Titres"), (F.col("low") + TIE).alias("Plus_Bas"), F.col("symbol").alias("Titre")), path)
    lines = files.delimited(spark, f"{path}/*.csv")
    return files.bars_of(lines.withColumn("file", files.field("Titre"))).select(F.col("symbol_key").alias("symbol"), "date", "low", "close", "volume", "high")


def documents_round_trip(spark, sf):
    """Quotes of a country as one document for each, and back."""
    path = scratch_folder(spark, "documents")
    s = _table(spark, sf, "supplier")
    sinks.to_keyed_documents(s.select(F.col("s_nationkey").alias("country"), F.col("s_suppkey").cast("string").alias("ticker"), "s_name", "s_acctbal"), path, "ticker", ["country"])
    return files.keyed_documents(spark, path, "rows", "struct<s_name: string, s_acctbal: double>", lines=True).select(F.col("key").alias("ticker"), "value.s_name", "value.s_acctbal")


def statuses(spark, sf):
    path = scratch_folder(spark, "status")
    sinks.by_status(_table(spark, sf, "orders").select("o_orderkey", F.col("o_orderstatus").alias("statut"), "o_totalprice"), path)
    return spark.read.schema("o_orderkey long, o_totalprice double, statut string").parquet(path).groupBy("statut").agg(F.count("*").alias("n"), F.min("o_orderkey").alias("first"))


def year_sheet(spark, sf):
    own = _table(spark, sf, "orders").groupBy(F.col("o_orderpriority").alias("priority"), F.year("o_orderdate").cast("string").alias("y")).agg(F.count("*").alias("n"))
    return sinks.wide_sheet(own, "priority", "y", "n", ["1995", "1996", "1997"]).select("priority", *(F.col(y).alias(f"y{y}") for y in ("1995", "1996", "1997")))


def symbols_by_kind(spark, sf):
    """Symbols that the coverage calls shares, and, as it has no funds, all of the history for funds."""
    part = _table(spark, sf, "part")
    coverage = part.select(F.col("p_brand").alias("Ticker"), F.when(F.col("p_brand") < "Brand#3", " action").otherwise("Indice").alias("Type"))
    history = daily_bars(spark, sf)
    return files.symbols_of_kind(coverage, "Action", history).withColumn("kind", F.lit("Action")).unionByName(files.symbols_of_kind(coverage, "Fonds", history).withColumn("kind", F.lit("Fonds")))


def streamed_upsert(spark, sf):
    """Orders as a stream of files into a stored table: the last of each customer stays, also after a second run."""
    path, out = scratch_folder(spark, "orders"), scratch_folder(spark, "table")
    rows = _table(spark, sf, "orders").select(F.col("o_custkey").alias("k"), F.col("o_orderkey").alias("seq"), "o_totalprice")
    rows.repartition(4, "seq").write.parquet(path)
    state = scratch_folder(spark, "state")
    for _ in range(2):
        ingest.upserted(ingest.file_stream(spark, path, "k long, seq long, o_totalprice double"), out, ["k"], "seq", state).awaitTermination()
    return sinks.StoredTable(spark, out).read()


def stored_signals(spark, sf):
    """Signals by brand and day into a history, a second snapshot of the last day over the first."""
    own = daily_bars(spark, sf).where("year(date) = 2000").select(F.col("symbol").alias("ticker"), F.col("date").alias("as_of"), F.round(F.col("close") + TIE, 3).alias("close"))
    again = own.where("month(as_of) = 12").withColumn("close", F.col("close") + 1)
    return sinks.merged(sinks.merged(None, own, ["ticker", "as_of"]), again, ["ticker", "as_of"])


def day_movers(spark, sf):
    from tidemark.operators import detail

    own = daily_bars(spark, sf).where("date <= '2000-03-15'")
    return detail.movers(own).select("side", F.col("rank").cast("long").alias("rank"), "symbol", "date", F.round(F.col("close") + TIE, 3).alias("close"), F.round(F.col("change") + TIE, 4).alias("change"))


def value_growth(spark, sf):
    """Brands by what their parts bring, years as years of earnings."""
    from tidemark.operators import detail

    own, part = daily_bars(spark, sf), _table(spark, sf, "part")
    profiles = part.groupBy(F.col("p_brand").alias("symbol")).agg(F.count("*").alias("shares"), F.min("p_type").alias("sector"))
    earnings = own.groupBy("symbol", F.year("date").alias("exercice")).agg((F.sum("volume") / 100.0 - 30).alias("bnpa"))
    got = detail.positioning(own, earnings, profiles)
    return got.select("symbol", F.round(F.col("per") + TIE, 4).alias("per"), F.round(F.col("total_return") + TIE, 4).alias("total_return"), F.round(F.col("cap") + TIE, 2).alias("cap"), "sector")


def canonical_symbols(spark, sf):
    """Brands by the keys of their files; some have no document."""
    from tidemark.operators import detail

    brands = _table(spark, sf, "part").select("p_brand").distinct()
    key = F.regexp_replace("p_brand", "[^A-Za-z0-9]", "_")
    documents = brands.where("p_brand <> 'Brand#3'").select(F.concat(key, F.lit("_societe.json")).alias("file"), F.col("p_brand").alias("ticker"))
    return detail.canonical(brands.select(key.alias("symbol_key")), documents)


def news_status(spark, sf):
    """Number of news by category with a default, and the last day."""
    kinds = french.looked_up(F.col("lang"), {"fr": "Français", " EN ": "Anglais"}, "Autre")
    own = _table(spark, sf, "documents").select(kinds.alias("category"), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 300).cast("int")).alias("date"))
    return own.groupBy("category").agg(F.count("*").alias("n"), F.max("date").alias("last"))


def match_previews(spark, sf):
    titles = _table(spark, sf, "documents").select(F.col("doc_id").alias("id"), F.substring_index("text", "\n", 1).alias("head"), "text")
    path = scratch_folder(spark, "preview")
    sinks.match_preview(news.linked(titles.select("id", F.col("text").alias("title")), PATTERNS), titles.select("id", F.lit("t").alias("title")), path)
    return files.text_table(spark, path).select("outcome", F.col("id").cast("long").alias("id"), "key")


QUERIES = {f.__name__: f for f in (transaction_costs, portfolio_totals, rebalance_lines, dividend_years, carried_closes, last_closes, bar_turnovers, parsed_texts, link_counts, selected_news, signal_concentration, monthly_metrics, kept_first_writes, filled_values, new_increments, csv_round_trip, documents_round_trip, statuses, year_sheet, symbols_by_kind, streamed_upsert, stored_signals, day_movers, value_growth, canonical_symbols, news_status, match_previews)}

_HELD = f"""{BARS}, q AS (SELECT symbol, arg_max(close, date) AS last FROM bars WHERE symbol <> 'Brand#11' GROUP BY symbol),
  h AS (SELECT o_custkey AS portfolio, p_brand AS symbol, coalesce(CAST(sum(l_quantity) FILTER (WHERE l_returnflag <> 'R') AS BIGINT), 0) AS quantity, sum(l_extendedprice) / sum(l_quantity) AS cost FROM lineitem, orders, part WHERE l_orderkey = o_orderkey AND l_partkey = p_partkey GROUP BY 1, 2)"""
_PLAIN = "regexp_replace(translate(lower(replace(replace(coalesce(text, ''), '’', ''''), '‘', '''')), 'àâäáãåçéèêëíìîïñóòôöõúùûüýÿ', 'aaaaaaceeeeiiiinooooouuuuyy'), '[^\\x00-\\x7F]', '', 'g')"
_COUNT = " + ".join(f"CAST(regexp_matches(t, '\\b({'|'.join(x.replace('.', chr(92) + '.') for x in v)})\\b') AS INT)" for _, v in sorted(PATTERNS.items()))
_NAMED = ", ".join(f"CASE WHEN regexp_matches(t, '\\b({'|'.join(x.replace('.', chr(92) + '.') for x in v)})\\b') THEN '{k}' END" for k, v in sorted(PATTERNS.items()))
ORACLE = {
    "transaction_costs": f"SELECT l_orderkey, sum(f) AS fee, round(sum(l_extendedprice + f) + {TIE}, 3) AS cost, round(sum(l_extendedprice - f) + {TIE}, 3) AS proceeds FROM (SELECT *, floor(l_extendedprice * 0.011e0 + 0.5) AS f FROM lineitem) GROUP BY l_orderkey",
    "portfolio_totals": f"""WITH {_HELD}, v AS (SELECT portfolio, quantity * cost AS inv, coalesce(quantity * last, quantity * cost) AS mv FROM h LEFT JOIN q USING (symbol) WHERE quantity > 0),
      t AS (SELECT c_custkey AS portfolio, c_acctbal AS cash, coalesce(sum(mv), 0) AS hv, coalesce(sum(inv), 0) AS inv, CASE WHEN c_custkey % 3 > 0 THEN c_custkey % 2 * 5000.0 ELSE 0 END AS dep FROM customer LEFT JOIN v ON portfolio = c_custkey GROUP BY 1, 2)
      SELECT portfolio, round(hv + {TIE}, 3) AS holdings_value, round(inv + {TIE}, 3) AS invested, round(hv - inv + {TIE}, 3) AS unrealised, round(CASE WHEN inv > 0 THEN 100 * (hv - inv) / inv END + {TIE}, 3) AS unrealised_pct,
        round(hv + cash + {TIE}, 3) AS total_value, round(hv + cash - dep + {TIE}, 3) AS total_return, round(CASE WHEN dep > 0 THEN 100 * (hv + cash - dep) / dep END + {TIE}, 3) AS total_return_pct FROM t""",
    "rebalance_lines": f"""WITH {_HELD}, p AS (SELECT p_brand AS symbol, count(*) AS n FROM part GROUP BY 1), g AS (SELECT symbol, CAST(sum(quantity) AS BIGINT) AS held FROM h WHERE portfolio % 50 = 0 GROUP BY 1),
      l AS (SELECT p.symbol, last, coalesce(held, 0) AS held, CASE WHEN last > 0 THEN CAST(floor(CAST(n AS DOUBLE) / (SELECT sum(n) FROM p) * 1e6 / last) AS BIGINT) ELSE 0 END AS target, CASE WHEN n % 2 = 0 THEN 'ACHAT' END AS signal FROM p LEFT JOIN q USING (symbol) LEFT JOIN g USING (symbol))
      SELECT symbol, last, held, target, target - held AS delta, CASE WHEN target > held THEN 'BUY' WHEN target < held THEN 'SELL' ELSE 'HOLD' END AS action, round(target * last + {TIE}, 3) AS amount, signal FROM l""",
    "dividend_years": "SELECT o_custkey AS ticker, CAST(year(o_orderdate) AS VARCHAR) AS exercice, round(max(o_totalprice), 2) AS amount, round(max(o_orderkey % 100 / 4), 2) AS yield_pct FROM orders WHERE o_custkey % 5 = 0 AND year(o_orderdate) BETWEEN 1995 AND 1997 GROUP BY 1, 2",
    "carried_closes": f"""WITH {BARS}, b AS (SELECT symbol, date, close FROM bars WHERE day(date) % 2 = 0), g AS (SELECT s.symbol, d.date FROM (SELECT symbol, min(date) AS first FROM b GROUP BY 1) s, (SELECT DISTINCT date FROM b) d WHERE d.date >= s.first)
      SELECT g.symbol, g.date, round(b.close + {TIE}, 3) AS close FROM g ASOF JOIN b ON g.symbol = b.symbol AND g.date >= b.date""",
    "last_closes": f"WITH {BARS}, r AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY date DESC) AS k FROM bars) SELECT symbol, string_agg(CAST(CAST(round(close + {TIE}, 2) AS DECIMAL(18, 2)) AS VARCHAR), ',' ORDER BY date) AS closes, CAST(count(*) AS INT) AS n FROM r WHERE k <= 7 GROUP BY symbol",
    "bar_turnovers": f"WITH {BARS} SELECT symbol, date, round_even(volume * (high + low) / 2, 0) AS turnover, date_diff('day', DATE '1970-01-01', CASE WHEN month(date) > 6 THEN make_date(year(date), 7, 1) ELSE make_date(year(date), 1, 1) END) AS semester_day FROM bars WHERE date BETWEEN DATE '1998-06-30' AND DATE '2000-06-30'",
    "parsed_texts": """SELECT o_orderkey AS id, CAST(o_orderdate AS DATE) AS written, strftime(o_orderdate, '%Y-%m-%d') AS slashed, CAST(CASE WHEN o_orderkey % 3 = 0 THEN year(o_orderdate) - 2 WHEN o_orderkey % 2 = 0 THEN year(o_orderdate) ELSE year(o_orderdate) - 1 END AS VARCHAR) AS exercice,
      'AB.ci/' || year(o_orderdate) || '_avis_exercice_' || year(o_orderdate) || '_' || o_orderkey || '.pdf' AS path, CAST((o_orderkey % 100) || '.' || (o_orderkey % 9) AS DOUBLE) AS number, 'a b ' || o_orderkey AS spaces, 'ci' AS country, 'A_B_' || o_orderkey AS key, floor(o_totalprice / 10 * 10.0 + 0.5) / 10.0 AS half_up FROM orders""",
    "link_counts": f"WITH p AS (SELECT {_PLAIN} AS t FROM documents), k AS (SELECT {_COUNT} AS n FROM p) SELECT count(*) AS total, count(*) FILTER (WHERE n = 1) AS linked, count(*) FILTER (WHERE n > 1) AS ambiguous, count(*) FILTER (WHERE n = 0) AS unlinked FROM k",
    "selected_news": "SELECT doc_id, source AS category, CAST(DATE '2024-01-01' + CAST(doc_id % 300 AS INT) AS DATE) AS date FROM documents WHERE contains(lower(text), 'license') AND doc_id % 300 BETWEEN 31 AND 273",
    "signal_concentration": f"""WITH {BARS}, c AS (SELECT arg_max(close, date) / arg_min(close, date) - 1 AS r FROM bars GROUP BY symbol), s AS (SELECT CASE WHEN r >= 0.10 THEN 'ACHAT FORT' WHEN r >= 0.03 THEN 'ACHAT' WHEN r >= -0.03 THEN 'NEUTRE' WHEN r >= -0.10 THEN 'VENTE' ELSE 'VENTE FORTE' END AS signal FROM c),
      g AS (SELECT signal, count(*) AS c FROM s GROUP BY 1) SELECT signal AS dominant, round(c / (SELECT sum(c) FROM g), 6) AS ratio, CAST(c > 0.3 * (SELECT sum(c) FROM g) AS INT) AS flagged, CAST((SELECT sum(c) FROM g) AS BIGINT) AS n FROM g ORDER BY c DESC, signal LIMIT 1""",
    "monthly_metrics": f"""WITH {BARS}, m AS (SELECT symbol AS curve, CAST(date_trunc('month', date) AS DATE) AS date, arg_max(close, date) AS level FROM bars GROUP BY 1, 2),
      r AS (SELECT *, level / lag(level) OVER w - 1 AS ret, level / max(level) OVER w - 1 AS fall FROM m WINDOW w AS (PARTITION BY curve ORDER BY date))
      SELECT curve, round_even(avg(ret) * 12 / (stddev_samp(ret) * sqrt(12)), 3) AS sharpe, round_even(min(fall), 3) AS max_drawdown, round_even(power(arg_max(level, date) / arg_min(level, date), 365.0 / date_diff('day', min(date), max(date))) - 1, 3) AS cagr FROM r GROUP BY curve""",
    "kept_first_writes": "SELECT DISTINCT ON (k, y) k, y, v, seq FROM (SELECT o_custkey AS k, CAST(year(o_orderdate) AS INT) AS y, round(o_totalprice, 2) AS v, o_orderkey AS seq, o_orderkey % 4 > 0 AS late FROM orders) ORDER BY k, y, late, seq",
    "filled_values": "SELECT s_suppkey AS k, CASE WHEN s_suppkey % 3 = 0 THEN 'x' ELSE s_name END AS name, CASE WHEN s_suppkey % 3 < 2 THEN s_acctbal * 2 ELSE s_acctbal END AS v FROM supplier",
    "new_increments": f"WITH {BARS}, e AS (SELECT symbol, max(date) AS d FROM bars WHERE date < DATE '2000-01-01' AND (symbol <> 'Brand#22' OR date < DATE '1999-01-01') GROUP BY symbol) SELECT bars.symbol, date, volume FROM bars JOIN e ON e.symbol = bars.symbol WHERE bars.symbol = 'Brand#21' OR date > d",
    "csv_round_trip": f"WITH {BARS} SELECT symbol, date, CAST(printf('%.2f', low + {TIE}) AS DOUBLE) AS low, CAST(printf('%.2f', close + {TIE}) AS DOUBLE) AS close, CAST(volume AS DOUBLE) AS volume, CAST(NULL AS DOUBLE) AS high FROM bars",
    "documents_round_trip": "SELECT CAST(s_suppkey AS VARCHAR) AS ticker, s_name, s_acctbal FROM supplier",
    "statuses": "SELECT o_orderstatus AS statut, count(*) AS n, min(o_orderkey) AS first FROM orders GROUP BY 1",
    "year_sheet": "SELECT o_orderpriority AS priority, " + ", ".join(f"nullif(count(*) FILTER (WHERE year(o_orderdate) = {y}), 0) AS y{y}" for y in (1995, 1996, 1997)) + " FROM orders GROUP BY 1",
    "symbols_by_kind": "SELECT DISTINCT p_brand AS symbol, 'Action' AS kind FROM part WHERE p_brand < 'Brand#3' UNION ALL SELECT DISTINCT p_brand, 'Fonds' FROM part JOIN lineitem ON l_partkey = p_partkey",
    "streamed_upsert": "SELECT o_custkey AS k, max(o_orderkey) AS seq, arg_max(o_totalprice, o_orderkey) AS o_totalprice FROM orders GROUP BY 1",
    "stored_signals": f"WITH {BARS} SELECT symbol AS ticker, date AS as_of, round(close + {TIE}, 3) + CASE WHEN month(date) = 12 THEN 1 ELSE 0 END AS close FROM bars WHERE year(date) = 2000",
    "day_movers": f"""WITH {BARS}, c AS (SELECT symbol, date, close, close / lag(close) OVER (PARTITION BY symbol ORDER BY date) - 1 AS change FROM bars WHERE date <= DATE '2000-03-15'),
      d AS (SELECT *, row_number() OVER (ORDER BY change DESC, symbol) AS up, row_number() OVER (ORDER BY change, symbol) AS down FROM c WHERE date = (SELECT max(date) FROM c) AND change IS NOT NULL)
      SELECT 'top' AS side, up AS rank, symbol, date, round(close + {TIE}, 3) AS close, round(change + {TIE}, 4) AS change FROM d WHERE up <= 5 UNION ALL SELECT 'flop', down, symbol, date, round(close + {TIE}, 3), round(change + {TIE}, 4) FROM d WHERE down <= 5""",
    "value_growth": f"""WITH {BARS}, p AS (SELECT p_brand AS symbol, count(*) AS shares, min(p_type) AS sector FROM part GROUP BY 1), y AS (SELECT symbol, year(date) AS y, sum(volume) / 100.0 - 30 AS e FROM bars GROUP BY 1, 2), e AS (SELECT symbol, arg_max(e, y) AS e FROM y GROUP BY 1),
      b AS (SELECT symbol, arg_min(close, date) AS first, arg_max(close, date) AS last FROM bars GROUP BY 1)
      SELECT symbol, round(CASE WHEN e > 0 THEN last / e END + {TIE}, 4) AS per, round(last / first - 1 + {TIE}, 4) AS total_return, round(last * shares + {TIE}, 2) AS cap, sector FROM b JOIN e USING (symbol) JOIN p USING (symbol)""",
    "canonical_symbols": "SELECT replace(p_brand, '#', '_') AS symbol_key, nullif(p_brand, 'Brand#3') AS symbol FROM part GROUP BY p_brand",
    "news_status": "SELECT CASE lang WHEN 'fr' THEN 'Français' WHEN 'en' THEN 'Anglais' ELSE 'Autre' END AS category, count(*) AS n, max(CAST(DATE '2024-01-01' + CAST(doc_id % 300 AS INT) AS DATE)) AS last FROM documents GROUP BY 1",
    "match_previews": f"WITH p AS (SELECT doc_id AS id, {_PLAIN} AS t FROM documents), k AS (SELECT id, list_filter([{_NAMED}], lambda x: x IS NOT NULL) AS hits FROM p) SELECT CASE WHEN len(hits) = 1 THEN 'linked' ELSE 'ambiguous' END AS outcome, id, CASE WHEN len(hits) = 1 THEN hits[1] ELSE len(hits) || ' keys' END AS key FROM k WHERE len(hits) > 0",
}
