"""Detail documents, restrictions of a universe, and orders by name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators import bars

#: Order of names as French readers expect it: accents and case count only between names that are else the same.
COLLATION = "fr"


def security_details(quotes: DataFrame, profiles: DataFrame | None = None, signals: DataFrame | None = None, figures: DataFrame | None = None, upcoming: DataFrame | None = None, today: Column | None = None, n: int = 60) -> DataFrame:
    """One row for each symbol of any part: quote, profile, signal, figures (array by year), next_dividend, history (the last n bars, oldest first).

    quotes (symbol, date, close, ...), profiles and signals (a row for each symbol; of several
    the largest counts), figures (symbol, exercice, ...), upcoming (symbol, ex_date, ...): the
    first one that is not before today, dateless ones last. The parts are stacked and grouped
    once; a symbol's group holds n bars and its years at most. Rows without a symbol are left out.
    """
    whole = lambda t, *without: F.struct(*(c for c in t.columns if c not in ("symbol", *without)))
    newest = bars.last_bars(quotes.where("date is not null"), n + 1)
    change = F.try_divide("close", F.lag("close").over(bars.by_date())) - 1
    place = F.row_number().over(Window.partitionBy("symbol").orderBy(F.desc("date")))
    newest = newest.withColumns({"change": change, "place_": place}).where(F.col("place_") <= n)
    parts = [newest.select("symbol", F.struct("date", *(c for c in quotes.columns if c not in ("symbol", "date")), "change").alias("bar"))]
    kinds = {"bar": parts[0].schema["bar"].dataType.simpleString()}
    for name, t in (("profile", profiles), ("signal", signals), ("figure", figures), ("dividend", upcoming)):
        if t is None:
            continue
        if name == "figure":
            own = t.select("symbol", F.struct("exercice", *(c for c in t.columns if c not in ("symbol", "exercice"))).alias(name))
        elif name == "dividend":
            later = t if today is None else t.where(F.col("ex_date").isNull() | (F.col("ex_date") >= today))
            own = later.select("symbol", F.struct(F.coalesce("ex_date", F.lit("9999-12-31").cast("date")).alias("when_"), whole(t).alias("row")).alias(name))
        else:
            own = t.select("symbol", whole(t).alias(name))
        parts.append(own)
        kinds[name] = own.schema[name].dataType.simpleString()
    stacked = parts[0]
    for own in parts[1:]:
        stacked = stacked.unionByName(own, allowMissingColumns=True)
    for name in ("profile", "signal", "figure", "dividend"):
        if name not in kinds:
            stacked = stacked.withColumn(name, F.lit(None).cast("struct<none:string>" if name != "dividend" else "struct<when_:date, row:struct<none:string>>"))
    return stacked.where("symbol is not null").groupBy("symbol").agg(F.max("bar").alias("quote"), F.max("profile").alias("profile"), F.max("signal").alias("signal"), F.sort_array(F.collect_list("figure")).alias("figures"), F.min("dividend").getField("row").alias("next_dividend"), F.sort_array(F.collect_list("bar")).alias("history"))


def by_name(rows: DataFrame, name: str = "name", collation: str = COLLATION) -> DataFrame:
    """The rows in the language's order of names, equal names in the order of their code points; nulls first."""
    return rows.orderBy(F.collate(F.col(name), collation), F.col(name))


def ranked_by_name(rows: DataFrame, within: list[str], name: str = "name", collation: str = COLLATION) -> DataFrame:
    """Adds place: the place of each row's name in the language's order within its group."""
    return rows.withColumn("place", F.row_number().over(Window.partitionBy(*within).orderBy(F.collate(F.col(name), collation), F.col(name))))


def headline_first(rows: DataFrame, code: str, first: list[str]) -> DataFrame:
    """The rows of the named codes first, in the order given, then the rest by code."""
    at = F.array_position(F.array(*(F.lit(x) for x in first)), F.col(code))
    return rows.orderBy(F.when(at > 0, at).otherwise(len(first) + 1), code)


def restricted(rows: DataFrame, wanted: DataFrame, key: str = "symbol") -> DataFrame:
    """Rows of wanted keys; where no key is wanted at all, every row."""
    named = wanted.select(key).where(F.col(key).isNotNull()).distinct()
    none = named.limit(1).agg((F.count("*") == 0).alias("none_"))  # one row
    flagged = rows.crossJoin(F.broadcast(none))
    return flagged.join(named.withColumn("named_", F.lit(True)), key, "left").where("none_ or named_").select(*rows.columns)


def overlap(left: DataFrame, right: DataFrame, key: str = "symbol") -> DataFrame:
    """key, side: both, left or right for each key that either table has; nulls do not count."""
    keys = left.select(key, F.lit(1).alias("bit")).unionByName(right.select(key, F.lit(2).alias("bit"))).where(F.col(key).isNotNull())
    return keys.groupBy(key).agg(F.element_at(F.array(F.lit("left"), F.lit("right"), F.lit("both")), F.bit_or("bit")).alias("side"))


def expected_income(plan: DataFrame, upcoming: DataFrame) -> DataFrame:
    """symbol, quantity, amount, income of target lines with a first upcoming dividend (symbol, ex_date, amount): the earliest date, then the largest amount; lines without one have none."""
    first = Window.partitionBy("symbol").orderBy(F.asc_nulls_last("ex_date"), F.desc_nulls_last("amount"))
    next_one = upcoming.join(plan.select("symbol").distinct(), "symbol", "left_semi").withColumn("rank_", F.row_number().over(first)).where("rank_ = 1").select("symbol", "ex_date", "amount")
    return plan.select("symbol", "quantity").join(next_one, "symbol", "left").withColumn("income", F.col("quantity") * F.col("amount"))


def movers(rows: DataFrame, n: int = 5) -> DataFrame:
    """side ('top' or 'flop'), rank, symbol, date, close, change of the n largest and n smallest changes of the newest day (ties: by symbol); symbols without a bar on it or before it are left out."""
    change = F.try_divide("close", F.lag("close").over(bars.by_date())) - 1
    last = rows.agg(F.max("date").alias("date"))  # one row
    own = rows.select("symbol", "date", "close", change.alias("change")).join(F.broadcast(last), "date", "left_semi").where("change is not null")
    sides = []
    for side, order in (("top", F.desc("change")), ("flop", F.asc("change"))):
        best = own.orderBy(order, "symbol").limit(n)
        sides.append(best.select(F.lit(side).alias("side"), F.row_number().over(Window.partitionBy(F.lit(side)).orderBy(order, "symbol")).alias("rank"), "symbol", "date", "close", "change"))
    return sides[0].unionByName(sides[1])


def movers_document(rows: DataFrame, n: int = 5) -> DataFrame:
    """One document of the movers: date, top, flop."""
    own = movers(rows, n)
    side = lambda s: F.sort_array(F.collect_list(F.when(F.col("side") == s, F.struct("rank", "symbol", "close", "change")))).alias(s)
    return own.agg(F.max("date").alias("date"), side("top"), side("flop")).select(F.to_json(F.struct("date", "top", "flop")).alias("document"))


def positioning(rows: DataFrame, earnings: DataFrame, profiles: DataFrame) -> DataFrame:
    """symbol, per, total_return, cap, sector: the last close over the newest earnings per share (null without positive ones), the change from the first close to the last, and the shares' worth, for symbols with a bar.

    earnings (symbol, exercice, bnpa), profiles (symbol, shares, sector).
    """
    own = rows.groupBy("symbol").agg(F.min_by("close", "date").alias("first_"), F.max_by("close", "date").alias("last_"))
    newest = earnings.where("bnpa is not null").groupBy("symbol").agg(F.max_by("bnpa", "exercice").alias("bnpa_"))
    own = own.join(newest, "symbol", "left").join(profiles.select("symbol", "shares", "sector"), "symbol", "left")
    return own.select("symbol", F.when(F.col("bnpa_") > 0, F.col("last_") / F.col("bnpa_")).alias("per"), (F.try_divide("last_", "first_") - 1).alias("total_return"), (F.col("last_") * F.col("shares")).alias("cap"), "sector")


def canonical(rows: DataFrame, documents: DataFrame) -> DataFrame:
    """rows (symbol_key, ...) with symbol: the ticker that a document of the same file key holds; null where none does. Keys are never turned back into symbols by their letters.

    documents (file, ticker): the key is the file's name up to its last underscore; of several tickers of a key the smallest counts.
    """
    known = documents.where("ticker is not null").groupBy(F.regexp_replace("file", r"_[^_]*$", "").alias("symbol_key")).agg(F.min("ticker").alias("symbol"))
    return rows.join(known, "symbol_key", "left")
