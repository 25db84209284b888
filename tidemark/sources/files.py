"""Scans of the flat files and documents of a market data set; one read for all files of a kind."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions import french

#: A document of figures by name and year.
FUNDAMENTALS = "ticker string, source string, annees array<string>, metrics map<string, map<string, string>>"
SIGNAL = "signal string, last_price double, target_30d double, confidence string, trend string"


def text_table(spark: SparkSession, path: str, sep: str = ";") -> DataFrame:
    """A delimited file with a header; every column is text, a byte order mark is dropped."""
    return spark.read.csv(path, sep=sep, header=True, inferSchema=False)


def parted_line(text: Column, sep: str) -> Column:
    """The fields of a line, without their quotes; empty ones are null."""
    pieces = F.regexp_extract_all(F.concat(F.lit(sep), text), F.lit(f'{re.escape(sep)}("(?:[^"]|"")*"|[^{re.escape(sep)}]*)'), F.lit(1))
    plain = lambda x: F.when(x.startswith('"') & x.endswith('"') & (F.length(x) > 1), F.replace(F.substr(x, F.lit(2), F.length(x) - 2), F.lit('""'), F.lit('"'))).otherwise(x)
    return F.transform(pieces, lambda x: F.nullif(plain(x), F.lit("")))


def delimited(spark: SparkSession, path: str, sep: str = ";") -> DataFrame:
    """file, line, fields (text by the name that the file's own header gives), extra: one row for each line of all files that is not blank.

    One scan: a file is read whole (these files hold one symbol's days), its first line is its
    header, so files may order their columns as they like or lack some. A name that comes twice
    counts where it comes first; line breaks within quotes are not read. extra: more fields than the header has.
    """
    raw = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file"), F.split(F.translate("value", "\ufeff", ""), r"\r\n|\n|\r").alias("lines"))
    # Names first: what stands beside posexplode is worked out for each line, and would keep the whole file with it.
    raw = raw.select("file", F.transform(parted_line(F.get("lines", F.lit(0)), sep), lambda x: F.btrim(x)).alias("names"), "lines")
    own = raw.select("file", "names", F.posexplode("lines").alias("at", "text")).where("at > 0 and trim(text) <> ''")
    own = own.select("file", (F.col("at") + 1).alias("line"), "names", parted_line(F.col("text"), sep).alias("values"))
    count = lambda c: F.coalesce(F.array_max(F.transform(c, lambda x, i: F.when(x.isNotNull(), i))), F.lit(-1))
    # Each named place once; a line may be shorter than its header.
    first = F.filter(F.sequence(F.lit(0), F.greatest(count("names"), F.lit(0))), lambda i: F.get("names", i).isNotNull() & (F.array_position("names", F.get("names", i)) == i + 1))
    return own.select("file", "line", F.map_from_arrays(F.transform(first, lambda i: F.get("names", i)), F.transform(first, lambda i: F.get("values", i))).alias("fields"), (count("values") > count("names")).alias("extra"))


def field(name: str) -> Column:
    return F.try_element_at("fields", F.lit(name))


def any_date(text: Column) -> Column:
    return F.coalesce(F.try_to_date(text, "yyyy-MM-dd"), F.try_to_date(text, "dd/MM/yyyy"))


def bars_of(lines: DataFrame) -> DataFrame:
    """Bars of lines that `delimited` gives."""
    number = lambda name: french.clean_number(field(name))
    own = lines.select(F.regexp_replace("file", r"_historique\.csv.*$", "").alias("symbol_key"), any_date(field("Date")).alias("date"), number("Ouverture").alias("open"), number("Plus_Haut").alias("high"), number("Plus_Bas").alias("low"), number("Cloture").alias("close"), F.coalesce(number("Volume_Titres"), F.lit(0.0)).alias("volume"), number("Volume_FCFA").alias("turnover"), number("Variation_Pct").alias("variation"))
    return own.where("date is not null and close is not null")


def bars(spark: SparkSession, path: str) -> DataFrame:
    """symbol_key (from the file's name), date, open, high, low, close, volume, turnover, variation; columns go by each file's own header.

    Rows without a date or a close are dropped; a volume that is no number counts as 0.
    """
    return bars_of(delimited(spark, path))


def documents(spark: SparkSession, path: str, schema: str, lines: bool = False) -> DataFrame:
    """One row for each file, or for each line of files that hold a document a line; file says which. What does not fit the schema is null."""
    return spark.read.json(path, schema=schema, multiLine=not lines).withColumn("file", F.col("_metadata.file_name"))


def profiles(spark: SparkSession, path: str) -> DataFrame:
    """file, fields (all scraped pairs), shares (under the first of its names that holds digits), readable."""
    raw = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file"), F.ltrim(F.translate("value", "\ufeff", "")).alias("value"))
    own = raw.withColumn("fields", F.from_json("value", "map<string,string>"))
    named = [french.digits(F.try_element_at("fields", F.lit(n))) for n in ("Nombre_Titres", "Nombre_Actions", "Nombre de titres")]
    return own.select("file", "fields", F.coalesce(*named).alias("shares"), (F.coalesce(F.size("fields"), F.lit(0)) > 0).alias("readable"))


def fundamentals(spark: SparkSession, path: str) -> DataFrame:
    """ticker, exercice, metric, value, raw: one row for each figure of each year."""
    own = documents(spark, path, FUNDAMENTALS).select("ticker", F.explode("metrics").alias("metric", "years"))
    own = own.select("ticker", "metric", F.explode("years").alias("exercice", "raw"))
    return own.select("ticker", F.col("exercice").try_cast("int").alias("exercice"), "metric", french.clean_number(F.col("raw")).alias("value"), "raw")


def upcoming_dividends(spark: SparkSession, path: str) -> DataFrame:
    """ticker, name, amount, yield_pct, ex_date, pay_date; dates may be ISO or with slashes."""
    raw = text_table(spark, path)
    get = lambda name: F.col(name) if name in raw.columns else F.lit(None).cast("string")
    date = lambda name: F.try_to_date(french.slash_date(get(name)), "yyyy-MM-dd")
    return raw.select(get("Ticker").alias("ticker"), get("Nom").alias("name"), french.clean_number(get("Montant_Net")).alias("amount"), french.clean_number(get("Rendement_Pct")).alias("yield_pct"), date("Date_Detachement").alias("ex_date"), date("Date_Paiement").alias("pay_date"))


def keyed_documents(spark: SparkSession, path: str, field: str, value_type: str, lines: bool = False) -> DataFrame:
    """key, value of a map that a document holds under a field: signals or an allocation by ticker."""
    return documents(spark, path, f"`{field}` map<string, {value_type}>", lines).select(F.explode(field).alias("key", "value"))


def signals(spark: SparkSession, path: str) -> DataFrame:
    return keyed_documents(spark, path, "signals", f"struct<{SIGNAL.replace(' ', ':').replace(',:', ',')}>").select(F.col("key").alias("ticker"), "value.*")


def allocation(spark: SparkSession, path: str) -> DataFrame:
    return keyed_documents(spark, path, "allocation", "double").select(F.col("key").alias("ticker"), F.col("value").alias("weight"))


def symbols_of_kind(coverage: DataFrame, kind: str, history: DataFrame) -> DataFrame:
    """symbol of a kind by the coverage table (Ticker, Type; any case); where it names none, all symbols of the history."""
    named = coverage.where(F.lower(F.btrim("Type")) == kind.lower()).select(F.col("Ticker").alias("symbol")).distinct()
    rest = history.select("symbol").distinct().join(named.limit(1).select(F.lit(1).alias("any_")), how="left").where("any_ is null").select("symbol")
    return named.unionByName(rest)


def latest_ingested(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Of rows with the same keys that of the largest order; ties fall to the largest row."""
    last = Window.partitionBy(*keys).orderBy(F.desc(order), *(F.desc(c) for c in rows.columns if c not in keys))
    return rows.withColumn("rank_", F.row_number().over(last)).where("rank_ = 1").drop("rank_")
