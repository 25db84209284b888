"""Dividends of two sources: increments by year, fusion, divergence, status."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import french

OFFICIAL = "official"
KEY = ["ticker", "exercice"]


def history_rows(wide: DataFrame, years: list[int]) -> DataFrame:
    """ticker, exercice, amount, yield_pct from columns Div_YYYY and Rend_YYYY_Pct; years without an amount are left out."""
    one = lambda y: F.struct(F.lit(str(y)).alias("exercice"), french.clean_number(F.col(f"Div_{y}")).alias("amount"), french.clean_number(F.col(f"Rend_{y}_Pct")).alias("yield_pct"))
    return wide.select("ticker", F.explode(F.array(*map(one, years))).alias("own")).select("ticker", "own.*").where("amount is not null")


def fused(rows: DataFrame) -> DataFrame:
    """One row for each key of rows (ticker, exercice, src, seq, ex_date, pay_date, amount, yield_pct, notice).

    With an official row: its first one's dates (where ISO) and amount stand, else the first valid
    ones of the other rows; the yield is the last other row's, even a null. Without one, all is the
    first row's, even a null. Sources are joined in order by commas. seq orders a source's rows.
    """
    ours = F.col("src") == OFFICIAL
    place = F.struct((~ours).cast("int").alias("other"), "seq")  # official rows come first
    first = lambda value, when: F.min_by(value, F.when(when, place))
    head = F.struct("ex_date", "pay_date", "amount", "yield_pct", "notice")
    own = rows.groupBy(*KEY).agg(
        F.max(ours).alias("known"), F.min_by(head, place).alias("head"), F.max_by("yield_pct", F.when(~ours, F.col("seq"))).alias("last_yield"), F.count_if(~ours).alias("others"),
        *(first(c, ~ours & french.is_iso(F.col(c))).alias(f"other_{c}") for c in ("ex_date", "pay_date")), first("amount", ~ours & F.col("amount").isNotNull()).alias("other_amount"),
        F.array_join(F.array_sort(F.collect_set("src")), ",").alias("sources"),
    )
    date = lambda c: F.when(~F.col("known") | french.is_iso(F.col(f"head.{c}")), F.col(f"head.{c}")).otherwise(F.coalesce(f"other_{c}", f"head.{c}"))
    amount = F.when(~F.col("known"), F.col("head.amount")).otherwise(F.coalesce("head.amount", "other_amount"))
    rate = F.when(F.col("known") & (F.col("others") > 0), F.col("last_yield")).otherwise(F.col("head.yield_pct"))
    return own.select(*KEY, date("ex_date").alias("ex_date"), date("pay_date").alias("pay_date"), amount.alias("amount"), rate.alias("yield_pct"), F.col("head.notice").alias("notice"), "sources", (F.col("known") & (F.abs(F.col("head.amount") - F.col("other_amount")) > 0.01)).alias("diverges"))


def status(ex_date: Column, today: Column) -> Column:
    """'A préciser' without an ISO date, 'Passé' before today, else 'A venir'."""
    return F.when(~french.is_iso(ex_date), "A préciser").when(ex_date < today.cast("string"), "Passé").otherwise("A venir")


def listed(rows: DataFrame) -> DataFrame:
    """Newest year first, then newest payment, then the ticker."""
    return rows.orderBy(F.desc_nulls_last("exercice"), F.desc_nulls_last("pay_date"), "ticker")
