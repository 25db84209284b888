"""Detail documents, restrictions, orders by name, and stored tables."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tidemark.functions import french
from tidemark.operators import detail, portfolio
from tidemark.sources import loads, parted, sinks

D = dt.date


def test_details(spark):
    quotes = spark.createDataFrame([("A", D(2024, 1, k), float(k)) for k in range(1, 9)] + [("B", D(2024, 1, 1), 5.0), ("A", None, 1.0), (None, D(2024, 1, 1), 1.0)], "symbol string, date date, close double")
    profiles = spark.createDataFrame([("A", "Banque"), ("C", "Eau"), ("C", "Air")], "symbol string, sector string")
    figures = spark.createDataFrame([("A", 2023, 7.0), ("A", 2021, 5.0)], "symbol string, exercice int, per double")
    upcoming = spark.createDataFrame([("A", D(2024, 1, 1), 1.0), ("A", D(2024, 6, 1), 2.0), ("A", D(2024, 5, 1), 3.0), ("B", None, 4.0)], "symbol string, ex_date date, amount double")
    got = {r.symbol: r for r in detail.security_details(quotes, profiles, None, figures, upcoming, F.to_date(F.lit("2024-02-01")), n=3).collect()}
    assert set(got) == {"A", "B", "C"}
    a, b, c = got["A"], got["B"], got["C"]
    assert [(h.date.day, h.close, round(h.change, 6)) for h in a.history] == [(6, 6.0, 0.2), (7, 7.0, round(1 / 6, 6)), (8, 8.0, round(1 / 7, 6))] and a.quote == a.history[-1]
    assert a.profile.sector == "Banque" and [(f.exercice, f.per) for f in a.figures] == [(2021, 5.0), (2023, 7.0)] and (a.next_dividend.ex_date, a.next_dividend.amount) == (D(2024, 5, 1), 3.0) and a.signal is None
    assert b.quote.change is None and (b.next_dividend.ex_date, b.next_dividend.amount) == (None, 4.0) and b.figures == []
    assert c.quote is None and c.history == [] and c.profile.sector == "Eau"
    assert detail.security_details(quotes.limit(0)).count() == 0


def test_names(spark):
    names = ["Zoé", "Zoe", "zoe", "éclair", "Eclair", "eclat", "cote", "coté", "côte", "Abc", None]
    got = [r.name for r in detail.by_name(spark.createDataFrame([(n,) for n in names], "name string").repartition(3)).collect()]
    assert got == [None, "Abc", "cote", "coté", "côte", "Eclair", "éclair", "eclat", "zoe", "Zoe", "Zoé"]
    codes = spark.createDataFrame([(c,) for c in ("X", "SECOND", "A", "FIRST")], "code string")
    assert [r.code for r in detail.headline_first(codes, "code", ["FIRST", "SECOND", "THIRD"]).collect()] == ["FIRST", "SECOND", "A", "X"]


def test_keys(spark):
    rows = spark.createDataFrame([("A", 1), ("B", 2), (None, 3)], "symbol string, v int")
    keys = lambda *k: spark.createDataFrame([(x,) for x in k], "symbol string")
    assert {r.v for r in detail.restricted(rows, keys("B", "B", "Z")).collect()} == {2}
    assert {r.v for r in detail.restricted(rows, keys()).collect()} == {1, 2, 3} == {r.v for r in detail.restricted(rows, keys(None)).collect()}
    assert {tuple(r) for r in detail.overlap(keys("A", "B", "B", None), keys("B", "C")).collect()} == {("A", "left"), ("B", "both"), ("C", "right")}
    upcoming = spark.createDataFrame([("A", D(2024, 6, 1), 2.0), ("A", D(2024, 6, 1), 3.0), ("A", None, 9.0), ("Z", D(2024, 1, 1), 1.0)], "symbol string, ex_date date, amount double")
    plan = spark.createDataFrame([("A", 10), ("B", 5)], "symbol string, quantity int")
    assert {(r.symbol, r.amount, r.income) for r in detail.expected_income(plan, upcoming).collect()} == {("A", 3.0, 30.0), ("B", None, None)}


def test_null_portfolio(spark):
    rows = [(None, 1, "DEPOSIT", None, 1, 50.0), (None, 2, "BUY", "S", 1, 10.0), (1, 1, "WITHDRAW", None, 1, 5.0), (1, 1, "DEPOSIT", None, 1, 9.0)]
    got = portfolio.replayed(spark.createDataFrame(rows, "portfolio long, seq long, type string, symbol string, quantity long, price double")).collect()
    assert {(r.portfolio, r.seq, r.applied, r.cash) for r in got} == {(None, 1, True, 50.0), (None, 2, True, 40.0), (1, 1, True, 9.0), (1, 1, True, 4.0)}  # deposits of a moment come first
    assert portfolio.replayed(spark.createDataFrame([], "portfolio long, seq long, type string, symbol string, quantity long, price double")).count() == 0


def test_stored_table_is_locked(spark, tmp_path):
    table = sinks.StoredTable(spark, str(tmp_path / "t"))
    rows = spark.createDataFrame([(1, {"a": 1}), (1, {"a": 2}), (2, None)], "k int, m map<string, int>")
    assert {r.k for r in table.upsert(rows, ["k"]).collect()} == {1, 2}
    number = parted.Versions(spark, str(tmp_path / "t")).latest()[0]
    parted.Versions(spark, str(tmp_path / "t")).commit(number + 1, "other")
    with pytest.raises(parted.Conflict):
        table.write(rows, number=number)


def test_movers_and_positions(spark):
    rows = [(s, D(2024, 1, k), float(c)) for s, own in {"A": [10, 11], "B": [10, 9], "C": [10, 12], "D": [10, 11], "E": [5]}.items() for k, c in enumerate(own, 1)] + [("F", D(2024, 1, 2), 3.0)]
    quotes = spark.createDataFrame(rows, "symbol string, date date, close double")
    got = [(r.side, r["rank"], r.symbol, round(r.change, 6)) for r in detail.movers(quotes, 2).orderBy("side", "rank").collect()]
    assert got == [("flop", 1, "B", -0.1), ("flop", 2, "A", 0.1), ("top", 1, "C", 0.2), ("top", 2, "A", 0.1)]
    doc = json.loads(detail.movers_document(quotes, 1).first().document)
    assert doc["date"] == "2024-01-02" and [r["symbol"] for r in doc["top"]] == ["C"] and [r["symbol"] for r in doc["flop"]] == ["B"]
    earnings = spark.createDataFrame([("A", 2022, 5.0), ("A", 2023, 2.0), ("B", 2023, -1.0)], "symbol string, exercice int, bnpa double")
    profiles = spark.createDataFrame([("A", 100, "x")], "symbol string, shares long, sector string")
    own = {r.symbol: (r.per, r.total_return and round(r.total_return, 6), r.cap, r.sector) for r in detail.positioning(quotes, earnings, profiles).collect()}
    assert own["A"] == (5.5, 0.1, 1100.0, "x") and own["B"][0] is None and own["E"] == (None, 0.0, None, None)


def test_canonical_and_lookups(spark):
    rows = spark.createDataFrame([("A_B_ci", 1), ("Z_ci", 2), (None, 3)], "symbol_key string, v int")
    documents = spark.createDataFrame([("A_B_ci_societe.json", "A-B.ci"), ("Q_ci_societe.json", None)], "file string, ticker string")
    assert {(r.v, r.symbol) for r in detail.canonical(rows, documents).collect()} == {(1, "A-B.ci"), (2, None), (3, None)}
    texts = spark.createDataFrame([(" OUI ",), ("x",), (None,)], "c string")
    assert [r[0] for r in texts.select(french.looked_up(F.col("c"), {"oui": "yes"}, "other")).collect()] == ["yes", "other", "other"]


def test_import_steps():
    ran = []
    steps = {k: (lambda k=k: ran.append(k) or k.upper()) for k in "abc"}
    assert loads.steps_run(steps, "c, a") == {"a": "A", "c": "C"} and ran == ["a", "c"]
    assert list(loads.steps_run(steps)) == ["a", "b", "c"]
    with pytest.raises(ValueError, match="no such step: x"):
        loads.steps_run(steps, "a,x")
    assert ran == ["a", "c", "a", "b", "c"]
