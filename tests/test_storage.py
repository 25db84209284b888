"""Merges by part, loads by file, header-aware scans and first writes of streams."""

import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidemark.sources import files, loads, parted
from tidemark.streaming import ingest

D = dt.date
BARS = "symbol string, date date, close double"


def table(spark, path):
    return parted.PartedTable(spark, str(path), F.year("date"), derive=parted.changes)


def changes(rows):
    """By hand, of the last given row for each key."""
    own, out = dict(sorted(((s, d), c) for s, d, c in rows)), {}
    for (s, d), c in own.items():
        before = max((x for x in own if x[0] == s and x[1] < d), default=None)
        out[s, d] = (c, None if before is None else round(100 * (c / own[before] - 1), 2))
    return out


def stored(t):
    return {(r.symbol, r.date): (r.close, r.change) for r in t.read().collect()}


def held(path):
    return {p: (p.stat().st_mtime_ns, p.read_bytes()) for p in Path(path).rglob("*.parquet")}


def test_merge_by_part(spark, tmp_path):
    frame = lambda rows: spark.createDataFrame(rows, BARS)
    base = [(s, D(y, m, 5), 100.0 + 7 * k + y % 7 * m) for k, s in enumerate("AB") for y in (2020, 2021, 2022) for m in (1, 6, 12)] + [("C", D(2020, 3, 1), 10.0), ("C", D(2022, 3, 1), 30.0)]
    t = table(spark, tmp_path / "t")
    assert t.read() is None and t.merge(frame([])) == []
    assert t.merge(frame([*base, (None, D(2020, 1, 1), 1.0), ("A", None, 1.0)])) == ["2020", "2021", "2022"]
    assert stored(t) == changes(base)
    before = held(tmp_path / "t")
    # New rows at the end touch their year only; the first new row looks back at the last old one.
    new = [("A", D(2023, 1, 5), 500.0), ("C", D(2023, 2, 1), 15.0)]
    assert t.merge(frame(new)) == ["2023"]
    assert stored(t) == changes([*base, *new]) and stored(t)["C", D(2023, 2, 1)] == (15.0, -50.0)
    # A correction at the end of a year changes the first row of the symbol's next year with rows, wherever that is.
    fix = [("C", D(2020, 3, 1), 20.0)]
    assert t.merge(frame(fix)) == ["2020", "2022"]
    rows = [*[r for r in base if r[:2] != fix[0][:2]], *new, *fix]
    assert stored(t) == changes(rows) and stored(t)["C", D(2022, 3, 1)] == (30.0, 50.0)
    assert all(held(tmp_path / "t")[p] == v for p, v in before.items())  # no file of a version is ever changed
    parts = t.state()[1]["parts"]
    assert parts["2021"] != parts["2020"] == parts["2022"] != parts["2023"]
    # A replay gives the same table, as does a build at once.
    t.merge(frame(fix))
    whole = table(spark, tmp_path / "whole")
    whole.merge(frame(rows))
    assert stored(t) == stored(whole) == changes(rows)


def test_two_writers(spark, tmp_path):
    versions = parted.Versions(spark, str(tmp_path / "v"))
    assert versions.latest() == (0, "")
    versions.commit(1, "a")
    with pytest.raises(parted.Conflict):
        versions.commit(1, "b")
    (tmp_path / "v/versions/000000000002").write_text("half")  # a writer that died
    assert versions.latest() == (1, "a\n")


HEAD = "Date;Ouverture;Plus_Haut;Plus_Bas;Cloture;Volume_Titres;Volume_FCFA;Variation_Pct"


def test_columns_by_name(spark, tmp_path):
    (tmp_path / "A_historique.csv").write_text(f"﻿{HEAD}\n2024-01-02;1;4;1;3;10;30;0,5\n", encoding="utf-8")
    (tmp_path / "B_historique.csv").write_text("Cloture; Date ;Ouverture;Autre;Cloture\r\n999;03/01/2024;3;x;5\r\n\r\n", encoding="utf-8")
    (tmp_path / "C_historique.csv").write_text('Date;Cloture\n2024-01-04;"1 000,5"\n', encoding="utf-8")
    (tmp_path / "D_historique.csv").write_text("", encoding="utf-8")
    (tmp_path / "E_historique.csv").write_text("Date;Ouverture\n2024-01-04;1\n", encoding="utf-8")
    got = {r.symbol_key: r for r in files.bars(spark, str(tmp_path / "*_historique.csv")).collect()}
    assert set(got) == {"A", "B", "C"}
    assert (got["A"].open, got["A"].close, got["A"].volume, got["A"].variation) == (1, 3, 10, 0.5)
    assert (got["B"].open, got["B"].close, got["B"].date, got["B"].high, got["B"].volume) == (3, 999, D(2024, 1, 3), None, 0)
    assert got["C"].close == 1000.5


def test_loads_by_file(spark, tmp_path):
    (tmp_path / "A_historique.csv").write_text(f"{HEAD}\n2024-01-02;1;4;1;3;10;30;0\n2024-01-03;1;4;1;5;x;30;0\n")
    (tmp_path / "B_historique.csv").write_text(f"{HEAD}\n2024-01-02;1;4;1;3;10;30;0\nsoon;1;4;1;5;1;30;0\n2024-01-04;1;4;1;;1;30;0\n")
    (tmp_path / "C_historique.csv").write_text(f"{HEAD}\n2024-01-02;1;4;1;3;10;30;0;9;9\n")
    got = loads.bar_files(spark, str(tmp_path / "*_historique.csv"))
    assert {(r.file[0], r.rows, r.faulty, r.first_fault, r.accepted) for r in got.report.collect()} == {("A", 2, 0, None, True), ("B", 3, 2, "no close", False), ("C", 1, 1, "too many fields", False)}
    assert {(r.symbol_key, r.close, r.volume) for r in got.accepted.collect()} == {("A", 3.0, 10.0), ("A", 5.0, 0.0)}
    assert {(r.file[0], r.line, r.fault) for r in got.rejected.collect()} == {("B", 2, None), ("B", 3, "no date"), ("B", 4, "no close"), ("C", 2, "too many fields")}
    some = loads.bar_files(spark, str(tmp_path / "*_historique.csv"), most=2)
    assert some.accepted.count() == 3 and some.rejected.count() == 0
    rows = spark.createDataFrame([(None, 1), (None, -1), ("x", 2)], "file string, v int")
    own = loads.by_file(rows, {"low": F.col("v") < 0})
    assert [tuple(r) for r in own.accepted.collect()] == [("x", 2)] and own.rejected.count() == 2
    assert loads.by_file(rows.limit(0), {"low": F.col("v") < 0}).report.count() == 0


def test_first_writes_for_good(spark, tmp_path):
    for k, v in ingest.ROCKS.items():
        spark.conf.set(k, v)
    try:
        schema = "id long, seq long, title string"
        put = lambda n, rows: spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/in/{n}")

        def run():
            stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(f"{tmp_path}/in")
            out = ingest.first_writes(stream, "id", ["seq"]).writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start()
            out.awaitTermination()
            return sorted(map(tuple, spark.read.schema(schema).parquet(f"{tmp_path}/out").collect()))

        put(1, [(1, 5, "late"), (1, 2, "first"), (2, 1, "two"), (None, 1, "none"), (1, 2, "first")])
        assert run() == [(1, 2, "first"), (2, 1, "two")]
        put(2, [(1, 1, "earlier but after"), (3, 9, "three")])  # a new start from the checkpoint
        put(3, [(3, 1, "again"), (2, 0, "again")])
        assert run() == [(1, 2, "first"), (2, 1, "two"), (3, 9, "three")]
        assert run() == [(1, 2, "first"), (2, 1, "two"), (3, 9, "three")]
    finally:
        for k in ingest.ROCKS:
            spark.conf.unset(k)
