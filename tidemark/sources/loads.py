"""Loads by file: a file with a faulty row stays out whole, the others load, and every file is accounted for."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import french
from tidemark.sources import files


@dataclass
class Loads:
    """accepted rows; rejected: the rows of files that stay out, with fault (null for their sound rows); report: file, rows, faulty, first_fault, accepted."""

    accepted: DataFrame
    rejected: DataFrame
    report: DataFrame


def by_file(rows: DataFrame, faults: dict[str, Column], file: str = "file", most: int = 0) -> Loads:
    """Sorts rows by whether their file has more faulty rows than most; a row's fault is the first of the conditions that holds (null conditions do not)."""
    fault = F.coalesce(*(F.when(condition, F.lit(name)) for name, condition in faults.items()))
    own = rows.withColumn("fault", fault)
    report = own.groupBy(file).agg(F.count("*").alias("rows"), F.count("fault").alias("faulty"), F.min("fault").alias("first_fault"))
    report = report.withColumn("accepted", F.col("faulty") <= most)
    bad = report.where(~F.col("accepted")).select(F.col(file).alias("bad_file_"))
    same = F.col(file).eqNullSafe(F.col("bad_file_"))
    return Loads(own.join(bad, same, "left_anti").where("fault is null").drop("fault"), own.join(bad, same, "left_semi"), report)


def bar_files(spark: SparkSession, path: str, most: int = 0) -> Loads:
    """Loads of bar files: a row is faulty without a date, with a close that is no number, or with more fields than its header. Accepted rows are as files.bars gives them."""
    lines = files.delimited(spark, path)
    get = files.field
    faults = {"no date": files.any_date(get("Date")).isNull(), "no close": french.clean_number(get("Cloture")).isNull(), "too many fields": F.col("extra")}
    got = by_file(lines, faults, most=most)
    return Loads(files.bars_of(got.accepted), got.rejected, got.report)


def steps_run(steps: dict[str, Callable[[], object]], only: str | None = None) -> dict[str, object]:
    """Runs the steps in their order, or those alone that only names (by commas, in any order), and returns what each gives; a name that is no step stops all before the first."""
    wanted = list(steps) if only is None else [x.strip() for x in only.split(",") if x.strip()]
    if unknown := sorted(set(wanted) - set(steps)):
        raise ValueError(f"no such step: {', '.join(unknown)}")
    return {name: step() for name, step in steps.items() if name in wanted}
