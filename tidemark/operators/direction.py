"""Direction of the next closes: lagged features, a split by time, boosted trees, and measures of their answers.

A row's features look back only and its label forward only; training ends where a label
would reach past the cut, so nothing of the test days is learned. Windows have the symbol
as their key.
"""

from __future__ import annotations

from pyspark.ml import Model
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.bars import by_date

FEATURES = ["ret1", "ret5", "ret20", "mean10", "mean20", "rsi14", "deviation20", "volume20", "range20"]
#: Rows of its symbol that a row needs before it.
HISTORY = 20


def features(bars: DataFrame, horizon: int = 1) -> DataFrame:
    """symbol, date, FEATURES, label (1: the close is higher horizon rows later; null where there is none yet), label_date.

    Takes symbol, date, high, low, close, volume; rows with a null date, or a close that is null or not positive, are left out. Quotients by 0 are 0, but the strength of a flat series is 50.
    """
    own = bars.where("date is not null and close > 0").select("symbol", "date", *(F.coalesce(F.col(c).cast("double"), F.col("close").cast("double") if c != "volume" else F.lit(0.0)).alias(c) for c in ("high", "low", "close", "volume")))
    w = by_date()
    close, back = F.col("close"), lambda k: F.lag("close", k).over(w)
    span = lambda n: w.rowsBetween(1 - n, 0)
    own = own.withColumns({"step": close - back(1), "ret1": close / back(1) - 1, "place": F.row_number().over(w)})
    up, down = (F.sum(F.greatest(c, F.lit(0.0))).over(span(14)) for c in (F.col("step"), -F.col("step")))
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    top, low = F.max("high").over(span(20)), F.min("low").over(span(20))
    own = own.select(
        "symbol",
        "date",
        "place",
        "ret1",
        (close / back(5) - 1).alias("ret5"),
        (close / back(20) - 1).alias("ret20"),
        (close / F.avg("close").over(span(10)) - 1).alias("mean10"),
        (close / F.avg("close").over(span(20)) - 1).alias("mean20"),
        F.when(up + down > 0, 100 * up / (up + down)).otherwise(50.0).alias("rsi14"),
        zero(F.stddev_samp("ret1").over(span(20))).alias("deviation20"),
        zero(F.try_divide("volume", F.avg("volume").over(span(20)))).alias("volume20"),
        zero(F.try_divide(close - low, top - low)).alias("range20"),
        F.when(F.lead("close", horizon).over(w).isNotNull(), (F.lead("close", horizon).over(w) > close).cast("int")).alias("label"),
        F.lead("date", horizon).over(w).alias("label_date"),
    )
    return own.where(F.col("place") > HISTORY).drop("place")


def cut_date(rows: DataFrame, share: float = 0.7) -> DataFrame:
    """One row with the cut: the day at a share of the way from the first to the last date."""
    first, last = F.min("date"), F.max("date")
    return rows.agg(F.date_add(first, F.floor(F.datediff(last, first) * share).cast("int")).alias("cut"))


def split(rows: DataFrame, share: float = 0.7) -> DataFrame:
    """Adds part: train (label known by the cut), test (features after it), between (neither) or open (no label yet)."""
    part = F.when(F.col("label").isNull(), "open").when(F.col("label_date") <= F.col("cut"), "train").when(F.col("date") > F.col("cut"), "test").otherwise("between")
    # The cut is one row.
    return rows.crossJoin(F.broadcast(cut_date(rows, share))).withColumn("part", part).drop("cut")


def vectors(rows: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=FEATURES, outputCol="features_").transform(rows)


def trained(train: DataFrame, rounds: int = 12, depth: int = 3, seed: int = 7) -> Model | None:
    """Boosted trees over the rows with a label; None where a class is missing."""
    kinds = {r[0] for r in train.where("label is not null").select("label").distinct().collect()}  # two rows at most
    if len(kinds) < 2:
        return None
    return GBTClassifier(featuresCol="features_", labelCol="label", maxIter=rounds, maxDepth=depth, seed=seed).fit(vectors(train).select("features_", F.col("label").cast("double").alias("label")))


def predicted(model: Model, rows: DataFrame) -> DataFrame:
    """rows with probability_up and predicted (1 from a half on)."""
    own = model.transform(vectors(rows)).withColumn("probability_up", vector_to_array("probability")[1])
    return own.select(*rows.columns, "probability_up", (F.col("probability_up") >= 0.5).cast("int").alias("predicted"))


def measured(answers: DataFrame) -> DataFrame:
    """One row for answers (label, predicted): n, accuracy, f1_up, f1_down, f1_macro; rows without a label do not count, a class never met nor named has 0, and for no rows all are 0."""
    hit = lambda a, b: F.count_if((F.col("label") == a) & (F.col("predicted") == b))
    own = answers.where("label is not null").agg(hit(1, 1).alias("tp"), hit(0, 1).alias("fp"), hit(1, 0).alias("fn"), hit(0, 0).alias("tn"))
    f1 = lambda t: F.coalesce(F.try_divide(2.0 * F.col(t), 2 * F.col(t) + F.col("fp") + F.col("fn")), F.lit(0.0))
    n = F.expr("tp + fp + fn + tn")
    return own.select(n.alias("n"), F.coalesce(F.try_divide(F.col("tp") + F.col("tn"), n.cast("double")), F.lit(0.0)).alias("accuracy"), f1("tp").alias("f1_up"), f1("tn").alias("f1_down"), ((f1("tp") + f1("tn")) / 2).alias("f1_macro"))


def importances(spark: SparkSession, model: Model) -> DataFrame:
    """feature, importance; they add up to 1."""
    return spark.createDataFrame(list(zip(FEATURES, (float(x) for x in model.featureImportances.toArray()), strict=True)), "feature string, importance double")
