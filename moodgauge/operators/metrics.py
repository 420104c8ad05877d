"""Classification metrics as aggregates over (label, prediction)."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def confusion(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """(label, prediction, n); the label is the truth."""
    return scored.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count("*").alias("n")
    )


def _ratio(top: Column, bottom: Column) -> Column:
    """Zero where the denominator is zero, as common metric libraries report it."""
    return F.when(bottom == 0, 0.0).otherwise(top / bottom)


def binary_metrics(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Accuracy, precision, recall and F1 of class 1, in one pass."""
    truth, guess = F.col(label) == 1, F.col(prediction) == 1
    sums = scored.agg(
        F.count("*").alias("n"),
        F.count_if(F.col(label) == F.col(prediction)).alias("right"),
        F.count_if(truth & guess).alias("tp"),
        F.count_if(guess).alias("guessed"),
        F.count_if(truth).alias("actual"),
    )
    c = F.col
    return sums.select(
        c("n"),
        _ratio(c("right").cast("double"), c("n")).alias("accuracy"),
        _ratio(c("tp").cast("double"), c("guessed")).alias("precision"),
        _ratio(c("tp").cast("double"), c("actual")).alias("recall"),
        _ratio(2.0 * c("tp"), c("guessed") + c("actual")).alias("f1"),
    )


def class_report(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Precision, recall, F1 and support of every class, from the confusion counts alone."""
    cells = confusion(scored, label, prediction)
    roles = cells.select(
        "n",
        (F.col("label") == F.col("prediction")).alias("hit"),
        F.explode(
            F.array(
                F.struct(F.col("label").alias("class"), F.lit(1).alias("actual")),
                F.struct(F.col("prediction").alias("class"), F.lit(0).alias("actual")),
            )
        ).alias("r"),
    )
    is_actual = F.col("r.actual") == 1
    sums = roles.groupBy(F.col("r.class").alias("class")).agg(
        F.sum(F.when(is_actual & F.col("hit"), F.col("n")).otherwise(0)).alias("tp"),
        F.sum(F.when(~is_actual, F.col("n")).otherwise(0)).alias("guessed"),
        F.sum(F.when(is_actual, F.col("n")).otherwise(0)).alias("support"),
    )
    c = F.col
    return sums.select(
        "class",
        _ratio(c("tp").cast("double"), c("guessed")).alias("precision"),
        _ratio(c("tp").cast("double"), c("support")).alias("recall"),
        _ratio(2.0 * c("tp"), c("guessed") + c("support")).alias("f1"),
        "support",
    )
