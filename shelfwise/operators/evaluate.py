"""Figures over predictions. Each function is one aggregate, so one pass."""

from pyspark.sql import Column, DataFrame, functions as F


def has_prediction(column="prediction") -> Column:
    """A prediction that is neither NULL nor NaN (what a cold start leaves behind)."""
    return F.col(column).isNotNull() & ~F.isnan(column)


def drop_unpredicted(predictions: DataFrame) -> DataFrame:
    return predictions.dropna(subset=["prediction"])


def _percent(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, F.round(part * 100.0 / whole, 1))


def rmse(predictions: DataFrame, label="rating", prediction="prediction") -> DataFrame:
    """``(n, rmse)`` over the predicted rows; ``rmse`` is NULL if there are none."""
    error = F.when(has_prediction(prediction), F.col(label) - F.col(prediction))
    return predictions.agg(
        F.count(error).alias("n"), F.sqrt(F.avg(error * error)).alias("rmse")
    )


def summary(df: DataFrame, *columns: str) -> DataFrame:
    """Count, mean, sample standard deviation, least and greatest value, one row a column."""
    figures = df.agg(*[
        F.struct(
            F.lit(c).alias("column_name"), F.count(c).alias("n"), F.avg(c).alias("mean"),
            F.stddev_samp(c).alias("stddev"), F.min(c).cast("double").alias("min"),
            F.max(c).cast("double").alias("max"),
        ).alias(c)
        for c in columns
    ])
    return figures.select(F.inline(F.array(*columns)))


def coverage(predictions: DataFrame) -> DataFrame:
    """``(valid, total, percent)``; give it rows whose cold starts were kept as NaN."""
    valid, total = F.count_if(has_prediction()), F.count("*")
    return predictions.agg(
        valid.alias("valid"), total.alias("total"), _percent(valid, total).alias("percent")
    )


def evaluation(predictions: DataFrame) -> DataFrame:
    """All figures a run reports, from one scan of predictions with cold starts kept as NaN."""
    valid, total = F.count_if(has_prediction()), F.count("*")
    error = F.when(has_prediction(), F.col("rating") - F.col("prediction"))
    return predictions.agg(
        total.alias("test_rows"), valid.alias("predicted_rows"),
        _percent(valid, total).alias("percent"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
    )
