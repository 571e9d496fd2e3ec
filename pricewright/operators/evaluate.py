"""Regression metrics and comparisons."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .. import schemas

def _relative_error(y: Column, p: Column) -> Column:
    """|y-p|/|y|; a target of zero gives infinity, or NaN when the prediction is zero too."""
    at_zero = F.when(p == 0, float("nan")).otherwise(float("inf"))
    return F.when(y != 0, F.abs((y - p) / y)).otherwise(at_zero)


def regression_metrics(
    df: DataFrame, actual: str = "price", predicted: str = "predicted_price"
) -> DataFrame:
    """R², MAE, MSE, RMSE and MAPE in percent, as one row from one pass."""
    y, p = F.col(actual).cast("double"), F.col(predicted).cast("double")
    error = y - p
    unexplained, spread = F.sum(error * error), F.var_pop(y) * F.count(y)
    constant = F.when(unexplained == 0, 1.0).otherwise(0.0)
    return df.filter(y.isNotNull() & p.isNotNull()).agg(
        F.count(F.lit(1)).alias("rows"),
        F.when(spread != 0, 1 - F.try_divide(unexplained, spread)).otherwise(constant).alias("r2"),
        F.avg(F.abs(error)).alias("mae"),
        F.avg(error * error).alias("mse"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        (F.avg(_relative_error(y, p)) * 100).alias("mape"),
    )


def baseline_delta(
    metrics: DataFrame,
    baseline_r2: float = schemas.BASELINE_R2,
    baseline_mae: float = schemas.BASELINE_MAE,
) -> DataFrame:
    """Differences to the published baseline and whether R² improved."""
    return metrics.withColumns(
        {
            "r2_delta": F.col("r2") - baseline_r2,
            "mae_delta": F.col("mae") - baseline_mae,
            "improved": F.col("r2") > baseline_r2,
        }
    )


def comparison_record(metrics: DataFrame, algorithm: str) -> DataFrame:
    return metrics.select(F.lit(algorithm).alias("algorithm"), "r2", "mae", "rmse", "mape")


def comparison_table(records: DataFrame) -> DataFrame:
    """Algorithms by R², scores with two places."""
    return (
        records.orderBy(F.desc("r2"), "algorithm")
        .select(
            "algorithm",
            *[F.round(F.col(c), 2).alias(c) for c in ("r2", "mae", "rmse", "mape")],
        )
    )


def result_record(
    metrics: DataFrame,
    algorithm: str,
    best_params: dict[str, float],
    numeric: Sequence[str] = tuple(schemas.NUMERIC),
    categorical: Sequence[str] = tuple(schemas.CATEGORICAL),
    new_tables: Sequence[str] = tuple(schemas.NEW_TABLES),
    leakage_fixed: bool = True,
) -> DataFrame:
    """The full result of a training run as one nested row. Defaults are those of the current model."""
    params = F.create_map(
        *[item for k, v in best_params.items() for item in (F.lit(k), F.lit(float(v)))]
    )

    def texts(values: Sequence[str]) -> Column:
        return F.array(*[F.lit(v) for v in values]).cast("array<string>")

    return baseline_delta(metrics).select(
        F.lit(algorithm).alias("algorithm"),
        "r2",
        "mae",
        "mape",
        F.lit(len(numeric) + len(categorical)).alias("features_count"),
        texts(numeric).alias("features_numeric"),
        texts(categorical).alias("features_categorical"),
        params.alias("best_params"),
        F.struct("r2_delta", "mae_delta").alias("vs_baseline"),
        texts(new_tables).alias("new_tables_used"),
        F.lit(leakage_fixed).alias("leakage_fixed"),
    )
