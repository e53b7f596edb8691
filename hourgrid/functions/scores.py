"""Forecast error measures as aggregate expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: added to the actual in the percentage error.
MAPE_EPSILON = 1e-10


def mae(y: Column, p: Column) -> Column:
    return F.avg(F.abs(y - p))


def rmse(y: Column, p: Column) -> Column:
    return F.sqrt(F.avg(F.pow(y - p, 2)))


def r2(y: Column, p: Column) -> Column:
    """1 - SSE/SST; constant actuals score 1 when hit exactly and 0 otherwise."""
    sse, sst = F.avg(F.pow(y - p, 2)), F.var_pop(y)
    return F.when(sst > 0, 1 - sse / F.when(sst > 0, sst)).when(sse == 0, 1.0).otherwise(0.0)


def mape(y: Column, p: Column, epsilon: float = MAPE_EPSILON) -> Column:
    return F.avg(F.abs((y - p) / (y + F.lit(epsilon)))) * 100


def mape_nonzero(y: Column, p: Column) -> Column:
    """Percentage error over rows with a non-zero actual."""
    return F.avg(F.when(y != 0, F.abs((y - p) / F.when(y != 0, y)))) * 100


def poisson_deviance(y: Column, p: Column) -> Column:
    mu = F.greatest(p, F.lit(1e-9))
    return F.avg(2 * (F.when(y > 0, y * F.log(y / mu)).otherwise(0.0) - y + mu))


def score_columns(y: Column, p: Column) -> list[Column]:
    return [mae(y, p).alias("mae"), rmse(y, p).alias("rmse"), r2(y, p).alias("r2"), mape(y, p).alias("mape")]
