"""Time-series operators over ``(keys..., ts, value)`` frames.

Every operator takes ``keys`` (series id columns, possibly empty). Rows are
numbered within their series and windows run over ranges of these numbers that
carry the neighbouring rows (:mod:`opsight.operators.series`), so many series run in
parallel and a single long one spreads over tasks as well.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from opsight.operators.series import RANGE_ROWS, in_ranges, numbered, own_rows, range_window


def gap_fill(df: DataFrame, keys: Sequence[str], ts: str = "ts", value: str = "value",
             fill_value: float | None = 0.0) -> DataFrame:
    """One row per day from each series' first to last day; missing days get
    ``fill_value`` (0 for volume series; None keeps them NULL)."""
    keys = list(keys)
    span = df.groupBy(*keys).agg(F.min(ts).alias("__lo"), F.max(ts).alias("__hi"))
    days = span.select(*keys, F.explode(F.sequence("__lo", "__hi", F.expr("INTERVAL 1 DAY"))).alias(ts))
    out = days.join(df.select(*keys, ts, value), [*keys, ts], "left")
    if fill_value is not None:
        out = out.withColumn(value, F.coalesce(F.col(value), F.lit(float(fill_value))))
    return out


def decompose(df: DataFrame, keys: Sequence[str], ts: str = "ts", value: str = "value",
              period: int = 7, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Additive decomposition: trend = centred moving average, seasonal = mean
    detrended value per phase (centred to mean 0), resid = value − trend − seasonal (J1).

    Odd ``period``: plain centred mean over ``period`` rows; even: the 2×period
    average (half weight on both ends over period+1 rows). The trend is NULL
    where the window is incomplete. Phase = position in the series mod period.
    """
    keys = list(keys)
    half = period // 2
    rows = in_ranges(numbered(df.select(*keys, ts, value), keys, ts), half, half, range_rows)
    w = range_window(keys)
    frame = w.rowsBetween(-half, half)
    y = F.col(value).cast("double")
    if period % 2:
        trend = F.when(F.count(y).over(frame) == period, F.avg(y).over(frame))
    else:
        ends = F.lag(y, half).over(w) + F.lead(y, half).over(w)
        inner = F.sum(y).over(frame) - ends
        trend = F.when(F.count(y).over(frame) == period + 1, (inner + 0.5 * ends) / period)
    base = own_rows(rows.select(*keys, ts, y.alias(value), trend.alias("trend"), ((F.col("__i") - 1) % period).alias("phase"),
                                "__i", "__n", "__range", "__own"))
    phase_means = base.groupBy(*keys, "phase").agg(F.avg(F.col(value) - F.col("trend")).alias("pm"))
    kw = Window.partitionBy(*keys) if keys else Window.partitionBy()
    seasonal = phase_means.select(*keys, "phase", (F.col("pm") - F.avg("pm").over(kw)).alias("seasonal"))
    out = base.join(seasonal, [*keys, "phase"], "left")
    return out.select(*keys, ts, value, "trend", "seasonal",
                      (F.col(value) - F.col("trend") - F.col("seasonal")).alias("resid"))


def rolling_stats(df: DataFrame, keys: Sequence[str], ts: str = "ts", value: str = "value",
                  window: int = 30, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Trailing rolling mean and sample std over ``window`` rows; NULL until the
    window is full (pandas ``rolling(window)``) (J2, F9)."""
    keys = list(keys)
    rows = in_ranges(numbered(df.select(*keys, ts, value), keys, ts), window - 1, 0, range_rows)
    frame = range_window(keys).rowsBetween(-(window - 1), 0)
    full = F.count(F.col(value)).over(frame) == window
    return own_rows(rows.withColumns({"rolling_mean": F.when(full, F.avg(value).over(frame)),
                                      "rolling_std": F.when(full, F.stddev_samp(value).over(frame))}))


def anomaly_band(df: DataFrame, keys: Sequence[str], ts: str = "ts", value: str = "value",
                 window: int = 30, sigma: float = 2.5, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Rows outside centred rolling mean ± sigma·std.

    Centred windows: odd sizes are symmetric; an even size n covers rows
    i − n/2 … i + n/2 − 1 (as pandas ``center=True``). Only full windows count,
    so the first n/2 and last n/2 − 1 rows cannot be flagged.
    """
    keys = list(keys)
    before = window // 2
    after = window // 2 - 1 if window % 2 == 0 else window // 2
    rows = in_ranges(numbered(df.select(*keys, ts, value), keys, ts), before, after, range_rows)
    frame = range_window(keys).rowsBetween(-before, after)
    full = F.count(F.col(value)).over(frame) == window
    band = own_rows(rows.withColumns({"mean": F.when(full, F.avg(value).over(frame)),
                                      "std": F.when(full, F.stddev_samp(value).over(frame))}))
    band = band.select("*", (F.col("mean") - sigma * F.col("std")).alias("lower"),
                       (F.col("mean") + sigma * F.col("std")).alias("upper"))
    return band.filter((F.col(value) > F.col("upper")) | (F.col(value) < F.col("lower")))


def holdout_split(df: DataFrame, keys: Sequence[str], ts: str = "ts", horizon: int = 30) -> DataFrame:
    """Mark the last ``horizon`` rows of each series as ``is_test``."""
    keys = list(keys)
    rows = numbered(df, keys, ts)
    return rows.withColumn("is_test", F.col("__n") - F.col("__i") < horizon).drop("__i", "__n")


def forecast_errors(forecast: DataFrame, actual: DataFrame, keys: Sequence[str], ts: str = "ts",
                    value: str = "value", predicted: str = "forecast") -> DataFrame:
    """MAE and RMSE per series of forecasts aligned to actuals by (keys, ts)."""
    keys = list(keys)
    j = forecast.select(*keys, ts, predicted).join(actual.select(*keys, ts, value), [*keys, ts], "inner")
    e = F.col(value) - F.col(predicted)
    return j.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.avg(F.abs(e)).alias("mae"),
                                F.sqrt(F.avg(e * e)).alias("rmse"))
