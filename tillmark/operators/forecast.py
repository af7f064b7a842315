"""Statistical forecasts of every series in one job.

A series is reduced to its last points (at most 30, or the horizon) and a handful
of sums; the forecast is arithmetic on those.  Positions count present days, as
row lags do; densify the series first to count calendar days.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillmark.operators.features import densify as dense

MIN_POINTS = 14
TREND_POINTS = 30
SEASON = 7
MA_WINDOW = 7


def series_from_daily(daily: DataFrame, keys: Sequence[str] = ("product_id",), day: str = "agg_date",
                      value: str = "total_quantity", densify: bool = False) -> DataFrame:
    """One value per key and day; with ``densify`` also for the days between without a row, 0 there."""
    series = daily.groupBy(*keys, F.col(day).alias("day")).agg(F.sum(value).cast("long").alias("y"))
    return dense(series, keys, "y", "day") if densify else series


def fitted(series: DataFrame, keys: Sequence[str] = ("product_id",), horizon: int = 30,
           ma_window: int = MA_WINDOW, period: int = SEASON, min_points: int = MIN_POINTS) -> DataFrame:
    """Model state per series with enough points.

    ``back`` numbers points from the newest (1).  The filter on it keeps a bounded
    tail of every series; the regression runs over x = 0 .. n-1 in time order, from
    whole-number sums.
    """
    keep = max(TREND_POINTS, horizon, ma_window, period, min_points)
    newest = Window.partitionBy(*keys).orderBy(F.col("day").desc())
    tail = series.withColumn("back", F.row_number().over(newest)).filter(F.col("back") <= keep)
    in_trend = F.col("back") <= TREND_POINTS
    y, x = F.when(in_trend, F.col("y")), F.when(in_trend, -F.col("back").cast("long"))
    sums = tail.groupBy(*keys).agg(
        F.max("day").alias("last_day"),
        F.count(F.lit(1)).alias("points"),
        F.count(y).alias("n"),
        F.sum(y).alias("sy"), F.sum(x).alias("sx"), F.sum(x * y).alias("sxy"), F.sum(x * x).alias("sxx"),
        F.avg(F.when(F.col("back") <= ma_window, F.col("y"))).alias("ma"),
        F.avg(F.when(F.col("back") <= horizon, F.col("y"))).alias("history_avg"),
        # At most one season of values, oldest first.
        F.sort_array(F.collect_list(F.when(F.col("back") <= period, F.struct(-F.col("back"), F.col("y").alias("y")))))
        .alias("season"),
    ).filter(F.col("points") >= min_points)
    n, sx, sy, sxy, sxx = (F.col(c).cast("double") for c in ("n", "sx", "sy", "sxy", "sxx"))
    # x counts -n .. -1 so far; shifting it by n leaves the slope alone.
    slope = (n * sxy - sx * sy) / (n * sxx - sx * sx)
    return (sums.withColumn("slope", slope)
            .withColumn("intercept", (sy - F.col("slope") * (sx + n * n)) / n)
            .select(*keys, "last_day", "n", "ma", "history_avg", "slope", "intercept", "season"))


def steps_ahead(models: DataFrame, horizon: int) -> DataFrame:
    """One row per series and future day."""
    return (models.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
            .withColumn("forecast_date", F.date_add("last_day", F.col("step"))))


def moving_average() -> Column:
    return F.col("ma")


def linear_trend() -> Column:
    x = F.col("n").cast("double") + F.col("step").cast("double") - 1
    return F.greatest(F.col("slope") * x + F.col("intercept"), F.lit(0.0))


def seasonal_naive() -> Column:
    # The season is as long as the data allow, normally the full period.
    position = F.pmod(F.col("step") - 1, F.size("season")) + 1
    return F.greatest(F.element_at("season", position.cast("int"))["y"].cast("double"), F.lit(0.0))


def forecast(series: DataFrame, model: Column, keys: Sequence[str] = ("product_id",), horizon: int = 30, **fit) -> DataFrame:
    """A single model's forecast: `moving_average()`, `linear_trend()` or `seasonal_naive()`."""
    return steps_ahead(fitted(series, keys, horizon, **fit), horizon).select(
        *keys, "step", "forecast_date", model.alias("forecast"))


def ensemble(series: DataFrame, keys: Sequence[str] = ("product_id",), horizon: int = 30, **fit) -> DataFrame:
    """Mean of the three models with 80 % and 95 % bands from their spread."""
    models = steps_ahead(fitted(series, keys, horizon, **fit), horizon).withColumns({
        "ma": moving_average(), "linear": linear_trend(), "seasonal": seasonal_naive()})
    mean = (F.col("ma") + F.col("linear") + F.col("seasonal")) / 3
    off = [F.col(c) - F.col("forecast") for c in ("ma", "linear", "seasonal")]
    spread = F.sqrt((off[0] * off[0] + off[1] * off[1] + off[2] * off[2]) / 2)
    banded = models.withColumn("forecast", mean).withColumn("_std", spread)
    return banded.select(
        *keys, "step", "forecast_date", "forecast",
        F.greatest(F.col("forecast") - 1.28 * F.col("_std"), F.lit(0.0)).alias("lower_80"),
        (F.col("forecast") + 1.28 * F.col("_std")).alias("upper_80"),
        F.greatest(F.col("forecast") - 1.96 * F.col("_std"), F.lit(0.0)).alias("lower_95"),
        (F.col("forecast") + 1.96 * F.col("_std")).alias("upper_95"),
        "ma", "linear", "seasonal", "history_avg",
    )


def forecast_summary(forecasts: DataFrame, keys: Sequence[str] = ("product_id",)) -> DataFrame:
    """Total and mean forecast, and the change on the last horizon of history in percent.

    Summed as decimals, so the total does not depend on the order of the rows.
    """
    totals = forecasts.groupBy(*keys).agg(
        F.sum(F.col("forecast").cast("decimal(20,6)")).cast("double").alias("total_forecast"),
        F.count(F.lit(1)).alias("_steps"),
        F.max("history_avg").alias("history_avg"))
    mean = F.col("total_forecast") / F.col("_steps")
    return totals.withColumn("avg_forecast", mean).withColumn(
        "pct_change", (F.col("avg_forecast") - F.col("history_avg")) / F.greatest("history_avg", F.lit(1.0)) * 100,
    ).drop("_steps")
