"""Linear trend forecasts with prediction bands."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cloudtally.functions.exact import moments


def linear_forecast(df: DataFrame, entity: str, index: str, value: str, horizon: int,
                    z_80: float, z_95: float, date: str | None = None) -> DataFrame:
    """Forecast ``horizon`` steps per entity from a least-squares line of value on index.

    With ``date``, each step also has the month it is for, counted from the entity's last one.

    One aggregation: no model object, no Python, and the sums combine on the map side and in any order. The line
    needs two rows, the bands three; without them the columns are NULL.
    """
    m = moments(index, value)
    fit = df.groupBy(entity).agg(
        m.n.alias("n"), m.mean_x.alias("mean_x"), m.mean_y.alias("mean_y"), F.max(F.col(index).cast("double")).alias("last_x"),
        m.slope().alias("slope"), m.sxx.alias("sxx"), m.syy.alias("syy"),
        *([F.max(date).alias("last_date")] if date else []),
    )
    n, sxx = F.col("n").cast("double"), F.nullif(F.col("sxx"), F.lit(0.0))
    rest = F.greatest(F.col("syy") - F.col("slope") * F.col("slope") * F.col("sxx"), F.lit(0.0))
    spread = F.when(F.col("n") >= 3, F.sqrt(rest / F.nullif(n - 2, F.lit(0.0))))
    ahead = F.col("last_x") + F.col("step")
    error = F.col("spread") * F.sqrt(1 + 1 / n + F.pow(ahead - F.col("mean_x"), 2) / sxx)
    point = F.col("mean_y") + F.col("slope") * (ahead - F.col("mean_x"))
    steps = F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("step")
    return (
        fit.withColumn("spread", spread)
        .select("*", steps)
        .select(
            entity, "step", *([F.add_months("last_date", F.col("step")).alias("forecast_month")] if date else []),
            point.alias("forecast"),
            (point - error * z_80).alias("low_80"), (point + error * z_80).alias("high_80"),
            (point - error * z_95).alias("low_95"), (point + error * z_95).alias("high_95"),
        )
    )
