"""Daily series to product universe, correlations and fitted demand."""

from __future__ import annotations

from pyspark.sql import DataFrame

from comboscope.constants import JUMP_DATE, SERIES_DROP_ITEMS, SERIES_DROP_PREFIX
from comboscope.functions.storage import written
from comboscope.operators.correlation import correlated_products, quantity_correlations
from comboscope.operators.demand import demand_model
from comboscope.operators.series import product_universe


def plan_demand(primary: DataFrame, secondary: DataFrame, steps: int = 257, corr_threshold: float = 0.6,
                align: str = "date", prefix: str | None = SERIES_DROP_PREFIX, names: list = SERIES_DROP_ITEMS,
                jump_date: str = JUMP_DATE, jump_factor: float = 2.0, **model) -> dict[str, DataFrame]:
    """Tables ``series``, ``pairs`` and those of the demand model for the chosen products."""
    series = written(product_universe(primary, secondary, prefix=prefix, names=names, jump_date=jump_date,
                                      jump_factor=jump_factor), "universe")
    pairs = written(quantity_correlations(series, align), "pairs")
    fitted = demand_model(series, correlated_products(pairs, corr_threshold), steps, **model)
    return {"series": series, "pairs": pairs, **fitted}
