"""The scored parameter table several queries start from."""

from __future__ import annotations

from fadecast.operators.score import nested_rmse
from fadecast.operators.series import regularise
from fadecast.plans.backtest import seasonal_naive
from fadecast.plans.search import ParamGrid, attach_params
from fadecast.sources import tables

GRID_PARAMS = ParamGrid({"batch_size": [32, 64], "depth": [1, 2], "season": [24, 168]})


def hourly_grid(spark, sf):
    """Gap-free hourly series with zeros in the gaps: ``unique_id, ds, y0, pos, n``."""
    e = tables.electricity(spark, sf).select("unique_id", "ds", "y")
    g = regularise(e, ["unique_id"], "ds", 3600, fill="zero", values=["y"])
    return g.withColumnRenamed("y", "y0")


def scored(spark, sf):
    """Back-test score of every configuration of the seasonal-naive grid."""
    configs = GRID_PARAMS.all_configs()
    points = seasonal_naive(hourly_grid(spark, sf), ["unique_id"], "y0", configs)
    rmse = nested_rmse(points, ["unique_id"], "fold", by=["config_id"]).drop("n_folds")
    return attach_params(rmse, configs)
