"""Temporary views for ad-hoc SQL over the warehouse."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tillmark.operators import analytics, features


def register_views(sales: DataFrame, products: DataFrame, stores: DataFrame, daily: DataFrame,
                   weekly: DataFrame | None = None, ranks: DataFrame | None = None) -> list[str]:
    """Register the tables and the four analytical views; returns their names.

    Views are evaluated per query, with the query's filters pushed into them.  ``ranks`` is the table of monthly product
    ranks that the nightly job keeps; without it the ranks are computed now, and hold what the sales are now.
    """
    views = {
        "fact_sales": sales,
        "dim_product": products,
        "dim_store": stores,
        "agg_daily_demand": daily,
        "v_top_products_monthly": analytics.monthly_product_rank(sales, products) if ranks is None else analytics.with_product_names(ranks, products),
        "v_store_performance": analytics.store_performance(sales, stores),
        "v_category_demand_trend": analytics.category_trend(sales, products),
        "v_ml_ready_dataset": features.ml_dataset(daily),
    }
    if weekly is not None:
        views["agg_weekly_demand"] = weekly
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return list(views)
