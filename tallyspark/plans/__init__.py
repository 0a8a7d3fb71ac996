"""Whole models (M1-M15) as DataFrame -> DataFrame functions, and the DAG runner."""

from tallyspark.plans.revenue import (fees_raw, product_prices, product_revenue, revenue_by_period,
                                      sol_prices, staking_jito, staking_native, staking_revenue,
                                      unified_revenue, jito_api_rows)
from tallyspark.plans.epochs import epoch_info, voting_times
from tallyspark.plans.blocks import tx_per_block

__all__ = ["fees_raw", "product_prices", "product_revenue", "revenue_by_period", "sol_prices",
           "staking_jito", "staking_native", "staking_revenue", "unified_revenue", "jito_api_rows",
           "epoch_info", "voting_times", "tx_per_block"]
