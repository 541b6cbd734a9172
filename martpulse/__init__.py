"""Shop analytics on Spark: daily devices, turnover, wide sales, coupon alerts and sale search."""
