"""Reports, quality checks, the daily rollup and the hourly job."""
