"""Border-arrival analytics on Spark: lake, warehouse, checks and reports."""
